"""Writing: full refresh, partition replacement and upsert of Parquet tables.

Tables are directories partitioned by day.  Replacing writes go through a
staged copy, so a table is never overwritten by a plan that still reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.quality import is_day_loaded, require
from ridelake.session import delete_path, path_exists, staging_path
from ridelake.sources.key_days import KeyDays, forget, has_index, is_one_of, note_days, noted_by_other, same, store_schema, stored_schema

# Fixed value: start of the first load, 2020-11-01 00:00 in the market's zone (epoch seconds).
FIRST_LOAD_START = 1604156400


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A written copy of ``df`` that is removed afterwards, also on failure."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


@contextmanager
def staged_and_measured(df: DataFrame, label: str, measures: Mapping[str, Column]) -> Iterator[tuple[DataFrame, dict]]:
    """``staged`` with aggregates of the rows that were observed while they were written, so without another scan.

    An aggregate must not be DISTINCT.
    """
    observation = Observation(label)
    observed = df.observe(observation, *[column.alias(name) for name, column in measures.items()])
    with staged(observed, label) as ready:
        yield ready, observation.get


def _by_day(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day together, in tasks of even size: Spark splits heavy days and merges light ones by bytes."""
    return df.hint("rebalance", day)


def overwrite_table(df: DataFrame, path: str, day: str) -> None:
    """Full refresh: every existing partition is dropped."""
    spark = df.sparkSession
    with staged(df, "refresh") as ready:
        (
            _by_day(ready, day)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(day)
            .parquet(path)
        )
    spark.catalog.refreshByPath(path)


def _replace_days(df: DataFrame, path: str, day: str) -> None:
    spark = df.sparkSession
    (
        _by_day(df, day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    spark.catalog.refreshByPath(path)


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replace exactly the days present in ``df``; other days keep their files.

    ``df`` is read once more where the table has a key index, to note its days.
    """
    spark = df.sparkSession
    noted_by_other(spark, path, df.schema, _days_of(df, day) if has_index(spark, path) else [])
    _replace_days(df, path, day)


def overwrite_day(df: DataFrame, path: str, target: dt.date, day: str = "date_kr") -> None:
    """Replace one day.  An empty result empties that day."""
    _publish_day(df, path, target, day, {})


#: Name of the row count among the measures of a day.
ROW_COUNT = "row_count"


def _publish_day(df: DataFrame, path: str, target: dt.date, day: str, expected: Mapping[str, tuple[Column, object]]) -> None:
    """Stage one day, and publish it if what was observed while writing is as expected."""
    spark = df.sparkSession
    rows = df.where(F.col(day) == F.lit(target))
    measures = {ROW_COUNT: F.count(F.lit(1)), **{name: column for name, (column, _) in expected.items()}}
    with staged_and_measured(rows, "day", measures) as (ready, found):
        wrong = [f"{name} is {found.get(name)} and not {value}" for name, (_, value) in expected.items() if found.get(name) != value]
        if wrong:
            raise ValueError(f"{target} was not published: " + "; ".join(wrong))
        if found.get(ROW_COUNT):
            overwrite_days(ready, path, day)
        else:
            drop_day(spark, path, target, day)


def drop_day(spark: SparkSession, path: str, target: dt.date | None, day: str) -> None:
    noted_by_other(spark, path, T.StructType(), [target])
    _remove_day(spark, path, target, day)


def _remove_day(spark: SparkSession, path: str, target: dt.date | None, day: str) -> None:
    value = target.isoformat() if target else "__HIVE_DEFAULT_PARTITION__"
    delete_path(spark, f"{path}/{day}={value}")
    spark.catalog.refreshByPath(path)


def refresh_day(
    source: DataFrame,
    path: str,
    target: dt.date,
    day: str = "date_kr",
    checks: DataFrame | None = None,
    expected: Mapping[str, tuple[Column, object]] | None = None,
) -> str:
    """Load one day unless it is there already: ``"skipped"`` or ``"loaded"``.

    ``checks`` (rows of ``operators.quality``) must all pass before anything is written.  ``expected`` names
    aggregates of the day's rows with the values they must have: they are observed while the day is staged, so
    the source is read once, and a day that fails is not published.
    """
    spark = source.sparkSession
    if checks is not None:
        require(checks)
    if path_exists(spark, path) and is_day_loaded(spark.read.schema(source.schema).parquet(path), target, day):
        return "skipped"
    _publish_day(source, path, target, day, expected or {})
    return "loaded"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def merged(
    target: DataFrame, source: DataFrame, key: str | Sequence[str] = "id", coalesce_null: bool = False
) -> DataFrame:
    """Result of an upsert: source rows replace target rows of the same key, NULLs included.

    NULL keys equal each other.  Columns that only the target has keep their stored value.  With
    ``coalesce_null`` so does every column that is NULL in the source.  ``source`` must hold one row per key;
    its columns must be among the target's.
    """
    keys = _keys(key)
    asked = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    kept = target.join(asked, same(keys, [f"_new_{k}" for k in keys]), "left_anti").select(*target.columns)
    stored_only = [c for c in target.columns if c not in source.columns]
    if not coalesce_null and not stored_only:
        return kept.unionByName(source.select(*target.columns))
    stored = target.select(*[F.col(c).alias(f"_old_{c}") for c in target.columns])
    both = source.join(stored, same(keys, [f"_old_{k}" for k in keys]), "left")

    def final(name: str) -> Column:
        if name in stored_only:
            return F.col(f"_old_{name}").alias(name)
        keep_old = coalesce_null and name not in keys
        return F.coalesce(name, f"_old_{name}").alias(name) if keep_old else F.col(name)

    return kept.unionByName(both.select(*[final(c) for c in target.columns]))


def _require_one_row_per_key(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1).limit(3).collect()
    if repeated:
        raise ValueError("the source has several rows of one key: " + "; ".join(str(r.asDict()) for r in repeated))


def _stored_table(spark: SparkSession, path: str, incoming: T.StructType, day_name: str) -> DataFrame:
    """The table with its own columns and, after them, those that only the new rows have.

    The columns are on record after the first upsert, so no file is opened for them.
    """
    own = stored_schema(spark, path)
    if own is None:
        try:
            own = spark.read.option("mergeSchema", "true").parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            own = T.StructType()  # the folder is there, but all its days are empty
    fields = {f.name: f for f in own.fields} | {f.name: f for f in incoming.fields if f.name == day_name}
    fields |= {f.name: f for f in incoming.fields if f.name not in fields}
    schema = T.StructType(list(fields.values()))
    if stored_schema(spark, path) != schema:
        store_schema(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def upsert_table(
    source: DataFrame,
    path: str,
    day: Column | str,
    key: str | Sequence[str] = "id",
    coalesce_null: bool = False,
    day_name: str = "day",
    day_in_key: bool = False,
) -> str:
    """Upsert rows into a table partitioned by ``day_name`` (derived by ``day``).

    Returns ``"empty"``, ``"created"`` or ``"merged"``.  Only partitions that lose or gain a row are
    read and rewritten, and a row whose day moves leaves its old partition: an index next to the data says
    which day holds a key (``key_days``).  Several source rows of one key are an error.  Columns of the table
    that the source lacks keep their values; new columns are added.
    ``day_in_key``: the day follows from the key, so rows never move and there is no index.
    """
    spark, keys = source.sparkSession, _keys(key)
    day = F.col(day) if isinstance(day, str) else day
    with staged(source.withColumn(day_name, F.to_date(day)), "source") as incoming:
        if incoming.isEmpty():
            return "empty"
        _require_one_row_per_key(incoming, keys)
        index = None if day_in_key else KeyDays(spark, path, keys, day_name)
        if not path_exists(spark, path):
            _by_day(incoming, day_name).write.partitionBy(day_name).parquet(path)
            store_schema(spark, path, incoming.schema)
            if index:
                index.write_all(incoming)
            return "created"

        stored = _stored_table(spark, path, incoming.schema, day_name)
        affected = set(_days_of(incoming, day_name))
        if index:
            affected |= set(index.open(stored).days_of(incoming))
        # Literal days prune the scan to the affected partitions.
        current = stored.where(is_one_of(day_name, affected))
        result = merged(current, incoming, keys, coalesce_null)
        if coalesce_null:
            # The day follows the value that is finally stored.
            result = result.withColumn(day_name, F.to_date(day))
        with staged(result, "merged") as ready:
            final = set(_days_of(ready, day_name))
            note = note_days(spark, path, list(affected | final)) if index else None
            _replace_days(ready, path, day_name)
            # A failure before this block ends is repaired by running the same upsert again.
            for value in affected - final:
                _remove_day(spark, path, value, day_name)
            if index:
                asked = incoming.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
                moved = ready.join(asked, same(keys, [f"_new_{k}" for k in keys]), "left_semi")
                index.replace(moved if coalesce_null else incoming)
                forget(spark, [note])
        spark.catalog.refreshByPath(path)
        return "merged"


def _days_of(df: DataFrame, day: str) -> list[dt.date | None]:
    """Distinct days; at most one value per calendar day of the table."""
    return [row[0] for row in df.select(day).distinct().collect()]


def load_start(spark: SparkSession, path: str, requested_start: int) -> int:
    """Start of a load's search window: the fixed first start while the table is missing."""
    return requested_start if path_exists(spark, path) else FIRST_LOAD_START
