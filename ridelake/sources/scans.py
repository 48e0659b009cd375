"""Reading: partition-pruned scans, landed JSON, and fetch targets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.times import day_suffix, trailing_window
from ridelake.session import path_exists


def scan_trailing(df: DataFrame, target: dt.date, days_back: int = 1, day: str = "date_kr") -> DataFrame:
    """Rows of ``[target - days_back, target]``; late rows are read again on the next day."""
    return df.where(trailing_window(F.col(day), target, days_back))


def scan_since(df: DataFrame, start: dt.date, day: str = "date_kr") -> DataFrame:
    return df.where(F.col(day) >= F.lit(start))


def scan_shard(spark: SparkSession, path: str, shard: dt.date | str, schema: str, fmt: str = "parquet") -> DataFrame:
    """One day of a table stored as ``suffix=YYYYMMDD`` directories; the others are not listed or read."""
    name = shard if isinstance(shard, str) else day_suffix(shard)
    table = spark.read.schema(f"{schema}, suffix STRING").format(fmt).load(path)
    return table.where(F.col("suffix") == name)


_TEXT, _FILE, _BLOCK, _ORDER, _FAULT, _PARSED, _BROKEN = "_text", "_landed_file", "_block", "_order", "_fault", "_parsed", "_corrupt_record"
NOT_JSON, NO_FIELD, WRONG_TYPE = "unparsable", "no declared field", "wrong type: "


def _landed(spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool) -> DataFrame:
    """Every landed document as it stands: its text and place, what its declared fields hold, and why it is not accepted.

    The text is read first and parsed afterwards, so nothing depends on what a JSON reader makes of it.  A document
    that is an array holds one record for each element, and is accepted or not as a whole.
    """
    texts = spark.read.text(path, wholetext=multi_line).select(
        F.col("value").alias(_TEXT),
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_ORDER),
    )
    declared = T.StructType(T.StructType.fromDDL(schema).fields + [T.StructField(_BROKEN, T.StringType())])
    documents = texts.where(F.col(_TEXT).rlike("[^\\s]"))
    # In brackets, whatever follows a document on its line makes it unparsable or a second element.
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), _TEXT, F.lit("]"))), "$", "array<variant>")
    elements = F.transform(F.try_variant_get(alone[0], "$", "array<variant>"), lambda v: F.to_json(v))
    records = F.when(F.size(alone) == 1, F.coalesce(elements, F.array(_TEXT)))

    def read(text: Column) -> Column:
        return F.struct(F.from_json(text, declared, {"columnNameOfCorruptRecord": _BROKEN}).alias("row"), F.try_parse_json(text).alias("doc"))

    parsed = documents.withColumn(_PARSED, F.transform(records, read))
    faults = F.filter(F.transform(_PARSED, lambda r: _fault(r["row"], r["doc"], declared)), lambda f: f.isNotNull())
    return parsed.withColumn(_FAULT, F.when(F.col(_PARSED).isNull(), F.lit(NOT_JSON)).otherwise(F.try_element_at(faults, F.lit(1))))


def _fault(row: Column, doc: Column, declared: T.StructType) -> Column:
    """Why one record is not accepted; NULL if it is.

    Each declared field is looked up in the document itself: what is there and not NULL must have become a value.
    """
    names = [f.name for f in declared.fields if f.name != _BROKEN]

    def there(name: str) -> Column:
        found = F.try_variant_get(doc, "$['" + name + "']", "variant")
        return found.isNotNull() & ~F.is_variant_null(found)

    fault = F.when(doc.isNull(), F.lit(NOT_JSON))
    for name in names:
        fault = fault.when(there(name) & row[name].isNull(), F.lit(WRONG_TYPE + name))
    any_field = reduce(lambda a, b: a | b, [row[name].isNotNull() for name in names])
    # A field whose inner part has a wrong type is broken although it has a value.
    return fault.when(row[_BROKEN].isNotNull(), F.lit(WRONG_TYPE + "inside a field")).when(~any_field, F.lit(NO_FIELD))


def read_landed_json(
    spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = False, strict: bool = False
) -> DataFrame:
    """Accepted landed documents with a declared schema.

    Line-delimited by default, so large files are split between tasks.  A document is accepted if it parses, all
    its declared fields have their type, and it has one of them.  ``quarantined_json`` lists all others; with
    ``strict`` the first of them fails the job.  Blank lines and empty files are no documents.
    """
    return _accepted(_landed(spark, path, schema, multi_line), strict).drop(_FILE)


def _accepted(documents: DataFrame, strict: bool) -> DataFrame:
    """Records of the accepted documents, with their file."""
    if strict:
        text = F.concat(F.lit("landed document rejected: "), F.col(_FAULT), F.lit(" in "), F.col(_FILE))
        kept = documents.where(F.when(F.col(_FAULT).isNull(), True).otherwise(F.raise_error(text).cast("boolean")))
    else:
        kept = documents.where(F.col(_FAULT).isNull())
    rows = kept.select(_FILE, F.explode(_PARSED).alias("_record")).select(F.col("_record.row.*"), _FILE)
    return rows.drop(_BROKEN)


def quarantined_json(spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = False) -> DataFrame:
    """``file_name, block_start, document_order, reason, text`` of every document that ``read_landed_json`` does not accept.

    Accepted and quarantined documents together are all that have landed, and ``text`` is a document as it landed.
    ``document_order`` ascends along a file; ``block_start`` is where in it the split begins that was read.
    """
    documents = _landed(spark, path, schema, multi_line).where(F.col(_FAULT).isNotNull())
    name = F.regexp_extract(_FILE, "([^/]*)$", 1)
    return documents.select(name.alias("file_name"), F.col(_BLOCK).alias("block_start"), F.col(_ORDER).alias("document_order"), F.col(_FAULT).alias("reason"), F.col(_TEXT).alias("text"))


def accepted_texts(spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = False) -> DataFrame:
    """``file_name, text`` of the accepted documents, as they landed."""
    documents = _landed(spark, path, schema, multi_line).where(F.col(_FAULT).isNull())
    return documents.select(F.regexp_extract(_FILE, "([^/]*)$", 1).alias("file_name"), F.col(_TEXT).alias("text"))


def read_pages(
    spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = True, strict: bool = False
) -> DataFrame:
    """Accepted landed API pages, one document per file, with their load and page number.

    The number is the document's own ``page`` or else the last number in the file name
    (``tickets-0007.json``), or NULL.  ``load`` is the file's path without that number: the pages of one
    chain of requests share it.
    """
    documents = _accepted(_landed(spark, path, schema, multi_line), strict)
    numbered = F.regexp_extract(_FILE, "([0-9]+)[^0-9/]*$", 1)
    page = F.nullif(numbered, F.lit("")).try_cast("bigint")
    return documents.select(
        F.regexp_replace(_FILE, "[0-9]+[^0-9/]*$", "").alias("load"),
        (F.coalesce("page", page) if "page" in documents.columns else page).alias("page"),
        *[name for name in documents.columns if name not in ("page", "load", _FILE)],
    )


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Catalog table, or directory when the name has a slash."""
    if "/" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def search_targets(spark: SparkSession, forecast_table: str, seed_path: str, seed_schema: str) -> DataFrame:
    """Places to fetch: those already in the forecast table, else the seed file's."""
    if table_exists(spark, forecast_table):
        return read_table(spark, forecast_table).select("h3_l7", "lat", "lon").distinct()
    return read_landed_json(spark, seed_path, seed_schema, multi_line=True)


def run_sql(spark: SparkSession, text_or_path: str, **params) -> DataFrame:
    """SQL text, or a ``.sql`` file, with named parameters such as ``:target_date``.

    Parameters are typed values, never pasted into the text.
    """
    text = text_or_path
    if text_or_path.endswith(".sql"):
        with open(text_or_path, encoding="utf-8") as source:
            text = source.read()
    return spark.sql(text, args=params)
