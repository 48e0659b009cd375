"""Which day holds a key: an index that an upserted table keeps next to its data, and the table's schema.

``<table>/_keys/bucket=N`` holds ``key columns, day`` by a hash of the key, ``<table>/_table.json`` the columns and the
number of buckets.  Readers of the table do not see names that begin with an underscore.  A load looks into the buckets of
its own keys only, and rewrites only those.

A writer first notes the days that it is about to change in ``<table>/_pending``, and takes the note back when the index
says what the data say.  A note that is still there is of a load that failed, or of a writer that does not know the keys:
the next load takes the entries of those days from the data again.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.session import delete_path, file_names, materialize, move_path, path_exists, path_size, read_text, write_text

_BUCKET = "bucket"
#: Entries and bytes for which a bucket is made, and beyond which it is cut in two.
BUCKET_ROWS, BUCKET_BYTES = 1_000_000, 128 * 1024 * 1024


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equal keys, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def is_one_of(day: str, values: Sequence[dt.date | None]) -> Column:
    known = F.col(day).isin([v for v in values if v is not None])
    return known | F.col(day).isNull() if None in values else known


# --- what is written about a table --------------------------------------------


def _about(path: str) -> str:
    return f"{path}/_table.json"


def _facts(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, _about(path))) if path_exists(spark, _about(path)) else {}


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    facts = _facts(spark, path)
    return T.StructType.fromJson(facts["schema"]) if "schema" in facts else None


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_text(spark, _about(path), json.dumps({**_facts(spark, path), "schema": schema.jsonValue()}))


def note_days(spark: SparkSession, path: str, days: Sequence[dt.date | None]) -> str:
    """Days that are about to change; returns what ``forget`` takes back."""
    note = f"{path}/_pending/{uuid.uuid4().hex}"
    write_text(spark, note, json.dumps([d.isoformat() if d else None for d in days]))
    return note


def forget(spark: SparkSession, notes: Sequence[str]) -> None:
    for note in notes:
        delete_path(spark, note)


def noted_by_other(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[dt.date | None]) -> None:
    """A writer that replaces whole days of a described table leaves its new columns, and its days if they are indexed."""
    known = stored_schema(spark, path)
    if known is not None:
        new = [f for f in schema.fields if f.name not in known.names]
        if new:
            store_schema(spark, path, T.StructType([*known.fields, *new]))
    if has_index(spark, path):
        note_days(spark, path, days)


def has_index(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_keys")


# --- the index ----------------------------------------------------------------


class KeyDays:
    """The index of one table."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], day: str):
        self.spark, self.path, self.keys, self.day = spark, path, list(keys), day

    @property
    def folder(self) -> str:
        return f"{self.path}/_keys"

    def open(self, table: DataFrame) -> KeyDays:
        """Make the index ready, from the data where it is missing, was made for other keys, or has notes of other writers."""
        notes = [f"{self.path}/_pending/{name}" for name in file_names(self.spark, f"{self.path}/_pending")]
        facts = _facts(self.spark, self.path)
        if not has_index(self.spark, self.path) or facts.get("keys") != self.keys:
            self.write_all(table)
        elif notes:
            texts = {value for note in notes for value in json.loads(read_text(self.spark, note))}
            days = [dt.date.fromisoformat(v) if v else None for v in texts]
            kept = self._entries().where(~F.coalesce(is_one_of(self.day, days), F.lit(False))).drop(_BUCKET)
            self.write_all(kept.unionByName(table.where(is_one_of(self.day, days)).select(*self.keys, self.day)))
        forget(self.spark, notes)
        return self

    @property
    def buckets(self) -> int:
        return _facts(self.spark, self.path)["buckets"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _entries(self) -> DataFrame:
        found = self.spark.read.parquet(self.folder)
        return found.select(*self.keys, self.day, _BUCKET)

    def write_all(self, entries: DataFrame, buckets: int | None = None) -> None:
        """Replace the index.  A failure leaves none or the old one with the notes, and the next load mends both."""
        entries = materialize(entries.select(*self.keys, self.day), "key-days")
        buckets = buckets or max(4, math.ceil(entries.count() / BUCKET_ROWS))
        fresh = f"{self.path}/_keys-{uuid.uuid4().hex}"
        entries.withColumn(_BUCKET, self._bucket(buckets)).repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(fresh)
        delete_path(self.spark, self.folder)
        write_text(self.spark, _about(self.path), json.dumps({**_facts(self.spark, self.path), "keys": self.keys, "buckets": buckets}))
        move_path(self.spark, fresh, self.folder)

    def _touched(self, incoming: DataFrame) -> tuple[DataFrame, list[int]]:
        """The entries in the buckets of the incoming keys, and those buckets."""
        numbers = [r[0] for r in incoming.select(self._bucket(self.buckets).alias(_BUCKET)).distinct().collect()]
        return self._entries().where(F.col(_BUCKET).isin(numbers)), numbers

    def days_of(self, incoming: DataFrame) -> list[dt.date | None]:
        """The days that hold rows of the incoming keys; at most one value per calendar day of the table."""
        asked = incoming.select(*[F.col(k).alias(f"_new_{k}") for k in self.keys])
        entries, _ = self._touched(incoming)
        found = entries.join(asked, same(self.keys, [f"_new_{k}" for k in self.keys]), "left_semi")
        return [r[0] for r in found.select(self.day).distinct().collect()]

    def replace(self, rows: DataFrame) -> None:
        """From now on the keys of ``rows`` lie on the days that they have there."""
        asked = rows.select(*[F.col(k).alias(f"_new_{k}") for k in self.keys])
        entries, _ = self._touched(rows)
        kept = entries.join(asked, same(self.keys, [f"_new_{k}" for k in self.keys]), "left_anti").select(*self.keys, self.day)
        result = materialize(kept.unionByName(rows.select(*self.keys, self.day)), "key-days")
        buckets = self.buckets
        (
            result.withColumn(_BUCKET, self._bucket(buckets))
            .repartition(_BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET)
            .parquet(self.folder)
        )
        if path_size(self.spark, self.folder) > buckets * BUCKET_BYTES:
            self.write_all(self._entries(), 2 * buckets)
