"""Results that are replaced batch by batch while others read them.

Every batch writes folders of its own; one small file, ``<path>/_live.json``, names those that make up the result.
Replacing that file is the commit: readers see the old result or the new one, a batch that fails leaves the old one, and a
batch that was committed already is not applied again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridelake.session import delete_path, path_exists, read_text, write_text


@dataclass
class Live:
    """What a result consists of: a folder for each part, and facts that its writer keeps."""

    of: str = ""
    batch: int = -1
    parts: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)

    def has(self, of: str, batch: int) -> bool:
        """Whether this batch of this query is part of it."""
        return self.of == of and self.batch >= batch


def live(spark: SparkSession, path: str) -> Live:
    at = f"{path}/_live.json"
    return Live(**json.loads(read_text(spark, at))) if path_exists(spark, at) else Live()


def publish(spark: SparkSession, path: str, new: Live, keep: Iterable[str] = ()) -> None:
    """Make ``new`` the result.  Folders that neither it nor the result before it names are removed.

    The result before stays for readers that have listed it; ``keep`` names folders that are no longer part of the
    result but are still wanted.
    """
    before = live(spark, path)
    gone = set(before.facts.get("_before", [])) - {*new.parts.values(), *before.parts.values(), *keep}
    new.facts["_before"] = sorted(before.parts.values())
    write_text(spark, f"{path}/_live.json", json.dumps(new.__dict__))
    for folder in gone:
        delete_path(spark, f"{path}/{folder}")


def read_live(spark: SparkSession, path: str, schema: T.StructType, parts: Iterable[str] | None = None) -> DataFrame:
    """The result, or some parts of it; empty where there is none yet."""
    known = live(spark, path).parts
    folders = [f"{path}/{known[p]}" for p in (known if parts is None else parts)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a streaming query: batch numbers mean something only within one."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
