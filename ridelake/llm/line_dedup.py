"""Line dedup over levelled sorted runs of line keys, with DataFrame functions only.

A run is a Parquet table of line keys, sorted, with the smallest document that holds each.  Batches of documents arrive in
ascending id order.  A batch anti-joins the runs (a line whose key a run holds belongs to an earlier document), keeps the
first holder inside the batch, and adds its own new keys as a run of level 0.  When a level has ``fan_in`` runs they are
merged into one run of the next level, so ``n`` batches leave about ``fan_in * log(n)`` runs.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.session import materialize

#: ASCII white space that is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A row without an id counts as the last document.
_LAST = 2**63 - 1


def _key_text(line):
    return F.translate(F.trim(line, F.lit(BLANKS)), _UPPER, _LOWER)


class LineRuns:
    """The runs of one dedup job; ``add`` takes the batches."""

    def __init__(self, spark: SparkSession, fan_in: int = 4, min_chars: int = 10):
        self.spark, self.fan_in, self.min_chars = spark, fan_in, min_chars
        self.levels: list[list[DataFrame]] = [[]]

    def _runs(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return functools.reduce(DataFrame.unionAll, runs) if runs else None

    def add(self, batch: DataFrame) -> DataFrame:
        """Dropped lines ``doc, text_hash, line`` of a batch ``doc, text``; its new keys become a run.

        Every id of the batch must be larger than those of earlier batches.
        """
        lines = batch.select("doc", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line", "content"))
        lines = lines.withColumn("key", _key_text(F.col("content"))).filter(F.length("key") >= self.min_chars)
        # Two independent 64-bit hashes stand for the key: at 10^12 lines one alone would collide.
        lines = lines.select("doc", "text_hash", "line", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
        lines = materialize(lines, "batch-lines")
        # One row per key before anything meets: a frequent line is one row per map task.
        own = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        runs = self._runs()
        if runs is None:
            known = materialize(own.withColumn("older", F.lit(False)), "batch-keys")
        else:
            # An anti join in two halves: keys that a run holds are old, the rest are the new run.
            seen = runs.select("h1", "h2", F.lit(True).alias("seen"))
            known = materialize(own.join(seen, ["h1", "h2"], "left").withColumn("older", F.coalesce("seen", F.lit(False))).drop("seen"), "batch-keys")
        self._push(known.filter(~F.col("older")).select("h1", "h2"))
        repeated = known.filter(F.col("older") | (F.col("last") > F.col("first"))).select("h1", "h2", F.when(F.col("older"), F.lit(-1)).otherwise(F.lit(1)).alias("kind"), "first")
        return lines.join(repeated, ["h1", "h2"]).filter((F.col("kind") < 0) | (F.col("doc") > F.col("first"))).select("doc", "text_hash", "line")

    def _push(self, keys: DataFrame) -> None:
        self.levels[0].append(self._sorted(keys))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fan_in:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._sorted(functools.reduce(DataFrame.unionAll, self.levels[level])))
                self.levels[level] = []

    def _sorted(self, keys: DataFrame) -> DataFrame:
        # Runs are disjoint, so merging them needs no distinct.
        return materialize(keys.hint("rebalance", "h1").sortWithinPartitions("h1", "h2"), "line-run")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 3, fan_in: int = 2) -> DataFrame:
    """Documents without repeated lines: ``id, text, n_lines, n_dropped``, one row per input row.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased.  A key of at least ``min_chars`` code points
    that two documents hold keeps its lines only in the smallest id; shorter ones, blank lines included, stay.  A null or
    empty text is one empty line and gives the text ``""``.  Rows with equal ids are one document; rows with a null id are
    together the last document.  Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.col(text_col).alias("text"))
    bounds = source.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000).alias("at")).first()["at"] or [] if batches > 1 else []
    runs = LineRuns(spark, fan_in, min_chars)
    dropped = []
    edges = [None, *sorted(set(bounds)), None]
    for low, high in zip(edges, edges[1:], strict=False):
        batch = source
        batch = batch if low is None else batch.filter(F.col("doc") > low)
        batch = batch if high is None else batch.filter(F.col("doc") <= high)
        dropped.append(runs.add(batch.select("doc", "text")))
    per_text = functools.reduce(DataFrame.unionAll, dropped).groupBy("doc", "text_hash").agg(F.collect_set("line").alias("dropped"))
    rows = source.withColumn("text_hash", F.xxhash64("text")).join(per_text.hint("shuffle_hash"), ["doc", "text_hash"], "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("dropped", F.expr("cast(array() as array<int>)")))
    rows = rows.select("id", lines.alias("lines"), "dropped").select("id", "lines", kept.alias("kept"))
    text = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    return rows.select("id", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))
