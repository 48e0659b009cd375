"""Ranked lexical search over a length-stratified index.

Every document has a normaliser ``m`` that follows from its number of terms alone.  An index segment holds whole texts of
about ``segment_bytes``; in it documents with equal ``m`` form a stratum, and a term's postings lie by stratum and then by
``tf``.  Documents of one stratum and one ``tf`` share the impact of a term, so it is computed once for all of them, and the
largest ``tf`` of a term in a stratum bounds what the term can add there.  A search visits the strata of a segment by
descending bound and leaves the rest once no bound reaches the worst of the best documents known so far.

Segments are pieces of the table in its own partitioning: no text is shuffled, no segment follows from a key, and a hot term
or a common length is spread over all of them.  A search sends the queries to the segments, in blocks of bounded size.

An index is a folder with ``segments`` (a row per segment) and ``totals`` (the number of documents with a term, and of terms).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ridelake.session import materialize

# What a term is, how its case is folded, and the constants of the normaliser and the impact.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH_SHARE, LENGTH_BASE = 25, 75
SCALE, TF_FACTOR, LENGTH_FACTOR = 1_000_000_000, 1000, 12

#: Documents of the strata that are visited first; each further wave takes four times as many.
FIRST_WAVE = 256

_BYTES = np.arange(256)
_IN_TERM = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight is multiplied by."""
    return (SCALE * tf) // (TF_FACTOR * tf + LENGTH_FACTOR * m)


def _edges(texts: pa.StringArray) -> np.ndarray:
    if not len(texts):
        return np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def _spans(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, term starts, term ends, number of terms before each text)``."""
    edges = _edges(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_TERM[data]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    borders = edges[inside[edges] & inside[edges + 1]]  # two texts meet inside what looks like one term
    begins[borders] = ends[borders] = True
    starts = np.flatnonzero(begins)
    return data, starts, np.flatnonzero(ends), np.searchsorted(starts, edges)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, pa.StringArray]]:
    """Ids and whole texts of about ``most`` bytes, across batches."""
    held, size = [], 0
    for batch in batches:
        at, edges = 0, _edges(batch["text"])
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + most - size, side="right")) - 1)
            held.append(batch.slice(at, end - at))
            size += int(edges[end] - edges[at])
            at = end
            if size >= most or at < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> tuple[pa.Array, pa.StringArray]:
    return pa.concat_arrays([p["id"] for p in parts]), pa.concat_arrays([p["text"] for p in parts])


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for _, texts in _blocks(batches, most):
        n = np.diff(_spans(texts)[3])
        docs, terms = docs + int(np.count_nonzero(n)), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["n_docs", "n_terms"])


_SEGMENT = "terms array<string>, dfs array<int>, strata binary, stratum_starts binary, run_starts binary, run_strata binary, run_tfs binary, posting_starts binary, postings binary"


def _segment(ids: pa.Array, texts: pa.StringArray, n_docs: int, n_terms: int) -> pa.RecordBatch | None:
    data, starts, ends, before = _spans(texts)
    if not len(starts):
        return None
    lens = ends - starts
    folded = _FOLDED[data][_IN_TERM[data]]
    offsets = np.r_[0, np.cumsum(lens)].astype(np.int32)
    coded = pa.Array.from_buffers(pa.string(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(folded)]).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    n = np.diff(before).astype(np.int64)

    # Documents by stratum and then by id; those without a term are in no posting.
    m = LENGTH_BASE + (LENGTH_SHARE * n * n_docs) // n_terms
    by_id = np.empty(len(ids), np.int64)
    by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    order = np.lexsort((by_id, m))
    order = order[n[order] > 0]
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(order))
    strata, stratum_starts = np.unique(m[order], return_index=True)
    stratum = np.searchsorted(strata, m)

    held, tf = np.unique(np.repeat(place, n) + code * len(order), return_counts=True)
    term, doc = held // len(order), held % len(order)
    cell = term * len(strata) + stratum[order[doc]]
    line = np.lexsort((doc, tf, cell))
    cell, tf, doc = cell[line], tf[line], doc[line]
    first = np.flatnonzero(np.r_[True, (np.diff(cell) != 0) | (np.diff(tf) != 0)])
    run_term = cell[first] // len(strata)
    dfs = np.bincount(term, minlength=len(coded.dictionary))
    whole = [
        strata.astype("<i8"), np.r_[stratum_starts, len(order)].astype("<i4"), np.searchsorted(run_term, np.arange(len(dfs) + 1)).astype("<i4"),
        (cell[first] % len(strata)).astype("<i4"), tf[first].astype("<i4"), np.r_[first, len(doc)].astype("<i4"), doc.astype("<i4"),
    ]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (ids.take(pa.array(order)), coded.dictionary, pa.array(dfs, pa.int32()))]
    names = ["ids", *[part.split()[0] for part in _SEGMENT.split(", ")]]
    return pa.RecordBatch.from_arrays([*lists, *[pa.array([v.tobytes()], pa.binary()) for v in whole]], names)


def build_index(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = 6_000_000) -> None:
    """Index every row of ``docs``.

    Null and empty texts, and texts without a term, are in no posting and do not count.  Rows with equal ids are documents of
    their own; null ids are kept and come last among equal scores.  Ids may have any type that Arrow can sort.  Other
    columns do not matter, and an empty table gives an empty index.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.mapInArrow(lambda batches: _count(batches, segment_bytes), "n_docs long, n_terms long")
    totals = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns])
    totals.coalesce(1).write.parquet(f"{path}/totals")
    n_docs, n_terms = docs.sparkSession.read.parquet(f"{path}/totals").first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, segment_bytes):
            segment = _segment(ids, texts, n_docs, n_terms)
            if segment:
                yield segment

    id_type = rows.schema["id"].dataType.simpleString()
    rows.mapInArrow(run, f"ids array<{id_type}>, {_SEGMENT}").write.option("compression", "zstd").option("maxRecordsPerFile", 8).parquet(f"{path}/segments")


class _Best:
    """The ``k`` largest scores of an item that a task has seen."""

    def __init__(self, k: int):
        self.k, self.scores = k, np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A score below this is not among the best; ties are."""
        return int(self.scores[0]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray) -> None:
        self.scores = np.sort(np.r_[self.scores, scores])[-self.k :]


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    total = int(lens.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lens) - lens), lens)


class _Segment:
    """One segment, with the runs of the terms that a block of queries asks for."""

    def __init__(self, row: dict, asked: pa.Array):
        self.ids = row["ids"]
        strata = np.frombuffer(row["strata"], "<i8")
        self.stratum_starts = np.frombuffer(row["stratum_starts"], "<i4").astype(np.int64)
        run_starts = np.frombuffer(row["run_starts"], "<i4").astype(np.int64)
        self.posting_starts = np.frombuffer(row["posting_starts"], "<i4").astype(np.int64)
        self.postings = np.frombuffer(row["postings"], "<i4")
        run_strata, run_tfs = np.frombuffer(row["run_strata"], "<i4"), np.frombuffer(row["run_tfs"], "<i4")

        found = pc.fill_null(pc.index_in(asked, value_set=row["terms"]), -1).to_numpy()
        lens = np.where(found >= 0, run_starts[found + 1] - run_starts[found], 0)
        self.run = _ranges(run_starts[found], lens)  # of all asked terms, one after the other
        self.edges = np.r_[0, np.cumsum(lens)]
        self.stratum = run_strata[self.run].astype(np.int64)
        self.impact = impact(run_tfs[self.run].astype(np.int64), strata[self.stratum])
        # Runs of a term lie by stratum and tf: the last one of a stratum bounds it.
        term = np.repeat(np.arange(len(found)), lens)
        self.is_last = np.r_[(np.diff(self.stratum) != 0) | (np.diff(term) != 0), True][: len(self.run)]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: _Best) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, scores)`` of the segment that can still be among the best."""
        n_docs, n_strata = len(self.ids), len(self.stratum_starts) - 1
        lens = self.edges[terms + 1] - self.edges[terms]
        own = _ranges(self.edges[terms], lens)
        if not len(own):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stratum, value = self.stratum[own], np.repeat(weights, lens) * self.impact[own]
        last = self.is_last[own]
        bound = np.zeros(n_strata, np.int64)
        np.add.at(bound, stratum[last], value[last])
        order = np.argsort(-bound, kind="stable")
        docs_of = np.diff(self.stratum_starts)[order]
        scores = np.zeros(n_docs, np.int64)
        local = _Best(best.k)
        at, most = 0, FIRST_WAVE
        while at < n_strata:
            least = max(best.least, local.least)
            stop = at + int(np.searchsorted(np.cumsum(docs_of[at:]), most)) + 1
            wave = order[at : min(stop, n_strata)]
            wave = wave[bound[wave] >= least]
            if not len(wave):
                break  # bounds fall: no later stratum can reach the best either
            chosen = np.zeros(n_strata, bool)
            chosen[wave] = True
            picked = np.flatnonzero(chosen[stratum])
            runs = self.run[own[picked]]
            lens = self.posting_starts[runs + 1] - self.posting_starts[runs]
            where = self.postings[_ranges(self.posting_starts[runs], lens)]
            np.add.at(scores, where, np.repeat(value[picked], lens))
            seen = _ranges(self.stratum_starts[wave], np.diff(self.stratum_starts)[wave])
            new = scores[seen]
            local.add(new[new >= max(least, 1)])
            at, most = stop, most * 4
        docs = np.flatnonzero(scores >= max(best.least, local.least, 1))
        if len(docs) > best.k:
            # Documents of a stratum lie by id, so ties are told apart by id over the strata.
            rank = np.empty(len(docs), np.int64)
            rank[pc.sort_indices(self.ids.take(pa.array(docs))).to_numpy()] = np.arange(len(docs))
            docs = docs[np.lexsort((rank, -scores[docs]))[: best.k]]
        best.add(scores[docs])
        return docs, scores[docs]


def _search(batches: Iterator[pa.RecordBatch], queries: dict, k: int) -> Iterator[pa.RecordBatch]:
    best = [_Best(k) for _ in queries["items"]]
    asked = pa.array(queries["terms"], pa.string())
    for batch in batches:
        for row in range(batch.num_rows):
            one = {c: batch[c][row].values if c in ("ids", "terms") else batch[c][row].as_py() for c in batch.schema.names}
            segment = _Segment(one, asked)
            items, docs, scores = [], [], []
            for n, (terms, weights) in enumerate(queries["items"]):
                found, score = segment.search(terms, weights, best[n])
                items.append(np.full(len(found), n))
                docs.append(found)
                scores.append(score)
            if sum(map(len, docs)):
                item, doc = np.concatenate(items), np.concatenate(docs)
                yield pa.RecordBatch.from_arrays([queries["ids"].take(pa.array(item)), segment.ids.take(pa.array(doc)), pa.array(np.concatenate(scores), pa.int64())], ["item", "id", "score"])


def query_terms(items: DataFrame, item_id_col: str, item_text_col: str) -> DataFrame:
    """``item, term, times``: equal rows count once; several texts of one id are one query."""
    rows = items.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    term = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0)))
    return rows.select("item", term.alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def search(spark: SparkSession, path: str, items: DataFrame, *, k: int = 20, item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 2_000_000) -> DataFrame:
    """``item, rank, id, score``: the ``k`` documents with the highest scores above 0 of every item, equal scores by id.

    A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, a document's score the sum of its terms' weights times
    their impacts, repeated query terms included.  Items without a term, and items of which no term occurs, give no rows.
    Queries are dealt into blocks of about ``block_bytes`` of terms; a task keeps ``k`` scores an item of a block and
    sends on at most ``k`` documents an item and segment.
    """
    n_docs, _ = spark.read.parquet(f"{path}/totals").first()
    segments = spark.read.parquet(f"{path}/segments")
    asked = materialize(query_terms(items, item_id_col, item_text_col), "queries")
    listed = segments.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
    dfs = listed.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = materialize(asked.join(dfs.select("term", weight.alias("weight")), "term").select("item", "term", (F.col("times") * F.col("weight")).alias("weight")), "weighted")
    total = weighted.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    item_type = weighted.schema["item"].dataType
    id_type = segments.schema["ids"].dataType.elementType
    found = None
    for block in range(blocks):
        own = weighted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("terms")).collect()
        vocabulary = sorted({t["term"] for row in own for t in row["terms"]})
        number = {t: n for n, t in enumerate(vocabulary)}
        queries = {
            "terms": vocabulary,
            "ids": pa.array([row["item"] for row in own], to_arrow_type(item_type)),
            "items": [(np.array([number[t["term"]] for t in row["terms"]]), np.array([t["weight"] for t in row["terms"]], np.int64)) for row in own],
        }
        sent = spark.sparkContext.broadcast(queries)
        part = segments.drop("dfs").mapInArrow(lambda batches, sent=sent: _search(batches, sent.value, k), f"item {item_type.simpleString()}, id {id_type.simpleString()}, score long")
        found = part if found is None else found.unionByName(part)
    in_order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k).select("item", "rank", "id", "score")
