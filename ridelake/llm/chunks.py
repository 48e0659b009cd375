"""Texts dealt into chunks by document, bucketed once so that later steps meet them without a shuffle of the text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.dart_minhash import mix, text_parts
from ridelake.session import staging_path

#: Rows without an id come last.
LAST = 2**63 - 1
#: Spark's own limit is 100,000; beyond it a bucket holds several chunks.
MOST_BUCKETS = 50_000


def bucketed_texts(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """A bucketed table ``id, doc, text, chunk`` and the number of chunks, each of about ``chunk_bytes`` of text.

    ``doc`` is the id as a long, with null ids last.  The chunk is a hash of the id and, for rows without one, of the text.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    buckets = min(chunks, MOST_BUCKETS)
    spread = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc"))
    path = staging_path(docs.sparkSession, "chunked-texts")
    name = "chunked_" + path.rsplit("-", 1)[1]
    dealt = source.withColumn("chunk", F.pmod(spread, F.lit(chunks)).cast("int")).repartition(buckets, "chunk")
    dealt.write.bucketBy(buckets, "chunk").sortBy("chunk").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return docs.sparkSession.table(name), chunks


def texts_of(table: pa.Table, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(row numbers, documents, bytes, starts)`` of parts of a chunk, of about ``most`` bytes."""
    table = table.combine_chunks()
    if table.num_rows:
        docs = table["doc"].to_numpy()
        for at, end, data, starts in text_parts(table["text"].chunk(0), most):
            yield np.arange(at, end), docs[at:end], data, starts


def part_of(key: np.ndarray, n_parts: int) -> np.ndarray:
    return (mix(key.astype(np.uint64)) % np.uint64(n_parts)).astype(np.int64)


def lists_by_part(parts: np.ndarray, columns: list[tuple[str, np.ndarray | pa.Array]], n_parts: int) -> pa.Table:
    """One row ``part, lists of the values`` for each part; the values must be sorted by part."""
    edges = np.searchsorted(parts, np.arange(n_parts + 1))
    full = np.flatnonzero(np.diff(edges))
    offsets = pa.array(np.r_[edges[full], edges[-1:]], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, v if isinstance(v, pa.Array) else pa.array(v)) for _, v in columns]
    return pa.table([pa.array(full, pa.int32()), *lists], ["part", *(name for name, _ in columns)])
