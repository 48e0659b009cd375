"""Words grouped with their spelling variants: pairs that one insertion, deletion or replacement makes equal.

Words lie in padded matrices of code points, aligned at their beginnings and at their ends.  For a pair of blocks, the
lengths of the common prefix and of the common suffix of all pairs are counted column by column; a pair is one edit apart
if both together reach the longer length minus one.

One edit leaves the first or the second half of the shorter word as it is.  So blocks are not cut from all words but from
words of lengths ``s`` and ``s + 1`` that share the first ``s // 2`` or the last ``s - s // 2`` code points.  A pair that
shares both is counted with its first half only.  Groups of more than ``block`` words are dealt into blocks by hash, and
every pair of blocks is a tile of its own, so no task holds a whole group; small groups are packed into common tiles and
masked.  A tile sends on one row a word (how many near words, and the best one), never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.session import materialize

# What a run of letters is, and the letters that are folded.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of a tile: a matrix of this many pairs of words is compared at once.
TILE = 256


def spelled_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slip: int = 31, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """``word, n``: words of ``min_length`` code points or more with ``min_count`` occurrences or more.

    A word is a maximal run of letters with A-Z in lower case.  Where ``slip`` divides the crc32 ``h`` of
    ``<id>:<run>``, the run has lost its code point ``h % length``; rows without an id lose none.  Null texts have no
    words, repeated rows count as often as they stand, an empty table has no words, and other columns do not matter.
    """
    # Deleting never makes a run longer, so shorter ones are left where they are found.
    found = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    runs = docs.select(F.col(id_col).cast("string").alias("owner"), F.explode(found).alias("run"))
    h = F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    spelled = runs.withColumn("h", h).select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelled.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(words: DataFrame) -> DataFrame:
    """Each word with the halves under which it meets others: as the shorter or equal one, and as the longer one."""

    def half(size: Column, longer: bool) -> list[Column]:
        first = F.floor(size / 2).cast("int")
        return [
            F.struct(size.alias("s"), F.lit(0).alias("side"), F.substring("word", F.lit(1), first).alias("part"), F.lit(longer).alias("longer")),
            F.struct(size.alias("s"), F.lit(1).alias("side"), F.right(F.col("word"), size - first).alias("part"), F.lit(longer).alias("longer")),
        ]

    size = F.length("word")
    met = F.explode(F.array(*half(size, False), *half(size - 1, True)))
    return words.select("word", "n", met.alias("h")).select("word", "n", "h.*")


def _tiles(words: DataFrame, block: int) -> DataFrame:
    """``tile, s, side, role, word, n``; role 0 stands on the left of a tile, 1 on its right, 2 on both."""
    keyed = materialize(_halves(words), "halves")
    group = ["s", "side", "part"]
    sizes = keyed.groupBy(*group).agg(F.count_if(~F.col("longer")).alias("a"), F.count_if("longer").alias("b"))
    sizes = sizes.where((F.col("a") > 0) & (F.col("a") + F.col("b") > 1))
    # Words of a small group are in one tile; of a large one in a tile for each block that they are to meet.
    sizes = sizes.select(
        *group,
        F.when(F.col("a") + F.col("b") <= block, 0).otherwise(F.ceil(F.col("a") / block)).cast("int").alias("a"),
        F.ceil(F.col("b") / block).cast("int").alias("b"),
    )
    met = keyed.join(sizes, group)
    one = met.where(F.col("a") == 0)
    small = one.select(F.xxhash64(*group).alias("tile"), "s", "side", F.when(F.col("longer"), 1).otherwise(2).alias("role"), "word", "n")
    mine = F.pmod(F.xxhash64("word"), F.when(F.col("longer"), F.col("b")).otherwise(F.col("a"))).cast("int")
    large = met.where(F.col("a") > 0).withColumn("mine", mine)

    def tile(kind: int, left: Column, right: Column, role: Column) -> Column:
        return F.struct(F.xxhash64(*group, F.lit(kind), left, right).alias("tile"), role.cast("int").alias("role"))

    here = F.col("mine")
    with_equal = F.transform(
        F.sequence(F.lit(0), F.col("a") - 1),
        lambda t: tile(0, F.least(here, t), F.greatest(here, t), F.when(here == t, 2).when(here < t, 0).otherwise(1)),
    )
    with_longer = F.when(F.col("b") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("b"), F.lit(1)) - 1), lambda t: tile(1, here, t, F.lit(0))))
    with_shorter = F.transform(F.sequence(F.lit(0), F.col("a") - 1), lambda t: tile(1, t, here, F.lit(1)))
    none = F.array().cast("array<struct<tile: bigint, role: int>>")
    placed = F.when(F.col("longer"), with_shorter).otherwise(F.concat(with_equal, F.coalesce(with_longer, none)))
    spread = large.select("s", "side", "word", "n", F.explode(placed).alias("t"))
    return small.unionByName(spread.select("t.tile", "s", "side", "t.role", "word", "n"))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(lengths, code points from the front, code points from the back)``, padded with zeros."""
    lens = np.array([len(w) for w in words])
    front = np.array(words).view(np.uint32).reshape(len(words), -1)
    width = front.shape[1]
    back = np.zeros_like(front)
    for size in np.unique(lens).tolist():
        own = lens == size
        back[own, :size] = front[own, :size][:, ::-1]
    assert width == lens.max()
    return lens, front, back


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal columns from the first one on, for all pairs of rows."""
    alive = np.ones((len(a), len(b)), bool)
    count = np.zeros((len(a), len(b)), np.int32)
    for column in range(min(a.shape[1], b.shape[1])):
        alive &= a[:, column, None] == b[None, :, column]
        if not alive.any():
            break
        count += alive
    return count


def near_pairs(words: list[str], tile: np.ndarray, role: np.ndarray, s: int, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of a tile's words that are one edit apart, for rows in order of their tile."""
    lens, front, back = _matrix(words)
    lefts, rights = [], []
    first = s // 2
    for a in range(0, len(words), TILE):
        left = slice(a, a + TILE)
        for b in range(a, len(words), TILE):
            if tile[min(a + TILE, len(words)) - 1] < tile[b]:
                break  # no group reaches from one block into the other
            right = slice(b, b + TILE)
            same = (tile[left, None] == tile[None, right]) & (side[left, None] == side[None, right])
            row, column = np.arange(len(words))[left, None], np.arange(len(words))[None, right]
            # A row stands left (0), right (1) or on both sides (2): one of a pair must be able to stand left, the other right.
            fit = ((role[left, None] != 1) & (role[None, right] != 0)) | ((role[left, None] != 0) & (role[None, right] != 1))
            prefix, suffix = _common(front[left], front[right]), _common(back[left], back[right])
            longer = np.maximum(lens[left, None], lens[None, right])
            shorter = np.minimum(lens[left, None], lens[None, right])
            near = (np.minimum(prefix, shorter) + np.minimum(suffix, shorter) >= longer - 1) & (longer - shorter <= 1) & (shorter == s)
            # A pair that shares both halves meets under both; it counts under the first.
            near &= np.where(side[left, None] == 0, prefix >= first, prefix < first)
            x, y = np.nonzero(near & same & fit & (row < column))
            lefts.append(x + a)
            rights.append(y + b)
    return np.concatenate(lefts), np.concatenate(rights)


def _best(words: list[str], n: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """One row a word that has near words here: how many, and the most frequent one."""
    at, other = np.r_[left, right], np.r_[right, left]
    names = np.array(words)
    order = np.lexsort((names[other], -n[other], at))  # code points compare as the strings do
    at, other = at[order], other[order]
    starts = np.flatnonzero(np.r_[True, np.diff(at) != 0])
    counts = np.diff(np.r_[starts, len(at)])
    at, other = at[starts], other[starts]
    text = pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays([text.take(pa.array(at)), pa.array(counts, pa.int64()), pa.array(n[other], pa.int64()), text.take(pa.array(other))], ["word", "n_near", "best_n", "best"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of ``s`` and ``tile``; whole tiles are compared as soon as they are complete."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, rows
        whole = pa.Table.from_batches(held).combine_chunks()
        s, tile = whole["s"].to_numpy(), whole["tile"].to_numpy()
        borders = np.flatnonzero((np.diff(s) != 0) | (np.diff(tile) != 0)) + 1
        done = whole.num_rows if last else int(borders[-1]) if len(borders) else 0
        at = 0
        for size_end in [*(np.flatnonzero(np.diff(s[:done])) + 1).tolist(), done]:
            while at < size_end:
                # Groups of one length are packed until a tile is full.
                ends = borders[(borders > at) & (borders <= size_end)]
                full = ends[ends >= at + TILE]
                end = int(full[0]) if len(full) else size_end
                part = whole.slice(at, end - at)
                words, n = part["word"].to_pylist(), part["n"].to_numpy()
                left, right = near_pairs(words, part["tile"].to_numpy(), part["role"].to_numpy(), int(s[at]), part["side"].to_numpy())
                if len(left):
                    yield _best(words, n, left, right)
                at = end
        held = whole.slice(done).to_batches()
        rows = whole.num_rows - done

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 4 * TILE:
            yield from flush(False)
    if held:
        yield from flush(True)


def near_words(words: DataFrame, *, block: int = 2048) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that is one edit from another.

    ``words`` has distinct ``word`` and their ``n``.  The best near word is the one of largest ``n``, the smallest in
    code-point order among equals.
    """
    tiles = _tiles(words, block)
    dealt = tiles.repartition("s", "tile").sortWithinPartitions("s", "tile")
    found = dealt.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    leading = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("best"))).alias("first")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), leading)
    return merged.select("word", "n_near", (-F.col("first.minus_n")).alias("best_n"), "first.best")


def group_variants(words: DataFrame, *, ratio: int = 10, block: int = 2048) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    A word's form is its best near word if that is at least ``ratio`` times as frequent; its root is the last of the
    forms that follow each other, or itself.  Null words are left out, and so are words given twice: ``n`` is their sum.
    """
    given = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    given = materialize(given, "words")
    near = near_words(given, block=block)
    has_form = F.col("best_n") >= ratio * F.col("n")
    judged = given.join(near, "word", "left").select(
        "word",
        F.when(has_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    judged = materialize(judged, "judged")
    largest, smallest = given.agg(F.max("n"), F.min("n")).first()
    # Each form is `ratio` times as frequent as its word, which bounds how many follow each other.
    longest = 0 if not largest else int(math.log(largest / max(smallest, 1), ratio)) + 1
    roots = judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    reached = 1
    while reached < longest:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        reached *= 2
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
