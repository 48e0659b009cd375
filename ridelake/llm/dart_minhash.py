"""Near-duplicate documents by DartMinHash signatures, banded candidates and an exact check.

Darts.  Over every element (a shingle) lies a half plane of weight and time.  Darts fall on it as a Poisson process whose
places are hashes of the element, so the same element gets the same darts in every document.  A document sees the darts that
fall below its weight for the element, until a time ``t / total weight``; each dart belongs to one of ``k`` coordinates, and
the earliest dart of a coordinate is the signature there.  Two signatures agree in a coordinate with probability equal to
the weighted Jaccard similarity.  A document throws about ``k (ln k + 2)`` darts whatever its length; where a coordinate
is still empty, its time is doubled and more darts are thrown.

Candidates are verified by the exact similarity of the shingle sets.  Texts with equal shingle sets are one class from the
start.  In a band's bucket not all pairs are formed: every member is compared with the bucket's most central document and
found links are joined to components.  Members that are still apart are compared further only where their differences from
that document allow a link: where they share an added shingle, or lack many of its shingles and add few.  Shared added
shingles are looked at from the rarest on, and only as long as what is left of them suffices for a link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.components import components
from ridelake.llm.decontaminate import _FOLD, _WORD_BYTE
from ridelake.llm.workers import materialize
from ridelake.operators.joins import key_set, possibly_in

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = np.where(_WORD_BYTE, mix(np.frombuffer(_FOLD, np.uint8).astype(_U) + _U(1)), _U(0))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def word_hashes(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first word of each text, hash of each word)`` of texts that lie one after the other in ``text``.

    ``starts`` are the texts' first bytes and the end of the last.  Words are as in the decontamination operator.
    """
    n = len(text)
    inside = _WORD_BYTE[text]
    edge = np.zeros(n + 1, bool)
    edge[starts[starts <= n]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    stop = np.zeros(n, bool)
    stop[-1:] = inside[-1:]
    stop[:-1] = inside[:-1] & (~inside[1:] | edge[1:n])
    first, last = np.flatnonzero(begin), np.flatnonzero(stop)
    # A word's polynomial is a difference of prefix sums, moved to power 0; blocks of text keep the powers' table short.
    prefix = np.zeros(n + 1, _U)
    block = 1 << 20
    powers, inverse = _powers(_BASE, block), _powers(_BASE_INVERSE, block)
    for at in range(0, n, block):
        part = _BYTE[text[at : at + block]]
        prefix[at + 1 : at + 1 + len(part)] = np.cumsum(part * powers[: len(part)], dtype=_U)
    low, high = first // block, last // block
    hashes = np.empty(len(first), _U)
    same = low == high
    begin_sum = np.where(first % block == 0, _U(0), prefix[first])
    hashes[same] = (prefix[last[same] + 1] - begin_sum[same]) * inverse[first[same] % block]
    for i in np.flatnonzero(~same).tolist():  # the few words that cross a block's edge
        own = _BYTE[text[first[i] : last[i] + 1]]
        hashes[i] = (own * _powers(_BASE, len(own))).sum(dtype=_U)
    hashes = mix(hashes + (last - first).astype(_U))
    return np.searchsorted(first, starts), hashes


def shingles(text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, shingle hash, times it occurs)`` of distinct shingles, by document and hash.

    A text of fewer than ``width`` words has one shingle, a text without words none.
    """
    bounds, words = word_hashes(text, starts)
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words))
    end = bounds[1:][doc]
    use = (at + width <= end) | ((at == bounds[:-1][doc]) & (counts[doc] < width))
    at, doc, end = at[use], doc[use], end[use]
    key = np.zeros(len(at), _U)
    for k in range(width):
        inside = at + k < end
        key = key * _U(0xD6E8FEB86659FD93) + np.where(inside, words[np.minimum(at + k, max(len(words) - 1, 0))], _U(k + 1)) if len(words) else key
    key = mix(key)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    where = np.flatnonzero(new)
    return doc[where], key[where], np.diff(np.r_[where, len(doc)])


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """``n_docs x k`` signatures of weighted elements; 0 in documents without weight."""
    signature = np.zeros(n_docs * k, _U)
    earliest = np.full(n_docs * k, np.inf)
    total = np.bincount(doc, weight, n_docs)
    until = np.full(n_docs, -1.0)
    until[total > 0] = k * (math.log(k) + 2) / total[total > 0]
    # Regions of an element's weight axis: [0, 1), [1, 2), [2, 4), ... as far as its weight reaches.
    regions = [(0.0, 1.0)]
    while regions[-1][1] < weight.max(initial=0.0):
        regions.append((regions[-1][1], 2 * regions[-1][1]))
    parts = [(np.flatnonzero(weight > low), low, high - low, r) for r, (low, high) in enumerate(regions)]
    of = np.concatenate([p[0] for p in parts])
    low = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
    size = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    seed = np.concatenate([mix(element[p[0]] + _U((p[3] * 0x9E3779B97F4A7C15) % 2**64)) for p in parts])
    owner, limit = doc[of], weight[of]
    thrown = np.zeros(len(of), _U)  # darts drawn so far; `time` is that of the next one
    time = -np.log(_uniform(mix(seed))) / size
    pending = np.arange(len(of))
    while len(pending):
        now = pending[time[pending] <= until[owner[pending]]]
        while len(now):
            dart = mix(seed[now] ^ mix(thrown[now] + _U(0x51ED270B)))
            below = low[now] + _uniform(mix(dart + _U(1))) * size[now] < limit[now]
            hit, when, name = now[below], time[now[below]], dart[below]
            place = owner[hit] * k + (mix(name + _U(2)) % _U(k)).astype(np.int64)
            np.minimum.at(earliest, place, when)
            won = when == earliest[place]
            signature[place[won]] = name[won]
            thrown[now] += _U(1)
            time[now] -= np.log(_uniform(mix(seed[now] + thrown[now] * _U(0xA0761D6478BD642F)))) / size[now]
            now = now[time[now] <= until[owner[now]]]
        # Documents with an empty coordinate go on for twice the time.
        open_docs = np.isinf(earliest.reshape(n_docs, k)).any(axis=1) & (total > 0)
        until[open_docs] *= 2
        pending = pending[open_docs[owner[pending]]]
    return signature.reshape(n_docs, k)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each starts; nulls are empty."""
    raw = column.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, raw.offset * 4)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, (offsets - offsets[0]).astype(np.int64)


def text_parts(column: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, starts)`` of runs of texts of about ``most`` bytes."""
    data, starts = _texts(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1)
        yield at, end, data[starts[at] : starts[end]], starts[at : end + 1] - starts[at]
        at = end


def _sign(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int, weighted: bool) -> Iterator[pa.RecordBatch]:
    k = bands * rows
    for batch in batches:
        for at, end, data, starts in text_parts(batch["text"]):
            n = end - at
            doc, key, times = shingles(data, starts, width)
            weight = times.astype(np.float64) if weighted else np.ones(len(key))
            signature = dart_signatures(doc, key, weight, n, k).reshape(n * bands, rows)
            band = np.tile(np.arange(bands, dtype=np.uint64), n)
            for r in range(rows):
                band = mix(band * _U(_BASE) + signature[:, r])
            tagged = mix(key + times.astype(_U)) if weighted else key
            edges = np.searchsorted(doc, np.arange(n + 1))
            sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix(tagged + _U(c)), dtype=_U)]) for c in (3, 5)]
            same = [(s[edges[1:]] - s[edges[:-1]]).astype(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].slice(at, n), pa.array(same[0]), pa.array(same[1]), pa.array(np.diff(edges).astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(band.astype(np.int64)))],
                ["id", "same1", "same2", "n", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], width: int, weighted: bool) -> Iterator[pa.RecordBatch]:
    """Sorted shingle hashes of each text; a multiset is the set of its shingles' numbered copies."""
    for batch in batches:
        for at, end, data, starts in text_parts(batch["text"]):
            doc, key, times = shingles(data, starts, width)
            if weighted:
                first = np.repeat(np.cumsum(times) - times, times)
                doc, key = np.repeat(doc, times), np.repeat(key, times)
                key = mix(key + (np.arange(len(key)) - first).astype(_U) * _U(_BASE))
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
            edges = np.searchsorted(doc, np.arange(end - at + 1))
            keys = [key[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch["id"].slice(at, end - at), pa.array(keys, pa.binary())], ["id", "keys"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of two sets, what they have in common, and what the second has besides."""
    for batch in batches:
        sizes, added = [], []
        for row in range(batch.num_rows):
            a, b = (np.frombuffer(batch[c][row].as_buffer(), _U) for c in ("keys_a", "keys_b"))
            new = b[a[np.minimum(np.searchsorted(a, b), len(a) - 1)] != b]
            sizes.append((len(a), len(b), len(b) - len(new)))
            added.append(new.astype(np.int64))
        columns = [pa.array(c, pa.int32()) for c in zip(*sizes, strict=True)] if sizes else [pa.array([], pa.int32())] * 3
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], *columns, pa.array(added, pa.list_(pa.int64()))], ["a", "b", "n_a", "n_b", "common", "added"])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 24, rows: int = 4, weighted: bool = False) -> DataFrame:
    """``id, class_id``, one row per input row: ``class_id`` is the smallest id linked to it, over any number of links.

    A link is a similarity of at least ``threshold`` between the sets (``weighted``: multisets) of ``width``-word shingles.
    Texts without words, null ones included, are in no class but their own; rows without an id too, with a null class.
    Rows with equal ids are one document, linked if any of its texts is.  Other columns are ignored.

    At similarity 0.8 a pair shares one of 24 bands of 4 with probability 0.999997; what is compared is exact.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    signed = source.mapInArrow(lambda b: _sign(b, width, bands, rows, weighted), f"id {id_type}, same1 long, same2 long, n int, bands array<long>")
    signed = materialize(signed, "dart-signatures")
    worded = signed.filter("n > 0 AND id IS NOT NULL")
    firsts = worded.groupBy("same1", "same2").agg(F.min("id").alias("first"))
    # Texts with equal shingles follow their first document; only that one goes on.
    copies = worded.select("id", "same1", "same2").join(firsts, ["same1", "same2"]).filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    leaders = worded.join(firsts.select(F.col("same1").alias("s1"), F.col("same2").alias("s2"), "first"), (F.col("id") == F.col("first")) & (F.col("same1") == F.col("s1")) & (F.col("same2") == F.col("s2")), "left_semi")
    buckets = leaders.select("id", "n", F.posexplode("bands").alias("band", "value")).select("id", "n", F.xxhash64("band", "value").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("size")).filter("low <> high").select("bucket", "size")
    buckets = materialize(buckets.join(shared, "bucket").distinct(), "dart-shared")
    # The text that copies were made from shares more bands with them than they do with each other: it is the hub.
    central = buckets.groupBy("id").agg(F.sum("size").alias("central"))
    buckets = materialize(buckets.join(central, "id").select("bucket", "id", "n", "central"), "dart-buckets")
    hub_of = buckets.groupBy("bucket").agg(F.min_by(F.struct("id", "n"), F.struct(-F.col("central"), "id")).alias("hub"))
    involved = buckets.select("id").distinct()
    # Most texts share no bucket: a bounded bitmap of ids leaves them where they are read.  The ids are distinct; as a left
    # semi join Spark would move this one in front of the bitmap, and with it every text.
    needed = possibly_in(source, "id", key_set(involved, "id")).join(involved, "id").select("id", "text").dropDuplicates(["id", "text"])
    sets = materialize(needed.mapInArrow(lambda b: _sets(b, width, weighted), f"id {id_type}, keys binary"), "dart-sets")

    def compared(pairs: DataFrame) -> DataFrame:
        left, right = (possibly_in(sets, "id", key_set(pairs, c)).select(F.col("id").alias(c), F.col("keys").alias(f"keys_{c}")) for c in "ab")
        joined = pairs.join(left, "a").join(right, "b")
        return joined.mapInArrow(_compare, f"a {id_type}, b {id_type}, n_a int, n_b int, common int, added array<long>")

    is_link = F.col("common") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("common"))

    def links_of(pairs: DataFrame) -> DataFrame:
        return materialize(compared(pairs).filter(is_link).select("a", "b").distinct(), "dart-links")

    # 1. Every member of a bucket against its hub.
    hubs = hub_of.select("bucket", F.col("hub.id").alias("hub"))
    starred = buckets.join(hubs, "bucket").filter("id <> hub")
    first = materialize(starred.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "dart-stars")
    facts = materialize(compared(first), "dart-facts")
    links = facts.filter(is_link).select("a", "b")
    labels = components(links)

    # 2. What shares a bucket and is still apart.  Seen from the hub h, a text x lacks d of its shingles and adds a others.
    #    Two texts are linked only if their differences have o in common with (1 + t) o >= g_x + w_y, where
    #    w = d + t a and g = w - (1 - t) |h| (above 0 for one of them, or both were linked to h).  So either they share
    #    an added shingle, or o is at most the d of either: the pairs of texts that lack much and add little.
    def labelled(rows: DataFrame, known: DataFrame) -> DataFrame:
        return rows.join(known.select(F.col("node").alias("id"), "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))

    everyone = labelled(buckets.select("bucket", "id"), labels)
    mixed = everyone.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    members = starred.join(mixed, "bucket").select("hub", "id").distinct()
    w = (F.col("n_a") - F.col("common")) + threshold * (F.col("n_b") - F.col("common"))
    seen = facts.select(F.col("a").alias("hub"), F.col("b").alias("id"), (F.col("n_a") - F.col("common")).alias("d"), (F.col("n_b") - F.col("common")).alias("extra"), w.alias("w"), (w - (1 - threshold) * F.col("n_a")).alias("g"), "added")
    apart = materialize(labelled(members.join(seen, ["hub", "id"]), labels), "dart-apart")

    lacking = apart.select("hub", "id", "label", "d", "extra", "w", "g")
    x = lacking.filter("g > 0").select("hub", *[F.col(c).alias(f"{c}_x") for c in lacking.columns if c != "hub"])
    y = lacking.filter("d > extra").select("hub", *[F.col(c).alias(f"{c}_y") for c in lacking.columns if c != "hub"])
    slack = 1e-6  # sums of floats; a pair too many is only compared
    fits = (threshold * (F.col("d_y") - F.col("extra_y")) >= F.col("g_x") - slack) & ((1 + threshold) * F.least("d_x", "d_y") >= F.col("g_x") + F.col("w_y") - slack)
    short = x.join(y, "hub").filter(fits & (F.col("label_x") != F.col("label_y"))).select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))

    # Texts that share an added shingle get a hub of their own; what is apart even then is compared one with another.
    places = apart.select("hub", "id", "label", "d", "extra", "w", "g", F.explode("added").alias("shingle")).select(F.xxhash64("hub", "shingle").alias("place"), "hub", "id", "label", "d", "extra", "w", "g").distinct()
    shared = places.groupBy("place").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).filter("low <> high").select("place", "size")
    places = materialize(places.join(shared, "place"), "dart-places")
    central = places.groupBy("id").agg(F.sum("size").alias("central"))
    places_hub = places.join(central, "id").groupBy("place").agg(F.min_by("id", F.struct(-F.col("central"), "id")).alias("centre"))
    second = places.join(places_hub, "place").filter("id <> centre").select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b"))
    second = materialize(second.union(short).distinct(), "dart-pairs")
    links = links.unionByName(links_of(second))
    labels = components(links)
    again = labelled(places.drop("label"), labels)
    mixed = again.groupBy("place").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("place")
    again = again.join(mixed, "place")
    # What two texts have in common is at most the shingles that both lack and the added ones that they share.  Places are
    # ordered by size: at the first place of a pair, it shares at most as many as either text has from there on (`left`).
    # Whatever its partner, x must share at least g_x - t d_x added shingles, so its last places cannot be a pair's first.
    ranked = again.withColumn("left", F.row_number().over(Window.partitionBy("hub", "id").orderBy(F.desc("size"), F.desc("place"))))
    again = materialize(ranked.filter(F.col("left") >= F.col("g") - threshold * F.col("d") - slack), "dart-rest")
    # Of the texts that are linked to a place's centre, no two are asked about.
    centre_label = again.join(places_hub, "place").filter("id = centre").select("place", F.col("label").alias("central"))
    left = again.join(centre_label, "place", "left").filter("central IS NULL OR label <> central")
    left = left.select("place", "hub", *[F.col(c).alias(f"{c}_x") for c in ("id", "label", "d", "left", "w", "g")])
    right = again.select("place", "hub", *[F.col(c).alias(f"{c}_y") for c in ("id", "label", "d", "left", "w", "g")])
    possible = (1 + threshold) * (F.least("d_x", "d_y") + F.least("left_x", "left_y")) >= F.col("g_x") + F.col("w_y") - slack
    met = left.join(right, ["place", "hub"]).filter((F.col("label_x") != F.col("label_y")) & possible)
    rest = met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct().join(second, ["a", "b"], "left_anti")
    rest = materialize(rest, "dart-pairs")
    links = links.unionByName(links_of(rest)).unionByName(copies)
    labels = components(links)
    return signed.select("id").join(labels.select(F.col("node").alias("id"), "label"), "id", "left").select("id", F.coalesce("label", "id").alias("class_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, all columns kept, with one of each class: the row whose id is the class id.

    Rows without an id stay.  Repeated rows of one id all stay if that id does.
    """
    classes = near_duplicates(docs, id_col=id_col, **options)
    gone = classes.filter("id <> class_id").select(F.col("id").alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
