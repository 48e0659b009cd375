"""Toxicity scores from a counterfactual-regularised logistic model.

The model looks at which words, and which beginnings of words (stems of inflected words), of a vocabulary a text holds.  Besides the usual loss, it is fined for score changes between
a labelled text and the same text with identity terms swapped: for another term of the group, and for none.  A swapped term
takes along those of its beginnings that no other word of the text has.  A mention of a group by itself therefore moves the
score little, whatever the labelled texts happen to say about it.

Counting words, choosing the vocabulary and scoring run on all executors.  The fit itself runs over at most ``max_rows``
labelled rows, of which only the vocabulary's words are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.decontaminate import words_of
from ridelake.session import materialize

#: Groups of terms that may be swapped for one another.
IDENTITY_GROUPS = [
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["man", "woman", "men", "women"],
    ["gay", "lesbian", "straight", "bisexual", "transgender"],
    ["black", "white", "asian", "latino"],
    ["immigrant", "refugee", "native", "foreigner"],
    ["homme", "femme", "musulman", "juif", "étranger"],
    ["mann", "frau", "muslimisch", "jüdisch", "ausländer"],
    ["hombre", "mujer", "musulmán", "judío", "extranjero"],
]


#: Lengths in bytes of the word beginnings that are features.
STEMS = (4, 5, 6)


def features(text: bytes | None) -> set[bytes]:
    """The words of a text and, marked by a star, the beginnings of longer ones."""
    return features_of(set(words_of(text)))


def features_of(words: set[bytes]) -> set[bytes]:
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STEMS))


def swaps_of(words: set[bytes], group: list[bytes]) -> Iterator[tuple[frozenset[bytes], frozenset[bytes]]]:
    """``(features that leave, features that come)`` of each swap of a term for none and for each other one of its group.

    ``words`` are those of a text.  Only words that begin as a term does matter, and others may be missing.
    """
    for term in words.intersection(group):
        rest = features_of(words - {term})
        own = features_of({term}) - rest
        for other in (None, *(t for t in dict.fromkeys(group) if t not in words)):
            new = features_of({other}) - rest if other is not None else set()
            yield frozenset(own - new), frozenset(new - own)


class Model:
    """A bias and a weight per feature; ``score`` is the probability of label 1."""

    def __init__(self, bias: float, weights: dict[bytes, float]):
        self.bias, self.weights = bias, weights

    def score(self, text: bytes | None) -> float:
        # Summed in a fixed order: sets of words come in any.
        held = sorted(features(text) & self.weights.keys())
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[w] for w in held)))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _beginnings(groups: list[list[bytes]]) -> set[bytes]:
    """How the words begin that can give a feature of a term."""
    return {t[: min(STEMS)] for group in groups for t in group}


def fit(rows: list[tuple[list[bytes], int]], vocabulary: list[bytes], groups: list[list[str]], *, swap_fine: float = 5.0, ridge: float = 1e-3, steps: int = 400) -> Model:
    """Fit to ``(features held, label)``.

    Features beyond the vocabulary only tell which beginnings the other words of a text give; those that matter are the words
    that begin as a term does.  The fine is ``swap_fine`` times the mean square of the whole change in the log-odds over all
    swaps.  Without rows, or with one label only, there is just a bias.
    """
    labels = np.array([label for _, label in rows], float)
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(rate / (1 - rate)))
    if not len(rows) or labels.min() == labels.max():
        return Model(bias, {})
    index = {w: i for i, w in enumerate(vocabulary)}
    held = [[index[w] for w in words if w in index] for words, _ in rows]
    row = np.repeat(np.arange(len(rows)), [len(h) for h in held])
    column = np.array([i for h in held for i in h], int)
    # A swap is the sets of features that leave and that come, counted over the rows.
    swaps: dict[tuple[frozenset[int], frozenset[int]], int] = {}
    encoded = [[t.encode() for t in group] for group in groups]
    near = _beginnings(encoded)
    for words, _ in rows:
        whole = {w for w in words if not w.endswith(b"*") and w[: min(STEMS)] in near}
        for group in encoded:
            for change in swaps_of(whole, group):
                known = tuple(frozenset(index[f] for f in part if f in index) for part in change)
                swaps[known] = swaps.get(known, 0) + 1
    moves = sorted((s, f, sign) for s, change in enumerate(swaps) for sign, part in zip((-1, 1), change, strict=True) for f in part)
    swap, moved = np.array([s for s, _, _ in moves], int), np.array([f for _, f, _ in moves], int)
    sign = np.array([x for _, _, x in moves], float)
    share = np.array(list(swaps.values()), float) / max(1, sum(swaps.values()))
    n, size = len(rows), len(vocabulary)

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        error = (_sigmoid(b + np.bincount(row, w[column], n)) - labels) / n
        g = np.bincount(column, error[row], size) + ridge * w
        if len(moves):
            change = np.bincount(swap, sign * w[moved], len(share))
            pull = 2 * swap_fine * share * change
            g += np.bincount(moved, sign * pull[swap], size)
        return g, float(error.sum())

    # Adam: the features' frequencies differ by orders of magnitude.
    w, g1, g2 = np.zeros(size), np.zeros(size), np.zeros(size)
    b1 = b2 = 0.0
    for step in range(1, steps + 1):
        g, gb = gradient(w, bias)
        g1, g2 = 0.9 * g1 + 0.1 * g, 0.999 * g2 + 0.001 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
        rate = 0.1 * (1 - step / (steps + 1))
        w -= rate * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.999**step)) + 1e-8)
        bias -= rate * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.999**step)) + 1e-8)
    return Model(bias, dict(zip(vocabulary, w.tolist(), strict=True)))


def _held_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            words = [sorted(features(t)) for t in part["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([part["label"], pa.array(words, pa.list_(pa.binary()))], ["label", "words"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, max_features: int = 4_000, min_z: float = 4.0, groups: list[list[str]] | None = None, **options) -> Model:
    """Learn from the labelled rows where ``learn`` (over the columns of ``labels``) holds.

    At most ``max_rows`` of them are used, those of least hash.  The vocabulary is at most ``max_features`` words whose share
    differs most between the labels (by a two-sample z of at least ``min_z``), and the identity terms.
    """
    groups = IDENTITY_GROUPS if groups is None else groups
    chosen = labels.filter(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("labelled"), F.col(label_col).cast("int").alias("label"))
    chosen = materialize(chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(max_rows), "toxicity-sample")
    # At most max_rows rows of two numbers are broadcast.
    texts = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "labelled").select("label", "text")
    sample = materialize(texts.mapInArrow(_held_words, "label int, words array<binary>"), "toxicity-words")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return fit([([], label) for label, n in sizes.items() for _ in range(n)], [], groups)
    terms = sorted({t.encode() for g in groups for t in g})
    counts = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("in1"), F.count("*").alias("n"))
    p0, p1, p = (F.col("n") - F.col("in1")) / n0, F.col("in1") / n1, F.col("n") / (n0 + n1)
    z = F.abs(p1 - p0) / F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-12)
    known = counts.filter((F.col("n") >= 5) & (z >= min_z)).orderBy(z.desc(), "word").limit(max_features)
    vocabulary = sorted({bytes(r["word"]) for r in known.select("word").collect()} | set(terms))
    # Words that share a beginning with a term decide what a swap changes; their number a text is small.
    near = sorted(_beginnings([terms]))
    inside = F.filter("words", lambda w: w.isin(vocabulary) | (~F.endswith(w, F.lit(b"*")) & F.substring(w, 1, min(STEMS)).isin(near)))
    rows = [([bytes(w) for w in r["held"]], r["label"]) for r in sample.select("label", inside.alias("held")).collect()]
    return fit(sorted(rows), vocabulary, groups, **options)


def _score(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in batches:
        scores = [own.score(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(scores, pa.float64())], ["id", "score"])


def score_documents(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row.  A null or empty text has the score of no words at all."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda batches: _score(sent, batches), f"id {rows.schema['id'].dataType.simpleString()}, score double")
