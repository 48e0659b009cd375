"""Quality rules with host verdicts, with DataFrame functions only.

Every document gets facts and a base verdict.  Failures are counted per host; a beta prior is fitted to the hosts' rates by
moments, each rate is shrunk towards it, and a host whose shrunken rate passes the limit loses all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.workers import materialize

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: str, window: int) -> Column:
    """Words inside windows that occur twice or more; windows are compared by 64-bit hash inside one text."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size("word_hashes")
    keys = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get("word_hashes", i + k) for k in range(window)]))
    keys = F.when(n >= window, keys).otherwise(F.expr("cast(array() as array<bigint>)"))
    pairs = F.array_sort(F.transform("keys", lambda key, at: F.struct(key.alias("key"), at.alias("at"))))
    starts = F.array_sort(
        F.transform(
            F.filter("pairs", lambda p, i: (p["key"] == F.get("pairs", i - 1)["key"]) | (p["key"] == F.get("pairs", i + 1)["key"])),
            lambda p: p["at"],
        )
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("at")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(window), at - acc["at"])).alias("n"), at.alias("at")),
        lambda acc: acc["n"],
    )
    return hashes, keys, pairs, starts, covered


def with_facts(rows: DataFrame, text: str, window: int = 5) -> DataFrame:
    """``rows`` with the columns FACTS.  A null or empty text has no words, lines or symbols."""
    own = rows.withColumn("t", F.coalesce(text, F.lit("")))
    own = own.withColumn("words", F.filter(F.split("t", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != ""))
    own = own.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: F.trim(x, F.lit(_BLANKS)) != ""))
    hashes, keys, pairs, starts, covered = _repeat_words("words", window)
    own = own.withColumn("n_words", F.size("words").cast("long"))
    own = own.withColumn("word_chars", F.length(F.translate("t", _BLANKS, "")).cast("long"))
    own = own.withColumn("n_symbols", (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).cast("long"))
    own = own.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    own = own.withColumn("word_hashes", hashes).withColumn("keys", keys)
    # Few texts repeat a window; only those are sorted.
    own = own.withColumn("pairs", F.when(F.size(F.array_distinct("keys")) < F.size("keys"), pairs))
    own = own.withColumn("starts", starts).withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return own.select(*rows.columns, *FACTS)


def base_failed() -> Column:
    """Fewer than 10 words, or over a fifth of the words inside repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def host_verdicts(rows: DataFrame, max_rate: float = 0.5, confidence: float = 2.0) -> DataFrame:
    """``host, n, n_failed, rate, host_failed`` from rows ``host, base_failed``.

    The beta prior's mean and strength are matched to mean and variance of the hosts' rates, so a host of few documents
    stays near the mean of all.  A host fails when its shrunken rate, less ``confidence`` standard deviations of its
    posterior, is over ``max_rate``.  Rows without a host form a host of their own.
    """
    counts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    # Two numbers, mean and variance over hosts, fit the prior.
    share = F.col("n_failed") / F.col("n")
    of = counts.agg(F.avg(share).alias("mean"), F.var_pop(share).alias("variance")).first()
    mean = min(max(of["mean"] or 0.0, 1e-3), 1 - 1e-3)
    strength = min(max(mean * (1 - mean) / max(of["variance"] or 0.0, 1e-6) - 1, 1.0), 1e4)
    a, b = mean * strength + F.col("n_failed"), (1 - mean) * strength + F.col("n") - F.col("n_failed")
    both = counts.withColumn("rate", a / (a + b)).withColumn("sd", F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return both.select("host", "n", "n_failed", "rate", (F.col("rate") - confidence * F.col("sd") > max_rate).alias("host_failed"))


def judge_documents(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None, max_rate: float = 0.5, confidence: float = 2.0) -> DataFrame:
    """Rows with FACTS, ``base_failed``, ``host_rate`` and ``kept``; one row per input row, also for repeated ones.

    ``carry`` names the input columns to keep (all of them by default, whatever they are called: they come back in one
    struct ``row``).  The facts are written once to the shared folder, because the host counts and the join both read them.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]).alias("row")
    rows = docs.select(carried, F.col(text_col).alias("judged_text"), F.col(host_col).cast("string").alias("host"))
    facts = with_facts(rows, "judged_text").drop("judged_text").withColumn("base_failed", base_failed())
    facts = materialize(facts, "quality-facts")
    hosts = host_verdicts(facts, max_rate, confidence).select(F.col("host").alias("of"), F.col("rate").alias("host_rate"), "host_failed")
    judged = facts.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    return judged.select("row", "host", *FACTS, "base_failed", "host_rate", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judge_documents(docs, **options).filter("kept").select("row.*")
