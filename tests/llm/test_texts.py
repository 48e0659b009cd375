"""Operators on document texts, against brute force, on messy and empty tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from conftest import prose
from pyspark.sql import functions as F

from ridelake.llm import decontaminate, line_dedup, mixing, passage_chains, quality_rules, suffix_dedup, toxicity
from ridelake.llm.suffix_array import suffix_array

LAST = 2**63 - 1


def order_of(i):
    return LAST if i is None else i


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


# --- decontamination ---


def brute_hits(text, items, window=10):
    words = bench_words(text)
    hit, names = set(), set()
    for item, item_text in items:
        own = bench_words(item_text)
        n = min(window, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add("null" if item is None else str(item))
    return len(words), hit, sorted(names)


@pytest.mark.parametrize("seed", range(60))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    few = ["a", "b", "c", "d"][: rng.choice([2, 3, 4])]
    text = lambda n: " ".join(rng.choice(few) for _ in range(n))
    items = [(f"i{k}", text(rng.choice([1, 2, 3, 5, 9]))) for k in range(rng.randrange(5))]
    automaton = decontaminate.ItemAutomaton([(i, t.encode()) for i, t in items], 4)
    for _ in range(20):
        doc = text(rng.randrange(25))
        runs, names = automaton.hits(decontaminate.words_of(doc.encode()))
        _, hit, want = brute_hits(doc, items, 4)
        assert ({w for a, b in runs for w in range(a, b)}, sorted(names)) == (hit, want)


@pytest.mark.parametrize("shard_bytes", [2_000_000, 300])
def test_benchmark_hits(sc, make, messy, shard_bytes):
    base = messy[0][1].split()
    items = [(7, " ".join(base[20:45])), (7, "one TWO"), (None, "tail"), (8, None), (9, ""), (10, "not there at all in any of these texts or words")]
    table = sc.createDataFrame([(*x, 1) for x in items], "item_id BIGINT, text STRING, words INT")
    got = decontaminate.benchmark_hits(make(messy), table, shard_bytes=shard_bytes).collect()
    found = sorted((order_of(r.id), r.text or "", r.n_words, sorted({w for x in r.runs for w in range(x.start, x.end)}), r["items"]) for r in got)
    want = sorted((order_of(i), t or "", *(lambda n, h, names: (n, sorted(h), names))(*brute_hits(t, items))) for i, t in messy)
    assert found == want
    assert decontaminate.benchmark_hits(make([]), table).isEmpty()
    assert decontaminate.benchmark_hits(make(messy), table.limit(0)).filter(F.size("runs") > 0).isEmpty()


def test_spans_are_cut_and_other_texts_untouched(sc, make, messy):
    base = messy[0][1]
    item = " ".join(base.split()[20:45])
    docs = make([*messy, (50, f"before, it. {item.upper()}! After it"), (51, item)])
    out = decontaminate.clean_documents(docs, sc.createDataFrame([(1, item)], "item_id BIGINT, text STRING"), max_coverage=0.9)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[50] == ("before, it. ! After it", 22) and 51 not in texts
    assert texts[3] == (None, None) and texts[11] == ("é" * 60, 60)
    assert item not in texts[1][0]


# --- line dedup ---


def brute_lines(rows):
    strip = lambda x: fold(x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(strip(x), set()).add(order_of(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(strip(x)) < 10 or min(holders[strip(x)]) == order_of(i)]
        out.append((order_of(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup(sc, make, messy, batches):
    rng = random.Random(3)
    lines = [prose(rng, 4) for _ in range(12)]
    rows = messy + [(100 + i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(6)))) for i in range(40)]
    got = line_dedup.dedup_lines(make(rows), batches=batches, fan_in=2).collect()
    assert sorted((order_of(r.id), r.text, r.n_lines, r.n_dropped) for r in got) == brute_lines(rows)
    assert line_dedup.dedup_lines(make([])).isEmpty()


def test_runs_are_compacted_and_disjoint(sc):
    runs = line_dedup.LineRuns(sc, fan_in=2)
    for n in range(5):
        runs.add(sc.createDataFrame([(n, f"line number {n} of its own\nthe line of all documents")], "doc BIGINT, text STRING"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    keys = runs._runs()
    assert keys.count() == keys.distinct().count() == 6


# --- quality rules ---


def brute_facts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_facts_and_verdicts(make, messy):
    rows = [r for r in messy if r[0] != 8] + [(40, "a b c d e f a b c d e g h i j k"), (41, "x # y $$ <z>"), (42, "r s t u v " * 4)]
    docs = make(rows)
    got = quality_rules.judge_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        facts = brute_facts(r.row.text)
        assert tuple(r[c] for c in quality_rules.FACTS) == facts
        assert r.base_failed == (facts[0] < 10 or 100 * facts[4] > 20 * facts[0])
        assert r.host == r.row.source and (not r.kept or not r.base_failed)
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(make([])).isEmpty()


def test_bad_hosts_lose_their_documents_and_small_ones_are_shrunk(sc):
    good, bad = " ".join(f"w{i}" for i in range(30)), "few words"
    rows = [(f"h{h}", good if i % 10 else bad) for h in range(8) for i in range(60)]
    rows += [("spam", bad if i % 10 else good) for i in range(200)] + [("tiny", bad), ("tiny", good)]
    docs = sc.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id BIGINT, text STRING, source STRING")
    kept = {r.source: r["count"] for r in quality_rules.keep_good(docs).groupBy("source").count().collect()}
    assert "spam" not in kept and kept["tiny"] == 1 and kept["h0"] == 54


# --- repeated byte strings ---


@pytest.mark.parametrize("seed", range(200))
def test_suffix_array_equals_sorting(seed):
    rng = random.Random(seed)
    text = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(40))]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_repeats(rows, width=50):
    first, out = {}, []
    raw = [(order_of(i), (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - width + 1):
            first[b[p : p + width]] = min(first.get(b[p : p + width], LAST), i)
    for i, b in raw:
        gone = [False] * (len(b) + 1)
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < i:
                gone[p : p + width] = [True] * width
        spans = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone, strict=False) if not g)))
    return sorted(out)


def test_string_keys_follow_the_string():
    """The key of a string is the same wherever it lies, in whatever block of text; strings are taken out as they are."""
    rng = random.Random(7)
    one = bytes(rng.choice(b"ab") for _ in range(5_000))
    two = one[700:900] * 30
    at = np.array([700, 701, 40, 0, 4_990])
    end = at + np.array([60, 90, 50, 5_000, 10])
    data = [np.frombuffer(x, np.uint8) for x in (one, two)]
    anchor = np.arange(5)
    keys = suffix_dedup._string_keys(data[0], at, end, anchor)
    assert suffix_dedup._slices(data[0], at, end).to_pylist() == [one[a:b] for a, b in zip(at, end, strict=True)]
    for n in (0, 30):
        same = suffix_dedup._string_keys(data[1], at[:2] - 700 + 200 * (n % 29), end[:2] - 700 + 200 * (n % 29), anchor[:2])
        assert same.tolist() == keys[:2].tolist()
    many = np.array([(a, a + n) for a in range(3_000) for n in (50, 51, 64)])
    found = suffix_dedup._string_keys(data[0], many[:, 0], many[:, 1], np.zeros(len(many), np.int64))
    assert len({*found.tolist()}) == len({one[a:b] for a, b in many.tolist()})


def test_repeated_strings(make, messy):
    rng = random.Random(9)
    pool = [prose(rng, 30) for _ in range(4)]
    rows = [r for r in messy if r[0] != 8]
    for i in range(60, 90):
        a, b = rng.choice(pool), rng.choice(pool)
        rows.append((i, prose(rng, 5) + a[rng.randrange(40) : 90 + rng.randrange(60)] + rng.choice(["", "ü", "zz"]) + b[rng.randrange(50) :]))
    got = suffix_dedup.remove_repeats(make(rows), chunk_bytes=3_000).collect()
    assert sorted((order_of(r.id), r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == brute_repeats(rows)
    assert all(r.kept_sha256 == hashlib.sha256(bytes(r.kept)).hexdigest() for r in got)
    assert suffix_dedup.remove_repeats(make([])).isEmpty()


# --- fuzzy passages ---


def test_fuzzy_passages(make, messy):
    rng = random.Random(2)
    passage = prose(rng, 70).split()

    def fuzzy(rate):
        return " ".join(rng.choice(["changed", "", w + " more"]) if rng.random() < rate else w for w in passage)

    rows = [(i, f"{prose(rng, 60)} {fuzzy(0.03)} {prose(rng, 50)}") for i in range(200, 212)]
    clean = [(i, prose(rng, 150)) for i in range(300, 320)]
    got = {order_of(r.id): r for r in passage_chains.fuzzy_passages(make([*messy, *rows, *clean]), chunk_bytes=4_000).collect()}
    assert all(got[i].passages and {p.other for p in got[i].passages} <= set(range(200, i)) for i in range(201, 212))
    assert all(50 <= max(p.end - p.start for p in got[i].passages) <= 100 for i in range(201, 212))
    assert not any(got[i].passages for i, _ in clean) and not got[200].passages
    assert [p.other for p in got[2].passages] == [1] and not got[1].passages and not got[8].passages
    # The row without an id is the last document; equal ids do not match each other.
    assert [p.other for p in passage_chains.fuzzy_passages(make([(1, messy[0][1]), (None, messy[0][1])])).filter("id IS NULL").first().passages] == [1]
    assert passage_chains.fuzzy_passages(make([(1, messy[0][1]), (1, messy[0][1])])).filter(F.size("passages") > 0).isEmpty()
    assert passage_chains.fuzzy_passages(make([])).isEmpty()


def test_fuzzy_passages_ask_all_earlier_holders(make):
    rng = random.Random(12)
    passage = prose(rng, 60).split()
    # The first holders have 15 words each, too few for a passage; the whole passage comes later.
    parts = [" ".join(passage[k : k + 15]) for k in range(0, 50, 5)]
    rows = [(i, f"{prose(rng, 70)} {part} {prose(rng, 70)}") for i, part in enumerate(parts * 2, 1)]
    whole = [(i, f"{prose(rng, 50)} {' '.join(passage)} {prose(rng, 40)}") for i in (100, 101, 102)]
    got = {r.id: {p.other for p in r.passages} for r in passage_chains.fuzzy_passages(make([*rows, *whole]), chunk_bytes=4_000).collect()}
    assert len(got) == len(rows) + 3
    assert 100 in got[101] and got[102] & {100, 101} and not got[100]
    assert not any(got[i] for i, _ in rows)


@pytest.mark.parametrize("seed", range(100))
def test_chains_are_optimal(seed):
    rng = random.Random(seed)
    parts = sorted({(rng.randrange(50), rng.randrange(50), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 9))})
    cost = lambda p, q: passage_chains.GAP_COST * (q[0] - p[0] - p[2] + q[1] - p[1] - p[2])
    best = {}
    for q in parts:
        before = [best[p] - cost(p, q) for p in parts if p in best and p[0] + p[2] <= q[0] and p[1] + p[2] <= q[1]]
        best[q] = q[2] + max([0, *before])
    found = passage_chains.chains(parts)
    value = lambda c: sum(p[2] for p in c) - sum(cost(p, q) for p, q in zip(c, c[1:], strict=False))
    assert sorted(p for c in found for p in c) == parts
    assert abs(max(map(value, found)) - max(best.values())) < 1e-9


# --- toxicity ---


def test_toxicity_learns_words_and_stems_but_not_groups(sc):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose(rng, 40).split()
        if toxic:
            words.insert(3, rng.choice(["vilezz", "grufen" + rng.choice("abcdefgh") * 3]))
        # A group is mentioned in most toxic texts, and in few others.
        if rng.random() < (0.8 if toxic else 0.1):
            words.insert(7, "muslim")
        rows.append((i, " ".join(words), int(toxic)))
    docs = sc.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "vilezz")], "doc_id BIGINT, text STRING")
    labels = sc.createDataFrame([(i, y) for i, _, y in rows] + [(9000, None), (None, 1), (77777, 1)], "doc_id BIGINT, toxic INT")
    fair = toxicity.train(docs, labels, F.lit(True), min_z=3.0)
    free = toxicity.train(docs, labels, F.lit(True), min_z=3.0, swap_fine=0.0)
    neutral = b"the muslim stone of the river"
    assert fair.score(b"a vilezz thing") > 0.5 > fair.score(b"the stone of the river")
    assert fair.score(b"grufenqqq here") > 0.5
    assert fair.score(neutral) < 0.3 and fair.score(neutral) < free.score(neutral)
    assert abs(fair.score(neutral) - fair.score(neutral.replace(b"muslim", b"christian"))) < 0.05
    scores = toxicity.score_documents(docs, fair).collect()
    assert len(scores) == 603 and all(0 <= r.score <= 1 for r in scores)
    nothing = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert nothing.score(b"x") == nothing.score(None)


def test_toxicity_fines_the_whole_swap(sc):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        toxic = i % 2
        words = prose(rng, 30).split()
        # Nothing but the mentions of a group correlates with the label.
        if rng.random() < (0.5 if toxic else 0.1):
            words.insert(7, "muslim")
        rows.append((i, " ".join(words), toxic))
    docs = sc.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = sc.createDataFrame([(i, y) for i, _, y in rows], "doc_id BIGINT, toxic INT")
    fair = toxicity.train(docs, labels, F.lit(True), min_z=3.0)
    free = toxicity.train(docs, labels, F.lit(True), min_z=3.0, swap_fine=0.0)
    assert {b"musl*", b"musli*"} <= fair.weights.keys()

    def odds(model, text):
        p = model.score(text)
        return math.log(p / (1 - p))

    def change(model, term):
        return odds(model, b"the " + term + b" stone of the river") - odds(model, b"the stone of the river")

    assert change(free, b"muslim") > 1.5
    assert all(abs(change(fair, term.encode())) < 0.3 for term in toxicity.IDENTITY_GROUPS[0])


def test_toxicity_swaps_follow_the_words_of_a_text():
    got = set(toxicity.swaps_of({b"muslim", b"muslims", b"river"}, [b"muslim", b"hindu"]))
    # "muslims" still gives both beginnings, and "muslim*".
    assert got == {(frozenset({b"muslim"}), frozenset()), (frozenset({b"muslim"}), frozenset({b"hindu", b"hind*"}))}
    alone = set(toxicity.swaps_of({b"muslim", b"river"}, [b"muslim", b"hindu"]))
    assert alone == {(frozenset({b"muslim", b"musl*", b"musli*"}), frozenset(n)) for n in ((), (b"hindu", b"hind*"))}


# --- mixing ---


def mixed(docs, share, epochs, **options):
    levels = {"domain": F.substring("source", 1, 1), "source": F.col("source")}
    weights = [F.when(F.col("domain") == "a", 3).otherwise(1), F.lit(1)]
    return mixing.mix(docs, budget_share=share, levels=levels, weights=weights, tokens=mixing.token_count("text"), max_epochs=epochs, **options)


def test_mixing_meets_budgets(sc):
    docs = sc.createDataFrame([(i, "w " * (1 + i % 5), f"{'ab'[i % 2]}{i % 6}") for i in range(600)], "doc_id BIGINT, text STRING, source STRING")
    out = mixed(docs, 0.5, 1, bucket_docs=16)
    sums = {r.source: r.t for r in out.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total = 600 * 3
    for source, t in sums.items():
        quota = total // 2 * (3 if source[0] == "a" else 1) // 4 // 3
        assert quota - 5 < t <= quota
    assert out.count() == out.select("row.doc_id").distinct().count()
    assert {tuple(r.row) for r in out.collect()} == {tuple(r.row) for r in mixed(docs, 0.5, 1, bucket_docs=4096).collect()}


def test_shortages_go_to_siblings_before_ancestors(sc):
    # Domain a may have 3/4 of 800 tokens; its source a2 has few, so a1 takes over before b does.
    rows = [(i, "w " * 10, "a1") for i in range(60)] + [(100 + i, "w " * 10, "a2") for i in range(2)] + [(200 + i, "w " * 10, "b1") for i in range(98)]
    docs = sc.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    sums = {r.source: r.t for r in mixed(docs, 0.5, 1).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    assert sums == {"a1": 580, "a2": 20, "b1": 200}


def test_epochs_repeat_documents_and_edge_cases(make, messy):
    docs = make(messy)
    out = mixed(docs, 2.5, 4)
    most = out.groupBy("row.doc_id", "row.text", "epoch").count().agg(F.max("count")).first()[0]
    repeated = docs.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
    assert out.agg(F.max("epoch")).first()[0] >= 1 and most <= repeated
    assert out.select("row.*").columns == docs.columns
    assert mixed(make([]), 1.0, 2).isEmpty()
