"""SentencePiece by chunks, spelling variants and ranked search against plain versions."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ridelake.llm import length_index, queries, sentence_pieces, variants
from ridelake.session import staging_path

EDGES = [
    "", " ", "a", " a", "a ", "a  b", "▁a", "\na", "a\tb", "é ", "ﬁ ½", "   ", "<s> a</s>", "\0a", "a b", "<0x41>", "a▁▁b ▁ c", "▁", "日本 語  x", "😀 a",
    "a\r\n b", "﻿ x", "é x", "x" * 5000, "many words " * 3000,
]


# --- pieces -------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.PieceTable(queries.piece_model_path())


def test_ids_and_texts_equal_the_library(pieces):
    rng = random.Random(3)
    texts = EDGES + ["".join(rng.choice("ab ▁\né😀 ") for _ in range(rng.randrange(12))) for _ in range(4000)]
    ids = pieces.encode(texts)
    assert pieces.by_chunk and pieces.decodes_by_chunk
    assert ids.to_pylist() == pieces.model.encode(texts)
    assert pieces.decode(ids) == pieces.model.decode(ids.to_pylist())


def test_any_ids_decode_as_in_the_library(pieces):
    rng = random.Random(4)
    some = [0, 1, 2, 3, 50, 259, 264, 13, 2287, 28705, 28708]
    lists = [[rng.choice([*some, rng.randrange(32000)]) for _ in range(rng.randrange(8))] for _ in range(5000)]
    assert pieces.decode(pa.array(lists, pa.list_(pa.int32()))) == [pieces.model.decode(x) for x in lists]
    assert pieces.decode(pa.array([], pa.list_(pa.int32()))) == []


def test_chunks_that_change_alone_are_encoded_whole(pieces, monkeypatch):
    texts = ["odd word", "a word", "", "odd"]
    real = pieces._segment
    monkeypatch.setattr(pieces, "_segment", lambda chunks: ([[7]] * len(chunks), real(chunks)[1] | [c == "▁odd" for c in chunks]))
    got = pieces.encode(texts).to_pylist()
    assert got[0] == pieces.model.encode(texts[0]) and got[3] == pieces.model.encode("odd")
    assert got[1:3] == [[7, 7], []]


def test_documents_keep_their_rows(make, messy, pieces):
    model = queries.piece_model_path()
    coded = sentence_pieces.encode(make(messy), model, block_bytes=200)
    got = [(r.id, r.ids, r.text) for r in sentence_pieces.decode(coded, model, block_ids=50).collect()]
    want = [(i, ids, pieces.model.decode(ids)) for i, ids in ((i, pieces.model.encode(t or "")) for i, t in messy)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_tables_and_null_ids_of_lists(make, sc):
    model = queries.piece_model_path()
    assert sentence_pieces.decode(sentence_pieces.encode(make([]), model), model).collect() == []
    got = sentence_pieces.decode(sc.createDataFrame([("a", None), ("b", []), (None, [264])], "id STRING, ids ARRAY<BIGINT>"), model).collect()
    assert sorted((r.id or "", r.ids, r.text) for r in got) == [("", [264], "a"), ("a", [], ""), ("b", [], "")]


def test_query_equals_the_library(sc, pieces):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    sf = "/root/testdata/sf0.001"
    got = {tuple(r) for r in queries.op11_sentence_pieces(sc, sf).collect()}
    want = set()
    for row in sc.read.parquet(f"{sf}/documents.parquet").collect():
        ids = pieces.model.encode(row.text or "")
        want.add((row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(pieces.model.decode(ids))))
    assert got == want


# --- spelling -----------------------------------------------------------------


def words_by_hand(rows, slip=31):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(variants.UPPER, variants.LOWER))
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped_by_hand(words, ratio=10):
    near = defaultdict(set)
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].add(b)
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in near}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def variants_of(sc, words, **options):
    df = sc.createDataFrame(list(words.items()), "word STRING, n BIGINT")
    return sorted((tuple(r) for r in variants.group_variants(df, **options).select(*COLUMNS).collect()))


@pytest.mark.parametrize("block", [2048, 8])
def test_variants_equal_all_pairs(sc, block):
    """Also with groups cut into many tiles; words over two letters make long ones."""
    rng = random.Random(11)
    words = {}
    for size in (7, 8, 9, 10, 12):
        for _ in range(60):
            words["".join(rng.choice("abé") for _ in range(size))] = rng.choice([2, 3, 20, 30, 300, 4000])
    for word in list(words)[:40]:  # certain neighbours, at the ends too
        at = rng.randrange(len(word) + 1)
        words.setdefault(word[:at] + "q" + word[at:], 2)
        words.setdefault("z" + word[1:], 25)
        words.setdefault(word[:-1], 2)
    assert variants_of(sc, words, block=block) == grouped_by_hand(words)


def test_one_hot_group_is_split_and_complete(sc):
    """All words share their beginning; the group is larger than a tile of rows and than a block."""
    rng = random.Random(12)
    words = {"commonstart" + "".join(rng.choice("abcd") for _ in range(4)): rng.randrange(2, 500) for _ in range(400)}
    words |= {w + "e": 2 for w in list(words)[:100]}
    words["commonstar"] = 9
    assert variants_of(sc, words, block=64) == grouped_by_hand(words)
    assert variants_of(sc, words) == grouped_by_hand(words)


def test_forms_that_follow_each_other_and_ties(sc):
    chain = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000}
    ties = {"zzzzzza": 50, "zzzzzzb": 50, "zzzzzzc": 5, "üüüüüüü": 100, "üüüüüüv": 9}
    got = variants_of(sc, {**chain, **ties})
    assert got == grouped_by_hand({**chain, **ties})
    rows = {r[0]: r for r in got}
    assert rows["abcdefg"][2] == "abcdefghijk" and rows["zzzzzzc"][1] == "zzzzzza"
    assert variants_of(sc, {}) == [] and variants_of(sc, {"lonesome": 4}) == [("lonesome", None, "lonesome", 4, 0, None)]


def test_words_of_documents(make, messy, rows):
    rng = random.Random(13)
    texts = [*messy, (20, "Straßenbahn STRAßENBAHN straßenbahn ÄPFELCHEN äpfelchen"), (21, "w" * 30_000), (22, "W" * 30_000), (23, "w" * 30_001 + " " + "w" * 30_001)]
    texts += [(100 + i, " ".join(rng.choice(["reliable", "Wonderful", "seventh"]) for _ in range(30))) for i in range(80)]
    got = dict(rows(variants.spelled_words(make(texts))))
    assert got == words_by_hand(texts)
    assert sorted(tuple(r) for r in variants.group_variants(variants.spelled_words(make(texts))).select(*COLUMNS).collect()) == grouped_by_hand(got)
    assert variants.group_variants(variants.spelled_words(make([]))).collect() == []


# --- search -------------------------------------------------------------------


def ranked_by_hand(docs, items, k=20):
    def terms(text):
        return re.findall(length_index.TERM, (text or "").translate(str.maketrans(length_index.UPPER, length_index.LOWER)))

    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(Counter)
    for item, text in {*items}:
        asked[item].update(terms(text))
    out = []
    for item, query in asked.items():
        weight = {t: n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t, n in query.items() if t in df}
        found = []
        for (doc, c), n in zip(counted, sizes, strict=True):
            if n:
                m = 100 - 25 + (25 * n * n_docs) // n_terms
                score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, w in weight.items())
                found.append((-score, doc is None, doc))
        top = sorted((f for f in found if f[0] < 0), key=lambda f: (f[0], f[1], f[2] or 0))[:k]
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(top, 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "the river and the stone"), (2, "aaaa é lantern"), (3, None), (4, ""), (5, "nowhere-to-be-found"), (6, "one two three line of characters"), (6, "own words"), (1, "the river and the stone"), (None, "ab tail")]


def found_in(sc, docs, items, path=None, segment_bytes=6_000_000, **options):
    path = path or staging_path(sc, "test-index")
    length_index.build_index(docs, path, segment_bytes=segment_bytes)
    df = sc.createDataFrame(items, "item_id BIGINT, text STRING, id STRING, rank INT")
    return sorted((tuple(r) for r in length_index.search(sc, path, df, **options).collect()), key=repr)


def padded(items):
    return [(i, t, "x", 1) for i, t in items]


@pytest.mark.parametrize("segment_bytes", [6_000_000, 3_000, 1])
def test_search_equals_scoring_every_document(sc, make, messy, segment_bytes):
    """In one segment, in several, and in one a document."""
    got = found_in(sc, make(messy).repartition(2), padded(ITEMS), segment_bytes=segment_bytes)
    assert got == ranked_by_hand(messy, ITEMS)


def test_large_strata_ties_and_blocks_of_queries(sc, make):
    """Copies make one stratum hold most documents, and more documents tie than are asked for."""
    rng = random.Random(8)
    words = [f"w{n}" for n in range(60)]
    docs = [(i, "w1 w2 w3 w4 w5 w6 w7 w8") for i in range(700)]
    docs += [(1000 + i, " ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randrange(1, 60)))) for i in range(900)]
    rng.shuffle(docs)
    items = [(n, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for n in range(30)] + [(99, "w3 w3 w1")]
    assert found_in(sc, make(docs).repartition(3), padded(items), block_bytes=200) == ranked_by_hand(docs, items)
    assert found_in(sc, make(docs), padded(items), segment_bytes=20_000, k=3) == ranked_by_hand(docs, items, k=3)


def test_search_leaves_low_strata(sc, make, monkeypatch):
    """Bounds decide: with short documents that hold the term, strata of long ones are not scored."""
    docs = [(i, "rare") for i in range(30)] + [(100 + i, "rare " + "filler " * (50 * i)) for i in range(1, 30)]
    ids, texts = pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])
    n_terms = sum(len(t.split()) for _, t in docs)
    row = length_index._segment(ids, texts, len(docs), n_terms)
    one = {c: row[c][0].values if c in ("ids", "terms") else row[c][0].as_py() for c in row.schema.names}
    segment = length_index._Segment(one, pa.array(["rare"]))
    segment.postings = np.where(segment.postings < 30, segment.postings, -10**6)  # reading further ones would fail
    monkeypatch.setattr(length_index, "FIRST_WAVE", 20)
    found, scores = segment.search(np.array([0]), np.array([500]), length_index._Best(20))
    assert sorted(ids.take(pa.array(found)).to_pylist()) == list(range(20)) and len(set(scores.tolist())) == 1


def test_empty_search(sc, make, messy):
    assert found_in(sc, make([]), padded(ITEMS)) == []
    assert found_in(sc, make(messy), []) == []


def test_ids_of_any_type(sc):
    docs = sc.createDataFrame([("b", "same text"), ("a", "same text"), (None, "same text"), ("c", None)], "doc_id STRING, text STRING")
    assert found_in(sc, docs, padded([(1, "text")]))[0][2] == "a"
    assert [r[2] for r in found_in(sc, docs, padded([(1, "text")]))] == ["a", "b", None]


def test_a_block_of_texts_stays_small():
    """What encoding and decoding 10 MB of one batch adds to a worker, at the usual block sizes."""
    code = """
import inspect, random, resource, numpy as np, pyarrow as pa
from ridelake.llm import queries, sentence_pieces as sp
table, rng = sp.PieceTable(queries.piece_model_path()), random.Random(1)
texts = pa.array([" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 10))) for _ in range(300)) for _ in range(5000)])
usual = [inspect.signature(f).parameters[n].default for f, n in ((sp.encode, "block_bytes"), (sp.decode, "block_ids"))]
table.decode(table.encode(["warm"]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for part in sp._parts(pa.RecordBatch.from_arrays([texts], ["text"]), np.diff(sp._edges(texts)), usual[0]):
    ids = table.encode(part["text"].to_pylist())
    for own in sp._parts(pa.RecordBatch.from_arrays([ids], ["ids"]), np.diff(ids.offsets.to_numpy()), usual[1]):
        table.decode(own["ids"])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1000)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, env={**os.environ, "PYTHONPATH": os.pathsep.join([root, *sys.path])}, check=True)
    assert int(found.stdout) < 250
