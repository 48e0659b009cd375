"""Near copies, token stores, archives, and the pipeline."""

import io
import json
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import prose
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import dart_minhash, queries, token_store, warc
from ridelake.llm.components import components

SF = "/root/testdata/sf0.001"


# --- near copies ---


def shingle_set(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_classes(rows, least=0.8):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and len(a & b) >= least * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_copies(rng, n, words, rate):
    base = prose(rng, words).split()
    return [" ".join(prose(rng, 1) if rng.random() < rate else w for w in base) for _ in range(n)]


def test_near_duplicates_equal_brute_force(make, messy):
    rng = random.Random(11)
    texts = [t for rate in (0.005, 0.02, 0.03, 0.05) for t in near_copies(rng, 25, 150, rate)]
    # Shortened copies: they lack much of the text they come from, and add nothing.
    whole = prose(rng, 200).split()
    texts += [" ".join(whole[: 200 - 7 * k]) for k in range(14)]
    # Copies of a copy that is far from the original.
    second = " ".join(w if k % 12 else "other" + w for k, w in enumerate(whole))
    texts += [second.replace(whole[k], "swap", 1) for k in range(0, 60, 5)]
    rows = [*messy, *enumerate(texts, 1000)]
    got = dart_minhash.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    want = brute_classes(rows)
    assert {r.id: r.class_id for r in got if r.id is not None} == want
    assert all(r.class_id is None for r in got if r.id is None)
    docs = make(rows)
    kept = dart_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*want.values(), None}
    assert dart_minhash.near_duplicates(make([])).isEmpty()


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    keys = dart_minhash.mix(np.arange(1, 400, dtype=np.uint64))
    a, b = rng.uniform(0.2, 6, len(keys)), rng.uniform(0.2, 6, len(keys))
    a[:60], b[300:] = 0, 0
    doc, element, weight = np.repeat([0, 1], len(keys)), np.tile(keys, 2), np.concatenate([a, b])
    used = weight > 0
    signature = dart_minhash.dart_signatures(doc[used], element[used], weight[used], 3, 4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((signature[0] == signature[1]).mean() - want) < 0.03
    assert (signature[:2] != 0).all() and (signature[2] == 0).all()


def test_weighted_copies(make):
    base = " ".join(f"w{i}" for i in range(40))
    got = dart_minhash.near_duplicates(make([(1, base), (2, f"{base} " * 6), (3, base + " x")]), weighted=True)
    assert {r.id: r.class_id for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def test_components_of_a_long_chain(sc):
    links = sc.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a BIGINT, b BIGINT")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(links.limit(0)).isEmpty()


# --- token store ---


@pytest.mark.parametrize("seed", range(30))
def test_simple8b_round_trip(seed):
    rng = random.Random(seed)
    values = [rng.choice([0, 1, rng.randrange(16), rng.randrange(50_000), rng.randrange(2**30), 2**60 - 1, 2**60, 2**64 - 1][: rng.choice([1, 2, 4, 8])]) for _ in range(rng.choice([0, 1, 7, 130, 1000]))]
    given = np.array(values, np.uint64)
    words, escapes = token_store.pack(given)
    assert (token_store.unpack(words, escapes, len(given)) == given).all()
    if values and max(values) == 0:
        assert len(words) <= 8 * (len(values) // 120 + 2) or len(values) < 120


def test_pieces_give_the_ids_of_the_whole_text():
    encoder = token_store.PieceEncoder(queries.tokenizer_path(), most=50)
    rng = random.Random(1)
    signs = list("ab é漢1 2'.,\n\t !-\"&s½́ ²Z") + ["<|endoftext|>", "'ll", "  "]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(16)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, repr(text)


def test_recent_pieces_are_made_once(monkeypatch):
    made = []

    def make(piece):
        made.append(piece)
        return piece.encode() * 2

    def ask(recent, names):
        ids, places = recent.of(pa.array(names, pa.string()))
        assert ids.take(pa.array(places)).to_pylist() == [n.encode() * 2 for n in names]

    rng, recent = random.Random(3), token_store._Recent(make, 6)
    for _ in range(200):
        ask(recent, rng.sample("abcdefghijkl", rng.randrange(0, 9)))
        assert len(recent.names) == len(recent.ids) == len(recent.used) <= 9 and len({*recent.names.to_pylist()}) == len(recent.names)
    made.clear()
    for names in ("abcd", "ef", "abef", "gh", "abgh"):  # c and d are the longest unused
        ask(recent, names)
    assert made.count("a") <= 1 and made.count("g") <= 1
    monkeypatch.setattr(token_store, "RECENT_BYTES", 3)
    ask(recent, "xya")
    assert sorted(recent.names.to_pylist()) == ["a", "x", "y"]
    made.clear()
    many, large = [f"w{n}" for n in range(250_000)], token_store.PieceEncoder(queries.tokenizer_path()).pieces
    monkeypatch.setattr(token_store, "RECENT_BYTES", 64_000_000)
    large.make = make
    for _ in range(2):
        large.of(pa.array(many))
    assert len(made) == len(many)


def test_store_round_trip(sc, make, messy, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(make(messy), path, queries.tokenizer_path(), block_ids=500)
    got = sorted(token_store.read_store(sc, path, with_ids=True).collect(), key=lambda r: r.start)
    encoder = token_store.PieceEncoder(queries.tokenizer_path())
    want = sorted(((i is not None, i or 0, [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in messy), key=lambda x: x[:2])
    assert [r.doc_id for r in got] == [i if known else None for known, i, _ in want]
    assert sorted((r.doc_id or 0, r["ids"]) for r in got) == sorted((i, ids) for _, i, ids in want)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r["ids"])
        assert r.ids_crc32 == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r.n_tokens
    empty = str(tmp_path / "empty")
    token_store.write_store(make([]), empty, queries.tokenizer_path())
    assert token_store.read_store(sc, empty).isEmpty()


# --- archives ---


def test_archives_round_trip(sc, tmp_path):
    big = "b" * (17 << 20)  # the member's last byte is not NUL
    pages = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "ü", "größe\r\n\r\n x"), (6, "u", big), (None, "n", "same"), (None, "n", "alone"), (7, "z", "\0\0")]
    df = sc.createDataFrame([(*p, "x", 1) for p in pages], "page_id BIGINT, url STRING, html STRING, payload_sha STRING, holder INT")
    path = str(tmp_path / "warc")
    warc.write_archives(df, path)
    got = sorted(((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_archives(sc, path).collect()), key=repr)
    holder = {"same": 2, "": 4}
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        h = holder.get(html or "", i)
        want.append((i is None, i or 0, "response" if h == i else "revisit", None if h == i else h, len(raw), warc.digest(raw)))
    assert got == sorted(want, key=repr)
    # The files are plain WARC archives: concatenated gzip members.
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")) if p.suffix == ".txt")
    records = list(warc.read_records(io.BytesIO(raw)))
    assert len(records) == len(pages) and "\n" not in "".join(f["warc-target-uri"] for f, _ in records)
    warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(sc, str(tmp_path / "none")).isEmpty()


def test_damaged_archives_are_noticed():
    good = warc.record(1, "u", b"payload", None)
    two = warc.gzip_member(good) + warc.gzip_member(b"") + warc.gzip_member(warc.record(2, "u", b"", 1))
    assert [f["warc-type"] for f, _ in warc.read_records(io.BytesIO(two))] == ["response", "revisit"]
    for bad in (two[:-9], two[: len(two) // 2], warc.gzip_member(good.replace(b"payload", b"paXload")), warc.gzip_member(good[:-1]), warc.gzip_member(b"no record\r\n\r\n"), b"plain"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


# --- pipeline ---


def test_pipeline_stages(sc, tmp_path):
    docs = sc.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_deduplicated", "decontaminated", "mixed", "token_ids"]
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(sc, before, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = sc.read.parquet(str(tmp_path / name))
        if name != "token_ids":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
        sizes.append(docs.count())
        if name == "near_deduplicated":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in docs.collect()} == set(brute_classes(rows).values())
        if name == "decontaminated":
            assert queries.decontaminate.benchmark_hits(docs, sc.read.parquet(f"{SF}/benchmark.parquet")).filter(F.size("runs") > 0).count() < 5
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 100
    assert corpus_pipeline.run(sc, SF).count() == sizes[-1]


def test_every_operator_is_registered():
    found = queries.queries()
    assert [int(name[2:].split("_")[0]) for name in found] == list(range(1, 11))
    assert json.dumps(sorted(found))
    assert pq.read_schema(f"{SF}/documents.parquet").names == ["doc_id", "text", "lang", "source", "n_chars"]
