"""The stages on their own, chained without writing, and beside each other."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ridelake.llm import queries, token_store
from conftest import prose

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def sf_dir(sc, tmp_path_factory):
    """A folder with a benchmark of two items."""
    path = tmp_path_factory.mktemp("sf")
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item")]
    sc.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    rows = [(i, prose(rng, 60)) for i in range(40)]
    rows += [(100, rows[0][1]), (101, rows[1][1] + " tail"), (102, rows[2][1]), (103, None), (104, ""), (105, "few words"), (None, rows[3][1])]
    rows += [(200, prose(rng, 40) + " alpha beta gamma delta epsilon zeta eta theta iota kappa lambda " + prose(rng, 40))]
    rows += [(300, "\n".join(prose(rng, 50) for _ in range(200)))]
    return rows


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


def test_every_stage_keeps_the_columns_it_gets(sc, make, corpus, sf_dir):
    docs = make(corpus).withColumn("a.b", F.lit(1)).withColumn("two words", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(sc, docs, sf_dir)
        assert got.columns == docs.columns, name
        assert not got.isEmpty(), name


def test_decisions(sc, make, corpus, sf_dir):
    docs = make(corpus)
    good = ids(STAGES["quality"](sc, docs, sf_dir))
    assert not {103, 104, 105} & set(good) and {0, 100, 101, 200, 300} <= set(good)
    one = ids(STAGES["near_deduplicated"](sc, docs, sf_dir))
    assert {100, 101, 102} & set(one) == set() and {0, 1, 2, 3, 200, None} <= set(one)
    clean = {r.doc_id: r.text for r in STAGES["decontaminated"](sc, docs, sf_dir).collect()}
    assert "epsilon" not in clean[200] and all(clean[i] == t for i, t in corpus if i not in (200, None))


def test_stages_chain_without_being_written(sc, make, corpus, sf_dir):
    """Each stage gets a frame that nothing has read yet; a second pipeline runs between the first one's stages."""
    first = second = make(corpus)
    for _, stage in corpus_pipeline.STAGES:
        first = stage(sc, first, sf_dir)
        second = stage(sc, second, sf_dir)
    rows = sorted(map(tuple, first.collect()), key=repr)
    assert rows == sorted(map(tuple, second.collect()), key=repr)
    encoder = token_store.PieceEncoder(queries.tokenizer_path())
    text = dict(corpus)
    untouched = [r for r in rows if r[0] not in (None, 200)]
    assert untouched and all(r[2] == len(encoder.whole(text[r[0]])) // 4 + 1 for r in untouched)


def test_an_empty_table_stays_empty(sc, make, sf_dir):
    docs = make([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(sc, docs, sf_dir)
        assert docs.collect() == []


def test_only_messy_rows(sc, make, messy, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(sc, make(messy), sf_dir).count() <= len(messy), name
