import random

import pytest

from ridelake.llm.workers import share_code

WORDS = "the of and river stone cloud amber delta forest quiet lantern marble engine harbor window paper copper silver".split()
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Names that the operators use inside.
CLASHING = ["id", "doc", "row", "chunk", "text_hash", "words", "lines", "key", "part", "n_words", "host", "kept", "label", "packed_row", "start", "item", "n", "a", "b"]


def prose(rng, n, sep=" "):
    return sep.join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def sc(spark):
    share_code(spark)
    return spark


@pytest.fixture(scope="session")
def make(sc):
    """Documents from ``(id, text)``, with extra columns of clashing names."""

    def frame(rows):
        full = [(i, t, "en", "s" if i is None or i % 3 else None, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows]
        return sc.createDataFrame(full, SCHEMA + "".join(f", `{c}` STRING" for c in CLASHING))

    return frame


@pytest.fixture(scope="session")
def messy():
    """Nulls, empty and long texts, repeated rows, equal ids and missing ids."""
    rng = random.Random(5)
    base = prose(rng, 120)
    long = "\n".join(prose(rng, 40) for _ in range(300))
    line = "a line of more than ten characters"
    return [
        (1, base), (2, base + " tail"), (3, None), (4, ""), (5, " \t\n \n"), (6, "ab"), (6, "ab"), (7, "one two three"), (8, long),
        (9, f"{line}\n{line}\nown words here in nine"), (9, f"{line}\nanother text of nine"), (10, f"  {line.upper()}\t\nlast"), (None, base),
        (None, line), (None, None), (11, "é" * 60), (12, "x " + "é" * 60), (13, base.replace("the", "THE")), (14, "aaaa" * 50), (15, "aaaa" * 30),
    ]
