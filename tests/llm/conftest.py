from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, a long, h1 long, root long, rank int, size int, mix_pass int"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, one very long text, columns with clashing names."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(400)]

    def text(n):
        return "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(n))

    base = [text(rng.randint(2, 6)) for _ in range(24)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100, base[0], "en", "s0"), (101, base[0] + " tail", None, None), (100, base[0], "en", "s0")]
    rows += [(102, base[3].replace(words[5], "changed"), "en", "s1"), (103, "", "en", "s1"), (104, None, None, "s2"), (105, " \n\t \n", "en", None)]
    rows += [(None, base[5], None, None), (None, None, None, None), (106, "é ß 日本 " * 3, "fr", "s0")]
    rows += [(107, text(1500) + "\n" + base[7], "en", "s2"), (108, "x" * 50_000, "en", "s2"), (109, "the " * 300, "en", "s1")]
    extra = (None, 1, None, 2, 3, None, 0)
    full = [(i, t, lang, source, None if t is None else len(t), *extra) for i, t, lang, source in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(5)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def pairs(messy):
    """The rows of ``messy`` as (doc_id, text) on the driver."""
    return [(r["doc_id"], r["text"]) for r in messy.collect()]
