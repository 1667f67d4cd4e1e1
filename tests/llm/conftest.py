from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, labels int, taken string"


def _prose(rng, n, stock=400):
    return " ".join(f"w{rng.randrange(stock)}" + rng.choice(["", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source) rows: prose, copies, near copies, shared passages, runs, junk, nulls and ties."""
    rng = random.Random(4)
    rows = []
    passage = _prose(rng, 60)
    for i in range(90):
        text = "\n".join(_prose(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 8)))
        if i % 9 == 0:
            text += "\n" + passage
        if i % 10 == 1:
            text += " no" * 50
        rows.append((i, text, "en", f"s{i % 4}"))
    rows += [(100 + k, rows[5][1], "en", "s1") for k in range(6)]
    long = _prose(rng, 300, 5000).split()
    for k in range(8):
        words = list(long)
        words[7 * k + 3] = f"changed{k}"
        rows.append((200 + k, " ".join(words), "en", None))
    rows += [
        (300, None, None, None), (301, "", "en", "s0"), (302, " \n\t ", "en", "s0"), (303, "one", "en", "s0"),
        (304, "one two three", "en", "s0"), (305, "one two three", "en", "s9"), (306, "é ñ \x85 \xa0 ▁ <s> x ▁y  z\n\n q\r\n", "fr", "é"),
        (307, "a" * 5000, "en", "s0"), (308, " ".join(["x y"] * 3000), "en", "s0"), (309, "l1 a\nl2 b\n" * 30, "en", "s0"),
        (5, rows[5][1], "en", "s1"), (None, "without an id", "en", "s0"), (None, None, None, "s0"),
    ]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, "t") for r in corpus], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    return "/root/testdata/sf0.001"
