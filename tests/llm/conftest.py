"""Documents with every odd case, as rows of (doc_id, text, lang, source, n_chars)."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    syllables = "an er on en th in re st or ti".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def cases():
    rng = random.Random(4)
    shared = prose(rng, 60)
    texts = {
        1: prose(rng, 80) + " " + shared,
        2: shared + "\n" + prose(rng, 30),
        3: prose(rng, 10) + "  " + shared[: len(shared) // 2],
        4: "",
        5: None,
        6: "word",
        7: "ab " * 400,
        8: "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
        9: prose(rng, 5000) + " " + shared,
        10: "é ü \x1c" + shared.upper(),
        11: " \t\n ",
        12: shared + " " + shared,
        13: "a b c d e",
        14: "İ Σ gnu general public license gnu general public license",
        15: prose(rng, 21),
    }
    rows = [(i, t, "en", "s1" if i % 3 else None, len(t or "")) for i, t in texts.items()]
    rows += [(20 + i, texts[1], None, "s2", None) for i in range(3)]  # exact copies
    rows += [(30, texts[1] + " end", "en", "s1", 1), (30, texts[1] + " end", "en", "s1", 1)]
    rows += [(None, texts[2], "en", "s1", 0), (None, None, None, None, None)]
    rows += [((1 << 60) + 1, texts[15] + " z", "en", "s1", 0)]  # no floating number holds this id
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The cases with columns whose names the operators use themselves."""
    docs = spark.createDataFrame(cases(), SCHEMA)
    clash = "key shard bucket kind blob row pos label size slice fp tile node root n range last h1 x"
    return docs.selectExpr("*", *[f"'?' AS {c}" for c in clash.split()])


@pytest.fixture(scope="session")
def odd_rows():
    return cases()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
