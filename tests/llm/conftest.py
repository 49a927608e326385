import random

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, block long, "
           "token string, row long, salt int, n int, held_out boolean, label string, shard string, y string")


def prose(rng, words, lang="en"):
    parts = {"en": ["the", "and", "ing", "tion", "wh", "er", "on"], "de": ["sch", "und", "ein", "ge", "ver", "ß", "ü"]}
    return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """``(doc_id, text, lang)`` with every awkward case once or more."""
    rng = random.Random(5)
    base = prose(rng, 120)
    long = prose(rng, 20_000)
    rows = [(1, base, "en"), (2, base, "en"), (3, base + " tail", "en"), (3, base + " tail", "en"), (4, None, "en"),
            (5, "", "de"), (6, " \n\t ", None), (None, base + " other end", "en"), (None, None, None),
            (7, long, "en"), (8, "x" * 50_000, None), (9, "two words", "en"), (10, "two words", "en"),
            (11, "a b c d e", "en"), (12, "日本語 🙂 text\u0000nul <|endoftext|>", "en"), (13, "1234 !!! ###", None),
            (14, prose(rng, 200, "de"), "de"), (15, "A B C\r\nD\x0bE", "en")]
    rows += [(20 + i, prose(rng, 60, "de" if i % 3 else "en"), "de" if i % 3 else "en") for i in range(40)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, g, "s", 1, 0.5, True, 7, "t", 3, 2, 1, None, "l", "sh", "yy")
                                  for d, t, g in rows], COLUMNS)


@pytest.fixture(scope="session")
def edge(spark, edge_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    frame(spark, edge_rows).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
