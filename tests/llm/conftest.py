from __future__ import annotations

import pytest

from wattlake.session import get_session


@pytest.fixture(scope="session")
def spark():
    return get_session("local[4]", shuffle_partitions=4)


#: Cases every operator must take: nulls, empty and blank texts, ties, repeated rows, one very long text.
BASE = "the quick brown fox jumps over the lazy dog while seven small birds sing on an old stone wall near a quiet river bank"
LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(30000))


def documents(spark, extra=()):
    words = BASE.split()
    other = [f"{a}{b}" for a in "kltm" for b in ("or", "an", "ist", "ede", "ulo", "ine", "ash", "opa")]
    rows = [(1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, None, None, None), (4, "", "en", "b"),
            (5, " \n\t ", "en", "b"), (6, "One two three", "en", "b"), (7, "one TWO three", None, "b"),
            (8, BASE.upper(), "en", "a"), (9, " ".join(words[:-1] + ["lake"]), "en", None), (None, BASE + " end", "fr", "c"),
            (10, " ".join(other), "fr", "c"), (11, " ".join(other[::-1]), "fr", "c"), (12, "x", "fr", "c"),
            (13, " ".join(other) + " " + " ".join(other), "fr", "a"), (14, LONG, "en", "a"), (15, LONG + " tail", "en", "a"),
            (16, "été déjà vu, 42 tables!! the quick brown fox", "fr", "a"), (17, "12 34 --", "en", "a"),
            (18, " ".join(other[:20]) + "\n" + BASE, "en", "c"), *extra]
    # clashing names: columns that operators use inside
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), "r", 5, "s") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, ref string, size int, component string")


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    documents(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return docs.where("doc_id = -1")
