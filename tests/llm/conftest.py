import random

import pytest
from pyspark.sql import types as T

SYLLABLES = {
    "aa": ["the", "ing", "er", "on", "an", "th", "re", "st"],
    "bb": ["der", "sch", "ung", "ein", "ich", "keit", "be", "zu"],
    "cc": ["eau", "qui", "ment", "oi", "ère", "lle", "vi", "ç"],
}


def prose(rng, lang="aa", n=60):
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))))
    return " ".join(out).capitalize() + "."


DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents with copies, near copies, shared passages, empty, null and long texts."""
    rng = random.Random(7)
    rows = []
    passage = prose(rng, "aa", 40)
    for i in range(90):
        lang = "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2]
        text = prose(rng, lang, rng.choice([1, 2, 4, 30, 60, 120]))
        if i % 9 == 4:
            text = f"{text} {passage} {prose(rng, lang, 10)}"
        rows.append([i, text, lang, ["s1", "s2", None, "s3"][min(3, i % 8)]])
    base = prose(rng, "aa", 150).split(" ")
    for i in range(90, 110):  # copies of one text with more and more words changed
        words = list(base)
        for k in range(i - 90):
            words[(7 * k + i) % len(words)] = f"x{k}y"
        rows.append([i, " ".join(words), "aa", "s3"])
    rows += [[110, rows[5][1], "cc", "s1"], [111, rows[5][1], "cc", "s2"], [112, None, "aa", "s1"], [113, "", "bb", "s1"], [114, " \t\n", None, "s1"], [115, "123 !?", "aa", "s1"]]
    rows += [[116, "ab" * 3000, "aa", "s2"], [117, prose(rng, "bb", 8000), "bb", "s3"], [118, "Ünïcödé ☃ " * 40, "bb", "s1"], [119, rows[10][1].upper(), "bb", "s2"]]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def sf_dir(spark, corpus, tmp_path_factory):
    """The corpus and its labels as a data folder."""
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(corpus, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    return str(root)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
