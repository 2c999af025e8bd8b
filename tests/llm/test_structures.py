"""Conversation tries, quality rules and Merkle manifests against plain versions."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from threadkeeper.llm import op11_trie, op12_quality, op13_manifest

from . import brute
from .conftest import prose

TURNS = "conv_id long, turn long, role string, text string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=str)


def talk(rng, convs, longest, words="xyz"):
    """Conversations whose turns are few, so that many share their first ones."""
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, longest)):
            rows.append((c - 7, t, rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else "user", rng.choice([*words, "é☃", "", None]) if rng.random() < 0.6 else "x"))
    return rows


@pytest.fixture
def parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n_parts", [1, 5, 70])
def test_trie_equals_plain_nodes_over_any_parts(spark, parts, n_parts):
    rng = random.Random(n_parts)
    rows = talk(rng, 150, 6)
    rows += [(1000 + i, t, "user", "x") for i in range(70) for t in range(9)]  # a third are copies of one conversation
    rows += [(5, None, "user", "first"), (5, 0, "user", "x"), (5, 0, "user", "x"), (None, 0, "user", "x"), (2001, 0, "user", "deep")]
    rows += [(2001, t, "user", f"t{t}") for t in range(1, 300)]
    parts(n_parts)
    turns = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit("clash")).repartition(4)
    got = rows_of(op11_trie.trie(op11_trie.rebuild(op11_trie.conversations(turns))), *NODE)
    assert got == brute.trie_nodes(brute.rebuilt(rows))


def test_trie_of_turnless_and_single_conversations(spark):
    for rows in ([(1, 0, None, None)], [(6, 0, "user", "a")], [(3, t, "user", "a") for t in range(3)]):
        got = rows_of(op11_trie.trie(op11_trie.rebuild(op11_trie.conversations(spark.createDataFrame(rows, TURNS)))), *NODE)
        assert got == brute.trie_nodes(brute.rebuilt(rows))


def test_every_merge_makes_one_branching_node():
    items = [op11_trie.Item(list(k), [1] * len(k), {len(k): [1, i, 0, 0, 0]}) for i, k in enumerate(["", "a", "ab", "abc", "abd", "b"])]
    forest = op11_trie.Forest(items, whole=True)
    nodes = {(r[0], r[1]): r for r in forest.nodes({}, None)}
    assert len(nodes) == 6 and nodes[(0, 0)][3:7] == (6, 2, 3, (5 - 1) + (3 - 1) - 1 + 0)
    assert nodes[(2, 2)][3:5] == (3, 2) and nodes[(1, 1)][3:5] == (4, 1)


def test_trie_sql(spark, tmp_path):
    rows = talk(random.Random(3), 60, 5)
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(NODE)} FROM ({op11_trie.OP11_SQL})").fetchall(), key=str)
    assert rows_of(op11_trie.op11_trie(spark, str(tmp_path)), *NODE) == want == brute.trie_nodes(brute.rebuilt(rows))


def awkward_texts(rng):
    line = prose(rng, "aa", 12)
    return [
        None, "", " \t\n", "one", "spam " * 4000, "\n".join([line] * 5), f"{line}\n\n{line}\n \n{prose(rng, 'bb', 30)}", "x" * 100000,
        "#*$ %&| <> " * 9, "Ünï ☃☃ cödé line two " * 12, "a b c d e f g h a b c d e f g h", "a b c d e f g h i a b c d e f g h", "a " * 8, "- x\n* y\n• z...\nend…",
        "the of and to a in is that for it " * 2, prose(rng, "cc", 3000), "THE!! END!! " * 15, "w" * 9 + "\r" + "v",
    ]


def test_quality_counts_equal_plain_ones(spark):
    texts = awkward_texts(random.Random(5))
    docs = spark.createDataFrame([(i, t, "clash", True) for i, t in enumerate(texts)], "id long, text string, n_words string, kept boolean")
    got = {r["id"]: r for r in op12_quality.judge(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat = brute.quality_counts(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat), repr(t)[:60]
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n) and r.kept == (not r.base_failed and r.failed_rules == "")


def test_windows_whose_hashes_collide_are_compared_by_words(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    text = "a b c d e f g h i j a b c d e f g h k l"
    got = spark.createDataFrame([(text,)], "t string").select(op12_quality.measures(F.col("t"))["n_repeat_words"]).first()[0]
    assert got == brute.quality_counts(text)[4] == 16


def test_quality_rules_are_read_from_the_table(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog " * 1 + " ".join(f"w{i}x" for i in range(40)))], "doc_id long, text string")
    assert op12_quality.judge(docs).first().kept
    strict = op12_quality.RULES + (op12_quality.Rule("few_words", "n_words", "n_lines", most=1000),)
    assert op12_quality.judge(docs, strict).first().failed_rules == "few_words"


def test_quality_is_one_projection_without_user_functions(spark, sf_dir):
    plan = op12_quality.op12_quality(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_quality_sql(spark, sf_dir, corpus):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet/*.parquet'")
    got = op12_quality.op12_quality(spark, sf_dir)
    want = sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({op12_quality.OP12_SQL})").fetchall(), key=str)
    assert rows_of(got, *got.columns) == want and len(want) == len(corpus)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_equals_plain_trees(spark, sf_dir, corpus):
    want = brute.merkle_rows(corpus)
    assert rows_of(op13_manifest.op13_manifest(spark, sf_dir), *MANIFEST) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet/*.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(MANIFEST)} FROM ({op13_manifest.OP13_SQL})").fetchall(), key=str) == want
    assert 0 < sum(not r[-1] for r in want) < len(want)


@pytest.mark.parametrize("stride", [1, 3])
def test_manifest_over_several_stored_levels_nulls_and_repeated_rows(spark, tmp_path, monkeypatch, stride, parts):
    monkeypatch.setattr(op13_manifest, "STRIDE", stride)
    parts(7)
    rng = random.Random(stride)
    rows = [(i, f"text {i}", rng.choice(["en", "en", "de", None, "", "ü"]), None if i % 5 else "s", None if i % 11 == 0 else i) for i in range(83)]
    rows += [(7, "again", "en", "s", 3)] * 30 + [(None, None, None, None, None), (None, "x", "en", "s", 1), (2**40, "y" * 50000, "lone", "s", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.withColumn("g", F.lit("clash")).withColumn("leaf", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(op13_manifest.op13_manifest(spark, str(tmp_path)), *MANIFEST) == brute.merkle_rows(rows)


def test_manifest_of_one_row(spark, tmp_path):
    rows = [(1, "a", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    (got,) = rows_of(op13_manifest.op13_manifest(spark, str(tmp_path)), *MANIFEST)
    assert got == brute.merkle_rows(rows)[0] and got[1] == got[2] == got[3]
