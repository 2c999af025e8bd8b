"""The operators on a small corpus with every odd case, against plain versions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from threadkeeper.llm import op1_mixing, op2_language, op3_minhash, op4_suffix_dedup, op5_preference, op6_toxicity, op7_fingerprint, op8_lm, op9_embeddings, op10_bpe

from . import brute
from .conftest import DOCS, prose


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# 1 mixing


def test_mix_meets_targets_and_caps(spark, sf_dir, corpus):
    rows = op1_mixing.op1_mix(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    size = {r[0]: len(brute.words(r[1])) for r in corpus}
    source = {r[0]: r[3] for r in corpus}
    totals = defaultdict(int)
    for d, n in size.items():
        totals[source[d]] += n
    want, taken = brute.targets(dict(totals)), defaultdict(int)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == totals[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 4)
    again = op1_mixing.op1_mix(spark, sf_dir)
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_targets_reshare_the_excess(spark):
    for sizes in ({"a": 100, "b": 1, "c": 2}, {"a": 5, "b": 5, "c": 5, None: 50}, {"a": 0, "b": 7}, {"x": 0}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in op1_mixing.weighted_targets(df, "source").collect()}
        assert got == {k: pytest.approx(v) for k, v in brute.targets(sizes).items()} if any(sizes.values()) else set(got.values()) == {0.0}


def test_two_margins_are_balanced_together(spark):
    from threadkeeper.llm.common import Scratch

    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 300), ("b", "x", 200), ("b", "y", 50)], "s string, l string, words long")
    margins = {"s": spark.createDataFrame([("a", 300.0), ("b", 300.0)], "s string, target double"), "l": spark.createDataFrame([("x", 350.0), ("y", 250.0)], "l string, target double")}
    rows = op1_mixing.balance(cells, margins, Scratch(spark, "t"), tolerance=0.02).collect()
    for k, want in (("s", {"a": 300, "b": 300}), ("l", {"x": 350, "y": 250})):
        got = defaultdict(float)
        for r in rows:
            got[r[k]] += r.words * r.rate
        assert dict(got) == {g: pytest.approx(v, rel=0.03) for g, v in want.items()}


# 2 language


def test_language_of_held_out_texts(spark, sf_dir, corpus):
    rows = op2_language.op2_language(spark, sf_dir).collect()
    truth = {r[0]: (r[1], r[2]) for r in corpus}
    assert len(rows) == len(corpus)
    good = n = 0
    for r in rows:
        text, lang = truth[r.doc_id]
        assert r.held_out == (brute.crc(r.doc_id) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
        else:
            assert r.lang_pred in ("aa", "bb", "cc")
            if r.held_out and r.doc_id < 90 and len(text) > 40:
                n, good = n + 1, good + (r.lang_pred == lang)
    assert n > 5 and good == n


def test_language_stage_drops_undetermined_only(spark, docs, sf_dir, corpus):
    out = op2_language.stage(spark, docs.withColumn("lang_pred", F.lit("clash")).withColumn("_0", F.lit(1)), sf_dir)
    assert out.columns == [*docs.columns, "lang_pred", "_0"]
    assert {r.doc_id for r in out.collect()} == {r[0] for r in corpus if any(c.isalpha() for c in r[1] or "")}


# 3 near-duplicates


def test_near_duplicates_equal_all_pairs(docs, corpus):
    got = by_id(op3_minhash.near_duplicates(docs, 3, 85))
    want = brute.near_duplicates([r[:2] for r in corpus], 3, 85)
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == want


def test_near_duplicate_groups_with_rows_out_of_line(spark):
    rng = random.Random(1)
    base = prose(rng, n=100).split(" ")
    rows = []
    for i in range(120):  # most reach each other only through few of them
        w = list(base)
        for k in rng.sample(range(len(w)), rng.choice([0, 1, 2, 3, 5, 9])):
            w[k] = f"q{i}"
        rows.append((i, " ".join(w)))
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1])]
    got = op3_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    want = brute.near_duplicates(rows[:120], 3, 85)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]


def test_near_duplicates_of_reused_ids_keep_their_links(spark):
    a, b = " ".join(f"a{i}" for i in range(200)), " ".join(f"b{i}" for i in range(200))
    rows = [(5, a), (5, b), (8, a + " end"), (3, b + " end"), (9, a), (5, "alone among all"), (7, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op3_minhash.near_duplicates(df, 3, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [
        (3, 199, 3, True), (5, 1, 5, True), (5, 198, 3, False), (5, 198, 5, True), (7, 198, 3, False), (8, 199, 5, False), (9, 198, 5, False)
    ]
    assert sorted(map(tuple, op3_minhash.stage(spark, df, "").collect())) == sorted([(3, b + " end"), (5, a), (5, "alone among all")])


def test_near_dedup_stage_keeps_one_of_each_group(spark, docs, sf_dir, corpus):
    twice = docs.unionByName(docs.where("doc_id in (3, 112)"))
    out = op3_minhash.stage(spark, twice, sf_dir)
    want = brute.near_duplicates([r[:2] for r in corpus], 5, 80)
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, (_, _, kept) in want.items() if kept)


# 4 repeats


def test_repeats_equal_the_plain_scan(spark, sf_dir, corpus):
    got = by_id(op4_suffix_dedup.op4_suffix_dedup(spark, sf_dir))
    want = brute.repeats([r[:2] for r in corpus])
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == {d: x[:4] for d, x in want.items()}


def test_repeats_with_edits_null_ids_and_repeated_rows(spark):
    rng = random.Random(9)
    base = prose(rng, n=80)
    rows = []
    for i in range(30):
        t = list(base)
        for _ in range(rng.choice([0, 1, 3])):
            t[rng.randrange(len(t))] = "#"
        a, b = sorted((rng.randrange(len(t)), rng.randrange(len(t))))
        rows.append((i, "".join(t[a : b + 150])))
    df = spark.createDataFrame([*rows, rows[4], (None, base)], "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = op4_suffix_dedup.remove_repeats(df).collect()
    want = brute.repeats([*rows, (None, base)])
    assert len(got) == len(rows) + 2
    for r in got:
        assert r.text == want[r.doc_id][4].decode("utf-8", "ignore") and r.spans == "clash"


def test_repeats_of_two_texts_without_id_do_not_depend_on_batches(spark):
    rng = random.Random(11)
    passage, tails = prose(rng, n=60), [prose(rng, n=30) for _ in range(3)]
    same = spark.createDataFrame([(None, passage + tails[0]), (None, passage + tails[1])], "doc_id long, text string").coalesce(1)
    other = spark.createDataFrame([(1, passage + tails[2])], "doc_id long, text string")
    for df in (same.union(other), same.union(other).coalesce(1), same.repartition(2, "text").union(other)):
        got = op4_suffix_dedup.remove_repeats(df).collect()
        texts = sorted(r.text for r in got if r.doc_id is None)
        assert [r.text for r in got if r.doc_id == 1] == [passage + tails[2]]
        assert texts == sorted(tails[:2])


# 5 preference


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "a long reply")]
    turns += [(2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "other")]
    turns += [(3, 0, "user", None), (3, 1, None, "x"), (None, 0, "user", "hi"), (4, 0, "user", "hi"), (4, 0, "user", "hi")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("weight", F.lit("clash"))
    got = {(r.kind, r.chosen_id, r.rejected_id): r for r in op5_preference.format_pairs(op5_preference.preference_pairs(df)).collect()}
    assert set(got) == {("opening", 1, 2), ("opening", 1, 4), ("stale", 1, 1), ("stale", 2, 2)}
    r = got["opening", 1, 2]
    assert r.n_prompt_turns == 2 and r.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n"
    assert r.chosen == "<|user|>\nmore<|end|>\n<|assistant|>\na long reply<|end|>\n" and r.chosen_mask == "0:21,0:14,1:20"
    assert r.rejected == "<|user|>\nother<|end|>\n" and r.rejected_mask == "0:22"
    assert got["stale", 1, 1].rejected == "<|assistant|>\nhello<|end|>\n" and got["stale", 1, 1].n_prompt_turns == 3
    assert got["stale", 2, 2].rejected == "<|assistant|>\nhi<|end|>\n"
    assert got["opening", 1, 4].n_prompt_turns == 1


# 6 toxicity


def test_toxicity_learns_and_leaves_clean_texts(spark, corpus, tmp_path):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(700):
        w = prose(rng, "aa", 40).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for k in rng.sample(range(len(w)), 3):
                w[k] = rng.choice(["scumbag", "Idiotic", "trash,"]) + ("" if k % 2 else rng.choice(["s", "ly"]))
        rows.append((i, " ".join(w), "aa", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(700, None, None, None, None), (701, "", None, None, None), (702, "idiotic " * 5000, None, None, None), (None, "clean", None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*labels, (701, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op6_toxicity.op6_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    seen = {r.doc_id: r for r in got}
    held = [seen[i] for i in range(700) if seen[i].held_out]
    assert all(r.held_out == (brute.crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert seen[702].predicted == 1 and seen[701].predicted == 0 and seen[701].score == seen[700].score


def test_toxicity_without_labels_scores_nothing(spark, docs):
    none = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    model = op6_toxicity.train(docs, none)
    assert {r.score for r in op6_toxicity.score(docs, model, ["doc_id"]).collect()} == {0.0}


# 7 fingerprints


def test_fingerprints_of_edited_and_next_texts(spark, sf_dir, corpus):
    got = by_id(op7_fingerprint.op7_fingerprint(spark, sf_dir))
    rows = sorted(((r[0], r[1] or "") for r in corpus), reverse=True)
    assert len(got) == len(rows)
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)]
        m = len(text) // 3
        edited = text[: len(text) - m] + after[1][:m]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == op7_fingerprint.fingerprints([text])[0] and r.edited_fingerprint == op7_fingerprint.fingerprints([edited])[0]
        assert r.near_next == op7_fingerprint.likeness(r.fingerprint, got[after[0]].fingerprint)
        if 300 < len(text) < 5000 and d < 90:
            assert r.near_edited > 0.25 > r.near_next


def test_fingerprints_of_single_and_repeated_rows(spark):
    one = op7_fingerprint.compare_with_next(spark.createDataFrame([(5, "abc def")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = [(1, "x y z"), (1, "x y z"), (None, "q"), (2, None)]
    got = op7_fingerprint.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)


# 8 language model


def test_language_model_scores(spark, sf_dir, corpus):
    got = op8_lm.op8_lm(spark, sf_dir).collect()
    tokens = {r[0]: [*brute.words(r[1]), "</end>"] for r in corpus}
    c = Counter()
    for d, w in tokens.items():
        if brute.crc(d) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(corpus)
    for r in got:
        w = tokens[r.doc_id]
        assert r.held_out == (brute.crc(r.doc_id) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert math.isfinite(r.score) and r.score <= 0
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_looks_rare_words_up(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(op8_lm, "HEAD", 5)
    flagged = docs.unionByName(docs.where("doc_id = 7")).withColumn("held_out", F.lit(False))
    rows = op8_lm.score(flagged).collect()
    c = Counter(w for r in [*corpus, corpus[7]] for w in [*brute.words(r[1]), "</end>"])
    n, v = sum(c.values()), len(c)
    text = {r[0]: r[1] for r in corpus}
    assert len(rows) == len(corpus) + 1
    for r in rows:
        w = [*brute.words(text[r.doc_id]), "</end>"]
        assert r.n_known == len(w) and r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))


def test_language_model_counts_the_most_frequent_words_when_none_fits_the_head(spark, docs, corpus, monkeypatch):
    c = Counter(w for r in corpus for w in [*brute.words(r[1]), "</end>"])
    n, v, text = sum(c.values()), len(c), {r[0]: r[1] for r in corpus}
    flagged = docs.withColumn("held_out", F.lit(False))
    choose, chosen = op8_lm.head_floor, []
    monkeypatch.setattr(op8_lm, "head_floor", lambda words, most, clip: chosen.append(choose(words, most, 3)) or chosen[-1])
    for head in (0, 5):
        monkeypatch.setattr(op8_lm, "HEAD", head)
        for r in op8_lm.score(flagged).collect():
            w = [*brute.words(text[r.doc_id]), "</end>"]
            assert r.n_known == len(w) and r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
    assert chosen[0] > max(c.values()) and 3 < chosen[1] <= max(c.values())
    assert sum(x >= chosen[1] for x in c.values()) <= 5


def test_language_model_scores_equal_a_plain_model_whether_its_filter_is_broadcast_or_not(spark, docs, corpus, monkeypatch):
    rows = [*corpus, corpus[7]]
    flagged = docs.unionByName(docs.where("doc_id = 7")).withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 1)
    monkeypatch.setattr(op8_lm, "RANGE_BYTES", 40_000)  # several hash ranges
    monkeypatch.setattr(op8_lm, "PACKET", 20_000)  # and packets
    monkeypatch.setattr(op8_lm, "BITS", 64)  # hardly a false positive
    got = sorted(map(tuple, op8_lm.score(flagged).collect()))
    other = sorted(map(tuple, op8_lm.score(flagged, broadcast=True).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in other]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in other], rtol=1e-12)

    texts = {r[0]: [*brute.words(r[1]), None] for r in corpus}
    one, two = Counter(), Counter()
    learn = [texts[r[0]] for r in rows if brute.crc(r[0]) % 5 != 1]
    for w in learn:
        one.update(w)
        two.update(zip([0, *w], w))
    level = lambda n: int(op8_lm.level(np.array([n]))[0])
    means = []
    for c in (one, two):
        n = np.array(list(c.values()))
        q = op8_lm.level(n)
        means.append({x: n[q == x].mean() for x in set(q.tolist())})
    n, v, start = sum(one.values()), len(one), one[None]
    use = {}
    for w in learn:
        for a, b in zip([0, *w], w):
            x = use.setdefault(level(one[a] if a != 0 else start), [0, 0, 0])
            x[0] += 1
            x[1] += 1
            x[2] += level(two[a, b]) >= level(2)
    for r in got:
        want = 0.0
        w = texts[r[0]]
        for a, b in zip([0, *w], w):
            before = level(one[a] if a != 0 else start)
            total, found, again = use.get(before, (0, 0, 0))
            mass, gain = (again / (total + 1), again / found) if again else (0.0, 0.0)
            history = start if a == 0 else max(1.0, means[0].get(before, 0.0))
            pair = min(1.0, means[1].get(level(two[a, b]), 0.0) / history)
            want += math.log10(gain * pair + (1 - mass) * (means[0].get(level(one[b]), 0.0) + 0.5) / (n + 0.5 * (v + 1)))
        assert r[6] == pytest.approx(min(0.0, want), rel=1e-3, abs=1e-6)


def test_language_model_with_nulls_empty_texts_repeated_ids_and_clashing_columns(spark):
    shape = "doc_id long, text string, held_out boolean, row string, learn int"
    assert op8_lm.score(spark.createDataFrame([], shape)).collect() == []
    rows = [(None, None, False, "x", 1), (1, "", False, "x", 1), (1, "a b", True, "x", 1), (None, "A b " * 3, None, "x", 1), (2, "漢 b", False, "x", 1)]
    got = op8_lm.score(spark.createDataFrame(rows, shape)).collect()
    assert Counter(tuple(r[:5]) for r in got) == Counter([(None, False, 1, 1, 5), (1, False, 1, 1, 5), (1, True, 3, 2, 5), (None, None, 7, 4, 5), (2, False, 3, 3, 5)])
    assert [tuple(r) for r in op8_lm.score(spark.createDataFrame([rows[2]], shape)).collect()] == [(1, True, 3, 0, 0, 0.0, 0.0)]


# 9 embeddings


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        x = rng.normal(size=16)
        if i % 4 and rows:
            x = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=16) * rng.choice([0, 0.05, 0.15, 0.3])
        rows.append((i, [float(np.float32(c)) for c in x], int(i % 3)))
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, rows[0][1], None), (404, [None] * 16, 0), (405, rows[0][1][:8], 0), (406, [], 1), (407, [float("inf")] * 16, 2)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]))
    want = brute.vector_links(rows, 0.93)
    assert sum(x[0] for x in want.values()) > 50
    for options in ({"cell_size": 50, "block": 16}, {"cell_size": 100, "block": 1000, "deviations": None}):
        got = op9_embeddings.near_vectors(df.withColumn("cell", F.lit("clash")), 0.93, **options).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_near_vectors_with_concentrated_differences_meet_over_cell_edges(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i, angle in enumerate(rng.uniform(0, 2 * np.pi, 200)):  # all differences lie in one plane of the 64 dimensions
        x = rng.normal(size=64) * 1e-3
        x[:2] += np.cos(angle), np.sin(angle)
        rows.append((i, [float(np.float32(c)) for c in x], 1))
    df = spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]))
    want = brute.vector_links(rows, 0.93)
    assert sum(x[0] for x in want.values()) > 100
    got = op9_embeddings.near_vectors(df, 0.93, cell_size=50, block=64).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_near_vectors_of_reused_ids_keep_their_links(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(2, 16)).tolist()
    rows = [(5, x, 1), (5, y, 1), (2, [c + 1e-3 for c in x], 1), (3, [c - 1e-3 for c in y], 1), (9, y, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op9_embeddings.near_vectors(df, 0.93).collect())
    assert got == [(2, 1, 2, True), (3, 2, 3, True), (5, 1, 2, False), (5, 2, 3, False), (9, 2, 3, False)]


def linked_vectors(kind, dims, n, seed):
    """Pairs at cosine 0.93 to 0.99 whose differences are spread, lie in two components, or lie in the eight dimensions that carry most of the spread."""
    rng = np.random.default_rng(seed)
    scale = np.where(np.arange(dims) < 8, 1.0, 0.05) if kind == "low rank" else np.ones(dims)
    x = rng.normal(size=(n // 2, dims)) * scale
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.normal(size=x.shape) * scale
    if kind == "two components":
        d[np.argsort(rng.random(x.shape), axis=1).argsort(axis=1) >= 2] = 0
    d -= (d * x).sum(axis=1, keepdims=True) * x
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    cos = rng.uniform(0.93, 0.99, (n // 2, 1))
    return np.concatenate([x, cos * x + np.sqrt(1 - cos**2) * d])


@pytest.mark.parametrize("kind", ["spread", "two components", "low rank"])
def test_near_vectors_recall_over_many_cells(spark, kind):
    unit = linked_vectors(kind, 64, 1500, 11)
    true = unit @ unit.T >= 0.93
    np.fill_diagonal(true, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(unit)], "vec_id long, embedding array<double>, label int")
    links = {d: {r.vec_id: r.n_links for r in op9_embeddings.near_vectors(df, 0.93, cell_size=60, block=100, deviations=d).collect()} for d in (op9_embeddings.DEVIATIONS, None)}
    want = true.sum(axis=1)
    assert want.sum() >= 1400 and all(links[None][i] == n for i, n in enumerate(want))
    assert all(links[op9_embeddings.DEVIATIONS][i] <= n for i, n in enumerate(want))
    assert sum(links[op9_embeddings.DEVIATIONS].values()) >= 0.99 * want.sum()


# 10 tokens


def test_tokens_equal_the_library(spark, sf_dir, corpus):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(op10_bpe.tokenizer_path())
    got = by_id(op10_bpe.op10_bpe(spark, sf_dir))
    for doc, text, *_ in corpus:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        r = got[doc]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# all


def test_empty_tables_give_empty_results(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    from threadkeeper.llm.catalog import QUERIES

    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name


def test_pipeline_stages_take_effect(spark, sf_dir, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "repeats", "mix", "tokens"]
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), [r[:2] for r in corpus if any(c.isalpha() for c in r[1] or "")]
    near = brute.near_duplicates(kept, 5, 80)
    kept = [(d, t) for d, t in kept if near[d][2]]
    texts = {d: x[4].decode("utf-8", "ignore") for d, x in brute.repeats(kept).items()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert docs.columns == [f.name for f in DOCS]
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(texts) and max(copies.values()) <= 3
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and len(r.ids) == r.n_tokens
    source = {r[0]: r[3] for r in corpus}
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, t in texts.items():
        sizes[source[d]] += len(brute.words(t))
        taken[source[d]] += copies[d] * len(brute.words(t))
    for s, t in brute.targets(dict(sizes)).items():
        assert abs(taken[s] - t) <= max(0.1 * t, 10)
