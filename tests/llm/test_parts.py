"""The operators' numeric parts against plain versions."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadkeeper import session
from threadkeeper.llm import common, op2_language, op3_minhash, op4_suffix_dedup, op6_toxicity, op7_fingerprint, op8_lm, op9_embeddings, op10_bpe
from threadkeeper.llm import words as W
from threadkeeper.llm.op10_bpe import PIECE, Transducer, tokenizer_path

from . import brute

TEXT = st.text(alphabet=st.sampled_from("abAB \t\n.é漢\x0b\xa0"), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_hash_equal_exactly_when_they_are(texts):
    h, at = W.word_hashes(pa.array(texts, pa.string()))
    plain = [brute.words(t) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in plain]
    name = {}
    for w, x in zip([w for p in plain for w in p], h.tolist(), strict=True):
        assert name.setdefault(w, x) == x
    assert len(set(name.values())) == len(name)


def test_a_word_longer_than_the_power_table_hashes_like_its_copy():
    long = "x" * (W.STEP + 1000)
    h, _ = W.word_hashes(pa.array([f"a {long} b", long, long[:-1] + "y"]))
    assert h[1] == h[3] != h[4]


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    limit = op3_minhash.sketch_limit(0.85)
    for both, far in ((900, False), (850, False), (300, True)):
        common = rng.integers(0, 1 << 63, both, dtype=np.uint64)
        n = (1000 - both) // 2
        sets = [np.concatenate([common, rng.integers(0, 1 << 63, n, dtype=np.uint64)]) for _ in range(2)]
        values, offsets = np.concatenate(sets), np.array([0, both + n, 2 * (both + n)])
        a, b = op3_minhash.odd_sketches(op3_minhash.min_hashes(values, offsets, op3_minhash.SAMPLES))
        assert (int(np.bitwise_count(a ^ b).sum()) > limit) == far


def test_bands_miss_few_pairs_at_the_threshold():
    for threshold in (0.8, 0.85):
        bands, rows = op3_minhash.band_plan(threshold)
        assert (1 - threshold**rows) ** bands <= 1e-5 and bands <= 32


def test_a_refused_pair_meets_once_with_its_full_sets_however_many_bands_it_shares(spark, monkeypatch):
    from pyspark.sql import functions as F

    tried = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(ok):
        tried.add(1)
        return ok

    plain = op3_minhash.similar
    monkeypatch.setattr(op3_minhash, "similar", lambda a, b, percent: counted(plain(a, b, percent)))
    words = [f"w{i}" for i in range(100)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:91] + [f"x{i}" for i in range(9)]))]  # 91 of 109 words: just below 85 %
    out = op3_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=1, percent=85)
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(1, 1), (2, 2)]
    assert tried.value == 3  # with the band's hub, with its second hub, and across components


def test_a_class_gives_its_set_from_one_text_however_often_its_id_is_used(spark, monkeypatch):
    computed = spark.sparkContext.accumulator(0)
    plain = op3_minhash._sets

    def counted(size):
        run = plain(size)

        def rows(batches):
            for batch in run(batches):
                computed.add(batch.num_rows)
                yield batch

        return rows

    monkeypatch.setattr(op3_minhash, "_sets", counted)
    a, b = [f"a{i}" for i in range(100)], [f"b{i}" for i in range(100)]
    docs = [(1, " ".join(a))] * 5 + [(1, "  ".join(a)), (1, " ".join(b)), (1, "alone"), (2, " ".join([*a, "end"])), (2, " ".join([*b, "end"]))]
    out = op3_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=1, percent=85)
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(1, 1)] * 8 + [(2, 1)] * 2
    assert computed.value == 4  # a and b, with and without an end


def test_shingling_gives_back_the_model_that_a_worker_held():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": ["a b c d"], "th": pa.array([7])})
    for run in (op3_minhash._features(3, 2, 2), op3_minhash._sets(3)):
        common.worker_model("another operator's", lambda: [0] * 1000)
        assert [b.num_rows for b in run(iter([batch]))] == [1]
        assert not common._MODEL


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_stages_give_back_what_their_worker_freed():
    own = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10
    path = tokenizer_path()
    common.worker_model(("tokens", path), lambda: Transducer(path))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": ["a b c d"]})
    held = [bytes(2000) for _ in range(100_000)]  # 200 MB, below what the heap maps one by one
    held = held[-1:]  # what stays last keeps the heap from shrinking by itself
    before = own()
    assert [b.num_rows for b in op10_bpe._round_trip(path, ["doc_id"], True)(iter([batch]))] == [1]
    assert own() < before - 100


def test_many_near_but_unlinked_texts_meet_in_few_tasks(spark, monkeypatch):
    """Small partitions count as skewed here, as on a large table."""
    conf = {
        "spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    monkeypatch.setitem(session.RUNTIME_CONF, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(op3_minhash, "BLOCK", 32)
    words = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join([*words[: 95 - i % 2], *(f"x{i}-{k}" for k in range(9))])) for i in range(120)]  # about 84 % of each pair's words are shared
    docs += [(200, docs[7][1] + " end"), (201, docs[110][1] + " end")]
    old = {k: spark.conf.get(k, None) for k in conf}
    group = "few-tasks"
    for k, v in conf.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = op3_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=1, percent=85).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(120)} | {200: 7, 201: 110}
    seen = spark.sparkContext.statusTracker()
    stages = {s for j in seen.getJobIdsForGroup(group) for s in seen.getJobInfo(j).stageIds}
    tasks = [info.numTasks for s in stages if (info := seen.getStageInfo(s))]
    assert max(tasks) <= 100


def test_suffix_automaton_knows_exactly_the_substrings():
    rng = random.Random(3)
    text = [rng.randrange(1, 4) for _ in range(40)]
    go = op2_language.suffix_automaton(np.array(text, np.uint8))
    subs = {tuple(text[i:j]) for i in range(40) for j in range(i, min(40, i + 6) + 1)}

    def knows(s):
        state = 0
        for c in s:
            if c not in go[state]:
                return False
            state = go[state][c]
        return True

    import itertools

    for n in range(1, 6):
        for s in itertools.product((1, 2, 3), repeat=n):
            assert knows(s) == (s in subs)


def test_cross_parse_counts_the_longest_matches():
    rng = random.Random(5)
    samples = {"x": ["abcabdabe cab"], "y": ["zzyyx xyz"]}
    p = op2_language.CrossParser(samples)

    def phrases(text, lang):
        known = " ".join("".join(c for c in t) for t in samples[lang]) + " "
        n = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i : j + 1] in known and text[i : i + 1] in known:
                j += 1
            n, i = n + 1, j
        return n

    for _ in range(50):
        text = "".join(rng.choice("abcxyzq ") for _ in range(30)).strip()
        text = " ".join(text.split())
        got = p.phrases([op2_language.symbols(text, p.ids)])[0]
        assert got.tolist() == [phrases(text, "x"), phrases(text, "y")]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(-2, 2).map(lambda x: round(x, 2)), max_size=25))
def test_maximal_segments_are_disjoint_and_hold_the_best(scores):
    s = np.array(scores)
    found = op6_toxicity.maximal_segments(s)
    best = max((s[i:j].sum() for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
    assert max((x for x, _, _ in found), default=0) == pytest.approx(max(best, 0))
    for (_, _, e), (_, b, _) in zip(found, found[1:], strict=False):
        assert e <= b
    for x, a, b in found:
        assert x == pytest.approx(s[a:b].sum())
        inner = [s[a:k].sum() for k in range(a + 1, b)]
        assert all(v > -1e-9 for v in inner)  # no prefix that should have been cut off
    # every positive score lies in a segment
    assert all(any(a <= i < b for _, a, b in found) for i in np.flatnonzero(s > 0))


def test_equal_substrings_share_interior_names():
    rng = random.Random(2)
    inner = "".join(rng.choice("abcdef gh") for _ in range(900))
    names = []
    for front in ("", "q", "zz top ", "0123456789" * 3):
        x = np.frombuffer((front + inner + "tail").encode("utf-32-le"), np.uint32)
        level = op7_fingerprint.parse(x, np.zeros(len(x), np.int64))
        names.append(op7_fingerprint.parse(*level)[0])
    for other in names[1:]:
        assert len(np.intersect1d(names[0], other)) >= len(names[0]) - 8


def test_fingerprints_do_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = ["", "a", "aa", "ab" * 400, "😀" * 50, *("".join(rng.choice("abc d") for _ in range(n)) for n in (3, 30, 300, 3000))]
    assert op7_fingerprint.fingerprints(texts) == [op7_fingerprint.fingerprints([t])[0] for t in texts]
    assert op7_fingerprint.likeness("", "") == 1.0
    assert op7_fingerprint.likeness(op7_fingerprint.fingerprints(["abc"])[0], "") == 0.0


def test_log_frequency_filter_reads_levels_back():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 33, 3000, dtype=np.uint64))
    n, ranges = rng.integers(0, 2000, len(keys)), rng.integers(0, 4, len(keys))
    n[::3] = 0  # asked for but never counted
    want = op8_lm.level(n)
    filled = [op8_lm.Filter.stretch(keys[ranges == r], want[ranges == r], op8_lm.BITS) for r in range(4)]
    f = op8_lm.Filter(np.concatenate(filled), np.array([8 * len(x) for x in filled]))
    got = f.levels(keys, ranges)
    assert (got >= want).all() and (got > want).mean() < 0.05


def test_a_range_adds_counts_up_and_answers_every_packet():
    texts = pa.array(["a b a b a", "b c", None, "a " * 700], pa.string())
    learn = [True, False, True, True]
    asked = []
    for packet, rows in enumerate(([0, 1], [2, 3], [0])):
        batch = pa.RecordBatch.from_arrays([texts.take(pa.array(rows)), pa.array([learn[r] for r in rows])], names=["text", "learn"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        sent = pa.RecordBatch.from_arrays([pa.array([packet]), pa.array([sink.getvalue().to_pybytes()])], names=["packet", "texts"])
        asked += op8_lm._ask(0)(iter([sent]))
    table = pa.Table.from_batches(asked)
    got = {r["packet"]: r for r in op8_lm._answer(False, 64)(table).to_pylist()}
    counts = Counter("a b a b a </s>".split() * 2 + ["</s>"] + ["a"] * 700 + ["</s>"])
    for packet, words in ((0, "a b c </s>"), (1, "a </s>"), (2, "a b </s>")):
        assert got[packet]["words"] == len(words.split())
        assert sorted(got[packet]["levels"][: got[packet]["words"]]) == sorted(op8_lm.level(np.array([counts[w] for w in words.split()])))
    assert sum(got[None]["sums"][: op8_lm.LEVELS]) == sum(counts.values()) == sum(got[None]["sums"][op8_lm.LEVELS :])


def test_words_of_one_length_that_a_polynomial_confuses_have_their_own_hashes():
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    words = [thue, thue.translate({97: "b", 98: "a"}), thue[:512], thue[512:], *("x" * n for n in range(1, 130))]
    h, _ = W.word_hashes(pa.array(words, pa.string()))
    assert len(set(h.tolist())) == len(words) - (thue[:512] == thue[512:])
    upper, _ = W.word_hashes(pa.array([w.upper() for w in words], pa.string()))
    assert (upper == h).all()


def test_spherical_kmeans_finds_separate_directions():
    rng = np.random.default_rng(0)
    centres = np.linalg.qr(rng.normal(size=(16, 4)))[0].T
    x = np.concatenate([c + 0.05 * rng.normal(size=(50, 16)) for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = op9_embeddings.spherical_kmeans(x, 4)
    assert np.sort((centres @ c.T).max(axis=1))[0] > 0.95


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=30), min_size=1, max_size=4), st.integers(0, 3))
def test_runs_cover_every_window_once(texts, seed):
    w, g = 8, 4
    data, at = W.text_buffer(pa.array(texts))
    text, p, n, _, _ = op4_suffix_dedup.runs(data, at, w, g)
    got = sorted((int(t), int(a) + k) for t, a, m in zip(text, p, n, strict=True) for k in range(m))
    assert got == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - w + 1)]


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    return Transducer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())


PIECES = ["a", "b", " ", "  ", "\n", "é", "12", "'s", "'LL", "<|endoftext|>", "😀", "the", "　", "\x1c", "\x85", "ß", "漢字", "!", "_", "́", "\x00", " schaft"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_bpe_equals_the_library(bpe, text):
    mine, lib = bpe
    ids = np.frombuffer(b"".join(mine.encode(text)), "<u4").tolist()
    want = lib.encode(text, add_special_tokens=False).ids
    assert ids == want
    assert "".join(mine.decode(iter([b"".join(mine.encode(text))]))) == lib.decode(want, skip_special_tokens=False)


def test_bpe_streams_long_pre_tokens_and_long_texts(bpe):
    mine, lib = bpe
    rng = random.Random(0)
    for text in ("a" * 5000, "".join(rng.choice("abcdefgh") for _ in range(4000)), "ab " * 50_000, " " * 3000 + "x"):
        assert np.frombuffer(b"".join(mine.encode(text)), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_bpe_cuts_long_texts_without_blanks_and_holds_little_at_once(bpe):
    mine, lib = bpe
    rng = random.Random(2)
    chinese = "".join(rng.choice("的一是不了人我在有他这中大来上，。1") for _ in range(400_000))
    code = "".join(rng.choice(["x'", "'s", "(a)", "=12", "''ll", "\t", "b_", "'", "9'd", "\n\n "]) for _ in range(100_000))
    word = "".join(rng.choice("abcdefghé") for _ in range(150_000))
    for text in (chinese, code, word):
        chunks = list(mine.encode(text))
        assert np.frombuffer(b"".join(chunks), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
        assert max(map(len, chunks)) <= 4 * 4 * PIECE
        assert "".join(mine.decode(chunks)) == text
    assert max(map(len, mine.pieces(chinese))) <= PIECE + 1000 and max(map(len, mine.pieces(code))) <= PIECE + 1000
    assert "".join(mine.pieces(code)) == code


def test_bpe_memo_keeps_the_words_in_use(bpe, monkeypatch):
    mine, lib = bpe
    monkeypatch.setattr(op10_bpe, "MEMO", 8)
    texts = [f"word{chr(97 + i)} again{chr(98 + i)} again{chr(97 + i)} " + "y" * 70 * (i % 2) for i in range(20)]
    for _ in range(2):
        for text, chunks in zip(texts, mine.encode_all(texts), strict=True):
            assert np.frombuffer(b"".join(chunks), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_bpe_compatibility_is_what_merging_says(bpe):
    mine, _ = bpe
    rng = random.Random(1)
    some = sorted(mine.tokens.values())[:2000]
    for _ in range(5000):
        a, b = rng.choice(some), rng.choice(some)
        assert mine.compatible(a, b) == (mine.merge(mine.bytes_of[a] + mine.bytes_of[b]) == [a, b])


def test_decoding_replaces_ill_formed_bytes_like_the_library(bpe):
    mine, lib = bpe
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(0, 300) for _ in range(rng.randrange(1, 12))]
        chunks = [np.array(ids[:3], "<u4").tobytes(), np.array(ids[3:], "<u4").tobytes()]
        assert "".join(mine.decode(iter(chunks))) == lib.decode(ids, skip_special_tokens=False)
