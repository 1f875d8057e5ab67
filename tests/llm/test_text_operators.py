import re
from collections import Counter

import numpy as np
from brute import words

from tape.llm import compression, language, quality
from tape.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "12 34"), (None, "the cat sat on the mat"), (5, "x" * 200_000), (6, "a b " * 50_000), (6, "a b " * 50_000), (7, "Ünï\u00a0cödé 漢字 é")]


def base_counts(text):
    w = words(text)
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_compression_counts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(EDGES, "doc_id long, text string"))
    source = sorted(map(tuple, docs.collect()), key=str)
    measured = compression.measure(docs)
    rows = sorted(measured.collect(), key=lambda r: str((r.doc_id, r.text)))
    assert len(rows) == len(source)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
    verdicts = compression.quality_rules(docs).collect()
    for r in verdicts:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bands_reject_repetition_and_noise():
    import random

    import zstandard

    r = random.Random(1)
    compress = zstandard.ZstdCompressor(level=compression.LEVEL).compress
    voc = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(2000)]
    prose = " ".join(r.choice(voc) for _ in range(3000)).encode()
    noise = bytes(r.randrange(33, 126) for _ in range(20000))
    assert compression.within_bands(prose, compress)[0]
    assert not compression.within_bands(b"spam and eggs " * 1000, compress)[0]
    assert not compression.within_bands(noise, compress)[0]
    # half of the chunks repeat although the whole is within its limits
    mixed = b"".join(prose[k:k + 2048] if k % 4096 else b"ab" * 1024 for k in range(0, 16384, 2048))
    verdict, ratio, outside = compression.within_bands(mixed, compress)
    assert outside == 0.5 and not verdict and 0.2 < ratio
    assert compression.within_bands(b"", compress) == (True, 0.0, 0.0)


def test_chunks_of_short_texts_and_last_chunks_are_judged():
    import random

    import zstandard

    r = random.Random(1)
    compress = zstandard.ZstdCompressor(level=compression.LEVEL).compress
    voc = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(2000)]
    prose = " ".join(r.choice(voc) for _ in range(3000)).encode()
    for n in (2047, 2048, 2049, 3000, 4000, 4095, 4096, 4500, 6200):
        verdict, _, outside = compression.within_bands(prose[:n], compress)
        assert verdict and outside == 0.0
    # 4,000 bytes, half of them repeated: the whole ratio is within its limits
    verdict, ratio, outside = compression.within_bands(prose[:1952] + b"ab" * 1024, compress)
    assert outside == 0.5 and not verdict and 0.23 < ratio < 0.76
    # so is a last chunk of 300 bytes, with what is before it
    assert compression.within_bands(prose[:2048] + b"ab" * 1174, compress)[2] == 2 / 3


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "plain words that say something useful to a reader of this page", 0.5, "x")], "doc_id long, text string, Score double, _score string")
    assert quality.good_documents(docs).columns == docs.columns
    assert quality.good_documents(docs.limit(0)).count() == 0
    assert quality.classify(docs.limit(0)).count() == 0
    assert compression.quality_rules(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(empty).count() == 0


def test_quality_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string")
    got = quality.classify(docs).collect()
    assert len(got) == len(EDGES)
    assert {(r.score, r.kept) for r in got if r.doc_id in (1, 2, 3)} == {(0.0, False)}
    assert all(0 <= r.score <= 1 for r in got)


def test_scores_do_not_depend_on_the_next_row(spark):
    texts = ["", "a", "ab", "abc", "Ünï 漢", "the cat sat", "## 12 %%", "z" * 50, "a b"]
    w = np.random.default_rng(3).normal(0, 40, quality.DIMENSIONS)
    score = lambda some: {r.text: r.score for r in quality.with_scores(spark.createDataFrame([(t,) for t in some], "text string").coalesce(1), w, 0.0, "score").collect()}
    alone = {t: s for t in texts for s in score([t]).values()}
    assert score(texts) == score(texts[::-1]) == alone


def test_training_sample_is_set_by_distinct_texts(spark):
    docs = spark.range(8000).selectExpr("concat('text number ', id % 200, ' of some words') AS text")
    report = quality.train(docs, train_rows=100)[2]
    assert report["rows"] == 8000 and 60 < report["trained_on"] < 140


def test_quality_on_labels_it_never_saw(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op3_quality_weak_labels"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [not r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) > 0.85


def test_labeller_accuracies():
    """EM finds the accuracies that votes were drawn with."""
    r = np.random.default_rng(2)
    y = r.random(20000) < 0.8
    right = np.linspace(0.7, 0.95, len(quality.LABELLERS))
    votes = np.where(r.random((20000, len(right))) < right, 1, -1) * np.where(y, 1, -1)[:, None]
    votes[r.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, accuracy, share = quality.estimate(patterns, counts)
    assert abs(share - 0.8) < 0.02
    assert np.abs(accuracy - right[:, None]).max() < 0.05


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_language_mixture"](spark, d).join(docs, "doc_id").collect()
    held = [r.lang == r.lang_pred for r in got if r.held_out]
    assert len(held) > 100 and np.mean(held) > 0.98


def test_language_edges(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog in the house", "en"), ("der hund und die katze in dem haus", "de"), ("le chat et le chien dans la maison", "fr")] * 20)]
    docs = spark.createDataFrame(rows + [(100, None, "en"), (101, "", "en"), (102, "12 % 34", "de"), (None, "the dog", "en"), (103, "der hund", None), (103, "der hund", None), (104, "x" * 100_000, "fr")], "doc_id long, text string, lang string")
    got = language.identify(docs).collect()
    assert len(got) == len(rows) + 7
    by = {r.doc_id: r for r in got}
    assert {(by[k].lang_pred, by[k].score) for k in (100, 101, 102)} == {("und", 0.0)}
    assert by[None].lang_pred == "en" and by[None].held_out is False and by[103].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got)
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_language_mixture_proportions():
    """Two languages stay in the set where both are there, one where it is not."""
    logs = np.log(np.array([[0.9, 0.05, 0.05], [0.05, 0.9, 0.05]]))
    mixed = np.repeat(logs, [60, 40], axis=0)
    pure = np.repeat(logs, [99, 1], axis=0)
    share = language.infer(np.concatenate([mixed, pure]), np.array([0, 100, 200]))
    assert abs(share[0, 0] - 0.6) < 0.08 and share[0, 2] < 1e-3 and share[0, 1] > 0.3
    assert share[1, 0] > 0.99
