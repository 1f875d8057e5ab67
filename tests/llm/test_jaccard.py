import random

import numpy as np
import pytest
from brute import jaccard_components, shingle_set

from tape.llm import jaccard
from tape.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def run(spark, rows, **kw):
    return sorted(map(tuple, jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)


def families(seed, groups=12, words=60):
    """Texts with edits, some of them right at the threshold."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(25)]
    rows = []
    for g in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 4, 5, 9, words, 3 * words]))]
        if g % 3 == 0:
            base = passage + base
        for _ in range(r.randint(1, 6)):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append((len(rows), r.choice([" ", "\n", "\t "]).join(text).upper() if r.random() < 0.2 else " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = families(seed)
    want = jaccard_components(rows)
    assert run(spark, rows) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_nulls_empty_repeats_and_short_texts(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (9, "one two"), (2, "ONE  two"), (2, "ONE  two"), (7, "one two three"), (None, "one two"), (8, "é é é é é é é é"), (6, "é é é é é")]
    assert run(spark, rows) == jaccard_components(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_cross_components_are_completed(spark):
    """A chain whose ends do not link with its centre."""
    words = [f"c{k}" for k in range(120)]
    rows = [(k, " ".join(words[3 * k:3 * k + 60])) for k in range(12)]
    assert run(spark, rows) == jaccard_components(rows)


def test_one_of_each_keeps_all_columns(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "a b c d e f", None, 2), (2, "a b c d e f", None, 2), (None, "a b c d e f", "y", 3), (3, "other", "z", 4), (3, "other", "z", 4), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, stays int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[3], rows[4], rows[6]], key=str)


def test_repeated_ids_keep_their_other_texts(spark):
    words = [f"w{k}" for k in range(60)]
    first, copy = " ".join(words), " ".join(words[:-1] + ["end"])
    rows = [(1, first), (7, copy), (7, "a clean text of the same id"), (7, "one more clean text of it"), (7, "one more clean text of it")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted([rows[0], rows[2], rows[3]])


def test_links_through_texts_without_id(spark):
    words = [f"w{k}" for k in range(100)]
    text = lambda k: " ".join(words[k:k + 80])
    rows = [(9, text(0)), (None, text(8)), (None, text(8)), (5, text(16))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(9, 5), (None, 5), (5, 5)}


def test_prefixes_meet_under_every_order():
    """The prefix property on random pairs at or over the threshold."""
    r = np.random.default_rng(3)
    levels = r.integers(0, 5, 1 << 10).astype(np.uint8)
    for _ in range(300):
        pool = np.unique(r.integers(0, 1 << 62, 80).astype(np.uint64))
        x, y = np.sort(r.permutation(pool)[:r.integers(60, 80)]), np.sort(r.permutation(pool)[:r.integers(60, 80)])
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            for seed in jaccard.ORDER_SEEDS:
                assert len(np.intersect1d(jaccard.prefix(x, levels, seed, 80), jaccard.prefix(y, levels, seed, 80)))


def test_pack_round_trip():
    tokens = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 500).astype(np.uint64))
    assert set(jaccard.unpack(jaccard.pack(tokens)).tolist()) == {int(t) & ((1 << 48) - 1) for t in tokens}


def test_shingle_sizes(spark):
    rows = [(1, "a a a a a a a"), (2, "a b c d"), (3, "A b c D e f")]
    assert run(spark, rows) == [(k, len(shingle_set(t)), k) for k, t in rows]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(200, 201), (300, 300)], "a long, b long")
    got = dict(map(tuple, connected_components(edges).collect()))
    assert got == {**{k: 0 for k in range(101)}, 200: 200, 201: 200}
