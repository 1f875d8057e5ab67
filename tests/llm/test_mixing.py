import random

import pytest

from tape.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """The resharing process itself, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, got = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level >= cap * sizes[s]}
        if not full:
            got.update({s: w[s] * level for s in open_})
            break
        got.update({s: cap * sizes[s] for s in full})
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return got


def documents(seed, n=400):
    r = random.Random(seed)
    names = ["b", "a", None, "é", "Z", "zz"]
    return [(k, r.choices(names, [30, 5, 3, 2, 9, 1])[0], " ".join("w" for _ in range(r.randint(0, 30)))) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rows = documents(seed)
    got = mixing.mix_sizes(spark.createDataFrame(rows, SCHEMA)).collect()
    source = {k: s for k, s, _ in rows}
    sizes, taken, target = {}, {}, {}
    for k, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    for r in got:
        assert r.size == len(rows[r.doc_id][2].split()) and r.taken <= 2 * r.size and r.source_size == sizes[source[r.doc_id]]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 30
    again = mixing.mix_sizes(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(again) == sorted(got)


def test_budgets_are_nested(spark):
    docs = spark.createDataFrame(documents(5), SCHEMA)
    small, large = ({r.doc_id: r.taken for r in mixing.mix_sizes(docs, share=s).collect()} for s in (0.4, 0.7))
    assert all(small[k] <= large[k] for k in small) and sum(small.values()) < sum(large.values())


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None), (None, None, None), (1, None, "a b"), (1, None, "a b"), (2, "s", ""), (3, "t", "x\x0by\x1cz")]
    got = mixing.mix_sizes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and {(r.doc_id, r.size) for r in got} == {(None, 0), (1, 2), (2, 0), (3, 2)}
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mix_sizes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mixed_documents_are_the_copies(spark):
    rows = [(*r, "k") for r in documents(6, 200)]
    docs = spark.createDataFrame(rows, SCHEMA + ", copies string").withColumnRenamed("copies", "Cut")
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    n = {}
    for r in mixed.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    for r in mixing.mix_sizes(docs).collect():
        if r.size:
            assert r.taken == r.size * n.get(r.doc_id, 0)
        else:
            assert n[r.doc_id] >= 1
