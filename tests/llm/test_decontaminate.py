import hashlib
import random
import re

from brute import lower

from tape.llm import decontaminate as D

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items, size=10):
    tests = []
    for item, text in items:
        w = re.findall(WORD, lower(text))
        m = min(size, len(w))
        tests += [(item, w[k:k + m]) for k in range(len(w) - m + 1)] if m else []
    out = []
    for doc, text in docs:
        w = re.findall(WORD, lower(text))
        hit, names = set(), set()
        for item, t in tests:
            for k in range(len(w) - len(t) + 1):
                if w[k:k + len(t)] == t:
                    hit |= set(range(k, k + len(t)))
                    names |= set() if item is None else {str(item)}
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_random_texts_equal_brute_force(spark):
    r = random.Random(7)
    voc = ["a", "b", "c", "d"]  # few words: blocks and windows repeat
    items = [(k, " ".join(r.choice(voc) for _ in range(r.choice([0, 1, 3, 7, 10, 14])))) for k in range(12)] + [(3, "a b c d a b c d a b"), (None, "d d d d")]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(77, None)]
    docs = [(k, r.choice([" ", ", ", "\n"]).join(r.choice(voc + ["A", "z"]) for _ in range(r.randint(0, 60)))) for k in range(60)] + [(5, None), (None, "x"), (5, ""), (6, "Ä b-C 9d_e")]
    got = D.contamination_report(*frames(spark, docs, items))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    r = random.Random(8)
    items = [(k, " ".join(f"w{r.randrange(30)}" for _ in range(14))) for k in range(20)]
    docs = [(k, items[r.randrange(20)][1] + " " + items[r.randrange(20)][1]) for k in range(20)]
    d, b = frames(spark, docs, items)
    one, names = D.find_contamination(d, b)
    many, _ = D.find_contamination(d, b, block_bytes=100)
    assert sorted(one.collect(), key=str) == sorted(many.collect(), key=str)
    assert {r[names[4]] > 0 for r in one.collect()} == {True}


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 9), (2, "q", None, None)], "doc_id long, text string, N_HIT string, n_words int")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    kept = D.without_contamination(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert D.without_contamination(docs, items.limit(0)).count() == 2
    assert D.contamination_report(docs.limit(0), items).count() == 0
