import zlib
from collections import Counter

import pytest

from tape.llm import sharding

SCHEMA = "doc_id long, text string"


def test_counts_slots_and_growth(spark):
    rows = [(k, f"text {k} é") for k in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sharding.shard_documents(docs).collect()
    n = Counter(r.shard for r in got)
    assert set(n) == set(range(16)) and max(n.values()) < 1.35 * 250 and min(n.values()) > 0.65 * 250
    for s in n:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n[s]))
    for r in got:
        t = f"text {r.doc_id} é".encode()
        assert (r.size, r.text_crc32, r.law) == (len(t) + 1, zlib.crc32(t), "key")
        assert r.grown_shard in (r.shard, 16)
    moved = sum(r.grown_shard == 16 for r in got)
    assert 0.6 * 4000 / 17 < moved < 1.4 * 4000 / 17
    grown = {r.doc_id: r.shard for r in sharding.shard_documents(docs, (1.0,) * 17).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in got)


def test_weights(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "'x' AS text")
    n = Counter(r.shard for r in sharding.shard_documents(docs, (1.0, 2.0, 3.0)).collect())
    for s in range(3):
        assert n[s] == pytest.approx(1000 * (s + 1), rel=0.12)


def test_key_alone_decides(spark):
    a, b = (spark.createDataFrame([(k, f"{x}{k}") for k in range(50)], SCHEMA) for x in "ab")
    assert {(r.doc_id, r.shard) for r in sharding.shard_documents(a).collect()} == {(r.doc_id, r.shard) for r in sharding.shard_documents(b.repartition(5)).collect()}


def test_nulls_repeats_empty_and_clashes(spark):
    rows = [(None, None, 1)] * 3 + [(1, "", 2)] * 2 + [(2, None, 3)]
    docs = spark.createDataFrame(rows, SCHEMA + ", shard int").withColumnRenamed("shard", "Slot")
    got = sharding.shard_documents(docs).collect()
    assert len(got) == 6 and {(r.size, r.text_crc32) for r in got} == {(1, 0)}
    for s in {r.shard for r in got}:
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))
    assert sharding.shard_documents(docs.limit(0)).count() == 0
