"""The pipeline, stage by stage, against brute-force versions."""

from collections import Counter

import pytest
from brute import jaccard_components
from test_decontaminate import brute as contamination
from test_mixing import targets

import corpus_pipeline
from tape.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage(spark, stages):
    w, bias, _ = quality.train(stages[0])
    kept = {r.doc_id for r in quality.with_scores(stages[0], w, bias, "p").collect() if r.p >= 0.5}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in kept]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(r[0] in kept for r in rows(stages[0]) if labels.get(r[0]) == 1) >= 0.95 * sum(q == 1 for q in labels.values())


def test_near_duplicate_stage(stages):
    before = rows(stages[1])
    least = {d: c for d, _, c in jaccard_components([(r[0], r[1]) for r in before])}
    assert rows(stages[2]) == [r for r in before if least[r[0]] == r[0]]


def test_decontamination_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in contamination([(r[0], r[1]) for r in rows(stages[2])], items) if r[5]}
    assert rows(stages[3]) == [r for r in rows(stages[2]) if r[0] not in dirty]


def test_mixing_stage(stages):
    before, after = rows(stages[3]), Counter(rows(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 2
    size, got, longest = Counter(), Counter(), Counter()
    for r in before:
        n = len(r[1].split())
        size[r[3]] += n
        got[r[3]] += n * after[r]
        longest[r[3]] = max(longest[r[3]], n)
    for s, t in targets(dict(size)).items():
        assert abs(got[s] - t) <= longest[s]


def test_sharding_stage(stages):
    before, after = stages[4].collect(), stages[5].collect()
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    for s in {r.shard for r in after}:
        slots = sorted(r.slot for r in after if r.shard == s)
        assert slots == list(range(len(slots)))


def test_run_and_empty_documents(spark, stages, tmp_path):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(stages[5].collect())
    stages[0].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_documents_pass_all_stages(spark, tmp_path):
    odd = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words in a row that read like any other page of text does", None, None, 3), (2, "plain words in a row that read like any other page of text does", None, None, 3), (3, "z" * 100_000, "en", "s", None)]
    spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS shard", "'x' AS `_shard`", "'y' AS score").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, 2, 3, None}
