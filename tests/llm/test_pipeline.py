import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

import __spark_entry__ as entry
import corpus_pipeline
from mercato.llm import decontaminate, exact_dedup, quality, simhash

ITEMS = [(1, prose(200)[3][1]), (2, prose(200)[17][1])]


@pytest.fixture
def folder(spark, tmp_path):
    rows = [doc(r[0], r[1] if not r[0] or r[0] % 5 else " ".join(w + "###" for w in r[1].split()), r[3]) for r in prose(300)] + odd_rows()[2:7]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, ITEMS, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame(spark, [(i, int(i % 5 != 0), 0) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_take_effect_in_order(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    docs = with_clashes(spark.read.parquet(f"{folder}/documents.parquet"))
    names = docs.columns
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], folder)
        out.write.parquet(f"{folder}/stage{len(seen)}")
        seen.append(spark.read.parquet(f"{folder}/stage{len(seen)}"))
        if len(seen) <= len(corpus_pipeline.STAGES):
            assert seen[-1].columns == names
    labels, items = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    ids = [sorted((r.doc_id for r in x.collect()), key=repr) for x in seen]
    assert ids[1] == sorted((r.doc_id for r in quality.quality_scores(seen[0], labels).collect() if r.predicted), key=repr)
    assert ids[2] == sorted((r.doc_id for r in exact_dedup.copy_groups(seen[1]).collect() if r.kept), key=repr)
    assert ids[3] == sorted((r.doc_id for r in simhash.near_groups(seen[2]).collect() if r.doc_id == r.component_id or r.component_id is None), key=repr)
    assert ids[4] == sorted((r.doc_id for r in decontaminate.contamination(seen[3], items).collect() if not r.contaminated), key=repr)
    assert set(ids[5]) <= set(ids[4]) and len(ids[0]) > len(ids[1]) > len(ids[2]) > len(ids[3]) > len(ids[4]) > 0
    mix = seen[5].collect()
    assert abs(sum(r.taken for r in mix) - sum(t for t in {r.source: r.target for r in mix}.values())) < 0.1 * sum(r.taken for r in mix)


def test_run_is_the_registered_query(spark, folder):
    a, b = (sorted((r.doc_id, r.taken) for r in f(spark, folder).collect() if r.doc_id is not None) for f in (corpus_pipeline.run, entry.queries()["pipeline"]))
    assert a == b and a


def test_every_operator_has_one_query():
    names = [k for k in entry.queries() if k.startswith("op") and k.split("_")[0][2:].isdigit()]
    assert sorted(int(k.split("_")[0][2:]) for k in names) == list(range(1, 11))


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
