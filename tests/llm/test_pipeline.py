import __spark_entry__
import corpus_pipeline
from epiframe.llm import decontaminate, line_dedup, quality, simhash
from epiframe.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "mixing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = staged(stage(spark, docs, SF), "t")
        if k < 4:
            assert out.columns == docs.columns
            ids = [r.doc_id for r in out.select("doc_id").collect()]
            assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality classifier":
            score = {r.doc_id: r.score for r in quality.scores(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
            assert set(ids) == {i for i, s in score.items() if s >= 0.5}
        if name == "line dedup":
            want = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
            assert {r.doc_id: r.text for r in out.collect()} == want
        if name == "simhash near-dedup":
            groups = simhash.near_groups(docs).collect()
            assert set(ids) == {g.group_id for g in groups}
        if name == "benchmark decontamination":
            found = decontaminate.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert set(ids) == {r.doc_id for r in found.collect() if not r.hits}
        if name == "mixing":
            assert {r.copy for r in out.collect()} <= {1, 2} and out.count() > docs.count()
        docs = out


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
