import pytest

import corpus_pipeline
from compare import rows, views
from vivarium.llm import decontamination, jaccard_join, mixing, registry, toxicity
from vivarium.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), views(SF).execute(registry.ORACLE_SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_pipeline_stages(spark):
    """Each stage against what its operator says of the stage's input."""
    d = table(spark, SF, "documents")
    columns, kept = d.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, d = d, staged(stage(spark, d, SF), name)
        assert d.columns == columns
        kept[name] = (before, d)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = kept["toxicity"]
    assert ids(after) == ids(toxicity.toxicity(before, table(spark, SF, "labels")).where("predicted = 0"))
    before, after = kept["near_duplicates"]
    assert ids(after) == ids(jaccard_join.jaccard_components(before).where("component_id = doc_id"))
    before, after = kept["decontamination"]
    assert ids(after) == ids(decontamination.contamination(before, table(spark, SF, "benchmark")).where("not contaminated"))
    before, after = kept["mixing"]
    copies = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    for r in mixing.mix_sources(before).collect():
        assert abs(copies.get(r.doc_id, 0) - r.taken / max(1, r.size)) < 1
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == ids(after)
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)
    assert corpus_pipeline.run(spark, SF).count() == len(out)
