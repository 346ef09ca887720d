import os

import pytest

import corpus_pipeline
from tests.llm.conftest import sentence

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_every_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    from chronotape.llm.common import stored

    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            if name != "mixing":
                assert 0 < docs.count() <= before
            before = docs.count()
    pieces = docs.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in pieces) <= 1024 and docs.where("piece = 0").count() == before


def test_stages_survive_nulls_repeats_and_no_documents(spark, make_documents, tmp_path):
    spark.createDataFrame([(1, 1, 0), (None, None, None), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(k, sentence(k, 70), f"s{k % 2}") for k in range(6)] + [(0, sentence(0, 70), "s0"), (9, None, None), (None, "", "s1"), (10, sentence(3, 70), "s1")]
    for given in (rows, []):
        docs = make_documents(given)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        pieces = docs.collect()
        taken = {source: sum(70 for r in pieces if r.piece == 0 and r.doc_id % 2 == source) for source in (0, 1)}
        # source s0 holds clean, distinct texts 0, 2, 4 and s1 holds 1, 3, 5; null, empty and repeated texts are gone
        assert {r.doc_id for r in pieces} <= {0, 1, 2, 3, 4, 5}
        # 420 words shared five to two: s0 takes 300 and s1 120, each to the nearest texts of 70 words
        assert taken == ({0: 280, 1: 140} if given else {0: 0, 1: 0})
