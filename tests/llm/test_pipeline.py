from temblor.config import shared_dir
from tests.llm.conftest import ODD

import corpus_pipeline


def test_stages_on_small_tables(spark):
    """Each stage's decision, on documents made for it."""
    folder = shared_dir(spark, "pipeline-test")
    words = [f"alpha{k} beta{k} of" for k in range(60)]
    clean, other = " ".join(words), " ".join(f"gamma{k} the delta{k}" for k in range(60))
    passage = " ".join(f"exam{k} is" for k in range(20))
    rows = [
        (1, clean), (2, clean), (3, clean.replace("alpha7 ", "changed ")), (4, other + " mail a.b@example.com"),
        (5, passage + " " + " ".join(f"tail{k}" for k in range(30))), (6, "too short"), (7, "same words again " * 40), (8, None),
    ]
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, kept = table, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
        assert docs.columns == table.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["quality_rules"]) == {1, 2, 3, 4, 5}
    assert set(kept["near_duplicates"]) == {1, 4, 5}
    assert set(kept["decontaminate"]) == {1, 4}
    assert kept["mask_pii"] == {1: clean, 4: other + " mail [EMAIL]"}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == {1, 4} and len({p.sequence_id for p in pieces}) == 1


def test_odd_rows_pass_through_every_stage(spark):
    folder = shared_dir(spark, "pipeline-test")
    table = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for docs in (table, table.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, folder).count() >= 0
