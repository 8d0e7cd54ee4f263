"""The pipeline, stage by stage, against plain versions of its decisions."""

import corpus_pipeline
from lakepnl.llm import decontaminate, simhash
from lakepnl.llm.text import saved


def test_stages(spark, sf, small):
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = saved(stage(spark, docs, sf), name)
        assert made.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"]: r["text"] for r in made.collect()}
        assert set(after) <= set(before)
        if name == "line_dedup":
            assert set(after) == set(before)
            assert all(set(after[k].split("\n")) <= set(before[k].split("\n")) for k in after)
            assert all(r["n_chars"] == len(r["text"]) for r in made.collect())
        else:
            assert all(after[k] == before[k] for k in after)
        if name == "near_dedup":
            groups = simhash.near_duplicates(docs).collect()
            assert set(after) == {r["component_id"] for r in groups}
        if name == "decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            left = decontaminate.overlaps(made, bench).where(decontaminate.contaminated())
            assert left.count() == 0 and after
        docs = made
    name, stage = corpus_pipeline.STAGES[-1]
    assert {r["doc_id"] for r in stage(spark, docs, sf).collect()} == set(after)


def test_odd_and_no_rows(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = saved(stage(spark, docs, sf), name)
            assert docs.count() or not made.count()
            if name != "best_fit_packing":
                assert made.columns == docs.columns


def test_near_dedup_keeps_one_of_repeated_rows(spark, sf, odd_docs):
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, odd_docs, sf).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 2, None, 5, 7, 8]))


def test_near_dedup_tells_rows_of_one_id_apart(spark, sf, small):
    """Ids that collide between sources: each text is judged by its own group."""
    texts = [r["text"] for r in small.where("length(text) > 500").orderBy("doc_id").limit(5).collect()]
    rows = [(1, texts[0]), (1, texts[1]), (0, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[2])]
    rows += [(4, texts[3]), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, df, sf).collect()]
    assert sorted(kept) == sorted([(0, texts[0]), (1, texts[1]), (3, texts[2]), *rows[-2:]])
