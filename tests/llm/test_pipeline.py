"""The stages in order, each on what the one before it kept."""

import corpus_pipeline
from tests.conftest import TESTDATA
from tests.llm import brute


def test_pipeline(spark, tmp_path):
    sf_dir = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert kept[name].keys() <= before.keys()
        if name == "line_dedup":
            want = brute.line_dedup(sorted(before.items()), 100)
            assert kept[name] == {d: t for d, t in want.items() if t or not before[d]}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "near_dup":
            want = brute.near_components(sorted(before.items()), 5)
            assert kept[name].keys() == {d for d, (_, least) in want.items() if d == least}
        if name == "decontaminate":
            clean = {d for d, _, hit, _ in brute.contamination(before.items(), map(tuple, items)) if not hit}
            assert kept[name].keys() == clean
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept["decontaminate"].keys()


def test_near_dup_stage_takes_five_words(spark):
    rows = []
    for group, edits in enumerate((0, 3, 4, 5, 6)):  # of 200 words, apart from each other
        words = [f"g{group}w{i}" for i in range(200)]
        rows.append((2 * group, " ".join(words)))
        for k in range(edits):
            words[20 + 30 * k] = f"edit{k}"
        rows.append((2 * group + 1, " ".join(words)))
    kept = corpus_pipeline.near_dup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    by_four = {d for d, (_, least) in brute.near_components(rows).items() if d == least}
    want = {d for d, (_, least) in brute.near_components(rows, 5).items() if d == least}
    assert by_four < want
    assert {r.doc_id for r in kept.collect()} == want
