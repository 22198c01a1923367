"""How many texts a Python worker gets at once."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tagmatch.llm import near_dup, packing, quality
from tagmatch.sources.shared import BATCH, TEXTS_AT_ONCE, small_batches


@pytest.mark.parametrize(("module", "stage"), [(near_dup, "near_dup"), (packing, "packing")])
def test_jobs_over_texts_run_with_small_batches(spark, monkeypatch, module, stage):
    seen, stored, before = [], module.stored, spark.conf.get(BATCH)

    def noted(df, name):
        seen.append(int(spark.conf.get(BATCH)))
        return stored(df, name)

    monkeypatch.setattr(module, "stored", noted)
    rows = [(i, f"{i // 2} {'one two three four five six seven ' * 3}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, "").count() >= 3
    assert seen and max(seen) <= TEXTS_AT_ONCE
    assert spark.conf.get(BATCH) == before


@pytest.mark.parametrize(("set_to", "want"), [("10000", TEXTS_AT_ONCE), ("0", TEXTS_AT_ONCE), ("7", 7)])
def test_smaller_batches_of_the_session_stay(spark, set_to, want):
    before = spark.conf.get(BATCH)
    try:
        spark.conf.set(BATCH, set_to)
        with pytest.raises(KeyError), small_batches(spark):
            assert int(spark.conf.get(BATCH)) == want
            raise KeyError
        assert spark.conf.get(BATCH) == set_to
    finally:
        spark.conf.set(BATCH, before)


def test_quality_measures_a_large_batch_few_texts_at_once():
    n = 2 * TEXTS_AT_ONCE + 3
    texts = [None if i % 7 == 0 else f"the {i} and # of\nthe {i % 5}\nthe {i % 5}" for i in range(n)]
    langs = [None if i % 3 == 0 else "en" for i in range(n)]
    counts = np.arange(quality.CLASSES + len(quality.VOCABULARY) + 1)
    references = quality.References({"en": 5, None: 2}, counts[None, :], {None: counts[::-1]})
    measure = quality._features(references).func
    parts = list(measure(iter([(pa.array(texts), pa.array(langs))])))
    assert [len(p) for p in parts] == [TEXTS_AT_ONCE, TEXTS_AT_ONCE, 3]
    alone = measure((pa.array([t], pa.string()), pa.array([g], pa.string())) for t, g in zip(texts, langs))
    assert [r for p in parts for r in p.to_pylist()] == [r for p in alone for r in p.to_pylist()]
