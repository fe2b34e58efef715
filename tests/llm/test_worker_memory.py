"""What a Python worker holds at a time: small Arrow batches, words in portions, one Python function in a stage."""

import numpy as np
import pyarrow as pa

from rillstream.llm import common, minhash, toxicity

SIZE = 200_000


def _largest_batch(docs):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["bytes"])

    return docs.mapInArrow(measure, "bytes long").agg({"bytes": "max"}).first()[0]


def test_batches_after_a_stored_table_are_small(spark):
    spark.conf.unset(common._BATCH)
    docs = spark.range(0, 64, 1, 1).selectExpr("id as doc_id", f"repeat('x', {SIZE}) as text")
    docs = common.stored(docs, "test-batches").coalesce(1)
    assert SIZE <= _largest_batch(docs) <= common.BATCH_BYTES + 2 * SIZE


def test_a_lower_bound_stays(spark):
    spark.conf.set(common._BATCH, 1000)
    try:
        common.small_batches(spark)
        assert spark.conf.get(common._BATCH).removesuffix("b") == "1000"
    finally:
        spark.conf.unset(common._BATCH)


def test_portions_of_words_give_the_same_numbers(monkeypatch):
    vocabulary = pa.array([b"\0cloud", b"rain", b"sun"], pa.binary())
    texts = ["Sun rain", None, "", "rain cloudy sun rain unseen", "sun", "", "clouded rain"]
    expected = [[3, 2], [], [], [2, 1, 3, 2, toxicity.RARE], [3], [], [1, 2]]
    assert [x.tolist() for x in toxicity.numbered(vocabulary, texts)] == expected
    monkeypatch.setattr(toxicity, "PORTION", 1)
    assert [x.tolist() for x in toxicity.numbered(vocabulary, texts)] == expected
    assert toxicity.numbered(vocabulary, []) == []
    assert all(x.dtype == np.int64 for x in toxicity.numbered(vocabulary, [None, ""]))


def test_shingle_sets_have_one_python_function_in_a_stage(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b  c d e f"), (3, "other words")], "doc_id long, text string")
    found = common.stored(minhash.classes(minhash.signatures(docs, 2)), "test-classes")
    sets = minhash.shingle_sets(docs, found.select("node", "k1", "k2"), 2)
    assert sorted(len(r["hashes"]) for r in sets.collect()) == [1, 5]
    assert "ArrowEvalPython" not in sets._jdf.queryExecution().executedPlan().toString()
