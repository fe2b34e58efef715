"""What toxicity sends to the tasks, and how many pairs near dedup lists."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from rillstream.llm import minhash, toxicity


def test_words_are_looked_up_at_once():
    vocabulary = pa.array(sorted([b"bread", b"river", "жгучая".encode(), toxicity.GROUP + b"light", toxicity.GROUP + b"river"]), pa.binary())
    ids = {word: i + 1 for i, word in enumerate(vocabulary.to_pylist())}
    texts = ["River, bread bread lighthouse", None, "", "nothing", "lights Жгучая riverside", "..."]
    want = [[ids.get(w) or ids.get(toxicity.GROUP + toxicity.stem_of(w), toxicity.RARE) for w in toxicity.words_of(t)] for t in texts]
    assert [x.tolist() for x in toxicity.numbered(vocabulary, texts)] == want
    assert [x.tolist() for x in toxicity.numbered(pa.array([], pa.binary()), texts)] == [[0] * len(w) for w in want]
    assert toxicity.numbered(vocabulary, []) == []


def test_sent_model_holds_only_what_scores_need(spark):
    rng = random.Random(4)
    rows = [(i, " ".join([*(rng.choice("the of and river".split()) for _ in range(30)), f"seldom{i}", f"other{i}"])) for i in range(300)]
    docs = spark.createDataFrame(rows + [(1000 + i, "the " * 200_000) for i in range(2)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 // 2) for i in range(300)], "doc_id long, toxic int")
    sent = toxicity.fitted(docs, labels)[0].value
    assert set(sent.__dict__) == {"words", "single", "stands", "size", "standing", "weight", "pairs", "pair"}
    # seldom words stand as their stems: their own entries are not sent
    assert len(sent.standing) == len(sent.weight) == sent.size == len(np.unique(sent.stands)) < len(sent.words) / 2


def test_parities_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (3, 150, 5000):
        a, b = (rng.integers(0, 1 << 63, n, np.uint64) for _ in range(2))
        both = rng.integers(0, 1 << 63, n, np.uint64)
        x, y = (np.array(minhash.parities(np.unique(np.concatenate([both, z]))), np.int64).view(np.uint64) for z in (a, b))
        odd = sum(int(v).bit_count() for v in x ^ y)
        assert len(x) == minhash.PARITY_BITS // 64 and 0 < odd <= 2 * n
