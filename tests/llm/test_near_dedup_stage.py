"""The near-dedup stage takes its first candidates from SimHash fingerprints."""

from __future__ import annotations

import random

from rillstream.llm import minhash, simhash


def test_stage_compares_close_fingerprints_first(spark, monkeypatch):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(400)) for _ in range(3)]
    texts = [t for b in base for t in (b, b + " end", "start " + b)] + ["one", "", None, "  ", "quite another text of some words"]
    handed, real = [], minhash.near_links

    def spy(found, docs, words, similarity, before):
        prints = {r["node"]: r["fp"] for r in found.collect() if r["n"]}
        handed.append((prints, [(r["node"], r["pivot"]) for r in before.collect()]))
        return real(found, docs, words, similarity, before)

    monkeypatch.setattr(minhash, "near_links", spy)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = simhash.keep_one(frame)
    (prints, pairs), = handed
    root = {n: n for n in prints}
    for a, b in pairs:
        assert ((prints[a] ^ prints[b]) % 2**64).bit_count() <= simhash.RADIUS
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    close = [(a, b) for a in prints for b in prints if a < b and ((prints[a] ^ prints[b]) % 2**64).bit_count() <= simhash.RADIUS]
    assert close and all(root[a] == root[b] for a, b in close)
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(["0", "3", "6", "9", "10", "13"])
