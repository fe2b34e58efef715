"""Merkle manifest, periodic runs, MinHash near copies, and toxicity with labels of one class, against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from rillstream.llm import merkle, minhash, queries, runs, simhash, toxicity  # noqa: E402

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, n long, node long, path string,"
          " k1 long, runs string, __at long, key string")
ROWS = [(5, "a b", "en"), (None, "no id", "en"), (None, "no id", "en"), (3, None, None), (3, "", None), (3, "", None), (9, "é ü", ""),
        (7, "x " * 20_000, "en"), (1, "one", "de"), *((100 + i, f"text {i}", "en") for i in range(40)), (2, "z", "é"), (4, "z", "zz")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, g, None, None, "g", 1, 1, 1, "p", 1, "r", 1, "k") for d, t, g in ROWS], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, arity):
    """Root and a path of (left, right) for every node."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place - place % arity
            paths[i].append(("".join(nodes[first:place]), "".join(nodes[place + 1:first + arity])))
        nodes = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        at = [place // arity for place in at]
    return nodes[0], paths


@pytest.mark.parametrize("arity,levels", [(2, 6), (2, 2), (3, 1), (4, 2)])
def test_manifest(odd, empty, arity, levels):
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for d, t, g in ROWS:
        groups[g].append((d is not None, d or 0, h(*map(framed, (d, None, g, None, t))), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {g: tree([leaf for _, _, leaf, _ in sorted(groups[g], key=lambda x: x[:3])], arity) for g in names}
    root, outer = tree([inner[g][0] for g in names], arity)
    expected = sorted((str(d), leaf, inner[g][0], root, tuple(inner[g][1][i] + outer[names.index(g)]))
                      for g in names for i, (_, _, leaf, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])))
    out = merkle.manifest(odd, arity=arity, levels=levels)
    got = out.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in got) == expected
    assert all(r["folded"] == root for r in got)
    assert merkle.manifest(empty, arity=arity, levels=levels).count() == 0


def plain_runs(words, least=24):
    out, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, 3 * q):
                out.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_made_texts(seed):
    """Periods of all scales, also of parts that are periodic themselves."""
    rng, texts = random.Random(seed), []
    for _ in range(24):
        words, letters = [], rng.choice([1, 2, 3, 20, 1000])
        while len(words) < rng.choice([50, 700, 1500]):
            period, base = rng.choice([1, 2, 5, 30, 47, 48, 49, 71, 72, 73, 107, 108, 161, 162, 200, 243]), []
            while len(base) < period:
                base += [str(rng.randrange(letters)) for _ in range(rng.randint(1, 6))] * rng.choice([1, 1, 2, 30])
            words += (base[:period] * 6)[:rng.randint(2 * period, 5 * period)] + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 3))]
        texts.append(words)
    long_ones = 0
    for words, (read, found) in zip(texts, runs.text_runs([" ".join(w) for w in texts])):
        assert read == [w.encode() for w in words] and found == plain_runs(words)
        long_ones += sum(r[2] >= runs.SHORT for r in found)
    assert long_ones > 5


def test_runs_of_odd_rows(odd, empty):
    got = {(r["doc_id"], r["n_words"]): r for r in runs.periodic_runs(odd).collect()}
    assert runs.periodic_runs(odd).count() == len(ROWS) and runs.periodic_runs(empty).count() == 0
    assert [tuple(x) for x in got[7, 20_000]["runs"]] == [(0, 20_000, 1)] and got[7, 20_000]["collapsed"] == "x"
    assert got[3, 0]["runs"] == [] and got[3, 0]["collapsed"] == ""
    with pytest.raises(ValueError):
        runs.periodic_runs(odd, 25)


def test_runs_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    seen = 0
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = brute.WORDS.findall(r["text"] or "")
        value = zlib.crc32(str(r["doc_id"]).encode())
        if value % 10 == 0 and words:
            a = value // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + value // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if len(words) > 4000:
            continue
        found = plain_runs(words)
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        assert got[r["doc_id"]] == (
            len(found), *best, 1000 * best[1] // best[2] if found else None, brute.sha("".join("%d,%d,%d\n" % x for x in found)),
            brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
        seen += len(found)
    assert seen > 5


def plain_near(docs, words, percent=80):
    """[(shingles, root)] by comparing all rows."""
    sets = []
    for _, text in docs:
        w = brute.WORDS.findall((text or "").translate(brute.LOWER))
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if one and 100 * min(len(one), len(sets[j])) >= percent * max(len(one), len(sets[j])):
                both = len(one & sets[j])
                if 100 * both >= percent * (len(one) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def crowd(seed, count, changes):
    """Copies of one text with random words changed: alike in part, chained in part."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    out = []
    for _ in range(count):
        mine = list(base)
        for at in rng.sample(range(150), rng.choice(changes)):
            mine[at] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(mine))
    return out


@pytest.mark.parametrize("words,changes", [(2, [2, 5, 8, 9, 10, 14]), (5, [1, 2, 3, 4, 5])])
def test_near_copies_against_all_pairs(spark, words, changes):
    texts = crowd(1, 160, changes) + crowd(2, 60, changes) + ["", None, "  ", "one", "ONE", "One two", "one  TWO", "one two three"]
    docs = [(1000 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, None), (7, texts[3])]
    plain = plain_near(docs, words)
    least = defaultdict(list)
    for (d, _), (n, root) in zip(docs, plain):
        least[root] += [d] if d is not None else []
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = sorted((str(d), n, str(min(least[root])) if n else str(d)) for (d, _), (n, root) in zip(docs, plain))
    got = minhash.near_duplicates(frame, words, 0.8).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    groups = len({root for n, root in plain if n}) + 1  # texts without a word are one class
    assert minhash.keep_one(frame, words, 0.8).count() == groups


def test_near_copies_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    want = {d: (n, docs[root][0]) for (d, _), (n, root) in zip(docs, plain_near(docs, 2))}
    got = queries.op12_minhash_near_dedup(spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_stage_is_exhaustive_at_five_words(spark):
    frame = spark.read.parquet(f"{LARGER}/documents.parquet")
    docs = [tuple(r) for r in frame.select("doc_id", "text").orderBy("doc_id").collect()]
    want = {docs[root][0] for _, root in plain_near(docs, 5)}
    assert {r["doc_id"] for r in simhash.keep_one(frame).select("doc_id").collect()} == want


def test_near_copies_of_odd_rows(odd, empty, monkeypatch):
    for sent in (minhash.SENT_KEYS, 0):  # by broadcast, by shuffle
        monkeypatch.setattr(minhash, "SENT_KEYS", sent)
        assert minhash.near_duplicates(odd, 2, 0.8).count() == len(ROWS)
        kept = minhash.keep_one(odd)
        assert kept.columns == odd.columns
        assert sorted((str(r["doc_id"]) for r in kept.collect()), key=str) == sorted(
            str(d) for d in ({d for d, t, _ in ROWS if t != "z"} | {2}))
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_odd_sketches_tell_the_similarity():
    rng = np.random.default_rng(3)
    for similarity in (0.8, 0.9, 0.95):
        counts = []
        for _ in range(60):
            shared = int(2 * similarity / (1 + similarity) * 400)
            one, other = (rng.integers(0, 1 << 63, 400 - shared, np.uint64) for _ in range(2))
            both = rng.integers(0, 1 << 63, shared, np.uint64)
            a, b = (np.array(minhash.odd_sketch(minhash.minima(np.concatenate([both, x]))), np.int64) for x in (one, other))
            counts.append(int(sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))))
        mean, deviation = minhash.odd_bits(similarity)
        assert abs(np.mean(counts) - mean) < deviation and max(counts) <= minhash.most_odd_bits(similarity)
    assert minhash.most_odd_bits(0.8) < minhash.odd_bits(0.3)[0]


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_class_remove_nothing(spark, label):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice("the of and bread river stone light walk".split()) for _ in range(30))) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 200 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in got)
    assert toxicity.keep_ordinary(docs, labels).count() == 200


def test_pattern_of_words_is_that_of_the_contract():
    text = "a\x0bb\x1cc\td e f"
    assert [w.decode() for w in text.encode().split()] == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_toxicity_by_one_word(spark):
    """Texts that differ in one word only, beyond ASCII; an unseen word of its stem leans the same way."""
    text = lambda i: " ".join(f"w{(i * 7 + j * j) % 40}" for j in range(30))
    plain, toxic = [(i, text(i)) for i in range(300)], [(1000 + i, text(i) + " жгучая") for i in range(100)]
    docs = spark.createDataFrame([*plain, *toxic, (5000, text(3) + " жгучая"), (5001, text(3)), (5002, text(3) + " жгучий")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d >= 1000)) for d, _ in (*plain, *toxic)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, labels).collect()}
    assert got[5000] >= 0.5 > got[5001]
    assert got[5002] > got[5001]
