"""Near duplicates: SimHash fingerprints linked through covering locality-sensitive hashing.

Masks come from a linear code: bit ``i`` belongs to a non-zero vector m(i) of r + 1 bits, and the
mask of vector v keeps the bits with an odd <m(i), v>. Any r bits leave some v that is even on all of them, so a pair that
differs in at most r bits agrees in that masked table: no pair is missed.

A table entry that only one fingerprint has needs no further look. The fingerprints of the others are linked exactly
through the points within one bit of them (two fingerprints differ in at most two bits just if they share such a point).
A point has at most 65 fingerprints around it, and each is linked to the smallest only, so
neither a crowded table entry nor a large group of copies gives all pairs or one large task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import minhash
from .common import per_slice, stored
from .graphs import components

BITS = 64
RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes, as a signed 64-bit number: a bit is set if it is set in over half of them."""
    ones = np.zeros(BITS, np.int64)
    for block in range(0, len(hashes), 1 << 15):
        part = hashes[block:block + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text (A-Z lower-cased), as a signed 64-bit number.

    A bit is set if it is set in over half the shingle hashes. Null and texts without a word give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = ends[words_per_shingle - 1:] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    return of_hashes(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), "<u8", len(last)))


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; other columns are left out."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"],
                "fp": [fingerprint(text, words_per_shingle) for text in rows["text"]]}

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_slice(run, schema), "doc_id long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    vectors = range(1, 1 << (radius + 1))
    owner = [1 + i % len(vectors) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (owner[i] & v).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _around(fp: Column) -> Column:
    """The fingerprint and all points one bit away from it."""
    return F.array(fp, *(fp.bitwiseXOR(F.lit(_signed(1 << i)).cast("long")) for i in range(BITS)))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b), a > b, that connect just the fingerprints within ``radius`` (1 or 2) bits of each other.

    ``distinct`` has one column fp without repeats. For two bits links are stars around the smallest fingerprint
    next to a shared point; they connect what all pairs would connect.
    """
    if radius not in (1, 2):
        raise ValueError("fingerprints are linked within 1 or 2 bits; minhash.keep_one finds less similar texts")
    masks = covering_masks(radius)
    entries = distinct.select("fp", F.posexplode(F.array(*(
        F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks))).alias("t", "key"))
    # the smallest and the largest fingerprint of an entry differ just if it has two or more
    crowded = entries.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where(
        "lo < hi").select("t", "key")
    crowded = stored(crowded, "simhash-entries")
    found = entries.join(crowded, ["t", "key"]).select("fp").distinct()
    points = found.select("fp", F.explode(_around(F.col("fp"))).alias("point"))
    if radius == 1:
        return points.join(found.select(F.col("fp").alias("b")), F.col("point") == F.col("b")).where("fp > b").select(
            F.col("fp").alias("a"), "b")
    stars = points.groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(
        F.size("fps") > 1)  # at most 65 each
    return stars.select(F.element_at("fps", 1).alias("b"), F.explode("fps").alias("a")).where(
        "a > b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text, anything else).

    Rows whose fingerprints of ``words``-word shingles differ in at most ``radius`` bits are linked; component_id is the smallest
    doc_id that links reach. Null and empty texts have fingerprint zero and are linked like others.
    Rows that repeat a doc_id stay as rows; a null doc_id counts only where a component has no other.
    """
    rows = stored(fingerprints(docs, words), "simhash-rows")
    smallest = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    edges = stored(links(smallest.select("fp"), radius), "simhash-links")
    roots = components(edges)
    classes = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    classes = stored(classes, "simhash-roots")
    ids = stored(classes.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-ids")
    by_fp = stored(classes.join(ids, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = minhash.WORDS, similarity: float = minhash.SIMILARITY) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs`` (doc_id, text, anything else).

    Texts whose fingerprints of ``words``-word shingles differ in RADIUS bits at most are compared on their whole shingle sets and
    linked at the similarity. Alike texts may differ in more bits than tables can cover; MinHash bands find these among what is
    not linked yet. Which row of a group stays, ``minhash.keep_one`` says.
    """
    found = stored(minhash.classes(minhash.signatures(docs, words, of_hashes)), "simhash-classes")
    return minhash.survivors(docs, found, minhash.near_links(found, docs, words, similarity, close(found)))


def close(found: DataFrame) -> DataFrame:
    """Pairs (node, pivot) of ``found`` (node, n, fp) that connect the classes with words whose fingerprints differ in RADIUS bits at most."""
    spoken = found.where("n > 0")
    prints = stored(spoken.groupBy("fp").agg(F.min("node").alias("pivot")), "simhash-prints")
    same = spoken.select("node", "fp").join(prints, "fp").where("node <> pivot").select("node", "pivot")
    one = prints.select(F.col("fp").alias("a"), F.col("pivot").alias("node"))
    near = links(prints.select("fp")).join(one, "a").join(prints.withColumnRenamed("fp", "b"), "b")
    return same.union(near.select("node", "pivot"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

