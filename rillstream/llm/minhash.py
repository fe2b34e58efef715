"""Near copies by the Jaccard similarity of word shingles: MinHash bands, odd sketches, then exact confirmation on whole sets.

A class is all rows with the same words (A-Z lower-cased, white space as one blank); its key is a 128-bit hash of them. Per class
BANDS bucket numbers come from BANDS x BAND_ROWS minima of its shingle hashes. Two classes of similarity s share a bucket with probability
1 - (1 - s^5)^32: 0.999997 at 0.8, more above. The same minima are folded into an odd sketch: each flips one of SKETCH_BITS
bits. The minima that two classes do not share flip the bits of the exclusive or of their sketches, so its population count
tells how many those are, the more exactly the fewer. Candidates with more odd bits than a pair at the wanted similarity has
(with six standard deviations to spare) are dropped, and of the others the one with the fewest is compared first.

Buckets compare their members with a pivot, first each with the pivot most like it, then those not in its component yet, and in
further turns with other pivots where a bucket still holds several components. What is left there is refined by rare shingles: two sets of
similarity s share one of their ceil((1 - s) n) + 1 rarest shingles (prefix filter), so only classes that share
such a shingle and are in different components are compared pair by pair. Of these a pair is listed only where two exact bounds allow the
similarity: the shingles that follow the shared one, and the parities of the sets: each shingle flips one of PARITY_BITS bits, and sets
that differ in d shingles differ in d of these bits at most.
"""

from __future__ import annotations

from collections.abc import Callable
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_slice, stored
from .graphs import components

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
BAND_ROWS = 5
SKETCH_BITS = 256
PARITY_BITS = 1024
SEED = 42
#: Keys of classes that are sent to every task at most (some 100 MB); more are joined by a shuffle.
SENT_KEYS = 1 << 20
_DRAWN = np.random.default_rng(SEED)
FACTORS = _DRAWN.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), np.uint64, endpoint=False) | np.uint64(1)
OFFSETS = _DRAWN.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), np.uint64, endpoint=False)
#: Every turn of pivots ranks the nodes by another order.
TURNS = [0, *(int(x) for x in _DRAWN.integers(1 << 20, 1 << 62, 3))]
SALTS = _DRAWN.integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64, endpoint=False)


def spoken(text: str | None) -> bytes:
    """The words of a text, A-Z lower-cased, with one blank between them."""
    return b" ".join((text or "").encode().lower().split())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def key_of(words_of_text: bytes) -> tuple[int, int]:
    """128 bits that stand for the words of a text."""
    value = xxhash.xxh3_128_intdigest(words_of_text, SEED)
    return _signed(value >> 64), _signed(value & (1 << 64) - 1)


def keys(text: Column) -> Column:
    """(k1, k2) of a text column."""

    @F.pandas_udf("k1 long, k2 long")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([key_of(spoken(text)) for text in texts], columns=["k1", "k2"], dtype="int64")

    return run(text)


def hashes_of(words_of_text: bytes, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the word shingles of ``spoken`` words, repeats included; fewer words are one shingle, none gives none."""
    if not words_of_text:
        return np.empty(0, np.uint64)
    ends = [*(np.flatnonzero(np.frombuffer(words_of_text, np.uint8) == 32).tolist()), len(words_of_text)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(words_of_text[a:b], SEED) for a, b in zip(starts, ends[words - 1:] or ends[-1:])], np.uint64)


def shingles(words_of_text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct ``hashes_of`` a text, ascending."""
    return np.unique(hashes_of(words_of_text, words))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each MinHash function; ``hashes`` must not be empty."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        np.minimum(least, (hashes[None, at:at + (1 << 10)] * FACTORS + OFFSETS).min(axis=1), out=least)
    return least


def buckets(least: np.ndarray) -> list[int]:
    """The bucket number of every band."""
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(bands)], np.uint64).view(np.int64).tolist()


def odd_sketch(least: np.ndarray) -> list[int]:
    """SKETCH_BITS bits as 64-bit numbers; a bit is set if an odd number of minima fall on it."""
    mixed = (least ^ SALTS) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    odd = np.bincount((mixed >> np.uint64(56)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def parities(hashes: np.ndarray) -> list[int]:
    """PARITY_BITS bits as 64-bit numbers; a bit is set if an odd number of the shingles fall on it."""
    odd = np.bincount((hashes % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def odd_bits(similarity: float) -> tuple[float, float]:
    """Expected population count of the exclusive or of two sketches at a similarity, and its standard deviation."""
    samples = BANDS * BAND_ROWS
    apart = 2 * samples * (1 - similarity)
    same = (1 - 2 / SKETCH_BITS) ** apart
    drawn = 2 * sqrt(samples * similarity * (1 - similarity)) * same
    return SKETCH_BITS * (1 - same) / 2, sqrt(drawn ** 2 + SKETCH_BITS * (1 - same ** 2) / 4)


def most_odd_bits(similarity: float) -> int:
    """The most odd bits with which a pair is still compared; the chance that an alike pair has more is about 1e-9."""
    mean, deviation = odd_bits(similarity)
    return int(min(SKETCH_BITS, mean + 6 * deviation + 1))


def similar(n: Column, m: Column, both: Column, similarity: float) -> Column:
    return both.cast("double") >= F.lit(similarity) * (n + m - both) - 1e-9


def signatures(docs: DataFrame, words: int = WORDS, fingerprint: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """(doc_id, k1, k2, n, buckets, sketch) of every row: distinct shingles, bucket numbers and odd sketch.

    ``fingerprint`` adds a column fp, made from the ``hashes_of`` each text.
    """
    fields = [("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()),
              ("buckets", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
    columns = "doc_id long, k1 long, k2 long, n long, buckets array<long>, sketch array<long>"
    if fingerprint:
        fields, columns = [*fields, ("fp", pa.int64())], columns + ", fp long"

    def run(rows: dict[str, list]) -> dict[str, list]:
        said = [spoken(text) for text in rows["text"]]
        every = [hashes_of(x, words) for x in said]
        found = [np.unique(x) for x in every]
        least = [minima(f) if len(f) else None for f in found]
        k1, k2 = zip(*map(key_of, said))
        return {"doc_id": rows["doc_id"], "k1": k1, "k2": k2, "n": [len(f) for f in found],
                "buckets": [buckets(x) if x is not None else [] for x in least],
                "sketch": [odd_sketch(x) if x is not None else [] for x in least]} | (
                    {"fp": [fingerprint(x) for x in every]} if fingerprint else {})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_slice(run, pa.schema(fields)), columns)


def classes(rows: DataFrame) -> DataFrame:
    """(node, k1, k2, first, copies, n, buckets, sketch, fp if there) of every class of ``signatures``, numbered: its smallest doc_id and its rows."""
    same = [F.first(c).alias(c) for c in rows.columns if c not in ("doc_id", "k1", "k2")]
    return rows.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), *same).withColumn("node", F.monotonically_increasing_id())


def bounded(keys: DataFrame) -> DataFrame:
    """``keys``, to be sent to the tasks where they are few enough (see SENT_KEYS), else to be joined by a shuffle."""
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, hashes, parity): the shingles of the classes ``wanted`` (node, k1, k2) and their ``parities``."""
    fields = [("node", pa.int64()), ("hashes", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))]

    def run(rows: dict[str, list]) -> dict[str, list]:
        found = [shingles(spoken(text), words) for text in rows["text"]]
        return {"node": rows["node"], "hashes": [x.view(np.int64) for x in found], "parity": [parities(x) for x in found]}

    texts = docs.select("text", keys(F.col("text")).alias("key")).select("text", "key.*").join(
        bounded(wanted), ["k1", "k2"]).select("node", "text")
    # two Python functions in a stage would keep two workers for each core
    texts = stored(texts, "near-texts")
    # copies in a partition give one row; their sets are the same
    return texts.mapInArrow(per_slice(run, pa.schema(fields)), "node long, hashes array<long>, parity array<long>").groupBy("node").agg(
        F.first("hashes").alias("hashes"), F.first("parity").alias("parity"))


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of the given ones whose shingle sets have the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    met = pairs.select("a", "b").join(one, "a").join(other, "b")
    return met.where(similar(F.size("x"), F.size("y"), both, similarity)).select("a", "b")


def _starred(members: DataFrame, bucket: str, turn: int) -> DataFrame:
    """(``bucket``, node, pivot, size) of members (``bucket``, node) beside the pivot of their bucket.

    In one turn all buckets rank nodes alike, so buckets with the same members have the same pivot; another turn ranks them anew.
    """
    drawn = F.col("node").bitwiseXOR(F.lit(TURNS[turn]))
    pivots = members.groupBy(bucket).agg(F.min(drawn).alias("lo"), F.max(drawn).alias("hi"), F.count("*").alias("size")).where(
        "lo < hi").select(bucket, F.col("lo").bitwiseXOR(F.lit(TURNS[turn])).alias("pivot"), "size")
    return stored(members.join(stored(pivots, "near-pivots"), bucket).where("node <> pivot"), "near-members")


def _odd(one: str, other: str, bits: int = SKETCH_BITS) -> Column:
    """Population count of the exclusive or of two sketches."""
    return sum((F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))) for i in range(bits // 64)), F.lit(0))


def _likely(pairs: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, pivot) whose sizes and sketches allow the similarity, with their ``odd`` bits."""
    other = found.select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    met = pairs.join(found.select("node", "n", "sketch"), "node").join(other, "pivot")
    fits = F.least("n", "m") >= F.lit(similarity) * F.greatest("n", "m") - 1e-9
    return met.where(fits).select("node", "pivot", _odd("sketch", "other").alias("odd")).where(F.col("odd") <= most_odd_bits(similarity))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (node, pivot, …) that are in different components."""
    mine = pairs.join(roots.select("node", F.col("root").alias("__mine")), "node", "left")
    both = mine.join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("__other")), "pivot", "left")
    return both.where(F.coalesce("__mine", "node") != F.coalesce("__other", "pivot")).drop("__mine", "__other")


def _mixed(members: DataFrame, roots: DataFrame, bucket: str) -> DataFrame:
    """The members (``bucket``, node) of buckets that hold several components, with their ``root``."""
    placed = stored(members.join(roots, "node", "left").select(bucket, "node", F.coalesce("root", "node").alias("root")), "near-placed")
    several = placed.groupBy(bucket).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select(bucket)
    return stored(placed.join(stored(several, "near-mixed"), bucket, "left_semi"), "near-open")


def near_links(found: DataFrame, docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
               before: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between nodes of ``found`` (see ``classes``) that connect what all alike pairs that share a bucket would connect.

    ``before``: pairs (node, pivot) that another search has found; they are confirmed first.
    """
    members = _starred(found.select(F.explode("buckets").alias("bucket"), "node"), "bucket", 0)
    stars = stored(_likely(members.select("node", "pivot").distinct(), found, similarity), "near-stars")
    # a bucket of two is decided by its one pair
    crowd = members.where("size > 2").select("bucket", "node")
    named = stars.select("node").union(stars.select("pivot")).union(crowd.select("node"))
    if before is not None:
        before = stored(_likely(before, found, similarity).select("node", "pivot"), "near-before")
        named = named.union(before.select("node")).union(before.select("pivot"))
    named = named.distinct()
    wanted = stored(found.select("node", "k1", "k2").join(named, "node", "left_semi"), "near-wanted")
    sets = stored(shingle_sets(docs, wanted, words), "near-sets")

    def tried(edges: DataFrame | None, pairs: DataFrame) -> DataFrame:
        links = confirmed(pairs.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct(),
                          sets, similarity)
        return stored(links if edges is None else edges.union(links), "near-links")

    edges = tried(None, before) if before is not None else None
    edges = tried(edges, stars.groupBy("node").agg(F.min_by("pivot", "odd").alias("pivot")))
    edges = tried(edges, stored(_apart(stars, components(edges)), "near-apart"))
    for turn in range(1, len(TURNS)):
        roots = components(edges)
        again = _starred(_mixed(crowd, roots, "bucket").select("bucket", "node"), "bucket", turn).select("node", "pivot").distinct()
        edges = tried(edges, stored(_apart(_likely(again, found, similarity), roots), "near-apart"))

    # what pivots did not decide: members of crowded buckets in different components, by their rare shingles
    roots = components(edges)
    open_ = _mixed(crowd, roots, "bucket").select("node").distinct()
    tokens = stored(sets.join(stored(open_, "near-open-nodes"), "node", "left_semi").select(
        "node", F.explode("hashes").alias("token")), "near-tokens")
    spread = tokens.join(stored(tokens.groupBy("token").agg(F.count("*").alias("texts")), "near-token-counts"), "token")
    ranked = spread.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("texts", "token"))).alias("ranked"))
    n = F.size("ranked")
    # of a pair the smaller set needs the shorter prefix: the two share at least 2 s / (1 + s) of its shingles
    longer, shorter = (n - F.ceil(F.lit(share) * n - 1e-9).cast("int") + 1 for share in (similarity, 2 * similarity / (1 + similarity)))
    rare = ranked.select("node", n.alias("n"), shorter.alias("shorter"), F.posexplode(F.slice("ranked", F.lit(1), longer)).alias("place", "r"))
    rare = stored(rare.where("r.texts > 1").select(F.col("r.token").alias("token"), "node", "n", "place", F.expr("place < shorter").alias("short")),
                  "near-rare")
    left = _mixed(rare.select("token", "node"), roots, "token").join(rare, ["token", "node"]).join(
        found.select("node", "sketch"), "node").join(sets.select("node", "parity"), "node")
    other = left.where("short").select("token", F.col("node").alias("pivot"), F.col("root").alias("other_root"), F.col("n").alias("m"),
                                       F.col("place").alias("other_place"), F.col("sketch").alias("other"), F.col("parity").alias("other_parity"))
    # the shingles an alike pair shares at least; the first it shares has this many after it, itself included, in both
    shared = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("m")) - 1e-9)
    last = left.join(other, "token").where("root <> other_root and (n > m or n = m and node > pivot)").where(
        (F.col("m") >= F.lit(similarity) * F.col("n") - 1e-9) & (F.col("n") - F.col("place") >= shared)
        & (F.col("m") - F.col("other_place") >= shared) & (_odd("sketch", "other") <= most_odd_bits(similarity))
        & (_odd("parity", "other_parity", PARITY_BITS) <= F.col("n") + F.col("m") - 2 * shared))
    return tried(edges, stored(last.select("node", "pivot").distinct(), "near-last"))


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, anything else).

    Rows whose sets of ``words``-word shingles have at least the similarity are linked; component_id is the smallest doc_id that links
    reach. A text with fewer words is one shingle; null and empty texts have no shingles, are linked with nothing and are their own
    component. Rows that repeat a doc_id stay as rows; a null doc_id counts only where a component has no other. An empty table gives no rows.
    """
    signed = stored(signatures(docs, words), "near-rows")
    found = stored(classes(signed), "near-classes")
    roots = components(near_links(found, docs, words, similarity))
    rooted = stored(found.select("node", "k1", "k2", "first", "n").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), "near-roots")
    ids = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "near-ids")
    by_key = stored(rooted.join(ids, "root").select("k1", "k2", "n", "component_id"), "near-components")
    rows = signed.select("doc_id", "k1", "k2").join(by_key, ["k1", "k2"])
    return rows.select("doc_id", F.col("n").alias("n_shingles"),
                       F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each component of near copies, with the columns of ``docs`` (doc_id, text, anything else).

    Rows are linked by their words alone, never by doc_id. Of a component the row of the smallest doc_id stays (null comes last,
    then the smallest class); of rows that share this doc_id and the words one stays. Texts without a word are one class.
    Rows whose text no other row has or resembles are passed through; only the others meet the verdicts.
    """
    found = stored(classes(signatures(docs, words)), "near-classes")
    return survivors(docs, found, near_links(found, docs, words, similarity))


def survivors(docs: DataFrame, found: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by ``links`` between the classes ``found`` of its texts; see ``keep_one``."""
    roots = components(links)
    rooted = stored(found.select("node", "k1", "k2", "first", "copies").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), "near-roots")
    best = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("best")
    stays = stored(rooted.groupBy("root").agg(best).select(F.col("best.node").alias("node"), F.lit(True).alias("__stays")), "near-stays")
    judged = rooted.join(stays, "node", "left").where("copies > 1 or __stays is null").select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("first").alias("__first"), F.coalesce("__stays", F.lit(False)).alias("__stays"))
    judged = bounded(stored(judged, "near-judged"))
    rows = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": keys(F.col("text"))}).withColumns(
        {"__a": F.col("__key.k1"), "__b": F.col("__key.k2")}).drop("__key")
    rows = rows.join(judged, (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2")), "left").where(
        F.col("__stays").isNull() | (F.col("__stays") & F.col("__id").eqNullSafe(F.col("__first"))))
    if docs.groupBy("doc_id").count().where("count > 1").take(1):  # only then a document can stand in several rows of a class
        # rows of a class of one have a key of their own
        rows = rows.withColumn("__n", F.when(F.col("__stays"), F.lit(0)).otherwise(F.lit(1))).dropDuplicates(["__id", "__a", "__b", "__n"])
    return rows.select(*docs.columns)
