"""Line dedup: Bloom filters of lines seen once and twice, then exact confirmation of suspects.

Every task keeps two bit arrays per filter segment: bits of keys it has seen, and bits of keys it has
seen twice. Merged, ``twice = twice1 | twice2 | (once1 & once2)``, so a key of two documents is always in the
second filter. Only lines found there are shuffled, as digests, to be confirmed and to find the first
document. The filters' size follows the number of lines. The second filter is sent to the tasks in groups of segments of
about ``filter_bytes``, one after the other. With several groups the keys are first stored by group, where they arise,
so that each group is a pass over its own keys only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstream.session import fresh_path

from .common import per_slice, slices, stored

MIN_CHARS = 10
SPACE = b" \t\n\v\f\r"
SEGMENT_BITS = 1 << 20
BITS_PER_LINE = 16
FLUSH = 1 << 19
#: Documents without an id come after all others; equal texts without one are the same document.
NO_ID = (1 << 63) - 1
#: Bytes of the second filter, as bits, that the driver and a task hold at a time (one segment at least).
FILTER_BYTES = 128 << 20


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line, or None if it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _keys(text: str | None, min_chars: int) -> set[bytes]:
    found = {line_key(line, min_chars) for line in (text or "").encode().split(b"\n")}
    found.discard(None)
    return found  # type: ignore[return-value]


def _digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:16]


def _places(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash, and its two bit positions there."""
    low = (hashes & np.uint64(SEGMENT_BITS - 1)).astype(np.uint32)
    high = ((hashes >> np.uint64(20)) & np.uint64(SEGMENT_BITS - 1)).astype(np.uint32)
    return ((hashes >> np.uint64(40)) % np.uint64(segments)).astype(np.int64), np.stack([low, high], 1)


def _encode(positions: np.ndarray) -> bytes:
    """Positions as numbers where few, as bits where many; the first byte tells which."""
    positions = np.unique(positions.astype(np.uint32))
    if len(positions) * 4 < SEGMENT_BITS // 8:
        return b"n" + positions.tobytes()
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[positions] = 1
    return b"b" + np.packbits(bits).tobytes()


def _decode(data: bytes) -> np.ndarray:
    """The 0/1 array of a segment."""
    if data[:1] == b"b":
        return np.unpackbits(np.frombuffer(data, np.uint8, offset=1))
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[np.frombuffer(data, np.uint32, offset=1)] = 1
    return bits


def _filters(docs: DataFrame, segments: int, min_chars: int) -> DataFrame:
    """(segment, twice) of the merged filters; segments without a repeated key are left out."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("segment", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])

        def flush(held: list[int]) -> pa.RecordBatch:
            hashes, counts = np.unique(np.array(held, np.uint64), return_counts=True)
            segment, places = _places(hashes, segments)
            order = np.argsort(segment, kind="stable")
            names, begin = np.unique(segment[order], return_index=True)
            parts = [order[a:b] for a, b in zip(begin, [*begin[1:], len(order)])]
            return pa.RecordBatch.from_arrays([
                pa.array(names, pa.int64()),
                pa.array([_encode(places[p].ravel()) for p in parts], pa.binary()),
                pa.array([_encode(places[p[counts[p] > 1]].ravel()) for p in parts], pa.binary()),
            ], schema=schema)

        held: list[int] = []
        for part in slices(batches):
            for text in part.to_pydict()["text"]:
                held.extend(map(xxhash.xxh64_intdigest, _keys(text, min_chars)))
                if len(held) >= FLUSH:
                    yield flush(held)
                    held = []
        if held:
            yield flush(held)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        once = np.zeros(SEGMENT_BITS, np.uint8)
        twice = np.zeros(SEGMENT_BITS, np.uint8)
        for one, two in zip(rows["once"], rows["twice"]):
            more = _decode(one)
            twice |= _decode(two) | (once & more)
            once |= more
        places = np.flatnonzero(twice)
        return pd.DataFrame({"segment": rows["segment"][:1], "twice": [_encode(places)]})

    # a segment's rows are bounded: each task sends a key once, and a segment has few keys
    return docs.select("text").mapInArrow(partial, "segment long, once binary, twice binary").groupBy(
        "segment").applyInPandas(merge, "segment long, twice binary")


def _named(docs: DataFrame) -> list[Column]:
    """Columns (doc, part) that tell documents apart and order them."""
    doc = docs["doc_id"].cast("long")
    return [F.coalesce(doc, F.lit(NO_ID)).alias("doc"), F.when(doc.isNull(), F.xxhash64("text")).otherwise(0).alias("part")]


def _found(hashes: np.ndarray, segments: int, filters: dict[int, bytes], opened: dict[int, np.ndarray]) -> np.ndarray:
    """Which hashes the second filter holds; ``opened`` keeps its segments as bits."""
    out = np.zeros(len(hashes), bool)
    segment, places = _places(hashes, segments)
    for name in np.unique(segment):
        data = filters.get(int(name))
        if data is None:
            continue
        if name not in opened:
            opened[name] = np.frombuffer(data, np.uint8, offset=1) if data[:1] == b"b" else np.packbits(_decode(data))
        mine = np.flatnonzero(segment == name)
        at = places[mine]
        out[mine] = ((opened[name][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
    return out


def _sent(filters: DataFrame) -> Broadcast:
    """Filter segments, of which the caller bounds the size, for the tasks."""
    return filters.sparkSession.sparkContext.broadcast(
        {r["segment"]: bytes(r["twice"]) for r in filters.collect() if len(r["twice"]) > 1})


def _line_keys(docs: DataFrame, segments: int, groups: int, shared: Broadcast | None, min_chars: int) -> DataFrame:
    """(doc, part, hash, grp, digest) of the keys of each row, with ``shared`` only of those that the second filter holds."""
    schema = pa.schema([("doc", pa.int64()), ("part", pa.int64()), ("hash", pa.int64()), ("grp", pa.int64()), ("digest", pa.binary())])
    opened: dict[int, np.ndarray] = {}

    def run(rows: dict[str, list]) -> dict[str, list]:
        at: list[int] = []
        keys: list[bytes] = []
        for row, text in enumerate(rows["text"]):
            mine = _keys(text, min_chars)
            keys.extend(mine)
            at.extend([row] * len(mine))
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        kept = range(len(keys)) if shared is None else np.flatnonzero(_found(hashes, segments, shared.value, opened)).tolist()
        left = hashes[kept] if len(kept) else np.empty(0, np.uint64)
        return {"doc": [rows["doc"][at[i]] for i in kept], "part": [rows["part"][at[i]] for i in kept],
                "hash": left.view(np.int64), "grp": _places(left, segments)[0] % groups, "digest": [_digest(keys[i]) for i in kept]}

    return docs.select(*_named(docs), "text").mapInArrow(
        per_slice(run, schema), "doc long, part long, hash long, grp long, digest binary")


def _suspects(docs: DataFrame, segments: int, filters: DataFrame, min_chars: int, filter_bytes: int) -> DataFrame:
    """(doc, part, digest) of the keys that the second filter holds, once per row of ``docs``."""
    spark = docs.sparkSession
    held = filters.where(F.length("twice") > 1).count()  # a task opens each of these as bits
    groups = max(1, -(-held // max(1, filter_bytes * 8 // SEGMENT_BITS)))
    if groups == 1:
        return stored(_line_keys(docs, segments, 1, _sent(filters), min_chars).select("doc", "part", "digest"), "line-suspects")
    path, out = fresh_path(spark, "line-keys"), fresh_path(spark, "line-suspects")
    keys = _line_keys(docs, segments, groups, None, min_chars)
    keys.write.partitionBy("grp").parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    for group in range(groups):
        shared = _sent(filters.where(F.col("segment") % groups == group))
        opened: dict[int, np.ndarray] = {}

        def held(batches: Iterable[pa.RecordBatch], shared: Broadcast = shared,
                 opened: dict[int, np.ndarray] = opened) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(2).to_numpy().view(np.uint64)
                yield batch.filter(pa.array(_found(hashes, segments, shared.value, opened))).select(["doc", "part", "digest"])

        mine = keys.where(F.col("grp") == group).select("doc", "part", "hash", "digest")
        mine.mapInArrow(held, "doc long, part long, digest binary").write.parquet(f"{out}/grp={group}")
        shared.destroy()
    return spark.read.schema("doc long, part long, digest binary, grp long").parquet(out).drop("grp")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc, part, digests): the keys, as digests, whose lines each document loses."""
    lines = docs.select(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = max(64, -(-lines * BITS_PER_LINE // SEGMENT_BITS))
    filters = stored(_filters(docs, segments, min_chars), "line-filters")
    suspects = _suspects(docs, segments, filters, min_chars, filter_bytes)
    name = F.struct("doc", "part")
    first = suspects.groupBy("digest").agg(F.min(name).alias("first"), F.max(name).alias("last")).where(
        "first < last").select("digest", "first")
    first = stored(first, "line-firsts")
    losing = suspects.join(first, "digest").where(name != F.col("first"))
    return losing.groupBy("doc", "part").agg(F.collect_set("digest").alias("digests"))


def drop_repeated(docs: DataFrame, min_chars: int = MIN_CHARS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``docs`` (doc_id, text, …) with the lines left in ``text``, and n_lines, n_dropped.

    Null and empty texts have one empty line. Rows that repeat a doc_id are parts of one
    document. Rows without one are documents that come last, in the order of a hash of their texts; those with
    equal texts are one document. Other columns stay as they are; columns called n_lines or n_dropped are
    replaced, and no column may be called __doc, __part, __digests or __cut.
    """
    lost = repeated_lines(docs, min_chars, filter_bytes).select(
        F.col("doc").alias("__doc"), F.col("part").alias("__part"), F.col("digests").alias("__digests"))

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut(texts: pd.Series, digests: pd.Series) -> pd.DataFrame:
        out = []
        for text, drop in zip(texts, digests):
            lines = (text or "").encode().split(b"\n")
            if drop is None or not len(drop):
                out.append((text or "", len(lines), 0))
                continue
            gone = {bytes(d) for d in drop}
            keys = (line_key(line, min_chars) for line in lines)
            left = [line for line, key in zip(lines, keys) if key is None or _digest(key) not in gone]
            out.append((b"\n".join(left).decode(), len(lines), len(lines) - len(left)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    doc, part = _named(docs)
    rows = docs.select(*columns).join(lost, (doc == F.col("__doc")) & (part == F.col("__part")), "left")
    rows = rows.withColumn("__cut", cut("text", "__digests"))
    return rows.select(*(F.col("__cut.text").alias("text") if c == "text" else F.col(c) for c in columns),
                       "__cut.n_lines", "__cut.n_dropped")
