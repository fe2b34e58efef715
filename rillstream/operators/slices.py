"""Stream cuts and bounded slices of an event log.

A cut is one offset per segment. Slices are half open: start <= offset < end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .joins import events_in_slices
from .ordered import CHUNK_WIDTH, INDEX_WIDTH, Fold, block_of, block_starts, keyed_scan

Cut = Mapping[int, int]


def read_slice(log: DataFrame, start: Cut | None = None, end: Cut | None = None, *,
               others: bool = True) -> DataFrame:
    """Events between two known cuts; ``None`` (or a missing segment) is unbounded.

    Segments that neither cut names are read whole, or not at all with ``others=False``.
    The cuts become plain predicates that prune partitions by segment; without other segments
    the widest offset range also reaches the scan and skips row groups.
    """
    segments = sorted(set(start or {}) | set(end or {}))
    if not segments:
        return log if others else log.where(F.lit(False))
    keep: Column = ~F.col("segment_id").isin(segments) if others else F.lit(False)
    for segment in segments:
        inside = F.col("segment_id") == segment
        if start and segment in start:
            inside &= F.col("offset") >= start[segment]
        if end and segment in end:
            inside &= F.col("offset") < end[segment]
        keep = keep | inside
    out = log.where(keep)
    if not others and start and len(start) == len(segments):
        out = out.where(F.col("offset") >= min(start.values()))
    if not others and end and len(end) == len(segments):
        out = out.where(F.col("offset") < max(end.values()))
    return out


def read_slices(log: DataFrame, cuts: DataFrame) -> DataFrame:
    """Events of many streams, each within its own cut pair.

    ``cuts``: stream, segment_id, start_offset, end_offset (null = unbounded). A
    (stream, segment) without a row is not read. The cuts are stored first: the planner then knows their size
    and sends few of them to the scan by itself; where there are many, both sides of the join have plain exchanges,
    so adaptive execution splits busy segments.
    """
    spark = log.sparkSession
    path = fresh_path(spark, "cuts")
    cuts.select("stream", "segment_id", "start_offset", "end_offset").write.parquet(path)
    joined = log.join(spark.read.parquet(path), ["stream", "segment_id"])
    return joined.where(
        (F.col("start_offset").isNull() | (F.col("offset") >= F.col("start_offset")))
        & (F.col("end_offset").isNull() | (F.col("offset") < F.col("end_offset")))
    ).select(*log.columns)


def checkpoint_cut(log: DataFrame) -> DataFrame:
    """Next offset to read per stream and segment, after all rows of ``log``."""
    return log.groupBy("stream", "segment_id").agg((F.max("offset") + 1).alias("offset"))


def cuts_by_index(log: DataFrame, first: int, last: int, *, order: str = "offset",
                  width: int = INDEX_WIDTH) -> DataFrame:
    """Cut pair of every stream that encloses its events number ``first`` to ``last - 1``.

    The number counts the events of the stream in ``order``. If ``last`` lies past the end,
    the end is unbounded (null). The log is counted per block of ``width`` positions; only the blocks in which the two
    events lie, two per stream at most, are numbered row by row.
    """
    per = _stored(log.groupBy("stream", "segment_id", block_of(order, width).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")), "blocks")
    starts = _stored(block_starts(per, ["stream"], "block", "n"), "block-starts")

    def reached(place: str, offset: str) -> list[Column]:
        return [F.when(F.col(place) >= bound, F.col(offset)).alias(name)
                for name, bound in (("from", first), ("to", last))]

    def split(bound: int) -> Column:
        return (F.col("start") < bound) & (F.col("start") + F.col("n") > bound)

    rows = _numbered(log.select("stream", "segment_id", "offset", *([order] if order != "offset" else [])),
                     starts.where(split(first) | split(last)), order, width)
    whole = per.join(starts.drop("n"), ["stream", "block"]).select(
        "stream", "segment_id", *reached("start", "lo"), "hi")
    inner = rows.select("stream", "segment_id", *reached("i", "offset"), F.lit(None).cast("bigint").alias("hi"))
    per_segment = whole.unionByName(inner).groupBy("stream", "segment_id").agg(
        F.coalesce(F.min("from"), F.max("hi") + 1).alias("start_offset"),
        F.coalesce(F.min("to"), F.max("hi") + 1).alias("e"))
    sizes = starts.groupBy("stream").agg(F.sum("n").alias("events"))
    return per_segment.join(sizes, "stream").select(
        "stream", "segment_id", "start_offset",
        F.when(F.col("events") >= last, F.col("e")).alias("end_offset"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A small table, written once; the planner then knows its size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(log: DataFrame, starts: DataFrame, order: str, width: int) -> DataFrame:
    """The rows of the blocks in ``starts`` (stream, block, start) with their number ``i`` in the stream."""
    wanted = _stored(starts.select("stream", "block", "start").distinct(), "open-blocks")
    inside = Window.partitionBy("stream", "block").orderBy(order)
    return log.withColumn("block", block_of(order, width)).join(wanted, ["stream", "block"]).withColumn(
        "i", F.col("start") + F.row_number().over(inside) - 1)


def index_ranges(log: DataFrame, group: Column, *, width: int = INDEX_WIDTH) -> DataFrame:
    """First and one-past-last event number of each group (e.g. day) of a stream.

    Only the blocks of ``width`` positions that hold the first or the last event of a group are numbered row by row.
    """
    per = _stored(log.groupBy("stream", group.alias("grp"), block_of("offset", width).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")), "blocks")
    starts = block_starts(per, ["stream"], "block", "n")
    ends = _stored(per.groupBy("stream", "grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "group-ends")
    at = ends.select("stream", "grp", F.explode(F.array("lo", "hi")).alias("offset")).withColumn(
        "block", block_of("offset", width))
    rows = _numbered(log.select("stream", "offset"), starts.join(at, ["stream", "block"], "left_semi"), "offset", width)
    return rows.join(at.select("stream", "grp", "offset").distinct(), ["stream", "offset"]).groupBy("stream", "grp").agg(
        F.min("i").alias("first_index"), (F.max("i") + 1).alias("end_index"))


def slice_sums(log: DataFrame, cuts: DataFrame, field: int = 2) -> DataFrame:
    """Sum of one ``:``-separated integer field of the events inside the cuts, per stream."""
    value = F.element_at(F.split("event", ":"), field + 1).cast("int")
    return read_slices(log, cuts).groupBy("stream").agg(F.sum(value).alias("total"))


def segment_counts(log: DataFrame) -> DataFrame:
    """Events per segment of each stream, and per stream (segment_id null)."""
    per_segment = log.groupBy("stream", "segment_id").agg(F.count(F.lit(1)).alias("events"))
    per_stream = per_segment.groupBy("stream").agg(F.sum("events").alias("events"))
    return per_segment.unionByName(per_stream.withColumn("segment_id", F.lit(None).cast("int")))


def _bookmark_fold(flag: str, position: str) -> Fold:
    shape = "struct<closes:boolean,pending:bigint>"

    def make(closes: Column, pending: Column) -> Column:
        return F.struct(closes.alias("closes"), pending.alias("pending")).cast(shape)

    nothing = F.lit(None).cast("bigint")
    return Fold(
        initial=lambda: nothing,
        identity=lambda: make(F.lit(False), nothing),
        effect=lambda row: make(~row[flag], F.when(row[flag], row[position].cast("bigint"))),
        compose=lambda f, g: F.when(g["closes"], g).otherwise(
            make(f["closes"], F.coalesce(f["pending"], g["pending"]))),
        apply=lambda f, s: F.when(f["closes"], f["pending"]).otherwise(
            F.coalesce(s, f["pending"])),
        advance=lambda row, s: F.when(row[flag], F.coalesce(s, row[position].cast("bigint"))))


def bookmark_slices(events: DataFrame, key: str, position: str, of_interest: Column, *,
                    width: int = CHUNK_WIDTH) -> DataFrame:
    """Maximal runs of rows of interest per key, once a later row closes them.

    The slice starts at the first row of the run and ends at the closing row
    (exclusive). A run still open at the end of the data gives no slice.
    """
    # coalesce: a missing reading is of no interest
    flags = events.select(key, position, F.coalesce(of_interest, F.lit(False)).alias("hit"))
    walked = keyed_scan(flags, [key], position, _bookmark_fold("hit", position), width=width)
    return walked.where(~F.col("hit") & F.col("before").isNotNull()).select(
        key, F.col("before").alias("start_offset"), F.col(position).alias("end_offset"))


def _counting_fold(flag: str, counted: str, position: str) -> Fold:
    """State: position of the pending bookmark, rows counted in front of it, and rows counted so far."""
    state = "struct<pending:bigint,before:bigint,hits:bigint>"
    shape = "struct<closes:boolean,pending:bigint,before:bigint,hits:bigint>"

    def make(*fields: Column, kind: str = shape) -> Column:
        names = [f.split(":")[0] for f in kind[7:-1].split(",")]
        return F.struct(*[f.alias(n) for f, n in zip(fields, names)]).cast(kind)

    nothing, zero = F.lit(None), F.lit(0)

    def later(known: Column, first: Column, second: Column) -> Column:
        """Rows counted before the bookmark, which is ``first``'s if ``known``."""
        return F.when(known, first["before"]).otherwise(first["hits"] + second["before"])

    def compose(f: Column, g: Column) -> Column:
        keeps = ~g["closes"] & f["pending"].isNotNull()
        return make(f["closes"] | g["closes"], F.when(keeps, f["pending"]).otherwise(g["pending"]),
                    later(keeps, f, g), f["hits"] + g["hits"])

    def apply(f: Column, s: Column) -> Column:
        keeps = ~f["closes"] & s["pending"].isNotNull()
        return make(F.when(keeps, s["pending"]).otherwise(f["pending"]), later(keeps, s, f),
                    s["hits"] + f["hits"], kind=state)

    return Fold(
        initial=lambda: make(nothing, zero, zero, kind=state),
        identity=lambda: make(F.lit(False), nothing, zero, zero),
        effect=lambda row: make(~row[flag], F.when(row[flag], row[position]), zero, row[counted].cast("bigint")),
        compose=compose, apply=apply,
        advance=lambda row, s: make(
            F.when(row[flag], F.coalesce(s["pending"], row[position].cast("bigint"))),
            F.when(s["pending"].isNotNull(), s["before"]).otherwise(s["hits"]),
            s["hits"] + row[counted].cast("bigint"), kind=state))


def bookmark_counts(events: DataFrame, key: str, position: str, of_interest: Column, counted: Column, *,
                    width: int = CHUNK_WIDTH) -> DataFrame:
    """`bookmark_slices` with ``n``, the rows of each slice that satisfy ``counted``, in one walk.

    The walk carries the rows counted so far, so a slice's count is the difference of two of its values.
    """
    flags = events.select(key, position, F.coalesce(of_interest, F.lit(False)).alias("hit"),
                          F.coalesce(counted, F.lit(False)).alias("counted"))
    walked = keyed_scan(flags, [key], position, _counting_fold("hit", "counted", position), width=width)
    return walked.where(~F.col("hit") & F.col("before.pending").isNotNull()).select(
        key, F.col("before.pending").alias("start_offset"), F.col(position).alias("end_offset"),
        (F.col("before.hits") - F.col("before.before")).alias("n"))


def slice_counts(events: DataFrame, slices: DataFrame, key: str, position: str,
                 counted: Column, *, block: int = 1 << 16) -> DataFrame:
    """Rows of each slice that satisfy ``counted``; slices without any show 0.

    For slices that come as data; those of bookmarks are counted by `bookmark_counts` without a join.
    """
    hits = (events_in_slices(events.where(counted).select(key, position), slices, key, position,
                             block=block)
            .groupBy(key, "start_offset").agg(F.count(F.lit(1)).alias("n")))
    return (slices.join(hits, [key, "start_offset"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("long")))


def union_streams(logs: Sequence[DataFrame]) -> DataFrame:
    """Several streams as one read."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out


def last_interval(df: DataFrame, time: str, keep: str) -> DataFrame:
    """Rows newer than the latest time minus ``keep`` (e.g. ``1 hour``)."""
    newest = df.agg(F.max(time).alias("newest")).scalar()
    return df.where(F.col(time) > newest - F.expr(f"interval {keep}"))
