"""Order-dependent work that stays parallel when one key holds much of the data.

A keyed fold (state machine, pending bookmark, conditional map update, previous
row) normally needs the whole history of a key in one place. Here a heavy key is
cut into chunks of consecutive positions. Every chunk is summarised by the
*function* it applies to the state; such functions compose associatively, so
the state at the start of each chunk follows from a two-level prefix over chunk
summaries, and each chunk is then replayed on its own.

A fold is described by a :class:`Fold`: the state function of one row, how two
functions compose and how a function acts on a state, all as column
expressions, so the work stays inside Catalyst.

Positions must be unique, non-negative integers within a key (log offsets), so a chunk of
``width`` positions never holds more than ``width`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

CHUNK_WIDTH = 4096      # most rows folded in one array
CHUNK_FAN = 1024        # chunks put together per second-level group
INDEX_WIDTH = 1 << 18   # positions per task in a plain running sum
KEY_PARTS = 64          # parts in which the rows of one key look up whether it is heavy
_RUN = 64               # states gathered before they are put aside


def block_of(position: str, width: int) -> Column:
    """Number of the block of ``width`` positions a row falls in (integer division)."""
    return F.expr(f"`{position}` div {width}")


@dataclass(frozen=True)
class Fold:
    """An ordered fold whose row effects compose."""

    initial: Callable[[], Column]                    # state before the first row
    identity: Callable[[], Column]                   # function that changes nothing
    effect: Callable[[Column], Column]               # row struct -> function
    compose: Callable[[Column, Column], Column]      # first, second -> function
    apply: Callable[[Column, Column], Column]        # function, state -> state
    advance: Callable[[Column, Column], Column] | None = None   # row struct, state -> state

    def next_state(self, row: Column, state: Column) -> Column:
        """State after one row; ``advance`` is a shorter form of applying the row's effect."""
        if self.advance is not None:
            return self.advance(row, state)
        return self.apply(self.effect(row), state)


def states_before(items: Column, start: Column,
                  advance: Callable[[Column, Column], Column]) -> Column:
    """State in front of each item of an array; ``advance(item, state)`` gives the next one.

    Appending to an array copies it, so states are gathered in short runs that are
    flattened in the end: the cost per item does not grow with the array.
    """
    none_yet = F.slice(F.array(start), 1, 0)

    def step(acc: Column, item: Column) -> Column:
        return F.struct(advance(item, acc["state"]).alias("state"),
                        F.concat(acc["seen"], F.array(acc["state"])).alias("seen"))

    def walk_run(acc: Column, number: Column) -> Column:
        run = F.slice(items, number * _RUN + 1, F.lit(_RUN))
        walked = F.aggregate(run, F.struct(acc["state"].alias("state"), none_yet.alias("seen")),
                             step)
        # a one-element transform names the walk, which is otherwise evaluated per use
        return F.element_at(F.transform(F.array(walked), lambda w: F.struct(
            w["state"].alias("state"),
            F.concat(acc["runs"], F.array(w["seen"])).alias("runs"))), 1)

    runs = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _RUN).cast("int"))
    none_walked = F.slice(F.array(none_yet), 1, 0)
    return F.flatten(F.aggregate(
        runs, F.struct(start.alias("state"), none_walked.alias("runs")), walk_run)["runs"])


def _sorted_by(items: Column, field: str) -> Column:
    """Sort an array of structs by one unique field (the rest need not be orderable)."""
    return F.array_sort(items, lambda a, b: F.when(a[field] < b[field], -1)
                        .when(a[field] > b[field], 1).otherwise(0))


def chunk_starts(functions: DataFrame, fold: Fold, *, fan: int = CHUNK_FAN) -> DataFrame:
    """State at the start of every chunk.

    ``functions``: ``__key``, ``chunk`` (long), ``fn``. Result: ``__key``, ``chunk``, ``start``.
    Chunks are put together in spans of ``fan``, so the last step per key handles one item
    per span. The outer join keeps both uses of ``groups`` the same plan: one exchange.
    """
    groups = (
        functions
        .groupBy("__key", block_of("chunk", fan).alias("span"))
        .agg(_sorted_by(F.collect_list(F.struct("chunk", "fn")), "chunk").alias("chunks"))
        .withColumn("span_fn", F.aggregate(
            "chunks", fold.identity(), lambda acc, c: fold.compose(acc, c["fn"])))
    )
    spans = (
        groups.groupBy("__key")
        .agg(_sorted_by(F.collect_list(F.struct("span", F.col("span_fn").alias("fn"))), "span")
             .alias("spans"))
        .withColumn("seen", states_before(F.col("spans"), fold.initial(),
                                          lambda s, state: fold.apply(s["fn"], state)))
        .select("__key", F.inline(F.arrays_zip(F.col("spans.span").alias("span"),
                                               F.col("seen").alias("start"))))
    )
    return (
        groups.join(spans, ["__key", "span"], "left")
        .withColumn("seen", states_before(F.col("chunks"), F.col("start"),
                                          lambda c, state: fold.apply(c["fn"], state)))
        .select("__key", F.inline(F.arrays_zip(F.col("chunks.chunk").alias("chunk"),
                                               F.col("seen").alias("start"))))
    )


def heavy_keys(df: DataFrame, keys: Sequence[str], most_rows: int) -> DataFrame:
    """Keys with more than ``most_rows`` rows (counted map-side first)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
            .where(F.col("__rows") > most_rows).select(*keys, F.lit(True).alias("__heavy")))


def marked_heavy(df: DataFrame, keys: Sequence[str], heavy: DataFrame, spread: Sequence[str],
                 parts: int = KEY_PARTS) -> DataFrame:
    """Add the columns of ``heavy`` (null for other keys) and ``__part``.

    The rows of a key meet the short list of heavy keys in ``parts`` places, chosen by the columns
    ``spread``, so a heavy key does not pass through one task even where the list is not broadcast.
    """
    copies = heavy.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    part = F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int")
    return df.withColumn("__part", part).join(copies, [*keys, "__part"], "left")


def _replayed(arrays: DataFrame, start: Column, fold: Fold, keys: Sequence[str],
              columns: Sequence[str]) -> DataFrame:
    """Rows of sorted arrays with the states around them."""
    return (
        arrays
        .withColumn("seen", states_before(F.col("rows.row"), start, fold.next_state))
        .select("__key", F.inline(F.arrays_zip(F.col("rows.row").alias("row"),
                                               F.col("seen").alias("before"))))
        .withColumn("after", fold.next_state(F.col("row"), F.col("before")))
        .select(*[F.col(f"__key.{k}").alias(k) for k in keys], "row.*", "before", "after")
        .select(*columns, "before", "after"))


def _histories(keyed: DataFrame, schema_json: str) -> Column:
    """Rows of a group as one array in order of ``__pos``."""
    items = F.collect_list(F.struct("__pos", "row"))
    if '"map"' in schema_json or '"variant"' in schema_json:      # such rows have no order of their own
        return _sorted_by(items, "__pos").alias("rows")
    return F.sort_array(items).alias("rows")


def keyed_walk(df: DataFrame, keys: Sequence[str], position: str, initial: Callable[[], Column],
               advance: Callable[[Column, Column], Column]) -> DataFrame:
    """`keyed_scan` for keys that are known to be short, by ``advance`` alone: one array per key."""
    payload = F.struct(*[c for c in df.columns if c not in keys])
    keyed = df.select(F.struct(*keys).alias("__key"), F.col(position).alias("__pos"),
                      payload.alias("row"))
    fold = Fold(initial=initial, identity=initial, effect=lambda row: row,
                compose=lambda first, second: second, apply=lambda fn, state: state,
                advance=advance)
    return _replayed(keyed.groupBy("__key").agg(_histories(keyed, df.schema.json())), initial(),
                     fold, list(keys), df.columns)


def keyed_scan(df: DataFrame, keys: Sequence[str], position: str, fold: Fold, *,
               width: int = CHUNK_WIDTH, fan: int = CHUNK_FAN) -> DataFrame:
    """Replay every key in ``position`` order.

    Returns the input columns plus ``before`` and ``after``: the state around each
    row. Keys are counted first (a job over the key columns; only the keys with more than
    ``width`` rows are kept, in the shared checkpoint folder). Without such keys each history
    is folded as one array, in one shuffle. Heavy keys are cut into chunks of ``width`` positions;
    the functions of the chunks, one row each, are kept in the shared folder too.
    """
    if df.isStreaming:
        raise ValueError("keyed_scan is a batch operator; see rillstream.streaming.stateful")
    keys = list(keys)
    shared_dir(df.sparkSession)
    payload = F.struct(*[c for c in df.columns if c not in keys])
    keyed = df.select(F.struct(*keys).alias("__key"), F.col(position).alias("__pos"),
                      payload.alias("row"))
    items = _histories(keyed, df.schema.json())
    heavy = heavy_keys(keyed, ["__key"], width).checkpoint()
    if heavy.isEmpty():
        return _replayed(keyed.groupBy("__key").agg(items), fold.initial(), fold, keys, df.columns)
    chunked = (
        marked_heavy(keyed, ["__key"], heavy, ["__pos"])
        .withColumn("chunk", F.when(F.col("__heavy"), block_of("__pos", width))
                    .otherwise(F.lit(-1)).cast("long"))
        .select("__key", "chunk", "__pos", "row").repartition("__key", "chunk")
        .groupBy("__key", "chunk").agg(items))
    functions = chunked.where("chunk >= 0").select(
        "__key", "chunk",
        F.aggregate("rows", fold.identity(),
                    lambda acc, r: fold.compose(acc, fold.effect(r["row"]))).alias("fn")).checkpoint()
    starts = chunk_starts(functions, fold, fan=fan).withColumn("__known", F.lit(True))
    placed = chunked.join(starts, ["__key", "chunk"], "left").withColumn(
        "start", F.when(F.col("__known"), F.col("start")).otherwise(fold.initial()))
    return _replayed(placed, F.col("start"), fold, keys, df.columns)


def previous_row(df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str], *,
                 width: int = CHUNK_WIDTH) -> DataFrame:
    """Add ``previous``: a struct of ``columns`` of the key's preceding row, or null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    shape = "struct<" + ",".join(f"`{c}`:{types[c].simpleString()}" for c in columns) + ">"

    def none() -> Column:
        return F.lit(None).cast(shape)

    fold = Fold(
        initial=none, identity=none,
        effect=lambda row: F.struct(*[row[c].alias(c) for c in columns]).cast(shape),
        compose=lambda first, second: F.coalesce(second, first),
        apply=lambda fn, state: F.coalesce(fn, state))
    return (keyed_scan(df, keys, position, fold, width=width)
            .withColumnRenamed("before", "previous").drop("after"))


def _sums(names: Sequence[str]) -> Fold:
    """Totals of several weights at once."""
    zero = F.struct(*[F.lit(0).cast("long").alias(n) for n in names])

    def add(a: Column, b: Column) -> Column:
        return F.struct(*[(a[n] + b[n]).alias(n) for n in names])

    return Fold(initial=lambda: zero, identity=lambda: zero, effect=lambda row: row,
                compose=add, apply=lambda fn, state: add(state, fn))


def running_sums(df: DataFrame, weights: Mapping[str, Column], position: str, *,
                 partition_by: Sequence[str] = (), width: int = INDEX_WIDTH,
                 fan: int = CHUNK_FAN) -> DataFrame:
    """Inclusive running totals of integer weights (result name -> weight) in ``position`` order.

    Works without bringing a partition into one task: totals per block of
    ``width`` positions, a prefix over the blocks, and a window inside each block.
    """
    names = {name: f"__w{i}" for i, name in enumerate(weights)}
    weighted = df.select(
        "*", *[w.cast("long").alias(names[n]) for n, w in weights.items()],
        F.struct(*(partition_by or [F.lit(0)])).alias("__key"),
        block_of(position, width).alias("chunk"))
    totals = weighted.groupBy("__key", "chunk").agg(
        *[F.sum(w).alias(w) for w in names.values()]).select(
        "__key", "chunk", F.struct(*names.values()).alias("fn"))
    starts = chunk_starts(totals, _sums(list(names.values())), fan=fan)
    inside = Window.partitionBy("__key", "chunk").orderBy(position).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        weighted.join(starts, ["__key", "chunk"], "left")
        .select(*df.columns, *[(F.col(f"start.{w}") + F.sum(w).over(inside)).alias(n)
                               for n, w in names.items()])
    )


def running_sum(df: DataFrame, weight: Column | str, position: str, name: str, *,
                partition_by: Sequence[str] = (), width: int = INDEX_WIDTH,
                fan: int = CHUNK_FAN) -> DataFrame:
    """One running total; see `running_sums`."""
    column = F.col(weight) if isinstance(weight, str) else weight
    return running_sums(df, {name: column}, position, partition_by=partition_by, width=width,
                        fan=fan)


def block_starts(totals: DataFrame, keys: Sequence[str], block: str, rows: str) -> DataFrame:
    """Rows of each key in front of each of its blocks: ``keys``, ``block``, ``start``, ``rows``.

    ``totals``: parts of blocks with their number of ``rows``; several parts of a block are added up.
    """
    whole = totals.groupBy(F.struct(*keys).alias("__key"), F.col(block).cast("long").alias("chunk")).agg(
        F.sum(rows).alias("n"))
    starts = chunk_starts(whole.select("__key", "chunk", F.struct("n").alias("fn")), _sums(["n"]))
    return whole.join(starts, ["__key", "chunk"]).select(
        "__key.*", F.col("chunk").alias(block), F.col("start.n").alias("start"), F.col("n").alias(rows))


def highest_before(df: DataFrame, value: str, position: str, name: str, *,
                   partition_by: Sequence[str] = (), width: int = INDEX_WIDTH) -> DataFrame:
    """Highest ``value`` of all rows at lower positions (null for the first)."""
    nothing = F.lit(None).cast(df.schema[value].dataType)
    top = Fold(initial=lambda: nothing, identity=lambda: nothing, effect=lambda row: row[value],
               compose=F.greatest, apply=F.greatest)
    placed = df.select("*", F.struct(*(partition_by or [F.lit(0)])).alias("__key"),
                       block_of(position, width).alias("chunk"))
    tops = placed.groupBy("__key", "chunk").agg(F.max(value).alias("fn"))
    inside = Window.partitionBy("__key", "chunk").orderBy(position).rowsBetween(
        Window.unboundedPreceding, -1)
    return (placed.join(chunk_starts(tops, top), ["__key", "chunk"], "left")
            .withColumn(name, F.greatest("start", F.max(value).over(inside)))
            .select(*df.columns, name))


def next_where(df: DataFrame, flag: Column, position: str, name: str, *,
               partition_by: Sequence[str] = (), width: int = INDEX_WIDTH) -> DataFrame:
    """Position of the next row, after each row, for which ``flag`` holds (null if none).

    Where no partition has more than ``width`` rows (counted first) one window over each is enough.
    """
    following = (1, Window.unboundedFollowing)
    if partition_by and heavy_keys(df, partition_by, width).isEmpty():
        whole = Window.partitionBy(*partition_by).orderBy(position).rowsBetween(*following)
        return df.withColumn(name, F.min(F.when(flag, F.col(position).cast("long"))).over(whole))
    nothing = F.lit(None).cast("long")
    first = Fold(initial=lambda: nothing, identity=lambda: nothing, effect=lambda row: nothing,
                 compose=F.least, apply=F.least)
    at = F.when(flag, F.col(position).cast("long"))
    # blocks are numbered backwards, so that what comes after has been met
    placed = df.select("*", F.struct(*(partition_by or [F.lit(0)])).alias("__key"),
                       (-block_of(position, width)).alias("chunk"), at.alias("__flagged"))
    firsts = placed.groupBy("__key", "chunk").agg(F.min("__flagged").alias("fn"))
    inside = Window.partitionBy("__key", "chunk").orderBy(position).rowsBetween(*following)
    return (placed.join(chunk_starts(firsts, first), ["__key", "chunk"], "left")
            .withColumn(name, F.coalesce(F.min("__flagged").over(inside), "start"))
            .select(*df.columns, name))


def dense_index(df: DataFrame, position: str, name: str, *, first: int = 0,
                partition_by: Sequence[str] = (), width: int = INDEX_WIDTH) -> DataFrame:
    """Number the rows ``first, first+1, …`` in ``position`` order."""
    out = running_sum(df, F.lit(1), position, name, partition_by=partition_by, width=width)
    return out.withColumn(name, F.col(name) + F.lit(first - 1))
