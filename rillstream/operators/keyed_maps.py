"""Replicated maps and keyed tables as folds over an update log.

Update log: rev (unique, increasing), op, key, value, expected. Ops: put, putIfAbsent,
remove, removeIf, replace, replaceIf, clear. `put_all` spreads a map over put rows.
A missing key and a null value are the same thing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .ordered import (
    CHUNK_WIDTH, INDEX_WIDTH, heavy_keys, highest_before, keyed_walk, marked_heavy, next_where, running_sum)

def _next_value(row: Column, current: Column) -> Column:
    """Value of a key after one update."""
    op, value = row["op"], row["value"]
    matches = current == row["expected"]
    return (F.when(op == "put", value)
            .when(op == "putIfAbsent", F.coalesce(current, value))
            .when(op.isin("remove", "clear"), F.lit(None).cast("string"))
            .when(op == "replace", F.when(current.isNotNull(), value))
            .when((op == "removeIf") & matches, F.lit(None).cast("string"))
            .when((op == "replaceIf") & matches, value)
            .otherwise(current))


def _none() -> Column:
    return F.lit(None).cast("string")


def _walked(updates: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``updates`` (``keys``, rev, op, value, expected, …) with ``before`` and ``after``, the key's value around each.

    Keys of up to ``width`` updates are walked as one array each; the rows of the others go through
    `_linked`. Keys are counted first; only the heavy ones are kept, in the shared folder.
    """
    shared_dir(updates.sparkSession)
    heavy = heavy_keys(updates, keys, width).checkpoint()
    if heavy.isEmpty():
        return keyed_walk(updates, keys, "rev", _none, _next_value)
    marked = marked_heavy(updates, keys, heavy, ["rev"]).drop("__part")
    light = marked.where("__heavy is null").drop("__heavy")
    return keyed_walk(light, keys, "rev", _none, _next_value).unionByName(
        _linked(marked.where("__heavy").drop("__heavy"), keys))


def _linked(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The same for keys with long histories, without a key's history in one place.

    An update that takes effect leaves a known value, so the next update that takes effect after it is known too: the
    next one that acts on any value, or the next that expects just this value, whichever comes first. These links
    need no history, only the next flagged row per key, or per key and value. Following the links from a key's first update finds
    all that took effect, by doubling: in each round the rows reached so far reach as many again, and links
    become twice as long. Rounds grow with the logarithm of the longest chain, and a round costs at most a join of the updates.
    """
    op = F.col("op")
    result = F.when(op.isin("put", "putIfAbsent", "replace", "replaceIf"), F.col("value"))
    rows = updates.select(*keys, "rev", "op", "expected", result.alias("__result")).checkpoint()
    # rows stand at odd places, and what they expect just before at even ones
    own = rows.select(*keys, (F.col("rev") * 2 + 1).alias("__at"), F.col("__result").alias("__token"),
                      F.lit(False).alias("__asks")).where("__token is not null")
    asked = rows.where(op.isin("removeIf", "replaceIf") & F.col("expected").isNotNull()).select(
        *keys, (F.col("rev") * 2).alias("__at"), F.col("expected").alias("__token"), F.lit(True).alias("__asks"))
    same = next_where(own.unionByName(asked), F.col("__asks"), "__at", "__same", partition_by=[*keys, "__token"])
    same = same.where("not __asks").select(*keys, F.expr("(__at - 1) div 2").alias("rev"), F.expr("__same div 2").alias("__same"))
    ahead = next_where(rows, op.isin("put", "remove", "replace"), "rev", "__any", partition_by=keys)
    ahead = next_where(ahead, op.isin("put", "putIfAbsent"), "rev", "__absent", partition_by=keys)
    follows = F.when(F.col("__result").isNull(), F.col("__absent")).otherwise(F.least("__any", "__same"))
    links = ahead.join(same, [*keys, "rev"], "left").select(*keys, "rev", follows.alias("to")).where(
        "to is not null").checkpoint()
    reached = rows.where(op.isin("put", "putIfAbsent")).groupBy(*keys).agg(F.min("rev").alias("rev"))
    while not links.isEmpty():
        more = reached.join(links, [*keys, "rev"]).select(*keys, F.col("to").alias("rev"))
        reached = reached.unionByName(more).repartition(*keys, "rev").checkpoint()
        further = links.select(*keys, F.col("rev").alias("to"), F.col("to").alias("__to"))
        links = links.join(further, [*keys, "to"]).select(*keys, "rev", F.col("__to").alias("to")).checkpoint()
    took = updates.join(reached.withColumn("__took", F.lit(True)), [*keys, "rev"], "left").withColumn(
        "__left", F.when(F.col("__took"), F.struct("rev", result.alias("value"))))
    seen = highest_before(took, "__left", "rev", "__last", partition_by=keys)
    return seen.select(*updates.columns, F.col("__last.value").alias("before"),
                       F.when(F.col("__took"), result).otherwise(F.col("__last.value")).alias("after"))


def put_all(updates: DataFrame, entries: str = "entries") -> DataFrame:
    """Rows of op putAll become one put per map entry, under the same revision."""
    many = F.col("op") == "putAll"
    own = F.array(F.struct("key", "value"))
    rest = [c for c in updates.columns if c not in ("op", "key", "value", entries)]
    return updates.select(
        *rest, F.when(many, "put").otherwise(F.col("op")).alias("op"),
        F.inline(F.when(many, F.map_entries(entries)).otherwise(own)))


def replay(updates: DataFrame) -> DataFrame:
    """Map after unconditional updates only (put, remove, clear).

    Everything up to the last clear is dropped before the shuffle; then the last
    update per key decides.
    """
    cleared = updates.agg(F.max(F.when(F.col("op") == "clear", F.col("rev")))).scalar()
    live = updates.where((F.col("op") != "clear") & (F.col("rev") > F.coalesce(cleared, F.lit(-1))))
    last = live.groupBy("key").agg(F.max(F.struct("rev", "op", "value")).alias("u"))
    return (last.where("u.op = 'put' and u.value is not null")
            .select("key", F.col("u.value").alias("value")))


def conditional_replay(updates: DataFrame, *, width: int = CHUNK_WIDTH,
                       index_width: int = INDEX_WIDTH) -> DataFrame:
    """Outcome of each keyed update: value before and after it, and whether it took effect.

    A clear opens a new epoch: an epoch number (running count of clears)
    joins the key, instead of copying each clear to each key.
    """
    epochs = running_sum(updates, (F.col("op") == "clear").cast("int"), "rev", "epoch",
                         width=index_width).where("op <> 'clear'")
    walked = _walked(epochs, ["epoch", "key"], width)
    before, op = F.col("before"), F.col("op")
    applied = (F.when(op == "put", True)
               .when(op == "putIfAbsent", before.isNull())
               .when(op.isin("remove", "replace"), before.isNotNull())
               .otherwise(F.coalesce(before == F.col("expected"), F.lit(False))))
    return walked.select("rev", "epoch", "key", "op", before.alias("previous"),
                         applied.alias("applied"), F.col("after").alias("current"))


def snapshot(outcomes: DataFrame) -> DataFrame:
    """Map left by a conditional replay: last epoch only, last value per key."""
    newest = outcomes.agg(F.max("epoch")).scalar()
    last = (outcomes.where(F.col("epoch") == newest).groupBy("key")
            .agg(F.max(F.struct("rev", "current")).alias("u")))
    return last.where("u.current is not null").select("key", F.col("u.current").alias("value"))


def final_map(updates: DataFrame, *, width: int = CHUNK_WIDTH) -> DataFrame:
    """Map after all updates, conditional ones included.

    Only what follows the last clear matters, so the rest is filtered first.
    """
    cleared = updates.agg(F.max(F.when(F.col("op") == "clear", F.col("rev")))).scalar()
    live = updates.where((F.col("op") != "clear") & (F.col("rev") > F.coalesce(cleared, F.lit(-1))))
    walked = _walked(live, ["key"], width)
    last = walked.groupBy("key").agg(F.max(F.struct("rev", "after")).alias("u"))
    return last.where("u.after is not null").select("key", F.col("u.after").alias("value"))


def compacted(updates: DataFrame) -> DataFrame:
    """A log that replays to the same map: one put per live key.

    Keeps the revision of the update that set the value, so later updates append to it.
    """
    cleared = updates.agg(F.max(F.when(F.col("op") == "clear", F.col("rev")))).scalar()
    live = updates.where((F.col("op") != "clear") & (F.col("rev") > F.coalesce(cleared, F.lit(-1))))
    last = live.groupBy("key").agg(F.max(F.struct("rev", "op", "value")).alias("u"))
    return (last.where("u.op = 'put' and u.value is not null")
            .select(F.col("u.rev").alias("rev"), F.lit("put").alias("op"), "key",
                    F.col("u.value").alias("value")))


def due_for_compaction(outcomes: DataFrame, removals: int = 5) -> Column:
    """Whether enough removals were asked for to rewrite the log."""
    return outcomes.agg(
        (F.count_if(F.col("op").isin("remove", "removeIf")) >= removals)).scalar()


# Reads over a snapshot (key, value).

def get(table: DataFrame, key: str) -> DataFrame:
    return table.where(F.col("key") == key).select("value")


def lookup(requests: DataFrame, table: DataFrame, default: Column | None = None) -> DataFrame:
    """Value for each requested key, or the default when it is missing."""
    found = requests.join(table, "key", "left")
    return found if default is None else found.withColumn("value", F.coalesce("value", default))


def contains_keys(requests: DataFrame, table: DataFrame) -> DataFrame:
    """The requested keys that exist."""
    return requests.join(table.select("key"), "key", "left_semi")


def contains_value(table: DataFrame, value: str) -> DataFrame:
    return table.agg(F.coalesce(F.bool_or(F.col("value") == value), F.lit(False)).alias("found"))


def size(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("size"))


def value_counts(table: DataFrame) -> DataFrame:
    """The bag of values, as value and multiplicity."""
    return table.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# Keyed tables with conditional insert.

def insert_if_absent(table: DataFrame, rows: DataFrame, keys: list[str],
                     order: str | None = None) -> DataFrame:
    """Rows that may be inserted: key not taken yet, first one per key."""
    fresh = rows.join(table.select(*keys), keys, "left_anti")
    if order is None:
        return fresh.dropDuplicates(keys)
    rest = [c for c in rows.columns if c not in keys and c != order]
    return (fresh.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("r"))
            .select(*keys, "r.*").select(*rows.columns))


def put_rows(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or overwrite by key."""
    return table.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def remove_rows(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(rows.select(*keys), keys, "left_anti")


def rows_of(table: DataFrame, **primary: object) -> DataFrame:
    """Rows under a primary key (a prefix of the key columns)."""
    out = table
    for column, value in primary.items():
        out = out.where(F.col(column) == value)
    return out
