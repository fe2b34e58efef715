"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is p times its size takes floor(p) copies of each row, and one more with probability p - floor(p).
The extra copies are not drawn one by one: two rows with fractional probabilities trade mass (counted in words, so the words
of both together stay the same) in a random direction until one probability is 0 or 1. The rows of a block
are paired one after the other; the at most one row that stays fractional goes up a tree of blocks. At the root a single
row per source is drawn. So each source's words differ from its target by less than one row, and each row keeps its
probability.

Blocks come from a hash of the row, and every random number from a hash of the seed and the rows, so reruns agree
however the input is split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
BLOCK_ROWS = 4096
FAN_IN = 64


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row; size is the number of words of the whole text, null has none."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(lambda text: len(text.encode().split()) if text else 0).astype("int64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(count("text"), F.lit(0)).alias("size"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered by code point, null last; sorted and numbered in parallel."""
    order = sources.orderBy(F.col("source").isNull(), "source")
    numbered = order.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    return sources.sparkSession.createDataFrame(numbered, "source string, source_size long, docs long, rank long")


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, docs, target): shares of the words by weight, no source above ``most`` times its size.

    Sources above their limit stop there, and what is over is shared again by weight until none is above. Each
    step fetches four numbers only.
    """
    sources = stored(_ranked(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))), "mix-sources")
    kinds = F.array(*map(F.lit, weights))
    sources = sources.withColumn("weight", F.get(kinds, (F.col("rank") % len(weights)).cast("int")))
    limit = most * F.col("source_size")
    level, full = 0.0, -1
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        # a source is at its limit if the level of the last step took it there
        at_limit = (F.col("weight") * F.lit(level) > limit) | (F.col("source_size") == 0)
        used, count, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(at_limit, limit)), F.lit(0.0)), F.count(F.when(at_limit, 1)),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0.0))).first()
        if count == full or not open_weight:
            break
        full, level = count, max(level, (total - used) / open_weight)
    return stored(sources.select("source", "source_size", "docs", F.least(
        F.col("weight") * F.lit(level), limit).alias("target")), "mix-targets")


def _draw(*parts: object) -> float:
    """A number from [0, 1) that depends on the parts only."""
    digest = hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=8).digest()
    return (int.from_bytes(digest, "big") >> 11) / (1 << 53)


def pivot(items: list[tuple[float, int, str]], seed: int) -> list[float]:
    """New probabilities for (probability, size, key): all are 0 or 1 but for one at most.

    Two fractional rows trade words until one is whole; the direction is drawn so that each keeps its
    probability on average.
    """
    out = [p for p, _, _ in items]
    open_row = -1
    for row, (p, _, _) in enumerate(items):
        if not 0 < p < 1:
            continue
        if open_row < 0:
            open_row = row
            continue
        a, b = items[open_row], items[row]
        pa, pb, sa, sb = out[open_row], out[row], a[1], b[1]
        up_a, up_b = sa * (1 - pa), sb * (1 - pb)
        down_a, down_b = sa * pa, sb * pb
        to_a, to_b = min(up_a, down_b), min(up_b, down_a)
        if _draw(seed, a[2], b[2], row) * (to_a + to_b) < to_b:
            new_a = 1.0 if up_a <= down_b else pa + to_a / sa
            new_b = 0.0 if down_b <= up_a else pb - to_a / sb
        else:
            new_b = 1.0 if up_b <= down_a else pb + to_b / sb
            new_a = 0.0 if down_a <= up_b else pa - to_b / sa
        out[open_row], out[row] = new_a, new_b
        open_row = open_row if 0 < new_a < 1 else row if 0 < new_b < 1 else -1
    return out


def _level(rows: DataFrame, seed: int, last: bool) -> DataFrame:
    def combine(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "doc_id", "size"], kind="stable").reset_index(drop=True)
        keys = [f"{o}:{d}" for o, d in zip(part["order"], part["doc_id"])]
        part["p"] = pivot(list(zip(part["p"], part["size"], keys)), seed)
        if last:  # the rows here are of one source: its last open row is drawn
            part["p"] = [float(_draw(seed, key, "root") < p) if 0 < p < 1 else p for p, key in zip(part["p"], keys)]
        return part

    return rows.groupBy("source", "block").applyInPandas(combine, rows.schema)


def take(rows: DataFrame, goals: DataFrame, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row of ``rows``.

    Null sources are one source. Rows without words, and all rows of a source without words, get no copies.
    Repeated rows are rounded each by itself.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("ratio", ratio).withColumnRenamed("source", "__source")
    joined = rows.join(goals, rows["source"].eqNullSafe(goals["__source"]))
    joined = joined.withColumns({
        "whole": F.when(F.col("size") > 0, F.floor("ratio")).otherwise(F.lit(0)).cast("long"),
        "p": F.when(F.col("size") > 0, F.col("ratio") - F.floor("ratio")).otherwise(F.lit(0.0)),
        "doc_id": F.col("doc_id").cast("string"),  # pandas has no whole numbers with nulls
        "order": F.xxhash64(F.lit(seed), "doc_id", "size"),
        "blocks": F.ceil(F.col("docs") / block_rows).cast("long")})
    joined = joined.withColumn("block", F.pmod(F.col("order"), F.col("blocks")))
    keep = ["doc_id", "source", "size", "source_size", "target", "whole", "p", "order", "blocks", "block"]
    level = joined.select(*keep)
    done: DataFrame | None = None
    blocks = goals.agg(F.max(F.ceil(F.col("docs") / block_rows))).first()[0] or 1
    while True:
        out = stored(_level(level, seed, blocks <= 1), "mix-level")
        if blocks <= 1:
            done = out if done is None else done.unionByName(out)
            break
        # the largest source's tree sets the number of levels; a source of one block goes up with its one open row
        fractional = (F.col("p") > 0) & (F.col("p") < 1)
        settled = out.where(~fractional)
        done = settled if done is None else done.unionByName(settled)
        level = out.where(fractional).withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
        blocks = -(-blocks // FAN_IN)
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "size", "source_size", "target",
                       (F.col("whole") + F.col("p")).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: int = 42,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Copies of every row of ``docs`` (doc_id, text, source, …) for a mix of sources to target weights.

    Sources are weighed in turn by code point, null last. Empty tables give no rows.
    """
    rows = stored(sizes(docs), "mix-sizes")
    return take(rows, targets(rows, weights, share), seed, block_rows)


def expand(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` with every row repeated as often as ``plan`` (of mix) says; rows that share a doc_id share its copies."""
    total = plan.groupBy("doc_id").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    total = total.withColumnRenamed("doc_id", "__id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("source", F.xxhash64("text")))
    rows = docs.withColumn("__nth", nth).join(total, docs["doc_id"].cast("long").eqNullSafe(total["__id"]))
    share = F.floor(F.col("__copies") / F.col("__rows")) + (
        F.col("__nth") <= F.col("__copies") % F.col("__rows")).cast("long")
    return rows.where(share > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), share))).select(*docs.columns)
