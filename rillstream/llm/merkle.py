"""A Merkle manifest of a table: a digest per row, a tree per group, a tree over the groups, and a proof per row.

Nodes of a level stand in runs of ``arity``; the digests of a run, joined, are hashed into the parent, also where the last
run is shorter. A row keeps standing for the nodes of which it is the first leaf, so at level ``l`` the siblings of a node are at the
fixed distances ``arity ** l``, 2 ``arity ** l``, … before and behind it: lag and lead columns over rows in order, masked by the
slot in the run and by the run's length. First children hash the parents. The way back down hands each parent's path to
its later children by the same lags.

One window holds a block of ``arity ** LEVELS`` consecutive rows of a group, never a whole group; the tops of the blocks are the nodes
of the next tier. Positions come from a range sort: numbers inside each sorted part plus the counts of the parts before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ARITY = 2
#: Levels that one tier climbs: a window holds ARITY ** LEVELS rows.
LEVELS = 6
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts joined; null parts are left out."""
    return F.sha2(F.concat(*(F.coalesce(p, F.lit("")) for p in parts)), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values, each `-` if null, else its UTF-8 byte count, a colon and the value as text."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(framed, values))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (grp, …) with ``pos``, its place in its group by ``order`` from 0, and ``n``, the rows of the group.

    Rows that are equal in ``order`` are told apart by where they were read, so they spread over the parts too.
    """
    keys = ["grp", *order, "__place"]
    parts = nodes.withColumn("__place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = stored(parts.drop("__place").withColumn("__at", F.monotonically_increasing_id()), "merkle-order").withColumn(
        "__part", F.shiftright("__at", 33))
    counts = parts.groupBy("__part", "grp").agg(F.count("*").alias("__rows"), F.min("__at").alias("__from"))
    # a row per part and group in it: as many as tasks and groups, not as rows
    whole = Window.partitionBy("grp")
    counts = counts.select("__part", "grp", "__from", F.sum("__rows").over(whole).alias("n"), (F.sum("__rows").over(
        whole.orderBy("__part")) - F.col("__rows")).alias("__before"))
    placed = parts.join(stored(counts, "merkle-parts"), ["__part", "grp"])
    return placed.withColumn("pos", F.col("__at") - F.col("__from") + F.col("__before")).drop(
        "__part", "__at", "__from", "__before")


IN_BLOCK = "OVER (PARTITION BY grp, block ORDER BY pos)"


def _climbed(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``nodes`` (grp, pos, n, node, …) with ``block``, ``__top`` (on first rows of blocks) and ``__left<l>``, ``__right<l>``."""
    rows = nodes.selectExpr("*", f"pos div {arity ** levels} AS block", "node AS __top")
    for level in range(levels):
        step = arity ** level
        slot = f"(pos div {step}) % {arity}"
        count = f"((n + {step - 1}) div {step})"
        stands = f"(pos % {step} = 0 AND {count} > 1)"

        def beside(there: str, shift: str) -> str:
            return f"coalesce(CASE WHEN {there} THEN {shift} {IN_BLOCK} END, '')"

        before = ", ".join(beside(f"{slot} >= {d}", f"lag(__top, {d * step})") for d in range(arity - 1, 0, -1))
        # a node stands behind in the run if its place is in the level and the slots suffice
        behind = ", ".join(beside(f"{slot} + {d} < {arity} AND pos div {step} + {d} < {count}", f"lead(__top, {d * step})")
                           for d in range(1, arity))
        rows = rows.withColumns({
            f"__left{level}": F.expr(f"CASE WHEN {stands} THEN concat({before}) END"),
            f"__right{level}": F.expr(f"CASE WHEN {stands} THEN concat({behind}) END"),
            "__top": F.expr(f"CASE WHEN pos % {step * arity} = 0 THEN "
                            f"CASE WHEN {count} > 1 THEN sha2(concat(__top, {behind}), 256) ELSE __top END END")})
    return rows


def _with_paths(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``nodes`` with ``block`` and ``path``, the siblings of every row from its own level to the top of its block."""
    rows = _climbed(nodes, arity, levels)
    none = f"CAST(array() AS {PATH})"
    rows = rows.withColumn("path", F.expr(f"CASE WHEN pos % {arity ** levels} = 0 THEN {none} END"))
    for level in reversed(range(levels)):
        step = arity ** level
        handed = " ".join(f"WHEN {d} THEN lag(path, {d * step}) {IN_BLOCK}" for d in range(1, arity))
        own = f"array(named_struct('left', __left{level}, 'right', __right{level}))"
        rows = rows.withColumn("path", F.expr(
            f"CASE WHEN pos % {step} = 0 THEN concat(CASE WHEN __left{level} IS NULL THEN {none} ELSE {own} END, "
            f"CASE (pos div {step}) % {arity} {handed} ELSE path END) END"))
    return rows.drop("__top", *(f"__{side}{level}" for side in ("left", "right") for level in range(levels)))


def tiers_of(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> list[DataFrame]:
    """``nodes`` (grp, pos, n, node, …) and the tiers above, up to one node (grp, pos 0, n 1, node) for every group."""
    tiers, size = [nodes], arity ** levels
    while (tiers[-1].agg(F.max("n")).first()[0] or 1) > 1:
        climbed = _climbed(tiers[-1].select("grp", "pos", "n", "node"), arity, levels)
        tiers.append(stored(climbed.where(F.col("pos") % size == 0).select(
            "grp", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
            F.col("__top").alias("node")), "merkle-tier"))
    return tiers


def paths_of(tiers: list[DataFrame], heads: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """The rows of the lowest tier with ``path`` to the end of their group's path in ``heads`` (grp, path, …), and its other columns."""
    carried = [c for c in heads.columns if c not in ("grp", "path")]
    upper = heads.withColumn("pos", F.lit(0).cast("long"))
    if len(tiers) == 1:
        return tiers[0].join(heads, "grp")
    for tier in reversed(tiers[:-1]):
        above = stored(upper.select("grp", F.col("pos").alias("block"), F.col("path").alias("__above"), *carried), "merkle-paths")
        upper = _with_paths(tier, arity, levels).join(above, ["grp", "block"]).withColumn(
            "path", F.concat("path", "__above")).drop("block", "__above")
    return upper


def manifest(docs: DataFrame, by: str = "lang", order: str = "doc_id",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None,
             arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(``order``, ``by``, leaf, subroot, root, path, columns of ``carry``) of every row of ``docs``.

    Leaves are digests of ``columns``, stand in a tree per value of ``by`` in ascending ``order`` (nulls first; equal ones by their leaf;
    repeated rows are leaves each), and the groups' roots in a tree by ``by`` (null first, then bytewise). Columns of ``docs``
    that are not named are not read, whatever they are called. An empty table gives no rows.
    ``carry`` gives further columns computed from the row, such as the leaf of a changed row.
    """
    carried = {f"__carry_{name}": column for name, column in (carry or {}).items()}
    own = docs.select(F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("grp"), F.col(order).alias("__key"),
                      F.col(by).alias("__by"), leaf_digest(*map(F.col, columns)).alias("node"),
                      *(column.alias(name) for name, column in carried.items()))
    leaves = tiers_of(stored(numbered(stored(own, "merkle-leaves"), ["__key", "node"]), "merkle-nodes"), arity, levels)
    subroots = leaves[-1].select("grp", "node") if len(leaves) > 1 else leaves[0].select("grp", "node")
    tops = tiers_of(stored(numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"), ["name"]),
                           "merkle-groups"), arity, levels)
    root = tops[-1].select("grp", F.col("node").alias("root"), F.array().cast(PATH).alias("path"))
    heads = paths_of(tops, root, arity, levels).select(F.col("name").alias("grp"), "path", F.col("node").alias("subroot"), "root")
    rows = paths_of(leaves, stored(heads, "merkle-heads"), arity, levels)
    return rows.select(F.col("__key").alias(order), F.col("__by").alias(by), F.col("node").alias("leaf"), "subroot", "root", "path",
                       *(F.col(f"__carry_{name}").alias(name) for name in carry or {}))
