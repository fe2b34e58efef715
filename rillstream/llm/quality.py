"""Quality rules with adaptive thresholds, in DataFrame functions only.

Features of every text are computed once. Mergeable quantile sketches per language and source, per language and over all
rows give each feature its usual range; a feature of a document far outside the range of its group rejects
it. A group's own range counts as much as the group has rows: it is mixed with its language's range,
and that with the range of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows at which a group's own range counts as much as the range above it.
PRIOR_ROWS = 50
#: Quartile distances beyond the quartiles that are still usual.
REACH = 4.0
#: feature: (least distance from the quartiles, whether values below the range count too)
FEATURES = {"word_length": (0.6, True), "symbol_rate": (0.1, False), "dup_line_rate": (0.34, False),
            "repeat_rate": (0.2, False)}
ACCURACY = 2000


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that a text has twice or more, by position."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(
        F.get(words, i), F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)))
    return hashes


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source) with the counts of every text; null and empty texts have none."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(
        F.split("text", "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != ""))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    # window hashes, in order of position; the place of each in sorted order tells which come twice
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= 4, _repeated(F.col("words"))))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(twice, placed))
    same = lambda i: (F.get("placed", i)["h"] == F.get("placed", i - 1)["h"]) | (
        F.get("placed", i)["h"] == F.get("placed", i + 1)["h"])
    starts = F.array_sort(F.transform(F.filter(
        F.transform("placed", lambda x, i: F.struct(x["i"].alias("i"), F.coalesce(same(i), F.lit(False)).alias("dup"))),
        lambda x: x["dup"]), lambda x: x["i"]))
    rows = rows.withColumn("starts", starts)
    covered = F.aggregate(
        F.transform("starts", lambda s, i: F.least(F.lit(3), F.coalesce(s - F.get("starts", i - 1), F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.select(
        "doc_id", "lang", "source", "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"))


def _rates(rows: DataFrame) -> DataFrame:
    words = F.greatest("n_words", F.lit(1))
    return rows.withColumns({
        "word_length": F.col("word_chars") / words, "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "base_failed": (F.col("n_words") < MIN_WORDS) | (
            100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))})


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source) with the lowest and highest usual value of each feature, from quantile sketches.

    Sketches see the rows that pass the fixed rules. Groups are combined with null for a missing language or source.
    """
    kinds = list(FEATURES)
    good = _rates(rows).where("not base_failed")
    # sketches are mergeable: one per task and group crosses the shuffle
    sketch = [F.percentile_approx(kind, [0.25, 0.75], ACCURACY).alias(kind) for kind in kinds]
    def level(keys: list[str], name: str) -> DataFrame:
        return good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sketch).select(
            *keys, F.struct("n", *kinds).alias(name))
    groups = rows.select("lang", "source").distinct()
    own = level(["lang", "source"], "own").withColumnsRenamed({"lang": "l", "source": "s"})
    middle = level(["lang"], "middle").withColumnRenamed("lang", "m")
    top = level([], "top")
    joined = groups.join(own, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    joined = joined.join(middle, F.col("lang").eqNullSafe(F.col("m")), "left")
    joined = joined.withColumn("one", F.lit(1)).join(top.withColumn("one", F.lit(1)), "one", "left")

    def quartile(kind: str, which: int) -> Column:
        value: Column = F.get(F.col("top")[kind], F.lit(which))
        for name in ("middle", "own"):
            n = F.coalesce(F.col(name)["n"], F.lit(0))
            share = n / (n + PRIOR_ROWS)
            value = value + share * (F.coalesce(F.get(F.col(name)[kind], F.lit(which)), value) - value)
        return value

    columns = []
    for kind, (least, below) in FEATURES.items():
        low, high = quartile(kind, 0), quartile(kind, 1)
        reach = F.greatest(REACH * (high - low), F.lit(least))
        columns.append((high + reach).alias(f"most_{kind}"))
        if below:
            columns.append((low - reach).alias(f"least_{kind}"))
    return joined.select("lang", "source", *columns)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row.

    Null and empty texts fail the fixed rules; a null language or source is a group like any other; repeated rows
    count each. Other columns of ``docs`` are left out. An empty table gives no rows.
    """
    rows = stored(features(docs), "quality-features")
    limits = stored(thresholds(rows), "quality-limits").withColumnsRenamed({"lang": "l", "source": "s"})
    joined = _rates(rows).join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    usual = F.lit(True)
    for kind, (_, below) in FEATURES.items():
        usual &= F.coalesce(F.col(kind) <= F.col(f"most_{kind}"), F.lit(True))
        if below:
            usual &= F.coalesce(F.col(kind) >= F.col(f"least_{kind}"), F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & usual).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose documents are all kept, with the columns of ``docs``."""
    good = judged(docs).groupBy("doc_id").agg(F.min("kept").alias("kept")).where("kept").select(
        F.col("doc_id").alias("__keep"))
    return docs.join(stored(good, "quality-keep"), F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")), "left_semi")
