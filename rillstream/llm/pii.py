"""Personal data: fixed forms, and more by bootstrapped contextual extraction, in DataFrame functions only.

The fixed forms are the seeds. Every token with a digit or an @ is an instance; its patterns are the words before and after
it and its shape. Patterns are scored by the instances they surround, instances by the
patterns around them, in turn. Instances that high-confidence patterns agree on, and no seed covers, are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
#: Fixed forms. Possessive, and starting only where a run of their first characters does: one pass over a text of any length.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"[\x20\x09-\x0D]"
BLOCK = 64
ROUNDS = 3
#: A pattern counts with this many different instances at least, and from this confidence on.
MIN_SUPPORT = 5
CONFIDENT = 0.9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a function over an array in it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_starts(lengths: Column) -> Column:
    """Where each of consecutive pieces starts, in blocks, so that long arrays stay cheap."""
    def sums(start: Column, values: Column) -> Column:
        return F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def placed(blocks: Column) -> Column:
        begins = F.slice(sums(F.lit(0), F.transform(blocks, total)), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, begins, lambda values, begin: F.slice(
            sums(begin, values), F.lit(1), F.size(values))))

    def of(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
                             lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(values) > 0, let(blocks, placed)).otherwise(F.array().cast("array<int>"))

    return let(lengths, of)


def _luhn(digits: Column) -> Column:
    """Luhn's sum of a string of digits ends in 0."""
    ones = F.transform(F.split(F.reverse(digits), ""), lambda d: F.when(d == "", 0).otherwise(d.cast("int")))
    doubled = F.transform(ones, lambda d, i: F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    def check(match: Column) -> Column:
        digits = F.regexp_replace(match, "[^0-9]", "")
        if kind == "ip":
            return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (
                F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.ltrim(p, F.lit("0")).try_cast("int")).isNull()
                | (F.ltrim(p, F.lit("0")).try_cast("int") <= 255)))
        if kind == "card":
            return F.length(digits).between(13, 19) & _luhn(digits)
        if kind == "phone":
            return F.length(digits).between(9, 15)
        return F.lit(True)
    return check


def _found(kind: str) -> Column:
    """Spans of one fixed form in column text."""
    guard = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}.get(
        kind, F.rlike("text", F.lit("[0-9]")))
    matches = F.regexp_extract_all("text", F.lit(FORMS[kind]), F.lit(0))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,match:string>>")
    gaps = F.split("text", FORMS[kind], -1)

    def spans(matches: Column, gaps: Column) -> Column:
        begins = running_starts(F.zip_with(
            gaps, matches, lambda gap, match: F.length(gap) + F.coalesce(F.length(match), F.lit(0))))
        starts = F.zip_with(begins, gaps, lambda begin, gap: begin + F.length(gap))
        return F.zip_with(starts, matches, lambda start, match: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"),
            match.alias("match")))  # after the last gap there is no match

    found = let(matches, lambda m: let(gaps, lambda g: spans(m, g)))
    return F.when(guard, F.filter(found, lambda s: s["match"].isNotNull() & _valid(kind)(s["match"]))).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text, spans): spans of the fixed forms of every row; key is a hash of the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    for kind in KINDS:
        rows = rows.withColumn(kind, _found(kind))
    return rows.select("doc_id", "key", "text", F.concat(*KINDS).alias("spans"))


def instances(rows: DataFrame) -> DataFrame:
    """One row per token with a digit or @ of base_spans: its place, context words, shape, and the seed it touches."""
    with_token = rows.where(F.rlike("text", F.lit("[0-9@]")))
    plain = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}]", ""))

    def placed(tokens: Column, at: Column) -> Column:
        return F.transform(tokens, lambda t, i: F.struct(
            t.alias("token"), F.get(at, i).alias("start"), F.get(tokens, i - 1).alias("before"),
            F.get(tokens, i + 1).alias("after")))

    all_tokens = let(F.split("text", SPACE, -1), lambda tokens: let(
        running_starts(F.transform(tokens, lambda t: F.length(t) + 1)), lambda at: placed(tokens, at)))
    picked = F.filter(all_tokens, lambda x: F.rlike(x["token"], F.lit("[0-9@]")))
    out = with_token.select("doc_id", "key", "spans", F.explode(picked).alias("x")).select(
        "doc_id", "key", "spans", "x.token", "x.start", plain(F.coalesce("x.before", F.lit(""))).alias("before"),
        plain(F.coalesce("x.after", F.lit(""))).alias("after"))
    # the token without marks around it
    lead = F.length("token") - F.length(F.regexp_replace("token", r"^[^\p{L}0-9+@(]++", ""))
    core = F.regexp_replace(F.regexp_replace("token", r"^[^\p{L}0-9+@(]++", ""), r"(?<![^\p{L}0-9])[^\p{L}0-9]++$|(?<=[\p{L}0-9])[^\p{L}0-9]++$", "")
    out = out.withColumn("start", F.col("start") + lead).withColumn("token", core)
    out = out.withColumn("end", F.col("start") + F.length("token")).where("end > start")
    touching = F.filter("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    out = out.withColumn("seed", F.get(touching, F.lit(0))["kind"]).drop("spans")
    digits = F.length(F.regexp_replace("token", "[^0-9]", ""))
    shape = (F.when(F.contains("token", F.lit("@")), 0)
             .when(F.rlike("token", F.lit(r"^[0-9]++(?:[.:,_-][0-9]++){3}$")), 1)
             .when(F.rlike("token", F.lit(r"^[0-9][0-9._/-]++$")) & digits.between(13, 19), 2)
             .when(F.rlike("token", F.lit(r"^[+(]?[0-9][()0-9._/-]++$")) & digits.between(7, 12), 3))
    return out.withColumn("kind", F.coalesce("seed", shape)).where("kind is not null")


def discovered(rows: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
               confident: float = CONFIDENT) -> DataFrame:
    """(doc_id, key, kind, start, end) of instances that confident patterns agree on and no fixed form covers."""
    all_of = stored(instances(rows), "pii-instances")
    named = all_of.withColumn("instance", F.concat_ws(":", "kind", F.lower("token")))
    sides = named.select("instance", "kind", F.col("seed").isNotNull().alias("seed"), F.explode(F.array(
        F.struct(F.lit("before").alias("side"), F.col("before").alias("word")),
        F.struct(F.lit("after").alias("side"), F.col("after").alias("word")))).alias("p")).select(
        "instance", "seed", F.concat_ws(":", "p.side", "kind", "p.word").alias("pattern"), F.col("p.word").alias("word"))
    # links of the graph: an instance and a pattern around it; seeds hold as true, others begin as untrue
    graph = stored(sides.where("word <> ''").groupBy("pattern", "instance").agg(
        F.max(F.col("seed").cast("int")).alias("seed")), "pii-graph")
    scores = stored(graph.groupBy("instance").agg(F.max("seed").cast("double").alias("score")), "pii-scores")
    patterns = None
    for _ in range(rounds):
        valued = graph.join(scores, "instance")
        patterns = stored(valued.groupBy("pattern").agg(F.avg("score").alias("trust"), F.count("*").alias("support"))
                          .where(F.col("support") >= min_support), "pii-patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))))
        scores = stored(graph.join(patterns, "pattern", "left").groupBy("instance").agg(
            F.when(F.max("seed") > 0, 1.0).otherwise(
                F.coalesce(F.avg("trust"), F.lit(0.0)) * (1 - F.coalesce(doubt, F.lit(1.0)))).alias("score")), "pii-scores")
    trusted = patterns.where(F.col("trust") >= confident).select("pattern")
    sure = graph.join(trusted, "pattern", "left_semi").groupBy("instance").agg(F.lit(1).alias("n"))
    sure = sure.join(scores.where(F.col("score") >= confident / 2), "instance", "left_semi").select("instance")
    return named.where("seed is null").join(stored(sure, "pii-sure"), "instance", "left_semi").select(
        "doc_id", "key", "kind", "start", "end").distinct()


def personal_data(docs: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
                  confident: float = CONFIDENT) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs`` (doc_id, text): arrays of (kind, start, end) by kind and start.

    kind is an index into KINDS; start and end count code points. ``base`` has the fixed forms, ``spans``
    these and the discovered ones. Null texts are empty and have none. Repeated rows give repeated results; other
    columns are left out.
    """
    rows = base_spans(docs)
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = stored(rows.select("doc_id", "key", plain.alias("base")), "pii-base")
    more = discovered(rows, rounds, min_support, confident)
    more = more.groupBy("doc_id", "key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))
    more = stored(more, "pii-more").withColumnsRenamed({"doc_id": "d", "key": "k"})
    joined = base.join(more, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    empty = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return joined.select("doc_id", F.array_sort("base").alias("base"),
                         F.array_sort(F.concat("base", F.coalesce("more", empty))).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
