"""The operators over their whole tables, and the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontamination, licenses, linededup, merkle, minhash, mixing, pii, quality, runs, simhash, toxicity, webpages)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontamination.contaminated_spans(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    counts = [count(kind) for kind in range(len(pii.KINDS))]
    return out.select("doc_id", *counts, F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
                      pii.span_list(F.col("spans")).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.examples(rows.unionByName(own)))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.col("formatted_chars").cast("long").alias("formatted_chars"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = webpages.main_texts(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return out.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang")), F.col("n_chars") + 1, F.col("text"))
    out = merkle.manifest(docs, by="lang", order="doc_id", columns=("doc_id", "source", "lang", "n_chars", "text"),
                          carry={"changed": F.when(hit, changed)})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
                     folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _repeating(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth text by crc32 of its doc_id repeats a stretch of its words to the end."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    n, g = F.size("words"), F.expr("h div 10")
    docs = docs.withColumn("words", words).withColumn("plan", F.when(n > 0, F.struct((g % n).alias("a"), (g % 8 + 3).alias("d"))))
    a = F.col("plan.a")
    docs = docs.withColumn("p", F.expr("1 + (size(words) - plan.a) div plan.d"))
    # bound once, not once per word
    at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % F.col("p")))
    text = F.array_join(F.transform(F.arrays_zip(F.array("words").alias("w"), F.array(at).alias("at")), lambda x: F.array_join(
        F.transform(x["at"], lambda i: F.get(x["w"], i.cast("int"))), " ")), "")
    return docs.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, similarity=0.8)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.periodic_runs(_repeating(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select("doc_id", "runs", "collapsed", best.alias("best"), F.array_join(line, "").alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_line_dedup, op2_license_scan, op3_source_mix, op4_decontamination, op5_personal_data, op6_toxicity,
    op7_chat_format, op8_quality_rules, op9_html_extraction, op10_simhash_near_dedup,
    op11_merkle_manifest, op12_minhash_near_dedup, op13_periodic_runs)}

def _framed(*values: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


#: Unsigned crc32 of decimal text, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split({}, ''), lambda c: ord(c)::UBIGINT), lambda sum, byte: list_reduce(
    range(8)::UBIGINT[], lambda part, i: xor(part >> 1, 3988292384::UBIGINT * (part & 1)), xor(sum, byte)), 4294967295::UBIGINT),
    4294967295::UBIGINT)"""

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_line_dedup": f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
    SELECT doc_id, i, lines[i] AS line, {_LOWER.format(f"trim(lines[i], {_SPACE})")} AS key
    FROM docs, range(1, len(lines) + 1) AS r(i)),
firsts AS (
    SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
    SELECT doc_id, i, line, first IS NOT NULL AND doc_id <> first AS gone
    FROM lines LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op4_decontamination": f"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id::VARCHAR AS id, text FROM documents
    UNION ALL SELECT 'i', item_id::VARCHAR, text FROM benchmark),
words AS (
    SELECT kind, id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")},
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM texts),
items AS (
    SELECT DISTINCT id, least(len(w), 10) AS size, list_slice(w, i, i + least(len(w), 10) - 1) AS gram
    FROM words, range(1, len(w) - least(len(w), 10) + 2) AS r(i) WHERE kind = 'i' AND len(w) > 0),
places AS (
    SELECT id, i, size, list_slice(w, i, i + size - 1) AS gram
    FROM words, (SELECT DISTINCT size FROM items) AS s, range(1, len(w) - size + 2) AS r(i) WHERE kind = 'd'),
hits AS (SELECT p.id AS doc, p.i, p.size, t.id AS item FROM places AS p JOIN items AS t USING (size, gram)),
covered AS (SELECT doc, count(DISTINCT i + j) AS n_hit FROM hits, range(0, size) AS r(j) GROUP BY doc),
named AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc, item FROM hits) GROUP BY doc)
SELECT id::BIGINT AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON doc = id LEFT JOIN named ON named.doc = id WHERE kind = 'd'""",
    "op7_chat_format": """
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, row_number() OVER w AS n, sum(23 + length(regexp_replace(replace(role, chr(92), chr(92) || chr(92)),
        '(<)(/?s>)|(\\[)(/?INST\\])', '\\1\\3' || chr(92) || chr(92) || '\\2\\4', 'g'))
        + length(regexp_replace(replace(text, chr(92), chr(92) || chr(92)),
        '(<)(/?s>)|(\\[)(/?INST\\])', '\\1\\3' || chr(92) || chr(92) || '\\2\\4', 'g'))) OVER w AS upto,
        count(*) OVER (PARTITION BY conv_id) AS total
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (WHERE role = 'assistant' OR n = total)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, coalesce('=' || lang, '') AS grp, {_framed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
        CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0
            THEN {_framed("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS changed
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY grp) AS n FROM rows),
tree AS (
    SELECT grp, 0 AS level, pos, n, leaf AS node FROM leaves
    UNION ALL
    SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(node || coalesce(other, ''))
    FROM (SELECT *, lead(node) OVER (PARTITION BY grp ORDER BY pos) AS other FROM tree WHERE n > 1) WHERE pos % 2 = 0),
subroots AS (
    SELECT grp, node, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
    SELECT 0 AS level, pos, n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(node || coalesce(other, ''))
    FROM (SELECT *, lead(node) OVER (ORDER BY pos) AS other FROM top WHERE n > 1) WHERE pos % 2 = 0),
climb AS (
    SELECT doc_id, grp, leaf, pos AS id, 0 AS level, pos, n, coalesce(changed, leaf) AS cur, '' AS proof FROM leaves
    UNION ALL
    SELECT c.doc_id, c.grp, c.leaf, c.id, c.level + 1, c.pos // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.pos % 2 = 1 THEN s.node || cur ELSE cur || coalesce(s.node, '') END), proof || coalesce(s.node, '')
    FROM climb AS c LEFT JOIN tree AS s ON s.grp = c.grp AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
ended AS (
    SELECT doc_id, leaf, c.grp, c.id, s.node AS subroot, s.pos, s.n, cur, proof
    FROM climb AS c JOIN subroots AS s USING (grp) WHERE c.n = 1),
climb2 AS (
    SELECT doc_id, leaf, grp, id, subroot, 0 AS level, pos, n, cur, proof FROM ended
    UNION ALL
    SELECT c.doc_id, c.leaf, c.grp, c.id, c.subroot, c.level + 1, c.pos // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.pos % 2 = 1 THEN s.node || cur ELSE cur || coalesce(s.node, '') END), proof || coalesce(s.node, '')
    FROM climb2 AS c LEFT JOIN top AS s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM climb2, (SELECT node AS root FROM top WHERE n = 1) WHERE n = 1""",
}
