"""Evolving and mixed-format streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import schemas
from . import inputs
from .inputs import MIXED, TYPED
from .registry import query

# Fixed writer versions of the evolving record and the default of its later field.
WRITER_FIELDS = {1: ["a"], 2: ["a", "b"]}
DEFAULTS = {"b": "not written by version 1"}


@query(f"""SELECT event_id, version, name AS a,
  CASE WHEN version = 1 THEN '{DEFAULTS["b"]}' ELSE 'value' END AS b
  FROM {MIXED} WHERE type = 'Record'""")
def evolved_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = schemas.of_types(inputs.mixed_stream(spark, sf_dir), ["Record"])
    return schemas.read_evolved(records, "a string, b string", WRITER_FIELDS, DEFAULTS).select(
        "event_id", "version", "a", "b")


@query(f"""SELECT type, version, f.field, count(*) AS rows_with FROM (
    SELECT type, version, unnest(json_keys(payload)) AS field FROM {MIXED}) f GROUP BY ALL""")
def observed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.observed_fields(inputs.mixed_stream(spark, sf_dir))


_FIELDS = f"""(SELECT DISTINCT type, version, unnest(json_keys(payload)) AS field FROM (
  SELECT type, version, payload FROM {MIXED}
  UNION ALL SELECT type, 3, payload FROM {MIXED} WHERE type = 'Type2'
  UNION ALL SELECT 'Type1', 2, payload FROM {MIXED} WHERE type = 'Type2'))"""


@query(f"""SELECT n.type, n.version, n.field FROM {_FIELDS} n
  WHERE n.field <> 'b'
    AND EXISTS (SELECT 1 FROM {_FIELDS} o WHERE o.type = n.type AND o.version < n.version)
    AND NOT EXISTS (SELECT 1 FROM {_FIELDS} o WHERE o.type = n.type AND o.field = n.field
      AND o.version = (SELECT max(version) FROM {_FIELDS} p
                       WHERE p.type = n.type AND p.version < n.version))""")
def incompatible_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas as observed; a later Type1 with Type2's fields breaks readers, b has a default."""
    mixed = inputs.mixed_stream(spark, sf_dir)
    second = mixed.where("type = 'Type2'")
    written = (mixed.unionByName(second.withColumn("version", F.lit(3)))
               .unionByName(second.withColumn("version", F.lit(2))
                            .withColumn("type", F.lit("Type1"))))
    table = schemas.observed_fields(written).select(
        "type", "version", "field", (F.col("field") == "b").alias("has_default"))
    return schemas.incompatible_fields(table)


_TYPED = """event_id, type, CASE WHEN type = 'Type1' THEN name END AS a,
  CASE WHEN type = 'Type1' THEN k END AS b, CASE WHEN type = 'Type2' THEN name END AS c,
  CASE WHEN type = 'Type2' THEN k END AS d, CASE WHEN type = 'Type2' THEN name END AS e"""


@query(f"""SELECT {_TYPED}, CASE WHEN type = 'Type3' THEN name END AS f,
  CASE WHEN type = 'Type3' THEN k END AS g, CASE WHEN type = 'Type3' THEN name END AS h,
  CASE WHEN type = 'Type3' THEN name END AS i, CASE WHEN type = 'Record' THEN name END AS record_a,
  CASE WHEN type = 'Record' AND version = 2 THEN 'value' END AS record_b FROM {MIXED}""")
def typed_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {**TYPED, "Record": "a string, b string"}
    return schemas.demultiplex(inputs.mixed_stream(spark, sf_dir), known).select(
        "event_id", "type", "type1.a", "type1.b", "type2.c", "type2.d", "type2.e", "type3.f",
        "type3.g", "type3.h", "type3.i", F.col("record.a").alias("record_a"),
        F.col("record.b").alias("record_b"))


@query(f"""SELECT {_TYPED}, CASE WHEN type = 'Type3' THEN name END AS generic_f,
  CASE WHEN type NOT IN ('Type1', 'Type2') THEN payload END AS generic FROM {MIXED}""")
def typed_or_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {name: TYPED[name] for name in ("Type1", "Type2")}
    out = schemas.typed_or_generic(inputs.mixed_stream(spark, sf_dir), known)
    return out.select(
        "event_id", "type", "type1.a", "type1.b", "type2.c", "type2.d", "type2.e",
        F.try_variant_get("generic", "$.f", "string").alias("generic_f"),
        F.col("generic").cast("string").alias("generic"))


@query(f"""SELECT event_id, type, version, payload AS record,
  json_extract_string(payload, '$.a') AS a FROM {MIXED}""")
def generic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schemas.read_generic(inputs.mixed_stream(spark, sf_dir))
    return out.select("event_id", "type", "version", F.col("record").cast("string").alias("record"),
                      F.try_variant_get("record", "$.a", "string").alias("a"))


@query(f"SELECT event_id, type, payload FROM {MIXED} WHERE type IN ('Type1', 'Type3')")
def type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.of_types(inputs.mixed_stream(spark, sf_dir), ["Type1", "Type3"]).select(
        "event_id", "type", "payload")


@query(f"SELECT format, type, version, payload FROM {MIXED} WHERE type <> 'Type2'")
def mixed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.copy_with_schema(inputs.mixed_stream(spark, sf_dir), F.col("type") != "Type2")


@query(f"SELECT event_id, type, payload AS json FROM {MIXED}")
def records_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {**TYPED, "Record": "a string, b string"}
    return schemas.as_json(inputs.mixed_stream(spark, sf_dir), known).select(
        "event_id", "type", "json")


@query("""SELECT 'json' AS format, 'Order' AS type, 1 AS version,
    json_object('key', o_orderkey, 'status', o_orderstatus)::VARCHAR AS payload FROM orders
  UNION ALL SELECT 'json', 'Customer', 1,
    json_object('key', c_custkey, 'name', c_name, 'segment', c_mktsegment)::VARCHAR FROM customer""")
def multi_type_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    customers = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    return schemas.multiplex({"Order": orders, "Customer": customers})


_CODEC = "case doc_id % 3 when 0 then 'gzip' when 1 then 'none' else 'mycompression' end"


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(_CODEC).alias("codec"), F.col("text").cast("binary").alias("data"))
    return documents.select("doc_id", "codec",
                            schemas.encode(F.col("data"), F.col("codec")).alias("payload"))


@query(f"""SELECT doc_id, {_CODEC} AS codec, md5(text) AS digest, strlen(text) AS bytes
  FROM documents""")
def codec_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _coded(spark, sf_dir).select(
        "doc_id", "codec", schemas.decode(F.col("payload"), F.col("codec")).alias("data"))
    return decoded.select("doc_id", "codec", F.md5("data").alias("digest"),
                          F.octet_length("data").cast("long").alias("bytes"))


@query(f"SELECT {_CODEC} AS codec, count(*) AS events FROM documents GROUP BY 1")
def codecs_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.codecs_seen(_coded(spark, sf_dir))


_ORDER = "key bigint, status string, priority string"
_USER = "name string, address struct<nation:int,house:int>"
# A subtype has the fields of its base type first.
FORMATTED = {"Order": _ORDER, "User": _USER, "KeyUser": f"{_USER}, segment string"}
_ORDER_FORMAT = "case o_orderkey % 3 when 0 then 'csv' when 1 then 'xml' else 'json' end"
_USER_FORMAT = "case when c_custkey % 3 = 0 then 'xml' else 'json' end"


def _formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three formats, and users of two types with a nested address in two."""
    order = F.struct(F.col("o_orderkey").cast("bigint").alias("key"), F.col("o_orderstatus").alias("status"),
                     F.col("o_orderpriority").alias("priority"))
    orders = inputs.table(spark, sf_dir, "orders").withColumn("format", F.expr(_ORDER_FORMAT)).select(
        F.col("o_orderkey").alias("id"), F.lit("Order").alias("type"), "format",
        schemas.write_payload(order, F.col("format")).alias("payload"))
    base = [F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").cast("int").alias("nation"), F.expr("cast(c_custkey % 100 as int)").alias("house")).alias("address")]
    key_user = F.col("c_custkey") % 4 == 0
    customers = inputs.table(spark, sf_dir, "customer").withColumn("format", F.expr(_USER_FORMAT))
    users = customers.select(
        F.col("c_custkey").alias("id"), F.when(key_user, "KeyUser").otherwise("User").alias("type"), "format",
        F.when(key_user, schemas.write_payload(F.struct(*base, F.col("c_mktsegment").alias("segment")),
                                               F.col("format"), nested=True))
        .otherwise(schemas.write_payload(F.struct(*base), F.col("format"), nested=True)).alias("payload"))
    return orders.unionByName(users)


_ADDRESS = "json_object('nation', c_nationkey, 'house', c_custkey % 100)"


@query(f"""SELECT o_orderkey AS id, 'Order' AS type, {_ORDER_FORMAT} AS format,
    json_object('key', o_orderkey, 'status', o_orderstatus, 'priority', o_orderpriority)::VARCHAR AS json FROM orders
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'KeyUser' ELSE 'User' END, {_USER_FORMAT},
    CASE WHEN c_custkey % 4 = 0
      THEN json_object('name', c_name, 'address', {_ADDRESS}, 'segment', c_mktsegment)::VARCHAR
      ELSE json_object('name', c_name, 'address', {_ADDRESS})::VARCHAR END FROM customer""")
def formats_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.formats_as_json(_formatted(spark, sf_dir), FORMATTED).select("id", "type", "format", "json")


@query("""SELECT c_custkey AS id, c_name AS name, c_nationkey::INTEGER AS nation, (c_custkey % 100)::INTEGER AS house,
  CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS segment FROM customer""")
def nested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of both types by the fields of the base type, out of both formats."""
    read = schemas.demultiplex_formats(_formatted(spark, sf_dir).where("type <> 'Order'"), FORMATTED)

    def field(name: str) -> Column:
        return F.coalesce(F.col(f"user.{name}"), F.col(f"keyuser.{name}"))

    return read.select("id", field("name").alias("name"), field("address.nation").alias("nation"),
                       field("address.house").alias("house"), F.col("keyuser.segment").alias("segment"))
