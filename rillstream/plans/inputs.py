"""How the given tables stand in for the streams and tables the queries read.

Each stand-in exists twice: as a DataFrame, and as SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import previous_row
from ..sources.files import table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number inside their JSON properties as column k."""
    return table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))


EVENTS = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("ride_id"),
        F.expr("cast(user_id % 5 as int)").alias("vendor_id"),
        F.col("ts").alias("pickup_time"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("k"))).alias("dropoff_time"),
        F.expr("case when k % 10 <> 0 then k % 7 end").alias("passenger_count"),
        F.col("value").alias("trip_distance"),
        F.expr("cast(user_id % 25 as int)").alias("start_location_id"),
        F.expr("k % 25").alias("dest_location_id"))


RIDES = f"""(SELECT event_id AS ride_id, CAST(user_id % 5 AS INTEGER) AS vendor_id,
  ts AS pickup_time, ts + to_minutes(k) AS dropoff_time,
  CASE WHEN k % 10 <> 0 THEN k % 7 END AS passenger_count, value AS trip_distance,
  CAST(user_id % 25 AS INTEGER) AS start_location_id, k % 25 AS dest_location_id
  FROM {EVENTS})"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"), F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("service "), F.col("r_regionkey").cast("string")).alias("service_zone"))


ZONES = """(SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
  'service ' || r_regionkey AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log: one stream per event type, five segments, offsets in write order.

    Payloads read ``<stream>:day<N>:<number>``.
    """
    day = F.datediff(F.col("ts"), F.lit("2024-01-01"))
    return events(spark, sf_dir).select(
        F.concat(F.substring("event_type", 1, 1), F.lit(":day"), day.cast("string"), F.lit(":"),
                 F.expr("k % 20").cast("string")).alias("event"),
        F.lit("examples").alias("scope"), F.col("event_type").alias("stream"),
        F.expr("cast(user_id % 5 as int)").alias("segment_id"),
        F.col("event_id").alias("offset"), F.col("user_id").cast("string").alias("routing_key"),
        F.col("ts").alias("event_time"))


LOG = f"""(SELECT left(event_type, 1) || ':day'
    || CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS VARCHAR)
    || ':' || CAST(k % 20 AS VARCHAR) AS event,
  'examples' AS scope, event_type AS stream, CAST(user_id % 5 AS INTEGER) AS segment_id,
  event_id AS "offset", CAST(user_id AS VARCHAR) AS routing_key, ts AS event_time
  FROM {EVENTS})"""


def network_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.expr("cast((user_id * 2654435761) % 4294967296 - 2147483648 as int)")
        .alias("source_address"),
        F.expr("k % 7 + 1").alias("event"), F.col("ts").alias("event_time"),
        F.concat(F.lit("net-"), F.expr("k % 10").cast("string")).alias("network_id"),
        F.expr("cast(user_id % 180 as double) - 89.5").alias("lat"),
        F.expr("cast(user_id * 7 % 360 as double) - 179.75").alias("lon"),
        F.col("event_id").alias("offset"))


NETWORK = f"""(SELECT
  CAST((user_id * 2654435761) % 4294967296 - 2147483648 AS INTEGER) AS source_address,
  k % 7 + 1 AS event, ts AS event_time, 'net-' || CAST(k % 10 AS VARCHAR) AS network_id,
  CAST(user_id % 180 AS DOUBLE) - 89.5 AS lat, CAST(user_id * 7 % 360 AS DOUBLE) - 179.75 AS lon,
  event_id AS "offset" FROM {EVENTS})"""


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records in JSON: a user's row is set by each event and deleted by an error."""
    source = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                                   "value")
    rows = previous_row(source, ["user_id"], "event_id", ["event_type", "value"])
    live = F.coalesce(F.col("previous.event_type") != "error", F.lit(False))
    gone = F.col("event_type") == "error"
    image = "struct<id:string,value:double>"
    key = F.col("user_id").cast("string").alias("id")
    before = F.when(live, F.struct(key, F.col("previous.value").alias("value")).cast(image))
    after = F.when(~gone, F.struct(key, "value").cast(image))
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    op = F.when(gone, "d").when(live, "u").otherwise("c")
    kept = rows.where(~(gone & ~live))
    return kept.select(F.to_json(F.struct(
        before.alias("before"), after.alias("after"),
        F.struct(millis.alias("ts_ms"), F.lit("stock").alias("db"), F.lit("stock").alias("table"),
                 F.lit("binlog.000002").alias("file"), F.col("event_id").alias("pos"),
                 F.lit(0).alias("row")).alias("source"),
        op.alias("op"), millis.alias("ts_ms"))).alias("event"))


CHANGES = """(SELECT CAST(user_id AS VARCHAR) AS id,
  CASE WHEN event_type = 'error' THEN 'd' WHEN live THEN 'u' ELSE 'c' END AS op,
  CASE WHEN live THEN pv END AS before_value,
  CASE WHEN event_type <> 'error' THEN value END AS after_value,
  event_id AS pos, (epoch_us(ts) // 1000) AS ts_ms
  FROM (SELECT *, lag(value) OVER w AS pv,
          coalesce(lag(event_type) OVER w <> 'error', false) AS live
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
  WHERE NOT (event_type = 'error' AND NOT live))"""


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("sector"))


SECTORS = "(SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS sector FROM customer)"

_OPS = ("case when event_type = 'error' and k = 99 then 'clear' else {} end")
_OP_NAMES = ["put", "putIfAbsent", "remove", "removeIf", "replace", "replaceIf", "put",
             "putIfAbsent"]


def map_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("rev"),
        F.expr(_OPS.format(f"element_at(array({str(_OP_NAMES)[1:-1]}), k % 8 + 1)")).alias("op"),
        F.concat(F.lit("key-"), F.col("user_id").cast("string")).alias("key"),
        F.concat(F.lit("v"), F.expr("k % 3").cast("string")).alias("value"),
        F.concat(F.lit("v"), F.expr("event_id % 3").cast("string")).alias("expected"))


MAP_UPDATES = f"""(SELECT event_id AS rev,
  {_OPS.format(f"list_extract({_OP_NAMES}, k % 8 + 1)")} AS op,
  'key-' || CAST(user_id AS VARCHAR) AS key, 'v' || CAST(k % 3 AS VARCHAR) AS value,
  'v' || CAST(event_id % 3 AS VARCHAR) AS expected FROM {EVENTS})"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("#c"), F.col("conv_id").cast("string")).alias("channel"),
        F.col("turn").alias("offset"), F.col("role").alias("from_user"), "text")


MESSAGES = """(SELECT '#c' || CAST(conv_id AS VARCHAR) AS channel, turn AS "offset",
  role AS from_user, text FROM conversations)"""


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who spoke in a channel follows it from their first message on."""
    return messages(spark, sf_dir).groupBy(F.col("from_user").alias("user"), "channel").agg(
        (F.min("offset") + 1).alias("position"))


SUBSCRIPTIONS = f"""(SELECT from_user AS "user", channel, min("offset") + 1 AS position
  FROM {MESSAGES} GROUP BY ALL)"""

_TYPES = ("case event_type when 'click' then 'Type1' when 'view' then 'Type2' "
          "when 'purchase' then 'Type3' else 'Record' end")
_VERSIONS = "case event_type when 'error' then 2 else 1 end"

# Fixed record types of the mixed stream.
TYPED = {
    "Type1": "a string, b int",
    "Type2": "c string, d int, e string",
    "Type3": "f string, g int, h string, i string",
}


def mixed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tagged payloads of four record types, one of them in two versions."""
    name = F.concat("event_type", F.lit("-"), F.col("user_id").cast("string"))
    number = F.col("k")

    def body(*fields: str) -> Column:
        kinds = {"b": number, "d": number, "g": number}
        return F.to_json(F.struct(*[kinds.get(f, name).alias(f) for f in fields]))

    payload = (F.when(F.col("event_type") == "click", body("a", "b"))
               .when(F.col("event_type") == "view", body("c", "d", "e"))
               .when(F.col("event_type") == "purchase", body("f", "g", "h", "i"))
               .when(F.col("event_type") == "signup",
                     F.to_json(F.struct(name.alias("a"))))
               .otherwise(F.to_json(F.struct(name.alias("a"), F.lit("value").alias("b")))))
    return events(spark, sf_dir).select(
        "event_id", F.lit("json").alias("format"), F.expr(_TYPES).alias("type"),
        F.expr(_VERSIONS).alias("version"), payload.alias("payload"))


MIXED = f"""(SELECT event_id, 'json' AS format, {_TYPES} AS type, {_VERSIONS} AS version,
  event_type || '-' || CAST(user_id AS VARCHAR) AS name, k,
  CASE event_type
    WHEN 'click' THEN '{{"a":"' || event_type || '-' || user_id || '","b":' || k || '}}'
    WHEN 'view' THEN '{{"c":"' || event_type || '-' || user_id || '","d":' || k
      || ',"e":"' || event_type || '-' || user_id || '"}}'
    WHEN 'purchase' THEN '{{"f":"' || event_type || '-' || user_id || '","g":' || k
      || ',"h":"' || event_type || '-' || user_id || '","i":"' || event_type || '-' || user_id || '"}}'
    WHEN 'signup' THEN '{{"a":"' || event_type || '-' || user_id || '"}}'
    ELSE '{{"a":"' || event_type || '-' || user_id || '","b":"value"}}' END AS payload
  FROM {EVENTS})"""
