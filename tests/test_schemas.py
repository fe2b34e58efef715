"""Schema evolution, mixed records and codecs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstream.operators import schemas

TYPES = {"Type1": "a string, b int", "Type2": "c string, d int, e string"}


def mixed(spark):
    return spark.createDataFrame([
        ("json", "Type1", 1, '{"a":"x","b":1}'),
        ("json", "Type2", 1, '{"c":"y","d":2,"e":"z"}'),
        ("json", "Type3", 1, '{"f":"w","g":3}'),
    ], "format string, type string, version int, payload string")


def test_old_rows_get_defaults_and_written_nulls_stay(spark):
    df = spark.createDataFrame([(1, '{"a":"test"}'), (2, '{"a":"test","b":"value"}'),
                                (2, '{"a":"test","b":null}')], "version int, payload string")
    out = schemas.read_evolved(df, "a string, b string", {1: ["a"], 2: ["a", "b"]},
                               {"b": "backwardPolicy compatible with schema1"})
    assert [r["b"] for r in out.collect()] == ["backwardPolicy compatible with schema1", "value", None]


def test_field_without_default_is_rejected(spark):
    table = spark.createDataFrame(
        [("g", 1, "a", False), ("g", 2, "a", False), ("g", 2, "b", True),
         ("g", 3, "a", False), ("g", 3, "b", False), ("g", 3, "c", False)],
        "type string, version int, field string, has_default boolean")
    bad = schemas.incompatible_fields(table).collect()
    assert [tuple(r) for r in bad] == [("g", 3, "c")]


def test_typed_typed_generic(spark):
    out = schemas.typed_or_generic(mixed(spark), TYPES).orderBy("type").collect()
    assert out[0]["type1"].a == "x" and out[0]["generic"] is None
    assert out[1]["type2"].d == 2 and out[1]["type1"] is None
    assert out[2]["generic"].toPython() == {"f": "w", "g": 3}


def test_multiplex_and_back(spark):
    frames = {"Type1": spark.createDataFrame([("x", 1)], TYPES["Type1"]),
              "Type2": spark.createDataFrame([("y", 2, "z")], TYPES["Type2"])}
    stream = schemas.multiplex(frames)
    got = schemas.as_json(stream, TYPES).orderBy("type").collect()
    assert [r["json"] for r in got] == ['{"a":"x","b":1}', '{"c":"y","d":2,"e":"z"}']
    assert schemas.copy_with_schema(stream, F.col("type") == "Type2").count() == 1
    assert schemas.demultiplex(stream, TYPES).where("type1.b = 1").count() == 1


def test_codecs(spark):
    rows = [(c, d) for c in ("none", "gzip", "mycompression")
            for d in (b"", b"a", b"hello", bytes(range(256)), None)]
    df = spark.createDataFrame(rows, "codec string, data binary")
    coded = df.withColumn("coded", schemas.encode(F.col("data"), F.col("codec")))
    back = coded.withColumn("back", schemas.decode(F.col("coded"), F.col("codec")))
    assert back.where("not (back <=> data)").count() == 0
    assert back.where("codec = 'mycompression' and data = cast('hello' as binary) "
                      "and coded = cast('elloh' as binary)").count() == 1
    assert back.where("codec = 'gzip' and hex(coded) not like '1F8B%'").count() == 0
    assert {r["codec"]: r["events"] for r in schemas.codecs_seen(df).collect()} == {
        "none": 5, "gzip": 5, "mycompression": 5}


def test_formats_of_payloads(spark):
    """Commas, quotes, markup and line ends survive each format; other formats and broken payloads give null."""
    texts = ["a,b", 'say "x"', "<i>&amp;</i>", "two\nlines", "é"]
    rows = [(i, f, t) for i, t in enumerate(texts) for f in ("json", "csv", "xml")]
    df = spark.createDataFrame(rows, "n long, format string, t string")
    written = df.select("n", "format", "t", schemas.write_payload(F.struct("n", "t"), F.col("format")).alias("payload"))
    read = written.select("n", "t", schemas.read_payload(F.col("payload"), F.col("format"), "n long, t string").alias("r"))
    assert all((r["n"], r["t"]) == tuple(r["r"]) for r in read.collect())
    odd = spark.createDataFrame([("A", "json", '{"n": '), ("A", "avro", "x"), ("B", "json", '{"n": 1}'), ("A", "json", None)],
                                "type string, format string, payload string")
    assert [r["json"] in (None, "{}") for r in schemas.formats_as_json(odd, {"A": "n long"}).collect()] == [True] * 4
