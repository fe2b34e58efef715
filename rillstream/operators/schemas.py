"""Evolving and mixed-format event streams.

Every row carries its payload as JSON text with tags for type and version, the way
a registry-coded event carries its schema id.
"""

from __future__ import annotations

import gzip
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_evolved(df: DataFrame, reader_schema: str, writer_fields: Mapping[int, Sequence[str]],
                 defaults: Mapping[str, object], *, payload: str = "payload",
                 version: str = "version") -> DataFrame:
    """Rows of all versions in the reader's schema.

    A field that the writer's version did not have gets its default; a null that was
    written stays null.
    """
    parsed = df.withColumn("__r", F.from_json(payload, reader_schema))
    names = parsed.select("__r.*").columns
    fields = []
    for name in names:
        lacking = [v for v, known in writer_fields.items() if name not in known]
        field = F.col(f"__r.{name}")
        if lacking and name in defaults:
            field = F.when(F.col(version).isin(lacking), F.lit(defaults[name])).otherwise(field)
        fields.append(field.alias(name))
    rest = [c for c in df.columns if c not in (payload, *names)]
    return parsed.select(*rest, *fields)


def observed_fields(df: DataFrame, *, payload: str = "payload", group: str = "type",
                    version: str = "version") -> DataFrame:
    """Schema table of what was written: fields per group and version."""
    fields = df.select(group, version, F.explode(F.json_object_keys(payload)).alias("field"))
    return fields.groupBy(group, version, "field").agg(F.count(F.lit(1)).alias("rows_with"))


def incompatible_fields(schemas: DataFrame, *, group: str = "type",
                        version: str = "version") -> DataFrame:
    """Backward check: fields new in a version, without default.

    ``schemas``: group, version, field, has_default. Each version is held against the
    one before it; the first version of a group has nothing to break.
    """
    known = schemas.select(group, version).distinct()
    earlier = known.select(group, F.col(version).alias("__older"))
    base = (known.join(earlier, group).where(F.col("__older") < F.col(version))
            .groupBy(group, version).agg(F.max("__older").alias("__base")))
    checked = schemas.join(base, [group, version]).where(~F.col("has_default"))
    old = schemas.select(group, F.col(version).alias("__base"), "field")
    return (checked.join(old, [group, "__base", "field"], "left_anti")
            .select(group, version, "field"))


def demultiplex(df: DataFrame, schemas: Mapping[str, str], *, payload: str = "payload",
                tag: str = "type") -> DataFrame:
    """One struct column per known type, filled for rows of that type only."""
    typed = [F.when(F.col(tag) == name, F.from_json(payload, ddl)).alias(name.lower())
             for name, ddl in schemas.items()]
    return df.select(*[c for c in df.columns if c != payload], *typed)


def typed_or_generic(df: DataFrame, schemas: Mapping[str, str], *, payload: str = "payload",
                     tag: str = "type") -> DataFrame:
    """Known types as in `demultiplex`; all others as a schemaless value in ``generic``."""
    kept = demultiplex(df.withColumn("__p", F.col(payload)), schemas, payload=payload, tag=tag)
    other = F.when(~F.col(tag).isin(list(schemas)), F.parse_json("__p"))
    return kept.withColumn("generic", other).drop("__p")


def read_generic(df: DataFrame, *, payload: str = "payload") -> DataFrame:
    """Every payload under its own writer schema, as a schemaless value."""
    return df.withColumn("record", F.parse_json(payload)).drop(payload)


def of_types(df: DataFrame, types: Sequence[str], *, tag: str = "type") -> DataFrame:
    return df.where(F.col(tag).isin(list(types)))


def copy_with_schema(df: DataFrame, keep: Column | None = None) -> DataFrame:
    """Pass payloads on together with their schema tags, unread."""
    out = df if keep is None else df.where(keep)
    return out.select("format", "type", "version", "payload")


def as_json(df: DataFrame, schemas: Mapping[str, str], *, payload: str = "payload",
            tag: str = "type") -> DataFrame:
    """Each record as JSON text of its typed form."""
    text = F.coalesce(*[
        F.to_json(F.when(F.col(tag) == name, F.from_json(payload, ddl)))
        for name, ddl in schemas.items()])
    return df.withColumn("json", text).drop(payload)


def _nested(ddl: str) -> bool:
    return any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in T.StructType.fromDDL(ddl))


def write_payload(record: Column, fmt: Column, *, nested: bool = False) -> Column:
    """A record as text in the format named per row: json, xml or (records without nested fields) csv; null for others."""
    out = F.when(fmt == "json", F.to_json(record)).when(fmt == "xml", F.to_xml(record))
    return out if nested else out.when(fmt == "csv", F.to_csv(record))


def read_payload(payload: Column, fmt: Column, ddl: str) -> Column:
    """The record that `write_payload` wrote; only the row's own format is parsed. Null for other formats."""
    out = F.when(fmt == "json", F.from_json(payload, ddl)).when(fmt == "xml", F.from_xml(payload, ddl))
    return out if _nested(ddl) else out.when(fmt == "csv", F.from_csv(payload, F.lit(ddl)))


def demultiplex_formats(df: DataFrame, schemas: Mapping[str, str], *, payload: str = "payload", tag: str = "type",
                        fmt: str = "format") -> DataFrame:
    """`demultiplex` where each row names its format as well: one struct column per known type."""
    typed = [F.when(F.col(tag) == name, read_payload(F.col(payload), F.col(fmt), ddl)).alias(name.lower())
             for name, ddl in schemas.items()]
    return df.select(*[c for c in df.columns if c != payload], *typed)


def formats_as_json(df: DataFrame, schemas: Mapping[str, str], *, payload: str = "payload", tag: str = "type",
                    fmt: str = "format") -> DataFrame:
    """Each record, whatever its format, as JSON text of its typed form; null for unknown types and formats."""
    text = F.coalesce(*[F.to_json(F.when(F.col(tag) == name, read_payload(F.col(payload), F.col(fmt), ddl)))
                        for name, ddl in schemas.items()])
    return df.withColumn("json", text).drop(payload)


def multiplex(frames: Mapping[str, DataFrame], *, version: int = 1,
              fmt: str = "json") -> DataFrame:
    """Records of several types as one stream of tag and payload."""
    out: DataFrame | None = None
    for name, frame in frames.items():
        keys = [c for c in frame.columns if c.startswith("_")]
        body = [c for c in frame.columns if not c.startswith("_")]
        rows = frame.select(*keys, F.lit(fmt).alias("format"), F.lit(name).alias("type"),
                            F.lit(version).alias("version"),
                            F.to_json(F.struct(*body)).alias("payload"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no frames given")
    return out


def _gzip_column(data: Column, *, pack: bool) -> Column:
    """gzip per value in Arrow batches; Spark has no built-in for it.

    The worker function is local, so it travels by value and workers need no
    installed copy of this package.
    """

    def convert(values: pd.Series) -> pd.Series:
        def one(raw: bytes | None) -> bytes | None:
            if raw is None:
                return None
            return gzip.compress(bytes(raw), 6, mtime=0) if pack else gzip.decompress(bytes(raw))
        return values.map(one)

    return F.pandas_udf(convert, T.BinaryType())(data)


def _bytes(data: Column, start: Column | int, length: Column | int) -> Column:
    return F.substring(data, start, length)


def encode(data: Column, codec: Column) -> Column:
    """Binary payload in the codec named per row: none, gzip, or mycompression (rotate left)."""
    size = F.octet_length(data)
    rotated = F.when(size == 0, data).otherwise(
        F.concat(_bytes(data, F.lit(2), size), _bytes(data, 1, 1)))
    return (F.when(codec == "none", data).when(codec == "mycompression", rotated)
            .otherwise(_gzip_column(F.when(codec == "gzip", data), pack=True)))


def decode(data: Column, codec: Column) -> Column:
    """Undo `encode`. Only gzip payloads leave the JVM; other rows send nulls there."""
    size = F.octet_length(data)
    rotated = F.when(size == 0, data).otherwise(
        F.concat(_bytes(data, size, F.lit(1)), _bytes(data, F.lit(1), size - 1)))
    return (F.when(codec == "none", data).when(codec == "mycompression", rotated)
            .otherwise(_gzip_column(F.when(codec == "gzip", data), pack=False)))


def codecs_seen(df: DataFrame, codec: str = "codec") -> DataFrame:
    return df.groupBy(codec).agg(F.count(F.lit(1)).alias("events"))
