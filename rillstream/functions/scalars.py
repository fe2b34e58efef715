"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dotted_address(address: Column) -> Column:
    """32-bit integer to dotted IPv4, top byte first."""
    number = address.cast("int")
    return F.concat_ws(".", *[
        F.shiftrightunsigned(number, bits).bitwiseAND(255).cast("string")
        for bits in (24, 16, 8, 0)])


def event_letter(code: Column) -> Column:
    """Event code 1, 2, … to a, b, …"""
    return F.char(code + 96)


def iso_millis(millis: Column) -> Column:
    """Epoch milliseconds to an ISO-8601 UTC instant (session zone UTC)."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def wall_clock(seconds: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch seconds to the wall clock of a zone, as a zoneless timestamp."""
    return F.from_utc_timestamp(F.timestamp_seconds(seconds), zone).cast("timestamp_ntz")


def parse_seconds(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zoneless timestamp."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def direct_channel(one: Column, other: Column) -> Column:
    """Name of the two-person channel: both names sorted, joined by a dash."""
    return F.array_join(F.array_sort(F.array(one, other)), "-")


def channel_name(name: Column) -> Column:
    """Public channel names carry a leading ``#``."""
    return F.when(name.startswith("#"), name).otherwise(F.concat(F.lit("#"), name))


def channel_stream(name: Column) -> Column:
    """Stream that backs a channel: the name without its ``#``."""
    return F.when(name.startswith("#"), F.substring(name, 2, 1 << 30)).otherwise(name)


def chat_line(user: Column, text: Column) -> Column:
    return F.concat(F.lit("["), user, F.lit("] "), text)


def padded_key(key: Column, width: int) -> Column:
    """Right-align a key to a fixed width; longer keys are an error, never cut."""
    return F.when(F.length(key) <= width, F.lpad(key, width, " ")).otherwise(
        F.raise_error(F.concat(F.lit("key too long: "), key)).cast("string"))


def unpadded_key(key: Column) -> Column:
    return F.trim(key)


def lat_lon(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))


def payload_field(payload: Column, index: int, separator: str = ":") -> Column:
    """Field ``index`` (from 0) of a separated payload."""
    return F.element_at(F.split(payload, separator), index + 1)


def base_counts(sequence: Column, bases: str = "ACGT") -> list[Column]:
    """Occurrences of each base letter."""
    return [(F.length(sequence) - F.length(F.replace(sequence, F.lit(b), F.lit("")))).cast("long")
            .alias(f"n_{b.lower()}") for b in bases]


def sensor_reading(line: Column) -> Column:
    """Parse ``"millis, id, location, temperature"``, right-padded or not."""
    parts = F.split(F.rtrim(line), ", ")
    return F.struct(
        F.get(parts, F.lit(0)).cast("long").alias("timestamp"),
        F.get(parts, F.lit(1)).cast("int").alias("sensor_id"),
        F.get(parts, F.lit(2)).alias("location"),
        F.get(parts, F.lit(3)).cast("float").alias("temp"))


def sensor_line(millis: Column, sensor: Column, location: Column, temp: Column,
                width: int = 100) -> Column:
    """Write a reading the way the sensors do, padded to ``width``."""
    text = F.concat_ws(", ", millis.cast("string"), sensor.cast("string"), location,
                       temp.cast("string"))
    return F.when(F.length(text) >= width, text).otherwise(F.rpad(text, width, " "))


def routed_json(columns: list[str]) -> Column:
    """Row to JSON text."""
    return F.to_json(F.struct(*columns))


def lower_camel(name: str) -> str:
    """``pu_location_id`` to ``puLocationId``."""
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def camel_json(columns: list[str]) -> Column:
    """Row to JSON text with lowerCamel field names."""
    return F.to_json(F.struct(*[F.col(c).alias(lower_camel(c)) for c in columns]))
