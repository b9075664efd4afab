"""Columns on the wire: JSON and fixed-width binary, and the Kafka source around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Event types of the binary format, by ordinal.
EVENT_TYPES = ("a", "b", "c", "d", "e", "f", "g")

KAFKA_COLUMNS = ("topic", "partition", "offset", "timestamp")


def decode_json(df: DataFrame, column: str, schema: str | StructType) -> DataFrame:
    """Replace a JSON text (or binary) column by its fields."""
    parsed = F.from_json(F.col(column).cast("string"), schema)
    rest = [c for c in df.columns if c != column]
    return df.withColumn("__json", parsed).select(*rest, "__json.*")


def encode_json(df: DataFrame, name: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


def int32_le(data: Column, offset: int) -> Column:
    """The signed little-endian 32-bit integer at a byte offset of a binary column."""
    octets = [F.hex(F.substring(data, offset + i + 1, 1)) for i in (3, 2, 1, 0)]
    unsigned = F.conv(F.concat(*octets), 16, 10).cast("long")
    return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned).cast("int")


def decode_event_binary(df: DataFrame, column: str, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Eight bytes: source address, then the ordinal of the event type."""
    names = F.array(*[F.lit(t) for t in types])
    rest = [c for c in df.columns if c != column]
    return df.select(
        *rest,
        int32_le(F.col(column), 0).alias("address"),
        F.get(names, int32_le(F.col(column), 4)).alias("type"),
    )


def int32_le_hex(number: Column) -> Column:
    """A 32-bit integer as eight hex digits, low byte first."""
    octets = [F.lpad(F.hex(F.shiftrightunsigned(number, n).bitwiseAND(F.lit(255)).cast("long")), 2, "0") for n in (0, 8, 16, 24)]
    return F.concat(*octets)


def encode_event_binary(df: DataFrame, address: str, kind: str, name: str = "value", types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    ordinal = F.array_position(F.array(*[F.lit(t) for t in types]), F.col(kind)).cast("int") - 1
    rest = [c for c in df.columns if c not in (address, kind)]
    return df.select(*rest, F.unhex(F.concat(int32_le_hex(F.col(address)), int32_le_hex(ordinal))).alias(name))


def kafka_options(servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None, **extra: str) -> dict[str, str]:
    """Options of the Kafka source. ``group`` starts like ``latest``: the checkpoint keeps the offsets."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest" if starting == "group" else starting,
        **extra,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def parse_kafka(df: DataFrame, value_schema: str | StructType, with_metadata: bool = False) -> DataFrame:
    """Fields of the JSON value; with metadata also key, topic, partition, offset, timestamp."""
    kept = [F.col("key").cast("string").alias("key"), *KAFKA_COLUMNS] if with_metadata else []
    return decode_json(df.select(*kept, "value"), "value", value_schema)


def read_kafka(spark: SparkSession, options: Mapping[str, str], value_schema: str | StructType, with_metadata: bool = False) -> DataFrame:
    return parse_kafka(spark.readStream.format("kafka").options(**dict(options)).load(), value_schema, with_metadata)


def read_change_events(stream: DataFrame, column: str = "value") -> DataFrame:
    """Change events as JSON text: database, table, type and the two row images."""
    schema = "database string, table string, type string, before map<string,string>, after map<string,string>"
    return decode_json(stream, column, schema)
