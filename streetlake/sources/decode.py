"""Decode Kafka-shaped records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EVENT_FIELDS, KAFKA_FIELDS, WIRE_SCHEMA


def decode_events(df: DataFrame, keep_value: bool = True) -> DataFrame:
    """JSON ``value`` -> typed event columns + broker offset/partition/time.

    Corrupt text gives an all-null event, a badly typed field a null field;
    an unparseable ISO time gives a null ``event_ts`` (ANSI-safe ``try_``).
    Works unchanged on streaming frames.
    """
    text = F.col("value").cast("string")
    parsed = df.select(
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("timestamp").cast("timestamp").alias("kafka_ingest_ts"),
        text.alias("value"),
        F.from_json(text, WIRE_SCHEMA, {"mode": "PERMISSIVE"}).alias("data"),
    )
    cols = []
    for c in EVENT_FIELDS:
        if c == "event_ts":
            cols.append(F.try_to_timestamp(F.col("data.timestamp")).alias("event_ts"))
        else:
            cols.append(F.col("data." + c).alias(c))
    cols += [F.col(c) for c in KAFKA_FIELDS]
    if keep_value:
        cols.append(F.col("value"))
    return parsed.select(*cols)
