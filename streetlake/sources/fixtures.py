"""Adapter from the driver's generic ``events`` table to traffic-camera events.

The rules below are fixed values of the test fixture (see FIXTURES.md §3): every
validity rule gets failing rows and 1 event in 89 is delivered twice.  The
adapter is a single scan of ``events``: the second delivery is produced with an
``explode`` instead of a self-union, and the registry lookup is a broadcast of
the 12-row seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.registry import CAMERA_REGISTRY
from ..schema import RAW_FIELDS, WIRE_FIELDS

# --- fixed values of the fixture adapter --------------------------------------
DUPLICATE_EVERY = 89            # n % 89 = 0 is delivered twice
DUPLICATE_OFFSET = 100_000_000  # kafka offset of the second delivery
NULL_CAMERA_EVERY = 211
BAD_CAMERA_EVERY = 223
NULL_TS_EVERY = 401
BAD_LAT_EVERY = 307
BAD_LON_EVERY = 311
NULL_SPEED_EVERY = 157
FORCED_CRITICAL_EVERY = 97
N_CAMERAS = 12
INGEST_DELAY_SECONDS = 2


def traffic_raw(events: DataFrame) -> DataFrame:
    """``events`` -> decoded raw traffic events (the RAW frame, no ``value``)."""
    n = F.col("event_id")
    base = events.select(
        n.alias("n"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
        F.concat(F.lit("CAM_"),
                 F.lpad((F.col("user_id") % N_CAMERAS + 1).cast("string"), 2, "0")).alias("cam"),
        (((n * 37) % 1040).cast("double") / 10).alias("score"),
        # delivery copies: 0 always, 1 for the re-delivered events
        F.explode(F.when(n % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    # The 12 seeded cameras are a fixed lookup: a literal map replaces the
    # join (no broadcast stage); unknown ids are dropped as an inner join would.
    lookup = F.create_map(*[x for cam, loc, lat, lon, _ in CAMERA_REGISTRY
                            for x in (F.lit(cam), F.struct(F.lit(loc).alias("location"),
                                                           F.lit(lat).alias("latitude"),
                                                           F.lit(lon).alias("longitude")))])
    d = (base.withColumn("_r", F.element_at(lookup, F.col("cam")))
         .filter(F.col("_r").isNotNull())
         .select("*", "_r.location", "_r.latitude", "_r.longitude"))
    k = F.col("k")
    n = F.col("n")
    score = F.col("score")
    out = d.select(
        n.cast("string").alias("event_id"),
        F.when(n % NULL_CAMERA_EVERY == 0, F.lit(None).cast("string"))
         .when(n % BAD_CAMERA_EVERY == 0, F.concat(F.lit("X"), F.col("cam")))
         .otherwise(F.col("cam")).alias("camera_id"),
        F.when(n % NULL_TS_EVERY == 0, F.lit(None).cast("timestamp"))
         .otherwise(F.col("ts")).alias("event_ts"),
        F.col("location"),
        F.when(n % BAD_LAT_EVERY == 0, F.lit(95.0)).otherwise(F.col("latitude")).alias("latitude"),
        F.when(n % BAD_LON_EVERY == 0, F.lit(-190.0)).otherwise(F.col("longitude")).alias("longitude"),
        F.floor((k * k * k).cast("double") / 470).cast("int").alias("vehicle_count"),
        F.when(n % NULL_SPEED_EVERY == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("average_speed"),
        F.when((n % FORCED_CRITICAL_EVERY == 0) | (score >= 75), "CRITICAL")
         .when(score >= 50, "HIGH").when(score >= 25, "MEDIUM").otherwise("LOW")
         .alias("congestion_level"),
        score.alias("congestion_score"),
        (F.col("event_type") == "error").alias("accident_detected"),
        (n % 81).cast("int").alias("pedestrian_count"),
        (F.lit(5.0) + ((n * 13) % 201).cast("double") / 10).alias("heavy_vehicle_pct"),
        F.lit("2.4.1").alias("producer_version"),
        F.lit("1.0").alias("schema_version"),
        (n + F.col("copy") * DUPLICATE_OFFSET).alias("kafka_offset"),
        (F.col("user_id") % N_CAMERAS).cast("int").alias("kafka_partition"),
        (F.col("ts") + F.expr(f"INTERVAL {INGEST_DELAY_SECONDS} SECONDS")).alias("kafka_ingest_ts"),
    )
    return out.select(*RAW_FIELDS)


# --- fixed values of the rough variant (FIXTURES.md §5) ------------------------
NO_ID_EVERY = 13                # n % 13 = 0: delivered without an event id
NO_OFFSET_EVERY = 3             # n % 3 = 0: without partition and offset
CONSTANT_CAMERA = "CAM_11"
CONSTANT_SPEED = 50.0000001
# ingest delay of a second delivery, in seconds, by n % 4: none, 20 s, 20 min, 6 days
SECOND_DELIVERY_DELAY = [0, 20, 1_200, 518_400]


def traffic_rough(raw: DataFrame) -> DataFrame:
    """``traffic_raw`` as a careless producer and broker would deliver it: events
    without an id, rows without offsets, speeds of seven decimals, one camera
    that always reads the same, second deliveries that come late."""
    n = F.col("event_id").cast("long")
    second = F.col("kafka_offset") != n
    delay = F.element_at(F.array(*[F.lit(s) for s in SECOND_DELIVERY_DELAY]), (n % len(SECOND_DELIVERY_DELAY) + 1).cast("int"))
    no_offset = n % NO_OFFSET_EVERY == 0
    return raw.select(*[{
        "event_id": F.when(n % NO_ID_EVERY != 0, F.col("event_id")),
        "average_speed": F.when((F.col("camera_id") == CONSTANT_CAMERA) & F.col("average_speed").isNotNull(),
                                F.lit(CONSTANT_SPEED))
                          .otherwise(F.col("average_speed") + (n % 1000).cast("double") / F.lit(10_000_000.0)),
        "kafka_partition": F.when(~no_offset, F.col("kafka_partition")),
        "kafka_offset": F.when(~no_offset, F.col("kafka_offset")),
        "kafka_ingest_ts": F.col("kafka_ingest_ts") + F.make_dt_interval(
            secs=F.when(second, delay).otherwise(F.lit(0)).cast("decimal(18,6)")),
    }.get(c, F.col(c)).alias(c) for c in raw.columns])


WIRE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def to_wire(raw: DataFrame, topic: str = "traffic.raw.events") -> DataFrame:
    """Render decoded events as Kafka-shaped records (key, value JSON, offsets).

    This is the inverse of ``decode_events``; it is how a replay directory or a
    Kafka topic is fed from a table.
    """
    fields = []
    for f in WIRE_FIELDS:
        if f == "timestamp":
            fields.append(F.date_format("event_ts", WIRE_TS_FORMAT).alias("timestamp"))
        else:
            fields.append(F.col(f))
    return raw.select(
        F.col("camera_id").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_ingest_ts").alias("timestamp"),
    )


# The same adapter as SQL text (valid in Spark SQL and DuckDB); the oracle
# queries are written on top of these views.
ADAPTER_SQL = """WITH registry AS (
  SELECT camera_id, location, cast(lat as double) AS latitude, cast(lon as double) AS longitude, zone
  FROM (VALUES
    ('CAM_01','Main St / 5th Ave',43.6532,-79.3832,'A'),
    ('CAM_02','Highway 401 Northbound',43.7615,-79.4111,'B'),
    ('CAM_03','Downtown Financial Core',43.6481,-79.3786,'A'),
    ('CAM_04','Pearson Airport Rd',43.6777,-79.6248,'C'),
    ('CAM_05','Bayview Ave / Sheppard',43.7687,-79.3768,'D'),
    ('CAM_06','Union Station Approach',43.6452,-79.3806,'A'),
    ('CAM_07','Lake Shore Blvd W',43.6362,-79.4891,'C'),
    ('CAM_08','Yonge & Eglinton',43.7072,-79.3982,'B'),
    ('CAM_09','Don Valley Pkwy S',43.6629,-79.3418,'D'),
    ('CAM_10','Gardiner Expressway E',43.6418,-79.3521,'A'),
    ('CAM_11','Allen Rd / Lawrence',43.7232,-79.4416,'E'),
    ('CAM_12','Scarborough Town Centre',43.7745,-79.2569,'E')
  ) AS t(camera_id, location, lat, lon, zone)
),
base AS (
  SELECT event_id AS n, user_id, event_type, value, cast(ts as timestamp) AS ts,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) AS k,
         concat('CAM_', lpad(cast(user_id % 12 + 1 as string), 2, '0')) AS cam,
         cast((event_id * 37) % 1040 as double) / 10 AS score
  FROM events
),
delivered AS (
  SELECT *, n AS kafka_offset FROM base
  UNION ALL
  SELECT *, n + 100000000 AS kafka_offset FROM base WHERE n % 89 = 0
),
traffic_raw AS (
  SELECT cast(d.n as string) AS event_id,
         CASE WHEN d.n % 211 = 0 THEN NULL WHEN d.n % 223 = 0 THEN concat('X', d.cam) ELSE d.cam END AS camera_id,
         CASE WHEN d.n % 401 = 0 THEN NULL ELSE d.ts END AS event_ts,
         r.location,
         CASE WHEN d.n % 307 = 0 THEN cast(95 as double) ELSE r.latitude END AS latitude,
         CASE WHEN d.n % 311 = 0 THEN cast(-190 as double) ELSE r.longitude END AS longitude,
         cast(floor(cast(d.k * d.k * d.k as double) / 470) as int) AS vehicle_count,
         CASE WHEN d.n % 157 = 0 THEN NULL ELSE d.value END AS average_speed,
         CASE WHEN d.n % 97 = 0 OR d.score >= 75 THEN 'CRITICAL' WHEN d.score >= 50 THEN 'HIGH'
              WHEN d.score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS congestion_level,
         d.score AS congestion_score,
         d.event_type = 'error' AS accident_detected,
         cast(d.n % 81 as int) AS pedestrian_count,
         5 + cast((d.n * 13) % 201 as double) / 10 AS heavy_vehicle_pct,
         '2.4.1' AS producer_version, '1.0' AS schema_version,
         d.kafka_offset, cast(d.user_id % 12 as int) AS kafka_partition,
         d.ts + interval 2 seconds AS kafka_ingest_ts
  FROM delivered d JOIN registry r ON r.camera_id = d.cam
),
clean AS (
  SELECT *,
         CASE WHEN congestion_score >= 75 THEN 'CRITICAL' WHEN congestion_score >= 50 THEN 'HIGH'
              WHEN congestion_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS congestion_category,
         hour(event_ts) IN (7, 8, 9, 16, 17, 18) AS is_peak_hour,
         cast(event_ts as date) AS event_date,
         cast(hour(event_ts) as int) AS event_hour
  FROM traffic_raw
  WHERE camera_id IS NOT NULL AND vehicle_count BETWEEN 0 AND 2000
    AND average_speed BETWEEN 0 AND 200 AND congestion_score BETWEEN 0 AND 100
    AND event_ts IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
)"""

# ``traffic_rough`` in DuckDB: the adapter with its raw frame replaced.
_ROUGH = """rough_key AS (SELECT *, cast(event_id as bigint) AS n FROM traffic_plain),
traffic_raw AS (
  SELECT * EXCLUDE (n) REPLACE (
           CASE WHEN n % 13 <> 0 THEN event_id END AS event_id,
           CASE WHEN camera_id = 'CAM_11' AND average_speed IS NOT NULL THEN 50.0000001::double
                ELSE average_speed + (n % 1000)::double / 10000000.0::double END AS average_speed,
           CASE WHEN n % 3 <> 0 THEN kafka_partition END AS kafka_partition,
           CASE WHEN n % 3 <> 0 THEN kafka_offset END AS kafka_offset,
           kafka_ingest_ts + to_seconds(CASE WHEN kafka_offset = n THEN 0 WHEN n % 4 = 0 THEN 0 WHEN n % 4 = 1 THEN 20
                                             WHEN n % 4 = 2 THEN 1200 ELSE 518400 END) AS kafka_ingest_ts)
  FROM rough_key
),
clean AS ("""
ROUGH_SQL = ADAPTER_SQL.replace("traffic_raw AS (", "traffic_plain AS (").replace("clean AS (", _ROUGH)
