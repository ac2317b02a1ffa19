"""Camera registry dimension (12 cameras, zones A-E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the seeded camera registry -------------------------------
# camera_id, location, latitude, longitude, zone
CAMERA_REGISTRY = [
    ("CAM_01", "Main St / 5th Ave", 43.6532, -79.3832, "A"),
    ("CAM_02", "Highway 401 Northbound", 43.7615, -79.4111, "B"),
    ("CAM_03", "Downtown Financial Core", 43.6481, -79.3786, "A"),
    ("CAM_04", "Pearson Airport Rd", 43.6777, -79.6248, "C"),
    ("CAM_05", "Bayview Ave / Sheppard", 43.7687, -79.3768, "D"),
    ("CAM_06", "Union Station Approach", 43.6452, -79.3806, "A"),
    ("CAM_07", "Lake Shore Blvd W", 43.6362, -79.4891, "C"),
    ("CAM_08", "Yonge & Eglinton", 43.7072, -79.3982, "B"),
    ("CAM_09", "Don Valley Pkwy S", 43.6629, -79.3418, "D"),
    ("CAM_10", "Gardiner Expressway E", 43.6418, -79.3521, "A"),
    ("CAM_11", "Allen Rd / Lawrence", 43.7232, -79.4416, "E"),
    ("CAM_12", "Scarborough Town Centre", 43.7745, -79.2569, "E"),
]

REGISTRY_SCHEMA = T.StructType([
    T.StructField("camera_id", T.StringType(), False),
    T.StructField("location", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("zone", T.StringType(), True),
    T.StructField("active", T.BooleanType(), True),
])


_SAMPLE = {"string": "", "double": 0.0, "boolean": False}


def camera_registry(spark: SparkSession) -> DataFrame:
    """The seeded registry as a 12-row DataFrame.

    Built as an inline literal relation (not ``createDataFrame``, whose RDD
    has no size estimate), so the planner knows it is tiny; the frame is
    flagged fixed-size so joins broadcast it without a runtime check.
    """
    rows = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                       for v, f in zip(r + (True,), REGISTRY_SCHEMA.fields)]) for r in CAMERA_REGISTRY]
    df = spark.range(1).select(F.inline(F.array(*rows)))
    # union with an empty relation typed as declared, so nullable columns are
    # nullable (a union's nullability is the OR of its inputs); the empty
    # branch is removed by the optimizer
    typed = spark.range(0).select(*[(F.lit(None) if f.nullable else F.lit(_SAMPLE[f.dataType.typeName()]))
                                    .cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA.fields])
    df = df.unionByName(typed)
    df._fixed_size = True
    return df


def is_fixed_size(df: DataFrame) -> bool:
    """True for frames of a size fixed by construction (the registry seed)."""
    return bool(getattr(df, "_fixed_size", False))


def upsert_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-if-absent: rows of ``new`` whose camera_id is not in ``old``."""
    cols = old.columns
    others = [c for c in cols if c != "camera_id"]
    # one deterministic row per new camera id (smallest attribute tuple)
    first = (new.groupBy("camera_id")
             .agg(F.min(F.struct(*[F.col(c) for c in others])).alias("r"))
             .select("camera_id", *[F.col("r." + c).alias(c) for c in others]))
    fresh = first.join(old.select("camera_id"), "camera_id", "left_anti")
    return old.unionByName(fresh.select(*cols))
