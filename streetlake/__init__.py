"""streetlake: Spark-native analytics for road-traffic camera events.

Every operator is a plain function over DataFrames; the same functions run on
batch tables and on Structured Streaming frames.  Catalyst plans everything.
"""

__version__ = "0.1.0"
