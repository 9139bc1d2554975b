"""The profile and exact dedup as streams: the same expressions over rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as T


def running_profile(stream: DataFrame, text: str, time: str = "ts", late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Rows, languages and lengths per window; windows close once the watermark passes them."""
    features = stream.withColumn("_language", T.language(T.filled(text))).withColumn("_n", F.length(T.filled(text)))
    return features.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.col("_language").alias("language")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("_n").alias("mean_chars"), F.max("_n").alias("max_chars"), F.count_if(T.is_mcq(T.filled(text))).alias("mcq")
    )


def first_copies(stream: DataFrame, user: str, assistant: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Drops a row if its level-3 digest was seen within the watermark; the state holds digests only."""
    digest = T.pair_digest(T.collapse(T.filled(user)), T.collapse(T.strip_think(T.filled(assistant))))
    return stream.withColumn("l3", digest).withWatermark(time, late).dropDuplicatesWithinWatermark(["l3"])
