"""Star-schema tables seen as interactions and tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.columns import EVENT, ITEM, TIME, USER


def events_as_listens(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as (user, item, timestamp, event id); the item is the props text."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(
        USER, F.col("props").alias(ITEM), F.col("ts").alias(TIME), F.col("event_id").alias(EVENT)
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` and ``orders`` as (user, item, timestamp): who bought which part when."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias(USER),
        F.col("l_partkey").cast("string").alias(ITEM),
        F.col("o_orderdate").alias(TIME),
    )


def parts_as_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` as track metadata."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return parts.select(
        F.col("p_partkey").cast("string").alias(ITEM),
        F.col("p_brand").alias("artist_name"),
        F.col("p_name").alias("track_name"),
        F.lit(None).cast("string").alias("recording_mbid"),
    )


def customers_as_users(spark: SparkSession, folder: str) -> DataFrame:
    """``customer`` as user metadata."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.select(F.col("c_custkey").alias(USER), F.col("c_name").alias("user_name"))
