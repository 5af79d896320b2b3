"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from chorale.columns import EVENT, ITEM, PLAYS, TIME, USER

INTERACTIONS = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField(TIME, T.TimestampNTZType()),
        T.StructField(EVENT, T.LongType()),
    ]
)

TRACKS = T.StructType(
    [
        T.StructField(ITEM, T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("recording_mbid", T.StringType()),
    ]
)

USERS = T.StructType(
    [T.StructField(USER, T.LongType()), T.StructField("user_name", T.StringType())]
)

RATINGS = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField(PLAYS, T.LongType()),
    ]
)

TUNING_RESULTS = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("reg", T.DoubleType()),
        T.StructField("alpha", T.DoubleType()),
        T.StructField("iterations", T.IntegerType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("map", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("ndcg", T.DoubleType()),
        T.StructField("n_users", T.LongType()),
        T.StructField("fit_seconds", T.DoubleType()),
        T.StructField("evaluate_seconds", T.DoubleType()),
    ]
)
