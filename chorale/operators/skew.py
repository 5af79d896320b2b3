"""Row positions and counts per key that survive keys with too many rows.

A window function puts all rows of its partition key into one task, and adaptive
execution does not split that. Here a sketch of the table shows the keys that hold a good
part of it, and where to cut their rows into slices of about equal length: rows are
numbered inside the slice, and the slices of a key are summed up in order. The rows are
shuffled once, and no job runs before the result is asked for.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.functions.search import count_at_most

POSITION = "position"
KEY_ROWS = "key_rows"

# A sketch of a table looks at one row in so many.
THIN = 16
# A key that holds no more picks of a sketch than this is left whole.
UNCUT = 4
# Copies of one row are written out in runs of this length.
COPY_RUN = 100_000
# Seconds of a day, and how many characters name one in a text.
DAY_SECONDS, DAY_CHARS = 86_400, 10


def with_key_rows(df: DataFrame, keys: list[str], name: str = KEY_ROWS) -> DataFrame:
    """Every row with the number of rows that share its keys. Keys must not be null.

    Counts are combined before their shuffle and joined back, and adaptive execution
    splits the rows of a hot key in that join.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, keys, "left").select(*df.columns, name)


def day_of(df: DataFrame, column: str) -> Column:
    """The day of a time, given as a timestamp, a date, a number of seconds or ISO text."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp") or kind == "date":
        return F.to_date(column)
    if kind == "string":
        return F.substring(column, 1, DAY_CHARS)
    return F.floor(F.col(column) / DAY_SECONDS)


def with_earlier(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column | str],
    maxima: dict[str, Column | str] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Every row with sums and maxima over those of its key's rows that come before it.

    ``sums`` and ``maxima`` give the expression for each new column; a sum also gets a column
    ``<name>_total`` over all rows of the key. Rows must be unique on ``keys`` and ``order``
    together; keys may be null, and null is a key.

    The table is sketched by ``pieces`` rows, spread like all rows and picked from one in
    ``THIN`` of them, by default four for each shuffle partition. A key that holds more than
    ``UNCUT`` of them is cut there: its picks are the bounds of slices of about equal length,
    so its rows are spread over tasks even if all have one time. All other keys, which are
    about a partition long at most, are one slice each. The sketch reads the table once more,
    but the rows themselves are shuffled once and joined with small tables only: no more than
    ``pieces`` rows of bounds, and as many slices and one more for each key that is cut.
    """
    maxima = maxima or {}
    columns = df.columns
    sliced = _sliced(df, keys, order, pieces)
    ordered = Window.partitionBy(*keys, "__slice").orderBy(*order)
    above = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # In order too, though the order doesn't matter: so all windows share one sort, and what
    # reads these sums only needs the same columns as the rest and can use its shuffle.
    slice_rows = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = [F.sum(c).over(above).alias(f"__sum_{n}") for n, c in sums.items()]
    found += [F.sum(c).over(slice_rows).alias(f"__all_{n}") for n, c in sums.items()]
    found += [F.max(c).over(above).alias(f"__max_{n}") for n, c in maxima.items()]
    found += [F.max(c).over(slice_rows).alias(f"__top_{n}") for n, c in maxima.items()]
    numbered = sliced.select("*", *found)
    # What slices hold comes from the numbered rows, whose shuffle is then used twice.
    per_slice = [F.max(f"__all_{n}").alias(f"__all_{n}") for n in sums]
    per_slice += [F.max(f"__top_{n}").alias(f"__top_{n}") for n in maxima]
    held = numbered.where("__cut").groupBy(*keys, "__slice").agg(*per_slice)
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        *keys,
        F.col("__slice"),
        *[F.sum(f"__all_{n}").over(before).alias(f"__before_{n}") for n in sums],
        *[F.sum(f"__all_{n}").over(whole).alias(f"__total_{n}") for n in sums],
        *[F.max(f"__top_{n}").over(before).alias(f"__above_{n}") for n in maxima],
    )
    on = _same_keys(keys, "r", "s") & (F.col("r.__slice") == F.col("s.__slice"))
    joined = numbered.alias("r").join(F.broadcast(starts).alias("s"), on, "left")
    out = [F.col(f"r.{c}") for c in columns]
    for name in sums:
        inside = F.coalesce(F.col(f"__sum_{name}"), F.lit(0))
        out.append((F.coalesce(F.col(f"__before_{name}"), F.lit(0)) + inside).alias(name))
        out.append(F.coalesce(f"__total_{name}", f"__all_{name}").alias(f"{name}_total"))
    out += [F.greatest(f"__above_{name}", f"__max_{name}").alias(name) for name in maxima]
    return joined.select(*out)


def _same_keys(keys: list[str], left: str, right: str) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _sliced(df: DataFrame, keys: list[str], order: list[str], pieces: int | None) -> DataFrame:
    """Every row with ``__slice``, which rises with its key's order, and ``__cut``: whether
    its key has more than one slice."""
    if pieces is None:
        pieces = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*order)
    # One row in a few, by hash, is enough to pick from and leaves little to sort.
    some = df.where(F.pmod(F.xxhash64(F.lit("sketch"), *keys, *order), F.lit(THIN)) == 0)
    cuts = (
        _spread_picks(some, F.lit(pieces), [*keys, *order])
        .select("pick.*")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(place)).alias("__cuts"))
        .where(F.size("__cuts") > UNCUT)
    )
    joined = df.alias("r").join(F.broadcast(cuts).alias("c"), _same_keys(keys, "r", "c"), "left")
    cut = F.col("__cuts").isNotNull()
    number = F.when(cut, count_at_most(F.col("__cuts"), place)).otherwise(F.lit(0))
    return joined.select("r.*", "__cuts").select(
        *df.columns, cut.alias("__cut"), number.alias("__slice")
    )


def with_positions(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    distinct: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Every row with its ``position`` (from 1) among its key's rows, and ``key_rows``.

    Rows are ordered by ``order`` ascending and then by all other columns, so that only
    rows equal in every column are interchangeable; those are counted before the shuffle,
    unless ``distinct`` says that there are none. All columns must be of a sortable type.
    ``pieces`` is that of ``with_earlier``.
    """
    columns = df.columns
    full_order = [*order, *[c for c in columns if c not in order and c not in keys]]
    if distinct:
        placed = with_earlier(df, keys, full_order, {"__rows": F.lit(1)}, pieces=pieces)
        place = (F.col("__rows") + 1).alias(POSITION)
        return placed.select(*columns, place, F.col("__rows_total").alias(KEY_ROWS))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    placed = with_earlier(counted, keys, full_order, {"__rows": "__copies"}, pieces=pieces)
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__copies") - 1) / COPY_RUN))
    until = F.least("__copies", (F.col("__run") + 1) * COPY_RUN) - 1
    return (
        placed.withColumn("__run", F.explode(runs))
        .withColumn("__copy", F.explode(F.sequence(F.col("__run") * COPY_RUN, until)))
        .select(
            *columns,
            (F.col("__rows") + F.col("__copy") + 1).alias(POSITION),
            F.col("__rows_total").alias(KEY_ROWS),
        )
    )


def with_global_positions(
    df: DataFrame, order: list[str], pieces: int | None = None
) -> DataFrame:
    """Every row with its ``position`` (from 1) in the whole table.

    The rows must be unique on ``order``. A plain window without a partition key
    would sort the table in one task; here each task sorts some of ``pieces``
    pieces of it, by default four for each shuffle partition.
    """
    if pieces is None:
        pieces = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order)
    bounds = (
        _spread_picks(df, F.lit(pieces), order)
        .agg(F.array_sort(F.collect_list("pick")).alias("bounds"))
        .scalar()
    )
    inside = F.row_number().over(Window.partitionBy("piece").orderBy(*order))
    numbered = (
        df.withColumn("bounds", bounds)
        .withColumn("piece", count_at_most(F.col("bounds"), key))
        .drop("bounds")
        .withColumn("inside", inside)
    )
    # Sums at most pieces + 1 rows in one task. The counts come from the numbered
    # rows, whose shuffle is then used twice.
    before = (
        numbered.groupBy("piece")
        .agg(F.max("inside").cast("bigint").alias("piece_rows"))
        .withColumn("before", _sum_of_earlier("piece_rows", Window.orderBy("piece")))
        .select("piece", "before")
    )
    return (
        numbered.join(F.broadcast(before), "piece", "left")
        .withColumn(POSITION, F.col("before") + F.col("inside"))
        .select(*df.columns, POSITION)
    )


def _spread_picks(df: DataFrame, pieces: Column, order: list[str]) -> DataFrame:
    """About ``pieces`` rows' sort keys, as ``pick``.

    The rows are dealt into slots by hash and the one with the least second hash
    is taken from each slot. So the picks are spread like the rows, depend on
    nothing but the data, and come out the same in a repeated task.
    """
    slot = F.pmod(F.xxhash64(*order), pieces).alias("slot")
    chance = F.xxhash64(F.lit("pick"), *order)
    return df.groupBy(slot).agg(F.min_by(F.struct(*order), chance).alias("pick"))


def _sum_of_earlier(name: str, ordered: Window) -> Column:
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(earlier), F.lit(0))
