"""Binary search in a sorted array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_most(bounds: Column, key: Column) -> Column:
    """How many entries of the ascending array ``bounds`` are <= ``key``.

    Tries steps of falling powers of two, about log2(size) comparisons a row, so
    that arrays with many thousands of bounds stay cheap. A step past the end
    reads null, which is not at most the key.
    """
    largest = F.ceil(F.log2(F.size(bounds) + F.lit(1))).cast("int")
    steps = F.transform(
        F.sequence(largest, F.lit(0)), lambda power: F.pow(F.lit(2), power).cast("int")
    )

    def found_for(key: Column) -> Column:
        return F.aggregate(
            steps,
            F.lit(0),
            lambda found, step: F.when(
                F.get(bounds, found + step - F.lit(1)) <= key, found + step
            ).otherwise(found),
        )

    # The key is bound to a variable, so that it is not put together again for each step.
    return F.get(F.transform(F.array(key), found_for), F.lit(0))
