"""Small everyday operations as plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def sliding_max(df: DataFrame, group: str, order: list[str], value: str, k: int) -> DataFrame:
    """The greatest sum of k consecutive values of each group that has so many."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(1 - k, 0)
    sums = df.select(group, F.sum(value).over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"))
    return sums.where(F.col("n") == k).groupBy(group).agg(F.round(F.max("s"), 4).alias("best"))


def is_palindrome(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    return (bare != "") & (F.reverse(bare) == bare)


def combinations(df: DataFrame, group: str, item: str) -> DataFrame:
    """Unordered pairs of distinct items of a group."""
    a, b = df.select(group, F.col(item).alias("a")).distinct(), df.select(group, F.col(item).alias("b")).distinct()
    return a.join(b, group).where("a < b")


def carried(df: DataFrame, group: str, order: list[str], value: Column, out: str) -> DataFrame:
    """df with the last non-null value so far, in order, of each group: section markers carried down to their lines."""
    return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("n_", F.row_number().over(w)).where("n_ = 1").drop("n_")


def fibonacci(n: Column) -> Column:
    """The n-th Fibonacci number, from 0, 1."""
    pair = F.aggregate(F.sequence(F.lit(1), n), F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(1).cast("bigint").alias("b")), lambda s, _: F.struct(s["b"].alias("a"), (s["a"] + s["b"]).alias("b")))
    return F.when(n <= 0, F.lit(0).cast("bigint")).otherwise(pair["a"])


def factorial(n: Column) -> Column:
    """n! by multiplication, up to 20!; null for a negative n."""
    return F.when(n >= 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(1).cast("bigint"), lambda s, x: s * x))


def divided(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or either is null."""
    return F.try_divide(a, b)


def bisect_left(array: Column, x: Column) -> Column:
    """Place at which x goes into a sorted array, before its equals."""
    return F.size(F.filter(array, lambda v: v < x))


def binary_search(array: Column, x: Column, most: int = 62) -> Column:
    """Place of x in a sorted array of distinct values, from 0; -1 if it isn't there.  The interval is halved, most times at most."""
    start = F.struct(F.lit(0).alias("lo"), F.size(array).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = F.get(array, mid) < x
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(right, s["hi"]).otherwise(mid).alias("hi")))

    at = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(most), F.ceil(F.log2(F.size(array) + 1)).cast("int") + 1)), start, halve)["lo"]
    return F.when(F.get(array, at) == x, at).otherwise(-1)


def permutations(df: DataFrame, group: str, item: str) -> DataFrame:
    """Ordered pairs of distinct items of a group."""
    a, b = df.select(group, F.col(item).alias("a")).distinct(), df.select(group, F.col(item).alias("b")).distinct()
    return a.join(b, group).where("a <> b")
