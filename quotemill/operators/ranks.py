"""Exact ranks and quantiles of groups, some of which are too large for a task.

Groups of up to GROUP_ROWS rows are sorted where they are dealt. Distinct values of a larger group are counted, and range-partitioned by (group, value) at sampled splitters,
so that a large group is dealt to many tasks. A task's counts go into one row a range and group; ranks
are what stands in the ranges before plus what stands before inside the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.sources.table_io import staged

#: Rows of a group that are ranked in one task; the values of larger groups are dealt to many.
GROUP_ROWS = 500_000


def ranked(rows: DataFrame, by: str, value: str) -> DataFrame:
    """by, value, n, before, size, most: each distinct value of a group (nulls left out), how often it is there, how many smaller ones there are, and the group's number of values and largest value."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    counts = staged(counts.repartitionByRange(by, value).withColumn("range", F.spark_partition_id()), "ranges")  # the ranges are those that were written, whatever is run again
    ranges = counts.groupBy(by, "range").agg(F.sum("n").alias("held"), F.max(value).alias("top"))
    group = Window.partitionBy(by)  # a row a range
    ranges = ranges.select(by, "range", F.coalesce(F.sum("held").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"), F.sum("held").over(group).alias("size"), F.max("top").over(group).alias("most"))
    inner = F.sum("n").over(Window.partitionBy(by, "range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("inner", F.coalesce(inner, F.lit(0))).join(ranges, [by, "range"])
    return counts.select(by, value, "n", (F.col("earlier") + F.col("inner")).alias("before"), "size", "most")


def with_shares(rows: DataFrame, by: str, values: list[str], name: str, tops: dict[str, str]) -> DataFrame:
    """rows with rank_share() of their values in the group under ``name``, and the group's largest values of columns (``tops``: name of column by name of the largest).

    Values are ordered by the first column, then by the next; rows whose first one is null have no share.
    rows are read three times at most: for the sizes of groups, and by groups that are small or large.
    """
    sizes = rows.groupBy(by).agg(F.count("*").alias("rows"))
    found = sizes.agg(F.sum("rows").alias("rows"), F.collect_list(F.when(F.col("rows") > GROUP_ROWS, F.col(by))).alias("large")).first()  # few are large, since their rows are many
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-(found["rows"] or 0) // GROUP_ROWS))
    is_large = F.coalesce(F.col(by).isin(found["large"]), F.lit(False)) if found["large"] else F.lit(False)
    value, w = values[0], Window.partitionBy(by).orderBy(*values)
    whole, equal = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), w.rangeBetween(Window.currentRow, Window.currentRow)
    counted = {"n": F.count(value).over(equal), "upto": F.count(value).over(w), "size": F.count(value).over(whole)}
    small = rows.where(~is_large).repartition(parts, by).withColumns(counted | {top: F.max(c).over(whole) for top, c in tops.items()})
    out = small.withColumn("before", F.col("upto") - F.col("n"))
    if found["large"]:
        large = rows.where(is_large)
        most = large.groupBy(by).agg(*[F.max(c).alias(top) for top, c in tops.items()])
        large = large.withColumn("value_", F.when(F.col(value).isNotNull(), F.struct(*values)))
        large = large.join(ranked(large, by, "value_").select(by, "value_", "n", "before", "size"), [by, "value_"], "left").join(most, by)
        out = out.drop("upto").unionByName(large.drop("value_"))
    share = F.when(F.col(value).isNotNull(), rank_share())
    return out.select(*rows.columns, share.alias(name), *tops)


def rank_share() -> Column:
    """Of ranked() rows: the average rank of the value, over the number of values."""
    return (F.col("before") + 1 + (F.col("n") - 1) / 2) / F.col("size")


def quantiles(found: DataFrame, by: str, value: str, share: float) -> DataFrame:
    """by, quantile: the value at ``share`` of each group of ranked() rows, between two neighbours in proportion."""
    place = (F.col("size") - 1) * F.lit(share)
    lo, hi = F.floor(place), F.ceil(place)
    at = lambda p: (F.col("before") <= p) & (p < F.col("before") + F.col("n"))
    near = found.where(at(lo) | at(hi)).groupBy(by).agg(F.min(value).alias("low_"), F.max(value).alias("high_"), F.first("size").alias("size"))
    low, high = F.col("low_"), F.col("high_")
    return near.select(by, F.when(lo == hi, low).otherwise((hi - place) * low + (place - lo) * high).alias("quantile"))
