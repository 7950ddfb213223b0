"""Running totals in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, region: Column, bucket: Column, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` plus the sum of ``value`` over all rows before this one in (region, bucket, order).

    Regions and buckets must sort like the rows, and a bucket lies in one region. Sums are combined before each
    shuffle; one task sums the regions, a few of them however many rows there are, others the buckets of
    each region, and the rows are sorted bucket by bucket.
    """
    rows = df.withColumn("__r", region).withColumn("__b", bucket).withColumn("__v", value)
    earlier = lambda w: F.coalesce(F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = rows.groupBy("__r", "__b").agg(F.sum("__v").alias("__s"))
    regions = heads.groupBy("__r").agg(F.sum("__s").alias("__s")).withColumn("__before", earlier(Window.orderBy("__r"))).drop("__s")
    heads = heads.withColumn("__in", earlier(Window.partitionBy("__r").orderBy("__b"))).join(regions, "__r")
    heads = heads.select("__b", (F.col("__before") + F.col("__in")).alias("__base"))
    inside = Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum("__v").over(inside), F.lit(0))).join(heads, "__b")
    return rows.withColumn(name, (F.col("__base") + F.col("__in")).cast("long")).drop("__r", "__b", "__v", "__in", "__base")
