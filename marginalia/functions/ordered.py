"""Ordered computations over groups that may be too large for one task.

A plain window puts a whole partition-by group into one task. Here every group is
cut into buckets that follow the sort order and hold a bounded number of rows; the
window runs per bucket, and only one summary row per bucket is ordered per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows per bucket when the bucket is a block of the unique row index.
BLOCK = 1 << 20


def block_of(index: Column | str) -> Column:
    c = F.col(index) if isinstance(index, str) else index
    return F.floor(c / F.lit(BLOCK))


def _with_buckets(df: DataFrame, bucket: list[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"__b{i}" for i in range(len(bucket))]
    return df.withColumns(dict(zip(names, bucket))), names


def bounded_row_number(
    df: DataFrame, group: list[str], bucket: list[Column], order: list[str], out: str
) -> DataFrame:
    """Exact 1-based row number per group.

    ``bucket`` must be non-null and agree with ``order``: rows of an earlier bucket
    sort before rows of a later one. ``group`` columns must be non-null.
    """
    rows, b = _with_buckets(df, bucket)
    keys = group + b
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(*b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.join(offsets, keys)
        .withColumn(out, F.col("__off") + F.row_number().over(inside))
        .drop("__off", *b)
    )


def latest_before(
    df: DataFrame,
    group: list[str],
    bucket: list[Column],
    order: list[str],
    carries: dict[str, tuple[Column, Column]],
) -> DataFrame:
    """For each row the value of the nearest earlier row of its group that qualifies.

    ``carries`` maps an output name to ``(value, condition)``; the value must be a
    struct so that a qualifying row is never NULL.
    """
    rows, b = _with_buckets(df, bucket)
    keys = group + b
    rows = rows.withColumns(
        {f"__v_{name}": F.when(cond, value) for name, (value, cond) in carries.items()}
    )
    position = F.struct(*order)
    summary = rows.groupBy(*keys).agg(
        *[
            F.max_by(f"__v_{name}", F.when(F.col(f"__v_{name}").isNotNull(), position)).alias(f"__s_{name}")
            for name in carries
        ]
    )
    before_bucket = Window.partitionBy(*group).orderBy(*b).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys,
        *[F.last(f"__s_{name}", ignorenulls=True).over(before_bucket).alias(f"__c_{name}") for name in carries],
    )
    before_row = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(summary, keys)
    for name in carries:
        inside = F.last(f"__v_{name}", ignorenulls=True).over(before_row)
        out = out.withColumn(name, F.coalesce(inside, F.col(f"__c_{name}")))
    return out.drop(*b, *[f"__v_{n}" for n in carries], *[f"__c_{n}" for n in carries])


def best_per_group(
    df: DataFrame, group: list[str], rank: list[Column], keep: list[str]
) -> DataFrame:
    """The row with the smallest rank per group, as an aggregate that combines map-side.

    The rank must end in a unique value, so that the choice never depends on task order.
    """
    return (
        df.groupBy(*group)
        .agg(F.min_by(F.struct(*keep), F.struct(*rank)).alias("__best"))
        .select(*group, *[F.col(f"__best.{k}").alias(k) for k in keep])
    )
