"""Exact order statistics and running totals without sorting a table in one partition."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class _Interval:
    """Rows that share ``prefix`` on the first keys and lie in [low, high] on the next one."""

    def __init__(self, prefix: tuple, low, high, before: int, ranks: list[int]):
        self.prefix, self.low, self.high = prefix, low, high
        self.before, self.ranks = before, ranks

    def condition(self, keys: list[str]) -> Column:
        parts = [F.col(k) == F.lit(v) for k, v in zip(keys, self.prefix)]
        if self.low is not None:
            parts.append(F.col(keys[len(self.prefix)]).between(F.lit(self.low), F.lit(self.high)))
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def order_statistics(
    df: DataFrame, keys: list[str], ranks: list[int], *, bins: int = 4096, leaf: int = 5000
) -> dict[int, tuple]:
    """Key tuples at the given 0-based ranks in lexicographic order of numeric, non-null ``keys``.

    Every round counts rows in at most ``bins`` equal-width bins of each interval that still holds a
    wanted rank (map-side combined), then narrows to the bin with the rank; a bin of one value moves
    on to the next key. Only when at most ``leaf`` rows remain are they fetched. The driver sees
    bin counts and a bounded number of keys; no row is shuffled by rank and no key can be hot.
    """
    found: dict[int, tuple] = {}
    integral = {k: t in ("bigint", "int", "smallint", "tinyint") for k, t in df.dtypes}
    active = [_Interval((), None, None, 0, sorted(set(ranks)))]
    total = None
    while active:
        slot = F.lit(None).cast("struct<interval:int,bin:int>")
        for number, part in reversed(list(enumerate(active))):
            key = keys[len(part.prefix)]
            if part.low is None:
                cell = F.lit(0)
            else:
                offset = F.col(key) - F.lit(part.low)
                width = float(part.high - part.low)
                cell = F.least(
                    F.floor(offset.cast("double") * F.lit(bins / width)).cast("int"),
                    F.lit(bins - 1),
                )
            slot = F.when(
                part.condition(keys),
                F.struct(F.lit(number).alias("interval"), cell.alias("bin")),
            ).otherwise(slot)
        counted = df.withColumn("__slot", slot).filter(F.col("__slot").isNotNull())
        depth = [keys[len(p.prefix)] for p in active]
        current = reduce(
            lambda acc, item: F.when(
                F.col("__slot.interval") == item[0], F.col(item[1]).cast("double")
            ).otherwise(acc),
            enumerate(depth),
            F.lit(None).cast("double"),
        )
        exact = reduce(
            lambda acc, item: F.when(
                F.col("__slot.interval") == item[0], F.col(item[1]).cast("bigint")
            ).otherwise(acc),
            [(i, k) for i, k in enumerate(depth) if integral[k]],
            F.lit(None).cast("bigint"),
        )
        rows = (
            counted.groupBy("__slot.interval", "__slot.bin")
            .agg(
                F.count("*").alias("n"),
                F.min(current).alias("low"),
                F.max(current).alias("high"),
                F.min(exact).alias("low_int"),
                F.max(exact).alias("high_int"),
            )
            .orderBy("interval", "bin")
            .collect()
        )
        if total is None:
            total = sum(r["n"] for r in rows)
            if ranks and (min(ranks) < 0 or max(ranks) >= total):
                raise ValueError("rank outside the table")
        following, leaves = [], []
        for number, part in enumerate(active):
            whole = integral[depth[number]]
            before = part.before
            for row in (r for r in rows if r["interval"] == number):
                inside = [k for k in part.ranks if before <= k < before + row["n"]]
                if inside:
                    low = row["low_int"] if whole else row["low"]
                    high = row["high_int"] if whole else row["high"]
                    if low == high:
                        prefix = (*part.prefix, low)
                        if len(prefix) == len(keys):
                            found.update({k: prefix for k in inside})
                            before += row["n"]
                            continue
                        narrowed = _Interval(prefix, None, None, before, inside)
                    else:
                        narrowed = _Interval(part.prefix, low, high, before, inside)
                    (leaves if row["n"] <= leaf else following).append(narrowed)
                before += row["n"]
        if leaves:
            tagged = F.lit(None).cast("int")
            for number, part in enumerate(leaves):
                tagged = F.when(part.condition(keys), F.lit(number)).otherwise(tagged)
            kept = df.select(*keys, tagged.alias("__leaf")).filter(F.col("__leaf").isNotNull())
            per_leaf: dict[int, list[tuple]] = {}
            for row in kept.collect():
                per_leaf.setdefault(row["__leaf"], []).append(tuple(row[k] for k in keys))
            for number, part in enumerate(leaves):
                ordered = sorted(per_leaf[number])
                found.update({k: ordered[k - part.before] for k in part.ranks})
        active = following
    return found


def below(keys: list[str], cut: tuple) -> Column:
    """True for rows strictly before ``cut`` in lexicographic order."""
    return F.struct(*[F.col(k) for k in keys]) < F.struct(
        *[F.lit(v).alias(k) for k, v in zip(keys, cut)]
    )


def running_totals(
    df: DataFrame, key: str, sums: list[str], *, descending: bool = True, buckets: int = 512
) -> DataFrame:
    """Inclusive running totals of ``sums`` over distinct values of a double ``key``.

    Rows are first added up per key value. The key range is cut at approximate quantiles of the
    distinct values, bucket totals become offsets (a table of at most ``buckets`` rows), and each
    bucket accumulates on its own. Bucket edges only steer the work; the totals are exact. Infinite keys go to the
    outer buckets and NaN counts as the largest key, as in Spark's order.
    """
    grouped = df.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums])
    probes = [i / buckets for i in range(1, buckets)]
    edges = grouped.agg(F.percentile_approx(key, probes, 100 * buckets // 10)).first()[0] or []
    inner = sorted({e for e in edges if math.isfinite(e)})
    bucketed = grouped.withColumn("__bucket", F.lit(0))
    if inner:
        bucketed = Bucketizer(
            splits=[float("-inf"), *inner, float("inf")], inputCol=key, outputCol="__bucket", handleInvalid="keep"
        ).transform(grouped)
    sign = -1 if descending else 1
    bucketed = bucketed.withColumn("__bucket", (F.lit(sign) * F.col("__bucket")).cast("int"))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("__bucket")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            "__bucket",
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums],
        )
    )
    order = F.col(key).desc() if descending else F.col(key).asc()
    inside = (
        Window.partitionBy("__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return bucketed.join(F.broadcast(offsets), "__bucket").select(
        key,
        *sums,
        *[(F.sum(c).over(inside) + F.col(f"__before_{c}")).alias(f"cum_{c}") for c in sums],
    )
