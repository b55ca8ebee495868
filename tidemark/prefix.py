"""Running aggregates over one long order, in two steps: within buckets, then over buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

COMBINE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}
TAKE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


@dataclass(frozen=True)
class Running:
    """A running `kind` (sum, max, min, count or last) of value. `last` is the last value that
    is not null; with exclusive a row's own value is left out. `total` is the sum over all rows
    of a key, before and after."""

    value: Column
    kind: str
    exclusive: bool = False


def prefix_scans(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None, wanted: dict[str, Running]) -> DataFrame:
    """df with the running aggregates wanted, by keys in order.

    bucket must not fall as the order rises, and rows that tie in the order share one. Each
    window holds one bucket of a key, however many rows the key has; the second scan sees one
    row a bucket. Without a bucket each key is one window."""
    at = {n: f"__{i}" for i, n in enumerate(wanted)}
    df = df.withColumns({"__bucket": F.lit(0) if bucket is None else bucket} | {f"{at[n]}v": r.value for n, r in wanted.items()})
    over = W.partitionBy(*(keys or [F.lit(1)])).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    totals, carried, combined = [], {}, {}
    local = {}
    for n, r in wanted.items():
        v, here, before = f"{at[n]}v", F.col(f"{at[n]}l"), F.col(f"{at[n]}c")
        within = W.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if r.exclusive else 0)
        if r.kind == "total":
            every = W.partitionBy(*(keys or [F.lit(1)]))
            totals.append(F.sum(v).alias(f"{at[n]}t"))
            carried[f"{at[n]}c"] = F.sum(f"{at[n]}t").over(every)
            if bucket is None:
                local[f"{at[n]}l"] = F.sum(v).over(every)
            combined[n] = before
        elif r.kind == "last":
            totals.append(F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(f"{at[n]}t"))
            local[f"{at[n]}l"], carried[f"{at[n]}c"] = F.last(v, True).over(within), F.last(f"{at[n]}t", True).over(over)
            combined[n] = F.coalesce(here, before)
        else:
            totals.append(TAKE[r.kind](v).alias(f"{at[n]}t"))
            local[f"{at[n]}l"], carried[f"{at[n]}c"] = TAKE[r.kind](v).over(within), COMBINE[r.kind](f"{at[n]}t").over(over)
            pick = {"max": F.greatest, "min": F.least}.get(r.kind)
            combined[n] = pick(here, before) if pick else F.coalesce(here + before, here, before)
    scanned = df.withColumns(local)
    if bucket is None:
        scanned = scanned.withColumns({n: F.col(f"{at[n]}l") for n in wanted})
    else:
        buckets = df.groupBy(*keys, "__bucket").agg(*totals).withColumns(carried).drop(*[f"{a}t" for a in at.values()])
        # null keys and buckets are values too
        names = [*keys, "__bucket"]
        buckets = buckets.withColumnsRenamed({n: f"__r{i}" for i, n in enumerate(names)})
        same = [scanned[n].eqNullSafe(buckets[f"__r{i}"]) for i, n in enumerate(names)]
        scanned = scanned.join(buckets, same).withColumns(combined).drop(*[f"__r{i}" for i in range(len(names))])
    return scanned.drop("__bucket", *[f"{a}{s}" for a in at.values() for s in "vlc"])


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: Column, kind: str, name: str, exclusive: bool = False) -> DataFrame:
    return prefix_scans(df, keys, order, bucket, {name: Running(value, kind, exclusive)})
