"""Column builders with the numeric conventions of the market-data service."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def real(x: Column | str) -> Column:
    """NaN as null, so that every comparison with it is unknown rather than true."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(~F.isnan(c), c)


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def rounded(x: Column | str, digits: int) -> Column:
    """Rounding of the scaled double, as SQL engines do it; ``round`` goes by its shortest decimal form, which makes other halves."""
    c = F.col(x) if isinstance(x, str) else x
    scale = F.lit(10.0**digits)
    return F.round(c * scale) / scale


def decimals(x: Column | str) -> Column:
    """Digits after the point in the shortest decimal form of a double.

    Values in (0, 1e-4) print with an exponent, whose characters count as well when there is a point.
    """
    c = F.col(x) if isinstance(x, str) else x
    plain = F.length(F.rtrim(F.split_part(F.expr(f"cast(cast({_sql(x)} AS decimal(38,18)) AS string)"), F.lit("."), F.lit(2)), F.lit("0")))
    java = c.cast("string")
    tail = F.split_part(java, F.lit("."), F.lit(2))
    mantissa = F.split_part(tail, F.lit("E"), F.lit(1))
    power = F.abs(F.split_part(java, F.lit("E"), F.lit(2)).cast("int"))
    small = F.when(mantissa == "0", 0).otherwise(F.length(mantissa) + 2 + F.greatest(F.length(power.cast("string")), F.lit(2)))
    size = F.abs(c)
    return F.when(F.isnan(c) | c.isNull(), 0).when((size > 0) & (size < 1e-4), small).when(size >= 1e16, 0).otherwise(plain)


def _sql(x: Column | str) -> str:
    if not isinstance(x, str):
        raise TypeError("decimals takes a column name")
    return f"CASE WHEN isnan(`{x}`) OR abs(`{x}`) >= 1e16 THEN 0 ELSE `{x}` END"


def lookup(key: Column, table: Mapping[str, float], default: float = 0.0) -> Column:
    """A literal map with a default for missing keys."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def nearest_rank(values: Column, q: float) -> Column:
    """Element at place floor(n * q), from 0 and at most the last, of an array in ascending order."""
    n = F.size(values)
    return F.try_element_at(F.sort_array(values), F.least(F.floor(n * F.lit(q)) + 1, n).cast("int"))


def hash16(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 16)


def ranked(df: DataFrame, key: str, seq: str, out: str = "rn", span: int = 1 << 16) -> DataFrame:
    """Adds each row's rank (1, 2, ...) among its key's rows by the integer ``seq``.

    Rows are ranked within spans of ``seq`` and then moved on by the counts of earlier spans, so a key spreads over tasks.
    """
    d = df.withColumn("_span", F.floor(F.col(seq) / span))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy(F.col(key).alias("_k"), F.col("_span").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_k", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    met = d.join(counts, F.col(key).eqNullSafe(F.col("_k")) & F.col("_span").eqNullSafe(F.col("_s")))
    inside = Window.partitionBy(key, "_span").orderBy(seq)
    return met.withColumn(out, F.row_number().over(inside) + F.col("_before")).drop("_span", "_k", "_s", "_before")


def running(df: DataFrame, key: str, rank: str, lags: Mapping[str, str], averages: Mapping[str, str], alpha: float = 0.1, block: int = 512) -> DataFrame:
    """Adds, over each key's rows by ``rank`` (1, 2, ...), previous values (``lags``: column -> name) and exponential averages
    seeded with the first value (``averages``: column -> name; ``<name>_before`` is the average before the row).

    The recursion is linear, so it needs no fold: inside a block of ``block`` ranks an average is one running sum of
    weighted values, and what earlier blocks add is the weighted total of the block before; older ones weigh
    less than double precision shows, for blocks are at least that long. All windows are by (key, block), so one key
    spreads over tasks; one table of blocks and one join serve everything. A NaN stays in every later average.
    """
    keep = 1.0 - alpha
    block = max(block, math.ceil(-40 / math.log(keep)))
    weight = F.when(F.col(rank) == 1, F.lit(1.0)).otherwise(F.lit(alpha))
    d = df.withColumn("_b", F.floor((F.col(rank) - 1) / block)).withColumn("_p", F.pmod(F.col(rank) - 1, F.lit(block)))
    inside = Window.partitionBy(key, "_b").orderBy(rank)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    sides = list(enumerate(averages.items()))
    d = d.withColumns({f"_w{i}": weight * F.nanvl(v, F.lit(0.0)) * F.pow(F.lit(keep), -F.col("_p")) for i, (v, _) in sides})
    ends = [F.max_by(v, rank).alias(f"_l{i}") for i, v in enumerate(lags)]
    ends += [(F.sum(f"_w{i}") * F.pow(F.lit(keep), F.max("_p"))).alias(f"_t{i}") for i, _ in sides]
    ends += [F.max(F.isnan(v).cast("int")).alias(f"_z{i}") for i, (v, _) in sides]
    chain = Window.partitionBy("_k").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    blocks = d.groupBy(F.col(key).alias("_k"), (F.col("_b") + 1).alias("_o")).agg(*ends)
    blocks = blocks.withColumns({f"_z{i}": F.max(f"_z{i}").over(chain) for i, _ in sides})
    local = {f"_v{i}": F.lag(v).over(inside) for i, v in enumerate(lags)}
    local |= {f"_s{i}": F.sum(f"_w{i}").over(upto) for i, _ in sides} | {f"_n{i}": F.max(F.isnan(v).cast("int")).over(upto) for i, (v, _) in sides}
    d = d.withColumns(local).join(blocks, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_o")), "left")
    first = F.col("_p") == 0
    d = d.withColumns({name: F.when(first, F.col(f"_l{i}")).otherwise(F.col(f"_v{i}")) for i, name in enumerate(lags.values())})
    at = lambda i: F.col(f"_s{i}") * F.pow(F.lit(keep), "_p") + F.coalesce(f"_t{i}", F.lit(0.0)) * F.pow(F.lit(keep), F.col("_p") + 1)
    d = d.withColumns({name: F.when(F.greatest(F.coalesce(f"_z{i}", F.lit(0)), F.col(f"_n{i}")) == 1, F.lit(float("nan"))).otherwise(at(i)) for i, (_, name) in sides})
    d = d.withColumns({f"{name}_before": F.when(first, F.col(f"_t{i}")).otherwise(F.lag(name).over(inside)) for i, (_, name) in sides})
    return d.drop(*[c for c in d.columns if re.fullmatch(r"_[bpko]|_[wltzvsn]\d+", c)])


def sustained(df: DataFrame, keys: list[str], ts: str, firing: str, seconds: int) -> DataFrame:
    """Runs of consecutive firing samples per key that last at least ``seconds``: keys, started, ended, samples."""
    w = Window.partitionBy(*keys).orderBy(ts)
    island = F.sum((~F.col(firing)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = df.withColumn("_island", island).filter(firing).groupBy(*keys, "_island").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("samples"))
    return runs.filter(F.col("ended") - F.col("started") >= seconds * 1000).drop("_island")


def range_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, width_ms: int, on: list[str]) -> DataFrame:
    """Rows of both sides with equal ``on`` and left_ts < right_ts < left_ts + width, as a hash join.

    Each left row goes to the two time buckets that its range can touch, each right row to its own, so the
    join has an equality on the bucket and no side is compared with all of the other.
    """
    bucket = lambda c: F.floor(F.col(c) / width_ms)
    wide = left.withColumn("_bucket", F.explode(F.array(bucket(left_ts), bucket(left_ts) + 1)))
    narrow = right.withColumn("_bucket", bucket(right_ts))
    met = wide.join(narrow, [*on, "_bucket"]) if on else wide.join(narrow, "_bucket")
    return met.filter((F.col(right_ts) > F.col(left_ts)) & (F.col(right_ts) < F.col(left_ts) + width_ms)).drop("_bucket")
