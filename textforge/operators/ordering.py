"""Order-dependent operators without a single-task window.

A window partitioned by a file, source or run would put a hot group in one task.
Here every group is cut into blocks; only one small row per block is scanned in
order, and rows are ranked inside their block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textforge.functions.draws import order_key
from textforge.storage import materialize


def _cols(keys):
    return [F.col(k) for k in keys]


def dense_index(df: DataFrame, keys: list[str], seed: int, name: str = "idx", count_from: DataFrame | None = None) -> DataFrame:
    """Dense 0-based index in the order of md5(seed, keys): a reproducible full shuffle.

    Only hashes and keys are sorted and numbered, by sorted_index; other columns are joined to their number.  The keys
    are unique.  ``count_from`` may name a cheaper relation with the same keys, best a stored one.
    """
    tagged = (count_from if count_from is not None else df).select(*keys).withColumn("_h", F.unhex(order_key(seed, *keys)))
    if count_from is None and set(df.columns) != set(keys):
        tagged = materialize(tagged)  # range partitioning reads its input twice
    ranked = sorted_index(tagged, ["_h", *keys], name, "_h")
    if set(df.columns) == set(keys):
        return ranked.select(*df.columns, name)
    side = ranked.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], name)
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(side[f"_key_{i}"]) for i, k in enumerate(keys)])
    return df.join(side, same).select(*df.columns, name)


def shuffled_index(df: DataFrame, keys: list[str], seed: int, name: str = "idx") -> DataFrame:
    """dense_index of a stored table of small rows, which are sorted whole: no join to the numbers, so keys may repeat."""
    return sorted_index(df.withColumn("_h", F.unhex(order_key(seed, *keys))), ["_h", *keys], name, "_h")


def sorted_index(df: DataFrame, keys: list[str], name: str = "idx", *dropped: str) -> DataFrame:
    """Dense 0-based index in the order of the keys, which must be unique for a fixed result; ``dropped`` keys only sort.

    Spark's range partitioning sorts the rows; they are numbered inside their partition and shifted by the counts of
    the partitions before, one small row each.  No task sees more than its range.
    """
    ranged = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop(*dropped))
    part = F.shiftrightunsigned("_at", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # A row per shuffle partition.
    return (ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_offset"))


def value_cuts(df: DataFrame, order: str, rows_per_block: int = 1_000_000, max_blocks: int = 8192) -> list:
    """Equi-depth cut points of a numeric column: a bounded list, computed by one aggregate."""
    n = df.select(order).count()
    blocks = min(max_blocks, -(-n // rows_per_block))
    if blocks <= 1:
        return []
    at = [i / blocks for i in range(1, blocks)]
    found = df.agg(F.percentile_approx(order, at, 20 * blocks)).first()[0]
    return sorted(set(found))


def block_of(value: Column, cuts: list) -> Column:
    """Number of cuts <= value, by binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    arr, steps, size = F.lit(cuts), [], 1
    while size <= len(cuts):
        steps.append(size)
        size *= 2
    return F.aggregate(
        F.lit(steps[::-1]), F.lit(0),
        lambda pos, step: F.when(F.get(arr, pos + step - 1) <= value, pos + step).otherwise(pos))


def carried(df: DataFrame, by: list[str], block: Column, order: list[str], value: Column, name: str,
            how: str = "max", forward: bool = True) -> DataFrame:
    """max, min or sum of ``value`` over all earlier (forward) or later rows of the group.

    ``block`` must grow with ``order`` inside a group.  The current row is not included;
    the result is null (0 for sums) where there is nothing before or after.
    """
    agg = {"max": F.max, "min": F.min, "sum": F.sum}[how]
    tagged = df.withColumn("_block", block).withColumn("_value", value)
    direction = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    others = (Window.unboundedPreceding, -1)
    edges = tagged.groupBy(*by, "_block").agg(agg("_value").alias("_edge"))
    over_blocks = Window.partitionBy(*by).orderBy(direction("_block")).rowsBetween(*others)
    carry = edges.select(*by, "_block", agg("_edge").over(over_blocks).alias("_carry"))
    in_block = Window.partitionBy(*by, "_block").orderBy(*[direction(c) for c in order]).rowsBetween(*others)
    inside, outside = agg("_value").over(in_block), F.col("_carry")
    if how == "sum":
        both = F.coalesce(inside, F.lit(0)) + F.coalesce(outside, F.lit(0))
    else:
        both = (F.greatest if how == "max" else F.least)(inside, outside)
    return tagged.join(carry, [*by, "_block"]).withColumn(name, both).drop("_block", "_value", "_carry")
