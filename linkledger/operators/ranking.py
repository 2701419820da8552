"""Running totals and row positions over one global order, without a single-task window.

A window without partition keys sends every row to one task. Here the rows are
range partitioned by the order columns, the small per-range totals are summed
up in order, and each range continues from the total before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

Stage = Callable[[DataFrame, str], DataFrame]


def ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_global_order(df: DataFrame, order: list[str], stage: Stage, value: str = "NULL") -> DataFrame:
    """Add ``position`` (1 = first), ``running`` (sum of value so far), ``overall``
    (its sum) and ``valued`` (how many rows have a value).

    The tagged rows are staged first: both branches below must see the same
    range of every row, also when an executor is lost and tasks run again.
    """
    keys: list[Column] = [F.expr(o.split()[0]).desc() if o.endswith(" DESC") else F.expr(o).asc() for o in order]
    tagged = stage(
        df.selectExpr("*", f"cast({value} AS decimal(18,2)) AS _amount")
        .repartitionByRange(ranges(df), *keys)
        .withColumn("_range", F.spark_partition_id()),
        "global_order",
    )

    # One row per range: never more rows than shuffle partitions.
    before = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = (
        tagged.groupBy("_range")
        .agg(F.expr("count(*) AS _rows"), F.expr("sum(_amount) AS _sum"), F.expr("count(_amount) AS _valued"))
        .selectExpr(
            "_range",
            f"coalesce(sum(_rows) {before}, 0) AS _rows_before",
            f"coalesce(sum(_sum) {before}, 0) AS _sum_before",
            "sum(_sum) OVER () AS overall",
            "sum(_valued) OVER () AS valued",
        )
    )

    inside = f"OVER (PARTITION BY _range ORDER BY {', '.join(order)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        tagged.selectExpr("*", f"row_number() {inside} AS _row", f"sum(_amount) {inside} AS _run")
        .join(F.broadcast(starts), "_range")
        .selectExpr(
            *df.columns, "overall", "valued",
            "_rows_before + _row AS position",
            "_sum_before + coalesce(_run, 0) AS running",
        )
    )


def equal_count_tile(position: str, rows: str, tiles: int = 10) -> str:
    """Tile number of a position when the first tiles take the extra rows."""
    size, extra = f"({rows} div {tiles})", f"({rows} % {tiles})"
    head = f"({extra} * ({size} + 1))"
    ceil = lambda a, b: f"(({a} + {b} - 1) div {b})"
    return (
        f"cast(if({position} <= {head}, {ceil(position, f'({size} + 1)')}, "
        f"{extra} + {ceil(f'({position} - {head})', f'greatest({size}, 1)')}) AS int)"
    )


def share_tile(running: str, overall: str, tiles: int = 10) -> str:
    """Tile number by share of the total, in whole cents so no rounding creeps in."""
    cents = lambda x: f"cast({x} * 100 AS decimal(30,0))"
    return f"cast(least(({cents(running)} * {tiles} + {cents(overall)} - 1) div {cents(overall)}, {tiles}) AS int)"
