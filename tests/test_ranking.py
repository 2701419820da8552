"""The distributed order against plain windows and against brute force."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from linkledger.operators.ranking import in_global_order
from linkledger.operators.revenue import with_sales_decile


def amounts(spark, rows):
    return spark.createDataFrame(
        [(k, None if v is None else Decimal(v)) for k, v in rows], "account_no bigint, total_revenue decimal(18,2)"
    )


def brute_force(rows):
    """(share decile, equal count decile) per account with positive revenue."""
    ranked = sorted(((v, k) for k, v in rows if v is not None and Decimal(v) > 0), key=lambda p: (-Decimal(p[0]), p[1]))
    cents = [int(Decimal(v) * 100) for v, _ in ranked]
    whole, running, found = sum(cents), 0, {}
    size, extra = divmod(len(ranked), 10)
    tiles = [t for t in range(1, 11) for _ in range(size + (t <= extra))]
    for (_, key), cent, tile in zip(ranked, cents, tiles):
        running += cent
        found[key] = (min(10, -(-running * 10 // whole)), tile)
    return found


@pytest.mark.parametrize("rows", [
    [(i, str(random.Random(1).randint(1, 10**6) % (i + 7) + 1)) for i in range(500)],
    [(i, "100.00") for i in range(300)],                                        # all tied
    [(1, "5.00")],                                                              # a single account
    [(1, "1000000.00")] + [(i, "0.01") for i in range(2, 200)],                 # one holds nearly all
    [(i, str(i % 5 - 1)) for i in range(100)] + [(1000, None)],                 # zero, negative, none
    [(i, "3.33") for i in range(7)],                                            # fewer accounts than tiles
])
def test_deciles(spark, stage, rows):
    expected = brute_force(rows)
    for n, method in enumerate(("share", "ntile")):
        got = {r["account_no"]: r["raw_decile"] for r in with_sales_decile(amounts(spark, rows), stage, method).collect()}
        assert len(got) == len(rows)
        assert {k: v for k, v in got.items() if v is not None} == {k: v[n] for k, v in expected.items()}


def test_hot_value_is_spread(spark, stage):
    """Half of all rows tie on the first key and must still land in several ranges."""
    df = spark.range(20000).selectExpr("id", "if(id % 2 = 0, 7, id) AS v")
    seen = {}

    def spy(staged, name):
        kept = stage(staged, name)
        seen["ranges"] = kept.filter("v = 7").select("_range").distinct().count()
        return kept

    out = in_global_order(df, ["v", "id"], spy, "v")
    assert seen["ranges"] > 1
    plain = df.selectExpr("id", "row_number() OVER (ORDER BY v, id) AS position",
                          "sum(v) OVER (ORDER BY v, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running")
    assert out.select("id", "position", F.col("running").cast("bigint")).exceptAll(plain).count() == 0
    assert out.count() == 20000
