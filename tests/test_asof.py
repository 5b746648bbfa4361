"""Versions valid on many days against a plain comparison of all pairs."""

import datetime as dt
import random

from pickbay.operators.asof import as_of_many

CHAIN = "poid string, start_date string, end_date string, v int"
ROWS = "poid string, day string, n int"


def plain(chain, rows):
    return sorted((p, d, n, s, e, v) for p, d, n in rows for q, s, e, v in chain
                  if None not in (p, d, s, e) and p == q and s <= d < e)


def day(rng, first=dt.date(2021, 11, 1), days=1100):
    return (first + dt.timedelta(days=rng.randrange(days))).isoformat()


def found(spark, chain, rows):
    df = as_of_many(spark.createDataFrame(chain, CHAIN), spark.createDataFrame(rows, ROWS), ["poid"], "day")
    return sorted(map(tuple, df.collect())), df


def test_against_all_pairs(spark):
    rng = random.Random(1)
    chain = [(f"p{rng.randrange(9)}", *sorted([day(rng), day(rng)]), i) for i in range(300)]
    chain += [("p1", "1900-01-01", "9999-12-31", 900), ("p2", "2022-01-01", "2024-01-01", 901), ("p3", "2022-03-01", "2022-03-01", 902),
              ("p4", "2024-02-29", "2024-03-01", 903), ("p5", None, "2024-01-01", 904), (None, "2022-01-01", "2024-01-01", 905)]
    rows = [(f"p{rng.randrange(9)}", day(rng), i) for i in range(500)] + [("p1", None, 900), (None, "2022-05-05", 901), ("p4", "2024-02-29", 902)]
    rows += [("p2", "2021-12-31", 1), ("p2", "2022-01-01", 2), ("p2", "2023-12-31", 3), ("p2", "2024-01-01", 4)]
    got, df = found(spark, chain, rows)
    assert got == plain(chain, rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_range_over_everything_is_few_pieces(spark):
    from pickbay.operators import asof
    from pyspark.sql import functions as F
    one = spark.createDataFrame([(dt.date(2020, 1, 15), dt.date(2024, 6, 20))], "_lo date, _hi date")
    pieces = one.select(F.expr(asof._pieces("_lo", "_hi")).alias("p")).first().p
    assert sorted(p for p in pieces if len(p) == 4) == ["2021", "2022", "2023"]
    assert len(pieces) == 3 + 11 + 17 + 5 + 19          # years, months and days before, months and days after


def test_hot_key_with_many_versions(spark):
    """A third of all rows and of all versions under one key: no more candidates than results."""
    rng = random.Random(2)
    first = dt.date(2022, 1, 1)
    chain = [("hot", (first + dt.timedelta(days=k)).isoformat(), (first + dt.timedelta(days=k + 1)).isoformat(), k) for k in range(900)]
    rows = [("hot" if i % 3 == 0 else f"p{i % 50}", day(rng, first, 900), i) for i in range(3000)]
    got, _ = found(spark, chain, rows)
    assert len(got) == 1000 and got == plain(chain, rows)


def test_empty_sides(spark):
    assert found(spark, [], [("p", "2022-01-01", 1)])[0] == []
    assert found(spark, [("p", "2022-01-01", "2023-01-01", 1)], [])[0] == []
