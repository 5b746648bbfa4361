"""Versions valid on many days: a chain (validity ranges) joined with dated rows.

A range join on `start <= day < end` would compare every version of a key with
every row of it.  Here a range is cut into calendar pieces, each a whole year, a
whole month or a day, written as the common beginning of its days ("2024",
"2024-03", "2024-03-09"); a day lies in exactly one piece of a range that holds
it, and a day's own three beginnings are all the pieces it can lie in.  So the
join is an equality on key and piece, without false candidates, however long
the ranges and however many versions a key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS = (("YEAR", 12, 4), ("MONTH", 1, 7))    # unit, its months, characters of its days' common beginning


def _pieces(lo: str, hi: str, units=UNITS) -> str:
    """SQL array of the pieces of the days from `lo` to the day before `hi` (date expressions)."""
    if not units:
        return f"CASE WHEN {lo} < {hi} THEN transform(sequence({lo}, date_sub({hi}, 1)), d -> date_format(d, 'yyyy-MM-dd')) ELSE array() END"
    (unit, months, chars), rest = units[0], units[1:]
    first = f"CASE WHEN trunc({lo}, '{unit}') = {lo} THEN {lo} ELSE add_months(trunc({lo}, '{unit}'), {months}) END"
    last = f"trunc({hi}, '{unit}')"
    whole = (f"transform(sequence({first}, add_months({last}, -{months}), INTERVAL {months} MONTH), "
             f"d -> substring(date_format(d, 'yyyy-MM-dd'), 1, {chars}))")
    return (f"CASE WHEN {first} < {last} THEN concat({whole}, {_pieces(lo, f'({first})', rest)}, {_pieces(f'({last})', hi, rest)}) "
            f"ELSE {_pieces(lo, hi, rest)} END")


def as_of_many(chain: DataFrame, rows: DataFrame, on: list[str], day: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """`rows` joined with the versions of `chain` valid on their own day.

    `on` are key columns of both (null matches nothing), `day`, `start` and `end`
    are ISO dates as text; a version is valid from `start` to the day before
    `end`.  Returns all columns of `rows`, then those of `chain` but the keys.  A
    row without a valid version, and a version or row whose dates are missing
    or no dates, is left out; rows valid with several versions come once for each.

    Ranges are cut only within the days that occur in `rows` (two values read to
    the driver), so an open end costs a few years' pieces, not thousands.
    """
    dated = rows.withColumn("_day", F.to_date(F.col(day).try_cast("date")))
    span = dated.agg(F.min("_day").alias("a"), F.max("_day").alias("b")).first()
    probes = dated.withColumn("_piece", F.explode(F.expr(
        "transform(array(4, 7, 10), n -> substring(date_format(_day, 'yyyy-MM-dd'), 1, n))"))).where("_day IS NOT NULL").drop("_day")
    others = [c for c in chain.columns if c not in on]
    clipped = chain.select(
        *chain.columns,
        F.greatest(F.col(start).try_cast("date"), F.lit(span.a)).alias("_lo"),
        F.least(F.col(end).try_cast("date"), F.date_add(F.lit(span.b), 1)).alias("_hi")).where(
        F.col(start).try_cast("date").isNotNull() & F.col(end).try_cast("date").isNotNull() & (F.col("_lo") < F.col("_hi")))
    pieces = clipped.withColumn("_piece", F.explode(F.expr(_pieces("_lo", "_hi"))))
    joined = probes.join(pieces.select(*on, "_piece", *[F.col(c).alias(f"_v_{c}") for c in others]), [*on, "_piece"])
    return joined.select(*rows.columns, *[F.col(f"_v_{c}").alias(c) for c in others])
