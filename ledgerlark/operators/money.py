"""Exact sums of quantity x price for prices of any size.

A price counts as the decimal number that its shortest text spells.  Prices below 10^9
with up to 12 decimals fit DECIMAL(27,12) and are summed as such; those below 10^7 in whole
cents, which no other number of up to 15 digits shares its double with, get there by integers
instead of text.  Any other line is split
into limbs of nine digits, (limb, value) with the value in units of 10^(9 limb); limbs are
summed for each key and limb, which partial aggregation does map-side, and only then joined:
carries run from the lowest limb up, so the total is exact whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the two ways meet: prices from here on, or with more decimals, go by limbs.
WIDE_PRICE = 1.0e9
_PRICE = "CAST(unit_price AS DOUBLE)"

# The price in cents, if it has no more than two decimals (the division is rounded correctly).
_CENTS = f"floor({_PRICE} * 100D + 0.5D)"
IN_CENTS_SQL = (f"coalesce({_PRICE} >= 0D AND {_PRICE} < 1.0E7D "
                f"AND CAST({_CENTS} AS DOUBLE) / 100D = {_PRICE}, false)")

#: Whether DECIMAL(27,12) holds the price exactly; null for a null price.
FITS_SQL = (f"(CASE WHEN {IN_CENTS_SQL} THEN true "
            f"WHEN {_PRICE} < {WIDE_PRICE}D AND {_PRICE} > -{WIDE_PRICE}D "
            f"THEN CAST(CAST({_PRICE} AS DECIMAL(27,12)) AS DOUBLE) = {_PRICE} "
            f"WHEN {_PRICE} IS NOT NULL THEN false END)")
_PLAIN_SQL = ("CAST(CAST(quantity AS INT) AS DECIMAL(10,0)) "
              f"* CAST({_PRICE} AS DECIMAL(27,12))")
_CENTS_VALUE_SQL = (f"CAST(CAST(CAST(CAST(quantity AS INT) AS BIGINT) * {_CENTS} AS DECIMAL(19,0)) "
                    "* CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,12))")


def line_value_sql(split: bool) -> str:
    """Exact value of a line.  A price that does not fit counts as 0 where its limbs are
    summed elsewhere (``split``), and is an error where they are not."""
    other = ("CAST(0 AS DECIMAL(38,12))" if split else
             "raise_error(concat('price ', CAST(unit_price AS STRING), ' needs the sum by limbs'))")
    return (f"CASE WHEN {IN_CENTS_SQL} THEN {_CENTS_VALUE_SQL} WHEN {FITS_SQL} THEN {_PLAIN_SQL} "
            f"WHEN unit_price IS NOT NULL AND quantity IS NOT NULL THEN {other} END")


#: Value of a line in cents as BIGINT; null where the price is not in whole cents.
CENTS_SQL = f"CASE WHEN {IN_CENTS_SQL} THEN CAST(CAST(quantity AS INT) AS BIGINT) * {_CENTS} END"


def line_sum_sql(cents: str, split: bool) -> str:
    """Exact sum of line values, the same as that of ``line_value_sql``.  Lines with ``cents``, a
    BIGINT column, are summed as its upper and lower 32 bits, so that no sum of 64 bits runs
    over; only the others are summed as decimals."""
    plain = (f"CAST((CAST(sum(shiftright({cents}, 32)) AS DECIMAL(20,0)) * CAST(4294967296 AS DECIMAL(10,0)) "
             f"+ CAST(sum({cents} & 4294967295L) AS DECIMAL(20,0))) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,12))")
    rest = f"sum(CASE WHEN {cents} IS NULL THEN {line_value_sql(split)} END)"
    return f"coalesce(CAST({plain} + {rest} AS DECIMAL(38,12)), {plain}, {rest})"


def wide_prices() -> Column:
    """Counter of the lines whose price does not fit."""
    return F.expr(f"count_if(NOT {FITS_SQL})")


def limb_rows(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, limb and value of the ``lines`` (quantity, unit_price) that do not fit."""
    text = f"split(CAST({_PRICE} AS STRING), 'E')"
    parts = lines.where(f"NOT {FITS_SQL} AND quantity IS NOT NULL").selectExpr(
        *keys, f"assert_true({_PRICE} > 0 AND {_PRICE} < double('Infinity'), "
               "'prices have to be positive and finite') AS checked",
        "CAST(CAST(quantity AS INT) AS DECIMAL(10,0)) AS q", f"{text}[0] AS mantissa",
        f"CAST(coalesce(try_element_at({text}, 2), '0') AS INT) AS exponent")
    # price = digits x 10^place
    parts = parts.where("checked IS NULL").selectExpr(
        *keys, "q * CAST(replace(mantissa, '.', '') AS DECIMAL(20,0)) AS units",
        "exponent - (CASE WHEN instr(mantissa, '.') > 0 THEN length(mantissa) - "
        "instr(mantissa, '.') ELSE 0 END) AS place")
    padded = ("lpad(concat(CAST(units AS STRING), repeat('0', place - 9 * limb)), 45, '0')")
    sliced = ", ".join(f"named_struct('limb', limb + {k}, 'value', "
                       f"CAST(substr(digits, {37 - 9 * k}, 9) AS DECIMAL(18,0)))" for k in range(5))
    return parts.selectExpr("*", "CAST(floor(place / 9) AS INT) AS limb").selectExpr(
        *keys, "limb", f"{padded} AS digits").selectExpr(*keys, f"inline(array({sliced}))").where(
        "value <> 0")


def limb_sums(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and _limbs (limb -> sum) of the lines that do not fit."""
    summed = limb_rows(lines, keys).groupBy(*keys, "limb").agg(F.sum("value").alias("value"))
    # At most the 80 limbs that the range of doubles has, for each key.
    return summed.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("limb", "value"))).alias("_limbs"))


def with_limbs(grouped: DataFrame, limbs: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """``grouped`` with its keys' _limbs (null: all prices fit)."""
    if limbs is None:
        return grouped.withColumn("_limbs", F.expr("CAST(NULL AS MAP<INT, DECIMAL(28,0)>)"))
    named = limbs.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return grouped.join(named, same, "left").drop(*(f"_k_{k}" for k in keys))


def _digits_sql(total: str, rounded: bool) -> str:
    """Text of the exact sum of ``total`` (DECIMAL(38,12), not negative) and _limbs, as
    digits from limb min(-2, lowest) up; with 0.005 added where it is to be cut to cents."""
    plain = f"lpad(concat(replace(CAST(CAST({total} AS DECIMAL(38,12)) AS STRING), '.', ''), '000000'), 54, '0')"
    lowest = "least(-2, array_min(map_keys(_limbs)))"
    own = (f"(CASE WHEN i BETWEEN -2 AND 3 THEN CAST(substr({plain}, 46 - 9 * (i + 2), 9) "
           "AS DECIMAL(18,0)) ELSE 0 END)")
    more = " + (CASE WHEN i = -1 THEN 5000000 ELSE 0 END)" if rounded else ""
    here = f"CAST(s.carry + coalesce(_limbs[i], 0) + {own}{more} AS DECIMAL(32,0))"
    step = (f"transform(array({here}), t -> named_struct('carry', "
            "CAST((t - t % 1000000000) / 1000000000 AS DECIMAL(32,0)), 'digits', "
            "concat(lpad(CAST(CAST(t % 1000000000 AS BIGINT) AS STRING), 9, '0'), s.digits)))[0]")
    return (f"aggregate(sequence({lowest}, greatest(3, array_max(map_keys(_limbs))) + 4), "
            "named_struct('carry', CAST(0 AS DECIMAL(32,0)), 'digits', ''), "
            f"(s, i) -> {step}, s -> s.digits)")


def _by_limbs_sql(total: str, rounded: bool) -> str:
    fraction = "(-9 * least(-2, array_min(map_keys(_limbs))))"
    digits = _digits_sql(total, rounded)
    cut = "2" if rounded else fraction
    return (f"transform(array({digits}), d -> CAST(concat(left(d, length(d) - {fraction}), '.', "
            f"substr(d, length(d) - {fraction} + 1, {cut})) AS DOUBLE))[0]")


def cents_sql(total: str) -> str:
    """The exact sum rounded half away from zero to cents, as DOUBLE."""
    return (f"CASE WHEN _limbs IS NULL THEN CAST(round({total}, 2) AS DOUBLE) "
            f"ELSE {_by_limbs_sql(total, True)} END")


def double_sql(total: str) -> str:
    """The DOUBLE nearest to the exact sum."""
    return (f"CASE WHEN _limbs IS NULL THEN CAST({total} AS DOUBLE) "
            f"ELSE {_by_limbs_sql(total, False)} END")
