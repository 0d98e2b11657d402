"""Column expressions for cleaning and validating retail records.

Every function returns a ``Column`` made of built-in Spark SQL functions, so
the work stays inside generated code; nothing here is a Python UDF.

Each expression is written once, as SQL text, and handed to the JVM in a
single ``F.expr`` call.  Building it from ``pyspark.sql.functions`` instead
costs one driver-to-JVM round trip per node, which for the quality gate meant
thousands of round trips per run.  Inputs are column names or ``Sql``
fragments (for composing expressions); the ``*_sql`` builders return ``Sql``.

An expression names its input as seldom as it can.  The optimizer writes inputs out
where filters are pushed below projections and joins, so text that is named four times
at each of three levels is computed 64 times, in methods too long for the JIT compiler.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Sql(str):
    """A SQL expression fragment, as opposed to a column name."""


Ref = str  # a column name or an ``Sql`` fragment


def ref(c: Ref) -> str:
    """SQL text for a column name (quoted) or an ``Sql`` fragment (bracketed)."""
    if isinstance(c, Sql):
        return f"({c})"
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError(f"expected a column name or Sql, got {type(c).__name__}")


def lit(value: str) -> str:
    """A SQL string literal for any text (backslashes and quotes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(c: Ref) -> Column:
    return F.expr(ref(c))


# Whitespace a Unicode-aware strip removes: every character Python's
# ``str.isspace`` accepts (the White_Space property plus U+001C-1F).  Derived
# from that rule rather than listed; Spark's own ``trim`` removes only U+0020.
SPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Number text accepted by a lenient parse (decimal, exponent,
# inf / infinity / nan in any case, optional sign, surrounding blanks).
# ``try_cast`` alone would also take Java literals such as ``1.0d``.
NUMBER_PATTERN = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)
WHOLE_NUMBER_PATTERN = r"^\s*[+-]?\d+(?:\.0*)?\s*$"
# A letter that never occurs in plain decimal or exponent text, and the special words a
# lenient parse accepts nevertheless.
_NO_NUMBER_LETTER = "[a-df-zA-DF-Z]"
_NUMBER_WORD = r"^[+-]?(?i:inf|infinity|nan)\z"

# Timestamp layouts tried in order by the strict date parse.
DEFAULT_DATE_FORMATS: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
# The layouts among them that Spark's cast reads, in digits.
_CAST_LAYOUTS: dict[str, str] = {
    "yyyy-MM-dd HH:mm:ss": r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
    "yyyy-MM-dd": r"\d{4}-\d{2}-\d{2}",
}
# Pattern fields that always print with exactly as many digits as letters.
_FIXED_WIDTH_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss", "S", "SS", "SSS")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


# ------------------------------------------------------------ SQL builders
def _visible_start_sql(text: str) -> str:
    """Whether ``text`` begins with a visible ASCII character; null for null."""
    return f"({text} >= '!' AND {text} < {lit(chr(127))})"


def trim_text_sql(c: Ref) -> Sql:
    text = f"CAST({ref(c)} AS STRING)"
    # The search of each end for all space characters is left to the texts that may need it.
    plain = f"trim({text})"
    return Sql(f"CASE WHEN {_visible_start_sql(plain)} AND {_visible_start_sql(f'right({plain}, 1)')} "
               f"THEN {plain} ELSE trim(BOTH {lit(SPACE_CHARS)} FROM {text}) END")


def drop_decimal_zero_sql(c: Ref) -> Sql:
    return Sql(f"regexp_replace({ref(c)}, {lit(r'\.0$')}, '')")


def lenient_double_sql(c: Ref, data_type: T.DataType | None = None) -> Sql:
    if data_type is not None and isinstance(data_type, _NUMERIC):
        return Sql(f"CAST({ref(c)} AS DOUBLE)")
    text = f"trim(CAST({ref(c)} AS STRING))"
    # Two searches, the second for few values, cost a fraction of one replacement.
    return Sql(f"try_cast(CASE WHEN {text} RLIKE {lit(_NO_NUMBER_LETTER)} "
               f"AND NOT {text} RLIKE {lit(_NUMBER_WORD)} THEN NULL ELSE {text} END AS DOUBLE)")


def _fixed_width(fmt: str) -> bool:
    """Numeric fields only (yyyy, MM, dd, HH, mm, ss), no quoted text."""
    runs = [m.group(0) for m in re.finditer(r"([A-Za-z])\1*", fmt)]
    return "'" not in fmt and all(run in _FIXED_WIDTH_FIELDS for run in runs)


def strict_timestamp_sql(c: Ref, formats: Sequence[str] = DEFAULT_DATE_FORMATS,
                         data_type: T.DataType | None = None) -> Sql:
    if data_type is not None and isinstance(
            data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return Sql(f"CAST({ref(c)} AS TIMESTAMP_NTZ)")
    text = f"CAST({ref(c)} AS STRING)"
    if formats and all(fmt in _CAST_LAYOUTS for fmt in formats):
        # The text of any of the layouts, or none, which casts to null.
        layouts = lit(rf"^(?:{'|'.join(_CAST_LAYOUTS[fmt] for fmt in formats)})\z")
        return Sql(f"try_cast(regexp_extract({text}, {layouts}, 0) AS TIMESTAMP_NTZ)")
    parsed = []
    for fmt in formats:
        value = f"CAST(try_to_timestamp({text}, {lit(fmt)}) AS TIMESTAMP_NTZ)"
        if _fixed_width(fmt):
            # Only text of the layout's exact width can match it, so other
            # values skip a parse attempt that would fail.
            value = f"CASE WHEN length({text}) = {len(fmt)} THEN {value} END"
        parsed.append(value)
    return Sql(parsed[0] if len(parsed) == 1 else f"coalesce({', '.join(parsed)})")


def non_blank_sql(c: Ref) -> Sql:
    return Sql(f"coalesce({ref(c)} <> '', false)")


def is_blank_sql(c: Ref) -> Sql:
    # Whether anything is left does not depend on the other end, so the strip stops at the
    # first character that is no space; a visible one needs no strip.
    text = f"CAST({ref(c)} AS STRING)"
    return Sql(f"CASE WHEN {_visible_start_sql(text)} THEN false "
               f"ELSE coalesce(trim(LEADING {lit(SPACE_CHARS)} FROM {text}) = '', false) END")


def finite_sql(c: Ref) -> Sql:
    # NaN is greater than any other value.
    return Sql(f"coalesce(abs({ref(c)}) < double('Infinity'), false)")


def whole_sql(c: Ref) -> Sql:
    # The remainder of an infinite value or NaN is NaN.
    return Sql(f"coalesce({ref(c)} % 1.0D = 0.0D, false)")


# The warehouse keeps quantities as 32-bit integers; one beyond is not valid.
MOST_QUANTITY = 2147483647.0


def valid_quantity_sql(c: Ref) -> Sql:
    return Sql(f"{whole_sql(c)} AND coalesce({ref(c)} <> 0.0D AND "
               f"abs({ref(c)}) <= {MOST_QUANTITY}D, false)")


def positive_finite_sql(c: Ref) -> Sql:
    # The remainder keeps finite values and makes NaN of the others, which is below nothing.
    return Sql(f"coalesce(-({ref(c)} % double('Infinity')) < 0.0D, false)")


def all_of_sql(conditions: Iterable[Ref]) -> Sql:
    return Sql(" AND ".join(ref(c) for c in conditions))


def any_of_sql(conditions: Iterable[Ref]) -> Sql:
    return Sql(" OR ".join(ref(c) for c in conditions))


def line_status_sql(order_id: Ref, quantity: Ref) -> Sql:
    return Sql(f"CASE WHEN left({ref(order_id)}, 1) IN ('C', 'c') OR {ref(quantity)} < 0 "
               f"THEN 'canceled' ELSE 'paid' END")


def absolute_quantity_sql(c: Ref) -> Sql:
    return Sql(f"CAST(abs({ref(c)}) AS BIGINT)")


def date_text_sql(ts: Ref) -> Sql:
    return Sql(f"CAST(to_date({ref(ts)}) AS STRING)")


def segment_sql(country: Ref, home_country: str) -> Sql:
    return Sql(f"CASE WHEN {ref(country)} = {lit(home_country)} THEN 'domestic' "
               f"ELSE 'export' END")


def revenue_flag_sql(status: Ref) -> Sql:
    return Sql(f"CASE WHEN {ref(status)} = 'paid' THEN 1 ELSE 0 END")


def money_round_sql(x: Ref, digits: int = 2) -> Sql:
    scale = float(10**digits)
    return Sql(f"round({ref(x)} * {scale}D) / {scale}D")


# ------------------------------------------------------- Column functions
def trim_text(c: Ref) -> Column:
    """Strip Unicode whitespace at both ends; null stays null.

    Every character of ``SPACE_CHARS`` is removed at both ends.
    """
    return F.expr(trim_text_sql(c))


def drop_decimal_zero(c: Ref) -> Column:
    """Remove one trailing ``.0`` (ids exported through a float column)."""
    return F.expr(drop_decimal_zero_sql(c))


def lenient_double(c: Ref, data_type: T.DataType | None = None) -> Column:
    """Text or number to double; anything unparsable becomes null.

    Text qualifies when it holds no letter other than an exponent ``e`` (or is
    inf / infinity / nan, in any case), which keeps out Java literals such as ``1.0d`` or
    hexadecimal floats that ``try_cast`` would accept."""
    return F.expr(lenient_double_sql(c, data_type))


def strict_timestamp(c: Ref, formats: Sequence[str] = DEFAULT_DATE_FORMATS,
                     data_type: T.DataType | None = None) -> Column:
    """Parse with an explicit list of layouts; the first that fits wins.

    Layouts of digits are matched as a whole before the cast, other ones are parsed by
    ``try_to_timestamp``; both reject trailing text and impossible days, unlike a plain
    cast to date.
    """
    return F.expr(strict_timestamp_sql(c, formats, data_type))


def non_blank(c: Ref) -> Column:
    """Present and not the empty string."""
    return F.expr(non_blank_sql(c))


def is_blank(c: Ref) -> Column:
    """Whitespace-only (or empty); null is *not* blank."""
    return F.expr(is_blank_sql(c))


def finite(c: Ref) -> Column:
    """Not null, not NaN, not +/-inf (F8).  NaN needs its own test in Spark."""
    return F.expr(finite_sql(c))


def whole(c: Ref) -> Column:
    """Finite and without a fractional part."""
    return F.expr(whole_sql(c))


def valid_quantity(c: Ref) -> Column:
    """Finite, non-zero, whole; negative quantities are returns."""
    return F.expr(valid_quantity_sql(c))


def positive_finite(c: Ref) -> Column:
    """Finite and strictly positive (F11, also the Q8 predicate)."""
    return F.expr(positive_finite_sql(c))


def all_of(conditions: Iterable[Ref]) -> Column:
    return F.expr(all_of_sql(conditions))


def any_of(conditions: Iterable[Ref]) -> Column:
    return F.expr(any_of_sql(conditions))


def line_status(order_id: Ref, quantity: Ref) -> Column:
    """``canceled`` for a C-prefixed invoice or a negative quantity."""
    return F.expr(line_status_sql(order_id, quantity))


def absolute_quantity(c: Ref) -> Column:
    """Absolute whole quantity, applied after the status is known."""
    return F.expr(absolute_quantity_sql(c))


def date_text(ts: Ref) -> Column:
    """Timestamp cut to its ``YYYY-MM-DD`` day."""
    return F.expr(date_text_sql(ts))


def segment(country: Ref, home_country: str) -> Column:
    """``domestic`` for the home country, ``export`` for all others (F16)."""
    return F.expr(segment_sql(country, home_country))


def revenue_flag(status: Ref) -> Column:
    """1 for a paid order, 0 for anything else, null included."""
    return F.expr(revenue_flag_sql(status))


def money_round(x: Ref, digits: int = 2) -> Column:
    """Round a double the way C's ``round(x * 10^d) / 10^d`` does.

    Spark's ``round`` on a double rounds its decimal rendering; scaling first
    and rounding to an integer gives the binary-value rounding most engines
    use for DOUBLE.
    """
    return F.expr(money_round_sql(x, digits))
