"""Number and truth functions (NUM-1 … NUM-4, BOOL-1/2, NULL-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TEXT_TRUE

JSON_NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"
# What a float text may look like. Spark's own cast also takes "1d" and "1f".
DIGITS = r"[0-9]+(_[0-9]+)*"
FLOAT_TEXT = (
    rf"^[+-]?({DIGITS}[.]?({DIGITS})?|[.]{DIGITS})([eE][+-]?{DIGITS})?$|^(?i)[+-]?(inf|infinity|nan)$"
)
JSON_BLANKS = " \t\n\r"


def clean_number(c: Column) -> Column:
    """Keep digits and dots only, then read a double; NULL when that fails.

    The shape is tested first: a failing cast costs an exception per row. What is left is a number
    if it has a digit and no second dot. As the test names the cleaned text more than once, Spark works it out
    once a row; with one pattern as the test it did so there and again for the cast.
    """
    v = F.regexp_replace(c, "[^0-9.]+", "")
    return F.when((F.substring_index(v, ".", 2) == v) & ~v.isin("", "."), v).try_cast("double")


def clean_sheet_number(c: Column) -> Column:
    """As :func:`clean_number`, with spreadsheet errors and failures as 0."""
    broken = F.contains(c, F.lit("#DIV/0!")) | F.contains(c, F.lit("#REF!"))
    return F.when(broken, F.lit(0.0)).otherwise(F.coalesce(clean_number(c), F.lit(0.0)))


def to_number(c: Column, kind: str) -> Column:
    """Clean a text column; a number is only widened, so its sign survives."""
    return clean_number(c) if kind == "string" else c.cast("double")


def text_to_long(c: Column) -> Column:
    """JSON number text to bigint, truncating; ``true``/``false`` to 1/0."""
    v = F.btrim(c, F.lit(JSON_BLANKS))
    number = F.when(v.rlike(JSON_NUMBER), v)
    return F.coalesce(
        number.try_cast("bigint"),
        number.try_cast("double").try_cast("bigint"),
        F.when(v == "true", F.lit(1)).when(v == "false", F.lit(0)).cast("bigint"),
    )


def text_to_id(c: Column) -> Column:
    """JSON number text to the text of an integer of any length."""
    v = F.btrim(c, F.lit(JSON_BLANKS))
    return F.coalesce(text_to_long(c).cast("string"), F.when(v.rlike(r"^-?[1-9][0-9]*$"), v))


def text_to_double(c: Column) -> Column:
    v = F.trim(c)
    return F.when(v.rlike(FLOAT_TEXT), F.replace(v, F.lit("_"), F.lit(""))).try_cast("double")


def is_float(c: Column) -> Column:
    return text_to_double(c).isNotNull()


def is_true(c: Column, numeric: bool = False) -> Column:
    """``true``/``True`` or a true boolean; for a number column, 1. Else false."""
    hit = (c == 1) if numeric else c.cast("string").isin(*TEXT_TRUE)
    return F.coalesce(hit, F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


# --- exact sums ----------------------------------------------------------------
#
# A double is summed in limbs, each an exact decimal, so no order of rows changes a
# sum. Common amounts lie in the first limb alone; the others are NULL for them.

MONEY = "decimal(36,12)"
WIDE = "decimal(38,12)"
#: Numbers from here on are whole and go to the limb of large ones; those beyond, or nearer to 0, to that of doubles.
LARGE, BEYOND, TINY = 1e24, 1e36, 1e-20
#: The limbs: common amounts, what they leave behind the twelfth place, large numbers, those that no decimal holds.
LIMBS = ("", "_fine", "_large", "_beyond")


def money(c: Column) -> Column:
    """The first limb: twelve places after the point and 24 before it; NULL for what is no number or larger."""
    return c.try_cast(MONEY)


def money_sum(c: Column) -> Column:
    """The sum of a first limb, 26 places before the point."""
    return F.try_sum(c.try_cast(WIDE))


def limbs(c: Column) -> list[Column]:
    """The limbs of a number, in the order of ``LIMBS``; all NULL for what is no finite number.

    Behind the twelfth place a double has digits only below 100,000; these are kept to the 32nd place.
    No number is lost: what no decimal holds (from 1e36 on, and below 1e-20) is summed as doubles, and only there
    may the order of rows change the last bits.
    """
    x = c.try_cast("double")
    size = F.abs(x)
    first = F.when(size < LARGE, money(c))
    rest = x.try_cast("decimal(38,32)") - first
    fine = F.when((size < 1e5) & (size >= TINY) & (first.cast("double") != x), rest.try_cast("decimal(38,38)"))
    large = F.when((size >= LARGE) & (size < BEYOND), x.try_cast("decimal(38,0)"))
    beyond = F.when(((size >= BEYOND) & (size < float("inf"))) | ((size < TINY) & (size > 0)), x)
    return [first, fine, large, beyond]


def limb_sums(parts: list[Column]) -> list[Column]:
    """The sums of limbs, which are limbs again."""
    first, fine, large, beyond = parts
    return [money_sum(first), F.try_sum(fine), F.try_sum(large), F.sum(beyond)]


def named_limbs(name: str) -> list[Column]:
    """Columns that hold the limbs of ``name``."""
    return [F.col(f"`{name}{limb}`") for limb in LIMBS]


def as_limbs(name: str, parts: list[Column]) -> list[Column]:
    return [part.alias(f"{name}{limb}") for part, limb in zip(parts, LIMBS)]


def add_limbs(a: list[Column], b: list[Column]) -> list[Column]:
    """Limb by limb; NULL counts as nothing."""
    kinds = (WIDE, "decimal(38,38)", "decimal(38,0)", "double")
    return [F.coalesce(F.try_add(x.try_cast(k), y.try_cast(k)), x.try_cast(k), y.try_cast(k)) for x, y, k in zip(a, b, kinds)]


def whole(parts: list[Column]) -> Column:
    """The number that limbs hold, rounded once a limb, largest first; 0 for none."""
    first, fine, large, beyond = (F.coalesce(part.cast("double"), F.lit(0.0)) for part in parts)
    return beyond + large + first + fine


def exact_sum(c: Column) -> Column:
    """The sum of a column as a double, the same for any order of rows; 0 where there is no number."""
    return whole(limb_sums(limbs(c)))
