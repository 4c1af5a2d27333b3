"""Text and number columns with the conversion rules the sheets were written under."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as white space.
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_DIGITS = r"[0-9]+(_[0-9]+)*"
_FLOAT = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INTEGER = rf"^[+-]?{_DIGITS}$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"
_NAN = r"(?i)^[+-]?nan$"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, no-break spaces and tabs included."""
    return F.btrim(text, F.lit(_WHITE_SPACE))


def parse_float(text: Column) -> Column:
    """Text to double, null where it is not a number.

    Accepts ``1_000``, ``.5``, ``inf`` and ``nan`` and rejects ``1d`` and ``2f``, which a plain
    cast gets the other way round.
    """
    t = strip(text)
    return (
        F.when(t.rlike(_FLOAT), F.regexp_replace(t, "_", "").try_cast("double"))
        .when(t.rlike(_NAN), F.lit(float("nan")))
        .when(t.rlike(_INFINITE), F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def parse_int(text: Column) -> Column:
    t = strip(text)
    return F.when(t.rlike(_INTEGER), F.regexp_replace(t, "_", "").try_cast("int"))


def float_text(number: Column) -> Column:
    """Shortest text of a double: ``0.5``, ``1e-05``, ``12.0``, ``nan``.

    The built-in cast writes an exponent outside [1e-3, 1e7); here it starts outside
    [1e-4, 1e16).
    """
    plain = number.cast("string")
    mantissa = F.regexp_replace(F.substring_index(F.abs(number).cast("string"), "E", 1), r"\.0$", "")
    digits = F.regexp_replace(mantissa, r"\.", "")
    exponent = F.substring_index(plain, "E", -1).try_cast("int")
    sign = F.when(number < 0, "-").otherwise("")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    large = F.concat(
        sign,
        F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0")),
        F.lit("."),
        F.when(F.length(digits) > exponent + 1, F.substring(digits, exponent + 2, F.length(digits)))
        .otherwise("0"),
    )
    scientific = F.concat(
        sign,
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(F.isnan(number), "nan")
        .when(number == float("inf"), "inf")
        .when(number == float("-inf"), "-inf")
        .when(~plain.contains("E"), plain)
        .when(exponent.between(-4, -1), small)
        .when(exponent.between(0, 15), large)
        .otherwise(scientific)
    )


def round_number(number: Column, decimals: int) -> Column:
    """Round the written decimal half up."""
    return F.when(F.isnan(number) | F.abs(number).isin(float("inf")), number).otherwise(F.round(number, decimals))


def round_exactly(number: Column, decimals: int) -> Column:
    """Round the stored binary value; differs from :func:`round_number` only on numbers written
    with a 5 right after the last kept place."""

    @F.pandas_udf("double")
    def rounded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda v: round(v, decimals), na_action="ignore").astype("float64")

    return rounded(number)
