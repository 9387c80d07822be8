"""Keys, fixed-point text and display labels."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(user_id: str | Column) -> Column:
    """Zero-padded row key, ``user_000042``."""
    return F.format_string("user_%06d", user_id)


def fixed4(value: str | Column) -> Column:
    """Four decimals, no thousands separator, for means rounded to four places."""
    return F.format_string("%.4f", value)


def fixed2(value: str | Column) -> Column:
    """Two decimals of any mean, halves going to the even digit.

    ``format_string`` rounds the shortest text of a double, and halves up:
    3.125 would read 3.13 and 1.015, which lies just below, 1.02. Here the
    binary fraction is scaled as an integer, so nothing is rounded before.
    """
    value = F.col(value) if isinstance(value, str) else value
    one, half = 1 << 52, 1 << 51
    whole = F.floor(value)
    scaled = ((value - whole) * float(one)).cast("bigint") * 100
    cents, rest = F.shiftright(scaled, 52), scaled.bitwiseAND(one - 1)
    up = (rest > half) | ((rest == half) & (cents % 2 == 1))
    total = whole * 100 + cents + up.cast("int")
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)").cast("string")


def support_label(mean: str | Column, count: str | Column) -> Column:
    """``4.4911  (112 ratings)``."""
    return F.format_string("%s  (%d ratings)", fixed4(mean), count)


def short_support_label(mean: str | Column, count: str | Column) -> Column:
    """``4.49  (112 ratings)``."""
    return F.format_string("%s  (%d ratings)", fixed2(mean), count)


def shortened(title: str, width: int = 41) -> Column:
    return F.substring(title, 1, width)


def gender_label(code: str | Column) -> Column:
    """``M`` reads Male; every other code reads Female."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code == "M", "Male").otherwise("Female")


def or_default(column: str | Column, default: object) -> Column:
    return F.coalesce(column, F.lit(default))
