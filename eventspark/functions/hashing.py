"""Scalar UDF ``hashCode(s) * factor`` with 32-bit wrap-around, kept inside Catalyst.

The string's code points, those beyond the BMP as surrogate pairs (Java's char units), are folded with ``h = 31*h + unit``
modulo 2^32, re-signed, multiplied by the factor and wrapped again.  Everything is built-in expressions (no Python
per row), so it runs in the JVM next to the scan.  NULL in → NULL out.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The factor used when the job parameter is unset (12) and Java's hash multiplier (31).
DEFAULT_FACTOR = 12
JAVA_HASH_MULTIPLIER = 31

TWO32 = 1 << 32
TWO31 = 1 << 31


def _signed32(x: Column) -> Column:
    """Unsigned 32-bit value in a long → Java int value (one use of ``x``, so it is evaluated once)."""
    return F.pmod(x + F.lit(TWO31), F.lit(TWO32)) - F.lit(TWO31)


def java_hash_code(s: Column) -> Column:
    points = F.transform(F.split(s, F.lit("")), lambda c: F.ascii(c).cast("bigint"))

    def fold(h: Column, c: Column) -> Column:  # a point beyond the BMP is two units, its surrogates
        pair = (h * JAVA_HASH_MULTIPLIER + F.lit(0xD7C0) + F.shiftright(c, 10)) * JAVA_HASH_MULTIPLIER
        return F.pmod(F.when(c < 0x10000, h * JAVA_HASH_MULTIPLIER + c)
                      .otherwise(pair + F.lit(0xDC00) + c.bitwiseAND(0x3FF)), F.lit(TWO32))

    folded = F.aggregate(points, F.lit(0).cast("bigint"), fold)
    return F.when(s == "", F.lit(0)).otherwise(_signed32(folded)).cast("int")


def hash_code_times(s: Column, factor: int = DEFAULT_FACTOR) -> Column:
    h = java_hash_code(s).cast("bigint")
    return _signed32(F.pmod(h * F.lit(int(factor)), F.lit(TWO32))).cast("int")


def register_hash_code(spark: SparkSession, name: str = "hashCode", factor: int | None = None) -> None:
    """Register the function for SQL as a SQL function (body stays a Catalyst expression).

    ``factor`` falls back to the session conf ``eventspark.hashcode_factor`` (the job parameter), else 12.
    """
    if factor is None:
        factor = int(spark.conf.get("eventspark.hashcode_factor", str(DEFAULT_FACTOR)))
    m = JAVA_HASH_MULTIPLIER
    fold = (f"aggregate(transform(split(s, ''), c -> CAST(ascii(c) AS BIGINT)), CAST(0 AS BIGINT), (h, c) -> pmod("
            f"CASE WHEN c < 65536 THEN h * {m} + c ELSE (h * {m} + 55232 + shiftright(c, 10)) * {m} + 56320 + (c & 1023) END, "
            f"{TWO32}))")
    signed = f"(pmod({fold} + {TWO31}, {TWO32}) - {TWO31})"
    body = f"CAST(pmod({signed} * {int(factor)} + {TWO31}, {TWO32}) - {TWO31} AS INT)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT RETURN "
              f"CASE WHEN s IS NULL OR s = '' THEN (CASE WHEN s IS NULL THEN NULL ELSE 0 END) ELSE {body} END")
