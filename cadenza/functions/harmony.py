"""Musical key encodings as built-in Column expressions.

No Python UDF: every function returns a Catalyst expression, so it stays in
whole-stage codegen and filters on its result can still be pushed below it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference) --------------------------------
# Camelot wheel number for each pitch class key = 0..11 (0 = C, 1 = C#/Db, ...
# 11 = B), major keys (letter B) and minor keys (letter A).
CAMELOT_MAJOR = [8, 3, 10, 5, 12, 7, 2, 9, 4, 11, 6, 1]
CAMELOT_MINOR = [5, 12, 7, 2, 9, 4, 11, 6, 1, 8, 3, 10]
# ---------------------------------------------------------------------------

TWO_PI = 2 * math.pi


def _lookup(table: list[int], idx: Column) -> Column:
    """table[idx] for idx in 0..11, null otherwise (ANSI-safe)."""
    arr = F.array(*[F.lit(v) for v in table])
    return F.when(idx.between(0, 11), F.get(arr, idx.cast("int")))


def key_sin(key: Column) -> Column:
    """H1 — sin(2π·key/12)."""
    return F.sin(F.lit(TWO_PI) * key / F.lit(12))


def key_cos(key: Column) -> Column:
    """H1 — cos(2π·key/12)."""
    return F.cos(F.lit(TWO_PI) * key / F.lit(12))


def mode_major(mode: Column) -> Column:
    """H3 — 1 if mode = 1 else 0 (null → 0)."""
    return F.when(mode == 1, F.lit(1)).otherwise(F.lit(0))


def camelot_number(key: Column, mode: Column) -> Column:
    """H4 — wheel number 1..12; null key/mode or key outside 0..11 → null.

    A fractional key is truncated first (int(key) semantics); a key that no
    int can hold, or not a number, is outside.
    """
    k = F.when((key > -1) & (key < 12), key.cast("int"))
    return (F.when(key.isNull() | mode.isNull(), F.lit(None).cast("int"))
            .when(mode == 1, _lookup(CAMELOT_MAJOR, k))
            .otherwise(_lookup(CAMELOT_MINOR, k)))


def camelot_letter(mode: Column) -> Column:
    """H5 — 'B' for major (mode = 1), 'A' otherwise (null → 'A')."""
    return F.when(mode == 1, F.lit("B")).otherwise(F.lit("A"))


def camelot_code(key: Column, mode: Column) -> Column:
    """H6 — e.g. '8B'; null when the number is null."""
    return F.concat(camelot_number(key, mode).cast("string"), camelot_letter(mode))


def camelot_neighbors(num: Column, letter: Column) -> Column:
    """H7 — [same, num−1 (wrap to 12), num+1 (wrap to 1), same number other letter]."""
    down = F.when(num > 1, num - 1).otherwise(F.lit(12))
    up = F.when(num < 12, num + 1).otherwise(F.lit(1))
    other = F.when(letter == "A", F.lit("B")).otherwise(F.lit("A"))
    return F.array(
        F.concat(num.cast("string"), letter),
        F.concat(down.cast("string"), letter),
        F.concat(up.cast("string"), letter),
        F.concat(num.cast("string"), other),
    )


def camelot_angle(num: Column) -> Column:
    return F.lit(TWO_PI) * (num - F.lit(1)) / F.lit(12)


def camelot_cos(num: Column) -> Column:
    """H8."""
    return F.cos(camelot_angle(num))


def camelot_sin(num: Column) -> Column:
    """H8."""
    return F.sin(camelot_angle(num))


def camelot_mode_small(letter: Column) -> Column:
    """H9 — 1.0 for 'B', else 0.0."""
    return F.when(letter == "B", F.lit(1.0)).otherwise(F.lit(0.0))


def tempo_bin(tempo: Column, width: int = 5) -> Column:
    """H14 — floor(tempo / width) * width, as int."""
    return (F.floor(tempo / F.lit(width)) * F.lit(width)).cast("int")


def tempo_diff(tempo: Column, seed_tempo: Column) -> Column:
    """H15 — |tempo − seed tempo|."""
    return F.abs(tempo - seed_tempo)


def with_camelot(df, key: str = "key", mode: str = "mode"):
    """Add camelot_num, camelot_letter, camelot (code) columns."""
    return (df.withColumn("camelot_num", camelot_number(F.col(key), F.col(mode)))
              .withColumn("camelot_letter", camelot_letter(F.col(mode)))
              .withColumn("camelot", F.concat(F.col("camelot_num").cast("string"), F.col("camelot_letter"))))
