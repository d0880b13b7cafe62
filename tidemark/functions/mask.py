"""Update masks: which columns an update touched, as a bitmap of column ordinals.

The bitmap is big-endian binary: ordinal 1 is the lowest bit of the last byte. Masks are
built from 32-bit words, so tables may have any number of columns; counts and co-changes
come from bitwise work on distinct masks, of which there are far fewer than changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 32


def _words(n: int) -> int:
    return max(1, -(-n // WORD))


def mask_of(flags: Sequence[Column]) -> Column:
    """Mask of one boolean per column, in ordinal order; null counts as not touched."""
    words = []
    for w in reversed(range(_words(len(flags)))):
        part = flags[w * WORD : (w + 1) * WORD]
        word = F.lit(0).cast("bigint")
        for k, f in enumerate(part):
            word = word.bitwiseOR(F.when(F.coalesce(f, F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
        words.append(F.lpad(F.hex(word), WORD // 4, "0"))
    return F.unhex(F.concat(*words))


def mask_from_names(names: Column, columns: Sequence[str]) -> Column:
    """Mask of an array of column names; unknown names are left out."""
    return mask_of([F.array_contains(names, c) for c in columns])


def bit_of(mask: Column, ordinal: int) -> Column:
    """Whether the mask has the 1-based ordinal; masks may be longer or shorter than needed."""
    at = F.length(mask) - (ordinal - 1) // 8
    byte = F.conv(F.hex(F.substring(mask, at, 1)), 16, 10).cast("bigint")
    return F.when(at < 1, F.lit(False)).otherwise(F.shiftright(byte, (ordinal - 1) % 8).bitwiseAND(F.lit(1)) == 1)


def names_from_mask(mask: Column, columns: Sequence[str]) -> Column:
    """Names of the touched columns, in ordinal order."""
    each = F.array(*[F.when(bit_of(mask, k), F.lit(c)) for k, c in enumerate(columns, 1)])
    return F.filter(each, lambda x: x.isNotNull())


def image_mask(old: Column, new: Column, columns: Sequence[str]) -> Column:
    """Mask of the columns whose values differ between two images (null-safe)."""
    return mask_of([~old.getField(c).eqNullSafe(new.getField(c)) for c in columns])


def co_changes(masked: DataFrame, columns: Sequence[str], mask: str = "update_mask", by: Sequence[str] = ()) -> DataFrame:
    """``by``, column_a, column_b, updates: how often two columns changed together (a column with
    itself: how often it changed), a before b in ordinal order.

    Changes are first counted per distinct mask; bits are read from those rows only.
    """
    counted = masked.groupBy(*by, mask).agg(F.count(F.lit(1)).alias("_n"))
    touched = counted.select(*by, "_n", names_from_mask(F.col(mask), columns).alias("_names"))
    a = touched.select(*by, "_n", "_names", F.posexplode("_names").alias("_at", "column_a"))
    b = a.select(*by, "_n", "column_a", F.explode(F.slice("_names", F.col("_at") + 1, F.size("_names"))).alias("column_b"))
    return b.groupBy(*by, "column_a", "column_b").agg(F.sum("_n").cast("bigint").alias("updates"))
