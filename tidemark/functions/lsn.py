"""LSN column expressions: binary inside, 20-character upper-case hex at the edges.

All of these are plain Catalyst expressions (``hex``/``unhex``/``lpad``), so they stay
inside whole-stage codegen and a bare ``lsn`` column keeps Parquet filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.model import LSN_BYTES

HEX_WIDTH = 2 * LSN_BYTES


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lsn_from_number(col: str | Column) -> Column:
    """Non-negative bigint → 10-byte big-endian LSN."""
    return F.unhex(F.lpad(F.hex(_c(col)), HEX_WIDTH, "0"))


def lsn_from_hex(col: str | Column) -> Column:
    """Hex text (any width up to 20) → 10-byte LSN; empty text → null."""
    c = _c(col)
    return F.when(F.length(c) > 0, F.unhex(F.lpad(F.upper(c), HEX_WIDTH, "0")))


def lsn_hex(col: str | Column) -> Column:
    """10-byte LSN → 20-character upper-case hex (null stays null)."""
    return F.lpad(F.hex(_c(col)), HEX_WIDTH, "0")


def lsn_literal(value: int | str | bytes) -> Column:
    """A constant LSN from an int, a hex string or raw bytes."""
    if isinstance(value, int):
        raw = value.to_bytes(LSN_BYTES, "big")
    elif isinstance(value, str):
        raw = bytes.fromhex(value.rjust(HEX_WIDTH, "0"))
    else:
        raw = bytes(value).rjust(LSN_BYTES, b"\x00")
    return F.lit(bytearray(raw)).cast(BinaryType())


def lsns_to_hex(df: DataFrame, *cols: str) -> DataFrame:
    """Display form: replace every named binary LSN column by its hex text."""
    names = cols or tuple(f.name for f in df.schema.fields if isinstance(f.dataType, BinaryType))
    return df.withColumns({c: lsn_hex(c) for c in names if c in df.columns})
