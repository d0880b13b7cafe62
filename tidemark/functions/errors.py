"""Error text → acknowledgement status, as one JVM-side ``CASE`` expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import ACK_FAILED, ACK_RETRY, ACK_SCHEMA_MISMATCH

# ---- fixed values: substrings (matched case-insensitively, checked in this order) ---
RETRY_MARKERS = ("connection", "timeout", "temporarily unavailable")
SCHEMA_MARKERS = ("column", "type", "schema")


def _any_contains(text: Column, markers: tuple[str, ...]) -> Column:
    cond = F.lit(False)
    for m in markers:
        cond = cond | text.contains(m)
    return cond


def classify_error(message: str | Column) -> Column:
    """RETRY for transient faults, else SCHEMA_MISMATCH for shape faults, else FAILED."""
    msg = F.lower(F.col(message) if isinstance(message, str) else message)
    return (
        F.when(_any_contains(msg, RETRY_MARKERS), F.lit(ACK_RETRY))
        .when(_any_contains(msg, SCHEMA_MARKERS), F.lit(ACK_SCHEMA_MISMATCH))
        .otherwise(F.lit(ACK_FAILED))
    )


def error_status(message: str) -> str:
    """The same classes for one message in Python (an apply attempt's own error)."""
    text = message.lower()
    if any(m in text for m in RETRY_MARKERS):
        return ACK_RETRY
    return ACK_SCHEMA_MISMATCH if any(m in text for m in SCHEMA_MARKERS) else ACK_FAILED
