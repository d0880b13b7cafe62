"""Join helpers: explicit broadcasts only behind a checked size bound.

Configuration tables (routes, schema maps, cursors, key metadata) are tiny, but a
user may pass anything. ``bounded_broadcast`` counts at most ``max_rows + 1`` rows of
the side; within the bound it returns a broadcast hint, beyond it the plain frame, so
Spark falls back to a shuffle join (and AQE may still broadcast at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

DEFAULT_MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, materialize: bool = False
) -> DataFrame:
    """Broadcast hint when ``df`` has at most ``max_rows`` rows, else ``df`` unchanged.

    ``materialize=True`` is for small *derived* tables (one row per source or
    capture, computed from the whole log): they are written once with a reliable
    checkpoint, so the row check and the join read the same small files instead of
    recomputing the aggregate.
    """
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
