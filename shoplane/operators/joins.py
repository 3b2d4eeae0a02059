"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows and bytes (of its rows as text); above
# that the join stays a shuffle join (and AQE may still convert it from runtime sizes).
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def broadcast_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` is within both bounds, else ``df``.

    The check reads at most ``max_rows + 1`` rows of the (small) side, so it stays
    cheap even when the side turns out to be large.
    """
    row = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df
