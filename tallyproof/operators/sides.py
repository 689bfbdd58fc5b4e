"""Small join sides: broadcast by their stored size, never on trust."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.sources.tables import frozen_relation

# Stored bytes of a side table up to which it is sent to every executor. Columns compress several
# times at most, so the table stays far below an executor's memory.
BROADCAST_BYTES = 16 << 20


def stored_bytes(rows: DataFrame) -> int:
    """Bytes of the files that a stored relation reads, from its plan."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized_side(side: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``side`` as a stored copy, with a broadcast hint if it is at most ``limit`` bytes, and
    whether it is.

    It is computed once whatever its size; ``session.stored_copies`` releases the copy.
    """
    copy = frozen_relation(side, "side")
    if stored_bytes(copy) <= limit:
        return F.broadcast(copy), True
    return copy, False
