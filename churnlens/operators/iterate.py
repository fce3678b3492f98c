"""Loop support for iterated graph operators.

Each round builds a new state DataFrame from the previous one. The state is
written as a table next to the session's checkpoint directory (shared storage
on a cluster) and read back: that cuts the lineage, so a lost executor rereads
files, and it shows the planner the true size of the state. A small state is
then broadcast by Spark's own size check; a large one is shuffled, and as
neither side of its joins was aggregated in place, AQE splits hot keys. The
tables are scratch of a run; the owner of the folder clears it.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from churnlens.session import scratch_path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to shared storage once and read from there."""
    path = scratch_path(df.sparkSession, f"state/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Alternating:
    """The states of a loop in two folders by turns. A state takes the place of
    the one before the last, so only two lie on the disk at a time: round ``i``
    may read state ``i - 1``, and nothing older."""

    def __init__(self):
        self.name, self.turn = uuid.uuid4().hex, 0

    def advance(self, df: DataFrame) -> DataFrame:
        path = scratch_path(df.sparkSession, f"state/{self.name}-{self.turn % 2}")
        self.turn += 1
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


class StateLoop:
    """Rounds of a state; ``every`` is kept for callers that name it: each
    state is stored, as each is read by the next round and its stop test."""

    def __init__(self, every: int = 1):
        self.every = every

    def advance(self, state: DataFrame) -> DataFrame:
        """Store round ``state``; return the DataFrame to build on."""
        return stored(state)

    def finish(self, state: DataFrame) -> DataFrame:
        return stored(state)


def persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)
