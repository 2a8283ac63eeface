"""Join of a large fact side with a narrow, usually small side.

The small side is written once as Parquet and read back.  The planner then
knows its bytes: below ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts
without a hint, so the fact side is not shuffled; above it both sides are
shuffled and adaptive execution splits the partitions of hot keys.  Nothing is
probed or counted, and the plan is the same at every size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from cityzones.session import materialize


def join_measured(big: DataFrame, small: DataFrame, left_keys: list[str], right_keys: list[str],
                  how: str = "inner") -> DataFrame:
    """Equi-join ``big`` with ``small``, which is computed once (an eager job)."""
    side = materialize(small, "join-side")
    cond = reduce(lambda a, b: a & b, [big[lk] == side[rk] for lk, rk in zip(left_keys, right_keys)])
    return big.join(side, cond, how)
