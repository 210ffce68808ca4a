"""encore: implicit-feedback recommendation analytics as Spark DataFrame operators.

Every public operator takes and returns DataFrames. Global orderings (top
fractions, percent ranks, dense indices) are computed with a distributed
prefix sum over a range-partitioned, reliably checkpointed frame, never with
an unpartitioned window over the data; per-user windows salt heavy users.
"""

from encore.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
