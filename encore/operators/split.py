"""Train / validation split, cold-start users and user-set restrictions.

The per-user split numbers each user's rows in a seeded hash order. A plain
``row_number() OVER (PARTITION BY user)`` sends all rows of a user to one task,
and one user may hold a third of the data. Here the rows are range-sorted on
(user, hash, item) into partitions, so a large user spans several; rows are
numbered inside (partition, user), and a user that crosses a partition's edge
gets the rows of its earlier partitions as an offset, from a table of at most
two rows per partition. One path for all users, whatever their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.columns import floor_fraction, hash_order_key
from encore.functions.ordering import _PID, _POS, _tag, range_sorted_checkpoint, value_positions

U, I, N = "user_id", "item_id", "interactions"

#: Range partitions for each shuffle partition: the pieces of a large user are then small beside a task's share.
PIECES = 4
#: Rows below which a further range partition costs more than it spreads: each writes a file a shuffle partition, twice.
PIECE_ROWS = 250_000
#: The same while cores would be idle.
LEAST_ROWS = 10_000


def _pieces(rows: int, most: int, cores: int) -> int:
    """Range partitions for so many rows: one a PIECE_ROWS, or one a core where that is more and a core gets LEAST_ROWS."""
    return min(most, max(rows // PIECE_ROWS, min(cores, rows // LEAST_ROWS)) + 1)


def label_split(ix: DataFrame, fraction: float = 0.8, seed=42, user: str = U, item: str = I,
                partitions: int | None = None) -> DataFrame:
    """Rows of ``ix`` with ``rn`` (1-based position in the user's seeded order),
    ``n`` (rows of the user) and ``row_counts`` = floor(fraction * n).

    Order: md5('seed|user|item') then item id, the same in Spark and DuckDB.
    Train rows are ``rn <= row_counts``, validation rows the rest. Rows with a
    NULL user are split as one user.
    """
    if not partitions:
        spark = ix.sparkSession
        partitions = _pieces(ix.count(), PIECES * int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # 16 bytes in the order of the digest's text, used up by the sort: neither shuffled as text nor written.
    hashed = ix.withColumn("_h", F.unhex(hash_order_key(seed, user, item)))
    order = [F.col(user).asc_nulls_first(), F.col("_h").asc(), F.col(item).asc()]
    tagged = _tag(range_sorted_checkpoint(hashed, order, partitions, drop=["_h"]))
    # First and last user of every partition, with their rows there: at most two rows a partition.
    counts = tagged.groupBy(_PID, user).agg(F.count(F.lit(1)).alias("_c"))
    edge = F.struct(F.col(user).alias("u"), "_c")
    edges = (counts.groupBy(_PID).agg(F.array_distinct(F.array(F.min(edge), F.max(edge))).alias("_e"))
                   .select(_PID, F.explode("_e").alias("_e")).select(_PID, F.col("_e.u").alias("_u"), "_e._c"))
    of_user = Window.partitionBy("_u")
    edges = (edges.withColumn("_off", F.coalesce(F.sum("_c").over(
                      of_user.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .withColumn("_n", F.sum("_c").over(of_user))
                  .select(F.col(_PID).alias("_p"), "_u", "_off", "_n"))
    local = Window.partitionBy(_PID, user)
    numbered = (tagged.withColumn("_r", F.row_number().over(local.orderBy(_POS)))
                      .withColumn("_l", F.count(F.lit(1)).over(local))
                      .join(F.broadcast(edges), (F.col(_PID) == F.col("_p")) & F.col(user).eqNullSafe(F.col("_u")), "left"))
    return (numbered.withColumn("rn", (F.coalesce("_off", F.lit(0)) + F.col("_r")).cast("long"))
                    .withColumn("n", F.coalesce("_n", "_l").cast("long"))
                    .withColumn("row_counts", floor_fraction("n", fraction))
                    .select(*ix.columns, "rn", "n", "row_counts"))


def train_val_split(ix: DataFrame, fraction: float = 0.8, seed=42) -> tuple[DataFrame, DataFrame]:
    """(train, val): per user the first floor(fraction * n) rows of the seeded
    order go to train, the rest to validation. Disjoint, union = ``ix``."""
    labelled = label_split(ix, fraction, seed)
    train = labelled.where(F.col("rn") <= F.col("row_counts")).select(*ix.columns)
    val = labelled.where(F.col("rn") > F.col("row_counts")).select(*ix.columns)
    return train, val


def split_sizes(ix: DataFrame, fraction: float = 0.8) -> DataFrame:
    """(user_id, n, row_counts): rows per user and the train size floor(fraction * n)."""
    return (ix.groupBy(U).agg(F.count(F.lit(1)).cast("long").alias("n"))
              .withColumn("row_counts", floor_fraction("n", fraction)))


# ---------------------------------------------------------------- cold start

def user_totals(ix: DataFrame) -> DataFrame:
    """(user_id, total_interactions)."""
    return ix.groupBy(U).agg(F.sum(N).alias("total_interactions"))


def user_percent_rank(ix: DataFrame, partitions: int | None = None) -> DataFrame:
    """(user_id, total_interactions, percent_rank) with percent_rank =
    (users with a smaller total) / (users - 1), 0 for a single user; tied
    totals share the lowest value, as PERCENT_RANK() OVER (ORDER BY total).

    The users are range-sorted by total and numbered there, so no task sees
    all users and no row is shuffled on a total that many users share.
    """
    ranked = value_positions(user_totals(ix), "total_interactions", [U], partitions=partitions)
    n_users = F.col("total")
    rank = F.when(n_users <= 1, F.lit(0.0)).otherwise(F.col("before").cast("double") / (n_users - 1).cast("double"))
    return ranked.select(U, "total_interactions", rank.alias("percent_rank"))


def cold_start_users(ix: DataFrame, pct: float = 0.1, partitions: int | None = None) -> DataFrame:
    """Simulated cold-start users: percent_rank of total interactions <= pct."""
    return user_percent_rank(ix, partitions).where(F.col("percent_rank") <= F.lit(float(pct)))


def warm_users(ix: DataFrame, pct: float = 0.1, partitions: int | None = None) -> DataFrame:
    """The other users: percent_rank > pct."""
    return user_percent_rank(ix, partitions).where(F.col("percent_rank") > F.lit(float(pct)))


def split_by_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of ``df`` whose user is in ``users``, with the user attributes attached."""
    return df.join(users, U, "inner")


# ---------------------------------------------------------------- user-set restrictions

def distinct_users(df: DataFrame) -> DataFrame:
    return df.select(U).distinct()


def warm_test(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows of users that have training rows."""
    return test.join(distinct_users(train), U, "left_semi")


def cold_test(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows of users absent from training: the real cold-start users."""
    return test.join(distinct_users(train), U, "left_anti")


def missing_users(train: DataFrame, val: DataFrame) -> DataFrame:
    """Validation users without a training row (expected: none)."""
    return distinct_users(val).join(distinct_users(train), U, "left_anti")
