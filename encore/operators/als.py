"""Implicit-feedback matrix factorisation with Spark MLlib's blocked ALS."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators import factors, implicit
from encore.operators.metrics import map_at_k
from encore.operators.ranking import exclude_seen, explode_recs
from encore.session import ensure_checkpoint_dir
from encore.sources.tables import delete_path, materialize, scratch_path

U, I, N = "user_id", "item_id", "interactions"
INT_MIN, INT_MAX = -(2**31), 2**31 - 1

#: Vectors of a block in MLlib's product.
PRODUCT_BYTES = 8 << 20

#: Factors from which solving for the ratings takes less than solving for the factors.
MANY_FACTORS = 32

# The reference's ALS configuration and its tuning axes.
REFERENCE_ALS = dict(rank=200, reg=0.5, alpha=1.0, max_iter=15, user_blocks=100, item_blocks=100)
REFERENCE_AXES = {
    "rank": [10, 50, 100, 150, 200],
    "reg": [0.1, 0.5, 0.8, 1.0],
    "alpha": [0.1, 0.5, 1.0, 10.0],
    "max_iter": [10, 12, 15, 20],
}
# The reference's rank x reg table.
REFERENCE_PRODUCT = {"rank": [100, 150, 200], "reg": [0.1, 0.5, 0.8, 1.0]}


def one_at_a_time_grid(axes: dict[str, list]) -> list[dict]:
    """Settings that vary one parameter at a time (the others at the base values)."""
    return [{name: value} for name, values in axes.items() for value in values]


def product_grid(**axes: list) -> list[dict]:
    """All combinations of the values (e.g. rank x reg)."""
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def check_int_ids(df: DataFrame, cols: list[str]) -> None:
    """Raise before fitting if an id does not fit ALS's int ids (one aggregate)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    row = df.agg(*aggs).first()
    for c in cols:
        lo, hi = row[f"min_{c}"], row[f"max_{c}"]
        if lo is not None and (lo < INT_MIN or hi > INT_MAX):
            raise ValueError(f"{c} outside the int range ({lo}..{hi}): index the ids first")


def fit_als(ix: DataFrame, rank: int = 200, reg: float = 0.5, alpha: float = 1.0,
            max_iter: int = 15, user_blocks: int = 100, item_blocks: int = 100,
            seed: int = 42, user: str = U, item: str = I, rating: str = N,
            checkpoint_interval: int = 10) -> ALSModel:
    """Fit implicit ALS. Ids are checked, then cast to int; the checkpoint
    interval cuts the iteration lineage on the reliable checkpoint directory.

    From ``MANY_FACTORS`` on, MLlib makes the first vectors and ``implicit``
    iterates: the same vectors but for rounding, without rank cubed a vector.
    """
    check_int_ids(ix, [user, item])
    ensure_checkpoint_dir(ix.sparkSession)
    data = ix.select(F.col(user).cast("int").alias(user), F.col(item).cast("int").alias(item),
                     F.col(rating).cast("float").alias(rating))
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=True, rank=rank,
              regParam=reg, alpha=alpha, maxIter=max_iter, numUserBlocks=user_blocks,
              numItemBlocks=item_blocks, seed=seed, checkpointInterval=checkpoint_interval,
              coldStartStrategy="drop", nonnegative=False)
    if rank < MANY_FACTORS or reg <= 0 or max_iter < 1:
        return als.fit(data)
    begun = als.setMaxIter(0).fit(data)
    blocks = [implicit.block_count(data.count(), rank, n) for n in (user_blocks, item_blocks)]
    users, items = implicit.factorize(data, begun.userFactors, rank, reg, alpha, max_iter, tuple(blocks),
                                      user, item, rating, checkpoint_interval)
    # MLlib's saved form of a model, with other vectors.
    path = scratch_path(ix.sparkSession, "als_model")
    begun.write().save(path)
    release_als(begun)
    users.write.mode("overwrite").parquet(f"{path}/userFactors")
    items.write.mode("overwrite").parquet(f"{path}/itemFactors")
    model = ALSModel.load(path)
    model.scratch = path
    return model


def recommend_als(model: ALSModel, k: int = 100, users: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, rank, score): top k per user, for ``users`` or all.

    Users without factors get no rows.
    """
    user_col, item_col = model.getUserCol(), model.getItemCol()
    # Each user gets k candidates from every block of items: blocks of bounded bytes, not of 4096 vectors.
    model.setBlockSize(max(4096, PRODUCT_BYTES // (4 * model.rank)))
    if users is None:
        recs = model.recommendForAllUsers(k)
    else:
        subset = users.select(F.col(U).cast("int").alias(user_col)).distinct()
        recs = model.recommendForUserSubset(subset, k)
    return explode_recs(recs.withColumnRenamed(user_col, U), field=item_col)


def factor_blocks(model: ALSModel, chunk_bytes: int = factors.CHUNK_BYTES) -> factors.ItemBlocks:
    """The model's item vectors, by falling norm, in chunks."""
    return factors.item_blocks(model.itemFactors, chunk_bytes)


def top_k_lists(model: ALSModel, k: int, users: DataFrame | None, blocks: factors.ItemBlocks) -> DataFrame:
    """(user_id, items, scores, scored) for ``users`` that have vectors, or for all."""
    vectors = model.userFactors
    if users is not None:
        vectors = vectors.join(users.select(F.col(U).cast("int").alias("id")).distinct(), "id", "left_semi")
    return factors.top_k(vectors, blocks, k)


def recommend_exact(model: ALSModel, k: int = 100, users: DataFrame | None = None, chunk_bytes: int = factors.CHUNK_BYTES) -> DataFrame:
    """``recommend_als`` by exact search with norm bounds: the same lists, without the users x items product."""
    return factors.as_rows(top_k_lists(model, k, users, factor_blocks(model, chunk_bytes)))


def auc_als(model: ALSModel, positives: DataFrame, sample: int | None = None, seed: int = 42) -> DataFrame:
    """(user_id, m, auc) of the model's scores over all items, for the positives' users or a seeded sample of them."""
    users = positives.select(U).distinct().join(known_users(model), U, "left_semi")
    if sample is not None:
        users = factors.sample_users(users, sample, seed)
    vectors = model.userFactors.join(users.select(F.col(U).cast("int").alias("id")), "id", "left_semi")
    return factors.auc_per_user(vectors, model.itemFactors, factor_blocks(model), positives.join(users, U, "left_semi"))


def known_users(model: ALSModel) -> DataFrame:
    """(user_id) of the users the model has factors for."""
    return model.userFactors.select(F.col("id").cast("long").alias(U))


def recommend_unseen_als(model: ALSModel, users: DataFrame, seen: DataFrame, k: int = 100) -> DataFrame:
    """(user_id, item_id, rank, score): each user's k best items among those the user has not seen.

    A user with s seen items gets the k + s best first, of which at least k are
    unseen. Users are grouped by s rounded up to a power of two, so there is one
    recommendation for each of some twenty sizes, not one for each user.
    """
    sizes = (users.select(U).distinct().join(seen.select(U, I).distinct().groupBy(U).agg(F.count(F.lit(1)).alias("s")), U, "left")
                  .select(U, F.when(F.coalesce("s", F.lit(0)) > 0, F.ceil(F.log2("s"))).otherwise(-1).cast("int").alias("step")))
    sizes = materialize(sizes, "seen_sizes")
    steps = [r["step"] for r in sizes.select("step").distinct().orderBy("step").collect()]
    blocks = factor_blocks(model)
    parts = [factors.as_rows(top_k_lists(model, k + (1 << step if step >= 0 else 0), sizes.where(F.col("step") == step), blocks)) for step in steps]
    if not parts:
        return recommend_exact(model, k, users).limit(0)
    best = exclude_seen(reduce(lambda a, b: a.unionByName(b), parts), seen)
    return best.where(F.col("rank") <= k)


def factor_summary(model: ALSModel) -> DataFrame:
    """(side, id, dims, norm): one row per user and per item factor vector."""
    def side(df, name):
        return df.select(F.lit(name).alias("side"), F.col("id").cast("long").alias("id"),
                         F.size("features").alias("dims"),
                         F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))
    return side(model.userFactors, "user").unionByName(side(model.itemFactors, "item"))


def score_als(model: ALSModel, labels: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(recommendations for the labelled users, their users): the search writes its lists, so metrics read a table."""
    users = labels.select(U).distinct().join(known_users(model), U, "left_semi")
    recs = recommend_exact(model, k, users)
    return recs, recs.select(U)


def release_als(model: ALSModel) -> None:
    """Free the factors."""
    for factors in (model._java_obj.userFactors(), model._java_obj.itemFactors()):
        factors.unpersist()
    if hasattr(model, "scratch"):
        delete_path(model.userFactors.sparkSession, model.scratch)


def _cost(cfg: dict) -> int:
    """What a fit's time grows with: a system of ``rank`` equations a vector and iteration."""
    return cfg.get("rank", REFERENCE_ALS["rank"]) ** 3 * cfg.get("max_iter", REFERENCE_ALS["max_iter"])


def side_by_side(settings: list[dict], cores: int) -> int:
    """Fits that keep the cores busy: a fit runs as many tasks as it has blocks on a side."""
    tasks = max((max(cfg.get(b, REFERENCE_ALS[b]) for b in ("user_blocks", "item_blocks")) for cfg in settings), default=cores)
    return max(2, cores // tasks)


def sweep_als(train: DataFrame, labels: DataFrame, grid: list[dict], k: int = 100,
              base: dict | None = None, at_once: int | None = 1) -> DataFrame:
    """(rank, reg, alpha, max_iter, users, map): one distributed fit per setting.

    ``grid`` lists the settings (e.g. one parameter varied at a time); each
    fit reads the same ``train`` (write it first) and is scored with MAP@k on
    ``labels`` for the labelled users. A model is scored to one row and freed
    before its thread fits the next one. ``at_once`` fits run side by side, each
    in a scheduler pool of its own (fair where ``spark.scheduler.mode`` is FAIR):
    an iteration has as many tasks as blocks, so one fit leaves cores idle. None:
    as many as the cores hold, two at least. The longest fits begin first.
    """
    sc = train.sparkSession.sparkContext
    settings = [dict(base or {}, **setting) for setting in grid]
    if at_once is None:
        at_once = side_by_side(settings, sc.defaultParallelism)

    def fitted(n: int, setting: dict) -> tuple:
        sc.setLocalProperty("spark.scheduler.pool", f"sweep-{n % at_once}")
        cfg = dict(base or {}, **setting)
        model = fit_als(train, **cfg)
        try:
            recs, users = score_als(model, labels, k)
            m = map_at_k(labels, recs, k, users).first()
        finally:
            release_als(model)
            sc.setLocalProperty("spark.scheduler.pool", None)
        return (int(cfg.get("rank", 200)), float(cfg.get("reg", 0.5)), float(cfg.get("alpha", 1.0)),
                int(cfg.get("max_iter", 15)), int(m["users"]), float(m["map"]))

    if at_once == 1:
        rows = [fitted(n, setting) for n, setting in enumerate(grid)]
    else:
        with ThreadPoolExecutor(at_once) as threads:
            run = inheritable_thread_target(train.sparkSession)(fitted)
            order = sorted(range(len(grid)), key=lambda n: -_cost(settings[n]))
            found = dict(zip(order, threads.map(run, range(len(grid)), [grid[n] for n in order])))  # the first error is raised
            rows = [found[n] for n in range(len(grid))]
    return train.sparkSession.createDataFrame(rows, "rank int, reg double, alpha double, max_iter int, users long, map double")
