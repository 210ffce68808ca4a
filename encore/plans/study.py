"""End-to-end offline evaluation over one dataset: prepare, split, model, score.

``Study`` names every intermediate frame once and writes the few that many
later steps read (interactions by period, the prepared set, the labelled
split, the user ranks, the warm training rows, the top-k list)
as Parquet tables under the reliable checkpoint directory. That cuts the
lineage -- later plans start from a short, prunable scan instead of
re-analysing the whole chain -- and a lost executor only costs a re-read, not
a recomputation from the raw tables.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from encore.operators import als, metrics, popularity, prep, ranking, split
from encore.plans import binding
from encore.sources.tables import delete_path, materialize, materialize_counted

U, I, N = "user_id", "item_id", "interactions"
SEGMENTS = ("val_warm", "val_cold", "test_warm", "test_cold")


@dataclass(frozen=True)
class Params:
    fraction: float = 0.5          # share of items kept, by listeners
    min_items: int = 10            # minimum items per kept user
    train_fraction: float = 0.8    # per-user share of rows in train
    seed: int = 42                 # seed of the split order
    cold_pct: float = 0.1          # percent_rank bound of simulated cold users
    beta: float = 5000.0           # popularity damping
    k: int = 10                    # list length and label depth
    test_cut: str = binding.TEST_CUT
    # The reference's beta grid.
    betas: tuple = (1.0, 100.0, 1000.0, 5000.0, 10000.0, 20000.0, 100000.0, 1000000.0)
    als: dict = field(default_factory=lambda: dict(rank=8, reg=0.5, alpha=1.0, max_iter=5,
                                                   user_blocks=4, item_blocks=4, seed=42))

    def __hash__(self):
        return hash((self.fraction, self.min_items, self.train_fraction, self.seed, self.cold_pct,
                     self.beta, self.k, self.test_cut, self.betas,
                     tuple(sorted(self.als.items()))))


class Study:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params or Params()
        self.tables: list[str] = []
        self._counts: dict[str, int] = {}
        self.als_seconds: float | None = None
        #: Tuning rows by setting: what a sweep and a grid share is fitted once.
        self.tuned: dict[tuple, tuple] = {}
        self._als_recs: dict[tuple[str, int], DataFrame] = {}

    def _keep_counted(self, df: DataFrame, name: str, counts: dict, partition_by: list[str] | None = None) -> DataFrame:
        table, found = materialize_counted(df, name, counts, partition_by, written=self.tables)
        self._counts.update(found)
        return table

    def stage_counts(self) -> DataFrame:
        """(stage, rows) of every stage, counted while the stages were written."""
        for stage in (self.interactions, self.core, self.parts, self.test_parts):
            assert stage is not None
        return self.spark.createDataFrame(sorted(self._counts.items()), "stage string, rows long")

    def _keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        return materialize(df, name, partition_by, written=self.tables)

    def release(self) -> int:
        """Delete the stage tables this study wrote; frames built on them become invalid."""
        deleted = sum(delete_path(self.spark, path) for path in self.tables)
        self.tables.clear()
        return deleted

    # ------------------------------------------------------------ inputs
    @cached_property
    def interactions(self) -> DataFrame:
        """History and test interactions from one join, stored by period."""
        return self._keep_counted(binding.interactions_by_period(self.spark, self.sf_dir, self.p.test_cut), "interactions",
                                  {"interactions": F.col("period") == "history", "test": (F.col("period") == "test") & (F.col(N) > 0)},
                                  partition_by=["period"])

    @cached_property
    def ix(self) -> DataFrame:
        return self.interactions.where(F.col("period") == "history").select(U, I, N)

    @cached_property
    def all_ix(self) -> DataFrame:
        """Interactions over both periods: what counting plays, listeners and activity reads."""
        return self._keep(self.interactions.groupBy(U, I).agg(F.sum(N).alias(N)), "all_interactions")

    @cached_property
    def dictionary(self) -> DataFrame:
        """Items of the prepared split (train and validation)."""
        return self.core.select(I).distinct()

    @cached_property
    def test(self) -> DataFrame:
        return prep.positive_only(self.interactions.where(F.col("period") == "test").select(U, I, N))

    # ------------------------------------------------------------ preparation
    @cached_property
    def popular(self) -> DataFrame:
        # Built from materialised pieces (listener table, ranked tie group).
        return prep.popular_items(self.ix, self.p.fraction)

    @cached_property
    def popular_ix(self) -> DataFrame:
        return prep.restrict_items(self.ix, self.popular)

    @cached_property
    def active(self) -> DataFrame:
        return prep.active_users(self.popular_ix, self.p.min_items)

    @cached_property
    def core(self) -> DataFrame:
        popular = Observation("popular_pairs")
        kept = prep.restrict_users(self.popular_ix.observe(popular, F.count(F.lit(1)).alias("rows")), self.active)
        table = self._keep_counted(kept, "core", {"core": F.lit(True)})
        self._counts["popular_pairs"] = int(popular.get["rows"])
        return table

    # ------------------------------------------------------------ split
    @cached_property
    def labelled(self) -> DataFrame:
        train = F.col("rn") <= F.col("row_counts")
        return self._keep_counted(split.label_split(self.core, self.p.train_fraction, self.p.seed), "labelled", {"train": train, "val": ~train})

    @cached_property
    def train(self) -> DataFrame:
        return self.labelled.where(F.col("rn") <= F.col("row_counts")).select(U, I, N)

    @cached_property
    def val(self) -> DataFrame:
        return self.labelled.where(F.col("rn") > F.col("row_counts")).select(U, I, N)

    @cached_property
    def user_ranks(self) -> DataFrame:
        return self._keep(split.user_percent_rank(self.core), "user_ranks")

    @cached_property
    def cold_users(self) -> DataFrame:
        return self.user_ranks.where(F.col("percent_rank") <= F.lit(float(self.p.cold_pct)))

    @cached_property
    def warm_users(self) -> DataFrame:
        return self.user_ranks.where(F.col("percent_rank") > F.lit(float(self.p.cold_pct)))

    @cached_property
    def parts(self) -> DataFrame:
        """The split's rows with their users' attributes, joined once and stored by side and group."""
        side = F.when(F.col("rn") <= F.col("row_counts"), "train").otherwise("val")
        group = F.when(F.col("percent_rank") <= F.lit(float(self.p.cold_pct)), "cold").otherwise("warm")
        rows = split.split_by_users(self.labelled, self.user_ranks).select(
            U, I, N, "total_interactions", "percent_rank", side.alias("side"), group.alias("user_group"))
        counts = {f"{s}_{g}": (F.col("side") == s) & (F.col("user_group") == g) for s in ("train", "val") for g in ("warm", "cold")}
        return self._keep_counted(rows, "parts", counts, partition_by=["side", "user_group"])

    def part(self, which: str) -> DataFrame:
        """train_warm, train_cold, val_warm, val_cold: rows with user attributes."""
        side, group = which.split("_")
        return self.parts.where((F.col("side") == side) & (F.col("user_group") == group)).drop("side", "user_group")

    @cached_property
    def train_warm(self) -> DataFrame:
        return prep.positive_only(self.part("train_warm"))

    @cached_property
    def test_parts(self) -> DataFrame:
        """The test rows, stored by whether their user has warm training rows."""
        rows = (split.warm_test(self.test, self.train_warm).withColumn("known", F.lit(1))
                .unionByName(split.cold_test(self.test, self.train_warm).withColumn("known", F.lit(0))))
        return self._keep_counted(rows, "test_parts", {"test_warm": F.col("known") == 1, "test_cold": F.col("known") == 0}, partition_by=["known"])

    @cached_property
    def test_warm(self) -> DataFrame:
        return self.test_parts.where("known = 1").drop("known")

    @cached_property
    def test_cold(self) -> DataFrame:
        return self.test_parts.where("known = 0").drop("known")

    # ------------------------------------------------------------ popularity model
    @cached_property
    def pop(self) -> DataFrame:
        return popularity.popularity(self.train_warm, self.p.beta)

    @cached_property
    def top(self) -> DataFrame:
        return self._keep(popularity.top_k(self.pop, self.p.k), "top")

    # ------------------------------------------------------------ evaluation
    def segment(self, name: str) -> tuple[DataFrame, DataFrame]:
        """(ground-truth rows, users the model is asked to score) of a segment."""
        if name == "val_warm":
            return prep.positive_only(self.part("val_warm")), self.train_warm.select(U)
        if name == "train_warm":
            return self.train_warm, self.train_warm.select(U)
        if name == "val_cold":
            return prep.positive_only(self.part("val_cold")), self.part("train_cold").select(U)
        if name == "test_warm":
            return self.test_warm, self.test_warm.select(U)
        if name == "test_cold":
            return self.test_cold, self.test_cold.select(U)
        raise ValueError(name)

    def labels(self, name: str, k: int | None = None) -> DataFrame:
        """The truth cut to each user's k strongest items: what MAP and NDCG are scored against."""
        truth, _ = self.segment(name)
        return ranking.true_top_k(truth, k or self.p.k)

    def relevant(self, name: str) -> DataFrame:
        """All items of the truth: what precision, recall and reciprocal rank are scored against."""
        truth, _ = self.segment(name)
        return truth.select(U, I)

    @cached_property
    def top_100(self) -> DataFrame:
        return self._keep(popularity.top_k(self.pop, 100), "top_100")

    def popularity_map(self, name: str, k: int | None = None) -> DataFrame:
        truth, users = self.segment(name)
        k = k or self.p.k
        top = self.top if k == self.p.k else self.top_100 if k == 100 else popularity.top_k(self.pop, k)
        return metrics.map_at_k(ranking.true_top_k(truth, k), top, k, users)

    def popularity_summary(self, name: str) -> DataFrame:
        """One row: users, map and ndcg on the cut truth, precision, recall and mrr on all of it."""
        _, users = self.segment(name)
        return metrics.ranking_summary(self.labels(name), self.relevant(name), self.top, self.p.k, users)

    def beta_sweep(self) -> DataFrame:
        """(beta, segment, users, map) on the validation segments."""
        segments = {}
        for name in ("val_warm", "val_cold"):
            truth, users = self.segment(name)
            segments[name] = (ranking.true_top_k(truth, self.p.k).select(U, I), users)
        return popularity.sweep_popularity(self.train_warm, segments, list(self.p.betas), self.p.k)

    @cached_property
    def als_model(self):
        """Implicit ALS on the warm training rows with ``Params.als``."""
        data = self.train_warm.select(U, I, N)
        began = time.time()
        model = als.fit_als(data, **self.p.als)
        self.als_seconds = time.time() - began
        return model

    def als_recs(self, name: str, k: int | None = None) -> DataFrame:
        """ALS lists for the labelled users of a segment that have factors; scored once and written."""
        key = (name, k or self.p.k)
        if key not in self._als_recs:
            self._als_recs[key] = als.score_als(self.als_model, self.labels(name, key[1]), key[1])[0]
        return self._als_recs[key]
