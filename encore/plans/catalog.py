"""Registered queries: every operator bound to the driver's tables.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
tables. Doubles are rounded to 9 decimals and arrays are rendered as
comma-joined text so the DuckDB oracle can be compared value by value; the
operators themselves return full doubles and real arrays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from encore.functions.columns import conform, impute_item_id
from encore.operators import als, factors, index, metrics, popularity, prep, ranking, report, sketches, split
from encore.plans import binding
from encore.plans.study import Params, Study
from encore.sources import tables

U, I, N = "user_id", "item_id", "interactions"

_STUDIES: dict = {}


def study(spark: SparkSession, sf_dir: str, params: Params | None = None) -> Study:
    """One Study per (application, dataset, parameters): stages are shared by queries.

    The files of a dataset must not change while its study is in use; ``forget``
    drops the studies after a change.
    """
    key = (spark.sparkContext.applicationId, sf_dir, params or Params())
    if key not in _STUDIES:
        _STUDIES[key] = Study(spark, sf_dir, params)
    return _STUDIES[key]


def forget(spark: SparkSession) -> int:
    """Drop this application's studies and delete every table it wrote; the number of tables deleted."""
    for key in [k for k in _STUDIES if k[0] == spark.sparkContext.applicationId]:
        del _STUDIES[key]
    return tables.release_all(spark)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def as_text(col: str):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",")


# ------------------------------------------------------------------ sources
def q_scan_interactions(spark, d):
    return tables.read_table(spark, f"{d}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")


def q_scan_typed(spark, d):
    return tables.read_table(spark, f"{d}/lineitem.parquet",
                             schema="l_orderkey BIGINT, l_partkey INT, l_quantity INT")


def q_scan_multi(spark, d):
    s = study(spark, d)
    base = tables.scratch_path(spark, "split")
    tables.write_table(s.train, f"{base}/train", mode="overwrite")
    tables.write_table(s.val, f"{base}/val", mode="overwrite")
    return tables.read_table(spark, [f"{base}/train", f"{base}/val"])


def q_sink_roundtrip(spark, d):
    s = study(spark, d)
    path = tables.scratch_path(spark, "interactions")
    tables.write_table(s.all_ix, path, mode="overwrite")
    return tables.read_table(spark, path, schema="user_id BIGINT, item_id BIGINT, interactions BIGINT")


def q_sql_view(spark, d):
    s = study(spark, d)
    view = tables.register(s.core, f"core_{uuid.uuid4().hex[:8]}")
    return tables.run_sql(spark, f"SELECT user_id, COUNT(*) AS n_items, SUM(interactions) AS total "
                                 f"FROM {view} GROUP BY user_id")


def q_split_counts(spark, d):
    """Rows of every stage, counted while the stages were written."""
    return study(spark, d).stage_counts()


# ------------------------------------------------------------------ projections
def q_impute_item_id(spark, d):
    t = binding.tracks(spark, d).drop("__index_level_0__")
    return impute_item_id(t, "recording_mbid", "recording_msid")


def q_conform_columns(spark, d):
    return conform(study(spark, d).core, positions=[2, 1, 0])


def q_rec_array_shape(spark, d):
    """Popularity list in the model-output shape array<struct<item_id, rating>>,
    then reduced to array<double> of items as the evaluator expects."""
    s = study(spark, d)
    rec = F.struct(F.col(I).alias("item_id"), F.col("score").cast("float").alias("rating"))
    arr = s.top.agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("rank"), rec.alias("rec")))),
                                lambda x: x["rec"]).alias("recommendations"))
    recs = s.train_warm.select(U).distinct().select(U, arr.scalar().alias("recommendations"))
    out = ranking.rec_items(recs)
    return out.select(U, as_text("predicted_labels").alias("predicted_labels"),
                      F.size("predicted_labels").alias("n"))


# ------------------------------------------------------------------ preparation
def q_interactions(spark, d):
    return study(spark, d).all_ix


def q_events_interactions(spark, d):
    return binding.event_interactions(spark, d)


def q_popular_items_pct15(spark, d):
    return prep.popular_items(study(spark, d).all_ix, 0.15)


def q_positive_feedback(spark, d):
    return prep.positive_only(study(spark, d).all_ix)


def q_item_listeners(spark, d):
    return prep.item_listeners(study(spark, d).all_ix)


def q_user_activity(spark, d):
    return prep.user_activity(study(spark, d).all_ix)


def q_popular_items(spark, d):
    return study(spark, d).popular


def q_restrict_items(spark, d):
    return study(spark, d).popular_ix


def q_active_users(spark, d):
    return study(spark, d).active


def q_low_activity_users(spark, d):
    return prep.low_activity_users(study(spark, d).popular_ix, 10)


def q_restrict_users(spark, d):
    return study(spark, d).core


def q_listener_histogram(spark, d):
    return prep.listener_histogram(study(spark, d).all_ix)


def q_activity_histogram(spark, d):
    return prep.activity_histogram(study(spark, d).all_ix)


def q_listener_percentile(spark, d):
    return prep.listener_percentile(study(spark, d).all_ix, 0.85)


QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.85, 0.95]


def q_listener_percentile_sketch(spark, d):
    """Quantiles of the listener counts from merged KLL states, one a range of items, and from percentile_approx: is the rank within the bound?"""
    listeners = tables.materialize(prep.item_listeners(study(spark, d).all_ix), "listeners")
    parts = listeners.withColumn("part", F.pmod(F.xxhash64(I), F.lit(16)))
    states = tables.materialize(sketches.quantile_state(parts, "listeners", by=["part"]), "quantile_states")
    merged = tables.materialize(sketches.quantiles(sketches.merge_quantiles(states), QUANTILES), "quantiles")
    accuracy = 1000
    approx = [prep._percentile(listeners, q, accuracy).select(F.lit(q).alias("q"), F.col("listener_percentile").cast("long").alias("value")) for q in QUANTILES]
    out = []
    # Three times the error that 99 % of quantiles keep, so that no run in a thousand is outside; percentile_approx is never.
    for kind, found, bound in (("kll", merged, 3 * sketches.kll_error()), ("percentile_approx", tables.union_all(approx), 1 / accuracy + 1e-9)):
        errors = sketches.rank_errors(listeners, "listeners", found, QUANTILES)
        out.append(errors.select(F.lit(kind).alias("kind"), "q", (F.col("error") <= bound).alias("within")))
    return tables.union_all(out)


def q_item_listeners_sketch(spark, d):
    """Distinct listeners of every item from states kept by period and merged, against the exact counts: items, and those off by over five standard errors."""
    s = study(spark, d)
    states = tables.materialize(sketches.listener_states(s.interactions, by=["period"]), "listener_states")
    found = sketches.estimates(sketches.merge_states(states), "estimate")
    exact = prep.item_listeners(s.all_ix)
    off = F.abs(F.col("estimate") - F.col("listeners")) > 5 * sketches.hll_error() * F.col("listeners")
    return exact.join(found, I, "full").agg(F.count("listeners").alias("items"), F.count("estimate").alias("estimated"),
                                            F.sum(F.coalesce(off, F.lit(True)).cast("int")).alias("outside"))


def q_items_by_percentile(spark, d):
    return prep.items_by_percentile(study(spark, d).all_ix, 0.85)


def q_items_by_percent_rank(spark, d):
    return rounded(prep.items_by_percent_rank(study(spark, d).all_ix, 0.15))


def q_join_items_left(spark, d):
    tr = impute_item_id(binding.tracks(spark, d).drop("__index_level_0__"), "recording_mbid", "recording_msid")
    return prep.attach_items(binding.raw_plays(spark, d), tr, "recording_msid")


def q_join_users_left(spark, d):
    """Customers and all their plays, counted."""
    joined = prep.attach_users(binding.users(spark, d), binding.plays(spark, d).select(U, I), U)
    return prep.count_interactions(joined)


def q_join_users_events_left(spark, d):
    """Customers and all their events; most customers have none and keep one row."""
    joined = prep.attach_users(binding.users(spark, d), binding.event_plays(spark, d), U)
    return prep.count_interactions(joined)


#: Plays that one task sorts and counts.
PLAYS_TASK = 500_000


def _in_tasks(plays: DataFrame, rows: int) -> DataFrame:
    """``plays``, of so many rows, by user in tasks of bounded memory where a core would get more.

    Left to AQE, a task gets up to 64 MB of shuffled bytes, which repeated names shrink thirtyfold.
    """
    tasks = rows // PLAYS_TASK + 1
    return plays.repartition(tasks, U) if tasks > plays.sparkSession.sparkContext.defaultParallelism else plays


def q_prepare_catalogue(spark, d):
    """The reference's preparation chain on the raw-id form: plays LEFT JOIN
    catalogue (imputed canonical id), users LEFT JOIN plays, play counts per
    (user, canonical item), top half of the items, users with >= 10 items."""
    tr = impute_item_id(binding.tracks(spark, d).drop("__index_level_0__"), "recording_mbid", "recording_msid")
    joined = prep.attach_items(binding.raw_plays(spark, d), tr, "recording_msid").select(U, "recording_mbid")
    lines = binding.table(spark, d, "lineitem").count()  # from the files' footers
    full = prep.attach_users(binding.users(spark, d), _in_tasks(joined, lines), U)
    ix = prep.count_interactions(full, U, "recording_mbid")
    return prep.prepare_interactions(ix, fraction=0.5, min_items=10)


def q_union_distinct(spark, d):
    """The prepared rows and their training part: every training row is there twice and comes out once."""
    s = study(spark, d)
    return tables.union_distinct(s.core, s.train)


# ------------------------------------------------------------------ split
def q_attach_group_size(spark, d):
    return study(spark, d).labelled


def q_split_train(spark, d):
    return study(spark, d).train


def q_split_val(spark, d):
    return study(spark, d).val


def q_split_sizes(spark, d):
    return split.split_sizes(study(spark, d).core, 0.8)


def q_split_coverage(spark, d):
    s = study(spark, d)
    return split.missing_users(s.train, s.val).agg(F.count(F.lit(1)).cast("long").alias("missing_users"))


def q_user_totals(spark, d):
    return split.user_totals(study(spark, d).core)


def q_user_percent_rank(spark, d):
    return study(spark, d).user_ranks


def q_cold_users(spark, d):
    return study(spark, d).cold_users


def q_warm_users(spark, d):
    return study(spark, d).warm_users


def _part(name):
    def q(spark, d):
        return study(spark, d).part(name)
    return q


def q_distinct_users(spark, d):
    return split.distinct_users(study(spark, d).train_warm)


def q_test_warm(spark, d):
    return study(spark, d).test_warm


def q_test_cold(spark, d):
    return study(spark, d).test_cold


def q_test_cold_listed(spark, d):
    s = study(spark, d)
    return prep.restrict_users(s.test, prep.low_activity_users(s.popular_ix, 10))


def q_small_train(spark, d):
    return tables.head_rows(study(spark, d).train, [F.col(U), F.col(I)], 1000)


def q_small_val(spark, d):
    return tables.head_rows(study(spark, d).val, [F.col(U), F.col(I)], 250)


def q_sample_train(spark, d):
    """1000 training rows by hash."""
    return tables.sample_rows(study(spark, d).train, 1000, [U, I])


def q_sample_val(spark, d):
    return tables.sample_rows(study(spark, d).val, 250, [U, I])


# ------------------------------------------------------------------ ranking / popularity
def q_true_top_k(spark, d):
    return study(spark, d).labels("val_warm")


def q_true_arrays(spark, d):
    arr = ranking.true_arrays(study(spark, d).labels("val_warm"))
    return arr.select(U, as_text("true_labels").alias("true_labels"))


def q_popularity_scores(spark, d):
    return rounded(study(spark, d).pop)


def q_popular_top_k(spark, d):
    return rounded(study(spark, d).top)


def q_popular_head(spark, d):
    return rounded(popularity.top_k(study(spark, d).pop, 5))


def q_popular_array(spark, d):
    arr = ranking.ranked_array(study(spark, d).top, "predicted_labels")
    return arr.select(as_text("predicted_labels").alias("predicted_labels"),
                      F.size("predicted_labels").alias("n"))


def _recs_for(users_of):
    def q(spark, d):
        s = study(spark, d)
        recs = popularity.recommend_popular(s.top, users_of(s))
        return recs.select(U, as_text("recommendations").alias("recommendations"))
    return q


def q_labels_joined(spark, d):
    s = study(spark, d)
    truth = ranking.true_arrays(s.labels("val_warm"))
    pred = popularity.recommend_popular(s.top, s.train_warm).withColumnRenamed("recommendations",
                                                                                 "predicted_labels")
    joined = ranking.pair_labels(truth, pred)
    return joined.select(U, as_text("true_labels").alias("true_labels"),
                         as_text("predicted_labels").alias("predicted_labels"))


def q_beta_sweep(spark, d):
    return rounded(study(spark, d).beta_sweep())


def q_recs_unseen(spark, d):
    """k unseen items for every training user."""
    s = study(spark, d)
    return popularity.recommend_unseen(s.pop, s.train_warm, s.train_warm, s.p.k)


# ------------------------------------------------------------------ metrics
def _map(name, k=None):
    def q(spark, d):
        return rounded(study(spark, d).popularity_map(name, k))
    return q


def q_ap_per_user(spark, d):
    s = study(spark, d)
    per_user = metrics.per_user_metrics(s.labels("val_warm"), s.top, s.p.k, s.segment("val_warm")[1])
    return rounded(per_user.select(U, "ap"))


def _metric(function, segment="val_warm"):
    """precision, recall and reciprocal rank count all relevant items of a user, however many."""
    def q(spark, d):
        s = study(spark, d)
        return rounded(function(s.relevant(segment), s.top, s.p.k, s.segment(segment)[1]))
    return q


def q_ndcg_at_k(spark, d):
    s = study(spark, d)
    return rounded(metrics.ndcg_at_k(s.labels("val_warm"), s.top, s.p.k, s.segment("val_warm")[1]))


def _auc(segment):
    def q(spark, d):
        s = study(spark, d)
        truth, users = s.segment(segment)
        positives = truth.join(users.distinct(), U, "left_semi")
        return rounded(metrics.auc_summary(metrics.auc_global_scores(positives, s.pop, universe=s.dictionary)))
    return q


def q_popularity_report(spark, d):
    s = study(spark, d)
    rows = [report.metric_row(s.popularity_map(seg), "popularity", seg, "map", s.p.k) for seg in
            ("val_warm", "val_cold", "test_warm", "test_cold")]
    return rounded(report.compare_models(rows))


def q_popularity_metrics_report(spark, d):
    """MAP, precision, recall, NDCG and MRR of the popularity list on every segment."""
    s = study(spark, d)
    rows = [report.metric_rows(s.popularity_summary(seg), "popularity", seg, s.p.k, RANKING_METRICS)
            for seg in ("val_warm", "val_cold", "test_warm", "test_cold")]
    return rounded(report.compare_models(rows))


def q_popularity_intervals(spark, d):
    """95 % intervals of the popularity list's per-user metrics, per segment."""
    s = study(spark, d)
    parts = []
    for seg in ("val_warm", "test_warm"):
        per_user = metrics.per_user_metrics(s.labels(seg), s.top, s.p.k, s.segment(seg)[1])
        parts.append(report.bootstrap(per_user, ["ap", "ndcg"], replicates=100).withColumn("segment", F.lit(seg)))
    return rounded(report.compare_models(parts))


RANKING_METRICS = ["map", "precision", "recall", "ndcg", "mrr"]


# ------------------------------------------------------------------ dictionaries
def q_item_index(spark, d):
    return index.fit_item_index(study(spark, d).core).select(I, "item_idx")


def q_item_index_unseen(spark, d):
    s = study(spark, d)
    idx = index.fit_item_index(s.core)
    return index.apply_item_index(s.test, idx).select(U, I, "item_idx")


def q_user_index(spark, d):
    s = study(spark, d)
    return index.fit_ids(s.core, U, "u_idx")


def q_coo_triples(spark, d):
    s = study(spark, d)
    # Train and validation are the prepared rows, split: both dictionaries are fitted on those.
    users = index.fit_ids(s.core, U, "u_idx")
    items = index.fit_ids(s.core, I, "i_idx")
    return index.to_coo(s.train, users, items)


def q_csr_roundtrip(spark, d):
    """The training matrix in written CSR blocks, and back to triples."""
    blocks = tables.materialize(index.to_csr(q_coo_triples(spark, d), entries=4096), "csr")
    return index.from_csr(blocks)


def q_csr_blocks(spark, d):
    """Blocks, the entries of the largest, and all entries."""
    blocks = index.to_csr(q_coo_triples(spark, d), entries=4096)
    n = F.size("indices")
    return blocks.agg(F.count(F.lit(1)).alias("blocks"), F.max(n).alias("largest"), F.sum(n).alias("entries"),
                      F.sum((F.element_at("indptr", -1) != n).cast("int")).alias("faults"))


# ------------------------------------------------------------------ ALS (rows-only checks)
def _als_model(s: Study):
    return s.als_model


def q_als_indexed_recs(spark, d):
    """String item ids through the dictionary into ALS and back: the prepared
    catalogue interactions are split, indexed (frequency order, unseen -> n),
    fitted on the int indices and the top k are mapped back to the labels."""
    s = study(spark, d)
    ix = tables.materialize(q_prepare_catalogue(spark, d), "catalogue_core")
    train, _ = split.train_val_split(ix, s.p.train_fraction, s.p.seed)
    idx = index.fit_item_index(ix)
    model = als.fit_als(index.apply_item_index(train, idx), item="item_idx", **s.p.als)
    recs = als.recommend_exact(model, s.p.k).withColumnRenamed(I, "item_idx")
    return recs.join(idx.select("item_idx", F.col(I).alias("recording_mbid")), "item_idx").drop("item_idx")


def q_als_factors(spark, d):
    return als.factor_summary(_als_model(study(spark, d)))


def q_als_recs_subset(spark, d):
    s = study(spark, d)
    return s.als_recs("val_warm")


def q_als_recs_all(spark, d):
    s = study(spark, d)
    return als.recommend_exact(_als_model(s), s.p.k)


def _als_map(segment, k=None):
    """ALS top k for the segment's users that have factors, made once."""
    def q(spark, d):
        s = study(spark, d)
        recs = s.als_recs(segment, k)
        return rounded(metrics.map_at_k(s.labels(segment, k), recs, k or s.p.k, recs.select(U)))
    return q


def _auc_als(segment):
    """Mean AUC of the ALS scores of all items, over every user of the segment."""
    def q(spark, d):
        s = study(spark, d)
        return rounded(metrics.auc_summary(als.auc_als(_als_model(s), s.segment(segment)[0])))
    return q


def q_als_topk_work(spark, d):
    """How many of the users x items scores the norm bounds made needless."""
    model = _als_model(study(spark, d))
    blocks = als.factor_blocks(model)
    return rounded(factors.work(als.top_k_lists(model, study(spark, d).p.k, None, blocks), blocks))


def q_model_interval(spark, d):
    """ALS less popularity on warm validation users, user by user: mean difference and its 95 % interval."""
    s = study(spark, d)
    recs, labels = s.als_recs("val_warm"), s.labels("val_warm")
    of_als = metrics.per_user_metrics(labels, recs, s.p.k, recs.select(U))
    of_pop = metrics.per_user_metrics(labels, s.top, s.p.k, s.segment("val_warm")[1])
    return rounded(report.bootstrap(report.paired_difference(of_als, of_pop, ["ap", "ndcg"]), ["ap", "ndcg"]))


def q_als_sweep(spark, d):
    """One parameter at a time around the reference's configuration, over all four of its axes."""
    return _tuned(study(spark, d), als.one_at_a_time_grid(als.REFERENCE_AXES))


def q_als_grid(spark, d):
    """The reference's rank x reg table, at its other settings."""
    return _tuned(study(spark, d), als.product_grid(**als.REFERENCE_PRODUCT))


def _tuned(s, grid):
    """MAP of each setting; a setting that the study has scored before is not fitted again. The block counts are the study's."""
    base = dict(als.REFERENCE_ALS, **{b: s.p.als[b] for b in ("user_blocks", "item_blocks", "seed")})
    wanted = [tuple(sorted((base | g).items())) for g in grid]
    new = [dict(w) for w in dict.fromkeys(wanted) if w not in s.tuned]
    if new:
        rows = als.sweep_als(s.train_warm.select(U, I, N), s.labels("val_warm"), new, s.p.k, at_once=None).collect()  # a row a setting
        s.tuned.update({tuple(sorted(cfg.items())): tuple(r) for cfg, r in zip(new, rows)})
    return rounded(s.spark.createDataFrame([s.tuned[w] for w in wanted], "rank int, reg double, alpha double, max_iter int, users long, map double"))


def _tuned_check(q):
    """A tuning table's settings and users, and whether each MAP is a share."""
    def check(spark, d):
        return q(spark, d).select("rank", "reg", "alpha", "max_iter", "users", F.col("map").between(0.0, 1.0).alias("is_share"))
    return check


def q_model_report(spark, d):
    """Popularity and ALS on warm validation and test users: five ranking metrics, and the seconds of the fit."""
    s = study(spark, d)
    rows = []
    for seg in ("val_warm", "test_warm"):
        recs = s.als_recs(seg)
        of_als = metrics.ranking_summary(s.labels(seg), s.relevant(seg), recs, s.p.k, recs.select(U))
        rows.append(report.metric_rows(s.popularity_summary(seg), "popularity", seg, s.p.k, RANKING_METRICS)
                    .withColumn("fit_seconds", F.lit(None).cast("double")))
        rows.append(report.metric_rows(of_als, "als", seg, s.p.k, RANKING_METRICS).withColumn("fit_seconds", F.lit(s.als_seconds)))
    return rounded(report.compare_models(rows))


# ------------------------------------------------------------------ ALS (facts that SQL knows)
def q_als_id_range(spark, d):
    """Ids after the cast to ALS's int ids."""
    train = study(spark, d).train_warm
    als.check_int_ids(train, [U, I])
    u, i = F.col(U).cast("int"), F.col(I).cast("int")
    return train.agg(F.min(u).alias("min_user"), F.max(u).alias("max_user"), F.min(i).alias("min_item"), F.max(i).alias("max_item"))


def q_als_factor_check(spark, d):
    """Factor vectors a side: how many, of which lengths, and how many of them are not finite."""
    f = als.factor_summary(_als_model(study(spark, d)))
    bad = F.isnan("norm") | (F.abs("norm") == F.lit(float("inf")))
    return f.groupBy("side").agg(F.count(F.lit(1)).alias("vectors"), F.min("dims").alias("least_dims"), F.max("dims").alias("most_dims"),
                                 F.sum(F.when(bad, 1).otherwise(0)).alias("not_finite"))


def _rec_facts(recs, train):
    """users, rows, users whose ranks have gaps, rows whose score exceeds the one before, rows of unknown items."""
    before = F.lag("score").over(Window.partitionBy(U).orderBy("rank"))
    known = train.select(I).distinct().withColumn("known", F.lit(1))
    per_user = (recs.withColumn("before", before).join(known, I, "left").groupBy(U)
                    .agg(F.count(F.lit(1)).alias("rows"), F.max("rank").alias("last"), F.count_distinct("rank").alias("ranks"),
                         F.sum(F.when(F.col("score") > F.col("before"), 1).otherwise(0)).alias("rises"),
                         F.sum(F.when(F.col("known").isNull(), 1).otherwise(0)).alias("unknown")))
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.sum("rows").alias("rows"),
                        F.sum(F.when((F.col("last") != F.col("rows")) | (F.col("ranks") != F.col("rows")), 1).otherwise(0)).alias("gaps"),
                        F.sum("rises").alias("rises"), F.sum("unknown").alias("unknown"))


def q_als_recs_check(spark, d):
    s = study(spark, d)
    return _rec_facts(tables.materialize(als.recommend_exact(_als_model(s), s.p.k), "recs"), s.train_warm)


def _checked_chunk(items: int, rank: int) -> int:
    """Chunks small enough that the search goes through several, a dozen at most while they fit: each is loaded by a job."""
    return min(factors.CHUNK_BYTES, max(64 << 10, items * (8 * rank + 16) // 12))


def q_als_topk_check(spark, d):
    """The exact search against MLlib's full product, for every user: rows whose score at a rank differs."""
    s = study(spark, d)
    chunk_bytes = _checked_chunk(_als_model(s).itemFactors.count(), s.p.als["rank"])
    ours = als.recommend_exact(_als_model(s), s.p.k, chunk_bytes=chunk_bytes).select(U, "rank", F.col("score").alias("ours"))
    theirs = tables.materialize(als.recommend_als(_als_model(s), s.p.k), "recs").select(U, "rank", "score")
    differs = F.coalesce(F.abs(F.col("ours") - F.col("score")) > 1e-5, F.lit(True))
    return ours.join(theirs, [U, "rank"], "full").agg(F.count_distinct(U).alias("users"), F.count(F.lit(1)).alias("rows"),
                                                      F.sum(differs.cast("int")).alias("differing"))


def q_auc_als_check(spark, d):
    """Rank counts against the definition on 50 sampled users, whose items are all listed: users, and those whose AUC differs."""
    s, n = study(spark, d), 50
    model, truth = _als_model(s), s.segment("val_warm")[0].select(U, I).distinct()
    counted = als.auc_als(model, truth, sample=n)
    users = factors.sample_users(truth.join(als.known_users(model), U, "left_semi"), n)
    blocks = als.factor_blocks(model)
    rows = factors.as_rows(als.top_k_lists(model, blocks.items, users, blocks)).join(truth.withColumn("pos", F.lit(1)), [U, I], "left")
    rows = rows.select(U, "score", F.coalesce("pos", F.lit(0)).alias("pos")).withColumn("neg", 1 - F.col("pos"))
    upto = F.sum("neg").over(Window.partitionBy(U).orderBy("score").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ties = F.sum("neg").over(Window.partitionBy(U, "score"))
    wins = rows.withColumn("wins", F.col("pos") * (upto - ties / 2.0)).groupBy(U).agg(
        (F.sum("wins") / (F.sum("pos") * F.sum("neg").cast("double"))).alias("plain"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    both = counted.join(wins.where("p > 0 and n > 0"), U, "full")
    return both.agg(F.count(F.lit(1)).alias("users"),
                    F.coalesce(F.sum(F.coalesce(F.abs(F.col("auc") - F.col("plain")) > 1e-9, F.lit(True)).cast("int")), F.lit(0)).alias("differing"))


def q_model_report_check(spark, d):
    """The comparison table's rows and users, and whether each value is a share."""
    rows = q_model_report(spark, d)
    return rows.select("model", "segment", "metric", "k", "users", F.col("value").between(0.0, 1.0).alias("is_share"))


def q_als_unseen_check(spark, d):
    """ALS lists of unseen items: full wherever k unseen items exist, and without a seen one."""
    s = study(spark, d)
    recs = tables.materialize(als.recommend_unseen_als(_als_model(s), s.train_warm, s.train_warm, s.p.k), "unseen")
    seen = recs.join(s.train_warm.select(U, I), [U, I], "left_semi").agg(F.count(F.lit(1)).alias("seen"))
    return _rec_facts(recs, s.train_warm).withColumn("seen", seen.scalar())


def _als_map_check(segment, k=None):
    """The relational MAP against Spark's own evaluator on the same lists."""
    def q(spark, d):
        s = study(spark, d)
        depth = k or s.p.k
        recs, labels = s.als_recs(segment, k), s.labels(segment, k)
        ours = metrics.map_at_k(labels, recs, depth, recs.select(U)).first()
        pred = ranking.ranked_array(recs, "prediction", [U], as_double=True)
        truth = ranking.true_arrays(labels, as_double=True).withColumnRenamed("true_labels", "label")
        theirs = RankingEvaluator(k=depth, metricName="meanAveragePrecisionAtK", labelCol="label",
                                  predictionCol="prediction").evaluate(truth.join(pred, U))
        return spark.createDataFrame([(ours["users"], round(abs(ours["map"] - theirs), 9))], "users long, difference double")
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks
    "scan_interactions": q_scan_interactions,
    "scan_typed": q_scan_typed,
    "scan_multi": q_scan_multi,
    "sink_roundtrip": q_sink_roundtrip,
    "sql_view": q_sql_view,
    "split_counts": q_split_counts,
    # projections
    "impute_item_id": q_impute_item_id,
    "conform_columns": q_conform_columns,
    "rec_array_shape": q_rec_array_shape,
    # preparation
    "interactions": q_interactions,
    "events_interactions": q_events_interactions,
    "positive_feedback": q_positive_feedback,
    "item_listeners": q_item_listeners,
    "user_activity": q_user_activity,
    "popular_items": q_popular_items,
    "popular_items_pct15": q_popular_items_pct15,
    "restrict_items": q_restrict_items,
    "active_users": q_active_users,
    "low_activity_users": q_low_activity_users,
    "restrict_users": q_restrict_users,
    "listener_histogram": q_listener_histogram,
    "activity_histogram": q_activity_histogram,
    "listener_percentile": q_listener_percentile,
    "listener_percentile_sketch": q_listener_percentile_sketch,
    "item_listeners_sketch": q_item_listeners_sketch,
    "items_by_percentile": q_items_by_percentile,
    "items_by_percent_rank": q_items_by_percent_rank,
    "join_items_left": q_join_items_left,
    "join_users_left": q_join_users_left,
    "join_users_events_left": q_join_users_events_left,
    "union_distinct": q_union_distinct,
    "prepare_catalogue": q_prepare_catalogue,
    # split and cold start
    "attach_group_size": q_attach_group_size,
    "split_train": q_split_train,
    "split_val": q_split_val,
    "split_sizes": q_split_sizes,
    "split_coverage": q_split_coverage,
    "user_totals": q_user_totals,
    "user_percent_rank": q_user_percent_rank,
    "cold_users": q_cold_users,
    "warm_users": q_warm_users,
    "train_warm": _part("train_warm"),
    "train_cold": _part("train_cold"),
    "val_warm": _part("val_warm"),
    "val_cold": _part("val_cold"),
    "distinct_users": q_distinct_users,
    "test_warm": q_test_warm,
    "test_cold": q_test_cold,
    "test_cold_listed": q_test_cold_listed,
    "small_train": q_small_train,
    "small_val": q_small_val,
    "sample_train": q_sample_train,
    "sample_val": q_sample_val,
    # ranking and popularity
    "true_top_k": q_true_top_k,
    "true_arrays": q_true_arrays,
    "popularity_scores": q_popularity_scores,
    "popular_top_k": q_popular_top_k,
    "popular_head": q_popular_head,
    "popular_array": q_popular_array,
    "popular_recs_per_user": _recs_for(lambda s: s.train_warm),
    "cold_recs": _recs_for(lambda s: s.part("train_cold")),
    "labels_joined": q_labels_joined,
    "beta_sweep": q_beta_sweep,
    "recs_unseen": q_recs_unseen,
    # metrics
    "map_at_k_warm": _map("val_warm"),
    "map_at_k_cold": _map("val_cold"),
    "map_at_k_test_warm": _map("test_warm"),
    "map_at_k_test_cold": _map("test_cold"),
    "ap_per_user": q_ap_per_user,
    "map_at_100_val_warm": _map("val_warm", 100),
    "map_at_100_val_cold": _map("val_cold", 100),
    "map_at_100_test_warm": _map("test_warm", 100),
    "map_at_100_test_cold": _map("test_cold", 100),
    "precision_at_k": _metric(metrics.precision_at_k),
    "precision_train_warm": _metric(metrics.precision_at_k, "train_warm"),
    "recall_at_k": _metric(metrics.recall_at_k),
    "ndcg_at_k": q_ndcg_at_k,
    "mrr": _metric(metrics.mrr),
    "auc_popularity": _auc("val_warm"),
    "auc_train_warm": _auc("train_warm"),
    "popularity_report": q_popularity_report,
    "popularity_metrics_report": q_popularity_metrics_report,
    "popularity_intervals": q_popularity_intervals,
    # dictionaries
    "item_index": q_item_index,
    "item_index_unseen": q_item_index_unseen,
    "user_index": q_user_index,
    "coo_triples": q_coo_triples,
    "csr_roundtrip": q_csr_roundtrip,
    "csr_blocks": q_csr_blocks,
    # ALS
    "als_factors": q_als_factors,
    "als_recs_subset": q_als_recs_subset,
    "als_recs_all": q_als_recs_all,
    "als_map": _als_map("val_warm"),
    "als_map_test": _als_map("test_warm"),
    "als_id_range": q_als_id_range,
    "als_factor_check": q_als_factor_check,
    "als_recs_check": q_als_recs_check,
    "als_unseen_check": q_als_unseen_check,
    "als_map_check": _als_map_check("val_warm"),
    "als_map_100": _als_map("val_warm", 100),
    "als_map_100_test": _als_map("test_warm", 100),
    "als_map_100_check": _als_map_check("val_warm", 100),
    "als_map_100_test_check": _als_map_check("test_warm", 100),
    "als_topk_check": q_als_topk_check,
    "als_topk_work": q_als_topk_work,
    "auc_als": _auc_als("val_warm"),
    "auc_als_test": _auc_als("test_warm"),
    "auc_als_check": q_auc_als_check,
    "model_report_check": q_model_report_check,
    "model_interval": q_model_interval,
    "als_sweep": q_als_sweep,
    "als_sweep_check": _tuned_check(q_als_sweep),
    "als_grid": q_als_grid,
    "als_grid_check": _tuned_check(q_als_grid),
    "als_indexed_recs": q_als_indexed_recs,
    "model_report": q_model_report,
}
