"""DuckDB SQL for the driver's correctness gate, one text per registered key.

Written independently of the Spark code, straight from the definitions with
plain windows, joins and LIMITs. Parameters are the defaults of
``encore.plans.study.Params``: item fraction 1/2, at least 10 items per user,
train share 4/5, seed 42, cold bound 0.1, beta 5000, k 10, test cut
2001-01-01. Doubles are rounded to 9 decimals, lists rendered as text, as in
the registered Spark queries.
"""

from __future__ import annotations

K = 10
BETA = 5000
BETAS = (1, 100, 1000, 5000, 10000, 20000, 100000, 1000000)

BASE = f"""
plays AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity AS quantity
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderdate < TIMESTAMP '2001-01-01'),
ix AS (
  SELECT user_id, item_id, CAST(SUM(quantity) AS BIGINT) AS interactions
  FROM plays GROUP BY user_id, item_id),
ix_all AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(SUM(l.l_quantity) AS BIGINT) AS interactions
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate IS NOT NULL GROUP BY 1, 2),
listeners_all AS (
  SELECT item_id, COUNT(user_id) AS listeners FROM ix_all WHERE item_id IS NOT NULL GROUP BY item_id),
listeners AS (
  SELECT item_id, COUNT(user_id) AS listeners FROM ix WHERE item_id IS NOT NULL GROUP BY item_id),
popular AS (
  SELECT item_id, listeners FROM (
    SELECT item_id, listeners, row_number() OVER (ORDER BY listeners DESC, item_id ASC) AS rn
    FROM listeners) r
  WHERE rn <= (SELECT (COUNT(*) * 1) // 2 FROM listeners)),
popular_ix AS (SELECT * FROM ix WHERE item_id IN (SELECT item_id FROM popular)),
active AS (SELECT user_id FROM popular_ix GROUP BY user_id HAVING COUNT(*) >= 10),
core AS (SELECT * FROM popular_ix WHERE user_id IN (SELECT user_id FROM active)),
labelled AS (
  SELECT user_id, item_id, interactions, rn, n, (n * 4) // 5 AS row_counts FROM (
    SELECT user_id, item_id, interactions,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY
        md5(concat('42', '|', CAST(user_id AS VARCHAR), '|', CAST(item_id AS VARCHAR))), item_id) AS BIGINT) AS rn,
      CAST(COUNT(*) OVER (PARTITION BY user_id) AS BIGINT) AS n
    FROM core) z),
train_rows AS (SELECT user_id, item_id, interactions FROM labelled WHERE rn <= row_counts),
val_rows AS (SELECT user_id, item_id, interactions FROM labelled WHERE rn > row_counts),
totals AS (SELECT user_id, CAST(SUM(interactions) AS BIGINT) AS total_interactions FROM core GROUP BY user_id),
uranks AS (
  SELECT user_id, total_interactions,
         percent_rank() OVER (ORDER BY total_interactions) AS percent_rank FROM totals),
cold_u AS (SELECT * FROM uranks WHERE percent_rank <= CAST(0.1 AS DOUBLE)),
warm_u AS (SELECT * FROM uranks WHERE percent_rank > CAST(0.1 AS DOUBLE)),
train_warm AS (SELECT t.*, w.total_interactions, w.percent_rank FROM train_rows t JOIN warm_u w USING (user_id)),
train_cold AS (SELECT t.*, w.total_interactions, w.percent_rank FROM train_rows t JOIN cold_u w USING (user_id)),
val_warm AS (SELECT t.*, w.total_interactions, w.percent_rank FROM val_rows t JOIN warm_u w USING (user_id)),
val_cold AS (SELECT t.*, w.total_interactions, w.percent_rank FROM val_rows t JOIN cold_u w USING (user_id)),
test_plays AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity AS quantity
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderdate >= TIMESTAMP '2001-01-01'),
test_rows AS (
  SELECT * FROM (SELECT user_id, item_id, CAST(SUM(quantity) AS BIGINT) AS interactions
                 FROM test_plays GROUP BY user_id, item_id) t WHERE interactions > 0),
test_warm AS (SELECT * FROM test_rows WHERE user_id IN (SELECT user_id FROM train_warm)),
test_cold AS (SELECT * FROM test_rows WHERE user_id NOT IN (SELECT user_id FROM train_warm)),
pop_scores AS (
  SELECT item_id, CAST(SUM(interactions) AS BIGINT) AS total_listens,
         CAST(COUNT(user_id) AS BIGINT) AS num_users,
         CAST(SUM(interactions) AS DOUBLE) / (CAST(COUNT(user_id) AS DOUBLE) + CAST({BETA} AS DOUBLE)) AS score
  FROM train_warm WHERE interactions > 0 GROUP BY item_id),
top_list AS (
  SELECT item_id, score, rank FROM (
    SELECT item_id, score, CAST(row_number() OVER (ORDER BY score DESC, item_id ASC) AS BIGINT) AS rank
    FROM pop_scores) r WHERE rank <= {K}),
tracks AS (
  SELECT CAST(p_partkey AS VARCHAR) AS recording_msid,
         COALESCE(CASE WHEN p_type = 'SMALL' THEN NULL ELSE concat_ws(' / ', p_name, p_brand) END,
                  CAST(p_partkey AS VARCHAR)) AS recording_mbid
  FROM part),
item_counts AS (SELECT item_id, COUNT(*) AS freq FROM core GROUP BY item_id),
item_dict AS (
  SELECT item_id, CAST(row_number() OVER (ORDER BY freq DESC, CAST(item_id AS VARCHAR) ASC) - 1 AS BIGINT)
         AS item_idx FROM item_counts),
full_rows AS (SELECT * FROM train_rows UNION SELECT * FROM val_rows),
user_dict AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS u_idx
  FROM (SELECT DISTINCT user_id FROM full_rows) u),
item_ids AS (
  SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS BIGINT) AS i_idx
  FROM (SELECT DISTINCT item_id FROM full_rows) i)
"""

SEGMENTS = {
    "train_warm": ("train_warm", "train_warm"),
    "val_warm": ("val_warm", "train_warm"),
    "val_cold": ("val_cold", "train_cold"),
    "test_warm": ("test_warm", "test_warm"),
    "test_cold": ("test_cold", "test_cold"),
}


def _with(*extra: str) -> str:
    parts = [BASE.strip()] + [e.strip() for e in extra if e.strip()]
    return "WITH " + ",\n".join(parts) + "\n"


def _metric_ctes(segment: str, tag: str = "", k: int = K, cut: bool = True) -> str:
    """Best / lab / nl / hits / ht / ideal / pu CTEs (suffixed by ``tag``) for one segment.

    ``cut``: only each user's k strongest items are labels (MAP, NDCG); else all of them.
    """
    truth, users = SEGMENTS[segment]
    t = tag
    return f"""
best{t} AS (
  SELECT item_id, rank FROM (
    SELECT item_id, row_number() OVER (ORDER BY score DESC, item_id ASC) AS rank FROM pop_scores) r WHERE rank <= {k}),
lab{t} AS (
  SELECT user_id, item_id FROM (
    SELECT user_id, item_id,
           row_number() OVER (PARTITION BY user_id ORDER BY interactions DESC, item_id ASC) AS rank
    FROM {truth} WHERE interactions > 0) r {f"WHERE rank <= {k}" if cut else ""}),
nl{t} AS (
  SELECT user_id, COUNT(*) AS n_labels FROM lab{t}
  WHERE user_id IN (SELECT user_id FROM {users}) GROUP BY user_id),
hits{t} AS (
  SELECT l.user_id, t.rank FROM lab{t} l JOIN best{t} t ON l.item_id = t.item_id
  WHERE l.user_id IN (SELECT user_id FROM nl{t})),
ht{t} AS (
  SELECT user_id, SUM(CAST(cnt AS DOUBLE) / CAST(rank AS DOUBLE)) AS ap_sum, COUNT(*) AS hits,
         SUM(1.0 / log2(CAST(rank AS DOUBLE) + 1.0)) AS dcg, MIN(rank) AS first_rank
  FROM (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS cnt
        FROM hits{t}) h GROUP BY user_id),
ideal{t} AS (
  SELECT i, SUM(1.0 / log2(CAST(i AS DOUBLE) + 1.0)) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
         AND CURRENT ROW) AS idcg FROM range(1, {k + 1}) g(i)),
pu{t} AS (
  SELECT nl.user_id, nl.n_labels, COALESCE(ht.hits, 0) AS hits,
         COALESCE(ht.ap_sum, 0.0) / CAST(LEAST(nl.n_labels, {k}) AS DOUBLE) AS ap,
         CAST(COALESCE(ht.hits, 0) AS DOUBLE) / CAST({k} AS DOUBLE) AS precision,
         CAST(COALESCE(ht.hits, 0) AS DOUBLE) / CAST(nl.n_labels AS DOUBLE) AS recall,
         COALESCE(ht.dcg, 0.0) / ideal.idcg AS ndcg,
         COALESCE(1.0 / CAST(ht.first_rank AS DOUBLE), 0.0) AS rr
  FROM nl{t} nl LEFT JOIN ht{t} ht USING (user_id) JOIN ideal{t} ideal ON ideal.i = LEAST(nl.n_labels, {k}))
"""


def _auc(segment: str) -> str:
    """From the definition: over all pairs (relevant item, other item of the dictionary), wins plus half the ties."""
    truth, users = SEGMENTS[segment]
    return _with("""
dict AS (SELECT d.item_id, COALESCE(s.score, -1) AS score FROM (SELECT DISTINCT item_id FROM core) d LEFT JOIN pop_scores s USING (item_id))""", f"""
pos AS (SELECT DISTINCT t.user_id, t.item_id, d.score FROM {truth} t JOIN dict d USING (item_id)
        WHERE t.interactions > 0 AND t.user_id IN (SELECT user_id FROM {users}))""", """
wins AS (
  SELECT p.user_id, avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END) AS auc
  FROM pos p CROSS JOIN dict q
  WHERE NOT EXISTS (SELECT 1 FROM pos x WHERE x.user_id = p.user_id AND x.item_id = q.item_id) GROUP BY p.user_id)""") + (
        "SELECT CAST(COUNT(*) AS BIGINT) AS users, ROUND(COALESCE(AVG(auc), 0.0), 9) AS auc FROM wins")


def _mean_sql(column: str, out: str, segment: str = "val_warm", k: int = K, cut: bool = True) -> str:
    return (_with(_metric_ctes(segment, k=k, cut=cut)) +
            f"SELECT CAST(COUNT(*) AS BIGINT) AS users, ROUND(COALESCE(AVG({column}), 0.0), 9) AS {out} FROM pu")


def _intervals() -> str:
    """A Poisson bootstrap from the definition: every user's draw of every replicate, percentiles of the replicates' means."""
    parts = []
    for seg, t in (("val_warm", "_v"), ("test_warm", "_t")):
        for m in ("ap", "ndcg"):
            parts.append(f"""SELECT '{seg}' AS segment, '{m}' AS metric, (SELECT count(*) FROM pu{t}) AS users,
  ROUND((SELECT avg({m}) FROM pu{t}), 9) AS value, ROUND(quantile_cont(v, 0.025), 9) AS low, ROUND(quantile_cont(v, 0.975), 9) AS high
FROM (SELECT r, sum(w * {m}) / sum(w) AS v FROM draws{t} JOIN pu{t} USING (user_id) GROUP BY r HAVING sum(w) > 0)""")
    draws = [f"""
draws{t} AS (
  SELECT user_id, r, len(list_filter((SELECT steps FROM poisson), lambda c: c <=
    ('0x' || substr(md5('42|' || user_id::VARCHAR || '|' || r), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)) AS w
  FROM pu{t}, unnest(range(1, 101)) AS q(r))""" for t in ("_v", "_t")]
    poisson = """
poisson AS (SELECT list(c ORDER BY k) AS steps FROM (SELECT k, sum(exp(-1.0::DOUBLE) / factorial(k::INT)::DOUBLE) OVER (ORDER BY k) AS c FROM range(16) g(k)))"""
    return _with(_metric_ctes("val_warm", "_v"), _metric_ctes("test_warm", "_t"), poisson, *draws) + "\nUNION ALL ".join(parts)


def _model_report_check() -> str:
    rows = []
    for model in ("popularity", "als"):
        for seg, t in (("val_warm", "_v"), ("test_warm", "_t")):
            for m in ("map", "precision", "recall", "ndcg", "mrr"):
                rows.append(f"SELECT '{model}' AS model, '{seg}' AS segment, '{m}' AS metric, {K} AS k, (SELECT count(*) FROM nl{t}) AS users, true AS is_share")
    return _with(_metric_ctes("val_warm", "_v"), _metric_ctes("test_warm", "_t")) + "\nUNION ALL ".join(rows)


def _tuning(settings: str) -> str:
    return _with(_metric_ctes("val_warm")) + f"""SELECT rank::INT AS rank, reg::DOUBLE AS reg, alpha::DOUBLE AS alpha, max_iter::INT AS max_iter,
  (SELECT count(*) FROM nl) AS users, true AS is_share FROM ({settings}) s"""


def _listener_bin(col: str) -> str:
    return f"""CASE WHEN {col} < 5 THEN '[0, 5)' WHEN {col} < 10 THEN '[5, 10)'
  WHEN {col} < 20 THEN '[10, 20)' WHEN {col} < 30 THEN '[20, 30)' WHEN {col} < 40 THEN '[30, 40)'
  WHEN {col} < 50 THEN '[40, 50)' WHEN {col} < 100 THEN '[50, 100)' WHEN {col} < 200 THEN '[100, 200)'
  WHEN {col} < 500 THEN '[200, 500)' ELSE '>=500' END"""


def _activity_bin(col: str) -> str:
    return f"""CASE WHEN {col} < 10 THEN '[0, 10)' WHEN {col} < 25 THEN '[10, 25)'
  WHEN {col} < 50 THEN '[25, 50)' WHEN {col} < 100 THEN '[50, 100)' WHEN {col} < 200 THEN '[100, 200)'
  WHEN {col} < 300 THEN '[200, 300)' WHEN {col} < 400 THEN '[300, 400)' WHEN {col} < 500 THEN '[400, 500)'
  ELSE '>=500' END"""


def _recs_text(users_table: str) -> str:
    return (_with() + f"""SELECT u.user_id, (SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank)
  FROM top_list) AS recommendations FROM (SELECT DISTINCT user_id FROM {users_table}) u""")


def _beta_sweep() -> str:
    values = ", ".join(f"(CAST({b} AS DOUBLE))" for b in BETAS)
    seg_parts = []
    for name in ("val_warm", "val_cold"):
        truth, users = SEGMENTS[name]
        seg_parts.append(f"""
SELECT b.beta, '{name}' AS segment, (SELECT COUNT(*) FROM nl_{name}) AS users,
       ROUND(CASE WHEN (SELECT COUNT(*) FROM nl_{name}) > 0
             THEN COALESCE(s.total, 0.0) / CAST((SELECT COUNT(*) FROM nl_{name}) AS DOUBLE) ELSE 0.0 END, 9) AS map
FROM betas b LEFT JOIN (
  SELECT beta, SUM(ap) AS total FROM (
    SELECT h.beta, h.user_id, SUM(CAST(h.cnt AS DOUBLE) / CAST(h.rank AS DOUBLE))
           / CAST(LEAST(MIN(nl.n_labels), {K}) AS DOUBLE) AS ap
    FROM (SELECT l.user_id, t.beta, t.rank,
                 row_number() OVER (PARTITION BY t.beta, l.user_id ORDER BY t.rank) AS cnt
          FROM lab_{name} l JOIN tops t ON l.item_id = t.item_id
          WHERE l.user_id IN (SELECT user_id FROM nl_{name})) h
    JOIN nl_{name} nl ON nl.user_id = h.user_id
    GROUP BY h.beta, h.user_id) a GROUP BY beta) s ON s.beta = b.beta""")
    ctes = [f"betas AS (SELECT * FROM (VALUES {values}) v(beta))",
            f"""item_aggs AS (
  SELECT item_id, CAST(SUM(interactions) AS BIGINT) AS tl, CAST(COUNT(user_id) AS BIGINT) AS nu
  FROM train_warm WHERE interactions > 0 GROUP BY item_id)""",
            f"""tops AS (
  SELECT beta, item_id, rank FROM (
    SELECT b.beta, a.item_id, row_number() OVER (PARTITION BY b.beta ORDER BY
      CAST(a.tl AS DOUBLE) / (CAST(a.nu AS DOUBLE) + b.beta) DESC, a.item_id ASC) AS rank
    FROM item_aggs a CROSS JOIN betas b) r WHERE rank <= {K})"""]
    for name in ("val_warm", "val_cold"):
        truth, users = SEGMENTS[name]
        ctes.append(f"""lab_{name} AS (
  SELECT user_id, item_id FROM (
    SELECT user_id, item_id,
           row_number() OVER (PARTITION BY user_id ORDER BY interactions DESC, item_id ASC) AS rank
    FROM {truth} WHERE interactions > 0) r WHERE rank <= {K})""")
        ctes.append(f"""nl_{name} AS (
  SELECT user_id, COUNT(*) AS n_labels FROM lab_{name}
  WHERE user_id IN (SELECT user_id FROM {users}) GROUP BY user_id)""")
    return _with(*ctes) + "\nUNION ALL\n".join(seg_parts)


def _popularity_report() -> str:
    ctes, selects = [], []
    for i, name in enumerate(("val_warm", "val_cold", "test_warm", "test_cold")):
        ctes.append(_metric_ctes(name, f"_{i}"))
        selects.append(f"SELECT 'popularity' AS model, '{name}' AS segment, 'map' AS metric, "
                       f"CAST({K} AS INTEGER) AS k, CAST(COUNT(*) AS BIGINT) AS users, "
                       f"ROUND(COALESCE(AVG(ap), 0.0), 9) AS value FROM pu_{i}")
    return _with(*ctes) + "\nUNION ALL\n".join(selects)


def _popularity_metrics_report() -> str:
    ctes, selects = [], []
    for i, name in enumerate(("val_warm", "val_cold", "test_warm", "test_cold")):
        ctes += [_metric_ctes(name, f"_{i}"), _metric_ctes(name, f"_{i}a", cut=False)]
        for metric, col, source in (("map", "ap", f"{i}"), ("precision", "precision", f"{i}a"), ("recall", "recall", f"{i}a"),
                                    ("ndcg", "ndcg", f"{i}"), ("mrr", "rr", f"{i}a")):
            selects.append(f"SELECT 'popularity' AS model, '{name}' AS segment, '{metric}' AS metric, "
                           f"CAST({K} AS INTEGER) AS k, CAST(COUNT(*) AS BIGINT) AS users, "
                           f"ROUND(COALESCE(AVG({col}), 0.0), 9) AS value FROM pu_{source}")
    return _with(*ctes) + "\nUNION ALL\n".join(selects)


ORACLE_SQL: dict[str, str] = {
    # sources / sinks
    "scan_interactions": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "scan_typed": ("SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, "
                   "CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem"),
    "scan_multi": _with() + "SELECT * FROM train_rows UNION ALL SELECT * FROM val_rows",
    "sink_roundtrip": _with() + "SELECT * FROM ix_all",
    "sql_view": _with() + ("SELECT user_id, COUNT(*) AS n_items, CAST(SUM(interactions) AS BIGINT) AS total "
                           "FROM core GROUP BY user_id"),
    "split_counts": _with() + """
SELECT 'interactions' AS stage, COUNT(*) AS rows FROM ix
UNION ALL SELECT 'popular_pairs', COUNT(*) FROM popular_ix
UNION ALL SELECT 'core', COUNT(*) FROM core
UNION ALL SELECT 'train', COUNT(*) FROM train_rows
UNION ALL SELECT 'val', COUNT(*) FROM val_rows
UNION ALL SELECT 'train_warm', COUNT(*) FROM train_warm
UNION ALL SELECT 'train_cold', COUNT(*) FROM train_cold
UNION ALL SELECT 'val_warm', COUNT(*) FROM val_warm
UNION ALL SELECT 'val_cold', COUNT(*) FROM val_cold
UNION ALL SELECT 'test', COUNT(*) FROM test_rows
UNION ALL SELECT 'test_warm', COUNT(*) FROM test_warm
UNION ALL SELECT 'test_cold', COUNT(*) FROM test_cold""",
    # projections
    "impute_item_id": _with() + "SELECT recording_msid, recording_mbid FROM tracks",
    "conform_columns": _with() + "SELECT interactions, item_id, user_id FROM core",
    "rec_array_shape": _with() + """SELECT u.user_id,
  (SELECT string_agg(CAST(CAST(item_id AS DOUBLE) AS VARCHAR), ',' ORDER BY rank) FROM top_list) AS predicted_labels,
  (SELECT COUNT(*)::INTEGER FROM top_list) AS n
FROM (SELECT DISTINCT user_id FROM train_warm) u""",
    # preparation
    "interactions": _with() + "SELECT * FROM ix_all",
    "events_interactions": """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  COUNT(*) AS interactions FROM events GROUP BY 1, 2""",
    "popular_items_pct15": _with() + """SELECT item_id, listeners FROM (
  SELECT item_id, listeners, row_number() OVER (ORDER BY listeners DESC, item_id ASC) AS rn FROM listeners_all) r
WHERE rn <= (SELECT (COUNT(*) * 3) // 20 FROM listeners_all)""",
    "positive_feedback": _with() + "SELECT * FROM ix_all WHERE interactions > 0",
    "item_listeners": _with() + "SELECT item_id, listeners FROM listeners_all",
    "user_activity": _with() + ("SELECT user_id, COUNT(item_id) AS tracks FROM ix_all "
                                "WHERE user_id IS NOT NULL GROUP BY user_id"),
    "popular_items": _with() + "SELECT item_id, listeners FROM popular",
    "restrict_items": _with() + "SELECT * FROM popular_ix",
    "active_users": _with() + "SELECT user_id FROM active",
    "low_activity_users": _with() + "SELECT user_id FROM popular_ix GROUP BY user_id HAVING COUNT(*) < 10",
    "restrict_users": _with() + "SELECT * FROM core",
    "listener_histogram": _with() + (f"SELECT {_listener_bin('listeners')} AS listeners_counts, "
                                     "COUNT(*) AS track_counts FROM listeners_all GROUP BY 1"),
    "activity_histogram": _with() + (f"SELECT {_activity_bin('tracks')} AS track_counts, COUNT(*) AS user_counts "
                                     "FROM (SELECT user_id, COUNT(item_id) AS tracks FROM ix_all GROUP BY user_id) a "
                                     "GROUP BY 1"),
    "listener_percentile": _with() + ("SELECT ROUND(quantile_cont(listeners, 0.85), 9) AS listener_percentile "
                                      "FROM listeners_all"),
    "items_by_percentile": _with() + ("SELECT item_id, listeners FROM listeners_all WHERE listeners >= "
                                      "(SELECT ROUND(quantile_cont(listeners, 0.85), 9) FROM listeners_all)"),
    "items_by_percent_rank": _with() + """SELECT item_id, listeners, ROUND(pr, 9) AS percent_rank FROM (
  SELECT item_id, listeners, percent_rank() OVER (ORDER BY listeners DESC) AS pr FROM listeners_all) r
WHERE pr <= CAST(0.15 AS DOUBLE)""",
    "join_items_left": _with() + """SELECT p.user_id, p.recording_msid, t.recording_mbid FROM (
  SELECT o.o_custkey AS user_id, CAST(l.l_partkey AS VARCHAR) AS recording_msid
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey) p
LEFT JOIN tracks t ON p.recording_msid = t.recording_msid""",
    "join_users_left": """SELECT c.c_custkey AS user_id, e.item_id, COUNT(*) AS interactions
FROM customer c LEFT JOIN (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey) e ON c.c_custkey = e.user_id
GROUP BY c.c_custkey, e.item_id""",
    "join_users_events_left": """SELECT c.c_custkey AS user_id, e.item_id, COUNT(*) AS interactions
FROM customer c LEFT JOIN (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events) e
  ON c.c_custkey = e.user_id GROUP BY c.c_custkey, e.item_id""",
    "prepare_catalogue": _with("""
cat_plays AS (
  SELECT o.o_custkey AS user_id, CAST(l.l_partkey AS VARCHAR) AS recording_msid
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)""", """
cat_joined AS (SELECT p.user_id, t.recording_mbid FROM cat_plays p
               LEFT JOIN tracks t ON p.recording_msid = t.recording_msid)""", """
cat_full AS (SELECT c.c_custkey AS user_id, j.recording_mbid FROM customer c
             LEFT JOIN cat_joined j ON c.c_custkey = j.user_id)""", """
cat_ix AS (SELECT user_id, recording_mbid AS item_id, COUNT(*) AS interactions FROM cat_full GROUP BY 1, 2)""", """
cat_l AS (SELECT item_id, COUNT(user_id) AS listeners FROM cat_ix WHERE item_id IS NOT NULL GROUP BY item_id)""", """
cat_pop AS (SELECT item_id FROM (
  SELECT item_id, row_number() OVER (ORDER BY listeners DESC, item_id ASC) AS rn FROM cat_l) r
  WHERE rn <= (SELECT COUNT(*) // 2 FROM cat_l))""", """
cat_pi AS (SELECT * FROM cat_ix WHERE item_id IN (SELECT item_id FROM cat_pop))""") + """SELECT * FROM cat_pi
WHERE user_id IN (SELECT user_id FROM cat_pi GROUP BY user_id HAVING COUNT(*) >= 10)""",
    "union_distinct": _with() + "SELECT * FROM core UNION SELECT * FROM train_rows",
    # split and cold start
    "attach_group_size": _with() + "SELECT user_id, item_id, interactions, rn, n, row_counts FROM labelled",
    "split_train": _with() + "SELECT * FROM train_rows",
    "split_val": _with() + "SELECT * FROM val_rows",
    "split_sizes": _with() + ("SELECT user_id, COUNT(*) AS n, (COUNT(*) * 4) // 5 AS row_counts "
                              "FROM core GROUP BY user_id"),
    "split_coverage": _with() + ("SELECT COUNT(*) AS missing_users FROM (SELECT DISTINCT user_id FROM val_rows "
                                 "WHERE user_id NOT IN (SELECT user_id FROM train_rows)) m"),
    "user_totals": _with() + "SELECT * FROM totals",
    "user_percent_rank": _with() + "SELECT * FROM uranks",
    "cold_users": _with() + "SELECT * FROM cold_u",
    "warm_users": _with() + "SELECT * FROM warm_u",
    "train_warm": _with() + "SELECT * FROM train_warm",
    "train_cold": _with() + "SELECT * FROM train_cold",
    "val_warm": _with() + "SELECT * FROM val_warm",
    "val_cold": _with() + "SELECT * FROM val_cold",
    "distinct_users": _with() + "SELECT DISTINCT user_id FROM train_warm",
    "test_warm": _with() + "SELECT * FROM test_warm",
    "test_cold": _with() + "SELECT * FROM test_cold",
    "test_cold_listed": _with() + ("SELECT * FROM test_rows WHERE user_id IN (SELECT user_id FROM popular_ix "
                                   "GROUP BY user_id HAVING COUNT(*) < 10)"),
    "listener_percentile_sketch": "SELECT kind, q::DOUBLE AS q, true AS within FROM (VALUES ('kll'), ('percentile_approx')) a(kind), "
                                  "(VALUES (0.05), (0.25), (0.5), (0.75), (0.85), (0.95)) b(q)",
    "item_listeners_sketch": _with() + "SELECT count(*) AS items, count(*) AS estimated, 0::BIGINT AS outside FROM listeners_all",
    "sample_train": _with() + "SELECT * FROM train_rows ORDER BY md5('42|' || user_id::VARCHAR || '|' || item_id::VARCHAR), user_id, item_id LIMIT 1000",
    "sample_val": _with() + "SELECT * FROM val_rows ORDER BY md5('42|' || user_id::VARCHAR || '|' || item_id::VARCHAR), user_id, item_id LIMIT 250",
    "small_train": _with() + "SELECT * FROM train_rows ORDER BY user_id, item_id LIMIT 1000",
    "small_val": _with() + "SELECT * FROM val_rows ORDER BY user_id, item_id LIMIT 250",
    # ranking and popularity
    "true_top_k": _with() + f"""SELECT * FROM (
  SELECT user_id, item_id, interactions, total_interactions, percent_rank,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY interactions DESC, item_id ASC) AS BIGINT) AS rank
  FROM val_warm WHERE interactions > 0) r WHERE rank <= {K}""",
    "true_arrays": _with() + f"""SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS true_labels
FROM (SELECT user_id, item_id,
        row_number() OVER (PARTITION BY user_id ORDER BY interactions DESC, item_id ASC) AS rank
      FROM val_warm WHERE interactions > 0) r WHERE rank <= {K} GROUP BY user_id""",
    "popularity_scores": _with() + ("SELECT item_id, total_listens, num_users, ROUND(score, 9) AS score "
                                    "FROM pop_scores"),
    "popular_top_k": _with() + "SELECT item_id, ROUND(score, 9) AS score, rank FROM top_list",
    "popular_head": _with() + """SELECT item_id, ROUND(score, 9) AS score, rank FROM (
  SELECT item_id, score, CAST(row_number() OVER (ORDER BY score DESC, item_id ASC) AS BIGINT) AS rank
  FROM pop_scores) r WHERE rank <= 5""",
    "popular_array": _with() + ("SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS predicted_labels, "
                                "COUNT(*)::INTEGER AS n FROM top_list"),
    "popular_recs_per_user": _recs_text("train_warm"),
    "cold_recs": _recs_text("train_cold"),
    "labels_joined": _with() + f"""SELECT t.user_id, t.true_labels, p.predicted_labels FROM (
  SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS true_labels FROM (
    SELECT user_id, item_id,
           row_number() OVER (PARTITION BY user_id ORDER BY interactions DESC, item_id ASC) AS rank
    FROM val_warm WHERE interactions > 0) r WHERE rank <= {K} GROUP BY user_id) t
JOIN (SELECT u.user_id, (SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) FROM top_list)
        AS predicted_labels FROM (SELECT DISTINCT user_id FROM train_warm) u) p ON t.user_id = p.user_id""",
    "beta_sweep": _beta_sweep(),
    "recs_unseen": _with() + f"""SELECT user_id, item_id, rank FROM (
  SELECT x.user_id, x.item_id, CAST(row_number() OVER (PARTITION BY x.user_id ORDER BY x.score DESC, x.item_id ASC) AS BIGINT) AS rank
  FROM (SELECT u.user_id, s.item_id, s.score FROM (SELECT DISTINCT user_id FROM train_warm) u CROSS JOIN pop_scores s) x
  WHERE NOT EXISTS (SELECT 1 FROM train_warm w WHERE w.user_id = x.user_id AND w.item_id = x.item_id)) r WHERE rank <= {K}""",
    # metrics
    "map_at_k_warm": _mean_sql("ap", "map", "val_warm"),
    "map_at_k_cold": _mean_sql("ap", "map", "val_cold"),
    "map_at_k_test_warm": _mean_sql("ap", "map", "test_warm"),
    "map_at_k_test_cold": _mean_sql("ap", "map", "test_cold"),
    "ap_per_user": _with(_metric_ctes("val_warm")) + "SELECT user_id, ROUND(ap, 9) AS ap FROM pu",
    "map_at_100_val_warm": _mean_sql("ap", "map", "val_warm", 100),
    "map_at_100_val_cold": _mean_sql("ap", "map", "val_cold", 100),
    "map_at_100_test_warm": _mean_sql("ap", "map", "test_warm", 100),
    "map_at_100_test_cold": _mean_sql("ap", "map", "test_cold", 100),
    "precision_at_k": _mean_sql("precision", "precision", cut=False),
    "precision_train_warm": _mean_sql("precision", "precision", "train_warm", cut=False),
    "recall_at_k": _mean_sql("recall", "recall", cut=False),
    "ndcg_at_k": _mean_sql("ndcg", "ndcg"),
    "mrr": _mean_sql("rr", "mrr", cut=False),
    "auc_popularity": _auc("val_warm"),
    "auc_train_warm": _auc("train_warm"),
    # ALS: what SQL knows of it
    "als_id_range": _with() + """SELECT min(user_id)::INT AS min_user, max(user_id)::INT AS max_user, min(item_id)::INT AS min_item,
  max(item_id)::INT AS max_item FROM train_warm WHERE interactions > 0""",
    "als_factor_check": _with() + """SELECT 'user' AS side, count(DISTINCT user_id) AS vectors, 8 AS least_dims, 8 AS most_dims,
  0::BIGINT AS not_finite FROM train_warm WHERE interactions > 0
UNION ALL SELECT 'item', count(DISTINCT item_id), 8, 8, 0 FROM train_warm WHERE interactions > 0""",
    "als_recs_check": _with() + f"""SELECT count(DISTINCT user_id) AS users,
  (count(DISTINCT user_id) * least({K}, count(DISTINCT item_id)))::BIGINT AS rows, 0::BIGINT AS gaps, 0::BIGINT AS rises, 0::BIGINT AS unknown
FROM train_warm WHERE interactions > 0""",
    "als_unseen_check": _with() + f"""SELECT count(*) AS users, sum(least({K}, n - s))::BIGINT AS rows, 0::BIGINT AS gaps, 0::BIGINT AS rises,
  0::BIGINT AS unknown, 0::BIGINT AS seen
FROM (SELECT user_id, count(DISTINCT item_id) AS s FROM train_warm WHERE interactions > 0 GROUP BY user_id) u,
     (SELECT count(DISTINCT item_id) AS n FROM train_warm WHERE interactions > 0) t WHERE n > s""",
    "als_map_check": _with(_metric_ctes("val_warm")) + "SELECT count(*) AS users, 0.0::DOUBLE AS difference FROM nl",
    "als_map_100_check": _with(_metric_ctes("val_warm", k=100)) + "SELECT count(*) AS users, 0.0::DOUBLE AS difference FROM nl",
    "als_map_100_test_check": _with(_metric_ctes("test_warm", k=100)) + "SELECT count(*) AS users, 0.0::DOUBLE AS difference FROM nl",
    "als_topk_check": _with() + f"""SELECT count(DISTINCT user_id) AS users,
  (count(DISTINCT user_id) * least({K}, count(DISTINCT item_id)))::BIGINT AS rows, 0::BIGINT AS differing FROM train_warm WHERE interactions > 0""",
    "auc_als_check": _with("""
known AS (SELECT user_id, item_id FROM train_warm WHERE interactions > 0)""", """
truth AS (SELECT DISTINCT user_id, item_id FROM val_warm WHERE interactions > 0 AND user_id IN (SELECT user_id FROM known))""", """
sampled AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM truth) ORDER BY md5('42|' || user_id::VARCHAR), user_id LIMIT 50)""", """
sizes AS (SELECT user_id, count(*) AS m FROM truth WHERE user_id IN (SELECT user_id FROM sampled) AND item_id IN (SELECT item_id FROM known) GROUP BY user_id)""")
    + "SELECT count(*) AS users, 0::BIGINT AS differing FROM sizes WHERE m < (SELECT count(DISTINCT item_id) FROM known)",
    "als_sweep_check": _tuning("""
  SELECT unnest([10, 50, 100, 150, 200]) AS rank, 0.5 AS reg, 1.0 AS alpha, 15 AS max_iter
  UNION ALL SELECT 200, unnest([0.1, 0.5, 0.8, 1.0]), 1.0, 15
  UNION ALL SELECT 200, 0.5, unnest([0.1, 0.5, 1.0, 10.0]), 15
  UNION ALL SELECT 200, 0.5, 1.0, unnest([10, 12, 15, 20])"""),
    "als_grid_check": _tuning("SELECT rank, reg, 1.0 AS alpha, 15 AS max_iter FROM (SELECT unnest([100, 150, 200]) AS rank) a, (SELECT unnest([0.1, 0.5, 0.8, 1.0]) AS reg) b"),
    "csr_roundtrip": _with() + """SELECT u.u_idx, i.i_idx, CAST(t.interactions AS DOUBLE) AS weight
FROM train_rows t JOIN user_dict u ON t.user_id = u.user_id JOIN item_ids i ON t.item_id = i.item_id""",
    "csr_blocks": _with() + """SELECT CAST(ceil(count(*) / 4096.0) AS BIGINT) AS blocks, least(count(*), 4096)::INT AS largest, count(*) AS entries,
  0::BIGINT AS faults FROM train_rows""",
    "model_report_check": _model_report_check(),
    "popularity_intervals": _intervals(),
    "popularity_report": _popularity_report(),
    "popularity_metrics_report": _popularity_metrics_report(),
    # dictionaries
    "item_index": _with() + "SELECT item_id, item_idx FROM item_dict",
    "item_index_unseen": _with() + """SELECT t.user_id, t.item_id,
  COALESCE(d.item_idx, (SELECT COUNT(*) FROM item_dict)) AS item_idx
FROM test_rows t LEFT JOIN item_dict d ON t.item_id = d.item_id""",
    "user_index": _with() + "SELECT user_id, u_idx FROM user_dict",
    "coo_triples": _with() + """SELECT u.u_idx, i.i_idx, 1.0::DOUBLE AS value, CAST(t.interactions AS DOUBLE) AS weight
FROM train_rows t JOIN user_dict u ON t.user_id = u.user_id JOIN item_ids i ON t.item_id = i.item_id""",
}
