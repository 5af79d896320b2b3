"""Plain SQL for the registered queries, from the same tables and parameters."""

from __future__ import annotations

from chorale.plans import catalogue as c

LISTENS = "listens AS (SELECT user_id, props AS recording_msid, ts AS listened_at, event_id FROM events)"
HELD_OUT = f"{LISTENS}, held_out AS (SELECT * FROM listens WHERE listened_at >= TIMESTAMP '{c.TEST_FROM}')"
LEARNED = f"{LISTENS}, learned AS (SELECT * FROM listens WHERE listened_at < TIMESTAMP '{c.TEST_FROM}')"
PURCHASES = (
    "purchases AS (SELECT o_custkey AS user_id, CAST(l_partkey AS VARCHAR) AS recording_msid,"
    " o_orderdate AS listened_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


def counted(source: str, where: str = "TRUE") -> str:
    return (
        f"SELECT user_id, recording_msid, count(*) AS play_count FROM {source}"
        f" WHERE {where} GROUP BY user_id, recording_msid"
    )


def tagged(source: str, tie: str = "") -> str:
    return (
        "tagged AS (SELECT *, row_number() OVER (PARTITION BY user_id"
        f" ORDER BY listened_at, recording_msid{tie}) <="
        " floor(count(*) OVER (PARTITION BY user_id) * CAST(0.8 AS DOUBLE)) AS is_train"
        f" FROM {source})"
    )


SPLIT = f"{LEARNED}, {tagged('learned', ', event_id')}"
SPLIT_PURCHASES = f"{PURCHASES}, {tagged('purchases')}"
TRAIN = f"{SPLIT}, train AS ({counted('tagged', 'is_train')})"
BOTH = f"{TRAIN}, validation AS ({counted('tagged', 'NOT is_train')})"
RATINGS = f"{LISTENS}, ratings AS ({counted('listens')})"
HELD_OUT_RATINGS = counted("held_out")


def bucket(columns: str, seed: int) -> str:
    text = f"concat_ws('|', {columns}, '{seed}')"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0"


def scores(train: str, name: str = "scores", threshold: int = c.USER_THRESHOLD) -> str:
    return (
        f"{name} AS (SELECT recording_msid, CAST(sum(play_count) AS BIGINT) AS listen_count,"
        " count(*) AS user_count,"
        f" sum(play_count) / CAST(count(*) + {c.DAMPING} AS DOUBLE) AS avg_listen_per_user"
        f" FROM {train} GROUP BY recording_msid HAVING count(*) >= {threshold})"
    )


def ranking(source: str = "scores", name: str = "ranking") -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER"
        f" (ORDER BY avg_listen_per_user DESC, recording_msid) AS pos FROM {source})"
    )


def metrics_at(k: int, placed: str, extra: str = "") -> str:
    """Metrics at k from ``placed`` (user_id, pos): one row per relevant pair."""
    return f"""
    SELECT CAST({k} AS INTEGER) AS k, count(*) AS n_users,
           round(avg(precise / least(n_relevant, {k})), 9) AS map,
           round(avg(n_hits / CAST({k} AS DOUBLE)), 9) AS "precision",
           round(avg(gain / best), 9) AS ndcg,
           round(avg(n_hits / n_relevant), 9) AS recall{extra}
    FROM (
      SELECT user_id, count(*) AS n_relevant, count(place) AS n_hits,
             coalesce(sum(nth / place), 0) AS precise,
             coalesce(sum(1 / ln(place + 1)), 0) AS gain
      FROM (
        SELECT user_id, CASE WHEN pos <= {k} THEN pos END AS place,
               row_number() OVER (PARTITION BY user_id ORDER BY pos NULLS LAST) AS nth
        FROM {placed}
      ) AS places GROUP BY user_id
    ) AS users
    JOIN (SELECT n, sum(1 / ln(n + 1)) OVER (ORDER BY n) AS best
          FROM range(1, {k + 1}) AS r(n)) AS ideal ON n = least(n_relevant, {k})"""


def metrics(ks, placed: str, extra: str = "") -> str:
    return "\nUNION ALL\n".join(metrics_at(k, placed, extra) for k in ks)


def placed(relevant: str, name: str = "placed", ranked: str = "ranking") -> str:
    return (
        f"{name} AS (SELECT user_id, pos FROM"
        f" (SELECT DISTINCT user_id, recording_msid FROM {relevant}) AS relevant"
        f" LEFT JOIN {ranked} USING (recording_msid))"
    )


# Per user: the share of (relevant, other) pairs in the right order, counted pair by
# pair from places, and the reciprocal of the first place.
FULL = """, whole AS (
  SELECT round(avg(auc), 9) AS auc, round(avg(mrr), 9) AS mrr FROM (
    SELECT CASE WHEN count(pos) > 0 AND count(pos) < m THEN
             sum((m - pos) - (n_found - nth)) / (count(pos) * (m - count(pos))) END AS auc,
           1 / min(pos) AS mrr
    FROM (
      SELECT user_id, pos, (SELECT count(*) FROM ranking) AS m,
             count(pos) OVER (PARTITION BY user_id) AS n_found,
             row_number() OVER (PARTITION BY user_id ORDER BY pos NULLS LAST) AS nth
      FROM placed
    ) AS p GROUP BY user_id, m
  ) AS u
)"""
FULL_COLUMNS = ", (SELECT auc FROM whole) AS auc, (SELECT mrr FROM whole) AS mrr"


def full_metrics(split: str, train: str, relevant: str) -> str:
    return (
        f"WITH {split}, {scores(train)}, {ranking()}, {placed(relevant)}{FULL}"
        f" {metrics(c.KS, 'placed', FULL_COLUMNS)}"
    )


def compared(side: str) -> str:
    columns = '"precision", auc, recall, mrr'
    return (
        f"SELECT '{side}' AS side, {columns} FROM (WITH {placed(side)}{FULL}"
        f" {metrics_at(c.KS[0], 'placed', FULL_COLUMNS)}) AS m"
    )


def labelled(ks, placed_name: str, label: str, column: str) -> str:
    return f"SELECT *, {label} AS {column} FROM ({metrics(ks, placed_name)}) AS m"


def stability(seed: int) -> str:
    drawn = bucket("user_id, recording_msid", seed)
    return f"""
    SELECT *, CAST({seed} AS INTEGER) AS seed FROM (
      WITH train_{seed} AS (SELECT * FROM ratings WHERE {drawn} >= 0.2),
      test_{seed} AS (SELECT * FROM ratings WHERE {drawn} < 0.2),
      {scores(f'train_{seed}', f'scores_{seed}')},
      {ranking(f'scores_{seed}', f'ranking_{seed}')},
      {placed(f'test_{seed}', f'placed_{seed}', f'ranking_{seed}')}
      {metrics(c.KS, f'placed_{seed}')}
    ) AS s"""


def index(source: str, order: str, where: str = "TRUE") -> str:
    return (
        "SELECT recording_msid, CAST(row_number() OVER"
        f" (ORDER BY {order}, recording_msid) - 1 AS INTEGER) AS track_id_index"
        f" FROM {source} WHERE {where} GROUP BY recording_msid"
    )


EVENT_COLUMNS = "user_id, recording_msid, CAST(listened_at AS VARCHAR) AS listened_at, event_id"
THRESHOLD = c.PLAY_THRESHOLD
KNOWN = f"""{BOTH},
  fitted AS (SELECT * FROM train WHERE play_count >= {THRESHOLD}),
  checked AS (SELECT * FROM validation WHERE play_count >= {THRESHOLD})"""

POINTS = " UNION ALL ".join(
    f"SELECT CAST({p.rank} AS INTEGER) AS rank, CAST({p.reg} AS DOUBLE) AS reg,"
    f" CAST({p.alpha} AS DOUBLE) AS alpha, CAST({p.iterations} AS INTEGER) AS iterations"
    for p in c.GRID
)

ORACLE: dict[str, str] = {
    "scan_interactions": f"WITH {LISTENS} SELECT {EVENT_COLUMNS} FROM listens",
    "read_interactions": f"WITH {LEARNED} SELECT {EVENT_COLUMNS} FROM learned",
    "read_tracks": (
        "SELECT CAST(p_partkey AS VARCHAR) AS recording_msid, p_brand AS artist_name,"
        " p_name AS track_name, CAST(NULL AS VARCHAR) AS recording_mbid FROM part"
    ),
    "read_users": "SELECT c_custkey AS user_id, c_name AS user_name FROM customer",
    "prepared_tables": (
        f"WITH {BOTH}, held_out AS (SELECT * FROM listens WHERE listened_at >= TIMESTAMP '{c.TEST_FROM}')"
        " SELECT 'train' AS side, * FROM train UNION ALL SELECT 'validation' AS side, * FROM validation"
        f" UNION ALL SELECT 'test' AS side, * FROM ({HELD_OUT_RATINGS}) AS t"
    ),
    "written_results": "SELECT user_id, count(*) AS total_rows FROM events GROUP BY user_id",
    "als_prediction_is_product": (
        f"WITH {KNOWN} SELECT user_id, recording_msid, play_count, TRUE AS is_product FROM checked"
        " WHERE user_id IN (SELECT user_id FROM fitted)"
        " AND recording_msid IN (SELECT recording_msid FROM fitted)"
    ),
    "als_known_and_all": (
        f"WITH {SPLIT_PURCHASES} SELECT count(DISTINCT user_id) AS n_users, TRUE AS same_hits,"
        " TRUE AS all_is_stricter FROM tagged WHERE NOT is_train"
    ),
    "split_stability_errors": f"WITH {PURCHASES}, ratings AS ({counted('purchases')}), replicates AS ("
    + " UNION ALL ".join(stability(s) for s in c.SEEDS)
    + ") SELECT k, count(*) AS n_splits, "
    + ", ".join(
        f'round(avg("{m}"), 6) AS "{m}", round(stddev_samp("{m}") / sqrt(count(*)), 6) AS {m}_error'
        for m in ("map", "precision", "ndcg", "recall")
    )
    + " FROM replicates GROUP BY k",
    "popularity_from_days": (
        f"WITH {LISTENS} SELECT recording_msid, count(user_id) AS listen_count, TRUE AS is_near, TRUE AS is_same"
        " FROM listens WHERE recording_msid IS NOT NULL GROUP BY recording_msid HAVING count(user_id) > 0"
    ),
    "als_lists_are_best": (
        f"WITH {SPLIT_PURCHASES}, train AS ({counted('tagged', 'is_train')}) SELECT CAST(least({c.KS[0]},"
        " count(DISTINCT recording_msid)) AS INTEGER) AS n_listed, count(DISTINCT user_id) AS n_users,"
        " TRUE AS are_best FROM train"
    ),
    "als_metrics_recomputed": (
        f"WITH {SPLIT_PURCHASES}, train AS ({counted('tagged', 'is_train')})"
        f" SELECT CAST({c.KS[0]} AS INTEGER) AS k, count(DISTINCT user_id) AS n_users, TRUE AS are_same"
        " FROM tagged WHERE NOT is_train AND user_id IN (SELECT user_id FROM train)"
        " AND recording_msid IN (SELECT recording_msid FROM train)"
    ),
    "als_fit_is_optimal": (
        f"WITH {SPLIT_PURCHASES} SELECT count(DISTINCT user_id) AS n_users, TRUE AS is_optimal"
        " FROM tagged WHERE is_train"
    ),
    "als_tune_best": (
        f"SELECT unnest(['map', 'rmse']) AS select_by, CAST({len(c.GRID)} AS INTEGER) AS n_points, TRUE AS is_best"
    ),
    "edge_check_of_rates": """
    WITH results AS (
        SELECT CAST(l_linenumber AS DOUBLE) AS "rank", CAST(l_discount AS DOUBLE) AS reg,
            CAST(l_tax AS DOUBLE) AS alpha, CAST(floor(l_quantity / 10) AS DOUBLE) AS iterations,
            round(avg(CAST(l_extendedprice AS DOUBLE)), 6) AS map FROM lineitem GROUP BY 1, 2, 3, 4),
    best AS (SELECT * FROM results ORDER BY map DESC, "rank", reg, alpha, iterations LIMIT 1),
    long AS (UNPIVOT results ON "rank", reg, alpha, iterations INTO NAME parameter VALUE held),
    chosen AS (UNPIVOT best ON "rank", reg, alpha, iterations INTO NAME parameter VALUE chosen),
    spans AS (SELECT parameter, min(held) AS low, max(held) AS high, count(DISTINCT held) AS n_values
        FROM long GROUP BY parameter)
    SELECT parameter, chosen, low, high, n_values, n_values > 1 AND chosen IN (low, high) AS on_edge
    FROM chosen JOIN spans USING (parameter)""",
    "bounds_find_all": (
        "SELECT unnest([TRUE, FALSE]) AS is_exact, TRUE AS finds, TRUE AS is_less"
    ),
    "random_rows_cover": (
        "SELECT count(*) AS n_events, CAST(1 AS BIGINT) AS most, TRUE AS is_near FROM events"
    ),
    "bernoulli_bounds": "SELECT count(*) AS n_events, TRUE AS are_rows, TRUE AS is_near FROM events",
    "scan_test": f"WITH {HELD_OUT} SELECT {EVENT_COLUMNS} FROM held_out",
    "scan_tracks": (
        "SELECT CAST(p_partkey AS VARCHAR) AS recording_msid, p_brand AS artist_name,"
        " p_name AS track_name, CAST(NULL AS VARCHAR) AS recording_mbid FROM part"
    ),
    "scan_users": "SELECT c_custkey AS user_id, c_name AS user_name FROM customer",
    "conform_ratings": (
        f"WITH {RATINGS} SELECT CAST(user_id AS INTEGER) AS user_id,"
        " CAST(play_count AS INTEGER) AS play_count, CAST(NULL AS VARCHAR) AS track_name"
        " FROM ratings"
    ),
    "write_read_roundtrip": (
        f"WITH {BOTH} SELECT *, 'train' AS side FROM train"
        " UNION ALL SELECT *, 'validation' AS side FROM validation"
    ),
    "single_file_sample": (
        f"WITH {LISTENS} SELECT user_id, recording_msid, event_id, CAST(1 AS BIGINT) AS n_files"
        f" FROM listens WHERE {bucket('user_id, recording_msid, event_id', c.SEED)} < {c.SAMPLE}"
    ),
    "materialize_hit": f"WITH {RATINGS} SELECT * FROM ratings",
    "view_query": (
        f"WITH {LEARNED} SELECT recording_msid, count(*) AS n_listens FROM learned GROUP BY recording_msid"
    ),
    "clean_interactions": (
        "SELECT user_id, props AS recording_msid, CAST(ts AS VARCHAR) AS listened_at, event_id"
        " FROM events WHERE event_type <> 'error'"
    ),
    "profile": (
        f"WITH {RATINGS} SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users,"
        " count(DISTINCT recording_msid) AS n_items, max(play_count) AS max_play_count FROM ratings"
    ),
    "user_totals": "SELECT user_id, count(*) AS total_rows FROM events GROUP BY user_id",
    "play_counts": f"WITH {RATINGS} SELECT * FROM ratings",
    "events_with_play_count": (
        "SELECT user_id, props AS recording_msid, event_id,"
        " CAST(count(*) OVER (PARTITION BY user_id, props) AS INTEGER) AS play_count FROM events"
    ),
    "heaviest_pairs": (
        f"WITH {RATINGS} SELECT * FROM ratings"
        " WHERE play_count = (SELECT max(play_count) FROM ratings)"
    ),
    "min_plays_inclusive": f"WITH {RATINGS} SELECT * FROM ratings WHERE play_count >= {THRESHOLD}",
    "min_plays_strict": f"WITH {RATINGS} SELECT * FROM ratings WHERE play_count > {THRESHOLD}",
    "dedupe_ratings": f"WITH {RATINGS} SELECT * FROM ratings",
    "distinct_users": "SELECT DISTINCT user_id FROM events",
    "distinct_items": "SELECT DISTINCT props AS recording_msid FROM events",
    "union_train_test": (
        f"WITH {SPLIT}, held_out AS (SELECT * FROM listens WHERE listened_at >= TIMESTAMP '{c.TEST_FROM}'),"
        " both_sets AS (SELECT user_id, recording_msid FROM tagged WHERE is_train"
        " UNION ALL SELECT user_id, recording_msid FROM held_out)"
        f" {counted('both_sets')}"
    ),
    "sample_hash": (
        f"WITH {LISTENS} SELECT user_id, recording_msid, event_id FROM listens"
        f" WHERE {bucket('user_id, recording_msid, event_id', c.SEED)} < {c.SAMPLE}"
    ),
    "split_train": f"WITH {SPLIT} SELECT {EVENT_COLUMNS} FROM tagged WHERE is_train",
    "split_validation": f"WITH {SPLIT} SELECT {EVENT_COLUMNS} FROM tagged WHERE NOT is_train",
    "split_summary": (
        f"WITH {SPLIT} SELECT user_id,"
        " count(*) FILTER (WHERE is_train) AS n_train,"
        " count(*) FILTER (WHERE NOT is_train) AS n_validation,"
        " CAST(max(listened_at) FILTER (WHERE is_train) AS VARCHAR) AS last_train,"
        " CAST(min(listened_at) FILTER (WHERE NOT is_train) AS VARCHAR) AS first_validation"
        " FROM tagged GROUP BY user_id"
    ),
    "split_purchases": (
        f"WITH {SPLIT_PURCHASES} SELECT is_train, user_id, recording_msid,"
        " count(*) AS play_count FROM tagged GROUP BY is_train, user_id, recording_msid"
    ),
    "split_random_pairs": (
        f"WITH {RATINGS} SELECT *, {bucket('user_id, recording_msid', c.SEED)} >= 0.2 AS is_train"
        " FROM ratings"
    ),
    "prepare_test": f"WITH {HELD_OUT} {HELD_OUT_RATINGS}",
    "item_index_frequency": f"WITH {TRAIN} {index('train', 'count(*) DESC')}",
    "item_index_first_seen": f"WITH {LISTENS} {index('listens', 'min(listened_at)')}",
    "item_index_first_row": (
        f"WITH {RATINGS} {index('ratings', 'min(user_id)', f'play_count > {THRESHOLD}')}"
    ),
    "item_index_purchases": (
        f"WITH {PURCHASES}, ratings AS ({counted('purchases')})"
        f" {index('ratings', 'count(*) DESC')}"
    ),
    "indexed_ratings": (
        f"WITH {TRAIN}, numbered AS ({index('train', 'count(*) DESC')})"
        " SELECT user_id, recording_msid, track_id_index, play_count"
        " FROM train JOIN numbered USING (recording_msid)"
    ),
    "index_unseen": (
        f"WITH {TRAIN}, numbered AS ({index('train', 'count(*) DESC', 'play_count >= 5')}),"
        f" test AS ({counted('listens', f'''listened_at >= TIMESTAMP '{c.TEST_FROM}' ''')})"
        " SELECT user_id, recording_msid, CAST(coalesce(track_id_index,"
        " (SELECT count(*) FROM numbered)) AS INTEGER) AS track_id_index, play_count"
        " FROM test LEFT JOIN numbered USING (recording_msid)"
    ),
    "popularity_all_scores": (
        f"WITH {TRAIN}, {scores('train')} SELECT recording_msid, listen_count, user_count,"
        " round(avg_listen_per_user, 9) AS avg_listen_per_user FROM scores"
    ),
    "popularity_top_n": (
        f"WITH {TRAIN}, {scores('train')}, {ranking()} SELECT recording_msid, listen_count,"
        " user_count, round(avg_listen_per_user, 9) AS avg_listen_per_user,"
        f" CAST(pos AS INTEGER) AS pos FROM ranking WHERE pos <= {c.KS[0]}"
    ),
    "popularity_ranking": (
        f"WITH {PURCHASES}, ratings AS ({counted('purchases')}), {scores('ratings')}, {ranking()}"
        " SELECT recording_msid, pos FROM ranking"
    ),
    "recommend_popular": (
        f"WITH {TRAIN}, {scores('train')}, {ranking()}"
        " SELECT DISTINCT user_id, (SELECT coalesce(string_agg(recording_msid, '|' ORDER BY pos), '')"
        f" FROM ranking WHERE pos <= {c.KS[0]}) AS predicted FROM tagged WHERE NOT is_train"
    ),
    "relevant_lists": (
        f"WITH {TRAIN}, placed AS (SELECT user_id, recording_msid, CAST((row_number() OVER"
        f" (PARTITION BY user_id ORDER BY recording_msid) - 1) // {c.LIST_ROWS} AS BIGINT) AS part"
        " FROM train) SELECT user_id, part,"
        " string_agg(recording_msid, '|' ORDER BY recording_msid) AS actual"
        " FROM placed GROUP BY user_id, part"
    ),
    "top_n_per_user": (
        f"WITH {TRAIN} SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id"
        " ORDER BY play_count DESC, recording_msid) AS INTEGER) AS pos FROM train) AS t"
        f" WHERE pos <= {c.KS[0]}"
    ),
    "metrics_popularity": (
        f"WITH {BOTH}, held_out AS (SELECT * FROM listens WHERE listened_at >= TIMESTAMP '{c.TEST_FROM}'),"
        f" {scores('train')}, {ranking()}, {placed('validation', 'on_validation')},"
        f" {placed('held_out', 'on_test')}"
        f" {labelled(c.KS, 'on_validation', chr(39) + 'validation' + chr(39), 'evaluated_on')}"
        " UNION ALL"
        f" {labelled(c.KS, 'on_test', chr(39) + 'test' + chr(39), 'evaluated_on')}"
    ),
    "metrics_purchases": (
        f"WITH {SPLIT_PURCHASES}, train AS ({counted('tagged', 'is_train')}),"
        f" validation AS ({counted('tagged', 'NOT is_train')}),"
        f" {scores('train')}, {ranking()}, {placed('validation')}"
        f" {labelled(c.KS, 'placed', chr(39) + 'validation' + chr(39), 'evaluated_on')}"
    ),
    "metrics_auc_mrr": full_metrics(BOTH, "train", "validation"),
    "metrics_train_side": full_metrics(BOTH, "train", "train"),
    "metrics_auc_purchases": full_metrics(
        f"{SPLIT_PURCHASES}, train AS ({counted('tagged', 'is_train')}),"
        f" validation AS ({counted('tagged', 'NOT is_train')})",
        "train",
        "validation",
    ),
    "metrics_every_user": f"""
    WITH {BOTH},
    own AS (SELECT user_id, recording_msid, row_number() OVER (PARTITION BY user_id
            ORDER BY play_count DESC, recording_msid) AS pos FROM train),
    placed AS (SELECT v.user_id, own.pos FROM validation v LEFT JOIN own
               ON own.user_id = v.user_id AND own.recording_msid = v.recording_msid
               AND own.pos <= {c.KS[0]} WHERE v.play_count >= {THRESHOLD}),
    found AS ({metrics_at(c.KS[0], 'placed')}),
    everyone AS (SELECT count(DISTINCT user_id) AS n FROM train),
    raw AS (
      SELECT user_id, n_relevant, n_hits, precise, gain, best FROM (
        SELECT user_id, count(*) AS n_relevant, count(pos) AS n_hits,
               coalesce(sum(nth / pos), 0) AS precise, coalesce(sum(1 / ln(pos + 1)), 0) AS gain
        FROM (SELECT user_id, pos, row_number() OVER (PARTITION BY user_id
              ORDER BY pos NULLS LAST) AS nth FROM placed) AS p GROUP BY user_id) AS u
      JOIN (SELECT n, sum(1 / ln(n + 1)) OVER (ORDER BY n) AS best
            FROM range(1, {c.KS[0] + 1}) AS r(n)) AS ideal ON n = least(n_relevant, {c.KS[0]}))
    SELECT CAST({c.KS[0]} AS INTEGER) AS k, n AS n_users,
           round(sum(precise / least(n_relevant, {c.KS[0]})) / n, 9) AS map,
           round(sum(n_hits / CAST({c.KS[0]} AS DOUBLE)) / n, 9) AS "precision",
           round(sum(gain / best) / n, 9) AS ndcg,
           round(sum(n_hits / n_relevant) / n, 9) AS recall
    FROM raw, everyone GROUP BY n""",
    "rmse_mean_predictor": f"""
    WITH {BOTH}, means AS (SELECT recording_msid, avg(play_count) AS prediction
                           FROM train GROUP BY recording_msid)
    SELECT count(*) AS n_pairs,
           round(sqrt(avg((play_count - prediction) * (play_count - prediction))), 9) AS rmse
    FROM validation JOIN means USING (recording_msid)""",
    "split_stability": f"WITH {RATINGS} " + " UNION ALL ".join(stability(s) for s in c.SEEDS),
    "als_scored_pairs": f"""
    WITH {KNOWN} SELECT user_id, recording_msid, play_count, TRUE AS is_sound FROM checked
    WHERE user_id IN (SELECT user_id FROM fitted)
      AND recording_msid IN (SELECT recording_msid FROM fitted)""",
    "als_top_n_shape": f"""
    WITH {KNOWN}, shown AS (SELECT least({c.KS[0]}, count(DISTINCT recording_msid)) AS n FROM fitted)
    SELECT DISTINCT user_id, n AS n_rows, n AS n_items, CAST(n AS INTEGER) AS last_pos
    FROM checked, shown WHERE user_id IN (SELECT user_id FROM fitted)""",
    "als_metric_users": f"""
    WITH {KNOWN}, known AS (SELECT user_id FROM checked
      WHERE user_id IN (SELECT user_id FROM fitted)
        AND recording_msid IN (SELECT recording_msid FROM fitted))
    SELECT 'known' AS relevant, count(DISTINCT user_id) AS n_users, TRUE AS is_sound FROM known
    UNION ALL SELECT 'all', count(DISTINCT user_id), TRUE FROM checked""",
    "als_tune_points": f"""
    WITH {KNOWN}, known AS (SELECT user_id FROM checked
      WHERE user_id IN (SELECT user_id FROM fitted)
        AND recording_msid IN (SELECT recording_msid FROM fitted)),
    points AS ({POINTS})
    SELECT points.*, (SELECT count(DISTINCT user_id) FROM known) AS n_users, TRUE AS is_sound
    FROM points""",
    "als_scaling_sizes": f"WITH {RATINGS} "
    + " UNION ALL ".join(
        f"SELECT CAST({share} AS DOUBLE) AS fraction, count(*) AS n_pairs, TRUE AS is_sound"
        f" FROM ratings WHERE {bucket('user_id, recording_msid', 1)} < {share}"
        for share in c.FRACTIONS
    ),
    "compare_popularity": f"""
    WITH {RATINGS}, kept AS (SELECT *, {bucket('user_id, recording_msid', c.SEED)} AS drawn
                             FROM ratings WHERE play_count > {THRESHOLD}),
    train AS (SELECT * FROM kept WHERE drawn >= 0.2), test AS (SELECT * FROM kept WHERE drawn < 0.2),
    {scores('train', threshold=1)}, {ranking()}
    {compared('train')} UNION ALL {compared('test')}""",
}
