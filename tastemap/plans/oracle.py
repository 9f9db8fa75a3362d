"""DuckDB SQL equivalents of the registered queries, over the raw parquet views.

Each string is self-contained: it rebuilds the fixture views (E, P, T, V) as CTEs from the
driver's tables. They hold at every scale factor.
"""

from __future__ import annotations

import re

# The sampling parameters and fixture bounds (same as the Spark queries).
ITEM_THRESH, ITEM_SAMPLE_N, USER_THRESH, USER_SAMPLE_N, SEED = 25, 50, 0, 50, 0
ACTIVE_ITEM_THRESH = 30

CTE = {
    "e_raw": """
        SELECT CAST(user_id AS INTEGER) AS user_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
               least(10, floor(value / 10) + 1) / 2 AS rating, ts, event_id
        FROM events""",
    "e": """
        SELECT user_id, item_id, rating, ts FROM e_raw
        QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) = 1""",
    "p_raw": """
        SELECT CAST(o.o_custkey AS INTEGER) AS user_id, CAST(l.l_partkey AS INTEGER) AS item_id,
               ceil(l.l_quantity / 5) / 2 AS rating, l.l_shipdate AS ts, l.l_orderkey, l.l_linenumber
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "p": """
        SELECT user_id, item_id, rating, ts FROM p_raw
        QUALIFY row_number() OVER (PARTITION BY user_id, item_id
                                   ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
    "t": """
        SELECT CAST(vec_id AS INTEGER) AS item_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS tag_id,
               CAST(unnest(embedding) AS DOUBLE) AS relevance
        FROM embeddings""",
    "e_lab": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS _r,
               count(*) OVER (PARTITION BY user_id) AS _n FROM e""",
    "e_train": "SELECT user_id, item_id, rating, ts FROM e_lab WHERE _r <= _n - (_n * 1) // 5",
    "e_test": "SELECT user_id, item_id, rating, ts FROM e_lab WHERE _r > _n - (_n * 1) // 5",
    "p_lab": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS _r,
               count(*) OVER (PARTITION BY user_id) AS _n FROM p""",
    "p_train": "SELECT user_id, item_id, rating, ts FROM p_lab WHERE _r <= _n - (_n * 1) // 5",
    "p_test": "SELECT user_id, item_id, rating, ts FROM p_lab WHERE _r > _n - (_n * 1) // 5",
    "vu": """
        SELECT s.user_id AS id, CAST(v.embedding AS DOUBLE[]) AS f
        FROM (SELECT DISTINCT user_id FROM e_train) s
        JOIN embeddings v ON v.vec_id = (s.user_id + 100) % (SELECT count(*) FROM embeddings)""",
    "vi": """
        SELECT s.item_id AS id, CAST(v.embedding AS DOUBLE[]) AS f
        FROM (SELECT DISTINCT item_id FROM e) s
        JOIN embeddings v ON v.vec_id = s.item_id % (SELECT count(*) FROM embeddings)""",
    "vis": "SELECT id, list_transform(f, lambda x: x * (1 + (id % 7) / 4)) AS f FROM vi",
    # dot scores of E train users x items, seen pairs removed, rounded to 6 places
    "dot": """
        SELECT u.id AS user_id, i.id AS item_id, round(list_dot_product(u.f, i.f), 6) AS score
        FROM vu u CROSS JOIN vi i
        WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = u.id AND t.item_id = i.id)""",
    "e_cat": "SELECT DISTINCT item_id FROM e_test",
    "dot_pop": """
        SELECT * FROM dot WHERE item_id IN (SELECT item_id FROM e_cat)
          AND user_id IN (SELECT user_id FROM e_test)""",
    "bias_um": "SELECT user_id, avg(rating) AS user_mean FROM e_train GROUP BY user_id",
    "bias_im": "SELECT item_id, avg(rating) AS item_mean FROM e_train GROUP BY item_id",
    "bias": """
        SELECT u.user_id, i.item_id, round(i.item_mean + u.user_mean, 6) AS score
        FROM bias_um u CROSS JOIN bias_im i
        WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id)""",
    "knn_d": """
        SELECT u.id AS user_id, i.id AS item_id, round(list_distance(u.f, i.f), 6) AS score
        FROM vu u CROSS JOIN vis i""",
    "knn": """
        SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score, item_id) AS rank
        FROM (SELECT * FROM knn_d QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score, item_id) <= 15) b
        WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = b.user_id AND t.item_id = b.item_id)
        QUALIFY rank <= 10""",
    "knn_full": """
        SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score, item_id) AS rank
        FROM knn_d d WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = d.user_id AND t.item_id = d.item_id)
        QUALIFY rank <= 10""",
    "vu_p": """
        SELECT s.user_id AS id, CAST(v.embedding AS DOUBLE[]) AS f
        FROM (SELECT DISTINCT user_id FROM p_train) s
        JOIN embeddings v ON v.vec_id = (s.user_id + 100) % (SELECT count(*) FROM embeddings)""",
    "vi_p": """
        SELECT s.item_id AS id, CAST(v.embedding AS DOUBLE[]) AS f
        FROM (SELECT DISTINCT item_id FROM p) s
        JOIN embeddings v ON v.vec_id = s.item_id % (SELECT count(*) FROM embeddings)""",
    "vis_p": "SELECT id, list_transform(f, lambda x: x * (1 + (id % 7) / 4)) AS f FROM vi_p",
    "dot_p": """
        SELECT u.id AS user_id, i.id AS item_id, round(list_dot_product(u.f, i.f), 6) AS score
        FROM vu_p u CROSS JOIN vi_p i
        WHERE NOT EXISTS (SELECT 1 FROM p_train t WHERE t.user_id = u.id AND t.item_id = i.id)""",
    "p_cat": "SELECT DISTINCT item_id FROM p_test",
    "p_ranked": """
        SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r
        FROM dot_p WHERE item_id IN (SELECT item_id FROM p_cat)""",
    "knn_scores": "SELECT user_id, item_id, CAST(-rank AS DOUBLE) AS score FROM knn_full",
}

ORDER = list(CTE)


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively), in dependency order."""
    defs = dict(CTE)
    defs.update(extra or {})
    order = ORDER + [k for k in (extra or {}) if k not in CTE]
    need: set[str] = set()
    stack = [body]
    while stack:
        s = stack.pop()
        for n in _deps_in(s, defs):
            if n not in need:
                need.add(n)
                stack.append(defs[n])
    parts = [f"{n} AS ({defs[n]})" for n in order if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _deps_in(sql: str, defs: dict[str, str]) -> set[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    return {n for n in defs if n in words}


def topk_sql(src: str, k: int, score: str = "score") -> str:
    return f"""SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY {score} DESC, item_id) AS rank
        FROM {src} QUALIFY rank <= {k}"""


def recall_cte(pred: str, kt: int, kp: int) -> dict[str, str]:
    return {
        "act": topk_sql("e_test", kt, "rating"),
        "prd": topk_sql(pred, kp),
        "hit": "SELECT a.user_id, a.item_id FROM act a JOIN prd p USING (user_id, item_id)",
        "rpu": f"""
            SELECT n.user_id, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits, n.n_test,
                   coalesce(h.hits, 0) / least({kp}, n.n_test) AS recall
            FROM (SELECT user_id, count(*) AS n_test FROM e_test GROUP BY user_id) n
            LEFT JOIN (SELECT user_id, count(*) AS hits FROM hit GROUP BY user_id) h USING (user_id)""",
    }


def coverage_sql(pred: str, k: int, t: int, kind: str) -> str:
    extra = recall_cte(pred, k, k)
    if kind == "user":
        body = f"""SELECT round(avg(CASE WHEN coalesce(h.n, 0) >= {t} THEN 1.0 ELSE 0.0 END), 6) AS coverage
            FROM (SELECT DISTINCT user_id FROM e_test) u
            LEFT JOIN (SELECT user_id, count(*) AS n FROM hit GROUP BY user_id) h USING (user_id)"""
    else:
        body = f"""SELECT round(avg(CASE WHEN coalesce(h.n, 0) >= {t} THEN 1.0 ELSE 0.0 END), 6) AS coverage
            FROM e_cat c LEFT JOIN (SELECT item_id, count(*) AS n FROM hit GROUP BY item_id) h USING (item_id)"""
    return with_ctes(body, extra)


def dcg_cte(pred: str) -> dict[str, str]:
    """Totals of predicted and ideal gains: scored items by (score desc, item), unscored last
    by item id (computed densely here, as a brute-force check)."""
    return {
        "pop": f"SELECT * FROM {pred} WHERE item_id IN (SELECT item_id FROM e_cat) AND user_id IN (SELECT user_id FROM e_test)",
        "grid": """
            SELECT u.user_id, c.item_id, s.score
            FROM (SELECT DISTINCT user_id FROM e_test) u CROSS JOIN e_cat c
            LEFT JOIN pop s ON s.user_id = u.user_id AND s.item_id = c.item_id""",
        "granked": """
            SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id
                   ORDER BY (score IS NULL), score DESC, item_id) AS r FROM grid""",
        "tot": """
            SELECT (SELECT sum(1 / log2(g.r + 1)) FROM granked g JOIN e_test t USING (user_id, item_id)) AS dcg_sum,
                   (SELECT sum(1 / log2(r + 1)) FROM (SELECT row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS r
                                                      FROM e_test)) AS ideal_sum,
                   (SELECT count(*) FROM e_cat) AS n_catalogue""",
    }


def _hist(values: str, col: str, bins: int) -> str:
    return f"""
        SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_lo,
               round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_hi, count(*) AS n
        FROM (SELECT CASE WHEN s.hi = s.lo THEN 0
                          ELSE CAST(least({bins - 1}, floor(CAST(v.{col} - s.lo AS DOUBLE) * {bins} / CAST(s.hi - s.lo AS DOUBLE))) AS BIGINT)
                     END AS bin, CAST(s.lo AS DOUBLE) AS lo, CAST(s.hi AS DOUBLE) AS hi
              FROM {values} v, (SELECT min({col}) AS lo, max({col}) AS hi FROM {values}) s)
        GROUP BY bin, lo, hi"""


def _bucket(n: str, bounds: list[int]) -> tuple[str, str]:
    gid = "CASE " + " ".join(f"WHEN {n} <= {b} THEN {i + 1}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds) + 1} END"
    labels = [f"0-{bounds[0]}"] + [f"{bounds[i - 1]}-{bounds[i]}" for i in range(1, len(bounds))]
    lab = "CASE " + " ".join(f"WHEN {n} <= {b} THEN '{labels[i]}'" for i, b in enumerate(bounds)) + f" ELSE '{bounds[-1]}+' END"
    return f"CAST({gid} AS INTEGER)", lab


P_USER_BOUNDS = [5, 10, 30, 40, 50, 100]
P_ITEM_BOUNDS = [20, 25, 30, 35, 40, 100]
E_TRAIN_USER_BOUNDS = [30, 35, 40, 45, 100]


def _groups(src: str, by: str, bounds: list[int]) -> str:
    gid, lab = _bucket("n_ratings", bounds)
    return f"SELECT {by}, n_ratings, {gid} AS group_id, {lab} AS group_range FROM (SELECT {by}, count(*) AS n_ratings FROM {src} GROUP BY {by})"


def _draw(ids: str, col: str, n: int) -> str:
    return f"SELECT {col} FROM ({ids}) ORDER BY md5(CAST({col} AS VARCHAR) || '#{SEED}'), {col} LIMIT {n}"


SAMPLE_CTE = {
    "s_items": _draw(f"SELECT item_id FROM p GROUP BY item_id HAVING count(*) > {ITEM_THRESH}", "item_id", ITEM_SAMPLE_N),
    "s_by_items": "SELECT * FROM p WHERE item_id IN (SELECT item_id FROM s_items)",
    "s_users": _draw(f"SELECT user_id FROM s_by_items GROUP BY user_id HAVING count(*) > {USER_THRESH}", "user_id", USER_SAMPLE_N),
    "sample": "SELECT * FROM s_by_items WHERE user_id IN (SELECT user_id FROM s_users)",
}


def _metric_rows(pred: str, model: str, k: int = 10, t: int = 1) -> tuple[dict[str, str], str]:
    """CTEs and a SELECT producing (model, metric, value) rows for one predictor."""
    m = model
    ctes = {
        f"{m}_pop": f"SELECT * FROM {pred} WHERE item_id IN (SELECT item_id FROM e_cat) AND user_id IN (SELECT user_id FROM e_test)",
        f"{m}_prd": topk_sql(f"{m}_pop", k),
        "act10": topk_sql("e_test", k, "rating"),
        f"{m}_hit": f"SELECT a.user_id, a.item_id FROM act10 a JOIN {m}_prd p USING (user_id, item_id)",
        f"{m}_grid": f"""
            SELECT u.user_id, c.item_id, s.score
            FROM (SELECT DISTINCT user_id FROM e_test) u CROSS JOIN e_cat c
            LEFT JOIN {m}_pop s ON s.user_id = u.user_id AND s.item_id = c.item_id""",
        f"{m}_gr": f"""SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id
                   ORDER BY (score IS NULL), score DESC, item_id) AS r FROM {m}_grid""",
    }
    gid, _ = _bucket("n_ratings", E_TRAIN_USER_BOUNDS)
    ctes[f"{m}_rpu"] = f"""
        SELECT n.user_id, coalesce(h.hits, 0) / least({k}, n.n_test) AS recall
        FROM (SELECT user_id, count(*) AS n_test FROM e_test GROUP BY user_id) n
        LEFT JOIN (SELECT user_id, count(*) AS hits FROM {m}_hit GROUP BY user_id) h USING (user_id)"""
    body = f"""
        SELECT '{m}' AS model, 'recall_group_' || g.group_id AS metric, round(avg(r.recall), 6) AS value
        FROM {m}_rpu r JOIN (SELECT user_id, {gid} AS group_id
                             FROM (SELECT user_id, count(*) AS n_ratings FROM e_train GROUP BY user_id)) g USING (user_id)
        GROUP BY g.group_id
        UNION ALL
        SELECT '{m}' AS model, 'recall' AS metric, round(avg(coalesce(h.hits, 0) / least({k}, n.n_test)), 6) AS value
        FROM (SELECT user_id, count(*) AS n_test FROM e_test GROUP BY user_id) n
        LEFT JOIN (SELECT user_id, count(*) AS hits FROM {m}_hit GROUP BY user_id) h USING (user_id)
        UNION ALL
        SELECT '{m}', 'user_coverage', round(avg(CASE WHEN coalesce(h.n, 0) >= {t} THEN 1.0 ELSE 0.0 END), 6)
        FROM (SELECT DISTINCT user_id FROM e_test) u
        LEFT JOIN (SELECT user_id, count(*) AS n FROM {m}_hit GROUP BY user_id) h USING (user_id)
        UNION ALL
        SELECT '{m}', 'item_coverage', round(avg(CASE WHEN coalesce(h.n, 0) >= {t} THEN 1.0 ELSE 0.0 END), 6)
        FROM e_cat c LEFT JOIN (SELECT item_id, count(*) AS n FROM {m}_hit GROUP BY item_id) h USING (item_id)
        UNION ALL
        SELECT '{m}', 'catalog_coverage', round(avg(CASE WHEN coalesce(h.n, 0) >= 1 THEN 1.0 ELSE 0.0 END), 6)
        FROM e_cat c LEFT JOIN (SELECT item_id, count(*) AS n FROM {m}_hit GROUP BY item_id) h USING (item_id)
        UNION ALL
        SELECT '{m}', 'ndcg', round(
            (SELECT sum(1 / log2(g.r + 1)) FROM {m}_gr g JOIN e_test t USING (user_id, item_id)) /
            (SELECT sum(1 / log2(r + 1)) FROM (SELECT row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS r FROM e_test)), 6)"""
    return ctes, body


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["src_interactions"] = with_ctes("SELECT user_id, item_id, rating FROM p")
    q["src_interactions_events"] = with_ctes("SELECT user_id, item_id, rating FROM e")
    q["src_item_tags"] = with_ctes("SELECT item_id, tag_id, relevance FROM t")
    q["src_ratings_csv"] = with_ctes("SELECT user_id, item_id, rating, CAST(epoch(CAST(ts AS TIMESTAMP)) AS BIGINT) AS ts FROM p")
    q["src_tags_csv"] = with_ctes("SELECT item_id, tag_id, relevance FROM t")
    q["tags_of_sampled_items"] = with_ctes("SELECT * FROM t WHERE item_id IN (SELECT item_id FROM sample)", SAMPLE_CTE)
    q["active_items"] = with_ctes(f"SELECT item_id, count(*) AS n_ratings FROM p GROUP BY item_id HAVING count(*) > {ACTIVE_ITEM_THRESH}")
    q["active_users"] = with_ctes("SELECT user_id, count(*) AS n_ratings FROM p GROUP BY user_id HAVING count(*) > 20")
    q["id_dictionary"] = with_ctes(
        "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS pos FROM (SELECT DISTINCT user_id FROM p)"
    )
    q["pivot_user_blocks"] = with_ctes(
        "SELECT item_id, pos // 1000 AS block, list(user_id ORDER BY user_id) AS users, list(rating ORDER BY user_id) AS ratings "
        "FROM e JOIN (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS pos FROM (SELECT DISTINCT user_id FROM e)) USING (user_id) "
        "GROUP BY item_id, pos // 1000"
    )
    q["matrix_shape"] = with_ctes(
        "SELECT count(DISTINCT item_id) AS n_items, count(DISTINCT user_id) AS n_users, count(*) AS n_ratings FROM p"
    )
    q["align_to_catalogue"] = with_ctes("SELECT user_id, item_id, score FROM dot WHERE item_id IN (SELECT item_id FROM e_cat)")
    q["unseen_pairs"] = with_ctes(
        "SELECT user_id, item_id, rating FROM e WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = e.user_id AND t.item_id = e.item_id)"
    )
    q["sample_rsmr"] = with_ctes("SELECT user_id, item_id, rating FROM sample", SAMPLE_CTE)
    q["draw_items"] = with_ctes("SELECT item_id FROM s_items", SAMPLE_CTE)
    q["sample_totals"] = with_ctes(
        "SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(*) AS n_ratings FROM sample", SAMPLE_CTE
    )
    q["split_train"] = with_ctes("SELECT user_id, item_id, rating FROM e_train")
    q["split_test"] = with_ctes("SELECT user_id, item_id, rating FROM e_test")
    q["split_train_p"] = with_ctes("SELECT user_id, item_id, rating FROM p_train")
    q["split_test_p"] = with_ctes("SELECT user_id, item_id, rating FROM p_test")
    q["split_validation"] = with_ctes(
        "SELECT user_id, item_id, rating FROM p_vlab WHERE _r > _n - (_n * 1) // 5",
        {
            "p_vlab": """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS _r,
                   count(*) OVER (PARTITION BY user_id) AS _n FROM p_train"""
        },
    )
    q["split_holdout"] = with_ctes(
        "SELECT user_id, item_id, rating FROM e_train "
        "WHERE substr(md5(CAST(user_id AS VARCHAR) || '#' || CAST(item_id AS VARCHAR) || '#0'), 1, 8) >= 'e6666666'"
    )
    q["user_freq"] = with_ctes("SELECT user_id, count(*) AS n_ratings FROM p GROUP BY user_id")
    q["item_freq"] = with_ctes("SELECT item_id, count(*) AS n_ratings FROM p GROUP BY item_id")
    q["user_groups"] = with_ctes(_groups("p", "user_id", P_USER_BOUNDS))
    q["item_groups"] = with_ctes(_groups("p", "item_id", P_ITEM_BOUNDS))
    q["user_group_counts"] = with_ctes(
        f"SELECT group_id, group_range, count(*) AS n_members FROM ({_groups('p', 'user_id', P_USER_BOUNDS)}) GROUP BY group_id, group_range"
    )
    q["item_group_counts"] = with_ctes(
        f"SELECT group_id, group_range, count(*) AS n_members FROM ({_groups('p', 'item_id', P_ITEM_BOUNDS)}) GROUP BY group_id, group_range"
    )
    q["freq_histogram_users"] = with_ctes(_hist("uf", "n_ratings", 1000), {"uf": "SELECT user_id, count(*) AS n_ratings FROM p GROUP BY user_id"})
    q["freq_histogram_items"] = with_ctes(_hist("itf", "n_ratings", 5000), {"itf": "SELECT item_id, count(*) AS n_ratings FROM p GROUP BY item_id"})
    q["recall_histogram"] = with_ctes(_hist("rpu", "recall", 10), recall_cte("dot_pop", 5, 5))
    q["bias_user_mean"] = with_ctes("SELECT user_id, round(user_mean, 6) AS user_mean FROM bias_um")
    q["bias_item_mean"] = with_ctes("SELECT item_id, round(item_mean, 6) AS item_mean FROM bias_im")
    q["bias_scores"] = with_ctes("SELECT user_id, item_id, score FROM bias")
    q["bias_score_pairs"] = with_ctes(
        """SELECT t.user_id, t.item_id, round(i.item_mean + u.user_mean, 6) AS score
           FROM e_test t JOIN bias_um u USING (user_id) JOIN bias_im i USING (item_id)
           WHERE NOT EXISTS (SELECT 1 FROM e_train r WHERE r.user_id = t.user_id AND r.item_id = t.item_id)"""
    )
    q["bias_topk"] = with_ctes(
        """SELECT user_id, item_id, round(item_mean + user_mean, 6) AS score,
                  row_number() OVER (PARTITION BY user_id ORDER BY item_mean DESC, item_id) AS rank
           FROM bias_um u CROSS JOIN bias_im i
           WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id)
           QUALIFY rank <= 10"""
    )
    q["dot_scores"] = with_ctes("SELECT user_id, item_id, score FROM dot")
    q["candidates_dot"] = with_ctes(
        """SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
           FROM dot QUALIFY rank <= 10"""
    )
    q["knn_exact_budget"] = with_ctes("SELECT user_id, item_id, score, rank FROM knn")
    q["knn_unseen_topk"] = with_ctes(
        """SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score, item_id) AS rank
           FROM knn_d d WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = d.user_id AND t.item_id = d.item_id)
           QUALIFY rank <= 10"""
    )
    q["candidates_dot_p"] = with_ctes(
        """SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
           FROM dot_p QUALIFY rank <= 10"""
    )
    q["knn_unseen_topk_p"] = with_ctes(
        """SELECT u.id AS user_id, i.id AS item_id, round(list_distance(u.f, i.f), 6) AS score,
                  row_number() OVER (PARTITION BY u.id ORDER BY round(list_distance(u.f, i.f), 6), i.id) AS rank
           FROM vu_p u CROSS JOIN vis_p i WHERE NOT EXISTS (SELECT 1 FROM p_train t WHERE t.user_id = u.id AND t.item_id = i.id)
           QUALIFY rank <= 10"""
    )
    q["bias_topk_p"] = with_ctes(
        """SELECT user_id, item_id, round(item_mean + user_mean, 6) AS score,
                  row_number() OVER (PARTITION BY user_id ORDER BY item_mean DESC, item_id) AS rank
           FROM (SELECT user_id, avg(rating) AS user_mean FROM p_train GROUP BY user_id) u
           CROSS JOIN (SELECT item_id, avg(rating) AS item_mean FROM p_train GROUP BY item_id) i
           WHERE NOT EXISTS (SELECT 1 FROM p_train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id)
           QUALIFY rank <= 10"""
    )
    q["align_lists"] = with_ctes(
        """SELECT user_id, item_id, rank FROM (
             SELECT u.id AS user_id, i.id AS item_id, row_number() OVER (PARTITION BY u.id ORDER BY round(list_distance(u.f, i.f), 6), i.id) AS rank
             FROM vu_p u CROSS JOIN vis_p i WHERE NOT EXISTS (SELECT 1 FROM p_train t WHERE t.user_id = u.id AND t.item_id = i.id)
             QUALIFY rank <= 10)
           WHERE item_id IN (SELECT item_id FROM p_cat)"""
    )
    # a test pair is scored: its user is in train and it was not seen; no other case occurs in a split
    q["target_ranks_p"] = with_ctes("SELECT user_id, item_id, true AS is_scored, r FROM p_ranked JOIN p_test USING (user_id, item_id)")
    q["ndcg_p"] = with_ctes(
        """SELECT round((SELECT sum(1 / log2(r + 1)) FROM p_ranked JOIN p_test USING (user_id, item_id)) /
                        (SELECT sum(1 / log2(r + 1)) FROM (SELECT row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS r FROM p_test)), 6) AS ndcg"""
    )
    q["item_tag_vectors"] = with_ctes(
        "SELECT item_id, count(*) AS n_tags, round(sum(relevance * (tag_id + 1)), 6) AS weighted_sum FROM t GROUP BY item_id"
    )
    q["nn_features"] = with_ctes(
        """SELECT r.user_id, r.item_id, r.rating, CAST(len(u.f) + len(i.f) + len(tv.v) AS BIGINT) AS dim,
                  round(list_sum(u.f) + list_sum(i.f) + list_sum(tv.v), 6) AS feature_sum
           FROM e_train r JOIN vu u ON u.id = r.user_id JOIN vi i ON i.id = r.item_id
           JOIN (SELECT item_id, list(relevance ORDER BY tag_id) AS v FROM t GROUP BY item_id) tv ON tv.item_id = r.item_id"""
    )
    q["candidate_labels"] = with_ctes(
        """SELECT c.user_id, c.item_id, c.rank, t.rating
           FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
                 FROM dot QUALIFY rank <= 10) c
           LEFT JOIN e_test t USING (user_id, item_id)"""
    )
    q["candidate_labels_union"] = with_ctes(
        """SELECT c.user_id, c.item_id, t.rating
           FROM (SELECT user_id, item_id FROM dot
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 10) c
           LEFT JOIN e_test t USING (user_id, item_id)"""
    )
    q["rerank_topk"] = with_ctes(
        """SELECT c.user_id, c.item_id, row_number() OVER (PARTITION BY c.user_id ORDER BY d.score DESC, c.item_id) AS rank
           FROM (SELECT user_id, item_id FROM knn_d k
                 WHERE NOT EXISTS (SELECT 1 FROM e_train t WHERE t.user_id = k.user_id AND t.item_id = k.item_id)
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score, item_id) <= 30) c
           JOIN dot d USING (user_id, item_id)
           QUALIFY rank <= 10"""
    )
    q["topk_actual"] = with_ctes(topk_sql("e_test", 5, "rating"))
    q["topk_pred"] = with_ctes(topk_sql("dot_pop", 5))
    q["recall_per_user"] = with_ctes("SELECT user_id, hits, n_test, round(recall, 6) AS recall FROM rpu", recall_cte("dot_pop", 5, 5))
    q["recall_mean"] = with_ctes("SELECT round(avg(recall), 6) AS recall FROM rpu", recall_cte("dot_pop", 10, 10))
    q["recall_loose"] = with_ctes("SELECT round(avg(recall), 6) AS recall FROM rpu", recall_cte("dot_pop", 50, 20))
    gid, lab = _bucket("n_ratings", E_TRAIN_USER_BOUNDS)
    q["recall_by_group"] = with_ctes(
        f"""SELECT g.group_id, g.group_range, round(avg(r.recall), 4) AS recall, count(*) AS n_users
            FROM rpu r JOIN (SELECT user_id, {gid} AS group_id, {lab} AS group_range
                             FROM (SELECT user_id, count(*) AS n_ratings FROM e_train GROUP BY user_id)) g USING (user_id)
            GROUP BY g.group_id, g.group_range""",
        recall_cte("dot_pop", 5, 5),
    )
    q["coverage_user"] = coverage_sql("dot_pop", 10, 1, "user")
    q["coverage_item"] = coverage_sql("dot_pop", 10, 3, "item")
    q["coverage_catalog"] = coverage_sql("dot_pop", 10, 1, "item")
    q["error_metrics"] = with_ctes(
        """SELECT round(avg(abs(t.rating - s.score)), 6) AS mae, round(avg((t.rating - s.score) * (t.rating - s.score)), 6) AS mse,
                  round(sqrt(avg((t.rating - s.score) * (t.rating - s.score))), 6) AS rmse, count(*) AS n_pairs
           FROM e_test t JOIN (SELECT t2.user_id, t2.item_id, i.item_mean + u.user_mean AS score
                               FROM e_test t2 JOIN bias_um u USING (user_id) JOIN bias_im i USING (item_id)) s USING (user_id, item_id)"""
    )
    q["dcg"] = with_ctes("SELECT round(dcg_sum / n_catalogue, 6) AS dcg FROM tot", dcg_cte("dot_pop"))
    q["ndcg"] = with_ctes("SELECT round(dcg_sum / ideal_sum, 6) AS ndcg FROM tot", dcg_cte("dot_pop"))
    q["ndcg_topk_list"] = with_ctes("SELECT round(dcg_sum / ideal_sum, 6) AS ndcg FROM tot", dcg_cte("knn_scores"))
    ctes: dict[str, str] = {}
    bodies = []
    for pred, m in (("bias", "bias"), ("dot", "dot"), ("knn_scores", "knn")):
        c, b = _metric_rows(pred, m)
        ctes.update(c)
        bodies.append(b)
    q["model_comparison"] = with_ctes("\nUNION ALL\n".join(bodies), ctes)
    q.update(_model_oracle())
    return q


def _lists(train: str, k: int, items: str, also: str) -> str:
    """What a list of the k best unseen items must be, for every train user."""
    return f"""SELECT true AS {also}, s.user_id, least({k}, (SELECT count(*) FROM ({items})) - s.n) AS n_items, true AS all_unseen, true AS items_differ,
               true AS ranks_complete, true AS scores_finite
        FROM (SELECT user_id, count(DISTINCT item_id) AS n FROM {train} GROUP BY user_id) s
        WHERE (SELECT count(*) FROM ({items})) > s.n"""


def _mlp_passes() -> dict[str, str]:
    """Forward pass, gradient and one training step of the 128-4-2-1 network on fixed weights."""
    d, h1, h2, lr = 128, 4, 2, 0.1
    theta = [((7919 * p) % 201 - 100) / 1000 for p in range(d * h1 + h1 + h1 * h2 + h2 + h2 + 1)]
    b1, w2, b2, w3, b3 = d * h1, d * h1 + h1, d * h1 + h1 + h1 * h2, d * h1 + h1 + h1 * h2 + h2, d * h1 + h1 + h1 * h2 + 2 * h2
    lit = lambda v: f"CAST({v!r} AS DOUBLE)"

    def passes(rows: str) -> str:
        first = ", ".join(f"greatest(list_dot_product(x, [{', '.join(lit(theta[i * h1 + j]) for i in range(d))}]) + {lit(theta[b1 + j])}, 0) AS a{j}" for j in range(h1))
        second = ", ".join("greatest(" + " + ".join(f"a{j} * {lit(theta[w2 + j * h2 + k])}" for j in range(h1)) + f" + {lit(theta[b2 + k])}, 0) AS c{k}" for k in range(h2))
        out = " + ".join(f"c{k} * {lit(theta[w3 + k])}" for k in range(h2)) + f" + {lit(theta[b3])}"
        x = f"SELECT r.user_id, r.item_id, r.rating, list_concat(u.f, i.f) AS x FROM {rows} r JOIN vu u ON u.id = r.user_id JOIN vi i ON i.id = r.item_id"
        return f"SELECT *, {out} AS p FROM (SELECT *, {second} FROM (SELECT *, {first} FROM ({x})))"

    back = f"SELECT *, 2 * (p - rating) / (SELECT count(*) FROM fwd) AS e FROM fwd"
    back = f"SELECT *, {', '.join(f'CASE WHEN c{k} > 0 THEN e * {lit(theta[w3 + k])} ELSE 0 END AS d{k}' for k in range(h2))} FROM ({back})"
    hidden = lambda j: " + ".join(f"d{k} * {lit(theta[w2 + j * h2 + k])}" for k in range(h2))
    back = f"SELECT *, {', '.join(f'CASE WHEN a{j} > 0 THEN {hidden(j)} ELSE 0 END AS g{j}' for j in range(h1))} FROM ({back})"
    at = lambda pos, expr: f"SELECT CAST({pos} AS BIGINT) AS pos, sum({expr}) AS grad FROM bwd"
    parts = [f"SELECT CAST((k - 1) * {h1} + {j} AS BIGINT) AS pos, sum(v * g{j}) AS grad FROM (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS k, g{j} FROM bwd) GROUP BY k" for j in range(h1)]
    parts += [at(b1 + j, f"g{j}") for j in range(h1)]
    parts += [at(w2 + j * h2 + k, f"a{j} * d{k}") for j in range(h1) for k in range(h2)] + [at(b2 + k, f"d{k}") for k in range(h2)]
    parts += [at(w3 + k, f"c{k} * e") for k in range(h2)] + [at(b3, "e")]
    grad = {"fwd": passes("e_train"), "bwd": back, "grads": " UNION ALL ".join(parts)}
    # the first Adam step: moments m = (1 - b1) g, v = (1 - b2) g^2, rate lr * sqrt(1 - b2) / (1 - b1)
    step = f"{lr} * sqrt(1 - 0.999) / (1 - 0.9) * ((1 - 0.9) * grad) / (sqrt((1 - 0.999) * grad * grad) + 1e-7)"
    start = f"((7919 * pos) % 201 - 100) / 1000"
    return {
        "mlp_forward": f"SELECT user_id, item_id, rating, round(p, 6) AS score FROM ({passes('e_test')})",
        "mlp_gradient": with_ctes("SELECT pos, round(grad, 6) + 0.0 AS grad FROM grads", grad),
        "mlp_step": with_ctes(f"SELECT pos, round({start} - {step}, 5) AS weight FROM grads", grad),
    }


def _model_oracle() -> dict[str, str]:
    """Properties of right results of the fitted models (see ``model_queries``)."""
    e_items, p_items = "SELECT DISTINCT item_id FROM e_train", "SELECT DISTINCT item_id FROM p_train"
    q = {
        "als_user_factors": "SELECT DISTINCT user_id AS id, CAST(10 AS BIGINT) AS dim, true AS solves FROM e_train",
        "als_item_factors": "SELECT DISTINCT item_id AS id, CAST(10 AS BIGINT) AS dim, true AS solves FROM e_train",
        "als_predict_pairs": """SELECT user_id, item_id, rating, true AS is_dot_product FROM e_test
            WHERE user_id IN (SELECT user_id FROM e_train) AND item_id IN (SELECT item_id FROM e_train)""",
        "mlp_fit_history": "SELECT CAST(unnest(range(1, 33)) AS INTEGER) AS epoch, true AS loss_falls, true AS loss_ok, true AS mae_ok, true AS val_loss_ok, true AS val_mae_ok",
        "mlp_scores": "SELECT user_id, item_id, rating, true AS is_forward_pass FROM e_test WHERE user_id IN (SELECT id FROM vu) AND item_id IN (SELECT id FROM vi)",
        "mlp_eval": """SELECT count(*) AS n, true AS mse_ok, true AS mae_ok FROM e_test
            WHERE user_id IN (SELECT id FROM vu) AND item_id IN (SELECT id FROM vi)""",
        "knn_lsh": _lists("e_train", 10, "SELECT id FROM vi", "recall_ok"),
        "pipeline_ann_nn_p": _lists("p_train", 10, p_items, "reranked"),
        "pipeline_ann_nn_tags_p": _lists("p_train", 10, p_items, "reranked"),
    }
    for name in ("candidates_als", "knn_als"):
        q[name] = _lists("e_train", 10, e_items, "optimal")
    for name in ("pipeline_mf_nn", "pipeline_mf_nn_tags", "pipeline_ann_nn", "pipeline_ann_nn_tags"):
        q[name] = _lists("e_train", 10, e_items, "reranked")
    q.update(_mlp_passes())
    out = {name: body if body.lstrip().startswith("WITH") else with_ctes(body) for name, body in q.items()}
    ok = "true AS metric_ok, true AS best_ok"
    axis = lambda name, *v: f"(SELECT unnest([{', '.join(map(str, v))}]) AS {name})"
    reg = "(SELECT unnest([CAST(0.1 AS DOUBLE), CAST(0.01 AS DOUBLE)]) AS reg)"
    out["tune_als_cv"] = f"SELECT *, {ok} FROM {axis('max_iter', 5, 15, 25)}, {reg}, {axis('rank', 5, 10, 15)}"
    out["tune_knn_grid"] = f"SELECT *, {ok} FROM {axis('max_iter', 5, 10, 15)}, {axis('rank', 5, 10, 20)}"
    out["tune_ann_nn_grid"] = f"SELECT *, {ok} FROM {axis('max_iter', 2, 5, 10, 15)}, {axis('rank', 5, 10, 15, 20)}, {axis('prerank_k', 20, 30, 50)}"
    for name in ("tune_mf_nn_grid", "tune_mf_nn_grid_tags"):
        out[name] = f"SELECT *, {ok} FROM {axis('max_iter', 5, 15, 25)}, {reg}, {axis('k', 20, 30, 50)}, {axis('rank', 10, 15, 20)}"
    return out
