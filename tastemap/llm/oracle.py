"""DuckDB SQL for the queries that SQL can express, over the raw tables."""

from __future__ import annotations

from tastemap.llm import centroids, chat, codes, secrets

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
sides AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(id, r) AS (SELECT x, x FROM sides UNION SELECT reach.id, sides.y FROM reach JOIN sides ON sides.x = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT id, min(r) AS m FROM reach GROUP BY id) c ON c.id = d.doc_id"""

OP2 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
first AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (h) WHERE f < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM each e
         WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = e.doc_id AND g.p = e.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id"""

OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, i, substr(x, 2 * i - 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - 48)) AS i FROM d)),
first AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (s) WHERE f < doc_id),
spans AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS spans
          FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, p, substr(x, 2 * p - 1, 2) AS b FROM (SELECT d.doc_id, x, unnest(range(1, len(x) // 2 + 1)) AS p
          FROM d JOIN spans ON spans.doc_id = d.doc_id)),
kept AS (SELECT doc_id, string_agg(b, '' ORDER BY p) AS x FROM bytes e
         WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = e.doc_id AND g.p = e.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN s.doc_id IS NULL THEN d.x ELSE coalesce(kept.x, '') END)) AS kept_sha256
FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

OP6 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, i, i + 12), ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM iw))),
hits AS (SELECT doc_id, k, i, item_id FROM dw JOIN iw USING (k, win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(coalesce(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL), [])) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(cov.n > 0 AND 20 * cov.n >= len(w), false) AS contaminated
FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""

OP7 = """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS last,
             strlen(h) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY h) AS again
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))"""


def _op9() -> str:
    """Spans from the pieces between matches; a token is a maximal run with all three kinds of characters."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    token = "[A-Za-z0-9_/+-]{20,}"
    kinds = [
        ("assign", secrets.ASSIGN, 2, f"length(v) >= {secrets.ASSIGN_LEN}"),
        ("access", secrets.ACCESS, 0, f"length(v) >= {secrets.ACCESS_LEN}"),
        ("hex", secrets.HEX, 0, f"length(v) >= {secrets.HEX_LEN}"),
        ("token", token, 0, "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"),
    ]
    parts = []
    for i, (kind, pattern, group, keep) in enumerate(kinds):
        p = quote(pattern)
        parts.append(
            f"""SELECT doc_id, owner, {i} AS o, '{kind}' AS kind, v, before + coalesce(list_sum(list_transform(list_slice(m, 1, j - 1), lambda x: length(x))), 0) AS a, length(m[j]) AS n
            FROM (SELECT doc_id, owner, m, j, g[j] AS v, list_sum(list_transform(list_slice(s, 1, j), lambda x: length(x))) AS before
                  FROM (SELECT doc_id, owner, m, g, s, unnest(range(1, len(m) + 1)) AS j
                        FROM (SELECT doc_id, owner, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS g, string_split_regex(t, {p}) AS s FROM d)))
            WHERE {keep}"""
        )
    return f"""
WITH d AS (SELECT doc_id, source AS owner, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
spans AS (SELECT doc_id, o, kind, v, CAST(a AS BIGINT) AS a, CAST(a + n AS BIGINT) AS e, owner FROM found),
freq AS (SELECT v, count(DISTINCT coalesce(owner, chr(1))) AS owners FROM spans GROUP BY v),
judged AS (SELECT s.*, owners <= {secrets.MAX_OWNERS} AS live, kind || ':' || a || ':' || e AS line FROM spans s JOIN freq USING (v)),
per AS (SELECT doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
               string_agg(line, ',' ORDER BY a, o) FILTER (WHERE o < 3) AS base, string_agg(line, ',' ORDER BY a, o) FILTER (WHERE o < 3 OR live) AS spans,
               count(*) FILTER (WHERE live) AS n_live
        FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN per ON per.doc_id = d.doc_id"""


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
DISTANCE = "list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)"  # of integers in doubles: exact


def _means(rows: str, key: str) -> str:
    """(key, c): componentwise floor(sum / count) of the vectors ``x`` of ``rows`` by ``key``."""
    return f"""SELECT {key}, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY k) AS c
        FROM (SELECT {key}, k, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (SELECT {key}, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM {rows}) GROUP BY {key}, k) GROUP BY {key}"""


def _op11() -> str:
    assign = lambda i: f"""a{i} AS MATERIALIZED (SELECT vec_id, x, j, c, d FROM (SELECT vec_id, x, j, c, {DISTANCE} AS d, r FROM q CROSS JOIN c{i})
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)"""  # noqa: E731
    steps = []
    for i in range(centroids.ROUNDS):
        steps += [assign(i), f"m{i} AS MATERIALIZED ({_means(f'a{i}', 'j')})", f"c{i + 1} AS MATERIALIZED (SELECT o.j, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (j))"]
    last = centroids.ROUNDS
    key = f"sha256('{centroids.SEED}:' || vec_id)"
    return f"""
WITH q AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {centroids.SCALE})) AS x
     FROM embeddings WHERE len(embedding) = {centroids.DIM} AND {FINITE}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {key}, x) - 1 AS INTEGER) AS j, x AS c FROM q QUALIFY j < {centroids.K}),
{", ".join(steps)}, {assign(last)}
SELECT vec_id, j AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{last}"""


def _op12() -> str:
    assign = lambda i: f"""a{i} AS MATERIALIZED (SELECT r, p, x, e, d FROM (SELECT r, q.p, x, e, {DISTANCE} AS d FROM q JOIN b{i} b ON b.p = q.p)
        QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""  # noqa: E731
    steps = []
    for i in range(codes.ROUNDS):
        steps += [assign(i), f"m{i} AS MATERIALIZED ({_means(f'a{i}', 'p, e')})",
                  f"b{i + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM b{i} o LEFT JOIN m{i} m ON m.p = o.p AND m.e = o.e)"]
    n, last = codes.PARTS, codes.ROUNDS
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS r, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {codes.SCALE})) AS x
     FROM embeddings WHERE {FINITE}),
q AS MATERIALIZED (SELECT r, p, list_slice(x, p * len(x) // {n} + 1, (p + 1) * len(x) // {n}) AS x FROM (SELECT r, x, unnest(range({n})) AS p FROM v)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM q WHERE r <= {codes.ENTRIES}),
{", ".join(steps)}, {assign(last)},
book AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS h FROM b{last}),
per AS (SELECT r, string_agg(lower(printf('%02x', CAST(e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN per USING (r) CROSS JOIN book"""


def _op13() -> str:
    header = "CASE " + " ".join(f"WHEN role = '{r}' THEN {len(t) + 6}" for r, t in chat.ROLES.items()) + " ELSE 12 + 2 * strlen(role) END"
    return rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
each AS (SELECT conv_id, turn, role, text, CASE WHEN role = '{chat.LEARNED}' THEN text ELSE '' END AS l,
                {header} + length(text) + len(regexp_extract_all(text, '{chat.CONTROL}')) + {len(chat.END)} AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(l)) AS BIGINT) AS loss_chars, sha256(string_agg(l, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS n_tokens
FROM each GROUP BY conv_id"""


def oracle() -> dict[str, str]:
    return {
        "op1_jaccard_join": OP1,
        "op2_substring_dedup": OP2,
        "op4_suffix_array_dedup": OP4,
        "op6_benchmark_decontamination": OP6,
        "op7_warc": OP7,
        "op9_secret_scans": _op9(),
        "op11_centroid_clustering": _op11(),
        "op12_vector_compression": _op12(),
        "op13_chat_formatting": _op13(),
    }
