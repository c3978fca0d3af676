"""DuckDB SQL for the queries whose result SQL can express."""

_SPACES = r"[\x20\x09-\x0D]+"
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_NORM} AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.t) AS text_sha256
        FROM t JOIN g ON t.t = g.t
    """,
    "op13_filter_audit": f"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{_SPACES}') IF x <> ''] AS w
            FROM documents),
        f AS (
            SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
                   (len(w) < 100)::INT AS a, (100 * len(list_distinct(w)) < 80 * len(w))::INT AS b,
                   (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT AS c,
                   regexp_matches(t, '[#$%&*|]')::INT AS d,
                   coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS e
            FROM d LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
                              FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
        cells AS (
            SELECT part, [a, b, c, d, e] AS v, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM f GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
        steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders),
        judged AS (
            SELECT part, filter_order, step, n, good, toxic, v[ascii(filter_order[step]) - 64] = 1 AS fails,
                   len([i FOR i IN range(1, step) IF v[ascii(filter_order[i]) - 64] = 1]) > 0 AS earlier,
                   list_sum(v) AS failures
            FROM cells, steps),
        counted AS (
            SELECT part, filter_order, step,
                   coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (fails AND NOT earlier), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (fails AND earlier), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (fails AND failures = 1), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (fails AND NOT earlier), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0)::BIGINT AS toxic_lost
            FROM judged GROUP BY ALL)
        SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM counted
    """,
}
