"""DuckDB SQL of the queries that SQL can express over whole tables."""

_SPACE = "[\\x20\\x09-\\x0D]"

def _vector_codes() -> str:
    """Four parts, 256 entries, four rounds, written out round by round."""
    near = "min(struct_pack(d := list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := c.entry)) AS x"
    steps = ["c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256))"]
    for r in range(4):
        steps += [
            f"a{r} AS MATERIALIZED (SELECT p.vec_id, p.part, {near} FROM p JOIN c{r} AS c USING (part) GROUP BY p.vec_id, p.part)",
            f"u{r} AS (SELECT part, entry, list(m ORDER BY i) AS v FROM (SELECT a.part, a.x.e AS entry, i, CAST(floor(sum(p.v[i]) / count(*)) AS BIGINT) AS m FROM a{r} AS a JOIN p USING (vec_id, part), range(1, 17) AS t(i) GROUP BY ALL) GROUP BY part, entry)",
            f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(u.v, c.v) AS v FROM c{r} AS c LEFT JOIN u{r} AS u USING (part, entry))",
        ]
    return f"""
        WITH k AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS MATERIALIZED (SELECT vec_id, part, v[16 * part + 1 : 16 * part + 16] AS v FROM k, range(4) AS t(part)), {", ".join(steps)},
        z AS (SELECT p.vec_id, p.part, {near} FROM p JOIN c4 AS c USING (part) GROUP BY p.vec_id, p.part),
        h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c4),
        s AS (SELECT vec_id, string_agg(printf('%02x', x.e), '' ORDER BY part) AS code, CAST(sum(x.d) AS BIGINT) AS error FROM z GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM s JOIN k USING (vec_id), h
    """


ORACLES = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS s FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, s AS text_sha256
        FROM d WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id)
    """,
    "op10_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
        ), k AS (
            SELECT *, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), r AS (
            SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)
        ), m AS (
            SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.least AS lost FROM k LEFT JOIN r USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        p AS (SELECT doc_id, n, a, substring(t, 2 * a + 1, 2098) AS t FROM (SELECT doc_id, n, t, unnest(range(0, n, 1000)) AS a FROM d)),
        w AS (SELECT doc_id, a + i AS i, sha256(substring(t, 2 * i + 1, 100)) AS s FROM (SELECT doc_id, a, t, unnest(range(least(1000, n - 49 - a))) AS i FROM p WHERE n - 49 > a)),
        m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
        g AS (SELECT w.doc_id, w.i FROM w JOIN m USING (s) WHERE w.doc_id > m.least),
        b AS (SELECT doc_id, a + i AS i, substring(t, 2 * i + 1, 2) AS x FROM (SELECT doc_id, a, t, unnest(range(least(1000, n - a))) AS i FROM p)),
        c AS (SELECT b.doc_id, b.i, x, max(g.i) OVER (PARTITION BY b.doc_id ORDER BY b.i) AS last FROM b LEFT JOIN g ON g.doc_id = b.doc_id AND g.i = b.i),
        f AS (SELECT *, coalesce(last > i - 50, false) AS gone FROM c),
        e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM f)
        SELECT d.doc_id, max(d.n) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
               sha256(unhex(coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone), ''))) AS kept_sha256
        FROM d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id
    """,
    "op4_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, i, sha256(array_to_string(ws[i + 1 : i + 20], ' ')) AS s FROM (SELECT doc_id, ws, unnest(range(len(ws) - 19)) AS i FROM d WHERE len(ws) >= 20)),
        g AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
        b AS (SELECT doc_id, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM d),
        c AS (SELECT b.doc_id, b.i, b.x, max(g.i) OVER (PARTITION BY b.doc_id ORDER BY b.i) AS last FROM b LEFT JOIN g ON g.doc_id = b.doc_id AND g.i = b.i),
        f AS (SELECT *, coalesce(last > i - 20, false) AS gone FROM c)
        SELECT d.doc_id, max(len(ws)) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
    """,
    "op13_filter_audit": """
        WITH RECURSIVE o(filter_order) AS (
            SELECT '' UNION ALL SELECT filter_order || f FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f) WHERE NOT contains(filter_order, f)
        ), s AS (
            SELECT filter_order, step, filter_order[:step - 1] AS past, filter_order[step] AS f FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5
        ), d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), l AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id
        ), x AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY sha256(t)) THEN 'E' ELSE '' END AS fails
            FROM d LEFT JOIN l USING (doc_id)
        ), c AS (
            SELECT part, fails, good, toxic, count(*) AS n FROM x GROUP BY ALL
        ), g AS (
            SELECT part, filter_order, step, f, n, fails, good, toxic, contains(fails, f) AS now, past <> '' AND regexp_matches(fails, '[' || past || 'x]') AS earlier FROM c, s
        ), e AS (
            SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT now), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT earlier AND now), 0) AS removed,
                   coalesce(sum(n) FILTER (WHERE earlier AND now), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails = f), 0) AS unique_fails,
                   coalesce(sum(n) FILTER (WHERE NOT earlier AND now AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (WHERE NOT earlier AND now AND toxic = 1), 0) AS toxic_lost
            FROM g GROUP BY part, filter_order, step, f
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM e
    """,
    "op11_vector_codes": _vector_codes(),
}
