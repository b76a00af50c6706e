"""Logs, hashes, MinHash arithmetic, schedules and budgets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions import hashes as H
from tidewire.operators import merkle as M
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, revisions, table

_CHAIN = f"""l AS (SELECT conv_id AS log, turn AS idx, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, '{{"log":' || conv_id || ',"role":"' || role || '","turn":' || turn || '}}' AS payload FROM conversations),
    f AS (SELECT log, list(sha256(payload) ORDER BY idx) AS leaves, max(idx) - min(idx) + 1 = count(*) AND min(idx) = 0 AS gapless, count(*) AS entries FROM l GROUP BY log),
    c AS (SELECT log, leaves, gapless, entries, list_reduce(list_prepend('{H.GENESIS}', leaves), lambda acc, x: sha256(unhex(acc) || unhex(x))) AS head FROM f)"""


def _entries(spark, sf):
    payload = H.canonical_json({"log": F.col("article_id"), "role": F.col("role"), "turn": F.col("turn")})
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("article_id"), "role", "turn")
    return t.select(F.col("article_id").alias("log"), F.col("turn").alias("idx"), payload.alias("payload"))


@query(f"WITH {_CHAIN} SELECT log, payload, sha256(payload) AS leaf FROM l", articles=False)
def log_entries(spark, sf):
    """Each entry's canonical payload (keys in order, no white space) and its leaf hash."""
    return _entries(spark, sf).select("log", "payload", F.sha2(F.col("payload").cast("binary"), 256).alias("leaf"))


def _stored_log(spark, sf):
    """Entries as they are stored: (log, idx, payload, leaf, chain). Payloads of every seventh log's second entry were changed since,
    leaves of every eleventh log's third were replaced with their payload, and every thirteenth log lost its second entry."""
    e = _entries(spark, sf).withColumn("leaf", F.sha2(F.col("payload").cast("binary"), 256))
    logs = e.groupBy("log").agg(F.array_sort(F.collect_list(F.struct("idx", "payload", "leaf"))).alias("e"))  # a conversation's turns
    each = logs.select("log", F.explode(F.arrays_zip("e", H.chain(F.transform("e", lambda x: x["leaf"])).alias("c"))).alias("x")).select("log", "x.e.*", F.col("x.c").alias("chain"))
    forged = (F.col("log") % 11 == 0) & (F.col("idx") == 2)
    other = F.when(((F.col("log") % 7 == 0) & (F.col("idx") == 1)) | forged, F.concat("payload", F.lit("!"))).otherwise(F.col("payload"))
    each = each.withColumn("payload", other).withColumn("leaf", F.when(forged, F.sha2(F.col("payload").cast("binary"), 256)).otherwise(F.col("leaf")))
    return each.where("NOT (log % 13 = 0 AND idx = 1)")


@query(f"""WITH {_CHAIN}, s AS (SELECT l.log, idx, payload, sha256(payload) AS leaf, list_reduce(list_prepend('{H.GENESIS}', leaves[1 : place + 1]), lambda acc, x: sha256(unhex(acc) || unhex(x))) AS chain FROM l JOIN f USING (log)),
    q AS (SELECT log, idx, CASE WHEN (log % 7 = 0 AND idx = 1) OR (log % 11 = 0 AND idx = 2) THEN payload || '!' ELSE payload END AS payload, leaf, chain FROM s WHERE NOT (log % 13 = 0 AND idx = 1)),
    r AS (SELECT log, idx, payload, CASE WHEN log % 11 = 0 AND idx = 2 THEN sha256(payload) ELSE leaf END AS leaf, chain, coalesce(lag(chain) OVER w, '{H.GENESIS}') AS before, row_number() OVER w - 1 AS place FROM q WINDOW w AS (PARTITION BY log ORDER BY idx))
    SELECT log, count(*) AS entries, bool_and(idx = place) AS gapless, arg_max(chain, idx) AS head, bool_and(idx = place AND sha256(payload) = leaf AND sha256(unhex(before) || unhex(leaf)) = chain) AS valid FROM r GROUP BY log""")
def chain_verify(spark, sf):
    """Stored logs, each entry held against the one before it alone: its leaf is its payload's, its chain follows, its index is the next."""
    w = Window.partitionBy("log").orderBy("idx")
    e = _stored_log(spark, sf).withColumns({"before": F.coalesce(F.lag("chain").over(w), F.lit(H.GENESIS)), "next": F.coalesce(F.lag("idx").over(w) + 1, F.lit(0))})
    link = F.sha2(F.concat(F.unhex("before"), F.unhex("leaf")), 256)
    ok = (F.col("idx") == F.col("next")) & (F.sha2(F.col("payload").cast("binary"), 256) == F.col("leaf")) & (link == F.col("chain"))
    return e.groupBy("log").agg(F.count("*").alias("entries"), F.bool_and(F.col("idx") == F.col("next")).alias("gapless"), F.max_by("chain", "idx").alias("head"), F.bool_and(ok).alias("valid"))


@query("""WITH RECURSIVE t AS (SELECT 0 AS lvl, list(sha256(coalesce(text, '')) ORDER BY doc_id) AS h FROM documents UNION ALL
    SELECT lvl + 1, list_transform(range(1, len(h) + 1, 2), lambda k: sha256(unhex('01') || unhex(h[k]) || unhex(h[least(k + 1, len(h))]))) FROM t WHERE len(h) > 1) SELECT h[1] AS root, lvl AS levels FROM t WHERE len(h) = 1""")
def legacy_merkle_root(spark, sf):
    """The older tree: leaves without a prefix, an odd level repeats its last node."""
    leaves = table(spark, sf, "documents").select(F.col("doc_id").alias("i"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("h"))
    tree = M.levels(leaves, repeat=True)
    return tree[-1].select(F.col("h").alias("root"), F.lit(len(tree) - 1).alias("levels"))


_PROOF = """WITH RECURSIVE t AS (SELECT 0 AS lvl, list(sha256(unhex('00') || encode(coalesce(text, ''))) ORDER BY doc_id) AS h FROM documents UNION ALL
    SELECT lvl + 1, list_transform(range(1, len(h) + 1, 2), lambda k: CASE WHEN k = len(h) THEN h[k] ELSE sha256(unhex('01') || unhex(h[k]) || unhex(h[k + 1])) END) FROM t WHERE len(h) > 1),
    n AS (SELECT lvl, unnest(range(len(h))) AS i, unnest(h) AS h, len(h) AS size FROM t),
    s AS (SELECT d.doc_id AS i, n.lvl, n.h AS sibling FROM documents d JOIN n ON n.i = xor(d.doc_id >> n.lvl, 1) AND n.size > 1)"""


@query(f"{_PROOF} SELECT d.doc_id AS i, count(s.i) AS steps, sha256(coalesce(string_agg(sibling, '' ORDER BY lvl), '')) AS path_hash, true AS valid FROM documents d LEFT JOIN s ON s.i = d.doc_id GROUP BY d.doc_id")
def inclusion_proofs(spark, sf):
    """Every leaf's audit path, made down the tree level by level, its digest, and whether it folds to the root."""
    leaves = table(spark, sf, "documents").select(F.col("doc_id").alias("i"), M.leaf_hash(F.coalesce("text", F.lit(""))).alias("h"))
    return M.proof_paths(leaves).select("i", F.size("path").cast("long").alias("steps"), F.sha2(F.array_join(F.transform("path", lambda p: p["sibling"]), "").cast("binary"), 256).alias("path_hash"), "valid")


_BOTH = """WITH RECURSIVE t AS (SELECT 'rfc6962' AS scheme, 0 AS lvl, list(sha256(unhex('00') || encode(coalesce(text, ''))) ORDER BY doc_id) AS h FROM documents UNION ALL SELECT 'ct/v1', 0, list(sha256(coalesce(text, '')) ORDER BY doc_id) FROM documents UNION ALL
    SELECT scheme, lvl + 1, list_transform(range(1, len(h) + 1, 2), lambda k: CASE WHEN k < len(h) THEN sha256(unhex('01') || unhex(h[k]) || unhex(h[k + 1])) WHEN scheme = 'ct/v1' THEN sha256(unhex('01') || unhex(h[k]) || unhex(h[k])) ELSE h[k] END) FROM t WHERE len(h) > 1),
    d AS (SELECT doc_id AS i, coalesce(text, '') AS body, count(*) OVER () AS size FROM documents), g AS (SELECT scheme, d.i, lvl, CASE WHEN xor(d.i >> lvl, 1) < len(h) THEN h[xor(d.i >> lvl, 1) + 1] WHEN scheme = 'ct/v1' THEN h[len(h)] END AS sibling FROM d, t WHERE len(h) > 1),
    p AS (SELECT scheme, i, list(sibling ORDER BY lvl) FILTER (WHERE sibling IS NOT NULL) AS path FROM g GROUP BY ALL), r AS (SELECT scheme, h[1] AS root FROM t WHERE len(h) = 1),
    m AS (SELECT scheme, i AS leaf, i % 7 AS fault, CASE WHEN i % 7 = 4 THEN xor(i, 1) ELSE i END AS i, CASE WHEN i % 7 = 3 THEN size * 2 ELSE size END AS size, CASE WHEN i % 7 = 1 THEN body || '.' ELSE body END AS body, CASE WHEN i % 7 = 5 THEN path[1 : len(path) - 1] ELSE path END AS path, CASE WHEN i % 7 = 2 THEN sha256(root) ELSE root END AS root FROM p JOIN d USING (i) JOIN r USING (scheme)),
    l AS (SELECT *, list_filter(range(0, 40), lambda k: ((size - 1) >> k) > 0 AND (scheme = 'ct/v1' OR (i >> k) < ((size - 1) >> k) OR ((size - 1) >> k) % 2 = 1)) AS levels FROM m),
    f AS (SELECT *, CASE WHEN i < size AND len(levels) = len(path) THEN list_reduce(list_prepend(CASE WHEN scheme = 'ct/v1' THEN sha256(body) ELSE sha256(unhex('00') || encode(body)) END, list_transform(list_zip(levels, path), lambda z: CASE WHEN (i >> z[1]) % 2 = 1 THEN 'L' ELSE 'R' END || z[2])), lambda acc, x: CASE WHEN x[1] = 'L' THEN sha256(unhex('01') || unhex(x[2:]) || unhex(acc)) ELSE sha256(unhex('01') || unhex(acc) || unhex(x[2:])) END) END AS got FROM l)"""


@query(f"{_BOTH} SELECT scheme, leaf, fault, coalesce(got = root, false) AS valid, got AS folded FROM f")
def proof_checks(spark, sf):
    """Proofs of every leaf in both schemes, most of them with a fault: another payload, root, size or index, or a sibling less."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("i"), F.coalesce("text", F.lit("")).alias("body"))
    n = docs.count()
    out = None
    for scheme in (M.RFC, M.OLD):
        leaves = docs.select("i", (M.leaf_hash(F.col("body")) if scheme == M.RFC else F.sha2(F.col("body").cast("binary"), 256)).alias("h"))
        root = M.levels(leaves, scheme == M.OLD)[-1].select(F.col("h").alias("root"))
        p = M.proof_paths(leaves, scheme == M.OLD).select("i", F.transform("path", lambda x: x["sibling"]).alias("path")).join(docs, "i").crossJoin(F.broadcast(root))  # one row
        k = F.col("i") % 7
        p = p.select(
            F.lit(scheme).alias("scheme"), F.col("i").alias("leaf"), k.alias("fault"), F.when(k == 4, F.col("i").bitwiseXOR(F.lit(1))).otherwise(F.col("i")).alias("i"), F.when(k == 3, n * 2).otherwise(n).cast("long").alias("size"),
            F.when(k == 1, F.concat("body", F.lit("."))).otherwise(F.col("body")).alias("body"), F.when(k == 5, F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))).otherwise(F.col("path")).alias("path"), F.when(k == 2, F.sha2(F.col("root").cast("binary"), 256)).otherwise(F.col("root")).alias("root"),
        )
        out = p if out is None else out.unionByName(p)
    args = [F.col(c) for c in ("body", "i", "size", "path", "scheme")]
    return out.select("scheme", "leaf", "fault", M.included(*args, F.col("root")).alias("valid"), F.element_at(M.fold_steps(*args), -1).alias("folded"))


@query("""WITH p AS (SELECT conv_id AS id, list_sort(list_distinct(list(CAST(turn AS VARCHAR)))) AS members, count(*) AS n, any_value(role) FILTER (WHERE turn = 0) AS role FROM conversations GROUP BY conv_id),
    c AS (SELECT id, ['analyzer_version=unit/v1', array_to_string(members, chr(30)), coalesce(role, chr(0) || 'none'), 'n=' || n] AS parts FROM p)
    SELECT id, sha256(array_to_string(list_transform(parts, lambda x: lpad(upper(to_hex(octet_length(encode(x)))), 16, '0') || hex(encode(x))), '')) AS hex_hash FROM c""")
def input_hashes(spark, sf):
    """Digests of what a row was made from: parts rendered as text, each behind its length; sets in order, a null as its own token."""
    p = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.collect_set(F.col("turn").cast("string")).alias("members"), F.count("*").alias("n"), F.max(F.when(F.col("turn") == 0, F.col("role"))).alias("role"))
    parts = [F.lit("analyzer_version=unit/v1"), H.rendered_set(F.col("members")), H.rendered(F.col("role")), F.concat(F.lit("n="), F.col("n").cast("string"))]
    return p.select("id", F.sha2(F.hex(H.framed(parts)).cast("binary"), 256).alias("hex_hash"))


@query("""WITH e AS (SELECT event_id AS id, (event_id % 101) / 100.0::DOUBLE AS j, CAST(event_id % 200 AS DOUBLE) AS a, CAST((event_id * 7) % 300 AS DOUBLE) AS b FROM events), x AS (SELECT *, j * (a + b) / (1 + j) AS met, least(a, b) AS small, sqrt(j * (1 - j) / 128) AS sigma FROM e)
    SELECT id, round(met, 6) AS intersection, round(sigma, 6) AS sigma, round(CASE WHEN a <= 0 OR b <= 0 OR j <= 0 THEN 0.0 WHEN j >= 1 THEN 1.0 WHEN met > small AND met - small > 3 * sigma * (a + b) / pow(1 + j, 2) THEN 0.0 ELSE least(1.0, greatest(0.0, met / small)) END, 6) AS containment FROM x""")
def containment_estimates(spark, sf):
    """Containment from an estimated Jaccard: the inversion, its standard error, the clamp and the refusal beyond three errors."""
    n = F.col("event_id")
    e = table(spark, sf, "events").select(n.alias("id"), ((n % 101) / 100.0).alias("j"), (n % 200).cast("double").alias("a"), ((n * 7) % 300).cast("double").alias("b"))
    j, a, b = F.col("j"), F.col("a"), F.col("b")
    return e.select("id", F.round(H.intersection(j, a, b), 6).alias("intersection"), F.round(H.jaccard_sigma(j, 128), 6).alias("sigma"), F.round(H.containment(j, a, b, 128), 6).alias("containment"))


@query(r"""WITH t AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS x, lower(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '')) AS y FROM conversations), w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(x, '[\s\p{Z}]+'), lambda v: v <> '') AS x, list_filter(regexp_split_to_array(y, '[\s\p{Z}]+'), lambda v: v <> '') AS y FROM t),
    s AS (SELECT conv_id, turn, list_distinct(list_transform(range(1, greatest(len(x) - 3, 2)), lambda i: array_to_string(x[i : i + 4], ' '))) AS x, list_distinct(list_transform(range(1, greatest(len(y) - 3, 2)), lambda i: array_to_string(y[i : i + 4], ' '))) AS y FROM w)
    SELECT conv_id, turn, greatest(len(x), len(y)) <= 64 AS exact, CASE WHEN greatest(len(x), len(y)) <= 64 THEN round(len(list_intersect(x, y)) / CAST(least(len(x), len(y)) AS DOUBLE), 6) END AS containment FROM s""")
def containment_dispatch(spark, sf):
    """Containment of each turn's shingles in those of the turn before: exact up to 64 shingles; beyond, by signatures (null here, as those are estimates)."""
    got = H.neighbour_containment(revisions(spark, sf))
    return got.select(F.col("article_id").alias("conv_id"), F.col("revision").alias("turn"), "exact", F.when(F.col("exact"), F.round("containment", 6)).alias("containment"))


@query("SELECT event_id AS id, CASE WHEN event_id % 9 = 0 THEN 0 ELSE least(CAST(60 * pow(2, event_id % 9 - 1) AS BIGINT), 3600) END AS backoff FROM events")
def backoff(spark, sf):
    """Seconds to wait after so many failures in a row: doubling from a minute, an hour at most."""
    n = F.col("event_id") % 9
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.when(n == 0, 0).otherwise(F.least((60 * F.pow(F.lit(2), n - 1)).cast("long"), F.lit(3600))).alias("backoff"))


@query("""WITH s AS (SELECT event_id AS id, epoch(ts) AS now, CASE WHEN event_id % 10 = 0 THEN NULL ELSE epoch(ts) - value * 40 END AS last, CASE WHEN event_id % 4 = 0 THEN epoch(ts) + 5 WHEN event_id % 4 = 1 THEN epoch(ts) - 5 END AS until, event_id % 5 AS quiet, CASE WHEN event_id % 3 = 0 THEN epoch(ts) - value * 40 - event_id % 2 WHEN event_id % 3 = 1 THEN epoch(ts) END AS yield FROM events)
    SELECT id, CASE WHEN now < coalesce(until, 0) THEN false WHEN last IS NULL THEN true ELSE now - last >= CASE WHEN quiet >= 3 THEN 3600 WHEN yield IS NOT NULL AND last >= yield THEN 600 ELSE 900 END END AS due FROM s""")
def poll_due(spark, sf):
    """Feeds that are due: never before a back-off ends; then by an interval that follows what the last poll gave."""
    n, now = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    s = table(spark, sf, "events").select(
        n.alias("id"), now.alias("now"), F.when(n % 10 != 0, now - F.col("value") * 40).alias("last"), F.when(n % 4 == 0, now + 5).when(n % 4 == 1, now - 5).alias("until"), (n % 5).alias("quiet"),
        F.when(n % 3 == 0, now - F.col("value") * 40 - n % 2).when(n % 3 == 1, now).alias("yield"))
    wait = F.when(F.col("quiet") >= 3, 3600).when(F.col("last") >= F.col("yield"), 600).otherwise(900)
    return s.select("id", F.when(F.col("now") < F.coalesce("until", F.lit(0)), False).when(F.col("last").isNull(), True).otherwise(F.col("now") - F.col("last") >= wait).alias("due"))


@query("WITH r AS (SELECT user_id AS feed, event_id AS entry, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS nth FROM events) SELECT feed, count(*) FILTER (WHERE nth <= 10) AS fetched, count(*) FILTER (WHERE nth > 10) AS deferred FROM r GROUP BY feed")
def refresh_cycle(spark, sf):
    """Bodies fetched in a cycle, ten of each feed, newest first; the rest is deferred, not lost."""
    n = table(spark, sf, "events").groupBy(F.col("user_id").alias("feed")).agg(F.count("*").alias("n"))
    return n.select("feed", F.least("n", F.lit(10)).alias("fetched"), F.greatest(F.col("n") - 10, F.lit(0)).alias("deferred"))


@query("""WITH s AS (SELECT event_id AS id, event_id % 4 + 1 AS tier, ts AS now, CASE WHEN event_id % 8 <> 7 THEN value / 2 END AS elapsed FROM events)
    SELECT id, tier, elapsed IS NULL OR elapsed >= CASE tier WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 24 ELSE 6 END AS due, epoch_us(CASE tier WHEN 1 THEN date_trunc('hour', now) + INTERVAL 1 HOUR WHEN 2 THEN date_trunc('day', now) + to_hours((CAST(extract('hour' FROM now) AS BIGINT) // 4 + 1) * 4)
        WHEN 3 THEN date_trunc('day', now) + CASE WHEN date_trunc('day', now) + INTERVAL 6 HOUR <= now THEN INTERVAL 30 HOUR ELSE INTERVAL 6 HOUR END ELSE date_trunc('day', now) + to_hours((CAST(extract('hour' FROM now) AS BIGINT) // 6 + 1) * 6) END) AS next_us FROM s""")
def tier_schedule(spark, sf):
    """Whether a tier is due by the hours since its last run, and its next boundary."""
    n, now = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp"))
    s = table(spark, sf, "events").select(n.alias("id"), (n % 4 + 1).alias("tier"), now.alias("now"), F.when(n % 8 != 7, F.col("value") / 2).alias("elapsed"))
    hour, day = 3_600_000_000, 86_400_000_000
    at = lambda step: (F.floor(F.col("now") / step) + 1) * step
    six = F.floor(F.col("now") / day) * day + 6 * hour
    every = F.when(F.col("tier") == 1, 1).when(F.col("tier") == 2, 4).when(F.col("tier") == 3, 24).otherwise(6)
    nxt = F.when(F.col("tier") == 1, at(hour)).when(F.col("tier") == 2, at(4 * hour)).when(F.col("tier") == 3, F.when(six <= F.col("now"), six + day).otherwise(six)).otherwise(at(6 * hour))
    return s.select("id", "tier", (F.col("elapsed").isNull() | (F.col("elapsed") >= every)).alias("due"), nxt.alias("next_us"))


@query("""WITH l AS (SELECT conv_id AS log, count(*) AS size, CASE WHEN conv_id % 6 = 0 THEN NULL ELSE count(*) - conv_id % 2 END AS published, CASE WHEN conv_id % 6 IN (0, 1) THEN NULL ELSE conv_id % 50 END AS age FROM conversations GROUP BY conv_id)
    SELECT log, size - published AS lag, CASE WHEN age IS NULL AND log % 6 = 1 THEN 'unknown' WHEN age IS NULL THEN 'never' WHEN age > 24 AND NOT coalesce(published >= size, false) THEN 'stale' WHEN coalesce(published >= size, false) THEN 'idle' ELSE 'ok' END AS state, coalesce(age > 48, false) AS warn FROM l""")
def watchdog(spark, sf):
    """State of a log's newest checkpoint: never, unknown, stale (entries wait), idle (it covers all) or ok."""
    n = F.col("log")
    sizes = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("log")).agg(F.count("*").alias("size"))
    s = sizes.select("log", "size", F.when(n % 6 != 0, F.col("size") - n % 2).alias("published"), F.when(~(n % 6).isin(0, 1), n % 50).alias("age"))
    covers = F.coalesce(F.col("published") >= F.col("size"), F.lit(False))
    state = F.when(F.col("age").isNull() & (n % 6 == 1), "unknown").when(F.col("age").isNull(), "never").when((F.col("age") > 24) & ~covers, "stale").when(covers, "idle").otherwise("ok")
    return s.select("log", (F.col("size") - F.col("published")).alias("lag"), state.alias("state"), F.coalesce(F.col("age") > 48, F.lit(False)).alias("warn"))


@query("""WITH s AS (SELECT l_suppkey AS counter, count(*) AS requests, CAST(sum(l_quantity) AS BIGINT) AS tokens, 100 + l_suppkey % 400 * 3 AS request_cap, 3000 + l_suppkey % 5 * 4000 AS token_cap FROM lineitem GROUP BY l_suppkey)
    SELECT counter, tokens, round(tokens * 100.0 / token_cap, 4) AS percent, tokens >= token_cap AS exhausted, tokens >= token_cap AND requests < request_cap * 0.9 AS requests_unspent FROM s""")
def budget_report(spark, sf):
    """Spend against caps, and counters whose tokens are gone while the paired requests are not."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("counter")).agg(F.count("*").alias("requests"), F.sum("l_quantity").cast("long").alias("tokens"))
    n = F.col("counter")
    s = s.withColumns({"request_cap": 100 + n % 400 * 3, "token_cap": 3000 + n % 5 * 4000})
    gone = F.col("tokens") >= F.col("token_cap")
    return s.select("counter", "tokens", F.round(F.col("tokens") * 100.0 / F.col("token_cap"), 4).alias("percent"), gone.alias("exhausted"), (gone & (F.col("requests") < F.col("request_cap") * 0.9)).alias("requests_unspent"))


@query("SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, coalesce(round(sum(value) FILTER (WHERE event_type = 'click'), 4), 0) AS click, coalesce(round(sum(value) FILTER (WHERE event_type = 'purchase'), 4), 0) AS purchase, round(sum(value) / 1000, 6) AS cost FROM events GROUP BY 1")
def daily_cost(spark, sf):
    """Cost of a day, a column for each rung."""
    e = table(spark, sf, "events").select(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400).alias("day"), "event_type", "value")
    own = lambda t: F.coalesce(F.round(F.sum(F.when(F.col("event_type") == t, F.col("value"))), 4), F.lit(0.0)).alias(t)
    return e.groupBy("day").agg(own("click"), own("purchase"), F.round(F.sum("value") / 1000, 6).alias("cost"))


@query("""WITH s AS (SELECT source AS domain, count(*) FILTER (WHERE lang = 'en') AS entries_in_feed, count(*) FILTER (WHERE lang = 'fr' AND n_chars > 2500) AS ok, count(*) FILTER (WHERE lang = 'de') AS feed_ok, count(*) FILTER (WHERE lang = 'es') AS feed_failed FROM documents GROUP BY source),
    t AS (SELECT *, bool_or(entries_in_feed > 0) OVER () AS others FROM s)
    SELECT domain, (entries_in_feed > 0 AND ok = 0) OR (NOT (entries_in_feed > 0 AND ok = 0) AND feed_failed > 0 AND feed_ok = 0) OR (feed_ok > 0 AND entries_in_feed = 0 AND others) AS broken, CASE WHEN entries_in_feed > 0 AND ok = 0 THEN 'extraction failed for all' WHEN feed_failed > 0 AND feed_ok = 0 THEN 'all feeds failed' WHEN feed_ok > 0 AND entries_in_feed = 0 AND others THEN 'zero entries' ELSE '' END AS reason FROM t""")
def broken_sources(spark, sf):
    """Sources that are broken by what their counters say: nothing extracted, no feed answered, or empty feeds while others have entries."""
    n = lambda lang, more=None: F.count_if((F.col("lang") == lang) & (more if more is not None else F.lit(True)))
    s = table(spark, sf, "documents").groupBy(F.col("source").alias("domain")).agg(n("en").alias("entries"), n("fr", F.col("n_chars") > 2500).alias("ok"), n("de").alias("feed_ok"), n("es").alias("feed_failed"))
    t = s.crossJoin(F.broadcast(s.agg(F.bool_or(F.col("entries") > 0).alias("others"))))  # one row
    reason = F.when((F.col("entries") > 0) & (F.col("ok") == 0), "extraction failed for all").when((F.col("feed_failed") > 0) & (F.col("feed_ok") == 0), "all feeds failed").when((F.col("feed_ok") > 0) & (F.col("entries") == 0) & F.col("others"), "zero entries").otherwise("")
    return t.select("domain", (reason != "").alias("broken"), reason.alias("reason"))


@query("SELECT id, CASE id % 4 WHEN 0 THEN 'dropped:too_short' WHEN 1 THEN 'duplicate_of:' || (id - 1) WHEN 2 THEN 'unit:' || (id // 4) ELSE 'story:' || (id % 97) END AS terminal_state FROM a", articles=True)
def terminal_states(spark, sf):
    n = F.col("id")
    s = lambda c: c.cast("string")
    return articles(spark, sf).select("id", F.when(n % 4 == 0, "dropped:too_short").when(n % 4 == 1, F.concat(F.lit("duplicate_of:"), s(n - 1))).when(n % 4 == 2, F.concat(F.lit("unit:"), s(F.floor(n / 4)))).otherwise(F.concat(F.lit("story:"), s(n % 97))).alias("terminal_state"))


@query("SELECT user_id AS run, event_type AS stage, count(*) AS items, count(*) FILTER (WHERE value < 5) AS too_small, count(*) FILTER (WHERE value > 95) AS too_large, min(epoch_us(ts)) AS started, row_number() OVER (PARTITION BY user_id ORDER BY min(epoch_us(ts)), event_type) AS nth FROM events GROUP BY user_id, event_type")
def stage_runs(spark, sf):
    """A run's stages, oldest first, with what each dropped and why."""
    g = table(spark, sf, "events").groupBy(F.col("user_id").alias("run"), F.col("event_type").alias("stage")).agg(
        F.count("*").alias("items"), F.count_if(F.col("value") < 5).alias("too_small"), F.count_if(F.col("value") > 95).alias("too_large"), F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("started"))
    return g.select("*", F.row_number().over(Window.partitionBy("run").orderBy("started", "stage")).alias("nth"))


@query("SELECT reason, count(*) AS stories FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'already_analysed' WHEN o_totalprice > 300000 THEN 'budget_exhausted' WHEN o_orderkey % 10 = 1 THEN 'viewpoint_child' WHEN o_totalprice < 5000 THEN 'too_few_units' ELSE 'processed' END AS reason FROM orders) GROUP BY reason")
def phase2_summary(spark, sf):
    r = F.when(F.col("o_orderstatus") == "F", "already_analysed").when(F.col("o_totalprice") > 300000, "budget_exhausted").when(F.col("o_orderkey") % 10 == 1, "viewpoint_child").when(F.col("o_totalprice") < 5000, "too_few_units").otherwise("processed")
    return table(spark, sf, "orders").groupBy(r.alias("reason")).agg(F.count("*").alias("stories"))


@query("""SELECT 'claims' AS derived, version, count(*) AS n, count(*) FILTER (WHERE version IS NULL OR version NOT IN ('v2', 'v3')) AS stale FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE 'v' || (l_suppkey % 4) END AS version FROM lineitem) GROUP BY GROUPING SETS ((version), ())
    UNION ALL SELECT 'stories', version, count(*), count(*) FILTER (WHERE version IS NULL OR version NOT IN ('v2', 'v3')) FROM (SELECT 'v' || (o_custkey % 4) AS version FROM orders) GROUP BY GROUPING SETS ((version), ())""")
def version_audit(spark, sf):
    """Rows of each derived table by the version that made them, and how many of them are stale, with the tables' totals."""
    claims = table(spark, sf, "lineitem").select(F.lit("claims").alias("derived"), F.when(F.col("l_linenumber") != 7, F.concat(F.lit("v"), (F.col("l_suppkey") % 4).cast("string"))).alias("version"))
    stories = table(spark, sf, "orders").select(F.lit("stories").alias("derived"), F.concat(F.lit("v"), (F.col("o_custkey") % 4).cast("string")).alias("version"))
    rows = claims.unionByName(stories)
    stale = F.col("version").isNull() | ~F.col("version").isin("v2", "v3")
    marked = rows.withColumn("stale", stale)
    return marked.groupingSets([["derived", "version"], ["derived"]], "derived", "version").agg(F.count("*").alias("n"), F.count_if("stale").alias("stale"))
