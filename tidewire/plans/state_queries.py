"""Maintenance, lookups by dimension, details, audits of the model itself, answers in JSON, and scores."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions import extract as X
from tidewire.functions import hashes as H
from tidewire.functions import text as T
from tidewire.functions import url as U
from tidewire.operators import corpus as CO
from tidewire.operators import dimensions as D
from tidewire.operators import merkle as M
from tidewire.operators import vectors as V
from tidewire.plans.graph_queries import _LK, links
from tidewire.plans.registry import query
from tidewire.plans.text_queries import _CANONICAL
from tidewire.sources.tables import articles, revisions, spread, table

_HOSTS = """hs AS (SELECT page_id, lower(regexp_extract(trim(url), '^https?://([^/?#:]*)', 1)) AS host FROM pages), kn AS (SELECT known, 'group' || (length(known) % 5) AS owner, row_number() OVER (ORDER BY known) AS ordinal FROM (SELECT DISTINCT array_to_string(string_split(host, '.')[-2:], '.') AS known FROM hs WHERE page_id % 3 > 0))"""


@query(f"WITH {_HOSTS}, m AS (SELECT page_id, arg_min(owner, (host <> known, ordinal)) AS owner FROM hs JOIN kn ON host = known OR ends_with(host, '.' || known) GROUP BY page_id) SELECT page_id, host, coalesce(owner, 'Independent') AS owner FROM hs LEFT JOIN m USING (page_id)")
def owner_groups(spark, sf):
    """Owners of domains, by the domain itself or the first known one above it."""
    hs = table(spark, sf, "pages").select("page_id", F.lower(F.regexp_extract(F.trim("url"), "^https?://([^/?#:]*)", 1)).alias("host"))
    known = hs.where("page_id % 3 > 0").select(F.substring_index("host", ".", -2).alias("known")).distinct()
    owners = known.select("known", F.concat(F.lit("group"), (F.length("known") % 5).cast("string")).alias("owner"), F.col("known").alias("ordinal"))
    return D.owner_groups(hs, "host", owners).select("page_id", "host", "owner")


@query("WITH k AS (SELECT DISTINCT source AS known, 1 + CAST(substring(source, 4) AS INTEGER) % 4 AS tier FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 3 > 0 UNION SELECT DISTINCT source, 4 FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 2 = 0), b AS (SELECT known, min(tier) AS tier FROM k GROUP BY known) SELECT doc_id, source, coalesce(tier, 3) AS tier FROM documents LEFT JOIN b ON known = source")
def source_tiers(spark, sf):
    """Tiers of domains: of several lists the first, else the third."""
    n = F.substring("source", 4, 9).cast("int")
    docs = table(spark, sf, "documents")
    known = docs.where(n % 3 > 0).select(F.col("source").alias("known"), (1 + n % 4).alias("tier")).unionByName(docs.where(n % 2 == 0).select(F.col("source").alias("known"), F.lit(4).alias("tier"))).distinct()
    return D.tiers(docs.select("doc_id", "source"), "source", known, 3).select("doc_id", "source", "tier")


@query("""WITH n AS (SELECT n_nationkey AS code, CASE n_nationkey % 4 WHEN 0 THEN n_name || ', South' WHEN 1 THEN 'The ' || n_name || ' (North)' WHEN 2 THEN 'the ' || n_name ELSE n_name END AS name FROM nation),
    v AS (SELECT code, unnest(list_distinct(list_filter([lower(name), CASE WHEN contains(name, ',') THEN trim(split_part(lower(name), ',', 2)) || ' ' || trim(split_part(lower(name), ',', 1)) END, trim(regexp_replace(lower(name), '\\s*\\(.*?\\)', '')), trim(regexp_replace(lower(name), '^the\\s+', ''))], lambda x: x IS NOT NULL AND x <> ''))) AS variant FROM n)
    SELECT variant, min(code) AS code FROM v GROUP BY variant""".replace("\\\\", "\\"))
def name_index(spark, sf):
    """Spellings of places and the code of the first place that has them."""
    k = F.col("n_nationkey")
    name = F.when(k % 4 == 0, F.concat("n_name", F.lit(", South"))).when(k % 4 == 1, F.concat(F.lit("The "), "n_name", F.lit(" (North)"))).when(k % 4 == 2, F.concat(F.lit("the "), "n_name")).otherwise(F.col("n_name"))
    return table(spark, sf, "nation").select(k.alias("code"), F.explode(D.name_variants(name)).alias("variant")).groupBy("variant").agg(F.min("code").alias("code"))


@query("WITH d AS (SELECT source AS domain, lang, count(*) AS n FROM documents GROUP BY ALL), m AS (SELECT domain, arg_max(lang, (n, lang)) AS lang, sum(n) AS n FROM d GROUP BY domain), t AS (SELECT lang, sum(n) AS articles, count(*) AS domains FROM m GROUP BY lang) SELECT lang, articles::BIGINT AS articles, domains, round(articles * 100.0 / sum(articles) OVER (), 6) AS share FROM t")
def language_share(spark, sf):
    """Articles by the language that their domain mostly writes in."""
    m = table(spark, sf, "documents").groupBy(F.col("source").alias("domain"), "lang").agg(F.count("*").alias("n")).groupBy("domain").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"), F.sum("n").alias("n"))
    t = m.groupBy("lang").agg(F.sum("n").alias("articles"), F.count("*").alias("domains"))
    return t.crossJoin(F.broadcast(t.agg(F.sum("articles").alias("all")))).select("lang", "articles", "domains", F.round(F.col("articles") * 100.0 / F.col("all"), 6).alias("share"))  # one row


@query(f"WITH {_LK}, u AS (SELECT story, count(DISTINCT unit) AS units, count(DISTINCT unit) FILTER (WHERE tier = 1) AS tier1, count(DISTINCT source) AS sources FROM lk GROUP BY story) SELECT story, sources, tier1, round(CASE WHEN units > 0 THEN tier1 / CAST(units AS DOUBLE) ELSE 0.0 END, 6) AS confidence FROM u")
def story_events(spark, sf):
    """The map event of a story: its counts, and tier-1 units over all as confidence."""
    u = links(spark, sf).groupBy("story").agg(F.countDistinct("unit").alias("units"), F.countDistinct(F.when(F.col("tier") == 1, F.col("unit"))).alias("tier1"), F.countDistinct("source").alias("sources"))
    return u.select("story", "sources", "tier1", F.round(F.coalesce(F.try_divide("tier1", "units"), F.lit(0.0)), 6).alias("confidence"))


@query(f"WITH RECURSIVE {_CANONICAL}, f AS (SELECT canonical, min(page_id) AS first_page FROM c GROUP BY canonical) SELECT c.page_id AS subject, first_page AS object, 'same_event_as' AS predicate FROM c JOIN f USING (canonical) WHERE page_id <> first_page AND page_id % 10 <> 3")
def same_url_edges(spark, sf):
    """Edges from each page to the first of its address, but those that exist already (here every tenth)."""
    c = table(spark, sf, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"))
    edges = c.join(c.groupBy("canonical").agg(F.min("page_id").alias("object"), F.count("*").alias("n")).where("n > 1").drop("n"), "canonical").where("page_id <> object").select(F.col("page_id").alias("subject"), "object", F.lit("same_event_as").alias("predicate"))
    held = table(spark, sf, "pages").where("page_id % 10 = 3").select(F.col("page_id").alias("subject"))
    return edges.join(held, "subject", "left_anti")


@query("SELECT l_orderkey AS story, max(o_orderdate) AS latest FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE p_name ILIKE '%ring%' GROUP BY l_orderkey ORDER BY latest DESC, story LIMIT 50")
def search_by_representative(spark, sf):
    """Stories whose units' representatives have a word in their title, the latest first."""
    p = table(spark, sf, "part").where(F.col("p_name").ilike("%ring%")).select(F.col("p_partkey").alias("l_partkey"))
    hit = table(spark, sf, "lineitem").join(p, "l_partkey", "left_semi").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").join(hit, "o_orderkey", "left_semi").select(F.col("o_orderkey").alias("story"), F.col("o_orderdate").alias("latest")).orderBy(F.desc("latest"), "story").limit(50)


@query("WITH l AS (SELECT DISTINCT l_orderkey AS story, l_partkey AS unit FROM lineitem) SELECT l.story, count(*) AS own_units FROM l WHERE NOT EXISTS (SELECT 1 FROM l p WHERE p.story = l.story - l.story % 4 AND p.story <> l.story AND p.unit = l.unit) GROUP BY l.story")
def viewpoint_own_units(spark, sf):
    """Units of a viewpoint's story that are not its parent's too (every fourth story is the parent of the three after it)."""
    story = F.col("l_orderkey")
    line = table(spark, sf, "lineitem")
    # The stories of a parent that hold a unit are bits of one row: the parent itself is bit 3, as a remainder may be negative.
    own = spread(line.select((story - story % 4).alias("parent"), F.col("l_partkey").alias("unit"), F.expr("shiftleft(1, 3 + coalesce(l_orderkey % 4, 0))").alias("bit")), line.count(), "parent")
    held = own.groupBy("parent", "unit").agg(F.bit_or("bit").alias("held"))
    child = lambda k: F.col("held").bitwiseAND(F.lit(1 << 3 + k)) != 0
    free = F.col("unit").isNull() | F.col("parent").isNull() | ~child(0)
    n = held.groupBy("parent").agg(*[F.count_if(child(k) & (F.lit(k == 0) | free)).alias(f"n{3 + k}") for k in range(-3, 4)])
    each = n.select("parent", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{3 + k}").alias("own_units")) for k in range(-3, 4)])).alias("x"))
    return each.where("x.own_units > 0").select((F.col("parent") + F.col("x.k")).alias("story"), "x.own_units")


@query("WITH e AS (SELECT o_orderkey AS story, unnest([CAST(o_custkey AS VARCHAR), 'surface ' || (o_orderkey % 5), CAST(o_custkey + 1000000 AS VARCHAR)]) AS x FROM orders) SELECT story, string_agg(coalesce(c_name, CASE WHEN TRY_CAST(x AS BIGINT) IS NULL THEN x END), '|' ORDER BY coalesce(c_name, x)) AS names FROM e LEFT JOIN customer ON c_custkey = TRY_CAST(x AS BIGINT) WHERE c_name IS NOT NULL OR TRY_CAST(x AS BIGINT) IS NULL GROUP BY story")
def entity_names(spark, sf):
    """Names of a story's entities: ids by the dictionary, what is no id as it stands, ids that nothing knows dropped."""
    s = lambda c: c.cast("string")
    e = table(spark, sf, "orders").select(F.col("o_orderkey").alias("story"), F.explode(F.array(s(F.col("o_custkey")), F.concat(F.lit("surface "), s(F.col("o_orderkey") % 5)), s(F.col("o_custkey") + 1000000))).alias("x")).withColumn("id", F.col("x").try_cast("long"))
    j = e.join(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "id", "left").withColumn("name", F.coalesce("name", F.when(F.col("id").isNull(), F.col("x"))))
    return j.where("name IS NOT NULL").groupBy("story").agg(F.array_join(F.array_sort(F.collect_list("name")), "|").alias("names"))


@query(f"""WITH {_LK}, c AS (SELECT story, count(*) AS claims, count(*) FILTER (WHERE flag = 'A') AS disputes FROM lk GROUP BY story), t AS (SELECT story, string_agg(DISTINCT brand, ',' ORDER BY brand) AS topics FROM lk GROUP BY story), s AS (SELECT story, string_agg(source || ':' || n, ',' ORDER BY n DESC, source) AS top_sources FROM (SELECT story, source, sum(quantity) AS n, row_number() OVER (PARTITION BY story ORDER BY sum(quantity) DESC, source) AS nth FROM lk GROUP BY story, source) WHERE nth <= 3 GROUP BY story)
    SELECT o_orderkey AS story, o_orderstatus AS status, claims, disputes, topics, top_sources FROM orders JOIN c ON c.story = o_orderkey JOIN t ON t.story = o_orderkey JOIN s ON s.story = o_orderkey""")
def story_detail(spark, sf):
    """What the page of a story shows: its claims, topics and three main sources, each aggregated by story before the join."""
    lk = links(spark, sf)
    c = lk.groupBy("story").agg(F.count("*").alias("claims"), F.count_if(F.col("flag") == "A").alias("disputes"), F.array_join(F.array_sort(F.collect_set("brand")), ",").alias("topics"))
    n = lk.groupBy("story", "source").agg(F.sum("quantity").alias("n"))
    top = n.withColumn("nth", F.row_number().over(Window.partitionBy("story").orderBy(F.desc("n"), "source"))).where("nth <= 3")
    s = top.groupBy("story").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "source", "n"))), lambda x: F.concat_ws(":", x["source"].cast("string"), x["n"].cast("string"))), ",").alias("top_sources"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("story"), F.col("o_orderstatus").alias("status"))
    return o.join(c, "story").join(s, "story").select("story", "status", "claims", "disputes", "topics", "top_sources")


@query("WITH d AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'), c AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0) SELECT 'lineitem.l_orderkey' AS reference, count(*) AS blockers FROM lineitem WHERE l_orderkey IN (SELECT * FROM d) UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders WHERE o_custkey IN (SELECT * FROM c)")
def reference_blockers(spark, sf):
    """Rows that point at rows about to go."""
    line, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    a = line.join(orders.where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").agg(F.count("*").alias("blockers")).select(F.lit("lineitem.l_orderkey").alias("reference"), "blockers")
    b = orders.join(table(spark, sf, "customer").where("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(F.count("*").alias("blockers")).select(F.lit("orders.o_custkey").alias("reference"), "blockers")
    return a.unionByName(b)


@query("SELECT vec_id FROM embeddings WHERE vec_id IN (SELECT l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01' AND o_totalprice > 480000))")
def expired_embeddings(spark, sf):
    """Vectors of articles of units of stories that have expired: a chain of semi-joins."""
    old = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_totalprice > 480000").where(F.col("o_orderdate").cast("timestamp") < F.lit("1996-01-01 00:00:00").cast("timestamp"))
    gone = table(spark, sf, "lineitem").join(old, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(F.col("l_suppkey").alias("vec_id"))
    return table(spark, sf, "embeddings").join(gone, "vec_id", "left_semi").select("vec_id")


@query("WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey - o_orderkey % 4 END AS parent, o_orderstatus AS status FROM orders) SELECT p.id AS parent, count(*) AS children, string_agg(c.status, '' ORDER BY c.id) AS statuses FROM o p JOIN o c ON c.parent = p.id GROUP BY p.id")
def viewpoint_families(spark, sf):
    """Viewpoint children of each parent story that exists."""
    n = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(n.alias("id"), F.when(n % 4 > 0, n - n % 4).alias("parent"), F.col("o_orderstatus").alias("status"))
    c = o.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("children"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "status"))), lambda x: x["status"]), "").alias("statuses"))
    return c.join(o.select(F.col("id").alias("parent")), "parent", "left_semi").select("parent", "children", "statuses")


@query(f"WITH {_LK}, t AS (SELECT unit, tier, count(*) AS n FROM lk GROUP BY ALL), o AS (SELECT unit, owner, count(*) AS n FROM lk WHERE tier = 1 GROUP BY ALL) SELECT unit, string_agg('tier' || tier || '=' || n, ',' ORDER BY tier) AS tiers, (SELECT string_agg(owner || '=' || n, ',' ORDER BY owner) FROM o WHERE o.unit = t.unit) AS tier1_owners FROM t GROUP BY unit")
def unit_histograms(spark, sf):
    """A unit's articles by tier, and its tier-1 articles by owner, as sorted maps."""
    lk = links(spark, sf)
    text = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k, "n"))), lambda x: F.concat(x[0], F.lit("="), x["n"].cast("string"))), ",")
    hist = lambda df, k, out: df.groupBy("unit", F.col(k).alias("k")).agg(F.count("*").alias("n")).groupBy("unit").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: F.concat(x["k"].cast("string"), F.lit("="), x["n"].cast("string"))), ",").alias(out))
    return hist(lk.withColumn("t", F.concat(F.lit("tier"), F.col("tier").cast("string"))), "t", "tiers").join(hist(lk.where("tier = 1"), "owner", "tier1_owners"), "unit", "left")


@query(f"WITH {_LK}, s AS (SELECT story, least(count(DISTINCT unit), 5) AS units, least(count(DISTINCT owner), 3) AS owners FROM lk GROUP BY story) SELECT units, owners, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) AS total FROM s JOIN orders ON o_orderkey = story GROUP BY ROLLUP (units, owners)")
def story_crosstab(spark, sf):
    """Stories by units and owners against their status, with the totals of rows and of all."""
    s = links(spark, sf).groupBy("story").agg(F.least(F.countDistinct("unit"), F.lit(5)).alias("units"), F.least(F.countDistinct("owner"), F.lit(3)).alias("owners"))
    j = s.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("story"), F.col("o_orderstatus").alias("status")), "story")
    return j.rollup("units", "owners").agg(*[F.count_if(F.col("status") == x).alias(x.lower()) for x in ("O", "F", "P")], F.count("*").alias("total"))


@query(f"WITH {_LK}, s AS (SELECT story, count(DISTINCT unit) AS units, count(DISTINCT owner) FILTER (WHERE tier = 1) AS owners, count(DISTINCT unit) FILTER (WHERE tier = 1) AS tier1 FROM lk GROUP BY story) SELECT 'units' AS kind, CAST(units AS VARCHAR) AS bucket, count(*) AS stories FROM s GROUP BY units UNION ALL SELECT 'blocked', CASE WHEN tier1 < 2 THEN 'too few units' WHEN owners < 2 THEN 'too few owners' ELSE 'passed' END, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'entities', CASE WHEN units = 1 THEN '1' WHEN units <= 3 THEN '2-3' ELSE '4+' END, count(*) FROM s GROUP BY 2")
def grouping_report(spark, sf):
    """Distributions of units for each story, of reasons that block, and of entity counts, from one aggregate."""
    first = F.col("tier") == 1
    s = links(spark, sf).groupBy("story").agg(F.countDistinct("unit").alias("units"), F.countDistinct(F.when(first, F.col("owner"))).alias("owners"), F.countDistinct(F.when(first, F.col("unit"))).alias("tier1"))
    row = lambda kind, b: F.struct(F.lit(kind).alias("kind"), b.alias("bucket"))
    rows = F.array(row("units", F.col("units").cast("string")), row("blocked", F.when(F.col("tier1") < 2, "too few units").when(F.col("owners") < 2, "too few owners").otherwise("passed")), row("entities", F.when(F.col("units") == 1, "1").when(F.col("units") <= 3, "2-3").otherwise("4+")))
    return s.select(F.inline(rows)).groupBy("kind", "bucket").agg(F.count("*").alias("stories"))


@query("WITH e AS (SELECT source, lang, unnest(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+')) AS entity, unnest(range(len(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+')))) AS k, doc_id FROM documents), n AS (SELECT doc_id, lang, entity, count(*) AS n, min(k) AS k FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, k) AS nth FROM n) SELECT doc_id, string_agg(entity, '|' ORDER BY nth) AS entities FROM r WHERE nth <= 3 GROUP BY doc_id")
def entities_top_n(spark, sf):
    """The three names that a text names most, the first named of equals."""
    e = table(spark, sf, "documents").select("doc_id", F.posexplode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Z][a-z]+"), F.lit(0))).alias("k", "entity"))
    n = e.groupBy("doc_id", "entity").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    top = n.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "k"))).where("nth <= 3")
    return top.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "entity"))), lambda x: x["entity"]), "|").alias("entities"))


@query("""WITH s AS (SELECT lang AS field, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS fn FROM labels JOIN documents USING (doc_id) GROUP BY lang), f AS (SELECT field, tp, fp, fn, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM s)
    SELECT 'micro' AS kind, round(2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS f1, sum(tp)::BIGINT AS tp FROM f UNION ALL SELECT 'macro', round(avg(f1), 6), sum(tp)::BIGINT FROM f""")
def micro_and_macro(spark, sf):
    """All fields' counts merged and scored once, and the mean of the fields' scores."""
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", F.col("lang").alias("field")), "doc_id")
    n = lambda q, t: F.count_if((F.col("quality") == q) & (F.col("toxic") == t))
    f1 = lambda tp, fp, fn: F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))
    s = j.groupBy("field").agg(n(1, 0).alias("tp"), n(0, 0).alias("fp"), n(1, 1).alias("fn"))
    g = s.agg(F.round(f1(F.sum("tp"), F.sum("fp"), F.sum("fn")), 6).alias("micro"), F.round(F.avg(f1(F.col("tp"), F.col("fp"), F.col("fn"))), 6).alias("macro"), F.sum("tp").alias("tp"))
    return g.select(F.inline(F.array(F.struct(F.lit("micro").alias("kind"), F.col("micro").alias("f1"), "tp"), F.struct(F.lit("macro").alias("kind"), F.col("macro").alias("f1"), "tp"))))


@query("SELECT source, event, sum(n)::BIGINT AS n FROM (SELECT source, 'ok' AS event, 1 AS n FROM documents WHERE n_chars >= 200 UNION ALL SELECT source, 'too_short', 1 FROM documents WHERE n_chars < 200 UNION ALL SELECT source, 'chars', n_chars FROM documents) GROUP BY ALL")
def ingest_counters(spark, sf):
    """Counters of a source's events: one pass, one row for each."""
    d = table(spark, sf, "documents")
    events = F.array(F.struct(F.when(F.col("n_chars") >= 200, "ok").otherwise("too_short").alias("event"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("chars").alias("event"), F.col("n_chars").cast("long").alias("n")))
    return d.select("source", F.inline(events)).groupBy("source", "event").agg(F.sum("n").alias("n"))


@query("WITH r AS (SELECT conv_id, max(turn) AS turn, count(*) AS revisions FROM conversations GROUP BY conv_id HAVING count(*) >= 2) SELECT conv_id AS article, turn AS latest, revisions FROM r ORDER BY turn DESC, conv_id LIMIT 40")
def rescan_candidates(spark, sf):
    return revisions(spark, sf).groupBy(F.col("article_id").alias("article")).agg(F.max("revision").alias("latest"), F.count("*").alias("revisions")).where("revisions >= 2").orderBy(F.desc("latest"), "article").limit(40)


@query("WITH a1 AS (SELECT 'documents' AS adapter, CAST(doc_id AS VARCHAR) AS key, source AS domain FROM documents WHERE lang IN ('en', 'fr') UNION ALL SELECT 'pages', trim(url), lower(regexp_extract(trim(url), '^https?://([^/?#:]*)', 1)) FROM pages) SELECT adapter, count(*) AS rows, count(DISTINCT key) AS keys, count(DISTINCT domain) AS domains FROM a1 GROUP BY adapter")
def adapter_union(spark, sf):
    """Articles of several adapters put together, those of the languages and kinds that were asked for."""
    d = table(spark, sf, "documents").where("lang IN ('en', 'fr')").select(F.lit("documents").alias("adapter"), F.col("doc_id").cast("string").alias("key"), F.col("source").alias("domain"))
    p = table(spark, sf, "pages").select(F.lit("pages").alias("adapter"), F.trim("url").alias("key"), F.lower(F.regexp_extract(F.trim("url"), "^https?://([^/?#:]*)", 1)).alias("domain"))
    return d.unionByName(p).groupBy("adapter").agg(F.count("*").alias("rows"), F.countDistinct("key").alias("keys"), F.countDistinct("domain").alias("domains"))


@query("SELECT count(DISTINCT l_partkey) AS units, count(*) AS links FROM lineitem WHERE l_orderkey % 5 < 3")
def flattened_units(spark, sf):
    """Units of several stories, each once."""
    return table(spark, sf, "lineitem").where("l_orderkey % 5 < 3").agg(F.countDistinct("l_partkey").alias("units"), F.count("*").alias("links"))


@query("SELECT 'missing' AS kind, x AS name FROM (SELECT unnest(['o_orderkey', 'o_comment', 'o_clerk']) AS x EXCEPT SELECT column_name FROM (DESCRIBE orders)) UNION ALL SELECT 'unexpected', x FROM (SELECT column_name AS x FROM (DESCRIBE orders) EXCEPT SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderdate', 'o_comment', 'o_clerk'])) UNION ALL SELECT 'unused value', x FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS x EXCEPT SELECT o_orderstatus FROM orders)")
def schema_drift(spark, sf):
    """What a table should have and lacks, what it has beyond that, and values of an enumeration that no row has."""
    o = table(spark, sf, "orders")
    rows = lambda xs: spark.createDataFrame([(x,) for x in xs], "name string")
    have = rows(o.columns)
    missing = rows(["o_orderkey", "o_comment", "o_clerk"]).exceptAll(have).select(F.lit("missing").alias("kind"), "name")
    extra = have.exceptAll(rows(["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_comment", "o_clerk"])).select(F.lit("unexpected").alias("kind"), "name")
    unused = rows(["F", "O", "P", "X"]).join(o.select(F.col("o_orderstatus").alias("name")).distinct(), "name", "left_anti").select(F.lit("unused value").alias("kind"), "name")
    return missing.unionByName(extra).unionByName(unused)


@query("""WITH c AS (SELECT o_orderkey AS story, CASE o_orderkey % 4 WHEN 0 THEN '```json {"' || o_orderkey || '": "Pro Deal!"} ```' WHEN 1 THEN 'Here you are: {"' || o_orderkey || '": "  "} as asked' WHEN 2 THEN '{"' || o_orderkey || '": "anti-war"}' ELSE 'no answer' END AS answer FROM orders)
    SELECT story, CASE story % 4 WHEN 0 THEN 'pro_deal' WHEN 1 THEN 'neutral' WHEN 2 THEN 'anti_war' END AS label FROM c""")
def viewpoint_answers(spark, sf):
    """Labels out of a model's answer, with or without fences and prose around its JSON."""
    n = F.col("o_orderkey")
    s = n.cast("string")
    answer = F.when(n % 4 == 0, F.concat(F.lit('```json {"'), s, F.lit('": "Pro Deal!"} ```'))).when(n % 4 == 1, F.concat(F.lit('Here you are: {"'), s, F.lit('": "  "} as asked'))).when(n % 4 == 2, F.concat(F.lit('{"'), s, F.lit('": "anti-war"}'))).otherwise("no answer")
    parsed = F.from_json(F.nullif(F.regexp_extract(answer, r"(\{[\s\S]*\})", 1), F.lit("")), "map<string,string>")
    raw = F.try_element_at(parsed, s)
    label = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), "[^a-z0-9_]+", "_"), "^_+|_+$", "")
    return table(spark, sf, "orders").select(n.alias("story"), F.when(raw.isNotNull(), F.coalesce(F.nullif(F.substring(label, 1, 32), F.lit("")), F.lit("neutral"))).alias("label"))


@query("""SELECT o_orderkey AS story, 'claim ' || o_orderkey AS claim, CASE WHEN o_orderkey % 3 = 0 THEN 'allegation' ELSE 'fact' END AS claim_type, o_custkey AS unit, CASE o_orderkey % 2 WHEN 0 THEN 'supports' ELSE 'neutral' END AS stance, CASE o_orderkey % 5 WHEN 0 THEN 50 ELSE CAST(o_orderkey % 101 AS INTEGER) END AS confidence FROM orders WHERE o_orderkey % 7 <> 0""")
def claim_rows(spark, sf):
    """Claims and their evidence out of a model's answer; evidence that is malformed goes, its claim stays."""
    n = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    evidence = F.concat(F.lit('{"unit_id": '), F.when(n % 7 == 0, '"nothing"').otherwise(s(F.col("o_custkey"))), F.when(n % 2 == 0, ', "stance": "supports"').otherwise(""), F.when(n % 5 == 0, "").otherwise(F.concat(F.lit(', "confidence": '), s(n % 101))), F.lit("}"))
    answer = F.concat(F.lit('{"claims": [{"text": "claim '), s(n), F.lit('"'), F.when(n % 3 == 0, ', "claim_type": "allegation"').otherwise(""), F.lit(', "evidence": ['), evidence, F.lit("]}]}"))
    schema = "claims array<struct<text:string,claim_type:string,evidence:array<struct<unit_id:string,stance:string,confidence:string>>>>"
    c = table(spark, sf, "orders").select(n.alias("story"), F.explode(F.from_json(answer, schema)["claims"]).alias("c"))
    e = c.select("story", F.col("c.text").alias("claim"), F.coalesce("c.claim_type", F.lit("fact")).alias("claim_type"), F.explode("c.evidence").alias("e"))
    return e.select("story", "claim", "claim_type", F.col("e.unit_id").try_cast("long").alias("unit"), F.coalesce("e.stance", F.lit("neutral")).alias("stance"), F.coalesce(F.col("e.confidence"), F.lit("50")).try_cast("int").alias("confidence")).where("unit IS NOT NULL AND confidence IS NOT NULL")


@query("""SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN epoch(date_trunc('second', ts))::BIGINT WHEN 1 THEN epoch(TIMESTAMP '2024-03-05 06:07:08')::BIGINT WHEN 2 THEN epoch(TIMESTAMP '2024-03-05 04:07:08')::BIGINT END AS utc FROM events""")
def parsed_times(spark, sf):
    """Times of several forms in UTC: 14 digits, ISO with and without an offset; what cannot be read is null."""
    n = F.col("event_id")
    raw = F.when(n % 4 == 0, F.date_format("ts", "yyyyMMddHHmmss")).when(n % 4 == 1, "2024-03-05T06:07:08Z").when(n % 4 == 2, "2024-03-05T06:07:08+02:00").otherwise("n/a")
    parsed = F.coalesce(F.when(raw.rlike("^[0-9]{14}$"), F.try_to_timestamp(raw, F.lit("yyyyMMddHHmmss"))), F.when(raw.rlike(r"^\d{4}-"), raw.try_cast("timestamp")))
    return table(spark, sf, "events").select(n.alias("id"), F.unix_timestamp(parsed).alias("utc"))


@query("""WITH RECURSIVE t AS (SELECT 0 AS lvl, list(sha256(unhex('00') || unhex(sha256('{"index":' || event_id || ',"timestamp":' || epoch_us(ts) || '}'))) ORDER BY event_id) AS h FROM events UNION ALL
    SELECT lvl + 1, list_transform(range(1, len(h) + 1, 2), lambda k: CASE WHEN k = len(h) THEN h[k] ELSE sha256(unhex('01') || unhex(h[k]) || unhex(h[k + 1])) END) FROM t WHERE len(h) > 1) SELECT h[1] AS root FROM t WHERE len(h) = 1""")
def timestamp_commitment(spark, sf):
    """The root over the digests of entries' numbers and times."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("i"), F.sha2(H.canonical_json({"index": F.col("event_id"), "timestamp": F.unix_micros(F.col("ts").cast("timestamp"))}).cast("binary"), 256).alias("d"))
    return M.root(e.select("i", F.sha2(F.concat(F.unhex(F.lit("00")), F.unhex("d")), 256).alias("h")))


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS n FROM embeddings), u AS (SELECT vec_id, n, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS u FROM e) SELECT vec_id, n > 0 AS has_length, round(u[1], 6) AS first, round(u[-1], 6) AS last, round(list_max(u), 6) AS most, round(list_min(u), 6) AS least FROM u")
def unit_vectors(spark, sf):
    """Vectors brought to length one; a zero vector stays."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    u = e.withColumn("n", length("e")).withColumn("u", F.when(F.col("n") > 0, F.transform("e", lambda x: x / F.col("n"))).otherwise(F.col("e")))
    return u.select("vec_id", (F.col("n") > 0).alias("has_length"), *[F.round(c, 6).alias(n) for n, c in (("first", F.element_at("u", 1)), ("last", F.element_at("u", -1)), ("most", F.array_max("u")), ("least", F.array_min("u")))])


_FKS = [("nation", "region"), ("customer", "nation"), ("supplier", "nation"), ("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier"), ("labels", "documents")]


@query("WITH RECURSIVE fk(child, parent) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _FKS) + "), t AS (SELECT child AS name FROM fk UNION SELECT parent FROM fk), d AS (SELECT name, 0 AS depth FROM t UNION ALL SELECT parent, depth + 1 FROM d JOIN fk ON child = name) SELECT name, max(depth) AS depth, row_number() OVER (ORDER BY max(depth), name) AS place FROM d GROUP BY name")
def delete_order(spark, sf):
    """Tables in an order in which rows can be deleted: each after all that refer to it. The graph is the model's, a handful of rows."""
    fk = spark.createDataFrame(_FKS, "child string, parent string")
    at = fk.select(F.col("child").alias("name")).unionByName(fk.select(F.col("parent").alias("name"))).distinct().withColumn("depth", F.lit(0))
    level = at
    for _ in range(len({x for pair in _FKS for x in pair})):
        level = level.join(fk, F.col("name") == F.col("child")).select(F.col("parent").alias("name"), (F.col("depth") + 1).alias("depth")).distinct()
        at = at.unionByName(level)
        if level.isEmpty():
            break
    d = at.groupBy("name").agg(F.max("depth").alias("depth"))
    return d.select("name", "depth", F.row_number().over(Window.orderBy("depth", "name")).alias("place"))


@query("SELECT p_brand AS layer, count(*) AS shapes, min(p_partkey) AS first FROM part WHERE p_size < 40 GROUP BY p_brand ORDER BY layer LIMIT 200")
def map_layers(spark, sf):
    return table(spark, sf, "part").where("p_size < 40").groupBy(F.col("p_brand").alias("layer")).agg(F.count("*").alias("shapes"), F.min("p_partkey").alias("first")).orderBy("layer").limit(200)


@query("SELECT count(*) AS entries, count(DISTINCT conv_id) AS logs, max(turn) AS newest, count(*) FILTER (WHERE role = 'user') AS stamped, round(count(*) FILTER (WHERE role = 'user') * 100.0 / count(*), 4) AS share FROM conversations")
def transparency_status(spark, sf):
    """How much is stamped, over all logs."""
    stamped = F.count_if(F.col("role") == "user")
    return table(spark, sf, "conversations").agg(F.count("*").alias("entries"), F.countDistinct("conv_id").alias("logs"), F.max("turn").alias("newest"), stamped.alias("stamped"), F.round(stamped * 100.0 / F.count("*"), 4).alias("share"))


@query(f"WITH {_LK}, g AS (SELECT story, count(DISTINCT unit) FILTER (WHERE tier = 1) AS units, count(DISTINCT owner) FILTER (WHERE tier = 1) AS owners, max(articles) FILTER (WHERE tier >= 3) AS viral FROM lk GROUP BY story), s AS (SELECT *, units >= 2 AND owners >= 2 AS passed, CASE WHEN units >= 2 AND owners >= 2 THEN 70 ELSE 0 END + least(coalesce(viral, 0) * 2, 10) AS score FROM g) SELECT o_orderkey AS story, o_orderstatus AS before, CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN coalesce(passed, false) THEN 'pending' ELSE 'blocked' END AS after, coalesce(passed, false) = (coalesce(score, 0) >= 50) AS agreement FROM orders LEFT JOIN s ON story = o_orderkey")
def gate_application(spark, sf):
    """What a gate run makes of each story's status, and whether the score would have decided alike; final states stay."""
    first = F.col("tier") == 1
    g = links(spark, sf).groupBy("story").agg(F.countDistinct(F.when(first, F.col("unit"))).alias("units"), F.countDistinct(F.when(first, F.col("owner"))).alias("owners"), F.coalesce(F.max(F.when(F.col("tier") >= 3, F.col("articles"))), F.lit(0)).alias("viral"))
    passed = (F.col("units") >= 2) & (F.col("owners") >= 2)
    s = g.select("story", passed.alias("passed"), (F.when(passed, 70).otherwise(0) + F.least(F.col("viral") * 2, F.lit(10))).alias("score"))
    j = table(spark, sf, "orders").select(F.col("o_orderkey").alias("story"), F.col("o_orderstatus").alias("before")).join(s, "story", "left").withColumn("passed", F.coalesce("passed", F.lit(False)))
    return j.select("story", "before", F.when(F.col("before") == "F", "F").when(F.col("passed"), "pending").otherwise("blocked").alias("after"), (F.col("passed") == (F.coalesce("score", F.lit(0)) >= 50)).alias("agreement"))


@query("WITH d AS (SELECT doc_id, doc_id % 72 AS age, coalesce(text, '') AS text FROM documents) SELECT doc_id, age < 24 AND text <> '' AS cleared, CASE WHEN age < 24 THEN 0 ELSE length(text) END AS left_chars, CASE WHEN age < 24 THEN octet_length(encode(text)) ELSE 0 END AS reclaimed FROM d")
def retention_rewrite(spark, sf):
    """Articles after retention: bodies of old ones are gone, and what that frees."""
    t, old = F.coalesce("text", F.lit("")), F.col("doc_id") % 72 < 24
    return table(spark, sf, "documents").select("doc_id", (old & (t != "")).alias("cleared"), F.when(old, 0).otherwise(F.length(t)).cast("long").alias("left_chars"), F.when(old, F.octet_length(t)).otherwise(0).cast("long").alias("reclaimed"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 NOT IN (2, 3) THEN NULL ELSE o_custkey END AS pointer, o_custkey % 4 NOT IN (2, 3) AS recomputed FROM orders")
def recompute_stale(spark, sf):
    """Rows of versions that are no longer made: their pointers are cleared and they are made anew."""
    stale = ~(F.col("o_custkey") % 4).isin(2, 3)
    return table(spark, sf, "orders").select("o_orderkey", F.when(~stale, F.col("o_custkey")).alias("pointer"), stale.alias("recomputed"))


@query(f"WITH RECURSIVE {_CANONICAL}, o AS (SELECT page_id, url, sha256(lower(url)) AS old_hash, sha256(lower(canonical)) AS new_hash FROM c) SELECT old_hash, new_hash, min(page_id) AS first_page FROM o WHERE old_hash <> new_hash GROUP BY ALL")
def url_hash_backfill(spark, sf):
    """Aliases from hashes of addresses as they came to those of their canonical form."""
    c = table(spark, sf, "pages").select("page_id", F.sha2(F.lower(F.trim("url")).cast("binary"), 256).alias("old_hash"), U.url_hash(F.col("url")).alias("new_hash"))
    return c.where("old_hash <> new_hash").groupBy("old_hash", "new_hash").agg(F.min("page_id").alias("first_page"))


@query("SELECT o_orderkey AS story, CASE WHEN o_orderkey % 100 = 7 THEN 'unpublished' ELSE o_orderstatus END AS status, o_orderkey % 100 = 7 AND o_orderstatus <> 'P' AS changed FROM orders")
def unpublish(spark, sf):
    """Stories taken back; one that is back already (here P) does not change again."""
    named = F.col("o_orderkey") % 100 == 7
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("story"), F.when(named, "unpublished").otherwise(F.col("o_orderstatus")).alias("status"), (named & (F.col("o_orderstatus") != "P")).alias("changed"))


@query(f"WITH {_LK}, d AS (SELECT story, sha256(string_agg(unit || '-' || source, ',' ORDER BY unit, source)) AS digest, sha256(coalesce(string_agg(unit || '-' || source, ',' ORDER BY unit, source) FILTER (WHERE source % 5 > 0), '')) AS stored, count(*) AS n FROM lk GROUP BY story) SELECT story, n, digest, digest = stored AS current FROM d")
def claim_currency(spark, sf):
    """Whether claims were made from the units that a story has now, by the digest of these; links of every fifth source came later."""

    def digest(members):
        pairs = F.transform(F.array_sort(members), lambda x: F.concat_ws("-", x["unit"].cast("string"), x["source"].cast("string")))
        return F.sha2(F.array_join(pairs, ",").cast("binary"), 256)

    link = F.struct("unit", "source")
    d = links(spark, sf).groupBy("story").agg(digest(F.collect_list(link)).alias("digest"), digest(F.collect_list(F.when(F.col("source") % 5 > 0, link))).alias("stored"), F.count("*").alias("n"))
    return d.select("story", "n", "digest", (F.col("digest") == F.col("stored")).alias("current"))


@query(r"WITH t AS (SELECT event_id AS id, 'it is ' || (event_id % 50) || ' now' AS a, 'it is ' || CASE WHEN event_id % 3 = 1 THEN event_id % 50 * 3 ELSE event_id % 50 END || ' today' AS b FROM events), v AS (SELECT id, CAST(regexp_extract(a, '\d+') AS DOUBLE) AS a, CAST(regexp_extract(b, '\d+') AS DOUBLE) AS b FROM t) SELECT id, CASE WHEN a = 0 AND b <> 0 OR a <> 0 AND abs(b - a) / a > 0.05 THEN 'moderate' ELSE 'minor' END AS severity FROM v")
def correction_severity(spark, sf):
    """How grave a correction is: moderate where figures moved, else minor."""
    n = F.col("event_id")
    s = lambda c: c.cast("string")
    a, b = F.concat(F.lit("it is "), s(n % 50), F.lit(" now")), F.concat(F.lit("it is "), s(F.when(n % 3 == 1, n % 50 * 3).otherwise(n % 50)), F.lit(" today"))
    return table(spark, sf, "events").select(n.alias("id"), F.when(X.numbers_changed(a, b), "moderate").otherwise("minor").alias("severity"))


@query("SELECT doc_id, lang <> 'en' AS refreshed, CASE WHEN lang <> 'en' THEN 'en:' || source ELSE source END AS entities_from FROM documents")
def entity_refresh(spark, sf):
    """Entities of translated articles come from the translation."""
    other = F.col("lang") != "en"
    return table(spark, sf, "documents").select("doc_id", other.alias("refreshed"), F.when(other, F.concat(F.lit("en:"), "source")).otherwise(F.col("source")).alias("entities_from"))


_SNIP = """s AS (SELECT l_orderkey AS story, list({'text': 'part ' || l_partkey || ' was shipped with care', 'type': ['quote', 'stat', 'fact', 'summary', 'opinion'][l_suppkey % 5 + 1], 'confidence': CASE WHEN l_partkey % 3 > 0 THEN CAST(l_quantity AS INTEGER) END,
    'entities': ['Part ' || l_partkey, 'ACME']} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS x FROM lineitem GROUP BY l_orderkey)"""
_SPOILT = """p AS (SELECT story, x, 'drop_confidence' AS way, list_transform(x, lambda v: {'text': v.text, 'type': v.type, 'confidence': CAST(NULL AS INTEGER), 'entities': v.entities}) AS y FROM s
    UNION ALL SELECT story, x, 'collapse_type', list_transform(x, lambda v: {'text': v.text, 'type': 'summary', 'confidence': v.confidence, 'entities': v.entities}) FROM s
    UNION ALL SELECT story, x, 'cycle_type', list_transform(x, lambda v: {'text': v.text, 'type': CASE v.type WHEN 'quote' THEN 'stat' WHEN 'stat' THEN 'fact' WHEN 'fact' THEN 'summary' WHEN 'summary' THEN 'claim' WHEN 'claim' THEN 'quote' ELSE v.type END, 'confidence': v.confidence, 'entities': v.entities}) FROM s
    UNION ALL SELECT story, x, 'truncate_text', list_transform(x, lambda v: {'text': substring(v.text, 1, 19), 'type': v.type, 'confidence': v.confidence, 'entities': v.entities}) FROM s
    UNION ALL SELECT story, x, 'first_only', x[1:1] FROM s UNION ALL SELECT story, x, 'shout_entities', list_transform(x, lambda v: {'text': v.text, 'type': v.type, 'confidence': v.confidence, 'entities': list_transform(v.entities, lambda e: upper(e))}) FROM s)"""


@query(f"""WITH {_SNIP}, {_SPOILT} SELECT story, way AS perturbation, y IS DISTINCT FROM x AS changed, array_to_string(list_transform(y, lambda v: v.text || '/' || v.type || '/' || coalesce(CAST(v.confidence AS VARCHAR), '') || '/' || array_to_string(v.entities, '+')), ';') AS spoilt FROM p""")
def snippet_perturbations(spark, sf):
    """Answers spoilt on purpose in six ways, and which of them that changed."""
    names = F.array(*[F.lit(x) for x in ("quote", "stat", "fact", "summary", "opinion")])
    part = F.col("l_partkey").cast("string")
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.concat(F.lit("part "), part, F.lit(" was shipped with care")).alias("text"), F.element_at(names, (F.col("l_suppkey") % 5 + 1).cast("int")).alias("type"), F.when(F.col("l_partkey") % 3 > 0, F.col("l_quantity").cast("int")).alias("confidence"), F.array(F.concat(F.lit("Part "), part), F.lit("ACME")).alias("entities"))
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("story")).agg(F.array_sort(F.collect_list(one)).alias("x"))
    s = s.select("story", F.transform("x", lambda v: F.struct(v["text"].alias("text"), v["type"].alias("type"), v["confidence"].alias("confidence"), v["entities"].alias("entities"))).alias("x"))
    text = lambda v: F.concat(v["text"], F.lit("/"), v["type"], F.lit("/"), F.coalesce(v["confidence"].cast("string"), F.lit("")), F.lit("/"), F.array_join(v["entities"], "+"))
    return CO.perturbed(s, "x").select("story", "perturbation", "changed", F.array_join(F.transform("spoilt", text), ";").alias("spoilt"))


@query("SELECT count(*) AS gold, count(*) FILTER (WHERE d.doc_id IS NOT NULL) AS in_corpus, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS unlabelled FROM labels LEFT JOIN documents d USING (doc_id)")
def gold_coverage(spark, sf):
    """Gold labels that have an article, and articles that have none."""
    d, g = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    a = g.join(d.withColumn("held", F.lit(1)), "doc_id", "left").agg(F.count("*").alias("gold"), F.count("held").alias("in_corpus"))
    return a.crossJoin(d.join(g, "doc_id", "left_anti").agg(F.count("*").alias("unlabelled")))  # one row each


@query("SELECT conv_id, turn, sha256('v1' || chr(31) || role || chr(31) || coalesce(text, '')) AS key FROM conversations")
def replay_keys(spark, sf):
    """Keys of answers that are kept: the version, the prompt's kind and the input."""
    return table(spark, sf, "conversations").select("conv_id", "turn", F.sha2(F.concat_ws("\x1f", F.lit("v1"), "role", F.coalesce("text", F.lit(""))).cast("binary"), 256).alias("key"))


@query("SELECT source, count(*) AS rows, '| ' || source || ' | ' || count(*) || ' | ' || count(*) FILTER (WHERE lang = 'en') || ' |' AS line FROM documents GROUP BY source")
def source_report(spark, sf):
    """Rows of a source as lines of a report."""
    g = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("rows"), F.count_if(F.col("lang") == "en").alias("en"))
    return g.select("source", "rows", F.concat(F.lit("| "), "source", F.lit(" | "), F.col("rows").cast("string"), F.lit(" | "), F.col("en").cast("string"), F.lit(" |")).alias("line"))


@query("WITH g AS (SELECT user_id AS feed, max(epoch_us(ts)) AS last, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY user_id) SELECT feed, last, errors FROM g WHERE errors >= 3 ORDER BY feed")
def dead_feeds(spark, sf):
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("feed")).agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return e.where("errors >= 3").orderBy("feed")


@query()
def stored_signatures(spark, sf):
    """MinHash signatures of the turns' shingles as JSON, read again: as many slots, each the least hash that a fresh one has."""
    r = revisions(spark, sf)
    s = V.minhash(T.with_shingles(r, "content", "s"), "s", "sig").select(F.col("article_id").alias("conv_id"), F.col("revision").alias("turn"), "sig", F.to_json("sig").alias("stored"))
    back = F.from_json("stored", "array<bigint>")
    return s.select("conv_id", "turn", F.size(back).cast("long").alias("slots"), (back == F.col("sig")).alias("same"))


#: Twenty strata of articles: name, condition (in SQL that both engines read), and how many of each.
_STRATA = [
    ("de", "lang = 'de'", 4), ("es", "lang = 'es'", 4), ("fr", "lang = 'fr'", 4), ("it", "lang = 'it'", 4), ("no language", "lang IS NULL", 2), ("en short", "lang = 'en' AND n BETWEEN 200 AND 400", 6), ("en middle", "lang = 'en' AND n BETWEEN 401 AND 1500", 6),
    ("en long", "lang = 'en' AND n BETWEEN 1501 AND 5000", 5), ("en longest", "lang = 'en' AND n > 5000", 5), ("en tier 1", "lang = 'en' AND tier = 1", 4), ("en tier 2", "lang = 'en' AND tier = 2", 4), ("en tier 3", "lang = 'en' AND tier = 3", 3), ("en tier 4", "lang = 'en' AND tier = 4", 3),
    ("owner 0", "owner = 'owner0'", 2), ("owner 3", "owner = 'owner3'", 2), ("owner 5", "owner = 'owner5' AND lang <> 'en'", 2), ("figures", "body LIKE '%000%'", 3), ("lines", "body LIKE '%' || chr(10) || chr(10) || '%'", 3), ("any tier 1", "tier = 1", 5), ("any", "n >= 0", 6),
]


def _strata_sql() -> str:
    parts, before = [], []
    for k, (name, condition, most) in enumerate(_STRATA):
        out = "".join(f" AND id NOT IN (SELECT id FROM s{j})" for j in before)
        parts.append(f"s{k} AS MATERIALIZED (SELECT id, '{name}' AS stratum, digest FROM l WHERE n > 200 AND ({condition}){out} ORDER BY n DESC, id LIMIT {most})")
        before.append(k)
    union = " UNION ALL ".join(f"SELECT * FROM s{k}" for k in before)
    return f"WITH l AS MATERIALIZED (SELECT id, body, lang, tier, owner, length(body) AS n, sha256(body) AS digest FROM a), {', '.join(parts)}, u AS ({union}) SELECT id, stratum, CASE WHEN id % 9 = 0 THEN 'changed' WHEN id % 10 = 3 THEN 'missing' END AS fault FROM u"


@query(_strata_sql(), articles=True)
def frozen_corpus(spark, sf):
    """A sample frozen by twenty strata, each taking its longest bodies that none before it took, and held against the articles as
    they are since: every ninth has changed, of the others every tenth is gone."""
    a = articles(spark, sf).withColumn("n", F.length("body"))
    sample = CO.stratified(a.where("n > 200"), [(name, F.expr(c.replace("chr(10)", "char(10)")), most) for name, c, most in _STRATA], F.col("n"), "id")
    kept = sample.join(a.select("id", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256")), "id")
    since = a.where("id % 9 = 0 OR id % 10 <> 3").select("id", F.when(F.col("id") % 9 == 0, F.concat("body", F.lit("x"))).otherwise(F.col("body")).alias("body"))
    return CO.frozen(kept, since)
