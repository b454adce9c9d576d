"""Citations, treaty status, registers made from the order tables, freshness, worklists, bibliography."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import table, values, values_sql
from docket.operators import ordered
from docket.plans.dual import dual
from docket.registry import query

# --- citations ---------------------------------------------------------------------------------------------------------

_SCL = [
    ("c1", "Cristescu v. Romania, no. 13589/07, § 50, 10 January 2012;Radomilja and Others v. Croatia [GC], nos. 37685/10 and 22768/12, § 114, 20 March 2018"),
    ("c2", "Roman Zakharov v. Russia [GC], no. 47143/06, ECHR 2015; X v. Y, nos. 58170/13, 62322/14 and 24960/15"), ("c3", ""), ("c4", " ; Alone v. State"),
]
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_NOS = r"(?i)nos?\.\s*([\d/]+(?:\s*and\s*[\d/]+)*)"


@query("scl_parse", rf"""
WITH e AS (SELECT id, trim(unnest(regexp_split_to_array(scl, ';\s*'))) AS raw FROM {values_sql(_SCL, 'id, scl')}),
f AS (SELECT id, raw, regexp_extract(raw, '{_NOS}', 1) AS nos FROM e WHERE raw <> '')
SELECT id, raw, trim(regexp_replace(raw, '(?i),\s*nos?\..*$', '')) AS name, array_to_string(list_filter(regexp_split_to_array(nos, '\s+and\s+'), lambda x: contains(x, '/')), ',') AS appnos,
  nullif(regexp_extract(raw, '(\d{{1,2}}\s+({_MONTHS})\s+\d{{4}})', 1), '') AS date FROM f""")
def scl_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed citation strings to citation rows."""
    return _citations(values(spark, _SCL, "id, scl")).select("id", "raw", "name", F.array_join("appnos", ",").alias("appnos"), "date")


def _citations(cases: DataFrame) -> DataFrame:
    e = cases.select("id", F.explode(F.split("scl", r";\s*")).alias("raw")).select("id", F.trim("raw").alias("raw")).where("raw <> ''")
    appnos = F.filter(F.split(F.regexp_extract("raw", _NOS, 1), r"\s+and\s+"), lambda x: x.contains("/"))
    date = F.nullif(F.regexp_extract("raw", rf"(\d{{1,2}}\s+({_MONTHS})\s+\d{{4}})", 1), F.lit(""))
    return e.select("id", "raw", F.trim(F.regexp_replace("raw", r"(?i),\s*nos?\..*$", "")).alias("name"), appnos.alias("appnos"), date.alias("date"))


_EDGES = "(SELECT o_orderkey AS src, o_custkey * 4 AS dst FROM {orders})"
dual("citation_edges", f"SELECT src, count(*) AS cited_count, count(DISTINCT dst) AS cited FROM {_EDGES} e GROUP BY src")
dual("cited_by", f"SELECT dst AS case_id, count(DISTINCT src) AS cited_by FROM {_EDGES} e WHERE src <> dst GROUP BY dst")
dual("citation_chain2", f"""
SELECT a.src, b.dst, count(*) AS paths FROM {_EDGES} a JOIN {_EDGES} b ON a.dst = b.src WHERE a.src <> b.dst GROUP BY a.src, b.dst""")
dual("language_versions", """
SELECT a.doc_id AS left_id, b.doc_id AS right_id, a.lang AS left_lang, b.lang AS right_lang FROM {documents} a JOIN {documents} b ON a.source = b.source AND a.n_chars = b.n_chars AND a.lang < b.lang""")

# --- treaty status ------------------------------------------------------------------------------------------------------

_STATUS = "CHAPTER IV\nHUMAN RIGHTS\n4. International Covenant on Civil and Political Rights.\nNew York, 16 December 1966\nENTRY INTO FORCE:\n23 March 1976, in accordance with article 49\nREGISTRATION: 23 March 1976, No. 14668\nSTATUS: Signatories: 74. Parties: 173\nTEXT: United Nations, Treaty Series, vol. 999, p. 171"
dual("status_doc_parse", r"""
WITH t AS (SELECT 'IV-4' AS ref, %s AS text)
SELECT ref, nullif(regexp_extract(text, r'CHAPTER\s+([IVXLCDM]+)\s*\n([^\n]+)\n', 1), '') AS chapter_roman, nullif(trim(regexp_extract(text, r'CHAPTER\s+([IVXLCDM]+)\s*\n([^\n]+)\n', 2)), '') AS chapter_heading,
  nullif(regexp_replace(trim(regexp_extract(substr(text, 1, 1500), r'\s\d+\.\s*([A-Z][^\n]{8,200})', 1)), r'\.+$', ''), '') AS title,
  try_cast(nullif(regexp_extract(text, r'(?i)vol\.?\s*(\d{1,5})\s*,\s*p\.?\s*(\d{1,5})', 1), '') AS INT) AS unts_volume, try_cast(nullif(regexp_extract(text, r'(?i)vol\.?\s*(\d{1,5})\s*,\s*p\.?\s*(\d{1,5})', 2), '') AS INT) AS unts_page,
  nullif(regexp_extract(text, r'(?i)REGISTRATION:\s*[^N]{0,80}?No\.?\s*(\d{3,6})', 1), '') AS registration_number,
  try_cast(nullif(regexp_extract(text, r'Signatories:\s*(\d+)', 1), '') AS INT) AS signatories, try_cast(nullif(regexp_extract(text, r'Parties:\s*(\d+)', 1), '') AS INT) AS parties,
  nullif(trim(regexp_extract(text, r'ENTRY INTO FORCE:\s*\n+\s*([^\n]+)', 1)), '') AS entry_into_force FROM t""" % (" || chr(10) || ".join("'" + x + "'" for x in _STATUS.split("\n"))))

dual("signature_chart", r"""
WITH s AS (SELECT n.n_name AS state, p.p_partkey AS treaty, p.p_size AS y, n.n_regionkey AS bucket, (p.p_partkey + n.n_nationkey) % 3 AS flag FROM {nation} n JOIN {part} p ON p.p_partkey % 25 = n.n_nationkey)
SELECT treaty, bucket, concat(rpad(state, CAST(greatest(40, length(state)) AS INT), ' '), CASE flag WHEN 0 THEN ' [R]' WHEN 1 THEN ' [D]' ELSE '' END, ' sig=', CAST(1950 + y AS VARCHAR(9)), CASE WHEN flag > 0 THEN concat(' rat/acc=', CAST(1951 + y AS VARCHAR(9))) ELSE '' END) AS line FROM s""")
dual("signature_bucket_sizes", r"SELECT n_regionkey AS bucket, count(*) AS states, min(n_name) AS first_state FROM {nation} GROUP BY n_regionkey")
dual("declaration_tally", r"SELECT coalesce(nullif(o_orderpriority, '5-LOW'), '?') AS nature, count(*) AS n FROM {orders} GROUP BY 1")


@query("declarations_by_state", """
WITH d AS (SELECT n.n_name AS state, CAST(c.c_custkey % 20 AS VARCHAR) AS article, c.c_custkey AS id, c.c_mktsegment AS nature FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
SELECT state, count(*) AS n, string_agg(article || ':' || nature, chr(10) ORDER BY article, id) AS report FROM d GROUP BY state""")
def declarations_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped report; articles sort as text (T4), one text per state."""
    nation = F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state")))  # the fixed list of states
    d = table(spark, sf_dir, "customer").join(nation, "c_nationkey").select("state", (F.col("c_custkey") % 20).cast("string").alias("article"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("nature"))
    return d.groupBy("state").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("article", "id", "nature"))).alias("l")).select("state", "n", F.array_join(F.transform("l", lambda x: F.concat_ws(":", x["article"], x["nature"])), "\n").alias("report"))


dual("compare_states", r"""
SELECT p_type AS topic, sum(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END) AS norway, sum(CASE WHEN p_size % 2 = 1 THEN 1 ELSE 0 END) AS togo FROM {part} GROUP BY p_type""")
_RESERVED = [("a", "war"), ("a", "seas"), ("b", "tax")]
_TOPICS = [("war",), ("seas",), ("tax",), ("trade",)]
dual("reciprocity", f"""
WITH r AS {values_sql(_RESERVED, 'state, topic')}, t AS {values_sql(_TOPICS, 'topic')}
SELECT t.topic FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.topic = t.topic AND r.state = 'a') AND NOT EXISTS (SELECT 1 FROM r WHERE r.topic = t.topic AND r.state = 'b')""")

# --- registers ----------------------------------------------------------------------------------------------------------

_CASES = "(SELECT o_orderkey, concat('E-', CAST(o_orderkey % 40 AS VARCHAR(9)), '/', substr(CAST(o_orderdate AS VARCHAR(10)), 3, 2)) AS case_number, year(o_orderdate) AS y, o_orderkey % 40 AS num, o_orderstatus AS status, o_orderpriority AS kind FROM {orders})"
dual("case_list_filtered", f"SELECT o_orderkey, case_number, y FROM {_CASES} c WHERE y IN (1995, 1996) AND status = 'F' AND instr(lower(kind), 'urgent') > 0 ORDER BY y DESC, num DESC, o_orderkey LIMIT 50")
dual("case_counts", f"SELECT y, count(*) AS total, sum(CASE WHEN status = 'O' THEN 1 ELSE 0 END) AS pending, sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS decided, count(DISTINCT case_number) AS numbers FROM {_CASES} c GROUP BY y")
dual("series_union", r"""
SELECT 'a' AS series, n_name AS code FROM {nation} WHERE n_regionkey = 0 UNION ALL SELECT 'b', n_name FROM {nation} WHERE n_regionkey = 1 UNION ALL SELECT 'ab', n_name FROM {nation} WHERE n_regionkey > 1""")
dual("available_values", r"SELECT DISTINCT o_orderpriority AS value FROM {orders} WHERE NOT upper(o_orderpriority) = 'X'")
dual("state_prefix_resolve", r"""
WITH q AS (SELECT * FROM (VALUES ('al'), ('united k'), ('u'), ('germany'), ('zz top')) AS v(asked)),
m AS (SELECT q.asked, n.n_nationkey FROM q JOIN {nation} n ON left(lower(n.n_name), length(q.asked)) = q.asked),
g AS (SELECT asked, count(DISTINCT n_nationkey) AS n, min(n_nationkey) AS code FROM m GROUP BY asked)
SELECT q.asked, CASE WHEN g.n = 1 THEN g.code END AS code, coalesce(g.n, 0) AS candidates FROM q LEFT JOIN g ON q.asked = g.asked""")
dual("contains_resolve", r"""
WITH q AS (SELECT * FROM (VALUES ('an'), ('united'), ('xyz')) AS v(asked)), m AS (SELECT q.asked, n.n_name, row_number() OVER (PARTITION BY q.asked ORDER BY length(n.n_name), n.n_name) AS rn, count(*) OVER (PARTITION BY q.asked) AS n FROM q JOIN {nation} n ON instr(lower(n.n_name), q.asked) > 0)
SELECT asked, n_name AS shortest, n FROM m WHERE rn = 1""")
dual("status_carry_over", r"""
SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'Decided' WHEN 0 THEN 'Pending' END, 'Unknown') AS status FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""")
dual("status_verify", r"""
SELECT d.lang, count(*) AS cases, count(l.doc_id) AS verified, count(*) - count(l.doc_id) AS pending, sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS flagged FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY d.lang""")
dual("chapter_counts", r"SELECT n_regionkey AS chapter_int, count(*) AS treaties FROM {nation} GROUP BY n_regionkey")
dual("index_overlay", r"""
SELECT coalesce(c.c_nationkey, s.s_nationkey) AS key, c.n AS primary_n, s.n AS extra_n, coalesce(c.n, s.n) AS n FROM (SELECT c_nationkey, count(*) AS n FROM {customer} WHERE c_nationkey < 20 GROUP BY 1) c
FULL OUTER JOIN (SELECT s_nationkey, count(*) AS n FROM {supplier} WHERE s_nationkey > 3 GROUP BY 1) s ON c.c_nationkey = s.s_nationkey""")

# --- freshness ----------------------------------------------------------------------------------------------------------

_LAST = "(SELECT user_id, max(ts) AS fetched_at, count(*) AS fetches FROM {events} GROUP BY user_id)"
_NOW = "(SELECT max(ts) AS now FROM {events})"
dual("freshness_report", f"""
SELECT l.user_id, l.fetches, CASE WHEN l.fetched_at >= n.now - INTERVAL '1' DAY THEN 'fresh' WHEN l.fetched_at >= n.now - INTERVAL '14' DAY THEN 'stale' ELSE 'expired' END AS state FROM {_LAST} l JOIN {_NOW} n ON true""")
_PROBES = [
    ("u1", "a", "a", "e1", "e1", 1, 200), ("u2", "a", "b", "e1", "e1", 1, 200), ("u3", None, None, "e1", "e2", 1, 200), ("u4", None, None, None, None, 20, 200), ("u5", None, None, None, None, 3, 200), ("u6", None, None, None, None, None, None),
]
dual("conditional_freshness", f"""
SELECT url, CASE WHEN age IS NULL THEN true WHEN status IS NULL THEN true WHEN lm IS NOT NULL AND slm IS NOT NULL THEN lm <> slm WHEN etag IS NOT NULL AND setag IS NOT NULL THEN etag <> setag WHEN age > 14 THEN true ELSE false END AS changed,
  CASE WHEN age IS NULL THEN 'not cached' WHEN status IS NULL THEN 'probe failed' WHEN lm <> slm THEN 'last-modified differs' WHEN etag <> setag THEN 'etag differs' WHEN lm IS NULL AND etag IS NULL AND age > 14 THEN 'no validators and old' ELSE 'unchanged' END AS reason
FROM {values_sql(_PROBES, 'url, lm, slm, etag, setag, age, status')} p""")
dual("refresh_targets", f"SELECT l.user_id FROM {_LAST} l JOIN {_NOW} n ON l.fetched_at < n.now - INTERVAL '7' DAY")
_PACKAGES = [("nl.tar", "2026-01-02", "2026-01-01", 782), ("sf.tar", "2026-01-01", "2026-01-01", 3733), ("new.tar", "2026-01-01", None, 0), ("empty.tar", "2026-01-01", "2026-01-01", 0)]
dual("package_sync", f"SELECT filename, local IS NULL OR remote <> local OR n_files = 0 AS needs_update FROM {values_sql(_PACKAGES, 'filename, remote, local, n_files')} p")
dual("resume_pending", r"SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL")
dual("content_changed", r"SELECT a.page_id, sha1(a.html) <> sha1(b.html) AS changed FROM {pages} a JOIN {pages} b ON b.page_id = a.page_id + 1")
dual("event_props_json", r"SELECT event_type, sum(CAST(regexp_extract(props, r':\s*(\d+)', 1) AS BIGINT)) AS k, count(*) AS n FROM {events} WHERE regexp_extract(props, r':\s*(\d+)', 1) <> '' GROUP BY event_type")
_STEPS = [("server", 1, 1.0), ("server", 2, 2.0), ("server", 3, 4.0), ("waiting", 1, 5.0), ("waiting", 2, 10.0), ("waiting", 3, 10.0), ("page", 1, 1.5), ("page", 2, 3.0), ("page", 3, 4.5)]
dual("retry_schedule", f"SELECT kind, attempt, sum(CAST(delay AS DOUBLE)) OVER (PARTITION BY kind ORDER BY attempt) AS waited FROM {values_sql(_STEPS, 'kind, attempt, delay')} s")

# --- footnotes ----------------------------------------------------------------------------------------------------------


@query("ibid_resolve", """
WITH f AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS reference FROM conversations)
SELECT conv_id, turn, reference, last_value(reference IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS antecedent FROM f""")
def ibid_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short reference points to the last full one before it."""
    f = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("reference"))
    return ordered.preceding(f, "conv_id", "turn", F.col("reference"), "antecedent")


dual("footnote_letters", r"""
SELECT conv_id, turn, concat(CAST(conv_id AS VARCHAR(12)), CASE WHEN count(*) OVER (PARTITION BY conv_id, role) > 1 THEN chr(CAST(96 + row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS INT)) ELSE '' END) AS location, role FROM {conversations}""")
dual("crossref_check", r"SELECT c.conv_id, c.turn, c.turn + 2 AS target, t.turn IS NOT NULL AS found FROM {conversations} c LEFT JOIN {conversations} t ON t.conv_id = c.conv_id AND t.turn = c.turn + 2")
_SHEET = [
    ("1", "yes", "q", "no", None, None, None), ("2", "yes", "q", "yes", "Quotation not verbatim", "high", "x"), ("3", "yes", None, "yes", "Quotation not verbatim", "high", "x"), ("4", "source unavailable", "q", "no", None, None, None), ("5", "maybe", None, None, None, None, None),
]
dual("worklist_violations", f"""
SELECT location, CASE WHEN checked NOT IN ('yes', 'no', 'source unavailable') THEN 'checked' WHEN checked <> 'yes' AND discrepancy IS NOT NULL THEN 'blank when unavailable' WHEN discrepancy = 'yes' AND (severity IS NULL OR kind IS NULL) THEN 'severity'
  WHEN kind = 'Quotation not verbatim' AND quoted IS NULL THEN 'quote missing' END AS violation FROM {values_sql(_SHEET, 'location, checked, quoted, discrepancy, kind, severity, note')} w
WHERE checked NOT IN ('yes', 'no', 'source unavailable') OR (checked <> 'yes' AND discrepancy IS NOT NULL) OR (discrepancy = 'yes' AND (severity IS NULL OR kind IS NULL)) OR (kind = 'Quotation not verbatim' AND quoted IS NULL)""")
dual("worklist_colours", f"""
SELECT location, CASE WHEN checked = 'source unavailable' THEN 'grey' WHEN checked <> 'yes' THEN 'white' WHEN severity = 'high' THEN 'red' WHEN severity = 'medium' THEN 'orange' WHEN severity = 'low' THEN 'yellow' ELSE 'green' END AS colour FROM {values_sql(_SHEET, 'location, checked, quoted, discrepancy, kind, severity, note')} w""")
dual("worklist_missing", r"SELECT doc_id FROM {documents} EXCEPT SELECT doc_id FROM {labels}")
_ROUTES = [("case", 1, "own library"), ("case", 2, "court register"), ("statute", 1, "statute register"), ("treaty", 1, "own library"), ("treaty", 2, "world treaty register"), ("treaty", 3, "regional treaty register"), ("treaty", 4, "national treaty register")]
dual("tool_routing", f"SELECT category, tool FROM (SELECT category, tool, row_number() OVER (PARTITION BY category ORDER BY prio) AS rn FROM {values_sql(_ROUTES, 'category, prio, tool')} r WHERE tool <> 'own library') x WHERE rn = 1")

# --- bibliography -------------------------------------------------------------------------------------------------------

_BOOKS = [("Norges lover & <regler>: en oversikt", "Falk; Ola", "edt", "S.l.", "2001", "[358]"), ("", "Lie, Bernt", "aut", "Oslo", "", ""), ("Ærlig talt – Øst", "Åse", "trl", "Bergen", "1999", "12")]
dual("biblio_rdf", f"""
SELECT title, concat('<bib:Book>', CASE WHEN title <> '' THEN concat('<dc:title>', replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '</dc:title>') ELSE '' END,
  CASE role WHEN 'edt' THEN '<bib:editors>' WHEN 'trl' THEN '<z:translators>' ELSE '<bib:authors>' END, trim(split_part(name, ',', 1)), CASE WHEN year <> '' THEN concat('<dc:date>', year, '</dc:date>') ELSE '' END, '</bib:Book>') AS rdf,
  CASE WHEN place = 'S.l.' THEN '' ELSE place END AS place FROM {values_sql(_BOOKS, 'title, name, role, place, year, pages')} b""")


@query("basename_slug", f"""
SELECT title, coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(strip_accents(replace(replace(replace(replace(split_part(title, ':', 1), 'Æ', ''), 'æ', ''), 'Ø', ''), 'ø', '')), '[^ -~]', '', 'g'), '[^A-Za-z0-9._()-]+', '_', 'g'), '^_+|_+$', '', 'g'), 60), ''), 'Untitled') AS slug,
 coalesce(nullif(year, ''), 'n.d.') AS year FROM {values_sql(_BOOKS, 'title, name, role, place, year, pages')}""")
def basename_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names from titles (I29): NFKD folding has no built-in, so one Arrow-batched function does it."""
    @F.pandas_udf("string")
    def folded(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    plain = folded(F.split_part("title", F.lit(":"), F.lit(1)))
    slug = F.left(F.regexp_replace(F.regexp_replace(plain, r"[^A-Za-z0-9._()-]+", "_"), r"^_+|_+$", ""), F.lit(60))
    return values(spark, _BOOKS, "title, name, role, place, year, pages").select("title", F.coalesce(F.nullif(slug, F.lit("")), F.lit("Untitled")).alias("slug"), F.coalesce(F.nullif("year", F.lit("")), F.lit("n.d.")).alias("year"))


dual("library_prepworks_sql", r"""
SELECT d.doc_id, d.lang, d.source, substr(d.text, 1, 400) AS content FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id
WHERE l.quality = 1 AND d.lang IN ('en', 'fr') AND d.source LIKE 'src1%' AND d.text LIKE '%the%' ORDER BY d.doc_id LIMIT 5""")
dual("library_caselaw_sql", r"SELECT doc_id, substr(text, 1, 400) AS snippet FROM {documents} WHERE text LIKE '%re%th%on%' ORDER BY doc_id LIMIT 5")
dual("creator_roles", f"SELECT name, CASE role WHEN 'edt' THEN 'editor' WHEN 'trl' THEN 'translator' WHEN 'aut' THEN 'author' WHEN 'cre' THEN 'author' ELSE 'contributor' END AS creator_type FROM {values_sql(_BOOKS, 'title, name, role, place, year, pages')} b")
_WIDTHS = [("a", 608, 502), ("a", 608, 251), ("b", 100, 502), ("b", 100, 251), ("c", 600, None)]
dual("pick_width", f"SELECT page, target, coalesce(max(CASE WHEN width <= target THEN width END), min(width), target) AS width FROM {values_sql(_WIDTHS, 'page, target, width')} w GROUP BY page, target")
_PAGES = "SELECT p_brand, p_partkey, greatest(1, CAST({half_even}(CAST(p_size AS DOUBLE) * 100 / (CAST(297 AS DOUBLE) / CAST(25.4 AS DOUBLE)){places}) AS INT)) AS dpi FROM part"


@query("median_dpi", f"""
WITH d AS ({_PAGES.format(half_even="round_even", places=", 0")}), r AS (SELECT p_brand, dpi, row_number() OVER (PARTITION BY p_brand ORDER BY dpi, p_partkey) AS rn, count(*) OVER (PARTITION BY p_brand) AS n FROM d)
SELECT p_brand, dpi FROM r WHERE rn = CAST(floor(n / 2) AS INT) + 1""")
def median_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dots an inch of an A4 page from its height, rounded half to even; the upper median of each group (K9, A10). Counts
    of values are summed before they meet, so a group is one row for each of its few values."""
    dpi = F.greatest(F.lit(1), F.bround(F.col("p_size").cast("double") * 100 / F.lit(297 / 25.4)).cast("int"))
    counts = table(spark, sf_dir, "part").groupBy("p_brand", dpi.alias("dpi")).agg(F.count("*").alias("n"))
    held = counts.groupBy("p_brand").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("dpi", "n"))).alias("values"))
    below = lambda x: F.aggregate(F.filter("values", lambda y: y["dpi"] <= x["dpi"]), F.lit(0).cast("long"), lambda a, y: a + y["n"])
    return held.select("p_brand", F.get(F.filter("values", lambda x: below(x) > F.floor(F.col("total") / 2)), 0)["dpi"].alias("dpi"))


@query("tile_grid", """
SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(least(1024, 2500 - x) AS INT) AS w, CAST(least(1024, 3000 - y) AS INT) AS h FROM range(0, 2500, 1024) a(x), range(0, 3000, 1024) b(y)""")
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of one image, clipped at its edge (S15); a product of two short sequences inside one row."""
    one = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(2499), F.lit(1024))).alias("x"))
    grid = one.select("x", F.explode(F.sequence(F.lit(0), F.lit(2999), F.lit(1024))).alias("y"))
    return grid.select("x", "y", F.least(F.lit(1024), 2500 - F.col("x")).alias("w"), F.least(F.lit(1024), 3000 - F.col("y")).alias("h"))


_SIZES = [("a", 1, 100), ("a", 2, 140), ("a", 3, 120), ("b", 1, 50)]
dual("shrink_estimate", f"WITH r AS (SELECT doc, bytes, row_number() OVER (PARTITION BY doc ORDER BY page) AS rn, count(*) OVER (PARTITION BY doc) AS n FROM {values_sql(_SIZES, 'doc, page, bytes')} s) SELECT doc, CAST(floor(bytes * n * 0.95) AS BIGINT) AS estimate FROM r WHERE rn = CAST(floor(n / 2) AS INT) + 1")
dual("access_rights", f"SELECT id, CASE WHEN view = 'NONE' OR login <> '' THEN true ELSE false END AS requires_auth FROM {values_sql([('1', 'ALL', ''), ('2', 'NONE', ''), ('3', 'ALL', 'log in')], 'id, view, login')} a")
dual("date_formats", f"SELECT raw, coalesce(nullif(regexp_extract(raw, r'^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), ''), CASE WHEN regexp_extract(raw, r'^(\\d{{2}})/(\\d{{2}})/(\\d{{4}})', 0) <> '' THEN concat(substr(raw, 7, 4), '-', substr(raw, 4, 2), '-', substr(raw, 1, 2)) END) AS iso FROM {values_sql([('2018-09-04T00:00:00',), ('04/09/2018 00:00:00',), ('x',)], 'raw')} d")
