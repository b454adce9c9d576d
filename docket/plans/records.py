"""Nested records, open metadata, name resolution and small text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import table, values, values_sql
from docket.plans.dual import dual
from docket.registry import query

_RESPONSE = '{"resultcount": 2, "results": [{"columns": {"itemid": "001-1", "appno": "1/90;2/90", "languageisocode": "ENG"}}, {"columns": {"itemid": "001-2", "appno": "", "languageisocode": "FRE"}}]}'


@query("search_response_flatten", "SELECT * FROM (VALUES (0, '001-1', '1/90', 'ENG'), (0, '001-1', '2/90', 'ENG'), (1, '001-2', NULL, 'FRE')) AS v(pos, itemid, appno, lang)")
def search_response_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested search response with its schema stated: unwrap, then split the packed numbers."""
    kind = "resultcount INT, results ARRAY<STRUCT<columns: STRUCT<itemid: STRING, appno: STRING, languageisocode: STRING>>>"
    rows = values(spark, [(_RESPONSE,)], "body").select(F.from_json("body", kind).alias("r")).select(F.posexplode("r.results").alias("pos", "x")).select("pos", "x.columns.*")
    return rows.select("pos", "itemid", F.explode_outer(F.split(F.nullif("appno", F.lit("")), ";\\s*")).alias("appno"), F.col("languageisocode").alias("lang"))


_LABELS = {"Tittel": "title", "Dato": "date", "Sted": "place"}


@query("metadata_overlay", "SELECT * FROM (VALUES ('date', '1999'), ('place', 'Oslo'), ('title', 'A'), ('Ukjent', 'kept')) AS v(label, text)")
def metadata_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open metadata: known labels are renamed, unknown ones pass, and the primary record wins over the extra one."""
    known = F.create_map(*(F.lit(x) for pair in _LABELS.items() for x in pair))
    named = lambda m: F.transform_keys(m, lambda k, v: F.coalesce(F.try_element_at(known, k), k))
    one = spark.range(1).select(
        F.create_map(F.lit("Tittel"), F.lit("A"), F.lit("Ukjent"), F.lit("kept")).alias("a"), F.create_map(F.lit("Dato"), F.lit("1999"), F.lit("Tittel"), F.lit("B"), F.lit("Sted"), F.lit("Oslo")).alias("b")
    )
    both = one.select(named("a").alias("a"), named("b").alias("b"))
    extra = F.map_filter("b", lambda k, v: ~F.map_contains_key("a", k))
    return both.select(F.explode(F.map_concat("a", extra)).alias("label", "text"))


@query("name_resolution", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red') AND contains(lower(p_name), 'widget')")
def name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the name's head must occur."""
    head = F.split(F.lit("RED widget v. Others"), r"\s(?:v|c|vs)\.\s")[0]
    words = F.filter(F.split(F.lower(head), r"[^\w'-]+"), lambda w: F.length(w) > 1)
    return table(spark, sf_dir, "part").where(F.forall(words, lambda w: F.contains(F.lower("p_name"), w))).select("p_partkey", "p_name")


_WANTED = [("GERMANY",), ("germ",), ("united",), ("nowhere",)]
dual("did_you_mean", f"""
WITH q AS {values_sql(_WANTED, 'asked')}, miss AS (SELECT asked FROM q WHERE NOT EXISTS (SELECT 1 FROM {{nation}} n WHERE n.n_name = q.asked)),
r AS (SELECT m.asked, n.n_name, row_number() OVER (PARTITION BY m.asked ORDER BY n.n_name) AS rn FROM miss m JOIN {{nation}} n ON instr(lower(n.n_name), lower(m.asked)) > 0)
SELECT m.asked, r.n_name AS suggestion FROM miss m LEFT JOIN r ON r.asked = m.asked AND r.rn <= 5""")
dual("digit_complement_order", r"SELECT o_orderkey, translate(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), '0123456789', '9876543210') AS sort_key FROM {orders}")
dual("register_page", r"SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
dual("field_promotion", r"SELECT c_custkey AS number, c_name AS title, CAST(NULL AS VARCHAR(9)) AS parent, concat('https://example.org/treaty/', CAST(c_custkey AS VARCHAR(12))) AS source_url FROM {customer}")
_SLUGS = [("case-e-14",), ("x",), ("14a-REV-o'b",), ("",)]


@query("title_case_slug", f"""
WITH w AS (SELECT raw, replace(raw, '-', ' ') AS words FROM {values_sql(_SLUGS, 'raw')})
SELECT raw, words, array_to_string([CASE WHEN i = 1 OR NOT regexp_matches(substr(words, i - 1, 1), '[[:alpha:]]') THEN upper(substr(words, i, 1)) ELSE lower(substr(words, i, 1)) END FOR i IN range(1, length(words) + 1)], '') AS label FROM w""")
def title_case_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every letter that follows no letter is raised, the others are lowered."""
    words = values(spark, _SLUGS, "raw").select("raw", F.replace("raw", F.lit("-"), F.lit(" ")).alias("words"))
    marks = F.split("words", "")
    inside = lambda i: (i > 0) & F.coalesce(F.get(marks, i - 1).rlike(r"\p{L}"), F.lit(False))
    return words.select("raw", "words", F.array_join(F.transform(marks, lambda c, i: F.when(inside(i), F.lower(c)).otherwise(F.upper(c))), "").alias("label"))


@query("capture_between", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS pos FROM documents),
s AS (SELECT *, sum(CASE WHEN pos = 2 THEN 1 ELSE 0 END) OVER w AS started, sum(CASE WHEN line LIKE 'Licensed%' THEN 1 ELSE 0 END) OVER w AS stopped FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM s WHERE started > 0 AND stopped = 0 GROUP BY doc_id""")
def capture_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an anchor to a sentinel (W10), inside the row: line two up to the licence line."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("ls"))
    stop = F.array_position(F.transform("ls", lambda x: x.startswith("Licensed")), True)
    end = F.when(stop > 0, stop - 1).otherwise(F.size("ls"))
    part = lines.where(F.size("ls") > 1).select("doc_id", F.slice("ls", F.lit(2), F.greatest(end - 1, F.lit(0)).cast("int")).alias("p")).where(F.size("p") > 0)
    return part.select("doc_id", F.size("p").cast("long").alias("lines"), F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


@query("query_string", "SELECT 'year=1999&search=a%20%26%20b%2Fc' AS qs")
def query_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent-encoded parameters (F16)."""
    enc = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return values(spark, [("1999", "a & b/c")], "year, search").select(F.concat(F.lit("year="), enc("year"), F.lit("&search="), enc("search")).alias("qs"))
