"""Documents: quotation checks, versions, searches, slices, paragraph splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import table, values, values_sql
from docket.operators import lucene, verify
from docket.plans.dual import dual
from docket.registry import query


@query("quote_verify", """
WITH hit AS (SELECT b.item_id, d.doc_id, strpos(d.text, b.text) AS pos FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE length(b.text) > 0),
f AS (SELECT item_id, count(*) AS n, min(doc_id) AS first_doc, arg_min(pos, doc_id) AS first_pos FROM hit GROUP BY item_id)
SELECT b.item_id, coalesce(f.n, 0) AS n_sources, f.first_doc, CAST(f.first_pos AS BIGINT) AS first_pos,
  CASE WHEN f.n IS NULL THEN 'source unavailable' ELSE 'yes' END AS checked FROM benchmark b LEFT JOIN f ON b.item_id = f.item_id""")
def quote_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: which quotations occur verbatim, in how many sources, and where first."""
    quotes = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "quote")
    sources = table(spark, sf_dir, "documents").select("doc_id", "text")
    if sources.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        sources = sources.repartition(spark.sparkContext.defaultParallelism)
    hits = verify.occurrences(quotes, sources, "quote", "text").select("item_id", "doc_id", F.call_function("locate", F.col("quote"), F.col("text")).alias("pos"))
    found = hits.groupBy("item_id").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("f"))
    checked = F.when(F.col("n").isNull(), "source unavailable").otherwise("yes")
    out = quotes.select("item_id").join(found, "item_id", "left")
    return out.select("item_id", F.coalesce("n", F.lit(0)).alias("n_sources"), F.col("f.doc_id").alias("first_doc"), F.col("f.pos").cast("long").alias("first_pos"), checked.alias("checked"))


@query("quote_pinpoint", """
WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS para FROM documents),
hit AS (SELECT b.item_id, d.doc_id, b.text AS quote FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
j AS (SELECT h.item_id, h.doc_id, min(CASE WHEN contains(p.body, h.quote) THEN p.para END) AS para FROM hit h JOIN p ON p.doc_id = h.doc_id GROUP BY 1, 2)
SELECT item_id, doc_id, para, CASE WHEN para = 1 THEN 'as cited' WHEN para IS NULL THEN 'spans paragraphs' ELSE 'Wrong page/section/paragraph' END AS verdict FROM j""")
def quote_pinpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the quote in the cited paragraph (here the first)? Otherwise the real one (Q3)."""
    quotes = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "quote")
    hits = verify.occurrences(quotes, table(spark, sf_dir, "documents").select("doc_id", "text"), "quote", "text")
    paras = hits.select("item_id", "doc_id", "quote", F.split("text", "\n").alias("ps"))
    at = F.array_position(F.transform("ps", lambda p: F.contains(p, F.col("quote"))), True)
    verdict = F.when(F.col("para") == 1, "as cited").when(F.col("para").isNull(), "spans paragraphs").otherwise("Wrong page/section/paragraph")
    return paras.select("item_id", "doc_id", F.nullif(at, F.lit(0)).cast("long").alias("para")).withColumn("verdict", verdict)


_QUOTED = [
    ("1", "the “law” of the land", 'It is the "law" of the land.'), ("2", "law of […] land", "the law of the land"), ("3", "land … law", "the law of the land"),
    ("4", "of the land", "the law of the land"), ("5", "of a land", "the law of the land"),
]


@query("quote_tolerance", f"""
SELECT id, contains(source, quote) AS verbatim, CASE id WHEN '2' THEN true WHEN '4' THEN true ELSE contains(source, quote) END AS with_gaps,
 CASE WHEN id IN ('2', '4') THEN NULL WHEN contains(translate(source, '“”„«»‘’‚', '\"\"\"\"\"''''''')  , translate(quote, '“”„«»‘’‚', '\"\"\"\"\"''''''')) THEN 'low' ELSE 'high' END AS severity
FROM {values_sql(_QUOTED, 'id, quote, source')}""")
def quote_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and quotation marks in quotes (Q2, Q5)."""
    q = values(spark, _QUOTED, "id, quote, source")
    quote, source = F.col("quote"), F.col("source")
    verbatim, gaps = F.contains(source, quote), verify.fragments_in_order(quote, source)
    marks = F.contains(verify.same_marks(source), verify.same_marks(quote))
    return q.select("id", verbatim.alias("verbatim"), gaps.alias("with_gaps"), verify.severity(verbatim, gaps, marks).alias("severity"))


@query("quote_status_rollup", """
WITH hit AS (SELECT b.item_id, d.doc_id, d.lang FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
s AS (SELECT h.*, CASE WHEN l.quality = 0 THEN 'high' WHEN l.toxic = 1 THEN 'medium' WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'none' END AS severity FROM hit h LEFT JOIN labels l ON l.doc_id = h.doc_id)
SELECT severity, lang, CAST(grouping(severity) AS INT) AS all_severities, CAST(grouping(lang) AS INT) AS all_langs, count(*) AS n, count(DISTINCT item_id) AS items FROM s GROUP BY GROUPING SETS ((severity), (lang), ())""")
def quote_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the worklist by severity, by language and in all."""
    quotes = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "quote")
    hits = verify.occurrences(quotes, table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "quote", "text").select("item_id", "doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("known"))
    severity = F.when(F.col("quality") == 0, "high").when(F.col("toxic") == 1, "medium").when(F.col("known").isNull(), "unlabelled").otherwise("none")
    rows = hits.join(labels, "doc_id", "left").select("item_id", "lang", severity.alias("severity"))
    sets = rows.groupingSets([["severity"], ["lang"], []], "severity", "lang")
    return sets.agg(F.grouping("severity").cast("int").alias("all_severities"), F.grouping("lang").cast("int").alias("all_langs"), F.count("*").alias("n"), F.countDistinct("item_id").alias("items"))


@query("doc_versions_best", """
WITH r AS (SELECT d.doc_id, d.source, d.lang, l.quality, row_number() OVER (PARTITION BY d.source ORDER BY CASE WHEN l.quality = 1 THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END,
  CASE d.lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END, d.n_chars DESC, d.doc_id) AS rn FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT source, doc_id, lang, quality FROM r WHERE rn = 1""")
def doc_versions_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best version of each source in a stated order (J18): a minimum that tasks take before rows move, so a source that
    holds most documents is one row of each task."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rank = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    tongue = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).otherwise(2)
    best = F.min(F.struct(rank.alias("r"), tongue.alias("t"), (-F.col("n_chars")).alias("c"), "doc_id", "lang", "quality"))
    return docs.groupBy("source").agg(best.alias("b")).select("source", "b.doc_id", "b.lang", "b.quality")


# Kinds and branches of decisions in order of preference.
_VERSIONS = [
    ("14038/88", "a", "HEDEC", "ADMISSIBILITY", "ENG", "2003-01-01"), ("14038/88", "b", "HEJUD", "GRANDCHAMBER", "ENG", "2006-05-04"), ("14038/88", "c", "HEJUD", "CHAMBER", "ENG", "2007-01-01"),
    ("1/90", "d", "HFJUD", "CHAMBER", "FRE", "1992-01-01"), ("1/90", "e", "HEJUD", "CHAMBER", "ENG", "1991-01-01"), ("2/90", "f", "CLIN", "X", "ENG", None), ("2/90", "g", "PR", "X", "ENG", "1999-01-01"),
]
dual("ecthr_best_version", rf"""
WITH v AS {values_sql(_VERSIONS, 'appno, itemid, doctype, branch, lang, kpdate')},
r AS (SELECT *, row_number() OVER (PARTITION BY appno ORDER BY
  CASE WHEN doctype IN ('HEJUD', 'HFJUD') THEN 0 WHEN doctype IN ('HEDEC', 'HFDEC') THEN 1 WHEN doctype IN ('ADV', 'HEADV', 'HFADV') THEN 2 WHEN doctype IN ('CLIN', 'INFONOTE') THEN 3 WHEN doctype LIKE 'HERES%' OR doctype LIKE 'HFRES%' THEN 4 WHEN doctype = 'PR' THEN 6 ELSE 5 END,
  CASE branch WHEN 'GRANDCHAMBER' THEN 0 WHEN 'CHAMBER' THEN 1 WHEN 'COMMITTEE' THEN 2 WHEN 'ADMISSIBILITY' THEN 3 WHEN 'ADMISSIBILITYCOM' THEN 4 WHEN 'MERITS' THEN 5 ELSE 9 END,
  CASE lang WHEN 'ENG' THEN 0 WHEN 'FRE' THEN 1 ELSE 2 END, kpdate DESC NULLS LAST, itemid) AS rn FROM v)
SELECT appno, itemid, doctype, branch FROM r WHERE rn = 1""")
dual("doc_dedupe_first", r"SELECT sha1(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM {documents} GROUP BY 1")
dual("doc_exact_versions", r"""
WITH h AS (SELECT sha1(text) AS hash, source, doc_id FROM {documents}), g AS (SELECT hash, min(doc_id) AS first_doc, count(*) AS n FROM h GROUP BY hash HAVING count(*) > 1)
SELECT h.doc_id, g.first_doc, g.n FROM h JOIN g ON h.hash = g.hash WHERE h.doc_id <> g.first_doc""")


@query("doc_consecutive_collapse", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS pos FROM documents),
w AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM l)
SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE before IS NULL OR before <> line) AS kept FROM w GROUP BY doc_id""")
def doc_consecutive_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent equal lines count once (W3); the lines of a text stay in one row, so nothing is shuffled."""
    lines = F.split("text", "\n")
    kept = F.size(F.filter(F.col("ls"), lambda x, i: (i == 0) | (F.get(F.col("ls"), F.greatest(i - 1, F.lit(0))) != x)))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", lines.alias("ls")).select("doc_id", F.size("ls").cast("long").alias("lines"), kept.cast("long").alias("kept"))


@query("para_split", r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), n AS (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM l)
SELECT doc_id, CAST(i + 1 AS INT) AS para, rtrim('T' || ls[i + 1] || CASE WHEN i % 3 = 0 AND i + 1 < len(ls) THEN chr(10) || CAST(i + 1002 AS VARCHAR) || ' T' || ls[i + 2] ELSE '' END, ' ' || chr(9) || chr(10)) AS body
FROM n WHERE i % 3 <> 1""")
def para_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monotonic paragraph counter (W5) over all documents, their lines numbered with every third number out of order:
    such a line stays in the paragraph before it, and the next number is still accepted."""
    from docket.operators.paragraphs import split_paragraphs

    number = lambda i: i + 1 + F.when(i % 3 == 1, 1000).otherwise(0)
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(number(i).cast("string"), F.lit(" T"), x))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    return split_paragraphs(docs, "doc_id", "text")


dual("line_grep", r"""
SELECT doc_id, length(text) - length(replace(text, 'Licensed under', 'icensed under')) AS hits, substr(text, greatest(instr(text, 'Licensed under') - 60, 1), 180) AS snippet FROM {documents} WHERE text LIKE '%Licensed under%'""")
dual("snippet_search", r"""
SELECT doc_id, source, substr(text, greatest(instr(lower(text), 'thing') - 200, 1), 400) AS context FROM {documents} WHERE instr(lower(text), 'thing') > 0""")
dual("search_with_fulltext_fallback", r"""
SELECT doc_id, CASE WHEN instr(lower(concat(source, ' ', lang)), 'src1') > 0 THEN 'header' ELSE 'text' END AS found_in, CASE WHEN instr(lower(concat(source, ' ', lang)), 'src1') > 0 THEN source ELSE substr(text, greatest(instr(lower(text), 'stupid') - 60, 1), 180) END AS snippet
FROM {documents} WHERE instr(lower(concat(source, ' ', lang)), 'src1') > 0 OR instr(lower(text), 'stupid') > 0""")


@query("lucene_filter", """
SELECT doc_id, lang, source FROM documents WHERE ((lower(lang) LIKE '%en%' AND lower(source) LIKE '%src1%') OR (lower(lang) LIKE '%fr%' AND NOT lower(text) LIKE '%la%')) AND coalesce(source, '') <> '' AND source BETWEEN 'src1' AND 'src5'""")
def lucene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search language as a filter."""
    condition = lucene.compile_query("(lang:en AND source:(src1) OR lang:fr NOT text:la) source:* source:[src1 TO src5]")
    return table(spark, sf_dir, "documents").where(condition).select("doc_id", "lang", "source")


def _ranked(name: str, score: str, order: str, limit: int) -> None:
    dual(name, rf"SELECT p_partkey, p_name, score FROM (SELECT p_partkey, p_name, CAST({score} AS INT) AS score FROM {{part}}) s WHERE score > 0 ORDER BY {order} LIMIT {limit}")


_hay = "lower(concat(p_name, ' ', p_brand))"
_ranked("title_search_ranked_un", f"(CASE WHEN instr({_hay}, 'red ring') > 0 THEN 100 ELSE 0 END) + (CASE WHEN instr({_hay}, 'red') > 0 THEN 5 ELSE 0 END) + (CASE WHEN instr({_hay}, 'ring') > 0 THEN 5 ELSE 0 END) + (CASE WHEN left({_hay}, 8) = 'red ring' THEN 50 ELSE 0 END)", "score DESC, p_partkey", 10)
_ranked("title_search_statute", "(CASE WHEN instr(lower(p_name), 'a') > 0 THEN 2 ELSE 0 END) + (CASE WHEN instr(lower(p_type), 's') > 0 THEN 3 ELSE 0 END)", "score DESC, p_partkey", 15)


@query("title_search_coe", """
WITH p AS (SELECT p_partkey, p_name, lower(concat(p_name, ' ', p_type)) AS hay FROM part),
w AS (SELECT *, len(list_intersect(list_distinct(regexp_split_to_array('small red ring', '[^a-z0-9]+')), list_distinct(regexp_split_to_array(hay, '[^a-z0-9]+')))) AS shared FROM p)
SELECT p_partkey, p_name, CAST(floor(100.0 * shared / 3 + CASE WHEN contains(hay, 'small red ring') THEN 50 ELSE 0 END) AS INT) AS score FROM w WHERE shared > 0 ORDER BY score DESC, p_partkey DESC LIMIT 10""")
def title_search_coe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word overlap and containment; whole ranking tuple descending."""
    asked = "small red ring"
    hay = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    shared = F.size(F.array_intersect(F.array_distinct(F.split(F.lit(asked), "[^a-z0-9]+")), F.array_distinct(F.split(hay, "[^a-z0-9]+"))))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", hay.alias("hay"), shared.alias("shared")).where("shared > 0")
    score = F.floor(100.0 * F.col("shared") / 3 + F.when(F.contains("hay", F.lit(asked)), 50).otherwise(0)).cast("int")
    return p.select("p_partkey", "p_name", score.alias("score")).orderBy(F.desc("score"), F.desc("p_partkey")).limit(10)


@query("sentence_slice", """
WITH s AS (SELECT doc_id, strpos(text, chr(10)) AS a, text FROM documents WHERE contains(text, chr(10)))
SELECT doc_id, substr(text, a + 1, CASE WHEN strpos(substr(text, a + 1), chr(10)) > 0 THEN strpos(substr(text, a + 1), chr(10)) - 1 ELSE length(text) END) AS second FROM s""")
def sentence_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one marker to the next (W6): the second line of each text."""
    return table(spark, sf_dir, "documents").where(F.contains("text", F.lit("\n"))).select("doc_id", F.get(F.split("text", "\n", 3), 1).alias("second"))
