"""Scraped pages: plain text, links, headings, lists, gates, addresses, change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import table
from docket.functions import markup as M
from docket.plans.dual import dual
from docket.registry import query


def _profile(name: str, steps: M.Steps, source: str = "html", duck_source: str = "html") -> None:
    @query(f"page_text_{name}", f"SELECT page_id, {M.duck(duck_source, steps)} AS text FROM pages")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "pages").select("page_id", M.apply(F.expr(source), steps).alias("text"))


_profile("eu", M.EU)
_profile("statute", M.STATUTE)
_profile("register", M.REGISTER)
_profile("declaration", M.DECLARATION)
_profile("without_furniture", [*M.FURNITURE, *M.INLINE])
_profile("inline_title", M.INLINE, "regexp_extract(html, r'(?is)<title>(.*?)</title>', 1)", "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")
_profile("cell_first_paragraph", M.CELL, "regexp_extract(html, r'(?is)<p>(.*?)</p>', 1)", "regexp_extract(html, '(?is)<p>(.*?)</p>', 1)")
_profile("plain_heading", M.PLAIN, "regexp_extract(html, r'(?is)<h1[^>]*>(.*?)</h1>', 1)", "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")

_LINK = r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>'


@query("page_links", f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS hrefs, regexp_extract_all(html, '{_LINK}', 2) AS labels FROM pages),
e AS (SELECT page_id, unnest(hrefs) AS href, unnest(labels) AS label, CAST(generate_subscripts(hrefs, 1) AS BIGINT) AS pos FROM l)
SELECT page_id, pos, href, {M.duck('label', M.INLINE)} AS label FROM e""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated-match extraction: groups aligned by position."""
    p = table(spark, sf_dir, "pages")
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(_LINK), F.lit(2)).alias("label"))
    e = p.select("page_id", F.posexplode(pairs).alias("pos", "l"))
    return e.select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), F.col("l.href").alias("href"), M.apply(F.col("l.label"), M.INLINE).alias("label"))


@query("page_links_first", f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS hrefs FROM pages),
e AS (SELECT page_id, unnest(hrefs) AS href, CAST(generate_subscripts(hrefs, 1) AS BIGINT) AS pos FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM e)
SELECT href, page_id, pos FROM r WHERE rn = 1""")
def page_links_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the first sight of each address (W2): a grouped minimum, so a frequent address is reduced before it moves."""
    p = table(spark, sf_dir, "pages")
    e = p.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("pos", "href"))
    first = e.groupBy("href").agg(F.min(F.struct("page_id", "pos")).alias("f"))
    return first.select("href", F.col("f.page_id").alias("page_id"), (F.col("f.pos") + 1).cast("long").alias("pos"))


_BLOCK = r"(?is)<(h[1-6]|li|p)\b[^>]*>([^<]*)"


@query("page_items_under_heading", f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{_BLOCK}', 1) AS tags, regexp_extract_all(html, '{_BLOCK}', 2) AS bodies FROM pages),
e AS (SELECT page_id, lower(unnest(tags)) AS tag, unnest(bodies) AS body, CAST(generate_subscripts(tags, 1) AS BIGINT) AS pos FROM l),
f AS (SELECT *, last_value(CASE WHEN left(tag, 1) = 'h' THEN {M.duck('body', M.INLINE)} END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos) AS section FROM e)
SELECT page_id, section, pos, {M.duck('body', M.INLINE)} AS item FROM f WHERE left(tag, 1) <> 'h' AND section IS NOT NULL""")
def page_items_under_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading forward fill (W4): items before the first heading are dropped."""
    from docket.operators.ordered import fill_heading

    p = table(spark, sf_dir, "pages")
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(1)).alias("tag"), F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(2)).alias("body"))
    e = p.select("page_id", F.posexplode(pairs).alias("pos", "b")).select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), F.lower("b.tag").alias("tag"), M.apply(F.col("b.body"), M.INLINE).alias("item"))
    return fill_heading(e, "page_id", "pos", F.col("tag").startswith("h"), F.col("item"), "section").select("page_id", "section", "pos", "item")


# The titles of an error page and of an empty shell page, and the least and most lengths.
dual("page_quality_gate", r"""
WITH t AS (SELECT page_id, length(html) AS n, lower(regexp_extract(html, r'(?is)<title>(.*?)</title>', 1)) AS title,
  trim(regexp_replace(regexp_replace(html, r'(?is)<(script|style)\b.*?</(script|style)>', ' ' /*g*/), r'<[^>]+>', ' ' /*g*/)) AS body FROM {pages})
SELECT page_id, n >= 5000 AND instr(title, 'feilmelding') = 0 AND title <> 'lovdatapro' AS real_doc, n < 500 AS stub,
  length(regexp_replace(body, r'\s+', ' ' /*g*/)) >= 50 AS has_text FROM t""")
dual("page_url_parts", r"""
SELECT page_id, regexp_extract(url, r'^(https?)://', 1) AS scheme, lower(regexp_extract(url, r'^https?://([^/:?#]+)', 1)) AS host,
  regexp_extract(url, r'^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, r'\?([^#]*)', 1) AS query, regexp_extract(url, r'#(.*)$', 1) AS fragment,
  regexp_extract(url, r'^https?://[^/]+/([a-z]{2})(/|$)', 1) AS lang FROM {pages}""")
dual("page_language_decode", r"""
WITH c AS (SELECT * FROM (VALUES ('en', 'ENG', 'English'), ('fr', 'FRE', 'French'), ('de', 'GER', 'German'), ('it', 'ITA', 'Italian'), ('ru', 'RUS', 'Russian')) AS v(two, three, name)),
p AS (SELECT page_id, regexp_extract(html, r'<html lang="([a-z]+)"', 1) AS two FROM {pages})
SELECT p.page_id, p.two, c.three, c.name FROM p LEFT JOIN c ON p.two = c.two""")
dual("page_closed", r"SELECT regexp_extract(html, r'(?i)</html>\s*$', 0) <> '' AS closed, count(*) AS pages FROM {pages} GROUP BY 1")
dual("page_content_hash", r"SELECT page_id, sha1(html) AS sha1, md5(html) AS md5, substr(sha1(html), 1, 16) AS cache_key FROM {pages}")
