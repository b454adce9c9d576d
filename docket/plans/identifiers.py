"""Identifier grammars as column expressions, run over worked examples and over registers made from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import values, values_sql
from docket.plans.dual import dual
from docket.registry import query


def over(name: str, refs: list[str], sql: str) -> None:
    """A query over a list of references, column ``raw``."""
    dual(name, sql.replace("{refs}", values_sql([(r,) for r in refs], "raw")))


over("ident_ecthr", ["14038/88", " 001-57619 ", "003-8420063-11915360", "37685/10;22768/12", "case name", "1234567/88"], r"""
SELECT raw, regexp_extract(trim(raw), r'^\d{3}-\d+(-\d+)?$', 0) <> '' AS is_itemid,
  regexp_extract(trim(raw), r'^\d{1,6}/\d{2}(;\d{1,6}/\d{2})*$', 0) <> '' AS is_appno,
  nullif(regexp_extract(trim(raw), r'^(\d{1,6}/\d{2})(;\d{1,6}/\d{2})*$', 1), '') AS first_appno FROM {refs}""")

_ROMANS = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX", "XX", "XXI", "XXII", "XXIII", "XXIV", "XXV", "XXVI", "XXVII", "XXVIII", "XXIX", "XXX"]
ROMAN_SQL = values_sql([(r, i) for i, r in enumerate(_ROMANS, 1)], "roman, n")
over("ident_mtdsg", ["IV-4", "iv - 4", "IV-11a", "IV-11-a", "XXVI-b", "XXIII-1", "ZZ-1", "XIII-2"], rf"""
WITH u AS (SELECT raw, upper(regexp_replace(raw, r'\s+', '' /*g*/)) AS s FROM {{refs}}),
p AS (SELECT raw, regexp_extract(s, r'^([IVXLCDM]+)-(\d+)(-?[A-Z])?$', 1) AS r1, regexp_extract(s, r'^([IVXLCDM]+)-(\d+)(-?[A-Z])?$', 2) AS section,
  replace(regexp_extract(s, r'^([IVXLCDM]+)-(\d+)(-?[A-Z])?$', 3), '-', '') AS x1, regexp_extract(s, r'^([IVXLCDM]+)-([A-Z])$', 1) AS r2, regexp_extract(s, r'^([IVXLCDM]+)-([A-Z])$', 2) AS x2 FROM u),
q AS (SELECT raw, CASE WHEN r1 <> '' THEN r1 ELSE r2 END AS chapter, section, CASE WHEN r1 <> '' THEN x1 ELSE x2 END AS suffix FROM p)
SELECT q.raw, r.n AS chapter_int, try_cast(nullif(section, '') AS INT) AS section, suffix,
  CASE WHEN r.n IS NOT NULL THEN concat(chapter, '-', section, suffix) END AS ref, CASE WHEN r.n IS NOT NULL THEN concat(chapter, '-', section, lower(suffix)) END AS slug,
  CASE WHEN r.n IS NOT NULL THEN CASE WHEN r.n <= 12 THEN 'I' ELSE 'II' END END AS volume
FROM q LEFT JOIN {ROMAN_SQL} r ON q.chapter = r.roman""")

over("ident_cets", ["5", "005", "CETS 5", "ETS no. 5", "Convention no 108", "#210", "treaty 1234", "abc"], r"""
WITH s AS (SELECT raw, regexp_extract(lower(trim(raw)), r'^(?:(?:cets|ets|treaty|convention)[^0-9]*)?(?:no\.?\s*)?#?\s*(\d{1,3})$', 1) AS d FROM {refs})
SELECT raw, CASE WHEN d <> '' THEN lpad(d, 3, '0') END AS number FROM s""")

over("ident_efta", ["E-14/15", "e14-15", "e 14/15", "E-08/26", "8/25", "E0825", "e-3/2020", "E-14_15", "e 3 20"], r"""
WITH s AS (SELECT raw, regexp_extract(raw, r'(?i)(?:E\s*-?\s*)?0*(\d+)\s*[-/_\s]\s*0*(\d+)', 1) AS n, regexp_extract(raw, r'(?i)(?:E\s*-?\s*)?0*(\d+)\s*[-/_\s]\s*0*(\d+)', 2) AS y FROM {refs}),
k AS (SELECT raw, n, CASE WHEN length(y) < 2 THEN concat('0', y) ELSE y END AS y FROM s)
SELECT raw, CASE WHEN n <> '' THEN concat('E-', n, '/', y) END AS case_number,
  CASE WHEN n <> '' THEN CASE WHEN length(y) = 4 THEN CAST(y AS INT) WHEN CAST(y AS INT) >= 94 THEN 1900 + CAST(y AS INT) ELSE 2000 + CAST(y AS INT) END END AS year FROM k""")

over("ident_celex", ["62021CJ0488", "C-371/02", "C-106/89", "32003L0088", "C-9/20", "x"], r"""
WITH s AS (SELECT raw, regexp_extract(raw, r'^6(\d{4})CJ(\d{4})$', 1) AS y, regexp_extract(raw, r'^6(\d{4})CJ(\d{4})$', 2) AS n,
  regexp_extract(raw, r'^C-(\d+)/(\d{2})$', 1) AS cn, regexp_extract(raw, r'^C-(\d+)/(\d{2})$', 2) AS cy, regexp_extract(raw, r'\b([1-9]\d{4}[A-Z]{1,2}\d{2,4})\b', 1) AS found FROM {refs})
SELECT raw, nullif(found, '') AS celex_in_text, CASE WHEN y <> '' THEN concat('C-', CAST(CAST(n AS INT) AS VARCHAR(9)), '/', substr(y, 3, 2)) END AS case_number,
  CASE WHEN cn <> '' THEN concat('6', CASE WHEN CAST(cy AS INT) >= 53 THEN '19' ELSE '20' END, cy, 'CJ', lpad(cn, 4, '0')) END AS celex FROM s""")

over("ident_norway", ["HR-2016-2554-P (Holship)", "LG-2008-135938", "TR-2019-12", "Ot.prp. nr. 3 (1998-99)", "Prop. 71 L (2024-2025)", "Prop. 1 (2024-2025)", "Innst. 521 L (2024-2025)", "NOU 2022:8", "NOU 1999: 27a", "LBSIV/avgjorelse/lb-2020-1", "Rt. 2000 s. 1811"], r"""
WITH t AS (SELECT raw, trim(raw) AS s, CASE WHEN regexp_extract(raw, r'\([0-9\x{2013}-]+\)\s*$', 0) <> '' THEN trim(raw) ELSE trim(regexp_replace(raw, r'\s*\([^)]*\)\s*$', '')) END AS p,
  regexp_extract(raw, r'\((\d{4})\s*-\s*(\d{2,4})\)', 1) AS y1, regexp_extract(raw, r'\((\d{4})\s*-\s*(\d{2,4})\)', 2) AS y2 FROM {refs}),
k AS (SELECT raw, concat(y1, substr(y2, length(y2) - 1, 2)) AS session, y1,
  regexp_extract(p, r'(?i)^([A-Z]+)/(avgjorelse|forarbeid)/([a-z0-9-]+)$', 1) AS a1, regexp_extract(p, r'(?i)^([A-Z]+)/(avgjorelse|forarbeid)/([a-z0-9-]+)$', 2) AS a2, regexp_extract(p, r'(?i)^([A-Z]+)/(avgjorelse|forarbeid)/([a-z0-9-]+)$', 3) AS a3,
  regexp_extract(p, r'(?i)^HR-\d{4}-\d+-[A-Z]$', 0) AS hr, upper(regexp_extract(p, r'(?i)^(LB|LA|LE|LF|LG|LH|TR)-\d{4}-\d+[A-Za-z0-9-]*$', 1)) AS court, lower(p) AS lp,
  regexp_extract(s, r'(?i)^Ot\.?\s*pr[op]p?\.?\s*nr\.?\s*(\d+)\s*\(', 1) AS ot, regexp_extract(s, r'(?i)^(Prop|Innst)\.?\s*(\d+)\s*([A-Z]*)\s*\(', 1) AS kind,
  regexp_extract(s, r'(?i)^(Prop|Innst)\.?\s*(\d+)\s*([A-Z]*)\s*\(', 2) AS num, lower(regexp_extract(s, r'(?i)^(Prop|Innst)\.?\s*(\d+)\s*([A-Z]*)\s*\(', 3)) AS letter,
  regexp_extract(s, r'(?i)^NOU\s*(\d{4})\s*[:\s]\s*(\d+[A-Z]?)', 1) AS ny, lower(regexp_extract(s, r'(?i)^NOU\s*(\d{4})\s*[:\s]\s*(\d+[A-Z]?)', 2)) AS nn FROM t),
r AS (SELECT raw, CASE WHEN a1 <> '' THEN concat(upper(a1), '/', lower(a2), '/', lower(a3)) WHEN hr <> '' THEN concat('HRSIV/avgjorelse/', lower(hr)) WHEN court <> '' THEN concat(court, 'SIV/avgjorelse/', lp)
  WHEN ot <> '' AND y1 <> '' THEN concat('PROP/forarbeid/otprp-', ot, '-', session)
  WHEN kind <> '' AND y1 <> '' THEN concat(CASE WHEN lower(kind) = 'prop' THEN 'PROP/forarbeid/prop-' ELSE 'INNST/forarbeid/inns-' END, num, CASE WHEN letter <> '' THEN concat('-', letter) ELSE '' END, '-', session)
  WHEN ny <> '' THEN concat('NOU/forarbeid/nou-', ny, '-', nn) END AS path,
  CASE WHEN a1 <> '' THEN NULL WHEN hr <> '' THEN 'HRSTR' WHEN court <> '' THEN concat(court, 'STR') WHEN ot <> '' AND y1 <> '' THEN 'OTPRP' END AS alternative FROM k)
SELECT raw, path, alternative, path IS NULL AS needs_search,
  CASE WHEN alternative IS NOT NULL THEN concat(alternative, substr(path, instr(path, '/'))) END AS swapped FROM r""")

over("ident_pcij", ["A10", "A 10", "A-10", "B 4", "A/B 53", "AB 53", 'A10 "Lotus"', "C1"], r"""
WITH s AS (SELECT raw, upper(regexp_extract(regexp_replace(raw, r'\s+', '' /*g*/), r'(?i)^(A/B|A|B)[-/]?(\d{1,3})', 1)) AS series, regexp_extract(regexp_replace(raw, r'\s+', '' /*g*/), r'(?i)^(A/B|A|B)[-/]?(\d{1,3})', 2) AS n FROM {refs})
SELECT raw, CASE WHEN series = '' THEN NULL WHEN series = 'A/B' THEN concat('A/B', CAST(CAST(n AS INT) AS VARCHAR(9))) ELSE concat(series, CASE WHEN CAST(n AS INT) < 10 THEN '0' ELSE '' END, CAST(CAST(n AS INT) AS VARCHAR(9))) END AS code,
  CASE series WHEN 'A/B' THEN 'ab' WHEN 'A' THEN 'a' WHEN 'B' THEN 'b' END AS series FROM s""")

_FILED = r"(?i)/case-related/(\d+)/(\d+)-(\d{8})-([a-z]+)-(\d{2}-\d{2})-([a-z]+)\.pdf$"
_PARTS = ", ".join(f"regexp_extract(raw, r'{_FILED}', {i}) AS {name}" for i, name in enumerate(("a", "b", "d", "t", "serial", "lang"), 1))
over("ident_icj_pdf", ["/sites/default/files/case-related/70/70-19840510-ord-01-00-en.pdf", "/case-related/70/070-19840510-JUD-01-00-EN.pdf", "/case-related/71/70-19840510-ord-01-00-en.pdf", "/x.pdf"], f"""
WITH s AS (SELECT raw, {_PARTS} FROM {{refs}})
SELECT raw, CAST(a AS INT) AS case_id, concat(substr(d, 1, 4), '-', substr(d, 5, 2), '-', substr(d, 7, 2)) AS date, lower(t) AS doc_type, serial, lower(lang) AS lang
FROM s WHERE a <> '' AND try_cast(a AS INT) = try_cast(b AS INT)""")

# Kinds of media in identifiers, and the prefixes that may stand before them.
MEDIA = ["digibok", "digavis", "digifoto", "digitidsskrift", "digikart", "digimanus", "digiprogramrapport", "pliktmonografi", "pliktperiodika"]
URN_PREFIXES = ["URN:NBN:no-nb_", "urn:nbn:no-nb_", "urn:nbn:no-nb:"]
over("ident_media", ["URN:NBN:no-nb_digibok_2008051600041", "digavis_1", "http://x", "no-nb_digitidsskrift_12", "urn:nbn:no-nb:pliktmonografi_7a", " pliktperiodika_1 ", "digilyd_1", "digibok_2-1"], f"""
WITH s AS (SELECT raw, regexp_replace(trim(raw), r'^({"|".join(URN_PREFIXES)})', '') AS bare FROM {{refs}}),
k AS (SELECT raw, nullif(regexp_extract(bare, r'^({"|".join(MEDIA)})_[0-9A-Za-z]+$', 0), '') AS media_id FROM s)
SELECT raw, media_id, CASE WHEN media_id IS NOT NULL THEN concat('URN:NBN:no-nb_', media_id) END AS urn FROM k""")

over("ident_article", ["Artikkel II", "Art. 4", "33", "xxxiii", "ARTIKKEL iv"], rf"""
WITH s AS (SELECT raw, upper(trim(regexp_replace(raw, r'(?i)^\s*(artikkel|art\.?)\s*', ''))) AS k FROM {{refs}})
SELECT raw, lower(k) AS key, coalesce(CAST(a.n AS VARCHAR(4)), lower(b.roman)) AS other FROM s LEFT JOIN {ROMAN_SQL} a ON s.k = a.roman LEFT JOIN {ROMAN_SQL} b ON s.k = CAST(b.n AS VARCHAR(4))""")

over("ident_treaty_id", ["1948-12-09-1", "x/1999-01-02-33?a", "none"], r"""
SELECT raw, nullif(regexp_extract(raw, r'\d{4}-\d{2}-\d{2}-\d+', 0), '') AS id, try_cast(substr(nullif(regexp_extract(raw, r'\d{4}-\d{2}-\d{2}-\d+', 0), ''), 1, 4) AS INT) AS year FROM {refs}""")

over("ident_efta_label", ["14/15 Judgment 19/04/2017 EN", "8/26 Request AO 06/05/2026 NO", "8/26 Summary of the request 6/5/26 EN", "odd"], r"""
WITH n AS (SELECT * FROM (VALUES ('judgment', 'judgment'), ('advisory opinion', 'advisory-opinion'), ('order', 'order'), ('costs order', 'costs-order'), ('request ao', 'request'), ('request', 'request'), ('notification', 'notification'),
  ('summary of the request', 'summary'), ('report for the hearing', 'report'), ('opinion of the advocate general', 'opinion-aag'), ('opinion', 'opinion')) AS v(label, kind)),
s AS (SELECT raw, lower(regexp_extract(raw, r'^(\d+/\d+)\s+(.+?)\s+(\d{1,2}/\d{1,2}/\d{2,4})\s+([A-Z]{2,3})$', 2)) AS t, regexp_extract(raw, r'^(\d+/\d+)\s+(.+?)\s+(\d{1,2}/\d{1,2}/\d{2,4})\s+([A-Z]{2,3})$', 3) AS date,
  regexp_extract(raw, r'^(\d+/\d+)\s+(.+?)\s+(\d{1,2}/\d{1,2}/\d{2,4})\s+([A-Z]{2,3})$', 4) AS lang FROM {refs})
SELECT raw, coalesce(n.kind, s.t) AS type, s.date, s.lang FROM s LEFT JOIN n ON s.t = n.label""")

over("ident_declaration_link", ["Norway 24 June 1996", "Costa Rica 20 February 1973", "Togo"], r"""
SELECT raw, regexp_extract(raw, r'^(\D*?)\s*(\d.*)?$', 1) AS state, nullif(regexp_extract(raw, r'^(\D*?)\s*(\d.*)?$', 2), '') AS deposited FROM {refs}""")
over("ident_paragraph_sign", ["5", "§ 12 a", "§3-1"], r"SELECT raw, concat('§', regexp_replace(replace(raw, '§', ''), r'\s+', '' /*g*/)) AS section FROM {refs}")
# words hold letters, digits, low lines, apostrophes and hyphens; those of one character count only if there is no other
_WORDS = r"trim(regexp_replace({}, r'[^\p{{L}}\p{{N}}_\x27-]+', '  ' /*g*/))"
over("ident_case_head", ["Radomilja and Others v. Croatia", "X c. Suisse", "Smith vs UK", "Alone", "O'Keeffe v. Ireland", "Ærø & Öz-Türk vs. B v. C", "X v. Y"], rf"""
WITH h AS (SELECT raw, regexp_replace(raw, r'\s+(v\.|c\.|vs\.?)\s+.*$', '') AS head FROM {{refs}}),
t AS (SELECT raw, head, trim(regexp_replace(regexp_replace(concat(' ', {_WORDS.format("head")}, ' '), r' [^ ] ', ' ' /*g*/), r' +', ' ' /*g*/)) AS long_words, regexp_replace({_WORDS.format("raw")}, r' +', ' ' /*g*/) AS all_words FROM h)
SELECT raw, head, CASE WHEN long_words <> '' THEN long_words ELSE all_words END AS tokens FROM t""")

# Words that name the procedure, and the country in a list of referring bodies and in the names of the parties.
_PROCEDURES = [("AO", ["advisory", "preliminary"]), ("INF", ["fulfil", "infringement"]), ("DA", ["annulment", "failure-to-act"])]
_REFERRING = [
    ("NO", ["norges", "borgarting", "agder", "frostating", "gulating", "hålogaland", "halogaland", "norsk", "norwegian", "norway"]),
    ("LI", ["liechtenstein", "fürstentum", "furstentum", "vaduz"]),
    ("IS", ["island", "iceland", "héraðsdómur", "heradsdomur", "landsréttur", "landsrettur", "hæstirétt", "haestirett", "reykjavik", "reykjavík"]),
]
_PARTIES = [("NO", ["norway", "norge"]), ("IS", ["iceland", "ísland", "island"]), ("LI", ["liechtenstein"])]


def _first_named(text: str, kinds: list[tuple[str, list[str]]]) -> str:
    """The first kind one of whose words is in the text, else empty."""
    return "CASE " + " ".join("WHEN " + " OR ".join(f"instr(lower({text}), '{w}') > 0" for w in words) + f" THEN '{kind}'" for kind, words in kinds) + " ELSE '' END"


over("ident_procedure", ["request-for-an-advisory-opinion;Borgarting lagmannsrett", "failure-to-fulfil-obligations;Kingdom of Norway", "action-for-annulment;Vaduz and Reykjavík", "FAILURE-TO-ACT;Island v Liechtenstein", "Fürstliches Landgericht", ""], f"""
SELECT raw, {_first_named("raw", _PROCEDURES)} AS procedure, {_first_named("raw", _REFERRING)} AS referring, {_first_named("raw", _PARTIES)} AS parties FROM {{refs}}""")
over("ident_urls", ["IV-4", "XXIII-1"], r"SELECT raw, concat('/Pages/ViewDetails.aspx?src=TREATY&mtdsg_no=', raw, '&lang=_en') AS details, sha1(raw) AS key, substr(sha1(raw), 1, 12) AS short_key FROM {refs}")
over("ident_person_name", ["Ibsen, Henrik", "Madonna", "a, b, c"], r"SELECT raw, trim(split_part(raw, ',', 1)) AS surname, CASE WHEN instr(raw, ',') > 0 THEN trim(substr(raw, instr(raw, ',') + 1)) ELSE '' END AS given FROM {refs}")

# Short names of treaties and the references they stand for.
UN_ALIASES = [
    ("iccpr", "IV-4"), ("icescr", "IV-3"), ("cescr", "IV-3"), ("cerd", "IV-2"), ("icerd", "IV-2"), ("cedaw", "IV-8"), ("cat", "IV-9"), ("uncat", "IV-9"),
    ("crc", "IV-11"), ("icrmw", "IV-13"), ("cmw", "IV-13"), ("crpd", "IV-15"), ("iced", "IV-16"), ("icppd", "IV-16"), ("ced", "IV-16"),
    ("vclt", "XXIII-1"), ("vcssrt", "XXIII-2"), ("vcltsio", "XXIII-3"), ("vcdr", "III-3"), ("vccr", "III-6"), ("unclos", "XXI-6"), ("losc", "XXI-6"),
    ("rome statute", "XVIII-10"), ("icc statute", "XVIII-10"), ("refugee convention", "V-2"), ("1951 refugee convention", "V-2"),
    ("stateless persons", "V-3"), ("genocide convention", "IV-1"), ("tpnw", "XXVI-9"), ("npt", "XXVI-5"), ("ctbt", "XXVI-4"),
]
COE_ALIASES = [
    ("echr", "005"), ("european convention on human rights", "005"), ("european convention of human rights", "005"), ("convention on human rights", "005"),
    ("ecpt", "126"), ("cpt", "126"), ("anti-torture", "126"), ("anti torture", "126"), ("european convention against torture", "126"),
    ("cybercrime", "185"), ("budapest convention", "185"), ("convention on cybercrime", "185"),
    ("istanbul", "210"), ("istanbul convention", "210"), ("violence against women", "210"),
    ("lanzarote", "201"), ("lanzarote convention", "201"), ("child sexual exploitation", "201"),
    ("oviedo", "164"), ("oviedo convention", "164"), ("biomedicine", "164"), ("bioethics", "164"),
    ("convention 108", "108"), ("data protection", "108"), ("data protection convention", "108"), ("108+", "223"), ("convention 108+", "223"),
    ("bern", "104"), ("bern convention", "104"), ("wildlife", "104"), ("faro", "199"), ("granada", "121"), ("valletta", "143"),
    ("anti-doping", "135"), ("macolin", "215"), ("match-fixing", "215"), ("corruption", "173"), ("criminal law convention on corruption", "173"),
    ("money laundering", "141"), ("warsaw convention", "198"), ("trafficking", "197"), ("human trafficking", "197"),
    ("statute", "001"), ("council of europe statute", "001"), ("social charter", "035"), ("european social charter", "035"), ("revised social charter", "163"),
    ("echr p1", "009"), ("echr p4", "046"), ("echr p6", "114"), ("echr p7", "117"), ("echr p12", "177"), ("echr p13", "187"), ("echr p15", "213"), ("echr p16", "214"),
]
_ASKED = ["ICCPR", "vclt", " Rome Statute ", "E.C.H.R.", "(ECHR)", "Budapest  Convention!", "nothing known"]


@query("alias_resolve", rf"""
WITH a AS (SELECT 'UN' AS register, alias, ref FROM {values_sql(UN_ALIASES, 'alias, ref')} UNION ALL SELECT 'CoE', alias, ref FROM {values_sql(COE_ALIASES, 'alias, ref')}),
q AS (SELECT raw, lower(trim(raw)) AS k, trim(regexp_replace(regexp_replace(lower(trim(raw)), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS k2 FROM {values_sql([(x,) for x in _ASKED], 'raw')})
SELECT q.raw, coalesce(a.register, b.register) AS register, coalesce(a.ref, b.ref) AS ref FROM q LEFT JOIN a ON q.k = a.alias LEFT JOIN a b ON q.k2 = b.alias""")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact alias first, then with blanks for punctuation (J2). The alias tables are fixed and small, so they are broadcast."""
    un = values(spark, [("UN", *r) for r in UN_ALIASES], "register, alias, ref")
    aliases = F.broadcast(un.union(values(spark, [("CoE", *r) for r in COE_ALIASES], "register, alias, ref")))
    low = F.lower(F.trim("raw"))
    asked = values(spark, [(x,) for x in _ASKED], "raw").select("raw", low.alias("k"), F.trim(F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " ")).alias("k2"))
    exact = asked.join(aliases.select(F.col("register").alias("r1"), F.col("alias").alias("k"), F.col("ref").alias("f1")), "k", "left")
    both = exact.join(aliases.select(F.col("register").alias("r2"), F.col("alias").alias("k2"), F.col("ref").alias("f2")), "k2", "left")
    return both.select("raw", F.coalesce("r1", "r2").alias("register"), F.coalesce("f1", "f2").alias("ref"))
