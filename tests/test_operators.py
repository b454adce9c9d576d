"""Operators over small literal tables, golden rows from the worked examples."""

import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from docket.catalog import values
from docket.operators import lucene, ordered, verify
from docket.operators.paragraphs import split_paragraphs
from docket.sources.documents import docx_text, pdf_text, read_documents, read_statutes
from docket.streaming import fetch_log


def test_lucene(spark):
    rows = values(spark, [("1", "en", "Alpha beta"), ("2", "fr", "beta"), ("3", None, "")], "id, lang, text")
    ask = lambda q: sorted(r.id for r in rows.where(lucene.compile_query(q)).collect())
    assert ask("text:beta") == ["1", "2"]
    assert ask('text:"alpha beta" OR lang:fr') == ["1", "2"]
    assert ask("text:beta NOT lang:en") == ["2"]
    assert ask("NOT lang:*") == ["3"]
    assert ask("(lang:en OR lang:fr) text:(beta alpha)") == ["1"]
    assert ask("lang:[a TO f]") == ["1"]
    for bad in ("text:", "(lang:en", "lang:en)", "AND"):
        with pytest.raises(ValueError):
            lucene.compile_query(bad)


def test_paragraph_counter(spark):
    docs = values(spark, [("a", "x\n1\ntext\n73\n2.  Body"), ("b", "no numbers"), ("c", None), ("d", "2\nfrom two\n3 The Court\n5\u00a0. “Quoted” text \n9 Later\n6 lower\n7"), ("e", "3\nnot first"), ("f", "1\r\n\r\n2. A\n")], "doc, text")
    assert sorted(tuple(r) for r in split_paragraphs(docs, "doc", "text").collect()) == [("a", 1, "text\n73"), ("a", 2, "Body"), ("d", 2, "from two"), ("d", 3, "The Court"), ("d", 5, "“Quoted” text \n9 Later\n6 lower"), ("f", 1, ""), ("f", 2, "A")]


def test_ordered(spark):
    rows = spark.createDataFrame([("k", 1, "i", "x"), ("k", 2, "h", "A"), ("k", 3, "i", "y"), ("k", 4, "i", "y")], "key string, pos int, kind string, v string")
    filled = ordered.fill_heading(rows, "key", "pos", F.col("kind") == "h", F.col("v"), "section").collect()
    assert sorted((r.pos, r.section) for r in filled) == [(3, "A"), (4, "A")]
    assert sorted(r.pos for r in ordered.collapse_adjacent(rows, "key", "pos", "v").collect()) == [1, 2, 3]
    assert [r.pos for r in ordered.first_of(rows, ["kind"], [F.desc("pos")]).orderBy("pos").collect()] == [2, 4]
    before = ordered.preceding(rows, "key", "pos", F.when(F.col("kind") == "h", F.col("v")), "ref").orderBy("pos").collect()
    assert [r.ref for r in before] == [None, None, "A", "A"]


def test_occurrences_in_blocks(spark):
    quotes = values(spark, [(str(i), f"q{i} ") for i in range(9)] + [("e", "")], "id, quote")
    sources = values(spark, [("s", "q1 q2 q3 "), ("t", "q3 q8 "), ("n", None)], "sid, text")
    whole = sorted((r.id, r.sid) for r in verify.occurrences(quotes, sources, "quote", "text").collect())
    assert whole == [("1", "s"), ("2", "s"), ("3", "s"), ("3", "t"), ("8", "t")]
    assert whole == sorted((r.id, r.sid) for r in verify.occurrences(quotes, sources, "quote", "text", block=8).collect())


def test_occurrences_by_runs(spark):
    text = "An old  court, it said,\nheld that the law of the land is the law.  So it is. the law of the land is the law"
    quotes = [(str(i), text[a : a + n]) for i, (a, n) in enumerate((a, n) for a in range(0, len(text), 3) for n in (1, 9, 20, 37, 60))]
    quotes += [("absent", "held that the law of the sea is the law"), ("again", quotes[3][1]), ("blanks", "     "), ("none", None)]
    sources = [("s", text), ("copy", text), ("t", text[10:70]), ("u", "law of the land " * 50), ("e", ""), ("n", None)]
    asked = values(spark, quotes, "id, quote")
    got = sorted((r.id, r.sid) for r in verify.occurrences(asked, values(spark, sources, "sid, text"), "quote", "text").collect())
    assert got == sorted((i, k) for i, q in quotes for k, t in sources if q and t and q in t)
    assert verify.occurrences(asked.limit(0), values(spark, sources, "sid, text"), "quote", "text").count() == 0


def _docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_binary_sources(spark, tmp_path):
    assert docx_text(_docx("one", " ", "two")) == "one\n\ntwo\n"
    pdf = b"%PDF-1.4\nstream\n" + zlib.compress(b"BT (Hello) Tj (Hello) Tj (a\\)b) Tj ET") + b"\nendstream"
    assert pdf_text(pdf) == "Hello\na)b"
    (tmp_path / "a.docx").write_bytes(_docx("x"))
    (tmp_path / "b.pdf").write_bytes(pdf)
    (tmp_path / "c.docx").write_bytes(b"PK broken")
    (tmp_path / "d.bin").write_bytes(b"?")
    found = {r.path.rsplit("/", 1)[1]: (r.kind, r.text) for r in read_documents(spark, str(tmp_path)).collect()}
    assert found == {"a.docx": ("docx", "x\n"), "b.pdf": ("pdf", "Hello\na)b"), "c.docx": ("docx", None), "d.bin": ("other", None)}


def test_statutes(spark, tmp_path):
    (tmp_path / "1.xml").write_text('<title>Law one</title><meta dokid="NL/lov/1-2"/>')
    (tmp_path / "2.xml").write_text("<title>No id</title>" + "x" * 3000 + 'dokid="late"')
    assert [(r.title, r.dokid) for r in read_statutes(spark, str(tmp_path)).collect()] == [("Law one", "NL/lov/1-2")]


def test_stream(spark, tmp_path):
    log = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (7200, "b", 1.0)], "s long, event_type string, value double").select(F.timestamp_seconds("s").alias("ts"), "event_type", "value")
    log.write.parquet(str(tmp_path / "in"))
    stream = fetch_log.hourly(fetch_log.read_log(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double"))
    run = stream.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    run.awaitTermination(120)
    key = lambda df: sorted((str(r.start), r.event_type, r.n, r.total) for r in df.collect())
    assert key(spark.table("hourly")) == key(fetch_log.hourly(spark.read.parquet(str(tmp_path / "in"))))


def test_upsert(spark):
    batch = spark.sql("SELECT * FROM VALUES (1, timestamp_seconds(5)), (1, timestamp_seconds(9)), (2, timestamp_seconds(1)) AS t(user_id, ts)")
    first = fetch_log.upsert(batch, None)
    again = fetch_log.upsert(spark.sql("SELECT 1 AS user_id, timestamp_seconds(7) AS ts"), first)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
