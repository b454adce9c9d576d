"""The pipeline against a plain version, and the corpus queries against their DuckDB twins."""

import hashlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docket.llm import queries, secrets, toxicity
from docket.llm.common import table
from docket.llm.fingerprints import fingerprint

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    from tokenizers import Tokenizer

    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"))
    left = {r.doc_id: r.text for r in docs.collect() if model.scores(model.features(r.text)[None, :])[0] < 0.5}
    fps = {i: fingerprint(t) for i, t in left.items()}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    left = {i: t for i, t in left.items() if find(i) == i}
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    leaked = {i for i, t in left.items() if any(x in t for x in items)}
    assert not leaked & set(rows)
    missing = set(left) - set(rows) - leaked
    norm = lambda t: "".join(c for c in t.lower() if c.isalnum())
    assert all(any(norm(x)[:60] in norm(left[i]) for x in items) for i in missing)
    assert set(rows) <= set(left)
    ref = Tokenizer.from_file(queries.tokenizer_path())
    for i, r in rows.items():
        text, out, at = left[i], [], 0
        for a, b, _ in secrets.spans(text):
            if a >= at:
                out += [text[at:a], "[SECRET]"]
            at = max(at, b)
        text = "".join(out) + text[at:]
        assert r.n_chars == len(text) and r.ids == ref.encode(text, add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stage_columns(spark):
    docs = table(spark, SF, "documents").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


_CLASHING = ["score", "predicted", "_masked", "component_id", "fingerprint", "item", "_row", "_toxic", "n_tokens"]


def _odd_documents(spark):
    """Real documents, and rows with nulls, empty and very long texts, repeated ids and columns named as inner ones."""
    docs = table(spark, SF, "documents").where("doc_id < 60")
    odd = [(None, "no id, but words of its own", "en", "a", 27), (None, None, None, None, None), (9001, "", "en", "a", 0), (9002, "", None, "b", 0), (9003, None, "fr", None, None),
           (9004, " ".join(f"w{i % 997}x{i % 89}" for i in range(200_000)), "en", "a", 1), (9005, "one text of an id that comes twice", "en", "a", 34), (9005, "another text of an id that comes twice, unlike it", "en", "b", 1),
           (9006, "password = abcdefgh12345678 and nothing more", "en", "a", 44), (9006, "password = abcdefgh12345678 and nothing more", "en", "a", 44)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for c in _CLASHING:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return docs.cache()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_odd_rows(spark, name, stage):
    docs = _odd_documents(spark)
    out = stage(spark, docs, SF)
    kept = out.collect()
    assert all(r[c] == f"{c}{'-' if r.doc_id is None else r.doc_id}" for r in kept for c in _CLASHING if c != "n_tokens")
    if name == "bpe":
        assert len(kept) == docs.count() and {r.n_tokens for r in kept if r.doc_id in (9001, 9002, 9003)} == {0}
        return
    assert out.columns == docs.columns
    rows, odd = lambda rs: sorted(map(str, rs)), lambda i: [r for r in kept if r.doc_id == i]
    if name != "secrets":
        assert not set(rows(kept)) - set(rows(docs.collect()))
    assert len(odd(None)) == 2 and len(odd(9004)) == 1
    if name == "near_duplicates":
        assert len(odd(9001)) == 1 and not odd(9002) and not odd(9003)
        assert len(odd(9005)) == 1 and len(odd(9006)) == 1
        assert rows(kept) == rows(stage(spark, docs.repartition(5), SF).collect())
    else:
        assert all(len(odd(i)) == n for i, n in ((9001, 1), (9002, 1), (9003, 1), (9005, 2), (9006, 2)))
    if name == "secrets":
        assert [(r.text, r.n_chars) for r in odd(9006)] == [("[SECRET] and nothing more", 25)] * 2
        assert odd(9003)[0].text is None and odd(9003)[0].n_chars is None and len(kept) == docs.count()


def test_stages_of_nothing(spark):
    docs = table(spark, SF, "documents").limit(0)
    assert all(stage(spark, docs, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    flat = lambda df: sorted(tuple(None if pd.isna(v) else str(int(v)) if isinstance(v, (float, int)) else str(v) for v in r) for r in df[columns].itertuples(index=False))
    assert flat(got) == flat(want)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_stable_columns(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 0
