"""Quality classification with hierarchical empirical Bayes.

A logistic model on figures of the text gives each document its own evidence. Sites are groups of documents: a host, and
a path within it. The expected number of good documents of a host is shrunk towards the rate of the whole corpus, that
of a path towards its host's; the strengths of both priors follow from how much the groups differ (method of moments).
A document's posterior combines its own evidence with the rate of its path.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import checkpointed
from docket.llm.rules import figures
from docket.llm.toxicity import _logistic, held_out

#: Labelled rows that the evidence model is fitted on, at most (those with the smallest hash).
TRAIN_ROWS = 20_000
#: Bounds of the strength of a prior, in documents.
LEAST, MOST = 1.0, 10_000.0


def _features() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1)).cast("double")
    chars = F.greatest("word_chars", F.lit(1)).cast("double")
    return {
        "symbols": F.least(F.col("n_symbols") / n, F.lit(2.0)),
        "dup_lines": F.least(100 * F.col("n_dup_lines") / n, F.lit(20.0)),
        "repeats": F.col("n_repeat_words") / n,
        "size": F.log1p(n),
        "word_length": F.least(F.col("word_chars") / n, F.lit(15.0)),
        "capitals": F.col("n_capitals") / chars,
        "marks": F.least(F.col("n_marks") / n, F.lit(2.0)),
        "short": (F.col("n_words") < 50).cast("double"),
    }


def evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """The columns of ``docs`` but the text, and ``evidence``: log-odds of being good, from the text alone."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        "*", F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("n_capitals"), F.length(F.regexp_replace(text, r"[^!?|\-_=~]+", "")).alias("n_marks")
    )
    seen = figures(counted, text_col)
    seen = checkpointed(seen.select(*(c for c in docs.columns if c != text_col), *(f.alias(f"_{k}") for k, f in _features().items())))
    names = [f"_{k}" for k in _features()]
    marked = labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).where(~held_out(id_col)).select(id_col, "quality").dropDuplicates([id_col])
    chosen = seen.join(marked, id_col).orderBy(F.xxhash64(id_col), id_col).select("quality", *names).limit(rows).collect()  # at most ``rows`` rows of numbers
    y = np.array([r["quality"] for r in chosen], dtype=float)
    x = np.array([[r[n] for n in names] for r in chosen], dtype=float).reshape(len(y), len(names))
    if 0 < y.sum() < len(y):
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        w = _logistic((x - mean) / scale, y)
        slopes = w[1:] / scale
        value = F.lit(float(w[0] - mean @ slopes))
        for n, s in zip(names, slopes):
            value = value + F.lit(float(s)) * F.col(n)
    else:
        value = F.lit(float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    return seen.select(*(c for c in docs.columns if c != text_col), F.greatest(F.lit(-12.0), F.least(F.lit(12.0), value)).alias("evidence"))


def _strength(groups: DataFrame, mean: str, prior: str) -> float:
    """Prior strength from the spread of group means about their prior beyond what their sizes explain."""
    room = F.col(prior) * (1 - F.col(prior))
    r = groups.where("n > 1").agg(F.sum(F.col("n") * (F.col(mean) - F.col(prior)) ** 2 / room).alias("q"), F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") ** 2).alias("n2")).first()
    if not r["g"] or not r["n"]:
        return MOST
    spare = r["n"] - r["g"]
    share = (r["q"] - r["g"]) / spare if spare > 0 else 0.0  # about 1 / (strength + 1)
    return float(min(MOST, max(LEAST, 1 / share - 1))) if share > 0 else MOST


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None) -> DataFrame:
    """``id_col, held_out, evidence, host_rate, path_rate, score, kept`` for every row.

    ``host`` and ``path`` name the groups (default: source, and language within it); nulls are a group of their own.
    A path is always taken within its host. ``kept`` is score >= 0.5. Null texts count as empty; whole texts are read;
    repeated rows get equal results and count in their groups as often as they occur. An empty table gives no rows.
    Without usable labels all evidence is the same. Other columns are not read.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = docs.select(F.col(id_col), F.col(text_col), F.coalesce(host.cast("string"), F.lit("")).alias("_host"), F.coalesce(path.cast("string"), F.lit("")).alias("_path"))
    rows = checkpointed(evidence(rows, labels, id_col, text_col))
    own = 1 / (1 + F.exp(-F.col("evidence")))
    paths = checkpointed(rows.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum(own).alias("good")))
    total = paths.agg(F.sum("n"), F.sum("good")).first()
    rate = min(1 - 1e-4, max(1e-4, (total[1] or 0.0) / total[0])) if total[0] else 0.5

    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).select("*", (F.col("good") / F.col("n")).alias("mean"), F.lit(rate).alias("prior"))
    k = _strength(hosts, "mean", "prior")
    hosts = checkpointed(hosts.select("_host", ((F.col("good") + k * rate) / (F.col("n") + k)).alias("host_rate")))
    within = paths.join(hosts, "_host").select("*", (F.col("good") / F.col("n")).alias("mean"))
    k = _strength(within, "mean", "host_rate")
    within = within.select("_host", "_path", "host_rate", ((F.col("good") + k * F.col("host_rate")) / (F.col("n") + k)).alias("path_rate"))

    # the evidence holds the corpus rate already; the path's rate takes its place
    log_odds = F.col("evidence") - _logit(F.lit(rate)) + _logit(F.col("path_rate"))
    out = rows.join(checkpointed(within), ["_host", "_path"]).withColumn("score", 1 / (1 + F.exp(-log_odds)))
    return out.select(id_col, held_out(id_col).alias("held_out"), "evidence", "host_rate", "path_rate", "score", (F.col("score") >= 0.5).alias("kept"))
