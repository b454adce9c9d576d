"""Quality rules with risk-controlled cutoffs, with DataFrame functions only.

The base rules are fixed. Each further rule compares one figure of a text with a cutoff. Cutoffs are chosen from
labelled rows, for each stratum (language) by itself: a cutoff is allowed if an exact binomial bound shows that it
rejects at most a given share of good texts, at a level corrected for the number of all cutoffs tested (Bonferroni);
the strictest allowed one is taken. A stratum with too few labels gets no cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import WHITE, checkpointed

#: Share of good texts that all rules together may reject, and the chance that this fails in any stratum.
ALPHA, DELTA = 0.02, 0.05
#: Cutoffs that are tested for each rule: a text is rejected if its figure is larger.
GRID = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 2.0),
    "dup_lines_per_100_words": (0.5, 1.0, 2.0, 4.0, 8.0, 16.0),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.45),
    "word_length_off": (1.0, 1.5, 2.0, 3.0, 4.0, 6.0),
}


def figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long).

    Null and empty texts have zeros. Whole texts are read. Columns with these names are replaced; repeated rows get
    equal figures; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = docs.select(*(c for c in docs.columns if c not in made))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        "*",
        F.length(F.regexp_replace(text, WHITE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.transform(F.filter(F.split(text, WHITE + "+"), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("_w"),
    )
    w = F.col("_w")
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    step = step.select("*", n.cast("long").alias("n_words"), F.when(n >= 3, F.array_sort(windows)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_s")).drop("_w")
    s = F.col("_s")

    # equal windows are neighbours; of each, the three words that it covers
    again = F.transform(s, lambda x, k: F.when((F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"])), x["i"]))
    covered = F.array_distinct(F.flatten(F.transform(F.filter(again, lambda i: i.isNotNull()), lambda i: F.array(i, i + 1, i + 2))))
    return step.select("*", F.size(covered).cast("long").alias("n_repeat_words")).drop("_s").select(*docs.columns, *made)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """The figure of each rule; zero for a text without words."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_lines_per_100_words": 100 * F.col("n_dup_lines") / n,
        "repeat_share": F.col("n_repeat_words") / n,
        "word_length_off": F.when(F.col("n_words") > 0, F.abs(F.col("word_chars") / n - 5.0)).otherwise(0.0),
    }


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= x), the exact sum, with terms built up by logarithms."""
    odds = math.log(p / (1 - p))
    first = n.cast("double") * math.log1p(-p)
    start = F.struct(first.alias("term"), F.exp(first).alias("sum"))
    steps = F.when(x >= 1, F.sequence(F.lit(1), x.cast("int"))).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double") / i) + F.lit(odds)
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    return F.aggregate(steps, start, add, lambda acc: acc["sum"])


def cutoffs(rows: DataFrame, good: Column, stratum: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, rule, cutoff)`` from rows with figures, of which ``good`` marks those to be kept.

    The counts are sums over all labelled rows; strata are few (their number enters the correction).
    """
    known = rows.where(good & ~base_failed()).select(F.col(stratum).alias("stratum"), *(m.alias(r) for r, m in measures().items()))
    sums = [F.sum((F.col(r) > c).cast("long")).alias(f"{r}_{i}") for r, grid in GRID.items() for i, c in enumerate(grid)]
    counts = known.groupBy("stratum").agg(F.count("*").alias("n"), *sums)
    tests = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"{r}_{i}").alias("rejected")) for r, grid in GRID.items() for i, c in enumerate(grid)))
    tested = checkpointed(counts.select("stratum", "n", F.explode(tests).alias("t")).select("stratum", "n", "t.*"))
    level = delta / max(1, tested.count())
    share = alpha / len(GRID)
    # more rejections than the allowed share can never pass; this also bounds the sum
    allowed = tested.where(F.col("rejected") <= F.col("n") * share).where(binomial_cdf(F.col("rejected"), F.col("n"), share) <= level)
    return allowed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", quality_col: str = "quality") -> DataFrame:
    """``id_col``, the figures, ``base_failed`` and ``kept`` for every row of ``docs``.

    Labels that are null or not 0 or 1 are not used, repeated ones count once. A null stratum is a stratum. Rows with a
    null id are judged, but have no label.
    """
    rows = figures(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("_stratum"), F.col(text_col).alias("_text")), "_text").drop("_text")
    rows = checkpointed(rows)
    marked = labels.where(F.col(quality_col) == 1).select(F.col(id_col).alias("_id")).distinct()
    chosen = checkpointed(cutoffs(rows.join(marked, "_id"), F.lit(True), "_stratum"))
    wide = chosen.groupBy("stratum").pivot("rule", list(GRID)).agg(F.min("cutoff"))
    wide = wide.select(F.col("stratum").alias("_stratum"), *(F.col(r).alias(f"_{r}") for r in GRID))
    rejected = F.lit(False)
    for r, m in measures().items():
        rejected = rejected | F.coalesce(m > F.col(f"_{r}"), F.lit(False))
    out = rows.join(wide, "_stratum", "left").withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
