"""Quotation checks: does a quoted text occur verbatim, where, and how badly does it differ if not?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in the run by which a quotation is looked up.
ANCHOR = 3
#: Bytes of quotations too short for a run that are sent to the sources at once, about.
BLOCK_BYTES = 8 << 20
#: Gap markers of a quotation: what they leave out is not compared.
GAPS = r"\s*(?:\[…\]|\[\.\.\.\]|…|\.\.\.)\s*"
_QUOTE_MARKS = "“”„«»‘’‚"
_PLAIN_MARKS = "\"\"\"\"\"'''"


def same_marks(text: Column) -> Column:
    """Typographic quotation marks as plain ones."""
    return F.translate(text, _QUOTE_MARKS, _PLAIN_MARKS)


def _runs(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, _at, _run, _size)``: position, hash and length of all runs of ``ANCHOR`` pieces between single blanks."""
    pieces = F.split(text, " ", -1)
    names = [f"_w{k}" for k in range(ANCHOR)]
    shifted = F.arrays_zip(*(F.slice(pieces, k + 1, F.size(pieces)).alias(n) for k, n in enumerate(names)))
    runs = rows.select(key, F.posexplode(shifted).alias("_at", "_w")).select(key, "_at", "_w.*").where(F.col(names[-1]).isNotNull())
    return runs.select(key, "_at", F.xxhash64(*names).alias("_run"), F.length(F.concat(*names)).alias("_size"))


def occurrences(quotes: DataFrame, sources: DataFrame, quote: str, source: str, block: int = BLOCK_BYTES) -> DataFrame:
    """All pairs in which the source holds the quote verbatim; null and empty quotes occur nowhere.

    A quote is looked up by one run of words inside it: the runs of the sources meet the quotes' on their hashes, and only
    texts that hold the run are searched for the whole quote. Sizes known to the optimizer decide whether the quotes are
    broadcast or both sides are exchanged. Quotes too short for a run are a stated query set, which is sent in blocks of
    about ``block`` bytes to every partition of the sources; those do not move.
    """
    quotes = quotes.where(F.length(quote) > 0)
    # where a source holds a quote, all pieces but the quote's first and last are pieces of the source as well
    asked = quotes.select(F.col(quote).alias("_quote"), F.regexp_extract(quote, "(?s)^[^ ]* (.*) [^ ]*$", 1).alias("_inner")).distinct()
    inner = _runs(asked, "_quote", "_inner")
    looked_up = inner.groupBy("_quote").agg(F.max_by("_run", F.struct("_size", -F.col("_at"))).alias("_run"))
    runs = _runs(sources.select(F.xxhash64(source).alias("_text"), source), "_text", source).select("_text", "_run")
    near = runs.join(looked_up, "_run").select("_text", "_quote").distinct()
    held = sources.withColumn("_text", F.xxhash64(source)).join(near, "_text").where(F.contains(F.col(source), F.col("_quote")))
    found = [held.join(quotes.withColumnRenamed(quote, "_quote"), "_quote").withColumnRenamed("_quote", quote).drop("_text")]

    short = quotes.where(F.size(F.split(quote, " ", -1)) < ANCHOR + 2)
    size = short.select(F.sum(F.octet_length(quote))).first()[0] or 0
    blocks = -(-size // block)
    marked = short.withColumn("_block", F.pmod(F.xxhash64(quote), F.lit(blocks or 1)))
    found += [sources.join(F.broadcast(marked.where(F.col("_block") == b).drop("_block")), F.contains(F.col(source), F.col(quote))) for b in range(blocks)]
    return reduce(DataFrame.unionByName, found)


def fragments_in_order(quote: Column, source: Column) -> Column:
    """Whether all parts of a quote between gap markers occur in the source, one after another."""
    parts = F.filter(F.split(quote, GAPS), lambda p: p != "")

    def step(at: Column, part: Column) -> Column:
        found = F.call_function("locate", part, source, at)
        return F.when(at == 0, 0).when(found > 0, found + F.length(part)).otherwise(0)

    return F.aggregate(parts, F.lit(1), step) > 0


def severity(verbatim: Column, with_gaps: Column, marks_only: Column) -> Column:
    return F.when(verbatim | with_gaps, F.lit(None).cast("string")).when(marks_only, "low").otherwise("high")
