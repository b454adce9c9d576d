"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a fixed mask over some successive tokens; the tokens under its zeros are ignored, so a substitution there does
not hide a hit. Seeds of benchmark items and of documents are joined by hash. Each hit fixes an alignment; the tokens of
the item and of the document are compared along it, and a leak is a run of tokens that agrees in at least 80 %. The masks
are such that every run that meets this has a seed. Items of fewer than ten tokens are matched whole and exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import checkpointed

#: Tokens of the run that is verified, and the share of them that must agree.
RUN = 13
AGREE = 0.8
#: Items of fewer tokens must agree in all of them; items of fewer than ``LEAST`` tokens are not looked for.
SPACED, LEAST = 10, 3
#: For each number of tokens of an item (13: and more) masks of which one, at some place, misses any two positions. All
#: begin with two compared tokens and end in one, so that a seed lies in the text where an end of the item is cut off.
MASKS = {n: ("1" * n,) for n in range(LEAST, SPACED)} | {
    10: ("1111011", "11001111", "110101011", "111111", "110100111"),
    11: ("1111011", "110001111", "1101100011"),
    12: ("11110111", "1100101111", "11011001011", "1111111", "110110110001"),
    13: ("11110111", "11001001111", "11111101"),
}
_NUMBER = {mask: m for m, mask in enumerate(dict.fromkeys(x for masks in MASKS.values() for x in masks))}
#: Bits of the table of opening token pairs: a place whose pair is not marked makes no seeds. Its size is fixed; a larger
#: benchmark only marks more of it, and a place that is marked by chance makes seeds that meet nothing.
PAIR_BITS = 19


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits of a text in lower case; null has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _pair(t: Column, i: Column) -> Column:
    return F.xxhash64(F.get(t, i), F.get(t, i + 1))


def _marked_pairs(spots: DataFrame) -> Column:
    """An array literal of ``2 ** PAIR_BITS`` bits, 32 to a long, set where the hash of a pair falls."""
    place = F.pmod(F.col("pair"), F.lit(1 << PAIR_BITS))
    words = spots.select(place.alias("p")).distinct().groupBy(F.floor(F.col("p") / 32).cast("int").alias("w")).agg(F.sum(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(32)).cast("int"))).alias("bits"))
    table = [0] * (1 << (PAIR_BITS - 5))
    for r in words.collect():  # at most 2 ** (PAIR_BITS - 5) rows
        table[r["w"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _is_marked(marked: Column, pair: Column) -> Column:
    place = F.pmod(pair, F.lit(1 << PAIR_BITS))
    return F.call_function("shiftright", F.get(marked, F.floor(place / 32).cast("int")), F.pmod(place, F.lit(32)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _places(t: Column, least: int = LEAST) -> Column:
    """First positions of all runs of ``least`` tokens."""
    n = F.size(t)
    return F.when(n >= least, F.sequence(F.lit(0), n - least)).otherwise(F.array().cast("array<int>"))


def _seeds(t: Column, i: Column, masks: list[str]) -> Column:
    """The hashes at one place, one for each mask, whose number enters the hash; null where the text ends before."""
    return F.array(*(F.when(i + len(mask) <= F.size(t), F.xxhash64(F.lit(_NUMBER[mask]), *(F.get(t, i + k) for k in range(len(mask)) if mask[k] == "1"))) for mask in masks))


def _own_seeds(t: Column, i: Column, kinds: list[int]) -> Column:
    """The seeds of an item at one place, by the masks for its number of tokens."""
    made = F.array().cast("array<bigint>")
    for n in kinds:
        made = F.when(F.least(F.size(t), F.lit(RUN)) == n, _seeds(t, i, list(MASKS[n]))).otherwise(made)
    return made


def _agreeing(own: Column, other: Column, start: Column) -> Column:
    """1 where the token of an item equals the document's along the alignment, else 0."""
    return F.transform(own, lambda w, j: F.when((start + j >= 0) & F.coalesce(F.get(other, F.greatest(start + j, F.lit(0))) == w, F.lit(False)), 1).otherwise(0))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id_col, item_col, start, matched, agreement)``: a row for each document and item that it holds.

    ``start`` is the document's token at which the item's first token is aligned (negative if its start is cut off),
    ``matched`` the number of agreeing tokens along that alignment, ``agreement`` the best share over a run of 13 item
    tokens (all tokens of an item that has fewer). Every run that agrees in at least 80 % is found. An item of three to
    nine tokens must agree in all of them, one of fewer is never found. Null and empty texts hold nothing; whole texts
    are searched, however long. Of equal alignments the one that starts first is reported. Rows with one id are taken for one document and joined as such; a null id is not reported. Empty
    tables give no rows; other columns are not read.
    """
    items = benchmark.select(F.col(item_col).alias("item"), tokens(F.col(item_text_col)).alias("it"))
    items = checkpointed(items.where((F.size("it") >= LEAST) & F.col("item").isNotNull()))
    kinds = sorted(r.n for r in items.select(F.least(F.size("it"), F.lit(RUN)).alias("n")).distinct().collect())  # 11 at most
    masks = list(dict.fromkeys(x for n in kinds for x in MASKS[n]))
    spots = items.select("item", F.explode(F.transform(_places(F.col("it")), lambda i: F.struct(i.alias("off"), _pair(F.col("it"), i).alias("pair"), _own_seeds(F.col("it"), i, kinds).alias("seeds")))).alias("s"))
    spots = checkpointed(spots.select("item", "s.*"))
    marked = _marked_pairs(spots)

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("doc is not null")
    read = rows.select("doc", tokens(F.col("text")).alias("t"))
    t = F.col("t")
    places = _places(t, min(map(len, masks), default=LEAST))
    places = F.filter(places, lambda i: _is_marked(marked, _pair(t, i)))
    found = read.select("doc", F.explode(F.transform(places, lambda i: F.struct(i.alias("pos"), (_seeds(t, i, masks) if masks else F.array().cast("array<bigint>")).alias("seeds")))).alias("s"))
    found = found.select("doc", "s.pos", F.explode("s.seeds").alias("seed")).where("seed is not null")
    known = spots.select("item", "off", F.explode("seeds").alias("seed")).where("seed is not null")
    hits = found.join(known, "seed").select("doc", "item", (F.col("pos") - F.col("off")).alias("start")).distinct()
    hits = checkpointed(hits)

    # the texts of documents with a hit, and the tokens along each alignment
    suspects = rows.join(hits.select("doc").distinct(), "doc", "left_semi").select("doc", tokens(F.col("text")).alias("t"))
    aligned = suspects.join(hits, "doc").join(items, "item").select("doc", "item", "start", _agreeing(F.col("it"), F.col("t"), F.col("start")).alias("m"))
    run = F.least(F.size("m"), F.lit(RUN))
    sums = F.transform(F.sequence(F.lit(1), F.size("m") - run + 1), lambda j: F.aggregate(F.slice("m", j, run), F.lit(0), lambda a, x: a + x))
    needed = F.when(F.size("m") < SPACED, 1.0).otherwise(AGREE)
    scored = aligned.select("doc", "item", "start", needed.alias("needed"), F.aggregate("m", F.lit(0), lambda a, x: a + x).alias("matched"), (F.array_max(sums) / run).alias("agreement"))
    best = scored.where(F.col("agreement") >= F.col("needed")).groupBy("doc", "item").agg(F.max_by(F.struct("start", "matched", "agreement"), F.struct("agreement", "matched", -F.col("start"))).alias("b"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "b.start", "b.matched", "b.agreement")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with their columns; rows with a null id are kept."""
    return docs.join(leaks(docs, benchmark, id_col, text_col).select(id_col).distinct(), id_col, "left_anti").select(*docs.columns)
