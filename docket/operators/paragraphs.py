"""Numbered paragraphs of judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = r"[\s\p{Z}]"
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_ALONE = rf"^{_BLANK}*(\d{{1,4}})\.?{_BLANK}*$"
_BEFORE_TEXT = rf"^{_BLANK}*(\d{{1,4}})[.\s\p{{Z}}]+(?=[A-Z‘’“”(])"


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_BLANK}+|{_BLANK}+$", "")


def split_paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, para, body)``: a line opens paragraph n if it is the number alone, or the number, dots or blanks and a
    capital, typographic quotation mark or bracket, and n is one or two more than the last (0 at first). Other numbers stay
    text; text before the first paragraph and numbers that nothing follows are dropped. Null texts have no paragraphs.

    Everything stays in the row of the text: a fold over its numbered lines chooses the openings, slices between them
    are the bodies."""
    lines = F.split(F.regexp_replace(F.col(text), rf"(?:{_BREAK})\z", ""), _BREAK)
    alone = lambda line: F.regexp_extract(line, _ALONE, 1)

    def numbered(line: Column, i: Column) -> Column:
        n = F.coalesce(F.nullif(alone(line), F.lit("")), F.regexp_extract(line, _BEFORE_TEXT, 1))
        return F.struct(i.alias("pos"), F.nullif(n, F.lit("")).cast("int").alias("n"), (alone(line) != "").alias("alone"))

    def step(acc: Column, x: Column) -> Column:
        opens = x["n"].between(acc["last"] + 1, acc["last"] + 2)
        return F.struct(F.when(opens, x["n"]).otherwise(acc["last"]).alias("last"), F.when(opens, F.concat(acc["taken"], F.array(x))).otherwise(acc["taken"]).alias("taken"))

    none = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<pos:int,n:int,alone:boolean>>").alias("taken"))
    rows = docs.where(F.col(text).isNotNull()).select(key, lines.alias("lines"))
    rows = rows.select(key, "lines", F.filter(F.transform("lines", numbered), lambda x: x["n"].isNotNull()).alias("numbers"))
    rows = rows.select(key, "lines", F.aggregate("numbers", none, step, lambda acc: acc["taken"]).alias("taken"))

    def paragraph(x: Column, i: Column) -> Column:
        end = F.coalesce(F.get("taken", i + 1)["pos"], F.size("lines"))
        head = F.regexp_replace(F.get("lines", x["pos"]), _BEFORE_TEXT, "")
        rest = F.slice("lines", x["pos"] + 2, end - x["pos"] - 1)
        return F.struct(x["n"].alias("para"), F.when(x["alone"], rest).otherwise(F.concat(F.array(head), rest)).alias("body"))

    parts = rows.select(key, F.explode(F.transform("taken", paragraph)).alias("p")).where(F.size("p.body") > 0)
    return parts.select(key, F.col("p.para").alias("para"), _trimmed(F.array_join("p.body", "\n")).alias("body"))
