"""Text tokenising used by the search operators (runs JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: token separator = any run of characters that are neither letters nor digits.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text) -> Column:
    """Lower-cased letter/digit runs of a text column, empty pieces dropped."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: t != F.lit(""))


# Fixed values (word boundary rules of Unicode Standard Annex 29): scripts written without spaces whose characters are
# words of their own; signs that join two letters, and two digits. Marks belong to the character before them.
ALONE = r"\p{IsHan}\p{IsHiragana}"
BETWEEN_LETTERS, BETWEEN_DIGITS = "'\u2019.:\u00B7", "'\u2019.,;"
_ALONE = rf"[{ALONE}]\p{{M}}*+"
_CHAR = rf"[\p{{L}}\p{{N}}&&[^{ALONE}]]\p{{M}}*+"
_LETTER = rf"[\p{{L}}&&[^{ALONE}]]"
WORD = (rf"{_ALONE}|{_CHAR}(?:{_CHAR}|(?<=\p{{L}}\p{{M}}{{0,4}})[{BETWEEN_LETTERS}](?={_LETTER})"
        rf"|(?<=\p{{N}}\p{{M}}{{0,4}})[{BETWEEN_DIGITS}](?=\p{{N}}))*+")


def unicode_words(text) -> Column:
    """Lower-cased words by Unicode's word boundaries: each Han or Hiragana character is one, other letters, digits and
    their marks form runs, which an apostrophe, stop or comma between two letters or digits doesn't part."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def query_tokens(spark: SparkSession, keyword: str, words=tokens) -> list[str]:
    """Distinct words of a query parameter, by the same expression as the texts' (a constant, no data is read)."""
    return list(spark.range(1).select(F.array_distinct(words(F.lit(keyword or ""))).alias("t")).first()["t"])
