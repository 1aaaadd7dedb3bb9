"""Text scalar functions. All are plain column expressions and stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a strip removes (all Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Headings that open the back matter of a paper, in normalised form.
BACK_MATTER = [
    "ACKNOWLEDGEMENTS",
    "ACKNOWLEDGMENTS",
    "ACKNOWLEDGEMENT",
    "ACKNOWLEDGMENT",
    "BIBLIOGRAPHY",
    "DATAAVAILABILITY",
    "DECLARATIONOFCOMPETINGINTEREST",
    "REFERENCES",
    "SUPPLEMENTARYINFORMATION",
    "SUPPLEMENTARYMATERIALS",
    "SUPPORTINGINFORMATION",
    "参考文献",
    "致谢",
    "謝",
    "謝辞",
]

# Keywords looked for in the first line of a chunk, case-sensitive.
CHUNK_KEYWORDS = [
    "References",
    "REFERENCES",
    "Bibliography",
    "BIBLIOGRAPHY",
    "Acknowledgements",
    "ACKNOWLEDGEMENTS",
    "Acknowledgments",
    "ACKNOWLEDGMENTS",
    "参考文献",
    "致谢",
    "謝辞",
    "謝",
    "Online",
    "Declaration of Competing Interest",
    "Data availability",
    "Supplementary materials",
]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null counts as blank."""
    return F.coalesce(F.length(strip(text)), F.lit(0)) == 0


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def fix_utf8(text: Column) -> Column:
    """Replacement character to one space."""
    return F.replace(text, F.lit("\ufffd"), F.lit(" "))


def flatten_newlines(text: Column) -> Column:
    """Blank line, then single newline, to one space each."""
    return F.replace(F.replace(text, F.lit("\n\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))


def clean_text(text: Column) -> Column:
    """Join the broken lines of a paragraph, keep paragraph breaks, collapse runs of spaces.

    Bullets, dashes and trailing punctuation are left alone; blank text is returned as it is.
    """
    paragraphs = F.regexp_replace(text, r"[ \t]*\n[ \t]*\n\s*", "\u0000")
    joined = F.regexp_replace(paragraphs, r"\s*\n\s*", " ")
    spaced = F.regexp_replace(joined, r"[ \t\u00a0]+", " ")
    tidy = F.replace(strip(spaced), F.lit("\u0000"), F.lit("\n\n"))
    return F.when(is_blank(text), text).otherwise(tidy)


def normalise_heading(text: Column) -> Column:
    """Strip, drop spaces, newlines, tabs and both colons, then upper-case."""
    return F.upper(F.translate(strip(text), " \n\t:：", ""))


def is_back_matter(text: Column, keywords: list[str] = BACK_MATTER) -> Column:
    return contains_any(normalise_heading(text), keywords)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def is_title_line(text: Column) -> Column:
    """Non-blank, single line, not closed by a full stop."""
    stripped = strip(text)
    return (F.length(stripped) > 0) & ~stripped.endswith(".") & ~F.contains(stripped, F.lit("\n"))


TITLE_POLICIES = ("plain", "default", "default_title", "drop", "first_line")


def split_title(text: Column, policy: str = "plain") -> Column:
    """``struct(title, content)`` cut at the first blank line, or null where the policy drops the row."""
    cut = F.locate("\n\n", text)
    found = cut > 0
    head = F.when(found, F.substring(text, F.lit(1), cut - 1))
    tail = F.when(found, F.substring(text, cut + 2, F.length(text)))

    def pair(title: Column, content: Column) -> Column:
        return F.struct(title.alias("title"), content.alias("content"))

    if policy == "plain":
        return pair(F.coalesce(head, text), F.coalesce(tail, F.lit("")))
    if policy == "default":
        content = F.coalesce(tail, text)
        return pair(
            F.coalesce(head, F.lit("default")),
            F.when(content == "", F.lit("default")).otherwise(content),
        )
    if policy == "default_title":
        good = found & ~is_blank(head)
        return pair(
            F.when(good, head).otherwise(F.lit("Default Title")),
            F.when(good, tail).otherwise(text),
        )
    if policy == "drop":
        return F.when(found, pair(head, tail))
    if policy == "first_line":
        line = F.locate("\n", text)
        return pair(
            first_line(text),
            F.when(line > 0, F.substring(text, line + 1, F.length(text))).otherwise(F.lit("")),
        )
    raise ValueError(f"unknown title policy: {policy}")


def join_names(names: Column, sep: str = ", ") -> Column:
    return F.array_join(names, sep)


def clip(text: Column, limit: int = 2000) -> Column:
    return F.left(text, F.lit(limit))


def first_quoted(text: Column) -> Column:
    """Text between the first pair of single quotes, null when there is none."""
    return F.when(text.rlike(r"'(.*?)'"), F.regexp_extract(text, r"'(.*?)'", 1))


def first_quoted_of(elements: DataFrame, marker: str, order: str = "pos") -> DataFrame:
    """``doc_id, quoted`` of each document with an element that contains ``marker``, wherever it stands.

    The first such element by ``order`` decides: what it has between its first pair of single quotes, or its whole
    text if it has none. Elements without the marker are dropped before anything is shuffled, and of the others each
    task keeps one a document.
    """
    held = elements.where(F.contains("text", F.lit(marker)))
    first = held.groupBy("doc_id").agg(F.min_by("text", order).alias("_text"))
    return first.select("doc_id", F.coalesce(first_quoted(F.col("_text")), "_text").alias("quoted"))


def page_prefix(page: Column, text: Column) -> Column:
    """``Page p: text`` when the page is known and not zero."""
    known = F.coalesce(page.cast("string"), F.lit("")).isin("", "0") == F.lit(False)
    return F.when(known, F.concat(F.lit("Page "), page.cast("string"), F.lit(": "), text)).otherwise(text)
