"""Token counters: one definition usable on a column and on a Python string inside a task.

The default is an estimate for all scripts that costs no more than two lengths of a text. Exact counts by byte-pair
merging need a rank file, whose path is a parameter; its content goes to the workers, so they need no copy.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: how byte-pair encodings of this family cut a text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Counter:
    column: Callable[[Column], Column]
    text: Callable[[str], int]

    def __call__(self, text: Column) -> Column:
        return self.column(text)


def _n_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


# Pieces between single spaces: for scripts that put spaces between words. No array is built, so the column form
# stays in codegen.
word_count = Counter(lambda text: _n_spaces(text) + 1, lambda s: s.count(" ") + 1)

# Default: two bytes of UTF-8 that are not spaces make a token. A letter of one, two or three bytes so counts for half
# a token to one and a half, which is above the byte-pair count of nearly every text, spaced or not.
token_estimate = Counter(
    lambda text: F.shiftright(F.octet_length(text) - _n_spaces(text) + 1, 1),
    lambda s: (len(s.encode()) - s.count(" ") + 1) // 2,
)


# ---------------------------------------------------------------- exact counts


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Tokens by rank, from lines of base64 text and number."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def _encoding(content: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(content), special_tokens={})


class _Ranks:
    """The encoding of a rank file, built once in each worker and in the driver."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as source:
            # Some megabytes at most: the file of one vocabulary.
            self.held = SparkSession.active().sparkContext.broadcast({"content": source.read(), "pattern": pattern})

    def get(self):
        held = self.held.value
        if "encoding" not in held:
            held["encoding"] = _encoding(held["content"], held["pattern"])
        return held["encoding"]


def bpe_counter(path: str, pattern: str = PIECES) -> Counter:
    """Number of tokens of the rank file at ``path``; null stays null, the strings of special tokens are plain text."""
    ranks = _Ranks(path, pattern)

    @F.pandas_udf("int")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = ranks.get().encode_ordinary
        for texts in batches:
            yield pd.Series([None if t is None else len(encode(t)) for t in texts], dtype="Int32")

    return Counter(column, lambda s: len(ranks.get().encode_ordinary(s)))


def truncate_words(text: Column, limit: int = 8192) -> Column:
    """Prefix of ``limit`` pieces between single spaces."""
    return F.substring_index(text, " ", limit)


def bpe_truncate(path: str, limit: int = 8192, pattern: str = PIECES) -> Callable[[Column], Column]:
    """Longest prefix of whole characters among the first ``limit`` tokens of the rank file at ``path``."""
    ranks = _Ranks(path, pattern)

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = ranks.get()

        def prefix(t):
            tokens = encoding.encode_ordinary(t)
            # A token may end inside a character; what is left of it goes.
            return t if len(tokens) <= limit else encoding.decode_bytes(tokens[:limit]).decode(errors="ignore")

        for texts in batches:
            yield pd.Series([None if t is None else prefix(t) for t in texts], dtype="object")

    return cut
