"""Helpers the operators share: scratch tables, row keys, and vectorised tokenising inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# Words of the contracts: runs of anything but these characters.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20


# ---------------------------------------------------------------- tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/chunkloom-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    This cuts the lineage, so that a lost executor costs one stage and nothing is computed twice. The tables
    stay until ``drop_scratch``, because results that have not been read yet depend on them.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that tell rows apart also where ids repeat or are null. Equal rows share a key."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("k1"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k2"),
    ]


KEY = ["k1", "k2"]


# ---------------------------------------------------------------- text inside tasks


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _splitmix(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, kept per worker and grown when a longer text comes."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                p = np.full(size, np.uint64(base), np.uint64)
                p[0] = 1
                _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``values[start:end]``, from one running sum over all values."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        out = (total[ends] - total[starts]) * down[starts]
        return mix(out + (ends - starts).astype(np.uint64))


BYTE_VALUES = _splitmix(7, 256)


def word_spans(buffer: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which ``in_word`` holds."""
    flags = np.zeros(len(buffer) + 2, np.int8)
    flags[1:-1] = in_word[buffer]
    step = np.diff(flags)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def words_of(texts: list[bytes], in_word: np.ndarray = NOT_SPACE):
    """Words of several texts at once.

    Gives the joined bytes, start and end of each word in them, the hash of each word, and the index of the
    first word of each text, with the number of words at the end. The line break between texts ends words.
    """
    joined = b"\n".join(texts)
    buffer = np.frombuffer(joined, np.uint8)
    starts, ends = word_spans(buffer, in_word)
    hashes = span_hashes(BYTE_VALUES[buffer], starts, ends)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, begins)
    return joined, starts, ends, hashes, first


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=total[1:])
        return mix((total[n:] - total[:-n]) * down[:count] + np.uint64(n))


def with_columns_renamed(df: DataFrame, *needed: str) -> DataFrame:
    """Only the columns an operator reads, so that further columns of any name cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in needed])
