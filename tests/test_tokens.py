"""Token counters: the estimate in both forms, and byte-pair merging against brute force."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from chunkloom.functions import tokens
from chunkloom.operators import merging

SIGNS = ["a", "b", "ab", "the ", " ", "  ", "\n", "é", "ß", "日本", "語", "한", "😀", "1", "23", ".", "'s", "\t", "́", "क्"]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of one piece: always merge the pair of lowest rank, the leftmost of equals."""
    parts = [bytes([b]) for b in piece]
    while True:
        pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not pairs:
            return parts
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def rank_file(tmp_path_factory):
    """All bytes, and some merges learned nowhere: random joins of tokens that are there."""
    rng = random.Random(3)
    found = [bytes([b]) for b in range(256)]
    text = "".join(rng.choice(SIGNS) for _ in range(400)).encode()
    while len(found) < 340:
        at, size = rng.randrange(len(text) - 4), rng.randrange(2, 5)
        token = text[at : at + size]
        if token not in found and any(token[:i] in found and token[i:] in found for i in range(1, size)):
            found.append(token)
    path = tmp_path_factory.mktemp("ranks") / "small.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(found)))
    return str(path), {t: i for i, t in enumerate(found)}


def test_counts_and_prefixes_equal_brute_force(spark, rank_file):
    import regex

    path, ranks = rank_file
    rng = random.Random(4)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "<|endoftext|>", "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    counter = tokens.bpe_counter(path)
    got = df.select("id", counter(F.col("text")).alias("n"), tokens.bpe_truncate(path, 7)(F.col("text")).alias("head")).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["id"]]
        if text is None:
            assert r["n"] is None and r["head"] is None
            continue
        parts = [t for piece in regex.findall(tokens.PIECES, text) for t in merged(piece.encode(), ranks)]
        assert (r["n"], r["head"]) == (len(parts), b"".join(parts[:7]).decode(errors="ignore") if len(parts) > 7 else text)
        assert counter.text(text) == len(parts)


def test_estimate_has_one_meaning(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(40))) for _ in range(200)] + ["", " ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", tokens.token_estimate(F.col("text")).alias("n"), tokens.word_count(F.col("text")).alias("words")
    )
    for text, n, words in rows.collect():
        assert (n, words) == ((None, None) if text is None else (tokens.token_estimate.text(text), tokens.word_count.text(text)))


def test_estimate_lies_above_byte_pair_counts(spark):
    files = pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 100")
    exact = tokens.bpe_counter(files.path("byte_bpe_multi_50k.tiktoken"))(F.col("text"))
    rows = docs.select(exact.alias("exact"), tokens.token_estimate(F.col("text")).alias("n")).collect()
    assert sum(r["exact"] <= r["n"] for r in rows) >= 0.9 * len(rows)
    assert all(r["exact"] <= 1.3 * r["n"] and r["n"] <= 2 * r["exact"] for r in rows)


def test_long_unspaced_chunks_stay_apart(spark):
    chunk = "日本語の文章は空白を使わない。" * 40
    chunks = spark.createDataFrame([(1, i, chunk, i) for i in range(20)], "doc_id int, pos long, text string, page_number int")
    assert merging.merge_small_chunks(chunks).count() == 20
    assert merging.merge_small_chunks(chunks, counter=tokens.word_count).count() == 1


def test_merge_with_exact_counts(spark, rank_file):
    path, _ = rank_file
    chunks = spark.createDataFrame([(1, 0, "ab", 1), (1, 1, "the " * 30, 2), (1, 2, "ab", 3)], "doc_id int, pos long, text string, page_number int")
    rows = merging.merge_small_chunks(chunks, 15, 200, counter=tokens.bpe_counter(path)).orderBy("idx").collect()
    assert [r["text"] for r in rows] == ["ab " + "the " * 30, "ab "]
