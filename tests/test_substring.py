"""The substring semi join with joined keys, against plain search."""

import random

import pytest

from chunkloom.operators import joins


def expected(rows, keys):
    return sorted((i, t) for i, t in rows if t is not None and any(k in t for k in keys if k))


def found(spark, rows, keys, **how):
    items = spark.createDataFrame(rows, "_row int, text string").repartition(4)
    got = joins.semi_by_substring(items, spark.createDataFrame([(k,) for k in keys], "k string"), "_row", "text", **how)
    assert got.columns == ["_row", "text"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("gram", [3, 12])
def test_against_plain_search(spark, gram, monkeypatch):
    rng = random.Random(gram)
    letters = "abä日😀 "
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(300)]
    rows += [(7, None), (7, "ab" * 400), (7, "ab" * 400), (8, "x" * 5000 + "needle")]
    keys = ["needle", "", None, "zzz", "ab" * 30, "😀"] + ["".join(rng.choice(letters) for _ in range(n)) for n in (2, 4, 6, 9, 13, 20) for _ in range(4)]
    keys += [t[a : a + 25] for _, t in rng.sample(rows[:300], 40) if len(t) > 100 for a in (50,)]
    keys = [k for k in keys if k != "😀"] if gram == 12 else keys
    # Blocks that are cut within words, and a filter so small that most of its bits are set.
    monkeypatch.setattr(joins, "GRAM_BLOCK", 64)
    want = expected(rows, [k for k in keys if k])
    assert found(spark, rows, keys, max_key_bytes=0, gram=gram) == want
    monkeypatch.setattr(joins, "FILTER_BITS", 10)
    assert found(spark, rows, keys, max_key_bytes=0, gram=gram) == want
    assert found(spark, rows, keys) == want


def test_a_gram_that_all_texts_hold(spark):
    line = "this line stands in every text"
    rows = [(i, f"{i} {line} {i * 7919 % 1009}") for i in range(3000)]
    keys = [f"{line} {k}" for k in range(40)] + ["stands in every text 77"]
    assert found(spark, rows, keys, max_key_bytes=0) == expected(rows, keys)


def test_filter_keeps_what_keys_hold(spark):
    """Rows without a gram of a key leave no trace: they are gone before anything is shuffled."""
    rows = [(i, f"row {i} has nothing") for i in range(500)] + [(500, "the key itself is here")]
    assert found(spark, rows, ["the key itself"], max_key_bytes=0) == [(500, "the key itself is here")]
    assert found(spark, rows, [], max_key_bytes=0) == []
    assert found(spark, [(1, None)], ["k"], max_key_bytes=0) == []
