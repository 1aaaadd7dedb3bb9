"""Token files, whitening and the prefix trie against brute force, with odd rows."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import prefix_trie, token_blocks, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE, WORD_BPE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


# ---------------------------------------------------------------- token files


def encoded(path, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for ids in (
        [], [7], [2**32 - 1, 0], [5] * 1300, rng.integers(0, 50_257, 5000), rng.integers(0, 2**32, 700),
        np.where(rng.random(3000) < 0.03, 2**31, rng.integers(0, 60, 3000)),
    ):
        ids = np.array(ids, np.uint32)
        data, least, width, count = token_blocks.encode_blocks(ids)
        starts = np.cumsum([0] + [len(d) for d in data])
        if len(ids):
            back = token_blocks.decode_blocks(b"".join(data), starts, least, width, count)
            assert (back[: len(ids)] == ids).all()
    # The last case is small because outliers stand apart.
    assert width.max() <= 6 and count.sum() > 50 and starts[-1] < 3000


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(1)
    signs = ["a", "b", "Z", "é", "日", "́", "½", "1", "23", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", " ", "'", "'s", "'re"]
    signs += ["don't", ".", "…", "“", "!", "-", "_", "<|endoftext|>", "😀", "\r\n", "\x00", "\x0b", "ß", "ñ"]
    with open(BYTE_BPE) as source:
        encode = token_blocks.Encoder(source.read())
    assert encode.by_piece
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(3000)] + ["x" * 100_000, "ab " * 50_000]
    got = [ids.tolist() for a in range(0, len(texts), 7) for ids in encode([t.encode() for t in texts[a : a + 7]])]
    assert got == encoded(BYTE_BPE, texts)


def test_pieces_of_one_polynomial_hash_keep_their_own_ids():
    # A Thue-Morse word and its complement have the same polynomial hash modulo 2**64, whatever the odd base.
    word = "a"
    for _ in range(12):
        word += word.translate({97: "b", 98: "a"})
    texts = [f"same head {'x' * 8}{w}" for w in (word, word.translate({97: "b", 98: "a"}))]
    texts += ["short", "shorter", "shorter than sixteen", "exactly16bytes!!", "exactly16bytes!?", "caf\u00e9 \u3000 wide", ""]
    with open(BYTE_BPE, encoding="utf-8") as source:
        encode = token_blocks.Encoder(source.read())
    want = [e.ids for e in encode.model.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x.tolist() for x in encode([t.encode() for t in texts])] == want


def test_letters_of_all_scripts_keep_the_ids_of_whole_texts():
    from tokenizers import pre_tokenizers

    assert set(token_blocks.ALPHABET) == set(pre_tokenizers.ByteLevel.alphabet())
    rng = random.Random(3)
    signs = [chr(i) for i in [*range(0x3000), *rng.sample(range(0x3000, 0xD800), 1500), *rng.sample(range(0xE000, 0x110000), 3000)]]
    texts = [f"a{c}b {c}{c} {c}a'{c}" for c in signs] + ["".join(rng.sample(signs, 9)) for _ in range(1000)]
    with open(BYTE_BPE, encoding="utf-8") as source:
        encode = token_blocks.Encoder(source.read())
    got = [ids.tolist() for a in range(0, len(texts), 50) for ids in encode([t.encode() for t in texts[a : a + 50]])]
    assert got == encoded(BYTE_BPE, texts)


def test_memory_of_pieces_is_bounded_and_those_met_are_learnt_once(monkeypatch):
    monkeypatch.setattr(token_blocks, "MEMO", 400)
    monkeypatch.setattr(token_blocks, "LONG_BYTES", 20_000)
    rng = random.Random(4)
    with open(BYTE_BPE, encoding="utf-8") as source:
        encode = token_blocks.Encoder(source.read())
    learnt = []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda joined, a, b: learnt.extend(joined[x:y] for x, y in zip(a, b)) or learn(joined, a, b))
    often = [f" often{i}" for i in "abcdefgh"]
    for turn in range(60):
        texts = ["".join(often)] + ["".join(rng.choices("abcdef é1-", k=rng.choice([9, 99]))) for _ in range(8)] + ["x" * 3000 + "yz"[turn % 2] * turn]
        assert [x.tolist() for x in encode([t.encode() for t in texts])] == encoded(BYTE_BPE, texts)
        assert len(encode.memo.codes) < 4 * 400 + (1 << 14) and encode.memo.long_bytes == sum(map(len, encode.memo.long)) < 30_000
    assert encode.memo.n < len(learnt) and all(learnt.count(w.encode()) == 1 for w in often)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_token_files(spark, tmp_path, monkeypatch, path):
    monkeypatch.setattr(token_blocks, "FILE_IDS", 600)  # several files a task
    monkeypatch.setattr(token_blocks, "CHUNK_IDS", 512)
    rng = random.Random(2)
    texts = [None, "", " ", "short", "word " * 3000, "a\xa0b"] + [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(80)) for _ in range(40)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 2), (3, "short", 3), (3, "other", 4), (3, "short", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(5)
    folder = str(tmp_path / "files")
    token_blocks.write_token_files(docs, folder, path)
    back = token_blocks.read_token_files(spark, folder).collect()
    want = defaultdict(list)
    for (i, t, _), ids in zip(rows, encoded(path, [t or "" for _, t, _ in rows])):
        want[i].append([*ids, 0])
    got, at = defaultdict(list), 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        got[r["doc_id"]].append(list(struct.unpack(f"<{r['n_tokens']}I", r["ids"])))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r["doc_id"] for r in sorted(back, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    # Any range of ids is read from its own blocks.
    fs, _ = pafs.FileSystem.from_uri(folder)
    names = [f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.path.endswith(".ids")]
    assert len(names) > 3
    file = token_blocks.OpenFile(fs, max(names, key=lambda n: fs.get_file_info(n).size))
    every = file.ids(0, file.n_ids)
    for _ in range(20):
        a = rng.randrange(file.n_ids)
        b = rng.randrange(a, file.n_ids + 5)
        assert (file.ids(a, b) == every[a:b]).all()


def test_files_that_no_manifest_names_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "files")
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    token_blocks.write_token_files(docs, folder, BYTE_BPE)
    (tmp_path / "files" / "part-000000-0000-lost.ids").write_bytes(b"half a file")
    assert token_blocks.read_token_files(spark, folder).count() == 2
    empty = str(tmp_path / "empty")
    token_blocks.write_token_files(docs.limit(0), empty, BYTE_BPE)
    assert token_blocks.read_token_files(spark, empty).count() == 0


def test_token_query_on_whole_tables(spark):
    from chunkloom.llm.queries import op11_token_blocks

    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    ids = dict(zip(texts, encoded(BYTE_BPE, [t or "" for t in texts.values()])))
    want, at = {}, 0
    for i in sorted(ids):
        data = np.array([*ids[i], 0], "<u4").tobytes()
        want[i] = (at, len(data) // 4, zlib.crc32(data))
        at += len(data) // 4
    assert {r[0]: tuple(r[1:]) for r in op11_token_blocks(spark, folder).collect()} == want


# ---------------------------------------------------------------- whitening


def test_spectrum_of_matrices():
    rng = np.random.default_rng(0)
    wide = rng.standard_normal((200, 40))
    low = np.repeat(wide[:, :5], 8, axis=1)
    near = np.linalg.qr(wide[:40])[0] * np.sqrt(np.r_[[3.0, 3.0 * (1 + 1e-9)], np.linspace(0.1, 2, 38)])
    for matrix in (wide.T @ wide / 200, low.T @ low / 200, near @ near.T, np.diag(np.repeat([5.0, 3.0], 20)), np.eye(3), np.zeros((4, 4)), np.eye(1)):
        values, vectors, _ = whitening.leading(matrix, 32)
        want = np.linalg.eigvalsh(matrix)[::-1]
        rank = int((want > 1e-12 * max(want[0], 1e-300)).sum())
        assert len(values) == min(32, rank)
        assert np.allclose(values, want[: len(values)], rtol=1e-12, atol=1e-13)
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-10
        assert np.abs(matrix @ vectors.T - vectors.T * values).max(initial=0) < 1e-12 * (1 + want[0])
    assert whitening.Factors(np.array([[0.0, 1.0], [1.0, 0.0]]), 1e-18).negative() == 1


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((90, 6)) @ rng.standard_normal((6, 6))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(good)] + [(7, good[7].tolist(), 1), (None, good[3].tolist(), 2)]
    fit = np.vstack([good, good[7:8], good[3:4]])
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1e300] * 6, [1.0, 2.0]]
    df = spark.createDataFrame(rows + [(500 + i, v, 0) for i, v in enumerate(odd)], "vec_id long, embedding array<double>, component int").repartition(4)
    got = whitening.whiten(df, components=4).collect()
    x = (np.floor(64 * fit) + 1_000_000).astype(np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    want = centred @ vectors / np.sqrt(values)
    assert len(got) == 4 * n and {r["n"] for r in got} == {n}
    by_id = defaultdict(list)
    for r in got:
        by_id[(r["vec_id"], r["component"])].append(r)
    signs = [np.sign(by_id[(0, c + 1)][0]["whitened"] * want[0, c]) for c in range(4)]
    for i, (vec_id, _, _) in enumerate(rows):
        for c in range(4):
            r = by_id[(vec_id, c + 1)][0]
            assert abs(r["whitened"] - signs[c] * want[i, c]) < 1e-8
            assert r["deviation"] == int(((n * x[i] - s) ** 2).sum())
            assert abs(r["explained"] - values[c] / np.trace(centred.T @ centred / n)) < 1e-9
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    # Two vectors span one direction.
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.5])], schema)).select("component").distinct().count() == 1


# ---------------------------------------------------------------- prefix trie


def nodes_of(rows):
    conversations = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            conversations[c].append((turn is not None, turn or 0, role or "", text or ""))
    conversations = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in conversations.items()}
    rebuilt = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = conversations.get(c - c % 100, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        mine = members[node]
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(mine) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in mine if len(rebuilt[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((mine[0], len(node), parent, len(mine), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def tiny(monkeypatch):
    for name in ("BLOCK", "EDGE", "PIECE_IDS"):
        monkeypatch.setattr(prefix_trie, name, 2)


def test_trie_equals_brute_force(spark, tiny):
    rng = random.Random(5)
    rows, pool = [], []
    for c in rng.sample(range(900), 90):
        length = rng.choice([1, 1, 2, 3, 5, 8, 14, 20])
        turns = list(rng.choice(pool))[: rng.randrange(20)] if pool and rng.random() < 0.7 else []
        turns += [(rng.choice(["u", None]), rng.choice(["a", "bb", "ü", None])) for _ in range(length - len(turns))]
        pool.append(turns)
        at = [None if i == 0 and c % 3 == 0 else i for i in range(len(turns))]
        rows += [(c, i, role, text, 9) for i, (role, text) in zip(at, turns)]
    rows.append((None, 1, "u", "no conversation", 9))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int").repartition(5)
    assert sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=str) == nodes_of(rows)


def test_trie_of_equal_long_and_missing_conversations(spark, tiny):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(c, t, "u", "same") for c in range(30) for t in range(7)]  # one hot conversation
    rows += [(500, t, "u", f"{t % 3}") for t in range(300)]  # one long one
    rows += [(c, 0, None, None) for c in (601, 602, 777)]  # no base: some are left without turns
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=str) == nodes_of(rows)
    # Rows that share a turn, and repeated rows, stay turns of their own.
    tied = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "b"), (0, 0, "u", "a"), (0, 0, "u", "b"), (0, 0, "u", "b")]
    depth = prefix_trie.conversation_trie(spark.createDataFrame(tied, schema)).agg(F.max("depth"), F.count("*")).first()
    assert tuple(depth) == (3, 4)


def test_two_fattest_depths(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 60)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
