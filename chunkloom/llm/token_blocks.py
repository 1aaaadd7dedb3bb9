"""Token ids of whole texts in binary files of patched frame-of-reference blocks.

``write_token_files`` orders documents by id over range partitions, turns each text into ids and saves them with the
data source ``token_blocks``; ``spark.read.format("token_blocks")`` reads a folder of such files back, one row a
document, in any session that has called ``register``.

A file holds blocks of 512 ids, whatever document they belong to. A block keeps its least id once and the distances
from it packed at the width that fits a percentile of them, the percentile being the one that makes the block
smallest; distances that need more bits stand in an exception list of positions and values. The index at the end of
a file gives the start of each block in bytes, so that any range of ids is read without the rest, and the documents
with their numbers of ids.

Layout, little endian: magic; for each block its packed words, exception positions (u16) and exception values (u32);
index: block starts (u64, one more than blocks), least ids (u32), widths (u8), numbers of exceptions (u16),
document ids (i64), null flags (u8), numbers of ids (u64); footer: blocks, documents, ids, place of the index (u64),
crc32 of the index (u32), magic.

Each task streams its rows into files of its own; a file counts only when the driver has listed it in the manifest,
which holds a name and two numbers a file, so lost or repeated tasks leave nothing that is read.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import NOT_SPACE, mix, scratch_root, text_bytes, with_columns_renamed, word_spans

MAGIC = b"PFORIDS1"
BLOCK = 512
PERCENTILES = (50, 75, 90, 95, 98, 100)
CHUNK_IDS = 1 << 19  # ids encoded or decoded at a time
FILE_IDS = 1 << 25  # ids after which a task begins another file
FOOTER = "<QQQQI8s"
MANIFEST = "_files.json"
END_ID = 0
CHUNK_BYTES = 1 << 20  # text encoded at a time, if no text is longer
MEMO = 1 << 19  # pieces after which those not met again are forgotten
LONG_BYTES = 1 << 24  # bytes in pieces of more than 16 bytes after which these are forgotten
LINES = 64  # pieces encoded as one text


# ---------------------------------------------------------------- blocks


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 512 values below 2**width as rows of 64-bit words; 64 values fill ``width`` words."""
    lanes = values.reshape(len(values), BLOCK // 64, 64).astype(np.uint64)
    out = np.zeros((len(values), BLOCK // 64, max(width, 1)), np.uint64)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        out[:, :, word] |= lanes[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= lanes[:, :, i] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)[:, : BLOCK // 64 * width]


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK // 64, 64), np.uint64)
    if not width:
        return out.reshape(len(words), BLOCK)
    lanes = words.reshape(len(words), BLOCK // 64, width)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = lanes[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (lanes[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, i] = value & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, least id, width and number of exceptions of each block; the last block is filled up with its own last id."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return [], *(np.zeros(0, np.int64) for _ in range(3))
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(blocks, BLOCK)
    least = rows.min(axis=1)
    over = rows - least[:, None]
    ranked = np.sort(over, axis=1)
    at = np.array([-(-p * BLOCK // 100) - 1 for p in PERCENTILES])
    widths = _bits(ranked[:, at])
    cost = widths * (BLOCK // 8) + (BLOCK - 1 - at)[None, :] * 6
    width = widths[np.arange(blocks), cost.argmin(axis=1)]
    outside = over >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    count = outside.sum(axis=1)
    where, place = np.nonzero(outside)
    values = over[where, place].astype("<u4")
    cuts = np.cumsum(count) - count
    inside = np.where(outside, np.uint32(0), over)
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        for i, words in zip(mine.tolist(), _pack(inside[mine], w).astype("<u8")):
            a, b = int(cuts[i]), int(cuts[i] + count[i])
            out[i] = words.tobytes() + (place[a:b].astype("<u2").tobytes() + values[a:b].tobytes() if b > a else b"")
    return out, least, width, count


def decode_blocks(data: bytes, starts: np.ndarray, least: np.ndarray, width: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All ids of consecutive blocks; ``starts`` are places in ``data``, with its end."""
    out = np.zeros((len(least), BLOCK), np.uint64)
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        size = BLOCK // 8 * w
        if w:
            words = np.stack([np.frombuffer(data, "<u8", size // 8, int(starts[i])) for i in mine])
            out[mine] = _unpack(words, w)
    for i in np.flatnonzero(count).tolist():
        n, at = int(count[i]), int(starts[i]) + BLOCK // 8 * int(width[i])
        out[i, np.frombuffer(data, "<u2", n, at)] = np.frombuffer(data, "<u4", n, at + 2 * n)
    return (out + least[:, None].astype(np.uint64)).astype(np.uint32).ravel()


# ---------------------------------------------------------------- files


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


class BlockFile:
    """One file being written: blocks go out as they fill, the index is kept for the end."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.out = fs.open_output_stream(path)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.starts, self.heads, self.docs = [], [], []
        self.rest, self.held = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.n_ids += len(ids)
        for a in range(0, len(ids), CHUNK_IDS):
            part = ids[a : a + CHUNK_IDS]
            self.rest.append(part)
            self.held += len(part)
            if self.held >= CHUNK_IDS:
                self._blocks(last=False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        data, *heads = encode_blocks(ids[:whole])
        sizes = np.array([len(d) for d in data], np.int64)
        self.starts.append(self.at + np.cumsum(sizes) - sizes)
        self.heads.append(heads)
        self.out.write(b"".join(data))
        self.at += int(sizes.sum())
        self.rest, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._blocks(last=True)
        starts = np.concatenate([*self.starts, [self.at]])
        least, width, count = (np.concatenate([h[j] for h in self.heads]) for j in range(3))
        doc_ids, nulls, sizes = (np.array([d[j] for d in self.docs]) for j in range(3))
        index = b"".join(
            x.astype(kind).tobytes()
            for x, kind in (
                (starts, "<u8"), (least, "<u4"), (width, "u1"), (count, "<u2"), (doc_ids, "<i8"), (nulls, "u1"), (sizes, "<u8"),
            )
        )
        self.out.write(index)
        self.out.write(struct.pack(FOOTER, len(least), len(self.docs), self.n_ids, self.at, zlib.crc32(index), MAGIC))
        self.out.close()


class OpenFile:
    """The index of a file, and any range of its ids."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.source = fs.open_input_file(path)
        size = self.source.size()
        blocks, docs, self.n_ids, at, crc, magic = struct.unpack(FOOTER, self.source.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        index = self.source.read_at(size - struct.calcsize(FOOTER) - at, at)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{path} is no whole file of token blocks")
        found, place = [], 0
        for n, kind in ((blocks + 1, "<u8"), (blocks, "<u4"), (blocks, "u1"), (blocks, "<u2"), (docs, "<i8"), (docs, "u1"), (docs, "<u8")):
            found.append(np.frombuffer(index, kind, n, place).astype(np.int64))
            place += n * np.dtype(kind).itemsize
        self.starts, self.least, self.width, self.count, self.doc_ids, self.nulls, self.sizes = found

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file, from the blocks that hold them only."""
        end = min(end, self.n_ids)
        if begin >= end:
            return np.zeros(0, np.uint32)
        a, b = begin // BLOCK, -(-end // BLOCK)
        first = int(self.starts[a])
        data = self.source.read_at(int(self.starts[b]) - first, first)
        ids = decode_blocks(data, self.starts[a : b + 1] - first, self.least[a:b], self.width[a:b], self.count[a:b])
        return ids[begin - a * BLOCK : end - a * BLOCK]


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[tuple[str, int, int]]


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        partition = TaskContext.get().partitionId()
        done: list[tuple[str, int, int]] = []
        now = name = None
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                if now is None:
                    # A name of its own for each attempt, so that attempts never share a file.
                    name = f"part-{partition:06d}-{len(done):04d}-{uuid.uuid4().hex}.ids"
                    now = BlockFile(fs, f"{folder}/{name}")
                now.add(doc_id, np.frombuffer(ids.as_buffer() or b"", "<u4") if ids.is_valid else np.zeros(0, np.uint32))
                if now.n_ids >= FILE_IDS:
                    now.close()
                    done.append((name, len(now.docs), now.n_ids))
                    now = None
        if now is not None:
            now.close()
            done.append((name, len(now.docs), now.n_ids))
        return Written(partition, done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        for name, *_ in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{folder}/{name}")


@dataclass
class FilePart(InputPartition):
    name: str
    before: int  # ids of all files before


class BlockReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[FilePart]:
        fs, folder = file_system(self.path)
        with fs.open_input_stream(f"{folder}/{MANIFEST}") as source:
            files = json.loads(source.read())
        out, before = [], 0
        for name, _, n_ids in files:
            out.append(FilePart(name, before))
            before += n_ids
        return out or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, folder = file_system(self.path)
        file = OpenFile(fs, f"{folder}/{partition.name}")
        ends = np.cumsum(file.sizes)
        held: list[np.ndarray] = []
        doc, begin = 0, 0  # next document, and the id at which ``held`` begins
        for a in range(0, max(file.n_ids, 1), CHUNK_IDS):
            b = min(a + CHUNK_IDS, file.n_ids)
            held.append(file.ids(a, b))
            upto = int(np.searchsorted(ends, b, side="right"))
            if upto == doc:
                continue
            ids = np.concatenate(held).astype("<u4", copy=False)
            stops = ends[doc:upto] - begin
            offsets = np.concatenate([[0], stops]).astype(np.int64) * 4
            data = pa.py_buffer(ids[: stops[-1]].tobytes())
            texts = pa.Array.from_buffers(pa.large_binary(), upto - doc, [None, pa.py_buffer(offsets.tobytes()), data])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file.doc_ids[doc:upto], pa.int64(), mask=file.nulls[doc:upto].astype(bool)),
                    pa.array(ends[doc:upto] - file.sizes[doc:upto] + partition.before, pa.int64()),
                    pa.array(file.sizes[doc:upto], pa.int64()),
                    texts.cast(pa.binary()),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )
            held, begin, doc = [ids[stops[-1] :]], int(ends[upto - 1]), upto


class TokenBlocks(DataSource):
    """``token_blocks``: rows (doc_id, ids) are written in the order of the partitions; ids are little-endian u32."""

    @classmethod
    def name(cls) -> str:
        return "token_blocks"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> BlockWriter:
        return BlockWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenBlocks)


# ---------------------------------------------------------------- ids

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
MARKS = np.zeros(256, bool)
MARKS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
WORDLIKE = LETTERS | (np.arange(256) >= 0x80)
# The signs of a byte-level tokenizer for bytes: printable characters stand for themselves, others from 256 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = "".join(chr(b if b in PRINTABLE else 256 + b - sum(p < b for p in PRINTABLE)) for b in range(256))


def wide_space(buffer: np.ndarray) -> np.ndarray:
    """Places where white space outside ASCII begins."""
    if len(buffer) < 3:
        buffer = np.concatenate([buffer, np.zeros(3 - len(buffer), np.uint8)])
    a, b, c = buffer[:-1], buffer[1:], np.append(buffer[2:], np.uint8(0))
    lead = np.flatnonzero((a == 0xC2) | (a == 0xE1) | (a == 0xE2) | (a == 0xE3))
    a, b, c = a[lead], b[lead], c[lead]
    general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
    return lead[
        (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general
        | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    ]


def pieces(buffer: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that make up the texts at ``begins`` to ``ends``, cut only where a byte-level tokenizer cuts as well.

    Runs of white space stand alone but for a last space, which goes with the word after it; a word is also cut
    between a letter and a punctuation mark of ASCII. Between texts stands one line break.
    """
    first, stop = word_spans(buffer, NOT_SPACE)
    text = np.searchsorted(begins, first, side="right") - 1
    before = begins[text]
    same = np.append(False, text[1:] == text[:-1])
    before = np.where(same, np.append(0, stop[:-1]), before) if len(first) else before
    gap, spaced = first > before, buffer[first - 1] == 0x20
    flags = np.zeros(len(buffer) + 1, bool)
    for at in (begins, ends, stop, first[gap] - 1, first[~(gap & spaced)]):
        flags[at] = True
    flags[1:-1] |= LETTERS[buffer[:-1]] & MARKS[buffer[1:]]
    starts = np.flatnonzero(flags)
    whole = np.zeros(len(buffer) + 1, bool)
    whole[ends] = True
    stops = np.append(starts[1:], len(buffer))
    inner = ~whole[starts]
    return starts[inner], stops[inner]


def _marks(
    joined: bytes, starts: np.ndarray, ends: np.ndarray, places: dict[bytes, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three numbers that tell pieces apart: first and last eight bytes, and length.

    A piece of more than 16 bytes has its place in ``places`` instead of its last bytes.
    """
    padded = np.frombuffer(joined + bytes(8), np.uint8)
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    width = ends - starts
    keep = np.where(width >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (8 * np.minimum(width, 7)).astype(np.uint64)) - np.uint64(1))
    heads = eights[starts].view("<u8").ravel() & keep
    tails = eights[np.maximum(ends - 8, starts)].view("<u8").ravel() & keep
    long = np.flatnonzero(width > 16)
    for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
        tails[i] = places.setdefault(joined[a:b], len(places))
    return heads, tails, width


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, as many as ``count`` says, one after the other."""
    after = np.cumsum(count)
    return np.repeat(begin - (after - count), count) + np.arange(after[-1] if len(after) else 0)


class Memo:
    """Ids of the pieces met so far, in arrays; ``slots`` is an open hash table of places in them.

    A piece is known by its code, first bytes and length. The code mixes these and the last bytes one to one, so that
    pieces alike in all three are equal.
    """

    def __init__(self):
        self.long: dict[bytes, int] = {}  # places of pieces of more than 16 bytes among these
        self.long_bytes = 0
        self.codes, self.heads = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.width, self.begin, self.count = (np.zeros(0, kind) for kind in (np.int32, np.int64, np.int32))
        self.met, self.ids = np.zeros(0, bool), np.zeros(0, "<u4")
        self._hold(np.zeros(0, np.int64), 1 << 14)

    def _hold(self, keep: np.ndarray, room: int) -> None:
        """Keep the pieces at some places, in that order, in arrays with room for more."""
        count = self.count[keep]
        self.ids = self.ids[_spread(self.begin[keep], count)]
        self.begin[keep] = np.cumsum(count) - count
        self.n, self.n_ids = len(keep), len(self.ids)
        for name in ("codes", "heads", "width", "begin", "count", "met"):
            old = getattr(self, name)
            new = np.empty(room, old.dtype)
            new[: self.n] = old[keep]
            setattr(self, name, new)
        self.slots = np.full(1 << (2 * room - 1).bit_length(), -1, np.int32)
        self._enter(np.arange(self.n))

    def _enter(self, places: np.ndarray) -> None:
        last = len(self.slots) - 1
        at = (self.codes[places] & np.uint64(last)).astype(np.int64)
        while len(places):
            free = self.slots[at] < 0
            self.slots[at[free]] = places[free]  # one of several stays
            lost = np.flatnonzero(self.slots[at] != places)
            places, at = places[lost], (at[lost] + 1) & last

    def find(self, codes: np.ndarray, heads: np.ndarray, width: np.ndarray) -> np.ndarray:
        """The place of each piece, -1 for those not held."""
        last = len(self.slots) - 1
        at = (codes & np.uint64(last)).astype(np.int64)
        out = np.full(len(codes), -1, np.int64)
        left = np.arange(len(codes))
        while len(left):
            place = self.slots[at]
            same = (place >= 0) & (self.codes[place] == codes) & (self.heads[place] == heads) & (self.width[place] == width)
            out[left[same]] = place[same]
            on = np.flatnonzero((place >= 0) & ~same)
            left, codes, heads, width, at = left[on], codes[on], heads[on], width[on], (at[on] + 1) & last
        self.met[out[out >= 0]] = True
        return out

    def add(self, codes: np.ndarray, heads: np.ndarray, width: np.ndarray, learnt: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Places of different pieces not held yet, given their ids and which are whose."""
        ids, begin, count = learnt
        stop = self.n + len(codes)
        if stop > len(self.codes):
            self._hold(np.arange(self.n), stop * 3 // 2)
        self.long_bytes += int(width[width > 16].sum())
        new = slice(self.n, stop)
        self.codes[new], self.heads[new], self.width[new] = codes, heads, width
        self.begin[new], self.count[new], self.met[new] = begin + self.n_ids, count, False
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.append(self.ids[: self.n_ids], np.empty(self.n_ids // 2 + len(ids), "<u4"))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        places = np.arange(self.n, stop)
        self.n, self.n_ids = stop, self.n_ids + len(ids)
        self._enter(places)
        return places

    def forget(self) -> None:
        """Of very many pieces keep those met again, the latest half at most; of very many bytes in long ones no long one."""
        if self.n > MEMO or self.long_bytes > LONG_BYTES:
            keep = np.flatnonzero(self.met[: self.n] & (self.width[: self.n] <= 16))[-MEMO // 2 :]
            self.long, self.long_bytes = {}, 0
            self._hold(keep, max(2 * len(keep), 1 << 14))
            self.met[: self.n] = False


class Encoder:
    """Ids of texts. A byte-level tokenizer encodes each distinct piece of the texts once, others whole texts."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_str(tokenizer)
        self.model.encode_special_tokens = True  # the strings of special tokens are ordinary text
        spec = json.loads(tokenizer)
        cut = spec.get("pre_tokenizer") or {}
        # Pieces are encoded as lines of one text, which is exact where a line break is one id of its own.
        self.line = self._plain(["\n"])[0]
        self.by_piece = (
            spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut.get("add_prefix_space") and len(self.line) == 1
        )
        # A piece of letters is one word to the pre-tokenizer as well; the same model gets it in the alphabet of bytes.
        self.words = Tokenizer(self.model.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.cuts = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.letters: dict[str, bool] = {}
        self.memo = Memo()

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(ids, "<u4") for ids in self._plain([t.decode() for t in texts])]

    def _others(self, text: str) -> set[str]:
        """Characters that are no letters to the pre-tokenizer."""
        found = set(text)
        for c in found.difference(self.letters):
            self.letters[c] = len(self.cuts.pre_tokenize_str(f"a{c}a")) == 1
        return {c for c in found if not self.letters[c]}

    def _learn(self, joined: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and for each piece its first and its number of ids."""
        buffer = np.frombuffer(joined, np.uint8)
        found = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        blank = ~NOT_SPACE[buffer[ends - 1]]
        before = np.cumsum(np.append(False, ~WORDLIKE[buffer]))
        word = ~blank & (before[ends] == before[starts + (buffer[starts] == 0x20)])
        others = self._others(b"".join([found[i] for i in np.flatnonzero(word).tolist()]).decode()) - {" "}
        if others:
            word[word] = [others.isdisjoint(found[i].decode()) for i in np.flatnonzero(word).tolist()]
        words, lines, blank = (np.flatnonzero(x).tolist() for x in (word, ~word & ~blank, blank))
        texts = [[b"\n".join([found[i] for i in mine[a : a + LINES]]) for a in range(0, len(mine), LINES)] for mine in (words, lines)]
        signs = [codecs.charmap_decode(t, "strict", ALPHABET)[0].replace(ALPHABET[10], f" {ALPHABET[10]} ") for t in texts[0]]
        ids = [e.ids for e in self.words.encode_batch_fast(signs, add_special_tokens=False)]
        ids += self._plain([t.decode() for t in texts[1]])
        every = np.array([i for group in ids for i in (*group, *self.line)], "<u4")
        stops = np.flatnonzero(every == self.line[0])
        rest = self._whole([found[i] for i in blank])
        if len(stops) != len(words) + len(lines):
            raise ValueError("a line break inside a piece")
        order = np.array([*words, *lines, *blank], np.int64)
        begin, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        count[order] = np.concatenate([np.diff(stops, prepend=-1) - 1, np.array([len(x) for x in rest], np.int64)])
        begin[order] = np.cumsum(count[order]) - count[order]
        return np.concatenate([every[every != self.line[0]], *rest]), begin, count

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. White space outside ASCII can join runs that are cut here; texts with it are encoded whole."""
        if not self.by_piece:
            return self._whole(texts)
        joined = b"\n".join(texts) + b"\n"
        buffer = np.frombuffer(joined, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        odd = set((np.searchsorted(begins, wide_space(buffer), side="right") - 1).tolist())
        if odd:
            rest = iter(self([t for i, t in enumerate(texts) if i not in odd]))
            whole = iter(self._whole([t for i, t in enumerate(texts) if i in odd]))
            return [next(whole if i in odd else rest) for i in range(len(texts))]
        starts, ends = pieces(buffer, begins, begins + sizes)
        if not len(starts):
            return [np.zeros(0, "<u4")] * len(texts)
        memo = self.memo
        memo.forget()
        heads, tails, width = _marks(joined, starts, ends, memo.long)
        with np.errstate(over="ignore"):
            codes = mix(heads ^ mix(tails + width.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        place = memo.find(codes, heads, width)
        new = np.flatnonzero(place < 0)
        if len(new):
            order = new[np.argsort(codes[new])]
            fresh = np.append(True, codes[order][1:] != codes[order][:-1])
            one, kind = order[fresh], np.cumsum(fresh) - 1
            # Different pieces that share a code would be taken for one.
            if any((x[order] != x[one][kind]).any() for x in (heads, width)):
                return self._whole(texts)
            learnt = self._learn(joined, starts[one], ends[one])
            place[order] = memo.add(codes[one], heads[one], width[one], learnt)[kind]
        count = memo.count[place]
        ids = memo.ids[_spread(memo.begin[place], count)]
        after = np.cumsum(count)
        cuts = np.append(0, after)[np.searchsorted(starts, np.append(begins, len(buffer)))]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def with_ids(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids) of each row of (doc_id, text), in place; ids of the whole text, then ``end_id``."""
    # A few megabytes at most: the file of one tokenizer, kept with its memo as long as a worker lives.
    with open(tokenizer, encoding="utf-8") as source:
        held = docs.sparkSession.sparkContext.broadcast({"file": source.read()})
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = held.value
        if "encoder" not in state:
            state["encoder"] = Encoder(state["file"])
        encode = state["encoder"]
        for batch in batches:
            doc_ids, column = batch.column("doc_id"), batch.column("text")
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            a = size = 0
            for i, more in enumerate(sizes):
                size += more
                if size >= CHUNK_BYTES or i + 1 == len(sizes):
                    ids = [np.concatenate([x, end]).tobytes() for x in encode(text_bytes(column.slice(a, i + 1 - a)))]
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(a, len(ids)), pa.array(ids, pa.binary())], ["doc_id", "ids"])
                    a, size = i + 1, 0

    return docs.mapInArrow(run, "doc_id long, ids binary")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID) -> None:
    """Write the ids of all texts to files in ``path`` in ascending order of doc_id, null first.

    Null and empty texts have no ids but the end id. Rows that share an id are ordered by a hash of their text; equal
    rows stay, each with ids of its own. Ranges are cut by id, text and place, so a hot id is spread over tasks.
    Further columns are ignored; an empty table gives a folder without files. Memory follows the longest text.
    """
    register(docs.sparkSession)
    rows = with_columns_renamed(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("doc_id").asc_nulls_first(), "h", "tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    with_ids(ordered, tokenizer, end_id).write.format("token_blocks").mode("append").save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian u32) of every document."""
    register(spark)
    return spark.read.format("token_blocks").load(path)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``write_token_files`` into the shared folder and ``read_token_files`` from it."""
    path = f"{scratch_root(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer)
    return read_token_files(docs.sparkSession, path)
