"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Cyclic boosting fits a tree of a few leaves to one feature after another and
adds it to that feature's lookup table; then trees with one cut on each axis are added to tables of the pairs
that promise most. A score is the sum of one entry of each table, for many texts at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import text_bytes, with_columns_renamed

SAMPLE_ROWS = 20_000  # most labelled rows a model is fitted on
BINS, PAIR_BINS, PAIRS = 32, 8, 12
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.15, 2.0

FEATURES = (
    "length words word_length upper digits non_ascii marks exclaimed barred breaks spaces distinct_words "
    "top_word repeated_next distinct_pairs distinct_lines line_length stops"
).split()
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]


def features_of(text: bytes) -> list[float]:
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, words, lines = len(text), text.split(), text.split(b"\n")
    n = len(words)
    per, each = 1.0 / max(size, 1), 1.0 / max(n, 1)
    seen = Counter(words)
    return [
        np.log1p(size),
        np.log1p(n),
        size * each,
        counts[65:91].sum() * per,
        counts[48:58].sum() * per,
        counts[128:].sum() * per,
        counts[_MARKS].sum() * per,
        counts[33] * per,
        counts[124] * per,
        counts[10] * per,
        counts[32] * per,
        len(seen) * each,
        max(seen.values(), default=0) * each,
        sum(map(eq, words, words[1:])) * each,
        len(set(zip(words, words[1:]))) * each,
        len(set(lines)) / len(lines),
        size / len(lines),
        counts[46] * each,
    ]


def feature_rows(texts: list[bytes]) -> np.ndarray:
    return np.array([features_of(t) for t in texts], float).reshape(len(texts), len(FEATURES))


class Additive:
    """Bin edges, one table per feature, and one table per chosen pair of features."""

    def __init__(self, base: float = 0.0):
        self.base = base
        self.edges: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.coarse: list[np.ndarray] = []  # bin of a feature to its bin in pair tables
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        bins = self.bins(x)
        for b, t in zip(bins, self.tables):
            total += t[b]
        for (f, g), t in zip(self.pairs, self.pair_tables):
            total += t[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _leaves(g: np.ndarray, h: np.ndarray, cuts: int = 2) -> np.ndarray:
    """Values per bin of a tree with ``cuts`` splits: the best split of the best leaf each time."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(cuts):
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gl, hl, gr, hr = cg[k] - cg[a], ch[k] - ch[a], cg[b] - cg[k], ch[b] - ch[k]
            gains = _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr)
            i = int(gains.argmax())
            if gains[i] > best[0]:
                best = (gains[i], (a, b), a + 1 + i)
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on each axis of a pair."""
    cg, ch = np.zeros(np.add(g.shape, 1)), np.zeros(np.add(h.shape, 1))
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    i, j = np.ix_(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]))

    def quarters(c):
        ll = c[i, j]
        lr, rl = c[i, -1] - ll, c[-1, j] - ll
        return ll, lr, rl, c[-1, -1] - ll - lr - rl

    qg, qh = quarters(cg), quarters(ch)
    gains = sum(_gain(a, b) for a, b in zip(qg, qh)) - _gain(cg[-1, -1], ch[-1, -1])
    if not gains.size:
        return 0.0, np.zeros(g.shape)
    at = np.unravel_index(gains.argmax(), gains.shape)
    value = [a[at] / (b[at] + RIDGE) for a, b in zip(qg, qh)]
    out = np.empty(g.shape)
    x, y = at[0] + 1, at[1] + 1
    out[:x, :y], out[:x, y:], out[x:, :y], out[x:, y:] = value
    return float(gains[at]), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit on rows in a fixed order; without rows, or of one class only, the score is the smoothed share."""
    share = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
    model = Additive(float(np.log(share / (1 - share))))
    if len(y) < 20 or len(np.unique(y)) < 2:
        return model
    for f in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])))
        n = len(model.edges[f]) + 1
        model.tables.append(np.zeros(n))
        model.coarse.append(np.arange(n) * min(PAIR_BINS, n) // n)
    bins = model.bins(x)
    total = np.full(len(y), model.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            g, h = slopes()
            n = len(model.tables[f])
            step = RATE * _leaves(np.bincount(b, g, n), np.bincount(b, h, n))
            model.tables[f] += step
            total += step[b]
    coarse = [model.coarse[f][b] for f, b in enumerate(bins)]
    sizes = [c.max() + 1 for c in model.coarse]

    def grid(f: int, k: int):
        g, h = slopes()
        at, shape = coarse[f] * sizes[k] + coarse[k], (sizes[f], sizes[k])
        n = sizes[f] * sizes[k]
        return np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape)

    order = [(-_quadrants(*grid(f, k))[0], f, k) for f in range(len(bins)) for k in range(f + 1, len(bins))]
    model.pairs = [(f, k) for _, f, k in sorted(order)[:PAIRS]]
    model.pair_tables = [np.zeros((sizes[f], sizes[k])) for f, k in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (f, k) in enumerate(model.pairs):
            step = RATE * _quadrants(*grid(f, k))[1]
            model.pair_tables[i] += step
            total += step[coarse[f], coarse[k]]
    return model


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Fit on at most ``sample_rows`` labelled texts that are not held out, chosen by a hash of the id.

    Several labels of an id count by their mean, and so do the features of several texts of an id; labels that are
    null or without a text are left out.
    """
    known = with_columns_renamed(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
    known = known.where(~held_out()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = with_columns_renamed(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = feature_rows(text_bytes(batch.column("text")))
            x = pa.array(list(rows), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), x], ["doc_id", "label", "x"])

    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    rows = texts.mapInArrow(run, "doc_id long, label int, x array<double>")
    each = [F.get("x", F.lit(f)) for f in range(len(FEATURES))]
    # Decimal sums do not depend on the order of the rows; the feature of a single row stays as it is.
    mean = [F.when(F.count("*") == 1, F.max(x)).otherwise(F.avg(x.cast("decimal(28,12)")).cast("double")) for x in each]
    # At most sample_rows rows of a few numbers, however many rows share an id.
    rows = rows.groupBy("doc_id", "label").agg(F.array(*mean).alias("x")).toPandas()
    rows = sorted(zip(rows["doc_id"], map(tuple, rows["x"]), rows["label"]))
    x = np.array([r[1] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r[2] for r in rows], float))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """All columns of ``docs`` and the column ``quality_score``, which replaces one of that name.

    Null and empty texts are scored like any other, by their (zero) features; so are repeated rows. The model, some
    thousand numbers, travels with the function, by value like all code, so workers need no copy of the package.
    """
    names = [c for c in docs.columns if c != "quality_score"]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = StructType([*rows.schema.fields, StructField("quality_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(feature_rows(text_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "quality_score"])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; further columns are ignored.

    Null and empty texts and repeated rows are scored like any other, rows without id count as not held out; an empty
    table gives no rows, and without usable labels every score is the same.
    """
    own = with_columns_renamed(docs, "doc_id", "text")
    scored = score(own, train(docs, labels, sample_rows))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )
