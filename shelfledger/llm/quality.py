"""Quality score of whole texts: histogram gradient-boosted trees over document statistics.

Statistics of all documents are taken in one pass over the texts and stored. The trees are grown on a
bounded sample of labelled rows, on quantile histograms, and flattened into arrays of complete binary
trees, so that scoring is a fixed number of numpy steps for a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import released, stored
from shelfledger.llm.words import _GAP, PIECE, slices, text_bytes, words

TRAIN_ROWS = 40_000  # labelled rows the trees are grown on, about, chosen by hash of the id
BINS, DEPTH, TREES, RATE, L2, LEAST_WEIGHT = 64, 4, 60, 0.15, 1.0, 2.0

NAMES = [
    "log_bytes", "log_words", "word_bytes", "letters", "upper", "digits", "stops", "symbols", "foreign", "breaks",
    "distinct_words", "top_word", "repeated_neighbours", "capitalised", "shouted", "symbol_ends", "bare_symbols",
    "log_lines", "line_bytes", "repeated_lines", "distinct_pairs", "longest_word",
]

_CLASS = np.full(256, 5, np.int8)  # 0 letter, 1 upper, 2 digit, 3 stop, 4 symbol, 5 foreign, 6 gap, 7 line break
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[33:48] = _CLASS[58:65] = _CLASS[91:97] = _CLASS[123:127] = 4
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63]] = 3
_CLASS[_GAP] = 6
_CLASS[:9] = 4
_CLASS[10] = 7


def _distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the number of distinct keys, and how often its most frequent key stands."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])])) if len(k) else np.zeros(0, int)
    times = np.diff(np.append(first, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, r[first], times)
    return np.bincount(r[first], minlength=n), most


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of NAMES per text; all 0 for an empty text."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    kind = _CLASS[data]
    per = np.bincount(row * 8 + kind, minlength=8 * n).reshape(n, 8)
    hashes, counts = words(offsets, data)
    of = np.repeat(np.arange(n), counts)
    ends_row = np.concatenate([row[1:] != row[:-1], [True]]) if len(row) else np.zeros(0, bool)
    begins_row = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    inside = kind < 6
    starts = np.flatnonzero(inside & (begins_row | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (ends_row | ~np.concatenate([inside[1:], [False]])))
    length = ends - starts + 1
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    first, last = kind[starts], kind[ends]
    uppers = np.concatenate([[0], np.cumsum(kind == 1)])
    plain = np.concatenate([[0], np.cumsum(kind <= 2)])
    foreign = np.concatenate([[0], np.cumsum(kind == 5)])
    count = lambda flag: np.bincount(of[flag], minlength=n)
    shouted = (uppers[ends + 1] - uppers[starts] >= 2) & (uppers[ends + 1] - uppers[starts] == plain[ends + 1] - plain[starts])
    bare = (plain[ends + 1] - plain[starts] == 0) & (foreign[ends + 1] - foreign[starts] == 0)
    kinds, top = _distinct(hashes, of, n)
    same_row = of[1:] == of[:-1]
    pairs, _ = _distinct((hashes[:-1] * np.uint64(3) + hashes[1:])[same_row], of[:-1][same_row], n)
    again = np.bincount(of[1:][same_row & (hashes[1:] == hashes[:-1])], minlength=n)

    cut = np.flatnonzero((kind == 7) | ends_row)
    line_row = row[cut]
    word_line = np.searchsorted(cut, starts)
    sums = np.bincount(word_line, weights=(hashes >> np.uint64(12)).astype(np.float64), minlength=len(cut))
    full = np.bincount(word_line, minlength=len(cut)) > 0
    lines = np.bincount(line_row[full], minlength=n)
    line_kinds, _ = _distinct(sums[full].view(np.uint64), line_row[full], n)

    size, w, ln = np.maximum(sizes, 1), np.maximum(counts, 1), np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(sizes), np.log1p(counts), sizes / w, per[:, 0] / size, per[:, 1] / size, per[:, 2] / size, per[:, 3] / size,
        per[:, 4] / size, per[:, 5] / size, per[:, 7] / size, kinds / w, top / w, again / w, count(first == 1) / w,
        count(shouted) / w, count(last == 4) / w, count(bare) / w, np.log1p(lines), sizes / ln, (lines - line_kinds) / ln,
        pairs / np.maximum(counts - 1, 1), np.log1p(longest),
    ]).astype(np.float32)


@released
def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = text_bytes(batch.column(batch.num_columns - 1))
        for i, j in slices(offsets, PIECE):
            found = statistics(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])
            part = batch.slice(i, j - i)
            ends = pa.array(np.arange(0, found.size + 1, len(NAMES), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], [*part.schema.names[:-1], "statistics"]
            )


@dataclass(frozen=True)
class Trees:
    """Complete trees in arrays, node k's children at 2k+1 and 2k+2: ``feature`` and ``above`` per inner
    node, ``value`` per leaf. A node that isn't split sends all to the left."""

    feature: np.ndarray
    above: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, above, value in zip(self.feature, self.above, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner if len(x) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosts trees on the log loss. Without both labels the trees are empty and the base decides."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)), base)
    columns = x.shape[1]
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in range(columns)]
    binned = np.column_stack([np.searchsorted(edges[c], x[:, c], "left") for c in range(columns)])
    margin = np.full(len(y), base)
    out = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut, above = np.zeros(inner, np.int64), np.full(inner, BINS), np.full(inner, np.inf, np.float32)
        for level in range(DEPTH):
            lo, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            at = (node - lo) * BINS
            for c in range(columns):
                key = at + binned[:, c]
                gs = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga**2 / (ha + L2)
                gain[(hl < LEAST_WEIGHT) | (ha - hl < LEAST_WEIGHT)] = 0
                k = gain[:, : len(edges[c])].argmax(1) if len(edges[c]) else np.zeros(width, np.int64)
                top = gain[np.arange(width), k]
                for m in np.flatnonzero(top > best):
                    best[m], feature[lo + m], cut[lo + m], above[lo + m] = top[m], c, k[m], edges[c][k[m]]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        margin += value[leaf]
        out.append((feature, above, value))
    return Trees(*(np.array(part) for part in zip(*out)), base)


def scored(docs: DataFrame, labels: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: id, score, 0 to 1.

    ``learn_from``: condition on the id of the rows whose labels may be learned. ``labels`` has the id
    and the label, 0 or 1; null labels and ids are left out. Without usable labels all scores are 0.5.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    stats = stored(rows.mapInArrow(_statistics, f"id {kind}, statistics array<float>"), "statistics")
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)")
    train = marked.filter(learn_from(F.col("id"))).join(stats, "id")
    share = TRAIN_ROWS / max(1, marked.count())
    draw = F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") / float(1 << 53)
    sample = train.filter(draw < share).select("id", "label", "statistics").toPandas().sort_values("id")
    x = np.array(sample["statistics"].tolist(), np.float32).reshape(-1, len(NAMES))
    shared = docs.sparkSession.sparkContext.broadcast(grow(x, sample["label"].to_numpy(np.float64)))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray(batch.column(1).flatten(), np.float32).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(found))], ["id", "score"])

    return stats.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


