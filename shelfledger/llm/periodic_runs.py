"""Periodic runs of words: tiles per period octave, boundary Z-functions, stitched interval fragments.

A run is a stretch of consecutive words with smallest period q and a length of at least max(6, 4 q) that
no neighbouring word extends with period q. Periods P <= p < 2 P, P a power of 2, are an octave. A text is exploded into
tiles that overlap:

* one tile size of 16 P words and a step of 8 P serve octave P. Octaves up to that of ``tile`` words share
  its tiles, larger ones have their own; a tile that would reach over the whole text is the text, and
  octaves of equal tiles share one row.
* two tiles have 8 P >= 4 p words in common, so whatever a tile sees too little of, another sees whole.

Tiles are solved on their own. An octave's boundaries stand every P words. For boundary c and period p the
Z-functions of the boundary give how far words from c on equal those p later, forward and backward; the
sum of both is the interval in which words repeat with period p. Z-values are taken for all
boundaries of a batch at once from names of blocks of 2^k words: a block's name is a hash of the names of its
halves. Intervals long enough for a run, without a smaller period, are the tile's fragments.

Fragments are shuffled by document and period and stitched where they overlap. Texts that fit a tile are solved where
they are read, and the first fragment of such a text brings the text along; only the tiles of longer texts are dealt out.
Words and blocks are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import released, stored, without
from shelfledger.llm.damage import GAPS, split_words
from shelfledger.llm.words import PIECE, mix, slices, text_bytes, words

TILE = 1 << 13
LEAST_LENGTH, LEAST_TIMES = 6, 4
FRAGMENTS = "k1 bigint, k2 bigint, period bigint, start bigint, stop bigint, text string"
TILES = "k1 bigint, k2 bigint, base bigint, low int, high int, words binary"
KEY = ["k1", "k2"]
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def octave(n: np.ndarray) -> np.ndarray:
    """The highest octave that a text of ``n`` words can have a run of, -1 if none."""
    n = np.asarray(n, np.int64)
    return np.where(n >= LEAST_LENGTH, np.frexp(np.maximum(n // LEAST_TIMES, 1).astype(float))[1] - 1, -1)


def tiles(n: int, tile: int = TILE) -> list[tuple[int, int, int, int]]:
    """(start, end, lowest octave, highest octave) of the tiles of a text of ``n`` words."""
    top, out = int(octave(n)), []
    low, k = 0, max(0, tile.bit_length() - 5)
    while low <= top:
        size = 16 << k
        if size >= n:
            out.append((0, n, low, top))
            break
        high = min(k, top)
        out += [(s, min(s + size, n), low, high) for s in range(0, n - (8 << k), 8 << k)]
        low, k = high + 1, k + 1
    return out


class Names:
    """Names of all blocks of 2^k words in tiles laid one after the other, the tiles of the highest octaves first."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray, top: np.ndarray):
        self.starts, self.ends, self.top = starts, ends, top
        self.levels = [values]
        for k in range(1, int(top[0]) + 1 if len(top) else 0):
            n, half = int(ends[np.flatnonzero(top >= k)[-1]]), 1 << (k - 1)
            last = self.levels[-1][:n]
            name = mix(last * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
            name[: n - half] += last[half:]
            self.levels.append(mix(name))

    def forward(self, x: np.ndarray, y: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many words from ``x`` on equal those from ``y`` on, before ``end``."""
        return self._extent(x, y, end - y, 1)

    def backward(self, x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
        """How many words before ``x`` equal those before ``y``, from ``start`` on."""
        return self._extent(x, y, x - start, -1)

    def _extent(self, x: np.ndarray, y: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
        done = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, size = self.levels[k], 1 << k
            active = np.arange(len(x))
            while len(active):
                at = done[active]
                left, right = (x[active] + at, y[active] + at) if way > 0 else (x[active] - at - size, y[active] - at - size)
                fits = (at + size <= room[active]) & (np.maximum(left, right) < len(name))
                active, left, right = active[fits], left[fits], right[fits]
                active = active[name[left] == name[right]]
                done[active] += size
        return done


def _smallest_factors(n: int) -> np.ndarray:
    """The smallest prime factor of each number up to ``n``."""
    out = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            part = out[p * p :: p]
            part[part == np.arange(p * p, n + 1, p)] = p
    return out


def solve(values: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments of tiles laid one after the other: number of the tile, period, and the interval
    [start, stop) of words of the tile that equal those a period later."""
    top = np.minimum(octave(counts), high)
    order = np.argsort(-top, kind="stable")
    order = order[top[order] >= 0]
    begin = (np.cumsum(counts) - counts)[order]
    counts, low, top = counts[order], low[order], top[order]
    ends = np.cumsum(counts)
    starts = ends - counts
    gather = np.arange(ends[-1] if len(ends) else 0) - np.repeat(starts - begin, counts)
    names = Names(values[gather], starts, ends, top)
    found = []
    for k in range(len(names.levels) if len(order) else 0):
        size = 1 << k
        use = np.flatnonzero(top >= k)
        n = int(ends[use[-1]])
        name = names.levels[k][:n]
        tile = np.repeat(use, counts[use])
        rel = np.arange(n) - starts[tile]
        boundary = starts[tile] + (((rel >> k) - 1) << k)
        same = (low[tile] <= k) & (rel >= size) & (rel + size <= counts[tile])
        same[same] = name[same.nonzero()[0]] == name[boundary[same]]
        new = same.copy()
        new[size:] &= ~(same[:-size] & (tile[size:] == tile[:-size]))  # the boundary before saw the same interval
        y = np.flatnonzero(new)
        x, t = boundary[y], tile[y]
        p = y - x
        a = x - names.backward(x, y, starts[t])
        b = x + names.forward(x, y, ends[t])
        whole = b - a >= np.maximum(LEAST_LENGTH - p, (LEAST_TIMES - 1) * p)
        a, b, p, t = a[whole], b[whole], p[whole], t[whole]
        if not len(p):
            continue
        factor, rest, single = _smallest_factors(int(p.max())), p.copy(), np.ones(len(p), bool)
        while (rest > 1).any():
            prime = factor[rest]
            shorter = np.where(rest > 1, p // np.maximum(prime, 1), 0)
            equal = (name[a] == name[a + shorter]) & (name[a + p - size] == name[a + p - size + shorter])
            single &= ~((shorter > 0) & equal)
            rest = np.where(rest > 1, rest // np.maximum(prime, 1), 1)
        a, b, p, t = (v[single] for v in (a, b, p, t))
        found.append((order[t], p, a - starts[t], b - starts[t]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(v) for v in zip(*found))


def _fragments(k1: np.ndarray, k2: np.ndarray, base: np.ndarray, found: tuple[np.ndarray, ...], texts: pa.Array | None = None) -> pa.RecordBatch:
    """Fragment rows; with ``texts``, the first of each text has the text."""
    t, p, a, b = found
    cells = [pa.array(c.astype(np.int64)) for c in (k1[t], k2[t], p, base[t] + a, base[t] + b)]
    if texts is None:
        own = pa.nulls(len(t), pa.string())
    else:
        first = np.zeros(len(t), bool)
        first[np.unique(t, return_index=True)[1]] = True
        own = texts.take(pa.array(t, mask=~first)).cast(pa.string())
    return pa.RecordBatch.from_arrays([*cells, own], ["k1", "k2", "period", "start", "stop", "text"])


@released
def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        offsets, data = text_bytes(batch.column(2))
        for i, j in slices(offsets, PIECE):
            values, counts = words(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])
            none = np.zeros(j - i, np.int64)
            yield _fragments(k1[i:j], k2[i:j], none, solve(values, counts, none, none + 62), batch.column(2).slice(i, j - i))


def _exploded(tile: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 3, *[pa.int32()] * 2, pa.binary())
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            offsets, data = text_bytes(batch.column(2))
            for i, key in enumerate(keys):
                values, counts = words(np.array([0, offsets[i + 1] - offsets[i]]), data[offsets[i] : offsets[i + 1]])
                ids = np.unique(values, return_inverse=True)[1].astype(np.uint32)
                for s, e, low, high in tiles(int(counts[0]), tile):
                    row = (*key, s, low, high, ids[s:e].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], ["k1", "k2", "base", "low", "high", "words"])

    return run


@released
def _tiles_solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2, base, low, high = (batch.column(c).to_numpy().astype(np.int64) for c in range(5))
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch.column(5)[i].as_py(), np.uint32)
            one = slice(i, i + 1)
            found = solve(mix(ids.astype(np.uint64) + np.uint64(1)), np.array([len(ids)]), low[one], high[one])
            yield _fragments(k1[one], k2[one], base[one], found)


def stitched(fragments: DataFrame) -> DataFrame:
    """(k1, k2, start, length, period, text) of the runs that fragments (k1, k2, period, start, stop, text) are parts of.

    Fragments of one run overlap, as tiles do; those of two runs of one period don't even touch.
    """
    order = Window.partitionBy(*KEY, "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = fragments.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("part", F.sum("new").over(order))
    return parted.groupBy(*KEY, "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("text").alias("text")).select(
        *KEY, "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period", "text"
    )


def keyed(id_col: str = "doc_id", text_col: str = "text") -> list:
    """The text and two hashes of id and text: rows equal in both share a key, and nothing else does."""
    text = F.col(text_col).cast("string")
    return [text.alias("text"), F.xxhash64(F.col(id_col).isNull(), id_col, text).alias("k1"), F.xxhash64(text, F.lit(12), id_col).alias("k2")]


def _tiled(tile: int):
    """Whether a text may have more words than a tile: one of fewer than twice as many characters can't."""
    return F.length(F.coalesce("text", F.lit(""))) >= 2 * tile


def runs(texts: DataFrame, tile: int = TILE) -> DataFrame:
    """(k1, k2, start, length, period, text) of all runs of ``keyed`` texts; a null or empty text has none.

    One run of each text that is its own only tile has the text.
    """
    rows = texts.select(*KEY, F.coalesce("text", F.lit("")).alias("text"))
    near = rows.filter(~_tiled(tile)).mapInArrow(_whole_texts, FRAGMENTS)
    far = rows.filter(_tiled(tile)).mapInArrow(_exploded(tile), TILES)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = far.repartition(parts, *KEY, "base", "low")
    return stitched(near.union(dealt.mapInArrow(_tiles_solved, FRAGMENTS)))


@released
def _without_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for cell, found in zip(batch.column(3), batch.column(2).to_pylist()):
            every = cell.as_py()
            gone = np.zeros(len(every) + 1, np.int64)
            np.add.at(gone, [r["start"] + r["period"] for r in found], 1)
            np.add.at(gone, [r["start"] + r["length"] for r in found], -1)
            kept.append(" ".join(w for w, g in zip(every, np.cumsum(gone)) if not g))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(kept, pa.string())], ["k1", "k2", "runs", "collapsed"])


def shortened(texts: DataFrame, tile: int = TILE) -> DataFrame:
    """(k1, k2, runs, collapsed) of those ``keyed`` texts that have runs.

    ``runs``: (start, length, period) by start, then period. ``collapsed``: the words joined by one blank, without those that a run
    holds after its first period. Of the texts of one tile only those with runs are shuffled, of longer ones all (and merged at every
    size). A text's runs come together in one task as the text does.
    """
    by_start = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    turned = F.transform(by_start, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    found = stored(runs(texts, tile).groupBy(*KEY).agg(turned.alias("runs"), F.max("text").alias("text")), "runs")
    long = texts.filter(_tiled(tile)).hint("merge").join(found.filter("text is null").drop("text"), KEY)
    long = long.groupBy(*KEY).agg(F.first("runs").alias("runs"), F.first("text").alias("text"))
    held = found.filter("text is not null").unionByName(long)
    schema = f"k1 bigint, k2 bigint, runs {RUNS}, collapsed string"
    return stored(held.select(*KEY, "runs", split_words(F.col("text")).alias("words")).mapInArrow(_without_repeats, schema), "shortened")


def plain(text):
    """A text's words joined by one blank; a null text has none."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAPS, " "))


def collapsed(docs: DataFrame, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their ``runs`` and ``collapsed`` text, see ``shortened``.

    A null text, an empty one and one of white space alone have no runs and an empty collapsed text. Repeated rows each get
    what one would. Columns named runs or collapsed are replaced; others may have any name.
    """
    rows = without(docs, ["runs", "collapsed"]).select(F.struct("*").alias("row"), *keyed(id_col, text_col))
    return rows.join(shortened(rows.select(*KEY, "text"), tile), KEY, "left").select(
        "row.*", F.coalesce("runs", F.expr(f"cast(array() AS {RUNS})")).alias("runs"), F.coalesce("collapsed", plain(F.col("text"))).alias("collapsed")
    )


def digests(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per document: number of runs, the greatest (ties: least start, then period) and digests of runs and collapsed text.

    Digests are made where texts are, so what is joined is small. Nulls and repeated rows as in ``collapsed``.
    """
    rows = docs.select("doc_id", *keyed())
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    found = shortened(rows.select(*KEY, "text"), tile).select(
        *KEY, F.size("runs").cast("bigint").alias("n_runs"), top.alias("top"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
    own = rows.select("doc_id", *KEY, F.sha2(plain(F.col("text")), 256).alias("plain_sha256"))
    length, period = F.col("top.length"), -F.col("top.less")
    return own.join(found.hint("merge"), KEY, "left").select(
        "doc_id", F.coalesce("n_runs", F.lit(0)).cast("bigint").alias("n_runs"), (-F.col("top.before")).alias("start"), length.alias("length"),
        period.alias("period"), F.expr('1000 * top.length div -top.less').cast("bigint").alias("exponent_milli"),
        F.coalesce("runs_sha256", F.sha2(F.lit(""), 256)).alias("runs_sha256"),
        F.coalesce("collapsed_sha256", "plain_sha256").alias("collapsed_sha256"),
    )
