"""Near-duplicate classes: minima of universal hashes, banding, signature and exact verification,
connected components.

Rows of equal shingle sets are first reduced to one representative by an aggregation, so copies,
however many, never meet in pairs. Representatives that share a band are then linked in two steps:

1. Every member of a bucket is paired with the bucket's smallest and largest member. Pairs pass the
   signature estimate, then the exact comparison of whole sets. Components of these links follow.
2. In buckets that still hold several components, members outside the bucket's largest component are held
   against members of other components, unless their rare shingles already part them. This is done in tiles of
   TILE members: a task compares the signatures of two tiles as matrices, and only pairs alike enough leave it. So
   documents that share passages but are not alike, however many meet in a bucket, make no pairs. With that, every pair of a
   bucket is linked, known to be too far apart, or in one component already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import counted, released, small, stored, tasks_for
from shelfledger.llm.components import components
from shelfledger.llm.words import mix, row_sets



RARE = 16  # documents with a shingle, at most, for it to be rare
TILE = 1024  # members of a bucket that meet others in one task
ROWS = 8192  # documents whose signatures, members or pairs one task writes


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity. A pair at it is missed with probability (1 - s**rows)**bands:
    2.4e-7 at 85 % with 26 bands of 5, 4e-7 at 80 % with 28 bands of 4. The signature estimate
    drops a pair only five standard deviations below the limit."""

    words: int = 3
    percent: int = 85
    rows: int = 5
    bands: int = 26

    @property
    def hashes(self) -> int:
        return self.rows * self.bands

    @property
    def least_estimate(self) -> float:
        s = self.percent / 100
        return s - 5 * sqrt(s * (1 - s) / self.hashes)


def minima(sets: np.ndarray, sizes: np.ndarray, s: Settings) -> np.ndarray:
    """Smallest value of each universal hash (multiply, add, keep the top 32 bits) over each set;
    one row for each set that isn't empty."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 63, s.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, s.hashes, dtype=np.uint64)
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), s.hashes), np.uint32)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + 65536)))
        part = sets[starts[i] : starts[j - 1] + sizes[j - 1]]
        at = starts[i:j] - starts[i]
        for h in range(s.hashes):
            out[i:j, h] = np.minimum.reduceat((part * a[h] + b[h]) >> np.uint64(32), at)
        i = j
    return out


def _features(s: Settings):
    schema = "id bigint, n_shingles bigint, set_key binary, signature binary, bands array<bigint>"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, s.bands + 1, dtype=np.uint64))
        for batch in batches:
            ids = batch.column(0)
            for i, j, sets, sizes in row_sets(batch.column(1), s.words):
                sig = minima(sets, sizes, s)
                keys = np.repeat(salt[None, :], len(sig), 0)
                for r in range(s.rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, r :: s.rows].astype(np.uint64))
                ends = np.cumsum(sizes)
                short = (sig & np.uint32(0xFFFF)).astype(np.uint16)
                full = sizes > 0
                row = np.cumsum(full) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(sizes.astype(np.int64)),
                        pa.array([
                            xxhash.xxh3_128_digest(sets[e - n : e].tobytes()) if n else None for e, n in zip(ends, sizes)
                        ], pa.binary()),
                        pa.array([short[r].tobytes() if f else None for r, f in zip(row, full)], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(full * s.bands)]).astype(np.int32)),
                            pa.array(keys.astype(np.int64).ravel()),
                        ),
                    ],
                    ["id", "n_shingles", "set_key", "signature", "bands"],
                )

    return run, schema


def _sets(s: Settings):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, sets, sizes in row_sets(batch.column(1), s.words):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(sets.astype(np.int64))
                        ),
                    ],
                    ["id", "shingles"],
                )

    return run, "id bigint, shingles array<bigint>"


def _alike(s: Settings):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, s.hashes) for k in ("sa", "sb")
            )
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= s.least_estimate))

    return run, "a bigint, b bigint"


def _linked(reps: DataFrame, sets: DataFrame, pairs: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """Those pairs (a, b) whose signatures and then whole sets are alike."""
    sig = reps.select("id", "n", "signature")
    both = (
        pairs.join(sig.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa")), "a")
        .join(sig.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb")), "b")
        .filter(100 * F.least("na", "nb") >= s.percent * F.greatest("na", "nb"))
        .select("a", "b", "sa", "sb")
    )
    likely = stored(both.coalesce(tasks).mapInArrow(*_alike(s)), "likely")
    common = F.size(F.array_intersect("xa", "xb"))
    return (
        likely.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a")
        .filter(100 * common >= s.percent * (F.size("xa") + F.size("xb") - common))
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _open_pairs(buckets: DataFrame, found: DataFrame, reps: DataFrame, sets: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """Pairs (a, b) in different components that share a bucket and can be alike.

    A shingle that at most RARE open documents have is rare. Two documents have in common at most their
    other shingles and the rare ones they share. So a pair of which one has many rare shingles must share
    one: these pairs come from the rare shingles, RARE for each document and shingle at most. Pairs that
    can be alike without one are found by their signatures in the tiles of a bucket, where documents too rich in rare
    shingles for all others are left out first and members of the largest component only wait for partners.
    """
    known = buckets.join(found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "bucket", "band", "id", "n", F.coalesce("component", "id").alias("component")
    )
    mixed = known.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.min("n").alias("least")
    ).filter("x < y").select("bucket", "least")
    rows, n = counted(known.join(mixed, "bucket"), "open", tasks)
    if not n:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"))
    ids, n = counted(rows.groupBy("id").agg(F.first("n").alias("n"), F.first("component").alias("component")), "ids", tasks)
    spread = sets.join(small(ids, n), "id").select("id", "n", "component", F.explode("shingles").alias("shingle"))
    scarce = stored(spread.groupBy("shingle").agg(F.count("*").alias("k")).filter(F.col("k") <= RARE), "scarce", tasks)
    rare = stored(spread.join(scarce, "shingle"), "rare", tasks)
    usual = small(stored(
        rare.groupBy("id").agg(F.count("*").alias("rare")).join(small(ids, n), "id", "right")
        .select("id", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("usual")),
        "usual", tasks,
    ), n)
    at_most = 100 + s.percent
    rich = (100 * F.col("usual") < s.percent * F.col("n")) | (at_most * F.col("usual") < s.percent * (F.col("n") + F.col("least")))
    poor = stored(rows.join(usual, "id").filter(~rich), "poor", tasks)

    mine = rare.filter("k > 1")
    theirs = mine.select("shingle", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"))
    met = (
        mine.join(theirs, "shingle").filter("x < id and component <> cx")
        .groupBy("x", "id", "nx", "n").agg(F.count("*").alias("shared"))
        .join(usual, "id").join(usual.select(F.col("id").alias("x"), F.col("usual").alias("ux")), "x")
    )
    share = F.least("usual", "ux") + F.col("shared")
    both = F.col("n") + F.col("nx")
    by_rare = met.filter((at_most * share >= s.percent * both) & (at_most * F.least("usual", "ux") < s.percent * both))

    few = poor.select("bucket", "band", "id", "n", "component", "usual").join(reps.select("id", "signature"), "id")
    by_bucket = _tile_pairs(few).mapInArrow(*_alike_in_tiles(s))
    pair = [F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")]
    return by_rare.select(*pair).union(by_bucket).distinct()


def _tile_pairs(few: DataFrame) -> DataFrame:
    """(first, second, same, band): members of two tiles of a bucket; second is null for a tile with itself.

    A bucket of one tile is that tile. In larger ones the largest component has tiles of its own, which meet the tiles
    of other members only. Buckets of one component are left out.
    """
    sizes = few.groupBy("bucket", "band", "component").agg(F.count("*").alias("k"))
    plan = sizes.groupBy("bucket", "band").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("all"), F.count("*").alias("parts")).filter("parts > 1")
    single = F.col("all") <= TILE
    plan = plan.drop("band").select(
        "bucket", F.col("top.component").alias("largest"), single.alias("single"),
        F.when(single, 1).otherwise(F.ceil((F.col("all") - F.col("top.k")) / TILE)).cast("int").alias("minor"),
        F.when(single, 0).otherwise(F.ceil(F.col("top.k") / TILE)).cast("int").alias("major"),
    )
    share = lambda n: F.pmod(F.xxhash64("id"), F.greatest(n, F.lit(1))).cast("int")
    tile = F.when(F.col("single") | (F.col("component") != F.col("largest")), share(F.col("minor"))).otherwise(F.col("minor") + share(F.col("major")))
    tiles = few.join(plan, "bucket").withColumn("tile", tile).groupBy("bucket", "band", "tile", "minor", "major").agg(
        F.collect_list(F.struct("id", "n", "component", "usual", "signature")).alias("members")
    )
    met = F.when(F.col("tile") < F.col("minor"), F.col("minor") + F.col("major")).otherwise(F.col("minor"))
    sent = tiles.select("bucket", "band", "tile", "members", F.explode(F.sequence(F.lit(0), met - 1)).alias("other"))
    pairs = sent.groupBy("bucket", "band", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")).agg(
        F.sort_array(F.collect_list(F.struct("tile", "members"))).alias("both")
    )
    return pairs.select(F.col("both")[0]["members"].alias("first"), F.get("both", F.lit(1))["members"].alias("second"), (F.col("i") == F.col("j")).alias("same"), "band")


def _alike_in_tiles(s: Settings):
    """Pairs of two tiles whose signatures are alike, each in the bucket of the first band that the two share."""
    def tile(column: pa.Array, row: int):
        members = column[row].values
        ids, n, component, usual = (members.field(k).to_numpy() for k in range(4))
        return ids, n, component, usual, np.frombuffer(b"".join(members.field(4).to_pylist()), np.uint16).reshape(len(ids), -1)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = int(np.ceil(s.least_estimate * s.hashes))
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                if not (batch.column(1)[row].is_valid or batch.column(2)[row].as_py()):
                    continue  # the other tile has no members
                band = batch.column(3)[row].as_py()
                ids, n, component, usual, sig = tile(batch.column(0), row)
                ids2, n2, component2, usual2, sig2 = tile(batch.column(1), row) if batch.column(1)[row].is_valid else (ids, n, component, usual, sig)
                for i in range(0, len(ids), 32):
                    part = slice(i, i + 32)
                    may = component[part, None] != component2
                    may &= 100 * np.minimum(n[part, None], n2) >= s.percent * np.maximum(n[part, None], n2)
                    may &= (100 + s.percent) * np.minimum(usual[part, None], usual2) >= s.percent * (n[part, None] + n2)
                    x, y = may.nonzero()
                    for k in range(0, len(x), 1 << 15):
                        p, q = x[k : k + (1 << 15)] + i, y[k : k + (1 << 15)]
                        equal = sig[p] == sig2[q]
                        alike = equal.sum(axis=1) >= least
                        alike[alike] = equal[alike].reshape(-1, s.bands, s.rows).all(axis=2).argmax(axis=1) == band
                        out.append(np.stack([np.minimum(ids[p[alike]], ids2[q[alike]]), np.maximum(ids[p[alike]], ids2[q[alike]])]))
            if out:
                pair = np.unique(np.concatenate(out, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    return run, "a bigint, b bigint"


def classes(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Null or wordless text has an empty set, is linked with nothing and is its own component. Rows
    repeating an id share its class and fate. A row with a null id has a null component and is kept.
    """
    s = settings
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    every, n = counted(docs.mapInArrow(*_features(s)), "features")
    tasks = tasks_for(docs.sparkSession, n, ROWS)
    reps = stored(
        every.filter("id is not null and n_shingles > 0").groupBy("set_key").agg(
            F.min("id").alias("id"), F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        ),
        "representatives", tasks,
    )
    members = reps.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = (
        members.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    )
    buckets = stored(members.join(shared, "bucket"), "buckets", tasks)
    ids, n = counted(buckets.select("id").distinct(), "ids", tasks)
    sets = stored(docs.join(small(ids, n), "id", "left_semi").select("id", "text").mapInArrow(*_sets(s)), "sets")
    pairs = stored(
        buckets.select(F.explode(F.array(
            F.struct(F.col("lo").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("hi").alias("b")),
        )).alias("p")).select("p.a", "p.b").filter("a < b").distinct(),
        "pairs", tasks,
    )
    links = stored(_linked(reps, sets, pairs, s, tasks), "links", tasks)
    found = components(links)
    more, n = counted(_open_pairs(buckets, found, reps, sets, s, tasks).join(pairs, ["a", "b"], "left_anti"), "pairs", tasks)
    if n:
        late, n = counted(_linked(reps, sets, more, s, tasks), "links", tasks)
        if n:
            found = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(late))

    named = reps.select("set_key", F.col("id").alias("node")).join(found, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component_id")
    )
    joined = every.select("id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one id of each class. Columns as they were."""
    gone, n = counted(classes(docs, settings, id_col, text_col).filter("not kept").select(id_col).distinct(), "gone")
    return docs.join(small(gone, n), id_col, "left_anti").select(*docs.columns)


