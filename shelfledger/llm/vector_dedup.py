"""Near-duplicate vectors of a label: products of int8 tiles, bounded errors, full precision where they don't decide.

Equal vectors of a label are first reduced to one point with a weight by an aggregation. Points are dealt to tiles of about
``tile`` points. Each pair of tiles of a label is one row, so no task grows with a label, however hot.

A unit vector u is written as u = s c + r with whole numbers c from -127 to 127, s = max|u| / 127 and e = |r|, which is kept
with the codes. For two vectors |u v - s c * s' c'| <= e |s' c'| + e' (as |u| = 1), so the product of the codes, exact in
whole numbers, parts all pairs but those possibly at the threshold; these alone are computed again in double precision from the
vectors. Nothing is estimated: the links are those of comparing all pairs.

Tiles are strips of a projection on one direction, the same for all labels. Unit vectors with cosine >= t are at most
sqrt(2 - 2 t) apart, and so are their projections; pairs of strips further apart are never made. The direction is the first principal one
of ``SAMPLE`` points; it only decides which pairs are left out, never a link.

Of a pair of tiles come the number of links of each point and a forest that connects the same points as the links,
so as many rows as points, though all of them be linked. Components follow by large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.llm.common import released, stored
from shelfledger.llm.components import components

COSINE = 0.98
TILE = 1024  # points of a tile, or fewer, so that it has about NUMBERS components at most
NUMBERS = 1 << 20
STRIPS = 32
SAMPLE = 4096  # points, or fewer, of NUMBERS components at most
ROUNDING = 1e-9  # far above what double and single precision lose in the bounds
_WIDTH = 1024  # whole products of so many codes are exact in single precision
_PAIRS = 1 << 15


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and error bound of unit vectors."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(units - scale[:, None] * codes, axis=1) + ROUNDING


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole products of all rows of two matrices of codes."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], _WIDTH):
        out += a[:, k : k + _WIDTH].astype(np.float32) @ b[:, k : k + _WIDTH].astype(np.float32).T
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1, by their greatest component first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def linked(x: np.ndarray, y: np.ndarray | None, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``x``, row of ``y``) with at least this cosine; of ``x`` with itself, each pair once."""
    u = unit(x)
    v = u if y is None else unit(y)
    cu, su, eu = quantised(u)
    cv, sv, ev = (cu, su, eu) if y is None else quantised(v)
    norm = sv * np.linalg.norm(cv.astype(float), axis=1)
    for i in range(0, len(u), 256):
        part = slice(i, min(i + 256, len(u)))
        most = products(cu[part], cv) * su[part, None] * sv + eu[part, None] * norm + ev + ROUNDING
        possible = most >= cosine
        if y is None:
            possible &= np.arange(len(v)) > np.arange(part.start, part.stop)[:, None]
        left, right = possible.nonzero()
        for k in range(0, len(left), _PAIRS):
            p, q = left[k : k + _PAIRS] + i, right[k : k + _PAIRS]
            sure = np.einsum("ij,ij->i", u[p], v[q]) >= cosine
            yield p[sure], q[sure]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches by the given links."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        low = np.minimum(a, b)
        if (a == b).all():
            return root
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root[root] != root).any():
            root = root[root]


def _placed(direction: np.ndarray):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("vector"))
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.zeros(batch.num_rows)
            fits = np.flatnonzero(sizes == len(direction))
            if len(fits):
                flat = lists.flatten().to_numpy().astype(float)
                begin = np.cumsum(sizes) - sizes
                at[fits] = unit(flat[begin[fits][:, None] + np.arange(len(direction))]) @ direction
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "at"])

    return run


def _tile(column: pa.Array, row: int) -> list[np.ndarray]:
    """Points, ids, weights and vectors of a tile."""
    points = column[row].values
    flat = points.field(3).flatten().to_numpy().astype(float)
    return [*(points.field(k).to_numpy() for k in range(3)), flat.reshape(len(points), -1)]


def _compared(cosine: float):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                points, ids, weights, x = _tile(batch.column(0), row)
                y, shift = None, 0
                if batch.column(1)[row].is_valid:
                    *more, y = _tile(batch.column(1), row)
                    shift = len(x)
                    points, ids, weights = (np.concatenate(v) for v in zip((points, ids, weights), more))
                links, every = np.zeros(len(ids), np.int64), np.arange(len(ids))
                root = every
                for p, q in linked(x, y, cosine):
                    q = q + shift
                    np.add.at(links, p, weights[q])
                    np.add.at(links, q, weights[p])
                    root = forest(len(ids), np.concatenate([p, every]), np.concatenate([q, root]))
                has = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points[has]), pa.array(links[has]), pa.array(ids[has]), pa.array(ids[root[has]])], ["point", "links", "u", "v"]
                )

    return run


def _direction(points: DataFrame) -> np.ndarray:
    """The first principal direction of at most ``SAMPLE`` points that are as long as most of them."""
    longest = points.agg(F.max("size")).first()[0]
    if longest is None:
        return np.ones(1)
    some = [np.array(r[0], float) for r in points.select("vector").limit(max(16, min(SAMPLE, NUMBERS // longest))).collect()]
    sizes = np.bincount([len(v) for v in some])
    rows = unit(np.stack([v for v in some if len(v) == sizes.argmax()]))
    return np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)[2][0] if len(rows) > 1 else rows[0]


def _tiles(points: DataFrame, tile: int) -> DataFrame:
    """Points (point, id, weight, label, size, vector, at) by tile: (label, size, strip, part, points), and of each strip its
    number of parts and the ends of its projections."""
    held = F.greatest(F.lit(16), F.least(F.lit(tile), F.floor(F.lit(NUMBERS) / F.col("size"))))
    kinds = points.groupBy("label", "size").agg(
        F.least(F.ceil(F.count("*") / held), F.lit(STRIPS)).cast("int").alias("strips"),
        F.percentile_approx("at", [k / STRIPS for k in range(1, STRIPS)], 1000).alias("cuts"),
    )
    strip = (F.size(F.filter("cuts", lambda c: c < F.col("at"))) * F.col("strips") / STRIPS).cast("int")
    placed = points.join(kinds, ["label", "size"]).withColumn("strip", strip)
    ends = placed.groupBy("label", "size", "strip").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.ceil(F.count("*") / held).cast("int").alias("parts")
    )
    placed = placed.join(ends, ["label", "size", "strip"]).withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int"))
    return stored(placed.groupBy("label", "size", "strip", "part").agg(
        F.first("low").alias("low"), F.first("high").alias("high"), F.first("parts").alias("parts"),
        F.collect_list(F.struct("point", "id", "weight", "vector")).alias("points"),
    ), "tiles")


def tile_pairs(tiles: DataFrame, cosine: float) -> DataFrame:
    """(first, second): the points of each pair of tiles of a label that may hold a link; second is null for a tile with itself.

    A tile is told the strips of its label, ``STRIPS`` at most, and sent once for each tile it is to meet.
    """
    reach = sqrt(max(0.0, 2 - 2 * cosine)) + ROUNDING
    strips = tiles.select("label", "size", "strip", "low", "high", "parts").distinct()
    others = strips.groupBy("label", "size").agg(F.collect_list(F.struct("strip", "low", "high", "parts")).alias("strips"))
    near = F.filter("strips", lambda s: (s["low"] - F.col("high") <= reach) & (F.col("low") - s["high"] <= reach))
    met = F.flatten(F.transform(near, lambda s: F.transform(
        F.sequence(F.lit(0), s["parts"] - 1), lambda k: F.struct(s["strip"].alias("strip"), k.alias("part")))))
    own = F.struct("strip", "part")
    sent = tiles.join(others, ["label", "size"]).select("label", "size", own.alias("own"), "points", F.explode(met).alias("other")).select(
        "label", "size", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), F.struct("own", "points").alias("tile")
    )
    pair = F.sort_array(F.collect_list("tile"))
    return sent.groupBy("label", "size", "a", "b").agg(pair.alias("pair")).select(
        F.col("pair")[0]["points"].alias("first"), F.get("pair", F.lit(1))["points"].alias("second")
    )


def near_vectors(rows: DataFrame, cosine: float = COSINE, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``rows``: id, n_links, component_id, kept.

    Vectors of one label and length are linked if their cosine, in double precision, is at least ``cosine``. A row without label or id, and
    a vector that is null, empty, zero or holds a null, a NaN or an infinity is linked with nothing: n_links 0, its own component.
    Equal vectors are linked like any others. Rows repeating an id count as vectors of their own in n_links and share a
    component. A row with a null id has a null component and is kept. Columns besides the three may have any name.
    """
    kind = "float" if dict(rows.dtypes)[vector_col] == "array<float>" else "double"
    vector = F.col(vector_col).cast(f"array<{kind}>")
    sound = (
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    )
    zero = F.lit(0).cast(kind)
    every = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.when(sound, vector).alias("vector")).select(
        "id", "label", F.transform("vector", lambda v: F.when(v == 0, zero).otherwise(v)).alias("vector"), F.xxhash64("vector").alias("hash"),
    )
    same = ["hash", "label", "vector"]
    equal = every.filter("vector is not null").groupBy(*same).agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    equal = stored(equal.withColumn("point", F.monotonically_increasing_id()), "equal")
    points = equal.select("point", F.col("least").alias("id"), "weight", "label", F.size("vector").alias("size"), "vector")
    schema = T.StructType([*points.schema.fields, T.StructField("at", T.DoubleType())])
    tiles = _tiles(stored(points.mapInArrow(_placed(_direction(points)), schema), "points"), tile)
    met = stored(tile_pairs(tiles, cosine).mapInArrow(_compared(cosine), "point bigint, links bigint, u bigint, v bigint"), "links")
    links = met.groupBy("point").agg(F.sum("links").alias("links"))
    of = equal.join(links, "point", "left").select(*same, "least", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    counted = stored(every.join(of, same, "left").select("id", "least", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links")), "counted")
    edges = met.select("u", "v").union(counted.filter("least < id").select(F.col("id").alias("u"), F.col("least").alias("v")))
    found = components(edges).withColumnRenamed("node", "id")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return counted.join(found, "id", "left").select(
        F.col("id").alias(id_col), "n_links", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )
