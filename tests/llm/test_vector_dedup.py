import numpy as np
import pytest

from shelfledger.llm import vector_dedup
from shelfledger.llm.common import ship_code

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """n_links of each row and the component of each id, by all pairs in double precision."""
    def sound(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, good = [0] * len(rows), [i for i, r in enumerate(rows) if sound(r)]
    units = {i: (x := np.array(np.float32(rows[i][1]), float)) / np.linalg.norm(x) for i in good}
    for k, i in enumerate(good):
        for j in good[:k]:
            if rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(rows[i][0]), find(rows[j][0])
                root[max(a, b)] = min(a, b)
    return sorted(((r[0], n, None if r[0] is None else find(r[0]), r[0] is None or find(r[0]) == r[0]) for r, n in zip(rows, links)), key=repr)


def near(rng, n, size, spread):
    """Vectors scattered round few centres, so that cosines lie on both sides of the threshold."""
    centres = rng.normal(size=(4, size))
    return [(c + rng.normal(size=size) * spread * rng.random()) * rng.choice([0.01, 1, 300]) for c in centres[rng.integers(0, 4, n)]]


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [0.0, -0.0, 0.0], 1), (9003, [1.0, None, 2.0], 1), (9004, [1.0, nan, 2.0], 1), (9005, [inf, 1.0, 0.0], 1), (9006, [], 1),
            (9007, [1.0, 2.0, 3.0], None), (9008, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0, 3.0], 1), (9009, [1.0, 2.0, 3.0], 1), (9010, [2.0, 4.0, 6.0], 1),
            (9009, [1.0, 2.0, 3.0], 1), (9011, [1.0, 2.0], 1), (9012, [0.0, 1.0, 0.0], 1), (9013, [-0.0, 1.0, 0.0], 1), (9014, [1e-30, 1e-30, 0.0], 1), (9015, [1e30, 1e30, 0.0], 1)]


@pytest.mark.parametrize("tile", [16, 1024])
def test_against_all_pairs(spark, tile):
    ship_code(spark)
    rng = np.random.default_rng(13)
    rows = [(i, v.astype(np.float32).tolist(), int(rng.integers(0, 3))) for i, v in enumerate(near(rng, 400, 24, 0.35))]
    rows += [(500 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(60)] + odd_rows()
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([rows[i] for i in order], SCHEMA).selectExpr("*", "1 AS point", "2 AS links", "3 AS hash")
    got = sorted((tuple(r) for r in vector_dedup.near_vectors(df, tile=tile).collect()), key=repr)
    want = brute(rows)
    assert got == want and 0.1 < np.mean([w[1] > 0 for w in want]) < 1


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for size in (1, 3, 64, 1500):
        u, v = (vector_dedup.unit(rng.normal(size=(50, size)) ** 3) for _ in range(2))
        (cu, su, eu), (cv, sv, ev) = vector_dedup.quantised(u), vector_dedup.quantised(v)
        whole = cu.astype(int) @ cv.astype(int).T
        assert (vector_dedup.products(cu, cv) == whole).all()
        wrong = np.abs(u @ v.T - whole * su[:, None] * sv)
        assert (wrong <= eu[:, None] * np.linalg.norm(sv[:, None] * cv, axis=1) + ev).all()


def test_forest_has_the_components_of_the_links():
    rng = np.random.default_rng(2)
    for _ in range(50):
        left, right = rng.integers(0, 40, (2, rng.integers(0, 40)))
        root = vector_dedup.forest(40, left, right)
        want = list(range(40))
        for _ in range(40):
            for a, b in zip(left, right):
                want[a] = want[b] = min(want[a], want[b])
        assert root.tolist() == want


def test_one_hot_group_makes_no_pairs(spark):
    """3,000 vectors that are all linked: rows out of the tile products grow with the points, not their pairs."""
    ship_code(spark)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=32)
    rows = [(i, (centre + rng.normal(size=32) * 0.01).tolist(), 1) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vector_dedup.near_vectors(df, tile=512)
    assert got.agg({"n_links": "min"}).first()[0] == 2999 and got.filter("component_id = 0").count() == 3000 and got.filter("kept").count() == 1


def test_strips_far_apart_are_not_paired(spark):
    """Points on a line of directions: most pairs of strips cannot hold a link and are left out, and none is lost."""
    ship_code(spark)
    angle = np.linspace(0, np.pi, 2000)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 1) for i, a in enumerate(angle)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vector_dedup.near_vectors(df, tile=64)
    want = [int(((np.abs(angle - a)) <= np.arccos(0.98)).sum()) - 1 for a in angle]
    assert sum(abs(r.n_links - want[r.vec_id]) for r in got.collect()) <= 4  # float32 components at the threshold
    points = spark.createDataFrame([(i, i, 1, 1, 2, v, float(v[0])) for i, v, _ in rows], "point long, id long, weight long, label int, size int, vector array<float>, at double")
    tiles = vector_dedup._tiles(points, 64)
    n = tiles.count()
    assert vector_dedup.tile_pairs(tiles, 0.98).count() < 0.4 * n * (n + 1) / 2


def test_empty_table(spark):
    assert vector_dedup.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
