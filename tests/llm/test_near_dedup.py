import random
import re
from pathlib import Path

import numpy as np
import pytest

from shelfledger.llm import near_dedup
from shelfledger.llm.components import components
from shelfledger.llm.near_dedup import Settings

WIDE = Settings(words=5, percent=80, rows=4, bands=28)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, s):
    sets = {i: shingles(t, s.words) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= s.percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("settings", [Settings(), WIDE])
def test_against_brute_force(spark, docs, settings):
    rng = random.Random(5)
    rows, at = [], 100
    for group in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 120, 160]))]
        for _ in range(25):
            rows.append((at, edited(rng, base, rng.choice([0, 0, 1, 2, 3, 4, 6]))))
            at += rng.randrange(1, 4)
    rows += [(1, "One two"), (2, "one TWO"), (3, ""), (4, None), (5, " \t\n"), (6, "one two three"), (7, "Ünï Ö x"), (8, "ünï ö x")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(docs(rows), settings).collect()}
    assert got == brute(rows, settings)


def test_odd_rows_and_columns(spark, docs):
    df = docs([(None, "a b c d"), (None, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "z")]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "component_id")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.classes(df).collect()), key=repr)
    assert got == [(2, 2, True), (2, 2, True), (3, 3, True), (None, None, True), (None, None, True)]
    kept = near_dedup.drop_near_copies(df, Settings())
    assert kept.columns == df.columns and kept.count() == 5
    assert near_dedup.classes(docs([])).collect() == []


def test_long_text(spark, docs):
    long = " ".join(f"t{i % 5000}" for i in range(600_000))
    got = {r.doc_id: r for r in near_dedup.classes(docs([(1, long), (2, long + " end"), (3, "x" * 3_000_000)])).collect()}
    assert got[1].n_shingles == 5000 and got[2].component_id == 1 and got[3].n_shingles == 1


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = np.concatenate([np.sort(pool[:2000]), np.sort(pool[500:2500])])
    sig = near_dedup.minima(sets, np.array([2000, 2000]), Settings())
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.15


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(1001, 1300)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)] + [(5, 5)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{j: 1000 for j in range(1000, 1300)}, **{2000 + i: 2000 for i in range(50)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components_of_stars_take_one_pass(spark):
    """Few jobs: each leaves plans, code and threads in the driver."""
    links = spark.createDataFrame([(100 * (j % 3), 100 * (j % 3) + j + 1) for j in range(60)] + [(0, 1), (1, 0)], "u long, v long")
    spark.sparkContext.setJobGroup("stars", "components of stars")
    try:
        found = components(links)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("stars"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert {(r.node, r.component) for r in found.collect()} == {(100 * (j % 3) + k, 100 * (j % 3)) for j in range(60) for k in (0, j + 1)}
    assert jobs <= 4


def test_small_tables_have_few_files(spark, docs):
    """Not a file for each shuffle partition, each of which costs a task to write and others to read."""
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    old = {p.name for p in scratch.iterdir()}
    own = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    rows = [(i, f"{text} end" * (i % 2)) for i, text in mosaics(4, 20)] + [(100 + i, text) for i, text in mosaics(4, 20)]
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(docs(rows)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len([*p.glob("part-*")]) for p in scratch.iterdir() if p.name not in old}
    assert got == brute(rows, Settings())
    assert len(files) > 8 and max(files.values()) <= 2 * spark.sparkContext.defaultParallelism  # a union has the files of both its sides


def mosaics(seed, n, pool=40, parts=8, order=sorted):
    """Documents put together from passages of one pool: many share bands, few are alike."""
    rng = random.Random(seed)
    passages = [" ".join(f"m{rng.randrange(10**6)}" for _ in range(20)) for _ in range(pool)]
    return [(i, " ".join(order(rng.sample(passages, parts)))) for i in range(n)]


def late_pairs(monkeypatch, df):
    """The number of pairs that the second step makes."""
    counts, made = [], near_dedup._open_pairs
    monkeypatch.setattr(near_dedup, "_open_pairs", lambda *a: counts.append((pairs := near_dedup.stored(made(*a), "late")).count()) or pairs)
    near_dedup.classes(df).collect()
    monkeypatch.setattr(near_dedup, "_open_pairs", made)
    return counts[0]


def test_mosaics_make_few_pairs(spark, docs, monkeypatch):
    """Four times the documents make no more than about four times the pairs; where the passages' order makes rare
    shingles, a document has at most RARE pairs for each of its 14."""
    few, many = (late_pairs(monkeypatch, docs(mosaics(1, n))) for n in (400, 1600))
    assert many <= 5 * max(few, 100)
    monkeypatch.setattr(near_dedup, "RARE", 4)
    assert late_pairs(monkeypatch, docs(mosaics(1, 1200, order=list))) <= 4 * 14 / 2 * 1200


@pytest.mark.parametrize("tile", [16, 1024])
def test_mosaics_against_brute_force(spark, docs, monkeypatch, tile):
    """With mosaics alike in part and in whole, in buckets of one tile and of several."""
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rng = random.Random(8)
    rows = mosaics(2, 220, pool=14, parts=9)
    rows += [(1000 + k, edited(rng, text.split(), rng.randrange(4))) for k, (_, text) in enumerate(rows[:60])]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(docs(rows)).collect()}
    assert got == brute(rows, Settings())
