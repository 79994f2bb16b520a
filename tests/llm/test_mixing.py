import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfledger.llm import mixing


def wanted(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        shared = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / shared for s in order}
        new = {s for s in order if target[s] > 3 * sizes[s] + 1e-9} - full
        if not new:
            return target
        full |= new


def corpus(seed, n=400, sources=("a", "b", "C", "é", None, "tiny")):
    rng = random.Random(seed)
    return [
        (i, " x \t" * rng.choice([0, 1, 5, 30, 200]) + "end", None, "tiny" if i % 97 == 0 else rng.choice(sources[:5] + ("a",) * 4))
        for i in range(n)
    ]


def test_targets_and_taken_words(docs):
    rows = corpus(1)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    target = wanted(sizes)
    mixed = mixing.mix(docs(rows))
    got = mixing.taken(mixed).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    words = Counter()
    for r in got:
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
        words[source[r.doc_id]] += r.taken
    assert any(target[s] == 3 * sizes[s] for s in sizes)
    for s in sizes:
        assert abs(words[s] - target[s]) <= 0.03 * target[s] + 5
    again = {(r.doc_id, r.taken) for r in mixing.taken(mixing.mix(docs(rows).repartition(7))).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_shards_are_disjoint_and_even(docs):
    mixed = mixing.mix(docs(corpus(2)), shard_words=500)
    draws = mixed.rows.select("source", "hash", "pass", "shard").collect()
    assert len({(r.source, r.hash, r["pass"]) for r in draws}) == len(draws)
    assert len({r.shard for r in draws}) > 8


def test_rows_are_repeated_as_taken(docs):
    rows = corpus(3, 120) + [(900, "twice the same", None, "a")] * 2 + [(None, "no id", None, None), (901, None, None, "b"), (902, "", None, "b")]
    df = docs(rows).withColumnRenamed("n_chars", "size")
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    taken = mixing.taken(mixing.mix(df)).groupBy("doc_id", "size").agg(F.sum("taken").alias("taken")).collect()
    for r in taken:
        if r["size"]:
            assert times[r.doc_id] == r.taken // r["size"]
    assert times[900] % 2 == 0


def test_empty_table_and_wordless_sources(docs):
    assert mixing.taken(mixing.mix(docs([]))).collect() == []
    got = mixing.taken(mixing.mix(docs([(1, "", None, "a"), (2, None, None, "b")]))).collect()
    assert {(r.doc_id, r["size"], r.target, r.taken) for r in got} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_tree_draws_are_hypergeometric(spark):
    """Means and variances of a root's split over many seeds, and exact sums at the leaves."""
    quotas = [6, 30, 14]
    left = []
    for seed in range(12):
        leaves = mixing.quota_tree(spark.createDataFrame([(quotas,)], "quotas array<bigint>"), 3, seed).collect()
        assert [sum(r.quotas[k] for r in leaves) for k in range(3)] == quotas
        assert {r.shard for r in leaves} == set(range(8))
        assert max(sum(r.quotas) for r in leaves) - min(sum(r.quotas) for r in leaves) <= 1
        left.append(sum(r.quotas[1] for r in leaves if r.shard < 4))
    spread = math.sqrt(25 * (30 / 50) * (20 / 50) * (25 / 49))
    assert abs(sum(left) / len(left) - 15) < 4 * spread / math.sqrt(len(left))
    assert len(set(left)) > 2


def test_hypergeometric_inversion_matches_exact_masses(spark):
    """The drawn number follows the uniform's place in the exact distribution."""
    pool, q, n = 40, 13, 20
    mass = [math.comb(q, k) * math.comb(pool - q, n - k) / math.comb(pool, n) for k in range(q + 1)]
    nodes = spark.range(400).select(F.col("id").alias("node"), F.array(F.lit(q), F.lit(pool - q)).cast("array<bigint>").alias("quotas"), F.lit(n).cast("bigint").alias("half"))
    got = nodes.select(
        F.expr(mixing._drawn(1)).alias("d"), F.expr("cast(shiftrightunsigned(xxhash64(1, node, 0), 11) AS double) / 9007199254740992D").alias("u")
    ).collect()
    for r in got:
        k, total = 0, mass[0]
        while total < r.u - 1e-9:
            k += 1
            total += mass[k]
        assert r.d[0] == k and sum(r.d) == n


def test_main_path_runs_no_python(docs):
    plan = mixing.taken(mixing.mix(docs(corpus(1, 50))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
