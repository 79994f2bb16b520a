"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt by hash into blocks. A source's target, in words, is met by whole
passes over its blocks plus a part of one more: blocks in permuted order as long as they fit, and of one
block more the documents that fit. The block draws of all sources are then dealt to output shards of equal
numbers of draws: from the root down, each node hands its left half a hypergeometric number of every
source's draws, so the leaves hold exact quotas with the distribution of a random deal. Each leaf takes
the next range of every source's draws, so shards are disjoint, and orders its rows by hash.

DataFrame functions only; the draw tree is array functions over one row per node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import small, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = 3  # sources weigh 1, 2, 3, repeating
MOST_REPEATS = 3
MOST_BLOCKS = 1024  # of a source; a block of a larger source just holds more documents
ROUNDS = 5  # of filling what is left with what still fits


@dataclass(frozen=True)
class Mix:
    """``sources``: source, source_size, target and the like, one row per source. ``units``: equal rows
    of the input once, with their number ``n``. ``rows``: a row per unit and time it is taken, with its
    shard and its place there. All are stored tables."""

    sources: DataFrame
    units: DataFrame
    rows: DataFrame


def targets(units: DataFrame) -> DataFrame:
    """(place, source, docs, source_size, target): the share of all words each source is to have.

    Sources stand in code-point order, null last. They share all words by weight; a target stops at
    three times its source, and the excess goes to the others by weight until none is above. Sources
    are ordered in one task, so their number is a dimension's, not that of documents.
    """
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    one = per.agg(
        F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "words", "docs"))).alias("s"),
        F.coalesce(F.sum("words"), F.lit(0)).cast("double").alias("total"),
    )
    weighed = one.select("total", F.expr(
        f"transform(s, (x, i) -> struct({MOST_REPEATS} * x.words / (i % {WEIGHTS} + 1) AS full_at, i AS place,"
        f" i % {WEIGHTS} + 1 AS weight, x.source AS source, x.words AS words, x.docs AS docs))"
    ).alias("s"))
    left = weighed.withColumn("left", F.expr(
        f"""aggregate(array_sort(s, (a, b) -> CASE WHEN a.full_at < b.full_at THEN -1 WHEN a.full_at > b.full_at THEN 1 ELSE a.place - b.place END),
            struct(total AS words, cast(aggregate(s, 0L, (a, x) -> a + x.weight) AS bigint) AS weight),
            (a, x) -> IF(x.full_at * a.weight <= a.words,
                struct(a.words - {MOST_REPEATS} * x.words AS words, a.weight - cast(x.weight AS bigint) AS weight), a))"""
    ))
    return left.select("left", F.explode("s").alias("x")).select(
        "x.place", "x.source", "x.docs", F.col("x.words").alias("source_size"),
        F.expr(
            f"""cast(CASE WHEN left.weight > 0 THEN least({MOST_REPEATS} * x.words, x.weight * left.words / left.weight)
                ELSE {MOST_REPEATS} * x.words END AS double)"""
        ).alias("target"),
        F.least(F.lit(MOST_BLOCKS), "x.docs").cast("bigint").alias("blocks"),
    )


def _log_factorial(x: str) -> str:
    """ln(x!): exact below 20, above by Stirling's series, to 1e-12 and better."""
    return (
        f"CASE WHEN {x} < 20 THEN ln(factorial(cast(greatest({x}, 0) AS int))) ELSE {x} * ln({x}) - {x} + 0.5D * ln(6.283185307179586D * {x})"
        f" + 1D / (12D * {x}) - 1D / (360D * {x} * {x} * {x}) END"
    )


def _drawn(seed: int) -> str:
    """SQL for the left half's draws of each source of a node (``node``, ``quotas``, ``half``).

    The sources' numbers are drawn one after the other, each by inverting the hypergeometric
    distribution of what is left; values beyond 12 standard deviations are below double precision.
    """
    f = _log_factorial
    mass = "exp(a.base - ({}) - ({}) - ({}) - ({}))".format(
        f("k"), f("(a.q - k)"), f("(a.n - k)"), f("(a.pool - a.q - a.n + k)")
    )
    base = " + ".join(f"({f(x)})" for x in ("b.q", "(b.pool - b.q)", "b.n", "(b.pool - b.n)")) + f" - ({f('b.pool')})"
    spread = "(12 * sqrt(b.n * (b.q / p) * (1 - b.q / p) * (b.pool - b.n) / greatest(p - 1, 1)) + 2)".replace("p)", "greatest(b.pool, 1))").replace("(p -", "(b.pool -")
    mean = "(b.n * (b.q / greatest(b.pool, 1)))"
    low = f"cast(greatest(0, b.n - (b.pool - b.q), floor({mean} - {spread})) AS bigint)"
    high = f"cast(least(b.q, b.n, ceil({mean} + {spread})) AS bigint)"
    pick = f"""aggregate(sequence(a.low, a.high), struct(0D AS c, cast(NULL AS bigint) AS k),
        (c, k) -> struct(c.c + {mass} AS c, coalesce(c.k, IF(c.c + {mass} >= a.u, k, NULL)) AS k), c -> coalesce(c.k, a.high))"""
    number = f"""element_at(transform(transform(array(b), b -> struct(b.q AS q, b.n AS n, b.pool AS pool, b.u AS u, {low} AS low, {high} AS high, {base} AS base)),
        a -> {pick}), 1)"""
    take = f"element_at(transform(array(struct(x AS q, s.n AS n, s.pool AS pool, s.u AS u)), b -> {number}), 1)"
    uniform = f"cast(shiftrightunsigned(xxhash64({seed}, node, s.i), 11) AS double) / 9007199254740992D"
    step = f"""element_at(transform(transform(array(struct(s.pool AS pool, s.n AS n, s.i AS i, s.out AS out, {uniform} AS u)), s -> struct(s AS s, {take} AS t)),
        r -> struct(r.s.pool - x AS pool, r.s.n - r.t AS n, r.s.i + 1 AS i, array_append(r.s.out, r.t) AS out)), 1)"""
    return f"""aggregate(quotas, struct(aggregate(quotas, 0L, (t, x) -> t + x) AS pool, half AS n, 0 AS i, cast(array() AS array<bigint>) AS out),
        (s, x) -> {step}, s -> s.out)"""


def quota_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, quotas) for 2**levels shards out of one row with the root's ``quotas``."""
    nodes = quotas.select(F.lit(1).cast("bigint").alias("node"), "quotas")
    for _ in range(levels):
        nodes = nodes.withColumn("half", F.expr("aggregate(quotas, 0L, (t, x) -> t + x) div 2"))
        nodes = nodes.withColumn("first", F.expr(_drawn(seed)))
        nodes = nodes.select(F.explode(F.expr(
            """array(struct(2 * node AS node, first AS quotas),
                struct(2 * node + 1 AS node, zip_with(quotas, first, (q, f) -> q - f) AS quotas))"""
        )).alias("c")).select("c.node", "c.quotas")
    return nodes.select((F.col("node") - 2**levels).alias("shard"), "quotas")


def _fitted(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``picked``, and ``rest`` lowered to the words of each place that stay open.

    In the given order, as many rows as fit into ``rest``; then, in what is left, as many of the smaller
    ones as fit; and again.
    """
    whole = Window.partitionBy("place")
    upto = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("picked", F.lit(False))
    for _ in range(ROUNDS):
        open_ = ~F.col("picked") & (F.col("words") <= F.col("rest"))
        rows = rows.withColumn("sum", F.sum(F.when(open_, F.col("words")).otherwise(0)).over(upto))
        rows = rows.withColumn("new", open_ & (F.col("sum") <= F.col("rest")))
        rows = rows.withColumn("rest", F.col("rest") - F.sum(F.when(F.col("new"), F.col("words")).otherwise(0)).over(whole))
        rows = rows.withColumn("picked", F.col("picked") | F.col("new"))
    return rows.drop("sum", "new")


def mix(docs: DataFrame, shard_words: int = 50_000_000, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> Mix:
    """Draws the mix. Null text has size 0; a null source is a source. Rows equal in id, source and
    text are one unit: all are taken, and equally often. Reruns draw the same rows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    units = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            F.xxhash64(F.lit(seed), F.col(id_col), text).alias("hash"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        ).groupBy("doc_id", "source", "hash").agg(F.first("size").alias("size"), F.count("*").alias("n")),
        "units",
    )
    sources = stored(targets(units), "sources")
    n_sources = sources.count()
    placed = units.withColumnRenamed("source", "s").join(
        small(sources.select("source", "place", "blocks"), n_sources), F.col("s").eqNullSafe(F.col("source"))
    ).drop("s").withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "hash"), "blocks")).drop("blocks")
    placed = stored(placed, "placed")

    share = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    passes = F.when(F.col("target") >= MOST_REPEATS * F.col("source_size"), MOST_REPEATS).otherwise(share).cast("bigint")
    passes = F.when(F.col("source_size") > 0, passes).otherwise(0)
    blocks = (
        placed.groupBy("place", "block").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
        .join(small(sources.select("place", "source_size", "target", passes.alias("passes")), n_sources), "place")
        .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), "passes")))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    )
    permuted = F.xxhash64(F.lit(seed + 2), "place", "pass", "block")
    last = _fitted(blocks.filter((F.col("pass") == F.col("passes")) & (F.col("rest") > 0)), permuted, "block")
    last = last.withColumn("next", F.row_number().over(Window.partitionBy("place").orderBy("picked", permuted, "block")))
    last = last.withColumn("part", F.when(F.col("picked"), "whole").when((F.col("next") == 1) & (F.col("rest") > 0), "some"))
    kept = ["place", "block", "pass", "part", "rest"]
    drawn = blocks.filter(F.col("pass") < F.col("passes")).withColumn("part", F.lit("whole")).select(*kept).union(
        last.filter("part is not null").select(*kept)
    )
    drawn = stored(
        drawn.withColumn("seq", F.row_number().over(Window.partitionBy("place").orderBy("pass", permuted, "block")).cast("bigint") - 1),
        "draws",
    )

    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    levels = 3
    while 2**levels * shard_words < total:
        levels += 1
    per = sources.join(drawn.groupBy("place").count(), "place", "left")
    root = per.agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("count", F.lit(0)).alias("q")))).alias("s")).select(
        F.expr("transform(s, x -> x.q)").alias("quotas")
    )
    leaves = quota_tree(root, levels, seed).select("shard", F.posexplode("quotas").alias("place", "quota"))
    leaves = leaves.withColumn("upto", F.sum("quota").over(Window.partitionBy("place").orderBy("shard")))
    dealt = leaves.filter("quota > 0").select(
        "shard", "place", F.explode(F.expr("sequence(upto - quota, upto - 1)")).alias("seq")
    )
    draws = stored(drawn.join(dealt, ["place", "seq"]).drop("seq"), "dealt")

    some = draws.filter("part = 'some'").drop("part")
    kept = ["doc_id", "source", "hash", "size", "n", "pass", "shard"]
    partly = placed.join(small(some, n_sources), ["place", "block"]).withColumn("words", F.col("size") * F.col("n"))
    rows = placed.join(draws.filter("part = 'whole'").drop("part", "rest"), ["place", "block"]).select(*kept).union(
        _fitted(partly, "hash", "doc_id").filter("picked").select(*kept)
    )
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed + 3), "shard", "hash", "pass"))
    return Mix(sources, units, stored(rows, "mixed"))


def taken(mixed: Mix) -> DataFrame:
    """One row per row of the input: doc_id, size, source_size, target, taken."""
    times = mixed.rows.groupBy("doc_id", "source", "hash").agg(F.count("*").alias("times"))
    u, t, s = mixed.units.alias("u"), times.alias("t"), mixed.sources.alias("s")
    same = [F.col(f"u.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("hash", "doc_id", "source")]
    return (
        u.join(t, same, "left").join(small(s, mixed.sources.count()), F.col("u.source").eqNullSafe(F.col("s.source")))
        .select(
            "u.doc_id", "u.size", "s.source_size", "s.target",
            (F.col("u.size") * F.coalesce("t.times", F.lit(0))).alias("taken"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("u.n"))).alias("copy"),
        ).drop("copy")
    )


def mixed_rows(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, partitioned and ordered as its shards are.

    Nulls and repeated rows as in ``mix``; no rows give none. Columns besides the three may have any name.
    """
    drawn = mix(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col).rows
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("from"),
    )
    joined = rows.join(
        drawn.select("doc_id", "source", "hash", "shard", "order"),
        (F.col("h") == F.col("hash")) & F.col("id").eqNullSafe(F.col("doc_id")) & F.col("from").eqNullSafe(F.col("source")),
    )
    return joined.repartition("shard", F.pmod("order", F.lit(64))).sortWithinPartitions("shard", "order").select("row.*")
