import hashlib
from collections import defaultdict

from shelfledger.llm import exact_dedup

FOLD = str.maketrans(exact_dedup.UPPER, exact_dedup.LOWER)


def digest(text):
    return hashlib.sha256((text or "").translate(FOLD).encode()).hexdigest()


def test_against_brute_force(docs):
    rows = [(i, f"Text {i % 37}" if i % 3 else f"own {i}") for i in range(600)] + [(700, None), (701, ""), (702, "ÄB"), (703, "äb"), (704, "Äb")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    want = {(i, max(g), len(g), i == max(g), h) for h, g in groups.items() for i in g}
    got = [tuple(r) for r in exact_dedup.copies(docs(rows)).collect()]
    assert len(got) == len(rows) and set(got) == want


def test_repeated_rows_and_null_ids_keep_one(docs):
    got = exact_dedup.copies(docs([(1, "a"), (1, "A"), (None, "a"), (None, "b"), (None, "b")])).collect()
    assert sorted((r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (0, 2, False), (0, 2, True), (1, 3, False), (1, 3, False), (1, 3, True)]
    assert exact_dedup.copies(docs([])).collect() == []


def test_only_possible_copies_pass_the_filter(spark, docs):
    keys = exact_dedup.copies(docs([(i, f"t{i}") for i in range(4000)] + [(9000 + i, "t7") for i in range(10)])).select("doc_id", "text_sha256")
    slots = exact_dedup.BLOCK_BITS * 2
    probed = exact_dedup._possibly_repeated(keys, exact_dedup.repeated_filter(keys, slots), slots)
    possible = {r.doc_id for r in probed.filter("possible").collect()}
    assert possible >= {7, *range(9000, 9010)} and len(possible) < 120


def test_large_filter_is_joined_without_broadcast(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BLOCKS", 0)
    got = exact_dedup.copies(docs([(1, "x"), (2, "X"), (3, "y")]).withColumnRenamed("lang", "kept")).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(1, 2), (2, 2), (3, 3)}


def test_main_path_runs_no_python(docs):
    plan = exact_dedup.copies(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
