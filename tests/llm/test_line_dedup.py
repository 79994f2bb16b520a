import random
from collections import defaultdict

from shelfledger.llm import line_dedup


def cleaned(rows, least):
    sites = defaultdict(set)
    for _, text, _, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(site)
    common = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, text, _, _ in rows:
        lines = None if text is None else text.split("\n")
        kept = lines and [x for x in lines if x.strip(" ") not in common]
        out.append((i, None if lines is None else "\n".join(kept), len(lines or []) - len(kept or [])))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(300):
        site = f"s{rng.randrange(40)}" if i % 9 else None
        lines = [f"own {i} {j}" for j in range(rng.randrange(4))] + [f" shared {k} " for k in range(30) if rng.random() < k / 60] + ["", "  "]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), None, site))
    return rows + [(900, None, None, "s1"), (901, "", None, None), (902, "shared 29\nshared 29", None, "s2"), (902, "other", None, "s2")]


def test_against_brute_force(docs):
    for least in (2, 8, 20):
        got = line_dedup.without_boilerplate(docs(corpus()), least_sites=least)
        assert sorted(((r.doc_id, r.text, r.lines_removed) for r in got.collect()), key=repr) == cleaned(corpus(), least)


def test_counts_far_above_the_band_need_no_exact_count(docs):
    rows = [(i, "everywhere\nown %d" % i, None, f"site{i}") for i in range(200)]
    got = line_dedup.without_boilerplate(docs(rows)).collect()
    assert all(r.text == f"own {r.doc_id}" for r in got)


def test_clash_empty_and_long(docs):
    df = docs([(1, "a\n" * 100_000, None, "x")]).withColumnRenamed("lang", "lines_removed")
    got = line_dedup.without_boilerplate(df)
    assert sorted(got.columns) == sorted(df.columns) and got.first().lines_removed == 0
    assert line_dedup.without_boilerplate(docs([])).collect() == []


def test_main_path_runs_no_python(docs):
    plan = line_dedup.without_boilerplate(docs(corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_columns_and_repeated_ids(docs):
    line = "a line that stands on many sites"
    rows = [(i % 5, f"own {i}\n{line}", None, f"site{i}") for i in range(12)] + [(None, f"null id\n{line}", None, "x"), (3, None, None, "y")]
    df = docs(rows).selectExpr("*", "1 AS removed", "2 AS __key", "3 AS key", "4 AS id", "5 AS place", "6 AS line", "7 AS row", "8 AS of")
    out = line_dedup.without_boilerplate(df)
    assert out.columns == [*df.columns, "lines_removed"]
    got = sorted(((r.doc_id, r.text, r.removed, r["__key"], r.row, r.of, r.lines_removed) for r in out.collect()), key=repr)
    assert got == sorted([(i, t and t.split("\n")[0], 1, 2, 7, 8, int(t is not None)) for i, t, _, _ in rows], key=repr)
