import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfledger.llm import damage, periodic_runs
from shelfledger.llm.words import mix


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w):
    """(start, length, period) of all runs by comparing all words at all periods."""
    out = []
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            a = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            part = w[a : i + p]
            if len(part) >= max(6, 4 * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                out.append((a, len(part), p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def damaged(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)] if h % 10 == 0 else w


def made_up(rng, longest):
    w = []
    while len(w) < longest:
        block = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(rng.randrange(1, 14))]
        w += block * rng.choice([1, 1, 2, 4, 5, 9])
    return w


@pytest.mark.parametrize("tile", [16, 32, 128])
def test_tiles_against_all_pairs_of_words(tile):
    """Tiles in octaves, solved on their own and stitched, give the runs of whole texts."""
    rng = random.Random(tile)
    for _ in range(120):
        w = made_up(rng, rng.randrange(200))
        values = mix(np.array(w, np.uint64) + np.uint64(1))
        cells = set()
        for s, e, low, high in periodic_runs.tiles(len(w), tile):
            _, p, a, b = periodic_runs.solve(values[s:e], np.array([e - s]), np.array([low]), np.array([high]))
            cells |= {(int(q), s + int(x), s + int(y)) for q, x, y in zip(p, a, b)}
        runs, last = [], None
        for q, x, y in sorted(cells):
            if last and last[0] == q and x <= last[2]:
                last[2] = max(last[2], y)
            else:
                last = [q, x, y]
                runs.append(last)
        assert sorted(((x, y - x + q, q) for q, x, y in runs), key=lambda r: (r[0], r[2])) == brute(w)


def test_many_texts_in_one_batch():
    rng = random.Random(2)
    for _ in range(60):
        texts = [made_up(rng, rng.randrange(90)) for _ in range(6)]
        counts, none = np.array([len(t) for t in texts]), np.zeros(6, np.int64)
        values = mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(1))
        t, p, a, b = periodic_runs.solve(values, counts, none, none + 62)
        for k, w in enumerate(texts):
            own = {(int(x), int(y - x + q), int(q)) for i, q, x, y in zip(t, p, a, b) if i == k}
            assert sorted(own, key=lambda r: (r[0], r[2])) == brute(w)


@pytest.mark.parametrize("tile", [32, 1 << 13])
def test_digests_against_brute_force(docs, tile):
    rng = random.Random(4)
    rows = [(i, rng.choice(["", "  ", "\n"]).join(["", rng.choice([" ", "\t", "  \n"]).join(f"w{x}" for x in made_up(rng, rng.randrange(180))), ""])) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \x0b\n"), (903, "a " * 5), (904, "a " * 6), (905, "a b " * 4), (905, "a b " * 4), (None, "x y " * 9), (906, "é ü " * 7)]
    df = damage.repeated_tails(docs(rows))
    got = sorted((tuple(r) for r in periodic_runs.digests(df, tile).collect()), key=repr)
    want = []
    for i, text in rows:
        w = damaged(i, words(text))
        runs = brute(w)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want.append((i, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
                     sha("".join(f"{a},{n},{p}\n" for a, n, p in runs)), sha(collapsed(w, runs))))
    assert got == sorted(want, key=repr)


def test_real_columns_nulls_and_clashing_names(spark, docs):
    df = docs([(1, "no no no no no no yes"), (1, "no no no no no no yes"), (None, None), (2, "plain")]).selectExpr(
        "*", "1 AS k1", "2 AS k2", "3 AS runs", "4 AS row", "5 AS period", "6 AS words")
    out = periodic_runs.collapsed(df, tile=16)
    assert out.columns == [c for c in df.columns if c != "runs"] + ["runs", "collapsed"]
    got = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed, r.k1, r.row) for r in out.collect())
    assert got == [(0, [], "", 1, 4), (1, [(0, 6, 1)], "no yes", 1, 4), (1, [(0, 6, 1)], "no yes", 1, 4), (2, [], "plain", 1, 4)]
    assert periodic_runs.digests(docs([])).collect() == [] and periodic_runs.collapsed(docs([])).collect() == []


def test_a_very_long_text(docs):
    """Half a million words: one run of a period of 60,000 and one of 3."""
    rng = random.Random(9)
    block = [f"b{rng.randrange(10**6)}" for _ in range(60_000)]
    w = ["x", "y", "z"] * 1000 + block * 4 + [f"t{i}" for i in range(260_000)]
    r = periodic_runs.digests(docs([(1, " ".join(w))])).first()
    assert (r.n_runs, r.start, r.length, r.period) == (2, 3000, 240_000, 60_000)
    assert r.collapsed_sha256 == sha(" ".join(["x", "y", "z"] + block + w[243_000:]))
