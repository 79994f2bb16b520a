import random

import numpy as np
import pytest

from shelfledger.llm import langid

WORDS = {
    "aa": ["kalo", "mire", "tonu", "shared", "velka"], "bb": ["zrty", "qwop", "hjkl", "shared", "vbnm"], "cc": ["όμικρον", "λόγος", "shared", "ψυχή"],
}


def corpus(n=240):
    rng = random.Random(2)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(12)), lang) for i in range(n) for lang in [rng.choice(list(WORDS))]]


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs(corpus()))


def test_languages_are_told_apart(docs, model):
    rows = [(1, "Kalo TONU mire velka"), (2, "qwop, hjkl! 12 zrty"), (3, "ΛΌΓΟΣ ψυχή"), (4, None), (5, ""), (6, "12 ... 99 \n"), (7, "漢字"), (8, "kalo " * 300_000)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs(rows), model).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "aa", 2: "bb", 3: "cc", 4: "und", 5: "und", 6: "und", 7: "aa", 8: "aa"}
    assert got[7][1] == 0 and got[4][1] == 0 and all(0 <= s <= 1 for _, s in got.values()) and got[8][1] > 0.9


def test_filter_names_all_languages_of_an_ngram(model):
    text = "shared".encode()
    share, total = langid.shares(model, np.array([0, len(text)]), np.frombuffer(text, np.uint8))
    assert total[0] > 0 and (share[0] > 0.9).all()


def grams(text):
    out = []
    for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        w = f"\0{word}\0"
        out += [w[i : i + n] for n in (3, 4) for i in range(len(w) - n + 1)]
    return out


def test_ngrams_against_plain_strings():
    texts = ["Ab, cde fghij", "", "x", "a-b 12cd", "Éa É", "long" * 50]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    names, seen = {}, [[] for _ in texts]
    for found, row in langid.ngrams(offsets, np.frombuffer(b"".join(data), np.uint8)):
        for g, r in zip(found.tolist(), row.tolist()):
            seen[r].append(g)
    for t, found in zip(texts, seen):
        plain = grams(t)
        assert len(plain) == len(found) and len(set(plain)) == len(set(found))
        names.update({g: None for g in found})


def test_pieces_do_not_change_ngrams(monkeypatch):
    text = ("word and other words " * 40).encode()
    at, data = np.array([0, 100, len(text)]), np.frombuffer(text, np.uint8)

    def counted():
        out = {}
        for found, row in langid.ngrams(at, data):
            for key in zip(found.tolist(), row.tolist()):
                out[key] = out.get(key, 0) + 1
        return out

    whole = counted()
    monkeypatch.setattr(langid, "PIECE", 13)
    assert counted() == whole


def test_no_labels_and_clashing_columns(docs):
    empty = langid.fit(docs([(1, "text", None)]))
    df = docs([(1, "text")]).withColumnRenamed("n_chars", "language")
    assert [(r.lang_pred, r.score) for r in langid.predict(df, empty, carry=("doc_id", "text", "language")).collect()] == [("und", 0.0)]
    assert langid.predict(docs([]), empty).collect() == []


def test_more_than_64_languages(docs):
    rng = random.Random(1)
    alphabet = [chr(0x4E00 + i) for i in range(2000)]
    lang_words = {f"l{k:02d}": ["".join(rng.choice(alphabet) for _ in range(5)) for _ in range(4)] for k in range(70)}
    rows = [(k * 10 + j, " ".join(w * 3), lang) for k, (lang, w) in enumerate(lang_words.items()) for j in range(2)]
    found = langid.predict(docs(rows), langid.fit(docs(rows)), carry=("doc_id", "lang")).collect()
    assert all(r.lang_pred == r.lang for r in found) and len(found) == 140


def test_masks_correction_and_winner_against_plain_sets(docs, spark):
    """The filters' corrected shares are those of exact sets of n-grams, and so is the winner, smaller names first in ties."""
    import random
    from collections import Counter, defaultdict

    import numpy as np

    from shelfledger.llm.words import text_bytes

    rng = random.Random(6)
    stems = {"aa": "kalo miru sete", "bb": "kalo brun tepp", "cc": "zwei drei vier", "dd": "zwei drei vier"}
    text = lambda lang: " ".join(rng.choice(stems[lang].split()) + rng.choice(["", "na", "st", "ed"]) for _ in range(30))
    rows = [(i, text(lang), lang) for i, lang in enumerate(sorted(stems) * 40)]
    model = langid.fit(docs(rows))
    assert model.languages == sorted(stems)

    def grams(t):
        import pyarrow as pa

        return [int(g) for part, _ in langid.ngrams(*text_bytes(pa.array([t]))) for g in part]

    counts = defaultdict(Counter)
    for _, t, lang in rows:
        counts[lang].update(grams(t))
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    rate = {lang: {g: n / total[lang] for g, n in c.items() if n >= langid.LEAST_COUNT} for lang, c in counts.items()}
    top = Counter()
    for c in rate.values():
        for g, r in c.items():
            top[g] = max(top[g], r)
    held = {lang: {g for g, r in c.items() if r >= langid.LEAST_SHARE * top[g]} for lang, c in rate.items()}

    tests = [(1000 + i, text(lang), None) for i, lang in enumerate(sorted(stems) * 10)] + [(2000, "kalo zwei", None), (2001, "Kalo", None)]
    found = {r.doc_id: r for r in langid.predict(docs(tests), model).collect()}
    for i, t, _ in tests:
        own = grams(t)
        exact = [sum(g in held[lang] for g in own) / len(own) for lang in sorted(stems)]
        assert abs(found[i].score - max(exact)) < 0.02
        best = [lang for lang, x in zip(sorted(stems), exact) if x > max(exact) - 0.02]
        assert found[i].lang_pred in best
    assert np.all(model.chance < 0.02) and found[2001].lang_pred == "aa"
