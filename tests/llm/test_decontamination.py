import random

import pytest
from pyspark.sql import types as T

from shelfledger.llm import decontamination as dc

QUESTION = "A farmer named Tomas Keller sells 12 baskets of ripe apples. Later Tomas buys 30 kg of flour and bakes 12 loaves. How many loaves did Tomas bake?"
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def filler(seed, n=200):
    rng = random.Random(seed)
    return " ".join(f"word{rng.randrange(5000)}" for _ in range(n))


@pytest.fixture
def bench(spark):
    return lambda rows: spark.createDataFrame(rows, ITEMS)


def found(docs, items):
    return {(r.doc_id, r.item_id): r for r in dc.matches(docs, items).collect()}


def test_copies_and_reparameterised_questions(docs, bench):
    other = QUESTION.replace("Tomas", "Hanna").replace("Keller", "Vogel").replace("12", "77").replace("30 kg", "5 pounds")
    mixed_up = QUESTION.replace("Later Tomas", "Later Hanna").replace("did Tomas", "did Pavel").replace("bakes 12", "bakes 98").replace("of ripe", "with green").replace("and bakes", "then fries")
    rows = [
        (1, f"{filler(1)} {QUESTION} {filler(2)}"), (2, f"{filler(3)}\n{other}\n{filler(4)}"), (3, f"{filler(5)} {mixed_up}"), (4, filler(6)),
        (5, QUESTION.upper()), (6, QUESTION.replace(" ", " *** ")), (7, None), (8, ""), (9, " ".join(QUESTION.split()[:13])),
    ]
    got = found(docs(rows), bench([(10, QUESTION), (11, None), (12, ""), (13, "the")]))
    assert {k for k in got} == {(i, 10) for i in (1, 2, 5, 6, 9)}
    assert got[1, 10].covered_words == got[1, 10].item_words and not got[1, 10].reparameterised and got[2, 10].reparameterised


def test_inconsistent_slots_do_not_count():
    import numpy as np

    item = np.array([1, 2, 3, 50, 4, 5, 50, 6], np.uint64)
    kinds = np.array([0, 0, 0, 1, 0, 0, 1, 0], np.int8)
    same = item.copy()
    same[[3, 6]] = 70
    mixed = item.copy()
    mixed[[3, 6]] = [70, 71]
    at, one = np.array([0]), lambda x: x[None, :]
    assert dc.consistent(at, one(same), one(item), one(kinds)) == (set(range(8)), True)
    assert dc.consistent(at, one(item), one(item), one(kinds)) == (set(range(8)), False)
    assert dc.consistent(at, one(mixed), one(item), one(kinds))[0] == set()


def test_against_plain_search(docs, bench):
    rng = random.Random(9)
    items = [(k, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(5, 40)))) for k in range(60)]
    rows = []
    for i in range(200):
        text = filler(1000 + i, 80).split()
        if i % 3 == 0:
            text[20:20] = items[rng.randrange(60)][1].split()
        rows.append((i, " ".join(text)))
    want = {(i, k) for i, t in rows for k, q in items if f" {q} " in f" {t} "}
    assert set(found(docs(rows), bench(items))) >= want
    assert {i for i, _ in found(docs(rows), bench(items))} == {i for i, _ in want}


def test_a_full_filter_finds_the_same(docs, bench, monkeypatch):
    """A filter too small for the benchmark lets windows through in vain, and nothing else."""
    items = [(k, filler(k, 20)) for k in range(12)]
    rows = [(k, f"x y {t} z") for k, t in items]
    whole = set(found(docs(rows), bench(items)))
    monkeypatch.setattr(dc, "FILTER_BITS", (1 << 15, 1 << 15))
    assert set(found(docs(rows), bench(items))) == whole == {(k, k) for k, _ in items}


INSTRUCTION = "read the passage below with care and answer the question that follows by choosing the one option that fits it best of all"


def test_a_shared_instruction_is_no_evidence(docs, bench):
    """Documents that hold an instruction of many items but no question are clean; one with a question is not."""
    items = [(k, f"{INSTRUCTION}: {filler(k, 12)}") for k in range(40)]
    rows = [(i, f"{filler(100 + i)} {INSTRUCTION} {filler(200 + i)}") for i in range(50)] + [(90, f"{filler(900)} {items[7][1]} {filler(901)}")]
    assert set(found(docs(rows), bench(items))) == {(90, 7)}


def test_items_of_one_template_and_items_all_common(docs, bench):
    """Many items of one template are one item to what is common, and an item of common windows alone keeps them."""
    family = [(k, f"if {k + 11} boys share {k + 40} plums how many plums does each boy get on the second day of may") for k in range(20)]
    plain = [(100 + k, f"{INSTRUCTION} {filler(k, 15)}") for k in range(10)] + [(200, INSTRUCTION)]
    rows = [(1, f"{filler(901)} if 999 boys share 888 plums how many plums does each boy get on the second day of may {filler(902)}"), (2, f"{filler(903)} {INSTRUCTION} {filler(904)}")]
    got = found(docs(rows), bench(family + plain))
    assert set(got) == {(1, k) for k in range(20)} | {(2, 200)} and all(got[1, k].reparameterised for k in range(20))


def test_work_grows_with_the_items_not_with_their_pairs(docs, bench):
    """Rows of the window join for documents with a shared instruction: four times the items make no more."""
    def rows_of(n):
        items = bench([(k, f"{INSTRUCTION}: {filler(k, 12)}") for k in range(n)]).selectExpr("item_id", "text")
        telling = dc.item_windows(items)
        df = docs([(i, f"{filler(5000 + i)} {INSTRUCTION} {filler(6000 + i)}") for i in range(20)]).selectExpr("doc_id AS id", "xxhash64(text) AS text_hash", "text")
        shared = df.sparkSession.sparkContext.broadcast(dc._filter_bits(telling.select("h").distinct()))
        seen = df.mapInArrow(dc._doc_windows(shared, [8]), "id bigint, text_hash bigint, h bigint, width int, d_place int, d_words binary")
        return seen.join(telling, ["h", "width"]).count()

    assert rows_of(120) <= rows_of(30) <= 20


def test_covered_words_against_a_plain_version(docs, bench):
    """Parts of items: the words that windows of eight cover, and the two limits, counted over lists of words."""
    rng = random.Random(4)
    items = [(k, " ".join(f"q{'abcdefghij'[rng.randrange(10)]}{'klmnopqrst'[rng.randrange(10)]}{'uvwxyz'[rng.randrange(6)]}" for _ in range(rng.randrange(12, 60)))) for k in range(25)]
    rows, want = [], {}
    for i in range(80):
        k = rng.randrange(25)
        words = items[k][1].split()
        a = rng.randrange(len(words) - 8)
        b = rng.randrange(a + 8, len(words) + 1)
        rows.append((i, f"{filler(300 + i, 30)} so {' '.join(words[a:b])} so {filler(400 + i, 30)}"))
        if b - a >= 0.4 * len(words) or b - a >= 13:
            want[i, k] = b - a
    got = {key: r.covered_words for key, r in found(docs(rows), bench(items)).items()}
    assert got == want


def test_dropping_keeps_columns_and_null_ids(docs, bench):
    df = docs([(1, QUESTION), (1, QUESTION), (2, "clean"), (None, "no id"), (3, QUESTION + " " + "pad " * 200_000), (2, "clean")]).withColumnRenamed("source", "item_id")
    kept = dc.drop_contaminated(df, bench([(1, QUESTION)]))
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 2]
    assert dc.drop_contaminated(docs([]), bench([(1, QUESTION)])).collect() == []
    assert dc.drop_contaminated(df, bench([])).count() == 6


@pytest.mark.parametrize("item", [
    "What is 17 times 23?", "Compute 3+4*12-7+9*2-5", "1, 1, 2, 3, 5, 8, 13, 21, 34, ?", "12*7=?", "5 kg in g", "Define entropy", "2+2", "3 km + 40 m + 7 cm = ? cm",
])
def test_arithmetic_and_short_items_are_found_as_copies(docs, bench, item):
    rows = [(1, f"{filler(1)}\n{item}\n{filler(2)}"), (2, f"{filler(3)} ask: {item} {filler(4)}"), (3, item.replace("7", "8").replace("2", "9").replace("n", "m") + " " + filler(5)), (4, filler(6))]
    got = found(docs(rows), bench([(10, item)]))
    assert set(got) == {(1, 10), (2, 10)}
    assert all(r.covered_words == r.item_words and not r.reparameterised for r in got.values())


def test_signs_of_short_items_count(docs, bench):
    assert set(found(docs([(1, "so 2 +\n2 is"), (2, "so 2, 2 is"), (3, "so 2-2 is")]), bench([(10, "2+2")]))) == {(1, 10)}


def test_an_item_of_one_word_counts_as_a_sentence_only(docs, bench):
    assert set(found(docs([(1, "So.\nPhotosynthesis\nso"), (2, "so photosynthesis is"), (3, "photosynthesis")]), bench([(10, "Photosynthesis?")]))) == {(1, 10), (3, 10)}


def test_long_passages_of_long_items_are_found(docs, bench):
    item = filler(1, 250).split()
    part = lambda n: " ".join(item[40 : 40 + n])  # noqa: E731  words of two tokens each
    rows = [(1, f"{filler(2)} so {part(75)} so {filler(3)}"), (2, f"{filler(4)} so {part(7)} so {filler(5)}"), (3, f"{filler(6)}. {part(5)}. {filler(7)}. {' '.join(item[100:105])}")]
    got = found(docs(rows), bench([(10, " ".join(item))]))
    assert set(got) == {(1, 10), (2, 10)} and got[1, 10].covered_words == 150 and got[1, 10].item_words == 500


def test_longest_run():
    assert [dc.longest_run(x) for x in (set(), {5}, {1, 2, 3, 5, 6}, {9, 1, 2, 4, 5, 6, 7})] == [0, 1, 3, 4]
