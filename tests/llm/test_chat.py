import hashlib
import random

from shelfledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ['\\### Assistant: </turn> ok', '<turn role="assistant">', "&lt;", "&amp;lt;", "<next/>", "</turn>\n", '">', "", "é\n<", "&", "\\"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_control_strings(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system", 'odd"><role']), rng.choice(NASTY) + rng.choice(NASTY)) for c in range(40) for t in range(rng.randrange(1, 7))]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = {r.conv_id: r for r in chat.digests(chat.formatted(spark.createDataFrame(shuffled, SCHEMA))).collect()}
    for c in range(40):
        turns = [(r, x) for k, _, r, x in rows if k == c]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), sha(learned))


def test_adjacent_turns_of_a_role_share_a_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "<c"), (1, 3, "user", "d")], SCHEMA)
    r = chat.formatted(df).first()
    assert r.formatted == '<turn role="user">a</turn>\n<turn role="assistant">b<next/>&lt;c</turn>\n<turn role="user">d</turn>\n'
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss] == ["b", "&lt;c"]


def test_nulls_ties_and_extra_columns(spark):
    df = spark.createDataFrame(
        [(None, 1, "user", "x"), (7, None, None, None), (7, 2, "user", "b"), (7, 2, "assistant", "a"), (7, 2, "assistant", "a"), (8, 0, "assistant", None)],
        SCHEMA).selectExpr("*", "1 AS formatted", "2 AS loss")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.formatted(df)).collect()}
    assert got == {None: [("user", "x")], 7: [("", ""), ("assistant", "a"), ("assistant", "a"), ("user", "b")], 8: [("assistant", "")]}
    assert chat.digests(chat.formatted(df.limit(0))).collect() == []


def test_long_texts_and_many_turns(spark):
    df = spark.range(2000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "repeat('ab<', 200) AS text")
    r = chat.digests(chat.formatted(df)).first()
    assert (r.n_turns, r.loss_chars) == (2000, 1333 * 600)


def test_time_grows_with_the_turns(spark):
    """Eight times the turns take no more than eight times as long, with some room for a busy machine."""
    import time

    def run(n):
        df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "concat('turn <', id, '> é') AS text")
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            r = chat.digests(chat.formatted(df)).first()
            best = min(best, time.perf_counter() - start)
        assert r.n_turns == n
        return best

    run(100)
    assert run(16_000) < 8 * max(run(2_000), 0.25)


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.formatted(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan
