import hashlib
import itertools
import random
import re
import zlib

from shelfledger.llm import damage, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            one = (c, t, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            out += [one, one] if h == 3 else [one]
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(roles, bad):
    """The least (cost, audit, made) over all edits, turn by turn."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    def widened(states):
        for _ in range(2):  # two inserted turns in a row lead back to where one was
            for (last, (cost, audit, made)) in list(states.items()):
                for x in step[last]:
                    if x in "ua":
                        new = (cost + 3, audit + "I", (*made, ("I", None, x)))
                        states[x] = min(states.get(x, new), new, key=lambda v: v[:2])
        return states

    states = widened({"": (0, "", ())})
    for i, (role, fault) in enumerate(zip(roles, bad)):
        after = {}

        def offer(last, value):
            after[last] = min(after.get(last, value), value, key=lambda v: v[:2])

        for last, (cost, audit, made) in states.items():
            offer(last, (cost + 4, audit + "D", made))
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                for x in step[last]:
                    if role[:1] == x:
                        offer(x, (cost + more, audit + "K", (*made, ("K", i, role))))
                    elif x in "ua":
                        offer(x, (cost + more + 3, audit + "R", (*made, ("R", i, x))))
        states = widened(after)
    return min((states[k] for k in ("", "a") if k in states), key=lambda v: v[:2])


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns, numbers = [(r[2], r[3]) for r in own], [r[1] for r in own if r[1] is not None]
        bad = faults(turns)
        cost, audit, made = cheapest([r for r, _ in turns], bad)
        lines = [f"{'user' if x == 'u' else 'assistant' if x == 'a' else x}:{'' if e == 'I' else turns[i][1]}" for e, i, x in made]
        firsts = [r[:1] for r, _ in turns]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(bad.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit, sha("\n".join(lines)),
        )
    return out


def made_up(rng, convs):
    said = ["Yes.", "No", "Why? ", "", " \t", "a\n", "Go!", "Go!", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    return [(c if c else None, t if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(said)) for c in range(convs) for t in range(rng.randrange(9)) if rng.random() > 0.1]


def test_against_a_plain_version(spark):
    rng = random.Random(11)
    rows = made_up(rng, 120)
    rows += [(500, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"turn {t}.") for t in range(400)]
    rows += [(501, 3, "user", "x."), (501, 3, "user", "x."), (501, 3, "assistant", "x."), (502, None, "user", None)]
    want = expected(rows)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "'x' AS steps", "'y' AS conv")
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.digests(df, damage.damaged_turns(df)).collect()}
    assert got == want


def test_lightest_against_all_edits():
    """Every string of edits up to a length, not a recurrence, is the judge here."""
    for n in range(4):
        for roles in itertools.product("suax", repeat=n):
            for marks in itertools.product("ktd", repeat=n):
                found = turn_repair.lightest("".join(roles), "".join(marks))
                assert found[0] <= 4 * n and found == least(roles, marks)


def least(roles, marks, room=3):
    best = None
    for new in itertools.product(range(room), repeat=len(roles) + 1):
        for edits in itertools.product("DKR", repeat=len(roles)):
            audit, out, cost = "I" * new[0], ["?"] * new[0], 3 * sum(new)
            for role, mark, edit, k in zip(roles, marks, edits, new[1:]):
                if edit != "D" and mark == "d":
                    break
                cost += {"D": 4, "K": 0, "R": 3}[edit] + (3 if mark == "t" and edit != "D" else 0)
                out += [] if edit == "D" else [role if edit == "K" else "?"]
                audit += edit + "I" * k
                out += ["?"] * k
            else:
                if best and (cost, audit) >= best:
                    continue
                if any(fits(out, start) for start in (0, 1)):
                    best = (cost, audit)
    return best


def fits(out, system):
    rest = out[system:]
    if system and (not out or out[0] != "s" or not rest):
        return False
    return len(rest) % 2 == 0 and all(x in ("?", "ua"[i % 2]) for i, x in enumerate(rest))


def test_audit_gives_the_grammar_and_the_steps():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(30)
        roles, marks = "".join(rng.choice("suax") for _ in range(n)), "".join(rng.choice("kkktd") for _ in range(n))
        cost, audit = turn_repair.lightest(roles, marks)
        made = turn_repair.steps(audit, roles)
        left = "".join(s["role"][0] if s["role"] else roles[s["source"] - 1] for s in made if s["edit"] != "D")
        assert GRAMMAR.match(left) and sum(e != "I" for e in audit) == n


def test_long_conversation_of_ties(spark):
    """Equal costs at every turn: audits are compared by their trie, not letter by letter."""
    cost, audit = turn_repair.lightest("u" * 3000, "k" * 3000)
    assert cost == 4500 and len(audit.replace("I", "")) == 3000


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Out."), (1, 5, "assistant", "No end"), (2, 0, "assistant", " ")]
    found = turn_repair.examined(spark.createDataFrame(rows, SCHEMA))
    made = turn_repair.repairs(found)
    r = {x.conv: x for x in made.collect()}
    assert (r[1].gaps, r[1].blank, r[1].duplicate, r[1].truncated, r[1].illegal) == (2, 0, 1, 1, 3)
    got = sorted(tuple(x) for x in turn_repair.repaired(found, made).collect())
    # Giving the tool's turn to the assistant and deleting the truncated one costs 11 as well, but its audit, KDRD, is greater.
    assert (r[1].cost, r[1].audit) == (11, "KDDK") and (r[2].cost, r[2].audit) == (4, "D")
    assert got == [(1, 0, "K", 0, "user", "Hi."), (1, 3, "K", 5, "assistant", "No end")]


def test_empty_tables_and_a_very_long_text(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turn_repair.digests(none, damage.damaged_turns(none)).collect() == []
    lost = spark.createDataFrame([(9, 9, "user", "x.")], SCHEMA)
    r = turn_repair.digests(lost, none).first()
    assert tuple(r) == (9, 0, 0, 0, 0, 0, 0, "", sha(""))
    text = "word " * 400_000 + "end."
    r = turn_repair.digests(lost, spark.createDataFrame([(9, 1, "user", text), (9, 2, "assistant", text)], SCHEMA)).first()
    assert (r.cost, r.audit, r.repaired_sha256) == (0, "KK", sha(f"user:{text}\nassistant:{text}"))
