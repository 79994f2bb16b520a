"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``.

Roles count by their initials: an optional system turn, then user and assistant in turns. Faults are
found in Spark: a turn is blank (no character but white space), a duplicate (role and text stand earlier)
or truncated (it ends in none of ``.!?``), the first that holds. Blank and duplicate turns must be deleted (4);
others may be kept (0), deleted (4) or given another role (3), and a truncated one that stays costs 3 more;
an empty user or assistant turn may be inserted anywhere (3). Of equally cheap edits those are taken
whose audit, the string of the initials K, D, R and I in order, is least.

Repairs are the derivations of a weighted hypergraph. Its items:

    Edit(i, e, x)   turn i, edited by e, yields the role x (nothing when deleted)     axioms
    New(x)          a new turn of role x                                             axioms
    Done(i, q)      the turns before i are edited and their roles leave state q
    Goal            all turns are edited and the roles are whole

and its hyperedges: Done(i, q), Edit(i, e, x) give Done(i + 1, qx); Done(i, q), New(x) give Done(i, qx); Done(n, q)
gives Goal in the states 0 and 3. A weight is (cost, turns used, audit): costs and turns add, audits are joined.
So each function is monotone in its arguments and no result is before one of them, and by Knuth's
generalisation of Dijkstra's algorithm an item popped from the agenda is final. Audits of one item are
strings of a trie whose nodes have jump pointers, so two are compared in steps of the logarithm of their length.

Only one role letter and one fault letter for each turn come together in a task; texts do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.llm.common import released

KEEP, DELETE, REROLE, INSERT, TRUNCATED = 0, 4, 3, 3, 3
WHITE = " \t\n\x0b\x0c\r"
FOLLOWS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WHOLE = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
STEPS = "array<struct<edit: string, source: int, role: string>>"


class Audits:
    """All audits seen, as a trie. A node's jump leads to an ancestor whose depth depends on its own
    depth alone, so two nodes of one depth climb side by side."""

    def __init__(self) -> None:
        self.up, self.jump, self.depth, self.letter = [0], [0], [0], [""]
        self.known: dict[tuple[int, str], int] = {}

    def joined(self, node: int, letter: str) -> int:
        found = self.known.get((node, letter))
        if found is None:
            found = self.known[node, letter] = len(self.up)
            far = self.jump[node]
            even = self.depth[node] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]]
            self.up.append(node)
            self.jump.append(self.jump[far] if even else node)
            self.depth.append(self.depth[node] + 1)
            self.letter.append(letter)
        return found

    def _at(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.jump[node] if self.depth[self.jump[node]] >= depth else self.up[node]
        return node

    def before(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` is less than that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._at(a, depth), self._at(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        while self.up[x] != self.up[y]:
            far = self.jump[x] != self.jump[y]
            x, y = (self.jump[x], self.jump[y]) if far else (self.up[x], self.up[y])
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node]
        return "".join(reversed(letters))


def axioms(roles: str, faults: str) -> list[list[tuple[int, str, str]]]:
    """(cost, edit, role) of what may be done to each turn. Faults: ``d`` must go, ``t`` is truncated."""
    every = []
    for role, fault in zip(roles, faults):
        own = [(DELETE, "D", "")]
        if fault != "d":
            more = TRUNCATED if fault == "t" else 0
            own += [(KEEP + more, "K", role)] if role in "sua" else []
            own += [(REROLE + more, "R", x) for x in "ua" if x != role]
        every.append(own)
    return every


def lightest(roles: str, faults: str) -> tuple[int, str]:
    """Cost and audit of the lightest derivation of the goal."""
    n, audits, agenda = len(roles), Audits(), []
    for i, own in enumerate(axioms(roles, faults)):
        for cost, edit, role in own:
            heappush(agenda, (cost, 1, 0, i, edit, role))
    for role in "ua":
        heappush(agenda, (INSERT, 0, 0, -1, "I", role))
    best: dict[tuple[int, int], tuple[int, int]] = {(0, 0): (0, 0)}  # of Done items: cost, audit
    heappush(agenda, (0, 0, 1, 0, 0, ""))
    edits: list[list[tuple[int, str, str]]] = [[] for _ in range(n + 1)]  # final axioms of each turn
    new: list[tuple[int, str, str]] = []
    final: list[set[int]] = [set() for _ in range(n + 1)]
    inserted_from: list[int] = []  # turns with final items, in order of time

    def derive(i: int, q: int, axiom: tuple[int, str, str], used: int) -> None:
        cost, edit, role = axiom
        to = FOLLOWS.get((q, role)) if role else q
        if to is None or to in final[i + used]:
            return
        done, trace = best[i, q]
        old = best.get((i + used, to))
        if old and old[0] < done + cost:
            return
        joined = audits.joined(trace, edit)
        if old is None or done + cost < old[0]:
            heappush(agenda, (done + cost, i + used, 1, i + used, to, ""))
        elif not audits.before(joined, old[1]):
            return
        best[i + used, to] = done + cost, joined

    while agenda:
        cost, used, kind, i, what, role = heappop(agenda)
        if kind == 0:
            if i < 0:
                new.append((cost, what, role))
                for j in set(inserted_from):
                    for q in tuple(final[j]):
                        derive(j, q, new[-1], 0)
            else:
                edits[i].append((cost, what, role))
                for q in tuple(final[i]):
                    derive(i, q, edits[i][-1], 1)
            continue
        if what in final[i]:
            continue
        final[i].add(what)
        if i == n and what in WHOLE:
            return best[i, what][0], audits.text(best[i, what][1])
        if len(new) < 2:
            inserted_from.append(i)
        for axiom in new:
            derive(i, what, axiom, 0)
        for axiom in edits[i]:
            derive(i, what, axiom, 1)
    raise AssertionError("deleting every turn always ends in the goal")


def steps(audit: str, roles: str) -> list[dict]:
    """What an audit does, in order: the edit, the turn it uses (from 1; none for a new one) and the new role."""
    out, state, at = [], 0, 0
    for edit in audit:
        at += edit != "I"
        made = "u" if state != 2 else "a"
        if edit != "D":
            state = FOLLOWS[state, roles[at - 1] if edit == "K" else made]
        out.append({"edit": edit, "source": None if edit == "I" else at, "role": NAMES[made] if edit in "RI" else None})
    return out


@released
def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("edit", pa.string()), ("source", pa.int32()), ("role", pa.string())]))
    for batch in batches:
        found = [(r, *lightest(r, f)) for r, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([c for _, c, _ in found], pa.int64()), pa.array([a for _, _, a in found], pa.string()),
             pa.array([steps(a, r) for r, _, a in found], kind)],
            ["conv", "cost", "audit", "steps"],
        )


def examined(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, place, initial, blank, duplicate, truncated, illegal) of each row.

    ``place`` numbers the rows of a conversation from 1 by turn, null first; rows of one turn by role, then
    text, so repeated rows stand side by side. A null role or text is one blank. ``initial`` is the role's first
    character if that is s, u or a, else x. ``illegal``: the initials of this row and the one before are not su, ua or au.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    taken = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    first = F.substring("role", 1, 1)
    placed = taken.withColumn("initial", F.when(first.isin("s", "u", "a"), first).otherwise("x")).withColumn("place", F.row_number().over(order))
    pair = F.concat(F.lag("initial").over(Window.partitionBy("conv").orderBy("place")), F.col("initial"))
    placed = placed.withColumn("illegal", F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
    again = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy("place")) > 1
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    return placed.withColumns({"blank": end == "", "again": again}).select(
        "conv", "turn", "role", "text", "place", "initial", "blank", (~F.col("blank") & F.col("again")).alias("duplicate"),
        (~F.col("blank") & ~F.col("again") & ~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"), "illegal",
    )


def repairs(found: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, steps) of each conversation of ``examined`` rows.

    ``gaps``: turn numbers missing between the least and the greatest. A conversation's role and fault
    letters, two bytes for each turn, come together in one task.
    """
    number = lambda c: F.sum(F.col(c).cast("bigint")).alias(c)
    fault = F.when(F.col("blank") | F.col("duplicate"), "d").when(F.col("truncated"), "t").otherwise("k")
    turns = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    signs = found.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "initial", fault.alias("fault")))).alias("signs"),
        number("blank"), number("duplicate"), number("truncated"), number("illegal"),
    )
    gaps = found.groupBy("conv").agg(F.coalesce(turns, F.lit(0)).cast("bigint").alias("gaps"))
    counts = signs.select("conv", "blank", "duplicate", "truncated", "illegal").join(gaps.withColumnRenamed("conv", "gap_conv"), F.col("conv").eqNullSafe(F.col("gap_conv"))).drop("gap_conv")
    schema = T.StructType([found.schema["conv"], *T.StructType.fromDDL(f"cost bigint, audit string, steps {STEPS}").fields])
    made = signs.select(
        "conv", F.array_join(F.col("signs.initial"), "").alias("roles"), F.array_join(F.col("signs.fault"), "").alias("faults")
    ).mapInArrow(_repairs, schema)
    return counts.join(made.withColumnRenamed("conv", "made_conv"), F.col("conv").eqNullSafe(F.col("made_conv"))).drop("made_conv")


def repaired(found: DataFrame, made: DataFrame) -> DataFrame:
    """(conv, place, edit, turn, role, text): the rows of each repaired conversation in their order.

    Inserted rows have no turn and an empty text. The order of ``place`` is that of the audit.
    """
    step = made.select("conv", F.posexplode("steps").alias("place", "step")).select(
        F.col("conv").alias("c"), "place", "step.edit", "step.source", F.col("step.role").alias("given")
    ).filter("edit <> 'D'")
    rows = found.select("conv", F.col("place").alias("source_place"), "turn", "role", "text")
    joined = step.join(rows, F.col("c").eqNullSafe(F.col("conv")) & (F.col("source") == F.col("source_place")), "left")
    return joined.select(
        F.col("c").alias("conv"), "place", "edit", "turn", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def digests(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conversation id of ``convs`` (conv_id) with counts, cost, audit and a digest of its
    repaired rows in ``rows``.

    A conversation without rows has zeros, an empty audit and the digest of the empty string; null ids are
    one conversation; without ``convs`` there are no rows. The digest is of one string, so here, and only
    here, the texts of a conversation come together in one task.
    """
    found = examined(rows)
    made = repairs(found)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("place", F.concat("role", F.lit(":"), "text").alias("line")))), lambda x: x["line"])
    texts = repaired(found, made).groupBy(F.col("conv").alias("text_conv")).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    named = convs.select("conv_id").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return (
        named.join(made.drop("steps"), F.col("conv_id").eqNullSafe(F.col("conv")), "left")
        .join(texts, F.col("conv_id").eqNullSafe(F.col("text_conv")), "left")
        .select(
            "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
