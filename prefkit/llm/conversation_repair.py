"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is sound when the initials of its roles read ``(s?(ua)+)?``. Each row is kept (K, free),
given the role user or assistant (R, 2) or deleted (D, 3), and empty user or assistant rows may be
inserted anywhere (I, 2). Blank rows and duplicates must be deleted; a truncated row that is not
deleted adds 1. Among the cheapest repairs the one whose audit (the initials of the edits, in order)
comes first in ASCII order is taken.

``cheapest_edits`` searches depth first with branch and bound on an explicit stack. A node is (rows
done, state of the role machine). The suffix bound is the least cost of the remaining rows from that
state, computed backwards; it leaves only the order of audits to the search. The incumbent is the
best (cost, audit) found. Per node a table keeps the best prefix that reached it, and a prefix that is
worse in (cost, audit) is dropped: what follows a node does not depend on the way to it. The search
ends when the stack is empty, so the incumbent is optimal. Prefixes share their beginnings (each
knows its parent), so memory follows the number of nodes and not its square.

Spark brings the rows of a conversation together; batches of conversations are searched in the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system, user or assistant row; what a state lets follow.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state that a user or assistant row of our making leads to.
OURS = (USER, USER, ASSISTANT, USER)
ENDS = (BEGIN, ASSISTANT)
#: A row's fault.
SOUND, CUT, BLANK, REPEATED = range(4)
PAIRS = ("su", "ua", "au")

_NO_SPACE = re.compile("[^\x20\x09-\x0d]")
_TAIL = "\x20\x09\x0a\x0b\x0c\x0d"
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}


def faults_of(rows: Sequence[tuple[str, str]]) -> list[int]:
    """The first fault of each (role, text): blank, seen before, or without an end mark."""
    seen: set[tuple[str, str]] = set()
    out = []
    for row in rows:
        text = row[1]
        if not _NO_SPACE.search(text):
            out.append(BLANK)
        elif row in seen:
            out.append(REPEATED)
        else:
            out.append(SOUND if text.rstrip(_TAIL)[-1] in ".!?" else CUT)
        seen.add(row)
    return out


def edits_of(state: int, initial: str, fault: int) -> list[tuple[str, int, int]]:
    """The edits of one row in a state: (letter, cost, next state), in ASCII order."""
    out = [("D", DELETE, state)]
    if fault not in (BLANK, REPEATED):
        extra = TRUNCATED if fault == CUT else 0
        if initial in FOLLOWS[state]:
            out.append(("K", extra, FOLLOWS[state][initial]))
        out.append(("R", REROLE + extra, OURS[state]))
    return out


def suffix_bounds(initials: str, faults: Sequence[int]) -> list[list[int]]:
    """Per number of rows done and state: the least cost of what remains."""
    n = len(faults)
    never = (n + 2) * DELETE + 2 * INSERT
    bounds = [[0] * 4 for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here = bounds[i]
        for state in range(4):
            if i == n:
                here[state] = 0 if state in ENDS else never
            else:
                here[state] = min(c + bounds[i + 1][to] for _, c, to in edits_of(state, initials[i], faults[i]))
        for _ in range(2):  # two insertions lead from any state to an end or back
            for state in range(4):
                here[state] = min(here[state], INSERT + here[OURS[state]])
    return bounds


def cheapest_edits(initials: str, faults: Sequence[int]) -> tuple[int, str]:
    """(cost, audit) of the best repair of rows with these role initials and faults."""
    n = len(faults)
    bounds = suffix_bounds(initials, faults)
    # Search tree: parent, edit, depth and cost of each prefix.
    parent, letter, depth, cost = [-1], [""], [0], [0]

    def before(a: int, b: int) -> bool:
        """Whether prefix a's audit comes before b's (a prefix of the other comes first)."""
        x, y = a, b
        shorter = depth[a] < depth[b]
        while depth[x] > depth[y]:
            x = parent[x]
        while depth[y] > depth[x]:
            y = parent[y]
        if x == y:
            return shorter
        while parent[x] != parent[y]:
            x, y = parent[x], parent[y]
        return letter[x] < letter[y]

    stack = [(0, 0, BEGIN)]
    reached: dict[tuple[int, int], int] = {}
    best, best_cost = -1, None
    on_best: set[int] = set()

    def behind_best(x: int) -> bool:
        """Whether no way on from prefix x comes before the incumbent's audit."""
        if x in on_best:
            return False
        while parent[x] not in on_best:
            x = parent[x]
        mine, at = letter[x], parent[x]
        theirs = [y for y in children[at] if y in on_best]
        return not theirs or mine > letter[theirs[0]]

    children: dict[int, list[int]] = {}
    while stack:
        x, i, state = stack.pop()
        least = cost[x] + bounds[i][state]
        if best >= 0 and (least > best_cost or (least == best_cost and behind_best(x))):
            continue
        rival = reached.get((i, state))
        if rival is not None and (cost[rival] < cost[x] or (cost[rival] == cost[x] and not before(x, rival))):
            continue
        reached[i, state] = x
        if i == n and state in ENDS:
            if best < 0 or cost[x] < best_cost or before(x, best):
                best, best_cost = x, cost[x]
                on_best = set()
                while x >= 0:
                    on_best.add(x)
                    x = parent[x]
            continue
        ways = [(e, c, i + 1, to) for e, c, to in edits_of(state, initials[i], faults[i])] if i < n else []
        ways.append(("I", INSERT, i, OURS[state]))
        # The most promising comes off the stack first, equal ones in the order of their letters.
        ways.sort(key=lambda w: (w[1] + bounds[w[2]][w[3]], w[0]), reverse=True)
        children[x] = []
        for e, c, j, to in ways:
            y = len(parent)
            parent.append(x)
            letter.append(e)
            depth.append(depth[x] + 1)
            cost.append(cost[x] + c)
            children[x].append(y)
            stack.append((y, j, to))
    audit = []
    x = best
    while x > 0:
        audit.append(letter[x])
        x = parent[x]
    return best_cost, "".join(reversed(audit))


def applied(rows: Sequence[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired rows: the edits fix the new roles, since a state lets only one of ours follow."""
    out, state, i = [], BEGIN, 0
    for edit in audit:
        if edit == "K":
            out.append(rows[i])
            state = FOLLOWS[state][rows[i][0][:1]]
        elif edit != "D":
            state = OURS[state]
            out.append((ROLE_OF[state], rows[i][1] if edit == "R" else ""))
        i += edit != "I"
    return out


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired array<struct<role: string, text: string>>"
)


def repaired(turns: Sequence[int | None], rows: Sequence[tuple[str, str]]) -> tuple:
    """One conversation's report (the columns of ``REPORT``)."""
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    faults = faults_of(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest_edits(initials, faults)
    kept = [{"role": r, "text": t} for r, t in applied(rows, audit)]
    return gaps, faults.count(BLANK), faults.count(REPEATED), faults.count(CUT), illegal, cost, audit, kept


#: Characters of text that one batch of results holds before it is handed on.
BATCH_CHARS = 16 * 1024 * 1024


def _reports(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, chars = [], [], 0
            for k in range(batch.num_rows):
                rows = batch.column(1)[k].as_py()
                pairs = [(r["role"], r["text"]) for r in rows]
                ids.append(batch.column(0)[k])
                found.append(repaired([r["turn"] for r in rows], pairs))
                chars += sum(len(t) for _, t in pairs)
                if chars > BATCH_CHARS or k == batch.num_rows - 1:
                    columns = [pa.array([i.as_py() for i in ids], schema.field(0).type)]
                    columns += [pa.array(list(c), schema.field(j + 1).type) for j, c in enumerate(zip(*found))]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
                    ids, found, chars = [], [], 0

    return run


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and the columns of ``REPORT``.

    Rows stand in the order of ``turn``, null first, equal turns by role, then text. ``gaps`` is how
    many turn numbers are missing between the least and the greatest; ``illegal`` counts neighbours
    whose role initials are none of su, ua, au. A null role or text is read as one space. Repeated rows
    are duplicates. The null conv_id is one conversation; an empty table gives no rows; other columns
    are ignored. A conversation is repaired as a whole in one task, as its least audit needs all of it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    space = F.lit(" ")
    row = F.struct("turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    empty = conversations.sparkSession.createDataFrame([], "conv_id long, " + REPORT)
    schema = empty.schema
    schema.fields[0].dataType = conversations.schema["conv_id"].dataType
    return grouped.mapInArrow(_reports(to_arrow_schema(schema)), schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    out = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    out = out.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return out.drop("copy")
