import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from prefkit.llm import chat_format as C
from prefkit.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string, segments string, state string"
AFTER = {t.role: t.after for t in C.TITLED.turns}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def brute(rows):
    """conv_id -> (turns, loss text, illegal turns, first of them, valid), by a plain loop."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        state, bad = "start", []
        for k, (_, _, role, _) in enumerate(turns):
            if state not in AFTER.get(role, ()):
                bad.append(k)
            state = role if role in AFTER else state
        learned = "".join(t for *_, role, t in turns if role == "assistant")
        valid = not bad and state == "assistant"
        out[conv] = ([(r, t) for *_, r, t in turns], learned, len(bad), bad[0] if bad else None, valid)
    return out


def check(spark, rows):
    made = C.format_conversations(table(spark, rows))
    read = made.select("*", C.read_turns(F.col("formatted")).alias("turns"), C.loss_text(F.col("segments")).alias("learned"))
    got = {
        r.conv_id: ([(t.role, t.text) for t in r.turns], r.learned, r.n_illegal, r.first_illegal, r.valid) for r in read.collect()
    }
    assert got == brute(rows)
    return {r.conv_id: r for r in read.collect()}


MARKS = ["</turn>", "</turn>\n", "### User: ", "### Assistant:", "### System: x", "### Role", "</role>", "\\", "\\\\", "<", "</", "#", "\n", "é", "𝄞", "ok."]


def test_round_trip_of_texts_made_of_control_strings(spark):
    r = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "</role>", "### User: ", "", None]
    rows = [
        (c, t, r.choice(roles), "".join(r.choice(MARKS) for _ in range(r.randint(0, 7)))) for c in range(150) for t in range(r.randint(1, 6))
    ]
    found = check(spark, rows)
    for row in found.values():
        # No control string but the template's own: as many closings as turns, each part one turn.
        assert row.formatted.count("</turn>") == len(row.turns)
        assert "".join(s.text for s in row.segments) == row.formatted
        assert len(row.segments) == 3 * len(row.turns)


def test_machine_flags_and_segments(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 1, "user", "v"), (3, 0, "assistant", "a")]
    found = check(spark, rows)
    assert [(s.text, s.loss) for s in found[1].segments] == [
        ("### System: ", False), ("s", False), ("</turn>\n", False),
        ("### User: ", False), ("u", False), ("</turn>\n", False),
        ("### Assistant: ", False), ("a", True), ("</turn>\n", False),
    ]
    assert found[1].valid and not found[2].valid and (found[2].first_illegal, found[3].n_illegal) == (1, 1)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (None, None, None, None), (4, None, "assistant", "first"), (4, 0, "user", ""),
        (5, 1, "user", "tie b"), (5, 1, "user", "tie a"), (5, 1, "user", "tie a"), (6, 0, "user", None), (7, 0, " ", " \n"),
    ]
    found = check(spark, rows)
    assert [t.text for t in found[5].turns] == ["tie a", "tie a", "tie b"]


def test_long_text_and_long_conversation(spark):
    rows = [(1, 0, "user", "\\</turn>" * 300_000), (1, 1, "assistant", "é" * 2_000_000)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(3000)]
    found = check(spark, rows)
    assert found[1].valid and found[2].valid


def test_empty_table(spark):
    assert C.format_conversations(table(spark, [])).count() == 0


def test_order_of_the_input_does_not_matter(spark):
    rows = [(c, t % 3, ("user", "assistant")[t % 2], str(t)) for c in range(5) for t in range(8)]
    a, b = (C.format_conversations(table(spark, x)).orderBy("conv_id").collect() for x in (rows, rows[::-1]))
    assert a == b


def test_a_declared_template(spark):
    terse = C.Template((C.Turn("user", "<|u|>", ("start", "assistant")), C.Turn("assistant", "<|a|>", ("user",), loss=True)), "<|end|>", ("assistant",), "<|r|>", "<|x|>", "~")
    rows = [(1, 0, "user", "~<|a|>"), (1, 1, "assistant", "<|end|>~")]
    row = C.format_conversations(table(spark, rows), terse).select("*", C.read_turns(F.col("formatted"), terse).alias("t")).first()
    assert row.formatted == "<|u|>~~<~|a|><|end|><|a|><~|end|>~~<|end|>"
    assert [(t.role, t.text) for t in row.t] == [("user", "~<|a|>"), ("assistant", "<|end|>~")] and row.valid


@pytest.mark.parametrize("closes", ["x", "a\\b", "aXa"])
def test_ambiguous_templates_are_refused(closes):
    with pytest.raises(ValueError):
        C.Template((C.Turn("user", "### U: ", ("start",)),), closes, ("user",))


def test_query_runs_no_python(spark):
    from prefkit.plans.inspect import plan_text

    plan = plan_text(Q.op11_chat_segments(spark, "/root/testdata/sf0.001"))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
