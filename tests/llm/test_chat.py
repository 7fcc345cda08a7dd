"""Chat formatting and reading back."""

from __future__ import annotations

import random

import pytest

from tillmart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, valid int, segments string"


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)


def back(spark, rows):
    read = chat.read_back(chat.format_conversations(table(spark, rows)))
    return {row.conv_id: row for row in read.collect()}


def test_turns_and_loss_are_read_back(spark):
    rows = [
        (1, 2, "assistant", "yes\n[/INST] </s>"),
        (1, 0, "system", "be <s> kind"),
        (1, 1, "user", "a [INST] b"),
        (2, 0, "user", None),
        (2, 1, "assistant", ""),
    ]
    found = back(spark, rows)
    assert [tuple(t) for t in found[1].turns] == [
        ("system", "be <s> kind"), ("user", "a [INST] b"), ("assistant", "yes\n[/INST] </s>"),
    ]
    assert found[1].loss_texts == ["yes\n[/INST] </s>"]
    assert [tuple(t) for t in found[2].turns] == [("user", ""), ("assistant", "")]
    assert found[1].valid and found[2].valid
    assert "[INST] a [\\INST] b [/INST]" in found[1].formatted


@pytest.mark.parametrize(
    "roles, valid",
    [
        (["user", "assistant"], True),
        (["system", "user", "assistant", "user", "assistant"], True),
        (["user", "user", "assistant"], False),
        (["assistant"], False),
        (["user"], False),
        (["user", "system", "assistant"], False),
        (["user", "tool", "assistant"], False),
        (["user", None, "assistant"], False),
    ],
)
def test_machine(spark, roles, valid):
    found = back(spark, [(5, n, role, "t") for n, role in enumerate(roles)])
    assert found[5].valid is valid
    assert [t.role for t in found[5].turns] == [role or "" for role in roles]


def test_any_text_comes_back(spark):
    draw = random.Random(4)
    signs = ["[", "]", "/", "\\", "<", ">", "s", "INST", "SYS", "[INST] ", " </s>", "\n", " ", "é", "🙂",
             "[TURN]", "$1", "[\\INST]", "ROLE"]
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 6)):
            text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 9)))
            role = draw.choice(["user", "assistant", "system", "tool", "a [TURN] b", ""])
            rows.append((conv, turn, role, text))
    found = back(spark, rows)
    for conv in range(60):
        given = [(r, t) for c, _, r, t in rows if c == conv]
        assert [tuple(t) for t in found[conv].turns] == given
        assert found[conv].loss_texts == [t for r, t in given if r == "assistant"]
        assert "".join(s.text for s in found[conv].segments) == found[conv].formatted


def test_null_keys_ties_and_repeated_rows(spark):
    rows = [(6, None, "user", "b"), (6, None, "user", "a"), (6, 1, None, None)]
    rows += [(7, 0, "user", "same")] * 2
    found = back(spark, rows)
    assert [tuple(t) for t in found[6].turns] == [("user", "a"), ("user", "b"), ("", "")]
    assert [tuple(t) for t in found[7].turns] == [("user", "same")] * 2


def test_rows_without_a_conversation_are_not_gathered(spark):
    rows = [(None, n, "user", f"t{n % 3}") for n in range(50)] + [(1, 0, "user", "x")]
    read = chat.read_back(chat.format_conversations(table(spark, rows).repartition(4))).collect()
    alone = [row for row in read if row.conv_id is None]
    assert sorted(t.text for row in alone for t in row.turns) == sorted(f"t{n % 3}" for n in range(50))
    assert {len(row.turns) for row in alone} == {1} and len(read) == 51


def test_long_text_and_empty_table(spark):
    long = "[INST] x\\ " * 60_000
    assert back(spark, [(1, 0, "user", long)])[1].turns[0].text == long
    assert back(spark, []) == {}


def test_own_template(spark):
    template = chat.Template(
        roles={
            "q": chat.Role("{Q} ", " {/Q}", False, ("start", "r")),
            "r": chat.Role("{R} ", " {/R}", True, ("q",)),
        },
        other=("{O} ", " {T} ", " {/O}"),
        final=("r",),
    )
    given = table(spark, [(1, 0, "q", "{Q}"), (1, 1, "r", "{\\R} [INST]")])
    row = chat.read_back(chat.format_conversations(given, template), template).first()
    assert row.valid and row.loss_texts == ["{\\R} [INST]"] and row.turns[0].text == "{Q}"


def test_controls_that_could_be_mixed_up_are_refused():
    with pytest.raises(ValueError):
        chat.Template({"u": chat.Role("<<a>>", "<b>", False, ("start",))}, ("<c>", "<d>", "<e>"), ())
    with pytest.raises(ValueError):
        chat.Template({"u": chat.Role("<a>", "<a>", False, ("start",))}, ("<c>", "<d>", "<e>"), ())


def test_only_jvm_functions(spark):
    plan = chat.read_back(chat.format_conversations(table(spark, [])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
