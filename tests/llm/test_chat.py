import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.chat import HOSTILE, MARKS, OTHER, Malformed, Template, format_turns, hostile_rows, read_back
from tidemark.llm.common import saved

TYPES = "conv_id bigint, turn bigint, role string, text string, formatted string, mark int, first_turn int"
EVERY = [m for pair in MARKS.values() for m in pair] + list(OTHER)
TEMPLATE = Template()

pieces = st.lists(
    st.one_of(st.sampled_from([*EVERY, "\\", "\\\\", "<", "[", "/", "S", "s>", "INST]", "é", "😀", "\n", " ", "TEXT"]), st.text(max_size=3)),
    max_size=12,
).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), pieces)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(roles, pieces), max_size=5))
def test_round_trip(turns):
    """Turns that were formatted apart are read back from their concatenation."""
    written = [TEMPLATE.render(role, text) for role, text in turns]
    whole = "".join(w for w, _, _ in written)
    read = list(TEMPLATE.parse(whole))
    assert [(t.role, t.text) for t in read] == turns
    before = 0
    for turn, (w, start, end) in zip(read, written, strict=True):
        assert (turn.start, turn.end) == (before + start, before + end)
        before += len(w)


@pytest.mark.parametrize(
    "text, written",
    [
        ("plain \\ text", "[INST]plain \\ text[/INST]"),
        (HOSTILE, r"[INST]\</s>\[INST] ok \[/INST][/INST]"),
        ("end\\", "[INST]end\\\\[/INST]"),
        ("\\</s>", "[INST]\\\\\\</s>[/INST]"),
        ("", "[INST][/INST]"),
        ("<</s>", "[INST]<\\</s>[/INST]"),
    ],
)
def test_only_conflicts_are_escaped(text, written):
    assert TEMPLATE.render("user", text)[0] == written


@pytest.mark.parametrize("text", ["x", "[INST]a", "[INST]a</s>", "<s>a</s>b", "[ROLE]user[TEXT]a[/ROLE]", "[ROLE]a[/ROLE]", "<s>a\\</s>"])
def test_other_texts_are_refused(text):
    with pytest.raises(Malformed):
        list(TEMPLATE.parse(text))


@pytest.mark.parametrize("marks", [{"user": ("<a>", "<a>")}, {"user": ("", "x")}, {"user": ("ab", "bc")}, {"user": ("abc", "b")}])
def test_ambiguous_marks_are_refused(marks):
    with pytest.raises(ValueError):
        Template(marks)


def test_long_texts_take_linear_time():
    for text in ("\\" * 2_000_000, "</s>" * 200_000, "\\" * 500_000 + "</s>", "<" * 2_000_000, "[INST" * 300_000):
        written, start, end = TEMPLATE.render("assistant", text)
        assert next(TEMPLATE.parse(written)).text == text


def brute(rows):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    out = []
    for conv in {r[0] for r in rows}:
        turns = [(r[1] is None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        turns.sort(key=lambda t: t[:3])
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        chars = sum(len(TEMPLATE.render(t[2], t[3])[0]) for t in turns)
        out.append((conv, len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss), chars))
    return sorted(out, key=str)


def found(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], TYPES).repartition(parts)
    pieces = saved(format_turns(df, **options), "pieces")
    return sorted(map(tuple, read_back(pieces).collect()), key=str), pieces


def conversations(n, most, seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.randint(1, most)):
            text = "".join(draw.choices([*EVERY, "\\", "word ", "é", "😀", "\n"], k=draw.randint(0, 30)))
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "tool", None]), draw.choice([text, text, None])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1 << 20, 50])
def test_equals_brute_force(spark, most):
    rows = conversations(40, 12, 1)
    got, _ = found(spark, rows, most=most)
    assert got == brute(rows)


def test_hot_conversation_is_split_over_tasks(spark):
    rows = conversations(20, 4, 2) + [(1000, turn, ("user", "assistant")[turn % 2], f"{turn} " * 40) for turn in range(3000)]
    got, pieces = found(spark, rows, most=4000)
    assert got == brute(rows)
    hot = pieces.where("conv_id = 1000").collect()
    assert len(hot) > 20 and max(len(r.formatted) for r in hot) < 5000
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], TYPES).repartition(3)
    shares = format_turns(df).selectExpr("conv_id", "spark_partition_id() as p").where("conv_id = 1000").distinct().collect()
    assert len(shares) > 1


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, 1, "user", "a"), (None, 0, "assistant", None), (1, None, "user", "last"), (1, 5, None, "x"), (1, 5, "assistant", "y"),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "same"), (3, 0, "</s>", "odd role"), (4, 0, None, None),
    ]
    got, _ = found(spark, rows)
    assert got == brute(rows)


def test_loss_mask_covers_assistants_only(spark):
    _, pieces = found(spark, [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "yo </s>"), (1, 2, "assistant", "!")])
    (row,) = pieces.collect()
    assert [row.formatted[s.start : s.end] for s in row.loss] == ["yo \\</s>", "!"]


def test_empty_table(spark):
    assert found(spark, [])[0] == []


def test_hostile_conversation(spark):
    (row,) = read_back(saved(format_turns(hostile_rows(spark)), "pieces")).collect()
    assert row.conv_id == -7 and row.n_turns == 2 and row.loss_chars == len(HOSTILE)
    assert row.loss_sha256 == hashlib.sha256(HOSTILE.encode()).hexdigest()
