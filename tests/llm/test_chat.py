"""Chat formatting: exact round trips, the machine, and the query's digests."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import clash, odd_texts
from tresoria.llm import chat
from tresoria.llm.chat import CHAT, Reader, Template

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = ["", " ", "\\", "\\\\", "### ", "</turn>", " </turn>\n", "\\### Assistant: </turn> ok", "### User: hi </turn>\n", "<</turn>", "</turn",
          "a\\", "##", "### ### </turn></turn>", "\n", "é🙂 </turn>", ": ", "Role x: "]


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def expected(rows, template=CHAT):
    """The digest row of each conversation, from the turns themselves."""
    out = []
    for conv in sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0)):
        turns = [(r or "", t or "") for _, _, r, t in sorted(
            (x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
        loss = "".join(t for r, t in turns if r in template.learned)
        text = "".join(template.mark(r) + template.escaped(t) + template.close for r, t in turns)
        order = [r for r, _ in turns]
        ok = all(b in template.follows.get(a, ()) for a, b in zip(["", *order], order)) and order[-1] in template.ends
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        out.append((conv, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), ok))
    return out


def odd_rows():
    rng = random.Random(5)
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, "assistant", "first"), (2, 1, "user", "second"), (3, 0, None, "no role"),
            (None, 0, "user", "no id"), (None, 1, "assistant", "no id"), (4, None, "system", "no turn"), (4, 1, "user", "x"), (4, 1, "user", "x"),
            (5, 0, "Assistant", "not the role"), (5, 1, "tool: ### \\", "any role"), (6, 0, "system", "alone"), (7, 0, "user", "a" * 3_000_000),
            (7, 1, "assistant", "</turn>" * 100_000)]
    roles = ["system", "user", "assistant"]
    rows += [(10 + c, t, rng.choice(roles), rng.choice(TRICKY)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(5_000)]
    return rows + [(200 + i, 0, "user", t) for i, (t) in enumerate(x for x in odd_texts() if not isinstance(x, tuple))]


def test_digests_of_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = sorted(expected(rows), key=key)
    made = chat.segments(df)
    assert sorted(map(tuple, chat.read_back(made, arranged=True).collect()), key=key) == want
    # segments in any order, and with extra columns of clashing names
    assert sorted(map(tuple, chat.read_back(made.orderBy(F.rand(1))).collect()), key=key) == want
    wide = clash(df).withColumns({c: F.lit("x") for c in ("segment", "turn_no", "loss", "valid")})
    assert sorted(map(tuple, chat.read_back(chat.segments(wide), arranged=True).collect()), key=key) == want


def test_segments_carry_loss_and_validity(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "</turn>"), (2, 0, "user", "a"), (2, 1, "user", "b")]
    got = chat.segments(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "segment").collect()
    assert "".join(r["text"] for r in got if r["conv_id"] == 1) == (
        "### System: be kind </turn>\n### User: hi </turn>\n### Assistant: \\</turn> </turn>\n")
    assert [(r["segment"], r["text"]) for r in got if r["loss"]] == [(7, "\\</turn>")]
    assert [r["valid"] for r in got if r["segment"] % 3 == 0] == [True, True, True, True, False]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.segments(none).collect() == [] and chat.read_back(chat.segments(none)).collect() == []


def test_another_template(spark):
    t = Template(open="<|", colon="|>", close="<|end|>", end="<|end|>", escape="~", marks={"human": "h", "bot": "b"},
                 learned=frozenset({"bot"}), follows={"": ("human",), "human": ("bot",), "bot": ("human",)}, ends=frozenset({"bot"}))
    rows = [(1, 0, "human", "a~<|b|>"), (1, 1, "bot", "<|end|>"), (2, 0, "bot", "x"), (3, 0, "|>~", "y")]
    got = chat.read_back(chat.segments(spark.createDataFrame(rows, SCHEMA), t), t, arranged=True)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows, t), key=key)


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError):
        Template(close="\n")
    with pytest.raises(ValueError):
        Template(close="\\</turn>", end="\\</turn>")
    with pytest.raises(ValueError):
        Template(close="--", end="--")


pieces = st.lists(st.sampled_from([*TRICKY, "x", "#", "<", "/turn>", "\u2028", "Role "]), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", ""]), pieces), pieces), max_size=5))
def test_round_trip(turns):
    text = "".join(CHAT.mark(r) + CHAT.escaped(t) + CHAT.close for r, t in turns)
    read, end = Reader(CHAT).turns(text)
    assert [(r, t) for r, t, _ in read] == turns and end == len(text)
    assert all(CHAT.unescaped(text[a:b]) == t for _, t, (a, b) in read)
