import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import chat_format as chat

FOLDER = "/root/testdata/sf0.001"
TEXTS = st.lists(st.sampled_from([*"a#\\</turn> :\n=é\U0001d518", "### ", "</turn>", "\\### User: "]), max_size=20).map("".join)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "System", ""]), TEXTS), TEXTS), max_size=5))
def test_template_can_be_read_back(said):
    shown = [chat.rendered(role, text) for role, text in said]
    assert list(chat.turns("".join(s[0] for s in shown))) == said
    for (_, text), (turn, start, end) in zip(said, shown):
        assert chat.unescape(turn[start:end]) == text
        # Inside a text, control strings stand behind a backslash only.
        bare = re.sub(r"\\.", "_", chat.escape(text), flags=re.DOTALL)
        assert "### " not in bare and "</turn>" not in bare


def test_what_is_no_turn_is_an_error():
    with pytest.raises(ValueError):
        list(chat.turns("### User: hi</turn>\nmore"))


def brute(rows):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) from rows (conv_id, turn, role, text)."""
    of = {}
    for r in rows:
        of.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    out = []
    for conv, said in of.items():
        said = sorted(said, key=lambda s: (s[:3], hashlib.md5(s[3].encode()).hexdigest()))
        loss = "".join(text for _, _, role, text in said if role == "assistant")
        out.append((conv, len(said), digest("".join(f"{role}\n{text}\n" for _, _, role, text in said)), len(loss), digest(loss)))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark):
    got = chat.op13_chat_formatting(spark, FOLDER)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    trial = spark.createDataFrame([(-7, k, r, "\\### Assistant: </turn> ok") for k, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select(*trial.columns).unionByName(trial).collect()
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(rows)


def test_events(spark):
    """Deltas add, an edit replaces, a regeneration begins anew, whatever order and however often they come."""
    log = [
        (1, 0, "m", 0, "start", "user", "hel"), (1, 0, "m", 1, "delta", None, "lo"), (1, 1, "n", 7, "start", "assistant", None),
        (1, 1, "n", 8, "delta", None, "bad"), (1, 1, "n", 9, "regenerate", None, None), (1, 1, "n", 10, "delta", None, "go"), (1, 1, "n", 11, "delta", None, "od"),
        (1, 2, "o", 12, "start", "user", "typo"), (1, 2, "o", 13, "edit", None, "fixed"), (1, 2, "o", 14, "delta", None, "!"), (1, 2, "o", 15, "seen", None, "?"),
        (1, 3, "p", 16, "delta", None, "never started"),
    ]
    frame = spark.createDataFrame([*log[::-1], log[1], log[5]], chat.LOG)
    [row] = chat.format_log(frame).collect()
    assert list(chat.turns(row.formatted)) == [("user", "hello"), ("assistant", "good"), ("user", "fixed!")]
    assert [row.formatted[s.start : s.end] for s in row.loss] == ["good"] and row.n_turns == 3


def test_long_conversations_come_in_segments(spark):
    rows = spark.range(2500).selectExpr("CASE WHEN id < 2400 THEN 5 ELSE id % 3 END AS conv_id", "id AS turn", "CASE WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('## ### say ', id) AS text")
    made = chat.format_log(chat.log_of(rows))
    assert {(r.segment, r.n_turns) for r in made.where("conv_id = 5").collect()} == {(0, 1024), (1, 1024), (2, 352)}
    assert sorted((tuple(r)[:5] for r in chat.read_back(made).collect()), key=repr) == brute(rows.collect())


def test_awkward_rows(spark):
    long = "word ### </turn> \\ " * 30_000
    rows = [
        (1, 0, "user", None), (1, 1, None, "a"), (1, 1, None, "a"), (1, None, "assistant", "b"), (None, 0, "user", "c"), (None, None, None, None), (2, 5, "assistant", long),
        (2, 5, "assistant", ""), (3, -4, "\\odd: role\n### ", "\U0001d518 é"), (3, -2000, "tool", "x"), (4, 0, "user", "no answer"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("seq", "kind", "message", "segment", "formatted"):
        frame = frame.withColumn(name, frame["role"])
    got = chat.read_back(chat.format_log(chat.log_of(frame)))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(frame.collect())
    assert chat.read_back(chat.format_log(chat.log_of(frame.where("conv_id = 99")))).count() == 0
