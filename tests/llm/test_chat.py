"""Chat formatting: folds, exact round trips, and hot or odd conversations."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from odflow.llm import chat

SCHEMA = "conv_id long, turn long, seq long, op string, role string, text string, rendered string"
PIECES = ["\\", "\n", "<s>", "</s>", "[INST]", "<|im_start|>", "<|im_end|>", "<", "|", "a", "é", "😀", "[", "<<SYS>>", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES)).map("".join), st.lists(st.sampled_from(PIECES)).map("".join))
def test_round_trip(role, text):
    rendered, start, end = chat.render(role, text)
    assert chat.parse(rendered + rendered) == [(role, text)] * 2
    inner = rendered[len(chat.OPEN):-len(chat.CLOSE) - 1]
    assert not any(control in inner for control in chat.CONTROLS)
    assert chat.unescape(rendered[start:end]) == (text if role == chat.LOSS_ROLE else "")


def rendered_texts(spark, events):
    rows = chat.format_chats(spark.createDataFrame([(*event, "clash") for event in events], SCHEMA)).collect()
    rows.sort(key=lambda r: ((r["conv_id"] is not None, r["conv_id"]), (r["turn"] is not None, r["turn"] or 0), r["message_no"]))
    return [(r["conv_id"], r["turn"], *chat.parse(r["rendered"])[0]) for r in rows]


def test_deltas_edits_and_regenerations_fold_in_sequence(spark):
    events = [(1, 1, 5, "delta", "assistant", "new "), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "assistant", "old"),
              (1, 1, 4, "regenerate", "assistant", None), (1, 1, 6, "delta", "assistant", "text"),
              (1, 0, 0, "message", "user", "first"), (1, 0, 9, "edit", "user", "edited"), (1, 0, 10, "delta", "user", "!"),
              (2, 3, 0, "delta", "user", "opened by a delta")]
    assert rendered_texts(spark, events) == [(1, 0, "user", "edited!"), (1, 1, "assistant", "new text"),
                                             (2, 3, "user", "opened by a delta")]


def test_nulls_repeats_and_an_empty_table(spark):
    events = [(None, None, None, None, None, None), (None, 0, 0, "message", "user", "x"), (3, 0, 0, "message", "user", "same"),
              (3, 0, 0, "message", "user", "same"), (3, 1, 0, "message", "assistant", "long " * 50_000)]
    assert rendered_texts(spark, events) == [(None, None, "", ""), (None, 0, "user", "x"), (3, 0, "user", "same"),
                                             (3, 0, "user", "same"), (3, 1, "assistant", "long " * 50_000)]
    assert rendered_texts(spark, []) == []


def test_digests_of_a_conversation_longer_than_a_run(spark):
    events = [(7, turn, 0, "message", "assistant" if turn % 2 else "user", f"turn {turn} </s>", "c") for turn in range(300)]
    rows = chat.digests(chat.format_chats(spark.createDataFrame(events, SCHEMA), turns_per_run=16)).collect()
    turns = "".join(f"{e[4]}\n{e[5]}\n" for e in events)
    loss = "".join(e[5] for e in events if e[4] == "assistant")
    assert len(rows) == 1 and rows[0]["n_turns"] == 300 and rows[0]["loss_chars"] == len(loss)
    assert rows[0]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert rows[0]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_controls_are_whole_in_the_pattern():
    assert all(re.search(chat._CONTROL, control) for control in chat.CONTROLS)
