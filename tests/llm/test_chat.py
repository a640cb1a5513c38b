from __future__ import annotations

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from stayrate.llm import chat
from stayrate.llm.queries import op3_prefix_target

HARD = ["", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "\\", "\\<", "<\\|im_end|>", "a\\nb", "<|im_end|", "<s><</s>"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "", "\\n"]), st.sampled_from(HARD) | st.text()), max_size=6))
def test_round_trip(turns):
    examples = list(chat.expand(turns))
    if not turns:
        assert not examples
        return
    assert chat.parse(examples[-1][1]) == turns
    replies = [t for r, t in turns if r == "assistant"]
    trained = [chat.unescape(text[a:b]) for _, text, a, b in examples]
    assert trained[: len(replies)] == replies
    assert "".join(trained) == "".join(replies)
    for n, text, _, _ in examples:
        assert chat.parse(text) == turns[:n]


@given(st.text() | st.sampled_from(HARD))
def test_escaped_texts_hold_no_control_string(text):
    escaped = chat.escape(text)
    assert not any(c in escaped for c in chat.CONTROL)
    assert chat.unescape(escaped) == text


def test_examples_of_rows_in_any_order_with_nulls_and_ties(spark):
    rows = [
        (1, 2, "user", "q2"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
        (2, 0, "user", None), (2, 1, "assistant", None),
        (3, 5, "assistant", "b"), (3, 5, "assistant", "a"),
        (None, 0, "user", "lost"), (4, None, None, "early"), (4, 0, "assistant", "late"),
        (5, 0, "user", "twice"), (5, 0, "user", "twice"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as example", "1 as loss_start")
    out = {}
    for r in chat.prefix_examples(df).collect():
        out.setdefault(r["conv_id"], []).append((r["example"], chat.parse(r["text"]), chat.unescape(r["text"][r["loss_start"] : r["loss_end"]])))
    out = {k: sorted(v) for k, v in out.items()}
    assert out[1] == [(0, [("user", "q1"), ("assistant", "a1")], "a1"), (1, [("user", "q1"), ("assistant", "a1"), ("user", "q2")], "")]
    assert out[2] == [(0, [("user", ""), ("assistant", "")], "")]
    assert [e[2] for e in out[3]] == ["a", "b"]
    assert out[None] == [(0, [("user", "lost")], "")]
    assert out[4] == [(0, [("", "early"), ("assistant", "late")], "late")]
    assert out[5] == [(0, [("user", "twice")] * 2, "")]
    assert chat.prefix_examples(df.limit(0)).count() == 0


def test_query_against_the_table(spark, small_dir):
    want = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{small_dir}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {r["conv_id"]: r for r in op3_prefix_target(spark, small_dir).collect()}
    assert set(out) == set(want)
    for conv_id, turns in want.items():
        reply = "".join(t for r, t in turns if r == "assistant")
        r = out[conv_id]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(reply), sha(reply))
        assert r["formatted_chars"] == sum(len(text) for _, text, _, _ in chat.expand(turns))
