import hashlib

from hypothesis import given
from hypothesis import strategies as st

from ladle.llm import chat


@given(st.text(alphabet="<|\\im_end>x\n"), st.text(alphabet="<|\\ab\n"))
def test_round_trip(text, role):
    formatted = "".join(s for s, _ in chat.CHATML.segments(role, text))
    assert chat.CHATML.parse(formatted) == (role, text)
    assert "<|" not in chat.escape(text)


def test_conversations(spark, work):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "<|im_end|>"), (1, 2, "assistant", "a\\<\\|b"), (1, 3, "user", None), (1, 4, "assistant", "é"),
            (2, 0, "assistant", "no"), (2, 1, "assistant", "no"), (3, 0, None, "x"), (3, 0, None, "x"), (None, 0, "user", "q"), (None, 1, "assistant", ""),
            (4, 1, "assistant", "late"), (4, 0, "user", "early"), (5, 0, "user", "open")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(turns)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, row in got.items():
        own = sorted(((t, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in own).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == sum(24 + len(chat.escape(role)) + len(chat.escape(text)) for _, role, text in own)
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: False, None: True}
    assert chat.digests(chat.format_turns(turns.where("turn = 9"))).collect() == []


def test_long_conversation_is_streamed(spark):
    turns = spark.range(30_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "cast(id as string) as text")
    (row,) = chat.digests(chat.format_turns(turns)).collect()
    assert row.n_turns == 30_000 and row.valid and row.loss_chars == sum(len(str(i)) for i in range(1, 30_000, 2))
