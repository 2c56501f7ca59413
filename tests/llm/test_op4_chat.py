from hypothesis import given, settings, strategies as st

from daymosaic.llm import op4_chat as chat

PIECES = [*"ab<|>/s[INST]␛\n ", "<|over|>", "<|turn|>", "</s>", "[/INST]", "␛1", "␛0"]
ALPHABET = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ALPHABET, ALPHABET), max_size=4))
def test_formatting_can_be_read_back(turns):
    breaker = chat.DEFAULT.breaker()
    segments = chat.emit(turns, chat.DEFAULT, breaker)
    assert chat.read_back("".join(t for t, _ in segments)) == turns
    for role, text in turns:
        assert not any(c in chat.escape(text, breaker) for c in chat.DEFAULT.control())


def test_state_machine():
    ok = lambda *roles: chat.accepted(list(roles), chat.DEFAULT)
    assert ok("system", "user", "assistant") == (3, True) and ok("user", "assistant", "user") == (3, False)
    assert ok("assistant") == (0, False) and ok("user", "user") == (1, False) and ok() == (0, False)


def test_awkward_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, None, "tool", "x"), (None, 0, None, "y"),
            (2, 0, "user", "q " * 20_000), (2, 1, "assistant", "[INST]<|says|>"), (3, 0, "user", "twice"), (3, 0, "user", "twice")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, valid string")
    out = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert chat.read_back(out[1]["formatted"]) == [("tool", "x"), ("user", ""), ("assistant", ""), ("assistant", "b")]
    assert chat.read_back(out[None]["formatted"]) == [("", "y")] and not out[1]["valid"] and out[2]["valid"]
    assert out[3]["accepted_turns"] == 1 and len(chat.read_back(out[3]["formatted"])) == 2
    for r in out.values():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert [chat.unescape(s["text"]) for s in out[2]["segments"] if s["loss"]] == ["[INST]<|says|>"]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_own_template(spark):
    own = chat.Template("[[", "]]", ";\n", (("", ("a",)), ("a", ("b",)), ("b", ())), ("b",), ("a", "b"), ("##",))
    df = spark.createDataFrame([(1, 0, "a", "x##[[y"), (1, 1, "b", "z;")], "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_chats(df, own).first()
    assert row["valid"] and chat.read_back(row["formatted"], own) == [("a", "x##[[y"), ("b", "z;")]
    assert sum(s["loss"] for s in row["segments"]) == 2
