import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import chat

_PARTS = st.sampled_from(["#", "##", "###", "### ", "\\", "</turn>", "<", "/", "\n", ": ", ":", "a", "assistant", "é"])
_TEXT = st.one_of(st.lists(_PARTS, max_size=8).map("".join), st.text(max_size=12))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), _TEXT), _TEXT), max_size=5))
def test_reading_back_gives_the_turns(turns):
    text, mask = chat.formatted(turns)
    assert chat.read_turns(text) == turns
    said = [chat.unescaped(text[a:b]) for a, b in mask]
    assert said == [t for role, t in turns if role == "assistant"]


def test_layouts_by_fingerprint():
    layouts = chat.known_layouts()
    said = [("user", "q"), ("assistant", "a")]
    for record, turns in (
        ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, said),
        ({"messages": []}, []),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, said),
        ({"prompt": "q", "completion": "a"}, said),
        ({"response": "a", "prompt": "q"}, said),
        ({"instruction": "q", "input": "", "output": "a"}, said),
        ({"instruction": "q", "input": "x", "output": "a"}, [("user", "q\n\nx"), ("assistant", "a")]),
        ({"system": "s", "instruction": "q", "output": None}, [("system", "s"), ("user", "q"), ("assistant", "")]),
    ):
        assert chat.turns_of(record, layouts[chat.fingerprint(record)]) == turns
    assert chat.fingerprint({"prompt": 1, "completion": "a"}) not in layouts
    assert chat.fingerprint({"a": {"b": "x"}}) != chat.fingerprint({"a": "x", "b": "x"})


def test_turns_table(spark):
    long = "word " * 30000
    rows = [
        (1, 1, "assistant", "a1", "x"), (1, 0, "user", "q1", "x"), (2, 0, "user", None, "x"), (2, 1, None, "n", "x"),
        (3, 0, "assistant", long, "x"), (None, 0, "user", "who", "x"), (4, 0, "user", "tie b", "x"), (4, 0, "user", "tie a", "x"),
        (5, 0, "user", "same", "x"), (5, 0, "user", "same", "x"), (6, None, "user", "first", "x"), (6, 0, "assistant", "", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    done = chat.format_records(chat.records_of_turns(table))
    got = {r.conv_id: r for r in chat.digests(done).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, role or "", text or "") for c, t, role, text, _ in rows if c == conv)
        )
        every = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == len(loss)
        assert got[conv].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.records_of_turns(table.limit(0)).count() == 0


def test_unknown_and_missing_records_stay(spark):
    rows = [(1, json.dumps({"odd": 1})), (2, None), (3, json.dumps({"prompt": "a", "completion": "b"}))]
    got = {r.conv_id: r for r in chat.format_records(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert got[1].formatted is None and len(got[1].fingerprint) == 16 and got[2].fingerprint is None
    assert got[3].formatted == "### user: a</turn>\n### assistant: b</turn>\n"
