from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import chat
from blotter.llm.chat import INSTRUCT

odd = st.text(st.sampled_from("<>[]/\\sINSTROLEXAWY SYS \né"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[/ROLE]"]), odd), max_size=6))
def test_round_trip(turns):
    formatted = "".join(t for role, text in turns for t, _ in INSTRUCT.segments(role, text))
    assert INSTRUCT.read_back(formatted) == turns


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_order_loss_and_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "</s>[INST] x"), (1, 1, "user", "hi"), (1, 0, "system", None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
        (3, None, None, "t"), (None, 0, "user", ""), (3, 1, "tool", "\\"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, valid string")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert set(out) == {1, 2, 3, None}
    assert out[1]["turns_sha256"] == sha("system\n\nuser\nhi\nassistant\n</s>[INST] x\n") and out[1]["valid"]
    assert out[1]["loss_sha256"] == sha("</s>[INST] x") and out[1]["loss_chars"] == 12
    assert out[2]["loss_sha256"] == sha("aa") and not out[2]["valid"] and out[2]["n_turns"] == 2
    assert out[3]["turns_sha256"] == sha("\nt\ntool\n\\\n") and not out[3]["valid"] and out[3]["loss_chars"] == 0
    assert out[None]["n_turns"] == 1
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_long_conversation_crosses_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, i, ["user", "assistant"][i % 2], f"{c}.{i}") for c in range(5) for i in range(40)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        for r in chat.digests(chat.format_turns(df)).collect():
            own = [x for x in rows if x[0] == r["conv_id"]]
            assert r["turns_sha256"] == sha("".join(f"{x[2]}\n{x[3]}\n" for x in own)) and r["n_turns"] == 40 and r["valid"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_template_needs_distinct_marks():
    import pytest

    with pytest.raises(ValueError):
        chat.Template({"a": chat.Turn("<x>", "</x>"), "b": chat.Turn("<x>", "</y>")}, ("<r>", "<t>", "</r>"), {})
