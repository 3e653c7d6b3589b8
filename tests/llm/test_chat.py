import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.llm import chat

DDL = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int, merged int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL)


def check(spark, rows):
    out = {r.conv_id: r for r in chat.format_conversations(make(spark, rows)).collect()}
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(make(spark, rows))).collect()}
    want = {}
    for c, turn, role, text in rows:
        want.setdefault(c, []).append((turn, role or "", text or ""))
    assert out.keys() == back.keys() == want.keys()
    for c, turns in want.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert [(t.role, t.text) for t in back[c].turns] == [t[1:] for t in turns]
        said = [t[2] for t in turns if t[1] == "assistant"]
        assert back[c].loss_text == "".join(said)
        f = out[c].formatted
        spans = [f[s.start:s.start + s.length] for s in out[c].loss_spans]
        assert len(spans) == len(said)
        for code, raw in ((code, raw) for raw, code in reversed(chat.ESCAPES)):
            spans = [s.replace(code, raw) for s in spans]
        assert spans == said
        raw = f.encode()
        assert [raw[s.start:s.start + s.length] for s in out[c].loss_bytes] == [
            f[s.start:s.start + s.length].encode() for s in out[c].loss_spans]
        merged = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:]))
        assert f.count(chat.END) == f.count(chat.TURN) == merged and f.count(chat.PART) == len(turns) - merged


def test_hard_conversations(spark):
    hard = "\\### Assistant: </turn> ok<part>\\0\\1 é漢\n"
    check(spark, [
        (1, 0, "user", hard), (1, 1, "assistant", hard), (1, 2, "assistant", "more"), (1, 3, "assistant", None), (1, 4, "user", ""),
        (2, 5, "assistant", ""), (2, 1, None, "no role"), (2, 2, "", "empty role"), (2, 3, "odd: ### role</turn>\n", "x"),
        (3, 0, "user", "tie b"), (3, 0, "user", "tie a"), (3, 0, "assistant", "tie"), (3, None, "user", "null turn"),
        (None, 0, "assistant", "null conversation"), (4, 0, "user", "same"), (4, 0, "user", "same"),
        (5, 0, "assistant", "long " * 50_000)])


def test_long_conversation(spark):
    check(spark, [(1, i, "assistant" if i % 3 else "user", f"t{i} \\ <") for i in range(3000)])


def test_empty_table(spark):
    assert chat.format_conversations(make(spark, [])).collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.sampled_from(["user", "assistant", "a:b"]),
                          st.text("\\<#:01 </turn>part\né", max_size=12)), min_size=1, max_size=20))
def test_any_text(spark, rows):
    check(spark, rows)


def test_no_python_in_the_plan(spark):
    plan = chat.read_back(chat.format_conversations(make(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_conversation_minus_seven(spark, sf):
    from ledgerlens.llm.queries import QUERIES
    row = QUERIES["op5_chat_format"](spark, sf).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
