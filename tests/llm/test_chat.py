import hashlib
import random

from gridweave.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string, segments int"
NASTY = ["\\", "\\\\", "###", "####", "##", "</turn>", " </turn>\n", "### Assistant: x", "\\h", "\\s", "\\e", "\\se", "<", ":", "\n", "", "é漢", "### User: </turn>\n### Assistant: y", "\\### Assistant: </turn> ok"]


def rows(seed=1, n=40):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randint(1, 7)):
            text = None if rng.random() < 0.05 else "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
            out.append((c, t, rng.choice(["user", "assistant", "system", "to:ol", "User", "###", None]) if rng.random() < 0.3 else ["user", "assistant"][t % 2], text, "c", 1))
    return out


def test_read_back_is_what_went_in(spark):
    data = rows()
    out = chat.formatted(spark.createDataFrame(data, SCHEMA).repartition(5))
    got = {r["conv_id"]: r for r in chat.digests(out).collect()}
    by = {}
    for c, t, role, text, *_ in data:
        by.setdefault(c, []).append((t, role or "", text or ""))
    text = {r["conv_id"]: r["formatted"] for r in out.collect()}
    for c, turns in by.items():
        turns.sort()
        own = got[c]
        assert own["n_turns"] == len(turns)
        assert own["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (own["loss_chars"], own["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert own["formatted_chars"] == len(text[c])
        assert text[c].count(" </turn>\n") == len(turns)


def test_order_of_roles(spark):
    cases = {
        ("user", "assistant"): None,
        ("system", "user", "assistant"): None,
        ("user", "assistant", "user", "assistant"): None,
        ("assistant", "user"): 0,
        ("user", "user", "assistant"): 1,
        ("user", "assistant", "system"): 2,
        ("user",): 1,
        ("user", "tool", "assistant"): 1,
        ("system",): 1,
        ("",): 0,
    }
    data = [(c, t, role, "x", "", 1) for c, roles in enumerate(cases) for t, role in enumerate(roles)]
    got = {r["conv_id"]: (r["fault"], r["valid"]) for r in chat.formatted(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {c: (fault, fault is None) for c, fault in enumerate(cases.values())}


def test_odd_tables(spark):
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
    data = [(1, 0, "user", "b", "", 1), (1, 0, "user", "a", "", 1), (1, 0, "user", "a", "", 1), (None, None, None, None, "", 1), (2, 0, "user", "x" * 300_000, "", 1)]
    got = {r["conv_id"]: r["formatted"] for r in chat.formatted(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[1] == "### User: a </turn>\n### User: a </turn>\n### User: b </turn>\n" and got[None] == "### :  </turn>\n" and len(got[2]) > 300_000


def test_other_templates(spark):
    template = chat.Template(learnt=("assistant", "user"), names={})
    out = chat.formatted(spark.createDataFrame([(1, 0, "us:er", "q", "", 1), (1, 1, "assistant", "a", "", 1)], SCHEMA), template)
    assert out.first()["formatted"] == "### us\\cer: q </turn>\n### assistant: a </turn>\n"
    assert [(s["text"], s["loss"]) for s in out.first()["segments"] if s["loss"]] == [("a", True)]


def test_plan_has_no_python(spark):
    plan = chat.digests(chat.formatted(spark.createDataFrame(rows(), SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
