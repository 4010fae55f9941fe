"""Chat formatting against plain Python: examples, masks, and texts full of control strings."""

import hashlib
import random
import re

import pytest

from seriesguard.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string, turns int"


def escaped(text):
    return re.sub(r"([\[<])(\\*)(/?(?:INST|SYS|ROLE|SAYS|s)[\]>])", r"\1\2\\\3", text)


def piece(role, text):
    if role in chat.TEMPLATE:
        before, behind = chat.TEMPLATE[role]
        return before + escaped(text) + behind
    return f"[ROLE] {escaped(role)} [SAYS] {escaped(text)} [/ROLE]"


def talks(rows):
    """Conversations with ordered turns, as (id, [(role, text)])."""
    none = lambda v: (v is not None, v if v is not None else 0)
    word = lambda v: (v is not None, (v or "").encode())
    out = {}
    for k, r in enumerate(rows):
        out.setdefault(("lone", k) if r[0] is None else ("id", r[0]), []).append(r)
    for key, turns in out.items():
        turns.sort(key=lambda r: (none(r[1]), word(r[2]), word(r[3])))
        yield (None if key[0] == "lone" else key[1]), [(r[2] or "", r[3] or "") for r in turns]


def examples_of(turns):
    ends = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
    if turns[-1][0] != "assistant":
        ends.append(len(turns) - 1)
    for k, i in enumerate(ends):
        text = "".join(piece(*t) for t in turns[:i + 1])
        reply = turns[i][0] == "assistant"
        start = len(text) - len(piece(*turns[i])) + 3 if reply else len(text)
        yield k, i + 1, text, start, len(text) - 4 if reply else len(text)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    marks = ["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/SYS]", "[ROLE]", "[SAYS]", "[/ROLE]", "[", "<", "\\", "/", "s>", "]", " ", "\n",
             "ok", "É", "\U0001f600", "[\\INST]", "<\\\\/s>", "$1", "[/SAYS>"]
    text = lambda: r.choice([None, "", "".join(r.choices(marks, k=r.choice([1, 3, 12, 60])))])
    roles = ["user", "assistant", "system", "tool", "", None, "[SAYS] x", "User"]
    out = [(c, t, r.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], text(), "x", 3) for c in range(40) for t in range(r.choice([1, 2, 5, 9]))]
    out += [(50, None, "user", "b", "x", 3), (50, None, "user", "a", "x", 3), (50, 1, "assistant", "c", "x", 3), (50, 1, "assistant", "c", "x", 3)]
    out += [(None, 1, "user", "q", "x", 3), (None, 2, "assistant", "</s>", "x", 3), (None, None, None, None, "x", 3)]
    return out + [(60, t, "assistant" if t % 2 else "user", "long " * 20_000, "x", 3) for t in range(4)]


def test_examples_equal_plain_python(spark, rows):
    found = chat.prefix_examples(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(c, *e) for c, turns in talks(rows) for e in examples_of(turns)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_read_back_equals_the_conversations(spark, rows):
    found = chat.read_back(spark.createDataFrame(rows, SCHEMA)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c, turns in talks(rows):
        loss = "".join(t for role, t in turns if role == "assistant")
        want.append((c, len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss),
                     sum(len(e[2]) for e in examples_of(turns))))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_texts_without_control_strings_stay_as_they_are(spark):
    df = spark.createDataFrame([("a [b] <i> \\ [ INST ]",), ("[INST]",), ("",)], "t string")
    from pyspark.sql import functions as F

    got = [tuple(r) for r in df.select(chat.escape(F.col("t")), chat.unescape(chat.escape(F.col("t")))).collect()]
    assert got == [("a [b] <i> \\ [ INST ]",) * 2, ("[\\INST]", "[INST]"), ("", "")]


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.prefix_examples(none).count() == 0
    assert chat.read_back(none).count() == 0


def test_turns_are_dealt_out_once_and_no_python(spark, rows):
    """Examples are expanded and read back where the turns lie: expanded texts are never shuffled."""
    df = chat.read_back(spark.createDataFrame(rows, SCHEMA).repartition(3).where("conv_id > 0"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan
