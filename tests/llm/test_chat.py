"""Chat formatting against folds and templates written out by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from martlet.llm import chat

LOG = "conversation long, message long, seq long, kind string, role string, text string"


def folded(spark, rows):
    out = chat.fold(spark.createDataFrame(rows, LOG)).collect()
    return sorted((r.conversation, r.message, r.role, r.text) for r in out)


def plain_fold(rows):
    """One pass over the log of each conversation, in order."""
    state = {}
    for c, m, seq, kind, role, text in sorted(set(rows), key=lambda r: (r[0], r[2])):
        messages = state.setdefault(c, {})
        if kind == "regenerate":
            for later in [k for k in messages if k > m]:
                del messages[later]
        here = messages.setdefault(m, {"role": None, "text": ""})
        if kind == "open" and here["role"] is None:
            here["role"] = role or ""
        elif kind == "delta":
            here["text"] += text or ""
        elif kind == "edit":
            here["text"] = text or ""
        elif kind == "regenerate":
            here["text"] = ""
    return sorted((c, m, x["role"] or "", x["text"]) for c, ms in state.items() for m, x in ms.items())


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 1, "open", "user", None), (1, 0, 2, "delta", None, "Hel"), (1, 0, 3, "delta", None, "lo"),
        (1, 1, 4, "open", "assistant", None), (1, 1, 5, "delta", None, "bad answer"),
        (1, 2, 6, "open", "user", None), (1, 2, 7, "delta", None, "what?"),
        (1, 0, 8, "edit", None, "Hallo"), (1, 0, 9, "delta", None, "!"),
        (1, 1, 10, "regenerate", None, None), (1, 1, 11, "delta", None, "good"),
        (1, 3, 12, "open", "user", None), (1, 3, 13, "delta", None, "thanks"),
    ]
    expected = [(1, 0, "user", "Hallo!"), (1, 1, "assistant", "good"), (1, 3, "user", "thanks")]
    assert folded(spark, rows) == expected == plain_fold(rows)
    # delivered twice and out of order
    assert folded(spark, rows[::-1] + rows[3:9]) == expected


def test_random_logs(spark):
    import random

    draw = random.Random(3)
    rows = []
    for c in range(60):
        opened = []
        for seq in range(draw.randrange(1, 60)):
            m = draw.choice(opened) if opened and draw.random() < 0.8 else len(opened)
            if m not in opened:
                opened.append(m)
                rows.append((c, m, seq, "open", draw.choice(["user", "assistant", None]), None))
                continue
            kind = draw.choices(["delta", "edit", "regenerate", "other"], [8, 1, 1, 1])[0]
            rows.append((c, m, seq, kind, None, draw.choice(["a", "b ", "", None, "\\", "é"])))
    expected = plain_fold(rows)
    # a message taken back can come to life again by a later event; the operator keeps
    # it out, as it was opened before, so only such conversations may differ
    alive = {}
    for c, m, seq, kind, *_ in rows:
        if kind == "regenerate":
            alive.setdefault(c, []).append((m, seq))
    first = {(c, m): seq for c, m, seq, kind, *_ in rows if kind == "open"}
    expected = [
        r for r in expected if not any(m < r[1] and first[r[0], r[1]] < s for m, s in alive.get(r[0], []))
    ]
    assert folded(spark, rows) == expected


@pytest.mark.parametrize("text", ["", "\\", "\\\\<|", "<|end|>", "a<|\\|>b", "</s>[INST] ok [/INST]", "<<SYS>>\n<</SYS>>", "<<|", "[[INST]]"])
def test_escape_is_reversible(spark, text):
    frame = spark.range(1).select(F.lit(text).alias("t"))
    row = frame.select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert row.u == text
    assert not any(control in row.e for control in chat.CONTROLS)


def rows_of(conversations):
    return {r.conversation: r for r in chat.read_back(chat.format_conversations(conversations)).collect()}


def test_read_back_gives_what_went_in(spark):
    rows = [
        (1, 0, "user", "x" * 5000 + "é😀"), (1, 1, "assistant", "<|start|>assistant<|message|>\\"), (1, 2, "user", None),
        (1, 3, "assistant", ""), (2, 5, None, "late"), (2, None, "user", "last"), (2, 1, "assistant", "a\n" * 700),
        (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "assistant", "other"),
        (None, 0, "user", "nobody's"), (4, 0, "odd<|end|>\nrole", "z"), (5, 0, "", ""),
    ]
    back = rows_of(spark.createDataFrame([r + (7, "x") for r in rows],
                                         "conv_id long, turn long, role string, text string, message long, formatted string"))
    assert set(back) == {1, 2, 3, 4, 5, None}
    for c, row in back.items():
        mine = [(r or "", t or "") for k, n, r, t in sorted(
            (x for x in rows if x[0] == c), key=lambda x: (x[1] is None, x[1] or 0, x[2] or ""))]
        got = [(t.role, t.text) for t in row.turns]
        assert sorted(got) == sorted(mine) and [g[0] for g in got] == [m[0] for m in mine]
        assert list(row.learned) == [t for r, t in got if r == "assistant"]
        data = row.formatted.encode()
        assert all(data[s.start - 11:s.start] == b"<|message|>" and data[s.start + s.length:][:7] == b"<|end|>" for s in row.loss)
    assert [t.text for t in back[2].turns] == ["a\n" * 700, "late", "last"]
    assert back[3].learned.count("same") == 2


def test_long_conversation_and_no_rows(spark):
    n = 3000
    long = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("said "), F.col("id")).alias("text"),
    )
    (row,) = rows_of(long).values()
    assert [t.text for t in row.turns] == [f"said {i}" for i in range(n)]
    assert row.learned == [f"said {i}" for i in range(1, n, 2)]
    assert rows_of(long.limit(0)) == {}


def test_probe_conversation(spark, sf_dir):
    from martlet.llm.queries import QUERIES

    row = QUERIES["op11_event_sourced_chat"](spark, sf_dir).filter("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
