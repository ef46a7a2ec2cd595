import hashlib

import pytest
from pyspark.sql import functions as F

from patronage.llm import chat_format as cf
from patronage.llm import queries
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"
NASTY = ["</s>[INST] ok [/INST]", "<\\s><\\\\/s>[\\INST]\\", "<<s>[[INST]<image>", "", None, "<s", "\\<s>\\", "日本<audio>é", "x" * 300_000]


def test_query_matches_sql(spark):
    assert_same(queries.op3_chat_formatting(spark, SF_DIR), connect(SF_DIR), queries.OP3_SQL)


def test_control_conversation(spark):
    row = queries.op3_chat_formatting(spark, SF_DIR).filter("conv_id = -1").first()
    text = queries.CONTROL_TEXT
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text) and row.n_turns == 2
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def messages(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, start int, loss int")
    return df.select("conv_id", "turn", "role", cf.text_parts(F.col("text")).alias("parts"), "start", "loss")


def test_escape_round_trip_of_control_strings(spark):
    rows = [(i, t, role, text, 0, 0) for i in range(3) for t, (role, text) in enumerate((r, x) for x in NASTY for r in ("user", "assistant", "<s>", None))]
    out = cf.format_conversations(messages(spark, rows))
    digest = cf.digests(out).orderBy("conv_id").collect()
    want = "".join(f"{role or ''}\n{text or ''}\n" for i, _, role, text, _, _ in rows if i == 0)
    said = "".join(text or "" for i, _, role, text, _, _ in rows if i == 0 and role == "assistant")
    for row in digest:
        assert row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.loss_chars == len(said)
    formatted = out.first().formatted
    assert formatted.count("</s>") == formatted.count("[INST]") == formatted.count("[/INST]") == len(NASTY) * 4 and formatted.count("<s>") == 1


def test_parts_leave_placeholders_and_attachments(spark):
    part = lambda kind, **x: (kind, *(x.get(k) for k in ("text", "ref", "width", "height", "seconds", "pages")))
    parts = [part("text", text="see <image>:"), part("image", ref="i.png", width=28, height=15), part("audio", ref="a.wav", seconds=1.5),
             part("document", ref="d.pdf", pages=3), part(None, ref="?"), part("text")]
    rows = [(7, 0, "user", parts), (7, 1, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{cf.PART}>")
    row = cf.format_conversations(df).first()
    assert row.formatted == "<s>[INST]user[/INST]see <\\image>:<image><audio><document><document></s>[INST]assistant[/INST]</s>"
    assert [(a.type, a.ref, a.tokens) for a in row.attachments] == [("image", "i.png", 4), ("audio", "a.wav", 38), ("document", "d.pdf", 768), ("document", "?", 0)]
    marks = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
    assert all(row.formatted[a.start :].startswith(marks[a.type]) for a in row.attachments) and row.expanded_tokens == 810
    assert [(s.start, s.length) for s in row.loss] == [(len(row.formatted) - 4, 0)]


def test_ties_nulls_and_empty_table(spark):
    rows = [(1, 0, "user", "b", 0, 0), (1, 0, "user", "b", 0, 0), (1, 0, "assistant", "c", 0, 0), (None, None, None, None, 0, 0), (None, 1, "user", "z", 0, 0)]
    got = {r.conv_id: r for r in cf.format_conversations(messages(spark, rows)).collect()}
    assert got[1].formatted == "<s>[INST]assistant[/INST]c</s>[INST]user[/INST]b</s>[INST]user[/INST]b</s>"
    assert got[None].formatted == "<s>[INST][/INST]</s>[INST]user[/INST]z</s>"
    assert cf.digests(cf.format_conversations(messages(spark, rows[:0]))).count() == 0


def test_template_must_be_escapable():
    with pytest.raises(ValueError):
        cf.Template(head="[<x")
    with pytest.raises(ValueError):
        cf.Template(head="<s>")
