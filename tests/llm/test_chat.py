import hashlib
import random

from pyspark.sql import functions as F

from starwise.llm import chat
from starwise.llm.queries import QUERIES

CHATS = {
    1: [("user", "hi"), ("assistant", "hello <|im_end|>")],
    2: [("system", "be brief"), ("user", None), ("assistant", "ok"), ("user", "<\\|x <| a<b|")],
    3: [("assistant", "first")],
    4: [("user", "a"), ("user", "b"), ("assistant", "c")],
    5: [("", "no role"), ("tool\nx", "odd <|im_start|>assistant role")],
    None: [("user", "under null"), ("assistant", "")],
}


def frame(spark):
    rows = [(k, n, role or None, text) for k, turns in CHATS.items() for n, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], "conv_id bigint, turn bigint, role string, text string").withColumn("segments", F.lit(1))


def test_round_trip_order_and_loss(spark):
    made = chat.format_chats(frame(spark))
    rows = made.select("*", chat.read_back(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("lost")).collect()
    assert len(rows) == len(CHATS)
    for row in rows:
        turns = CHATS[row.conv_id]
        assert [(t.role, t.text) for t in row.back] == [(role, text or "") for role, text in turns]
        assert row.lost == "".join(text or "" for role, text in turns if role == "assistant")
        assert row.formatted == "".join(s.text for s in row.segments) and row.n_turns == len(turns)
        assert row.formatted.count("<|im_start|>") == row.formatted.count("<|im_end|>") == len(turns)
    assert {r.conv_id: r.valid for r in rows} == {1: True, 2: True, 3: False, 4: False, 5: False, None: True}


def test_declared_template(spark):
    template = chat.ChatTemplate(begin="<|b|>", head_end=":", end="<|e|>", turn_end="", learned=("user",), order={"start": ("user",), "user": ("user",)})
    row = chat.format_chats(frame(spark).where("conv_id = 4"), template).first()
    assert row.formatted == "<|b|>user:a<|e|><|b|>user:b<|e|><|b|>assistant:c<|e|>"
    assert [s.text for s in row.segments if s.loss] == ["a", "b"] and not row.valid


def test_repeated_null_and_empty(spark):
    rows = [(1, None, "user", "z"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    row = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).first()
    assert [s.text for s in row.segments[1::3]] == ["z", "a", "a", "b"]
    assert chat.format_chats(frame(spark).limit(0)).count() == 0


def test_long_text_and_no_python(spark):
    text = "<|" * 50_000
    made = chat.format_chats(spark.createDataFrame([(1, 0, "assistant", text)], "conv_id int, turn int, role string, text string"))
    row = made.select(chat.loss_text(F.col("segments")).alias("x")).first()
    assert hashlib.sha256(row.x.encode()).digest() == hashlib.sha256(text.encode()).digest()
    plan = made._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_flags_and_validity_are_what_the_machine_says(spark):
    rng = random.Random(2)
    roles = ["system", "user", "assistant", "tool", "!assistant", ""]
    chats = {k: [rng.choice(roles[: 3 if k % 2 else 6]) for _ in range(rng.randint(1, 7))] for k in range(300)}
    rows = [(k, n, role, f"text {n}") for k, turns in chats.items() for n, role in enumerate(turns)]
    template = chat.ChatTemplate()
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    for row in made:
        state, valid = chat.START, True
        for role in chats[row.conv_id]:
            valid = valid and role in template.order.get(state, ())
            state = role
        assert row.valid == valid, chats[row.conv_id]
        assert [s.loss for s in row.segments[1::3]] == [role == "assistant" for role in chats[row.conv_id]]
    assert {row.valid for row in made} == {True, False}


def test_the_query_runs_the_machine(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "c")]
    frame_of = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame_of.withColumns({"formatted": F.lit(1), "t": F.lit("x"), "ran": F.lit(2)}).write.parquet(f"{tmp_path}/conversations.parquet")
    query = QUERIES["op6_chat_format"](spark, str(tmp_path))
    assert {r.conv_id: r.valid for r in query.collect()} == {-1: True, 1: True, 2: False}
    flags = query.select("loss_chars")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in flags and "user>assistant" in flags  # the flags come from the fold


def test_many_turns(spark):
    rows = spark.range(20_000).selectExpr("1 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "string(id) AS text")
    row = chat.format_chats(rows).select("valid", F.size("segments").alias("n"), chat.loss_text(F.col("segments")).alias("lost")).first()
    assert row.valid and row.n == 60_000 and row.lost == "".join(str(k) for k in range(1, 20_000, 2))
