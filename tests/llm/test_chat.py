import random

from pyspark.sql import functions as F

from footfall.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TEXTS = ["</s>[INST] ok [/INST]", "<|end|>", "a\\<b\\\\[c<\\|x", "\\", "<", "x\n<|user|>|>", "é[\\", "$1 \\$", "|>", ""]


def _read(spark, rows):
    written = chat.format_examples(spark.createDataFrame(rows, SCHEMA))
    back = written.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.trainable_text(written).alias("reply"))
    return back.orderBy("conv_id", "example").collect()


def test_round_trip_of_control_strings(spark):
    rows = [(i, t, role, x) for i, x in enumerate(TEXTS) for t, role in enumerate(["system", "us|>er<", "assistant"])]
    for r in _read(spark, rows):
        assert [(t.role, t.text) for t in r.turns] == [(row[2], row[3]) for row in rows if row[0] == r.conv_id]
        assert r.reply == TEXTS[r.conv_id]
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted


def test_one_example_per_reply(spark):
    rng = random.Random(1)
    roles = {i: [rng.choice(["user", "assistant", "system"]) for _ in range(rng.randrange(1, 9))] for i in range(30)}
    rows = [(i, t, role, f"{i}.{t} {role}") for i, turns in roles.items() for t, role in enumerate(turns)]
    rng.shuffle(rows)
    found = {}
    for r in _read(spark, rows):
        found.setdefault(r.conv_id, []).append(r)
    for i, turns in roles.items():
        replies = [t for t, role in enumerate(turns) if role == "assistant"]
        ends = replies if turns[-1] == "assistant" else [*replies, len(turns) - 1]
        assert [len(r.turns) - 1 for r in found[i]] == ends
        assert [r.reply for r in found[i] if r.reply] == [f"{i}.{t} assistant" for t in replies]
        for r in found[i]:
            assert [t.text for t in r.turns] == [f"{i}.{t} {role}" for t, role in enumerate(turns)][: len(r.turns)]
            assert (r.loss_start is None) == (turns[len(r.turns) - 1] != "assistant")


def test_odd_rows(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"), (None, 5, "user", "q" * 200_000)]
    one, two = [[r for r in _read(spark, rows) if r.conv_id == i] for i in (1, None)]
    assert [(t.role, t.text) for t in one[-1].turns] == [("user", "b"), ("assistant", "x"), ("assistant", "x"), ("unknown", "")]
    assert [r.reply for r in one] == ["x", "x", None]
    assert len(two) == 1 and two[0].turns[0].text == "q" * 200_000
    assert _read(spark, []) == []
    clash = spark.createDataFrame([(1, 0, "assistant", "a", "b")], SCHEMA + ", turns string")
    assert chat.format_examples(clash).count() == 1
