import pytest
from pyspark.sql import functions as F

from haulgrid.llm.preferences import formatted, preference_examples, rivals

KINDS = "conv_id long, turn long, role string, text string, turns string"
ROWS = [
    (0, 0, "system", "S", ""), (0, 1, "user", "Q", ""), (0, 2, "assistant", "good", ""),
    (1, 0, "system", "S", ""), (1, 1, "user", "Q", ""), (1, 2, "assistant", "bad", ""), (1, 3, "user", "more", ""),
    (1, 3, "user", "more", ""),  # repeated
    (2, 0, "user", None, ""), (2, 1, None, "x", ""), (3, 1, "", "x", ""), (3, 0, "user", "", ""),  # alike throughout
    (4, 0, "user", "a", ""), (5, 0, "user", "b" * 100_000, ""),
    (6, 0, "user", "no partner", ""), (None, 0, "user", "no id", ""),
    (8, None, "user", "first", ""), (8, 0, "assistant", "z", ""), (9, 0, "assistant", "z", ""),
]


def neighbours(turns):
    """Pairs of conversations 2 n and 2 n + 1."""
    ids = turns.where("conv_id is not null").select("conv_id").distinct()
    pairs = ids.groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id")).agg(
        F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id")
    )
    return pairs.where("chosen_id < rejected_id")


def turn(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_prompt_and_completions(spark):
    turns = spark.createDataFrame(ROWS, KINDS)
    found = {r.pair_id: r for r in preference_examples(turns, neighbours(turns)).collect()}
    assert sorted(found) == [0, 1, 2, 4]
    first = found[0]
    assert (first.chosen_id, first.rejected_id, first.n_prompt_turns) == (0, 1, 2)
    assert first.prompt == turn("system", "S") + turn("user", "Q")
    assert [(t.text, t.train) for t in first.chosen] == [(turn("assistant", "good"), True)]
    assert [(t.text, t.n_chars, t.train) for t in first.rejected] == [
        (turn("assistant", "bad"), len(turn("assistant", "bad")), True), (turn("user", "more"), len(turn("user", "more")), False)
    ]
    assert (found[1].n_prompt_turns, found[1].chosen, found[1].rejected) == (2, [], [])
    assert found[2].n_prompt_turns == 0 and found[2].prompt == "" and found[2].rejected[0].n_chars > 100_000
    assert found[4].n_prompt_turns == 0 and [t.train for t in found[4].chosen] == [False, True]


def test_any_pairs_and_none(spark):
    turns = spark.createDataFrame(ROWS, KINDS)
    pairs = spark.createDataFrame([(1, 1, 0), (2, 0, 77), (3, 0, 1)], "pair_id int, chosen_id long, rejected_id long")
    assert sorted(r.pair_id for r in preference_examples(turns, pairs).collect()) == [1, 3]
    assert preference_examples(turns.limit(0), neighbours(turns.limit(0))).count() == 0
    plan = preference_examples(turns, pairs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute(rows):
    """{conv_id: (next id, common turns, chosen rest, rejected rest)}, restated."""
    whole = {}
    for conv_id, at, role, text, *_ in set(rows):
        if conv_id is not None:
            whole.setdefault(conv_id, []).append((at is not None, at or 0, role or "", text or ""))
    whole = {conv_id: [(role, text) for *_, role, text in sorted(turns)] for conv_id, turns in whole.items()}
    ids, out = sorted(whole), {}
    for conv_id, other in zip(ids, ids[1:] + ids[:1]):
        good = whole[conv_id]
        spots = [i for i, (role, _) in enumerate(good) if role == "assistant"]
        answer = next((text for role, text in reversed(whole[other]) if role == "assistant"), "")
        bad = list(good)
        bad[spots[-1] if spots else len(bad):spots[-1] + 1 if spots else len(bad)] = [("assistant", answer)]
        same = 0
        while same < min(len(good), len(bad)) and good[same] == bad[same]:
            same += 1
        out[conv_id] = (other, same, good[same:], bad[same:])
    return out


@pytest.mark.parametrize("rows", [ROWS, ROWS[:3], [(1, 0, "user", "alone", "")], [], [(None, 0, "user", "x", "")]])
def test_every_conversation_meets_the_next_ones_answer(spark, rows):
    found = formatted(rivals(spark.createDataFrame(rows, KINDS))).collect()
    wanted = brute(rows)
    assert len(found) == len(wanted)
    for row in found:
        other, same, good, bad = wanted[row.pair_id]
        assert (row.chosen_id, row.rejected_id, row.n_prompt_turns) == (row.pair_id, other, same)
        assert [t.text for t in row.chosen] == [turn(*t) for t in good]
        assert [t.text for t in row.rejected] == [turn(*t) for t in bad]
        assert [t.train for t in row.rejected] == [role == "assistant" for role, _ in bad]


def test_given_conversations_share_their_prompts(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = formatted(rivals(turns))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    long = {r.conv_id for r in turns.groupBy("conv_id").count().where("count > 1").collect()}
    found = rows.collect()
    assert len(found) == turns.select("conv_id").distinct().count()
    assert all(row.n_prompt_turns > 0 for row in found if row.pair_id in long)
