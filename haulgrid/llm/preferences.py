"""Preference formatting: pairs of conversations as one prompt and two masked completions.

Where the conversations come without pairs, each is chosen, and rejected against itself with the
last answer of another one: ``rivals`` makes the pairs. They share their turns up to that answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import numbered, stored, table

TRAINED = "assistant"
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order; a repeated row counts once."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    )


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _after(turns: str) -> Column:
    """Turns behind the common prefix: rendered, with length and whether the loss counts them."""
    rest = F.slice(turns, F.col("n_prompt_turns") + 1, F.greatest(F.size(turns) - F.col("n_prompt_turns"), F.lit(0)))
    return F.transform(rest, lambda t: F.struct(
        _rendered(t).alias("text"), F.length(_rendered(t)).alias("n_chars"), (t["role"] == TRAINED).alias("train"),
    ))


def preference_examples(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair: pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected.

    ``turns`` has conv_id, turn, role and text, ``pairs`` has pair_id, chosen_id and rejected_id.
    The prompt is the longest run of turns, from the first, that both conversations have alike in
    role and text, rendered once. chosen and rejected are arrays of the turns after it: rendered
    text, its number of characters, and train, which is true for the assistant's turns only; all
    else is masked. Conversations that are alike throughout have empty completions. Turns are
    ordered by turn, a missing one first, then by role and text; repeated rows count once; a
    missing role or text is empty. Rows without a conv_id, and pairs one of whose conversations
    has no rows, give nothing. A pair is one training example, so its two conversations must fit
    into one row. Other columns are not read.
    """
    whole = _conversations(turns)
    rows = (
        pairs.select("pair_id", "chosen_id", "rejected_id")
        .join(whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("good")), "chosen_id")
        .join(whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("bad")), "rejected_id")
    )
    return formatted(rows)


def formatted(rows: DataFrame) -> DataFrame:
    """The examples of rows (pair_id, chosen_id, rejected_id, good, bad), the latter arrays of turns."""
    alike = F.zip_with("good", "bad", lambda a, b: a.eqNullSafe(b))
    rows = rows.withColumn("first", F.array_position(alike, F.lit(False)).cast("int"))
    rows = rows.withColumn(
        "n_prompt_turns", F.when(F.col("first") > 0, F.col("first") - 1).otherwise(F.size("good"))
    )
    prompt = F.transform(F.slice("good", F.lit(1), F.col("n_prompt_turns")), _rendered)
    return rows.select(
        "pair_id", "chosen_id", "rejected_id", "n_prompt_turns", F.array_join(prompt, "").alias("prompt"),
        _after("good").alias("chosen"), _after("bad").alias("rejected"),
    )


def rivals(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, good, bad): each conversation against another one's answer.

    good is the conversation, bad the same turns with the last assistant's turn replaced by that of
    the next conversation by id; the last one's next is the first. A conversation without an
    assistant's turn gets the other answer at its end; a next one without gives an empty answer.
    pair_id and chosen_id are the conversation's id, rejected_id is the next one's. A conversation
    that is alone is its own next. NULL ids, repeated rows and missing fields are as in
    ``preference_examples``; an empty table gives an empty table.
    """
    whole = _conversations(turns)
    back = F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == TRAINED), F.lit(True)).cast("int")
    last = F.when(back > 0, F.size("turns") - back + 1).otherwise(0)
    whole = stored(whole.withColumn("last", last), "conversations")
    places = stored(numbered(whole.select("conv_id"), ["conv_id"], "conversation-ids"), "conversation-places")
    count = places.agg(F.max("number") + 1).scalar()
    following = places.select(F.col("conv_id").alias("chosen_id"), F.pmod(F.col("number") + 1, count).alias("next"))
    answers = whole.select(
        F.col("conv_id").alias("rejected_id"),
        F.when(F.col("last") > 0, F.element_at("turns", F.col("last"))["text"]).otherwise("").alias("answer"),
    )
    pairs = following.join(
        places.select(F.col("conv_id").alias("rejected_id"), F.col("number").alias("next")), "next"
    ).join(answers, "rejected_id")
    other = F.struct(F.lit(TRAINED).alias("role"), F.col("answer").alias("text"))
    upto = F.when(F.col("last") > 0, F.col("last") - 1).otherwise(F.size("turns"))
    behind = F.slice("turns", upto + 2, F.greatest(F.size("turns") - upto - 1, F.lit(0)))
    return whole.join(pairs, F.col("conv_id") == F.col("chosen_id")).select(
        F.col("conv_id").alias("pair_id"), "chosen_id", "rejected_id", F.col("turns").alias("good"),
        F.concat(F.slice("turns", F.lit(1), upto), F.array(other), behind).alias("bad"),
    )


def _mask(side: str) -> Column:
    return F.array_join(F.transform(side, lambda t: F.when(t["train"], "1").otherwise("0")), "")


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the next one's last answer, the masks as one digit per turn."""
    found = formatted(rivals(table(spark, sf_dir, "conversations")))
    return found.select(
        "pair_id", "chosen_id", "rejected_id", "n_prompt_turns", "prompt",
        F.array_join("chosen.text", "").alias("chosen"), F.array_join("rejected.text", "").alias("rejected"),
        _mask("chosen").alias("chosen_mask"), _mask("rejected").alias("rejected_mask"),
    )


_TEXT = "'<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)"

SQL = f"""
WITH c AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS turns
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), l AS (
  SELECT conv_id, turns, row_number() OVER (ORDER BY conv_id) AS place, count(*) OVER () AS number,
    coalesce(list_max([CASE WHEN turns[i].role = '{TRAINED}' THEN i ELSE 0 END FOR i IN range(1, len(turns) + 1)]), 0) AS last
  FROM c
), j AS (
  SELECT g.conv_id AS pair_id, g.conv_id AS chosen_id, b.conv_id AS rejected_id, g.turns AS good,
    CASE WHEN g.last > 0 THEN g.turns[1:g.last - 1] ELSE g.turns END
      || [{{'role': '{TRAINED}', 'text': CASE WHEN b.last > 0 THEN b.turns[b.last].text ELSE '' END}}]
      || CASE WHEN g.last > 0 THEN g.turns[g.last + 1:] ELSE [] END AS bad
  FROM l g JOIN l b ON b.place = g.place % g.number + 1
), n AS (
  SELECT pair_id, coalesce(min(i) FILTER (WHERE good[i] IS DISTINCT FROM bad[i]) - 1, len(any_value(good))) AS n
  FROM j, unnest(range(1, greatest(len(good), len(bad)) + 1)) AS u(i) GROUP BY pair_id
)
SELECT pair_id, chosen_id, rejected_id, CAST(n.n AS INTEGER) AS n_prompt_turns,
  array_to_string([{_TEXT} FOR t IN good[1:n.n]], '') AS prompt,
  array_to_string([{_TEXT} FOR t IN good[n.n + 1:]], '') AS chosen,
  array_to_string([{_TEXT} FOR t IN bad[n.n + 1:]], '') AS rejected,
  array_to_string([CASE WHEN t.role = '{TRAINED}' THEN '1' ELSE '0' END FOR t IN good[n.n + 1:]], '') AS chosen_mask,
  array_to_string([CASE WHEN t.role = '{TRAINED}' THEN '1' ELSE '0' END FOR t IN bad[n.n + 1:]], '') AS rejected_mask
FROM j JOIN n USING (pair_id)
"""
