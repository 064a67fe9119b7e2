"""Classification of generated answers as column expressions, without any UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marker of a declined question and the words a read-only query may not hold.
DECLINED = "UNSUPPORTED:"
WRITE_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create", "truncate",
    "attach", "copy", "export", "install", "load", "call",
)

# Fixed value: the characters that count as blank, inside a regex character class.
BLANK = r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# A word character is any letter, number or underscore, of any script.
WORD = r"\p{L}\p{N}_"
START, END = rf"(?:\A|[^{WORD}])", rf"(?![{WORD}])"


def stripped(text: Column) -> Column:
    """Text without blanks at either end. Each run of blanks is looked at once."""
    without_head = F.regexp_replace(text, rf"\A[{BLANK}]++", "")
    return F.regexp_replace(without_head, rf"(?<![{BLANK}])[{BLANK}]++\z", "")


def unfenced(text: Column) -> Column:
    """Stripped text without an opening or closing code fence."""
    opened = F.regexp_replace(text, rf"(?iu)\A```(?:sql)?[{BLANK}]*+", "")
    return F.regexp_replace(opened, rf"(?<![{BLANK}])[{BLANK}]*+```\z", "")


def classified(responses: DataFrame, response: str) -> DataFrame:
    """Add ``verdict``, ``cleaned`` (of accepted ones) and ``reason`` (of declined ones).

    The first rule that applies decides: declined, not a query, several statements, a write
    word anywhere (inside literals too), else accepted.
    """
    text = F.col("_text")
    cleaned = F.col("_cleaned")
    declined = text.startswith(DECLINED)
    write_word = rf"(?iu){START}(?:{'|'.join(WRITE_WORDS)}){END}"
    verdict = (
        F.when(declined, F.lit("unsupported"))
        .when(~cleaned.rlike(rf"(?iu)\A(?:select|with){END}"), F.lit("not_select"))
        .when(F.regexp_replace(cleaned, r"(?<!;);++\z", "").contains(";"),
              F.lit("multi_statement"))
        .when(cleaned.rlike(write_word), F.lit("not_read_only"))
        .otherwise(F.lit("accepted"))
    )
    reason = stripped(F.substring(text, len(DECLINED) + 1, 2**31 - 1))
    return (
        responses.withColumn("_text", stripped(F.col(response)))
        .withColumn("_cleaned", unfenced(text))
        .withColumn("verdict", F.when(text.isNotNull(), verdict))
        .withColumn("cleaned", F.when(F.col("verdict") == "accepted", cleaned))
        .withColumn("reason", F.when(declined, reason))
        .drop("_text", "_cleaned")
    )


def run_status(verdict: Column) -> Column:
    """Status under which a run logs a response; rejected ones are errors."""
    return (
        F.when(verdict == "accepted", F.lit("success"))
        .when(verdict == "unsupported", F.lit("unsupported"))
        .otherwise(F.lit("error"))
    )
