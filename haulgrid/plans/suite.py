"""The question set run as a whole, with its answers and outcomes logged as JSON lines."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import InheritableThread

from haulgrid.functions.responses import classified, run_status
from haulgrid.plans import questions as q
from haulgrid.sources.mart import LoadMart

LOG_SCHEMA = (
    "id string, question string, why_it_matters string, assumption string, "
    "what_needs_change string, status string, answer string, answer_rows bigint, "
    "answer_path string, error string, error_message string"
)


@dataclass(frozen=True)
class Question:
    """A question; without ``build`` the data cannot answer it, and ``needs`` says what is missing.

    ``bounded`` tells whether a limit or the calendar bounds the answer. Only then does the log
    entry hold it; every answer is in files, whose folder the entry names.
    """

    id: str
    text: str
    build: Callable[[LoadMart], DataFrame] | None
    bounded: bool
    why: str
    assumption: str
    needs: str | None = None


QUESTIONS = [
    Question("q1", "Delivered loads in the last full month", q.delivered_in_last_full_month, True,
             "volume of the latest closed month",
             "a month is full if its last day has a delivery or a later month has one"),
    Question("q2", "Shipper with the highest total book price", q.top_shippers_by_book_price, True,
             "concentration of revenue", "all loads count, delivered or not"),
    Question("q3", "Average book price by pickup state", q.book_price_by_pickup_state, False,
             "regional pricing", "all loads count, delivered or not"),
    Question("q4", "Top five lanes by delivered loads", q.top_lanes, True,
             "where capacity is needed", "a lane is its whole text; ties go by name"),
    Question("q5", "Carrier with most delivered loads into a state", q.top_carriers_into, True,
             "dependence on one carrier", "loads without a named carrier compete as one"),
    Question("q6", "Average book price by haul type", q.book_price_by_haul_type, True,
             "price of crossing a state line", "a malformed lane counts as intrastate"),
    Question("q7", "Monthly volume of the busiest shipper", q.busiest_shipper_by_month, True,
             "trend of the largest account", "months without a load count as zero"),
    Question("q8", "Dearest lane of at least ten delivered loads", q.dearest_lanes, True,
             "lanes worth a closer look", "fewer loads make no reliable average"),
    Question("q9", "Top ten lanes by P&L ratio", q.lanes_by_pnl_ratio, True,
             "most profitable lanes", "P&L over book price, lanes of no price left out"),
    Question("q10", "Carriers rated below three on average", q.low_rated_carriers, False,
             "quality of service", "only rated loads count"),
    Question("q11", "Profit after operating overhead", None, True,
             "true profitability", "overhead would have to be known per load",
             needs="no column holds operating overhead"),
]


class OutOfTime(Exception):
    """A question's time was up before its answer was there."""


#: Seconds that a question may take.
TIME_LIMIT = 3600.0
#: Questions that run at a time.
AT_ONCE = 4


def run_questions(
    mart: LoadMart, folder: str, questions: list[Question] | None = None, seconds: float = TIME_LIMIT,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Run every question and log it; a failing one is logged and the rest go on.

    The status is ``success``, ``unsupported`` for a question that the data cannot answer,
    ``sql_error`` if Spark could not run the query, and ``error`` if anything else went wrong, or
    the question took more than ``seconds``: its jobs are then cancelled. ``at_once`` questions
    run side by side, each in a scheduler pool of its own, so that under the FAIR scheduler a heavy
    one does not hold up the others.
    Answers are lines of JSON under ``answers/<id>``: a row, and its place in the answer's order. A
    bounded answer also stands in its entry as one array in that order. Returns the log. A later
    run in the same folder replaces the answers and entries of its questions. A table that is not
    built yet is built in the time of the first question that needs it.
    """
    spark = mart.spark
    asked = QUESTIONS if questions is None else questions

    def run(item: Question) -> None:
        entry = {
            "id": item.id, "question": item.text, "why_it_matters": item.why,
            "assumption": item.assumption, "what_needs_change": item.needs,
        }
        try:
            if item.build is None:
                log = spark.range(1).select(F.lit("unsupported").alias("status"))
            else:
                path = f"{folder}/answers/{item.id}"
                log = within(spark, seconds, f"question-{item.id}", lambda: _answered(mart, item, path))
            _enter(log, entry, folder)
        except Exception as failure:  # noqa: BLE001 - the run goes on whatever went wrong
            status = "sql_error" if isinstance(failure, PySparkException) else "error"
            log = spark.range(1).select(
                F.lit(status).alias("status"),
                F.lit(type(failure).__name__).alias("error"),
                F.lit(str(failure)).alias("error_message"),
            )
            _enter(log, entry, folder)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(run, asked))
    return read_log(spark, folder, [item.id for item in asked])


def within(spark: SparkSession, seconds: float, name: str, work: Callable):
    """What ``work`` returns, if it does so in time; else its jobs are cancelled.

    The work has a thread of its own, whose jobs carry a tag and run in the pool of that name. A
    job that it starts after the cancelling is cancelled as well, as long as it lasts.
    """
    context, tag, done = spark.sparkContext, f"{name}-{uuid.uuid4().hex}", {}

    def run() -> None:
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        try:
            done["value"] = work()
        except BaseException as failure:  # noqa: BLE001 - handed on to the caller
            done["failure"] = failure

    thread = InheritableThread(run, daemon=True)
    thread.start()
    thread.join(seconds)
    if thread.is_alive():
        for _ in range(CANCEL_TRIES):
            context.cancelJobsWithTag(tag)
            thread.join(1.0)
            if not thread.is_alive():
                break
        raise OutOfTime(f"no answer within {seconds:g} seconds")
    if "failure" in done:
        raise done["failure"]
    return done["value"]


#: Times, a second apart, that the jobs of a question are cancelled.
CANCEL_TRIES = 30


def _answered(mart: LoadMart, item: Question, path: str) -> DataFrame:
    """Write the answer; one row for the log about it, to be read from its files."""
    # Partitions of a sorted answer are in its order, and so are these numbers.
    answer = item.build(mart).select(F.monotonically_increasing_id().alias("place"), F.struct("*").alias("row"))
    answer.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    rows = mart.spark.read.schema("place long, row string").json(path)
    log = [F.lit("success").alias("status"), F.count("*").alias("answer_rows"), F.lit(path).alias("answer_path")]
    if item.bounded:
        ordered = F.array_sort(F.collect_list(F.struct("place", "row")))
        log.append(F.concat(F.lit("["), F.array_join(ordered["row"], ","), F.lit("]")).alias("answer"))
    return rows.agg(*log)


def _enter(log: DataFrame, entry: dict[str, str | None], folder: str) -> None:
    columns = {name: F.lit(value).cast("string") for name, value in entry.items()}
    log.withColumns(columns).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{folder}/log/{entry['id']}"
    )


def read_log(spark: SparkSession, folder: str, ids: list[str]) -> DataFrame:
    """The entries of some questions."""
    return spark.read.schema(LOG_SCHEMA).json([f"{folder}/log/{i}" for i in ids])


def log_responses(responses: DataFrame, folder: str) -> None:
    """Log a table of generated answers as JSON lines, one entry per answer."""
    verdicts = classified(responses, "response")
    verdicts.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        run_status(F.col("verdict")).alias("status"),
        F.col("cleaned").alias("generated_sql"),
        F.col("reason").alias("unsupported_reason"),
        F.when(run_status(F.col("verdict")) == "error", F.col("verdict")).alias("error"),
    ).write.mode("overwrite").json(folder)


def status_counts(log: DataFrame) -> DataFrame:
    """Logged runs by status."""
    return log.groupBy("status").agg(F.count("*").alias("runs"))
