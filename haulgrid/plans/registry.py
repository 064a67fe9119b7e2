"""Every operator as a named query over the given tables: name -> (mart) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.functions import cleaning as C
from haulgrid.functions.responses import classified
from haulgrid.operators import checks, profile
from haulgrid.operators.dedupe import first_copy
from haulgrid.operators.measures import measured
from haulgrid.plans import breakdowns as B
from haulgrid.plans import export as X
from haulgrid.plans import models as M
from haulgrid.plans import questions as Q
from haulgrid.plans import suite as K
from haulgrid.plans.publishing import outcomes
from haulgrid.plans.seeded import seeded
from haulgrid.sources.landing import read_loads_csv, write_loads_csv
from haulgrid.sources.mart import LoadMart, mart_for
from haulgrid.sources.tables import derive_responses

# Parameters of the questions on the given tables.
STATE = "AS"
PERIOD = (dt.date(1998, 1, 1), dt.date(1998, 7, 1))
TREND = (dt.date(1997, 1, 1), dt.date(1999, 12, 1))

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def on_mart(name: str) -> Callable:
    """Register a function of the mart as a query."""

    def add(build: Callable[[LoadMart], DataFrame]) -> Callable[[LoadMart], DataFrame]:
        _QUERIES[name] = lambda spark, folder: build(mart_for(spark, folder))
        return build

    return add


def _scratch(mart: LoadMart, name: str) -> str:
    """Folder of what a query writes; the query's next run replaces it."""
    return f"{mart.root}/out/{name}"


def rounded(rows: DataFrame, places: dict[str, int]) -> DataFrame:
    """Round float results: the last digits of a float sum depend on the order of its terms."""
    return rows.withColumns({c: F.round(c, n) for c, n in places.items()})


# --- sources, sinks, materialization -------------------------------------------------------


@on_mart("s1_csv_landing")
def _(m):
    path = _scratch(m, "s1")
    write_loads_csv(m.raw, path)
    return read_loads_csv(m.spark, path).select(*M.raw_columns(m.raw))


@on_mart("s2_raw_scan")
def _(m):
    return m.raw.select(*M.raw_columns(m.raw)).withColumn(
        "carrier_dropped_us_count", F.col("carrier_dropped_us_count").cast("int")
    )


@on_mart("s3_staging_view")
def _(m):
    # The view gets a name of its own, so that two runs in one session do not meet.
    return m.spark.sql(
        "SELECT equipment_type, count(*) AS loads, count(carrier_name) AS named_carriers "
        "FROM {staged} GROUP BY equipment_type",
        staged=M.staged_loads(m.raw),
    )


#: What of each published table s4 compares: columns whose text is the same in any engine.
PUBLISHED = {
    "dim_date": ["date_day", "month_start_date", "year", "quarter", "month", "year_month", "day_of_week", "day_name"],
    "dim_shipper": ["shipper_key", "shipper_name"],
    "dim_carrier": ["carrier_key", "carrier_name"],
    "dim_lane": ["lane_key", "lane", "pickup_city", "pickup_state", "delivery_city", "delivery_state", "haul_type"],
    "fct_loads": ["load_id", "shipper_key", "carrier_key", "lane_key", "quote_date", "booked_date", "sourced_date",
                  "pickup_date", "delivery_date", "equipment_type", "haul_type", "is_delivered"],
}


#: Error checks that the given tables fail, as they hold such loads on purpose.
WAIVED = ("not_null", "lane_format", "negative_prices")


@on_mart("s4_published_tables")
def _(m):
    """Rows of each table, and the sum of a hash of each row's text."""
    folder = _scratch(m, "published")
    m.publish(folder, WAIVED)
    found = []
    for name, rows in LoadMart.reopen(m.spark, folder).published().items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in PUBLISHED[name]])
        digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
        found.append(rows.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.sum(digest).alias("content"),
        ))
    return reduce(DataFrame.unionByName, found)


@on_mart("s5_mart_scan")
def _(m):
    return m.facts.select("load_id", "booked_date", "book_price", "is_delivered")


@on_mart("s6_csv_export")
def _(m):
    return X.export_latest_month(m, _scratch(m, "s6"))


@on_mart("s7_csv_read_back")
def _(m):
    folder = _scratch(m, "s7")
    loads = X.latest_month_loads(m)
    X.write_export(loads, folder)
    return X.read_back_check(loads, folder)


def _questions_here() -> list[K.Question]:
    """The question set with the state that occurs in the given tables."""
    here = lambda m: Q.top_carriers_into(m, STATE)
    return [replace(i, build=here) if i.id == "q5" else i for i in K.QUESTIONS]


#: Answers without a fraction, whose text is the same in any engine.
WHOLE_ANSWERS = ("q1", "q4", "q5", "q7")


@on_mart("s8_answer_log")
def _(m):
    log = K.run_questions(m, _scratch(m, "s8"), _questions_here())
    return log.select(
        "id", "question", "assumption", "status", "answer_rows",
        F.col("answer").isNotNull().alias("answer_in_log"),
        F.col("answer_path").isNotNull().alias("answer_in_files"),
        F.when(F.col("id").isin(*WHOLE_ANSWERS), F.col("answer")).alias("answer"),
    )


# --- projections, filters, predicates ------------------------------------------------------


@on_mart("p1_typed_columns")
def _(m):
    return M.normalized(m.raw)


@on_mart("p4_first_copy")
def _(m):
    return first_copy(m.raw, "load_id", ["quote_date", "book_date"]).select(
        "load_id", "quote_date", "book_date", "lane"
    )


@on_mart("p5_delivered_loads")
def _(m):
    return m.facts.where(Q.delivered()).select("load_id", "delivery_date")


@on_mart("p6_half_open_range")
def _(m):
    period = Q.delivered_between(F.lit(PERIOD[0]), F.lit(PERIOD[1]))
    return m.facts.where(period).select("load_id", "delivery_date", "is_delivered")


@on_mart("p7_inclusive_range")
def _(m):
    return Q.months_between(m.calendar, *TREND)


@on_mart("p8_not_null")
def _(m):
    return m.facts.where(F.col("carrier_rating").isNotNull()).select("load_id", "carrier_rating")


@on_mart("p9_equals_literal")
def _(m):
    return m.lanes.where(F.col("delivery_state") == STATE).select("lane_key", "lane")


@on_mart("p10_inequality")
def _(m):
    return m.lanes.where(F.col("pickup_city") != F.col("delivery_city")).select(
        "lane", "pickup_city", "delivery_city"
    )


@on_mart("p11_time_comparison")
def _(m):
    return m.staged.where(F.col("delivered_at") < F.col("pickup_at")).select(
        "load_id", "pickup_at", "delivered_at"
    )


@on_mart("p14_case_flags")
def _(m):
    return m.staged.select(
        "load_id", "haul_type",
        F.when(F.col("book_price") == 0, 1).otherwise(0).alias("zero_book_price"),
    )


@on_mart("p15_delivered_flag")
def _(m):
    return m.staged.groupBy(
        "load_was_cancelled", F.col("delivered_at").isNotNull().alias("has_delivery"),
        "is_delivered",
    ).agg(F.count("*").alias("loads"))


@on_mart("p16_bound_parameters")
def _(m):
    return m.spark.sql(
        "SELECT count(*) AS loads, count_if(is_delivered) AS delivered_loads "
        "FROM {facts} WHERE delivery_date >= :first AND delivery_date < :end "
        "AND delivery_year BETWEEN year(:first) AND year(:end)",
        args={"first": PERIOD[0], "end": PERIOD[1]}, facts=m.facts,
    )


@on_mart("p17_latest_month_loads")
def _(m):
    month = Q.latest_month(m.facts).select("latest_available_month").scalar()
    return X.in_month(m.facts, month).select("load_id", "delivery_date")


@on_mart("p18_month_starts")
def _(m):
    return Q.months_between(m.calendar)


# --- joins ---------------------------------------------------------------------------------


@on_mart("j1_key_lookup")
def _(m):
    return M.facts_by_lookup(m.staged, m.shippers, m.carriers, m.lanes)


@on_mart("j2_carrier_totals")
def _(m):
    return rounded(
        measured(m, ["total_loads", "total_pnl"], ["carrier_name"], how="inner"),
        {"total_pnl": 2},
    )


@on_mart("j3_carrier_by_state")
def _(m):
    return measured(
        m, ["delivered_loads"], ["carrier_name", "delivery_state"], loads=Q.delivered(),
        how="inner",
    )


@on_mart("j4_named_loads")
def _(m):
    return X.with_members(m, m.facts).select(
        "load_id", "shipper_name", "carrier_name", "lane", "delivery_city"
    )


@on_mart("j6_latest_month_attached")
def _(m):
    latest = Q.latest_month(m.facts)
    month = latest.select("latest_available_month").scalar()
    return X.monthly_activity(m.facts).withColumn("latest_available_month", month)


@on_mart("j8_busiest_shipper_loads")
def _(m):
    done = m.facts.where(Q.delivered())
    winner = (
        done.groupBy("shipper_key")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("shipper_key"))
        .limit(1)
    )
    # The winner is a single row.
    return done.join(F.broadcast(winner), "shipper_key", "left_semi").select(
        "load_id", "shipper_key"
    )


@on_mart("j11_loads_by_role")
def _(m):
    return B.loads_by_roles(m, ["delivery_date", "booked_date", "pickup_date"], "year_month")


# --- aggregations, windows, sorts, set operations -------------------------------------------


@on_mart("a1_row_count")
def _(m):
    return m.footers("fct_loads").agg(F.count("*").alias("loads"))


@on_mart("a3_loads_by_equipment")
def _(m):
    return measured(m, ["total_loads"], ["equipment_type"])


@on_mart("a7_distinct_loads")
def _(m):
    return m.facts.agg(F.countDistinct("load_id").alias("distinct_loads"))


@on_mart("a8_delivery_bounds")
def _(m):
    return Q.with_delivery_year(m.footers("fct_loads")).agg(
        F.min("delivery_date").alias("first_day"), F.max("delivery_date").alias("last_day")
    )


@on_mart("a9_conditional_counts")
def _(m):
    return m.facts.groupBy("haul_type").agg(
        F.sum(F.when(Q.delivered(), 1).otherwise(0)).alias("delivered_loads"),
        F.count_if(F.col("book_price") == 0).alias("zero_book_price"),
    )


@on_mart("a12_group_by_expression")
def _(m):
    return m.facts.groupBy(
        F.year("booked_date").alias("booked_year"), F.quarter("booked_date").alias("quarter")
    ).agg(F.count("*").alias("loads"))


@on_mart("a13_order_by_hidden_count")
def _(m):
    groups = measured(m, ["delivered_loads"], ["shipper_name"], loads=Q.delivered())
    return (
        groups.orderBy(F.desc("delivered_loads"), F.asc_nulls_last("shipper_name"))
        .limit(10)
        .select("shipper_name")
    )


@on_mart("t5_nulls_last")
def _(m):
    return (
        m.facts.select("load_id", "carrier_rating", "delivery_date")
        .orderBy(F.asc_nulls_last("carrier_rating"), F.desc_nulls_last("delivery_date"),
                 "load_id")
    )


@on_mart("u1_lifecycle_dates")
def _(m):
    """All lifecycle dates as rows of one column, from one scan."""
    moments = F.array(*[F.col(moment).cast("date") for moment in M.ROLES])
    dates = m.staged.select(F.explode(moments).alias("date_day")).where(F.col("date_day").isNotNull())
    return dates.agg(
        F.min("date_day").alias("first_day"), F.max("date_day").alias("last_day"),
        F.count("*").alias("dates"),
    )


# --- scalar functions ----------------------------------------------------------------------


@on_mart("f3_parsed_stamps")
def _(m):
    stamps = {
        to: C.stamp(F.col(column))
        for column, to in (("pickup_date", "pickup_at"), ("delivery_date", "delivered_at"))
    }
    return m.raw.select("load_id", *[value.alias(name) for name, value in stamps.items()])


@on_mart("f4_clean_text")
def _(m):
    return m.raw.select(
        "load_id",
        F.upper(F.trim("equipment_type")).alias("equipment_type"),
        F.lower(F.trim("lane")).alias("lane_lower"),
        C.blank_to_null(F.col("sourcing_channel")).alias("sourcing_channel"),
        F.coalesce(C.blank_to_null(F.col("carrier_name")), F.lit(C.UNKNOWN_MEMBER)).alias(
            "carrier_or_unknown"
        ),
    )


@on_mart("f10_member_keys")
def _(m):
    return m.staged.select(
        "load_id", C.member_key(F.col("carrier_name")).alias("carrier_key"),
        C.lane_key(F.col("lane")).alias("lane_key"),
    )


@on_mart("f14_weekday_counts")
def _(m):
    return measured(m, ["total_loads"], ["day_of_week", "day_name"], role="booked_date")


@on_mart("f19_price_per_mile")
def _(m):
    return m.facts.select(
        "load_id",
        F.try_divide("book_price", "mileage").alias("price_per_mile"),
    )


@on_mart("f20_lane_parts")
def _(m):
    lanes = m.raw.select(F.trim("lane").alias("lane")).distinct()
    return lanes.withColumns(C.lane_columns(F.col("lane")))


# --- models --------------------------------------------------------------------------------

on_mart("m1_staged_loads")(lambda m: m.staged)
on_mart("m2_shipper_dimension")(lambda m: m.shippers)
on_mart("m3_carrier_dimension")(lambda m: m.carriers)
on_mart("m4_lane_dimension")(lambda m: m.lanes)
on_mart("m5_calendar_dimension")(lambda m: m.calendar)
on_mart("m6_load_facts")(lambda m: m.facts.select(*M.FACT_COLUMNS))

# --- data quality --------------------------------------------------------------------------


on_mart("d1_not_null")(lambda m: checks.row_rule_counts(m, "not_null"))
on_mart("d2_unique")(
    lambda m: checks.unique_counts(m).where(F.col("check_name") == "unique")
)
on_mart("d3_relationships")(checks.relationship_counts)
on_mart("d4_accepted_values")(lambda m: checks.row_rule_counts(m, "accepted_values"))
on_mart("d5_one_row_per_load")(lambda m: checks.duplicated(m.staged, "load_id"))

for _name, _check, _columns in (
    ("d6_lane_format", "lane_format", ["load_id", "lane"]),
    ("d7_negative_prices", "negative_prices", ["load_id", "book_price", "source_price"]),
    ("d10_delivered_before_booked", "delivered_before_booked",
     ["load_id", "booked_at", "delivered_at"]),
    ("d11_delivered_before_pickup", "delivered_before_pickup",
     ["load_id", "pickup_at", "delivered_at"]),
    ("d12_zero_book_price", "zero_book_price",
     ["load_id", "book_price", "load_was_cancelled", "is_delivered"]),
    ("d13_zero_source_price", "zero_source_price",
     ["load_id", "source_price", "load_was_cancelled", "is_delivered"]),
    ("d14_zero_mileage", "zero_mileage",
     ["load_id", "pickup_city", "pickup_state", "delivery_city", "delivery_state", "mileage"]),
):
    on_mart(_name)(
        lambda m, check=_check, columns=_columns: checks.breaking(m.staged, check).select(*columns)
    )

on_mart("d8_delivered_definition")(
    lambda m: checks.breaking(m.facts, "delivered_definition").select("load_id")
)
on_mart("d9_lane_consistency")(
    lambda m: checks.haul_type_mismatch_loads(m.facts, m.lanes).select("load_id")
)
on_mart("d15_check_suite")(checks.suite)
on_mart("d15_suite_status")(checks.suite_status)
on_mart("d15_publish_outcomes")(lambda m: outcomes(m, _scratch(m, "audited"), WAIVED))

# The same checks where they find something: on the tables with planted faults.
on_mart("d2_unique_seeded")(
    lambda m: checks.unique_counts(seeded(m)).where(F.col("check_name") == "unique")
)
on_mart("d3_relationships_seeded")(lambda m: checks.relationship_counts(seeded(m)))
on_mart("d4_accepted_values_seeded")(lambda m: checks.row_rule_counts(seeded(m), "accepted_values"))
on_mart("d5_one_row_per_load_seeded")(lambda m: checks.duplicated(seeded(m).staged, "load_id"))
on_mart("d8_delivered_definition_seeded")(
    lambda m: checks.breaking(seeded(m).facts, "delivered_definition").select("load_id", "is_delivered")
)
on_mart("d9_lane_consistency_seeded")(
    lambda m: checks.haul_type_mismatch_loads(seeded(m).facts, seeded(m).lanes).select("load_id", "haul_type", "lane_haul_type")
)
on_mart("j9_orphans_seeded")(
    lambda m: checks.orphans(seeded(m).facts, "shipper_key", seeded(m).shippers, "shipper_key")
)
on_mart("j9_date_orphans_seeded")(lambda m: checks.date_orphans(seeded(m).facts, seeded(m).calendar))
on_mart("j10_haul_types_seeded")(lambda m: checks.haul_type_mismatches(seeded(m).facts, seeded(m).lanes))
on_mart("d15_check_suite_seeded")(lambda m: checks.suite(seeded(m)))

on_mart("n1_shape")(lambda m: profile.shape(m.footers("raw_loads")))
on_mart("n2_duplicates")(lambda m: profile.duplicates(m.raw, "load_id"))
on_mart("n3_constant_columns")(lambda m: profile.constant_columns(m.raw))
on_mart("n4_null_counts")(lambda m: profile.null_counts(m.staged))
on_mart("n5_rating_range")(lambda m: profile.rating_range(m.staged))
on_mart("n6_value_counts")(lambda m: profile.value_counts(m.staged))
on_mart("n7_order_violations")(lambda m: profile.order_violations(m.staged))
on_mart("n8_cancelled_by_delivered")(lambda m: profile.cancelled_by_delivered(m.staged))
on_mart("n9_lane_conformity")(lambda m: profile.lane_conformity(m.staged))

# --- questions -----------------------------------------------------------------------------

on_mart("q1_last_full_month")(Q.delivered_in_last_full_month)
on_mart("q1_given_month")(lambda m: Q.delivered_in_last_full_month(m, *PERIOD))
on_mart("q2_top_shipper")(
    lambda m: rounded(Q.top_shippers_by_book_price(m), {"total_book_price": 2})
)
on_mart("q3_price_by_pickup_state")(
    lambda m: rounded(Q.book_price_by_pickup_state(m), {"avg_book_price": 6})
)
on_mart("q4_top_lanes")(Q.top_lanes)
on_mart("q5_top_carrier_into_state")(lambda m: Q.top_carriers_into(m, STATE))
on_mart("q6_price_by_haul_type")(
    lambda m: rounded(Q.book_price_by_haul_type(m), {"avg_book_price": 6})
)
on_mart("q7_busiest_shipper_by_month")(Q.busiest_shipper_by_month)
on_mart("q7_given_months")(lambda m: Q.busiest_shipper_by_month(m, *TREND))
on_mart("q8_dearest_lane")(lambda m: rounded(Q.dearest_lanes(m), {"avg_book_price": 6}))
on_mart("q9_lanes_by_pnl_ratio")(
    lambda m: rounded(
        Q.lanes_by_pnl_ratio(m), {"total_pnl": 2, "total_book_price": 2, "pnl_ratio": 6}
    )
)
on_mart("q10_low_rated_carriers")(
    lambda m: rounded(Q.low_rated_carriers(m), {"average_rating": 6})
)

# --- export --------------------------------------------------------------------------------

on_mart("e1_latest_month")(lambda m: Q.latest_month(Q.with_delivery_year(m.footers("fct_loads"))))
on_mart("e2_monthly_activity")(lambda m: X.monthly_activity(m.facts))
on_mart("e3_latest_month_loads")(X.latest_month_loads)
on_mart("e4_export_validation")(X.export_validation)
on_mart("e5_export_written")(
    lambda m: X.export_latest_month(m, _scratch(m, "e5")).groupBy("delivery_date").agg(
        F.count("*").alias("loads"), F.round(F.sum("book_price"), 2).alias("book_price")
    )
)

# --- measures and breakdowns ---------------------------------------------------------------

# Query -> (measure, attribute, date role, places).
MEASURE_QUERIES = {
    "b1_total_loads": ("total_loads", "pickup_state", "delivery_date", None),
    "b2_delivered_loads": ("delivered_loads", "carrier_name", "delivery_date", None),
    "b3_delivery_rate": ("delivery_rate", "carrier_name", "delivery_date", 6),
    "b4_total_book_price": ("total_book_price", "lane", "delivery_date", 2),
    "b5_average_book_price": ("avg_book_price", "pickup_city", "delivery_date", 6),
    "b6_delivered_book_price": ("delivered_book_price", "shipper_name", "delivery_date", 2),
    "b7_delivered_average_price": (
        "delivered_avg_book_price", "delivery_state", "delivery_date", 6),
    "b8_total_pnl": ("total_pnl", "year", "delivery_date", 2),
    "b9_delivered_pnl": ("delivered_pnl", "carrier_name", "delivery_date", 2),
    "b10_pnl_margin": ("pnl_margin", "shipper_name", "delivery_date", 6),
    "b11_delivered_pnl_margin": ("delivered_pnl_margin", "lane", "delivery_date", 6),
    "b12_average_rating": ("avg_carrier_rating", "carrier_name", "delivery_date", 6),
    "b13_on_time_pickup": ("on_time_pickup", "carrier_name", "delivery_date", 6),
    "b14_on_time_delivery": ("on_time_delivery", "pickup_city", "delivery_date", 6),
    "b15_on_time_overall": ("on_time_overall", "year_month", "delivery_date", 6),
    "b16_booked_loads": ("total_loads", "year_month", "booked_date", None),
    "b17_pickup_loads": ("total_loads", "year_month", "pickup_date", None),
}


def _measure_query(measure: str, by: str, role: str, places: int | None):
    def build(m: LoadMart) -> DataFrame:
        rows = B.loads_by_role(m, role, by, measure)
        return rows if places is None else rounded(rows, {measure: places})

    return build


for _name, _spec in MEASURE_QUERIES.items():
    on_mart(_name)(_measure_query(*_spec))

on_mart("b18_carrier_ranks")(B.carrier_ranks)

PLACES = {
    "delivery_rate": 6, "total_book_price": 2, "total_pnl": 2, "pnl_margin": 6,
    "avg_book_price": 6, "avg_carrier_rating": 6, "on_time_pickup": 6, "on_time_delivery": 6,
    "on_time_overall": 6, "delivered_pnl": 2,
}

# Query -> breakdown.
BREAKDOWN_QUERIES = {
    "v1_kpis": "kpis",
    "v2_monthly_trend": "monthly_trend",
    "v3_delivered_by_haul_type": "delivered_by_haul_type",
    "v5_delivered_by_lane": "delivered_by_lane",
    "v6_delivered_by_pickup_state": "delivered_by_pickup_state",
    "v7_delivered_by_delivery_state": "delivered_by_delivery_state",
    "v8_delivered_by_pickup_city": "delivered_by_pickup_city",
    "v9_delivered_by_delivery_city": "delivered_by_delivery_city",
    "v10_haul_type_comparison": "haul_type_comparison",
    "v11_loads_by_carrier": "loads_by_carrier",
    "v12_rating_by_carrier": "rating_by_carrier",
    "v13_on_time_by_carrier": "on_time_by_carrier",
    "v14_delivered_pnl_by_carrier": "delivered_pnl_by_carrier",
}


def _breakdown_query(name: str):
    def build(m: LoadMart) -> DataFrame:
        rows = B.breakdown(m, name)
        return rounded(rows, {c: PLACES[c] for c in rows.columns if c in PLACES})

    return build


for _name, _breakdown in BREAKDOWN_QUERIES.items():
    on_mart(_name)(_breakdown_query(_breakdown))

on_mart("v4_top_shippers")(lambda m: rounded(B.top_shippers(m), {"total_book_price": 2}))

# --- responses and runs --------------------------------------------------------------------

_QUERIES["r1_response_verdicts"] = lambda spark, folder: classified(
    derive_responses(spark, folder), "response"
).select("conv_id", "turn", "verdict", "cleaned", "reason")


@on_mart("r2_status_counts")
def _(m):
    folder = _scratch(m, "runs")
    K.log_responses(derive_responses(m.spark, m.source), folder)
    log = m.spark.read.schema("id string, status string").json(folder)
    return K.status_counts(log)


@on_mart("k1_question_suite")
def _(m):
    failing = K.Question("q12", "A question on a column that does not exist",
                         lambda mart: mart.facts.select("operating_overhead"), True, "none", "none")
    broken = K.Question("q13", "A question whose code fails", lambda mart: 1 // 0, True, "none", "none")
    here = _questions_here()
    log = K.run_questions(m, _scratch(m, "k1"), [failing, broken, *here])
    return K.status_counts(log)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
