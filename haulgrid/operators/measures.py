"""Measures over the load fact, grouped by any attributes of the dimensions.

Every measure is an expression over additive parts (counts and sums). Parts are first added
up per dimension *key* on the fact alone, and only that result is joined to the dimensions and
added up again per attribute. So the fact is never shuffled row by row for a join, and a key
with a third of all loads is one row per task when it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrid.plans.models import ROLES
from haulgrid.sources.mart import LoadMart
from haulgrid.sources.scratch import written

#: Columns of the fact that the stored parts are added up by, one at a time.
PART_KEYS = ["shipper_key", "carrier_key", "lane_key", "haul_type", "equipment_type", *ROLES.values()]
#: Any of them gives the parts of all loads; this one has the fewest values.
ALL_LOADS = "haul_type"


def _delivered(column: str) -> Column:
    return F.when(F.col("is_delivered"), F.col(column))


def _sum_and_count(value: Column, name: str) -> dict[str, Column]:
    return {f"{name}_sum": F.sum(value), f"{name}_n": F.count(value)}


def additive_parts() -> dict[str, Column]:
    """Every part by name: counts and sums over loads."""
    parts = {
        "loads_n": F.count(F.lit(1)),
        "delivered_n": F.count_if(F.col("is_delivered")),
        **_sum_and_count(F.col("carrier_rating"), "carrier_rating"),
    }
    for column in ("book_price", "pnl"):
        parts.update(_sum_and_count(F.col(column), column))
        parts.update(_sum_and_count(_delivered(column), f"delivered_{column}"))
    for flag, name in (("to_pickup", "pickup"), ("to_delivery", "delivery"),
                       ("overall", "overall")):
        value = F.col(f"carrier_on_time_{flag}").cast("int")
        parts.update(_sum_and_count(value, f"on_time_{name}"))
    return parts


def part_rows(facts: DataFrame) -> DataFrame:
    """Every part per value of each of ``PART_KEYS``, in one scan: kind, the keys, the parts.

    A row holds the sums of one value of the key that ``kind`` names; the other keys are NULL. There
    are as many rows as values, so what is asked by one key need not go over the loads again.
    """
    place = sum((F.grouping(key).cast("int") * F.lit(at) for at, key in enumerate(PART_KEYS)), F.lit(0))
    # Of a row's keys all but one are left out; their places add up to all but its own.
    own = F.lit(sum(range(len(PART_KEYS)))) - place
    kinds = F.array(*[F.lit(key) for key in PART_KEYS])
    sums = facts.groupingSets([[F.col(key)] for key in PART_KEYS], *[F.col(key) for key in PART_KEYS]).agg(
        F.element_at(kinds, (own + 1).cast("int")).alias("kind"),
        *[part.alias(name) for name, part in additive_parts().items()],
    )
    return sums.select("kind", *PART_KEYS, *additive_parts())


@dataclass(frozen=True)
class Measure:
    """Name, the parts it needs, and how its value follows from them.

    One part is taken as it is; of two the first is divided by the second, and a zero
    denominator gives NULL.
    """

    name: str
    parts: tuple[str, ...]

    def value(self) -> Column:
        if len(self.parts) == 1:
            return F.col(self.parts[0]).alias(self.name)
        top, bottom = (F.col(p).cast("double") for p in self.parts)
        return F.try_divide(top, bottom).alias(self.name)


MEASURES = {
    m.name: m
    for m in (
        Measure("total_loads", ("loads_n",)),
        Measure("delivered_loads", ("delivered_n",)),
        Measure("delivery_rate", ("delivered_n", "loads_n")),
        Measure("total_book_price", ("book_price_sum",)),
        Measure("avg_book_price", ("book_price_sum", "book_price_n")),
        Measure("delivered_book_price", ("delivered_book_price_sum",)),
        Measure("delivered_avg_book_price",
                ("delivered_book_price_sum", "delivered_book_price_n")),
        Measure("total_pnl", ("pnl_sum",)),
        Measure("delivered_pnl", ("delivered_pnl_sum",)),
        Measure("pnl_margin", ("pnl_sum", "book_price_sum")),
        Measure("delivered_pnl_margin", ("delivered_pnl_sum", "delivered_book_price_sum")),
        Measure("avg_carrier_rating", ("carrier_rating_sum", "carrier_rating_n")),
        Measure("rating_count", ("carrier_rating_n",)),
        Measure("on_time_pickup", ("on_time_pickup_sum", "on_time_pickup_n")),
        Measure("on_time_delivery", ("on_time_delivery_sum", "on_time_delivery_n")),
        Measure("on_time_overall", ("on_time_overall_sum", "on_time_overall_n")),
    )
}

SHIPPER = ("shipper_name",)
CARRIER = ("carrier_name",)
LANE = ("lane", "pickup_city", "pickup_state", "delivery_city", "delivery_state")
CALENDAR = ("date_day", "month_start_date", "year", "quarter", "month", "year_month",
            "day_of_week", "day_name")


def _lookups(mart: LoadMart, attributes: Sequence[str], role: str):
    """(fact column, dimension key, dimension, attributes) of each dimension that is needed."""
    known = (
        (SHIPPER, "shipper_key", "shipper_key", lambda: mart.shippers),
        (CARRIER, "carrier_key", "carrier_key", lambda: mart.carriers),
        (LANE, "lane_key", "lane_key", lambda: mart.lanes),
        (CALENDAR, role, "date_day", lambda: mart.calendar),
    )
    for columns, fact_column, key, dimension in known:
        wanted = [a for a in attributes if a in columns]
        if wanted:
            yield fact_column, key, dimension(), wanted


def _added_up(part: str) -> Column:
    """Sum of partial parts; a count over no rows at all is 0, as it is when counted directly."""
    total = F.sum(part)
    return F.coalesce(total, F.lit(0)) if part.endswith("_n") else total


def measured(
    mart: LoadMart,
    measures: Sequence[str],
    by: Sequence[str] = (),
    *,
    loads: Column | None = None,
    members: Column | None = None,
    members_use: Sequence[str] = (),
    role: str = "delivery_date",
    how: str = "left",
) -> DataFrame:
    """Measures per group of attributes.

    ``by`` names attributes of the dimensions, or columns of the fact itself. ``loads`` filters
    the fact; ``members`` filters on the attributes named in ``members_use``. ``role`` is the
    fact date that the calendar is joined on. With ``how="left"`` loads without a member form a
    group of their own, as in a report; ``"inner"`` leaves them out.
    """
    chosen = [MEASURES[m] for m in measures]
    parts = list(dict.fromkeys(p for m in chosen for p in m.parts))
    sums = None if loads is not None else _stored_sums(mart, parts, [*by, *members_use], role)
    if sums is not None:
        return _of_members(mart, sums, chosen, parts, by, members, members_use, role, how)
    known = additive_parts()
    facts = mart.facts if loads is None else mart.facts.where(loads)
    if members is not None and not set(members_use) & set(by):
        filtering = list(_lookups(mart, members_use, role))
        if len(filtering) == 1:
            # One dimension is asked for its filter alone: the loads of its members are taken
            # first, and are then not grouped by a key that the result does not have.
            (fact_column, key, dimension, _), = filtering
            some = dimension.where(members).select(F.col(key).alias("_key"))
            facts = facts.join(some, F.col(fact_column) == F.col("_key"), "left_semi")
            members, members_use = None, ()
    keys = _keys(mart, [*by, *members_use], role)
    sums = facts.groupBy(*keys).agg(*[known[p].alias(p) for p in parts])
    return _of_members(mart, sums, chosen, parts, by, members, members_use, role, how)


def _keys(mart: LoadMart, attributes: Sequence[str], role: str) -> list[str]:
    """The columns of the fact that these attributes follow from."""
    lookups = list(_lookups(mart, attributes, role))
    looked_up = {a for *_, wanted in lookups for a in wanted}
    own = [a for a in attributes if a not in looked_up]
    return list(dict.fromkeys([fact_column for fact_column, *_ in lookups] + own))


def _stored_sums(mart: LoadMart, parts: list[str], attributes: Sequence[str], role: str) -> DataFrame | None:
    """The parts by the one key that all attributes follow from, as they are stored; None if
    there is more than one key, or one that they are not stored by."""
    keys = _keys(mart, attributes, role)
    if len(keys) > 1 or not set(keys) <= set(PART_KEYS):
        return None
    stored = mart.parts.where(F.col("kind") == (keys[0] if keys else ALL_LOADS))
    return stored.select(*keys, *parts) if keys else stored.agg(*[_added_up(p).alias(p) for p in parts])


def _of_members(
    mart: LoadMart, sums: DataFrame, chosen: list[Measure], parts: list[str], by: Sequence[str],
    members: Column | None, members_use: Sequence[str], role: str, how: str,
) -> DataFrame:
    """The measures from parts by key: joined to the dimensions and added up per attribute."""
    lookups = list(_lookups(mart, [*by, *members_use], role))
    if lookups:
        for fact_column, key, dimension, wanted in lookups:
            member = dimension.select(F.col(key).alias("_key"), *wanted)
            sums = sums.join(member, F.col(fact_column) == F.col("_key"), how).drop("_key")
        if members is not None:
            sums = sums.where(members)
        sums = sums.groupBy(*by).agg(*[_added_up(p).alias(p) for p in parts])
    return sums.select(*by, *[m.value() for m in chosen])


def dense_rank_by(groups: DataFrame, value: str, rank: str) -> DataFrame:
    """Dense rank of grouped rows by a value, highest first; a row without a value has no rank.

    The distinct values are dealt in ranges and sorted there; a value's rank is its place in its
    range and the number of values in the ranges above. Only one count per range comes to the
    driver. The groups are computed once. The ranks are broadcast only if Spark finds them small.
    """
    groups = written(groups, "ranked")
    levels = groups.where(F.col(value).isNotNull()).select(F.col(value).alias("_level")).distinct()
    levels = levels.repartitionByRange(F.desc("_level")).sortWithinPartitions(F.desc("_level"))
    levels = written(levels.withColumn("_place", F.monotonically_increasing_id()), "levels")
    range_ = F.shiftrightunsigned("_place", 33)
    counts = sorted(map(tuple, levels.groupBy(range_).agg(F.count("*")).collect()))
    before = [0, *accumulate(n for _, n in counts)]
    starts = groups.sparkSession.createDataFrame(
        [(number, start) for (number, _), start in zip(counts, before)], "_range long, _before long"
    )
    place = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # One row for each range, so at most as many as shuffle partitions.
    ranks = levels.join(F.broadcast(starts), range_ == F.col("_range")).select("_level", place.cast("int").alias(rank))
    return groups.join(ranks, F.col(value) == F.col("_level")).drop("_level")
