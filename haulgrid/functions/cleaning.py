"""Column expressions of the staging step: text, numbers, timestamps, lanes, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name hashed for a missing shipper or carrier.
UNKNOWN_MEMBER = "__unknown__"

# Month, day, hour and minute of one or two digits, year of up to four; the plain
# form with a single blank, and the loose one with any blanks around and between.
PLAIN_STAMP = r"^\d{1,2}/\d{1,2}/\d{1,4} \d{1,2}:\d{1,2}\z"
LOOSE_STAMP = r"^\s*\d{1,2}/\d{1,2}/\d{1,4}\s+\d{1,2}:\d{1,2}\s*\z"

# Fixed value: what a well-formed lane looks like.
LANE_SHAPE = r"^[^,]+,[A-Za-z]{2} -> [^,]+,[A-Za-z]{2}\z"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def whole_number(value: Column) -> Column:
    """Integer from a number or its text, rounding halves to even."""
    return F.bround(value.cast("double")).cast("int")


def stamp(text: Column) -> Column:
    """Timestamp without zone from ``M/D/YYYY H:MM``; NULL for other shapes and for dates that
    do not exist. The text is read as UTC and counted from the epoch, so that the session's
    time zone, with its skipped and repeated hours, plays no part.
    """
    plain = F.when(text.rlike(PLAIN_STAMP), text).when(
        text.rlike(LOOSE_STAMP), F.trim(F.regexp_replace(text, r"\s+", " "))
    )
    moment = F.try_to_timestamp(F.concat(plain, F.lit("Z")), F.lit("M/d/y H:mX"))
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return epoch + F.expr("INTERVAL '1' SECOND") * F.unix_seconds(moment)


def lane_side(lane: Column, side: int) -> Column:
    return F.trim(F.split_part(lane, F.lit(" -> "), F.lit(side)))


def city_of(place: Column) -> Column:
    return F.trim(F.split_part(place, F.lit(","), F.lit(1)))


def state_of(place: Column) -> Column:
    return F.upper(F.trim(F.split_part(place, F.lit(","), F.lit(2))))


def lane_columns(lane: Column) -> dict[str, Column]:
    """Geography of a lane. A malformed lane has empty parts and counts as intrastate."""
    start, end = lane_side(lane, 1), lane_side(lane, 2)
    return {
        "pickup_city": city_of(start),
        "pickup_state": state_of(start),
        "delivery_city": city_of(end),
        "delivery_state": state_of(end),
    }


def haul_type(pickup_state: Column, delivery_state: Column) -> Column:
    return F.when(pickup_state == delivery_state, F.lit("intrastate")).otherwise(
        F.lit("interstate")
    )


def member_key(name: Column) -> Column:
    """Key of a shipper or carrier; a missing name gets the reserved member's key."""
    return F.md5(F.coalesce(name, F.lit(UNKNOWN_MEMBER)))


def lane_key(lane: Column) -> Column:
    return F.md5(lane)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")
