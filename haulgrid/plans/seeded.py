"""The modeled tables with planted faults, so that every check has something to find.

The faults are told by the load id, or by the text of a member's name, so that they are the same
wherever the tables are built. Each hits a share of the rows of the given tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrid.plans.models import ROLES
from haulgrid.sources.mart import LoadMart

#: Loads whose id this divides occur twice, staged and in the fact.
TWICE = 97
#: Loads whose id this divides have a key that no member has.
ORPHANED = {"shipper_key": 89, "carrier_key": 83, "lane_key": 79}
NOBODY = "nobody"
#: Loads whose id this divides have all dates on a day that the calendar lacks.
UNDATED = 73
NO_DAY = dt.date(1901, 1, 1)
#: Loads whose id this divides have a haul type that there is not, or the other one.
ODD_TYPE, OTHER_TYPE = 71, 61
SIDEWAYS = "sideways"
#: Loads whose id this divides have the opposite delivered flag.
FLIPPED = 67
#: Lanes into this state have an odd haul type, members of this last letter occur twice, and so
#: do days of this number.
ODD_STATE, TWICE_LETTER, TWICE_DAY = "EU", "7", 13


def _hit(divisor: int):
    return F.col("load_id") % divisor == 0


def _twice(rows: DataFrame, which) -> DataFrame:
    return rows.unionByName(rows.where(which))


class SeededMart:
    """Tables of a mart with faults, derived from it in the same plan; nothing is written."""

    def __init__(self, mart: LoadMart):
        self.spark = mart.spark
        self.staged = _twice(mart.staged, _hit(TWICE))
        other = F.when(F.col("haul_type") == "intrastate", "interstate").otherwise("intrastate")
        changes = {key: F.when(_hit(divisor), F.lit(NOBODY)).otherwise(F.col(key)) for key, divisor in ORPHANED.items()}
        changes |= {date: F.when(_hit(UNDATED), F.lit(NO_DAY)).otherwise(F.col(date)) for date in ROLES.values()}
        changes["haul_type"] = F.when(_hit(ODD_TYPE), SIDEWAYS).when(_hit(OTHER_TYPE), other).otherwise(F.col("haul_type"))
        changes["is_delivered"] = F.when(_hit(FLIPPED), ~F.col("is_delivered")).otherwise(F.col("is_delivered"))
        self.facts = _twice(mart.facts.withColumns(changes), _hit(TWICE))
        odd = F.when(F.col("delivery_state") == ODD_STATE, F.lit(SIDEWAYS)).otherwise(F.col("haul_type"))
        self.lanes = _twice(mart.lanes.withColumn("haul_type", odd), F.col("pickup_city").endswith(TWICE_LETTER))
        self.shippers = _twice(mart.shippers, F.col("shipper_name").endswith(TWICE_LETTER))
        self.carriers = _twice(mart.carriers, F.col("carrier_name").endswith(TWICE_LETTER))
        self.calendar = _twice(mart.calendar, F.dayofmonth("date_day") == TWICE_DAY)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "stg_loads": self.staged, "dim_date": self.calendar, "dim_shipper": self.shippers,
            "dim_carrier": self.carriers, "dim_lane": self.lanes, "fct_loads": self.facts,
        }


def seeded(mart: LoadMart) -> SeededMart:
    return SeededMart(mart)
