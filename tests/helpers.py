"""Small raw tables for tests."""

from haulgrid.sources.landing import RAW_COLUMNS

RAW_DDL = ", ".join(f"`{name}` {kind}" for name, kind in RAW_COLUMNS.items())

PLAIN_LOAD = {
    "load_id": 1, "lane": "Austin,TX -> Reno,NV",
    "quote_date": "1/1/2024 8:00", "book_date": "1/2/2024 8:00",
    "source_date": "1/3/2024 8:00", "pickup_date": "1/4/2024 8:00",
    "delivery_date": "1/6/2024 8:00",
    "book_price": 100.0, "source_price": 80.0, "pnl": 20.0, "mileage": 500.0,
    "equipment_type": " van ", "carrier_rating": 4.0, "sourcing_channel": "api",
    "vip_carrier": False, "carrier_dropped_us_count": 0.0,
    "carrier_name": "Carrier A", "shipper_name": "Shipper A",
    "carrier_on_time_to_pickup": True, "carrier_on_time_to_delivery": True,
    "carrier_on_time_overall": True,
    "pickup_appointment_time": "1/4/2024 9:00", "delivery_appointment_time": "1/6/2024 9:00",
    "has_mobile_app_tracking": False, "has_macropoint_tracking": False,
    "has_edi_tracking": False, "contracted_load": False,
    "load_booked_autonomously": False, "load_sourced_autonomously": False,
    "load_was_cancelled": False, "has_mobile_app_tracking.1": False,
}


def raw_rows(spark, *changes):
    """Raw loads that differ from a plain one as told; ids count up unless given."""
    rows = [{**PLAIN_LOAD, "load_id": i, **change} for i, change in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_DDL)


def mart_of(spark, tmp_path, *changes):
    from haulgrid.sources.mart import LoadMart

    return LoadMart(spark, lambda: raw_rows(spark, *changes), str(tmp_path / "mart"))
