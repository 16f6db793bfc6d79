"""Declared schemas; nothing is ever inferred from data."""

from __future__ import annotations

RAW_FIELDS = [
    ("booking_id", "bigint"),
    ("property_id", "int"),
    ("created_date_txt", "string"),
    ("created_time_txt", "string"),
    ("national_id", "string"),
    ("full_name", "string"),
    ("phone", "string"),
    ("channel", "string"),
    ("sub_channel", "string"),
    ("agent_name", "string"),
    ("agent_src_id", "bigint"),
    ("status_code", "int"),
    ("booking_status", "string"),
    ("payment_status", "string"),
    ("currency", "string"),
    ("stay_date_txt", "string"),
    ("room_number", "int"),
    ("room_type", "string"),
    ("quantity", "int"),
    ("unit_price", "decimal(18,6)"),
    ("total", "decimal(18,6)"),
    ("adults", "int"),
    ("children", "int"),
]
RAW_COLUMNS = [name for name, _ in RAW_FIELDS]
RAW_STAYS = ", ".join(f"{name} {kind}" for name, kind in RAW_FIELDS)
# added at landing: place in the export (file, start of the block that was read, order inside it), parsed dates, and the
# two partition columns
BRONZE = (
    RAW_STAYS
    + ", source_file string, source_block bigint, ingest_seq bigint, sale_day date, sale_seconds int, stay_day date, stay_month int, batch_id string"
)
BRONZE_COLUMNS = [field.strip().split(" ")[0] for field in BRONZE.replace("decimal(18,6)", "decimal").split(",")]
ARRIVAL = ["batch_id", "source_file", "source_block", "ingest_seq"]

PROPERTIES = """
    property_id int, name string, city string, region string, kind string, stars int, room_count int, opened date
"""
PROPERTY_TARGETS = """
    property_id int, year int, month int, occupancy_target decimal(12,2), production_target decimal(12,2)
"""
AGENT_TARGETS = "agent_id bigint, year int, month int, production_target decimal(12,2)"

RUN_EVENTS = """
    run_id bigint, process string, action string, rows bigint, status string, message string,
    seconds decimal(10,2), started_at timestamp_ntz, ended_at timestamp_ntz, is_end boolean, lease_until timestamp_ntz
"""

LINE_MONEY = "decimal(10,2)"
HEADER_MONEY = "decimal(12,2)"
