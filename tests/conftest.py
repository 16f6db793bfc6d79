import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from stayline.session import local_session
from stayline.sources import schemas


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # many tiny queries: compiling them well costs more than it saves
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8, shuffle_partitions=2, memory="6g", java_options="-XX:TieredStopAtLevel=1", shared=shared
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


RAW_DEFAULTS = dict(
    booking_id=1, property_id=10, created_date_txt="05/01/2025", created_time_txt="10:00:00", national_id="12345678",
    full_name="PEREZ LOPEZ ANA MARIA", phone="987654321", channel="AGENCIAS", sub_channel=None, agent_name="ana ruiz",
    agent_src_id=7, status_code=1, booking_status="Confirmado", payment_status="Pagado", currency="SOLES",
    stay_date_txt="10/02/2025", room_number=101, room_type="SUITE", quantity=1, unit_price=Decimal("100"),
    total=Decimal("100"), adults=2, children=0,
)


@pytest.fixture
def raw(spark):
    """Raw lines from partial rows; `batch_id` and `ingest_seq` give the order of arrival."""
    types = StructType.fromDDL(schemas.RAW_STAYS + ", batch_id string, source_file string, source_block bigint, ingest_seq bigint")

    def build(*rows):
        full = [{**RAW_DEFAULTS, "batch_id": "b", "source_file": "", "source_block": 0, "ingest_seq": at, **row} for at, row in enumerate(rows)]
        return spark.createDataFrame([tuple(row[f.name] for f in types) for row in full], types)

    return build


@pytest.fixture
def table(spark):
    def build(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return build


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def day(text):
    return dt.date.fromisoformat(text)
