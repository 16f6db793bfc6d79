"""What each query should return, as SQL for DuckDB over the driver's tables."""

from __future__ import annotations

from stayline.plans.registry import COMPARE_YEARS, RATE, SALT
from stayline.sources import testdata as lens


def _view(name: str, columns: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(lens.projection(columns, 'timestamp'))} FROM {source})"


def _r2(value: str) -> str:
    """Two decimals, half away from zero."""
    return f"(CASE WHEN ({value}) < 0 THEN -floor(abs({value}) * 100 + 0.5) / 100 ELSE floor(abs({value}) * 100 + 0.5) / 100 END)"


def _pct(part: str, whole: str) -> str:
    return _r2(f"CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)")


def _day(text: str) -> str:
    return f"CAST(try_strptime({text}, '%d/%m/%Y') AS DATE)"


def _title(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda p: upper(p[1:1]) || p[2:]), '')"


NOT_HOLD = "NOT (payment_status = 'Unpaid' AND booking_status = 'Held')"
DOLLAR = "upper(currency) IN ('DOLARES', 'DÓLARES', 'USD')"
KEY = "booking_id, created_year"

_VIEWS = {
    "properties": _view("properties", lens.PROPERTIES, "nation"),
    "guests": _view("guests", lens.GUESTS, "customer"),
    "bookings": _view("bookings", lens.BOOKINGS, "orders"),
    "stay_nights": _view("stay_nights", lens.STAY_NIGHTS, "lineitem"),
    "runs": _view("runs", lens.RUNS, "events"),
    "run_events": _view("run_events", lens.RUN_EVENTS, "events"),
    "sales": _view("sales", lens.RAW_HEADER, "orders"),
    "raw_lines": _view("raw_lines", lens.RAW_LINE, "lineitem"),
    "raw_stays": "raw_stays AS (SELECT * FROM raw_lines JOIN sales USING (src_order))",
    "raw": f"""raw AS (SELECT *, {_day('created_date_txt')} AS created_date, {_day('stay_date_txt')} AS stay_date,
        CAST(year({_day('created_date_txt')}) AS INT) AS created_year FROM raw_stays)""",
    "headers": f"""headers AS (SELECT b.*, t.* EXCLUDE ({KEY}) FROM bookings b LEFT JOIN (
        SELECT {KEY}, count(*) AS room_nights, CAST(sum(total) AS DECIMAL(12,2)) AS booking_total,
            min(stay_date) AS checkin, CAST(max(stay_date) + INTERVAL 1 DAY AS DATE) AS checkout,
            count(DISTINCT stay_date) AS stay_days
        FROM stay_nights GROUP BY ALL) t USING ({KEY}))""",
    "channels": """channels AS (SELECT * FROM (VALUES (1, '1-URGENT', 'Reservations'), (2, '2-HIGH', 'Reservations'),
        (3, '3-MEDIUM', 'Partners'), (4, '4-NOT SPECIFIED', 'Property')) v(channel_id, channel, area))""",
    "room_types": """room_types AS (SELECT DISTINCT room_type, CASE WHEN room_type IN ('AF', 'AO', 'NF', 'NO') THEN 'Lodging'
        WHEN room_type = 'RF' THEN 'Tent' ELSE 'Other' END AS category FROM stay_nights WHERE room_type IS NOT NULL)""",
    "agents": f"""agents AS (SELECT agent_src_id + 100 AS agent_id, agent_src_id, {_title('agent_name')} AS agent_name,
        coalesce(area, 'Unclassified') AS area
        FROM (SELECT agent_src_id, agent_name, channel FROM sales WHERE agent_src_id > 0 QUALIFY row_number() OVER (
            PARTITION BY agent_src_id ORDER BY {_day('created_date_txt')} DESC, created_time_txt DESC, src_order DESC) = 1)
        LEFT JOIN channels USING (channel))""",
    "targets": """targets AS (SELECT DISTINCT agent_id, CAST(year(created_at) AS INT) AS year,
        CAST(month(created_at) AS INT) AS month, CAST(CASE WHEN agent_src_id % 10 = 3 THEN 0
            ELSE 50000 + 1000 * (agent_src_id % 10) END AS DECIMAL(12,2)) AS production_target
        FROM bookings JOIN agents USING (agent_src_id) WHERE area = 'Reservations')""",
    "rates": """rates AS (SELECT rate_date, CAST(3 + month(rate_date) / CAST(100 AS DECIMAL(4,0)) AS DECIMAL(6,4)) AS usd_rate
        FROM (SELECT DISTINCT CAST(date_trunc('quarter', created_at) AS DATE) AS rate_date FROM bookings)
        WHERE rate_date >= DATE '1995-07-01')""",
    # constraints of dimensions and targets, each broken somewhere
    "f_channels": "f_channels AS (SELECT channel, area FROM channels UNION ALL SELECT '2-HIGH', NULL)",
    "f_room_types": """f_room_types AS (SELECT room_type, CASE WHEN room_type <> 'RO' THEN category END AS category
        FROM room_types)""",
    "f_agents": """f_agents AS (SELECT * REPLACE (CASE WHEN agent_src_id % 9 <> 0 THEN agent_name END AS agent_name)
        FROM (SELECT * FROM agents UNION ALL SELECT * FROM agents WHERE agent_src_id % 11 = 0))""",
    "f_property_targets": """f_property_targets AS (SELECT CASE WHEN property_id % 8 = 0 THEN 900 ELSE property_id END
            AS property_id, year, CASE WHEN month <> 2 THEN month END AS month
        FROM (SELECT DISTINCT property_id, year(created_at) AS year, month(created_at) AS month FROM bookings))""",
    "f_agent_targets": """f_agent_targets AS (SELECT CASE WHEN month = 3 THEN -1 ELSE agent_id END AS agent_id, year, month
        FROM targets)""",
    # the same warehouse with one fault planted per health check
    "f_guests": """f_guests AS (SELECT * REPLACE (CASE WHEN guest_id % 100 = 1 THEN '00000000' ELSE national_id END
        AS national_id) FROM guests)""",
    "f_nights": """f_nights AS (SELECT * REPLACE (
        CASE WHEN l_partkey % 211 = 0 THEN created_year + 100 ELSE created_year END AS created_year,
        CASE WHEN l_partkey % 199 = 0 THEN -total ELSE total END AS total,
        CASE WHEN l_partkey % 193 = 0 THEN room_type || '?' ELSE room_type END AS room_type) FROM stay_nights)""",
    "f_headers": f"""f_headers AS (SELECT * REPLACE (
        CASE WHEN booking_id % 499 = 0 THEN -1 - guest_id ELSE guest_id END AS guest_id,
        CASE WHEN booking_id % 397 = 0 THEN 900 ELSE property_id END AS property_id,
        CASE WHEN booking_id % 311 = 0 THEN 1000 + agent_src_id ELSE agent_src_id END AS agent_src_id,
        CASE WHEN booking_id % 293 = 0 THEN CAST(checkin - INTERVAL 2 DAY AS DATE) ELSE checkout END AS checkout)
        FROM (SELECT b.*, t.* EXCLUDE ({KEY}) FROM bookings b LEFT JOIN (
            SELECT {KEY}, CAST(sum(total) AS DECIMAL(12,2)) AS booking_total, min(stay_date) AS checkin,
                CAST(max(stay_date) + INTERVAL 1 DAY AS DATE) AS checkout FROM f_nights GROUP BY ALL) t
            USING ({KEY})))""",
    "stays": f"stays AS (SELECT guest_id, {KEY}, checkin, checkout FROM headers WHERE checkin IS NOT NULL)",
    # silver, rebuilt step by step
    "usable": "usable AS (SELECT * FROM raw WHERE stay_date IS NOT NULL AND src_order % 89 <> 0)",
    "s_guests": f"""s_guests AS (SELECT CAST(row_number() OVER (ORDER BY national_id) AS BIGINT) AS guest_id, * FROM (
        SELECT national_id, {_title('full_name')} AS full_name, phone, created_date AS first_booking,
            CASE WHEN regexp_full_match(national_id, '[0-9]{{8}}') THEN 'Domestic' ELSE 'Foreign' END AS country
        FROM usable WHERE national_id <> '' QUALIFY row_number() OVER (PARTITION BY national_id
            ORDER BY created_date, src_order, room_number, l_partkey, l_suppkey, total) = 1))""",
    "s_headers": f"""s_headers AS (SELECT {KEY}, property_id, guest_id,
            CAST(created_date || ' ' || created_time_txt AS TIMESTAMP) AS created_at, channel, sub_channel,
            {_title('agent_name')} AS agent_name, agent_src_id, status_code, booking_status, payment_status, currency
        FROM usable JOIN s_guests USING (national_id) QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY created_date,
            created_time_txt, src_order, room_number, l_partkey, l_suppkey, total) = 1)""",
    "s_nights": f"""s_nights AS (SELECT CAST(row_number() OVER (ORDER BY stay_date, {KEY}, old_room, room_type, src_order,
            l_partkey, l_suppkey, total) AS BIGINT) AS line_id, * EXCLUDE (src_order, l_partkey, l_suppkey, old_room) FROM (
        SELECT {KEY}, stay_date, room_number AS old_room, CAST(room_number + 1000 * (row_number() OVER (PARTITION BY {KEY}, stay_date, room_number
                ORDER BY room_type, src_order, l_partkey, l_suppkey, total) - 1) AS INT) AS room_number, room_type, quantity,
            CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
            CAST(CASE WHEN {DOLLAR} THEN total * {RATE} ELSE total END AS DECIMAL(10,2)) AS total, adults, children,
            CAST(day(stay_date) AS INT) AS day, CAST(month(stay_date) AS INT) AS month, CAST(year(stay_date) AS INT) AS year,
            src_order, l_partkey, l_suppkey
        FROM usable SEMI JOIN s_headers USING ({KEY})))""",
}


def _with(query: str) -> str:
    return f"WITH {', '.join(_VIEWS.values())} {query}"


_BY_DAY = """SELECT stay_date AS stay_day, count(*) AS lines, CAST(sum(total) AS DOUBLE) AS revenue
    FROM ({rows}) GROUP BY stay_date"""
_JUNE = "stay_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'"

_OCCUPANCY = f"""SELECT property_id, p.name AS property, CAST(year(stay_date) AS INT) AS year,
    CAST(month(stay_date) AS INT) AS month, CAST(sum(total) AS DOUBLE) AS revenue,
    count(DISTINCT (booking_id, created_year)) AS bookings
    FROM stay_nights JOIN bookings USING ({KEY}) JOIN properties p USING (property_id) JOIN room_types USING (room_type)
    {{join}} WHERE {NOT_HOLD} AND {{filter}} GROUP BY ALL"""


def _split() -> str:
    paid, partner = "FILTER (WHERE area <> 'Partners')", "FILTER (WHERE area = 'Partners')"
    return f"""SELECT property_id, CAST(month(stay_date) AS INT) AS month, CAST(year(stay_date) AS INT) AS year,
        count(*) AS nights, CAST(sum(total) AS DOUBLE) AS revenue,
        count(*) {paid} AS paid_nights, CAST(sum(total) {paid} AS DOUBLE) AS paid_revenue,
        count(*) {partner} AS partner_nights, CAST(sum(total) {partner} AS DOUBLE) AS partner_revenue,
        {_pct(f'count(*) {paid}', 'count(*)')} AS paid_nights_pct,
        {_pct(f'sum(total) {paid}', 'sum(total)')} AS paid_revenue_pct,
        {_pct(f'count(*) {partner}', 'count(*)')} AS partner_nights_pct,
        {_pct(f'sum(total) {partner}', 'sum(total)')} AS partner_revenue_pct
        FROM stay_nights JOIN bookings USING ({KEY}) JOIN channels USING (channel) JOIN room_types USING (room_type)
        WHERE {NOT_HOLD} AND category = 'Lodging' GROUP BY ALL"""


def _pivot(condition: str) -> str:
    blocks = []
    for number in lens.PIVOT:
        here = f"FILTER (WHERE property_id = {number})"
        blocks.append(
            f"CAST(sum(total) {here} AS DOUBLE) AS p{number}_revenue, count(*) {here} AS p{number}_nights,"
            f" {_pct(f'count(*) {here}', f'max(room_count) {here}')} AS p{number}_occupancy_pct"
        )
    return f"""SELECT stay_date, {', '.join(blocks)} FROM stay_nights JOIN bookings USING ({KEY})
        JOIN properties USING (property_id) JOIN room_types USING (room_type)
        WHERE property_id NOT IN {lens.INTERNAL} AND year(stay_date) = 2000 AND month(stay_date) = 6 AND {condition}
        GROUP BY stay_date"""


def _years() -> str:
    parts = []
    for year in COMPARE_YEARS:
        here = f"FILTER (WHERE year(stay_date) = {year})"
        parts.append(f"CAST(coalesce(sum(total) {here}, 0) AS DOUBLE) AS revenue_{year}, count(*) {here} AS nights_{year}")
    last, before = (f"sum(total) FILTER (WHERE year(stay_date) = {year})" for year in (COMPARE_YEARS[-1], COMPARE_YEARS[-2]))
    growth = f"(CAST(coalesce({last}, 0) AS DOUBLE) / nullif(CAST({before} AS DOUBLE), 0) - 1) * 100"
    return f"""SELECT property_id, {', '.join(parts)}, {_r2(growth)} AS yoy_pct
        FROM stay_nights JOIN bookings USING ({KEY})
        WHERE {NOT_HOLD} AND month(stay_date) = 6 AND year(stay_date) >= {COMPARE_YEARS[0]} GROUP BY property_id"""


# fixed values, written out here as well so that a wrong one in the library shows
_LABELS = {
    1: "bookings of unknown guests", 2: "lines without a booking", 3: "lines with a negative amount",
    4: "repeated national ids", 5: "properties without a city", 6: "channels missing from the dimension",
    7: "bookings of unknown properties", 8: "last silver build", 9: "bookings above the amount limit",
    10: "check-outs before check-in", 11: "agents missing from the dimension",
    12: "room types missing from the dimension", 13: "bookings differing between bronze and silver",
}
# counts up to which a check warns; checks 6 and 8 never turn critical by their count
_WARN_UP_TO = {1: 10, 2: 0, 3: 5, 4: 0, 5: 2, 6: None, 7: 0, 9: 3, 10: 0, 11: 0, 12: 0, 13: 0}


def _status(found: str, number: int) -> str:
    limit = _WARN_UP_TO[number]
    if limit is None:
        return f"CASE WHEN {found} = 0 THEN 'OK' ELSE 'WARN' END"
    if limit == 0:
        return f"CASE WHEN {found} = 0 THEN 'OK' ELSE 'CRITICAL' END"
    return f"CASE WHEN {found} = 0 THEN 'OK' WHEN {found} <= {limit} THEN 'WARN' ELSE 'CRITICAL' END"


_FOUND = {
    1: "SELECT count(*) AS n FROM f_headers h WHERE NOT EXISTS (SELECT 1 FROM f_guests g WHERE g.guest_id = h.guest_id)",
    2: """SELECT count(*) AS n FROM f_nights l WHERE NOT EXISTS (SELECT 1 FROM bookings b
        WHERE b.booking_id = l.booking_id AND b.created_year = l.created_year)""",
    3: "SELECT count(*) AS n FROM f_nights WHERE unit_price < 0 OR total < 0",
    4: "SELECT count(*) - count(DISTINCT national_id) AS n FROM f_guests",
    5: "SELECT count(*) AS n FROM properties WHERE city IS NULL",
    6: "SELECT count(DISTINCT channel) AS n FROM f_headers WHERE channel NOT IN (SELECT channel FROM channels)",
    7: "SELECT count(*) AS n FROM f_headers WHERE property_id NOT IN (SELECT property_id FROM properties)",
    9: "SELECT count(*) AS n FROM f_headers WHERE booking_total > 150000",
    10: "SELECT count(*) AS n FROM f_headers WHERE checkout < checkin",
    11: "SELECT count(DISTINCT agent_src_id) AS n FROM f_headers WHERE agent_src_id NOT IN (SELECT agent_src_id FROM agents)",
    12: "SELECT count(DISTINCT room_type) AS n FROM f_nights WHERE room_type NOT IN (SELECT room_type FROM room_types)",
    13: """SELECT abs((SELECT count(DISTINCT (booking_id, created_year)) FROM raw WHERE national_id <> ''
        AND property_id IN (SELECT property_id FROM properties)) - (SELECT count(*) FROM f_headers)) AS n""",
}


def _health(number: int) -> str:
    label = _LABELS[number]
    if number == 8:
        return f"""SELECT 8 AS check_no, '{label}' AS label, CAST(1 AS BIGINT) AS found, CASE
            WHEN NOT EXISTS (SELECT 1 FROM runs WHERE process = 'job_0') THEN 'WARN: never run'
            WHEN (SELECT status FROM runs WHERE process = 'job_0' ORDER BY started_at DESC, run_id DESC LIMIT 1) = 'ERROR'
                THEN 'CRITICAL: last run failed'
            WHEN (SELECT max(started_at) FROM runs WHERE process = 'job_0') < TIMESTAMP '2024-01-29 00:00:00'
                THEN 'WARN: older than 2 days'
            ELSE 'OK' END AS status"""
    return f"""SELECT {number} AS check_no, '{label}' AS label, CAST(n AS BIGINT) AS found, {_status('n', number)} AS status
        FROM ({_FOUND[number]})"""


def _unique(table: str, name: str, columns: str) -> str:
    present = " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))
    return f"""SELECT '{name}' AS table_name, 'unique: {columns}' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations
        FROM (SELECT count(*) AS n FROM {table} WHERE {present} GROUP BY {columns})"""


def _broken(table: str, name: str, rule: str, condition: str) -> str:
    return f"SELECT '{name}' AS table_name, '{rule}' AS rule, count(*) AS violations FROM {table} WHERE {condition}"


def _constraints() -> str:
    parts = [
        _unique("f_guests", "guests", "guest_id"),
        _broken("f_guests", "guests", "not null: national_id", "national_id IS NULL"),
        _unique("f_headers", "bookings", KEY),
        _unique("f_nights", "stay_nights", f"{KEY}, stay_date, room_number"),
        _broken("f_headers", "bookings", "references: property_id", "property_id NOT IN (SELECT property_id FROM properties)"),
        _broken("f_headers", "bookings", "references: guest_id", "guest_id NOT IN (SELECT guest_id FROM f_guests)"),
        _broken("f_nights", "stay_nights", f"references: {KEY}", f"({KEY}) NOT IN (SELECT ({KEY}) FROM f_headers)"),
    ]
    limits = {
        "guests": {"national_id": 20, "full_name": 200, "phone": 50},
        "bookings": {"channel": 100, "sub_channel": 100, "agent_name": 200, "booking_status": 50, "payment_status": 50,
                     "currency": 20},
        "stay_nights": {"room_type": 50},
    }
    tables = {"guests": "f_guests", "bookings": "f_headers", "stay_nights": "f_nights"}
    for name, columns in limits.items():
        for column, limit in columns.items():
            parts.append(_broken(tables[name], name, f"length <= {limit}: {column}", f"length({column}) > {limit}"))
    for column in ("booking_id", "created_year", "property_id", "guest_id"):
        parts.append(_broken("f_headers", "bookings", f"not null: {column}", f"{column} IS NULL"))
    for column in ("booking_id", "created_year"):
        parts.append(_broken("f_nights", "stay_nights", f"not null: {column}", f"{column} IS NULL"))
    return " UNION ALL ".join(parts)


def _dimension_constraints() -> str:
    tables = {
        "properties": ("properties", ["property_id"], ["property_id", "name"]),
        "dim_channel": ("f_channels", ["channel"], ["channel", "area"]),
        "dim_agent": ("f_agents", ["agent_src_id"], ["agent_src_id", "agent_name", "area"]),
        "dim_room_type": ("f_room_types", ["room_type"], ["room_type", "category"]),
        "property_targets": ("f_property_targets", ["property_id", "year", "month"], ["year", "month"]),
        "agent_targets": ("f_agent_targets", ["agent_id", "year", "month"], ["year", "month"]),
    }
    parts = [
        _broken("properties", "properties", "length <= 200: name", "length(name) > 200"),
        _broken("f_property_targets", "property_targets", "references: property_id",
                "property_id NOT IN (SELECT property_id FROM properties)"),
        _broken("f_agent_targets", "agent_targets", "references: agent_id", "agent_id NOT IN (SELECT agent_id FROM f_agents)"),
    ]
    for name, (table, key, needed) in tables.items():
        parts.append(_unique(table, name, ", ".join(key)))
        parts += [_broken(table, name, f"not null: {column}", f"{column} IS NULL") for column in needed]
    return " UNION ALL ".join(parts)


_SALES = """CAST(year(created_at) AS INT) AS year, CAST(month(created_at) AS INT) AS month,
    CAST(sum(booking_total) AS DOUBLE) AS revenue, count(*) AS bookings"""
_SEGMENT = "CASE WHEN count(*) = 1 THEN 'New' WHEN count(*) <= 3 THEN 'Occasional' WHEN count(*) <= 9 THEN 'Loyal' ELSE 'VIP' END"
_FACT = f"""SELECT {KEY}, property_id, p.name AS property, guest_id, national_id, full_name, phone, channel, sub_channel,
    agent_name, booking_status, payment_status, currency, created_at, CAST(month(created_at) AS INT) AS created_month,
    room_nights, CAST(booking_total AS DOUBLE) AS booking_total, stay_date, CAST(year(stay_date) AS INT) AS stay_year,
    CAST(month(stay_date) AS INT) AS stay_month, room_number, room_type, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(total AS DOUBLE) AS total, adults, children
    FROM headers JOIN properties p USING (property_id) JOIN guests USING (guest_id) JOIN stay_nights USING ({KEY})"""
_INTERVALS = f"""SELECT guest_id, {KEY}, row_number() OVER w AS stay_no, lag(checkin) OVER w AS previous_checkin,
    lag(checkout) OVER w AS previous_checkout, checkin, CAST(checkin - lag(checkin) OVER w AS INT) AS days_between,
    CAST(checkin - lag(checkout) OVER w AS INT) AS gap_days
    FROM stays WINDOW w AS (PARTITION BY guest_id ORDER BY checkin, {KEY}) QUALIFY row_number() OVER w > 1"""

_QUERIES = {
    "date_quarantine": """SELECT CASE WHEN stay_date IS NULL OR created_date IS NULL THEN 'bad' ELSE 'good' END AS state,
        stay_date, created_date, count(*) AS lines FROM raw GROUP BY ALL""",
    "land_raw_roundtrip": _BY_DAY.format(rows="SELECT * FROM raw"),
    "delete_window": _BY_DAY.format(rows=f"SELECT * FROM raw WHERE ({_JUNE}) IS NOT TRUE"),
    "reload_window": _BY_DAY.format(
        rows=f"SELECT * REPLACE (CASE WHEN {_JUNE} THEN total * 2 ELSE total END AS total) FROM raw"
    ),
    "dedup_guests": f"""SELECT national_id, {_title('full_name')} AS full_name, phone, created_date AS first_booking,
        CASE WHEN regexp_full_match(national_id, '[0-9]{{8}}') THEN 'Domestic' ELSE 'Foreign' END AS country FROM raw
        WHERE national_id <> '' QUALIFY row_number() OVER (PARTITION BY national_id ORDER BY created_date NULLS LAST,
            src_order, room_number, l_partkey, l_suppkey, total) = 1""",
    "title_case": f"SELECT guest_id, {_title('full_name')} AS full_name FROM guests",
    "derive_country": """SELECT guest_id, CASE WHEN regexp_full_match(national_id, '[0-9]{8}') THEN 'Domestic'
        ELSE 'Foreign' END AS country FROM guests""",
    "dedup_bookings": f"""SELECT booking_id % 500 AS booking_id, created_year, property_id, guest_id,
        CAST(created_date || ' ' || created_time_txt AS TIMESTAMP) AS created_at, channel, sub_channel,
        {_title('agent_name')} AS agent_name, agent_src_id, status_code, booking_status, payment_status, currency
        FROM raw JOIN guests USING (national_id) WHERE national_id <> '' QUALIFY row_number() OVER (
            PARTITION BY raw.booking_id % 500, created_year ORDER BY created_date, created_time_txt, src_order, room_number,
            l_partkey, l_suppkey, total) = 1""",
    "offset_collisions": f"""SELECT {KEY}, CAST(date_trunc('year', stay_date) AS DATE) AS stay_date,
        CAST(room_number + 1000 * (row_number() OVER (PARTITION BY {KEY}, year(stay_date), room_number
            ORDER BY room_type, src_order, l_partkey, l_suppkey, total) - 1) AS INT) AS room_number,
        room_type, CAST(total AS DOUBLE) AS total, l_partkey, l_suppkey FROM raw""",
    "to_local_currency": f"""SELECT {KEY}, l_partkey, l_suppkey, currency, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(CAST(CASE WHEN {DOLLAR} THEN total * {RATE} ELSE total END AS DECIMAL(10,2)) AS DOUBLE) AS total FROM raw""",
    "rate_as_of": f"""SELECT {KEY}, l_partkey, l_suppkey, created_date, CAST(rate AS DOUBLE) AS usd_rate,
        CAST(CAST(CASE WHEN {DOLLAR} THEN total * rate ELSE total END AS DECIMAL(10,2)) AS DOUBLE) AS total
        FROM (SELECT *, coalesce(usd_rate, CAST({RATE} AS DECIMAL(6,4))) AS rate
            FROM raw ASOF LEFT JOIN rates ON created_date >= rate_date)""",
    "keep_with_header": f"""SELECT {KEY}, stay_date, room_number, CAST(total AS DOUBLE) AS total, l_partkey, l_suppkey
        FROM stay_nights l WHERE EXISTS (SELECT 1 FROM bookings b JOIN orders o ON b.guest_id = o.o_custkey
            WHERE b.booking_id = l.booking_id AND b.created_year = l.created_year AND b.guest_id % 50 <> 0)""",
    "backfill_headers": "SELECT * REPLACE (CAST(booking_total AS DOUBLE) AS booking_total) FROM headers",
    "date_parts": """SELECT stay_date, CAST(day(stay_date) AS INT) AS day, CAST(month(stay_date) AS INT) AS month,
        CAST(year(stay_date) AS INT) AS year, count(*) AS lines FROM stay_nights GROUP BY ALL""",
    "silver_counts": """SELECT (SELECT count(*) FROM s_guests) AS guests, (SELECT count(*) FROM s_headers) AS bookings,
        (SELECT count(*) FROM s_nights) AS lines, (SELECT count(*) FROM raw
            WHERE stay_date IS NULL OR src_order % 89 = 0) AS quarantined""",
    "silver_bookings": f"""SELECT h.*, room_nights, CAST(booking_total AS DOUBLE) AS booking_total, checkin, checkout, stay_days
        FROM s_headers h LEFT JOIN (SELECT {KEY}, count(*) AS room_nights, sum(total) AS booking_total,
            min(stay_date) AS checkin, CAST(max(stay_date) + INTERVAL 1 DAY AS DATE) AS checkout,
            count(DISTINCT stay_date) AS stay_days FROM s_nights GROUP BY ALL) USING ({KEY})""",
    "silver_nights": """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(total AS DOUBLE) AS total)
        FROM s_nights""",
    "master_targets": """SELECT DISTINCT b.property_id, CAST(year(created_at) AS INT) AS year,
        CAST(month(created_at) AS INT) AS month, CAST(20000 + 100 * b.property_id AS DOUBLE) AS occupancy_target,
        CAST(30000 + 100 * month(created_at) AS DOUBLE) AS production_target, name, room_count
        FROM bookings b JOIN properties p USING (property_id)""",
    "surrogate_keys": "SELECT row_number() OVER (ORDER BY national_id) AS guest_key, national_id FROM guests",
    "constraint_violations": _constraints(),
    "dimension_violations": _dimension_constraints(),
    "calendar": """SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
        CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter, CAST(dayofweek(d) AS INT) AS day_of_week,
        dayname(d) AS day_name, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend,
        strftime(d, '%b %Y') AS month_label, 'Q' || quarter(d) || ' ' || year(d) AS quarter_label,
        CAST(year(d) * 100 + month(d) AS INT) AS year_month
        FROM (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY)) AS d FROM (
            SELECT min(x) AS low, max(x) AS high FROM (SELECT stay_date AS x FROM stay_nights
                UNION ALL SELECT CAST(created_at AS DATE) FROM bookings)))""",
    "channel_dim": """SELECT channel, CAST(channel_id AS BIGINT) AS channel_id, coalesce(area, 'Unclassified') AS area,
        CASE WHEN area IS NOT NULL THEN true END AS active, count(*) AS bookings
        FROM bookings LEFT JOIN channels USING (channel) GROUP BY ALL""",
    # from the raw lines: a sale without lines never reaches bronze
    "agent_dim": f"""SELECT row_number() OVER (ORDER BY agent_src_id) AS agent_id, agent_src_id,
        {_title('agent_name')} AS agent_name, coalesce(area, 'Unclassified') AS area, true AS active,
        TIMESTAMP '2024-01-31 00:00:00' AS created_at
        FROM (SELECT DISTINCT agent_src_id, agent_name, channel FROM (SELECT agent_src_id, agent_name, channel, rank() OVER (
            PARTITION BY agent_src_id ORDER BY created_date DESC, created_time_txt DESC, src_order DESC) AS place
            FROM raw WHERE agent_src_id > 0) WHERE place = 1) LEFT JOIN channels USING (channel)""",
    "room_type_dim": """SELECT row_number() OVER (ORDER BY room_type) AS room_type_id, room_type, category, true AS active
        FROM room_types""",
    "stable_guest_keys": """SELECT row_number() OVER (ORDER BY first <> 1995, national_id) AS guest_id, national_id FROM (
        SELECT national_id, min(created_year) AS first FROM raw WHERE stay_date IS NOT NULL AND national_id <> ''
        GROUP BY national_id)""",
    "dim_refresh": """SELECT row_number() OVER (ORDER BY first <> 1995, national_id) AS guest_key, national_id FROM (
        SELECT national_id, min(year(CAST(strptime(created_date_txt, '%d/%m/%Y') AS DATE))) AS first FROM sales
        GROUP BY national_id)""",
    "guest_metrics": f"""SELECT guest_id, count(*) AS bookings, CAST(sum(booking_total) AS DOUBLE) AS spend,
        CAST(min(created_at) AS DATE) AS first_sale, CAST(max(created_at) AS DATE) AS last_sale,
        count(*) FILTER (WHERE year(checkin) = 2000) AS bookings_this_year,
        CAST(sum(booking_total) FILTER (WHERE year(checkin) = 2000) AS DOUBLE) AS spend_this_year,
        count(*) FILTER (WHERE year(checkin) = 2000) >= 1 AS active_this_year, count(*) > 1 AS returning,
        {_SEGMENT} AS segment FROM headers WHERE {NOT_HOLD} GROUP BY guest_id""",
    "stay_fact": _FACT,
    "pii_safe": f"""SELECT sha256('{SALT}' || national_id) AS guest_hash, count(*) AS nights,
        CAST(sum(CAST(total AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM ({_FACT}) GROUP BY national_id""",
    "gold_refresh": f"""SELECT 'guest_metrics' AS table_name, count(DISTINCT guest_id) AS row_count,
        CAST(sum(booking_total) AS DOUBLE) AS amount FROM headers WHERE {NOT_HOLD}
        UNION ALL SELECT 'stay_fact', count(*), CAST(sum(CAST(total AS DECIMAL(12,2))) AS DOUBLE) FROM ({_FACT})""",
    "occupancy_total": _OCCUPANCY.format(join="", filter="category = 'Lodging'"),
    "occupancy_reservations_desk": _OCCUPANCY.format(
        join="JOIN channels USING (channel)", filter="category = 'Lodging' AND area = 'Reservations'"
    ),
    "occupancy_by_category": _OCCUPANCY.format(join="", filter="category IN ('Lodging', 'Tent')"),
    "paid_partner_split": _split(),
    "agent_by_property": f"""SELECT property_id, b.agent_src_id, CAST(month(stay_date) AS INT) AS month,
        CAST(year(stay_date) AS INT) AS year, CAST(sum(total) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity,
        p.name AS property, a.agent_name
        FROM stay_nights JOIN bookings b USING ({KEY}) JOIN properties p USING (property_id) JOIN channels c USING (channel)
        JOIN room_types USING (room_type) LEFT JOIN agents a ON a.agent_src_id = b.agent_src_id
        WHERE c.area = 'Reservations' AND {NOT_HOLD} AND category = 'Lodging' GROUP BY ALL""",
    "production": f"""SELECT property_id, {_SALES}, p.name AS property FROM headers JOIN properties p USING (property_id)
        JOIN channels USING (channel) WHERE {NOT_HOLD} AND area = 'Reservations' GROUP BY ALL""",
    "agent_attainment": f"""SELECT s.agent_id, agent_name, area, s.year, s.month, revenue, bookings,
        CAST(production_target AS DOUBLE) AS production_target, {_pct('revenue', 'production_target')} AS attainment_pct
        FROM (SELECT agent_id, a.agent_name, area, {_SALES} FROM headers JOIN agents a USING (agent_src_id)
            WHERE {NOT_HOLD} GROUP BY ALL) s
        LEFT JOIN targets t ON t.agent_id = s.agent_id AND t.year = s.year AND t.month = s.month""",
    "agent_daily": f"""SELECT agent_id, a.agent_name, CAST(created_at AS DATE) AS sale_date,
        CAST(year(created_at) AS INT) AS year, CAST(month(created_at) AS INT) AS month, CAST(day(created_at) AS INT) AS day,
        CAST(sum(total) AS DOUBLE) AS revenue, count(*) AS room_nights, count(DISTINCT (booking_id, created_year)) AS bookings,
        agent_id || '-' || strftime(created_at, '%Y%m') AS agent_month
        FROM bookings JOIN stay_nights USING ({KEY}) JOIN channels c USING (channel) JOIN agents a USING (agent_src_id)
        WHERE c.area = 'Reservations' AND {NOT_HOLD} GROUP BY ALL""",
    "daily_occupancy_pivot": _pivot(f"{NOT_HOLD} AND category = 'Lodging'"),
    "daily_occupancy_pivot_all": _pivot("true"),
    "same_month_by_year": _years(),
    "post_stay_contacts": f"""SELECT phone, given_names FROM (
        SELECT CASE WHEN regexp_full_match(phone, '[0-9]{{9}}') THEN '51' || phone
                WHEN regexp_full_match(phone, '51[0-9]{{9}}') THEN phone ELSE 'bad' END AS phone,
            split_part(full_name, ' ', 3) || ' ' || split_part(full_name, ' ', 4) AS given_names
        FROM headers JOIN guests USING (guest_id) WHERE property_id NOT IN {lens.INTERNAL} AND year(checkout) = 2000
            AND month(checkout) = 6 AND day(checkout) IN (13, 14)
        QUALIFY row_number() OVER (PARTITION BY national_id ORDER BY booking_total DESC NULLS LAST, checkin NULLS LAST, {KEY}) = 1)
        WHERE phone <> 'bad'""",
    "rate_vs_network": f"""SELECT property_id, property, {_r2('rate')} AS avg_rate, {_r2('network')} AS network_rate,
        {_r2('rate * 100 / network')} AS pct_of_network FROM (
            SELECT property_id, p.name AS property, CAST(sum(total) AS DOUBLE) / count(total) AS rate,
                (SELECT CAST(sum(total) AS DOUBLE) / count(total) FROM stay_nights) AS network
            FROM stay_nights JOIN bookings USING ({KEY}) JOIN properties p USING (property_id) GROUP BY ALL)""",
    # the pairs themselves, numbered and then gathered by later stay
    "stay_pairs": """SELECT guest_id, booking_id, created_year, checkin, checkout, count(*) AS earlier_stays,
        min(pair_no) AS first_pair, max(pair_no) AS last_pair, any_value(guest_pairs) AS guest_pairs FROM (
            SELECT l.*, row_number() OVER (PARTITION BY l.guest_id ORDER BY l.checkin, l.booking_id, l.created_year) AS pair_no,
                count(*) OVER (PARTITION BY l.guest_id) AS guest_pairs
            FROM stays e JOIN stays l ON e.guest_id = l.guest_id AND e.checkin < l.checkin)
        WHERE guest_pairs > 1 GROUP BY ALL""",
    "stay_pair_rows": """SELECT * EXCLUDE (guest_pairs) FROM (
            SELECT l.guest_id, row_number() OVER (PARTITION BY l.guest_id ORDER BY l.checkin, l.booking_id, l.created_year,
                    e.checkin, e.booking_id, e.created_year) AS pair_no, count(*) OVER (PARTITION BY l.guest_id) AS guest_pairs,
                e.booking_id AS earlier_booking_id, e.created_year AS earlier_created_year, e.checkin AS earlier_checkin,
                e.checkout AS earlier_checkout, l.booking_id, l.created_year, l.checkin, l.checkout,
                CAST(l.checkin - e.checkin AS INT) AS days_between
            FROM stays e JOIN stays l ON e.guest_id = l.guest_id AND e.checkin < l.checkin)
        WHERE guest_pairs > 1 AND pair_no <= 10""",
    "return_intervals": _INTERVALS,
    "return_median": f"""SELECT count(*) AS returns, CAST(median(days_between) AS DOUBLE) AS median_days FROM ({_INTERVALS})""",
    **{f"health_{number:02d}": _health(number) for number in range(1, 14)},
    "health_report": " UNION ALL ".join(_health(number) for number in range(1, 14)),
    "recent_runs": """SELECT run_id, process, action, rows, status, CAST(seconds AS DOUBLE) AS seconds,
        strftime(started_at, '%d/%m/%Y %H:%M:%S') AS started, message FROM runs
        ORDER BY started_at DESC NULLS LAST, run_id DESC LIMIT 50""",
    "run_stats": f"""SELECT process, count(*) AS runs, count(*) FILTER (WHERE status = 'OK') AS succeeded,
        count(*) FILTER (WHERE status = 'ERROR') AS failed, {_r2('CAST(sum(seconds) AS DOUBLE) / count(seconds)')} AS avg_seconds,
        CAST(max(seconds) AS DOUBLE) AS max_seconds, max(started_at) AS last_start FROM runs
        WHERE started_at >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY process""",
    "run_states": """SELECT CASE WHEN NOT e.is_end AND e.lease_until < TIMESTAMP '2024-01-15 00:00:00' THEN 'ABANDONED' ELSE e.status END AS status,
        count(*) AS runs FROM (SELECT run_id, max({'is_end': is_end, 'lease_until': lease_until, 'status': status}) AS e FROM run_events GROUP BY run_id) GROUP BY ALL""",
    "run_audit": """SELECT 'count_lines' AS process, 'SCAN' AS action, (SELECT count(*) FROM stay_nights) AS rows,
        'OK' AS status, true AS timed, true AS ended
        UNION ALL SELECT 'load_targets', 'READ', (SELECT count(*) FROM bookings), 'ERROR', true, true""",
}

ORACLES = {name: _with(query) for name, query in _QUERIES.items()}
