"""DuckDB SQL giving the expected result of each registered query.

Written against the given tables only.  ``sql`` puts the named subqueries a statement mentions in
front of it.
"""

from __future__ import annotations

import re

from tripmart import schemas as S

WIDE_LO, WIDE_HI = "DATE '1990-01-01'", "DATE '2009-12-31'"
LO, HI = "DATE '1997-01-01'", "DATE '1999-12-31'"
MONTHS_IN_SCOPE = "1,2,3,4,5,6,7,8,9,10,11,12"

_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}

CTES: dict[str, str] = {}

CTES["trip_lines"] = """
    SELECT l_orderkey, l_suppkey % 2 + 1 AS vendorid,
           o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
           CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
           l_quantity AS trip_distance,
           CAST(l_orderkey % 6 + 1 AS DOUBLE) AS ratecodeid,
           ' ' || l_linestatus || ' ' AS store_and_fwd_flag,
           CAST(c_nationkey AS BIGINT) AS pulocationid, CAST(s_nationkey AS BIGINT) AS dolocationid,
           CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE (l_linenumber + l_partkey) % 9 - 1 END AS payment_type,
           l_extendedprice AS fare_amount,
           l_discount * 10 AS extra,
           CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
           CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) + 50) // 100 AS DOUBLE) / 100 AS tip_amount,
           CASE WHEN l_tax = 0 THEN NULL ELSE round(l_tax * 10, 2) END AS tolls_amount,
           CAST(1.0 AS DOUBLE) AS improvement_surcharge,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice
                ELSE CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
                           * (100 - CAST(round(l_discount * 100) AS BIGINT))
                           * (100 + CAST(round(l_tax * 100) AS BIGINT)) + 5000) // 10000 AS DOUBLE) / 100
           END AS total_amount,
           CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
           CAST(NULL AS DOUBLE) AS airport_fee
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey"""

_RAW = ", ".join(S.TRIPS_RAW.names)

CTES["trips_raw"] = f"""
    SELECT {_RAW} FROM trip_lines
    UNION ALL
    SELECT {_RAW} FROM trip_lines WHERE l_orderkey % 97 = 0"""

CTES["weather_raw"] = """
    SELECT CASE WHEN day(o_orderdate) = 29 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
           max(o_totalprice) / 10000 AS temperature_2m_max,
           min(o_totalprice) / 10000 AS temperature_2m_min,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE)
               / (count(*) * CAST(1000000 AS DOUBLE)) AS temperature_2m_mean,
           CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS precipitation_sum,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS snowfall_sum
    FROM orders GROUP BY 1"""

CTES["zones_raw"] = """
    SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey END AS location_id,
           r_name AS borough, n_name AS zone,
           CASE WHEN n_regionkey < 2 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["bronze_trips"] = """
    SELECT * REPLACE (trim(store_and_fwd_flag) AS store_and_fwd_flag), CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
           CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month
    FROM trips_raw WHERE tpep_pickup_datetime IS NOT NULL"""

CTES["bronze_weather"] = """
    SELECT *, CAST(year(date) AS INTEGER) AS weather_year, CAST(month(date) AS INTEGER) AS weather_month
    FROM weather_raw WHERE date IS NOT NULL"""

CTES["bronze_zones"] = "SELECT DISTINCT * FROM zones_raw WHERE location_id IS NOT NULL"

CTES["derived_trips"] = """
    SELECT CAST(vendorid AS INTEGER) AS vendor_id,
           tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
           pickup_date, pickup_year, pickup_month,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
           CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS DOUBLE) / 60 AS trip_duration_minutes,
           CAST(ratecodeid AS INTEGER) AS rate_code_id, store_and_fwd_flag,
           CAST(pulocationid AS INTEGER) AS pickup_location_id,
           CAST(dolocationid AS INTEGER) AS dropoff_location_id,
           CAST(payment_type AS INTEGER) AS payment_type_code,
           fare_amount, extra AS extra_amount, mta_tax AS mta_tax_amount, tip_amount, tolls_amount,
           improvement_surcharge AS improvement_surcharge_amount,
           congestion_surcharge AS congestion_surcharge_amount, airport_fee AS airport_fee_amount,
           total_amount
    FROM bronze_trips"""

_KEY = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in S.TRIP_KEY)

CTES["keyed_trips"] = f"SELECT sha256(concat_ws('||', {_KEY})) AS trip_id, * FROM derived_trips"

CTES["clean_trips"] = f"""
    SELECT * FROM keyed_trips
    WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND pickup_date IS NOT NULL
      AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
      AND pickup_datetime < dropoff_datetime AND trip_duration_minutes > 0
      AND pickup_date BETWEEN {WIDE_LO} AND {WIDE_HI}"""

CTES["silver_trips"] = """
    SELECT * FROM clean_trips
    QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY passenger_count NULLS FIRST,
        rate_code_id NULLS FIRST, store_and_fwd_flag NULLS FIRST, payment_type_code NULLS FIRST,
        fare_amount NULLS FIRST, extra_amount NULLS FIRST, mta_tax_amount NULLS FIRST,
        tip_amount NULLS FIRST, tolls_amount NULLS FIRST,
        improvement_surcharge_amount NULLS FIRST, congestion_surcharge_amount NULLS FIRST,
        airport_fee_amount NULLS FIRST) = 1"""

CTES["silver_weather"] = """
    SELECT date AS weather_date, temperature_2m_max AS temperature_max,
           temperature_2m_min AS temperature_min, temperature_2m_mean AS temperature_mean,
           precipitation_sum, snowfall_sum, precipitation_sum > 0 AS is_rainy_day,
           snowfall_sum > 0 AS is_snowy_day, weather_year, weather_month
    FROM bronze_weather"""

CTES["silver_zones"] = "SELECT location_id, borough, zone, service_zone FROM bronze_zones"


def _calendar(day: str) -> str:
    return f"""
           CAST(year({day}) AS INTEGER) AS year_num, CAST(quarter({day}) AS INTEGER) AS quarter_num,
           CAST(month({day}) AS INTEGER) AS month_num, strftime({day}, '%B') AS month_name,
           CAST(day({day}) AS INTEGER) AS day_num_in_month,
           CAST(dayofweek({day}) + 1 AS INTEGER) AS day_of_week_num,
           strftime({day}, '%A') AS day_of_week_name,
           dayofweek({day}) IN (0, 6) AS is_weekend"""


CTES["dim_date"] = f"""
    SELECT date_day, {_calendar('date_day')}
    FROM (SELECT DISTINCT pickup_date AS date_day FROM silver_trips)"""

CTES["dim_zone"] = "SELECT * FROM silver_zones"

CTES["dim_weather"] = """
    SELECT weather_date, temperature_max, temperature_min, temperature_mean, precipitation_sum,
           snowfall_sum, is_rainy_day, is_snowy_day FROM silver_weather"""

_FACT = [n for n in S.FACT_TRIPS.names[:-1]]
_FILLED = ", ".join(
    "w.weather_date" if n == "weather_date"
    else f"coalesce(t.{n}, 0.0) AS {n}" if n in S.OPTIONAL_AMOUNTS else f"t.{n}"
    for n in _FACT
)

CTES["fact_trips"] = f"""
    SELECT {_FILLED}
    FROM silver_trips t
    LEFT JOIN dim_date d ON t.pickup_date = d.date_day
    LEFT JOIN dim_zone p ON t.pickup_location_id = p.location_id
    LEFT JOIN dim_zone z ON t.dropoff_location_id = z.location_id
    LEFT JOIN dim_weather w ON t.pickup_date = w.weather_date"""

_NEGATIVE = "count(*) FILTER (WHERE f.total_amount < 0) AS negative_total_amount_trip_count"

CTES["fact_trips_faulty"] = """
    SELECT * REPLACE (CASE WHEN day(pickup_date) = 2 THEN 'x' || substr(trip_id, 2, 63)
        ELSE trip_id END AS trip_id) FROM fact_trips WHERE day(pickup_date) <> 1"""

CTES["mart_daily_demand"] = f"""
    SELECT f.pickup_date, f.pickup_year, f.pickup_month, d.quarter_num, d.month_name,
           d.day_num_in_month, d.day_of_week_num, d.day_of_week_name, d.is_weekend,
           count(*) AS trip_count, CAST(sum(f.passenger_count) AS BIGINT) AS total_passenger_count,
           sum(f.trip_distance) AS total_trip_distance,
           sum(f.trip_duration_minutes) AS total_trip_duration_minutes,
           sum(f.total_amount) AS total_revenue, sum(f.fare_amount) AS total_fare_amount,
           sum(f.tip_amount) AS total_tip_amount, sum(f.tolls_amount) AS total_tolls_amount,
           avg(f.trip_distance) AS avg_trip_distance,
           avg(f.trip_duration_minutes) AS avg_trip_duration_minutes,
           avg(f.total_amount) AS avg_total_amount, avg(f.fare_amount) AS avg_fare_amount,
           avg(f.tip_amount) AS avg_tip_amount, {_NEGATIVE}
    FROM fact_trips f LEFT JOIN dim_date d ON f.pickup_date = d.date_day
    GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9"""


def label(code: str) -> str:
    arms = " ".join(f"WHEN {c} THEN '{t}'" for c, t in S.PAYMENT_LABELS.items())
    return f"CASE WHEN {code} IS NULL THEN 'Missing' ELSE CASE {code} {arms} ELSE 'Other' END END"


CTES["payment_groups"] = """
    SELECT pickup_date, pickup_year, pickup_month,
           CAST(coalesce(payment_type_code, -1) AS INTEGER) AS payment_type_code,
           count(*) AS trip_count, sum(total_amount) AS total_revenue,
           sum(fare_amount) AS total_fare_amount, sum(tip_amount) AS total_tip_amount,
           avg(total_amount) AS avg_total_amount, avg(fare_amount) AS avg_fare_amount,
           avg(tip_amount) AS avg_tip_amount
    FROM fact_trips GROUP BY 1, 2, 3, 4"""

CTES["mart_daily_payment_mix"] = f"""
    SELECT *, {label('payment_type_code')} AS payment_type_name,
           CASE WHEN sum(trip_count) OVER w > 0
                THEN CAST(trip_count AS DOUBLE) / CAST(sum(trip_count) OVER w AS DOUBLE) ELSE 0.0 END AS payment_trip_share_pct,
           CASE WHEN sum(total_revenue) OVER w <> 0
                THEN total_revenue / sum(total_revenue) OVER w ELSE 0.0 END AS payment_revenue_share_pct
    FROM payment_groups WINDOW w AS (PARTITION BY pickup_date)"""

_SHORT = f"""count(*) AS trip_count, sum(f.total_amount) AS total_revenue,
           sum(f.fare_amount) AS total_fare_amount, sum(f.tip_amount) AS total_tip_amount,
           avg(f.total_amount) AS avg_total_amount, avg(f.trip_distance) AS avg_trip_distance,
           avg(f.trip_duration_minutes) AS avg_trip_duration_minutes, {_NEGATIVE}"""

CTES["mart_weather_impact"] = f"""
    SELECT f.pickup_date, f.pickup_year, f.pickup_month, d.day_of_week_num, d.day_of_week_name,
           d.is_weekend, w.weather_date, w.is_rainy_day, w.is_snowy_day, w.temperature_max,
           w.temperature_min, w.temperature_mean, w.precipitation_sum, w.snowfall_sum, {_SHORT}
    FROM fact_trips f LEFT JOIN dim_date d ON f.pickup_date = d.date_day
    LEFT JOIN dim_weather w ON f.weather_date = w.weather_date
    GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14"""

CTES["mart_zone_demand"] = f"""
    SELECT f.pickup_date, f.pickup_year, f.pickup_month, f.pickup_location_id, z.borough, z.zone,
           z.service_zone, {_SHORT}
    FROM fact_trips f LEFT JOIN dim_zone z ON f.pickup_location_id = z.location_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7"""


def sql(body: str) -> str:
    """``body`` with every subquery it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit_cte(name)

    def visit_cte(name: str) -> None:
        if name in open_:
            return
        open_.add(name)
        visit(CTES[name])
        if name not in needed:
            needed.append(name)

    open_: set[str] = set()
    visit(body)
    if not needed:
        return body
    heads = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {heads},\n{body.lstrip()[5:]}"
    return f"WITH {heads}\n{body}"


def comparable(table: str) -> str:
    """Select list of a layer table as the queries show it."""
    return ", ".join(shown(n, S.CONTRACTS[table].types[n]) for n in visible(table))


def visible(table: str) -> list[str]:
    return [
        n for n in S.CONTRACTS[table].names if not n.endswith("_loaded_at") and n != "source_file"
    ]


def shown(name: str, kind: str = "double") -> str:
    if name.startswith(("total_", "daily_revenue")) and kind == "double":
        return f"round({name}, 2) AS {name}"
    if name.startswith("avg_") or name.endswith("_share_pct"):
        return f"{steady(name)} AS {name}"
    return name


def steady(expression: str) -> str:
    """Cut to about six decimals at a place where no short decimal lies."""
    return f"floor(CAST({expression} AS DOUBLE) * 1000000 + CAST(0.2123 AS DOUBLE)) / 1000000"


def count_if(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def profile(table: str, conditions: dict[str, str], others: dict[str, str] | None = None) -> str:
    parts = [f"{e} AS {n}" for n, e in (others or {}).items()]
    parts += [count_if(c, n) for n, c in conditions.items()]
    return f"SELECT {', '.join(parts)} FROM {table}"


def nulls(names: list[str], suffix: str = "_nulls") -> dict[str, str]:
    """Load time and file columns, filled by construction, are never null."""
    return {f"{n}{suffix}": "FALSE" if technical(n) else f"{n} IS NULL" for n in names}


def technical(name: str) -> bool:
    return name.endswith("_loaded_at") or name == "source_file"


def report(table: str, conditions: dict[str, str], severity="error", dataset: str | None = None) -> str:
    rows = []
    for name, condition in conditions.items():
        level = severity.get(name, "error") if isinstance(severity, dict) else severity
        rows.append(
            f"SELECT '{dataset or table}' AS dataset, '{name}' AS check_name, '{level}' AS severity,"
            f" count(*) FILTER (WHERE {condition}) AS violations FROM {table}"
        )
    return "\nUNION ALL ".join(rows)


def counted(dataset: str, name: str, expression: str, severity: str = "error") -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, '{severity}' AS severity,"
        f" CAST({expression} AS BIGINT) AS violations"
    )


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


TIME_ORDER = {
    "bad_time_order_rows": "pickup_datetime >= dropoff_datetime",
    "non_positive_duration_rows": "trip_duration_minutes <= 0",
}
PARTS = {
    "bad_pickup_year_rows": "pickup_year <> year(pickup_date)",
    "bad_pickup_month_rows": "pickup_month <> month(pickup_date)",
    "bad_pickup_hour_rows": "pickup_hour <> hour(pickup_datetime)",
}
FLAGS = {
    "bad_rain_flag_rows": "precipitation_sum > 0 AND NOT is_rainy_day",
    "bad_non_rain_flag_rows": "precipitation_sum <= 0 AND is_rainy_day",
    "bad_snow_flag_rows": "snowfall_sum > 0 AND NOT is_snowy_day",
    "bad_non_snow_flag_rows": "snowfall_sum <= 0 AND is_snowy_day",
}
DATE_LOGIC = {
    "bad_year_num_rows": "year_num <> year(date_day)",
    "bad_quarter_num_rows": "quarter_num <> quarter(date_day)",
    "bad_month_num_rows": "month_num <> month(date_day)",
    "bad_day_num_rows": "day_num_in_month <> day(date_day)",
    "bad_day_of_week_rows": "day_of_week_num <> dayofweek(date_day) + 1",
    "bad_weekend_rows": "is_weekend <> (day_of_week_num IN (1, 7))",
}
BLANKS = {
    f"blank_{c}_rows": f"trim(coalesce({c}, '')) = ''" for c in ("borough", "zone", "service_zone")
}
LOOSE_BLANKS = {f"blank_{c}_rows": f"trim({c}) = ''" for c in ("borough", "zone", "service_zone")}
WEATHER_MATCH = {"bad_weather_date_match_rows": "pickup_date <> weather_date"}

LAYERS = list(S.CONTRACTS)
SILVER = ["silver_trips", "silver_weather", "silver_zones"]
GOLD = ["dim_date", "dim_zone", "dim_weather", "fact_trips"]
MARTS = ["mart_daily_demand", "mart_daily_payment_mix", "mart_weather_impact", "mart_zone_demand"]


def negatives(columns, suffix="_rows"):
    return {f"negative_{c}{suffix}": f"{c} < 0" for c in columns}


def outside(day: str) -> str:
    return f"({day} < {LO} OR {day} > {HI})"


def outside_month(year: str, month: str) -> str:
    inside = " OR ".join(f"({year} = {y} AND {month} IN ({MONTHS_IN_SCOPE}))" for y in (1997, 1998, 1999))
    return f"NOT ({inside})"


def mart_conditions(name: str) -> dict[str, str]:
    out = nulls(S.REQUIRED[name])
    out.update({n: PARTS[n] for n in ("bad_pickup_year_rows", "bad_pickup_month_rows")})
    out["non_positive_trip_count_rows"] = "trip_count <= 0"
    if name == "mart_daily_demand":
        out["negative_negative_trip_count_rows"] = "negative_total_amount_trip_count < 0"
    if name == "mart_daily_payment_mix":
        out.update(share_ranges("0"))
    if name == "mart_weather_impact":
        out["bad_weather_match_rows"] = "pickup_date <> weather_date"
    if name == "mart_zone_demand":
        out.update(BLANKS)
    return out


def share_ranges(tolerance: str) -> dict[str, str]:
    return {
        f"out_of_range_{n}_share_rows":
            f"payment_{n}_share_pct < -{tolerance} OR payment_{n}_share_pct > 1 + {tolerance}"
        for n in ("trip", "revenue")
    }


def duplicate_keys(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"(SELECT count(*) FROM (SELECT {k} FROM {table} GROUP BY {k} HAVING count(*) > 1))"


def unmatched(table: str, column: str, other: str, key: str) -> str:
    return (
        f"(SELECT count(*) FROM {table} a LEFT JOIN {other} b ON a.{column} = b.{key}"
        f" WHERE b.{key} IS NULL)"
    )


def relation(source: str, target: str, may_shrink: bool) -> str:
    s, t = f"(SELECT count(*) FROM {source})", f"(SELECT count(*) FROM {target})"
    return union(
        [
            counted(target, "target_above_source", f"greatest({t} - {s}, 0)"),
            counted(target, "target_below_source", f"greatest({s} - {t}, 0)",
                    "warn" if may_shrink else "error"),
        ]
    )


def reconcile(mart: str, grain: str, with_negatives: bool) -> str:
    def total(table: str, column: str) -> str:
        return f"(SELECT coalesce(sum({column}), 0) FROM {table})"

    columns = {
        "mart_rows": f"(SELECT count(*) FROM {mart})",
        "mart_trips": f"CAST({total(mart, 'trip_count')} AS BIGINT)",
        "mart_revenue": f"round({total(mart, 'total_revenue')}, 2)",
        "expected_rows": f"(SELECT count(*) FROM (SELECT DISTINCT {grain} FROM fact_trips))",
        "fact_rows": "(SELECT count(*) FROM fact_trips)",
        "fact_total_amount": f"round({total('fact_trips', 'total_amount')}, 2)",
    }
    if with_negatives:
        columns["mart_negatives"] = f"CAST({total(mart, 'negative_total_amount_trip_count')} AS BIGINT)"
        columns["fact_negatives"] = "(SELECT count(*) FROM fact_trips WHERE total_amount < 0)"
    bad = ["mart_rows <> expected_rows", "mart_trips <> fact_rows",
           "abs(mart_revenue - fact_total_amount) > 0.01"]
    bad += ["mart_negatives <> fact_negatives"] if with_negatives else []
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    score = " + ".join(f"CAST({b} AS INTEGER)" for b in bad)
    return f"SELECT *, CAST({score} AS INTEGER) AS violations FROM (SELECT {listed})"


def cross(other: str, with_negatives: bool, name: str) -> str:
    extra = (
        "OR d.negative_total_amount_trip_count <> o.negative_total_amount_trip_count"
        if with_negatives else ""
    )
    return f"""SELECT count(*) AS {name} FROM mart_daily_demand d
        FULL OUTER JOIN ({other}) o ON d.pickup_date = o.pickup_date
        WHERE d.pickup_date IS NULL OR o.pickup_date IS NULL OR d.trip_count <> o.trip_count
           OR abs(d.total_revenue - o.total_revenue) > 0.01 {extra}"""


def rolled(mart: str, with_negatives: bool) -> str:
    extra = (
        ", sum(negative_total_amount_trip_count) AS negative_total_amount_trip_count"
        if with_negatives else ""
    )
    return f"""SELECT pickup_date, sum(trip_count) AS trip_count,
        sum(total_revenue) AS total_revenue {extra} FROM {mart} GROUP BY pickup_date"""


def _layer(name: str) -> str:
    return f"SELECT {comparable(name)} FROM {name}"


def _rows(name: str) -> str:
    return f"SELECT {', '.join(visible(name))} FROM {name}"


def _documents(body: str) -> str:
    """Per month the length of every array; February's snowfall is one short."""
    return f"""WITH months AS (
        SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM weather_raw
        WHERE date IS NOT NULL GROUP BY 1) {body}"""


def _weather_fields() -> list[str]:
    return ["time", *S.WEATHER_RAW.names[1:]]


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_fields = ", ".join(S.TRIPS_RAW.names)

    # sources
    q["scan_csv_trips"] = _rows("bronze_trips")
    q["scan_csv_weather"] = _rows("bronze_weather")
    q["scan_csv_zones"] = _rows("bronze_zones")
    q["scan_csv_untyped_count"] = union(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}_raw"
        for n in ("trips", "weather", "zones")
    )
    month = "strftime(tpep_pickup_datetime, '%Y-%m')"
    q["scan_csv_glob"] = f"SELECT {month} AS file_month, count(*) AS row_count FROM trips_raw GROUP BY 1"
    q["month_from_filename"] = f"""SELECT {month} AS file_month, count(*) AS row_count,
        CAST(0 AS BIGINT) AS rows_of_other_months FROM trips_raw GROUP BY 1"""
    q["scan_parquet_partitioned"] = """SELECT pickup_year, pickup_month, count(*) AS row_count
        FROM silver_trips GROUP BY 1, 2"""
    q["view_parquet_hive"] = """SELECT t.pickup_year, t.pickup_month, count(*) AS trip_count,
        count(w.weather_date) AS trips_with_weather
        FROM silver_trips t LEFT JOIN silver_weather w ON t.pickup_date = w.weather_date
        GROUP BY 1, 2"""
    q["view_csv_inferred"] = """SELECT CAST(year(date) AS INTEGER) AS weather_year,
        count(*) AS row_count, min(date) AS min_date, max(date) AS max_date,
        sum(precipitation_sum) AS precipitation_total FROM weather_raw GROUP BY 1"""
    q["normalize_trip_source"] = f"SELECT {raw_fields} FROM trips_raw"
    fields = ", ".join(S.WEATHER_RAW.names[1:])
    q["flatten_parallel_arrays"] = f"""SELECT strftime(date, '%Y-%m') AS month,
        strftime(date, '%Y-%m-%d') AS date, {fields}
        FROM weather_raw WHERE date IS NOT NULL AND month(date) <> 2"""
    q["check_parallel_array_lengths"] = _documents(
        union(
            f"""SELECT month, '{f}' AS field, TRUE AS present, CAST({n} AS INTEGER) AS length,
            CAST(n AS INTEGER) AS expected_length, {n} = n AND n > 0 AS is_usable FROM months"""
            for f in _weather_fields()
            for n in ["(n - CASE WHEN month LIKE '%-02' THEN 1 ELSE 0 END)" if f == "snowfall_sum" else "n"]
        )
    )
    q["lineage_file_counts"] = """SELECT 'lineitem.parquet' AS source_file, count(*) AS row_count
        FROM bronze_trips"""
    q["check_source_headers"] = union(
        f"SELECT '{n}' AS dataset, TRUE AS headers_ok, count(*) AS data_rows FROM {n}_raw"
        for n in ("trips", "weather", "zones")
    )
    q["month_scope_backfill"] = """SELECT pickup_year, pickup_month, count(*) AS trip_count,
        max(pickup_date) AS last_date FROM silver_trips
        WHERE (pickup_year = 1997 AND pickup_month = 2) OR (pickup_year = 1998 AND pickup_month = 7)
           OR (pickup_year = 1999 AND pickup_month = 12) GROUP BY 1, 2"""

    # sinks
    q["sink_overwrite_roundtrip"] = _rows("dim_weather")
    q["sink_dynamic_partition_overwrite"] = """SELECT pickup_date, pickup_year, pickup_month,
        trip_count + CASE WHEN pickup_year = (SELECT max(pickup_year) FROM mart_daily_demand) THEN 1000 ELSE 0 END AS trip_count
        FROM mart_daily_demand"""
    q["sink_flat_export"] = _layer("mart_zone_demand")
    q["export_rowcount_reconcile"] = union(
        f"""SELECT '{m}' AS dataset, count(*) AS source_rows, count(*) AS exported_rows,
        CAST(0 AS BIGINT) AS violations FROM {m}"""
        for m in MARTS
    )
    q["sink_truncate_once_append"] = f"SELECT date, {fields} FROM weather_raw"
    q["sink_months_in_one_commit"] = q["sink_dynamic_partition_overwrite"] + """
        WHERE pickup_year * 100 + pickup_month > (SELECT min(pickup_year * 100 + pickup_month) FROM mart_daily_demand)"""
    q["sink_batches_resumed"] = q["sink_truncate_once_append"]
    q["sink_commit_row_counts"] = """SELECT
        'pickup_year=' || pickup_year || '/pickup_month=' || pickup_month AS partition, count(*) AS row_count
        FROM silver_trips GROUP BY 1"""
    q["conform_contract"] = f"SELECT {raw_fields} FROM trips_raw"
    rejected = {"trip_distance": "count(*) FILTER (WHERE payment_type IS NULL)"}
    q["conform_rejects"] = union(
        f"""SELECT 'trips' AS dataset, 'rejected_{f.name}' AS check_name, 'error' AS severity,
        CAST({rejected.get(f.name, 'count(*) FILTER (WHERE false)')} AS BIGINT) AS violations FROM trips_raw"""
        for f in S.TRIPS_RAW if f.type != "string"
    )
    q["load_clean_blanks"] = """SELECT o_orderstatus,
        CASE WHEN o_orderstatus IN ('O', 'P') THEN NULL ELSE o_orderpriority END AS priority,
        count(*) AS row_count FROM orders GROUP BY 1, 2"""
    q["load_clean_truncate"] = """SELECT c_custkey, left(c_name, 12) AS c_name,
        left(c_mktsegment, 5) AS c_mktsegment FROM customer"""

    # projections and filters
    q["ensure_columns"] = """SELECT o_orderpriority, o_orderkey, CAST(NULL AS VARCHAR) AS o_comment,
        o_orderstatus FROM orders"""
    renamed = ", ".join(f"{a} AS {b}" for a, b in S.TRIP_RENAMES.items())
    q["rename_map"] = f"SELECT {renamed} FROM bronze_trips"
    typed = ", ".join(
        "CASE WHEN payment_type IS NULL THEN NULL ELSE trip_distance END AS trip_distance"
        if n == "trip_distance" else n
        for n in S.TRIPS_RAW.names
    )
    q["cast_bronze_types"] = f"SELECT {typed} FROM trips_raw"
    q["cast_silver_types"] = """SELECT vendor_id, passenger_count, rate_code_id, pickup_location_id,
        dropoff_location_id, payment_type_code, trip_distance, total_amount FROM derived_trips"""
    q["sanitize_identifiers"] = """SELECT c_custkey,
        trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '_') AS name_identifier,
        'col_' || c_custkey || '_' || lower(c_mktsegment) AS mixed_identifier FROM customer"""
    q["bronze_trips"] = _rows("bronze_trips")
    q["bronze_weather"] = _rows("bronze_weather")
    q["bronze_zones"] = _rows("bronze_zones")
    q["filter_trip_quality"] = """SELECT pickup_year, pickup_month, count(*) AS kept_rows,
        min(trip_duration_minutes) AS min_minutes FROM derived_trips
        WHERE pickup_datetime < dropoff_datetime AND pickup_location_id IS NOT NULL
          AND dropoff_location_id IS NOT NULL GROUP BY 1, 2"""
    q["filter_date_scope"] = f"""SELECT pickup_date, count(*) AS row_count FROM bronze_trips
        WHERE pickup_date >= {LO} AND pickup_date <= {HI} GROUP BY 1"""
    q["partition_scope_violations"] = report(
        "bronze_trips",
        {"pickup_date_out_of_scope": outside("pickup_date"),
         "partition_out_of_scope": outside_month("pickup_year", "pickup_month")},
    )
    shown_bronze = ", ".join(visible("bronze_trips"))
    order = ", ".join(f"{n} NULLS FIRST" for n in visible("bronze_trips"))
    q["preview_rows"] = f"SELECT {shown_bronze} FROM bronze_trips ORDER BY {order} LIMIT 5"
    q["describe_schema"] = union(
        f"""SELECT '{t}' AS dataset, CAST({i} AS INTEGER) AS position, '{n}' AS column_name,
        '{S.CONTRACTS[t].types[n]}' AS data_type, count({n}) AS filled_rows FROM {t}"""
        for t in ["bronze_weather", *MARTS]
        for i, n in enumerate(visible(t), 1)
    )
    q["dataset_overview"] = union(
        f"""SELECT '{t}' AS dataset_name, count(*) AS row_count,
        CAST({len(S.CONTRACTS[t])} AS INTEGER) AS column_count FROM {t}"""
        for t in ["bronze_weather", "bronze_zones", *SILVER, "dim_date", *MARTS]
    )

    # scalar functions
    q["parse_timestamps"] = """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL
        ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS parsed_ts FROM events"""
    q["parse_dates"] = """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN NULL
        ELSE CAST(o_orderdate AS DATE) END AS parsed_date FROM orders"""
    q["date_parts"] = f"""SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_num,
        {_calendar('ts')} FROM events"""
    q["trip_duration"] = """SELECT l_orderkey, l_linenumber,
        CAST(epoch(l_shipdate) - epoch(o_orderdate) AS DOUBLE) / 60 AS minutes
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    q["trim_text"] = """SELECT CAST(location_id AS VARCHAR) AS "LocationID", borough AS "Borough",
        zone AS "Zone", service_zone FROM zones_raw"""
    amounts = ", ".join(
        f"count(*) AS {c}_filled, round(sum(coalesce({c}, 0)), 2) AS {c}_sum" for c in S.OPTIONAL_AMOUNTS
    )
    q["fill_optional_amounts"] = f"""SELECT pickup_year, pickup_month, {amounts}
        FROM derived_trips GROUP BY 1, 2"""
    q["surrogate_key"] = f"SELECT trip_id, {', '.join(S.TRIP_KEY)} FROM keyed_trips"
    q["payment_type_label"] = f"""SELECT payment_type, {label('payment_type')} AS payment_type_name,
        count(*) AS trip_count FROM trips_raw GROUP BY 1, 2"""
    q["weather_flags"] = """SELECT weather_date, precipitation_sum, snowfall_sum, is_rainy_day,
        is_snowy_day FROM silver_weather"""

    # layers
    for name in [*SILVER, "dim_date", "dim_zone", "dim_weather", "fact_trips"]:
        q[name] = _rows(name)
    q["silver_trips_few_copies"] = q["silver_trips"]
    for name in MARTS:
        q[name] = _layer(name)

    # joins and set operations
    q["join_role_playing_zone"] = f"""SELECT
        {unmatched('silver_trips', 'pickup_location_id', 'silver_zones', 'location_id')} AS missing_pickup_zone_rows,
        {unmatched('silver_trips', 'dropoff_location_id', 'silver_zones', 'location_id')} AS missing_dropoff_zone_rows"""
    roles = {
        "date": ("pickup_date", "dim_date", "date_day"),
        "pickup_zone": ("pickup_location_id", "dim_zone", "location_id"),
        "dropoff_zone": ("dropoff_location_id", "dim_zone", "location_id"),
        "weather": ("weather_date", "dim_weather", "weather_date"),
    }
    q["fk_orphans"] = union(
        f"""SELECT '{r}' AS role, CAST(f.{c} AS VARCHAR) AS key, count(*) AS row_count
        FROM fact_trips f LEFT JOIN {t} d ON f.{c} = d.{k} WHERE d.{k} IS NULL GROUP BY f.{c}"""
        for r, (c, t, k) in roles.items()
    )
    q["keyset_diff_anti"] = """
        SELECT day, 'weather' AS missing_in FROM (SELECT pickup_date AS day FROM silver_trips
            EXCEPT SELECT weather_date FROM silver_weather)
        UNION ALL
        SELECT day, 'trips' AS missing_in FROM (SELECT weather_date AS day FROM silver_weather
            EXCEPT SELECT pickup_date FROM silver_trips)"""
    q["keyset_diff_except"] = """SELECT
        (SELECT count(*) FROM (SELECT trip_id FROM keyed_trips EXCEPT SELECT trip_id FROM fact_trips)) AS trip_ids_missing_in_fact,
        (SELECT count(*) FROM (SELECT trip_id FROM fact_trips EXCEPT SELECT trip_id FROM keyed_trips)) AS unexpected_trip_ids_in_fact"""
    q["keyset_diff_one_pass"] = union(
        f"""SELECT '{t}' AS dataset,
        (SELECT count(*) FROM (SELECT trip_id FROM silver_trips EXCEPT SELECT trip_id FROM {t})) AS only_left,
        (SELECT count(*) FROM (SELECT trip_id FROM {t} EXCEPT SELECT trip_id FROM silver_trips)) AS only_right"""
        for t in ("fact_trips", "fact_trips_faulty")
    )
    q["keyset_diff_digests"] = q["keyset_diff_one_pass"]
    q["scalar_reconcile"] = union(
        f"""SELECT '{t}' AS dataset,
        (SELECT count(*) FROM silver_trips) AS silver_trips_row_count,
        (SELECT round(sum(total_amount), 2) FROM silver_trips) AS silver_trips_total_amount_sum,
        (SELECT count(*) FROM {t}) AS fact_trips_row_count,
        (SELECT round(sum(total_amount), 2) FROM {t}) AS fact_trips_total_amount_sum"""
        for t in ("fact_trips", "fact_trips_faulty")
    )
    days = {"silver_trips": "pickup_date", "silver_weather": "weather_date", "dim_date": "date_day",
            "dim_weather": "weather_date", "fact_trips": "pickup_date",
            **dict.fromkeys(MARTS, "pickup_date")}
    q["overview_union"] = union(
        f"""SELECT '{t}' AS dataset_name, count(*) AS row_count,
        {f'min({days[t]})' if t in days else 'CAST(NULL AS DATE)'} AS min_date,
        {f'max({days[t]})' if t in days else 'CAST(NULL AS DATE)'} AS max_date FROM {t}"""
        for t in [*SILVER, *GOLD, *MARTS]
    )

    # aggregates and windows
    q["agg_conditional_count"] = """SELECT pickup_year,
        count(*) FILTER (WHERE total_amount < 0) AS negative_rows,
        count(*) FILTER (WHERE payment_type IS NULL) AS no_payment_rows
        FROM bronze_trips GROUP BY 1"""
    q["null_profile"] = profile("trips_raw", nulls(S.TRIPS_RAW.names), {"row_count": "count(*)"})
    q["overview_counts"] = """SELECT 'bronze_weather' AS dataset_name, count(*) AS row_count,
        min(date) AS min_date, max(date) AS max_date FROM bronze_weather"""
    q["distinct_partitions"] = "SELECT DISTINCT pickup_year, pickup_month FROM bronze_trips"
    q["dedupe_by_key"] = """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1"""
    q["having_duplicates"] = """SELECT trip_id, count(*) AS duplicate_count FROM clean_trips
        GROUP BY trip_id HAVING count(*) > 1"""
    q["duplicate_group_count"] = f"SELECT {duplicate_keys('clean_trips', ['trip_id'])} AS duplicate_trip_ids"
    q["agg_sum_or_zero"] = """SELECT round(coalesce(sum(airport_fee), 0), 2) AS airport_fee_total,
        round(coalesce(sum(tolls_amount), 0), 2) AS tolls_total FROM trips_raw"""
    share = "CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY pickup_date) AS DOUBLE)"
    q["share_of_day_total"] = f"""SELECT pickup_date, pickup_location_id, count(*) AS trip_count,
        {steady(share)} AS share FROM fact_trips GROUP BY 1, 2"""

    # raw and bronze reports
    q["raw_row_counts"] = union(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("trips_raw", "weather_raw", "zones_raw")
    )
    q["raw_trip_quality"] = profile(
        "trips_raw",
        {
            "pickup_datetime_nulls": "tpep_pickup_datetime IS NULL",
            "dropoff_datetime_nulls": "tpep_dropoff_datetime IS NULL",
            **nulls(["pulocationid", "dolocationid", "total_amount"]),
            **negatives(["trip_distance", "passenger_count", "total_amount"]),
            "invalid_datetime_order_rows": "tpep_dropoff_datetime < tpep_pickup_datetime",
            "pickup_date_out_of_expected_range_rows": outside("CAST(tpep_pickup_datetime AS DATE)"),
        },
        {
            "trip_row_count": "count(*)",
            "min_pickup_date": "min(CAST(tpep_pickup_datetime AS DATE))",
            "max_pickup_date": "max(CAST(tpep_pickup_datetime AS DATE))",
        },
    )
    span = "datediff('day', min(date), max(date)) + 1"
    q["weather_completeness"] = f"""SELECT count(*) AS weather_row_count,
        count(DISTINCT date) AS distinct_weather_dates, min(date) AS min_weather_date,
        max(date) AS max_weather_date, {span} AS expected_calendar_days,
        {span} - count(DISTINCT date) AS missing_weather_days,
        count(*) - count(DISTINCT date) AS duplicate_weather_date_rows,
        {count_if('date IS NULL', 'date_nulls')},
        {count_if('temperature_2m_mean IS NULL', 'temperature_mean_nulls')},
        {count_if('precipitation_sum IS NULL', 'precipitation_sum_nulls')},
        {count_if('snowfall_sum IS NULL', 'snowfall_sum_nulls')} FROM weather_raw"""
    q["zone_distinct_profile"] = profile(
        "zones_raw",
        nulls(["location_id", "borough", "zone", "service_zone"]),
        {"zone_row_count": "count(*)", "distinct_location_ids": "count(DISTINCT location_id)",
         "duplicate_location_id_rows": "count(*) - count(DISTINCT location_id)"},
    )
    q["unmapped_locations"] = f"""SELECT 'pickup_location_unmapped' AS check_name,
        {unmatched('trips_raw', 'pulocationid', 'zones_raw', 'location_id')} AS unmapped_rows
        UNION ALL SELECT 'dropoff_location_unmapped',
        {unmatched('trips_raw', 'dolocationid', 'zones_raw', 'location_id')}"""
    q["daily_coverage"] = f"""SELECT count(*) AS active_days,
        {count_if('w.date IS NULL', 'days_missing_weather')}, min(t.pickup_date) AS min_trip_date,
        max(t.pickup_date) AS max_trip_date
        FROM (SELECT DISTINCT CAST(tpep_pickup_datetime AS DATE) AS pickup_date FROM trips_raw) t
        LEFT JOIN weather_raw w ON t.pickup_date = w.date"""
    q["payment_distribution"] = """SELECT payment_type, count(*) AS trip_count,
        round(CAST(100 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS trip_share_pct
        FROM trips_raw GROUP BY 1"""
    q["business_metrics"] = """SELECT count(*) AS trip_count,
        round(sum(total_amount), 2) AS total_revenue_raw,
        round(avg(total_amount), 2) AS avg_total_amount_raw,
        round(avg(trip_distance), 2) AS avg_trip_distance_raw FROM trips_raw"""
    q["raw_status_summary"] = f"""SELECT CASE WHEN trip_rows > 0 AND weather_rows > 0 AND zone_rows > 0
            AND pickup_nulls = 0 AND pickup_location_nulls = 0 AND dropoff_location_nulls = 0
            AND missing_days = 0 AND duplicate_location_ids = 0 THEN 'PASS' ELSE 'CHECK_REQUIRED' END
            AS raw_layer_status, *
        FROM (SELECT count(*) AS trip_rows, {count_if('tpep_pickup_datetime IS NULL', 'pickup_nulls')},
                {count_if('pulocationid IS NULL', 'pickup_location_nulls')},
                {count_if('dolocationid IS NULL', 'dropoff_location_nulls')} FROM trips_raw) t
        CROSS JOIN (SELECT count(*) AS weather_rows, {span} - count(DISTINCT date) AS missing_days FROM weather_raw) w
        CROSS JOIN (SELECT count(*) AS zone_rows,
                count(*) - count(DISTINCT location_id) AS duplicate_location_ids FROM zones_raw) z"""
    q["raw_table_profile"] = f"""SELECT * FROM (SELECT count(*) AS trip_rows,
            min(CAST(tpep_pickup_datetime AS DATE)) AS min_pickup_date,
            max(CAST(tpep_pickup_datetime AS DATE)) AS max_pickup_date FROM trips_raw) t
        CROSS JOIN (SELECT count(*) AS weather_rows, min(date) AS min_weather_date,
            max(date) AS max_weather_date FROM weather_raw) w
        CROSS JOIN (SELECT count(*) AS zone_rows FROM zones_raw) z
        CROSS JOIN (SELECT {duplicate_keys('zones_raw', ['location_id'])} AS duplicate_zone_id_groups) d"""
    q["raw_vs_bronze_counts"] = union(
        f"""SELECT '{n}' AS dataset, (SELECT count(*) FROM {n}_raw) AS raw_count,
        (SELECT count(*) FROM bronze_{n}) AS bronze_count"""
        for n in ("trips", "weather", "zones")
    )
    months = ["bronze_trips", "bronze_weather", "silver_trips", "silver_weather"]

    def per_month(tables):
        return union(
            f"""SELECT {S.PARTITIONS[t][0]} AS year_num, {S.PARTITIONS[t][1]} AS month_num,
            count(*) AS row_count, '{t}' AS dataset_name FROM {t} GROUP BY 1, 2"""
            for t in tables
        )

    q["rows_per_month"] = per_month(months)
    q["mart_month_coverage"] = per_month(MARTS)
    q["datetime_extremes"] = """SELECT min(tpep_pickup_datetime) AS min_pickup_ts,
        max(tpep_pickup_datetime) AS max_pickup_ts, min(tpep_dropoff_datetime) AS min_dropoff_ts,
        max(tpep_dropoff_datetime) AS max_dropoff_ts FROM bronze_trips"""
    q["bronze_negative_review"] = profile(
        "bronze_trips", negatives(["trip_distance", "fare_amount", "total_amount"], "")
    )
    q["calendar_gaps"] = """SELECT CAST(c.d AS DATE) AS expected_date FROM (
            SELECT unnest(generate_series((SELECT min(date) FROM bronze_weather),
                (SELECT max(date) FROM bronze_weather), INTERVAL 1 DAY)) AS d) c
        LEFT JOIN bronze_weather w ON CAST(c.d AS DATE) = w.date WHERE w.date IS NULL"""
    q["zones_per_borough"] = "SELECT borough, count(*) AS row_count FROM bronze_zones GROUP BY 1"

    # checks
    q["check_non_empty"] = union(
        counted(t, "is_empty", f"CASE WHEN (SELECT count(*) FROM {t}) = 0 THEN 1 ELSE 0 END")
        for t in LAYERS
    )
    q["check_columns"] = union(
        f"""SELECT '{t}' AS dataset, 'columns_match' AS check_name, 'error' AS severity,
        CAST(0 AS BIGINT) AS violations, '' AS missing_columns, '' AS unexpected_columns,
        '' AS mistyped_columns"""
        for t in LAYERS
    ) + """ UNION ALL SELECT 'dim_zone_faulty', 'columns_match', 'error', CAST(3 AS BIGINT),
        'service_zone', 'extra', 'location_id'"""
    q["check_rowcount_relation"] = union(
        [relation("trips_raw", "bronze_trips", True), relation("weather_raw", "bronze_weather", False),
         relation("zones_raw", "bronze_zones", False)]
        + [relation(f"bronze_{n}", f"silver_{n}", True) for n in ("trips", "weather", "zones")]
    )
    q["check_rowcount_exact"] = union(
        counted(t, "rowcount_differs",
                f"abs((SELECT count(*) FROM {s}) - (SELECT count(*) FROM {t}))")
        for t, s in {"fact_trips": "silver_trips", "fact_trips_faulty": "silver_trips",
                     "dim_weather": "silver_weather", "dim_zone": "silver_zones"}.items()
    )
    q["check_unique_key"] = union(
        counted(t, "duplicate_" + "_".join(k), duplicate_keys(t, k)) for t, k in S.UNIQUE_KEYS.items()
    )
    for name, tables in {
        "nulls_bronze": ["bronze_trips", "bronze_weather", "bronze_zones"],
        "nulls_silver": SILVER, "nulls_gold": GOLD, "nulls_serving": MARTS,
    }.items():
        q[name] = union(report(t, nulls(S.REQUIRED[t])) for t in tables)
    q["blank_text"] = union(
        f"SELECT *, {flag} AS null_is_blank FROM ({report(t, conditions)})"
        for t in ("dim_zone", "mart_zone_demand")
        for flag, conditions in (("FALSE", LOOSE_BLANKS), ("TRUE", BLANKS))
    )
    q["check_time_order"] = union(report(t, TIME_ORDER) for t in ("derived_trips", "silver_trips"))
    q["check_weather_date_match"] = union(
        report(t, WEATHER_MATCH) for t in ("fact_trips", "mart_weather_impact")
    )
    q["check_derived_parts"] = union(report(t, PARTS) for t in ("silver_trips", "fact_trips"))
    q["check_dim_date_logic"] = report("dim_date", DATE_LOGIC)
    q["check_dim_date_coverage"] = counted(
        "dim_date", "rowcount_differs",
        "abs((SELECT count(DISTINCT pickup_date) FROM silver_trips) - (SELECT count(*) FROM dim_date))",
    )
    q["check_weather_flags"] = report("dim_weather", FLAGS)
    q["check_negative_distance"] = report("fact_trips", negatives(["trip_distance"]))
    q["negative_money_profile"] = report("fact_trips", negatives(S.MONEY_COLUMNS), "warn")
    q["check_columns_by_folder"] = """SELECT 'mart_daily_demand' AS dataset, 'columns_match' AS check_name,
        'error' AS severity, CAST(2 AS BIGINT) AS violations, '' AS missing_columns, 'extra' AS unexpected_columns,
        'trip_count' AS mistyped_columns,
        'pickup_year=' || max(pickup_year * 100 + pickup_month) // 100
            || '/pickup_month=' || max(pickup_year * 100 + pickup_month) % 100 AS folder FROM mart_daily_demand"""
    q["check_same_keys"] = union(
        counted(t, name, f"(SELECT count(*) FROM (SELECT trip_id FROM {a} EXCEPT SELECT trip_id FROM {b}))")
        for t in ("fact_trips", "fact_trips_faulty")
        for name, a, b in (("missing_keys", "silver_trips", t), ("unexpected_keys", t, "silver_trips"))
    )
    q["fk_coverage"] = f"""SELECT
        {unmatched('fact_trips', 'pickup_date', 'dim_date', 'date_day')} AS missing_dim_date_rows,
        {unmatched('fact_trips', 'pickup_location_id', 'dim_zone', 'location_id')} AS missing_pickup_dim_zone_rows,
        {unmatched('fact_trips', 'dropoff_location_id', 'dim_zone', 'location_id')} AS missing_dropoff_dim_zone_rows,
        {unmatched('fact_trips', 'weather_date', 'dim_weather', 'weather_date')} AS missing_dim_weather_rows"""
    q["check_partition_dirs"] = """SELECT pickup_year, pickup_month,
        pickup_year || '/' || pickup_month AS folder, count(*) AS row_count, TRUE AS in_own_folder
        FROM silver_trips GROUP BY 1, 2"""
    q["demand_vs_dim_date"] = """SELECT count(*) AS mart_daily_demand_date_mismatch_rows
        FROM mart_daily_demand m LEFT JOIN dim_date d ON m.pickup_date = d.date_day
        WHERE d.date_day IS NULL OR m.quarter_num <> d.quarter_num OR m.month_name <> d.month_name
           OR m.day_num_in_month <> d.day_num_in_month OR m.day_of_week_num <> d.day_of_week_num
           OR m.day_of_week_name <> d.day_of_week_name OR m.is_weekend <> d.is_weekend"""
    q["weather_vs_dims"] = """SELECT count(*) AS mart_weather_impact_descriptor_mismatch_rows
        FROM mart_weather_impact m LEFT JOIN dim_date d ON m.pickup_date = d.date_day
        LEFT JOIN dim_weather w ON m.weather_date = w.weather_date
        WHERE d.date_day IS NULL OR w.weather_date IS NULL OR m.weather_date <> m.pickup_date
           OR m.day_of_week_num <> d.day_of_week_num OR m.is_weekend <> d.is_weekend
           OR m.is_rainy_day <> w.is_rainy_day OR m.is_snowy_day <> w.is_snowy_day
           OR m.temperature_max <> w.temperature_max OR m.temperature_min <> w.temperature_min
           OR m.temperature_mean <> w.temperature_mean
           OR m.precipitation_sum <> w.precipitation_sum OR m.snowfall_sum <> w.snowfall_sum"""
    q["zone_vs_dim_zone"] = """SELECT count(*) AS mart_zone_demand_descriptor_mismatch_rows
        FROM mart_zone_demand m LEFT JOIN dim_zone z ON m.pickup_location_id = z.location_id
        WHERE z.location_id IS NULL OR m.borough <> z.borough OR m.zone <> z.zone
           OR m.service_zone <> z.service_zone"""
    q["reconcile_daily_demand"] = reconcile("mart_daily_demand", "pickup_date", True)
    q["reconcile_payment_mix"] = reconcile(
        "mart_daily_payment_mix", "pickup_date, coalesce(payment_type_code, -1)", False
    )
    q["reconcile_weather_impact"] = reconcile("mart_weather_impact", "pickup_date", True)
    q["reconcile_zone_demand"] = reconcile("mart_zone_demand", "pickup_date, pickup_location_id", True)
    q["check_payment_labels"] = f"""SELECT count(*) AS label_mismatch_rows FROM mart_daily_payment_mix
        WHERE payment_type_name <> {label('payment_type_code')}"""
    q["share_sum_violations"] = f"""WITH sums AS (SELECT pickup_date,
            sum(payment_trip_share_pct) AS trip_share_sum,
            sum(payment_revenue_share_pct) AS revenue_share_sum,
            sum(total_revenue) AS daily_revenue_sum FROM mart_daily_payment_mix GROUP BY 1)
        {report('sums', {
            'bad_trip_share_days': 'abs(trip_share_sum - 1) > 0.0001',
            'bad_revenue_share_days': 'abs(daily_revenue_sum) > 0.01 AND abs(revenue_share_sum - 1) > 0.0001',
        }, dataset='mart_daily_payment_mix')}"""
    q["share_range_violations"] = union(
        f"""SELECT *, CAST({t} AS DOUBLE) AS tolerance FROM (
        {report('mart_daily_payment_mix', share_ranges(t), 'warn')})"""
        for t in ("0", "0.0001")
    )
    q["cross_mart_demand_weather"] = cross(
        "SELECT * FROM mart_weather_impact", True, "daily_vs_weather_mismatch_rows"
    )
    q["cross_mart_demand_payment"] = cross(
        rolled("mart_daily_payment_mix", False), False, "daily_vs_payment_mix_mismatch_rows"
    )
    q["cross_mart_demand_zone"] = cross(
        rolled("mart_zone_demand", True), True, "daily_vs_zone_mismatch_rows"
    )

    # silver, gold and serving reports
    scoped = {
        "silver_trips": (["pickup_date"], True), "silver_weather": (["weather_date"], True),
        "dim_date": (["date_day"], False), "dim_weather": (["weather_date"], False),
        "fact_trips": (["pickup_date", "weather_date"], True),
        "mart_daily_demand": (["pickup_date"], False),
        "mart_daily_payment_mix": (["pickup_date"], False),
        "mart_weather_impact": (["pickup_date", "weather_date"], False),
        "mart_zone_demand": (["pickup_date"], False),
    }
    q["scope_violations_summary"] = union(
        report(t, {
            **{f"{d}_out_of_scope": outside(d) for d in dates},
            **({"partition_out_of_scope": outside_month(*S.PARTITIONS[t])} if parts else {}),
        })
        for t, (dates, parts) in scoped.items()
    )
    q["scope_violations_detail"] = f"""SELECT weather_date, weather_year, weather_month,
        count(*) AS row_count FROM silver_weather
        WHERE {outside('weather_date')} OR {outside_month('weather_year', 'weather_month')}
        GROUP BY 1, 2, 3"""
    beyond = f"{outside('pickup_date')} OR {outside_month('pickup_year', 'pickup_month')}"
    q["scope_violations_detail_trips"] = f"""SELECT pickup_date, pickup_year, pickup_month,
        count(*) AS row_count FROM silver_trips WHERE {beyond} GROUP BY 1, 2, 3"""
    q["scope_violations_detail_fact"] = f"""SELECT pickup_date, weather_date, pickup_year,
        pickup_month, count(*) AS row_count FROM fact_trips
        WHERE {beyond} OR {outside('weather_date')} GROUP BY 1, 2, 3, 4"""
    q["scope_violations_detail_marts"] = union(
        f"""SELECT '{m}' AS dataset, pickup_date, pickup_year, pickup_month, count(*) AS row_count
        FROM {m} WHERE {beyond} GROUP BY 1, 2, 3, 4"""
        for m in MARTS
    )
    silver_nulls = [c for c in S.REQUIRED["silver_trips"] if c != "trip_duration_minutes"]
    q["silver_quality_profile"] = profile("silver_trips", {**nulls(silver_nulls), **TIME_ORDER, **PARTS})
    q["silver_weather_profile"] = profile(
        "silver_weather",
        {**nulls(S.REQUIRED["silver_weather"]),
         "bad_weather_year_rows": "weather_year <> year(weather_date)",
         "bad_weather_month_rows": "weather_month <> month(weather_date)", **FLAGS},
    )
    q["silver_zone_profile"] = profile("silver_zones", {**nulls(S.REQUIRED["silver_zones"]), **BLANKS})
    q["duplicate_grain_summary"] = "SELECT " + ", ".join(
        f"{duplicate_keys(t, S.UNIQUE_KEYS[t])} AS {t}_duplicate_keys" for t in [*SILVER, *GOLD, *MARTS]
    )
    q["dates_without_weather"] = """SELECT count(*) AS trip_dates_without_weather FROM (
        SELECT DISTINCT t.pickup_date FROM silver_trips t
        LEFT JOIN silver_weather w ON t.pickup_date = w.weather_date WHERE w.weather_date IS NULL)"""
    q["daily_snapshot"] = """SELECT pickup_date, count(*) AS trip_count,
        round(sum(total_amount), 2) AS total_revenue, round(avg(trip_distance), 2) AS avg_trip_distance,
        round(avg(trip_duration_minutes), 2) AS avg_trip_duration_minutes
        FROM silver_trips GROUP BY 1 ORDER BY 1 LIMIT 31"""
    q["payment_mix_snapshot"] = """SELECT pickup_date, payment_type_code, count(*) AS trip_count,
        round(sum(total_amount), 2) AS total_revenue FROM silver_trips GROUP BY 1, 2
        ORDER BY pickup_date, trip_count DESC, payment_type_code NULLS FIRST LIMIT 50"""
    places = """SELECT pickup_location_id, count(*) AS trip_count,
        round(sum(total_amount), 2) AS total_revenue"""
    ranked = "ORDER BY trip_count DESC, total_revenue DESC, pickup_location_id"
    q["top_pickup_locations"] = f"{places} FROM silver_trips GROUP BY 1 {ranked} LIMIT 15"
    q["top_zones_fact"] = f"""SELECT f.*, z.borough, z.zone FROM ({places} FROM fact_trips GROUP BY 1) f
        LEFT JOIN dim_zone z ON f.pickup_location_id = z.location_id {ranked} LIMIT 20"""
    q["top_zones_mart"] = f"""SELECT pickup_location_id, borough, zone,
        CAST(sum(trip_count) AS BIGINT) AS trip_count, round(sum(total_revenue), 2) AS total_revenue,
        CAST(sum(negative_total_amount_trip_count) AS BIGINT) AS negative_total_amount_trip_count
        FROM mart_zone_demand GROUP BY 1, 2, 3 {ranked} LIMIT 20"""
    q["weather_snapshot"] = """SELECT weather_date, temperature_mean, precipitation_sum, snowfall_sum,
        is_rainy_day, is_snowy_day FROM silver_weather ORDER BY weather_date LIMIT 31"""
    q["zone_snapshot"] = """SELECT location_id, borough, zone, service_zone FROM silver_zones
        ORDER BY location_id LIMIT 50"""
    q["monthly_revenue"] = """SELECT pickup_year, pickup_month, count(*) AS trip_count,
        round(sum(total_amount), 2) AS total_revenue FROM fact_trips GROUP BY 1, 2"""
    dates = ["bad_year_num_rows", "bad_quarter_num_rows", "bad_month_num_rows", "bad_day_num_rows"]
    q["dim_quality_profile"] = union(
        [
            report("dim_date", {**nulls(S.DIM_DATE.names), **{d: DATE_LOGIC[d] for d in dates}}),
            report("dim_zone", {**nulls(S.DIM_ZONE.names), **BLANKS}),
            report("dim_weather", {**nulls(S.DIM_WEATHER.names), **FLAGS}),
        ]
    )
    fact_nulls = ["trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_year",
                  "pickup_month", "pickup_hour", "weather_date", "pickup_location_id",
                  "dropoff_location_id", "trip_distance", "trip_duration_minutes", "total_amount",
                  "gold_loaded_at"]
    q["fact_quality_profile"] = profile(
        "fact_trips",
        {**nulls(fact_nulls), **TIME_ORDER, **negatives(["trip_distance"]), **PARTS,
         **WEATHER_MATCH, **negatives(S.MONEY_COLUMNS)},
    )
    q["negative_amount_by_day"] = """SELECT pickup_date, count(*) AS negative_total_amount_trip_count,
        round(sum(total_amount), 2) AS negative_total_amount_sum FROM fact_trips
        WHERE total_amount < 0 GROUP BY 1"""
    q["negative_amount_by_mart_day"] = """SELECT pickup_date, negative_total_amount_trip_count,
        round(total_revenue, 2) AS total_revenue FROM mart_daily_demand
        WHERE negative_total_amount_trip_count > 0"""
    q["mart_quality_profile"] = union(report(m, mart_conditions(m)) for m in MARTS)
    q["payment_label_listing"] = """SELECT pickup_date, payment_type_code, payment_type_name,
        count(*) AS row_count FROM mart_daily_payment_mix GROUP BY 1, 2, 3
        ORDER BY pickup_date, payment_type_code LIMIT 40"""
    q["mart_snapshots"] = _snapshots()

    # dashboards
    q["kpi_summary"] = f"""SELECT CAST(sum(trip_count) AS BIGINT) AS total_trips,
        round(sum(total_revenue), 2) AS total_revenue,
        {steady('sum(total_revenue) / sum(trip_count)')} AS avg_revenue_per_trip,
        {steady('sum(total_trip_duration_minutes) / sum(trip_count)')} AS avg_duration_minutes
        FROM mart_daily_demand"""
    q["daily_trips_vs_revenue"] = f"""SELECT pickup_date, trip_count,
        {steady('avg_total_amount')} AS avg_total_amount FROM mart_daily_demand"""
    q["dow_profile"] = f"""SELECT day_of_week_num, day_of_week_name,
        {steady('avg(trip_count)')} AS avg_trips,
        {steady('avg(avg_total_amount)')} AS avg_revenue_per_trip FROM mart_daily_demand GROUP BY 1, 2"""
    q["daily_revenue_trend"] = """SELECT pickup_date, round(total_revenue, 2) AS total_revenue
        FROM mart_daily_demand"""
    q["distance_vs_revenue"] = f"""SELECT pickup_date, {steady('avg_trip_distance')} AS avg_trip_distance,
        {steady('avg_total_amount')} AS avg_total_amount FROM mart_daily_demand"""
    q["top_peak_days"] = """SELECT pickup_date, day_of_week_name, trip_count,
        round(total_revenue, 2) AS total_revenue FROM mart_daily_demand
        ORDER BY trip_count DESC, pickup_date LIMIT 10"""
    q["weather_effect"] = f"""SELECT is_rainy_day, is_snowy_day, count(*) AS days,
        CAST(sum(trip_count) AS BIGINT) AS trips, round(sum(total_revenue), 2) AS total_revenue,
        {steady('avg(trip_count)')} AS avg_trips_per_day,
        {steady('sum(total_revenue) / sum(trip_count)')} AS avg_revenue_per_trip
        FROM mart_weather_impact GROUP BY 1, 2"""
    return {name: sql(body) for name, body in q.items()}


def _snapshots() -> str:
    kinds = {n: t for m in MARTS for n, t in S.CONTRACTS[m].types.items()}
    spec = {
        "mart_daily_demand": (
            ["pickup_date", "trip_count", "total_revenue", "avg_trip_distance",
             "avg_trip_duration_minutes", "negative_total_amount_trip_count"], "pickup_date", 31),
        "mart_daily_payment_mix": (
            ["pickup_date", "payment_type_code", "payment_type_name", "trip_count",
             "total_revenue", "payment_trip_share_pct", "payment_revenue_share_pct"],
            "pickup_date, trip_count DESC, payment_type_code", 50),
        "mart_weather_impact": (
            ["pickup_date", "is_rainy_day", "is_snowy_day", "temperature_mean",
             "precipitation_sum", "trip_count", "total_revenue", "avg_trip_distance",
             "avg_trip_duration_minutes", "negative_total_amount_trip_count"], "pickup_date", 31),
        "mart_zone_demand": (
            ["pickup_date", "pickup_location_id", "borough", "zone", "trip_count",
             "total_revenue", "negative_total_amount_trip_count"],
            "pickup_date, trip_count DESC, pickup_location_id", 50),
    }
    every = list(dict.fromkeys(n for columns, _, _ in spec.values() for n in columns))
    sql_type = {"date": "DATE", "boolean": "BOOLEAN", **_TYPES}
    parts = []
    for mart, (columns, order, k) in spec.items():
        chosen = ", ".join(
            shown(n, kinds[n]) if n in columns else f"CAST(NULL AS {sql_type[kinds[n]]}) AS {n}"
            for n in every
        )
        parts.append(
            f"SELECT {chosen}, '{mart}' AS dataset_name"
            f" FROM (SELECT * FROM {mart} ORDER BY {order} LIMIT {k})"
        )
    return union(parts)
