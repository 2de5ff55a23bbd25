"""The registered queries again, as plain SQL for the comparison engine.

Written from the definitions and not from the DataFrame code; only the field
expressions of the substitute table are shared.
"""

from __future__ import annotations

from checks.substitute import CARRIERS, LOOKUP_SQL, UNLABELLED_CARRIER, raw_ontime_sql
from tarmac.functions.casts import NA_TOKENS
from tarmac.functions.codes import ALPHABET, LOOKUP_URL, MONTH_URL
from tarmac.sources.fields import FIELDS

STAGED = """stg as (select
  md5(concat_ws('-',
    coalesce(cast(source_year as varchar), '_dbt_utils_surrogate_key_null_'),
    coalesce(cast(source_month as varchar), '_dbt_utils_surrogate_key_null_'),
    coalesce(Reporting_Airline, '_dbt_utils_surrogate_key_null_'),
    coalesce(cast(Flight_Number_Reporting_Airline as varchar), '_dbt_utils_surrogate_key_null_'),
    coalesce(FlightDate, '_dbt_utils_surrogate_key_null_'),
    coalesce(Origin, '_dbt_utils_surrogate_key_null_'),
    coalesce(Dest, '_dbt_utils_surrogate_key_null_'),
    coalesce(cast(CRSDepTime as varchar), '_dbt_utils_surrogate_key_null_'))) as flight_id,
  cast(Flight_Number_Reporting_Airline as bigint) as flight_number,
  Tail_Number as tail_number, Reporting_Airline as carrier_code,
  cast(FlightDate as date) as flight_date,
  cast(Year as bigint) as flight_year, cast(Quarter as bigint) as flight_quarter,
  cast(Month as bigint) as flight_month, cast(DayofMonth as bigint) as day_of_month,
  cast(DayOfWeek as bigint) as day_of_week,
  Origin as origin_airport, cast(OriginAirportID as bigint) as origin_airport_id,
  cast(OriginCityMarketID as bigint) as origin_city_market_id, OriginState as origin_state,
  Dest as destination_airport, cast(DestAirportID as bigint) as destination_airport_id,
  cast(DestCityMarketID as bigint) as destination_city_market_id,
  DestState as destination_state,
  cast(CRSDepTime as bigint) as scheduled_departure_time,
  cast(DepTime as bigint) as actual_departure_time,
  cast(CRSArrTime as bigint) as scheduled_arrival_time,
  cast(ArrTime as bigint) as actual_arrival_time,
  cast(DepDelay as double) as departure_delay_minutes, DepDel15 = 1 as departure_delayed_15,
  cast(ArrDelay as double) as arrival_delay_minutes, ArrDel15 = 1 as arrival_delayed_15,
  cast(CarrierDelay as double) as carrier_delay_minutes,
  cast(WeatherDelay as double) as weather_delay_minutes,
  cast(NASDelay as double) as nas_delay_minutes,
  cast(SecurityDelay as double) as security_delay_minutes,
  cast(LateAircraftDelay as double) as late_aircraft_delay_minutes,
  Cancelled = 1 as was_cancelled, CancellationCode as cancellation_code,
  Diverted = 1 as was_diverted,
  case when Diverted = 1 then 'diverted'
   when Cancelled = 1 and DepTime is null then 'cancelled_before_pushback'
   when Cancelled = 1 and WheelsOff is null then 'cancelled_after_pushback'
   when Cancelled = 1 and DivAirportLandings = 9 then 'cancelled_after_departure'
   when Cancelled = 1 then 'cancelled_other' else 'completed' end as flight_outcome,
  cast(CRSElapsedTime as double) as scheduled_elapsed_minutes,
  cast(ActualElapsedTime as double) as actual_elapsed_minutes,
  cast(AirTime as double) as air_time_minutes, cast(Distance as double) as distance_miles,
  cast(DistanceGroup as bigint) as distance_group,
  case when Diverted = 1 then coalesce(Div5Airport, Div4Airport, Div3Airport, Div2Airport,
   Div1Airport) end as final_diversion_airport,
  cast(source_year as bigint) as source_year, cast(source_month as bigint) as source_month,
  _source_file, _ingested_at
 from raw_ontime)"""

RAW = f"with {raw_ontime_sql()}"
FLIGHTS = f"{RAW},\n{STAGED}"

LEGS = "legs as (" + "\n union all ".join(
    f"""select r.flight_id, cast({n} as bigint) as diversion_sequence,
  Div{n}Airport as diversion_airport, cast(Div{n}AirportID as bigint) as diversion_airport_id,
  cast(Div{n}AirportSeqID as bigint) as diversion_airport_seq_id,
  cast(Div{n}WheelsOn as bigint) as wheels_on_time,
  cast(Div{n}WheelsOff as bigint) as wheels_off_time,
  cast(Div{n}TotalGTime as double) as total_ground_time_minutes,
  cast(Div{n}LongestGTime as double) as longest_ground_time_minutes,
  Div{n}TailNum as tail_number
 from keyed r where Div{n}Airport is not null"""
    for n in range(1, 6)
) + ")"

KEYED = """keyed as (select *, md5(concat_ws('-', cast(source_year as varchar),
  cast(source_month as varchar), Reporting_Airline,
  cast(Flight_Number_Reporting_Airline as varchar), FlightDate, Origin, Dest,
  cast(CRSDepTime as varchar))) as flight_id from raw_ontime)"""

LABELS = ",\n".join(f"{name} as ({sql})" for name, sql in LOOKUP_SQL.items())

LABEL_JOINS = """
 from stg f left join l_unique_carriers c on f.carrier_code = c.Code
 left join l_cancellation x on f.cancellation_code = x.Code
 left join l_city_market_id o on cast(f.origin_city_market_id as varchar) = o.Code
 left join l_city_market_id d on cast(f.destination_city_market_id as varchar) = d.Code"""

OUTCOME = """case when Diverted = 1 then 'diverted'
   when Cancelled = 1 and DepTime is null then 'cancelled_before_pushback'
   when Cancelled = 1 and WheelsOff is null then 'cancelled_after_pushback'
   when Cancelled = 1 and DivAirportLandings = 9 then 'cancelled_after_departure'
   when Cancelled = 1 then 'cancelled_other' else 'completed' end"""

# Of the filings of a key the one that has legs, found by its legs.
WITH_PARENT = f"""{RAW},
{KEYED},
{LEGS},
parent as (select distinct flight_id, Origin as origin_airport, {OUTCOME} as flight_outcome
 from keyed where coalesce(Div1Airport, Div2Airport, Div3Airport, Div4Airport, Div5Airport)
 is not null)
select legs.*, origin_airport, flight_outcome,
 diversion_airport <> origin_airport as diverted_to_different_airport
from legs join parent using (flight_id)"""

# Each leg with what its own row says.
EVENTS = f"{RAW},\n{KEYED}\n" + "\n union all ".join(
    f"""select flight_id, cast({n} as bigint) as diversion_sequence,
  Div{n}Airport as diversion_airport, cast(Div{n}AirportID as bigint) as diversion_airport_id,
  cast(Div{n}AirportSeqID as bigint) as diversion_airport_seq_id,
  cast(Div{n}WheelsOn as bigint) as wheels_on_time,
  cast(Div{n}WheelsOff as bigint) as wheels_off_time,
  cast(Div{n}TotalGTime as double) as total_ground_time_minutes,
  cast(Div{n}LongestGTime as double) as longest_ground_time_minutes,
  Div{n}TailNum as tail_number, Origin as origin_airport, {OUTCOME} as flight_outcome,
  Div{n}Airport <> Origin as diverted_to_different_airport
 from keyed where Div{n}Airport is not null"""
    for n in range(1, 6)
)


def _groups(keys: str) -> str:
    present = " and ".join(f"{k} is not null" for k in keys.split(", "))
    return f"""g as (select {keys}, count(*) as n_rows,
  count(distinct Reporting_Airline) as n_distinct_carriers,
  string_agg(distinct Reporting_Airline, ', ' order by Reporting_Airline) as carriers
 from raw_ontime where {present} group by {keys})"""


SLOT = "FlightDate, Origin, Dest, CRSDepTime"
ROUTE_DAY = "FlightDate, Origin, Dest"
PHYSICAL = "FlightDate, Tail_Number, Origin, Dest, CRSDepTime"
GROUP_MEASURES = "cast(CRSDepTime as bigint) as CRSDepTime, n_rows, n_distinct_carriers, carriers"


def _share(condition: str, digits: int) -> str:
    scale = 10**digits
    return f"""select count(*) filter ({condition}) as dupes, count(*) as groups,
 round_even(count(*) filter ({condition}) / count(*) * 100 * {scale}.0, 0) / {scale}.0 as pct
 from g"""


def _naive(keys: str) -> str:
    return f"""select '{keys}' as key, dupes, groups,
 round_even(dupes / groups * 100 * 1000.0, 0) / 1000.0 as pct from (
 select count(*) filter (n > 1) as dupes, count(*) as groups from (
  select count(*) as n from raw_ontime group by {keys}))"""


RAW_TYPES = FIELDS | {
    "source_year": "int",
    "source_month": "int",
    "_source_file": "string",
    "_ingested_at": "timestamp",
    "_logical_date": "string",
}


def _per_column(parts: str) -> str:
    """One row per raw column from a single row of non-null counts."""
    counts = ", ".join(f'count({c}) as "{c}"' for c in RAW_TYPES)
    rows = "\n union all ".join(
        parts.format(name=c, dtype=d, non_null=f'"{c}"') for c, d in RAW_TYPES.items()
    )
    return f"{RAW},\nk as materialized (select count(*) as n, {counts} from raw_ontime)\n{rows}"


def _summary(source: str, names: list[str]) -> str:
    return "\n union all ".join(
        f"""select '{n}' as "column", count({n}) as "count",
 round(avg(cast({n} as double)), 7) as mean, round(stddev_samp(cast({n} as double)), 7) as std,
 round(min(cast({n} as double)), 7) as "min",
 round(quantile_cont(cast({n} as double), 0.25), 7) as p25,
 round(quantile_cont(cast({n} as double), 0.5), 7) as p50,
 round(quantile_cont(cast({n} as double), 0.75), 7) as p75,
 round(max(cast({n} as double)), 7) as "max" from {source}"""
        for n in names
    )


def _lookup_rows(select: str) -> str:
    return f"with {LABELS}\n" + "\n union all ".join(
        f"select '{name}' as \"table\", {select.format(name=name)}" for name in LOOKUP_SQL
    )


BROKEN = """broken as (select * replace (
  case when hit then DepDelayMinutes + 1 else DepDelayMinutes end as DepDelayMinutes,
  case when hit then ArrDelayMinutes + 1 else ArrDelayMinutes end as ArrDelayMinutes,
  case when hit then 1 - DepDel15 else DepDel15 end as DepDel15,
  case when hit then 1 - ArrDel15 else ArrDel15 end as ArrDel15,
  case when hit then 5 else CarrierDelay end as CarrierDelay,
  case when hit then 100 else ActualElapsedTime end as ActualElapsedTime,
  case when hit then 7 else DivDistance end as DivDistance,
  case when hit then 11 else DistanceGroup end as DistanceGroup,
  case when hit then 9 else DivAirportLandings end as DivAirportLandings)
 from (select *, Flight_Number_Reporting_Airline % 101 = 0 as hit from raw_ontime))"""

RULES = {
    "departure_delay_minutes": (
        "DepDelay is not null and DepDelayMinutes is not null",
        "DepDelayMinutes <> case when DepDelay > 0 then DepDelay else 0 end",
    ),
    "departure_delayed_15": (
        "DepDelay is not null and DepDel15 is not null",
        "DepDel15 <> case when DepDelay >= 15 then 1 else 0 end",
    ),
    "arrival_delay_minutes": (
        "ArrDelay is not null and ArrDelayMinutes is not null",
        "ArrDelayMinutes <> case when ArrDelay > 0 then ArrDelay else 0 end",
    ),
    "arrival_delayed_15": (
        "ArrDelay is not null and ArrDel15 is not null",
        "ArrDel15 <> case when ArrDelay >= 15 then 1 else 0 end",
    ),
    "distance_group": (
        "Distance is not null and DistanceGroup is not null",
        "DistanceGroup <> case when Distance >= 2500 then 11 else 1 + floor(Distance / 250) end",
    ),
    "delay_causes_need_late_arrival": (
        "CarrierDelay is not null or WeatherDelay is not null or NASDelay is not null"
        " or SecurityDelay is not null or LateAircraftDelay is not null",
        "ArrDelay is null or ArrDelay < 15",
    ),
    "diverted_actual_elapsed_null": ("Diverted = 1", "ActualElapsedTime is not null"),
    "diverted_arrival_delay_null": ("Diverted = 1", "ArrDelay is not null"),
    "reached_destination_distance_zero": ("DivReachedDest = 1", "DivDistance <> 0"),
    "landings_marker_only_cancelled": (
        "DivAirportLandings = 9",
        "not (Diverted = 0 and Cancelled = 1)",
    ),
}


#: Of the load: how a row fits its file, and whether a cancellation has a known kind.
LOAD_RULES = {
    "flown_in_month_of_file": (
        "FlightDate is not null",
        "month(cast(FlightDate as date)) <> source_month or year(cast(FlightDate as date)) <> source_year",
    ),
    "cancellation_has_a_kind": ("Cancelled = 1", f"({OUTCOME}) = 'cancelled_other'"),
}


def _rules(source: str, rules: dict[str, tuple[str, str]] = RULES) -> str:
    return "\n union all ".join(
        f"""select '{name}' as rule, count(*) filter ({checked}) as checked,
 count(*) filter (({checked}) and ({broken})) as violations from {source}"""
        for name, (checked, broken) in rules.items()
    )


NAMES = ", ".join(f"('{n}', {i})" for i, n in enumerate(FIELDS))
HEADERS = f"""fields("column", i) as (values {NAMES}),
years as (select distinct year(l_shipdate) as sample from lineitem),
headers as (select sample, "column" from years, fields where (i + sample) % 17 <> 0)"""


def _respelled(name: str, dtype: str) -> str:
    """A field through text and back, as the strict projection must give it."""
    flight = "Flight_Number_Reporting_Airline"
    if dtype == "string":
        missing = ", ".join(f"'{token}'" for token in NA_TOKENS)
        return (
            f"case when {flight} % 11 = 0 or {name} in ({missing}) then null"
            f" else {name} end as {name}"
        )
    wide = "double" if dtype == "float" else "bigint"
    return f"cast(cast(cast({name} as varchar) as double) as {wide}) as {name}"


ROTATED = ALPHABET[13:] + ALPHABET[:13]
MONTH_FILE = MONTH_URL.rsplit("/", 1)[1]


def _printf(template: str, year: str, month: str) -> str:
    return f"printf('{template}', {year}, {month})"


def _delay_by(keys: str, joins: str = "", extra: str = "") -> str:
    outcomes = (
        "diverted",
        "cancelled_before_pushback",
        "cancelled_after_pushback",
        "cancelled_after_departure",
        "cancelled_other",
        "completed",
    )
    counts = ",\n ".join(f"count(*) filter (flight_outcome = '{o}') as {o}" for o in outcomes)
    return f"""select {keys}{extra}, count(*) as flights, count(arrival_delayed_15) as arrivals,
 count(*) filter (arrival_delayed_15) as delayed_arrivals,
 avg(case when arrival_delayed_15 then 1 when not arrival_delayed_15 then 0 end)
  as delay_probability,
 {counts}
 from stg {joins} group by {keys}{extra}"""


def _lookup(name: str, code: str, label: str) -> str:
    return f"select Code as {code}, Description as {label} from ({LOOKUP_SQL[name]})"


ORACLE: dict[str, str] = {
    "stg_flights": f"{FLIGHTS}\nselect * from stg",
    "flight_outcome_counts": (
        f"{FLIGHTS}\nselect flight_outcome, count(*) as flights from stg group by flight_outcome"
    ),
    "stg_diversion_detail": f"{RAW},\n{KEYED},\n{LEGS}\nselect * from legs",
    "stg_carriers": _lookup("l_unique_carriers", "carrier_code", "carrier_name"),
    "stg_cancellation_reasons": _lookup(
        "l_cancellation", "cancellation_code", "cancellation_reason"
    ),
    "stg_city_markets": _lookup("l_city_market_id", "city_market_id", "city_market_name"),
    "stg_delay_groups": _lookup(
        "l_ontime_delay_groups", "delay_group_code", "delay_group_label"
    ),
    "flights_labelled": f"""{FLIGHTS},
{LABELS}
select flight_id, carrier_code, c.Description as carrier_name, cancellation_code,
 x.Description as cancellation_reason, origin_city_market_id,
 o.Description as origin_city_market_name, destination_city_market_id,
 d.Description as destination_city_market_name {LABEL_JOINS}""",
    "delay_bands": f"""{RAW},
{LABELS}
select FlightDate, Reporting_Airline,
 cast(Flight_Number_Reporting_Airline as bigint) as flight_number,
 cast(DepartureDelayGroups as bigint) as departure_group,
 a.Description as departure_delay_band, cast(ArrivalDelayGroups as bigint) as arrival_group,
 b.Description as arrival_delay_band
from raw_ontime
left join l_ontime_delay_groups a on cast(DepartureDelayGroups as varchar) = a.Code
left join l_ontime_delay_groups b on cast(ArrivalDelayGroups as varchar) = b.Code""",
    "diversions_with_parent": WITH_PARENT,
    "diversion_events": EVENTS,
    "slot_report": (
        f"{RAW},\n{_groups(SLOT)}\nselect FlightDate, Origin, Dest, {GROUP_MEASURES} from g"
    ),
    "codeshare_candidates": f"""{RAW},
{_groups(SLOT)}
select FlightDate, Origin, Dest, {GROUP_MEASURES} from g where n_distinct_carriers > 1
order by g.n_rows desc, FlightDate, Origin, Dest, g.CRSDepTime limit 10""",
    "codeshare_share": f"{RAW},\n{_groups(SLOT)}\n{_share('n_distinct_carriers > 1', 2)}",
    "physical_duplicates": f"""{RAW},
{_groups(PHYSICAL)}
select FlightDate, Tail_Number, Origin, Dest, {GROUP_MEASURES} from g where n_rows > 1""",
    "physical_duplicate_share": f"{RAW},\n{_groups(PHYSICAL)}\n{_share('n_rows > 1', 3)}",
    "naive_duplicates": f"{RAW}\n{_naive(ROUTE_DAY)}\n union all {_naive(SLOT)}",
    "key_repeats": f"""{FLIGHTS}
select flight_id, count(*) as n_rows from stg group by flight_id having count(*) > 1""",
    "carrier_identity": f"""{RAW}
select Reporting_Airline, cast(DOT_ID_Reporting_Airline as bigint) as DOT_ID_Reporting_Airline,
 IATA_CODE_Reporting_Airline, count(Tail_Number) as flight_cnt from raw_ontime
where Reporting_Airline is not null and DOT_ID_Reporting_Airline is not null
 and IATA_CODE_Reporting_Airline is not null group by 1, 2, 3""",
    "landings_crosstab": f"""{RAW}
select cast(DivAirportLandings as bigint) as DivAirportLandings,
 cast(Diverted as bigint) as Diverted, cast(Cancelled as bigint) as Cancelled,
 count(*) as flight_count from raw_ontime group by 1, 2, 3
order by 2 nulls first, 3 nulls first, 4 desc""",
    "cancel_progress": f"""{RAW}
select cast(Cancelled as bigint) as Cancelled, cast(Diverted as bigint) as Diverted,
 DepTime is null as no_dep_time, WheelsOff is null as no_wheels_off,
 cast(DivAirportLandings as bigint) as DivAirportLandings, count(*) as n
from raw_ontime where Cancelled = 1 group by 1, 2, 3, 4, 5 order by n desc""",
    "table_shape": f"""{RAW}
select 'raw_ontime' as "table", count(*) as "rows", cast(114 as bigint) as cols from raw_ontime
union all select 'lineitem', count(*), cast(11 as bigint) from lineitem
union all select 'documents', count(*), cast(5 as bigint) from documents""",
    "null_profile": _per_column(
        "select '{name}' as \"column\", n - {non_null} as null_count,"
        " round_even((n - {non_null}) / n * 100 * 100.0, 0) / 100.0 as null_pct from k"
    ),
    "column_info": _per_column(
        "select '{name}' as \"column\", '{dtype}' as type, {non_null} as non_null from k"
    ),
    "numeric_summary": f"{RAW}\n"
    + _summary(
        "raw_ontime",
        [*(n for n, d in FIELDS.items() if d != "string"), "source_year", "source_month"],
    ),
    "numeric_summary_lineitem": _summary(
        "lineitem",
        [
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
        ],
    ),
    "lookup_summary": _lookup_rows(
        "count(*) as \"rows\", cast(3 as bigint) as cols,"
        " 'Code, Description' as columns from {name}"
    ),
    "lookup_heads": _lookup_rows(
        "Code, Description from (select * from {name} order by Code limit 3)"
    ),
    "carrier_isin": f"""{FLIGHTS}
select flight_id, carrier_code, flight_number from stg
where carrier_code in ('{CARRIERS[1]}', '{CARRIERS[2]}', '{CARRIERS[3]}', '{UNLABELLED_CARRIER}')""",
    "carrier_equals": (
        f"select Code, Description from ({LOOKUP_SQL['l_unique_carriers']})"
        f" where Code = '{CARRIERS[1]}'"
    ),
    "market_id_list": (
        f"select Code, Description from ({LOOKUP_SQL['l_city_market_id']})"
        " where Code in ('30000', '30001', '30002', '30005', '30009')"
    ),
    "origin_head": f"""{RAW}
select cast(OriginAirportID as bigint) as OriginAirportID,
 cast(OriginAirportSeqID as bigint) as OriginAirportSeqID,
 cast(OriginCityMarketID as bigint) as OriginCityMarketID, Origin, OriginCityName,
 OriginState, OriginStateFips, OriginStateName, cast(OriginWac as bigint) as OriginWac
from raw_ontime order by 1, 2, 3, 4, 5, 6, 7, 8, 9 limit 5""",
    "month_mismatch": f"""{FLIGHTS}
select flight_date, source_year, source_month, extract(month from flight_date) as actual_month
from stg where extract(month from flight_date) <> source_month
 or extract(year from flight_date) <> source_year""",
    "excess_other_cancellations": f"""{FLIGHTS}
select count(*) as cancelled_other, count(*) > 1 as excess from stg
where flight_outcome = 'cancelled_other'""",
    "rule_violations": f"{RAW},\n{BROKEN}\n{_rules('broken')}",
    "load_rule_counts": f"{RAW},\n{BROKEN}\n{_rules('broken', RULES | LOAD_RULES)}",
    "rule_violations_clean": f"{RAW}\n{_rules('raw_ontime')}",
    "schema_diff": f"""with {HEADERS},
steps as (select sample as sample_from, lead(sample) over (order by sample) as sample_to
 from (select distinct sample from headers))
select cast(sample_from as integer) as sample_from, cast(sample_to as integer) as sample_to,
 'added' as change, "column"
from steps join headers on sample = sample_to
where not exists (select 1 from headers h where h.sample = sample_from
 and h."column" = headers."column")
union all
select cast(sample_from as integer), cast(sample_to as integer), 'removed', "column"
from steps join headers on sample = sample_from
where sample_to is not null and not exists (select 1 from headers h
 where h.sample = sample_to and h."column" = headers."column")""",
    "header_problems": f"""with {HEADERS}
select cast(sample as varchar) as file, "column", 'missing' as problem from years, fields
where (i + sample) % 17 = 0 and sample in (select sample from headers)
union all select cast(sample as varchar), 'Extra', 'unexpected' from years""",
    "typed_projection": f"{RAW}\nselect "
    + ",\n ".join(_respelled(n, d) for n, d in FIELDS.items())
    + " from raw_ontime",
    "annotate": f"""{RAW}
select FlightDate, Reporting_Airline, Tail_Number,
 {_printf(MONTH_FILE, 'source_year', 'source_month')} as _source_file,
 cast('2026-01-01 00:00:00' as timestamp) as _ingested_at,
 {_printf('%d-%02d', 'source_year', 'source_month')} as _logical_date from raw_ontime""",
    "pending_months": f"""{RAW},
calendar as (select unnest(generate_series(date_trunc('month', min(o_orderdate)),
  date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders),
published as (select distinct year(l_shipdate) as y, month(l_shipdate) as mo from lineitem
 where year(l_shipdate) > 1995 or month(l_shipdate) > 2),
loaded as (select distinct source_year as y, source_month as mo from raw_ontime
 where source_month % 3 <> 0)
select cast(year(m) as bigint) as source_year, cast(month(m) as bigint) as source_month
from calendar where (year(m), month(m)) in (select (y, mo) from published)
 and (year(m), month(m)) not in (select (y, mo) from loaded)""",
    "lake_scan": f"""{RAW}
select cast(source_year as bigint) as source_year, cast(source_month as bigint) as source_month,
 count(*) as flights, sum(cast(Distance as double)) as miles from raw_ontime
where source_year = 1997 and source_month <= 6 group by 1, 2""",
    "lake_table": f"""{RAW}
select cast(source_year as bigint) as source_year, Reporting_Airline as carrier,
 count(*) as flights, sum(cast(Distance as double)) as miles from raw_ontime
where source_year in (1995, 1997) and source_month > 3 group by 1, 2""",
    "loaded_months": f"""{RAW}
select distinct cast(source_year as bigint) as source_year,
 cast(source_month as bigint) as source_month from raw_ontime""",
    "lookup_round_trip": _lookup_rows("Code, Description from {name}"),
    "url_codes": f"""select s_name as name, translate(s_name, '{ALPHABET}', '{ROTATED}') as encoded,
 s_name as decoded, concat('{LOOKUP_URL}', translate(s_name, '{ALPHABET}', '{ROTATED}')) as url
from supplier""",
    "month_urls": f"""with m as (select distinct year(l_shipdate) as y, month(l_shipdate) as mo
 from lineitem)
select {_printf(MONTH_URL, 'y', 'mo')} as url, {_printf(MONTH_FILE, 'y', 'mo')} as file,
 {_printf('%d-%02d', 'y', 'mo')} as logical_date from m""",
    "fct_flights": f"""{FLIGHTS},
{LABELS}
select f.*, c.Description as carrier_name, x.Description as cancellation_reason,
 o.Description as origin_city_market_name,
 d.Description as destination_city_market_name {LABEL_JOINS}""",
    "dim_date": f"""{FLIGHTS},
days as (select cast(unnest(generate_series(min(flight_date), max(flight_date),
  interval 1 day)) as date) as "date" from stg)
select "date", cast(year("date") as bigint) as "year", cast(quarter("date") as bigint) as quarter,
 cast(month("date") as bigint) as "month", monthname("date") as month_name,
 cast(day("date") as bigint) as day_of_month, cast(isodow("date") as bigint) as iso_weekday,
 dayname("date") as weekday_name from days""",
    "mart_carrier": f"{FLIGHTS},\n{LABELS}\n"
    + _delay_by(
        "carrier_code",
        "left join l_unique_carriers on carrier_code = Code",
        ", Description",
    ).replace("Description, count", "Description as carrier_name, count", 1),
    "mart_airport": f"{FLIGHTS}\n{_delay_by('origin_airport')}",
    "mart_market": f"{FLIGHTS},\n{LABELS}\n"
    + _delay_by(
        "origin_city_market_id",
        "left join l_city_market_id on cast(origin_city_market_id as varchar) = Code",
        ", Description",
    ).replace("Description, count", "Description as origin_city_market_name, count", 1),
    "mart_quarter": f"{FLIGHTS}\n{_delay_by('flight_quarter')}",
    "mart_causes": f"""{FLIGHTS}
select carrier_code, sum(carrier_delay_minutes) as carrier_delay_minutes,
 sum(weather_delay_minutes) as weather_delay_minutes, sum(nas_delay_minutes) as nas_delay_minutes,
 sum(security_delay_minutes) as security_delay_minutes,
 sum(late_aircraft_delay_minutes) as late_aircraft_delay_minutes from stg group by carrier_code""",
}

# The same results by way of files.
ORACLE["csv_round_trip"] = ORACLE["typed_projection"]
ORACLE["header_report"] = ORACLE["header_problems"]

_NO_KEYS = "\"column\" not in ('source_year', 'source_month')"
ORACLE["stored_null_profile"] = f"select * from ({ORACLE['null_profile']}) where {_NO_KEYS}"
ORACLE["stored_moments"] = f"""select "column", "count", mean, std, "min", "max"
from ({ORACLE['numeric_summary']}) where {_NO_KEYS}"""
ORACLE["stored_schema_diff"] = f"""{RAW},
loaded as (select distinct source_year as y, source_month as mo from raw_ontime where source_month <= 3),
cells as (select printf('%04d-%02d', y, mo) as sample, u.name as "column"
 from loaded, (values ('Origin: string', 0), ('Distance: float', 1), ('DepDelay: float', 3)) u(name, gone)
 where mo <> gone),
steps as (select sample as sample_from, lead(sample) over (order by sample) as sample_to
 from (select distinct sample from cells))
select sample_from, sample_to, 'added' as change, b."column" from steps join cells b on b.sample = sample_to
where not exists (select 1 from cells a where a.sample = sample_from and a."column" = b."column")
union all
select sample_from, sample_to, 'removed', a."column" from steps join cells a on a.sample = sample_from
where sample_to is not null and not exists
 (select 1 from cells b where b.sample = sample_to and b."column" = a."column")"""
