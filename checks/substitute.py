"""Flights for the checks, made from the given tables.

No flight data is at hand, so ``raw_ontime`` derives a lake table from
``lineitem``: one flight per line, every 500th order also filed by another
carrier and every 70th filed twice, the second time as not diverted. The lookups come from ``supplier``,
``part``, ``customer`` and ``orders``. Field expressions are written once as SQL text
that Spark and the comparison engine both read; what is checked is built on
top of them twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import compile_wide_rows
from tarmac.sources.fields import FIELDS

# Invented carriers; airports and the states they lie in.
CARRIERS = (
    "QA", "QB", "QC", "Q1", "Q2", "Q3", "ZA", "ZB", "ZC", "Z1", "Z2", "Z3", "VA", "VB", "V9",
)
UNLABELLED_CARRIER = CARRIERS[6]
LABEL_ALONE = "77Q"
AIRPORTS = ("ATL", "JFK", "LGA", "EWR", "ORD", "LAX", "SFO", "SEA", "LAS", "SGF")
STATES = ("GA", "NY", "NY", "NJ", "IL", "CA", "CA", "WA", "NV", "MO")


def _pick(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at an index from 0."""
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {cases} end"


def _hhmm(minute: str) -> str:
    return f"(({minute})%24)*100 + (({minute})%60)"


def _unless(condition: str, value: str) -> str:
    return f"case when {condition} then null else {value} end"


def _block(hour: str) -> str:
    padded = f"lpad(cast(({hour})%24 as string),2,'0')"
    return f"concat({padded},'00-',{padded},'59')"


def _place(prefix: str, i: str) -> dict[str, str]:
    state = _pick(STATES, i)
    return {
        f"{prefix}AirportID": f"10000+{i}",
        f"{prefix}AirportSeqID": f"(10000+{i})*100+1",
        f"{prefix}CityMarketID": f"30000+case when {i} in (1,2,3) then 1 else {i} end",
        prefix: _pick(AIRPORTS, i),
        f"{prefix}CityName": f"concat('City ',{_pick(AIRPORTS, i)})",
        f"{prefix}State": state,
        f"{prefix}StateFips": f"cast({i} as string)",
        f"{prefix}StateName": f"concat('State ',{state})",
        f"{prefix}Wac": f"20+{i}",
    }


def _slot(j: int) -> dict[str, str]:
    airport = "case when cx then oi else (oi+6)%10 end" if j == 2 else f"(oi+{j}+4)%10"
    absent = f"nd<{j}"
    return {
        f"Div{j}Airport": _unless(absent, _pick(AIRPORTS, airport)),
        f"Div{j}AirportID": _unless(absent, f"10000+{airport}"),
        f"Div{j}AirportSeqID": _unless(absent, f"(10000+{airport})*100+1"),
        f"Div{j}WheelsOn": _unless(absent, _hhmm(f"h+{j}")),
        f"Div{j}TotalGTime": _unless(absent, f"10+(h+{j})%90"),
        f"Div{j}LongestGTime": _unless(absent, f"10+(h+{j})%45"),
        f"Div{j}WheelsOff": _unless(f"{absent} or nd={j}", _hhmm(f"h+{j}+1")),
        f"Div{j}TailNum": _unless(f"{absent} or h%40=0", "concat('N',cast(p as string))"),
    }


def field_expressions(isodow: str) -> dict[str, str]:
    """SQL per raw field over the columns of ``_BASE`` to ``_STATE``."""
    no_departure, no_takeoff = "cx and ck=0", "cx and ck in (0,1)"
    no_arrival, on_time, no_return = "cx or dv", "cx or dv or ad<15", "h%100<>7"
    reached = "not dv or h%2=0"
    carrier = _pick(CARRIERS, "s%15")
    cause = "case when h%5={} then ad else 0 end"
    values = {
        "Year": "year(d)",
        "Quarter": "quarter(d)",
        "Month": "month(d)",
        "DayofMonth": "day(d)",
        "DayOfWeek": isodow,
        "FlightDate": "substr(cast(d as string),1,10)",
        "Reporting_Airline": carrier,
        "DOT_ID_Reporting_Airline": "19000+s%15",
        "IATA_CODE_Reporting_Airline": carrier,
        "Tail_Number": _unless("h%40=0", "concat('N',cast(p as string))"),
        "Flight_Number_Reporting_Airline": "k%9999",
        **_place("Origin", "oi"),
        **_place("Dest", "di"),
        "CRSDepTime": _hhmm("h"),
        "DepTime": _unless(no_departure, _hhmm("h+dd+12")),
        "DepDelay": _unless(no_departure, "dd"),
        "DepDelayMinutes": _unless(no_departure, "greatest(dd,0)"),
        "DepDel15": _unless(no_departure, "case when dd>=15 then 1 else 0 end"),
        "DepartureDelayGroups": _unless(
            no_departure, "least(12,greatest(-2,floor(dd/15)))"
        ),
        "DepTimeBlk": _block("h"),
        "TaxiOut": _unless(no_takeoff, "5+h%30"),
        "WheelsOff": _unless(no_takeoff, _hhmm("h+3")),
        "WheelsOn": _unless(no_arrival, _hhmm("h+5")),
        "TaxiIn": _unless(no_arrival, "2+h%12"),
        "CRSArrTime": _hhmm("h+2"),
        "ArrTime": _unless(no_arrival, _hhmm("h+6")),
        "ArrDelay": _unless(no_arrival, "ad"),
        "ArrDelayMinutes": _unless(no_arrival, "greatest(ad,0)"),
        "ArrDel15": _unless(no_arrival, "case when ad>=15 then 1 else 0 end"),
        "ArrivalDelayGroups": _unless(
            no_arrival, "least(12,greatest(-2,floor(ad/15)))"
        ),
        "ArrTimeBlk": _block("h+2"),
        "Cancelled": "case when cx then 1 else 0 end",
        "CancellationCode": "case when cx then substr('ABCD',cast(1+ck as int),1) end",
        "Diverted": "case when dv then 1 else 0 end",
        "CRSElapsedTime": "60+p%300",
        "ActualElapsedTime": _unless(no_arrival, "55+p%300+h%20"),
        "AirTime": _unless(no_arrival, "40+p%300"),
        "Flights": "1",
        "Distance": "100+p%2500",
        "DistanceGroup": "least(11,1+floor((100+p%2500)/250))",
        "CarrierDelay": _unless(on_time, cause.format(0)),
        "WeatherDelay": _unless(on_time, cause.format(1)),
        "NASDelay": _unless(on_time, cause.format(2)),
        "SecurityDelay": _unless(on_time, cause.format(3)),
        "LateAircraftDelay": _unless(on_time, cause.format(4)),
        "FirstDepTime": _unless(no_return, _hhmm("h")),
        "TotalAddGTime": _unless(no_return, "h%60"),
        "LongestAddGTime": _unless(no_return, "h%60"),
        "DivAirportLandings": "land",
        "DivReachedDest": _unless("not dv", "h%2"),
        "DivActualElapsedTime": _unless(reached, "200+p%300"),
        "DivArrDelay": _unless(reached, "100+ad"),
        "DivDistance": _unless("not dv", "case when h%2=1 then 0 else p%500 end"),
    }
    for j in range(1, 6):
        values.update(_slot(j))
    typed = {
        name: values[name] if dtype == "string" else f"cast({values[name]} as {dtype})"
        for name, dtype in FIELDS.items()
    }
    return typed | {
        "source_year": "cast(year(d) as int)",
        "source_month": "cast(case when h%997=0 then 1+month(d)%12 else month(d) end as int)",
        "_source_file": (
            "concat('ontime_',cast(year(d) as string),'_',cast(month(d) as string),'.zip')"
        ),
        "_ingested_at": "cast('2026-01-01 00:00:00' as timestamp)",
        "_logical_date": "substr(cast(d as string),1,7)",
    }


_BASE = [
    "l_orderkey as k",
    "l_linenumber as n",
    "l_partkey as p",
    "l_suppkey + case when f = 1 then 1 else 0 end as s",
    "f",
    "l_shipdate as d",
    "l_orderkey*7 + l_linenumber*13 + l_partkey*3 as h",
    "l_partkey%10 as oi",
    "(l_partkey%10 + 1 + l_orderkey%9)%10 as di",
]
_FLAGS = [
    "*",
    "h%50=1 as cx",
    "h%50=2 and f<2 as dv",
    "cast(floor(h/50) as bigint)%4 as ck",
    "cast(floor(h/50) as bigint)%5+1 as dn",
    "h%97-12 as dd",
    "h%89-10 as ad",
]
_STATE = [
    "*",
    "case when dv then dn when cx and ck=2 then 9 else 0 end as land",
    "case when dv then dn when cx and ck=2 then 2 else 0 end as nd",
]


def _filings() -> F.Column:
    """Filings of a line: 0 its own, 1 by another carrier, 2 a repeat."""
    none = F.array().cast("array<int>")
    key = F.col("l_orderkey")
    return F.explode(
        F.concat(
            F.array(F.lit(0)),
            F.when(key % 500 == 3, F.array(F.lit(1))).otherwise(none),
            F.when(key % 70 == 5, F.array(F.lit(2))).otherwise(none),
        )
    )


def raw_ontime(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The raw lake table, 114 columns; Spark prunes those a query leaves out.

    ``tasks`` deals the lines out first, for a file too small to be split.
    """
    compile_wide_rows(spark)
    fields = field_expressions("weekday(d)+1")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if tasks:
        lines = lines.repartition(tasks, "l_orderkey", "l_linenumber")
    return (
        lines.select("*", _filings().alias("f"))
        .selectExpr(*_BASE)
        .selectExpr(*_FLAGS)
        .selectExpr(*_STATE)
        .selectExpr(*[f"{sql} as {name}" for name, sql in fields.items()])
    )


def raw_ontime_sql() -> str:
    """CTE ``raw_ontime`` for the comparison engine."""
    fields = field_expressions("isodow(d)")
    columns = ",\n  ".join(f"{sql} as {name}" for name, sql in fields.items())
    return f"""filings as (
 select *, 0 as f from lineitem
 union all select *, 1 from lineitem where l_orderkey%500=3
 union all select *, 2 from lineitem where l_orderkey%70=5),
b as (select {', '.join(_BASE)} from filings),
c as (select {', '.join(_FLAGS)} from b),
e as (select {', '.join(_STATE)} from c),
raw_ontime as (select
  {columns}
 from e)"""


# Lookups. One carrier has no label and one label no carrier; two markets have no
# label, as their customers count for others, and three airports share one market.

_CARRIER_CODE = (
    f"case when s_suppkey%15=6 then '{LABEL_ALONE}' else {_pick(CARRIERS, 's_suppkey%15')} end"
)
_MARKET_CODE = (
    "cast(30000+case when c_nationkey in (2,3) then c_nationkey+20 else c_nationkey end as string)"
)

LOOKUP_SQL = {
    "l_unique_carriers": f"""
 select {_CARRIER_CODE} as Code, min(s_name) as Description
 from supplier group by {_CARRIER_CODE}""",
    "l_cancellation": """
 select substr('ABCD',cast(1+p_partkey%4 as int),1) as Code,
  min(case p_partkey%4 when 0 then 'Carrier' when 1 then 'Weather'
   when 2 then 'National Air System' else 'Security' end) as Description from part
 group by substr('ABCD',cast(1+p_partkey%4 as int),1)""",
    "l_city_market_id": f"""
 select {_MARKET_CODE} as Code, min(c_name) as Description from customer group by {_MARKET_CODE}""",
    "l_ontime_delay_groups": """
 select cast(o_orderkey%15-2 as string) as Code,
  concat('Delay group ', min(cast(o_orderkey%15-2 as string))) as Description from orders
 group by cast(o_orderkey%15-2 as string)""",
}

_LOOKUP_SOURCES = {
    "l_unique_carriers": ("supplier", "s_suppkey", "s_name"),
    "l_cancellation": ("part", "p_partkey", None),
    "l_city_market_id": ("customer", "c_nationkey", "c_name"),
    "l_ontime_delay_groups": ("orders", "o_orderkey", None),
}


def lookup(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One lookup as its snapshot would hold it, ``_ingested_at`` included."""
    source, key_name, label_name = _LOOKUP_SOURCES[table]
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    key = F.col(key_name)
    if table == "l_unique_carriers":
        listed = F.get(F.array(*map(F.lit, CARRIERS)), (key % 15).cast("int"))
        code = F.when(key % 15 == 6, LABEL_ALONE).otherwise(listed)
        pairs = rows.groupBy(code.alias("Code")).agg(F.min(label_name).alias("Description"))
    elif table == "l_cancellation":
        labels = F.array(*map(F.lit, ("Carrier", "Weather", "National Air System", "Security")))
        pairs = rows.select((key % 4).cast("int").alias("i")).distinct().select(
            F.substr(F.lit("ABCD"), F.col("i") + 1, F.lit(1)).alias("Code"),
            labels[F.col("i")].alias("Description"),
        )
    elif table == "l_city_market_id":
        pairs = (
            rows.withColumn("market", 30000 + F.when(key.isin(2, 3), key + 20).otherwise(key))
            .groupBy(F.col("market").cast("string").alias("Code"))
            .agg(F.min(label_name).alias("Description"))
        )
    else:
        code = (key % 15 - 2).cast("string")
        pairs = rows.select(code.alias("Code")).distinct().withColumn(
            "Description", F.concat(F.lit("Delay group "), "Code")
        )
    return pairs.withColumn("_ingested_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
