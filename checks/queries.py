"""Every registered query, as DataFrame code over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import substitute
from tarmac.functions import codes
from tarmac.operators import (
    crosstabs,
    diversions,
    duplicates,
    labels,
    profile,
    quality,
    staging,
    stored_profiles,
)
from tarmac.plans import marts, star
from tarmac.session import kept_folder, scratch_folder
from tarmac.sources import extracts, footers, headers, lake, lookups
from tarmac.sources.fields import FIELDS, MODELLED_LOOKUPS


class Tables:
    """The given tables and what is derived from them for one run.

    ``lake_root`` reads the raw table from a stored lake instead of deriving it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, lake_root: str | None = None):
        self.spark, self.sf_dir, self.lake_root = spark, sf_dir, lake_root

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        if self.lake_root:
            return lake.read_lake(self.spark, self.lake_root)
        return substitute.raw_ontime(self.spark, self.sf_dir)

    def raw_lookup(self, table: str) -> DataFrame:
        return substitute.lookup(self.spark, self.sf_dir, table)

    def lookup(self, table: str) -> DataFrame:
        return staging.stg_lookup(self.raw_lookup(table), *MODELLED_LOOKUPS[table])

    @property
    def flights(self) -> DataFrame:
        return staging.stg_flights(self.raw)

    @property
    def label_sides(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (
            self.lookup("l_unique_carriers"),
            self.lookup("l_cancellation"),
            self.lookup("l_city_market_id"),
        )

    @property
    def months(self) -> DataFrame:
        """Distinct months with shipped lines, as a listing of files would give."""
        shipped = F.col("l_shipdate")
        return (
            self.given("lineitem")
            .select(F.year(shipped).alias("source_year"), F.month(shipped).alias("source_month"))
            .distinct()
        )


Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


# Staging


@query
def stg_flights(t: Tables) -> DataFrame:
    return t.flights


@query
def flight_outcome_counts(t: Tables) -> DataFrame:
    return crosstabs.outcome_counts(t.flights)


@query
def stg_diversion_detail(t: Tables) -> DataFrame:
    return diversions.stg_diversion_detail(t.raw)


@query
def stg_carriers(t: Tables) -> DataFrame:
    return t.lookup("l_unique_carriers")


@query
def stg_cancellation_reasons(t: Tables) -> DataFrame:
    return t.lookup("l_cancellation")


@query
def stg_city_markets(t: Tables) -> DataFrame:
    return t.lookup("l_city_market_id")


@query
def stg_delay_groups(t: Tables) -> DataFrame:
    return t.lookup("l_ontime_delay_groups")


# Joins


@query
def flights_labelled(t: Tables) -> DataFrame:
    return labels.with_labels(t.flights, *t.label_sides).select(
        "flight_id",
        "carrier_code",
        "carrier_name",
        "cancellation_code",
        "cancellation_reason",
        "origin_city_market_id",
        "origin_city_market_name",
        "destination_city_market_id",
        "destination_city_market_name",
    )


@query
def delay_bands(t: Tables) -> DataFrame:
    banded = labels.with_delay_bands(t.raw, t.lookup("l_ontime_delay_groups"))
    return banded.select(
        "FlightDate",
        "Reporting_Airline",
        F.col("Flight_Number_Reporting_Airline").cast("long").alias("flight_number"),
        F.col("DepartureDelayGroups").cast("long").alias("departure_group"),
        "departure_delay_band",
        F.col("ArrivalDelayGroups").cast("long").alias("arrival_group"),
        "arrival_delay_band",
    )


@query
def diversions_with_parent(t: Tables) -> DataFrame:
    return diversions.diversions_with_parent(
        diversions.stg_diversion_detail(t.raw), t.flights
    )


@query
def diversion_events(t: Tables) -> DataFrame:
    return diversions.diversion_events(t.raw)


# Duplicates


def _listed(report: DataFrame) -> DataFrame:
    """Carrier list as text, clock time as a long."""
    plain = report.withColumn("carriers", F.array_join("carriers", ", "))
    return plain.withColumn("CRSDepTime", F.col("CRSDepTime").cast("long"))


def _many_carriers() -> Column:
    return F.col("n_distinct_carriers") > 1


def _many_rows() -> Column:
    return F.col("n_rows") > 1


@query
def slot_report(t: Tables) -> DataFrame:
    return _listed(duplicates.group_report(t.raw, duplicates.SLOT))


@query
def codeshare_candidates(t: Tables) -> DataFrame:
    report = duplicates.group_report(t.raw, duplicates.SLOT, _many_carriers())
    return _listed(duplicates.candidates(report, 10, duplicates.SLOT))


@query
def codeshare_share(t: Tables) -> DataFrame:
    counts = duplicates.group_counts(t.raw, duplicates.SLOT)
    return duplicates.duplicate_share(counts, F.col("several_carriers"), 2)


@query
def physical_duplicates(t: Tables) -> DataFrame:
    return _listed(duplicates.group_report(t.raw, duplicates.PHYSICAL_FLIGHT, _many_rows()))


@query
def physical_duplicate_share(t: Tables) -> DataFrame:
    counts = duplicates.group_counts(t.raw, duplicates.PHYSICAL_FLIGHT)
    return duplicates.duplicate_share(counts, _many_rows(), 3)


@query
def naive_duplicates(t: Tables) -> DataFrame:
    return duplicates.naive_shares(t.raw, 3)


@query
def key_repeats(t: Tables) -> DataFrame:
    return duplicates.key_repeats(t.flights, "flight_id")


# Counts


@query
def carrier_identity(t: Tables) -> DataFrame:
    dot_id = "DOT_ID_Reporting_Airline"
    found = crosstabs.carrier_identity(t.raw)
    return found.withColumn(dot_id, F.col(dot_id).cast("long"))


def _long_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@query
def landings_crosstab(t: Tables) -> DataFrame:
    return _long_columns(
        crosstabs.landings_crosstab(t.raw), "DivAirportLandings", "Diverted", "Cancelled"
    )


@query
def cancel_progress(t: Tables) -> DataFrame:
    return _long_columns(
        crosstabs.cancel_progress(t.raw), "DivAirportLandings", "Diverted", "Cancelled"
    )


# Profiles


@query
def table_shape(t: Tables) -> DataFrame:
    frames = {
        "raw_ontime": t.raw,
        "lineitem": t.given("lineitem"),
        "documents": t.given("documents"),
    }
    shapes = [
        profile.shape(df).withColumn("table", F.lit(name)) for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


@query
def null_profile(t: Tables) -> DataFrame:
    return profile.null_profile(t.raw)


@query
def column_info(t: Tables) -> DataFrame:
    return profile.column_info(t.raw)


def _rounded(summary: DataFrame) -> DataFrame:
    measures = [c for c in summary.columns if c not in ("column", "count")]
    return summary.withColumns({c: F.round(c, 7) for c in measures})


@query
def numeric_summary(t: Tables) -> DataFrame:
    return _rounded(profile.numeric_summary(t.raw))


@query
def numeric_summary_lineitem(t: Tables) -> DataFrame:
    return _rounded(profile.numeric_summary(t.given("lineitem")))


def _stored_profile(t: Tables) -> DataFrame:
    """Profiles of all months, stored in two loads, merged."""
    early = F.col("source_year") < 1998
    with scratch_folder(t.spark) as root:
        for part in (early, ~early):
            stored_profiles.store_profiles(t.raw.filter(part), root)
        return stored_profiles.merged(stored_profiles.read_profiles(t.spark, root)).checkpoint()


@query
def stored_null_profile(t: Tables) -> DataFrame:
    return stored_profiles.null_profile(_stored_profile(t))


@query
def stored_moments(t: Tables) -> DataFrame:
    summary = stored_profiles.numeric_summary(_stored_profile(t))
    return _rounded(summary.drop(*profile.QUANTILES))


def _all_lookups(t: Tables) -> dict[str, DataFrame]:
    return {name: t.raw_lookup(name) for name in MODELLED_LOOKUPS}


@query
def lookup_summary(t: Tables) -> DataFrame:
    return lookups.lookup_summary(_all_lookups(t))


@query
def lookup_heads(t: Tables) -> DataFrame:
    heads = [
        lookups.drop_metadata(df)
        .orderBy("Code")
        .limit(3)
        .withColumn("table", F.lit(name))
        for name, df in _all_lookups(t).items()
    ]
    return reduce(DataFrame.unionByName, heads)


# Filters and heads

PICKED_CARRIERS = (*substitute.CARRIERS[1:4], substitute.UNLABELLED_CARRIER)


@query
def carrier_isin(t: Tables) -> DataFrame:
    return t.flights.filter(F.col("carrier_code").isin(*PICKED_CARRIERS)).select(
        "flight_id", "carrier_code", "flight_number"
    )


@query
def carrier_equals(t: Tables) -> DataFrame:
    return t.raw_lookup("l_unique_carriers").filter(F.col("Code") == substitute.CARRIERS[1]).select(
        "Code", "Description"
    )


@query
def market_id_list(t: Tables) -> DataFrame:
    """A lookup's rows for a list of ids, of which some have none."""
    codes_wanted = [str(30000 + i) for i in (0, 1, 2, 5, 9)]
    rows = t.raw_lookup("l_city_market_id").filter(F.col("Code").isin(*codes_wanted))
    return rows.select("Code", "Description")


@query
def origin_head(t: Tables) -> DataFrame:
    columns = [c for c in FIELDS if c.startswith("Origin")]
    top = t.raw.select(*columns).orderBy(*columns).limit(5)
    return _long_columns(
        top, "OriginAirportID", "OriginAirportSeqID", "OriginCityMarketID", "OriginWac"
    )


# Checks


@query
def month_mismatch(t: Tables) -> DataFrame:
    return quality.month_mismatch(t.flights)


@query
def excess_other_cancellations(t: Tables) -> DataFrame:
    return quality.excess_other_cancellations(t.flights)


def _broken(raw: DataFrame) -> DataFrame:
    """The raw rows with every documented rule broken on some of them."""
    hit = F.col("Flight_Number_Reporting_Airline") % 101 == 0
    changes = {
        "DepDelayMinutes": F.col("DepDelayMinutes") + 1,
        "ArrDelayMinutes": F.col("ArrDelayMinutes") + 1,
        "DepDel15": 1 - F.col("DepDel15"),
        "ArrDel15": 1 - F.col("ArrDel15"),
        "CarrierDelay": F.lit(5),
        "ActualElapsedTime": F.lit(100),
        "DivDistance": F.lit(7),
        "DistanceGroup": F.lit(11),
        "DivAirportLandings": F.lit(9),
    }
    return raw.withColumns(
        {
            name: F.when(hit, value.cast(FIELDS[name])).otherwise(F.col(name))
            for name, value in changes.items()
        }
    )


@query
def rule_violations(t: Tables) -> DataFrame:
    return quality.rule_violations(_broken(t.raw))


@query
def rule_violations_clean(t: Tables) -> DataFrame:
    return quality.rule_violations(t.raw)


def _sample_headers(t: Tables) -> DataFrame:
    """Yearly headers with some names left out, by year."""
    years = t.months.select(F.col("source_year").alias("sample")).distinct()
    names = F.posexplode(F.array(*map(F.lit, FIELDS))).alias("i", "column")
    return years.select("sample", names).filter((F.col("i") + F.col("sample")) % 17 != 0)


@query
def schema_diff(t: Tables) -> DataFrame:
    return headers.schema_diff(_sample_headers(t))


@query
def header_problems(t: Tables) -> DataFrame:
    kept = _sample_headers(t).select(F.col("sample").cast("string").alias("file"), "column")
    extra = kept.select("file").distinct().withColumn("column", F.lit("Extra"))
    return headers.column_problems(kept.unionByName(extra))


# Ingestion


def _as_text(raw: DataFrame) -> DataFrame:
    """Raw fields as an extract might spell them: ``1.00``, ``NA``, leading zeros."""
    flight = F.col("Flight_Number_Reporting_Airline")

    def spelled(name: str, dtype: str) -> Column:
        text = F.col(name).cast("string")
        if dtype == "string":
            return F.when(flight % 11 == 0, F.lit("NA")).otherwise(text)
        if dtype == "int":
            return F.when(flight % 5 == 0, F.concat(F.lit("0"), text)).otherwise(text)
        if dtype == "float":
            return text
        return F.when(flight % 7 == 0, F.concat(text, F.lit(".00"))).otherwise(text)

    return raw.select(*[spelled(n, d).alias(n) for n, d in FIELDS.items()])


def _wide(typed: DataFrame) -> DataFrame:
    wide = {"float": "double", "string": "string"}
    return typed.select(
        *[F.col(n).cast(wide.get(d, "long")).alias(n) for n, d in FIELDS.items()]
    )


@query
def typed_projection(t: Tables) -> DataFrame:
    return _wide(extracts.typed_projection(_as_text(t.raw)))


@query
def annotate(t: Tables) -> DataFrame:
    year, month = F.col("source_year"), F.col("source_month")
    rows = t.raw.select("FlightDate", "Reporting_Airline", "Tail_Number", year, month)
    source_file = codes.last_path_part(codes.month_url(year, month))
    loaded_at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    return extracts.annotate(rows, source_file, year, month, loaded_at).drop(*lake.MONTH_KEYS)


@query
def pending_months(t: Tables) -> DataFrame:
    bounds = t.given("orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    calendar = lake.month_calendar(bounds, F.col("first"), F.col("last"))
    published = t.months.filter((F.col("source_year") > 1995) | (F.col("source_month") > 2))
    loaded = t.raw.filter(F.col("source_month") % 3 != 0).select(*lake.MONTH_KEYS).distinct()
    return _long_columns(
        lake.pending_months(calendar, published, loaded), *lake.MONTH_KEYS
    )


@query
def lake_scan(t: Tables) -> DataFrame:
    """Write the raw table as a lake, then read two quarters of one year back."""
    with scratch_folder(t.spark) as root:
        lake.write_lake(t.raw, root)
        half_year = (F.col("source_year") == 1997) & (F.col("source_month") <= 6)
        found = (
            lake.read_lake(t.spark, root)
            .filter(half_year)
            .groupBy(*lake.MONTH_KEYS)
            .agg(
                F.count("*").alias("flights"),
                F.sum(F.col("Distance").cast("double")).alias("miles"),
            )
        )
        return _long_columns(found, *lake.MONTH_KEYS).checkpoint()


@query
def stored_schema_diff(t: Tables) -> DataFrame:
    """A lake whose months differ in some columns, compared by the footers of its files."""
    months = t.raw.select(*lake.MONTH_KEYS, "Origin", "Distance", "DepDelay").filter("source_month <= 3")
    with scratch_folder(t.spark) as root:
        for month, left_out in ((1, "Distance"), (2, None), (3, "DepDelay")):
            own = months.filter(F.col("source_month") == month)
            lake.write_lake(own.drop(left_out) if left_out else own, root)
        diff = headers.schema_diff(footers.stored_columns(t.spark, root))
        return diff.checkpoint()


@query
def lake_table(t: Tables) -> DataFrame:
    """A lake of one half of the months under a name, the others loaded later, by SQL."""
    name = f"lake_{uuid.uuid4().hex}"
    early = F.col("source_year") < 1996
    with scratch_folder(t.spark) as root:
        lake.write_lake(t.raw.filter(early), root)
        lake.create_lake_table(t.spark, name, root, t.raw.schema)
        later = t.raw.filter(~early)
        lake.write_lake(later, root)
        months = later.select(*lake.MONTH_KEYS).distinct().collect()  # names of months
        lake.register_months(t.spark, name, root, [tuple(r) for r in months])
        found = t.spark.sql(
            f"""SELECT CAST(source_year AS BIGINT) AS source_year, Reporting_Airline AS carrier,
                count(*) AS flights, sum(CAST(Distance AS DOUBLE)) AS miles FROM {name}
                WHERE source_year IN (1995, 1997) AND source_month > 3
                GROUP BY source_year, Reporting_Airline"""
        ).checkpoint()
        t.spark.sql(f"DROP TABLE {name}")
        return found


@query
def load_rule_counts(t: Tables) -> DataFrame:
    """What the load itself counts of the rules, while it writes the lake."""
    counts = quality.RuleCounts(quality.load_rules())
    with scratch_folder(t.spark) as root:
        lake.write_lake(_broken(t.raw), root, counts.watch)
    return counts.frame(t.spark)


@query
def loaded_months(t: Tables) -> DataFrame:
    with scratch_folder(t.spark) as root:
        lake.write_lake(t.raw.select("FlightDate", *lake.MONTH_KEYS), root)
        return _long_columns(lake.loaded_months(t.spark, root), *lake.MONTH_KEYS).checkpoint()


# Most pieces that a table goes through text in; up to that number, most rows of a piece.
PIECES, PIECE_ROWS = 8, 5_000_000

# Rows of a file of text: a zipped one cannot be split, so a task reads back as many at least.
_FILE_ROWS = 50_000


@query
def csv_round_trip(t: Tables) -> DataFrame:
    """The raw table through CSV text as published, in two column orders.

    A large table goes piece by piece: the text of one piece is on disk at a time, zipped, beside
    the rows that were read back. These are stored as columns, in a fifth of the room of a
    checkpoint, until the application ends.
    """
    even = F.col("Flight_Number_Reporting_Airline").cast("int") % 2 == 0
    parts = {"even": (even, list(FIELDS)), "odd": (~even, list(reversed(FIELDS)))}
    pieces = min(PIECES, 1 + t.raw.count() // PIECE_ROWS)
    piece = F.pmod(F.xxhash64("Flight_Number_Reporting_Airline", "CRSDepTime"), F.lit(pieces))
    zipped = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    written = {"header": True, "maxRecordsPerFile": _FILE_ROWS} | zipped | headers.CSV_QUOTING
    with kept_folder(t.spark) as kept:
        for i in range(pieces):
            text = _as_text(t.raw.filter(piece == i) if pieces > 1 else t.raw)
            with scratch_folder(t.spark) as root:
                for name, (rows, columns) in parts.items():
                    trailing = F.lit(None).cast("string").alias("")
                    published = text.filter(rows).select(*columns, trailing)
                    published.write.options(**written).csv(f"{root}/{name}")
                months = extracts.read_months_csv(t.spark, [f"{root}/{name}" for name in parts])
                typed = _wide(months)
                typed.write.mode("append").option("compression", "zstd").parquet(kept)
        return t.spark.read.schema(typed.schema).parquet(kept)


@query
def lookup_round_trip(t: Tables) -> DataFrame:
    """The lookups through CSV files and their snapshots to views."""
    with scratch_folder(t.spark) as root:
        for name in MODELLED_LOOKUPS:
            rows = lookups.drop_metadata(t.raw_lookup(name))
            path = f"{root}/csv/{name.upper()}.csv"
            rows.write.options(header=True, **headers.CSV_QUOTING).csv(path)
        names = [name.upper() for name in MODELLED_LOOKUPS]
        lookups.load_lookups(t.spark, f"{root}/csv", f"{root}/lookups", names)
        lookups.register_lookups(t.spark, f"{root}/lookups")
        stored = lookups.read_lookups(t.spark, f"{root}/lookups")
        frames = [
            lookups.drop_metadata(t.spark.table(name)).withColumn("table", F.lit(name))
            for name in stored
        ]
        return reduce(DataFrame.unionByName, frames).checkpoint()


@query
def header_report(t: Tables) -> DataFrame:
    """``header_problems`` again, from the header lines of files."""
    cells = F.array_sort(F.collect_list(F.struct("i", "column")))
    names = F.array_join(F.transform(cells, lambda c: c["column"]), ",")
    kept = _sample_headers(t).groupBy("sample").agg(names.alias("value"))
    with scratch_folder(t.spark) as root:
        lines = kept.select("sample", F.concat("value", F.lit(",Extra,")).alias("value"))
        lines.write.partitionBy("sample").text(root)
        paths = [f"{root}/sample={r.sample}" for r in kept.select("sample").collect()]
        report = headers.header_report(t.spark, paths)
        sample = F.regexp_extract("file", "sample=([0-9]+)", 1)
        return report.withColumn("file", sample).checkpoint()


@query
def url_codes(t: Tables) -> DataFrame:
    name = F.col("s_name")
    return t.given("supplier").select(
        name.alias("name"),
        codes.encode(name).alias("encoded"),
        codes.decode(codes.encode(name)).alias("decoded"),
        codes.lookup_url(name).alias("url"),
    )


@query
def month_urls(t: Tables) -> DataFrame:
    year, month = F.col("source_year"), F.col("source_month")
    url = codes.month_url(year, month)
    return t.months.select(
        url.alias("url"),
        codes.last_path_part(url).alias("file"),
        codes.logical_date(year, month).alias("logical_date"),
    )


# Star schema and marts


@query
def fct_flights(t: Tables) -> DataFrame:
    return star.fct_flights(t.raw, *t.label_sides)


@query
def dim_date(t: Tables) -> DataFrame:
    return star.dim_date(t.flights)


@query
def mart_carrier(t: Tables) -> DataFrame:
    return marts.delay_by_carrier(t.flights, t.lookup("l_unique_carriers"))


@query
def mart_airport(t: Tables) -> DataFrame:
    return marts.delay_by(t.flights, ["origin_airport"])


@query
def mart_market(t: Tables) -> DataFrame:
    return marts.delay_by_market(t.flights, t.lookup("l_city_market_id"))


@query
def mart_quarter(t: Tables) -> DataFrame:
    return marts.delay_by(t.flights, ["flight_quarter"])


@query
def mart_causes(t: Tables) -> DataFrame:
    return marts.delay_causes(t.flights, ["carrier_code"])
