"""Headline timings: build the lake, then query it. Prints one JSON line.

The lake is written once from the tables in ``$BENCH_SF_DIR`` and timed as
``write_lake``; every other query reads it, as it would in use. ``read_csv``
reads the same flights back from CSV text with the strict casts. Each result is
computed in full and thrown away, the best of ``$BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from checks.queries import REGISTRY, Tables
from checks.substitute import raw_ontime
from tarmac.session import local_session
from tarmac.sources.extracts import read_month_csv
from tarmac.sources.fields import FIELDS
from tarmac.sources.lake import write_lake

HEADLINES = (
    "stg_flights",
    "flight_outcome_counts",
    "stg_diversion_detail",
    "diversions_with_parent",
    "diversion_events",
    "flights_labelled",
    "delay_bands",
    "slot_report",
    "codeshare_candidates",
    "physical_duplicates",
    "naive_duplicates",
    "key_repeats",
    "carrier_identity",
    "landings_crosstab",
    "cancel_progress",
    "null_profile",
    "numeric_summary",
    "month_mismatch",
    "rule_violations_clean",
    "fct_flights",
    "mart_carrier",
    "mart_airport",
    "mart_market",
    "mart_quarter",
    "mart_causes",
)


# The flags that extracts spell with decimals.
FLAGS = ("DepDel15", "ArrDel15", "Cancelled", "Diverted", "Flights", "DivReachedDest")


def published(name: str) -> Column:
    """A field as an extract spells it."""
    if name not in FLAGS:
        return F.col(name)
    return F.concat(F.col(name).cast("string"), F.lit(".00")).alias(name)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(
        cores,
        "bench",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-lake-")

    def discard(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def best(build) -> float:
        return min(timed(lambda: discard(build())) for _ in range(runs))

    raw = raw_ontime(spark, sf_dir, spark.sparkContext.defaultParallelism)
    writes = [timed(lambda: write_lake(raw, f"{root}/lake")) for _ in range(runs)]
    seconds = {"write_lake": min(writes)}
    tables = Tables(spark, sf_dir, lake_root=f"{root}/lake")
    text = tables.raw.select(*map(published, FIELDS))
    text = text.coalesce(spark.sparkContext.defaultParallelism)
    text.write.option("header", True).csv(f"{root}/csv")
    seconds["read_csv"] = best(lambda: read_month_csv(spark, f"{root}/csv"))
    for name in HEADLINES:
        seconds[name] = best(lambda: REGISTRY[name](tables))
    print(
        json.dumps(
            {
                "metric": "lake build and headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
