"""Every registered query against its SQL, and the entry points."""

from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pytest

import __spark_entry__ as entry_points
from checks import queries
from checks.compare import differences
from checks.oracle import ORACLE
from checks.queries import REGISTRY
from tarmac.session import ensure_checkpoint_dir


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    result = entry_points.queries()[name](spark, sf_dir)
    assert differences(result, duck, entry_points.oracle_sql()[name]) == []


def test_entry_counts_outcomes(spark):
    counts = {r.flight_outcome: r.flights for r in entry_points.entry(spark).collect()}
    assert counts == {
        "completed": 5845,
        "diverted": 130,
        "cancelled_before_pushback": 26,
        "cancelled_after_pushback": 36,
        "cancelled_after_departure": 38,
        "cancelled_other": 29,
    }


def _bytes_below(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())


def test_text_of_a_large_table_is_on_disk_a_piece_at_a_time(spark, tmp_path, monkeypatch):
    lines = spark.range(20_000).selectExpr(
        "id div 4 as l_orderkey",
        "id * 7919 % 20000 as l_partkey",
        "id % 1000 as l_suppkey",
        "cast(1 + id % 4 as int) as l_linenumber",
        "cast(date_add(date'1995-01-01', cast(id % 900 as int)) as timestamp) as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    shared = urlparse(ensure_checkpoint_dir(spark)).path
    before, text, on_disk = _bytes_below(shared), [], []

    def read(session, paths, *rest, read=queries.extracts.read_months_csv):
        text.append(sum(_bytes_below(urlparse(path).path) for path in paths))
        on_disk.append(_bytes_below(shared) - before)
        return read(session, paths, *rest)

    monkeypatch.setattr(queries.extracts, "read_months_csv", read)
    monkeypatch.setattr(queries, "PIECE_ROWS", 20_000, raising=False)
    found = REGISTRY["csv_round_trip"](queries.Tables(spark, str(tmp_path)))
    on_disk.append(_bytes_below(shared) - before)
    wanted = REGISTRY["typed_projection"](queries.Tables(spark, str(tmp_path)))
    assert found.schema == wanted.schema
    wanted = Counter(wanted.collect())
    assert Counter(found.collect()) == wanted
    n = sum(wanted.values())
    assert len(text) == 2 and max(text) < 60 * n  # plain and at once: 340 bytes a row
    assert max(on_disk) < 150 * n
