"""Wide rows in sessions that were not made by ``local_session``, and folders of results."""

import pytest

from checks.queries import _as_text
from checks.substitute import raw_ontime
from tarmac.operators import profile, staging, stored_profiles
from tarmac.session import compile_wide_rows, kept_folder
from tarmac.sources import extracts

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def plain(spark):
    """The session with Spark's own limit, from which the JVM interprets wide rows."""
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "65535")
    yield spark
    spark.conf.set(LIMIT, before)


def _flights(spark, sf_dir):
    raw = raw_ontime(spark, sf_dir)
    spark.conf.set(LIMIT, "65535")
    return raw


@pytest.mark.parametrize(
    "build",
    [
        staging.stg_flights,
        profile.numeric_summary,
        stored_profiles.month_profiles,
        lambda raw: extracts.typed_projection(_as_text(raw)),
    ],
)
def test_wide_operators_keep_generated_code_compilable(plain, sf_dir, build):
    build(_flights(plain, sf_dir))
    assert plain.conf.get(LIMIT) == "8000"


def test_derived_flights_keep_generated_code_compilable(plain, sf_dir):
    raw_ontime(plain, sf_dir)
    assert plain.conf.get(LIMIT) == "8000"


def test_a_lower_limit_stays(plain):
    plain.conf.set(LIMIT, "4000")
    compile_wide_rows(plain)
    assert plain.conf.get(LIMIT) == "4000"


def test_a_kept_folder_goes_with_the_application(spark):
    with kept_folder(spark) as root:
        spark.range(3).write.mode("append").parquet(root)
    assert spark.read.parquet(root).count() == 3
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.cancelDeleteOnExit(folder)  # true if it was to be removed at the end
    assert system.deleteOnExit(folder)


def test_a_kept_folder_goes_at_once_when_its_result_fails(spark):
    with pytest.raises(ValueError), kept_folder(spark) as root:
        spark.range(3).write.mode("append").parquet(root)
        raise ValueError
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
