from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.functions.timestamps import add_utc_micros, known_zones

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def micros(*parts, us=0, offset=0):
    return int((datetime(*parts, tzinfo=timezone.utc) - EPOCH).total_seconds()) * 1_000_000 + us - offset * 60_000_000


def parse(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, zone string")
    out = add_utc_micros(df, "us", F.col("text"), F.col("zone"), known_zones(spark))
    return [r["us"] for r in out.orderBy("i").collect()]


CASES = [
    ("2026-01-02", "UTC", micros(2026, 1, 2)),
    ("2026-01", "UTC", micros(2026, 1, 1)),
    ("2026-01-02T03:04Z", None, micros(2026, 1, 2, 3, 4)),
    ("2026-01-02T03:04:05.123456789Z", None, micros(2026, 1, 2, 3, 4, 5, us=123456)),
    ("2026-01-02T03:04:05,5Z", None, micros(2026, 1, 2, 3, 4, 5, us=500000)),
    ("2026-01-02T03:04:05-0330", None, micros(2026, 1, 2, 3, 4, 5, offset=-210)),
    ("2026-01-02 03:04:05 +05:45", None, micros(2026, 1, 2, 3, 4, 5, offset=345)),
    ("2026-01-02 03:04:05 CEST", None, micros(2026, 1, 2, 3, 4, 5, offset=120)),
    ("\t 2026/01/02 03:04:05 ", "Asia/Kolkata", micros(2026, 1, 2, 3, 4, 5, offset=330)),
    ("20260102T030405Z", None, micros(2026, 1, 2, 3, 4, 5)),
    ("2 Jan 2026 03:04:05", "UTC", micros(2026, 1, 2, 3, 4, 5)),
    ("Fri, 02 Jan 2026 03:04:05 GMT", None, micros(2026, 1, 2, 3, 4, 5)),
    ("Mon, 02 Jan 2026 03:04:05 GMT", None, None),
    ("Jan 2, 2026 12:04 AM", "UTC", micros(2026, 1, 2, 0, 4)),
    ("Jan 2, 2026 12:04 PM", "UTC", micros(2026, 1, 2, 12, 4)),
    ("2026-03-29T02:30:00[Europe/Berlin]", None, micros(2026, 3, 29, 2, 30, offset=60)),
    ("2025-10-26 02:30:00", "Europe/Berlin", micros(2025, 10, 26, 2, 30, offset=120)),
    ("2026-03-08 02:30:00", "America/New_York", micros(2026, 3, 8, 2, 30, offset=-300)),
    ("1771140901", None, 1771140901_000000),
    ("1771140901234", None, 1771140901_234000),
    ("1771140901234567", None, 1771140901_234567),
    ("1771140901.25", None, 1771140901_250000),
    ("2026-01-02 03:04:05", None, None),
    ("2026-01-02 03:04:05", "Nowhere/Land", None),
    ("2026-02-30", "UTC", None),
    ("2026-13-01T00:00:00Z", None, None),
    ("2026-01-01T25:00:00Z", None, None),
    ("0000-00-00", "UTC", None),
    ("00:00", "UTC", None),
    ("", "UTC", None),
    (None, "UTC", None),
    ("not scraped", "UTC", None),
    ("x" * 100_000, "UTC", None),
]


def test_each_format_and_policy(spark):
    assert parse(spark, [c[:2] for c in CASES]) == [c[2] for c in CASES]


def test_the_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert parse(spark, [c[:2] for c in CASES]) == [c[2] for c in CASES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "t string, us string, __x int")
    out = add_utc_micros(df, "us", F.col("t"), F.lit("UTC"), known_zones(spark))
    assert out.columns == ["t", "__x", "us"] and out.count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.datetimes(datetime(2000, 1, 1), datetime(2037, 1, 1)), st.sampled_from(["Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "UTC"])), min_size=50, max_size=200))
def test_local_times_against_the_standard_library(spark, rows):
    """fold 0 is the earlier instant of a repeated hour and the offset before the change in a skipped one."""
    want = [int((d.replace(microsecond=0, tzinfo=ZoneInfo(z)) - EPOCH) / timedelta(microseconds=1)) for d, z in rows]
    assert parse(spark, [(d.strftime("%Y-%m-%d %H:%M:%S"), z) for d, z in rows]) == want


@pytest.mark.parametrize("table", ["urls", "doms"])
def test_p4_found_against_brute_force(spark, table):
    """Every canonical-looking text of the data that Python's own parser reads must come out with the same instant."""
    from conftest import TESTDATA
    from quillmesh.plans.problems import p4_found

    found = {(r.src_table, r.row_id, r.field_name): r.utc_micros for r in p4_found(spark, f"{TESTDATA}/sf0.001").collect()}
    zones = {r.worker_id: r.zone_name for r in spark.read.parquet(f"{TESTDATA}/sf0.001/workers.parquet").collect()}
    key, fields = ("url_id", ("lastmod", "last_scraped")) if table == "urls" else ("dom_id", ("fetched_at",))
    seen = 0
    for r in spark.read.parquet(f"{TESTDATA}/sf0.001/{table}.parquet").drop("html").collect():
        for f in fields:
            try:
                t = datetime.fromisoformat((r[f] or "").strip().replace(",", "."))
            except ValueError:
                continue
            if len((r[f] or "").strip()) < 10:
                continue
            zone = ZoneInfo("UTC" if f == "lastmod" else zones[r["worker_id"]])
            want = int(((t if t.tzinfo else t.replace(tzinfo=zone)) - EPOCH) / timedelta(microseconds=1))
            got = found.get((table, r[key], f))
            if got is None:
                assert t.tzinfo and r[f].endswith("+00:00")
            else:
                seen += 1
                assert got == want, r[f]
    assert seen
