"""Durations in days count fractions of seconds."""

import datetime as dt

from compare import connect, difference
from skillweave.plans import registry


def test_days_lack_a_fraction_of_a_second(spark, tmp_path):
    """A day less a microsecond is no day, even where the second has changed."""
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 600_000)
    gaps = [86_400_000_000 * days + micros for days in (1, 2, 20) for micros in (-900_000, -1, 0, 1, 500_000)]
    rows = [(2 * k + last, start + dt.timedelta(microseconds=last * gap), k, "view", 1.0, "{}") for k, gap in enumerate(gaps) for last in (0, 1)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    df = registry.queries()["n5_duration_days"](spark, str(tmp_path))
    assert {r.exp_id: r.days for r in df.collect()} == {2 * k + last: None if last else gap // 86_400_000_000 for k, gap in enumerate(gaps) for last in (0, 1)}
    assert difference(df, connect(str(tmp_path)), registry.oracle_sql()["n5_duration_days"]) is None
