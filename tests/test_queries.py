"""Every registered query against its SQL on the smallest tables."""

import pytest

from cliploom.operators import kernels
from cliploom.plans import CATALOGUE
from tests.compare import difference

WITH_SQL = [name for name, item in CATALOGUE.items() if item.sql]
# Queries whose operators split a large key or a long clip; repeated with tiny limits.
ORDERED = [
    "next_design_seq", "robust_stats", "robust_scale", "distribution", "image_stats", "unwrap_degrees", "smooth_binomial",
    "smooth_triangle", "smooth_soft", "activity_time", "best_window", "trajectory_measures", "planted_slip", "rotation_jump",
    "travel_cap", "clamp_steps", "contact_runs",
]


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(name, spark, folder, sql):
    item = CATALOGUE[name]
    assert difference(item.run(spark, folder), sql, item.sql) is None


@pytest.mark.parametrize("name", ORDERED)
def test_split_keys_and_clips_equal_sql(name, spark, folder, sql, monkeypatch):
    monkeypatch.setattr(kernels, "CHUNK", 9)
    monkeypatch.setattr(kernels, "GROUP_ROWS", 40)
    item = CATALOGUE[name]
    assert difference(item.run(spark, folder), sql, item.sql) is None


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["id", "subject_id", "split_rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
