"""Scale rules checked on the physical plans of every registered query."""
import pytest

from tools.plan_report import report

SF = "/root/testdata/sf0.001"

# Windows partitioned by season are allowed only over constructor-level tables
# (a season holds at most one row per nation); per-driver windows only over
# one row per season.
SEASON_WINDOW_OK = {"points_gap", "constructor_rank", "mart_constructor_trend"}
DRIVER_WINDOW_OK = {"season_aggregates"}


@pytest.fixture(scope="module")
def plans(spark):
    return report(spark, SF)


def test_no_cartesian_or_nested_loop_join(plans):
    assert {k: v["cartesian"] for k, v in plans.items() if v["cartesian"]} == {}


def test_windows_only_on_bounded_keys(plans):
    for name, p in plans.items():
        for keys in p["windows"]:
            if "season" in keys.split(", ") or keys == "season":
                assert name in SEASON_WINDOW_OK, (name, keys)
            if keys == "driver_id":
                assert name in DRIVER_WINDOW_OK, (name, keys)


def test_no_expand_over_facts(plans):
    """Distinct counts are two aggregation levels, never an Expand of fact rows."""
    assert {k: v["expand"] for k, v in plans.items() if v["expand"]} == {}
