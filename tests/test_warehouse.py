"""The warehouse facts are the same rows as the raw computation."""
from lapforge.plans.model import FACT_COLUMNS, LAP_COLUMNS, Model

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_results_fact_equals_raw(spark):
    wh, raw = Model(spark, SF), Model(spark, SF, warehouse=False)
    cols = FACT_COLUMNS + ["constructor_id"]
    assert _rows(wh.results().select(*cols)) == _rows(raw.results().select(*cols))
    assert _rows(wh.race_facts(season=2000, drivers=[1, 2]).select(*FACT_COLUMNS)) == \
        _rows(raw.race_facts(season=2000, drivers=[1, 2]).select(*FACT_COLUMNS))


def test_laps_fact_equals_raw(spark):
    wh, raw = Model(spark, SF), Model(spark, SF, warehouse=False)
    cols = LAP_COLUMNS + ["lap"]
    assert _rows(wh.laps(2024, with_lap=True).select(*cols)) == \
        _rows(raw.laps(2024, with_lap=True).select(*cols))


def test_seasons_dimension_equal(spark):
    wh, raw = Model(spark, SF), Model(spark, SF, warehouse=False)
    assert _rows(wh.seasons()) == _rows(raw.seasons())


def test_season_aggregate_equals_raw(spark):
    wh, raw = Model(spark, SF), Model(spark, SF, warehouse=False)
    cols = raw.season_stats().columns
    assert _rows(wh.season_stats().select(*cols)) == _rows(raw.season_stats())


def test_season_list(spark):
    wh, raw = Model(spark, SF), Model(spark, SF, warehouse=False)
    assert wh.season_list() == raw.season_list() == list(range(1995, 2002))


def test_rebuilds_when_folder_is_gone(spark):
    from lapforge.plans import warehouse
    m = Model(spark, SF)
    before = m.race_facts().count()
    key = warehouse._key(spark, SF)
    gone = warehouse.location(m) + "-gone"
    warehouse._BUILT[key] = gone  # as if the shared folder had been cleaned
    assert m.race_facts().count() == before
    assert warehouse.location(m) != gone
