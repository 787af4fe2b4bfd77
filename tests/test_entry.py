import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["season", "driver_id", "driver_code", "driver_name", "constructor_id",
                          "team", "points", "rank"]
    # ranks of each season are 1..n (W1 property)
    by_season = {}
    for r in rows:
        by_season.setdefault(r.season, []).append(r["rank"])
    for ranks in by_season.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_contract_shapes():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
