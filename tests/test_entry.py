"""The driver contract: entry point, registry, oracle keys."""

import __spark_entry__ as entry


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "duration_min" in df.columns and "Temperature(C)" in df.columns


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


def test_query_names_avoid_reserved_words():
    """The library's own queries leave the corpus operators' names free."""
    for name in entry.registry.QUERIES:
        assert "pipeline" not in name and not name.startswith("op")
