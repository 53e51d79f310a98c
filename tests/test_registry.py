"""Every operator of the survey inventory has a registered query with an oracle."""

from ballotbox.plans.registry import load_all

EXPECTED = ([f"S{i}" for i in range(1, 9)] + [f"P{i}" for i in range(1, 16) if i != 11]
            + [f"T{i}" for i in range(1, 11)] + [f"U{i}" for i in range(1, 5)] + [f"Q{i}" for i in range(1, 9)]
            + [f"M{i}" for i in range(1, 13)] + [f"D{i}" for i in range(1, 6)])


def test_inventory_is_covered():
    registry = load_all()
    covered = {q.operator for q in registry.values()}
    assert sorted(set(EXPECTED) - covered) == []


def test_every_query_has_an_oracle():
    assert [name for name, q in load_all().items() if q.oracle is None] == []


def test_cycle_column_is_in_every_staging_model(spark):
    # The literal cycle of each source, carried by every staging query.
    registry = load_all()
    for name in (n for n in registry if n.startswith("stg_") and n != "stg_http_source"):
        assert "cycle" in registry[name].fn(spark, "/root/testdata/sf0.001").columns, name
