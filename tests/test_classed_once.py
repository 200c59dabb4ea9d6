"""Cells of boxes are made once, however often a query uses them."""

from hexloom.plans import spatial as plans


def test_shares_are_made_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(plans, "shares", lambda s, d, real=plans.shares: (made.append(1), real(s, d))[1])
    own, hexes = plans.classed(spark, "/root/testdata/sf0.001")
    assert made == [1] and own.select("q", "r").distinct().count() == hexes.count()
    for plan in (own, hexes):
        assert "MapInArrow" not in plan._jdf.queryExecution().optimizedPlan().toString()
