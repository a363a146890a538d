"""Inputs derived from the driver's tables."""

from allelon.plans import derived as X

SF = "/root/testdata/sf0.001"


def test_affinities_are_the_first_two_values_and_never_an_array(spark):
    want = {}
    for r in sorted(X.table(spark, SF, "events").select("user_id", "ts", "event_id", "value").collect()):
        want.setdefault(r["user_id"], []).append(r["value"] / 100)
    own = X.affinities(spark, SF)
    assert {r["user_id"]: (r["wt_affinity"], r["mut_affinity"]) for r in own.collect()} == {k: (*v, None, None)[:2] for k, v in want.items()}
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "WindowGroupLimit" in plan
