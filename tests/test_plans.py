"""Plan guards at cluster scale (automatic broadcast off, static plan):
no cartesian products or nested-loop joins, and no fact-sized table under a
broadcast. Broadcasts may only carry the proven-bounded dimensions."""
import re

import pytest

from conftest import SF_SMALL
from surveyfold.plans import registry

BIG = ("lineitem", "orders", "part", "supplier", "customer")


@pytest.fixture(scope="module")
def scale_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _broadcast_subtrees(plan: str) -> list[str]:
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            indent = len(line) - len(line.lstrip(" :+-"))
            sub = [line]
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan_at_scale(scale_conf, name):
    plan = registry.queries()[name](scale_conf, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for sub in _broadcast_subtrees(plan):
        scanned = re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet", sub)
        # a broadcast side may read a big table only through an aggregate
        if any(t in BIG for t in scanned):
            assert "HashAggregate" in sub or "SortAggregate" in sub, (name, sub[:400])


def test_zone_queries_cover_the_whole_tables(spark):
    """The plain names compare whole tables, the partial ones constructed mismatches."""
    from surveyfold.plans import analog
    whole = {r.cz90 for r in analog.crosswalk(spark, SF_SMALL).select("cz90").collect()}
    found = registry.queries()
    assert {r.key for r in found["j7_zone_coverage"](spark, SF_SMALL).collect()} == whole
    assert found["j9_counties_unmatched"](spark, SF_SMALL).count() == 0
    assert found["j9_counties_unmatched_partial"](spark, SF_SMALL).count() > 0
