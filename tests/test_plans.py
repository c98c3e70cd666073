"""How often the plans of the replay read their feed."""

import pytest

from wakeline.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def scans_of_events(query) -> int:
    """Scalar subqueries apart. ``props`` is a column of ``events`` alone."""
    leaves = query._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n")
    return leaves.count("props")


# Numbering the offsets of rejected rows takes three more, two of which share an exchange.
@pytest.mark.parametrize(
    ("name", "most"),
    [("first_copy", 0), ("reason_report", 0), ("detail_rows", 1), ("minute_agg", 1), ("rejected_rows", 4)],
)
def test_the_feed_is_judged_once(spark, name, most):
    assert scans_of_events(QUERIES[name](spark, SF_DIR)) == most
