"""What the package sets in a session it is given."""

from quarry.plans.registry import registry
from quarry.session import SHARE


def test_tasks_read_bounded_shares_unless_the_submitter_says_otherwise(spark, small_sf):
    key, size = SHARE
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        registry()["product_performance"](spark, small_sf)
        assert spark.conf.get(key) == size
        spark.conf.set(key, "48m")
        registry()["product_performance"](spark, small_sf)
        assert spark.conf.get(key) == "48m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
