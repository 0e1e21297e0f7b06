"""quarry: order analytics and environmental risk screening on Spark.

Every query is a function ``(spark, sf_dir) -> DataFrame`` built from
DataFrame operations; see ``quarry.plans.registry`` for the full list.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "sinks"]
