"""tillsight: retail star-schema analytics as Spark DataFrame operators.

Every operator is a function ``f(frames..., **params) -> DataFrame`` built from
built-in Spark SQL functions, so Catalyst plans it and the cluster runs it.

    from tillsight import Star, run_on
    run_on(Star(spark, "/data/sf1"), "q04_customer_ltv").show()
"""

__version__ = "0.1.0"

__all__ = ["Star", "WarehouseStar", "run_on", "queries"]


def __getattr__(name):
    # imported lazily so `import tillsight` does not start anything
    if name == "Star":
        from tillsight.sources.model import Star
        return Star
    if name == "WarehouseStar":
        from tillsight.sources.warehouse import WarehouseStar
        return WarehouseStar
    if name == "run_on":
        from tillsight.plans.catalog import run_on
        return run_on
    if name == "queries":
        from tillsight.plans.catalog import STAR_QUERIES
        return sorted(STAR_QUERIES)
    raise AttributeError(name)
