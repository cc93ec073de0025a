"""Results do not depend on shuffle partition count or input order (SURVEY §5 (6))."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillsight.operators import customers, retention, segments

AS_OF = dt.date(2024, 6, 30)


def _scrambled(df, parts):
    return df.withColumn("_r", F.rand(parts)).repartition(parts).sortWithinPartitions("_r").drop("_r")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_independent_of_partitioning(spark, sample, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        base = {
            "rfm": segments.rfm_segments(sample.customers, sample.orders, as_of=AS_OF),
            "pareto": segments.pareto_quintiles(sample.orders),
            "second": customers.days_to_second_order(sample.orders),
            "cohort": retention.cohort_matrix(sample.orders),
        }
        expect = {k: sorted(map(tuple, v.collect())) for k, v in base.items()}
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        o, c = _scrambled(sample.orders, parts), _scrambled(sample.customers, parts)
        got = {
            "rfm": segments.rfm_segments(c, o, as_of=AS_OF),
            "pareto": segments.pareto_quintiles(o),
            "second": customers.days_to_second_order(o),
            "cohort": retention.cohort_matrix(o),
        }
        for k, v in got.items():
            assert sorted(map(tuple, v.collect())) == expect[k], k
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
