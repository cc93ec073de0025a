import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tillsight.session import SQL_DEFAULTS

    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    builder = (SparkSession.builder.master("local[4]").appName("tillsight-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", ckpt))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample(spark):
    """The reference's sample rows as DataFrames."""
    from tillsight.sources import fixtures as fx

    class Sample:
        orders = fx.fact_orders(spark)
        customers = fx.dim_customer(spark)
        products = fx.dim_product(spark)
        products_plus = fx.dim_product(spark, invented=True)
        dates = fx.dim_date(spark)
        items = fx.invented_items(spark)
        events = fx.invented_events(spark)
        no_items = spark.createDataFrame([], fx.FACT_ITEMS_SCHEMA)
    return Sample
