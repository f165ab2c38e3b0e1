"""Hot keys: a third of the sales on one customer, a third with no customer.

Broadcasts are switched off and AQE's skew thresholds shrunk, so the
foreign-key joins run as sort-merge joins and AQE must split the hot
partitions. Results must not change.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrina.operators import facts as FX
from vitrina.operators.scd import scd1_latest

AS_OF = "2024-06-30 12:00:00"
N = 30000


@pytest.fixture
def skew_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _sales(spark):
    i = F.col("id")
    return spark.range(N).select(
        i.alias("id_venta"),
        F.when(i % 3 == 0, F.lit(None).cast("long")).when(i % 3 == 1, F.lit(7)).otherwise(i % 500)
         .alias("id_cliente"),
        (i % 50).alias("id_tienda"), (i % 70).alias("id_producto"),
        F.timestamp_add("DAY", (i % 30).cast("int"), F.lit(dt.datetime(2024, 1, 1))).alias("fecha_venta"))


def test_rejects_under_skew(spark, skew_conf):
    v = _sales(spark)
    dims = {
        "cliente": spark.range(0, 500, 2).select(F.col("id").alias("id_cliente")),
        "tienda": spark.range(0, 50).select(F.col("id").alias("id_tienda")),
        "producto": spark.range(0, 60).select(F.col("id").alias("id_producto")),
        "tiempo": spark.range(0, 20).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
                                            .alias("fecha")),
    }
    single = FX.rejects_single_pass(v, dims, AS_OF, unique_on=["id_venta"])
    rows = single.collect()
    union = FX.rejects_union(v, dims, AS_OF)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, union.collect()))
    by_reason = {}
    for r in rows:
        by_reason[r.reason] = by_reason.get(r.reason, 0) + 1
    # brute force: NULL customers and customers missing from the (even) dimension
    cust = [None if i % 3 == 0 else 7 if i % 3 == 1 else i % 500 for i in range(N)]
    assert by_reason["cliente"] == sum(1 for c in cust if c is None or c % 2 == 1)
    # the final adaptive plan of the executed query: hot partitions were split
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan


def test_scd_hot_key(spark, skew_conf):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    got = scd1_latest(df, ["k"], "seq")
    hot = got.filter("k = 1").collect()
    assert len(hot) == 1 and hot[0].seq == max(i for i in range(N) if i % 3 == 0 or i == 1)
    assert got.count() == len({1 if i % 3 == 0 else i for i in range(N)})
