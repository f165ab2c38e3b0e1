"""Fact table and rejected-sales audit (FIXTURES section 7)."""

import datetime as dt

from pyspark.sql import functions as F

from vitrina.operators import facts as FX
from vitrina.operators.dims import dim_tiempo

T = dt.datetime
AS_OF = "2024-06-30 12:00:00"
SALES = "id_venta long, id_cliente long, id_tienda long, id_producto long, fecha_venta timestamp"


def _dims(spark, ventas):
    return {
        "cliente": spark.createDataFrame([(1,)], "id_cliente long"),
        "tienda": spark.createDataFrame([(1,)], "id_tienda long"),
        "producto": spark.createDataFrame([(1,)], "id_producto long"),
        "tiempo": dim_tiempo(ventas, AS_OF),
    }


def _sales(spark):
    return spark.createDataFrame([
        (1, 1, 1, 1, T(2024, 1, 5, 10)),
        (2, 9, 9, 1, T(2024, 1, 6, 10)),
        (3, None, 1, 1, None),
    ], SALES)


def test_fixture_rejects(spark):
    v = _sales(spark)
    dims = _dims(spark, v)
    rej = {(r.id_venta, r.reason) for r in FX.rejects_single_pass(v, dims, AS_OF).collect()}
    assert rej == {(2, "cliente"), (2, "tienda"), (3, "cliente"), (3, "tiempo")}
    union = {(r.id_venta, r.reason) for r in FX.rejects_union(v, dims, AS_OF).collect()}
    assert union == rej


def test_fact_and_rejects_partition_sales(spark):
    v = _sales(spark).withColumns({"cantidad": F.lit(1), "monto": F.lit(1.0), "anio_mes": F.lit("x")})
    dims = _dims(spark, v)
    fact_ids = {r.id_venta for r in FX.fact_ventas(v, dims, AS_OF).collect()}
    rej_ids = {r.id_venta for r in FX.rejects_single_pass(v, dims, AS_OF).collect()}
    assert fact_ids == {1} and rej_ids == {2, 3} and not (fact_ids & rej_ids)
    tagged = FX.tag_sales(v, dims)
    assert {r.id_venta for r in FX.fact_from_tagged(tagged, AS_OF).collect()} == fact_ids


def test_duplicate_dimension_keys_do_not_multiply(spark):
    v = _sales(spark)
    dims = _dims(spark, v)
    dims["cliente"] = spark.createDataFrame([(1,), (1,), (9,), (9,)], "id_cliente long")
    rej = FX.rejects_single_pass(v, dims, AS_OF, unique_on=["id_venta"]).collect()
    assert sorted((r.id_venta, r.reason) for r in rej) == [(2, "tienda"), (3, "cliente"), (3, "tiempo")]


def test_single_pass_scans_sales_once(spark, tmp_path):
    path = f"{tmp_path}/ventas"
    _sales(spark).write.parquet(path)
    v = spark.read.parquet(path)
    dims = _dims(spark, spark.read.parquet(path))
    dims["tiempo"] = spark.createDataFrame([(dt.date(2024, 1, 5),)], "fecha date")
    plan = FX.rejects_single_pass(v, dims, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(path.split("/")[-1]) == 1 or plan.count("FileScan parquet") == 1
    assert "LeftOuter" in plan
