"""CSV feeds: columns by header name, further columns kept, odd headers refused."""

import pytest

from vitrina.sources.feeds import read_feed, read_feed_stream

A = "id_venta,id_cliente,id_tienda,id_producto,cantidad,monto,fecha_venta,updated_at\n1,2,3,4,5,6.5,2024-01-01 00:00:00,2024-01-02 00:00:00\n"
B = "id_producto,id_venta,canal,id_cliente\n77,11,web,22\n"


def _land(tmp_path, **named):
    for name, text in named.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return f"file://{tmp_path}"


def test_columns_by_name_per_family(spark, tmp_path):
    rows = {r.id_venta: r for r in read_feed(spark, _land(tmp_path, ventas_1=A, sales_1=B), "ventas").collect()}
    assert (rows["11"].id_producto, rows["11"].id_cliente, rows["11"].monto) == ("77", "22", None)
    assert rows["11"]._extra == {"canal": "web"} and rows["1"]._extra is None
    assert rows["11"]._src_file.endswith("sales_1.csv") and rows["11"]._src_bytes == len(B)


def test_header_of_another_order_in_one_family_is_an_error(spark, tmp_path):
    d = _land(tmp_path, ventas_1=A, ventas_2="id_cliente,id_venta,id_tienda,id_producto,cantidad,monto,fecha_venta,updated_at\n1,2,3,4,5,6,7,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, d, "ventas").collect()


def test_inferred_types(spark, tmp_path):
    df = read_feed(spark, _land(tmp_path, ventas_1=A.replace("updated_at", "updated_at,n").replace("02 00:00:00\n", "02 00:00:00,7\n")), "ventas", infer=True)
    assert df.first()._extra == {"n": "7"}


def test_stream_by_name(spark, tmp_path):
    d = _land(tmp_path, sales_1=B)  # the other families have no file yet
    out, ckpt = f"file://{tmp_path}/out", f"file://{tmp_path}/ckpt"

    def run():
        read_feed_stream(spark, d, "ventas").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()

    run()
    _land(tmp_path, fact_sales_1=A)
    run()
    run()
    assert sorted((r.id_venta, r.id_producto) for r in spark.read.parquet(out).collect()) == [("1", "4"), ("11", "77")]


def test_feed_rows_equal_table_rows(spark):
    from vitrina.plans.testfeeds import raw_feed
    sf = "/root/testdata/sf0.001"
    n = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("lineitem", "customer", "part", "supplier", "events")}
    assert raw_feed(spark, sf, "ventas").count() == n["lineitem"]
    for feed, table, again in (("clientes", "customer", 7), ("productos", "part", 9), ("tiendas", "supplier", 3), ("devoluciones", "events", 5)):
        key = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "events": "event_id"}[table]
        updates = spark.read.parquet(f"{sf}/{table}.parquet").where(f"{key} % {again} = 0").count()
        assert raw_feed(spark, sf, feed).count() == n[table] + updates, feed


def test_dimension_plans_start_no_job(spark):
    from vitrina.plans.catalog import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        for key in ("cliente", "tienda", "producto", "tiempo"):
            QUERIES[f"dim_{key}"](spark, "/root/testdata/sf0.001")
        # reading a footer is Spark's own one-task job; no stage shuffles or writes
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("plans")]
        assert all(len(j.stageIds) == 1 for j in jobs)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fact_reads_pruned_parquet(spark):
    from vitrina.plans.catalog import QUERIES
    plan = QUERIES["fact_ventas"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
