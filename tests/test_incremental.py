"""Incremental layers: compaction, consumption, months, mapping-driven ingest, schema
history, log and events, bucketed checks, guarded writes."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from vitrina.operators import dims as D
from vitrina.operators import facts as FX
from vitrina.operators import quality as Q
from vitrina.operators.scd import scd1_latest
from vitrina.plans import jobs
from vitrina.plans.catalog import QUERIES, Medallion
from vitrina.plans.streams import Landing, _mapped
from vitrina.plans.testfeeds import AS_OF
from vitrina.sources.schema_history import SchemaHistory, evolve, read_inferred, typed
from vitrina.streaming.change_table import ChangeTable
from vitrina.streaming.consumption import Consumption
from vitrina.streaming.mapped import MappedIngest, stored_mapping
from vitrina.streaming.progress import progress_listener

SF = "/root/testdata/sf0.001"
T = dt.datetime
SCHEMA = "k long, v string, ts timestamp"


def _set(df, cols=None):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def _scanned(df):
    """Rows that the Parquet scan of a plan without a shuffle handed out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


# --- C1-C5: compaction ---------------------------------------------------------------

def test_fifty_batches_stay_few_partitions(spark, tmp_path):
    table, rnd, rows = ChangeTable(spark, f"file://{tmp_path}/t", ["k"], "ts"), random.Random(4), []
    for batch in range(50):
        new = [(rnd.randrange(40), f"{batch}-{i}", T(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(500))) for i in range(4)]
        rows += new
        table.append(spark.createDataFrame(new, SCHEMA).coalesce(1), "flow", batch)
        table.compact_tiers(fanout=5)
        assert len(table.partitions()) < 5
    assert _set(table.read()) == _set(scd1_latest(spark.createDataFrame(rows, SCHEMA), ["k"], "ts"))
    assert not glob.glob(f"{tmp_path}/t/_compacting/*")


def test_lookup_skips_files(spark, tmp_path):
    table = ChangeTable(spark, f"file://{tmp_path}/t", ["k"], "ts")
    even = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(T(2024, 1, 1)).alias("ts"))
    table.append(even.where("k < 20000"), "f", 0)
    table.append(even.where("k >= 20000"), "f", 1)
    size = sum(table.partitions().values())
    table.merge(sorted(table.partitions()), size, file_bytes=size // 8)
    assert len(glob.glob(f"{tmp_path}/t/flow=compacted-*/batch_id=0/*.parquet")) >= 8
    rows, one = table.changes(), spark.createDataFrame([(12_344,)], "k long")
    assert 0 < _scanned(table.near(rows, one)) < 6_000  # by the range of the files
    absent = spark.createDataFrame([(12_345,), (30_001,)], "k long")
    assert _scanned(table.near(rows, absent)) == 0  # by their Bloom filters
    assert _set(table.lookup(one)) == {(12_344, "x", T(2024, 1, 1))}
    many = spark.range(10_000, 11_000).select(F.col("id").alias("k"))
    assert _scanned(table.near(rows, many)) < 12_000 and table.lookup(many).count() == 500
    assert table.lookup(one.limit(0)).count() == 0


def test_counts_after_compaction(spark, tmp_path):
    table = ChangeTable(spark, f"file://{tmp_path}/t", ["k"], "ts")
    for batch, rows in enumerate(([(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 1))], [(2, "c", T(2024, 2, 1)), (3, "d", T(2024, 1, 1))])):
        table.append(spark.createDataFrame(rows, SCHEMA), "f", batch)
    table.compact()
    table.append(spark.createDataFrame([(3, "late", T(2023, 1, 1)), (2, "e", T(2024, 3, 1)), (9, "n", None)], SCHEMA), "f", 2)
    assert tuple(table.counts("f", 2).first()) == (1, 1, 0)


# --- C6-C9: consumption --------------------------------------------------------------

def test_consumption_knows_compacted_partitions(spark, tmp_path):
    table, seen = ChangeTable(spark, f"file://{tmp_path}/t", ["k"], "ts"), Consumption(spark, f"file://{tmp_path}/c")
    row = spark.createDataFrame([(1, "a", T(2024, 1, 1))], SCHEMA)
    for batch in (0, 1):
        table.append(row, "f", batch)
    now, unseen = seen.unseen(table)
    assert unseen == now == [("f", 0), ("f", 1)]
    seen.commit("r1", now)
    table.compact()
    assert seen.unseen(table)[1] == []  # all that it replaced was seen
    table.append(row, "f", 2)
    assert seen.unseen(table)[1] == [("f", 2)]
    table.compact()
    assert len(seen.unseen(table)[1]) == 1  # merged with something new: read again
    seen.commit("r2", seen.unseen(table)[0])
    assert seen.unseen(table)[1] == [] and seen.runs() == ["r2"]


@pytest.fixture(scope="module")
def job(spark):
    """Two landing rounds; the second run's state, and what the first had left."""
    z = Landing(spark, "incremental-test")
    out = f"{z.root}/out"
    for feed in jobs.FEEDS:
        if feed != "clientes":
            z.land(SF, feed, [0, 1, 2] if feed == "ventas" else [0, 1])
    z.land(SF, "clientes", [1])
    first = jobs.run(spark, z.landing, out, AS_OF)
    root = first["gold"]["fact_ventas"].removeprefix("file:")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/anio_mes=*/*.parquet")}
    accepted = spark.read.parquet(first["gold"]["fact_ventas"]).count()
    return z, out, first, before, accepted


def test_run_without_changes_adds_nothing(spark, job):
    z, out, first, before, accepted = job
    again = jobs.run(spark, z.landing, out, AS_OF)
    assert again["bronze"] == [] and again["gold"] == first["gold"]
    root = first["gold"]["fact_ventas"].removeprefix("file:")
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{root}/anio_mes=*/*.parquet")} == before
    log = spark.read.parquet(f"{out}/auditoria/ingestion_log").where(F.col("job_run_id") == again["run_id"])
    assert _set(log.where("layer = 'gold'"), ["table", "rows_inserted"]) == {(f"gold.dim_{n}", 0) for n in ("cliente", "tienda", "producto", "tiempo")}


def test_late_customer_moves_its_sales(spark, job, tmp_path):
    z, out, first, before, accepted = job
    facts, rejects = (spark.read.parquet(first["gold"][t]) for t in jobs.FACTS)
    # a customer that only the customer check misses, with few sales
    only = rejects.groupBy("id_venta", "id_producto_source", "id_cliente_source", "anio_mes").agg(F.collect_set("reason").alias("r")).where("r = array('cliente')")
    waiting = rejects.where("reason = 'cliente'")
    late = only.where("id_cliente_source is not null").groupBy("id_cliente_source").agg(F.collect_set("anio_mes").alias("months"), F.count("*").alias("n")).orderBy("n", "id_cliente_source").first()
    months = {r[0] for r in waiting.where(F.col("id_cliente_source") == late.id_cliente_source).select("anio_mes").collect()}
    line = f"id_cliente,nombre,email,ciudad,fecha_registro\n{late.id_cliente_source},ana,ana@correo.com,lima,2020-01-01\n"
    landing = z.landing.removeprefix("file:")
    (tmp_path / "x.csv").write_text(line)
    os.rename(tmp_path / "x.csv", f"{landing}/clientes_tarde.csv")
    result = jobs.run(spark, z.landing, out, AS_OF)
    facts, rejects = (spark.read.parquet(result["gold"][t]) for t in jobs.FACTS)
    assert facts.where(F.col("id_cliente") == late.id_cliente_source).count() == late.n and facts.count() == accepted + late.n
    assert rejects.where(f"id_cliente_source = {late.id_cliente_source} and reason = 'cliente'").count() == 0
    root = first["gold"]["fact_ventas"].removeprefix("file:")
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/anio_mes=*/*.parquet")}
    touched = {f.split("anio_mes=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
    assert touched <= months and any(f in after for f in before)
    assert result["gold"]["dim_cliente"] != first["gold"]["dim_cliente"] and result["gold"]["dim_tienda"] == first["gold"]["dim_tienda"]
    members = spark.read.parquet(result["gold"]["dim_cliente"]).count()
    assert members == spark.read.parquet(first["gold"]["dim_cliente"]).count() + 1


def test_one_run_id_and_bronze_counts(spark, job):
    _, out, first, *_ = job
    log = spark.read.parquet(f"{out}/auditoria/ingestion_log").where(F.col("job_run_id") == first["run_id"])
    assert {r.layer: r.n for r in log.groupBy("layer").agg(F.count("*").alias("n")).collect()} == {"bronze": 5, "silver": 5, "gold": 6}
    sales = log.where("`table` = 'bronze.ventas_raw'").first()
    assert sales.rows_inserted == spark.read.parquet(f"{SF}/lineitem.parquet").count() and sales.file_bytes > 0


def test_failing_silver_batch_is_logged_once(spark):
    z = Landing(spark, "failing-test")
    out = f"{z.root}/out"
    z.land(SF, "tiendas", [0])
    jobs.run_bronze(spark, z.landing, out)
    broken = jobs.E.SILVER_DDL["tiendas"]
    jobs.E.SILVER_DDL["tiendas"] = broken + ", falta BIGINT NOT NULL"
    try:
        with pytest.raises(Exception):
            jobs.run_silver(spark, out, AS_OF)
    finally:
        jobs.E.SILVER_DDL["tiendas"] = broken
    jobs.run_silver(spark, out, AS_OF)
    log = spark.read.parquet(f"{out}/auditoria/ingestion_log").where("layer = 'silver'")
    assert sorted(r.job_status for r in log.collect()) == ["FAILED", "SUCCESS"]
    events = spark.read.parquet(f"{out}/auditoria/expectation_metrics")
    assert events.where("rule = 'valid_id_tienda'").count() == 1


def test_events_equal_a_pass_over_the_rows(spark, job):
    _, out, *_ = job
    events = spark.read.parquet(f"{out}/auditoria/expectation_metrics").where("table_name = 'bronze.productos_clean'")
    got = _set(events.groupBy("rule", "action").agg(F.sum("passed_records"), F.sum("failed_records")))
    assert got == _set(QUERIES["expect_drop_productos"](spark, SF), ["rule", "action", "passed_records", "failed_records"])


def test_unfinished_months_are_done_again(spark, job):
    z, out, *_ = job
    gold = f"{out}/gold"
    jobs.files.mkdirs(spark, f"{gold}/_pending/2003-05")
    root = f"{gold}/fact_ventas/anio_mes=2003-05".removeprefix("file:")
    want = _set(spark.read.parquet(f"file://{root}")) if os.path.exists(root) else set()
    jobs.files.delete(spark, f"{gold}/fact_ventas/anio_mes=2003-05")
    jobs.run_gold(spark, out, AS_OF)
    assert (_set(spark.read.parquet(f"file://{root}")) if os.path.exists(root) else set()) == want
    assert not jobs.files.exists(spark, f"{gold}/_pending")


# --- S1, S2, S10, S12, S15: ingest ---------------------------------------------------

A = "id_devolucion,id_venta,motivo,fecha_devolucion\n"


def _ingest(spark, tmp_path, **options):
    return MappedIngest(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/mapping", f"file://{tmp_path}/bronze", f"file://{tmp_path}/ckpt", **options)


def _drop(tmp_path, name, text):
    os.makedirs(tmp_path / "in", exist_ok=True)
    (tmp_path / f"{name}.tmp").write_text(text)
    os.rename(tmp_path / f"{name}.tmp", tmp_path / "in" / name)


def test_rows_and_files_that_do_not_fit(spark, tmp_path):
    _drop(tmp_path, "devoluciones_1.csv", A + "1,10,roto,2024-01-01\n2,20\n3,30,x,2024-01-01,y\n4,40,\"open,2024-01-01\n5,50,\"a, b\",2024-01-02\n")
    _drop(tmp_path, "devoluciones_2.csv", "fecha_devolucion,id_devolucion,canal\n2024-02-02,6,web\n")
    _drop(tmp_path, "devoluciones_3.csv", "a,b\n1,2\n")
    _drop(tmp_path, "otra_cosa.csv", "a,b\n1,2\n")
    _drop(tmp_path, "devoluciones_4.csv", "id_devolucion,id_devolucion\n1,2\n")
    ingest = _ingest(spark, tmp_path)
    loaded = ingest.run()
    assert [(x.target, x.rows, x.rejected) for x in loaded] == [("bronze.devoluciones_raw", 3, 5)]
    got = spark.read.parquet(ingest.table("bronze.devoluciones_raw"))
    assert _set(got, ["id_devolucion", "id_venta", "motivo", "fecha_devolucion"]) == {
        ("1", "10", "roto", "2024-01-01"), ("5", "50", "a, b", "2024-01-02"), ("6", None, None, "2024-02-02")}
    assert got.where("id_devolucion = '6'").first()._extra == {"canal": "web"}
    bad = spark.read.parquet(ingest.rejected("bronze.devoluciones_raw"))
    assert {r.record for r in bad.where("reason = 'malformed row'").collect()} == {"2,20", "3,30,x,2024-01-01,y", '4,40,"open,2024-01-01'}
    assert {r.record for r in bad.where("reason <> 'malformed row'").collect()} == {"a,b", "id_devolucion,id_devolucion"}
    assert [r.file_name for r in spark.read.parquet(f"file://{tmp_path}/bronze/unmatched_files").collect()] == ["otra_cosa.csv"]
    assert ingest.run() == []


def test_mapping_table_is_kept_and_used(spark, tmp_path):
    path = f"file://{tmp_path}/mapping"
    stored_mapping(spark, path, [(1, r"^ret.*\.txt", "bronze.devoluciones_raw", "CSV", True, ";"), (2, r"^sin.*", "bronze.devoluciones_raw", "CSV", False, "|"),
                                 (3, r"^off", "bronze.x_raw", "CSV", True, ",", False), (4, r"^j", "bronze.j_raw", "JSON", True, ",")])
    assert stored_mapping(spark, path).count() == 4  # not seeded again
    _drop(tmp_path, "ret.txt", A.replace(",", ";") + "1;10;a,b;2024-01-01\n")
    _drop(tmp_path, "sin_1", "2|20|c|2024-01-01\n3|30|d|2024-01-01\n")
    _drop(tmp_path, "sin_2", "4|40|e|2024-01-01\n")
    _drop(tmp_path, "off.csv", "a\n1\n")
    _drop(tmp_path, "j.json", "{}\n")
    ingest = _ingest(spark, tmp_path)
    ingest.run()
    assert _set(spark.read.parquet(ingest.table("bronze.devoluciones_raw")), ["id_devolucion", "motivo"]) == {("1", "a,b"), ("2", "c"), ("3", "d"), ("4", "e")}
    assert {r.file_name for r in spark.read.parquet(f"file://{tmp_path}/bronze/unmatched_files").collect()} == {"off.csv", "j.json"}


def test_plan_does_not_grow_with_files(spark, tmp_path, monkeypatch):
    for i in range(60):
        _drop(tmp_path, f"devoluciones_{i}.csv", A + f"{i},1,x,2024-01-01\n")
    ingest, scans = _ingest(spark, tmp_path), []
    scan = ingest._scan
    monkeypatch.setattr(ingest, "_scan", lambda names, paths, *rest: scans.append(len(paths)) or scan(names, paths, *rest))
    assert ingest.run()[0].rows == 60 and scans == [60]


def test_batch_appears_once(spark, tmp_path, monkeypatch):
    _drop(tmp_path, "devoluciones_1.csv", A + "1,10,x,2024-01-01\n")
    ingest, tries = _ingest(spark, tmp_path), []
    batch = ingest._batch

    def failing(df, batch_id):
        batch(df, batch_id)
        tries.append(batch_id)
        if len(tries) == 1:
            raise RuntimeError("lost after the rename")
    monkeypatch.setattr(ingest, "_batch", failing)
    with pytest.raises(Exception):
        ingest.run()
    ingest.run()
    assert tries == [0, 0] and spark.read.parquet(ingest.table("bronze.devoluciones_raw")).count() == 1


def test_inferred_types_widen(spark, tmp_path):
    rows = [(6, r"^stock", "bronze.stock_raw", "CSV", True, ",")]
    stored_mapping(spark, f"file://{tmp_path}/mapping", rows)
    ingest = _ingest(spark, tmp_path, rescue_share=0.0)
    history = ingest.history("bronze.stock_raw")
    for i, text in enumerate(("id,n,d,e\n1,5,2024-01-01,\n2,6,2024-01-02,\n", "id,n,d\n3,5.5,2024-01-03 10:00:00\n", "id,n,d,m,e\n4,many,2024-01-04,blue,true\n")):
        _drop(tmp_path, f"stock_{i}.csv", text)
        ingest.run()
    assert [history.at(v) for v in history.versions()] == [
        {"id": "long", "n": "long", "d": "date"}, {"id": "long", "n": "double", "d": "timestamp"},
        {"id": "long", "n": "string", "d": "timestamp", "m": "string", "e": "boolean"}]
    got = read_inferred(spark, ingest.table("bronze.stock_raw"), history)
    assert _set(got, ["id", "n", "m", "e"]) == {(1, "5", None, None), (2, "6", None, None), (3, "5.5", None, None), (4, "many", "blue", True)}
    assert got.where("id = 1").first().d == T(2024, 1, 1)


def test_rescued_values(spark, tmp_path):
    history = SchemaHistory(spark, f"file://{tmp_path}/h")
    df = spark.createDataFrame([(str(i),) for i in range(99)] + [("x",)], "a string")
    version, schema = history.advance(df, ["a"], 0.01)
    assert (version, schema) == (0, {"a": "long"})
    assert [r._rescued for r in typed(df, schema, ["a"], []).where("a is null").collect()] == [{"a": "x"}]
    assert history.advance(df, ["a"], 0.01)[0] == 0  # nothing new: no new version
    assert evolve({"a": "date"}, {"a": {"n": 1, "long": 1, "double": 1, "date": 0, "timestamp": 0, "boolean": 0}}, 0)["a"] == "string"
    assert evolve({}, {"a": {"n": 0}}, 0) == {}


def test_mapping_covers_all_families(spark):
    z = Landing(spark, "families-test")
    z.land(SF, "ventas", [0, 1, 2])
    assert sum(x.rows for x in _mapped(z).run()) == spark.read.parquet(f"{SF}/lineitem.parquet").count()


# --- J1, J5: bucketed tables ---------------------------------------------------------

def _bucketed(spark, tmp_path, sales, customers, name):
    tables = FX.BucketedSales(spark, f"file://{tmp_path}/{name}", f"bucketed_{name}", buckets=8)
    tables.store_sales(sales)
    tables.store_customers(customers)
    return tables


def test_bucketed_check_has_no_exchange(spark, tmp_path):
    m = Medallion(spark, SF)
    tables = _bucketed(spark, tmp_path, m.silver_ventas, m.dim("cliente"), "plan")
    sales, customers, *_ = tables._sides()
    plan = sales.join(customers.hint("merge"), "id_cliente", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = FX.semi_join_check(FX.with_fecha(m.silver_ventas), m.dim("cliente"), "id_cliente")
    assert _set(tables.with_customer(), want.columns) == _set(want)
    gone = FX.with_fecha(m.silver_ventas).where("id_cliente is not null").join(m.dim("cliente").select("id_cliente"), "id_cliente", "left_anti")
    assert _set(tables.without_customer(), gone.columns) == _set(gone)


def test_hot_customers_are_stored_apart(spark, tmp_path):
    rows = [(i, 7 if i % 3 == 0 else (None if i % 3 == 1 else i), T(2024, 1, 1)) for i in range(3000)]
    sales = spark.createDataFrame(rows, "id_venta long, id_cliente long, fecha_venta timestamp")
    for known in ([7, 2, 5], [2, 5]):
        tables = _bucketed(spark, tmp_path, sales, spark.createDataFrame([(k,) for k in known], "id_cliente long"), f"hot{len(known)}")
        assert [r[0] for r in tables._hot().collect()] == [7]
        assert _set(tables.with_customer(), ["id_venta"]) == {(i,) for i, c, _ in rows if c in known}
        assert _set(tables.without_customer(), ["id_venta"]) == {(i,) for i, c, _ in rows if c is not None and c not in known}


# --- Q3, C9, listener ----------------------------------------------------------------

def test_guarded_write_commits_all_or_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (3, -1.0)], "id long, x double")
    rules = [Q.expect_or_fail("has_id", F.col("id").isNotNull()), Q.expect_or_drop("positive", F.col("x") > 0)]
    assert Q.guarded_write(df, rules, f"file://{tmp_path}/a") == ("has_id", 0)
    assert os.listdir(tmp_path) == []
    assert Q.guarded_write(df.where("id is not null"), rules, f"file://{tmp_path}/a") == (None, 1)
    assert _set(spark.read.parquet(f"file://{tmp_path}/a")) == {(1, 1.0)}
    with pytest.raises(Exception, match="no verdict"):
        Q.guarded_write(df.where(F.raise_error(F.lit("no verdict")).cast("boolean")), rules, f"file://{tmp_path}/b")


def test_dates_of_two_loads(spark):
    rows = [(1, 1, 5, "2024-01-01 00:00:00", "2024-01-05 00:00:00", 0), (1, 1, 6, "2024-02-01 00:00:00", "2024-01-06 00:00:00", 1),
            (2, 1, 5, None, "2024-01-05 00:00:00", 0), (2, 1, 5, "2024-03-01 00:00:00", None, 1), (3, 1, 5, "2024-04-01 00:00:00", None, 1)]
    df = spark.createDataFrame(rows, "id_venta long, id_producto long, x int, fecha_venta string, updated_at string, _lote int").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("fecha_venta", "updated_at")})
    keys, seq = ("id_venta", "id_producto"), "updated_at"
    loads = [scd1_latest(df.where("_lote = 0"), keys, seq), scd1_latest(df, keys, seq)]
    got = D.dim_tiempo_loads(df, keys, seq, F.col("_lote") == 0, AS_OF)
    assert _set(got) == _set(D.dim_flow("tiempo", loads, AS_OF)) and got.count() == 3


def test_listener_reports_rows_and_errors(spark, tmp_path):
    listener = progress_listener(spark)
    assert listener is progress_listener(spark)
    spark.range(10).write.parquet(f"file://{tmp_path}/in")

    def run(sink, name):
        src = spark.readStream.schema("id long").parquet(f"file://{tmp_path}/in").observe("seen", F.count(F.lit(1)).alias("n"))
        q = src.writeStream.foreachBatch(sink).option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception:
            pass
        return listener.take(q)

    good = run(lambda df, i: df.write.format("noop").mode("overwrite").save(), "a")
    assert [(b.batch_id, b.rows, b.observed["seen"]["n"]) for b in good.batches] == [(0, 10, 10)] and good.error is None

    def fail(df, i):
        raise ValueError("broken sink")
    assert "broken sink" in run(fail, "b").error
