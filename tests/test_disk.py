"""What a job leaves on disk while it runs: shuffle files go with their query, tables and
landed files are compressed, rows are dealt out once."""

import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from vitrina.operators.scd import scd1_latest
from vitrina.plans import jobs
from vitrina.plans.streams import Landing
from vitrina.plans.testfeeds import AS_OF
from vitrina.session import SHUFFLE_CLEANUP, short_lived_shuffles
from vitrina.streaming.change_table import ChangeTable

SF = "/root/testdata/sf0.001"
SCHEMA = "k long, v string, w long, ts long"


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def _new_files(spark, before):
    """Shuffle files that came and stay; they are removed in the background."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def _rows(rnd, n, keys):
    """One row per key at most, with ties and NULLs in every column but the key."""
    one_of = lambda *x: rnd.choice([None, *x])
    return [(k, one_of("a", "b"), one_of(1, 2), one_of(5, 6)) for k in rnd.sample(range(keys), n)]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    with short_lived_shuffles(spark):
        with short_lived_shuffles(spark):
            spark.range(1000).repartition(5, "id").write.parquet(str(tmp_path / "a"))
        spark.range(1000).repartition(5, "id").groupBy(F.col("id") % 7).count().collect()
    assert not _new_files(spark, before) and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000


@pytest.mark.parametrize("step", ["land", "silver"])
def test_steps_leave_no_shuffle_files(spark, step):
    z = Landing(spark, "disk-test")
    out = f"{z.root}/out"
    before = _shuffle_files(spark)
    z.land(SF, "ventas", [0, 1, 2])
    if step == "silver":
        jobs.run_bronze(spark, z.landing, out)
        jobs.run_silver(spark, out, AS_OF)
    assert not _new_files(spark, before)


def test_tables_and_landed_files_are_compressed(spark):
    pq = pytest.importorskip("pyarrow.parquet")
    z = Landing(spark, "compressed-test")
    out = f"{z.root}/out"
    z.land(SF, "ventas", [0, 1, 2])
    z.ingest("ventas")
    landed = glob.glob(f"{z.landing.removeprefix('file:')}/*/part-*")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    jobs.run(spark, z.landing, out, AS_OF)
    at = z.root.removeprefix("file:")
    for table in ("bronze/ventas_raw", "out/bronze/ventas_raw", "out/bronze/ventas_clean", "out/silver/ventas", "out/gold/dim_tiempo", "out/gold/fact_ventas_rechazadas"):
        files = glob.glob(f"{at}/{table}/**/*.parquet", recursive=True)
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}, table
    assert spark.read.parquet(f"{z.root}/out/bronze/ventas_raw").count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_compaction_deals_rows_once(spark, tmp_path, monkeypatch):
    table, rnd, rows = ChangeTable(spark, str(tmp_path / "t"), ["k"], "ts"), random.Random(1), []
    for batch in range(4):
        new = _rows(rnd, 40, 60)
        rows += new
        table.append(spark.createDataFrame(new, SCHEMA), "f", batch)
    frame, plans = type(spark.range(1)), []
    sort = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *c: plans.append(self._jdf.queryExecution().executedPlan().toString()) or sort(self, *c))
    table.merge(sorted(table.partitions()), 8, file_bytes=1)
    assert len(plans) == 1 and plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0]
    assert len(glob.glob(f"{tmp_path}/t/flow=compacted-*/batch_id=0/*.parquet")) > 1
    want = scd1_latest(spark.createDataFrame(rows, SCHEMA), ["k"], "ts")
    got = table.changes().drop("flow", "batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_counts_with_ties_and_nulls(spark, tmp_path):
    table, rnd = ChangeTable(spark, str(tmp_path / "t"), ["k"], "ts", tie_breakers=["w"]), random.Random(2)
    batches = [_rows(rnd, 60, 80) for _ in range(3)]
    for i, rows in enumerate(batches):
        table.append(spark.createDataFrame(rows, SCHEMA), "f", i)

    def best(rows):
        out = {}
        for r in rows:
            k, v, w, ts = r
            rank = [(x is not None, x) for x in (ts, w, v)]
            if r[0] not in out or rank > out[k][0]:
                out[k] = (rank, r)
        return {k: r for k, (_, r) in out.items()}

    old, new = best(batches[0] + batches[1]), best(batches[0] + batches[1] + batches[2])
    mine = {r[0] for r in batches[2]}
    want = (len(mine - set(old)), sum(old[k] != new[k] for k in mine & set(old)), 0)
    assert min(want[:2]) > 0 and tuple(table.counts("f", 2).first()) == want


def test_sales_of_a_run_are_found_once(spark, monkeypatch):
    z, found = Landing(spark, "run-sales-test"), []
    out = f"{z.root}/out"
    for name in ("read", "lookup"):
        whole = getattr(ChangeTable, name)
        monkeypatch.setattr(ChangeTable, name, lambda self, *a, name=name, whole=whole: found.append((self.root.rpartition("out/")[2], name)) or whole(self, *a))
    sales_of = jobs._sales_of
    monkeypatch.setattr(jobs, "_sales_of", lambda *a: found.append(("silver/ventas", "months")) or sales_of(*a))
    want = [["read"], ["read"], ["lookup", "months"]]  # all sales are new, most of them, few
    for lotes, n in zip(([0], [1, 2], []), want, strict=True):
        z.land(SF, "ventas", lotes)
        if not lotes:
            line = "id_venta,id_cliente,id_tienda,id_producto,cantidad,monto,fecha_venta,updated_at\n1,1,1,1,2,3.5,2020-01-01 00:00:00,2024-01-01 00:00:00\n"
            with open(f"{z.landing.removeprefix('file:')}/ventas_tarde.csv", "w") as f:
                f.write(line)
        found.clear()
        result = jobs.run(spark, z.landing, out, AS_OF)
        assert [x for table, x in found if table == "silver/ventas"] == n
        facts, rejects = (spark.read.parquet(result["gold"][t]) for t in jobs.FACTS)
        rejected = rejects.select("id_venta", "id_producto_source").distinct().count()
        assert facts.count() + rejected == jobs.silver_tables(spark, out)["ventas"].count()
        assert not glob.glob(f"{out.removeprefix('file:')}/gold/_work/*")


@pytest.mark.parametrize("sizes", [(30, 5), (5, 30)])
def test_stored_sales_equal_a_lookup(spark, tmp_path, sizes):
    source, rnd = ChangeTable(spark, str(tmp_path / "t"), ["k"], "ts"), random.Random(3)
    for batch, n in enumerate(sizes):
        rows = [(*r, rnd.choice([None, "2020-01", "2020-02"])) for r in _rows(rnd, n, 40)]
        source.append(spark.createDataFrame(rows, f"{SCHEMA}, anio_mes string").coalesce(1), "f", batch)

    def plain(df):
        return sorted(str(r) for r in df.select("k", "v", "w", "ts", "anio_mes").collect())

    parts = sorted(source.partitions())
    for i, some in enumerate((parts[1:], parts)):
        sales = jobs.RunSales(spark, source, str(tmp_path / f"w{i}"))
        source.partitions = lambda: dict(zip(parts, sizes, strict=True))  # files of a few rows are of one size
        assert plain(sales.rows(some)) == plain(jobs.current_rows(source, some))
        assert (sales._state is None) == (sizes[0] > sizes[1] and some != parts)
        for months in (["2020-01"], ["2020-02", jobs.NO_MONTH]):
            assert plain(sales.of_months(months)) == plain(source.read().where(jobs._month().isin(months)))
            sales = sales if sales._state is not None else jobs.RunSales(spark, source, str(tmp_path / f"w{i}-{len(months)}"))
