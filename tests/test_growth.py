"""What large tables cost: no stage that HotSpot leaves interpreted, no feed, sale or
file worked through more often than needed."""

import pytest

from vitrina.operators import facts as FX
from vitrina.plans import catalog, streams
from vitrina.streaming import ingest
from vitrina.streaming.change_table import ChangeTable
from vitrina.streaming.mapped import MappedIngest

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("start", [lambda s: catalog.Medallion(s, SF), lambda s: streams.Landing(s, "limits")])
def test_no_stage_is_left_interpreted(spark, start):
    spark.conf.unset(LIMIT)
    start(spark)
    assert spark.conf.get(LIMIT) == "8000"


def test_bucketed_sales_are_cleaned_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(FX.BucketedSales, "store_sales", lambda self, ventas: plans.append(_plan(ventas)))
    monkeypatch.setattr(FX.BucketedSales, "store_customers", lambda self, dim: None)
    monkeypatch.setattr(FX.BucketedSales, "fact", lambda self, dims, as_of: None)
    catalog.q_fact_ventas_bucketed(spark, SF)
    assert len(plans) == 1 and "Join" not in plans[0] and "Window" not in plans[0]


def test_feed_of_three_families_is_built_once(spark, monkeypatch):
    joined = []
    stage = streams.stage_feed
    monkeypatch.setattr(streams, "stage_feed", lambda s, df, cols, folder: (joined.append("Join" in _plan(df)), stage(s, df, cols, folder)))
    assert streams.q_ingest_header_order(spark, SF).count() == streams.raw_feed(spark, SF, "ventas").count()
    assert joined == [False] * 3


def test_first_batch_is_compared_with_nothing(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], "s")
    table.append(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "k long, s long, v string"), "f", 0)
    first = table.counts("f", 0)
    assert first.first().asDict() == {"rows_inserted": 2, "rows_updated": 0, "rows_deleted": 0} and "Join" not in _plan(first)
    table.append(spark.createDataFrame([(1, 3, "c"), (3, 1, "d")], "k long, s long, v string"), "f", 1)
    assert table.counts("f", 1).first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "rows_deleted": 0}


@pytest.mark.parametrize("broken", [False, True])
def test_whole_files_are_read_once(spark, tmp_path, monkeypatch, broken):
    published, publish = {}, MappedIngest._publish

    def spy(self, df, folder, part, *observed):
        published[folder.rpartition("/")[2]] = "Relation" in _plan(df)
        return publish(self, df, folder, part, *observed)

    monkeypatch.setattr(MappedIngest, "_publish", spy)
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "devoluciones_1.csv").write_text("id_devolucion,id_venta,motivo,fecha_devolucion\n1,2,roto,2020-01-01\n" + ("3,4\n" if broken else ""))
    loaded = MappedIngest(spark, str(landing), str(tmp_path / "m"), str(tmp_path / "b"), str(tmp_path / "c")).run()
    assert [(x.rows, x.rejected) for x in loaded] == [(1, int(broken))]
    assert published == {"devoluciones_raw": True, "devoluciones_rejected": broken}
    assert spark.read.parquet(str(tmp_path / "b/devoluciones_rejected")).count() == int(broken)


def test_bronze_files_can_be_split(spark, tmp_path, monkeypatch):
    pq = pytest.importorskip("pyarrow.parquet")
    monkeypatch.setattr(ingest, "ROW_GROUP_BYTES", 1 << 10)
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "devoluciones_1.csv").write_text("id_devolucion,id_venta,motivo,fecha_devolucion\n" + "".join(f"{i},{i * 7},roto {i},2020-01-01\n" for i in range(5000)))
    ingest.ingest_to_bronze(spark, str(landing), "devoluciones", str(tmp_path / "b"), str(tmp_path / "c"))
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "b").glob("part*")]
    assert sum(m.num_rows for m in files) == 5000 and max(m.num_row_groups for m in files) > 1
    assert spark.conf.get(ingest.ROW_GROUP, None) is None
