"""SCD-1 semantics (FIXTURES section 6) in batch and as a stream."""

import datetime as dt
import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from vitrina.operators import dims as D
from vitrina.operators.scd import scd1_latest, scd1_merge
from vitrina.streaming.change_table import ChangeTable
from vitrina.streaming.flows import flow_id

T = dt.datetime
SCHEMA = "k long, v string, ts timestamp"
FILE1 = [(1, "a", T(2024, 1, 2)), (2, "b", T(2024, 1, 1))]
FILE2 = [(1, "LATE", T(2024, 1, 1)), (2, "B2", T(2024, 2, 1)), (3, "c", T(2024, 1, 1))]
WANT = {(1, "a", T(2024, 1, 2)), (2, "B2", T(2024, 2, 1)), (3, "c", T(2024, 1, 1))}


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_batch_latest(spark):
    df = spark.createDataFrame(FILE1 + FILE2, SCHEMA)
    assert _set(scd1_latest(df, ["k"], "ts")) == WANT


def test_null_sequence_and_ties(spark):
    rows = [(1, "x", None), (1, "y", T(2024, 1, 1)),      # NULL loses to any value
            (2, "only", None),                             # all-NULL key survives
            (3, "p", T(2024, 1, 1)), (3, "q", T(2024, 1, 1)),  # tie: larger other column wins
            (None, "nokey", T(2024, 1, 1))]                # NULL key rejected
    got = _set(scd1_latest(spark.createDataFrame(rows, SCHEMA), ["k"], "ts"))
    assert got == {(1, "y", T(2024, 1, 1)), (2, "only", None), (3, "q", T(2024, 1, 1))}


def test_order_and_split_invariance(spark):
    rows = FILE1 + FILE2 + [(4, "d", None), (4, "e", None), (5, "f", T(2023, 1, 1))]
    want = _set(scd1_latest(spark.createDataFrame(rows, SCHEMA), ["k"], "ts"))
    rnd = random.Random(7)
    for _ in range(3):
        rnd.shuffle(rows)
        cut = rnd.randrange(1, len(rows))
        first = scd1_latest(spark.createDataFrame(rows[:cut], SCHEMA).repartition(3), ["k"], "ts")
        merged = scd1_merge(first, spark.createDataFrame(rows[cut:], SCHEMA), ["k"], "ts")
        assert _set(merged) == want


def test_plan_limits_rows_before_shuffle(spark):
    df = spark.createDataFrame(FILE1 + FILE2, SCHEMA)
    plan = scd1_latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


class Stream:
    """CSV files landed one by one and upserted by a stream."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp, self.base = spark, tmp_path, f"file://{tmp_path}"
        self.target = ChangeTable(spark, f"{self.base}/target", ["k"], "ts")

    def land(self, rows, name):
        d = f"{self.tmp}/stage-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("header", True).csv(d)
        os.makedirs(f"{self.tmp}/in", exist_ok=True)
        os.rename(glob.glob(f"{d}/part-*.csv")[0], f"{self.tmp}/in/{name}.csv")

    def run(self, checkpoint="ckpt", sink=None):
        sink = sink or (lambda df, bid: self.target.append(df, flow_id(df.sparkSession), bid))
        src = self.spark.readStream.schema(SCHEMA).option("header", True).csv(f"{self.base}/in/*.csv")
        src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{self.base}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()

    def batches(self):
        return sorted((r.flow, r.batch_id) for r in self.target.changes().select("flow", "batch_id").distinct().collect())


def test_stream_late_row_restart_new_checkpoint_compaction(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.land(FILE1, "f1")
    s.run()
    s.land(FILE2, "f2")
    s.run()
    assert _set(s.target.read()) == WANT
    before = s.batches()
    assert [b for _, b in before] == [0, 1] and len({f for f, _ in before}) == 1 and before[0][0] != "batch"
    s.run()  # no new file: nothing changes
    assert s.batches() == before
    # a new checkpoint starts at batch 0 again and writes beside the old flow
    s.run("other")
    assert _set(s.target.read()) == WANT and set(before) < set(s.batches())
    s.target.compact()
    assert len(s.batches()) == 1 and _set(s.target.read()) == WANT
    s.land([(2, "B3", T(2024, 3, 1))], "f3")
    s.run()
    assert _set(s.target.read()) == {r for r in WANT if r[0] != 2} | {(2, "B3", T(2024, 3, 1))}


def test_retried_batch_writes_once_and_counts(spark, tmp_path):
    s, tries = Stream(spark, tmp_path), []

    def sink(df, bid):
        s.target.append(df, flow_id(df.sparkSession), bid)
        tries.append(bid)
        if len(tries) == 1:
            raise RuntimeError("lost after the write")

    s.land(FILE1, "f1")
    with pytest.raises(Exception, match="lost after the write"):
        s.run(sink=sink)
    s.run(sink=sink)
    assert tries == [0, 0] and s.target.changes().count() == 2
    s.land(FILE2, "f2")
    s.run(sink=sink)
    (flow, _), *_ = s.batches()
    assert tuple(s.target.counts(flow, 1).first()) == (1, 1, 0)  # key 3 new, key 2 changed, key 1 late


def test_a_batch_writes_only_its_rows(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.land(FILE1, "f1")
    s.run()
    files_before = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/target/flow=*/batch_id=0/*.parquet")}
    s.land(FILE2, "f2")
    s.run()
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/target/flow=*/batch_id=0/*.parquet")} == files_before
    assert s.target.changes().where("batch_id = 1").count() == len(FILE2)


def test_date_loads_order_by_nothing_after_the_date(spark):
    """columns after the date decide only between rows of the same date, so the
    aggregate holds none of them; dates are those of the upserts of both loads."""
    rows = [(1, 1, 5, "2020-01-01 10:00:00", "2020-03-01 00:00:00", "2020-01", 0), (1, 1, 6, "2020-01-02 10:00:00", "2020-03-01 00:00:00", "2020-01", 1),
            (1, 1, 6, "2020-01-02 10:00:00", "2020-03-01 00:00:00", "2020-99", 0), (2, 1, None, "2021-05-01 00:00:00", None, "2021-05", 1),
            (2, 1, None, None, "2020-01-01 00:00:00", None, 0), (3, 1, 1, "2022-01-01 00:00:00", None, "2022-01", 0), (None, 1, 1, "2023-01-01 00:00:00", None, "2023-01", 0)]
    sales = spark.createDataFrame(rows, "id_venta long, id_producto long, monto int, fecha_venta string, updated_at string, anio_mes string, _lote int").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("fecha_venta", "updated_at")})
    keys = ["id_venta", "id_producto"]
    got = D.dim_tiempo_loads(sales, keys, "updated_at", F.col("_lote") == 0, "2024-01-20 12:00:00")
    want = D.dim_flow("tiempo", [scd1_latest(x.drop("_lote"), keys, "updated_at") for x in (sales.where("_lote = 0"), sales)], "2024-01-20 12:00:00")
    assert sorted(str(r.fecha) for r in got.collect()) == sorted(str(r.fecha) for r in want.collect()) == ["2020-01-02", "2022-01-01"]
    newest = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "max(" in x]
    assert newest and not any("anio_mes" in x for x in newest)
