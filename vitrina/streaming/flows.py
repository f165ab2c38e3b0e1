"""Silver change flows as Structured Streaming queries.

``upsert_stream`` reads an append-only bronze table incrementally. The streaming plan
cleans the rows and observes the entity's quality rules; every micro-batch
(``foreachBatch``) stores its cleaned rows once as a partition of the clean table, from
which all else is read: survivors go to the entity's change table, rejected customers to
the quarantine, and one record to the ingestion log. Every sink holds one partition per
flow and batch and a retried batch overwrites its own, so a failure at any point leaves
no row twice.

Rule counts are not aggregated again: the streaming listener receives what the plan
observed while the clean rows were written, and they are stored as expectation events.
A batch that fails leaves a FAILED record in the log.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators import entities as E
from vitrina.operators import quality as Q
from vitrina.operators.audit import ingestion_log_row
from vitrina.operators.scd import key_not_null
from vitrina.operators.schema import enforce_schema
from vitrina.session import short_lived_shuffles
from vitrina.sources import files
from vitrina.streaming.change_table import ChangeTable, overwrite_batch
from vitrina.streaming.ingest import read_bronze_stream
from vitrina.streaming.progress import Run, progress_listener

TRANSFORMS: dict[str, Callable] = {
    "ventas": E.transform_ventas,
    "clientes": E.transform_clientes,
    "devoluciones": E.transform_devoluciones,
    "productos": lambda df, as_of, keep=(): E.transform_productos(df, keep),
    "tiendas": lambda df, as_of, keep=(): E.transform_tiendas(df, keep),
}
SOURCE = ("_src_file", "_src_bytes")
NO_COUNTS = {"rows_inserted": 0, "rows_updated": 0, "rows_deleted": 0}

RULES: dict[str, Callable] = {
    "ventas": lambda as_of: E.ventas_rules(),
    "clientes": lambda as_of: Q.clientes_warnings(as_of),
    "devoluciones": lambda as_of: E.devoluciones_rules(),
    "productos": lambda as_of: E.productos_rules(),
    "tiendas": lambda as_of: E.tiendas_rules(),
}


def flow_id(spark: SparkSession) -> str:
    """The id of the streaming query that runs this batch: it lives in the
    query's checkpoint, so it survives restarts and is new with a new one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def file_bytes(batch: DataFrame) -> int:
    """Bytes of the files behind a micro-batch, from their metadata."""
    if "_src_bytes" not in batch.columns:
        return 0
    return int(batch.select("_src_file", "_src_bytes").distinct().agg(F.coalesce(F.sum("_src_bytes"), F.lit(0))).first()[0])


def store_events(spark: SparkSession, run: Run, rules: Sequence[Q.Expectation], table: str, flow: str, path: str) -> None:
    """The rule counts that a stream's batches reported, one partition per batch."""
    ddl = "table_name string, batch long, rule string, action string, passed_records long, failed_records long"
    for b in run.batches:
        for observed in b.observed.values():
            rows = [(table, b.batch_id, m["rule"], m["action"], m["passed_records"], m["failed_records"]) for m in Q.observed_metrics(observed, rules)]
            overwrite_batch(spark.createDataFrame(rows, ddl).coalesce(1), path, flow, b.batch_id)


def upsert_stream(spark: SparkSession, bronze_dir: str, entity: str, target_root: str,
                  checkpoint_dir: str, as_of=None, log_dir: str | None = None,
                  quarantine_dir: str | None = None, metrics_dir: str | None = None,
                  max_files_per_trigger: int | None = None, declared: str | None = None,
                  clean_dir: str | None = None, run_id: int = 0) -> list[int]:
    """Run the entity's silver flow over every new bronze file, then stop.
    With a ``declared`` schema the rows get the audit columns and are put into
    that schema before they are stored. ``clean_dir`` is the table of cleaned rows."""
    keys, seq = E.SILVER_FLOWS[entity]
    target, rules = ChangeTable(spark, target_root, keys, seq), RULES[entity](as_of)
    clean_dir = clean_dir or f"{target_root.rstrip('/')}_clean"
    done: list[int] = []

    def log(session: SparkSession, flow: str, batch_id: int, start, **values) -> None:
        if log_dir:
            rec = ingestion_log_row(session, table=f"silver.{entity}", layer="silver", start=start, end=dt.datetime.now().replace(microsecond=0),
                                    job_run_id=run_id or batch_id, **values)
            overwrite_batch(rec.withColumn("version", F.lit(batch_id).cast("long")), log_dir, flow, batch_id)

    def batch(df: DataFrame, batch_id: int) -> None:
        start = dt.datetime.now().replace(microsecond=0)
        session = df.sparkSession
        flow = flow_id(session)
        # cleaned once, in a job without a shuffle; what follows reads the stored rows
        overwrite_batch(df, clean_dir, flow, batch_id)
        stored = f"{clean_dir.rstrip('/')}/flow={flow}/batch_id={batch_id}"
        cleaned = session.read.schema(df.schema).parquet(stored) if files.exists(session, stored) else df.limit(0)
        survivors = Q.apply_expectations(cleaned.drop(*SOURCE), rules)
        t0 = time.perf_counter()
        rows = Q.clientes_validos(survivors, as_of) if entity == "clientes" else survivors
        if declared:
            now = F.current_timestamp()
            rows = rows.withColumns({"_created_at": F.col("_created_at") if "_created_at" in rows.columns else now, "_last_updated_at": now})
            rows = enforce_schema(rows.where(key_not_null(keys)), declared)
        target.append(rows, flow, batch_id)
        merge_s = time.perf_counter() - t0
        if entity == "clientes" and quarantine_dir:
            overwrite_batch(Q.clientes_cuarentena(survivors, as_of), quarantine_dir, flow, batch_id)
        if log_dir:
            log(session, flow, batch_id, start, rows_in=cleaned.count(), counts=target.counts(flow, batch_id).first().asDict(),
                file_bytes=file_bytes(cleaned), merge_seconds=merge_s)
        done.append(batch_id)

    bronze = read_bronze_stream(spark, bronze_dir, max_files_per_trigger)
    source = [c for c in SOURCE if c in bronze.columns]
    cleaning = Q.observe_rules(TRANSFORMS[entity](bronze, as_of, source), rules, f"rules_{entity}")
    listener, begun = progress_listener(spark), dt.datetime.now().replace(microsecond=0)
    with short_lived_shuffles(spark):
        q = (cleaning.writeStream
             .foreachBatch(batch)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
        try:
            q.awaitTermination()
        except Exception:
            log(spark, f"failed-{q.runId}", max(done, default=-1) + 1, begun, rows_in=0, counts=NO_COUNTS, file_bytes=0, merge_seconds=0, status="FAILED")
            raise
        finally:
            run = listener.take(q)
            if metrics_dir:
                store_events(spark, run, rules, f"bronze.{entity}_clean", str(q.id), metrics_dir)
    return done


def read_target(spark: SparkSession, target_root: str, entity: str) -> DataFrame | None:
    keys, seq = E.SILVER_FLOWS[entity]
    return ChangeTable(spark, target_root, keys, seq).read()


__all__ = ["upsert_stream", "read_target", "TRANSFORMS", "RULES"]
