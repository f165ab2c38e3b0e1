"""The scheduled job: landing folder -> bronze -> silver -> gold.

``run(spark, landing_dir, out_dir, as_of)`` is what the reference's one
pipeline task does, as ordinary Spark jobs. Every layer reads only what is new:

1. bronze: one file stream over the landing folder; the stored mapping table
   ``auditoria/file_mapping`` says which table each file belongs to
   (``streaming.mapped``);
2. silver: each bronze table is read incrementally; every micro-batch is cleaned into
   ``bronze/<entity>_clean``, checked (rule counts to ``auditoria/expectation_metrics``)
   and added to the change table ``silver/<entity>``, which is compacted when tiers of it
   are full; rejected customers are appended to ``silver/clientes_cuarentena``;
3. gold: each dimension is a keyed change table that takes the current rows of the silver
   keys that changed since its last run; the fact and the rejected sales are stored by
   month, and a run replaces the months of changed sales and of rejected sales whose
   dimension member has come since.

All records of a run in ``auditoria/ingestion_log`` share its run id; failures are
recorded too. What a gold step has consumed is noted after its result is stored. A
dimension that changed is published as a new snapshot, and a marker names the snapshots
that belong together; the newest two runs keep theirs. Every step restarts from its
checkpoint, so a failed run can simply be run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrina.operators import dims as D
from vitrina.operators import entities as E
from vitrina.operators import facts as FX
from vitrina.operators.schema import enforce_schema
from vitrina.sources import files
from vitrina.operators.audit import ingestion_log_row
from vitrina.session import TABLE_OPTIONS, compiled_methods, short_lived_shuffles
from vitrina.streaming.change_table import BATCH, FLOW, ChangeTable, overwrite_batch
from vitrina.streaming.consumption import Consumption
from vitrina.streaming.flows import NO_COUNTS, read_target, upsert_stream
from vitrina.streaming.mapped import Loaded, MappedIngest

# The silver flows; a flow whose bronze table has not come yet waits.
FEEDS = ("clientes", "tiendas", "productos", "ventas", "devoluciones")
FACTS = ("fact_ventas", "fact_ventas_rechazadas")
# Month partition of sales without a date.
NO_MONTH = "sin_fecha"
MONTH = "anio_mes"
# Published dimension snapshots that stay.
KEPT_RUNS = 2


def _paths(out_dir: str) -> dict[str, str]:
    o = out_dir.rstrip("/")
    return {
        "bronze": f"{o}/bronze",
        "silver": f"{o}/silver",
        "gold": f"{o}/gold",
        "audit": f"{o}/auditoria",
        "ckpt": f"{o}/_checkpoints",
    }


class Log:
    """The ingestion log: one record per table and step, also of failed ones. All records of a
    run carry its id."""

    def __init__(self, spark: SparkSession, out_dir: str, run_id: int | None = None):
        self.spark, self.path = spark, f"{_paths(out_dir)['audit']}/ingestion_log"
        self.run_id = run_id or int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)

    def record(self, table: str, layer: str, rows_in: int, counts: dict, file_bytes: int, start, end, status: str = "SUCCESS", step: int = 0) -> None:
        rec = ingestion_log_row(self.spark, table=table, layer=layer, rows_in=rows_in, counts={**NO_COUNTS, **counts}, file_bytes=file_bytes, start=start, end=end,
                                merge_seconds=(end - start).total_seconds(), status=status, job_run_id=self.run_id)
        overwrite_batch(rec.withColumn("version", F.lit(step).cast("long")), self.path, f"{self.run_id}-{table}", step)

    def step(self, table: str, layer: str, work: Callable[[], tuple[int, dict, int]]) -> None:
        """Run ``work``, which returns rows_in, change counts and file bytes,
        and write its record; a failure is recorded and raised again."""
        start = dt.datetime.now().replace(microsecond=0)
        rows_in, counts, size, status = 0, {}, 0, "FAILED"
        try:
            rows_in, counts, size = work()
            status = "SUCCESS"
        finally:
            self.record(table, layer, rows_in, counts, size, start, dt.datetime.now().replace(microsecond=0), status)


def run_bronze(spark: SparkSession, landing_dir: str, out_dir: str,
               max_files_per_trigger: int | None = None, log: Log | None = None) -> list[Loaded]:
    """Rows, bytes and times are those of the batches that loaded them."""
    p, log = _paths(out_dir), log or Log(spark, out_dir)
    ingest = MappedIngest(spark, landing_dir, f"{p['audit']}/file_mapping", p["bronze"], f"{p['ckpt']}/bronze",
                          **({"max_files": max_files_per_trigger} if max_files_per_trigger else {}))
    start, failed = dt.datetime.now().replace(microsecond=0), True
    try:
        ingest.run()
        failed = False
    finally:
        for x in ingest.loaded:
            log.record(x.target, "bronze", x.rows + x.rejected, {"rows_inserted": x.rows}, x.file_bytes, x.start, x.end, step=x.batch_id)
        if failed:
            log.record("bronze", "bronze", 0, {}, 0, start, dt.datetime.now().replace(microsecond=0), "FAILED")
    return ingest.loaded


def run_silver(spark: SparkSession, out_dir: str, as_of=None, max_files_per_trigger: int | None = None, log: Log | None = None) -> dict:
    """``max_files_per_trigger`` bounds a micro-batch: a backlog is then worked
    off in several batches. Full tiers of the change tables are compacted."""
    p, log = _paths(out_dir), log or Log(spark, out_dir)
    done = {}
    for entity in FEEDS:
        bronze = f"{p['bronze']}/{entity}_raw"
        if not files.exists(spark, bronze):
            continue
        done[entity] = upsert_stream(
            spark, bronze, entity, f"{p['silver']}/{entity}",
            f"{p['ckpt']}/silver_{entity}", as_of=as_of,
            log_dir=log.path,
            metrics_dir=f"{p['audit']}/expectation_metrics",
            quarantine_dir=f"{p['silver']}/clientes_cuarentena" if entity == "clientes" else None,
            max_files_per_trigger=max_files_per_trigger, declared=E.SILVER_DDL[entity],
            clean_dir=f"{p['bronze']}/{entity}_clean", run_id=log.run_id)
        _silver(spark, out_dir, entity).compact_tiers()
    return done


def _silver(spark: SparkSession, out_dir: str, entity: str) -> ChangeTable:
    return ChangeTable(spark, f"{_paths(out_dir)['silver']}/{entity}", *E.SILVER_FLOWS[entity])


def silver_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    p = _paths(out_dir)
    return {e: read_target(spark, f"{p['silver']}/{e}", e) for e in FEEDS}


# dimension -> silver table whose rows feed it
DIM_SOURCE = {"cliente": "clientes", "tienda": "tiendas", "producto": "productos", "tiempo": "ventas"}


def _dim_keys(name: str) -> tuple[tuple[str, ...], str]:
    return (("fecha",), "creation_date") if name == "tiempo" else D.DIM_SPECS[name][1:]


def _dim_rows(name: str, silver: DataFrame, as_of) -> DataFrame:
    build = {"cliente": D.dim_cliente, "tienda": D.dim_tienda, "producto": D.dim_producto, "tiempo": D.dim_tiempo}[name]
    df = build(silver, as_of)
    stamped = df if "_created_at" in df.columns else df.withColumns({c: F.col("creation_date") for c in D.AUDIT_COLUMNS})
    return enforce_schema(stamped, D.GOLD_DDL[name])


def current_rows(table: ChangeTable, parts: list) -> DataFrame:
    """The current rows of the keys that some partitions hold."""
    keys = table.read_partitions(parts).select(*table.keys)
    if set(parts) == set(table.partitions()):
        return table.read()
    return table.lookup(keys)


class RunSales:
    """The current sales that a gold run works on, stored under its work folder: the date
    dimension, the months to refresh and the fact read the same rows."""

    def __init__(self, spark: SparkSession, source: ChangeTable, work: str):
        self.spark, self.source, self.work = spark, source, work
        self._state: DataFrame | None = None
        self._rows: dict[tuple, DataFrame] = {}

    def _stored(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.options(**TABLE_OPTIONS).parquet(f"{self.work}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.work}/{name}")

    def rows(self, parts: list) -> DataFrame:
        """``current_rows`` of some partitions. If these hold most of the table, the whole state is
        stored, of which they are a part, else only their rows."""
        if tuple(parts) not in self._rows:
            sizes = self.source.partitions()
            if self._state is None and 2 * sum(sizes[p] for p in parts) > sum(sizes.values()):
                self._state = self._stored(self.source.read(), "state")
            if self._state is None:
                found = self._stored(current_rows(self.source, parts), f"changed-{len(self._rows)}")
            elif set(parts) == set(sizes):
                found = self._state
            else:
                keys = self.source.read_partitions(parts).select(*self.source.keys).distinct()
                found = self._state.join(keys, self.source.keys, "left_semi")
            self._rows[tuple(parts)] = found
        return self._rows[tuple(parts)]

    def of_months(self, months: list[str]) -> DataFrame:
        if self._state is not None:
            return self._state.where(_month().isin(months))
        return self._stored(_sales_of(self.source, months), "ventas")


def dimension_flow(spark: SparkSession, out_dir: str, name: str) -> ChangeTable:
    return ChangeTable(spark, f"{_paths(out_dir)['gold']}/_flows/dim_{name}", *_dim_keys(name))


def advance_dimension(spark: SparkSession, out_dir: str, name: str, run_id: str, as_of=None, sales: RunSales | None = None) -> int:
    """Add to a dimension's flow the current rows of the silver keys that changed since
    the last run; members that silver no longer has stay. ``sales`` are those of the run, if it
    stores them. Returns the rows added."""
    source, flow = _silver(spark, out_dir, DIM_SOURCE[name]), dimension_flow(spark, out_dir, name)
    if not source.exists():
        return 0
    taken = Consumption(spark, f"{_paths(out_dir)['gold']}/_consumed/dim_{name}")
    now, unseen = taken.unseen(source)
    added = 0
    if unseen:
        changed = sales.rows(unseen) if sales and name == "tiempo" else current_rows(source, unseen)
        flow.append(_dim_rows(name, changed, as_of), f"gold-{run_id}", 0)
        part = (f"gold-{run_id}", 0)
        added = flow.read_partitions([part]).count() if files.exists(spark, flow.folder(part)) else 0
        flow.compact_tiers()
    taken.commit(run_id, now)
    return added


def published_gold(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The folders of the newest published tables."""
    gold = _paths(out_dir)["gold"]
    runs = files.list_names(spark, f"{gold}/_published")
    if not runs:
        return {}
    snapshots = dict(x.split("@") for x in files.list_names(spark, f"{gold}/_published/{runs[-1]}"))
    return {**{t: f"{gold}/{t}/run={run}" for t, run in snapshots.items()}, **{t: f"{gold}/{t}" for t in FACTS}}


def _publish(spark: SparkSession, out_dir: str, run_id: str, changed: list[str]) -> dict[str, str]:
    """Name the dimension snapshots of this run in one rename; older snapshots go."""
    gold = _paths(out_dir)["gold"]
    runs = files.list_names(spark, f"{gold}/_published")
    names = dict(x.split("@") for x in files.list_names(spark, f"{gold}/_published/{runs[-1]}")) if runs else {}
    names |= {f"dim_{n}": run_id for n in changed}
    for table, run in names.items():
        files.mkdirs(spark, f"{gold}/_publishing/{run_id}/{table}@{run}")
    files.mkdirs(spark, f"{gold}/_published")
    files.rename(spark, f"{gold}/_publishing/{run_id}", f"{gold}/_published/{run_id}")
    for old in runs[:-(KEPT_RUNS - 1) or None]:
        files.delete(spark, f"{gold}/_published/{old}")
    used = {x for run in files.list_names(spark, f"{gold}/_published") for x in files.list_names(spark, f"{gold}/_published/{run}")}
    for table in names:
        for run in files.list_names(spark, f"{gold}/{table}"):
            if f"{table}@{run.removeprefix('run=')}" not in used:
                files.delete(spark, f"{gold}/{table}/{run}")
    return published_gold(spark, out_dir)


def _month() -> Column:
    return F.coalesce(F.col(MONTH), F.lit(NO_MONTH))


def _months_to_refresh(spark: SparkSession, out_dir: str, sales: RunSales, unseen: list, before: dict[str, str], dims: dict[str, DataFrame]) -> list[str]:
    """The months of changed sales, as they were and as they are, and of rejected sales
    whose dimension member was not there at the last run, and those that an earlier run
    did not finish. One name per month."""
    gold, source, parts = _paths(out_dir)["gold"], sales.source, []
    stored = {t: spark.read.parquet(f"{gold}/{t}") for t in FACTS if any(n.startswith(MONTH) for n in files.list_names(spark, f"{gold}/{t}"))}
    unfinished = files.list_names(spark, f"{gold}/_pending")
    if unseen:
        keys = source.read_partitions(unseen).select(*source.keys).distinct()
        parts.append(sales.rows(unseen).select(_month().alias(MONTH)))
        if "fact_ventas" in stored:
            parts.append(stored["fact_ventas"].join(keys, list(source.keys), "left_semi").select(_month().alias(MONTH)))
        if "fact_ventas_rechazadas" in stored:
            old = keys.withColumnRenamed("id_producto", "id_producto_source")
            parts.append(stored["fact_ventas_rechazadas"].join(old, ["id_venta", "id_producto_source"], "left_semi").select(_month().alias(MONTH)))
    if "fact_ventas_rechazadas" in stored:
        for name, key in FX.REJECT_CHECKS:
            if name == "tiempo" or f"dim_{name}" not in before:
                continue  # dates come with the sales themselves
            new = dims[name].select(key).join(spark.read.parquet(before[f"dim_{name}"]).select(key), key, "left_anti").withColumnRenamed(key, f"{key}_source")
            waiting = stored["fact_ventas_rechazadas"].where(F.col("reason") == name)
            parts.append(waiting.join(new, f"{key}_source", "left_semi").select(_month().alias(MONTH)))
    out = spark.createDataFrame([(m,) for m in unfinished], f"{MONTH} string")
    for p in parts:
        out = out.unionByName(p)
    return sorted(r[0] for r in out.distinct().collect())


def _sales_of(source: ChangeTable, months: list[str]) -> DataFrame:
    """Current sales of some months: only keys that have a version in one of them are compared."""
    table = source.changes().drop(FLOW, BATCH)
    keys = table.where(_month().isin(months)).select(*source.keys).distinct()
    return source.latest(table.join(keys, source.keys, "left_semi")).where(_month().isin(months))


def _replace_months(spark: SparkSession, df: DataFrame, folder: str, draft: str, months: list[str]) -> int:
    """Store the rows of ``months`` in place of what was there; other months keep their files,
    and a month without rows goes. Returns the rows stored."""
    seen = Observation()
    # few files a month; a month with very many rows is split at run time
    rows = df.withColumn(MONTH, _month()).hint("rebalance", MONTH)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**TABLE_OPTIONS).partitionBy(MONTH).parquet(draft)
    ready = set(files.list_names(spark, draft))
    files.mkdirs(spark, folder)
    for name in (f"{MONTH}={m}" for m in months):
        files.delete(spark, f"{folder}/{name}")
        if name in ready:
            files.rename(spark, f"{draft}/{name}", f"{folder}/{name}")
    return int(seen.get["rows"])


def run_gold(spark: SparkSession, out_dir: str, as_of=None, log: Log | None = None) -> dict[str, str]:
    with short_lived_shuffles(spark):
        return _run_gold(spark, out_dir, as_of, log or Log(spark, out_dir))


def _run_gold(spark: SparkSession, out_dir: str, as_of, log: Log) -> dict[str, str]:
    p = _paths(out_dir)
    run_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    before, changed, dims = published_gold(spark, out_dir), [], {}
    source, work = _silver(spark, out_dir, "ventas"), f"{p['gold']}/_work/{run_id}"
    sales = RunSales(spark, source, work)
    for name, _ in FX.REJECT_CHECKS:
        def advance(name=name):
            added = advance_dimension(spark, out_dir, name, run_id, as_of, sales)
            if added or f"dim_{name}" not in before:
                state = dimension_flow(spark, out_dir, name).read()
                empty = spark.createDataFrame([], enforce_ddl(name))
                (empty if state is None else state).write.options(**TABLE_OPTIONS).parquet(f"{p['gold']}/dim_{name}/run={run_id}")
                changed.append(name)
            return added, {"rows_inserted": added}, 0

        log.step(f"gold.dim_{name}", "gold", advance)
        # the fact checks against what is published: the planner knows its size
        dims[name] = spark.read.parquet(f"{p['gold']}/dim_{name}/run={run_id}" if name in changed else before[f"dim_{name}"])
    if source.exists():
        taken = Consumption(spark, f"{p['gold']}/_consumed/fact_ventas")
        now, unseen = taken.unseen(source)
        months = _months_to_refresh(spark, out_dir, sales, unseen, before, dims)
        if months:
            for month in months:
                files.mkdirs(spark, f"{p['gold']}/_pending/{month}")
            # the sales of these months are read by the fact and by the rejects
            ventas = sales.of_months(months)
            rows_in = ventas.count()
            rejects = FX.rejects_single_pass(ventas, dims, as_of, unique_on=source.keys).withColumn(MONTH, F.date_format("fecha_venta", "yyyy-MM"))
            for df, table in ((FX.fact_ventas(ventas, dims, as_of), "fact_ventas"), (rejects, "fact_ventas_rechazadas")):
                log.step(f"gold.{table}", "gold", lambda df=df, table=table: (
                    rows_in, {"rows_inserted": _replace_months(spark, df, f"{p['gold']}/{table}", f"{work}/{table}", months)}, 0))
            files.delete(spark, f"{p['gold']}/_pending")
        taken.commit(run_id, now)
    files.delete(spark, work)
    return _publish(spark, out_dir, run_id, changed)


def enforce_ddl(name: str) -> str:
    return D.GOLD_DDL[name].replace(" NOT NULL", "")


def run(spark: SparkSession, landing_dir: str, out_dir: str, as_of=None, max_files_per_trigger: int | None = None) -> dict:
    """One scheduled run over whatever has landed since the last one."""
    compiled_methods(spark)
    log = Log(spark, out_dir)
    bronze = run_bronze(spark, landing_dir, out_dir, max_files_per_trigger, log)
    silver = run_silver(spark, out_dir, as_of, max_files_per_trigger, log)
    gold = run_gold(spark, out_dir, as_of, log)
    return {"bronze": bronze, "silver": silver, "gold": gold, "run_id": log.run_id}
