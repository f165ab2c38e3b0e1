"""Registered queries over files and streams (S1-S5, S7, S10-S12, C1 stream).

Each query lands raw feeds (derived from the testdata tables) as CSV files
in a fresh folder under ``spark.checkpoint.dir``, runs the incremental
jobs with ``availableNow`` triggers in landing rounds, and returns the
resulting table as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators import dims as D
from vitrina.operators import entities as E
from vitrina.plans.landing import land_staged, stage_feed
from vitrina.plans.testfeeds import AS_OF, raw_feed
from vitrina.session import compiled_methods, short_lived_shuffles, work_dir
from vitrina.sources import files
from vitrina.sources.feeds import FEED_SCHEMAS
from vitrina.sources.routing import file_mapping, list_files, read_routed, route_files
from vitrina.sources.schema_history import read_inferred
from vitrina.streaming.change_table import ChangeTable, read_batches
from vitrina.streaming.flows import read_target, upsert_stream
from vitrina.streaming.ingest import ingest_to_bronze, read_bronze
from vitrina.streaming.mapped import MappedIngest, stored_mapping

VENTAS_FAMILIES = {0: "ventas", 1: "fact_sales", 2: "sales"}


def feed_columns(feed: str) -> list[str]:
    return [f.split()[0] for f in FEED_SCHEMAS[feed].split(",")]


def _families(feed: str) -> dict[int, str]:
    return VENTAS_FAMILIES if feed == "ventas" else {0: feed, 1: feed}


class Landing:
    """One scratch landing zone + bronze area for a query run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        compiled_methods(spark)
        self.root = work_dir(spark, name)
        self.landing = f"{self.root}/landing"
        self._staged: set[str] = set()

    def land(self, sf_dir: str, feed: str, lotes) -> None:
        """Land the given batches of a feed (staged once, in one job)."""
        stage = f"{self.root}/_stage/{feed}"
        if feed not in self._staged:
            with short_lived_shuffles(self.spark):
                stage_feed(self.spark, raw_feed(self.spark, sf_dir, feed), feed_columns(feed), stage)
            self._staged.add(feed)
        fams = _families(feed)
        for lote in lotes:
            land_staged(self.spark, stage, lote, self.landing, fams[lote])

    def bronze(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}_raw"

    def ingest(self, feed: str) -> dict:
        return ingest_to_bronze(self.spark, self.landing, feed, self.bronze(feed),
                                f"{self.root}/_checkpoints/bronze_{feed}")


def _lote_from_file(feed: str):
    return F.regexp_extract("_src_file", r"_(\d+)\.csv/[^/]+$", 1).cast("int").alias("_lote")


def _ingested(spark, sf_dir, feed, rounds) -> DataFrame:
    z = Landing(spark, f"ingest-{feed}")
    for lotes in rounds:
        z.land(sf_dir, feed, lotes)
        z.ingest(feed)
    return read_bronze(spark, z.bronze(feed))


def q_ingest_stream_clientes(spark, sf_dir):
    """S1 + S15: explicit-schema customer CSV, two landing rounds."""
    b = _ingested(spark, sf_dir, "clientes", [[0], [1]])
    return b.select(*feed_columns("clientes"), _lote_from_file("clientes"))


def q_ingest_stream_raw(spark, sf_dir):
    """An all-STRING feed (returns), two landing rounds."""
    b = _ingested(spark, sf_dir, "devoluciones", [[0], [1]])
    return b.select(*feed_columns("devoluciones"), _lote_from_file("devoluciones"))


def q_ingest_multi_pattern(spark, sf_dir):
    """S3: the brace glob takes three file families into one table; a
    returns file in the same folder is not picked up."""
    z = Landing(spark, "ingest-multi")
    z.land(sf_dir, "devoluciones", [0])
    z.land(sf_dir, "ventas", [0, 1])
    z.ingest("ventas")
    z.land(sf_dir, "ventas", [2])
    z.ingest("ventas")
    b = read_bronze(spark, z.bronze("ventas"))
    return b.select(*feed_columns("ventas"),
                    F.regexp_extract("_src_file", r"/([a-z_]+)_\d+\.csv/[^/]+$", 1).alias("familia"))


# Column orders of the sales families in ``ingest_header_order``.
HEADER_ORDERS = {0: lambda c: c, 1: lambda c: [*c[::-1], "canal"], 2: lambda c: [*c[3:], *c[:3]]}


def q_ingest_header_order(spark, sf_dir):
    """Three sales families with other column orders, one with a
    further column, land together; columns are found by name."""
    z = Landing(spark, "ingest-header")
    # the feed is built once for its three families
    feed, built = raw_feed(spark, sf_dir, "ventas"), f"{z.root}/_stage/header-feed"
    feed.write.partitionBy("_lote").parquet(built)
    for lote, order in HEADER_ORDERS.items():
        family, stage = VENTAS_FAMILIES[lote], f"{z.root}/_stage/header-{lote}"
        rows = spark.read.schema(feed.schema).parquet(built).where(F.col("_lote") == lote).withColumn("canal", F.concat(F.lit("c"), "id_venta"))
        stage_feed(spark, rows, order(feed_columns("ventas")), stage)
        land_staged(spark, stage, lote, z.landing, family)
    z.ingest("ventas")
    b = read_bronze(spark, z.bronze("ventas"))
    return b.select(*feed_columns("ventas"), F.col("_extra")["canal"].alias("canal"),
                    F.regexp_extract("_src_file", r"/([a-z_]+)_\d+\.csv/[^/]+$", 1).alias("familia"))


def q_audit_columns(spark, sf_dir):
    """``_src_file`` from file metadata and ``_created_at`` load time."""
    b = _ingested(spark, sf_dir, "clientes", [[0, 1]])
    return b.select("id_cliente", _lote_from_file("clientes"),
                    F.col("_src_file").endswith(".csv").alias("has_src_file"),
                    F.col("_created_at").isNotNull().alias("has_created_at"))


def _ventas_stream(spark, sf_dir):
    z = Landing(spark, "stream-ventas")
    target = f"{z.root}/silver/ventas"
    log = f"{z.root}/auditoria/ingestion_log"
    for lotes in ([0, 1], [2]):
        z.land(sf_dir, "ventas", lotes)
        z.ingest("ventas")
        upsert_stream(spark, z.bronze("ventas"), "ventas", target,
                      f"{z.root}/_checkpoints/silver_ventas", as_of=AS_OF, log_dir=log)
    return z, target, log


def q_scd1_ventas_stream(spark, sf_dir):
    """C1 as a stream: two landing rounds through bronze into a versioned
    SCD-1 target; equals the batch result."""
    _, target, _ = _ventas_stream(spark, sf_dir)
    return read_target(spark, target, "ventas")


def q_ingestion_log(spark, sf_dir):
    """One record per silver micro-batch (deterministic columns)."""
    _, _, log = _ventas_stream(spark, sf_dir)
    return spark.read.parquet(log).select(
        F.col("table"), "layer", "version", "rows_in", "rows_inserted", "rows_updated", "rows_deleted",
        (F.col("file_bytes") > 0).alias("has_file_bytes"))


def _clientes_stream(spark, sf_dir):
    z = Landing(spark, "stream-clientes")
    target = f"{z.root}/silver/clientes"
    quarantine = f"{z.root}/silver/clientes_cuarentena"
    for lotes in ([0], [1]):
        z.land(sf_dir, "clientes", lotes)
        z.ingest("clientes")
        upsert_stream(spark, z.bronze("clientes"), "clientes", target,
                      f"{z.root}/_checkpoints/silver_clientes", as_of=AS_OF,
                      quarantine_dir=quarantine)
    return target, quarantine


def q_scd1_clientes_stream(spark, sf_dir):
    """C2 + Q6 as a stream: valid customers upserted per micro-batch."""
    target, _ = _clientes_stream(spark, sf_dir)
    return read_target(spark, target, "clientes")


def q_clientes_cuarentena_stream(spark, sf_dir):
    """Q6/Q7 as a stream: rejected customers appended with reasons."""
    _, quarantine = _clientes_stream(spark, sf_dir)
    return read_batches(spark, quarantine)


def _rounds_stream(spark, sf_dir, entity, rounds) -> DataFrame:
    z = Landing(spark, f"stream-{entity}")
    target = f"{z.root}/silver/{entity}"
    for lotes in rounds:
        z.land(sf_dir, entity, lotes)
        z.ingest(entity)
        upsert_stream(spark, z.bronze(entity), entity, target, f"{z.root}/_checkpoints/silver_{entity}", as_of=AS_OF)
    return read_target(spark, target, entity)


def q_scd1_devoluciones_stream(spark, sf_dir):
    """C3 as a stream with late data: the base load lands first, then a
    round of corrections in which every other row is older than the stored
    one (it must lose) and the rest are newer (they must win)."""
    return _rounds_stream(spark, sf_dir, "devoluciones", ([1], [0]))


def q_scd1_productos_stream(spark, sf_dir):
    """C4 as a stream: the second load replaces rows of the first, by load
    time (the sequence column; it is the clock here, so it is left out)."""
    return _rounds_stream(spark, sf_dir, "productos", ([0], [1])).drop("_created_at")


def q_scd1_tiendas_stream(spark, sf_dir):
    """C5 as a stream, like C4."""
    return _rounds_stream(spark, sf_dir, "tiendas", ([0], [1])).drop("_created_at")


def q_route_files(spark, sf_dir):
    """S10 + S12: every landed file routed by the mapping table."""
    z = Landing(spark, "route")
    for feed in ("ventas", "clientes", "productos", "tiendas", "devoluciones"):
        z.land(sf_dir, feed, sorted(_families(feed)))
    routed = route_files(list_files(spark, f"{z.landing}/*.csv"), file_mapping(spark, as_of=AS_OF))
    return routed.select(
        F.regexp_extract("file_name", r"^([a-z_]+)_\d+\.csv$", 1).alias("familia"),
        F.regexp_extract("file_name", r"_(\d+)\.csv$", 1).cast("int").alias("_lote"),
        "target_table", "file_format", "has_header", "delimiter").distinct()


def q_ingest_routed(spark, sf_dir):
    """S10-S12 drive S2: the files of two feeds land in one folder, the mapping
    table says which target each belongs to and how to read it."""
    z = Landing(spark, "ingest-routed")
    for feed in ("devoluciones", "clientes"):
        z.land(sf_dir, feed, [0, 1])
    listing = list_files(spark, f"{z.landing}/*.csv")
    tables = read_routed(spark, route_files(listing, file_mapping(spark, as_of=AS_OF)), z.landing)
    return tables["bronze.devoluciones_raw"].select(*feed_columns("devoluciones"), _lote_from_file("devoluciones"))


def q_gold_job(spark, sf_dir):
    """The scheduled job from landed files to the published fact."""
    from vitrina.plans import jobs

    z = Landing(spark, "gold-job")
    for feed in jobs.FEEDS:
        z.land(sf_dir, feed, sorted(_families(feed)))
    out = jobs.run(spark, z.landing, f"{z.root}/out", AS_OF)
    return spark.read.parquet(out["gold"]["fact_ventas"])


def _mapped(z: Landing, **options) -> MappedIngest:
    return MappedIngest(z.spark, z.landing, f"{z.root}/auditoria/file_mapping", f"{z.root}/bronze", f"{z.root}/_checkpoints/bronze", **options)


def q_ingest_mapped_stream(spark, sf_dir):
    """S10 + S12 drive S1-S4: files of three feeds land in one folder in two rounds; one
    stream loads each into the table that the stored mapping names."""
    z = Landing(spark, "ingest-mapped")
    for lote in (0, 1):
        for feed in ("ventas", "clientes", "devoluciones"):
            z.land(sf_dir, feed, [lote, 2] if (feed, lote) == ("ventas", 1) else [lote])
        _mapped(z).run()
    b = read_bronze(spark, z.bronze("ventas"))
    return b.select(*feed_columns("ventas"), F.regexp_extract("_src_file", r"/([a-z_]+)_\d+\.csv/[^/]+$", 1).alias("familia"))


def q_ingest_unmatched(spark, sf_dir):
    """Files that no mapping row takes, listed beside the tables."""
    z = Landing(spark, "ingest-unmatched")
    z.land(sf_dir, "clientes", [0, 1])
    stage_feed(spark, raw_feed(spark, sf_dir, "tiendas"), feed_columns("tiendas"), f"{z.root}/_stage/proveedores")
    for lote in (0, 1):
        land_staged(spark, f"{z.root}/_stage/proveedores", lote, z.landing, "proveedores")
    _mapped(z).run()
    lost = spark.read.parquet(f"{z.root}/bronze/unmatched_files")
    return lost.select(F.regexp_extract("file_name", r"^([a-z_]+)_\d+\.csv$", 1).alias("familia"),
                       F.regexp_extract("file_name", r"_(\d+)\.csv$", 1).cast("int").alias("_lote"), (F.col("length") > 0).alias("has_bytes")).distinct()


INVENTORY = (8, r"^inventario.*\.csv", "bronze.inventario_raw", "CSV", True, ",")


def q_ingest_inferred_stream(spark, sf_dir):
    """Types inferred from the parts' stock list in three landing rounds: whole prices,
    then prices with decimals (the column widens), then a further column and a few words among
    the numbers (they are rescued)."""
    z = Landing(spark, "ingest-inferred")
    mapping = f"{z.root}/auditoria/file_mapping"
    stored_mapping(spark, mapping, [INVENTORY])
    p, key = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet"), F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    rounds = [
        {"id_articulo": key, "existencias": F.col("p_size").cast("string"), "precio": F.floor(price).cast("string")},
        {"id_articulo": key, "existencias": F.col("p_size").cast("string"), "precio": price.cast("string")},
        {"id_articulo": key, "existencias": F.when(key % 150 == 2, F.lit("agotado")).otherwise(F.col("p_size").cast("string")),
         "precio": price.cast("string"), "marca": F.col("p_brand")},
    ]
    ingest = _mapped(z, rescue_share=0.05)
    for i, columns in enumerate(rounds):
        rows = p.where(key % 3 == i).select(*[c.alias(n) for n, c in columns.items()], F.lit(i).alias("_lote"))
        stage_feed(spark, rows, list(columns), f"{z.root}/_stage/inventario-{i}")
        land_staged(spark, f"{z.root}/_stage/inventario-{i}", i, z.landing, "inventario")
        ingest.run()
    b = read_inferred(spark, ingest.table(INVENTORY[2]), ingest.history(INVENTORY[2]))
    return b.select("id_articulo", "existencias", "precio", "marca", F.col("_rescued")["existencias"].alias("rescatado"))


def _returns_line() -> Column:
    """A returns row as a CSV line; some have too few or too many fields, or an open quote."""
    cols = [F.coalesce(F.trim(F.col(c)), F.lit("")) for c in feed_columns("devoluciones")]
    kind = F.col("id_devolucion").try_cast("long") % 50
    return (F.when(kind == 0, F.concat_ws(",", *cols[:2])).when(kind == 1, F.concat_ws(",", *cols, F.lit("sobra")))
            .when(kind == 2, F.concat(cols[0], F.lit(","), cols[1], F.lit(',"'), cols[2], F.lit(","), cols[3])).otherwise(F.concat_ws(",", *cols)))


def q_ingest_bad_rows(spark, sf_dir):
    """Rows that don't parse and a file of another feed's columns go to the rejected
    table; the rest is loaded."""
    z = Landing(spark, "ingest-bad")
    header = ",".join(feed_columns("devoluciones"))
    lines = raw_feed(spark, sf_dir, "devoluciones").select(_returns_line().alias(header))
    plain = {"header": "true", "sep": "\u0001", "quote": "", "escapeQuotes": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.write.options(**plain).csv(f"{z.root}/_stage/lineas")
    files.mkdirs(spark, z.landing)
    files.rename(spark, f"{z.root}/_stage/lineas", f"{z.landing}/devoluciones_0.csv")
    other = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet").select(F.col("n_nationkey").alias("clave"), F.col("n_name").alias("nombre"))
    other.write.options(header="true").csv(f"{z.root}/_stage/otra")
    files.rename(spark, f"{z.root}/_stage/otra", f"{z.landing}/devoluciones_1.csv")
    ingest = _mapped(z)
    ingest.run()
    good = read_bronze(spark, z.bronze("devoluciones")).select(F.lit("cargada").alias("estado"), *feed_columns("devoluciones"), F.lit(None).cast("string").alias("registro"))
    bad = spark.read.parquet(ingest.rejected("bronze.devoluciones_raw"))
    nothing = [F.lit(None).cast("string").alias(c) for c in feed_columns("devoluciones")]
    rows = bad.where("reason = 'malformed row'").select(F.lit("fila").alias("estado"), *nothing, F.col("record").alias("registro"))
    whole = bad.where("reason <> 'malformed row'").select(F.lit("archivo").alias("estado"), *nothing, F.col("record").alias("registro")).distinct()
    return good.unionByName(rows).unionByName(whole)


def q_scd1_ventas_compacted(spark, sf_dir):
    """C1 on a compacted target: one micro-batch per bronze file, full tiers merged after
    each round."""
    z = Landing(spark, "compacted-ventas")
    target = f"{z.root}/silver/ventas"
    for lotes in ([0, 1], [2]):
        z.land(sf_dir, "ventas", lotes)
        z.ingest("ventas")
        upsert_stream(spark, z.bronze("ventas"), "ventas", target, f"{z.root}/_checkpoints/silver_ventas", as_of=AS_OF, max_files_per_trigger=2)
        ChangeTable(spark, target, *E.SILVER_FLOWS["ventas"]).compact_tiers(fanout=2)
    return read_target(spark, target, "ventas")


def q_dim_cliente_incremental(spark, sf_dir):
    """The customer dimension after two runs, each of which takes only the silver changes it
    has not seen; a third run without changes takes none."""
    from vitrina.plans import jobs

    z = Landing(spark, "dim-incremental")
    out = f"{z.root}/out"
    for i, lotes in enumerate(([0], [1], [])):
        if lotes:
            z.land(sf_dir, "clientes", lotes)
        jobs.run_bronze(spark, z.landing, out)
        jobs.run_silver(spark, out, AS_OF)
        jobs.advance_dimension(spark, out, "cliente", f"run-{i}", AS_OF)
    cols, _, _ = D.DIM_SPECS["cliente"]
    return jobs.dimension_flow(spark, out, "cliente").read().select(*cols, "creation_date")


def q_gold_job_second_run(spark, sf_dir):
    """The fact after a second run, which replaces only the months that changed."""
    from vitrina.plans import jobs

    z = Landing(spark, "gold-second")
    for lotes in (0, 1):
        for feed in jobs.FEEDS:
            z.land(sf_dir, feed, [1, 2] if (feed, lotes) == ("ventas", 1) else [lotes])
        out = jobs.run(spark, z.landing, f"{z.root}/out", AS_OF)
    return spark.read.parquet(out["gold"]["fact_ventas"])


def q_ingestion_log_layers(spark, sf_dir):
    """One run's records of all three layers."""
    from vitrina.plans import jobs

    z = Landing(spark, "log-layers")
    for feed in jobs.FEEDS:
        z.land(sf_dir, feed, sorted(_families(feed)))
    out = jobs.run(spark, z.landing, f"{z.root}/out", AS_OF)
    log = spark.read.parquet(f"{z.root}/out/auditoria/ingestion_log")
    return log.select("table", "layer", "job_status", "rows_in", "rows_inserted", (F.col("job_run_id") == out["run_id"]).alias("same_run"))


def q_expectation_events(spark, sf_dir):
    """Rule counts as stored from the streams' reported metrics, over two rounds."""
    from vitrina.plans import jobs

    z = Landing(spark, "events")
    out = f"{z.root}/out"
    for lotes in (0, 1):
        for feed in jobs.FEEDS:
            z.land(sf_dir, feed, [1, 2] if (feed, lotes) == ("ventas", 1) else [lotes])
        jobs.run_bronze(spark, z.landing, out)
        jobs.run_silver(spark, out, AS_OF)
    events = read_batches(spark, f"{out}/auditoria/expectation_metrics")
    return events.groupBy("table_name", "rule", "action").agg(F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))


STREAM_QUERIES = {
    "ingest_mapped_stream": q_ingest_mapped_stream,
    "ingest_unmatched": q_ingest_unmatched,
    "ingest_inferred_stream": q_ingest_inferred_stream,
    "ingest_bad_rows": q_ingest_bad_rows,
    "scd1_ventas_compacted": q_scd1_ventas_compacted,
    "dim_cliente_incremental": q_dim_cliente_incremental,
    "gold_job_second_run": q_gold_job_second_run,
    "ingestion_log_layers": q_ingestion_log_layers,
    "expectation_events": q_expectation_events,
    "ingest_stream_clientes": q_ingest_stream_clientes,
    "ingest_stream_raw": q_ingest_stream_raw,
    "ingest_multi_pattern": q_ingest_multi_pattern,
    "ingest_header_order": q_ingest_header_order,
    "audit_columns": q_audit_columns,
    "scd1_ventas_stream": q_scd1_ventas_stream,
    "ingestion_log": q_ingestion_log,
    "route_files": q_route_files,
    "ingest_routed": q_ingest_routed,
    "gold_job": q_gold_job,
    "scd1_clientes_stream": q_scd1_clientes_stream,
    "clientes_cuarentena_stream": q_clientes_cuarentena_stream,
    "scd1_devoluciones_stream": q_scd1_devoluciones_stream,
    "scd1_productos_stream": q_scd1_productos_stream,
    "scd1_tiendas_stream": q_scd1_tiendas_stream,
}
