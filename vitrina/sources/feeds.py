"""Raw feed definitions and file sources.

Columns are found by the header of their files, family by family: the order
of columns may differ between families, further columns are kept in a map, and
a file whose header differs from its family's is an error. Four feeds have no
declared types in the reference (they were inferred); declared columns are read
as STRING, so a spelled-out quantity or a date in an odd format reaches the
cleaning step intact. Types can be inferred for a batch read (``infer``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed values that must equal the reference's: feed columns and file
# name patterns.
FEED_SCHEMAS = {
    "clientes": "id_cliente INT, nombre STRING, email STRING, ciudad STRING, fecha_registro STRING",
    "tiendas": "id_tienda STRING, nombre STRING, ciudad STRING, region STRING",
    "productos": "id_producto STRING, nombre STRING, categoria STRING, precio STRING",
    "ventas": ("id_venta STRING, id_cliente STRING, id_tienda STRING, id_producto STRING, "
               "cantidad STRING, monto STRING, fecha_venta STRING, updated_at STRING"),
    "devoluciones": "id_devolucion STRING, id_venta STRING, motivo STRING, fecha_devolucion STRING",
}

FEED_FAMILIES = {
    "clientes": ("clientes",),
    "tiendas": ("tiendas",),
    "productos": ("productos",),
    "ventas": ("ventas", "fact_sales", "sales"),
    "devoluciones": ("devoluciones",),
}
# Brace glob over all families of a feed.
FEED_GLOBS = {feed: (f"{{{','.join(f)}}}" if len(f) > 1 else f[0]) + "*.csv" for feed, f in FEED_FAMILIES.items()}

CSV_OPTIONS = {"header": "true", "sep": ","}


def add_audit_columns(df: DataFrame, load_ts=None) -> DataFrame:
    """``_src_file`` from the hidden file metadata, ``_created_at`` load
    time; ``_src_bytes``, the file's size, for the ingestion log.

    Must be applied directly on a file source, before any operator that
    loses the ``_metadata`` column.
    """
    ts = F.current_timestamp() if load_ts is None else load_ts
    return df.withColumns({"_src_file": F.col("_metadata.file_path"), "_src_bytes": F.col("_metadata.file_size"), "_created_at": ts})


def feed_path(landing_dir: str, feed: str, family: str | None = None) -> str:
    """Glob of a feed's files, or of one of its file families."""
    return f"{landing_dir.rstrip('/')}/{FEED_GLOBS[feed] if family is None else family + '*.csv'}"


def header_schema(spark: SparkSession, path: str, declared: StructType, options: dict, infer: bool = False) -> StructType | None:
    """The columns of the files at ``path`` in the order of their header line.
    Declared columns have their declared type; others are STRING, or with
    ``infer`` of the type their values have. None without files."""
    try:
        found = spark.read.options(**options).option("inferSchema", str(infer).lower()).csv(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    types = {f.name: f.dataType for f in declared}
    return StructType([StructField(f.name, types.get(f.name, f.dataType if infer else StringType())) for f in found])


def by_name(df: DataFrame, declared: StructType) -> DataFrame:
    """Declared columns found by name (NULL where a family lacks one); the
    values of all other columns go to the map ``_extra``."""
    names = [f.name for f in declared]
    audit = ["_src_file", "_src_bytes", "_created_at"]
    extra = [c for c in df.columns if c not in names and c not in audit]
    pairs = [x for c in extra for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    kept = F.create_map(*pairs) if extra else F.lit(None).cast("map<string,string>")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared],
                     kept.alias("_extra"), *[c for c in audit if c in df.columns])


def _read(spark: SparkSession, reader, landing_dir: str, feed: str, audit: bool, load_ts, options: dict, infer: bool, stream: bool) -> DataFrame:
    declared, out = StructType.fromDDL(FEED_SCHEMAS[feed]), None
    for family in FEED_FAMILIES[feed]:
        path = feed_path(landing_dir, feed, family)
        schema = header_schema(spark, path, declared, options, infer)
        if schema is None and not stream:
            continue
        # a file whose header is not its family's is an error, never a swap of columns
        df = reader.schema(schema or declared).options(**options).option("enforceSchema", "false").csv(path)
        df = by_name(add_audit_columns(df, load_ts) if audit else df, declared)
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise FileNotFoundError(f"no file at {feed_path(landing_dir, feed)}")
    return out


def read_feed(spark: SparkSession, landing_dir: str, feed: str, audit: bool = True,
              load_ts=None, options: dict | None = None, infer: bool = False) -> DataFrame:
    """S1/S2/S3/S15 batch form: the feed's CSV files under ``landing_dir``,
    columns by header name per file family."""
    return _read(spark, spark.read, landing_dir, feed, audit, load_ts, {**CSV_OPTIONS, **(options or {})}, infer, False)


def read_feed_stream(spark: SparkSession, landing_dir: str, feed: str, audit: bool = True,
                     options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1/S2/S3/S15 incremental form: every new file is read exactly once
    (progress kept in the query checkpoint)."""
    opts = {**CSV_OPTIONS, **(options or {})}
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _read(spark, reader, landing_dir, feed, audit, None, opts, False, True)
