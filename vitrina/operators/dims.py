"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.temporal import as_of_timestamp, calendar_columns
from vitrina.operators.scd import key_not_null, scd1_latest

# Fixed values that must equal the reference's: dimension columns, keys
# and sequence columns.
DIM_SPECS = {
    "cliente": (("id_cliente", "nombre", "email", "ciudad", "fecha_registro"),
                ("id_cliente",), "fecha_registro"),
    "tienda": (("id_tienda", "nombre", "ciudad", "region", "_created_at"),
               ("id_tienda",), "_created_at"),
    "producto": (("id_producto", "nombre", "categoria", "precio", "_created_at"),
                 ("id_producto",), "_created_at"),
}


AUDIT_COLUMNS = ("_created_at", "_last_updated_at")

# Fixed values that must equal the reference's: declared dimension tables.
GOLD_DDL = {
    "cliente": ("id_cliente BIGINT NOT NULL, nombre STRING, email STRING, ciudad STRING, fecha_registro DATE, "
                "creation_date TIMESTAMP, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "tienda": ("id_tienda BIGINT NOT NULL, nombre STRING, ciudad STRING, region STRING, "
               "creation_date TIMESTAMP, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "producto": ("id_producto BIGINT NOT NULL, nombre STRING, categoria STRING, precio DECIMAL(18,2), "
                 "creation_date TIMESTAMP, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "tiempo": ("fecha DATE NOT NULL, anio INT, mes INT, dia INT, anio_mes STRING, nombre_mes STRING, dia_semana INT, "
               "nombre_dia STRING, trimestre INT, creation_date TIMESTAMP, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
}


def enrich(df: DataFrame, columns: Sequence[str], as_of=None) -> DataFrame:
    """Project the silver columns, with the audit columns the silver
    table has, and stamp ``creation_date``."""
    audit = [c for c in AUDIT_COLUMNS if c in df.columns and c not in columns]
    return df.select(*columns, *audit, as_of_timestamp(as_of).alias("creation_date"))


def _dim(kind: str, silver: DataFrame, as_of=None, source_is_current: bool = True) -> DataFrame:
    cols, keys, seq = DIM_SPECS[kind]
    out = enrich(silver, cols, as_of)
    # A silver SCD-1 snapshot already holds one row per key, and an SCD-1
    # flow over a key-unique source is the identity: skip the shuffle.
    return out if source_is_current else scd1_latest(out, keys, seq)


def dim_cliente(silver_clientes: DataFrame, as_of=None, source_is_current: bool = True) -> DataFrame:
    return _dim("cliente", silver_clientes, as_of, source_is_current)


def dim_tienda(silver_tiendas: DataFrame, as_of=None, source_is_current: bool = True) -> DataFrame:
    return _dim("tienda", silver_tiendas, as_of, source_is_current)


def dim_producto(silver_productos: DataFrame, as_of=None, source_is_current: bool = True) -> DataFrame:
    return _dim("producto", silver_productos, as_of, source_is_current)


def dim_flow(kind: str, loads: Sequence[DataFrame], as_of=None) -> DataFrame:
    """The dimension after several loads of its silver table, each
    upserted by key: rows of earlier loads stay unless a later one replaces
    them. For ``tiempo`` a load is the sales, the key the date."""
    if kind == "tiempo":
        rows = [dim_tiempo(x, as_of) for x in loads]
        keys, seq = ("fecha",), "creation_date"
    else:
        cols, keys, seq = DIM_SPECS[kind]
        rows = [enrich(x, cols, as_of) for x in loads]
    out = rows[0]
    for x in rows[1:]:
        out = out.unionByName(x)
    return scd1_latest(out, keys, seq)


def dim_tiempo(silver_ventas: DataFrame, as_of=None) -> DataFrame:
    """U4 + D8-D10: one row per sale date, calendar parts derived after the
    dedupe. The distinct is a partial hash aggregate, so each task ships at
    most one row per date to the shuffle."""
    fechas = (silver_ventas.select(F.to_date("fecha_venta").alias("fecha"))
              .where("fecha IS NOT NULL")
              .distinct())
    return fechas.select("fecha", *[c.alias(n) for n, c in calendar_columns("fecha").items()],
                         as_of_timestamp(as_of).alias("creation_date"))


def dim_tiempo_loads(clean: DataFrame, keys: Sequence[str], sequence_by: str, load: Column, as_of=None) -> DataFrame:
    """``dim_flow("tiempo", ...)`` of two loads from one pass over the cleaned sales: the
    dates of the current sales after the first load (rows where ``load`` holds) and after both.
    One aggregate per sale key, partial on every task, finds the newest row of each; its order
    is that of ``scd1_latest``."""
    # columns after the date decide only between rows of the same date
    rest = [c for c in clean.columns if c not in {*keys, sequence_by}]
    newest = F.struct(sequence_by, *rest[:rest.index("fecha_venta") + 1])
    both = clean.where(key_not_null(keys)).groupBy(*keys).agg(
        F.max(newest).alias("now"), F.max(F.when(load, newest)).alias("first"))
    dates = both.select(F.explode(F.array("now.fecha_venta", "first.fecha_venta")).alias("fecha_venta"))
    return dim_tiempo(dates, as_of)


def distinct_keys(dim: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a dimension."""
    return dim.select(key).distinct()
