"""Per-entity cleaning and their quality rules.

Each ``clean_*`` is one narrow projection (no shuffle) followed by the
entity's drop rules; ``as_of`` replaces the wall clock so a run is
reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.numeric import decode_spelled_number, positive_amount, positive_int
from vitrina.functions.temporal import (
    month_key,
    null_outside_date,
    null_outside_ts,
    parse_date_multi,
    parse_ts_multi,
    parse_ts_three,
)
from vitrina.functions.text import (
    capitalize_first,
    clean_code,
    clean_title,
    is_valid_email,
    normalize_email,
    scrub_null_tokens,
)
from vitrina.operators.quality import Expectation, apply_expectations, clientes_warnings, expect_or_drop


def _long(c: str):
    return F.col(c).try_cast("long").alias(c)


# --- rules (Q2); rule names are fixed values that must equal the reference's -------------------------------------------------------------

def ventas_rules() -> list[Expectation]:
    return [expect_or_drop("valid_id_venta", F.col("id_venta").isNotNull()),
            expect_or_drop("valid_id_producto", F.col("id_producto").isNotNull())]


def devoluciones_rules() -> list[Expectation]:
    return [expect_or_drop("valid_id_devolucion", F.col("id_devolucion").isNotNull())]


def productos_rules() -> list[Expectation]:
    return [expect_or_drop("valid_id_producto", F.col("id_producto").isNotNull()),
            expect_or_drop("valid_precio", F.col("precio") > 0)]


def tiendas_rules() -> list[Expectation]:
    return [expect_or_drop("valid_id_tienda", F.col("id_tienda").isNotNull())]


# --- transforms -------------------------------------------------------------

# Each transform is two stacked projections: the first parses, the second
# applies range rules to the parsed *column*. A range rule reads its input
# three times; Spark does not collapse the two projections when that would
# copy an expensive expression, so every parse runs once per row. ``keep`` names
# further columns to carry along, such as the source file.

def transform_ventas(raw: DataFrame, as_of=None, keep: Sequence[str] = ()) -> DataFrame:
    """E1 projection: quantity words, positive int/amount, three-format
    timestamps, sales date range [2000-01-01, as_of], month key."""
    parsed = raw.select(
        _long("id_venta"), _long("id_cliente"), _long("id_tienda"), _long("id_producto"),
        positive_int(decode_spelled_number("cantidad")).alias("cantidad"),
        positive_amount("monto").alias("monto"),
        parse_ts_three("fecha_venta").alias("fecha_venta"),
        parse_ts_three("updated_at").alias("updated_at"), *keep,
    )
    ranged = parsed.withColumn("fecha_venta", null_outside_ts("fecha_venta", as_of, upper="instant"))
    return ranged.withColumn("anio_mes", month_key("fecha_venta"))


def transform_clientes(raw: DataFrame, as_of=None, keep: Sequence[str] = ()) -> DataFrame:
    """E2 projection: title-case names, e-mail normalise/validate,
    multi-format date with range [1900-01-01, today]."""
    parsed = raw.select(
        _long("id_cliente"),
        clean_title("nombre").alias("nombre"),
        normalize_email("email").alias("email"),
        clean_title("ciudad").alias("ciudad"),
        parse_date_multi("fecha_registro").alias("fecha_registro"), *keep,
    )
    return parsed.withColumns({
        "email": F.when(is_valid_email("email"), F.col("email")),
        "fecha_registro": null_outside_date("fecha_registro", as_of),
    })


def transform_devoluciones(raw: DataFrame, as_of=None, keep: Sequence[str] = ()) -> DataFrame:
    """E3 projection: reason scrub + capitalise, multi-format timestamp with
    range [2000-01-01, today 00:00]."""
    parsed = raw.select(
        _long("id_devolucion"), _long("id_venta"),
        scrub_null_tokens("motivo").alias("motivo"),
        parse_ts_multi("fecha_devolucion").alias("fecha_devolucion"), *keep,
    )
    return parsed.withColumns({
        "motivo": capitalize_first("motivo"),
        "fecha_devolucion": null_outside_ts("fecha_devolucion", as_of, upper="date"),
    })


def transform_productos(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """E4 projection: title-case name/category, positive price."""
    return raw.select(
        _long("id_producto"),
        clean_title("nombre").alias("nombre"),
        clean_title("categoria").alias("categoria"),
        positive_amount("precio").alias("precio"),
        F.col("_created_at"), *keep,
    )


def transform_tiendas(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """E5 projection: title-case name/city, upper-case region."""
    return raw.select(
        _long("id_tienda"),
        clean_title("nombre").alias("nombre"),
        clean_title("ciudad").alias("ciudad"),
        clean_code("region").alias("region"),
        F.col("_created_at"), *keep,
    )


# --- projection + rules -----------------------------------------------------

def clean_ventas(raw: DataFrame, as_of=None, observation=None) -> DataFrame:
    return apply_expectations(transform_ventas(raw, as_of), ventas_rules(), observation)


def clean_clientes(raw: DataFrame, as_of=None, observation=None) -> DataFrame:
    return apply_expectations(transform_clientes(raw, as_of), clientes_warnings(as_of), observation)


def clean_devoluciones(raw: DataFrame, as_of=None, observation=None) -> DataFrame:
    return apply_expectations(transform_devoluciones(raw, as_of), devoluciones_rules(), observation)


def clean_productos(raw: DataFrame, observation=None) -> DataFrame:
    return apply_expectations(transform_productos(raw), productos_rules(), observation)


def clean_tiendas(raw: DataFrame, observation=None) -> DataFrame:
    return apply_expectations(transform_tiendas(raw), tiendas_rules(), observation)


# --- silver targets: keys, sequence, declared schema (C1-C5) ------------------

# Fixed values that must equal the reference's: keys and sequence columns.
SILVER_FLOWS = {
    "ventas": (("id_venta", "id_producto"), "updated_at"),
    "clientes": (("id_cliente",), "fecha_registro"),
    "devoluciones": (("id_devolucion",), "fecha_devolucion"),
    "productos": (("id_producto",), "_created_at"),
    "tiendas": (("id_tienda",), "_created_at"),
}

# Fixed values that must equal the reference's: declared silver tables.
SILVER_DDL = {
    "ventas": ("id_venta BIGINT NOT NULL, id_cliente BIGINT, id_tienda BIGINT, "
               "id_producto BIGINT NOT NULL, cantidad INT, monto DECIMAL(18,2), "
               "fecha_venta TIMESTAMP, updated_at TIMESTAMP, anio_mes STRING, "
               "_created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "clientes": ("id_cliente BIGINT NOT NULL, nombre STRING, email STRING, ciudad STRING, "
                 "fecha_registro DATE, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "devoluciones": ("id_devolucion BIGINT NOT NULL, id_venta BIGINT, motivo STRING, "
                     "fecha_devolucion TIMESTAMP, _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "productos": ("id_producto BIGINT NOT NULL, nombre STRING, categoria STRING, "
                  "precio DECIMAL(18,2), _created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
    "tiendas": ("id_tienda BIGINT NOT NULL, nombre STRING, ciudad STRING, region STRING, "
                "_created_at TIMESTAMP, _last_updated_at TIMESTAMP"),
}
