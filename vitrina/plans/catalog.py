"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the testdata tables under ``sf_dir`` (through the
raw feeds of ``vitrina.plans.testfeeds``) and runs over whole tables.
Load-time columns use the fixed ``AS_OF`` instant so results are
reproducible and comparable with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.numeric import decode_spelled_number, positive_amount, positive_int
from vitrina.functions.temporal import null_outside_date, null_outside_ts, parse_date_multi, parse_ts_multi, parse_ts_three
from vitrina.functions.text import EMAIL_PATTERN, clean_email, clean_motivo
from vitrina.operators import dims as D
from vitrina.operators import entities as E
from vitrina.operators import facts as FX
from vitrina.operators import quality as Q
from vitrina.operators.schema import align_to_target, enforce_schema
from vitrina.operators.scd import scd1_latest
from vitrina.plans import testfeeds as TF
from vitrina.session import compiled_methods, work_dir
from vitrina.sources import files

AS_OF = TF.AS_OF


class Medallion:
    """Lazily built bronze -> silver -> gold plans over one testdata folder.

    Every property is a DataFrame plan and runs no job, but for
    ``silver_ventas_shared``, which writes the silver sales.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        compiled_methods(spark)

    # raw feeds
    def raw(self, feed: str) -> DataFrame:
        return TF.RAW_FEEDS[feed](self.spark, self.sf_dir)

    # bronze clean (projection + rules)
    @cached_property
    def ventas_t(self) -> DataFrame:
        return E.transform_ventas(self.raw("ventas"), self.as_of)

    @cached_property
    def ventas_clean(self) -> DataFrame:
        return E.clean_ventas(self.raw("ventas"), self.as_of)

    @cached_property
    def clientes_clean(self) -> DataFrame:
        return E.clean_clientes(self.raw("clientes"), self.as_of)

    @cached_property
    def devoluciones_clean(self) -> DataFrame:
        return E.clean_devoluciones(self.raw("devoluciones"), self.as_of)

    @cached_property
    def productos_clean(self) -> DataFrame:
        return E.clean_productos(self.raw("productos"))

    @cached_property
    def tiendas_clean(self) -> DataFrame:
        return E.clean_tiendas(self.raw("tiendas"))

    # silver (SCD-1 current state)
    def _scd(self, entity: str, df: DataFrame) -> DataFrame:
        keys, seq = E.SILVER_FLOWS[entity]
        return scd1_latest(df, keys, seq)

    @cached_property
    def silver_ventas(self) -> DataFrame:
        return self._scd("ventas", self.ventas_clean)

    @cached_property
    def silver_ventas_shared(self) -> DataFrame:
        """The silver sales, written once as Parquet in the shared folder and
        read back: the fact and reject plans read them several times, each time
        only the columns they need, and the planner knows their size."""
        path = f"{work_dir(self.spark, 'silver-ventas')}/ventas"
        self.silver_ventas.write.parquet(path)
        return self.spark.read.schema(self.silver_ventas.schema).parquet(path)

    @cached_property
    def silver_clientes(self) -> DataFrame:
        return self._scd("clientes", Q.clientes_validos(self.clientes_clean, self.as_of))

    @cached_property
    def silver_devoluciones(self) -> DataFrame:
        return self._scd("devoluciones", self.devoluciones_clean)

    @cached_property
    def silver_productos(self) -> DataFrame:
        return self._scd("productos", self.productos_clean)

    @cached_property
    def silver_tiendas(self) -> DataFrame:
        return self._scd("tiendas", self.tiendas_clean)

    def first_load(self, entity: str) -> DataFrame:
        """The silver table after the first landing batch alone."""
        raw = self.raw(entity).where("_lote = 0")
        clean = {"ventas": lambda: E.clean_ventas(raw, self.as_of),
                 "clientes": lambda: Q.clientes_validos(E.clean_clientes(raw, self.as_of), self.as_of),
                 "productos": lambda: E.clean_productos(raw), "tiendas": lambda: E.clean_tiendas(raw)}
        return self._scd(entity, clean[entity]())

    # gold
    def dim(self, name: str) -> DataFrame:
        """One dimension from the current silver table."""
        if name == "tiempo":
            return D.dim_tiempo(self.silver_ventas_shared, self.as_of)
        return {"cliente": lambda: D.dim_cliente(self.silver_clientes, self.as_of),
                "tienda": lambda: D.dim_tienda(self.silver_tiendas, self.as_of),
                "producto": lambda: D.dim_producto(self.silver_productos, self.as_of)}[name]()

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {name: self.dim(name) for name, _ in FX.REJECT_CHECKS}


def _m(spark, sf_dir) -> Medallion:
    return Medallion(spark, sf_dir)


# --- scalar operators over whole feeds ---------------------------------------------

def q_decode_cantidad(spark, sf_dir):
    r = _m(spark, sf_dir).raw("ventas")
    return r.select(F.col("id_venta").alias("id_venta_raw"), F.col("cantidad").alias("cantidad_raw"),
                    positive_int(decode_spelled_number("cantidad")).alias("cantidad"))


def q_clean_monto(spark, sf_dir):
    r = _m(spark, sf_dir).raw("ventas")
    return r.select(F.col("id_venta").alias("id_venta_raw"), F.col("monto").alias("monto_raw"),
                    positive_amount("monto").alias("monto"))


def q_parse_ts_three(spark, sf_dir):
    r = _m(spark, sf_dir).raw("ventas")
    return r.select(F.col("id_venta").alias("id_venta_raw"), F.col("fecha_venta").alias("fecha_raw"),
                    parse_ts_three("fecha_venta").alias("fecha_venta"),
                    parse_ts_three("updated_at").alias("updated_at"))


def q_parse_fecha_multi(spark, sf_dir):
    r = _m(spark, sf_dir).raw("clientes")
    return r.select("id_cliente", F.col("fecha_registro").alias("fecha_raw"),
                    parse_date_multi("fecha_registro").alias("fecha_registro"))


def q_range_null_date(spark, sf_dir):
    r = _m(spark, sf_dir).raw("clientes")
    parsed = parse_date_multi("fecha_registro")
    return r.select("id_cliente", parsed.alias("fecha_parsed"),
                    null_outside_date(parsed, AS_OF).alias("fecha_registro"))


def q_parse_ts_multi(spark, sf_dir):
    r = _m(spark, sf_dir).raw("devoluciones")
    return r.select(F.col("id_devolucion").alias("id_devolucion_raw"),
                    F.col("fecha_devolucion").alias("fecha_raw"),
                    parse_ts_multi("fecha_devolucion").alias("fecha_devolucion"))


def q_range_null_ts(spark, sf_dir):
    r = _m(spark, sf_dir).raw("devoluciones")
    parsed = parse_ts_multi("fecha_devolucion")
    return r.select(F.col("id_devolucion").alias("id_devolucion_raw"), parsed.alias("fecha_parsed"),
                    null_outside_ts(parsed, AS_OF, upper="date").alias("fecha_devolucion"))


def q_clean_title(spark, sf_dir):
    return E.transform_clientes(_m(spark, sf_dir).raw("clientes"), AS_OF).select("id_cliente", "nombre", "ciudad")


def q_clean_code(spark, sf_dir):
    return E.transform_tiendas(_m(spark, sf_dir).raw("tiendas")).select("id_tienda", "region")


def q_clean_email(spark, sf_dir):
    r = _m(spark, sf_dir).raw("clientes")
    return r.select("id_cliente", F.col("email").alias("email_raw"), clean_email("email").alias("email"))


def q_clean_motivo(spark, sf_dir):
    r = _m(spark, sf_dir).raw("devoluciones")
    return r.select(F.col("id_devolucion").alias("id_devolucion_raw"), F.col("motivo").alias("motivo_raw"),
                    clean_motivo("motivo").alias("motivo"))


def q_clean_precio(spark, sf_dir):
    r = _m(spark, sf_dir).raw("productos")
    return r.select(F.col("id_producto").alias("id_producto_raw"), F.col("precio").alias("precio_raw"),
                    positive_amount("precio").alias("precio"))


def q_regex_filter(spark, sf_dir):
    c = E.transform_clientes(_m(spark, sf_dir).raw("clientes"), AS_OF)
    return c.filter(F.col("email").rlike(EMAIL_PATTERN)).select("id_cliente", "email")


# --- entity cleaning, quality ------------------------------------------------------

def q_clean_ventas(spark, sf_dir):
    return _m(spark, sf_dir).ventas_clean


def q_cast_final(spark, sf_dir):
    return _m(spark, sf_dir).ventas_t.select("id_venta", "id_cliente", "id_tienda", "id_producto")


def q_anio_mes(spark, sf_dir):
    return _m(spark, sf_dir).ventas_clean.select("id_venta", "id_producto", "anio_mes")


def q_clean_clientes(spark, sf_dir):
    return _m(spark, sf_dir).clientes_clean


def q_clean_devoluciones(spark, sf_dir):
    return _m(spark, sf_dir).devoluciones_clean


def q_clean_productos(spark, sf_dir):
    return _m(spark, sf_dir).productos_clean


def q_clean_tiendas(spark, sf_dir):
    return _m(spark, sf_dir).tiendas_clean


def q_clientes_validos(spark, sf_dir):
    return Q.clientes_validos(_m(spark, sf_dir).clientes_clean, AS_OF)


def q_clientes_cuarentena(spark, sf_dir):
    return Q.clientes_cuarentena(_m(spark, sf_dir).clientes_clean, AS_OF)


def q_quarantine_reasons(spark, sf_dir):
    return _m(spark, sf_dir).clientes_clean.select("id_cliente", Q.quarantine_reasons(AS_OF).alias("razones_rechazo"))


def q_expect_warn_metrics(spark, sf_dir):
    m = _m(spark, sf_dir)
    return Q.expectation_metrics(E.transform_clientes(m.raw("clientes"), AS_OF), Q.clientes_warnings(AS_OF))


def q_expect_drop_ventas(spark, sf_dir):
    return Q.expectation_metrics(_m(spark, sf_dir).ventas_t, E.ventas_rules())


def q_expect_drop_productos(spark, sf_dir):
    return Q.expectation_metrics(E.transform_productos(_m(spark, sf_dir).raw("productos")), E.productos_rules())


def q_expectation_metrics(spark, sf_dir):
    """The event-log view - metrics of every rule of every table."""
    m = _m(spark, sf_dir)
    parts = [
        ("bronze.ventas_clean", m.ventas_t, E.ventas_rules()),
        ("bronze.clientes_clean", E.transform_clientes(m.raw("clientes"), AS_OF), Q.clientes_warnings(AS_OF)),
        ("bronze.devoluciones_clean", E.transform_devoluciones(m.raw("devoluciones"), AS_OF), E.devoluciones_rules()),
        ("bronze.productos_clean", E.transform_productos(m.raw("productos")), E.productos_rules()),
        ("bronze.tiendas_clean", E.transform_tiendas(m.raw("tiendas")), E.tiendas_rules()),
    ]
    out = None
    for table, df, rules in parts:
        x = Q.expectation_metrics(df, rules).select(F.lit(table).alias("table_name"), "*")
        out = x if out is None else out.unionByName(x)
    return out


def q_constraint_set_ventas(spark, sf_dir):
    return Q.apply_expectations(_m(spark, sf_dir).ventas_clean, Q.ventas_constraints())


def q_constraint_set_clientes(spark, sf_dir):
    """Q4, customers: the fail rule holds for the rows with an id."""
    with_id = _m(spark, sf_dir).clientes_clean.where("id_cliente is not null")
    return Q.apply_expectations(with_id, Q.clientes_constraints())


def q_constraint_set_comun(spark, sf_dir):
    """Q4, the set all tables share, on the products' raw prices."""
    r = _m(spark, sf_dir).raw("productos").where("id_producto is not null").select(
        F.col("id_producto").try_cast("long").alias("id_producto"), F.col("precio").try_cast("double").alias("precio"))
    return Q.apply_expectations(r, Q.common_constraints("id_producto", ["precio"]))


# --- SCD-1, dimensions, facts --------------------------------------------------------

def q_scd1_ventas(spark, sf_dir):
    return _m(spark, sf_dir).silver_ventas


def q_scd1_clientes(spark, sf_dir):
    return _m(spark, sf_dir).silver_clientes


def q_scd1_devoluciones(spark, sf_dir):
    return _m(spark, sf_dir).silver_devoluciones


def q_scd1_productos(spark, sf_dir):
    return _m(spark, sf_dir).silver_productos


def q_scd1_tiendas(spark, sf_dir):
    return _m(spark, sf_dir).silver_tiendas


def q_dim_cliente(spark, sf_dir):
    m = _m(spark, sf_dir)
    return D.dim_flow("cliente", [m.first_load("clientes"), m.silver_clientes], AS_OF)


def q_dim_tienda(spark, sf_dir):
    m = _m(spark, sf_dir)
    return D.dim_flow("tienda", [m.first_load("tiendas"), m.silver_tiendas], AS_OF)


def q_dim_producto(spark, sf_dir):
    m = _m(spark, sf_dir)
    return D.dim_flow("producto", [m.first_load("productos"), m.silver_productos], AS_OF)


def q_dim_tiempo(spark, sf_dir):
    """The first load is the rows of the first landing batch; the sales are cleaned once."""
    keys, seq = E.SILVER_FLOWS["ventas"]
    marked = E.transform_ventas(_m(spark, sf_dir).raw("ventas"), AS_OF, ("_lote",))
    clean = Q.apply_expectations(marked, E.ventas_rules())
    return D.dim_tiempo_loads(clean, keys, seq, F.col("_lote") == 0, AS_OF)


def q_distinct_keys(spark, sf_dir):
    return D.distinct_keys(_m(spark, sf_dir).dim("tienda"), "id_tienda")


def q_fact_ventas(spark, sf_dir):
    m = _m(spark, sf_dir)
    return FX.fact_ventas(m.silver_ventas_shared, m.dims, AS_OF)


def q_fact_join_expr(spark, sf_dir):
    m = _m(spark, sf_dir)
    return FX.fact_join_expr(m.silver_ventas_shared, m.dim("tiempo"))


def _reject_query(reason: str, key: str):
    def q(spark, sf_dir):
        m = _m(spark, sf_dir)
        # only the date dimension reads the sales a second time
        ventas = m.silver_ventas_shared if reason == "tiempo" else m.silver_ventas
        return FX.reject_by(ventas, m.dim(reason), key, reason, AS_OF)
    q.__name__ = f"q_reject_{reason}"
    return q


def q_fact_ventas_rechazadas(spark, sf_dir):
    m = _m(spark, sf_dir)
    keys, _ = E.SILVER_FLOWS["ventas"]
    return FX.rejects_single_pass(m.silver_ventas_shared, m.dims, AS_OF, unique_on=keys)


def q_union_rejects(spark, sf_dir):
    m = _m(spark, sf_dir)
    keys, _ = E.SILVER_FLOWS["ventas"]
    return FX.rejects_union(m.silver_ventas_shared, m.dims, AS_OF, unique_on=keys)


def q_fact_ventas_bucketed(spark, sf_dir):
    """J1/J9 on bucketed tables: the customer check has no exchange."""
    m, root = _m(spark, sf_dir), work_dir(spark, "bucketed")
    tables = FX.BucketedSales(spark, root, "vitrina_" + root.rpartition("-")[2], buckets=16)
    # read three times, and once more for the dates
    tables.store_sales(m.silver_ventas_shared)
    tables.store_customers(m.dim("cliente"))
    # dates come from all sales, also those without a customer
    return tables.fact({"tienda": m.dim("tienda"), "producto": m.dim("producto"), "tiempo": m.dim("tiempo")}, AS_OF)


def q_expect_fail_evidence(spark, sf_dir):
    """Q3: guarded writes of whole tables; an aborted one commits nothing."""
    m, root = _m(spark, sf_dir), work_dir(spark, "guarded")
    with_id = m.clientes_clean.where("id_cliente is not null")
    cases = [("ventas_todas", m.ventas_t, Q.ventas_constraints()), ("ventas_limpias", m.ventas_clean, Q.ventas_constraints()),
             ("clientes_todos", m.clientes_clean, Q.clientes_constraints()), ("clientes_con_id", with_id, Q.clientes_constraints())]
    rows = []
    for name, df, rules in cases:
        rule, committed = Q.guarded_write(df, rules, f"{root}/{name}")
        stored = spark.read.parquet(f"{root}/{name}").count() if files.exists(spark, f"{root}/{name}") else 0
        rows.append((name, rule, rule is not None, committed, stored))
    return spark.createDataFrame(rows, "caso string, regla string, abortada boolean, filas_confirmadas long, filas_guardadas long")


# --- schema operators ------------------------------------------------------------

ALIGN_TARGET_COLUMNS = ["id_venta", "id_producto", "monto", "fecha_venta", "canal"]


def q_enforce_schema(spark, sf_dir):
    """Silver sales projected onto the declared target DDL."""
    return enforce_schema(_m(spark, sf_dir).silver_ventas, E.SILVER_DDL["ventas"])


def _enforced(entity: str):
    def q(spark, sf_dir):
        return enforce_schema(getattr(_m(spark, sf_dir), f"silver_{entity}"), E.SILVER_DDL[entity])
    return q


def _enforced_dim(name: str):
    def q(spark, sf_dir):
        return enforce_schema(_m(spark, sf_dir).dim(name), D.GOLD_DDL[name])
    return q


def q_align_to_target(spark, sf_dir):
    """Clean sales aligned to a target column list (all STRING)."""
    return align_to_target(_m(spark, sf_dir).ventas_clean, ALIGN_TARGET_COLUMNS)


def q_project_rename(spark, sf_dir):
    """Projection with renames over the current customers."""
    c = _m(spark, sf_dir).silver_clientes
    return c.select("id_cliente", F.col("nombre").alias("nombre_cliente"),
                    F.col("ciudad").alias("ciudad_cliente"), "email")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_ventas": q_clean_ventas,
    "cast_final": q_cast_final,
    "decode_cantidad": q_decode_cantidad,
    "clean_monto": q_clean_monto,
    "parse_ts_three": q_parse_ts_three,
    "anio_mes": q_anio_mes,
    "parse_fecha_multi": q_parse_fecha_multi,
    "range_null_date": q_range_null_date,
    "parse_ts_multi": q_parse_ts_multi,
    "range_null_ts": q_range_null_ts,
    "clean_title": q_clean_title,
    "clean_code": q_clean_code,
    "clean_email": q_clean_email,
    "clean_motivo": q_clean_motivo,
    "clean_precio": q_clean_precio,
    "clean_clientes": q_clean_clientes,
    "clean_devoluciones": q_clean_devoluciones,
    "clean_productos": q_clean_productos,
    "clean_tiendas": q_clean_tiendas,
    "clientes_validos": q_clientes_validos,
    "clientes_cuarentena": q_clientes_cuarentena,
    "quarantine_reasons": q_quarantine_reasons,
    "regex_filter": q_regex_filter,
    "expect_warn_metrics": q_expect_warn_metrics,
    "expect_drop_ventas": q_expect_drop_ventas,
    "expect_drop_productos": q_expect_drop_productos,
    "expectation_metrics": q_expectation_metrics,
    "constraint_set_ventas": q_constraint_set_ventas,
    "constraint_set_clientes": q_constraint_set_clientes,
    "constraint_set_comun": q_constraint_set_comun,
    "scd1_ventas": q_scd1_ventas,
    "scd1_clientes": q_scd1_clientes,
    "scd1_devoluciones": q_scd1_devoluciones,
    "scd1_productos": q_scd1_productos,
    "scd1_tiendas": q_scd1_tiendas,
    "dim_cliente": q_dim_cliente,
    "dim_tienda": q_dim_tienda,
    "dim_producto": q_dim_producto,
    "dim_tiempo": q_dim_tiempo,
    "distinct_keys": q_distinct_keys,
    "fact_ventas": q_fact_ventas,
    "fact_join_expr": q_fact_join_expr,
    "reject_cliente": _reject_query("cliente", "id_cliente"),
    "reject_tienda": _reject_query("tienda", "id_tienda"),
    "reject_producto": _reject_query("producto", "id_producto"),
    "reject_tiempo": _reject_query("tiempo", "fecha"),
    "fact_ventas_rechazadas": q_fact_ventas_rechazadas,
    "union_rejects": q_union_rejects,
    "fact_ventas_bucketed": q_fact_ventas_bucketed,
    "expect_fail_evidence": q_expect_fail_evidence,
    "enforce_schema": q_enforce_schema,
    **{f"enforce_schema_{e}": _enforced(e) for e in E.SILVER_DDL},
    **{f"enforce_schema_dim_{d}": _enforced_dim(d) for d in D.GOLD_DDL},
    "align_to_target": q_align_to_target,
    "project_rename": q_project_rename,
}
