"""Fact table and rejected-sales audit.

Foreign-key checks never need a dimension column, so they are semi joins
(``left_semi``) or existence flags, never inner joins: a repeated
dimension key can not multiply sales rows, and no ``distinct`` is needed
on the build side. Join strategy is left to Spark: AQE broadcasts a side
only when its measured size is under ``autoBroadcastJoinThreshold`` and
otherwise plans a sort-merge join, splitting skewed sales partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.temporal import as_of_timestamp

# Fixed values that must equal the reference's: reason texts and the key
# each dimension checks, in the reference's order.
REJECT_CHECKS = (
    ("cliente", "id_cliente"),
    ("tienda", "id_tienda"),
    ("producto", "id_producto"),
    ("tiempo", "fecha"),
)

# Dimensions from the one that is usually smallest.
SMALL_FIRST = ("tiempo", "tienda", "producto", "cliente")

# Fixed values that must equal the reference's: the fact's columns.
FACT_COLUMNS = ("id_cliente", "id_tienda", "id_producto", "fecha", "id_venta",
                "cantidad", "monto", "fecha_venta", "anio_mes")


def with_fecha(ventas: DataFrame) -> DataFrame:
    """The sale date, computed once so the date check is an equi-join."""
    return ventas.withColumn("fecha", F.to_date("fecha_venta"))


def semi_join_check(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keep rows whose ``key`` exists in ``dim`` (NULL keys drop out)."""
    return df.join(dim.select(key), key, "left_semi")


def fact_ventas(ventas: DataFrame, dims: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """Sales whose four foreign keys all exist; natural keys kept.

    ``dims`` maps ``cliente``/``tienda``/``producto``/``tiempo`` to the
    dimension frames.
    """
    v = with_fecha(ventas)
    # semi joins commute: the small dimensions thin the sales before the large ones
    for name, key in sorted(REJECT_CHECKS, key=lambda c: SMALL_FIRST.index(c[0])):
        v = semi_join_check(v, dims[name], key)
    return v.select(*FACT_COLUMNS, as_of_timestamp(as_of).alias("creation_date"))


def fact_join_expr(ventas: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """J4 alone: sales joined to the date dimension on ``to_date(fecha_venta)``."""
    return semi_join_check(with_fecha(ventas), dim_tiempo, "fecha")


_SOURCE_COLUMNS = ("id_venta", "id_producto", "id_cliente", "id_tienda", "fecha_venta")


def _reject_projection(reason: Column, as_of) -> list[Column]:
    return [
        F.col("id_venta"),
        F.col("id_producto").alias("id_producto_source"),
        F.col("id_cliente").alias("id_cliente_source"),
        F.col("id_tienda").alias("id_tienda_source"),
        F.col("fecha_venta"),
        reason.alias("reason"),
        as_of_timestamp(as_of).alias("creation_date"),
    ]


def reject_by(ventas: DataFrame, dim: DataFrame, key: str, reason: str, as_of=None) -> DataFrame:
    """Sales whose ``key`` is missing from ``dim``; a NULL key is
    missing too (anti join keeps it)."""
    missing = with_fecha(ventas).join(dim.select(key), key, "left_anti")
    return missing.select(*_reject_projection(F.lit(reason), as_of))


def rejects_union(ventas: DataFrame, dims: Mapping[str, DataFrame], as_of=None,
                  distinct: bool = True, unique_on: Sequence[str] | None = None) -> DataFrame:
    """J10, anti-join form (U1 + U2): four anti joins, union, distinct. If sales are unique
    on ``unique_on``, two reject rows are equal when that key and the reason are.

    Four scans of the sales; kept as the independent check of the
    single-pass form."""
    parts = [reject_by(ventas, dims[n], k, n, as_of) for n, k in REJECT_CHECKS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if unique_on is not None and distinct:
        return out.dropDuplicates([*(f"{c}_source" if c.startswith("id_") and c != "id_venta" else c for c in unique_on), "reason"])
    return out.distinct() if distinct else out


# Customers with more than this share of a bucket's rows are checked beside the buckets.
HOT_SHARE = 0.5


class BucketedSales:
    """J1/J5 on co-located tables: sales and customers stored in buckets of the customer id, so
    that the check of each run reads both sides bucket by bucket, without an exchange.

    A bucket can't be split at run time, so customers that alone hold more than
    ``HOT_SHARE`` of an average bucket (fewer than 2 * buckets of them, whatever the data) are
    stored apart, spread over files, and checked against a broadcast of just those ids. Sales
    without a customer are in neither: they can't pass the check."""

    KEY = "id_cliente"

    def __init__(self, spark: SparkSession, root: str, name: str, buckets: int = 64):
        self.spark, self.root, self.name, self.buckets = spark, root.rstrip("/"), name, buckets

    def _bucketed(self, df: DataFrame, table: str) -> None:
        # dealt out as the buckets are: one file a bucket
        (df.repartition(self.buckets, self.KEY).write.mode("overwrite").bucketBy(self.buckets, self.KEY).sortBy(self.KEY)
         .option("path", f"{self.root}/{table}").format("parquet").saveAsTable(f"{self.name}_{table}"))

    def store_sales(self, ventas: DataFrame) -> None:
        known = with_fecha(ventas).where(F.col(self.KEY).isNotNull())
        per_key = known.groupBy(self.KEY).agg(F.count(F.lit(1)).alias("n"))
        per_key.write.mode("overwrite").parquet(f"{self.root}/per_key")
        per_key = self.spark.read.schema("id_cliente long, n long").parquet(f"{self.root}/per_key")
        limit = (per_key.agg(F.sum("n")).first()[0] or 0) * HOT_SHARE / self.buckets
        hot = per_key.where(F.col("n") > limit).select(self.KEY)
        hot.write.mode("overwrite").parquet(f"{self.root}/hot_keys")
        hot = F.broadcast(self._hot())
        self._bucketed(known.join(hot, self.KEY, "left_anti"), "ventas")
        known.join(hot, self.KEY, "left_semi").write.mode("overwrite").parquet(f"{self.root}/ventas_hot")

    def _hot(self) -> DataFrame:
        return self.spark.read.schema("id_cliente long").parquet(f"{self.root}/hot_keys")

    def store_customers(self, dim: DataFrame) -> None:
        self._bucketed(dim.select(self.KEY).distinct(), "clientes")

    def _sides(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        sales, customers = (self.spark.read.table(f"{self.name}_{t}") for t in ("ventas", "clientes"))
        hot = self.spark.read.schema(sales.schema).parquet(f"{self.root}/ventas_hot")
        # at most the hot keys
        return sales, customers, hot, F.broadcast(customers.join(F.broadcast(self._hot()), self.KEY, "left_semi"))

    def with_customer(self) -> DataFrame:
        """Sales whose customer exists."""
        sales, customers, hot, known_hot = self._sides()
        return sales.join(customers.hint("merge"), self.KEY, "left_semi").unionByName(hot.join(known_hot, self.KEY, "left_semi"))

    def without_customer(self) -> DataFrame:
        """Sales whose customer id no customer has."""
        sales, customers, hot, known_hot = self._sides()
        return sales.join(customers.hint("merge"), self.KEY, "left_anti").unionByName(hot.join(known_hot, self.KEY, "left_anti"))

    def fact(self, dims: Mapping[str, DataFrame], as_of=None) -> DataFrame:
        """The fact, its customer check on the buckets."""
        v = self.with_customer()
        for name, key in sorted((c for c in REJECT_CHECKS if c[0] != "cliente"), key=lambda c: SMALL_FIRST.index(c[0])):
            v = semi_join_check(v, dims[name], key)
        return v.select(*FACT_COLUMNS, as_of_timestamp(as_of).alias("creation_date"))


def tag_sales(ventas: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One scan of the sales with four flags ``ok_<dimension>``.

    Each flag comes from a left outer join against the *distinct* keys of
    the dimension (distinct, so a repeated key can never multiply a sale).
    Left outer joins are what AQE's skew handling splits: if one key - or
    NULL, for sales with no customer - holds a third of the sales under a
    sort-merge join, its partition is cut into pieces instead of landing on
    one task. Small key sets are broadcast by AQE from their measured size.
    """
    v = with_fecha(ventas)
    for name, key in REJECT_CHECKS:
        keys = dims[name].select(key).where(F.col(key).isNotNull()).distinct() \
            .withColumn(f"ok_{name}", F.lit(True))
        v = v.join(keys, key, "left").withColumn(f"ok_{name}", F.coalesce(f"ok_{name}", F.lit(False)))
    return v


def reject_reasons() -> Column:
    """The failed checks of a tagged sale, in the reference's order."""
    return F.array_compact(F.array(*[
        F.when(~F.col(f"ok_{name}"), F.lit(name)) for name, _ in REJECT_CHECKS
    ]))


def accepted_flag() -> Column:
    cond = F.lit(True)
    for name, _ in REJECT_CHECKS:
        cond = cond & F.col(f"ok_{name}")
    return cond


def fact_from_tagged(tagged: DataFrame, as_of=None) -> DataFrame:
    """J9 from the tagged plan: every flag true."""
    return tagged.filter(accepted_flag()).select(
        *FACT_COLUMNS, as_of_timestamp(as_of).alias("creation_date"))


def rejects_from_tagged(tagged: DataFrame, as_of=None,
                        unique_on: Sequence[str] | None = None) -> DataFrame:
    """J10 from the tagged plan: one row per (sale, failed check).

    The reference ends with a ``distinct``. When the caller states that
    the sales are unique on ``unique_on`` (true for an SCD-1 snapshot,
    keyed by id_venta, id_producto), every reject row is already distinct
    - both key columns and the reason are in it - and the full-row shuffle
    is skipped.
    """
    out = (tagged.filter(~accepted_flag())
           .select("*", F.explode(reject_reasons()).alias("__reason"))
           .select(*_reject_projection(F.col("__reason"), as_of)))
    covered = unique_on is not None and set(unique_on) <= set(_SOURCE_COLUMNS)
    return out if covered else out.distinct()


def rejects_single_pass(ventas: DataFrame, dims: Mapping[str, DataFrame], as_of=None,
                        unique_on: Sequence[str] | None = None) -> DataFrame:
    """J10, single-pass form: one scan of sales, four existence flags."""
    return rejects_from_tagged(tag_sales(ventas, dims), as_of, unique_on)
