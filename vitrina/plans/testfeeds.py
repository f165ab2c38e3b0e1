"""Raw retail feeds derived from the driver's testdata tables.

The testdata is a clean TPC-H-like schema; the retail feeds are raw
strings with the dirt the cleaning operators exist for (odd date formats,
spelled-out quantities, padded blanks, ``null`` tokens, non-positive
amounts, missing ids, foreign-key holes). All dirt is chosen by arithmetic
on each row's own key, so the same rows come out on every run, and the
DuckDB oracle (``vitrina.plans.oracle``) builds byte-identical feeds.

Every feed is a projection of whole tables (plus the dimension joins of
the star schema), so its size grows with the input. No row is left out:
foreign-key holes are sales whose id belongs to no dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.numeric import SPELLED_NUMBERS

# Fixed evaluation instant for every compared query (replaces the clock).
AS_OF = "2024-01-20 12:00:00"
# Load instants of the two dimension loads.
LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-01-02 00:00:00"
# Sales dates are shifted so most fall inside the [2000-01-01, as_of] range.
SHIFT_DAYS = 3652
# Added to the sales' foreign keys that are to miss their dimension.
NO_DIMENSION = 9_000_000_000_000
WORDS = list(SPELLED_NUMBERS)  # cero .. diez, value i at position i


# Every raw feed carries ``_lote``: the landing batch a row's file belongs
# to when the feed is written out as CSV files (sales: 0..2, others 0..1;
# the dimension feeds' second load is their second batch).


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of one testdata table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(c: str) -> Column:
    """A foreign key of the sales as text: one in ten keys is moved to an id
    that no dimension has."""
    key = F.col(c)
    return F.when(key % 10 == 0, key + NO_DIMENSION).otherwise(key).cast("string")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _fmt(ts: Column, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def _case(k: Column, mod: int, branches: dict[int, Column], default: Column) -> Column:
    r = k % mod
    out = None
    for value, col in branches.items():
        out = F.when(r == value, col) if out is None else out.when(r == value, col)
    return out.otherwise(default)


def _null(dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype)


def ventas_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales feed: lineitem joined to orders, one row per line."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # both sides grow with the business: the plan of a large input at every size,
    # and the rows' parsing is spread by the join's shuffle
    j = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    q = F.col("l_quantity").cast("int")
    m = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    word = F.try_element_at(F.array(*[F.lit(w) for w in WORDS]), q + 1)
    shift = F.when(k % 29 == 0, F.lit(0)).otherwise(F.lit(SHIFT_DAYS * 86400)) + (k * 7919) % 86400
    fv = F.timestamp_add("SECOND", shift, F.col("o_orderdate"))
    ua = F.timestamp_add("SECOND", (k * 31) % 86400, F.col("l_shipdate"))
    ymd_hms = _fmt(fv, "yyyy-MM-dd HH:mm:ss")
    return j.select(
        F.when(k % 499 == 0, _null()).otherwise(_s("l_orderkey")).alias("id_venta"),
        F.when(k % 211 == 0, _null()).otherwise(_id("o_custkey")).alias("id_cliente"),
        F.when(k % 307 == 0, F.concat(F.lit(" "), _id("l_suppkey"), F.lit(" ")))
         .otherwise(_id("l_suppkey")).alias("id_tienda"),
        F.when(k % 401 == 0, F.lit("N/D")).otherwise(_id("l_partkey")).alias("id_producto"),
        _case(k, 16, {
            0: F.when(q <= 10, word).otherwise(_s(q)),
            1: F.when(q <= 10, F.concat(F.lit(" "), F.upper(word), F.lit(" "))).otherwise(_s(q)),
            2: F.lit("0"),
            3: F.concat(F.lit("-"), _s(q)),
            4: F.concat(_s(q), F.lit(".5")),
            5: F.concat(F.lit(" "), _s(q), F.lit(" ")),
            6: _null(),
        }, _s(q)).alias("cantidad"),
        _case(k, 19, {
            0: F.concat(F.lit("-"), m),
            1: F.lit("0"),
            2: F.lit("N/D"),
            3: F.concat(F.lit(" "), m, F.lit(" ")),
            4: F.concat(m, F.lit("4")),
        }, m).alias("monto"),
        _case(k, 8, {
            3: _fmt(fv, "yyyy/MM/dd HH:mm:ss"),
            4: _fmt(fv, "dd/MM/yyyy HH:mm:ss"),
            5: F.concat(F.lit(" "), ymd_hms, F.lit(" ")),
            6: _fmt(fv, "yyyy/MM/dd HH:mm:ss"),
            7: F.when(k % 3 == 0, _fmt(fv, "yyyy-MM-dd")).otherwise(_fmt(fv, "dd/MM/yyyy HH:mm:ss")),
        }, ymd_hms).alias("fecha_venta"),
        F.when(k % 53 == 0, _null())
         .when(k % 6 == 0, _fmt(ua, "dd/MM/yyyy HH:mm:ss"))
         .when(k % 6 == 1, _fmt(ua, "yyyy/MM/dd HH:mm:ss"))
         .otherwise(_fmt(ua, "yyyy-MM-dd HH:mm:ss")).alias("updated_at"),
        (k % 3).cast("int").alias("_lote"),
    )


def clientes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer feed: two loads (every customer, then an update of every 7th)."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = c.join(n, c.c_nationkey == n.n_nationkey)
    src = base.withColumn("v", F.lit(1)).unionByName(
        base.filter(F.col("c_custkey") % 7 == 0).withColumn("v", F.lit(2)))
    k = F.col("c_custkey") * 2 + F.col("v")
    key = _s("c_custkey")
    email = F.concat(F.lit("cliente"), key, F.lit("@correo.com"))
    days = ((F.col("c_custkey") * 37 + F.col("v") * 400) % 3300).cast("int")
    d = F.date_add(F.lit("2015-01-01").cast("date"), days)
    ymd = _fmt(d, "yyyy-MM-dd")
    return src.select(
        F.when(k % 97 == 0, _null("int")).otherwise(F.col("c_custkey").cast("int")).alias("id_cliente"),
        _case(k, 4, {
            0: F.lower("c_name"),
            1: F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")),
            2: F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(" n "))),
        }, F.col("c_name")).alias("nombre"),
        _case(k, 24, {
            0: _null(),
            1: F.lit("null"),
            2: F.lit(" NULL "),
            3: F.concat(F.lit("cliente"), key, F.lit("@correo")),
            4: F.concat(F.lit(" "), F.upper(email), F.lit(" ")),
            5: F.concat(F.lit("cliente "), key, F.lit("@correo.com")),
        }, email).alias("email"),
        _case(k, 5, {
            0: F.lower("n_name"),
            1: _null(),
            2: F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")),
        }, F.col("n_name")).alias("ciudad"),
        F.when(k % 41 == 0, F.lit("1899-12-31"))
         .when(k % 43 == 0, F.lit("2999-01-01"))
         .otherwise(_case(k, 9, {
             0: ymd,
             1: _fmt(d, "dd/MM/yyyy"),
             2: _fmt(d, "MM-dd-yyyy"),
             3: _fmt(d, "yyyy/MM/dd"),
             4: F.concat(ymd, F.lit(" 10:11:12")),
             5: F.concat(_fmt(d, "dd/MM/yyyy"), F.lit(" 10:11:12")),
             6: F.concat(F.lit(" "), ymd, F.lit(" ")),
             7: F.concat(_fmt(d, "yyyy/MM/dd"), F.lit("x")),
         }, F.when(k % 2 == 0, F.lit("sin fecha")).otherwise(_fmt(d, "dd-MM-yyyy"))))
         .alias("fecha_registro"),
        (k % 2).cast("int").alias("_lote"),
    )


def devoluciones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns feed: every event, then a correction of every 5th event
    (two days later for even ids, a late older row for odd ids)."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    upd = e.filter(F.col("event_id") % 5 == 0).select(
        "event_id", "user_id",
        F.concat(F.lit("cambio de "), F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 2 == 0, F.timestamp_add("DAY", F.lit(2), F.col("ts")))
         .otherwise(F.timestamp_add("DAY", F.lit(-3), F.col("ts"))).alias("ts"))
    src = e.withColumn("v", F.lit(1)).unionByName(upd.withColumn("v", F.lit(2)))
    k = F.col("event_id") * 2 + F.col("v")
    t = F.col("ts")
    return src.select(
        F.when(k % 89 == 0, _null()).otherwise(_s("event_id")).alias("id_devolucion"),
        _s("user_id").alias("id_venta"),
        _case(k, 7, {
            0: F.concat(F.lit("  "), F.upper("event_type"), F.lit(" de fabrica ")),
            1: F.lit("N/A"),
            2: F.lit("n/a"),
            3: F.lit(""),
            4: F.lit("   "),
            5: _null(),
        }, F.col("event_type")).alias("motivo"),
        _case(k, 10, {
            0: _fmt(t, "yyyy-MM-dd HH:mm:ss"),
            1: _fmt(t, "dd/MM/yyyy HH:mm:ss"),
            2: _fmt(t, "MM-dd-yyyy HH:mm:ss"),
            3: _fmt(t, "yyyy/MM/dd HH:mm:ss"),
            4: _fmt(t, "yyyy-MM-dd"),
            5: _fmt(t, "dd/MM/yyyy"),
            6: _fmt(t, "MM-dd-yyyy"),
            7: _fmt(t, "yyyy/MM/dd"),
            8: F.lit("1999-12-31 23:59:59"),
        }, _fmt(t, "dd-MM-yyyy")).alias("fecha_devolucion"),
        (k % 2).cast("int").alias("_lote"),
    )


def productos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: two loads (every part, then a new price of every 9th)."""
    p = (_t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
         .withColumn("pr", F.col("p_retailprice").cast("decimal(18,2)")))
    src = p.select("*", F.lit(1).alias("v"), F.lit(LOAD_1).cast("timestamp").alias("_created_at")).unionByName(
        p.filter(F.col("p_partkey") % 9 == 0).select(
            "p_partkey", "p_name", "p_type", "p_retailprice",
            (F.col("pr") + F.lit(25).cast("decimal(18,2)")).alias("pr"),
            F.lit(2).alias("v"), F.lit(LOAD_2).cast("timestamp").alias("_created_at")),
        allowMissingColumns=False)
    k = F.col("p_partkey") * 2 + F.col("v")
    m = _s("pr")
    return src.select(
        F.when(k % 101 == 0, _null()).otherwise(_s("p_partkey")).alias("id_producto"),
        _case(k, 3, {0: F.upper("p_name"), 1: F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))},
              F.col("p_name")).alias("nombre"),
        _case(k, 4, {0: _null(), 1: F.lower("p_type")}, F.col("p_type")).alias("categoria"),
        _case(k, 13, {
            0: F.lit("0"),
            1: F.concat(F.lit("-"), m),
            2: F.lit("gratis"),
            3: F.concat(m, F.lit("6")),
            4: F.concat(F.lit(" "), m),
        }, m).alias("precio"),
        "_created_at",
        (F.col("v") - 1).cast("int").alias("_lote"),
    )


def tiendas_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store feed: supplier, nation and region; two loads (every supplier,
    then a new name of every third)."""
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("s_suppkey", "s_name", "n_name", "r_name"))
    src = base.select("*", F.lit(1).alias("v"), F.lit(LOAD_1).cast("timestamp").alias("_created_at")).unionByName(
        base.filter(F.col("s_suppkey") % 3 == 0).select(
            "s_suppkey", F.concat(F.col("s_name"), F.lit(" bis")).alias("s_name"), "n_name", "r_name",
            F.lit(2).alias("v"), F.lit(LOAD_2).cast("timestamp").alias("_created_at")))
    k = F.col("s_suppkey") * 2 + F.col("v")
    return src.select(
        F.when(k % 47 == 0, _null()).otherwise(_s("s_suppkey")).alias("id_tienda"),
        _case(k, 3, {0: F.lower("s_name"), 1: F.concat(F.lit("  "), F.col("s_name"))},
              F.col("s_name")).alias("nombre"),
        _case(k, 4, {0: _null(), 1: F.lower("n_name")}, F.col("n_name")).alias("ciudad"),
        _case(k, 3, {0: F.concat(F.lit(" "), F.lower("r_name"), F.lit(" "))},
              F.col("r_name")).alias("region"),
        "_created_at",
        (F.col("v") - 1).cast("int").alias("_lote"),
    )


RAW_FEEDS = {
    "ventas": ventas_raw,
    "clientes": clientes_raw,
    "devoluciones": devoluciones_raw,
    "productos": productos_raw,
    "tiendas": tiendas_raw,
}


def raw_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """The raw feed of this name."""
    return RAW_FEEDS[feed](spark, sf_dir)
