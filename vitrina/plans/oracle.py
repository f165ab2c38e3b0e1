"""DuckDB SQL oracle for the registered queries.

Written independently of the Spark operators: the same feeds and the same
semantics, expressed in DuckDB's SQL dialect (``try_strptime``, RE2
``regexp_matches``, ``QUALIFY``). DuckDB has no ``initcap``; a word-wise
``list_transform`` stands in. The views ``lineitem orders customer nation
supplier region part events`` are registered by the caller.
"""

from __future__ import annotations

from vitrina.plans.testfeeds import AS_OF, LOAD_1, LOAD_2, NO_DIMENSION, SHIFT_DAYS, WORDS

AS_OF_TS = f"TIMESTAMP '{AS_OF}'"
AS_OF_DATE = f"DATE '{AS_OF[:10]}'"
EMAIL_RE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def initcap(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"string_split(trim({x}), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END")


def _words_list() -> str:
    return "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"


def _words_case(x: str) -> str:
    whens = " ".join(f"WHEN '{w}' THEN '{i}'" for i, w in enumerate(WORDS))
    return f"CASE lower(trim({x})) {whens} END"


def _id(x: str) -> str:
    return f"CASE WHEN {x} % 10 = 0 THEN {x} + {NO_DIMENSION} ELSE {x} END"


# --- raw feeds -----------------------------------------------------------------

VENTAS_RAW = f"""
ventas_src AS (
  SELECT l.l_orderkey, {_id('l.l_partkey')} AS l_partkey, {_id('l.l_suppkey')} AS l_suppkey, {_id('o.o_custkey')} AS o_custkey,
         CAST(l.l_quantity AS INTEGER) AS q,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS m,
         l.l_orderkey * 8 + l.l_linenumber AS k,
         o.o_orderdate, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
ventas_ts AS (
  SELECT *,
    o_orderdate + to_seconds(CASE WHEN k % 29 = 0 THEN 0 ELSE {SHIFT_DAYS} * 86400 END + (k * 7919) % 86400) AS fv,
    l_shipdate + to_seconds((k * 31) % 86400) AS ua,
    {_words_list()}[q + 1] AS word
  FROM ventas_src
),
ventas_raw AS (
  SELECT
    CASE WHEN k % 499 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS id_venta,
    CASE WHEN k % 211 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS id_cliente,
    CASE WHEN k % 307 = 0 THEN ' ' || CAST(l_suppkey AS VARCHAR) || ' ' ELSE CAST(l_suppkey AS VARCHAR) END AS id_tienda,
    CASE WHEN k % 401 = 0 THEN 'N/D' ELSE CAST(l_partkey AS VARCHAR) END AS id_producto,
    CASE k % 16
      WHEN 0 THEN CASE WHEN q <= 10 THEN word ELSE CAST(q AS VARCHAR) END
      WHEN 1 THEN CASE WHEN q <= 10 THEN ' ' || upper(word) || ' ' ELSE CAST(q AS VARCHAR) END
      WHEN 2 THEN '0'
      WHEN 3 THEN '-' || CAST(q AS VARCHAR)
      WHEN 4 THEN CAST(q AS VARCHAR) || '.5'
      WHEN 5 THEN ' ' || CAST(q AS VARCHAR) || ' '
      WHEN 6 THEN NULL
      ELSE CAST(q AS VARCHAR) END AS cantidad,
    CASE k % 19
      WHEN 0 THEN '-' || m
      WHEN 1 THEN '0'
      WHEN 2 THEN 'N/D'
      WHEN 3 THEN ' ' || m || ' '
      WHEN 4 THEN m || '4'
      ELSE m END AS monto,
    CASE k % 8
      WHEN 3 THEN strftime(fv, '%Y/%m/%d %H:%M:%S')
      WHEN 4 THEN strftime(fv, '%d/%m/%Y %H:%M:%S')
      WHEN 5 THEN ' ' || strftime(fv, '%Y-%m-%d %H:%M:%S') || ' '
      WHEN 6 THEN strftime(fv, '%Y/%m/%d %H:%M:%S')
      WHEN 7 THEN CASE WHEN k % 3 = 0 THEN strftime(fv, '%Y-%m-%d') ELSE strftime(fv, '%d/%m/%Y %H:%M:%S') END
      ELSE strftime(fv, '%Y-%m-%d %H:%M:%S') END AS fecha_venta,
    CASE WHEN k % 53 = 0 THEN NULL
         WHEN k % 6 = 0 THEN strftime(ua, '%d/%m/%Y %H:%M:%S')
         WHEN k % 6 = 1 THEN strftime(ua, '%Y/%m/%d %H:%M:%S')
         ELSE strftime(ua, '%Y-%m-%d %H:%M:%S') END AS updated_at,
    CAST(k % 3 AS INTEGER) AS _lote
  FROM ventas_ts
)"""

CLIENTES_RAW = """
clientes_base AS (
  SELECT c.c_custkey, c.c_name, n.n_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
clientes_src AS (
  SELECT *, 1 AS v FROM clientes_base
  UNION ALL
  SELECT *, 2 AS v FROM clientes_base WHERE c_custkey % 7 = 0
),
clientes_k AS (
  SELECT *, c_custkey * 2 + v AS k,
         DATE '2015-01-01' + CAST((c_custkey * 37 + v * 400) % 3300 AS INTEGER) AS d,
         'cliente' || CAST(c_custkey AS VARCHAR) || '@correo.com' AS e
  FROM clientes_src
),
clientes_raw AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS id_cliente,
    CASE k % 4 WHEN 0 THEN lower(c_name)
               WHEN 1 THEN '  ' || upper(c_name) || ' '
               WHEN 2 THEN lower(replace(c_name, '#', ' n '))
               ELSE c_name END AS nombre,
    CASE k % 24 WHEN 0 THEN NULL
                WHEN 1 THEN 'null'
                WHEN 2 THEN ' NULL '
                WHEN 3 THEN 'cliente' || CAST(c_custkey AS VARCHAR) || '@correo'
                WHEN 4 THEN ' ' || upper(e) || ' '
                WHEN 5 THEN 'cliente ' || CAST(c_custkey AS VARCHAR) || '@correo.com'
                ELSE e END AS email,
    CASE k % 5 WHEN 0 THEN lower(n_name) WHEN 1 THEN NULL WHEN 2 THEN ' ' || n_name || ' ' ELSE n_name END AS ciudad,
    CASE WHEN k % 41 = 0 THEN '1899-12-31'
         WHEN k % 43 = 0 THEN '2999-01-01'
         ELSE CASE k % 9
           WHEN 0 THEN strftime(d, '%Y-%m-%d')
           WHEN 1 THEN strftime(d, '%d/%m/%Y')
           WHEN 2 THEN strftime(d, '%m-%d-%Y')
           WHEN 3 THEN strftime(d, '%Y/%m/%d')
           WHEN 4 THEN strftime(d, '%Y-%m-%d') || ' 10:11:12'
           WHEN 5 THEN strftime(d, '%d/%m/%Y') || ' 10:11:12'
           WHEN 6 THEN ' ' || strftime(d, '%Y-%m-%d') || ' '
           WHEN 7 THEN strftime(d, '%Y/%m/%d') || 'x'
           ELSE CASE WHEN k % 2 = 0 THEN 'sin fecha' ELSE strftime(d, '%d-%m-%Y') END
         END END AS fecha_registro,
    CAST(k % 2 AS INTEGER) AS _lote
  FROM clientes_k
)"""

DEVOLUCIONES_RAW = """
dev_src AS (
  SELECT event_id, user_id, event_type, ts, 1 AS v FROM events
  UNION ALL
  SELECT event_id, user_id, 'cambio de ' || event_type,
         CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 2 DAY ELSE ts - INTERVAL 3 DAY END, 2
  FROM events WHERE event_id % 5 = 0
),
devoluciones_raw AS (
  SELECT
    CASE WHEN (event_id * 2 + v) % 89 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id_devolucion,
    CAST(user_id AS VARCHAR) AS id_venta,
    CASE (event_id * 2 + v) % 7
      WHEN 0 THEN '  ' || upper(event_type) || ' de fabrica '
      WHEN 1 THEN 'N/A' WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN '   ' WHEN 5 THEN NULL
      ELSE event_type END AS motivo,
    CASE (event_id * 2 + v) % 10
      WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
      WHEN 2 THEN strftime(ts, '%m-%d-%Y %H:%M:%S')
      WHEN 3 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
      WHEN 4 THEN strftime(ts, '%Y-%m-%d')
      WHEN 5 THEN strftime(ts, '%d/%m/%Y')
      WHEN 6 THEN strftime(ts, '%m-%d-%Y')
      WHEN 7 THEN strftime(ts, '%Y/%m/%d')
      WHEN 8 THEN '1999-12-31 23:59:59'
      ELSE strftime(ts, '%d-%m-%Y') END AS fecha_devolucion,
    CAST((event_id * 2 + v) % 2 AS INTEGER) AS _lote
  FROM dev_src
)"""

PRODUCTOS_RAW = f"""
prod_base AS (
  SELECT p_partkey, p_name, p_type, CAST(p_retailprice AS DECIMAL(18,2)) AS pr
  FROM part
),
prod_src AS (
  SELECT p_partkey, p_name, p_type, pr, 1 AS v, TIMESTAMP '{LOAD_1}' AS _created_at FROM prod_base
  UNION ALL
  SELECT p_partkey, p_name, p_type, pr + CAST(25 AS DECIMAL(18,2)), 2, TIMESTAMP '{LOAD_2}'
  FROM prod_base WHERE p_partkey % 9 = 0
),
productos_raw AS (
  SELECT
    CASE WHEN (p_partkey * 2 + v) % 101 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS id_producto,
    CASE (p_partkey * 2 + v) % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN ' ' || p_name || '  ' ELSE p_name END AS nombre,
    CASE (p_partkey * 2 + v) % 4 WHEN 0 THEN NULL WHEN 1 THEN lower(p_type) ELSE p_type END AS categoria,
    CASE (p_partkey * 2 + v) % 13
      WHEN 0 THEN '0'
      WHEN 1 THEN '-' || CAST(pr AS VARCHAR)
      WHEN 2 THEN 'gratis'
      WHEN 3 THEN CAST(pr AS VARCHAR) || '6'
      WHEN 4 THEN ' ' || CAST(pr AS VARCHAR)
      ELSE CAST(pr AS VARCHAR) END AS precio,
    _created_at,
    CAST(v - 1 AS INTEGER) AS _lote
  FROM prod_src
)"""

TIENDAS_RAW = f"""
tienda_base AS (
  SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey
),
tienda_src AS (
  SELECT s_suppkey, s_name, n_name, r_name, 1 AS v, TIMESTAMP '{LOAD_1}' AS _created_at FROM tienda_base
  UNION ALL
  SELECT s_suppkey, s_name || ' bis', n_name, r_name, 2, TIMESTAMP '{LOAD_2}'
  FROM tienda_base WHERE s_suppkey % 3 = 0
),
tiendas_raw AS (
  SELECT
    CASE WHEN (s_suppkey * 2 + v) % 47 = 0 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS id_tienda,
    CASE (s_suppkey * 2 + v) % 3 WHEN 0 THEN lower(s_name) WHEN 1 THEN '  ' || s_name ELSE s_name END AS nombre,
    CASE (s_suppkey * 2 + v) % 4 WHEN 0 THEN NULL WHEN 1 THEN lower(n_name) ELSE n_name END AS ciudad,
    CASE (s_suppkey * 2 + v) % 3 WHEN 0 THEN ' ' || lower(r_name) || ' ' ELSE r_name END AS region,
    _created_at,
    CAST(v - 1 AS INTEGER) AS _lote
  FROM tienda_src
)"""


# --- cleaning --------------------------------------------------------------------

def _ts_three(x: str) -> str:
    t = f"trim({x})"
    return (f"coalesce(try_strptime({t}, '%Y/%m/%d %H:%M:%S'), try_strptime({t}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({t}, '%d/%m/%Y %H:%M:%S'))")


def _guarded(t: str, guard: str, fmt: str, src: str | None = None, cast: str | None = None) -> str:
    v = f"try_strptime({src or t}, '{fmt}')"
    if cast:
        v = f"CAST({v} AS {cast})"
    return f"CASE WHEN regexp_matches({t}, '{guard}') THEN {v} END"


def _date_multi(x: str) -> str:
    t = f"trim({x})"
    s10 = f"substr({t}, 1, 10)"
    parts = [
        _guarded(t, r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d", cast="DATE"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y", cast="DATE"),
        _guarded(t, r"^\d{2}-\d{2}-\d{4}$", "%m-%d-%Y", cast="DATE"),
        _guarded(t, r"^\d{2}-\d{2}-\d{4}$", "%d-%m-%Y", cast="DATE"),
        _guarded(t, r"^\d{4}/\d{2}/\d{2}", "%Y/%m/%d", src=s10, cast="DATE"),
        _guarded(t, r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "%Y-%m-%d", src=s10, cast="DATE"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "%d/%m/%Y", src=s10, cast="DATE"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4}$", "%m/%d/%Y", cast="DATE"),
    ]
    return "coalesce(" + ", ".join(parts) + ")"


def _ts_multi(x: str) -> str:
    t = f"trim({x})"
    parts = [
        _guarded(t, r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "%Y-%m-%d %H:%M:%S"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "%d/%m/%Y %H:%M:%S"),
        _guarded(t, r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$", "%m-%d-%Y %H:%M:%S"),
        _guarded(t, r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$", "%Y/%m/%d %H:%M:%S"),
        _guarded(t, r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y"),
        _guarded(t, r"^\d{2}/\d{2}/\d{4}$", "%m/%d/%Y"),
        _guarded(t, r"^\d{2}-\d{2}-\d{4}$", "%m-%d-%Y"),
        _guarded(t, r"^\d{2}-\d{2}-\d{4}$", "%d-%m-%Y"),
    ]
    return "coalesce(" + ", ".join(parts) + ")"


def _long(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(trim({x}) AS BIGINT) END"


def _pos_int(x: str) -> str:
    v = f"(CASE WHEN regexp_matches({x}, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(trim({x}) AS INTEGER) END)"
    return f"CASE WHEN {v} > 0 THEN {v} END"


def _pos_amount(x: str) -> str:
    v = f"try_cast({x} AS DOUBLE)"
    return f"CASE WHEN {v} > 0 THEN CAST(round({v}, 2) AS DECIMAL(18,2)) END"


def _email(x: str) -> str:
    n = f"lower(trim({x}))"
    return f"CASE WHEN {n} <> 'null' AND regexp_matches({n}, '{EMAIL_RE}') THEN {n} END"


def _motivo(x: str) -> str:
    low = f"lower(trim({x}))"
    return (f"CASE WHEN {x} IS NULL OR trim({x}) IN ('N/A', '') THEN NULL "
            f"ELSE upper(substr({low}, 1, 1)) || substr({low}, 2) END")


CLEAN = f"""
ventas_p AS (
  SELECT *, {_ts_three('fecha_venta')} AS fv_parsed FROM ventas_raw
),
ventas_t AS (
  SELECT
    {_long('id_venta')} AS id_venta,
    {_long('id_cliente')} AS id_cliente,
    {_long('id_tienda')} AS id_tienda,
    {_long('id_producto')} AS id_producto,
    {_pos_int("coalesce(" + _words_case("cantidad") + ", cantidad)")} AS cantidad,
    {_pos_amount('monto')} AS monto,
    CASE WHEN fv_parsed >= TIMESTAMP '2000-01-01' AND fv_parsed <= {AS_OF_TS} THEN fv_parsed END AS fecha_venta,
    {_ts_three('updated_at')} AS updated_at,
    _lote
  FROM ventas_p
),
ventas_clean AS (
  SELECT id_venta, id_cliente, id_tienda, id_producto, cantidad, monto, fecha_venta, updated_at,
         strftime(fecha_venta, '%Y-%m') AS anio_mes
  FROM ventas_t WHERE id_venta IS NOT NULL AND id_producto IS NOT NULL
),
clientes_p AS (
  SELECT *, {_date_multi('fecha_registro')} AS fr_parsed FROM clientes_raw
),
clientes_t AS (
  SELECT CAST(id_cliente AS BIGINT) AS id_cliente,
         {initcap('nombre')} AS nombre,
         {_email('email')} AS email,
         {initcap('ciudad')} AS ciudad,
         CASE WHEN fr_parsed >= DATE '1900-01-01' AND fr_parsed <= {AS_OF_DATE} THEN fr_parsed END AS fecha_registro
  FROM clientes_p
),
clientes_flag AS (
  SELECT *, coalesce(id_cliente IS NOT NULL AND email IS NOT NULL
                     AND regexp_matches(email, '{EMAIL_RE}')
                     AND fecha_registro IS NOT NULL
                     AND fecha_registro >= DATE '1900-01-01' AND fecha_registro <= {AS_OF_DATE}, false) AS ok
  FROM clientes_t
),
dev_p AS (
  SELECT *, {_ts_multi('fecha_devolucion')} AS fd_parsed FROM devoluciones_raw
),
dev_t AS (
  SELECT {_long('id_devolucion')} AS id_devolucion,
         {_long('id_venta')} AS id_venta,
         {_motivo('motivo')} AS motivo,
         CASE WHEN fd_parsed >= TIMESTAMP '2000-01-01' AND fd_parsed <= CAST({AS_OF_DATE} AS TIMESTAMP)
              THEN fd_parsed END AS fecha_devolucion
  FROM dev_p
),
dev_clean AS (SELECT * FROM dev_t WHERE id_devolucion IS NOT NULL),
prod_t AS (
  SELECT {_long('id_producto')} AS id_producto,
         {initcap('nombre')} AS nombre,
         {initcap('categoria')} AS categoria,
         {_pos_amount('precio')} AS precio,
         _created_at
  FROM productos_raw
),
prod_clean AS (SELECT * FROM prod_t WHERE id_producto IS NOT NULL AND coalesce(precio > 0, false)),
tienda_t AS (
  SELECT {_long('id_tienda')} AS id_tienda,
         {initcap('nombre')} AS nombre,
         {initcap('ciudad')} AS ciudad,
         upper(trim(region)) AS region,
         _created_at
  FROM tiendas_raw
),
tienda_clean AS (SELECT * FROM tienda_t WHERE id_tienda IS NOT NULL)"""


def _scd(src: str, keys: list[str], seq: str, cols: list[str]) -> str:
    rest = [c for c in cols if c not in keys and c != seq]
    order = ", ".join([f"{seq} DESC NULLS LAST"] + [f"{c} DESC NULLS LAST" for c in rest])
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT {', '.join(cols)} FROM {src} WHERE {nn} "
            f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")


VENTAS_COLS = ["id_venta", "id_cliente", "id_tienda", "id_producto", "cantidad", "monto",
               "fecha_venta", "updated_at", "anio_mes"]
CLIENTES_COLS = ["id_cliente", "nombre", "email", "ciudad", "fecha_registro"]
DEV_COLS = ["id_devolucion", "id_venta", "motivo", "fecha_devolucion"]
PROD_COLS = ["id_producto", "nombre", "categoria", "precio", "_created_at"]
TIENDA_COLS = ["id_tienda", "nombre", "ciudad", "region", "_created_at"]

SILVER = f"""
silver_ventas AS ({_scd('ventas_clean', ['id_venta', 'id_producto'], 'updated_at', VENTAS_COLS)}),
clientes_validos AS (SELECT {', '.join(CLIENTES_COLS)} FROM clientes_flag WHERE ok),
silver_clientes AS ({_scd('clientes_validos', ['id_cliente'], 'fecha_registro', CLIENTES_COLS)}),
silver_devoluciones AS ({_scd('dev_clean', ['id_devolucion'], 'fecha_devolucion', DEV_COLS)}),
silver_productos AS ({_scd('prod_clean', ['id_producto'], '_created_at', PROD_COLS)}),
silver_tiendas AS ({_scd('tienda_clean', ['id_tienda'], '_created_at', TIENDA_COLS)}),
dim_tiempo AS (
  SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         CAST(day(fecha) AS INTEGER) AS dia,
         strftime(fecha, '%Y-%m') AS anio_mes, strftime(fecha, '%B') AS nombre_mes,
         CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana, strftime(fecha, '%A') AS nombre_dia,
         CAST(quarter(fecha) AS INTEGER) AS trimestre, {AS_OF_TS} AS creation_date
  FROM (SELECT DISTINCT CAST(fecha_venta AS DATE) AS fecha FROM silver_ventas WHERE fecha_venta IS NOT NULL)
),
ventas_f AS (SELECT *, CAST(fecha_venta AS DATE) AS fecha FROM silver_ventas),
tagged AS (
  SELECT v.*,
    EXISTS (SELECT 1 FROM silver_clientes d WHERE d.id_cliente = v.id_cliente) AS ok_cliente,
    EXISTS (SELECT 1 FROM silver_tiendas d WHERE d.id_tienda = v.id_tienda) AS ok_tienda,
    EXISTS (SELECT 1 FROM silver_productos d WHERE d.id_producto = v.id_producto) AS ok_producto,
    EXISTS (SELECT 1 FROM dim_tiempo d WHERE d.fecha = v.fecha) AS ok_tiempo
  FROM ventas_f v
)"""

PREFIX = ("WITH " + ",".join([VENTAS_RAW, CLIENTES_RAW, DEVOLUCIONES_RAW, PRODUCTOS_RAW,
                               TIENDAS_RAW, CLEAN, SILVER]) + "\n")

REJECT_COLS = (f"id_venta, id_producto AS id_producto_source, id_cliente AS id_cliente_source, "
               f"id_tienda AS id_tienda_source, fecha_venta")


def _reject(reason: str) -> str:
    return f"SELECT {REJECT_COLS}, '{reason}' AS reason, {AS_OF_TS} AS creation_date FROM tagged WHERE NOT ok_{reason}"


_DECODED = f"coalesce({_words_case('cantidad')}, cantidad)"

FINAL = {
    "clean_ventas": "SELECT * FROM ventas_clean",
    "cast_final": "SELECT id_venta, id_cliente, id_tienda, id_producto FROM ventas_t",
    "decode_cantidad": f"SELECT id_venta AS id_venta_raw, cantidad AS cantidad_raw, "
                       f"{_pos_int(_DECODED)} AS cantidad FROM ventas_raw",
    "clean_monto": f"SELECT id_venta AS id_venta_raw, monto AS monto_raw, {_pos_amount('monto')} AS monto FROM ventas_raw",
    "parse_ts_three": f"SELECT id_venta AS id_venta_raw, fecha_venta AS fecha_raw, {_ts_three('fecha_venta')} AS fecha_venta, "
                      f"{_ts_three('updated_at')} AS updated_at FROM ventas_raw",
    "anio_mes": "SELECT id_venta, id_producto, anio_mes FROM ventas_clean",
    "parse_fecha_multi": "SELECT id_cliente, fecha_registro AS fecha_raw, fr_parsed AS fecha_registro FROM clientes_p",
    "range_null_date": f"SELECT id_cliente, fr_parsed AS fecha_parsed, "
                       f"CASE WHEN fr_parsed >= DATE '1900-01-01' AND fr_parsed <= {AS_OF_DATE} "
                       f"THEN fr_parsed END AS fecha_registro FROM clientes_p",
    "parse_ts_multi": "SELECT id_devolucion AS id_devolucion_raw, fecha_devolucion AS fecha_raw, "
                      "fd_parsed AS fecha_devolucion FROM dev_p",
    "range_null_ts": f"SELECT id_devolucion AS id_devolucion_raw, fd_parsed AS fecha_parsed, "
                     f"CASE WHEN fd_parsed >= TIMESTAMP '2000-01-01' AND fd_parsed <= CAST({AS_OF_DATE} AS TIMESTAMP) "
                     f"THEN fd_parsed END AS fecha_devolucion FROM dev_p",
    "clean_title": "SELECT id_cliente, nombre, ciudad FROM clientes_t",
    "clean_code": "SELECT id_tienda, region FROM tienda_t",
    "clean_email": f"SELECT id_cliente, email AS email_raw, {_email('email')} AS email FROM clientes_raw",
    "clean_motivo": f"SELECT id_devolucion AS id_devolucion_raw, motivo AS motivo_raw, {_motivo('motivo')} AS motivo "
                    f"FROM devoluciones_raw",
    "clean_precio": f"SELECT id_producto AS id_producto_raw, precio AS precio_raw, {_pos_amount('precio')} AS precio "
                    f"FROM productos_raw",
    "clean_clientes": "SELECT * FROM clientes_t",
    "clean_devoluciones": "SELECT * FROM dev_clean",
    "clean_productos": "SELECT * FROM prod_clean",
    "clean_tiendas": "SELECT * FROM tienda_clean",
    "clientes_validos": "SELECT * FROM clientes_validos",
    "regex_filter": f"SELECT id_cliente, email FROM clientes_t WHERE regexp_matches(email, '{EMAIL_RE}')",
    "scd1_ventas": "SELECT * FROM silver_ventas",
    "scd1_clientes": "SELECT * FROM silver_clientes",
    "scd1_devoluciones": "SELECT * FROM silver_devoluciones",
    "scd1_productos": "SELECT * FROM silver_productos",
    "scd1_tiendas": "SELECT * FROM silver_tiendas",
    "dim_cliente": f"SELECT *, {AS_OF_TS} AS creation_date FROM silver_clientes",
    "dim_tienda": f"SELECT *, {AS_OF_TS} AS creation_date FROM silver_tiendas",
    "dim_producto": f"SELECT *, {AS_OF_TS} AS creation_date FROM silver_productos",
    "dim_tiempo": "SELECT * FROM dim_tiempo",
    "fact_ventas": f"SELECT id_cliente, id_tienda, id_producto, fecha, id_venta, cantidad, monto, fecha_venta, "
                   f"anio_mes, {AS_OF_TS} AS creation_date FROM tagged "
                   f"WHERE ok_cliente AND ok_tienda AND ok_producto AND ok_tiempo",
    "fact_join_expr": "SELECT v.* FROM ventas_f v WHERE EXISTS (SELECT 1 FROM dim_tiempo d WHERE d.fecha = v.fecha)",
    "reject_cliente": _reject("cliente"),
    "reject_tienda": _reject("tienda"),
    "reject_producto": _reject("producto"),
    "reject_tiempo": _reject("tiempo"),
    "fact_ventas_rechazadas": " UNION ".join(_reject(r) for r in ("cliente", "tienda", "producto", "tiempo")),
    "union_rejects": " UNION ".join(_reject(r) for r in ("cliente", "tienda", "producto", "tiempo")),
    "distinct_keys": "SELECT DISTINCT id_tienda FROM silver_tiendas",
}


def _quarantine_reasons() -> str:
    in_range = f"fecha_registro >= DATE '1900-01-01' AND fecha_registro <= {AS_OF_DATE}"
    parts = [
        "CASE WHEN id_cliente IS NULL THEN 'ID cliente faltante' END",
        "CASE WHEN email IS NULL THEN 'Email faltante' END",
        f"CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL_RE}') THEN 'Email formato inválido' END",
        "CASE WHEN fecha_registro IS NULL THEN 'Fecha registro faltante' END",
        f"CASE WHEN fecha_registro IS NOT NULL AND NOT ({in_range}) THEN 'Fecha registro fuera de rango' END",
    ]
    return "concat_ws(', ', " + ", ".join(parts) + ")"


FINAL["quarantine_reasons"] = f"SELECT id_cliente, {_quarantine_reasons()} AS razones_rechazo FROM clientes_t"
FINAL["clientes_cuarentena"] = (
    f"SELECT {', '.join(CLIENTES_COLS)}, {_quarantine_reasons()} AS razones_rechazo, "
    f"{AS_OF_TS} AS fecha_cuarentena, 'PENDIENTE_REVISION' AS estado FROM clientes_flag WHERE NOT ok")
FINAL["clientes_cuarentena_stream"] = FINAL["clientes_cuarentena"]


def _metrics(src: str, rules: list[tuple[str, str, str]]) -> str:
    """rules: (name, action, sql condition). NULL counts as failed."""
    sel = []
    for name, action, cond in rules:
        failed = f"count(*) FILTER (WHERE NOT coalesce({cond}, false))"
        sel.append(f"SELECT '{name}' AS rule, '{action}' AS action, "
                   f"count(*) - {failed} AS passed_records, {failed} AS failed_records FROM {src}")
    return " UNION ALL ".join(sel)


CLIENTES_WARN = [
    ("warning_id_cliente_null", "warn", "id_cliente IS NOT NULL"),
    ("warning_email_null", "warn", "email IS NOT NULL"),
    ("warning_email_format", "warn", f"regexp_matches(email, '{EMAIL_RE}')"),
    ("warning_fecha_registro_null", "warn", "fecha_registro IS NOT NULL"),
    ("warning_fecha_registro_valida", "warn",
     f"fecha_registro >= DATE '1900-01-01' AND fecha_registro <= {AS_OF_DATE}"),
]
VENTAS_DROP = [("valid_id_venta", "drop", "id_venta IS NOT NULL"),
               ("valid_id_producto", "drop", "id_producto IS NOT NULL")]
PROD_DROP = [("valid_id_producto", "drop", "id_producto IS NOT NULL"),
             ("valid_precio", "drop", "precio > 0")]
DEV_DROP = [("valid_id_devolucion", "drop", "id_devolucion IS NOT NULL")]
TIENDA_DROP = [("valid_id_tienda", "drop", "id_tienda IS NOT NULL")]

FINAL["expect_warn_metrics"] = _metrics("clientes_t", CLIENTES_WARN)
FINAL["expect_drop_ventas"] = _metrics("ventas_t", VENTAS_DROP)
FINAL["expect_drop_productos"] = _metrics("prod_t", PROD_DROP)
FINAL["expectation_metrics"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_metrics(src, rules)})"
    for table, src, rules in [
        ("bronze.ventas_clean", "ventas_t", VENTAS_DROP),
        ("bronze.clientes_clean", "clientes_t", CLIENTES_WARN),
        ("bronze.devoluciones_clean", "dev_t", DEV_DROP),
        ("bronze.productos_clean", "prod_t", PROD_DROP),
        ("bronze.tiendas_clean", "tienda_t", TIENDA_DROP),
    ])
FINAL["constraint_set_ventas"] = ("SELECT * FROM ventas_clean WHERE coalesce(cantidad > 0, false) "
                                  "AND coalesce(monto >= 0, false)")

FINAL["constraint_set_clientes"] = f"SELECT * FROM clientes_t WHERE id_cliente IS NOT NULL AND coalesce(regexp_matches(email, '{EMAIL_RE}'), false)"
FINAL["constraint_set_comun"] = (
    f"SELECT * FROM (SELECT {_long('id_producto')} AS id_producto, try_cast(trim(precio) AS DOUBLE) AS precio "
    "FROM productos_raw WHERE id_producto IS NOT NULL) WHERE precio IS NULL OR precio >= 0")


# A CSV field holding empty text reads back as NULL (Spark's CSV source,
# default options, like the reference's reader), hence the nullif.
def _nz(cols: str) -> str:
    return ", ".join(f"nullif({c.strip()}, '') AS {c.strip()}" for c in cols.split(","))


FINAL["ingest_stream_clientes"] = (
    f"SELECT id_cliente, {_nz('nombre, email, ciudad, fecha_registro')}, _lote FROM clientes_raw")
FINAL["ingest_stream_raw"] = (
    f"SELECT {_nz('id_devolucion, id_venta, motivo, fecha_devolucion')}, _lote FROM devoluciones_raw")
FINAL["ingest_multi_pattern"] = (
    f"SELECT {_nz('id_venta, id_cliente, id_tienda, id_producto, cantidad, monto, fecha_venta, updated_at')}, "
    "CASE _lote WHEN 0 THEN 'ventas' WHEN 1 THEN 'fact_sales' ELSE 'sales' END AS familia FROM ventas_raw")
FINAL["ingest_header_order"] = FINAL["ingest_multi_pattern"].replace(
    "CASE _lote WHEN 0", "CASE WHEN _lote = 1 THEN 'c' || id_venta END AS canal, CASE _lote WHEN 0")
FINAL["audit_columns"] = "SELECT id_cliente, _lote, true AS has_src_file, true AS has_created_at FROM clientes_raw"
FINAL["ingest_routed"] = FINAL["ingest_stream_raw"]
FINAL["gold_job"] = FINAL["fact_ventas"]
FINAL["scd1_ventas_stream"] = "SELECT * FROM silver_ventas"
FINAL["scd1_clientes_stream"] = "SELECT * FROM silver_clientes"
FINAL["scd1_devoluciones_stream"] = "SELECT * FROM silver_devoluciones"
# the stream's sequence is the load time; the second load is the later one here too
FINAL["scd1_productos_stream"] = "SELECT id_producto, nombre, categoria, precio FROM silver_productos"
FINAL["scd1_tiendas_stream"] = "SELECT id_tienda, nombre, ciudad, region FROM silver_tiendas"

_V_CLEAN_L = ("SELECT id_venta, id_cliente, id_tienda, id_producto, cantidad, monto, fecha_venta, updated_at, "
              "strftime(fecha_venta, '%Y-%m') AS anio_mes, _lote FROM ventas_t "
              "WHERE id_venta IS NOT NULL AND id_producto IS NOT NULL")
_STATE0 = _scd("vcl0", ["id_venta", "id_producto"], "updated_at", VENTAS_COLS)
_STATE1 = _scd("vcl", ["id_venta", "id_producto"], "updated_at", VENTAS_COLS)
FINAL["ingestion_log"] = f"""
, vcl AS ({_V_CLEAN_L}),
vcl0 AS (SELECT * FROM vcl WHERE _lote IN (0, 1)),
st0 AS ({_STATE0}),
st1 AS ({_STATE1}),
cmp AS (
  SELECT st0.id_venta AS k0, st1.id_venta AS k1,
         (st0.id_cliente, st0.id_tienda, st0.cantidad, st0.monto, st0.fecha_venta, st0.updated_at, st0.anio_mes)
           IS DISTINCT FROM
         (st1.id_cliente, st1.id_tienda, st1.cantidad, st1.monto, st1.fecha_venta, st1.updated_at, st1.anio_mes) AS changed
  FROM st0 FULL OUTER JOIN st1 ON st0.id_venta = st1.id_venta AND st0.id_producto = st1.id_producto
)
SELECT 'silver.ventas' AS "table", 'silver' AS layer, CAST(0 AS BIGINT) AS version,
       (SELECT count(*) FROM ventas_raw WHERE _lote IN (0, 1)) AS rows_in,
       (SELECT count(*) FROM st0) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
       CAST(0 AS BIGINT) AS rows_deleted, true AS has_file_bytes
UNION ALL
SELECT 'silver.ventas', 'silver', CAST(1 AS BIGINT),
       (SELECT count(*) FROM ventas_raw WHERE _lote = 2),
       (SELECT count(*) FROM cmp WHERE k0 IS NULL),
       (SELECT count(*) FROM cmp WHERE k0 IS NOT NULL AND k1 IS NOT NULL AND changed),
       (SELECT count(*) FROM cmp WHERE k1 IS NULL), true"""

_ROUTE = {
    "ventas": "bronze.ventas_raw", "clientes": "bronze.clientes_raw", "productos": "bronze.productos_raw",
    "tiendas": "bronze.tiendas_raw", "devoluciones": "bronze.devoluciones_raw",
}


def _route_rows() -> str:
    parts = [
        "SELECT DISTINCT CASE _lote WHEN 0 THEN 'ventas' WHEN 1 THEN 'fact_sales' ELSE 'sales' END AS familia, "
        "_lote FROM ventas_raw"]
    for feed in ("clientes", "productos", "tiendas", "devoluciones"):
        parts.append(f"SELECT DISTINCT '{feed}' AS familia, _lote FROM {feed}_raw")
    return " UNION ALL ".join(parts)


FINAL["route_files"] = (
    "SELECT DISTINCT f.familia, f._lote, "
    "CASE WHEN f.familia IN ('fact_sales', 'sales') THEN NULL ELSE 'bronze.' || f.familia || '_raw' END AS target_table, "
    "CASE WHEN f.familia IN ('fact_sales', 'sales') THEN NULL ELSE 'CSV' END AS file_format, "
    "CASE WHEN f.familia IN ('fact_sales', 'sales') THEN NULL ELSE true END AS has_header, "
    "CASE WHEN f.familia IN ('fact_sales', 'sales') THEN NULL ELSE ',' END AS delimiter "
    f"FROM ({_route_rows()}) f")


FINAL["enforce_schema"] = ("SELECT *, CAST(NULL AS TIMESTAMP) AS _created_at, "
                           "CAST(NULL AS TIMESTAMP) AS _last_updated_at FROM silver_ventas")
for _t, _dim in (("silver_clientes", False), ("silver_devoluciones", False), ("silver_productos", False), ("silver_tiendas", False),
                 ("silver_clientes", True), ("silver_tiendas", True), ("silver_productos", True)):
    _key = {"silver_clientes": "cliente", "silver_tiendas": "tienda", "silver_productos": "producto"}.get(_t) if _dim else _t[7:]
    _created = "" if _t in ("silver_productos", "silver_tiendas") else "CAST(NULL AS TIMESTAMP) AS _created_at, "
    _date = f"{AS_OF_TS} AS creation_date, " if _dim else ""
    FINAL[f"enforce_schema_{'dim_' if _dim else ''}{_key}"] = f"SELECT *, {_date}{_created}CAST(NULL AS TIMESTAMP) AS _last_updated_at FROM {_t}"
FINAL["enforce_schema_ventas"] = FINAL["enforce_schema"]
FINAL["enforce_schema_dim_tiempo"] = ("SELECT *, CAST(NULL AS TIMESTAMP) AS _created_at, CAST(NULL AS TIMESTAMP) AS _last_updated_at "
                                      "FROM dim_tiempo")
FINAL["align_to_target"] = ("SELECT CAST(id_venta AS VARCHAR) AS id_venta, CAST(id_producto AS VARCHAR) AS id_producto, "
                            "CAST(monto AS VARCHAR) AS monto, CAST(fecha_venta AS VARCHAR) AS fecha_venta, "
                            "CAST(NULL AS VARCHAR) AS canal FROM ventas_clean")
FINAL["project_rename"] = ("SELECT id_cliente, nombre AS nombre_cliente, ciudad AS ciudad_cliente, email "
                           "FROM silver_clientes")


FINAL["ingest_mapped_stream"] = FINAL["ingest_multi_pattern"]
FINAL["ingest_unmatched"] = "SELECT DISTINCT 'proveedores' AS familia, _lote, true AS has_bytes FROM tiendas_raw"
_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
FINAL["ingest_inferred_stream"] = (
    "SELECT CAST(p_partkey AS BIGINT) AS id_articulo, CASE WHEN p_partkey % 150 = 2 THEN NULL ELSE CAST(p_size AS BIGINT) END AS existencias, "
    f"CASE WHEN p_partkey % 3 = 0 THEN CAST(floor({_PRICE}) AS DOUBLE) ELSE CAST({_PRICE} AS DOUBLE) END AS precio, "
    "CASE WHEN p_partkey % 3 = 2 THEN p_brand END AS marca, CASE WHEN p_partkey % 150 = 2 THEN 'agotado' END AS rescatado FROM part")
_D4 = "id_devolucion, id_venta, motivo, fecha_devolucion"
_D4_CELLS = ["coalesce(trim(%s), '')" % c for c in _D4.split(", ")]
_D4_LINE = " || ',' || ".join(_D4_CELLS)
FINAL["ingest_bad_rows"] = f"""
, r AS (SELECT *, TRY_CAST(id_devolucion AS BIGINT) % 50 AS kind FROM devoluciones_raw)
SELECT 'cargada' AS estado, {", ".join(f"nullif(trim({c}), '') AS {c}" for c in _D4.split(", "))}, CAST(NULL AS VARCHAR) AS registro
FROM r WHERE kind IS NULL OR kind > 2
UNION ALL
SELECT 'fila', NULL, NULL, NULL, NULL,
  CASE kind WHEN 0 THEN {_D4_CELLS[0]} || ',' || {_D4_CELLS[1]} WHEN 1 THEN {_D4_LINE} || ',sobra'
  ELSE {_D4_CELLS[0]} || ',' || {_D4_CELLS[1]} || ',"' || {_D4_CELLS[2]} || ',' || {_D4_CELLS[3]} END
FROM r WHERE kind <= 2
UNION ALL SELECT DISTINCT 'archivo', NULL, NULL, NULL, NULL, 'clave,nombre' FROM nation"""
FINAL["scd1_ventas_compacted"] = FINAL["scd1_ventas_stream"]
FINAL["dim_cliente_incremental"] = FINAL["dim_cliente"]
FINAL["gold_job_second_run"] = FINAL["fact_ventas"]
FINAL["fact_ventas_bucketed"] = FINAL["fact_ventas"]
FINAL["expectation_events"] = FINAL["expectation_metrics"]


def _count(key: str) -> str:
    return f"(SELECT count(*) FROM ({FINAL[key]}))"


_FAIL_CASES = (("ventas_todas", "valid_id_venta", None), ("ventas_limpias", None, "constraint_set_ventas"),
               ("clientes_todos", "valid_id_cliente", None), ("clientes_con_id", None, "constraint_set_clientes"))
FINAL["expect_fail_evidence"] = " UNION ALL ".join(
    f"SELECT '{case}' AS caso, CAST({f"'{rule}'" if rule else 'NULL'} AS VARCHAR) AS regla, {'true' if rule else 'false'} AS abortada, "
    f"CAST({_count(key) if key else 0} AS BIGINT) AS filas_confirmadas, CAST({_count(key) if key else 0} AS BIGINT) AS filas_guardadas"
    for case, rule, key in _FAIL_CASES)


def _log_layers() -> str:
    feeds = ("ventas", "clientes", "devoluciones", "productos", "tiendas")
    silver = {f: f"(SELECT count(*) FROM silver_{f})" for f in feeds}
    rows = [(f"bronze.{f}_raw", "bronze", f"(SELECT count(*) FROM {f}_raw)", f"(SELECT count(*) FROM {f}_raw)") for f in feeds]
    rows += [(f"silver.{f}", "silver", f"(SELECT count(*) FROM {f}_raw)", silver[f]) for f in feeds]
    dates = "(SELECT count(DISTINCT CAST(fecha_venta AS DATE)) FROM silver_ventas)"
    for name, added in (("cliente", silver["clientes"]), ("tienda", silver["tiendas"]), ("producto", silver["productos"]), ("tiempo", dates)):
        rows.append((f"gold.dim_{name}", "gold", added, added))
    rows += [(f"gold.{t}", "gold", silver["ventas"], _count(t)) for t in ("fact_ventas", "fact_ventas_rechazadas")]
    return " UNION ALL ".join(f"""SELECT '{t}' AS "table", '{layer}' AS layer, 'SUCCESS' AS job_status, CAST({n} AS BIGINT) AS rows_in,
        CAST({i} AS BIGINT) AS rows_inserted, true AS same_run""" for t, layer, n, i in rows)


FINAL["ingestion_log_layers"] = _log_layers()


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in FINAL.items():
        # a body starting with "," extends the CTE list of the prefix
        out[k] = (PREFIX.rstrip() + v) if v.lstrip().startswith(",") else PREFIX + v
    return out
