"""DuckDB SQL that computes the same results from the same Parquet tables, by other means."""

from __future__ import annotations

import re

ORDER = "l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_discount, l_returnflag, l_suppkey"
ORDER_DESC = ", ".join(f"{name} DESC" for name in ORDER.split(", "))

# White space as character codes, in the order of the reject rules.
SPACES = " || ".join(
    f"chr({code})"
    for code in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)

PARTS = {
    "raw_sales": """
        SELECT 'N-' || l_orderkey AS folio,
               CASE WHEN l_linenumber % 5 = 0 THEN strftime(l_shipdate, '%d/%m/%Y')
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fecha,
               CAST(l_partkey AS VARCHAR) AS producto_id,
               CASE WHEN l_orderkey % 401 = 0 THEN NULL WHEN l_orderkey % 397 = 0 THEN '0'
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS cantidad,
               CASE WHEN l_orderkey % 409 = 0 THEN 'por definir'
                    WHEN l_linenumber % 3 = 0 THEN '$' || precio ELSE precio END AS precio_unitario,
               CASE WHEN l_orderkey % 419 = 0 THEN 'Feria' WHEN l_returnflag = 'A' THEN ' whatsapp '
                    WHEN l_returnflag = 'N' THEN 'TIENDA' ELSE 'Tienda' END AS canal,
               l_orderkey // 50000 AS grupo, l.*
        FROM (SELECT *, CAST(CAST(CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE p_retailprice END
                             AS DECIMAL(10, 2)) AS VARCHAR) AS precio
              FROM lineitem JOIN part ON l_partkey = p_partkey) l""",
    "checked_sales": """
        SELECT *, CASE
            WHEN producto_id = '0' THEN 'producto_id debe ser mayor a 0: 0'
            WHEN cantidad IS NULL THEN 'cantidad vacío'
            WHEN cantidad = '0' THEN 'cantidad debe ser mayor a 0: 0'
            WHEN NOT regexp_full_match(precio_unitario, '[$]?[0-9]+[.][0-9]+')
                THEN 'precio_unitario no es una cantidad: ''' || precio_unitario || ''''
            WHEN lower(trim(canal)) NOT IN ('whatsapp', 'tienda') THEN 'canal desconocido: ''' || canal || ''''
            END AS motivo
        FROM raw_sales""",
    "good_sales": """
        SELECT folio, CAST(l_shipdate AS DATE) AS fecha, CAST(l_partkey AS INTEGER) AS producto_id,
               CAST(l_quantity AS INTEGER) AS cantidad,
               CAST(replace(precio_unitario, '$', '') AS DECIMAL(10, 2)) AS precio_unitario,
               CASE lower(trim(canal)) WHEN 'whatsapp' THEN 'WhatsApp' ELSE 'Tienda' END AS canal,
               {order}
        FROM checked_sales WHERE motivo IS NULL""",
    "ranked_sales": """
        SELECT *, row_number() OVER (PARTITION BY folio, producto_id ORDER BY {order_desc}) AS ultima,
               count(*) OVER (PARTITION BY folio, producto_id) AS copias
        FROM good_sales""",
    "sales": """
        SELECT folio, fecha, producto_id, cantidad, precio_unitario, canal, copias FROM ranked_sales WHERE ultima = 1""",
    "listed": """
        SELECT p_partkey // 1000 AS documento, p_partkey, 0 AS vuelta, p_name, p_brand, p_type, p_size, p_retailprice FROM part
        UNION ALL
        SELECT p_partkey // 1000, p_partkey, 1, p_name, p_brand, p_type, p_size, p_retailprice FROM part
        WHERE p_type = 'ECONOMY'""",
    "checked_products": """
        SELECT 'productos-' || documento AS archivo,
               CAST(row_number() OVER (PARTITION BY documento ORDER BY vuelta, p_partkey) AS INTEGER) AS linea,
               CAST(p_partkey AS INTEGER) AS producto_id, trim(p_name) AS nombre, p_brand AS marca, p_type AS tipo,
               CAST(CAST(p_retailprice AS DECIMAL(10, 2)) + vuelta AS DECIMAL(10, 2)) AS precio, vuelta, p_size,
               CASE WHEN p_partkey = 0 THEN 'id debe ser mayor a 0: 0' WHEN p_size = 48 THEN 'marca vacío'
                    WHEN p_size = 50 THEN 'precio vacío'
                    WHEN p_size = 49 THEN 'precio no es una cantidad: ''agotado''' END AS motivo
        FROM listed""",
    "good_products": """
        SELECT archivo, linea, producto_id, nombre, marca, tipo, precio, vuelta FROM checked_products WHERE motivo IS NULL""",
    "twice": """
        SELECT CASE WHEN producto_id % 17 = 0 THEN NULL ELSE folio END AS folio, producto_id,
               CASE WHEN producto_id % 11 = 0 THEN 0 ELSE cantidad END AS cantidad, CASE WHEN producto_id % 13 = 0 THEN NULL ELSE canal END AS canal
        FROM sales UNION ALL SELECT folio, producto_id, cantidad, canal FROM sales WHERE producto_id % 10 = 0""",
    "products": """
        SELECT producto_id, nombre, marca, tipo, precio FROM good_products g
        WHERE vuelta = (SELECT max(vuelta) FROM good_products o WHERE o.producto_id = g.producto_id)""",
    "order_days": """
        SELECT CAST(o_orderdate AS DATE) AS dia, count(*) AS n, min(o_orderkey) AS pedido, min(o_custkey) AS cliente
        FROM orders GROUP BY 1""",
    "weather_days": """
        SELECT dia AS fecha, 'clima-' || strftime(dia, '%Y-%m') AS archivo,
               CAST(row_number() OVER (PARTITION BY strftime(dia, '%Y-%m') ORDER BY dia) AS INTEGER) AS linea,
               CASE WHEN n % 5 <> 0 THEN CAST((cliente % 150 + 150) * 0.1 AS DECIMAL(4, 1)) END AS temp_max,
               CAST((cliente % 150 + 70) * 0.1 AS DECIMAL(4, 1)) AS temp_min,
               CASE WHEN n % 4 <> 0 THEN CAST((pedido % 40) * 0.1 AS DECIMAL(6, 1)) END AS lluvia_mm,
               n % 7 = 0 AS sin_datos
        FROM order_days WHERE day(dia) <> 31""",
    "weather": "SELECT fecha, temp_max, temp_min, lluvia_mm FROM weather_days WHERE NOT sin_datos",
    "dim_weather": """
        SELECT *, CASE WHEN lluvia_mm IS NULL THEN NULL ELSE lluvia_mm >= 1 END AS dia_lluvioso FROM weather""",
    "fx_days": """
        SELECT dia AS fecha, CAST((cliente % 50000 + 150000) * 0.0001 AS DECIMAL(10, 4)) AS usd_mxn,
               n % 11 = 0 OR n % 13 = 0 AS sin_tasa
        FROM order_days WHERE isodow(dia) <= 5 AND dia >= DATE '1995-03-01'""",
    "fx_rates": "SELECT fecha, usd_mxn FROM fx_days WHERE NOT sin_tasa",
    "priced_sales": """
        SELECT s.folio, s.producto_id, s.fecha, s.canal, s.cantidad, s.precio_unitario,
               CAST(s.cantidad * s.precio_unitario AS DECIMAL(12, 2)) AS total_mxn, r.usd_mxn
        FROM sales s ASOF LEFT JOIN fx_rates r ON s.fecha >= r.fecha""",
    "all_priced": """
        SELECT folio, producto_id, fecha,
               CASE dayofweek(fecha) WHEN 0 THEN 'Domingo' WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes'
                    WHEN 3 THEN 'Miércoles' WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' ELSE 'Sábado' END AS dia_semana,
               canal, cantidad, precio_unitario, total_mxn, usd_mxn,
               CAST(CAST((2 * CAST(total_mxn * 100 AS HUGEINT) * 10000 + CAST(usd_mxn * 10000 AS HUGEINT))
                         // (2 * CAST(usd_mxn * 10000 AS HUGEINT)) AS DECIMAL(14, 0)) * 0.01 AS DECIMAL(12, 2)) AS total_usd
        FROM priced_sales""",
    "fact": "SELECT * FROM all_priced WHERE producto_id IN (SELECT producto_id FROM products)",
    "daily": """
        SELECT f.fecha, f.dia_semana, count(DISTINCT f.folio) AS pedidos, CAST(sum(f.cantidad) AS BIGINT) AS piezas,
               CAST(sum(f.total_mxn) AS DECIMAL(22, 2)) AS ingreso_mxn,
               CAST(sum(f.total_usd) AS DECIMAL(22, 2)) AS ingreso_usd, max(f.usd_mxn) AS usd_mxn,
               w.temp_max, w.lluvia_mm, w.dia_lluvioso
        FROM fact f LEFT JOIN dim_weather w ON w.fecha = f.fecha
        GROUP BY f.fecha, f.dia_semana, w.temp_max, w.lluvia_mm, w.dia_lluvioso""",
    "ranking": """
        SELECT p.producto_id, p.nombre, p.marca, p.tipo, CAST(sum(f.cantidad) AS BIGINT) AS piezas,
               CAST(sum(f.total_mxn) AS DECIMAL(22, 2)) AS ingreso_mxn, count(DISTINCT f.folio) AS pedidos
        FROM fact f JOIN products p ON p.producto_id = f.producto_id
        GROUP BY p.producto_id, p.nombre, p.marca, p.tipo""",
    "counters": """
        SELECT 1 AS id, 'ventas_csv' AS fuente, (SELECT count(*) FROM checked_sales) AS leidas,
               (SELECT count(*) FROM checked_sales WHERE motivo IS NOT NULL) AS rechazadas,
               (SELECT CAST(coalesce(sum(copias - 1), 0) AS BIGINT) FROM sales) AS duplicadas,
               (SELECT count(*) FROM sales) AS cargadas
        UNION ALL
        SELECT 2, 'productos_json', (SELECT count(*) FROM checked_products),
               (SELECT count(*) FROM checked_products WHERE motivo IS NOT NULL),
               (SELECT count(*) FROM good_products) - (SELECT count(*) FROM products), (SELECT count(*) FROM products)
        UNION ALL
        SELECT 3, 'clima_api', (SELECT count(*) FROM weather_days), (SELECT count(*) FROM weather_days WHERE sin_datos),
               0, (SELECT count(*) FROM weather)
        UNION ALL
        SELECT 4, 'tipo_cambio_api', (SELECT count(*) FROM fx_days), (SELECT count(*) FROM fx_days WHERE sin_tasa),
               0, (SELECT count(*) FROM fx_rates)""",
    "rules": """
        SELECT 1 AS regla, 'Hay ventas cargadas' AS descripcion, true AS obligatoria,
               CASE WHEN (SELECT count(*) FROM sales) = 0 THEN 1 ELSE 0 END AS problemas
        UNION ALL SELECT 2, 'Hay productos cargados', true, CASE WHEN (SELECT count(*) FROM products) = 0 THEN 1 ELSE 0 END
        UNION ALL SELECT 3, 'Hay datos de clima', true, CASE WHEN (SELECT count(*) FROM weather) = 0 THEN 1 ELSE 0 END
        UNION ALL SELECT 4, 'Hay tipos de cambio', true, CASE WHEN (SELECT count(*) FROM fx_rates) = 0 THEN 1 ELSE 0 END
        UNION ALL SELECT 5, 'Toda venta es de un producto del catálogo', true,
               (SELECT count(*) FROM sales WHERE producto_id NOT IN (SELECT producto_id FROM products))
        UNION ALL SELECT 6, 'Todas las ventas de staging llegaron a fact_ventas', true,
               (SELECT count(*) FROM sales s WHERE NOT EXISTS
                   (SELECT 1 FROM fact f WHERE f.folio = s.folio AND f.producto_id = s.producto_id))
        UNION ALL SELECT 7, 'Toda venta tiene tipo de cambio', true, (SELECT count(*) FROM fact WHERE usd_mxn IS NULL)
        UNION ALL SELECT 8, 'El total en pesos cuadra con cantidad x precio', true,
               (SELECT count(*) FROM fact WHERE total_mxn <> cantidad * precio_unitario)
        UNION ALL SELECT 9, 'Ningún pedido tiene fecha futura', true,
               (SELECT count(*) FROM fact WHERE fecha > DATE '2001-06-01')
        UNION ALL SELECT 10, 'Los días con ventas tienen dato de clima', false,
               (SELECT count(DISTINCT f.fecha) FROM fact f LEFT JOIN weather w ON w.fecha = f.fecha WHERE w.lluvia_mm IS NULL)
        UNION ALL SELECT 11, 'Precio vendido igual al de lista (descuentos o cambios de precio)', false,
               (SELECT count(*) FROM fact f JOIN products p ON p.producto_id = f.producto_id
                WHERE f.precio_unitario <> p.precio)""",
}
PARTS = {name: text.replace("{order}", ORDER).replace("{order_desc}", ORDER_DESC) for name, text in PARTS.items()}


def _needs(sql: str) -> list[str]:
    """Named parts a text uses, in the order they must be defined."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if word in PARTS and word not in needed:
                visit(PARTS[word])
                needed.append(word)

    visit(sql)
    return needed


def _with_parts(sql: str) -> str:
    parts = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name]})" for name in _needs(sql))
    return f"WITH {parts}\n{sql}" if parts else sql


FIRST, SECOND = "'2026-09-12 07:00:00'", "'2026-09-13 07:00:00'"
RULE = "SELECT problemas FROM rules WHERE regla = {}"


_FACT_COLUMNS = (
    "folio, producto_id, fecha, dia_semana, canal, cantidad, precio_unitario, total_mxn, usd_mxn, total_usd"
)

QUERIES = {
    "scan_sales_csv": "SELECT grupo, folio, fecha, producto_id, cantidad, precio_unitario, canal FROM raw_sales",
    "scan_quoted_csv": f"""
        SELECT grupo, row_number() OVER (PARTITION BY grupo ORDER BY l_orderkey, {ORDER}) + 1 AS registro,
               CASE WHEN l_orderkey % 3 = 0 THEN folio || ', "a"' || chr(10) || CASE WHEN l_orderkey % 2 = 0 THEN chr(10) ELSE '' END || l_linenumber
                    WHEN l_orderkey % 5 = 0 THEN 'b, ' || folio ELSE folio END AS folio,
               fecha, producto_id, cantidad, precio_unitario, canal
        FROM raw_sales""",
    "sales_header_check": """
        SELECT columna, count(DISTINCT grupo) AS archivos FROM raw_sales,
               (SELECT unnest(['folio', 'fecha', 'producto_id', 'cantidad', 'precio_unitario', 'canal']) AS columna)
        GROUP BY columna""",
    "sales_record_no": f"""
        SELECT grupo, registro, folio, producto_id, motivo FROM (
            SELECT *, row_number() OVER (PARTITION BY grupo ORDER BY l_orderkey, {ORDER}) + 1 AS registro
            FROM checked_sales) n
        WHERE motivo IS NOT NULL""",
    "landing_roundtrip": f"""
        SELECT grupo, bytes, lineas, md5(lineas || '/' || s0 || '/' || s1) AS huella, true AS entera FROM (
            SELECT grupo, CAST(sum(strlen(linea) + 1) AS BIGINT) AS bytes, count(*) AS lineas,
                   sum(('0x' || substr(md5(n || ':' || linea), 1, 15))::BIGINT) AS s0,
                   sum(('0x' || substr(md5(n || ':' || linea), 17, 15))::BIGINT) AS s1
            FROM (
                SELECT grupo, row_number() OVER (PARTITION BY grupo ORDER BY l_orderkey, {ORDER}) + 1 AS n,
                       folio || ',' || fecha || ',' || producto_id || ',' || coalesce(cantidad, '') || ',' || precio_unitario || ',' || canal AS linea
                FROM raw_sales
                UNION ALL
                SELECT DISTINCT grupo, 1, 'folio,fecha,producto_id,cantidad,precio_unitario,canal' FROM raw_sales
            ) GROUP BY grupo
        )""",
    "payload_check": """
        SELECT DISTINCT 'cambio-' || strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS archivo,
               month(o_orderdate) IN (5, 6, 8, 11, 12) AS legible
        FROM orders
        WHERE isodow(o_orderdate) <= 5 AND CAST(o_orderdate AS DATE) >= DATE '1995-03-01'""",
    "scan_products_json": """
        SELECT producto_id::BIGINT AS id, linea,
               CASE WHEN p_size NOT IN (49, 50) THEN precio END AS precio
        FROM checked_products""",
    "weather_rows": "SELECT * FROM weather",
    "fx_rows": "SELECT * FROM fx_rates",
    "upsert_sales": f"""
        SELECT coalesce(b.folio, a.folio) AS folio, coalesce(b.fecha, a.fecha) AS fecha,
               coalesce(b.producto_id, a.producto_id) AS producto_id, coalesce(b.cantidad + 1, a.cantidad) AS cantidad,
               coalesce(b.precio_unitario, a.precio_unitario) AS precio_unitario, coalesce(b.canal, a.canal) AS canal,
               CASE WHEN b.folio IS NULL THEN {FIRST} ELSE {SECOND} END AS cargado_en
        FROM (SELECT * FROM good_sales WHERE l_shipdate < TIMESTAMP '1999-01-01'
              QUALIFY row_number() OVER (PARTITION BY folio, producto_id ORDER BY {ORDER_DESC}) = 1) a
        FULL JOIN (SELECT * FROM good_sales WHERE l_shipdate >= TIMESTAMP '1998-01-01'
                   QUALIFY row_number() OVER (PARTITION BY folio, producto_id ORDER BY {ORDER_DESC}) = 1) b
        ON a.folio = b.folio AND a.producto_id = b.producto_id""",
    "upsert_last_wins": f"SELECT *, {FIRST} AS cargado_en FROM products",
    "upsert_dim_product": f"""
        SELECT producto_id, nombre, marca, tipo, precio AS precio_lista,
               CASE WHEN tipo = 'ECONOMY' THEN {SECOND} ELSE {FIRST} END AS actualizado_en
        FROM products""",
    "upsert_dim_weather": f"""
        SELECT fecha, temp_max, temp_min, lluvia_mm, CASE WHEN lluvia_mm IS NOT NULL THEN lluvia_mm >= 1 END AS dia_lluvioso,
               actualizado_en
        FROM (SELECT fecha, temp_max, temp_min,
                     CAST(lluvia_mm + CASE WHEN fecha >= DATE '1998-01-01' THEN 1 ELSE 0 END AS DECIMAL(6, 1)) AS lluvia_mm,
                     CASE WHEN fecha >= DATE '1998-01-01' THEN {SECOND} ELSE {FIRST} END AS actualizado_en
              FROM weather) w""",
    "upsert_fact": f"""
        SELECT {_FACT_COLUMNS}, CASE WHEN fecha >= DATE '1998-01-01' THEN {SECOND} ELSE {FIRST} END AS actualizado_en
        FROM fact""",
    "load_counters": "SELECT fuente, leidas, rechazadas, duplicadas, cargadas FROM counters",
    "load_audit": f"""
        SELECT CAST(id AS BIGINT) AS id, 'corrida-1' AS run_id, fuente, 'crudo/' || fuente AS archivo_crudo,
               leidas AS filas_leidas, rechazadas AS filas_rechazadas, duplicadas AS filas_duplicadas,
               cargadas AS filas_cargadas, {FIRST} AS cargado_en
        FROM counters ORDER BY id DESC""",
    "rerun_idempotent": "SELECT count(*) AS filas, count(*) AS iguales, count(*) AS recargadas FROM sales",
    "rerun_whole_run": """
        SELECT tabla, filas, filas AS iguales FROM (
            SELECT 'staging.ventas' AS tabla, count(*) AS filas FROM sales UNION ALL
            SELECT 'staging.productos', count(*) FROM products UNION ALL
            SELECT 'staging.clima', count(*) FROM weather UNION ALL
            SELECT 'staging.tipo_cambio', count(*) FROM fx_rates UNION ALL
            SELECT 'analytics.dim_producto', count(*) FROM products UNION ALL
            SELECT 'analytics.dim_clima', count(*) FROM weather UNION ALL
            SELECT 'analytics.fact_ventas', count(*) FROM sales JOIN products USING (producto_id)) n""",
    "clean_text": f"""
        SELECT conv_id, turn, md5(limpio) AS huella, CAST(length(limpio) AS INTEGER) AS largo,
               CASE WHEN limpio = '' THEN 'texto vacío' END AS motivo
        FROM (SELECT conv_id, turn, CASE WHEN turn = 7 THEN '' ELSE trim(text, {SPACES}) END AS limpio FROM conversations) c""",
    "clean_positive_int": """
        SELECT texto, CASE WHEN motivo IS NULL THEN CAST(numero AS INTEGER) END AS valor, motivo, count(*) AS n
        FROM (
            SELECT texto, numero, CASE
                WHEN texto = ' ' THEN 'cantidad vacío'
                WHEN suffix(texto, '.0') THEN 'cantidad no es un número entero: ''' || texto || ''''
                WHEN numero <= 0 THEN 'cantidad debe ser mayor a 0: ' || numero END AS motivo
            FROM (
                SELECT CASE l_linenumber WHEN 1 THEN '+' || l_partkey WHEN 2 THEN '00' || l_partkey
                           WHEN 3 THEN l_partkey || '_000' WHEN 4 THEN l_partkey || '.0' WHEN 5 THEN '-' || l_partkey
                           WHEN 6 THEN ' ' || l_partkey || chr(9) ELSE ' ' END AS texto,
                       CASE l_linenumber WHEN 3 THEN l_partkey * 1000 WHEN 5 THEN -l_partkey ELSE l_partkey END AS numero
                FROM lineitem) a) b
        GROUP BY ALL""",
    "clean_money": """
        SELECT texto, CASE WHEN motivo IS NULL THEN valor END AS valor, motivo, count(*) AS n
        FROM (
            SELECT texto, CAST(CAST(centavos AS DECIMAL(12, 0)) * 0.01 AS DECIMAL(10, 2)) AS valor,
                   CASE WHEN texto = 'por definir' THEN 'precio no es una cantidad: ''por definir'''
                        WHEN texto = 'NaN' OR prefix(texto, '-') THEN 'precio debe ser mayor a 0: ''' || texto || ''''
                   END AS motivo
            FROM (
                SELECT CASE l_linenumber WHEN 1 THEN p WHEN 2 THEN ' $ ' || p WHEN 3 THEN p || '5'
                           WHEN 4 THEN regexp_replace(regexp_replace(p, '([0-9])([0-9]{3})[.]', '\\1,\\2.'),
                                                      '([0-9])([0-9]{3}),', '\\1,\\2,')
                           WHEN 5 THEN CAST(l_quantity AS BIGINT) || 'e1' WHEN 6 THEN '-' || p
                           ELSE CASE WHEN l_quantity > 25 THEN 'NaN' ELSE 'por definir' END END AS texto,
                       CASE l_linenumber WHEN 3 THEN c + c % 2 WHEN 5 THEN CAST(l_quantity AS BIGINT) * 1000 ELSE c END AS centavos
                FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) AS VARCHAR) AS p,
                             CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) * 100 AS BIGINT) AS c FROM lineitem) l) a) b
        GROUP BY ALL""",
    "clean_date": """
        SELECT texto, valor, CASE WHEN valor IS NULL THEN 'fecha no es una fecha válida: ''' || texto || '''' END AS motivo,
               count(*) AS n
        FROM (
            SELECT CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y')
                       WHEN 3 THEN year(l_shipdate) || '-' || month(l_shipdate) || '-' || day(l_shipdate)
                       WHEN 4 THEN day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate)
                       WHEN 5 THEN strftime(l_shipdate, '%Y-30-%d') WHEN 6 THEN '31/' || month(l_shipdate) || '/' || year(l_shipdate)
                       ELSE strftime(l_shipdate, '%d/%m/%y') END AS texto,
                   CASE WHEN l_linenumber BETWEEN 1 AND 4 THEN CAST(l_shipdate AS DATE)
                        WHEN l_linenumber = 6 AND month(l_shipdate) IN (1, 3, 5, 7, 8, 10, 12)
                            THEN make_date(year(l_shipdate), month(l_shipdate), 31) END AS valor
            FROM lineitem) a
        GROUP BY ALL""",
    "clean_channel": """
        SELECT canal AS texto, CASE lower(trim(canal)) WHEN 'whatsapp' THEN 'WhatsApp' WHEN 'tienda' THEN 'Tienda' END AS valor,
               CASE WHEN canal = 'Feria' THEN 'canal desconocido: ''Feria''' END AS motivo, count(*) AS n
        FROM raw_sales GROUP BY ALL""",
    "sales_rejects": "SELECT l_orderkey, l_linenumber, folio, producto_id, motivo FROM checked_sales WHERE motivo IS NOT NULL",
    "product_rejects": "SELECT archivo, linea, motivo FROM checked_products WHERE motivo IS NOT NULL",
    "products_clean": "SELECT archivo, linea, producto_id, nombre, marca, tipo, precio FROM good_products",
    "weather_rejects": """
        SELECT archivo, linea, strftime(fecha, '%Y-%m-%d') || ': sin datos todavía' AS motivo
        FROM weather_days WHERE sin_datos""",
    "fx_rejects": """
        SELECT strftime(fecha, '%Y-%m-%d') AS linea, strftime(fecha, '%Y-%m-%d') || ': sin tipo de cambio MXN' AS motivo
        FROM fx_days WHERE sin_tasa""",
    "weekday_name": "SELECT fecha, any_value(dia_semana) AS dia_semana, count(*) AS ventas FROM all_priced GROUP BY fecha",
    "line_total": "SELECT folio, producto_id, total_mxn FROM priced_sales",
    "sales_usd": "SELECT folio, producto_id, total_usd FROM all_priced",
    "rainy_flag": "SELECT * FROM dim_weather",
    "sales_enriched": """
        SELECT s.folio, s.fecha, s.producto_id, s.cantidad, s.precio_unitario, s.canal
        FROM sales s JOIN products p ON p.producto_id = s.producto_id""",
    "asof_fx": """
        SELECT l.l_orderkey, l.l_linenumber, l.fecha, r.usd_mxn
        FROM (SELECT *, CAST(l_shipdate AS DATE) AS fecha FROM lineitem) l
        ASOF LEFT JOIN fx_rates r ON l.fecha >= r.fecha""",
    "sales_dedup": "SELECT folio, fecha, producto_id, cantidad, precio_unitario, canal, copias FROM sales",
    "products_dedup": "SELECT * FROM products",
    "fact_sales": "SELECT * FROM fact",
    "daily_report": "SELECT * FROM daily",
    "product_ranking": "SELECT * FROM ranking ORDER BY ingreso_mxn DESC, producto_id",
    "sales_by_rain": """
        SELECT clima, dias, CAST(CAST((20 * pedidos + dias) // (2 * dias) AS DECIMAL(18, 0)) * 0.1 AS DECIMAL(20, 1)) AS pedidos_promedio,
               CAST(CAST((2 * centavos + dias) // (2 * dias) AS DECIMAL(26, 0)) * 0.01 AS DECIMAL(28, 2)) AS ingreso_promedio_mxn
        FROM (SELECT CASE WHEN dia_lluvioso THEN 'Con lluvia' WHEN NOT dia_lluvioso THEN 'Sin lluvia'
                          ELSE 'Sin dato de clima' END AS clima,
                     count(*) AS dias, CAST(sum(pedidos) AS HUGEINT) AS pedidos,
                     CAST(sum(ingreso_mxn) * 100 AS HUGEINT) AS centavos
              FROM daily GROUP BY 1) g
        ORDER BY clima""",
    "summary_totals": """
        SELECT count(DISTINCT folio) AS pedidos, CAST(coalesce(sum(cantidad), 0) AS BIGINT) AS piezas,
               CAST(coalesce(sum(total_mxn), 0) AS DECIMAL(22, 2)) AS ingreso_mxn,
               CAST(coalesce(sum(total_usd), 0) AS DECIMAL(22, 2)) AS ingreso_usd, min(fecha) AS desde, max(fecha) AS hasta
        FROM fact""",
    "last_7_days": """
        SELECT fecha, dia_semana, pedidos, piezas, ingreso_mxn, ingreso_usd, temp_max, lluvia_mm
        FROM daily ORDER BY fecha DESC LIMIT 7""",
    "top_products": """
        SELECT nombre, piezas, ingreso_mxn FROM ranking ORDER BY ingreso_mxn DESC, producto_id LIMIT 3""",
    "dq_nonempty": """
        SELECT CASE regla WHEN 1 THEN 'ventas' WHEN 2 THEN 'productos' WHEN 3 THEN 'clima' ELSE 'tipo_cambio' END AS tabla,
               CAST(problemas AS BIGINT) AS problemas
        FROM rules WHERE regla <= 4""",
    "dq_unknown_product": RULE.format(5),
    "dq_missing_in_fact": RULE.format(6),
    "dq_missing_fx": RULE.format(7),
    "dq_total_mismatch": RULE.format(8),
    "dq_future_day": RULE.format(9),
    "dq_days_without_weather": RULE.format(10),
    "dq_price_vs_list": RULE.format(11),
    "dq_report": """
        SELECT regla, descripcion, obligatoria, CAST(problemas AS BIGINT) AS problemas,
               CASE WHEN problemas = 0 THEN 'OK' WHEN obligatoria THEN 'FALLA' ELSE 'AVISO' END AS estado
        FROM rules""",
    "constraint_report": """
        SELECT tabla, restriccion, CASE WHEN restriccion = 'producto_id existe en el catálogo'
                    THEN (SELECT count(*) FROM sales WHERE producto_id NOT IN (SELECT producto_id FROM products))
                    ELSE 0 END AS problemas
        FROM (
            SELECT tabla, unnest(restricciones) AS restriccion FROM (
                SELECT 'staging.ventas' AS tabla, ['folio no nulo', 'fecha no nulo', 'producto_id no nulo', 'cantidad no nulo',
                    'precio_unitario no nulo', 'canal no nulo', 'cargado_en no nulo', 'cantidad mayor a 0',
                    'precio_unitario mayor a 0', 'llave única (folio, producto_id)'] AS restricciones
                UNION ALL SELECT 'staging.productos', ['producto_id no nulo', 'nombre no nulo', 'marca no nulo', 'tipo no nulo',
                    'precio no nulo', 'cargado_en no nulo', 'precio mayor a 0', 'llave única (producto_id)']
                UNION ALL SELECT 'staging.clima', ['fecha no nulo', 'cargado_en no nulo', 'llave única (fecha)']
                UNION ALL SELECT 'staging.tipo_cambio', ['fecha no nulo', 'usd_mxn no nulo', 'cargado_en no nulo',
                    'usd_mxn mayor a 0', 'llave única (fecha)']
                UNION ALL SELECT 'analytics.dim_producto', ['producto_id no nulo', 'nombre no nulo', 'marca no nulo',
                    'tipo no nulo', 'precio_lista no nulo', 'actualizado_en no nulo', 'llave única (producto_id)']
                UNION ALL SELECT 'analytics.dim_clima', ['fecha no nulo', 'actualizado_en no nulo', 'llave única (fecha)']
                UNION ALL SELECT 'analytics.fact_ventas', ['folio no nulo', 'producto_id no nulo', 'fecha no nulo',
                    'dia_semana no nulo', 'canal no nulo', 'cantidad no nulo', 'precio_unitario no nulo',
                    'total_mxn no nulo', 'actualizado_en no nulo', 'llave única (folio, producto_id)',
                    'producto_id existe en el catálogo']) t) u""",
    "adhoc_query": """
        SELECT producto_id, count(*) AS ventas, CAST(sum(cantidad) AS BIGINT) AS piezas, max(precio_unitario) AS precio_max
        FROM sales WHERE fecha BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' AND canal = 'WhatsApp' AND cantidad >= 10
        GROUP BY producto_id""",
    "window_end": """
        SELECT strftime(m, '%Y-%m-%d %H:%M:%S') AS momento, CAST(timezone('America/Mexico_City', timezone('UTC', m)) AS DATE) - 1 AS fin, count(*) AS n
        FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(CASE WHEN o_orderkey % 2 = 0 THEN 18000 ELSE 21600 END - 2 + o_orderkey % 5) AS m FROM orders)
        GROUP BY m""",
    "precision_limits": """
        SELECT 'staging.ventas' AS tabla, unnest(['producto_id', 'cantidad', 'precio_unitario']) AS columna, unnest(['int', 'int', 'decimal(10,2)']) AS tipo,
               unnest([0, count(*) FILTER (WHERE piezas > 2147483647), count(*) FILTER (WHERE round(precio, 2) > 99999999.99)]) AS problemas
        FROM (SELECT CASE WHEN l_orderkey % 41 = 0 THEN 100000000 ELSE 1 END * CAST(l_quantity AS BIGINT) AS piezas,
                     CASE WHEN l_orderkey % 37 = 0 THEN 5000 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12, 3)) AS precio FROM lineitem)
        UNION ALL
        SELECT 'staging.tipo_cambio', 'usd_mxn', 'decimal(10,4)', count(*) FILTER (WHERE o_custkey % 50000 * 60 > 999999) FROM orders""",
    "dq_broken": """
        SELECT 'vacía' AS caso, unnest([1, 2, 3, 4]) AS regla, CAST(1 AS BIGINT) AS problemas
        UNION ALL SELECT 'alterada', 5, (SELECT count(*) FROM sales WHERE producto_id NOT IN (SELECT producto_id FROM products WHERE producto_id % 5 <> 0))
        UNION ALL SELECT 'alterada', 6, (SELECT count(*) FROM sales) - (SELECT count(*) FROM fact WHERE producto_id % 11 <> 0)
        UNION ALL SELECT 'alterada', 8, (SELECT count(*) FROM fact WHERE producto_id % 7 = 0 AND producto_id % 11 <> 0)""",
    "constraint_violations": """
        SELECT * FROM (
            SELECT 'staging.ventas' AS tabla, 'folio no nulo' AS restriccion, (SELECT count(*) FROM twice WHERE folio IS NULL) AS problemas
            UNION ALL SELECT 'staging.ventas', 'fecha no nulo', 0
            UNION ALL SELECT 'staging.ventas', 'producto_id no nulo', 0
            UNION ALL SELECT 'staging.ventas', 'cantidad no nulo', 0
            UNION ALL SELECT 'staging.ventas', 'precio_unitario no nulo', 0
            UNION ALL SELECT 'staging.ventas', 'canal no nulo', (SELECT count(*) FROM twice WHERE canal IS NULL)
            UNION ALL SELECT 'staging.ventas', 'cargado_en no nulo', 0
            UNION ALL SELECT 'staging.ventas', 'cantidad mayor a 0', (SELECT count(*) FROM twice WHERE cantidad <= 0)
            UNION ALL SELECT 'staging.ventas', 'precio_unitario mayor a 0', 0
            UNION ALL SELECT 'staging.ventas', 'llave única (folio, producto_id)',
                             (SELECT count(*) FROM (SELECT 1 FROM twice GROUP BY folio, producto_id HAVING count(*) > 1))
            UNION ALL SELECT 'staging.ventas', 'producto_id existe en el catálogo',
                             (SELECT count(*) FROM twice WHERE producto_id NOT IN (SELECT producto_id FROM products))
        )""",
    "incremental_window": """
        SELECT fuente, caso, least(greatest(CAST(ultima - INTERVAL 7 DAY AS DATE), inicio), fin) AS inicio, fin
        FROM (SELECT 'clima' AS fuente, max(fecha) AS ultima FROM weather
              UNION ALL SELECT 'tipo_cambio', max(fecha) FROM fx_rates) m,
             (SELECT 'normal' AS caso, DATE '2001-09-01' AS fin, DATE '1995-01-01' AS inicio
              UNION ALL SELECT 'fin anterior', DATE '2000-01-01', DATE '1995-01-01'
              UNION ALL SELECT 'historia posterior', DATE '2026-09-13', DATE '2026-06-01') c""",
    "incremental_slice": """
        SELECT * FROM weather
        WHERE fecha BETWEEN (SELECT max(fecha) - 7 FROM weather WHERE fecha <= DATE '2001-06-30') AND DATE '2001-07-31'""",
}

ORACLES = {name: _with_parts(sql) for name, sql in QUERIES.items()}
