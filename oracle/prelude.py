"""Shared CTEs: the seven source tables and the layers built on them."""

from __future__ import annotations

import re

AS_OF = "DATE '2002-01-01'"
SPLIT = "DATE '2000-12-31'"


def dec_round(expr: str, digits: int) -> str:
    """Half-up rounding of a double as it is written in decimal, so that ties are ties."""
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


_COUNTRY = "CASE n_regionkey WHEN 0 THEN 'CO' WHEN 1 THEN 'MX' WHEN 2 THEN 'CL' WHEN 3 THEN 'PE' WHEN 4 THEN 'EC' END"
_CATEG = (
    "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
    "WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"
)

CTES: dict[str, str] = {}

CTES["mstr_proveedores"] = f"""
SELECT CAST(n_nationkey + 1 AS BIGINT) AS id_proveedor, n_name AS razon_social, {_COUNTRY} AS pais_origen,
       CAST(1 + (n_nationkey * 7) % 60 AS INTEGER) AS tiempo_repo_dias,
       CASE WHEN n_nationkey % 20 = 7 THEN NULL
            ELSE CAST(1 + (n_nationkey * 13 % 41) / 10.0 AS DECIMAL(3,2)) END AS calificacion_calidad,
       n_nationkey % 20 <> 0 AS activo
FROM nation"""

CTES["mstr_tiendas"] = f"""
SELECT s_suppkey AS id_tienda, s_name AS nom_tienda,
       CASE WHEN s_suppkey % 20 < 2 THEN 'HIPER' WHEN s_suppkey % 20 < 11 THEN 'SUPER' ELSE 'CONVE' END AS tipo_tienda,
       CAST(s_nationkey AS INTEGER) AS id_ciudad, {_COUNTRY} AS id_pais,
       CASE WHEN s_suppkey % 20 = 5 THEN NULL ELSE CAST(50 + (s_suppkey * 97) % 9000 AS INTEGER) END AS metros_cuadrados,
       s_suppkey % 20 <> 0 AS activo,
       CAST(DATE '1980-01-01' + CAST((s_suppkey * 37) % 5000 AS INTEGER) AS DATE) AS fec_apertura
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTES["mstr_articulos"] = f"""
SELECT p_partkey AS art_id,
       CASE WHEN p_partkey % 20 = 9 THEN NULL ELSE '770' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS cod_barra,
       p_name AS desc_art, CAST({_CATEG} AS INTEGER) AS id_categ_n1,
       CAST({_CATEG} * 10 + p_size % 5 + 1 AS INTEGER) AS id_categ_n2,
       CASE WHEN p_partkey % 5 = 0 THEN NULL
            ELSE CAST(({_CATEG} * 10 + p_size % 5 + 1) * 10 + p_size % 9 + 1 AS INTEGER) END AS id_categ_n3,
       CAST(substr(p_brand, 7) AS BIGINT) AS id_proveedor, CAST(p_retailprice AS DECIMAL(12,2)) AS precio_lista,
       CASE WHEN p_partkey % 20 = 3 THEN NULL ELSE CAST(p_size / 10.0 AS DECIMAL(8,3)) END AS peso_kg,
       CASE p_partkey % 4 WHEN 0 THEN 'UN' WHEN 1 THEN 'KG' WHEN 2 THEN 'LT' ELSE 'CC' END AS unid_medida,
       p_partkey % 20 <> 0 AS activo,
       CAST(DATE '1990-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS DATE) AS fec_alta
FROM part"""

CTES["crm_miembros"] = """
SELECT c_custkey AS id_miembro, CAST(DATE '1990-01-01' + CAST(c_custkey % 1800 AS INTEGER) AS DATE) AS fec_registro,
       CASE WHEN c_custkey % 20 = 3 THEN NULL ELSE CAST(c_nationkey AS INTEGER) END AS id_ciudad,
       CASE WHEN c_custkey % 20 = 1 THEN NULL WHEN c_custkey % 25 = 0 THEN 'X'
            WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS genero,
       CASE WHEN c_custkey % 20 = 11 THEN NULL ELSE
            CASE (c_custkey % 17) % 6 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45'
                 WHEN 3 THEN '46-55' WHEN 4 THEN '56-65' ELSE '65+' END END AS rango_edad,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'TIENDA' WHEN 'BUILDING' THEN 'WEB'
            WHEN 'FURNITURE' THEN 'MKT' WHEN 'HOUSEHOLD' THEN 'APP' END AS canal_pref,
       c_custkey % 10 <> 0 AS activo,
       CASE WHEN c_custkey % 20 < 3 THEN NULL
            ELSE CAST(DATE '1999-01-01' + CAST(c_custkey % 900 AS INTEGER) AS DATE) END AS fec_ultima_compra
FROM customer"""

CTES["ventas_num"] = """
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
FROM lineitem"""

CTES["ventas_base"] = """
SELECT l_orderkey * 1000000 + rn AS id_trans, l_orderkey * 1000 + rn AS n,
       CASE WHEN l_orderkey % 10 < 3 THEN NULL ELSE o_custkey END AS id_miembro,
       l_suppkey AS id_tienda, l_partkey AS art_id, CAST(o_orderdate AS DATE) AS fec_trans,
       lpad(CAST(8 + rn % 12 AS VARCHAR), 2, '0') || ':00:00' AS hra_trans,
       CAST(l_quantity AS INTEGER) AS qty_vendida, CAST(l_extendedprice AS DECIMAL(12,2)) AS precio_unitario_venta,
       CASE WHEN l_partkey % 20 = 7 THEN NULL
            ELSE CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(12,2))
                 * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) END AS descuento_aplicado,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'EFECTIVO' WHEN '2-HIGH' THEN 'TARJETA' WHEN '3-MEDIUM' THEN 'PSE'
            WHEN '4-NOT SPECIFIED' THEN 'NEQUI' ELSE 'CREDITO' END AS tipo_pago,
       CASE WHEN l_partkey % 20 < 11 THEN 'TIENDA' WHEN l_partkey % 20 < 16 THEN 'WEB'
            WHEN l_partkey % 20 < 19 THEN 'MKT' ELSE 'APP' END AS canal_venta,
       l_orderkey, l_linenumber, l_returnflag
FROM ventas_num JOIN orders ON l_orderkey = o_orderkey"""

CTES["ventas_rep"] = """
SELECT * FROM ventas_base
UNION ALL
SELECT * REPLACE (id_trans + 1000000000000000000 AS id_trans, n + 1000000000000 AS n) FROM ventas_base WHERE n % 997 = 0"""

CTES["trans_ventas"] = """
SELECT id_trans, id_miembro, id_tienda,
       CAST(CASE WHEN n % 1019 = 11 THEN 99999999 ELSE art_id END AS BIGINT) AS art_id,
       CASE WHEN n % 1013 = 7 THEN CAST(DATE '2027-01-01' + CAST(n % 365 AS INTEGER) AS DATE)
            ELSE fec_trans END AS fec_trans, hra_trans, qty_vendida,
       CAST(CASE WHEN n % 1009 = 5 THEN -precio_unitario_venta ELSE precio_unitario_venta END
            AS DECIMAL(12,2)) AS precio_unitario_venta,
       descuento_aplicado, tipo_pago, canal_venta
FROM ventas_rep"""

CTES["inv_stock_diario"] = f"""
SELECT (a * 1000000 + t) * 64 + d AS id_snapshot, a AS art_id, t AS id_tienda,
       CAST(DATE '2001-07-02' + CAST(d AS INTEGER) AS DATE) AS fec_snapshot,
       CAST((a * 31 + t * 17 + d * 7) % 31 AS INTEGER) AS stock_fisico,
       CASE WHEN (a + d) % 20 = 4 THEN NULL ELSE CAST((a + d) % 10 AS INTEGER) END AS stock_transito,
       CASE WHEN (t + d) % 20 = 6 THEN NULL ELSE CAST((t + d) % 5 AS INTEGER) END AS stock_reservado,
       CAST(CASE n1 WHEN 1 THEN 10 WHEN 2 THEN 8 WHEN 3 THEN 10 WHEN 4 THEN 3 WHEN 5 THEN 5 WHEN 6 THEN 8 END
            AS INTEGER) AS stock_minimo_config,
       CAST(3 * CASE n1 WHEN 1 THEN 10 WHEN 2 THEN 8 WHEN 3 THEN 10 WHEN 4 THEN 3 WHEN 5 THEN 5 WHEN 6 THEN 8 END
            AS INTEGER) AS stock_maximo_config
FROM (SELECT DISTINCT l_partkey AS a, l_suppkey AS t FROM lineitem) pares
JOIN (SELECT p_partkey, {_CATEG} AS n1 FROM part) categ ON p_partkey = a
CROSS JOIN (SELECT range AS d FROM range(30)) dias"""

CTES["post_devoluciones"] = """
SELECT id_trans AS id_devolucion, id_trans AS id_trans_origen, art_id, id_tienda,
       CAST(fec_trans + CAST(1 + n % 30 AS INTEGER) AS DATE) AS fec_devolucion,
       CAST(CASE WHEN n % 10 < 8 THEN 1 ELSE qty_vendida END AS INTEGER) AS qty_devuelta,
       CASE l_linenumber WHEN 1 THEN 'DEFECTUOSO' WHEN 2 THEN 'NO_DESEADO' WHEN 3 THEN 'TALLA'
            WHEN 4 THEN 'INCOMPLETO' WHEN 5 THEN 'NO_CORRESPONDE' WHEN 6 THEN 'VENCIDO' ELSE 'OTRO' END AS motivo_cod,
       CASE WHEN n % 10 < 8 THEN canal_venta ELSE 'WEB' END AS canal_devolucion,
       CASE WHEN l_orderkey % 10 < 4 THEN 'PROCESADA' WHEN l_orderkey % 10 < 6 THEN 'APROBADA'
            WHEN l_orderkey % 10 < 9 THEN 'REEMBOLSADA' ELSE 'RECHAZADA' END AS estado_devolucion,
       CASE WHEN n % 20 = 0 THEN NULL
            ELSE CAST(precio_unitario_venta * CAST(qty_vendida AS DECIMAL(10,0)) *
                 CAST(CASE WHEN l_orderkey % 10 < 4 THEN 0.90 WHEN l_orderkey % 10 < 6 THEN 0.95
                           WHEN l_orderkey % 10 < 9 THEN 1.00 ELSE 0.00 END AS DECIMAL(3,2)) AS DECIMAL(12,2))
       END AS vr_reembolso
FROM ventas_base WHERE l_returnflag = 'R'"""

CTES["log_ingesta"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, event_type AS tabla,
       CAST(count(*) * CASE WHEN extract(day FROM CAST(ts AS DATE)) % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS registros,
       CAST(ts AS DATE) AS ts_ejecucion
FROM events GROUP BY CAST(ts AS DATE), event_type"""

# ---------------------------------------------------------------- cleaning
CTES["ventas_unicas"] = """
SELECT * EXCLUDE (orden) FROM (
  SELECT *, row_number() OVER (PARTITION BY id_miembro, id_tienda, art_id, fec_trans, hra_trans
                               ORDER BY id_trans) AS orden FROM trans_ventas) t
WHERE orden = 1"""

CTES["ventas_marcadas"] = f"""
SELECT v.*,
       CASE WHEN id_trans IS NULL THEN 'pk_nula'
            WHEN precio_unitario_venta <= 0 THEN 'monto_no_positivo'
            WHEN fec_trans > {AS_OF} THEN 'fecha_futura'
            WHEN id_tienda IS NULL OR NOT EXISTS (SELECT 1 FROM mstr_tiendas p WHERE p.id_tienda = v.id_tienda)
              THEN 'fk_invalida_id_tienda'
            WHEN art_id IS NULL OR NOT EXISTS (SELECT 1 FROM mstr_articulos p WHERE p.art_id = v.art_id)
              THEN 'fk_invalida_art_id' END AS motivo
FROM ventas_unicas v"""

CTES["silver_ventas"] = "SELECT * EXCLUDE (motivo) FROM ventas_marcadas WHERE motivo IS NULL"

CTES["devoluciones_marcadas"] = """
SELECT d.*,
       CASE WHEN id_devolucion IS NULL THEN 'pk_nula'
            WHEN NOT EXISTS (SELECT 1 FROM silver_ventas p WHERE p.id_trans = d.id_trans_origen)
              THEN 'fk_invalida_id_trans_origen'
            WHEN NOT EXISTS (SELECT 1 FROM mstr_articulos p WHERE p.art_id = d.art_id) THEN 'fk_invalida_art_id'
            WHEN NOT EXISTS (SELECT 1 FROM mstr_tiendas p WHERE p.id_tienda = d.id_tienda)
              THEN 'fk_invalida_id_tienda' END AS motivo
FROM (SELECT DISTINCT * FROM post_devoluciones) d"""

CTES["silver_devoluciones"] = "SELECT * EXCLUDE (motivo) FROM devoluciones_marcadas WHERE motivo IS NULL"

CTES["fecha_ref"] = "SELECT max(fec_trans) AS ref FROM silver_ventas"

# ---------------------------------------------------------------- model
CTES["dim_productos"] = """
SELECT art_id, desc_art, id_categ_n1,
       CASE id_categ_n1 WHEN 1 THEN 'Alimentos y bebidas' WHEN 2 THEN 'Cuidado personal e higiene'
            WHEN 3 THEN 'Hogar y limpieza' WHEN 4 THEN 'Electronica y tecnologia'
            WHEN 5 THEN 'Ropa y calzado basico' WHEN 6 THEN 'Bebes y maternidad' ELSE 'Sin categoria' END AS categoria_n1,
       id_categ_n2, id_categ_n3, a.id_proveedor, p.pais_origen AS proveedor_pais,
       p.calificacion_calidad AS proveedor_calificacion, precio_lista, margen AS margen_estimado_pct,
       CAST(round(precio_lista * (1 + margen), 2) AS DECIMAL(18,2)) AS precio_con_margen, unid_medida, a.activo
FROM (SELECT *, CAST(CASE id_categ_n1 WHEN 1 THEN 0.18 WHEN 2 THEN 0.30 WHEN 3 THEN 0.28 WHEN 4 THEN 0.22
                     WHEN 5 THEN 0.45 WHEN 6 THEN 0.35 ELSE 0.20 END AS DECIMAL(3,2)) AS margen
      FROM mstr_articulos) a
LEFT JOIN mstr_proveedores p ON p.id_proveedor = a.id_proveedor"""

CTES["dim_tiendas"] = """
SELECT id_tienda, nom_tienda, tipo_tienda,
       CASE tipo_tienda WHEN 'HIPER' THEN 'Hipermercado' WHEN 'SUPER' THEN 'Supermercado de barrio'
            WHEN 'CONVE' THEN 'Tienda de conveniencia' ELSE 'Otro' END AS tipo_tienda_desc,
       id_ciudad, id_pais,
       CASE WHEN id_pais = 'CO' THEN 'CD Bogota' WHEN id_pais = 'MX' THEN 'CD Ciudad de Mexico'
            WHEN id_pais IN ('CL', 'PE', 'EC') THEN 'CD Santiago' ELSE 'Sin asignar' END AS zona_distribucion,
       metros_cuadrados, activo
FROM mstr_tiendas"""

CTES["moda_edad"] = """
SELECT canal_pref, rango_edad AS moda FROM (
  SELECT canal_pref, rango_edad, row_number() OVER (PARTITION BY canal_pref ORDER BY n DESC, rango_edad) AS rn
  FROM (SELECT canal_pref, rango_edad, count(*) AS n FROM crm_miembros WHERE rango_edad IS NOT NULL
        GROUP BY canal_pref, rango_edad) c) r
WHERE rn = 1"""

CTES["dim_clientes"] = """
SELECT m.id_miembro, m.fec_registro, CAST(ref - m.fec_registro AS INTEGER) AS antiguedad_dias, m.id_ciudad,
       CASE WHEN genero IN ('M', 'F') THEN genero ELSE 'No informado' END AS genero_std,
       coalesce(m.rango_edad, o.moda, '26-35') AS rango_edad, m.canal_pref, m.activo, m.fec_ultima_compra
FROM crm_miembros m LEFT JOIN moda_edad o ON o.canal_pref = m.canal_pref CROSS JOIN fecha_ref"""

CTES["fact_ventas"] = """
SELECT id_trans, coalesce(CAST(id_miembro AS VARCHAR), 'ANONIMO') AS id_cliente, id_miembro, id_tienda, art_id,
       fec_trans, hra_trans, qty_vendida, precio_unitario_venta, coalesce(descuento_aplicado, 0) AS descuento_aplicado,
       CAST(CAST(qty_vendida AS DECIMAL(10,0)) * precio_unitario_venta AS DECIMAL(18,2)) AS vr_venta_bruto,
       CAST(CAST(qty_vendida AS DECIMAL(10,0)) * precio_unitario_venta - coalesce(descuento_aplicado, 0)
            AS DECIMAL(18,2)) AS vr_venta_neto,
       coalesce(descuento_aplicado, 0) > 0 AS ind_descuento, tipo_pago, canal_venta
FROM silver_ventas"""

CTES["consumo"] = """
SELECT art_id, CAST(sum(qty_vendida) AS BIGINT) AS consumo_14d FROM fact_ventas, fecha_ref
WHERE fec_trans > ref - 14 GROUP BY art_id"""

CTES["ultimo_stock"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY art_id, id_tienda ORDER BY fec_snapshot DESC, id_snapshot DESC) AS rn
  FROM inv_stock_diario) s WHERE rn = 1"""

CTES["fact_inventario"] = f"""
SELECT id_snapshot, art_id, id_tienda, fec_snapshot, stock_fisico, stock_minimo_config, dif_stock_minimo, consumo_14d,
       consumo_diario, cobertura_dias, coalesce(cobertura_dias < 7, FALSE) AS alerta_quiebre
FROM (
  SELECT u.*, stock_fisico - stock_minimo_config AS dif_stock_minimo, coalesce(c.consumo_14d, 0) AS consumo_14d,
         CAST(coalesce(c.consumo_14d, 0) AS DOUBLE) / CAST(14 AS DOUBLE) AS consumo_diario,
         CASE WHEN coalesce(c.consumo_14d, 0) > 0 THEN
           {dec_round("CAST(stock_fisico AS DOUBLE) / (CAST(c.consumo_14d AS DOUBLE) / CAST(14 AS DOUBLE))", 1)}
         END AS cobertura_dias
  FROM ultimo_stock u LEFT JOIN consumo c ON c.art_id = u.art_id) x"""

CTES["fact_devoluciones"] = """
SELECT id_devolucion, id_trans_origen, d.art_id, d.id_tienda, fec_devolucion, qty_devuelta, motivo_cod,
       CASE motivo_cod WHEN 'DEFECTUOSO' THEN 'Articulo defectuoso o danado'
            WHEN 'NO_DESEADO' THEN 'Cliente cambio de opinion' WHEN 'TALLA' THEN 'Talla incorrecta'
            WHEN 'INCOMPLETO' THEN 'Paquete incompleto' WHEN 'NO_CORRESPONDE' THEN 'No corresponde a lo solicitado'
            WHEN 'VENCIDO' THEN 'Producto vencido' WHEN 'OTRO' THEN 'Otro motivo' ELSE 'Sin clasificar' END AS motivo_desc,
       canal_devolucion, estado_devolucion, coalesce(vr_reembolso, 0) AS vr_reembolso,
       v.precio_unitario_venta AS precio_venta_original
FROM silver_devoluciones d LEFT JOIN silver_ventas v ON v.id_trans = d.id_trans_origen"""

CTES["rfm_base"] = """
SELECT id_miembro, CAST(max(ref) - max(fec_trans) AS INTEGER) AS recencia_dias,
       CAST(count(*) FILTER (WHERE fec_trans > ref - 90) AS BIGINT) AS frecuencia,
       coalesce(sum(vr_venta_neto) FILTER (WHERE fec_trans > ref - 90), 0) AS monetario
FROM fact_ventas, fecha_ref WHERE id_miembro IS NOT NULL
GROUP BY id_miembro HAVING max(fec_trans) > max(ref) - 180"""

CTES["rfm_notas"] = """
SELECT *, CAST(ntile(5) OVER (ORDER BY recencia_dias DESC, id_miembro) AS INTEGER) AS R,
       CAST(ntile(5) OVER (ORDER BY frecuencia, id_miembro) AS INTEGER) AS F,
       CAST(ntile(5) OVER (ORDER BY monetario, id_miembro) AS INTEGER) AS M
FROM rfm_base"""

CTES["fact_rfm"] = """
SELECT id_miembro, recencia_dias, frecuencia, monetario, R, F, M, 'R' || R || '-F' || F || '-M' || M AS segmento_rfm,
       CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'Champions' WHEN R >= 3 AND F >= 3 THEN 'Leales'
            WHEN R >= 4 THEN 'Recientes' WHEN R <= 2 THEN 'En riesgo' ELSE 'Ocasionales' END AS etiqueta
FROM rfm_notas"""

CTES["ventas_enr"] = """
SELECT v.*, t.id_pais, t.zona_distribucion, t.tipo_tienda_desc, p.id_categ_n1, p.categoria_n1
FROM fact_ventas v LEFT JOIN dim_tiendas t ON t.id_tienda = v.id_tienda
LEFT JOIN dim_productos p ON p.art_id = v.art_id"""

CTES["venta_dia"] = "SELECT fec_trans, sum(vr_venta_neto) AS neto FROM fact_ventas GROUP BY fec_trans"

CTES["calendario"] = """
SELECT CAST(dia AS DATE) AS fecha FROM (
  SELECT unnest(generate_series(min(fec_trans), max(fec_trans), INTERVAL 1 DAY)) AS dia FROM fact_ventas) g"""

CTES["dia_pais"] = """
SELECT fec_trans, id_pais, CAST(sum(vr_venta_neto) AS DOUBLE) AS neto FROM ventas_enr GROUP BY fec_trans, id_pais"""

CTES["semanas"] = """
SELECT id_pais, lunes, CAST(isoyear(lunes) AS INTEGER) AS anio_iso, CAST(weekofyear(lunes) AS INTEGER) AS semana,
       CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas
FROM (SELECT id_pais, vr_venta_neto, CAST(date_trunc('week', fec_trans) AS DATE) AS lunes FROM ventas_enr) s
GROUP BY id_pais, lunes"""

CTES["pesos"] = """
SELECT art_id, id_categ_n1, CAST(CASE id_categ_n1 WHEN 1 THEN 0.40 WHEN 2 THEN 0.22 WHEN 3 THEN 0.18 WHEN 4 THEN 0.05
       WHEN 5 THEN 0.08 WHEN 6 THEN 0.07 END AS DECIMAL(3,2)) AS w
FROM mstr_articulos WHERE activo"""


def with_ctes(query: str) -> str:
    """Put the CTEs a query needs, in definition order, in front of it."""
    needed: set[str] = set()
    todo = [query]
    while todo:
        text = todo.pop()
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + query.strip()
