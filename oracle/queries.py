"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.prelude import AS_OF, SPLIT, dec_round, with_ctes

_SALE_COLS = "id_trans, id_miembro, id_tienda, art_id, fec_trans, hra_trans, qty_vendida"
_SALE_ROW = (
    f"{_SALE_COLS}, CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, "
    "CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, tipo_pago, canal_venta"
)
_TABLES = [
    "mstr_proveedores", "mstr_tiendas", "mstr_articulos", "crm_miembros",
    "trans_ventas", "inv_stock_diario", "post_devoluciones",
]


def _audit(ts: str, day: int, batch: str) -> str:
    return (
        f"'{ts}' AS _ts_ingesta, 'retail' AS _sistema_fuente, '{batch}' AS _batch_id, "
        f"CAST(2002 AS INTEGER) AS _anio_ingesta, CAST(1 AS INTEGER) AS _mes_ingesta, CAST({day} AS INTEGER) AS _dia_ingesta"
    )


_RUN1 = _audit("2002-01-01 02:00:00", 1, "lote-1")
_RUN2 = _audit("2002-01-02 02:00:00", 2, "lote-2")
_RESENT = f"fec_trans > {SPLIT} - 7 AND fec_trans <= {SPLIT}"
_MERGED = f"""
SELECT {_SALE_ROW}, {_RUN1} FROM trans_ventas WHERE fec_trans <= {SPLIT} - 7
UNION ALL
SELECT {_SALE_COLS}, CAST(precio_unitario_venta AS DOUBLE), CAST(descuento_aplicado AS DOUBLE),
       CASE WHEN {_RESENT} THEN 'TRANSFER' ELSE tipo_pago END, canal_venta, {_RUN2}
FROM trans_ventas WHERE fec_trans > {SPLIT} - 7"""
_MARKS = [
    ("mstr_tiendas", "fec_apertura"), ("mstr_articulos", "fec_alta"), ("crm_miembros", "fec_registro"),
    ("trans_ventas", "fec_trans"), ("inv_stock_diario", "fec_snapshot"), ("post_devoluciones", "fec_devolucion"),
]


def _watermarks(where: str) -> str:
    rows = ["SELECT 'mstr_proveedores' AS tabla, CAST(NULL AS DATE) AS watermark"]
    rows += [f"SELECT '{t}', max({c}) FROM {t} {where.format(c=c)}" for t, c in _MARKS]
    return "\nUNION ALL ".join(rows)


_EDGES = [
    ("mstr_articulos", "id_proveedor", "mstr_proveedores", "id_proveedor"),
    ("trans_ventas", "id_tienda", "mstr_tiendas", "id_tienda"),
    ("trans_ventas", "art_id", "mstr_articulos", "art_id"),
    ("inv_stock_diario", "art_id", "mstr_articulos", "art_id"),
    ("inv_stock_diario", "id_tienda", "mstr_tiendas", "id_tienda"),
    ("post_devoluciones", "id_trans_origen", "trans_ventas", "id_trans"),
    ("post_devoluciones", "art_id", "mstr_articulos", "art_id"),
    ("post_devoluciones", "id_tienda", "mstr_tiendas", "id_tienda"),
]

_ERRORS = """
SELECT 'trans_ventas' AS tabla_origen, CAST(id_trans AS VARCHAR) AS id_registro, motivo
FROM ventas_marcadas WHERE motivo IS NOT NULL
UNION ALL
SELECT 'post_devoluciones', CAST(id_devolucion AS VARCHAR), motivo FROM devoluciones_marcadas WHERE motivo IS NOT NULL"""


def _quality_rows() -> str:
    def counts(raw: str, kept: str, bad: str) -> str:
        return (
            f"SELECT '{raw}' AS tabla, (SELECT count(*) FROM {raw}) AS entrada, "
            f"({kept}) AS salida, ({bad}) AS rechazados"
        )

    rows = [
        counts(t, f"SELECT count(*) FROM (SELECT DISTINCT * FROM {t}) u", "SELECT 0")
        for t in _TABLES
        if t not in ("trans_ventas", "post_devoluciones")
    ]
    for raw, tagged in (("trans_ventas", "ventas_marcadas"), ("post_devoluciones", "devoluciones_marcadas")):
        rows.append(
            counts(
                raw,
                f"SELECT count(*) FROM {tagged} WHERE motivo IS NULL",
                f"SELECT count(*) FROM {tagged} WHERE motivo IS NOT NULL",
            )
        )
    return "\nUNION ALL ".join(rows)


_QUALITY = f"""
SELECT tabla, CAST(entrada AS BIGINT) AS entrada, CAST(entrada - salida - rechazados AS BIGINT) AS duplicados,
       CAST(rechazados AS BIGINT) AS rechazados, CAST(salida AS BIGINT) AS salida,
       {dec_round("100.0 * CAST(salida AS DOUBLE) / CAST(entrada AS DOUBLE)", 2)} AS pct_conformes
FROM ({_quality_rows()}) q"""


def _check(name: str, text: str, value: str, ok: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{text}' AS descripcion, {value} AS valor_obtenido, "
        f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS estado FROM ({source}) c"
    )


def _unique(table: str, key: str) -> str:
    return _check(
        f"pk_unica_{table}", f"{key} sin duplicados", f"n || ' filas / ' || d || ' {key} distintos'", "n = d",
        f"SELECT count(*) AS n, count(DISTINCT {key}) AS d FROM {table}",
    )


def _none(name: str, text: str, noun: str, source: str) -> str:
    return _check(name, text, f"n || ' {noun}'", "n = 0", source)


_DQ = "\nUNION ALL ".join([
    _unique("dim_productos", "art_id"),
    _unique("dim_tiendas", "id_tienda"),
    _unique("dim_clientes", "id_miembro"),
    _none("no_nulos_fact_ventas", "vr_venta_neto, art_id e id_tienda no nulos", "nulos",
          "SELECT count(*) AS n FROM fact_ventas WHERE vr_venta_neto IS NULL OR art_id IS NULL OR id_tienda IS NULL"),
    _none("ri_ventas_productos", "fact_ventas.art_id existe en dim_productos", "huerfanos",
          "SELECT count(*) AS n FROM fact_ventas v WHERE NOT EXISTS "
          "(SELECT 1 FROM dim_productos p WHERE p.art_id = v.art_id)"),
    _none("rango_vr_venta_neto", "vr_venta_neto > 0", "no positivos",
          "SELECT count(*) AS n FROM fact_ventas WHERE vr_venta_neto <= 0"),
    _none("rango_scores_rfm", "R, F y M entre 1 y 5", "fuera de rango",
          "SELECT count(*) AS n FROM fact_rfm WHERE R NOT BETWEEN 1 AND 5 OR F NOT BETWEEN 1 AND 5 "
          "OR M NOT BETWEEN 1 AND 5"),
    _none("rango_cobertura", "cobertura_dias >= 0 (o nula)", "negativas",
          "SELECT count(*) AS n FROM fact_inventario WHERE cobertura_dias < 0"),
])

_RUNS = """
SELECT batch_id, CAST(sum(registros) AS BIGINT) AS volumen, max(ts_ejecucion) AS ts FROM log_ingesta GROUP BY batch_id"""
_ALERT = f"""
SELECT batch_id, volumen AS volumen_actual, round_even(media, 0) AS promedio_previo,
       round_even(desviacion, 1) AS desviacion_pct, abs(desviacion) > 30 AS es_anomalia
FROM (SELECT a.batch_id, a.volumen, a.media, 100.0 * (a.volumen - a.media) / a.media AS desviacion
      FROM (SELECT batch_id, volumen, avg(volumen) OVER (ORDER BY ts ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS media,
                   row_number() OVER (ORDER BY ts DESC) AS n FROM ({_RUNS}) r) a
      WHERE n = 1 AND media IS NOT NULL) d"""

# Declared columns per table: (name, nullable, max length or None, vocabulary or None).
_COLS = {
    "mstr_proveedores": [("id_proveedor", 0, 0, 0), ("razon_social", 0, 150, 0), ("pais_origen", 0, 2, 0),
                         ("tiempo_repo_dias", 0, 0, 0), ("calificacion_calidad", 1, 0, 0), ("activo", 0, 0, 0)],
    "mstr_tiendas": [("id_tienda", 0, 0, 0), ("nom_tienda", 0, 120, 0), ("tipo_tienda", 0, 20, "'HIPER','SUPER','CONVE'"),
                     ("id_ciudad", 0, 0, 0), ("id_pais", 0, 2, "'CO','MX','CL','PE','EC'"),
                     ("metros_cuadrados", 1, 0, 0), ("activo", 0, 0, 0), ("fec_apertura", 0, 0, 0)],
    "mstr_articulos": [("art_id", 0, 0, 0), ("cod_barra", 1, 13, 0), ("desc_art", 0, 200, 0),
                       ("id_categ_n1", 0, 0, "1,2,3,4,5,6"), ("id_categ_n2", 0, 0, 0), ("id_categ_n3", 1, 0, 0),
                       ("id_proveedor", 0, 0, 0), ("precio_lista", 0, 0, 0), ("peso_kg", 1, 0, 0),
                       ("unid_medida", 0, 10, "'UN','KG','LT','MT','CC'"), ("activo", 0, 0, 0), ("fec_alta", 0, 0, 0)],
    "crm_miembros": [("id_miembro", 0, 0, 0), ("fec_registro", 0, 0, 0), ("id_ciudad", 1, 0, 0),
                     ("genero", 1, 1, "'M','F','X'"),
                     ("rango_edad", 1, 10, "'18-25','26-35','36-45','46-55','56-65','65+'"),
                     ("canal_pref", 1, 20, "'TIENDA','WEB','MKT','APP'"), ("activo", 0, 0, 0),
                     ("fec_ultima_compra", 1, 0, 0)],
    "trans_ventas": [("id_trans", 0, 0, 0), ("id_miembro", 1, 0, 0), ("id_tienda", 0, 0, 0), ("art_id", 0, 0, 0),
                     ("fec_trans", 0, 0, 0), ("hra_trans", 0, 8, 0), ("qty_vendida", 0, 0, 0),
                     ("precio_unitario_venta", 0, 0, 0), ("descuento_aplicado", 1, 0, 0),
                     ("tipo_pago", 0, 20, "'EFECTIVO','TARJETA','PSE','NEQUI','DAVIPLATA','TRANSFER','CREDITO'"),
                     ("canal_venta", 0, 20, "'TIENDA','WEB','MKT','APP'")],
    "inv_stock_diario": [("id_snapshot", 0, 0, 0), ("art_id", 0, 0, 0), ("id_tienda", 0, 0, 0), ("fec_snapshot", 0, 0, 0),
                         ("stock_fisico", 0, 0, 0), ("stock_transito", 1, 0, 0), ("stock_reservado", 1, 0, 0),
                         ("stock_minimo_config", 0, 0, 0), ("stock_maximo_config", 0, 0, 0)],
    "post_devoluciones": [("id_devolucion", 0, 0, 0), ("id_trans_origen", 0, 0, 0), ("art_id", 0, 0, 0),
                          ("id_tienda", 0, 0, 0), ("fec_devolucion", 0, 0, 0), ("qty_devuelta", 0, 0, 0),
                          ("motivo_cod", 0, 20, "'DEFECTUOSO','NO_DESEADO','TALLA','INCOMPLETO','NO_CORRESPONDE','VENCIDO','OTRO'"),
                          ("canal_devolucion", 0, 20, "'TIENDA','WEB','MKT','APP'"),
                          ("estado_devolucion", 0, 20, "'PROCESADA','APROBADA','REEMBOLSADA','RECHAZADA'"),
                          ("vr_reembolso", 1, 0, 0)],
}


def _contract() -> str:
    rows = []
    for table, cols in _COLS.items():
        for name, nullable, length, _ in cols:
            bad = ["FALSE"] + ([] if nullable else [f"{name} IS NULL"]) + ([f"length({name}) > {length}"] if length else [])
            rows.append(
                f"SELECT '{table}' AS tabla, '{name}' AS columna, 'contrato' AS regla, "
                f"CAST(count(*) FILTER (WHERE {' OR '.join(bad)}) AS BIGINT) AS violaciones FROM {table}"
            )
    return "\nUNION ALL ".join(rows)


def _domain() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{name}' AS columna, 'vocabulario' AS regla, "
        f"CAST(count(*) FILTER (WHERE {name} IS NOT NULL AND {name} NOT IN ({values})) AS BIGINT) AS violaciones FROM {table}"
        for table, cols in _COLS.items()
        for name, _, _, values in cols
        if values
    )


def _nulls() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{name}' AS columna, CAST(count(*) - count({name}) AS BIGINT) AS nulos FROM {table}"
        for table, cols in _COLS.items()
        for name, *_ in cols
    )


def _shares() -> str:
    wanted = [("mstr_proveedores", "pais_origen"), ("mstr_tiendas", "id_pais"), ("mstr_tiendas", "tipo_tienda"),
              ("mstr_articulos", "id_categ_n1"), ("crm_miembros", "genero")]
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS tabla, '{c}' AS columna, CAST({c} AS VARCHAR) AS valor, count(*) AS filas, "
        f"CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM {t}) AS DOUBLE) AS proporcion FROM {t} GROUP BY {c}"
        for t, c in wanted
    )


_KPI = f"""CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       count(DISTINCT id_trans) AS transacciones,
       {dec_round("CAST(sum(vr_venta_neto) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 2)} AS ticket_promedio"""

_WEEK_CHANGE = dec_round(
    "100.0 * (ventas_netas - ventas_semana_anterior) / NULLIF(ventas_semana_anterior, 0)", 2
)

_SQL = {
    "scan_sales": f"SELECT {_SALE_ROW} FROM trans_ventas",
    "preview_sales": f"SELECT {_SALE_ROW} FROM trans_ventas ORDER BY id_trans LIMIT 5",
    "load_counts": "\nUNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}" for t in _TABLES),
    "bronze_audit": f"SELECT {_SALE_ROW}, {_RUN1} FROM trans_ventas",
    "bronze_partition_counts": f"""
SELECT _anio_ingesta, _mes_ingesta, _dia_ingesta, _batch_id, count(*) AS filas FROM ({_MERGED}) m
GROUP BY _anio_ingesta, _mes_ingesta, _dia_ingesta, _batch_id""",
    "watermark": _watermarks(""),
    "watermark_capped": _watermarks(f"WHERE {{c}} <= {AS_OF}"),
    "incremental_filter": f"""
SELECT {_SALE_ROW} FROM trans_ventas
WHERE fec_trans > (SELECT max(fec_trans) FROM trans_ventas WHERE fec_trans <= {SPLIT})""",
    "late_rows": f"""
SELECT canal_venta, count(*) AS filas_tardias, min(fec_trans) AS desde, max(fec_trans) AS hasta FROM trans_ventas
WHERE canal_venta = 'APP'
  AND fec_trans <= (SELECT max(fec_trans) FROM trans_ventas WHERE fec_trans <= {SPLIT} AND canal_venta <> 'APP')
GROUP BY canal_venta""",
    "incremental_ingest": f"""
SELECT {_SALE_ROW}, {_RUN1} FROM trans_ventas WHERE fec_trans <= {SPLIT}
UNION ALL
SELECT {_SALE_ROW}, {_RUN2} FROM trans_ventas
WHERE fec_trans > (SELECT max(fec_trans) FROM trans_ventas WHERE fec_trans <= {SPLIT})""",
    "bronze_one_partition": f"""
SELECT canal_venta, count(*) AS filas FROM ({_MERGED}) m WHERE _dia_ingesta = 2 GROUP BY canal_venta""",
    "merge_upsert": _MERGED,
    "merge_repeated": f"""
SELECT _batch_id, tipo_pago, count(*) AS filas, count(DISTINCT id_trans) AS claves FROM ({_MERGED}) m
GROUP BY _batch_id, tipo_pago""",
    "full_reload": "SELECT 'lote-2' AS _batch_id, canal_venta, count(*) AS filas FROM trans_ventas GROUP BY canal_venta",
    "export_formats": "\nUNION ALL ".join(
        f"SELECT '{fmt}' AS formato, id_tienda, id_pais, tipo_tienda FROM mstr_tiendas" for fmt in ("csv", "json", "parquet")
    ),
    "transactions_by_order": """
SELECT canal_venta, count(DISTINCT id_trans // 1000000) AS transacciones, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       CAST(sum(vr_venta_neto) AS DOUBLE) / CAST(count(DISTINCT id_trans // 1000000) AS DOUBLE) AS ticket_promedio
FROM fact_ventas GROUP BY canal_venta""",
    "quality_bad_keys": f"""
SELECT 'post_devoluciones' AS tabla, entrada, entrada - salida - rechazados AS duplicados, rechazados, salida,
       {dec_round("100.0 * CAST(salida AS DOUBLE) / CAST(entrada AS DOUBLE)", 2)} AS pct_conformes
FROM (SELECT count(*) + count(*) FILTER (WHERE id_devolucion % 7 = 3 AND id_devolucion % 11 <> 0) AS entrada,
             count(*) FILTER (WHERE id_devolucion % 11 <> 0) AS salida,
             (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (id_devolucion) FROM post_devoluciones
                                    WHERE id_devolucion % 11 = 0) x) AS rechazados
      FROM post_devoluciones) q""",
    "merge_idempotent": f"""
SELECT pasadas, count(*) AS filas, count(DISTINCT id_trans) AS claves,
       count(*) FILTER (WHERE tipo_pago = 'TRANSFER') AS corregidas, CAST(sum(qty_vendida) AS BIGINT) AS unidades
FROM ({_MERGED}) m CROSS JOIN (SELECT CAST(1 AS INTEGER) AS pasadas UNION ALL SELECT CAST(2 AS INTEGER)) p
GROUP BY pasadas""",
    "dedup_exact": f"SELECT DISTINCT {_SALE_ROW.replace('id_trans, ', '', 1)} FROM trans_ventas",
    "dedup_business_key": f"SELECT {_SALE_ROW} FROM ventas_unicas",
    "quarantine_sales": f"""
SELECT id_trans, CASE WHEN id_trans IS NULL THEN 'pk_nula' WHEN precio_unitario_venta <= 0 THEN 'monto_no_positivo'
       WHEN fec_trans > {AS_OF} THEN 'fecha_futura' END AS motivo FROM ventas_unicas""",
    "fk_orphans": """
SELECT id_trans, art_id FROM trans_ventas v
WHERE NOT EXISTS (SELECT 1 FROM mstr_articulos p WHERE p.art_id = v.art_id)""",
    "fk_valid": """
SELECT id_trans, art_id FROM trans_ventas v WHERE EXISTS (SELECT 1 FROM mstr_articulos p WHERE p.art_id = v.art_id)""",
    "fk_null_ok": """
SELECT id_trans, id_miembro FROM trans_ventas v
WHERE id_miembro IS NULL OR EXISTS (SELECT 1 FROM crm_miembros p WHERE p.id_miembro = v.id_miembro AND p.activo)""",
    "fk_matrix": "\nUNION ALL ".join(
        f"SELECT '{c}' AS hija, '{fk}' AS columna, '{p}' AS padre, (SELECT count(*) FROM {c} h WHERE NOT EXISTS "
        f"(SELECT 1 FROM {p} q WHERE q.{pk} = h.{fk})) AS huerfanos"
        for c, fk, p, pk in _EDGES
    ),
    "silver_sales": f"SELECT {_SALE_ROW} FROM silver_ventas",
    "silver_returns": """
SELECT id_devolucion, id_trans_origen, art_id, id_tienda, fec_devolucion, qty_devuelta, motivo_cod, canal_devolucion,
       estado_devolucion, CAST(vr_reembolso AS DOUBLE) AS vr_reembolso FROM silver_devoluciones""",
    "silver_suppliers": """
SELECT DISTINCT id_proveedor, sha256(razon_social) AS razon_social, pais_origen, tiempo_repo_dias,
       CAST(calificacion_calidad AS DOUBLE) AS calificacion_calidad, activo FROM mstr_proveedores""",
    "error_table": _ERRORS,
    "error_summary": f"SELECT tabla_origen, motivo, count(*) AS registros FROM ({_ERRORS}) e GROUP BY tabla_origen, motivo",
    "quality_report": _QUALITY,
    "lookup_map": "SELECT art_id, id_categ_n1, categoria_n1, CAST(margen_estimado_pct AS DOUBLE) AS margen_estimado_pct FROM dim_productos",
    "standardize_gender": """
SELECT id_miembro, genero, CASE genero WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'No informado' END AS genero_std
FROM crm_miembros""",
    "group_mode": "SELECT canal_pref, moda AS rango_edad_moda FROM moda_edad",
    "dim_products": """
SELECT * REPLACE (CAST(proveedor_calificacion AS DOUBLE) AS proveedor_calificacion,
  CAST(precio_lista AS DOUBLE) AS precio_lista, CAST(margen_estimado_pct AS DOUBLE) AS margen_estimado_pct,
  CAST(precio_con_margen AS DOUBLE) AS precio_con_margen) FROM dim_productos""",
    "dim_stores": "SELECT * FROM dim_tiendas",
    "dim_customers": "SELECT * FROM dim_clientes",
    "dim_calendar": """
SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(quarter(fecha) AS INTEGER) AS trimestre,
       CAST(month(fecha) AS INTEGER) AS mes,
       ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre',
        'diciembre'][month(fecha)] AS nombre_mes,
       CAST(day(fecha) AS INTEGER) AS dia, CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana,
       ['domingo','lunes','martes','miercoles','jueves','viernes','sabado'][dayofweek(fecha) + 1] AS nombre_dia,
       CAST(weekofyear(fecha) AS INTEGER) AS semana_anio, dayofweek(fecha) IN (0, 6) AS es_fin_semana
FROM calendario""",
    "fact_sales": """
SELECT * REPLACE (CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta,
  CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, CAST(vr_venta_bruto AS DOUBLE) AS vr_venta_bruto,
  CAST(vr_venta_neto AS DOUBLE) AS vr_venta_neto) FROM fact_ventas""",
    "trailing_consumption": "SELECT art_id, consumo_14d FROM consumo",
    "latest_snapshot": "SELECT * FROM ultimo_stock",
    "fact_inventory": "SELECT * FROM fact_inventario",
    "stockout_count": "SELECT count(*) AS alertas FROM fact_inventario WHERE alerta_quiebre",
    "fact_returns": """
SELECT * REPLACE (CAST(vr_reembolso AS DOUBLE) AS vr_reembolso, CAST(precio_venta_original AS DOUBLE) AS precio_venta_original)
FROM fact_devoluciones""",
    "active_members": """
SELECT DISTINCT id_miembro FROM fact_ventas, fecha_ref WHERE id_miembro IS NOT NULL AND fec_trans > ref - 180""",
    "rfm": "SELECT * REPLACE (CAST(monetario AS DOUBLE) AS monetario) FROM fact_rfm",
    "sales_enriched": """
SELECT * REPLACE (CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta,
  CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, CAST(vr_venta_bruto AS DOUBLE) AS vr_venta_bruto,
  CAST(vr_venta_neto AS DOUBLE) AS vr_venta_neto) FROM ventas_enr""",
    "star_sales": """
SELECT CAST(year(fec_trans) AS INTEGER) AS anio, zona_distribucion, categoria_n1, c.genero_std,
       CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       count(DISTINCT id_trans) AS transacciones
FROM ventas_enr v LEFT JOIN dim_clientes c ON c.id_miembro = v.id_miembro
GROUP BY year(fec_trans), zona_distribucion, categoria_n1, c.genero_std""",
    "agg_daily_sales": f"""
SELECT fec_trans, id_pais, id_tienda, canal_venta, categoria_n1, {_KPI}
FROM ventas_enr GROUP BY fec_trans, id_pais, id_tienda, canal_venta, categoria_n1""",
    "return_rate": f"""
SELECT v.categoria_n1, v.canal_venta, unidades_vendidas, coalesce(unidades_devueltas, 0) AS unidades_devueltas,
       {dec_round("100.0 * CAST(coalesce(unidades_devueltas, 0) AS DOUBLE) / NULLIF(CAST(unidades_vendidas AS DOUBLE), 0)", 2)}
         AS tasa_devolucion_pct
FROM (SELECT categoria_n1, canal_venta, CAST(sum(qty_vendida) AS BIGINT) AS unidades_vendidas FROM ventas_enr
      GROUP BY categoria_n1, canal_venta) v
LEFT JOIN (SELECT p.categoria_n1, d.canal_devolucion, CAST(sum(qty_devuelta) AS BIGINT) AS unidades_devueltas
           FROM fact_devoluciones d LEFT JOIN dim_productos p ON p.art_id = d.art_id
           GROUP BY p.categoria_n1, d.canal_devolucion) r
  ON r.categoria_n1 = v.categoria_n1 AND r.canal_devolucion = v.canal_venta""",
    "return_ratio_overall": """
SELECT d.n AS devoluciones, v.n AS ventas, CAST(d.n AS DOUBLE) / CAST(v.n AS DOUBLE) AS tasa
FROM (SELECT count(*) AS n FROM silver_devoluciones) d CROSS JOIN (SELECT count(*) AS n FROM silver_ventas) v""",
    "agg_rfm_segments": f"""
SELECT etiqueta, count(*) AS clientes,
       {dec_round("CAST(sum(monetario) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 2)} AS monetario_promedio,
       {dec_round("CAST(sum(frecuencia) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 2)} AS frecuencia_promedio
FROM fact_rfm GROUP BY etiqueta""",
    "kpi_country_channel": f"""
SELECT id_pais, canal_venta, {_KPI},
       {dec_round("100.0 * CAST(count(*) FILTER (WHERE ind_descuento) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 2)}
         AS pct_con_descuento
FROM ventas_enr GROUP BY id_pais, canal_venta""",
    "top_n_products": """
SELECT art_id, categoria_n1, ventas_netas, unidades, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY categoria_n1 ORDER BY ventas_netas DESC, art_id) AS rn FROM (
    SELECT art_id, categoria_n1, CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas,
           CAST(sum(qty_vendida) AS BIGINT) AS unidades FROM ventas_enr GROUP BY art_id, categoria_n1) s) r
WHERE rn <= 10""",
    "top_n_slice": """
SELECT art_id, categoria_n1, ventas_netas, unidades, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY categoria_n1 ORDER BY ventas_netas DESC, art_id) AS rn FROM (
    SELECT art_id, categoria_n1, CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas,
           CAST(sum(qty_vendida) AS BIGINT) AS unidades FROM ventas_enr
    WHERE categoria_n1 IN ('Hogar y limpieza', 'Electronica y tecnologia') GROUP BY art_id, categoria_n1) s) r
WHERE rn <= 3""",
    "kpi_weekly": f"""
SELECT *, {_WEEK_CHANGE} AS variacion_pct FROM (
  SELECT id_pais, anio, semana, ventas_netas,
         lag(ventas_netas) OVER (PARTITION BY id_pais ORDER BY anio, semana) AS ventas_semana_anterior
  FROM (SELECT id_pais, CAST(year(fec_trans) AS INTEGER) AS anio, CAST(weekofyear(fec_trans) AS INTEGER) AS semana,
               CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas
        FROM ventas_enr GROUP BY id_pais, year(fec_trans), weekofyear(fec_trans)) w) x""",
    "kpi_weekly_iso": f"""
SELECT *, {_WEEK_CHANGE} AS variacion_pct FROM (
  SELECT a.id_pais, a.anio_iso, a.semana, a.ventas_netas, b.ventas_netas AS ventas_semana_anterior
  FROM semanas a LEFT JOIN semanas b ON b.id_pais = a.id_pais AND b.lunes = a.lunes - 7) x""",
    "dq_checks": _DQ,
    "run_volume": _RUNS,
    "volume_alert": _ALERT,
    "run_report": f"""
SELECT 'ingesta' AS seccion, batch_id AS nombre, CAST(volumen AS VARCHAR) AS valor, 'OK' AS estado FROM (
  SELECT *, row_number() OVER (ORDER BY ts DESC) AS n FROM ({_RUNS}) r) u WHERE n = 1
UNION ALL
SELECT 'calidad', tabla, CAST(salida AS VARCHAR), CASE WHEN rechazados > 0 THEN 'CON RECHAZOS' ELSE 'OK' END
FROM ({_QUALITY}) q
UNION ALL
SELECT 'verificacion', "check", valor_obtenido, estado FROM ({_DQ}) c
UNION ALL
SELECT 'volumen', batch_id, CAST(volumen_actual AS VARCHAR), CASE WHEN es_anomalia THEN 'ALERTA' ELSE 'OK' END
FROM ({_ALERT}) a""",
    "schema_conformance": _contract(),
    "domain_check": _domain(),
    "null_profile": _nulls(),
    "value_shares": _shares(),
    "numeric_summary": """
SELECT 'stock_fisico' AS columna, count(stock_fisico) AS filas,
       round(CAST(sum(stock_fisico) AS DOUBLE) / count(stock_fisico), 6) AS media,
       round(stddev_samp(stock_fisico), 6) AS desviacion, CAST(min(stock_fisico) AS DOUBLE) AS minimo,
       CAST(max(stock_fisico) AS DOUBLE) AS maximo, CAST(quantile_cont(stock_fisico, 0.25) AS DOUBLE) AS p25,
       CAST(quantile_cont(stock_fisico, 0.5) AS DOUBLE) AS p50, CAST(quantile_cont(stock_fisico, 0.75) AS DOUBLE) AS p75
FROM inv_stock_diario""",
    "month_histogram": """
SELECT CAST(month(fec_trans) AS INTEGER) AS mes, count(*) AS filas FROM trans_ventas GROUP BY month(fec_trans)""",
    "category_share": """
SELECT art_id, id_categ_n1, count(*) OVER (PARTITION BY id_categ_n1) AS articulos,
       round(peso / count(*) OVER (PARTITION BY id_categ_n1)
             / (SELECT CAST(sum(w) AS DOUBLE) FROM (SELECT DISTINCT id_categ_n1, w FROM pesos) t), 12) AS peso
FROM (SELECT art_id, id_categ_n1, CAST(w AS DOUBLE) AS peso FROM pesos) p""",
    "snapshot_spine": """
SELECT id_tienda, fec_snapshot, count(*) AS pares, count(DISTINCT art_id) AS articulos,
       CAST(sum(art_id) AS BIGINT) AS suma_art_id
FROM (SELECT DISTINCT art_id, id_tienda, CAST(ref - CAST(n AS INTEGER) AS DATE) AS fec_snapshot
      FROM inv_stock_diario CROSS JOIN fecha_ref CROSS JOIN (SELECT range AS n FROM range(30)) d) s
GROUP BY id_tienda, fec_snapshot""",
    "measures_by_country": """
SELECT id_pais, CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas, CAST(sum(vr_venta_bruto) AS DOUBLE) AS venta_bruta,
       CAST(sum(descuento_aplicado) AS DOUBLE) AS descuento_total,
       CAST(sum(descuento_aplicado) AS DOUBLE) / NULLIF(CAST(sum(vr_venta_bruto) AS DOUBLE), 0) AS tasa_descuento,
       count(DISTINCT id_trans) AS transacciones, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       CAST(sum(vr_venta_neto) AS DOUBLE) / CAST(count(DISTINCT id_trans) AS DOUBLE) AS ticket_promedio
FROM ventas_enr GROUP BY id_pais""",
    "discount_rate_by_category": """
SELECT categoria_n1, CAST(sum(descuento_aplicado) AS DOUBLE) / NULLIF(CAST(sum(vr_venta_bruto) AS DOUBLE), 0) AS tasa_descuento
FROM ventas_enr GROUP BY categoria_n1""",
    "same_day_last_week": """
SELECT a.fec_trans AS fecha, a.id_pais, a.neto AS ventas_netas, b.neto AS ventas_semana_anterior,
       (a.neto - b.neto) / NULLIF(b.neto, 0) AS variacion_semanal
FROM dia_pais a LEFT JOIN dia_pais b ON b.id_pais = a.id_pais AND b.fec_trans = a.fec_trans - 7""",
    "daily_trend": """
SELECT c.fecha, CAST(a.neto AS DOUBLE) AS ventas_netas, CAST(b.neto AS DOUBLE) AS ventas_semana_anterior,
       (CAST(a.neto AS DOUBLE) - CAST(b.neto AS DOUBLE)) / NULLIF(CAST(b.neto AS DOUBLE), 0) AS variacion_semanal
FROM calendario c LEFT JOIN venta_dia a ON a.fec_trans = c.fecha LEFT JOIN venta_dia b ON b.fec_trans = c.fecha - 7""",
    "sales_sliced": """
SELECT id_trans, fec_trans, id_pais, canal_venta, categoria_n1, CAST(vr_venta_neto AS DOUBLE) AS vr_venta_neto
FROM ventas_enr
WHERE fec_trans BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND id_pais IN ('CO', 'MX', 'CL')
  AND canal_venta IN ('TIENDA', 'WEB')
  AND categoria_n1 IN ('Alimentos y bebidas', 'Hogar y limpieza', 'Ropa y calzado basico')""",
    "late_rows_by_day": f"""
SELECT canal_venta, count(*) AS filas_tardias, min(fec_trans) AS desde, max(fec_trans) AS hasta FROM trans_ventas
WHERE canal_venta = 'APP'
  AND fec_trans <= (SELECT max(fec_trans) FROM trans_ventas WHERE fec_trans <= {SPLIT} AND canal_venta <> 'APP')
GROUP BY canal_venta""",
    "silver_incremental": """
SELECT tabla_origen, motivo, count(*) AS registros, CAST(sum(CAST(id AS HUGEINT)) AS VARCHAR) AS suma_claves FROM (
  SELECT 'mstr_proveedores' AS tabla_origen, 'valido' AS motivo, id_proveedor AS id FROM mstr_proveedores
  UNION ALL SELECT 'mstr_tiendas', 'valido', id_tienda FROM mstr_tiendas
  UNION ALL SELECT 'mstr_articulos', 'valido', art_id FROM mstr_articulos
  UNION ALL SELECT 'crm_miembros', 'valido', id_miembro FROM crm_miembros
  UNION ALL SELECT 'inv_stock_diario', 'valido', id_snapshot FROM inv_stock_diario
  UNION ALL SELECT 'trans_ventas', coalesce(motivo, 'valido'), id_trans FROM ventas_marcadas
  UNION ALL SELECT 'post_devoluciones', coalesce(motivo, 'valido'), id_devolucion FROM devoluciones_marcadas
) t GROUP BY tabla_origen, motivo""",
    "aggregates_by_month": f"""
SELECT fec_trans, id_pais, id_tienda, canal_venta, categoria_n1, {_KPI}
FROM ventas_enr GROUP BY fec_trans, id_pais, id_tienda, canal_venta, categoria_n1""",
    "matrix_subtotals": """
SELECT id_pais, canal_venta, categoria_n1, CAST(GROUPING(id_pais, canal_venta, categoria_n1) AS INTEGER) AS nivel,
       CAST(sum(vr_venta_neto) AS DOUBLE) AS ventas_netas, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       count(DISTINCT id_trans) AS transacciones,
       CAST(sum(vr_venta_neto) AS DOUBLE) / CAST(count(DISTINCT id_trans) AS DOUBLE) AS ticket_promedio,
       CAST(sum(descuento_aplicado) AS DOUBLE) / NULLIF(CAST(sum(vr_venta_bruto) AS DOUBLE), 0) AS tasa_descuento
FROM ventas_enr
GROUP BY GROUPING SETS ((id_pais, canal_venta, categoria_n1), (id_pais, canal_venta), (id_pais), ())""",
    "transactions_sketched": """
SELECT id_pais, canal_venta, CAST(sum(qty_vendida) AS BIGINT) AS unidades,
       count(DISTINCT id_trans // 1000000) AS transacciones, TRUE AS dentro_del_margen
FROM ventas_enr GROUP BY id_pais, canal_venta""",
    "returns_to_bucketed_sales": """
SELECT * REPLACE (CAST(vr_reembolso AS DOUBLE) AS vr_reembolso, CAST(precio_venta_original AS DOUBLE) AS precio_venta_original)
FROM fact_devoluciones""",
    "schema_generations": """
SELECT id_tienda, CASE WHEN id_tienda % 3 <> 0 THEN nom_tienda END AS nom_tienda, CAST(id_ciudad AS BIGINT) AS id_ciudad, id_pais,
       CASE WHEN id_tienda % 2 = 0 OR id_tienda % 3 = 0 THEN metros_cuadrados END AS metros_cuadrados,
       CASE WHEN id_tienda % 3 = 0 THEN 'lote-3' WHEN id_tienda % 2 = 0 THEN 'lote-2' ELSE 'lote-1' END AS _batch_id
FROM mstr_tiendas""",
    "load_metadata": """
SELECT 'mstr_tiendas' AS tabla, count(*) AS filas_cargadas, '2002-01-01 02:00:00' AS fecha_carga, CAST(8 AS BIGINT) AS columnas,
       'activo boolean, fec_apertura date, id_ciudad int, id_pais string, id_tienda bigint, metros_cuadrados int, '
       || 'nom_tienda string, tipo_tienda string' AS tipos FROM mstr_tiendas
UNION ALL
SELECT 'mstr_articulos', count(*), '2002-01-01 02:00:00', 12,
       'activo boolean, art_id bigint, cod_barra string, desc_art string, fec_alta date, id_categ_n1 int, id_categ_n2 int, '
       || 'id_categ_n3 int, id_proveedor bigint, peso_kg decimal(8,3), precio_lista decimal(12,2), unid_medida string'
FROM mstr_articulos""",
    "append_runs": """
SELECT tabla, count(*) AS corridas, CAST(sum(registros) AS BIGINT) AS registros FROM log_ingesta GROUP BY tabla""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in _SQL.items()}
