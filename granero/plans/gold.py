"""Dimensions, facts and the calendar."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from granero.functions.columns import first_match, lookup, money
from granero.functions.dates import calendar_columns, within_trailing
from granero.operators.dedup import first_per_key
from granero.operators.ranking import global_ntile, group_mode
from granero.operators.references import left_lookup

# Labels, margins and windows of the model.
CATEGORY_LABELS = {
    1: "Alimentos y bebidas",
    2: "Cuidado personal e higiene",
    3: "Hogar y limpieza",
    4: "Electronica y tecnologia",
    5: "Ropa y calzado basico",
    6: "Bebes y maternidad",
}
NO_CATEGORY = "Sin categoria"
MARGINS = {
    1: Decimal("0.18"),
    2: Decimal("0.30"),
    3: Decimal("0.28"),
    4: Decimal("0.22"),
    5: Decimal("0.45"),
    6: Decimal("0.35"),
}
DEFAULT_MARGIN = Decimal("0.20")
STORE_TYPE_LABELS = {
    "HIPER": "Hipermercado",
    "SUPER": "Supermercado de barrio",
    "CONVE": "Tienda de conveniencia",
}
OTHER_STORE_TYPE = "Otro"
DISTRIBUTION_ZONES = {
    "CO": "CD Bogota",
    "MX": "CD Ciudad de Mexico",
    "CL": "CD Santiago",
    "PE": "CD Santiago",
    "EC": "CD Santiago",
}
NO_ZONE = "Sin asignar"
RETURN_REASON_LABELS = {
    "DEFECTUOSO": "Articulo defectuoso o danado",
    "NO_DESEADO": "Cliente cambio de opinion",
    "TALLA": "Talla incorrecta",
    "INCOMPLETO": "Paquete incompleto",
    "NO_CORRESPONDE": "No corresponde a lo solicitado",
    "VENCIDO": "Producto vencido",
    "OTRO": "Otro motivo",
}
UNKNOWN_REASON = "Sin clasificar"
DEFAULT_AGE_RANGE = "26-35"
GENDER_NOT_GIVEN = "No informado"
ANONYMOUS = "ANONIMO"
CONSUMPTION_DAYS = 14
STOCKOUT_DAYS = 7
RFM_WINDOW_DAYS = 90
RFM_ACTIVE_DAYS = 180
# End of fixed values.


def standard_gender(col: str = "genero") -> Column:
    return F.when(F.col(col).isin("M", "F"), F.col(col)).otherwise(GENDER_NOT_GIVEN)


def dim_products(articles: DataFrame, suppliers: DataFrame) -> DataFrame:
    origin = suppliers.select(
        "id_proveedor",
        F.col("pais_origen").alias("proveedor_pais"),
        F.col("calificacion_calidad").alias("proveedor_calificacion"),
    )
    margin = lookup(F.col("id_categ_n1"), MARGINS, DEFAULT_MARGIN)
    return left_lookup(articles, origin, "id_proveedor").select(
        "art_id",
        "desc_art",
        "id_categ_n1",
        lookup(F.col("id_categ_n1"), CATEGORY_LABELS, NO_CATEGORY).alias("categoria_n1"),
        "id_categ_n2",
        "id_categ_n3",
        "id_proveedor",
        "proveedor_pais",
        "proveedor_calificacion",
        "precio_lista",
        margin.alias("margen_estimado_pct"),
        money(F.col("precio_lista") * (F.lit(1) + margin)).alias("precio_con_margen"),
        "unid_medida",
        "activo",
    )


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select(
        "id_tienda",
        "nom_tienda",
        "tipo_tienda",
        lookup(F.col("tipo_tienda"), STORE_TYPE_LABELS, OTHER_STORE_TYPE).alias("tipo_tienda_desc"),
        "id_ciudad",
        "id_pais",
        lookup(F.col("id_pais"), DISTRIBUTION_ZONES, NO_ZONE).alias("zona_distribucion"),
        "metros_cuadrados",
        "activo",
    )


def dim_customers(members: DataFrame, ref: Column) -> DataFrame:
    """Members with a missing age range filled from their channel's usual one."""
    usual = group_mode(members, "canal_pref", "rango_edad", "_habitual")
    return left_lookup(members, usual, "canal_pref").select(
        "id_miembro",
        "fec_registro",
        F.date_diff(ref, "fec_registro").alias("antiguedad_dias"),
        "id_ciudad",
        standard_gender().alias("genero_std"),
        F.coalesce("rango_edad", "_habitual", F.lit(DEFAULT_AGE_RANGE)).alias("rango_edad"),
        "canal_pref",
        "activo",
        "fec_ultima_compra",
    )


def fact_sales(sales: DataFrame) -> DataFrame:
    discount = F.coalesce("descuento_aplicado", F.lit(Decimal("0.00")))
    gross = money(F.col("qty_vendida").cast("decimal(10,0)") * F.col("precio_unitario_venta"))
    return sales.select(
        "id_trans",
        F.coalesce(F.col("id_miembro").cast("string"), F.lit(ANONYMOUS)).alias("id_cliente"),
        "id_miembro",
        "id_tienda",
        "art_id",
        F.to_date("fec_trans").alias("fec_trans"),
        "hra_trans",
        "qty_vendida",
        "precio_unitario_venta",
        discount.alias("descuento_aplicado"),
        gross.alias("vr_venta_bruto"),
        money(gross - discount).alias("vr_venta_neto"),
        (discount > 0).alias("ind_descuento"),
        "tipo_pago",
        "canal_venta",
    )


def trailing_consumption(sales: DataFrame, ref: Column, days: int = CONSUMPTION_DAYS) -> DataFrame:
    """Units sold per article over all stores in the last ``days`` days."""
    recent = sales.where(within_trailing("fec_trans", ref, days))
    return recent.groupBy("art_id").agg(F.sum("qty_vendida").cast("bigint").alias(f"consumo_{days}d"))


def latest_snapshot(stock: DataFrame) -> DataFrame:
    newest = [F.desc("fec_snapshot"), F.desc("id_snapshot")]
    return first_per_key(stock, ["art_id", "id_tienda"], newest, unique=True)


def fact_inventory(stock: DataFrame, sales: DataFrame, ref: Column) -> DataFrame:
    """Latest stock per article and store, with days of cover and the stock-out alert."""
    units = F.coalesce("consumo_14d", F.lit(0)).cast("bigint")
    daily = units.cast("double") / F.lit(float(CONSUMPTION_DAYS))
    cover = F.when(units > 0, F.round(F.try_divide(F.col("stock_fisico").cast("double"), daily), 1))
    return left_lookup(latest_snapshot(stock), trailing_consumption(sales, ref), "art_id").select(
        "id_snapshot",
        "art_id",
        "id_tienda",
        "fec_snapshot",
        "stock_fisico",
        "stock_minimo_config",
        (F.col("stock_fisico") - F.col("stock_minimo_config")).alias("dif_stock_minimo"),
        units.alias("consumo_14d"),
        daily.alias("consumo_diario"),
        cover.alias("cobertura_dias"),
        F.coalesce(cover < STOCKOUT_DAYS, F.lit(False)).alias("alerta_quiebre"),
    )


def stockout_count(inventory: DataFrame) -> DataFrame:
    return inventory.where("alerta_quiebre").agg(F.count("*").alias("alertas"))


def fact_returns(returns: DataFrame, sales: DataFrame) -> DataFrame:
    """Returns with the price of the original sale and the reason in words."""
    original = sales.select(
        F.col("id_trans").alias("id_trans_origen"), F.col("precio_unitario_venta").alias("precio_venta_original")
    )
    return left_lookup(returns, original, "id_trans_origen").select(
        "id_devolucion",
        "id_trans_origen",
        "art_id",
        "id_tienda",
        "fec_devolucion",
        "qty_devuelta",
        "motivo_cod",
        lookup(F.col("motivo_cod"), RETURN_REASON_LABELS, UNKNOWN_REASON).alias("motivo_desc"),
        "canal_devolucion",
        "estado_devolucion",
        F.coalesce("vr_reembolso", F.lit(Decimal("0.00"))).alias("vr_reembolso"),
        "precio_venta_original",
    )


def active_members(sales: DataFrame, ref: Column) -> DataFrame:
    known = sales.where(F.col("id_miembro").isNotNull() & within_trailing("fec_trans", ref, RFM_ACTIVE_DAYS))
    return known.select("id_miembro").distinct()


def rfm_base(sales: DataFrame, ref: Column) -> DataFrame:
    """Recency, frequency and value of the members active in the last 180 days.

    The last purchase of an active member lies inside the active window, so the
    history before it is never read and one aggregate gives all three figures.
    """
    known = sales.where(F.col("id_miembro").isNotNull() & within_trailing("fec_trans", ref, RFM_ACTIVE_DAYS))
    recent = within_trailing("fec_trans", ref, RFM_WINDOW_DAYS)
    totals = known.groupBy("id_miembro").agg(
        F.max("fec_trans").alias("_ultima"),
        F.count_if(recent).alias("frecuencia"),
        F.coalesce(F.sum(F.when(recent, F.col("vr_venta_neto"))), F.lit(Decimal("0.00"))).alias("monetario"),
    )
    return totals.select("id_miembro", F.date_diff(ref, "_ultima").alias("recencia_dias"), "frecuencia", "monetario")


def rfm_label(champion: int = 4, loyal: int = 3, recent: int = 4, at_risk: int = 2) -> Column:
    """The first rule that holds; a missing score satisfies none."""
    r, f, m = F.col("R"), F.col("F"), F.col("M")
    return first_match(
        [
            ((r >= champion) & (f >= champion) & (m >= champion), "Champions"),
            ((r >= loyal) & (f >= loyal), "Leales"),
            (r >= recent, "Recientes"),
            (r <= at_risk, "En riesgo"),
        ],
        "Ocasionales",
    )


def fact_rfm(sales: DataFrame, ref: Column) -> DataFrame:
    """Quintile scores over all active members; few days since the last purchase score high."""
    base = rfm_base(sales, ref).withColumn("_cercania", -F.col("recencia_dias"))
    scored = global_ntile(
        base,
        5,
        {
            "R": ["_cercania", "id_miembro"],
            "F": ["frecuencia", "id_miembro"],
            "M": ["monetario", "id_miembro"],
        },
    )
    return scored.select(
        "id_miembro",
        "recencia_dias",
        "frecuencia",
        "monetario",
        "R",
        "F",
        "M",
        F.format_string("R%d-F%d-M%d", "R", "F", "M").alias("segmento_rfm"),
        rfm_label().alias("etiqueta"),
    )


def calendar(sales: DataFrame) -> DataFrame:
    """Every day from the first to the last sale."""
    span = sales.agg(F.min("fec_trans").alias("desde"), F.max("fec_trans").alias("hasta"))
    days = span.select(F.explode(F.sequence("desde", "hasta", F.expr("interval 1 day"))).alias("fecha"))
    return days.select("fecha", *calendar_columns("fecha"))


def snapshot_spine(pairs: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """Each (article, store) pair on each day of a period: generated per row, not crossed."""
    days = F.explode(F.sequence(first_day, last_day, F.expr("interval 1 day")))
    return pairs.select("art_id", "id_tienda").distinct().withColumn("fec_snapshot", days)
