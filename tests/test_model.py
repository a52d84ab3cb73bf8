import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granero.catalog import ARTICLES, MEMBERS, RETURNS, SALES, STOCK, STORES
from granero.functions.columns import expose, lookup, percent
from granero.functions.dates import latest_date
from granero.operators import profile
from granero.operators.volume import volume_alert
from granero.plans import gold, kpis, measures
from granero.plans.measures import Star, measures_by

from tests.conftest import rows
from tests.test_cleaning import sales

D = dt.date(2001, 5, 1)


def line(n, **kw):
    return dict(id_trans=n, **kw)


def members(spark, *records):
    base = dict(
        id_miembro=1, fec_registro=D, id_ciudad=None, genero=None, rango_edad=None, canal_pref=None, activo=True,
        fec_ultima_compra=None,
    )
    return spark.createDataFrame([{**base, **r} for r in records], MEMBERS.schema)


def star(spark, *records, unique=True):
    facts = gold.fact_sales(sales(spark, *records))
    stores = spark.createDataFrame([(1, "CO"), (2, "MX"), (3, "CO")], "id_tienda bigint, id_pais string")
    products = spark.createDataFrame([(10, "A"), (11, "B")], "art_id bigint, categoria_n1 string")
    return Star(facts, {"id_tienda": stores, "art_id": products}, unique)


def test_lookup_default_and_null(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    assert rows(df.select("k", lookup(F.col("k"), {1: "uno"}, "otro").alias("v"))) == [(1, "uno"), (9, "otro"), (None, "otro")]


def test_fact_sales_rules(spark):
    got = rows(
        gold.fact_sales(
            sales(
                spark,
                line(1, id_miembro=None, descuento_aplicado=Decimal("1.25"), qty_vendida=3, precio_unitario_venta=Decimal("2.35")),
                line(2, descuento_aplicado=Decimal("0.00")),
            )
        ),
        "id_trans", "id_cliente", "descuento_aplicado", "vr_venta_bruto", "vr_venta_neto", "ind_descuento",
    )
    assert got == [
        (1, "ANONIMO", Decimal("1.25"), Decimal("7.05"), Decimal("5.80"), True),
        (2, "7", Decimal("0.00"), Decimal("10.00"), Decimal("10.00"), False),
    ]


def test_dim_customers_fills_ages(spark):
    df = members(
        spark,
        dict(id_miembro=1, canal_pref="WEB", rango_edad="65+", genero="M"),
        dict(id_miembro=2, canal_pref="WEB", rango_edad="18-25", genero="X"),
        dict(id_miembro=3, canal_pref="WEB", rango_edad="18-25"),
        dict(id_miembro=4, canal_pref="WEB", genero="F"),
        dict(id_miembro=5, canal_pref=None),
        dict(id_miembro=6, canal_pref=None, rango_edad="65+"),
        dict(id_miembro=7, canal_pref="APP"),
    )
    got = gold.dim_customers(df, F.lit(dt.date(2001, 5, 11)))
    assert rows(got, "id_miembro", "rango_edad", "genero_std", "antiguedad_dias") == [
        (1, "65+", "M", 10), (2, "18-25", "No informado", 10), (3, "18-25", "No informado", 10), (4, "18-25", "F", 10),
        (5, "26-35", "No informado", 10), (6, "65+", "No informado", 10), (7, "26-35", "No informado", 10),
    ]


def test_products_without_category_or_supplier(spark):
    base = {c.name: None for c in ARTICLES.columns}
    art = spark.createDataFrame(
        [
            {**base, "art_id": 1, "id_categ_n1": 9, "id_proveedor": 1, "precio_lista": Decimal("10.01")},
            {**base, "art_id": 2, "id_categ_n1": 1, "id_proveedor": 8, "precio_lista": Decimal("100.25")},
        ],
        ARTICLES.schema,
    )
    prov = spark.createDataFrame([(1, "CO", Decimal("4.50"))], "id_proveedor bigint, pais_origen string, calificacion_calidad decimal(3,2)")
    assert rows(gold.dim_products(art, prov), "art_id", "categoria_n1", "precio_con_margen", "proveedor_pais") == [
        (1, "Sin categoria", Decimal("12.01"), "CO"), (2, "Alimentos y bebidas", Decimal("118.30"), None),
    ]


def stock(spark, *records):
    base = dict(
        id_snapshot=1, art_id=10, id_tienda=1, fec_snapshot=D, stock_fisico=5, stock_transito=None, stock_reservado=None,
        stock_minimo_config=3, stock_maximo_config=9,
    )
    return spark.createDataFrame([{**base, **r} for r in records], STOCK.schema)


def test_inventory_cover_and_alert(spark):
    facts = gold.fact_sales(
        sales(
            spark,
            line(1, qty_vendida=14, fec_trans=D), line(2, id_tienda=2, qty_vendida=14, fec_trans=D - dt.timedelta(13)),
            line(3, qty_vendida=99, fec_trans=D - dt.timedelta(14)),  # just outside
        )
    )
    df = stock(
        spark,
        dict(id_snapshot=1, stock_fisico=50, fec_snapshot=D - dt.timedelta(1)),
        dict(id_snapshot=2, stock_fisico=13), dict(id_snapshot=3, stock_fisico=14),  # same day: higher id is later
        dict(id_snapshot=4, id_tienda=2, stock_fisico=13), dict(id_snapshot=5, art_id=11, stock_fisico=0),
    )
    got = gold.fact_inventory(df, facts, latest_date(facts, "fec_trans"))
    assert rows(got, "id_snapshot", "consumo_14d", "consumo_diario", "cobertura_dias", "alerta_quiebre", "dif_stock_minimo") == [
        (3, 28, 2.0, 7.0, False, 11), (4, 28, 2.0, 6.5, True, 10), (5, 0, 0.0, None, False, -3),
    ]
    assert gold.stockout_count(got).first()["alertas"] == 1


def test_returns_keep_rows_without_sale(spark):
    base = {c.name: None for c in RETURNS.columns}
    df = spark.createDataFrame(
        [
            {**base, "id_devolucion": 1, "id_trans_origen": 1, "motivo_cod": "TALLA"},
            {**base, "id_devolucion": 2, "id_trans_origen": 5, "motivo_cod": "?", "vr_reembolso": Decimal("3.00")},
        ],
        RETURNS.schema,
    )
    got = gold.fact_returns(df, gold.fact_sales(sales(spark, line(1))))
    assert rows(got, "id_devolucion", "motivo_desc", "vr_reembolso", "precio_venta_original") == [
        (1, "Talla incorrecta", Decimal("0.00"), Decimal("5.00")), (2, "Sin clasificar", Decimal("3.00"), None),
    ]


def test_rfm_windows_and_few_members(spark):
    ref = D
    facts = gold.fact_sales(
        sales(
            spark,
            line(1, id_miembro=1, fec_trans=ref), line(2, id_miembro=1, fec_trans=ref - dt.timedelta(89)),
            line(3, id_miembro=2, fec_trans=ref - dt.timedelta(90)),   # active, outside the 90 days
            line(4, id_miembro=3, fec_trans=ref - dt.timedelta(180)),  # not active
            line(5, id_miembro=None, fec_trans=ref),
        )
    )
    got = gold.fact_rfm(facts, F.lit(ref))
    assert rows(got, "id_miembro", "recencia_dias", "frecuencia", "monetario", "segmento_rfm", "etiqueta") == [
        (1, 0, 2, Decimal("20.00"), "R2-F2-M2", "En riesgo"), (2, 90, 0, Decimal("0.00"), "R1-F1-M1", "En riesgo"),
    ]
    assert rows(gold.active_members(facts, F.lit(ref))) == [(1,), (2,)]


@pytest.mark.parametrize(
    "r, f, m, label",
    [(5, 4, 4, "Champions"), (5, 4, 3, "Leales"), (3, 3, 1, "Leales"), (4, 2, 5, "Recientes"), (2, 5, 5, "En riesgo"),
     (3, 2, 5, "Ocasionales")],
)
def test_rfm_labels(spark, r, f, m, label):
    df = spark.createDataFrame([(r, f, m)], "R int, F int, M int")
    assert df.select(gold.rfm_label()).first()[0] == label


def test_calendar_is_dense_around_new_year(spark):
    facts = sales(spark, line(1, fec_trans=dt.date(2024, 12, 28)), line(2, fec_trans=dt.date(2025, 1, 5)))
    got = gold.calendar(facts)
    assert got.count() == 9
    sunday = got.where("fecha = '2024-12-29'").first()
    assert (sunday["dia_semana"], sunday["nombre_dia"], sunday["nombre_mes"], sunday["es_fin_semana"], sunday["semana_anio"]) == (
        1, "domingo", "diciembre", True, 52,
    )
    assert got.where("fecha = '2024-12-30'").first()["semana_anio"] == 1
    assert gold.calendar(facts.limit(0)).count() == 0


def test_measures_recompute_ratios_per_slice(spark):
    s = star(
        spark,
        line(1, id_tienda=1, descuento_aplicado=Decimal("1.00")), line(2, id_tienda=3), line(3, id_tienda=2, qty_vendida=0),
        line(4, id_tienda=77),
    )
    names = ["ventas_netas", "venta_bruta", "descuento_total", "tasa_descuento", "transacciones", "unidades", "ticket_promedio"]
    assert rows(measures_by(s, ["id_pais"], names)) == [
        ("CO", 19.0, 20.0, 1.0, 0.05, 2, 4, 9.5), ("MX", 0.0, 0.0, 0.0, None, 1, 0, 0.0), (None, 10.0, 10.0, 0.0, 0.0, 1, 2, 10.0),
    ]
    fine = measures_by(s, ["id_pais"], names, coarse=False)
    assert rows(fine) == rows(measures_by(s, ["id_pais"], names))


def test_repeated_ids_are_counted_once_when_not_declared_unique(spark):
    s = star(spark, line(1), line(1, hra_trans="10:00:00"), line(2), unique=False)
    assert rows(measures_by(s, ["id_pais"], ["transacciones", "unidades"])) == [("CO", 2, 6)]


def test_sum_over_any_grouping_is_the_total(spark):
    s = star(spark, *[line(i, id_tienda=1 + i % 4, art_id=10 + i % 3, qty_vendida=i % 5) for i in range(200)])
    total = s.sales.agg(F.sum("vr_venta_neto").cast("double")).first()[0]
    for by in (["id_pais"], ["categoria_n1"], ["canal_venta", "id_pais", "categoria_n1"], ["art_id", "categoria_n1"], ["fec_trans"]):
        got = measures_by(s, by, ["ventas_netas"]).agg(F.sum("ventas_netas")).first()[0]
        assert got == pytest.approx(total), by


def test_same_day_last_week_needs_that_very_day(spark):
    days = [0, 6, 7, 15]  # 7 has day 0 before it; 15 has none, its row before is 7
    s = star(spark, *[line(i, fec_trans=D + dt.timedelta(d), qty_vendida=d + 1) for i, d in enumerate(days)])
    got = measures.same_day_last_week(s, ["id_pais"])
    assert [r[2:] for r in rows(got)] == [(5.0, None, None), (35.0, None, None), (40.0, 5.0, 7.0), (80.0, None, None)]
    trend = measures.daily_trend(s, gold.calendar(s.sales))
    assert trend.count() == 16
    assert trend.where(F.col("fecha") == D + dt.timedelta(13)).first()[1:] == (None, 35.0, None)


def test_zero_week_before(spark):
    s = star(spark, line(1, fec_trans=D, qty_vendida=0), line(2, fec_trans=D + dt.timedelta(7)))
    assert [r["variacion_semanal"] for r in measures.same_day_last_week(s).orderBy("fecha").collect()] == [None, None]
    assert [r["variacion_pct"] for r in kpis.weekly_sales(s).collect()] == [None, None]


def test_weeks_over_new_year(spark):
    dates = [dt.date(2024, 12, 23), dt.date(2024, 12, 30), dt.date(2025, 1, 2), dt.date(2025, 1, 13)]
    s = star(spark, *[line(i, fec_trans=d, qty_vendida=10 * (i + 1)) for i, d in enumerate(dates)])
    assert [tuple(r)[1:5] for r in kpis.weekly_sales(s).collect()] == [
        (2024, 1, 100.0, None), (2024, 52, 50.0, 100.0), (2025, 1, 150.0, 50.0), (2025, 3, 200.0, 150.0),
    ]
    assert [tuple(r)[1:] for r in kpis.weekly_sales_iso(s).collect()] == [
        (2024, 52, 50.0, None, None), (2025, 1, 250.0, 50.0, 400.0), (2025, 3, 200.0, None, None),
    ]


def test_return_without_sales_cell_is_left_out(spark):
    base = {c.name: None for c in RETURNS.columns}
    back = spark.createDataFrame(
        [
            {**base, "art_id": 10, "canal_devolucion": "WEB", "qty_devuelta": 1},
            {**base, "art_id": 10, "canal_devolucion": "APP", "qty_devuelta": 5},
        ],
        RETURNS.schema,
    )
    s = star(spark, line(1, qty_vendida=3), line(2, art_id=11, qty_vendida=0))
    assert rows(kpis.return_rate(s, back)) == [("A", "WEB", 3, 1, 33.33), ("B", "WEB", 0, 0, None)]


def test_slicers(spark):
    s = star(spark, line(1), line(2, id_tienda=2), line(3, art_id=99), line(4, canal_venta="APP"), line(5, fec_trans=dt.date(2000, 1, 1)))
    assert rows(measures.sliced(s), "id_trans") == [(1,), (2,), (4,), (5,)]
    got = measures.sliced(s, first_day=D, countries=["CO"], channels=["WEB"], categories=["A"])
    assert rows(got, "id_trans") == [(1,)]


def log(spark, *volumes):
    return spark.createDataFrame(
        [(f"b{i}", "t", v, dt.datetime(2001, 1, 1 + i)) for i, v in enumerate(volumes)],
        "batch_id string, tabla string, registros bigint, ts_ejecucion timestamp",
    )


@pytest.mark.parametrize(
    "volumes, want",
    [
        ([100], []),
        ([100, 131], [("b1", 131, 100.0, 31.0, True)]),
        ([100, 130], [("b1", 130, 100.0, 30.0, False)]),
        ([100, 50], [("b1", 50, 100.0, -50.0, True)]),
        ([0, 0, 7], [("b2", 7, 0.0, 0.0, False)]),
        ([10**6] + [100] * 7 + [100], [("b8", 100, 100.0, 0.0, False)]),
    ],
)
def test_volume_alert(spark, volumes, want):
    assert rows(volume_alert(log(spark, *volumes))) == want


def test_profile_on_dirty_input(spark):
    dirty = spark.createDataFrame(
        [("1", "x" * 130, "HIPER", "3", "CO", None, "true", "2001-01-01", "drop me"),
         ("dos", "ok", "OTRO", "3", None, "50", "true", "not a date", "drop me")],
        "id_tienda string, nom_tienda string, tipo_tienda string, id_ciudad string, id_pais string, "
        "metros_cuadrados string, activo string, fec_apertura string, sobra string",
    )
    fit = profile.conform(dirty, STORES)
    assert fit.schema.simpleString() == STORES.schema.simpleString()
    found = {r["columna"]: r["violaciones"] for r in profile.contract_violations(fit, STORES).collect()}
    assert {k for k, v in found.items() if v} == {"id_tienda", "nom_tienda", "id_pais", "fec_apertura"}
    assert rows(profile.domain_violations(fit, STORES).where("violaciones > 0"), "columna", "violaciones") == [("tipo_tienda", 1)]
    assert dict(rows(profile.null_profile(fit)))["fec_apertura"] == 1
    assert rows(profile.value_shares(fit, ["id_pais"])) == [("id_pais", "CO", 1, 0.5), ("id_pais", None, 1, 0.5)]


def test_weight_shares_add_up_to_one(spark):
    df = spark.createDataFrame([(i, 1 if i < 3 else 2) for i in range(5)], "id int, g int")
    got = profile.weight_shares(df, "id", "g", {1: Decimal("0.3"), 2: Decimal("0.5"), 3: Decimal("0.2")})
    weights = [r["peso"] for r in got.orderBy("id").collect()]
    assert sum(weights) == pytest.approx(1.0)
    assert weights[0] == pytest.approx(0.3 / 3 / 0.8) and weights[4] == pytest.approx(0.5 / 2 / 0.8)


def test_percent_and_expose(spark):
    df = spark.createDataFrame([(Decimal("1.50"), 0), (Decimal("1.50"), 3)], "a decimal(5,2), b int")
    assert rows(expose(df.select("a", percent(F.col("a"), F.col("b")).alias("p")))) == [(1.5, 50.0), (1.5, None)]
