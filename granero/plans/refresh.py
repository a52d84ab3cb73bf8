"""One run over all layers: ingest, clean, model, aggregate, check.

Every layer reads the tables the layer before it has written, so no stage
recomputes another. A run that broke off is started again with the same batch id:
what it stored is replaced, not added to. A run on top of finished ones takes in
what is new: batches, the months they touch, and what refers to rows that changed.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from granero.catalog import TABLES, TableSpec
from granero.functions.dates import in_months, latest_date, month_of
from granero.operators.dedup import MOST_WORDS, repeated_words
from granero.operators.ingest import INGEST_PARTITIONS, after, day_prints, late_by_day, mark_of, stamp
from granero.operators.quarantine import REASON, quality_counted, rejected
from granero.operators.references import PackedKeys, packed_keys, union_all
from granero.operators.volume import volume_alert
from granero.plans import checks, gold, kpis
from granero.plans.measures import Star, is_unique
from granero.plans.silver import cleaned
from granero.session import stage, together
from granero.sources.tables import (
    Layers,
    batch_folder,
    live_batches,
    live_paths,
    overwrite_slices,
    put_batch,
    read_newest,
    read_table,
    replace_table,
    settle,
    table_exists,
)

_STATE = "_estado"
_VALID, _REJECTED = "valido", "rechazado"
_LOG_SCHEMA = (
    "tabla string, registros bigint, segundos double, batch_id string, ts_ejecucion timestamp, modo string"
)
_LATE_SCHEMA = "tabla string, tardias bigint, batch_id string"
_NOTE_SCHEMA = "batch_id string, ts timestamp, as_of date, estado string"
_PRINT_SCHEMA = "dia date, filas bigint, suma_a bigint, suma_b bigint"
COPIES = "_copias"
SLICE = "_mes"


@dataclass(frozen=True)
class Run:
    """What a run has to know: its date and stamp, its id, where the rows come from.

    Sales and their daily aggregate are stored by month; ``partitions`` names
    other output partition columns of model tables, for example
    ``{"kpi_ventas_semanales": ["anio"]}``. ``settle_after`` is the number of
    batches beyond which the older ones are settled.
    """

    as_of: dt.date
    ts: str
    batch_id: str
    system: str
    incremental: bool = True
    watermark_cap: bool = True
    partitions: Mapping[str, list[str]] = field(default_factory=dict)
    settle_after: int = 8


def _audited(spec: TableSpec) -> T.StructType:
    extra = [("_ts_ingesta", T.TimestampType()), ("_sistema_fuente", T.StringType()), ("_batch_id", T.StringType())]
    extra += [(c, T.IntegerType()) for c in INGEST_PARTITIONS]
    return T.StructType(spec.schema.fields + [T.StructField(n, t, True) for n, t in extra])


def read_bronze(
    spark: SparkSession,
    layers: Layers,
    spec: TableSpec,
    without: Sequence[str] = (),
    only: Sequence[str] | None = None,
    keys_first: bool = True,
) -> DataFrame:
    """The valid rows of all batches but those in ``without``, or of the batches in ``only``: per key those of the latest run."""
    path = layers.path("bronze", spec.name)
    return read_newest(spark, path, spec.key, _audited(spec), fmt=layers.fmt, without=without, only=only, keys_first=keys_first)


def _read_marked(spark: SparkSession, layers: Layers, spec: TableSpec) -> DataFrame:
    extra = [(REASON, T.StringType()), ("_ts_silver", T.TimestampType()), (COPIES, T.LongType()), (_STATE, T.StringType())]
    if spec.sliced_by:
        extra.append((SLICE, T.DateType()))
    schema = T.StructType(spec.schema.fields + [T.StructField(n, t, True) for n, t in extra])
    return read_table(spark, layers.path("silver", spec.name), layers.fmt, schema)


def read_silver(spark: SparkSession, layers: Layers, spec: TableSpec) -> DataFrame:
    """Valid rows of a cleaned table."""
    return _read_marked(spark, layers, spec).where(F.col(_STATE) == _VALID).drop(_STATE, REASON, COPIES, SLICE)


def read_gold(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    return read_table(spark, layers.path("gold", table), layers.fmt).drop(SLICE)


def read_sales(spark: SparkSession, layers: Layers, since: Column | None = None) -> DataFrame:
    """The sales facts, or those after a day: the months before it are not opened."""
    sales = read_table(spark, layers.path("gold", "fact_ventas"), layers.fmt)
    if since is not None:
        if SLICE in sales.columns:
            sales = sales.where(F.col(SLICE) >= F.trunc(since, "MM"))
        sales = sales.where(F.col("fec_trans") > since)
    return sales.drop(SLICE)


def last_sale(spark: SparkSession, layers: Layers) -> Column:
    """The reference date, from the last month that holds sales."""
    sales = read_table(spark, layers.path("gold", "fact_ventas"), layers.fmt)
    if SLICE in sales.columns:
        sales = sales.where(F.col(SLICE) == latest_date(sales.select(SLICE).distinct(), SLICE))
    return latest_date(sales, "fec_trans")


def _prints(spark: SparkSession, layers: Layers, spec: TableSpec, loaded: DataFrame, run: Run) -> DataFrame:
    """What was loaded per day, as the runs before have written it down; counted anew where they have not."""
    path = layers.path("bronze", f"_huellas/{spec.name}")
    noted = {n for n in live_batches(spark, path, [run.batch_id])[1]} if table_exists(spark, path) else set()
    stored = {n for n in live_batches(spark, layers.path("bronze", spec.name))[1]} - {batch_folder(run.batch_id)}
    if noted and stored <= noted:
        return read_table(spark, path, layers.fmt, _PRINT_SCHEMA, without=[run.batch_id])
    return day_prints(loaded, spec)


def ingest_table(
    spark: SparkSession, layers: Layers, spec: TableSpec, source: Callable[[], DataFrame], run: Run
) -> dict:
    """Load one table and say how much was loaded.

    Rows are stored as they come: missing and repeated keys are for the
    cleaning to count and reject. What counts as loaded before leaves this
    run's own batch out, so a run that is repeated loads the same rows again.
    The watermark and the days to search for late rows come from what earlier
    runs have noted per day, not from the table. Every ``run.settle_after``
    batches the older ones become the settled base of the table.
    """
    started = time.monotonic()
    path = layers.path("bronze", spec.name)
    before = live_paths(spark, path, [run.batch_id])
    loaded = read_bronze(spark, layers, spec, [run.batch_id], keys_first=False) if before else None
    cap = run.as_of if run.watermark_cap else None
    arrived, mark, prints = source(), None, None
    if run.incremental and loaded is not None and spec.watermark is not None:
        prints = _prints(spark, layers, spec, loaded, run)
        mark = mark_of(prints, cap)
    rows = after(arrived, spec.watermark, mark)
    counted = Observation()
    # counted before the stamps are added: Spark then sees that the partition columns are constant and does not sort
    seen = rows.select(*spec.column_names).observe(counted, F.count(F.lit(1)).alias("n"))
    batch = stamp(seen, run.ts, run.system, run.batch_id)
    stored = put_batch(batch, path, run.batch_id, INGEST_PARTITIONS, layers.fmt)
    if spec.watermark is not None:
        put_batch(day_prints(stored, spec), layers.path("bronze", f"_huellas/{spec.name}"), run.batch_id, fmt=layers.fmt)
    skipped = late_by_day(arrived, loaded, prints, spec, mark) if mark is not None else None
    _, batches = live_batches(spark, path)
    if len(batches) > run.settle_after:
        order = [spec.watermark] if spec.watermark else []
        settle(spark, path, spec.key, _audited(spec), [run.batch_id], order, fmt=layers.fmt)
    return {
        "tabla": spec.name,
        "registros": counted.get["n"],
        "segundos": round(time.monotonic() - started, 1),
        "tardias": 0 if skipped is None else skipped.count(),
    }


def ingest_all(spark: SparkSession, layers: Layers, sources: Mapping[str, Callable[[], DataFrame]], run: Run) -> None:
    """Load all tables; the log and the count of rows that came too late replace those of an earlier try of the run."""
    mode = "incremental" if run.incremental else "full"
    results = together(
        *[partial(ingest_table, spark, layers, spec, sources[name], run) for name, spec in TABLES.items()]
    )
    ts = dt.datetime.fromisoformat(run.ts)
    log = spark.createDataFrame(
        [(r["tabla"], r["registros"], r["segundos"], run.batch_id, ts, mode) for r in results], _LOG_SCHEMA
    )
    put_batch(log, layers.path("bronze", "_log_ingesta"), run.batch_id, fmt=layers.fmt)
    skipped = spark.createDataFrame([(r["tabla"], r["tardias"], run.batch_id) for r in results], _LATE_SCHEMA)
    put_batch(skipped, layers.path("bronze", "_filas_tardias"), run.batch_id, fmt=layers.fmt)


@dataclass(frozen=True)
class Progress:
    """What a layer has to take in: everything (``batches`` is None), or these batches on top of what it has.

    ``as_of`` is the date of the run that wrote what it has, ``broken`` are the
    notes of runs that broke off.
    """

    batches: list[str] | None
    as_of: dt.date | None = None
    broken: Sequence[Row] = ()


def _begin(spark: SparkSession, layers: Layers, layer: str, run: Run) -> Progress:
    """Note that a run writes a layer, and find out what is new to it.

    After a run that broke off, and when a run is repeated, it is everything.
    """
    path = layers.path(layer, "_corridas")
    noted = read_table(spark, path, layers.fmt, _NOTE_SCHEMA).collect() if table_exists(spark, path) else []  # a row per run
    _note(spark, layers, layer, run, "iniciada")
    finished = [r for r in noted if r["estado"] == "terminada"]
    broken = [r for r in noted if r["estado"] != "terminada"]
    if not finished or broken or run.batch_id in {r["batch_id"] for r in noted} or not run.incremental:
        return Progress(None, broken=broken)
    log = read_table(spark, layers.path("bronze", "_log_ingesta"), layers.fmt)
    loaded = {r["batch_id"] for r in log.select("batch_id").distinct().collect()}
    last = max(finished, key=lambda r: r["ts"])
    return Progress(sorted((loaded | {run.batch_id}) - {r["batch_id"] for r in finished}), last["as_of"])


def _note(spark: SparkSession, layers: Layers, layer: str, run: Run, state: str) -> None:
    row = (run.batch_id, dt.datetime.fromisoformat(run.ts), run.as_of, state)
    put_batch(spark.createDataFrame([row], _NOTE_SCHEMA), layers.path(layer, "_corridas"), run.batch_id, fmt=layers.fmt)


def _end(spark: SparkSession, layers: Layers, layer: str, run: Run, progress: Progress) -> None:
    """Note that a layer is complete: it holds what runs that broke off before had loaded, too."""
    for lost in progress.broken:
        earlier = replace(run, batch_id=lost["batch_id"], ts=lost["ts"].isoformat(" "), as_of=lost["as_of"])
        _note(spark, layers, layer, earlier, "terminada")
    _note(spark, layers, layer, run, "terminada")


def _touched(
    spark: SparkSession, layers: Layers, spec: TableSpec, run: Run, done: Progress, changed: Mapping[str, DataFrame]
) -> list[dt.date]:
    """Months of a sliced table that have to be cleaned again.

    Those of new rows, and those where the rows of the same keys stood before;
    those of rows whose parent came, went or changed state; and those of rows
    that a rule judges otherwise on the new run date. Of the table its keys,
    references and dates are read, none of it moves.
    """
    fresh = read_bronze(spark, layers, spec, only=done.batches)
    marked = _read_marked(spark, layers, spec)
    keys = fresh.select(spec.key).distinct()
    found = [fresh.select(month_of(spec.sliced_by).alias(SLICE)), marked.join(keys, spec.key, "left_semi").select(SLICE)]
    for ref in spec.references:
        if ref.parent in changed:
            parents = changed[ref.parent].select(F.col(TABLES[ref.parent].key).alias(ref.column))
            found.append(marked.join(parents, ref.column, "left_semi").select(SLICE))
    if done.as_of != run.as_of:
        for rule in [r for r in spec.rules if "{as_of}" in r.reject]:
            was, is_now = (F.expr(rule.reject.format(as_of=f"DATE '{d.isoformat()}'")) for d in (done.as_of, run.as_of))
            found.append(marked.where(~was.eqNullSafe(is_now)).select(SLICE))
    return sorted(r[SLICE] for r in union_all(f.distinct() for f in found).distinct().collect())  # a row per month


def _parent(spark: SparkSession, layers: Layers, spec: TableSpec) -> DataFrame | PackedKeys:
    """What a foreign key is checked against; dense keys are written packed, so that their size is known beforehand."""
    rows = read_silver(spark, layers, spec)
    return PackedKeys(stage(packed_keys(rows, spec.key).words, f"{spec.name}-claves")) if spec.dense_key else rows


def _repeated(raw: DataFrame, spec: TableSpec) -> DataFrame | None:
    """Where copies can stand, so that other rows need not move; None if rows move anyway or too many keys are repeated.

    Rows move anyway to be compared by a business key, or to meet a parent that is not checked by packed keys.
    """
    if not any(ref.column == spec.gathered_by and TABLES[ref.parent].dense_key for ref in spec.references) or spec.business_key:
        return None
    found = stage(repeated_words(raw, spec.key).limit(MOST_WORDS + 1), f"{spec.name}-repetidas")
    return found if found.count() <= MOST_WORDS else None


def _only_month(raw: DataFrame, spec: TableSpec, months: Sequence[dt.date] | None) -> dt.date | None:
    """The month of all rows, if they lie in one."""
    if months is None:
        months = [r[0] for r in raw.select(month_of(spec.sliced_by)).distinct().limit(2).collect()]
    return months[0] if len(months) == 1 else None


def _clean(
    spark: SparkSession, layers: Layers, spec: TableSpec, run: Run, done: Progress, changed: dict[str, DataFrame]
) -> list[dt.date] | None:
    """Clean a table, or what changed of it; returns the months that were written (None: all of it).

    Of a table that others refer to, the keys that became valid or ceased to be are left in ``changed``.
    """
    path = layers.path("silver", spec.name)
    months = None
    raw = read_bronze(spark, layers, spec)
    if done.batches is not None and spec.sliced_by:
        months = _touched(spark, layers, spec, run, done, changed)
        if not months:
            return []
        raw = raw.where(in_months(spec.sliced_by, months))
    parents = {ref.parent: _parent(spark, layers, TABLES[ref.parent]) for ref in spec.references}
    repeated = _repeated(raw, spec)
    month = _only_month(raw, spec, months) if spec.sliced_by and repeated is not None else None
    tagged = cleaned(raw, spec, run.as_of, parents, copies=COPIES, repeated=repeated)
    state = F.when(F.col(REASON).isNull(), _VALID).otherwise(_REJECTED)
    marked = tagged.withColumns({"_ts_silver": F.lit(run.ts).cast("timestamp"), _STATE: state})
    has_children = any(ref.parent == spec.name for child in TABLES.values() for ref in child.references)
    before = None
    if done.batches is not None and has_children:
        before = _read_marked(spark, layers, spec)
        before = before if months is None else before.where(F.col(SLICE).isin(*months))
        before = before.where(F.col(_STATE) == _VALID).select(spec.key)
        if months is not None:
            before = stage(before, f"{spec.name}-antes")  # its files are about to go
    if spec.sliced_by:
        marked = marked.withColumn(SLICE, month_of(spec.sliced_by))
        if months is not None:
            marked = stage(marked, f"{spec.name}-meses")
        if month is not None:  # a constant: nothing is sorted or moved to write by month
            marked = marked.withColumn(SLICE, F.lit(month))
        overwrite_slices(marked, path, SLICE, months, layers.fmt, gather=month is None)
    else:
        replace_table(marked, path, [_STATE], fmt=layers.fmt)
    if before is not None:
        now = _read_marked(spark, layers, spec).where(F.col(_STATE) == _VALID)
        now = (now if months is None else now.where(F.col(SLICE).isin(*months))).select(spec.key)
        sides = before.distinct().withColumn("_lado", F.lit(-1)).unionByName(now.distinct().withColumn("_lado", F.lit(1)))
        other = stage(sides.groupBy(spec.key).agg(F.sum("_lado").alias("_lado")).where("_lado <> 0").select(spec.key), "cambios")
        if other.limit(1).count():
            changed[spec.name] = other
    return months


class Written(dict):
    """Per table the months that a run has written (None: all of it), and the batches that it took in (None: all)."""

    def __init__(self, batches: list[str] | None) -> None:
        super().__init__()
        self.batches = batches


def clean_all(spark: SparkSession, layers: Layers, run: Run) -> Written:
    """Parents before children; each child is checked against the parent as written.

    A run on top of earlier ones cleans what its batches touch: the months of
    their rows, and the months of rows whose parents changed state, along the
    references. Returns what it has written.
    """
    stamp_ts = F.lit(run.ts).cast("timestamp")
    progress = _begin(spark, layers, "silver", run)
    written = Written(progress.batches)
    changed: dict[str, DataFrame] = {}

    def clean(spec: TableSpec) -> None:
        written[spec.name] = _clean(spark, layers, spec, run, progress, changed)

    while len(written) < len(TABLES):
        ready = [s for s in TABLES.values() if s.name not in written and {r.parent for r in s.references} <= set(written)]
        together(*[partial(clean, spec) for spec in ready])

    marked = {name: _read_marked(spark, layers, spec) for name, spec in TABLES.items()}
    errors = union_all(rejected(marked[name].where(F.col(_STATE) == _REJECTED), spec) for name, spec in TABLES.items())
    # Written on every run, so that a run without rejects leaves an empty table.
    replace_table(errors.withColumn("_ts_error", stamp_ts), layers.path("silver", "_errores"), fmt=layers.fmt)
    report = union_all(quality_counted(name, marked[name], COPIES) for name in TABLES)
    replace_table(report.withColumn("_ts_reporte", stamp_ts), layers.path("silver", "_reporte_calidad"), fmt=layers.fmt)
    _end(spark, layers, "silver", run, progress)
    return written


def _differs(before: DataFrame | None, now: DataFrame, columns: Sequence[str]) -> bool:
    if before is None:
        return True
    old, new = before.select(*columns), now.select(*columns)
    return old.exceptAll(new).unionAll(new.exceptAll(old)).limit(1).count() > 0


def model_all(spark: SparkSession, layers: Layers, run: Run, written: Written | None = None) -> None:
    """Dimensions, facts and aggregates of the cleaned tables.

    Sales and their daily aggregate are stored by month. With what the cleaning
    has ``written`` only those months are made again, the files of all others
    stay; the aggregate is made anew when a store changed its country or an
    article its category. Trailing windows open the months that they cover.
    """
    progress = _begin(spark, layers, "gold", run)
    months = None
    if written is not None and progress.batches is not None and progress.batches == written.batches:
        months = written["trans_ventas"]

    def clean(table: str) -> DataFrame:
        return read_silver(spark, layers, TABLES[table])

    def save(df: DataFrame, table: str) -> DataFrame:
        by = run.partitions.get(table, [])
        replace_table(df, layers.path("gold", table), by, gather=bool(by), fmt=layers.fmt)
        return read_gold(spark, layers, table)

    def save_months(df: DataFrame, table: str, wanted: list[dt.date] | None) -> None:
        if run.partitions.get(table):
            save(df.drop(SLICE), table)
        elif wanted is None or wanted:
            overwrite_slices(df, layers.path("gold", table), SLICE, wanted, layers.fmt)

    def sales_of(wanted: list[dt.date] | None) -> DataFrame:
        marked = _read_marked(spark, layers, TABLES["trans_ventas"]).where(F.col(_STATE) == _VALID)
        if wanted is not None and not run.partitions.get("fact_ventas"):
            marked = marked.where(F.col(SLICE).isin(*wanted))
        return gold.fact_sales(marked).withColumn(SLICE, month_of("fec_trans"))

    def known(table: str) -> DataFrame | None:
        return read_gold(spark, layers, table) if table_exists(spark, layers.path("gold", table)) else None

    stores_before, products_before = known("dim_tiendas"), known("dim_productos")
    products, stores, _ = together(
        lambda: save(gold.dim_products(clean("mstr_articulos"), clean("mstr_proveedores")), "dim_productos"),
        lambda: save(gold.dim_stores(clean("mstr_tiendas")), "dim_tiendas"),
        lambda: save_months(sales_of(months), "fact_ventas", months),
    )
    sales, ref = read_sales(spark, layers), last_sale(spark, layers)

    def recent(days: int) -> DataFrame:
        return read_sales(spark, layers, F.date_sub(ref, days))

    returns, rfm, *_ = together(
        lambda: save(gold.fact_returns(clean("post_devoluciones"), sales), "fact_devoluciones"),
        lambda: save(gold.fact_rfm(recent(gold.RFM_ACTIVE_DAYS), ref), "fact_rfm_clientes"),
        lambda: save(gold.dim_customers(clean("crm_miembros"), ref), "dim_clientes"),
        lambda: save(gold.fact_inventory(clean("inv_stock_diario"), recent(gold.CONSUMPTION_DAYS), ref), "fact_inventario"),
        lambda: save(gold.calendar(sales), "dim_calendario"),
    )
    if months is not None and (
        _differs(stores_before, stores, ["id_tienda", "id_pais"]) or _differs(products_before, products, ["art_id", "categoria_n1"])
    ):
        months = None
    star = Star(sales, {"id_tienda": stores, "art_id": products}, unique_lines=is_unique(sales, "id_trans"))

    def daily() -> None:
        if months == []:
            return
        touched = star if months is None else star.where(in_months("fec_trans", months))
        rows = kpis.agg_daily_sales(touched).withColumn(SLICE, month_of("fec_trans"))
        save_months(rows, "agg_ventas_diarias", months)

    together(
        daily,
        lambda: save(kpis.return_rate(star, returns), "agg_tasa_devolucion"),
        lambda: save(kpis.agg_rfm_segments(rfm), "agg_segmentos_rfm"),
        lambda: save(kpis.kpi_country_channel(star), "kpi_ventas_pais_canal"),
        lambda: save(kpis.top_products(star), "kpi_top_productos"),
        lambda: save(kpis.weekly_sales(star), "kpi_ventas_semanales"),
    )
    _end(spark, layers, "gold", run, progress)


def check_all(spark: SparkSession, layers: Layers, run: Run) -> DataFrame:
    """Write the check results and the volume alert; returns the run report."""
    stamp_ts = F.lit(run.ts).cast("timestamp")

    def model(table: str) -> DataFrame:
        return read_gold(spark, layers, table)

    results = checks.dq_checks(
        model("dim_productos"),
        model("dim_tiendas"),
        model("dim_clientes"),
        model("fact_ventas"),
        model("fact_rfm_clientes"),
        model("fact_inventario"),
    )
    replace_table(results.withColumn("_ts", stamp_ts), layers.path("gold", "_resultados_dq"), fmt=layers.fmt)
    log = read_table(spark, layers.path("bronze", "_log_ingesta"), layers.fmt)
    alert = volume_alert(log)
    put_batch(alert.withColumn("_ts", stamp_ts), layers.path("bronze", "_alertas_volumen"), run.batch_id, fmt=layers.fmt)
    quality = read_table(spark, layers.path("silver", "_reporte_calidad"), layers.fmt)
    return checks.run_report(log, quality, model("_resultados_dq"), alert)


def refresh(
    spark: SparkSession, layers: Layers, sources: Mapping[str, Callable[[], DataFrame]], run: Run
) -> DataFrame:
    """All layers in order; returns the run report."""
    ingest_all(spark, layers, sources, run)
    model_all(spark, layers, run, clean_all(spark, layers, run))
    return check_all(spark, layers, run)
