"""The seven source tables: columns, keys, rules, references.

A table is described once, as data; the operators take the description as an
argument, so a new table needs an entry here and no new code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = False
    values: tuple | None = None

    @property
    def stored_type(self) -> T.DataType:
        """The type held in files: bounded strings are stored as plain strings."""
        return T.StringType() if isinstance(self.type, T.VarcharType) else self.type


@dataclass(frozen=True)
class Rule:
    """Rows for which ``reject`` holds are rejected with ``reason``.

    ``reject`` is a SQL condition on ``column``; ``{as_of}`` stands for the run date.
    """

    reason: str
    column: str
    reject: str


@dataclass(frozen=True)
class Reference:
    """Foreign key ``column`` -> key of ``parent``."""

    column: str
    parent: str
    null_ok: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: tuple[Column, ...]
    watermark: str | None = None
    business_key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    references: tuple[Reference, ...] = ()
    masked: tuple[str, ...] = ()
    #: Date column by whose months the cleaned table is stored, so that a run cleans only the months it touches.
    #: Rows that are compared with each other (a business key) have to lie in one month.
    sliced_by: str | None = None
    #: Reference by which rows are brought together to find copies, so that they are in place when the reference is
    #: checked. For tables with few copies in which no value of it can hold a large part of the rows.
    gathered_by: str | None = None
    #: Keys are numbered in a row, so that those of 64 rows are kept in one when children are checked.
    dense_key: bool = False

    def __post_init__(self) -> None:
        if self.sliced_by and self.business_key and self.sliced_by not in self.business_key:
            raise ValueError(f"{self.name}: rows with one business key could lie in several months")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.stored_type, True) for c in self.columns])


# Vocabularies, labels and business constants.
COUNTRIES = ("CO", "MX", "CL", "PE", "EC")
CHANNELS = ("TIENDA", "WEB", "MKT", "APP")
STORE_TYPES = ("HIPER", "SUPER", "CONVE")
UNITS = ("UN", "KG", "LT", "MT", "CC")
AGE_RANGES = ("18-25", "26-35", "36-45", "46-55", "56-65", "65+")
GENDERS = ("M", "F", "X")
PAYMENTS = ("EFECTIVO", "TARJETA", "PSE", "NEQUI", "DAVIPLATA", "TRANSFER", "CREDITO")
RETURN_REASONS = ("DEFECTUOSO", "NO_DESEADO", "TALLA", "INCOMPLETO", "NO_CORRESPONDE", "VENCIDO", "OTRO")
RETURN_STATES = ("PROCESADA", "APROBADA", "REEMBOLSADA", "RECHAZADA")
CATEGORIES = (1, 2, 3, 4, 5, 6)
# End of fixed values.

_ID = T.LongType()
_INT = T.IntegerType()
_DAY = T.DateType()
_FLAG = T.BooleanType()
_MONEY = T.DecimalType(12, 2)


def _text(n: int) -> T.VarcharType:
    return T.VarcharType(n)


SUPPLIERS = TableSpec(
    name="mstr_proveedores",
    key="id_proveedor",
    columns=(
        Column("id_proveedor", _ID),
        Column("razon_social", _text(150)),
        Column("pais_origen", _text(2)),
        Column("tiempo_repo_dias", _INT),
        Column("calificacion_calidad", T.DecimalType(3, 2), nullable=True),
        Column("activo", _FLAG),
    ),
    masked=("razon_social",),
)

STORES = TableSpec(
    name="mstr_tiendas",
    key="id_tienda",
    dense_key=True,
    watermark="fec_apertura",
    columns=(
        Column("id_tienda", _ID),
        Column("nom_tienda", _text(120)),
        Column("tipo_tienda", _text(20), values=STORE_TYPES),
        Column("id_ciudad", _INT),
        Column("id_pais", _text(2), values=COUNTRIES),
        Column("metros_cuadrados", _INT, nullable=True),
        Column("activo", _FLAG),
        Column("fec_apertura", _DAY),
    ),
)

ARTICLES = TableSpec(
    name="mstr_articulos",
    key="art_id",
    dense_key=True,
    watermark="fec_alta",
    columns=(
        Column("art_id", _ID),
        Column("cod_barra", _text(13), nullable=True),
        Column("desc_art", _text(200)),
        Column("id_categ_n1", _INT, values=CATEGORIES),
        Column("id_categ_n2", _INT),
        Column("id_categ_n3", _INT, nullable=True),
        Column("id_proveedor", _ID),
        Column("precio_lista", _MONEY),
        Column("peso_kg", T.DecimalType(8, 3), nullable=True),
        Column("unid_medida", _text(10), values=UNITS),
        Column("activo", _FLAG),
        Column("fec_alta", _DAY),
    ),
    references=(Reference("id_proveedor", "mstr_proveedores"),),
)

MEMBERS = TableSpec(
    name="crm_miembros",
    key="id_miembro",
    watermark="fec_registro",
    columns=(
        Column("id_miembro", _ID),
        Column("fec_registro", _DAY),
        Column("id_ciudad", _INT, nullable=True),
        Column("genero", _text(1), nullable=True, values=GENDERS),
        Column("rango_edad", _text(10), nullable=True, values=AGE_RANGES),
        Column("canal_pref", _text(20), nullable=True, values=CHANNELS),
        Column("activo", _FLAG),
        Column("fec_ultima_compra", _DAY, nullable=True),
    ),
)

SALES = TableSpec(
    name="trans_ventas",
    key="id_trans",
    watermark="fec_trans",
    sliced_by="fec_trans",
    columns=(
        Column("id_trans", _ID),
        Column("id_miembro", _ID, nullable=True),
        Column("id_tienda", _ID),
        Column("art_id", _ID),
        Column("fec_trans", _DAY),
        Column("hra_trans", _text(8)),
        Column("qty_vendida", _INT),
        Column("precio_unitario_venta", _MONEY),
        Column("descuento_aplicado", _MONEY, nullable=True),
        Column("tipo_pago", _text(20), values=PAYMENTS),
        Column("canal_venta", _text(20), values=CHANNELS),
    ),
    business_key=("id_miembro", "id_tienda", "art_id", "fec_trans", "hra_trans"),
    rules=(
        Rule("monto_no_positivo", "precio_unitario_venta", "precio_unitario_venta <= 0"),
        Rule("fecha_futura", "fec_trans", "fec_trans > {as_of}"),
    ),
    references=(Reference("id_tienda", "mstr_tiendas"), Reference("art_id", "mstr_articulos")),
)

STOCK = TableSpec(
    name="inv_stock_diario",
    key="id_snapshot",
    watermark="fec_snapshot",
    sliced_by="fec_snapshot",
    gathered_by="art_id",
    columns=(
        Column("id_snapshot", _ID),
        Column("art_id", _ID),
        Column("id_tienda", _ID),
        Column("fec_snapshot", _DAY),
        Column("stock_fisico", _INT),
        Column("stock_transito", _INT, nullable=True),
        Column("stock_reservado", _INT, nullable=True),
        Column("stock_minimo_config", _INT),
        Column("stock_maximo_config", _INT),
    ),
    references=(Reference("art_id", "mstr_articulos"), Reference("id_tienda", "mstr_tiendas")),
)

RETURNS = TableSpec(
    name="post_devoluciones",
    key="id_devolucion",
    watermark="fec_devolucion",
    sliced_by="fec_devolucion",
    gathered_by="id_trans_origen",
    columns=(
        Column("id_devolucion", _ID),
        Column("id_trans_origen", _ID),
        Column("art_id", _ID),
        Column("id_tienda", _ID),
        Column("fec_devolucion", _DAY),
        Column("qty_devuelta", _INT),
        Column("motivo_cod", _text(20), values=RETURN_REASONS),
        Column("canal_devolucion", _text(20), values=CHANNELS),
        Column("estado_devolucion", _text(20), values=RETURN_STATES),
        Column("vr_reembolso", _MONEY, nullable=True),
    ),
    references=(
        Reference("id_trans_origen", "trans_ventas"),
        Reference("art_id", "mstr_articulos"),
        Reference("id_tienda", "mstr_tiendas"),
    ),
)

#: Parents come before the tables that refer to them.
TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (SUPPLIERS, STORES, ARTICLES, MEMBERS, SALES, STOCK, RETURNS)
}


def reference_edges() -> list[tuple[TableSpec, Reference, TableSpec]]:
    """Every (child, reference, parent) edge of the catalog."""
    return [(child, ref, TABLES[ref.parent]) for child in TABLES.values() for ref in child.references]
