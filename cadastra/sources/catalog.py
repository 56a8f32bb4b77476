"""Catalog document: parameters, lookups, periods and charges."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra import rules as R
from cadastra.functions.text import int_or_default, number_or_null
from cadastra.rules import Rules
from cadastra.session import small

# Element names of the document.
PARAMETERS = {"due_days": "DiasVencimientoFactura", "grace_days": "DiasGraciaCorta"}
LOOKUPS = {
    "movement_types": ("TipoMovimientoLecturaMedidor", "TipoMov"),
    "uses": ("TipoUsoPropiedad", "TipoUso"),
    "zones": ("TipoZonaPropiedad", "TipoZona"),
    "payment_methods": ("TipoMedioPago", "MedioPago"),
    "amount_types": ("TipoMontoCC", "TipoMonto"),
}
CHARGE_ATTRIBUTES = {
    "amount_type_id": ("TipoMontoCC", "int"),
    "period_id": ("PeriodoMontoCC", "int"),
    "min_amount": ("ValorMinimo", "decimal(19,4)"),
    "min_m3": ("ValorMinimoM3", "int"),
    "per_m3": ("ValorFijoM3Adicional", "decimal(19,4)"),
    "rate": ("ValorPorcentual", "decimal(10,2)"),
    "fixed": ("ValorFijo", "decimal(19,4)"),
    "min_m2": ("ValorM2Minimo", "int"),
    "tranche_m2": ("ValorTramosM2", "int"),
}
# Columns of each charge subtype. The garbage subtype does not keep its tranche size.
SUBTYPES = {
    R.WATER: ["min_amount", "min_m3", "per_m3"],
    R.LICENCE: ["fixed"],
    R.PROPERTY_TAX: ["rate", "min_m2", "tranche_m2"],
    R.GARBAGE: ["min_amount", "fixed", "min_m2"],
    R.PARKS: ["fixed"],
    R.RECONNECTION: ["fixed"],
    R.LATE_INTEREST: ["rate"],
}


def _attributes(*names: str) -> T.StructType:
    return T.StructType([T.StructField(f"_{n}", T.StringType()) for n in names])


def _section(item: str, fields: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(item, T.ArrayType(fields))])


def document_schema() -> T.StructType:
    charge = _attributes("id", "nombre", *[xml for xml, _ in CHARGE_ATTRIBUTES.values()])
    sections = [
        T.StructField(
            "ParametrosSistema", T.StructType([T.StructField(x, T.StringType()) for x in PARAMETERS.values()])
        ),
        T.StructField("PeriodoMontoCC", _section("PeriodoMonto", _attributes("id", "nombre", "qMeses", "dias"))),
        T.StructField("CCs", _section("CC", charge)),
    ]
    sections += [T.StructField(s, _section(i, _attributes("id", "nombre"))) for s, i in LOOKUPS.values()]
    return T.StructType(sections)


@dataclass(frozen=True)
class Catalog:
    """Catalog tables; each was checked to be small when it was read."""

    parameters: DataFrame
    uses: DataFrame
    zones: DataFrame
    movement_types: DataFrame
    payment_methods: DataFrame
    amount_types: DataFrame
    periods: DataFrame
    charges: DataFrame

    def subtype(self, name: str) -> DataFrame:
        """One charge subtype with its own columns."""
        return split_subtypes(self.charges)[name]

    def reconnection_fee(self) -> Column | None:
        """Fixed value of the reconnection charge with the smallest id; None when there is none above zero."""
        row = self.subtype(R.RECONNECTION).agg(F.min_by("fixed", "charge_id").alias("fee")).first()
        return None if row["fee"] is None or row["fee"] <= 0 else F.lit(row["fee"]).cast("decimal(19,4)")

    def rules(self, base: Rules = Rules()) -> Rules:
        """``base`` with the due and grace days of the parameter table; missing or malformed ones keep theirs."""
        return replace(
            base, **{field: int_parameter(self.parameters, xml, getattr(base, field)) for field, xml in PARAMETERS.items()}
        )


def int_parameter(parameters: DataFrame, name: str, default: int) -> int:
    found = parameters.where(F.col("name") == name).agg(F.max(F.col("value").try_cast("int")).alias("value"))
    return found.select(int_or_default(F.col("value").cast("string"), default).alias("value")).first()["value"]


def split_subtypes(charges: DataFrame) -> dict[str, DataFrame]:
    """The wide charge table as one table per subtype, each with its own columns."""
    return {
        name: charges.where(F.col("name") == name).select("charge_id", *columns) for name, columns in SUBTYPES.items()
    }


def parameters_of(document: DataFrame) -> DataFrame:
    pairs = [
        F.struct(F.lit(xml).alias("name"), F.col(f"ParametrosSistema.{xml}").alias("value"))
        for xml in PARAMETERS.values()
    ]
    return document.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def items_of(document: DataFrame, section: str, item: str) -> DataFrame:
    return document.select(F.explode(f"{section}.{item}").alias("item")).select("item.*")


def lookup_of(document: DataFrame, section: str, item: str) -> DataFrame:
    return items_of(document, section, item).select(
        F.col("_id").try_cast("int").alias("id"), F.col("_nombre").alias("name")
    )


def periods_of(document: DataFrame) -> DataFrame:
    return items_of(document, "PeriodoMontoCC", "PeriodoMonto").select(
        F.col("_id").try_cast("int").alias("id"),
        F.col("_nombre").alias("name"),
        number_or_null(F.col("_dias"), "int").alias("days"),
        number_or_null(F.col("_qMeses"), "int").alias("months"),
    )


def charges_of(document: DataFrame) -> DataFrame:
    """Charge rows; empty, malformed and zero attributes become null."""
    ids = ("amount_type_id", "period_id")
    return items_of(document, "CCs", "CC").select(
        F.col("_id").try_cast("int").alias("charge_id"),
        F.col("_nombre").alias("name"),
        *[
            (F.col(f"_{xml}").try_cast(kind) if name in ids else number_or_null(F.col(f"_{xml}"), kind)).alias(name)
            for name, (xml, kind) in CHARGE_ATTRIBUTES.items()
        ],
    )


def read_catalog(spark: SparkSession, path: str) -> Catalog:
    document = spark.read.format("xml").option("rowTag", "Catalogos").schema(document_schema()).load(path)
    return Catalog(
        parameters=small(parameters_of(document)),
        periods=small(periods_of(document)),
        charges=small(charges_of(document)),
        **{name: small(lookup_of(document, *where)) for name, where in LOOKUPS.items()},
    )
