"""Operations documents: one element per operation date, seven optional sections, shredded to typed events.

One date element is one nested row, so a document is as large as a row may be. Feeds beyond that arrive as typed
event tables (``schemas.EVENTS``) and enter the same plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra import schemas
from cadastra.session import written

LOAD_FAILED = 50002

# Section, item element, and event column -> attribute.
SECTIONS = {
    "person": (
        "Personas",
        "Persona",
        {"document": "valorDocumento", "name": "nombre", "email": "email", "phone": "telefono"},
    ),
    "property": (
        "Propiedades",
        "Propiedad",
        {
            "property_id": "numeroFinca",
            "meter_id": "numeroMedidor",
            "area_m2": "metrosCuadrados",
            "use_id": "tipoUsoId",
            "zone_id": "tipoZonaId",
            "fiscal_value": "valorFiscal",
            "registered_on": "fechaRegistro",
        },
    ),
    "ownership": (
        "PropiedadPersona",
        "Movimiento",
        {"property_id": "numeroFinca", "document": "valorDocumento", "action": "tipoAsociacionId"},
    ),
    "charge": (
        "CCPropiedad",
        "Movimiento",
        {"property_id": "numeroFinca", "charge_id": "idCC", "action": "tipoAsociacionId"},
    ),
    "fiscal": ("PropiedadCambio", "Cambio", {"property_id": "numeroFinca", "value": "nuevoValor"}),
    "reading": (
        "LecturasMedidor",
        "Lectura",
        {"meter_id": "numeroMedidor", "movement": "tipoMovimientoId", "value": "valor"},
    ),
    "payment": (
        "Pagos",
        "Pago",
        {"property_id": "numeroFinca", "method_id": "tipoMedioPagoId", "reference": "numeroReferencia"},
    ),
}
ROW_TAG = "FechaOperacion"
CORRUPT = "_corrupt"
DOCUMENT = "document"


def document_schema() -> T.StructType:
    """Schema of one date element; every attribute is text and is typed on extraction.

    An element that is no well-formed XML is kept whole in ``_corrupt``.
    """
    text = T.StringType()
    fields = [T.StructField("_fecha", text)]
    for section, item, attributes in SECTIONS.values():
        record = T.StructType([T.StructField(f"_{a}", text) for a in attributes.values()])
        fields.append(T.StructField(section, T.StructType([T.StructField(item, T.ArrayType(record))])))
    # The parser puts fields behind this one out of place, so it is the last.
    return T.StructType([*fields, T.StructField(CORRUPT, text)])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", ROW_TAG).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(document_schema()).load(path)


def stream_documents(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return (
        spark.readStream.format("xml")
        .option("rowTag", ROW_TAG)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(document_schema())
        .load(path)
    )


def dated(documents: DataFrame) -> DataFrame:
    """Well-formed elements with ``op_date``, null where the date cannot be read."""
    return documents.where(F.col(CORRUPT).isNull()).withColumn("op_date", F.col("_fecha").try_cast("date"))


def rows_of(documents: DataFrame, *kinds: str) -> DataFrame:
    """Every element and every item of every section as one row, so that a document is parsed once for all that is read of it.

    ``kind`` is the section, or ``document`` for the element itself; ``position`` is the item's place in its section. The
    attributes of all sections are text columns, null where a section has none of that name. ``reason`` tells why a load
    cannot take the row, or not all of it; it is null for sound ones. Rows of a broken element are the element alone, without
    a date; its ``key`` is a digest. With ``kinds``, items of these sections only.

    The date is a field of the row that is exploded: a filter on it is not pushed below, where it would parse again.
    """
    names = sorted({name for _, _, attributes in SECTIONS.values() for name in attributes})
    none = F.lit(None).cast("string")

    broken = F.col(CORRUPT).isNotNull()
    op_date = F.when(~broken, F.col("_fecha").try_cast("date"))

    def row(kind: str, position: Column, key: Column, values: dict[str, Column]) -> Column:
        place = [op_date.alias("op_date"), broken.alias("broken"), F.lit(kind).alias("kind"), position.alias("position"), key.alias("key")]
        return F.struct(*place, *[values.get(n, none).alias(n) for n in names])

    def items(kind: str) -> Column:
        section, item, attributes = SECTIONS[kind]

        def one(x: Column, position: Column) -> Column:
            return row(kind, position, position.cast("string"), {name: x[f"_{xml}"] for name, xml in attributes.items()})

        return F.transform(f"{section}.{item}", one)

    key = F.when(broken, F.sha2(CORRUPT, 256)).otherwise(F.coalesce("_fecha", F.lit("")))
    element = F.array(row(DOCUMENT, F.lit(None).cast("int"), key, {}))
    all_items = F.flatten(F.array_compact(F.array(element, *[F.when(~broken, items(kind)) for kind in kinds or SECTIONS])))
    rows = documents.select(F.explode(all_items).alias("row")).select("row.*")

    bad = F.lit(None).cast("array<string>")
    for kind in SECTIONS:
        unread = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in _attributes(kind)]
        bad = F.when(F.col("kind") == kind, F.array_compact(F.array(*unread))).otherwise(bad)
    of_element = F.col("kind") == DOCUMENT
    reason = (
        F.when(F.col("broken"), "unreadable element")
        .when(of_element & F.col("op_date").isNull(), "element without a readable date")
        .when(F.col("op_date").isNull(), "in an element without a readable date")
        .when(F.size(bad) > 0, F.concat(F.lit("unreadable "), F.array_join(bad, ", ")))
    )
    return rows.withColumn("reason", reason).drop("broken")


def _attributes(kind: str) -> list[T.StructField]:
    return [f for f in schemas.EVENTS[kind].fields if f.name not in ("op_date", "position")]


def events_of(rows: DataFrame, kind: str) -> DataFrame:
    """Typed events of one section; items of undated elements are rejects, not events."""
    mine = rows.where((F.col("kind") == kind) & F.col("op_date").isNotNull())
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _attributes(kind)]
    return mine.select("op_date", F.col("position").cast("int").alias("position"), *typed)


def dates_of(rows: DataFrame) -> DataFrame:
    """The date of every element that has one, as often as it is listed."""
    return rows.where((F.col("kind") == DOCUMENT) & F.col("op_date").isNotNull()).select("op_date")


def rejects_of(rows: DataFrame) -> DataFrame:
    """Everything a load cannot take in: broken and undated elements, items of the latter, unreadable attributes."""
    return rows.where("reason IS NOT NULL").select(
        "op_date", F.col("kind").alias("step"), F.lit(LOAD_FAILED).alias("code"), "key", "reason"
    )


def stored_rows(documents: DataFrame) -> DataFrame:
    """``rows_of`` written by kind and read back: one parse, then each reader opens the folder of its section only."""
    return written(rows_of(documents), "kind")


def shred(documents: DataFrame, kind: str) -> DataFrame:
    return events_of(rows_of(documents, kind), kind)


def all_events(rows: DataFrame) -> dict[str, DataFrame]:
    return {kind: events_of(rows, kind) for kind in SECTIONS}


def shred_all(documents: DataFrame) -> dict[str, DataFrame]:
    return all_events(rows_of(documents))


def load_rejects(documents: DataFrame) -> DataFrame:
    return rejects_of(rows_of(documents))


def operation_dates(documents: DataFrame) -> DataFrame:
    return dates_of(rows_of(documents)).distinct()


def duplicate_dates(dates: DataFrame) -> DataFrame:
    """Dates that occur more than once; a load accepts each date once."""
    return dates.groupBy("op_date").agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def parse_documents(text: DataFrame, column: str) -> DataFrame:
    """Parse a column of XML date elements with the document schema."""
    parsed = F.from_xml(F.col(column), document_schema(), {"columnNameOfCorruptRecord": CORRUPT})
    return text.select(parsed.alias("_doc")).select("_doc.*")


def write_documents(events: DataFrame, kind: str, block: Column | None = None) -> DataFrame:
    """Events as XML date elements, in column ``document``.

    Every event is an element of its own; with ``block``, the events of a date and block share one, ordered by
    ``position``. A block bounds the items of an element, so that a date with many events is many elements.
    """
    section, item, attributes = SECTIONS[kind]
    record = F.struct(*[F.col(name).cast("string").alias(f"_{xml}") for name, xml in attributes.items()])
    if block is None:
        items = events.select("op_date", F.array(record).alias("_items"))
    else:
        listed = F.array_sort(F.collect_list(F.struct("position", record.alias("_item"))))
        grouped = events.withColumn("_block", block).groupBy("op_date", "_block").agg(listed.alias("_listed"))
        items = grouped.select("op_date", F.transform("_listed", lambda x: x["_item"]).alias("_items"))
    element = F.struct(F.col("op_date").cast("string").alias("_fecha"), F.struct(F.col("_items").alias(item)).alias(section))
    return items.select(F.to_xml(element, {"rowTag": ROW_TAG}).alias("document"))
