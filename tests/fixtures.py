"""A catalog document built from the fixed values of the suite."""

from __future__ import annotations

from xml.sax.saxutils import quoteattr

from cadastra.sources.catalog import CHARGE_ATTRIBUTES, LOOKUPS
from cadastra.suite.star import CHARGES, USES, ZONES

# The remaining lookups of the published catalog.
ITEMS = {
    "uses": USES,
    "zones": ZONES,
    "movement_types": [(1, "Lectura"), (2, "Ajuste Crédito"), (3, "Ajuste Débito")],
    "payment_methods": [(1, "Efectivo"), (2, "Tarjeta")],
    "amount_types": [(1, "Monto Fijo"), (2, "Monto Variable"), (3, "Porcentaje")],
}
# The periods of the published catalog (id, name, months, days).
PERIODS = [
    (1, "Mensual", 1, None),
    (2, "Trimestral", 3, None),
    (3, "Semestral", 6, None),
    (4, "Anual", 12, None),
    (5, "Único", 1, None),
    (6, "Interés Diario", 1, 30),
]


def element(name: str, attributes: dict) -> str:
    text = " ".join(f"{k}={quoteattr('' if v is None else str(v))}" for k, v in attributes.items())
    return f"<{name} {text}/>"


def catalog_document(due: str = "15", grace: str = "10") -> str:
    parts = [
        f"<ParametrosSistema><DiasVencimientoFactura>{due}</DiasVencimientoFactura>"
        f"<DiasGraciaCorta>{grace}</DiasGraciaCorta></ParametrosSistema>"
    ]
    for table, (section, item) in LOOKUPS.items():
        rows = "".join(element(item, {"id": i, "nombre": n}) for i, n in ITEMS[table])
        parts.append(f"<{section}>{rows}</{section}>")
    rows = "".join(element("PeriodoMonto", {"id": i, "nombre": n, "qMeses": m, "dias": d}) for i, n, m, d in PERIODS)
    parts.append(f"<PeriodoMontoCC>{rows}</PeriodoMontoCC>")
    names = ["id", "nombre", *[xml for xml, _ in CHARGE_ATTRIBUTES.values()]]
    rows = "".join(element("CC", dict(zip(names, charge))) for charge in CHARGES)
    parts.append(f"<CCs>{rows}</CCs>")
    return "<Catalogos>" + "".join(parts) + "</Catalogos>"


CATALOG = catalog_document()
