"""Explicit schemas. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)
QUANTITY = T.DecimalType(10, 2)


_TYPES = {
    "date": T.DateType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "decimal(10,2)": QUANTITY,
    "decimal(19,4)": MONEY,
    "decimal(28,2)": T.DecimalType(28, 2),
}


def _struct(spec: str) -> T.StructType:
    """"name type, name type" to a schema, without needing a running session."""
    pairs = (part.strip().split(" ", 1) for part in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# -- typed operation events (one table per section of an operations document) -----------------

PERSON_EVENT = _struct("op_date date, position int, document string, name string, email string, phone string")
PROPERTY_EVENT = _struct(
    "op_date date, position int, property_id string, meter_id string, area_m2 decimal(10,2), use_id int, "
    "zone_id int, fiscal_value decimal(19,4), registered_on date"
)
OWNERSHIP_EVENT = _struct("op_date date, position int, property_id string, document string, action int")
CHARGE_EVENT = _struct("op_date date, position int, property_id string, charge_id int, action int")
FISCAL_EVENT = _struct("op_date date, position int, property_id string, value decimal(19,4)")
READING_EVENT = _struct("op_date date, position int, meter_id string, movement int, value decimal(10,2)")
PAYMENT_EVENT = _struct("op_date date, position int, property_id string, method_id int, reference string")

EVENTS = {
    "person": PERSON_EVENT,
    "property": PROPERTY_EVENT,
    "ownership": OWNERSHIP_EVENT,
    "charge": CHARGE_EVENT,
    "fiscal": FISCAL_EVENT,
    "reading": READING_EVENT,
    "payment": PAYMENT_EVENT,
}

# -- catalogs ---------------------------------------------------------------------------------

PARAMETER = _struct("name string, value string")
LOOKUP = _struct("id int, name string")
PERIOD = _struct("id int, name string, days int, months int")
CHARGE = _struct(
    "charge_id int, name string, amount_type_id int, period_id int, min_amount decimal(19,4), min_m3 int, "
    "per_m3 decimal(19,4), rate decimal(10,2), fixed decimal(19,4), min_m2 int, tranche_m2 int"
)

# -- table store: append-only logs, one partition per operation date ---------------------------

LOGS = {
    "op_day": _struct("op_date date, gate boolean"),
    "person": _struct("op_date date, document string, name string, email string, phone string"),
    "property": _struct(
        "op_date date, property_id string, meter_id string, area_m2 decimal(10,2), use_id int, zone_id int, "
        "fiscal_value decimal(19,4), registered_on date"
    ),
    "ownership_log": _struct("op_date date, property_id string, document string, action int"),
    "charge_log": _struct("op_date date, property_id string, charge_id int, action int"),
    "fiscal_log": _struct("op_date date, property_id string, value decimal(19,4)"),
    "reading": _struct("op_date date, position int, meter_id string, movement int, value decimal(10,2)"),
    "balance_log": _struct("op_date date, property_id string, balance decimal(28,2)"),
    "invoice": _struct(
        "op_date date, invoice_id string, property_id string, due_date date, original_total decimal(19,4), "
        "water_mark decimal(28,2)"
    ),
    "invoice_line": _struct(
        "op_date date, invoice_id string, charge_id int, amount decimal(19,4), description string"
    ),
    "payment": _struct(
        "op_date date, invoice_id string, property_id string, method_id int, reference string, "
        "interest decimal(19,4), fee decimal(19,4), amount decimal(19,4)"
    ),
    "cut_open": _struct("op_date date, property_id string, invoice_id string"),
    "cut_close": _struct("op_date date, property_id string, invoice_id string"),
    "reconnection": _struct("op_date date, property_id string, invoice_id string"),
    "reject": _struct("op_date date, step string, code int, key string, reason string"),
}
