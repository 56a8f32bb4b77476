"""Billing rules as one immutable parameter object."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Result codes kept as reject reasons.
PROPERTY_UNKNOWN = 3
PERSON_UNKNOWN = 4
INVOICE_UNKNOWN = 40002
NOTHING_PENDING = 50014

PENDING = 1
PAID = 2

# Charge names that select a calculator.
WATER = "ConsumoAgua"
LICENCE = "PatenteComercial"
PROPERTY_TAX = "ImpuestoPropiedad"
GARBAGE = "RecoleccionBasura"
PARKS = "MantenimientoParques"
RECONNECTION = "ReconexionAgua"
LATE_INTEREST = "InteresesMoratorios"

# Texts of the lines added by a payment or a simulation.
INTEREST_TEXT = "Intereses moratorios"
RECONNECTION_TEXT = "Reconexión de agua"


@dataclass(frozen=True)
class Rules:
    """Every constant of the billing rules; defaults reproduce the published behaviour."""

    due_days: int = 15
    grace_days: int = 10
    interest_rate: Decimal = Decimal("0.04")
    interest_period_days: Decimal = Decimal("30.0")
    licence_divisor: Decimal = Decimal("6.0")
    tax_divisor: Decimal = Decimal("12.0")
    parks_divisor: Decimal = Decimal("12.0")
    garbage_tranche_m2: Decimal = Decimal("200.0")
    # Use 1 is named 'Habitación' in the catalog, so homes are not covered by default.
    water_uses: tuple[str, ...] = ("Residencial", "Industrial", "Comercial")
    # The consumption mark moves only where this charge is active.
    consumption_charge_id: int = 1
    # "listed": cuts run only on dates that list a property of these uses; "always": every date.
    cut_gate: str = "listed"
    gate_use_ids: tuple[int, ...] = (1, 2, 3)
    # Stop at the first payment without a pending invoice instead of rejecting it.
    strict_payments: bool = False
    # Characters of a document shown in an owner list.
    owner_document_width: int = 20
    # Stop a load that meets unreadable input instead of rejecting what it cannot read.
    strict_load: bool = False
