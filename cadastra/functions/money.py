"""Money expressions. All arithmetic is decimal; results are stored with four places, half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.rules import Rules
from cadastra.schemas import MONEY


def money(value: Column) -> Column:
    return value.cast(MONEY)


def zero() -> Column:
    return money(F.lit(0))


def days_late(due: Column, on: Column) -> Column:
    """Days from the due date to ``on``; 0 when not late."""
    return F.greatest(F.datediff(on, due), F.lit(0))


def late_interest(original: Column, due: Column, on: Column, rules: Rules = Rules()) -> Column:
    """original * rate / period * days late; 0 when ``on`` is not after the due date."""
    accrued = original * F.lit(rules.interest_rate) / F.lit(rules.interest_period_days) * F.datediff(on, due)
    return F.when(on > due, money(accrued)).otherwise(zero())


def water_amount(consumption: Column, min_amount: Column, min_m3: Column, per_m3: Column) -> Column:
    """Minimum charge up to the included volume, then a fixed price per extra cubic metre."""
    floor = F.coalesce(min_amount, zero())
    included = F.coalesce(min_m3, F.lit(0))
    extra = (consumption - included) * F.coalesce(per_m3, zero())
    return F.when(consumption > included, money(floor + extra)).otherwise(floor)


def garbage_amount(
    area: Column, min_amount: Column, min_m2: Column, fixed: Column, rules: Rules = Rules()
) -> Column:
    """Minimum charge up to the included area, then a fixed price per started tranche."""
    floor = F.coalesce(min_amount, zero())
    included = F.coalesce(min_m2, F.lit(0))
    tranches = F.ceil((area - included) / F.lit(rules.garbage_tranche_m2))
    return F.when(area <= included, floor).otherwise(money(floor + tranches * F.coalesce(fixed, zero())))


def line_amount(
    name: Column, consumption: Column, fiscal: Column, area: Column, charge: dict[str, Column], rules: Rules = Rules()
) -> Column:
    """Amount of one invoice line, chosen by charge name; null for charges that are never billed monthly."""
    fixed = F.coalesce(charge["fixed"], zero())
    rate = F.coalesce(charge["rate"], F.lit(0).cast("decimal(10,2)"))
    return (
        F.when(
            name == R.WATER,
            water_amount(consumption, charge["min_amount"], charge["min_m3"], charge["per_m3"]),
        )
        .when(name == R.LICENCE, money(fixed / F.lit(rules.licence_divisor)))
        .when(name == R.PROPERTY_TAX, money(fiscal * rate / F.lit(rules.tax_divisor)))
        .when(
            name == R.GARBAGE,
            garbage_amount(area, charge["min_amount"], charge["min_m2"], charge["fixed"], rules),
        )
        .when(name == R.PARKS, money(fixed / F.lit(rules.parks_divisor)))
    )


def line_text(name: Column, consumption: Column) -> Column:
    """Line description: water lines carry the consumption, the others their charge name."""
    volume = consumption.cast("decimal(28,2)").cast("string")
    return F.when(name == R.WATER, F.concat(F.lit(f"{R.WATER} ("), volume, F.lit(" m3)"))).otherwise(name)
