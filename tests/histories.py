"""Random histories and a day-by-day simulation in plain Python, written from the rules for one property at a time."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal

DAY0 = dt.date(2024, 1, 25)
MONEY = Decimal("0.0001")
TEN = Decimal("0.0000000001")
WATER_USES = {2, 3}
FIRST = dt.timedelta(days=1)


def money(x) -> Decimal:
    return Decimal(x).quantize(MONEY, ROUND_HALF_UP)


def fine(x) -> Decimal:
    return Decimal(x).quantize(TEN, ROUND_HALF_UP)


MONTH_ENDS = [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 10), dt.date(2024, 4, 30)]


def random_events(
    n_properties: int, n_dates: int = 0, span: int = 0, seed: int = 0, dates: list[dt.date] | None = None, pay: float = 0.05
) -> tuple[dict[str, list[tuple]], list[dt.date]]:
    """Events of every section over ``n_dates`` operation dates spread over ``span`` days, or over ``dates``."""
    rnd = random.Random(seed)
    monthly = dates is not None
    n_dates = len(dates) if monthly else n_dates
    dates = dates or sorted({DAY0 + dt.timedelta(days=d) for d in rnd.sample(range(span), n_dates)})
    ev: dict[str, list[tuple]] = defaultdict(list)
    people = [str(1000 + i) for i in range(8)]
    for doc in people:
        when = rnd.choice(dates[: max(2, n_dates // 4)])
        for _ in range(rnd.choice([1, 1, 2])):
            ev["person"].append((when, len(ev["person"]), doc, f"name {doc}", None, None))
            when = rnd.choice(dates)
    for i in range(n_properties):
        pid, meter = f"F-{i:04d}", f"M-{i - i % 17 % 2:04d}"
        listed = rnd.choice(dates[: max(2, n_dates // 3)])
        registered = listed + dt.timedelta(days=rnd.choice([0, 0, -3, 4, rnd.randrange(-30, 5)]))
        if monthly:
            listed, registered = dates[0], dates[0]
        use, zone = rnd.choice([1, 2, 2, 3, 3, 4, 5]), rnd.randrange(1, 6)
        area, fiscal = Decimal(rnd.randrange(5000, 90000)) / 100, Decimal(rnd.randrange(10**6, 10**8)) / 7
        row = (pid, meter, area, use, zone, money(fiscal), registered)
        ev["property"].append((listed, len(ev["property"]), *row))
        if rnd.random() < 0.3:
            ev["property"].append((rnd.choice(dates), len(ev["property"]), pid, meter, Decimal(1), 1, 1, money(1), registered))
        for d in dates:
            if rnd.random() < 0.08:
                ev["ownership"].append((d, len(ev["ownership"]), pid, rnd.choice(people), rnd.choice([1, 1, 2])))
                if rnd.random() < 0.3:
                    ev["ownership"].append((d, len(ev["ownership"]), pid, rnd.choice(people), 2))
            if rnd.random() < 0.03:
                ev["charge"].append((d, len(ev["charge"]), pid, rnd.choice([1, 1, 2, 3, 4, 5, 6, 9]), rnd.choice([1, 2])))
            for _ in range(rnd.choice([0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 2])):
                ev["fiscal"].append((d, len(ev["fiscal"]), pid, money(rnd.randrange(10**5, 10**7))))
            for _ in range(rnd.choice([0, 0, 0, 1, 2])):
                value = Decimal(rnd.randrange(0, 12000)) / 100
                ev["reading"].append((d, len(ev["reading"]), meter, rnd.choice([1, 2, 3, 3, 9]), value))
            for _ in range(rnd.choice([1, 1, 2]) if rnd.random() < pay else 0):
                ref = None if rnd.random() < 0.03 else f"R{rnd.randrange(4)}"
                ev["payment"].append((d, len(ev["payment"]), pid, rnd.choice([1, 2]), ref))
    ev["payment"].append((dates[-1], len(ev["payment"]), "F-none", 1, "R0"))
    return ev, dates


def simulate(ev: dict[str, list[tuple]], dates: list[dt.date], grace: int = 10, due_days: int = 15) -> dict[str, set]:
    """Tables as sets of tuples after running the dates one by one."""
    out: dict[str, list] = defaultdict(list)
    by_day: dict[str, dict] = {k: defaultdict(list) for k in ("person", "property", "ownership", "charge", "fiscal", "reading", "payment")}
    for kind, rows in ev.items():
        for r in sorted(rows, key=lambda r: (r[0], r[1])):
            by_day[kind][r[0]].append(r[2:])
    persons, props, open_own = set(), {}, {}
    charges, invoices = {}, defaultdict(list)
    cuts, reconnected = {}, set()
    for d in dates:
        for doc, name, *_ in by_day["person"][d]:
            if doc not in persons:
                persons.add(doc)
                out["person"].append((d, doc, name))
        listed_gate = False
        for pid, meter, area, use, zone, fiscal, registered in by_day["property"][d]:
            listed_gate = listed_gate or use in (1, 2, 3)
            if pid in props:
                continue
            props[pid] = dict(meter=meter, area=area, use=use, zone=zone, fiscal=fiscal, reg=registered, bal=Decimal(0), mark=Decimal(0))
            out["property"].append((d, pid, meter))
            auto = [3] + ([1] if use in (1, 2, 3) else []) + ([4] if use != 5 else []) + ([5] if zone in (1, 5) else [])
            for c in auto:
                charges[(pid, c)] = [d, None]
        moves = {(p, o, a) for p, o, a in by_day["ownership"][d] if p in props and o in persons}
        for p, o, a in sorted(moves, key=lambda m: m[2]):
            if a == 1 and (p, o) not in open_own:
                open_own[(p, o)] = d
                out["ownership_log"].append((d, p, o, 1))
            elif a == 2 and (p, o) in open_own:
                del open_own[(p, o)]
                out["ownership_log"].append((d, p, o, 2))
        moves = {(p, c, a) for p, c, a in by_day["charge"][d] if p in props and 1 <= c <= 7}
        for p, c, a in sorted(moves, key=lambda m: m[2]):
            if a == 1 and (p, c) not in charges:
                charges[(p, c)] = [d, None]
            elif a == 2 and (p, c) in charges and charges[(p, c)][1] is None:
                charges[(p, c)][1] = d
        for p, v in by_day["fiscal"][d]:
            if p in props:
                props[p]["fiscal"] = v
        for meter, kind, value in by_day["reading"][d]:
            for x in props.values():
                if x["meter"] == meter:
                    x["bal"] = {1: value, 2: x["bal"] - value, 3: x["bal"] + value}.get(kind, x["bal"])
        active = lambda p, c: (p, c) in charges and charges[(p, c)][1] is None
        water = lambda p: props[p]["use"] in WATER_USES and active(p, 1)
        attempts = {a for a in by_day["payment"][d] if None not in a}
        for a in by_day["payment"][d]:
            if None in a:
                out["reject"].append((d, "/".join(x for x in (a[0], a[2]) if x)))
        for pid, method, ref in sorted(attempts, key=lambda a: (a[0], a[2], a[1])):
            todo = [i for i in invoices[pid] if not i["paid"]]
            if not todo:
                out["reject"].append((d, f"{pid}/{ref}"))
                continue
            inv = todo[0]
            late = max((d - inv["due"]).days, 0)
            accrued = money(fine(inv["total"] * Decimal("0.04") / 30) * late)
            fee = Decimal(0)
            if water(pid) and pid in cuts and not [i for i in todo[1:] if i["due"] < d]:
                fee = Decimal(30000)
                out["cut_close"].append((d, pid, cuts.pop(pid)["id"]))
            inv["paid"] = True
            out["payment"].append((d, inv["id"], pid, method, ref, accrued, money(fee), money(inv["total"] + accrued + fee)))
            for c, amount in ((7, accrued), (6, fee)):
                if amount > 0:
                    out["invoice_line"].append((d, inv["id"], c, money(amount)))
        for pid, inv in cuts.items():
            if inv["paid"] and (pid, inv["id"]) not in reconnected:
                reconnected.add((pid, inv["id"]))
                out["reconnection"].append((d, pid, inv["id"]))
        if listed_gate:
            for pid in props:
                late = [i for i in invoices[pid] if not i["paid"] and i["due"] + dt.timedelta(days=grace) < d]
                if late and water(pid) and pid not in cuts:
                    cuts[pid] = late[0]
                    out["cut_open"].append((d, pid, late[0]["id"]))
        month_end = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - FIRST
        for pid, x in props.items():
            if x["reg"] > d or min(x["reg"].day, month_end.day) != d.day:
                continue
            used, total = x["bal"] - x["mark"], Decimal(0)
            inv_id = f"{pid}-{d:%Y%m%d}"
            amounts = {
                1: 5000 + max(used - 30, 0) * 1000,
                2: Decimal(150000) / 6,
                3: fine(x["fiscal"] * Decimal("0.01") / 12),
                4: 150 if x["area"] <= 400 else 150 + ((x["area"] - 400) / 200).to_integral_value(ROUND_CEILING) * 300,
                5: Decimal(2000) / 12,
            }
            for c, amount in amounts.items():
                if active(pid, c):
                    out["invoice_line"].append((d, inv_id, c, money(amount)))
                    total += money(amount)
            mark = None
            if active(pid, 1):
                mark = x["mark"] = x["bal"]
            invoices[pid].append(dict(id=inv_id, due=d + dt.timedelta(days=due_days), total=total, paid=False))
            out["invoice"].append((d, inv_id, pid, d + dt.timedelta(days=due_days), money(total), mark))
        out["op_day"].append((d, listed_gate))
    out["charge_log"] = [(f, p, c, 1) for (p, c), (f, _) in charges.items()] + [
        (t, p, c, 2) for (p, c), (_, t) in charges.items() if t
    ]
    return out
