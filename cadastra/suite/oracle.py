"""SQL counterparts of the registered queries, for DuckDB over the same parquet tables.

Written from the rules, not from the Spark plans: windows over whole properties, plain joins, integer money
(ten-thousandths, because DuckDB divides decimals as doubles).
"""

from __future__ import annotations

import re

AS_OF = "DATE '1996-03-31'"
CUT_DATE = "DATE '1996-01-31'"
LATER_CUT_DATE = "DATE '1996-06-30'"


def money(units: str) -> str:
    """Ten-thousandths (integer) to DECIMAL(19,4)."""
    return f"CAST(CAST({units} AS DECIMAL(19,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(19,4))"


def interest(units: str, due: str, on: str) -> str:
    """Late interest in ten-thousandths: ten places half up, then four."""
    accrued = f"(({units} * 40000 + 15) // 30 * date_diff('day', {due}, {on}) + 500000) // 1000000"
    return f"CASE WHEN {on} > {due} THEN {accrued} ELSE 0 END"


def twelfth(units: str) -> str:
    return f"({units} * 2 + 12) // 24"


# name -> (CTEs it needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "charge": ((), """SELECT * FROM (VALUES (1,'ConsumoAgua'),(2,'PatenteComercial'),(3,'ImpuestoPropiedad'),
        (4,'RecoleccionBasura'),(5,'MantenimientoParques'),(6,'ReconexionAgua'),(7,'InteresesMoratorios'))
        AS t(charge_id, charge_name)"""),
    "use_name": ((), """SELECT * FROM (VALUES (1,'Habitación'),(2,'Comercial'),(3,'Industrial'),(4,'Lote Baldío'),
        (5,'Agrícola')) AS t(use_id, use_name)"""),
    "zone_name": ((), """SELECT * FROM (VALUES (1,'Residencial'),(2,'Agrícola'),(3,'Bosque'),(4,'Industrial'),
        (5,'Comercial')) AS t(zone_id, zone_name)"""),
    "property": ((), """SELECT c_custkey AS property_id, c_custkey AS meter_id,
        CAST(50 + (c_custkey * 37) % 1450 AS DECIMAL(10,2)) AS area_m2,
        CAST(1 + c_custkey % 5 AS INTEGER) AS use_id, CAST(1 + n_regionkey AS INTEGER) AS zone_id,
        CAST(round(abs(c_acctbal) * 1000) AS BIGINT) * 10000 AS fiscal_u,
        DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registered_on
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "person": ((), """SELECT s_suppkey AS document, s_name AS name,
        DATE '2024-01-01' + CAST(s_suppkey % 31 AS INTEGER) AS known_on FROM supplier"""),
    "reading": ((), """SELECT DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) AS op_date, event_id AS position,
        user_id AS meter_id,
        CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 ELSE 0 END AS movement,
        CAST(value AS DECIMAL(10,2)) AS value FROM events"""),
    "own_day": (("property", "person"), """SELECT DISTINCT user_id AS property_id, event_id % 7 AS document,
        CAST(ts AS DATE) AS op_date, CASE event_type WHEN 'signup' THEN 1 ELSE 2 END AS action
        FROM events JOIN property ON property_id = user_id JOIN person ON document = event_id % 7
        WHERE event_type IN ('signup','error') AND CAST(ts AS DATE) >= known_on
          AND CAST(ts AS DATE) >= registered_on"""),
    "own_step": (("own_day",), """SELECT * FROM (SELECT *, coalesce(lag(action) OVER (PARTITION BY property_id, document
        ORDER BY op_date, action), 2) AS before FROM own_day) t WHERE action <> before"""),
    "ownership": (("own_step",), """SELECT property_id, document, op_date AS start_date, end_date FROM (SELECT *,
        lead(op_date) OVER (PARTITION BY property_id, document ORDER BY op_date, action) AS end_date FROM own_step) t
        WHERE action = 1"""),
    "owner_text": (("ownership",), """SELECT property_id,
        string_agg(substring(CAST(document AS VARCHAR), 1, 20), ', ' ORDER BY document) AS owners
        FROM ownership WHERE end_date IS NULL GROUP BY property_id"""),
    "auto_charge": (("property",), """SELECT property_id, 3 AS charge_id, registered_on AS op_date FROM property
        UNION ALL SELECT property_id, 1, registered_on FROM property WHERE use_id IN (1,2,3)
        UNION ALL SELECT property_id, 4, registered_on FROM property WHERE use_id <> 5
        UNION ALL SELECT property_id, 5, registered_on FROM property WHERE zone_id IN (1,5)"""),
    "charge_move": (("property", "auto_charge"), """SELECT property_id, charge_id, op_date, 1 AS action FROM auto_charge
        UNION ALL SELECT property_id, CAST(1 + event_id % 8 AS INTEGER),
          DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER), CASE event_type WHEN 'view' THEN 1 ELSE 2 END
        FROM events JOIN property ON property_id = user_id
        WHERE event_type IN ('view','error') AND event_id % 8 < 7
          AND DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) >= registered_on"""),
    "assigned": (("charge_move",), """SELECT property_id, charge_id, min(op_date) AS from_date FROM charge_move
        WHERE action = 1 GROUP BY property_id, charge_id"""),
    "assignment": (("assigned", "charge_move"), """SELECT a.property_id, a.charge_id, a.from_date,
        min(m.op_date) FILTER (m.action = 2 AND m.op_date >= a.from_date) AS to_date
        FROM assigned a JOIN charge_move m ON m.property_id = a.property_id AND m.charge_id = a.charge_id
        GROUP BY a.property_id, a.charge_id, a.from_date"""),
    "water_now": (("property", "use_name", "assignment"), """SELECT property_id FROM property JOIN use_name USING (use_id)
        WHERE use_name IN ('Residencial','Industrial','Comercial') AND property_id IN
          (SELECT property_id FROM assignment WHERE charge_id = 1 AND to_date IS NULL)"""),
    "water_span": (("property", "use_name", "assignment"), """SELECT property_id, from_date,
        coalesce(to_date, DATE '9999-12-31') AS to_date
        FROM property JOIN use_name USING (use_id) JOIN assignment USING (property_id)
        WHERE use_name IN ('Residencial','Industrial','Comercial') AND charge_id = 1
          AND (to_date IS NULL OR to_date > from_date)"""),
    "invoice": ((), """SELECT o_orderkey AS invoice_id, o_custkey AS property_id,
        CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_orderdate AS DATE) + 15 AS due_date,
        CAST(round(o_totalprice * 10000) AS BIGINT) AS original_u,
        CAST(round(o_totalprice * 10000) AS BIGINT)
          + CASE o_orderstatus WHEN 'F' THEN o_orderkey % 100 * 10000 ELSE 0 END AS final_u,
        CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS state FROM orders"""),
    "paid_date": ((), """SELECT o_orderkey AS invoice_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45
        + CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 0 END AS INTEGER) AS paid_on FROM orders WHERE o_orderstatus = 'F'"""),
    "pending": (("invoice",), "SELECT * FROM invoice WHERE state = 1"),
    "active_cut": (("pending", "water_now"), f"""SELECT property_id, invoice_id FROM (SELECT property_id, invoice_id,
        row_number() OVER (PARTITION BY property_id ORDER BY invoice_date, invoice_id) AS rn FROM pending
        WHERE due_date + 10 < {CUT_DATE} AND property_id IN (SELECT property_id FROM water_now)) t WHERE rn = 1"""),
    "standing": (("invoice", "water_now", "active_cut"), f"""SELECT i.*,
        i.property_id IN (SELECT property_id FROM water_now) AND i.property_id IN (SELECT property_id FROM active_cut)
          AS cut_off,
        count(*) FILTER (i.state = 1 AND i.due_date < {AS_OF}) OVER (PARTITION BY i.property_id)
          = CASE WHEN i.state = 1 AND i.due_date < {AS_OF} THEN 1 ELSE 0 END AS last_overdue,
        i.state = 1 AND row_number() OVER (PARTITION BY i.property_id, i.state ORDER BY i.invoice_date, i.invoice_id) = 1
          AS oldest FROM invoice i"""),
    "header": (("standing", "paid_date", "property", "use_name", "zone_name"), f"""SELECT s.invoice_id, s.property_id, s.invoice_date,
        s.due_date, s.state, p.paid_on, u.use_name, z.zone_name, {AS_OF} AS as_of, s.original_u, s.final_u, s.oldest,
        CASE WHEN s.state = 1 THEN {interest('s.original_u', 's.due_date', AS_OF)} ELSE 0 END AS interest_u,
        CASE WHEN s.state = 1 AND s.cut_off AND s.last_overdue AND s.due_date < {AS_OF} THEN 300000000 ELSE 0 END AS fee_u
        FROM standing s LEFT JOIN paid_date p USING (invoice_id) LEFT JOIN property r USING (property_id)
        LEFT JOIN use_name u USING (use_id) LEFT JOIN zone_name z USING (zone_id)"""),
    "op_day": ((), "SELECT DISTINCT CAST(o_orderdate AS DATE) AS op_date FROM orders"),
    "gate": ((), "SELECT DISTINCT CAST(o_orderdate AS DATE) AS op_date FROM orders WHERE o_orderpriority = '1-URGENT'"),
    "bill_day": (("property", "op_day"), """SELECT property_id, op_date FROM property JOIN (SELECT op_date,
          unnest(range(day(op_date), CASE WHEN op_date = last_day(op_date) THEN 32 ELSE day(op_date) + 1 END)) AS day_key
          FROM op_day) d ON day(registered_on) = day_key WHERE registered_on <= op_date"""),
    "fiscal_change": (("property",), """SELECT o_custkey AS property_id, CAST(o_orderdate AS DATE) AS op_date,
        arg_max(CAST(round(o_totalprice * 10000) AS BIGINT), o_orderkey) AS value_u
        FROM orders JOIN property ON property_id = o_custkey
        WHERE o_orderstatus = 'P' AND CAST(o_orderdate AS DATE) >= registered_on GROUP BY ALL"""),
    "move": (("reading", "property"), """SELECT property_id, r.op_date, position, movement, value,
        count(*) FILTER (movement = 1) OVER (PARTITION BY property_id ORDER BY r.op_date, position) AS segment
        FROM reading r JOIN property USING (meter_id) WHERE r.op_date >= registered_on"""),
    "balance": (("move",), """SELECT property_id, op_date, position, CAST(sum(CASE movement WHEN 1 THEN value
        WHEN 2 THEN -value WHEN 3 THEN value ELSE 0 END)
        OVER (PARTITION BY property_id, segment ORDER BY op_date, position) AS DECIMAL(28,2)) AS balance FROM move"""),
    "balance_day": (("balance",), """SELECT property_id, op_date, arg_max(balance, position) AS balance FROM balance
        GROUP BY ALL"""),
    "fact": (("bill_day", "balance_day", "fiscal_change", "property"), """SELECT b.property_id, b.op_date, p.area_m2,
        coalesce(f.value_u, p.fiscal_u) AS fiscal_u, coalesce(m.balance, 0.00) AS balance FROM bill_day b
        ASOF LEFT JOIN balance_day m ON b.property_id = m.property_id AND b.op_date >= m.op_date
        ASOF LEFT JOIN fiscal_change f ON b.property_id = f.property_id AND b.op_date >= f.op_date
        JOIN property p ON p.property_id = b.property_id"""),
    "billed": (("fact", "assignment"), """SELECT f.*, charge_id FROM fact f JOIN assignment a USING (property_id)
        WHERE from_date <= op_date AND (to_date IS NULL OR to_date > op_date)"""),
    "volume": (("billed",), """SELECT property_id, op_date, CAST(balance - coalesce(lag(balance) OVER
        (PARTITION BY property_id ORDER BY op_date), 0) AS DECIMAL(28,2)) AS consumption FROM billed WHERE charge_id = 1"""),
    "line": (("billed", "volume"), f"""SELECT b.property_id, b.op_date, b.charge_id,
        CASE b.charge_id
          WHEN 1 THEN CAST((5000 + greatest(consumption - 30, 0) * 1000) * 10000 AS BIGINT)
          WHEN 2 THEN CAST(1500000000 AS BIGINT) // 6
          WHEN 3 THEN ((b.fiscal_u * 10000 + 6) // 12 + 500000) // 1000000
          WHEN 4 THEN CASE WHEN area_m2 <= 400 THEN 1500000
            ELSE 1500000 + (CAST(area_m2 AS BIGINT) - 400 + 199) // 200 * 3000000 END
          WHEN 5 THEN {twelfth('20000000')} END AS amount_u,
        CASE b.charge_id WHEN 1 THEN concat('ConsumoAgua (', CAST(consumption AS VARCHAR), ' m3)')
          WHEN 2 THEN 'PatenteComercial' WHEN 3 THEN 'ImpuestoPropiedad' WHEN 4 THEN 'RecoleccionBasura'
          WHEN 5 THEN 'MantenimientoParques' END AS description
        FROM billed b LEFT JOIN volume v ON v.property_id = b.property_id AND v.op_date = b.op_date
        WHERE b.charge_id <= 5"""),
    "sent": ((), """SELECT CAST(l_shipdate AS DATE) AS op_date, CAST(o_custkey AS VARCHAR) AS property_id,
        CAST(1 + l_partkey % 2 AS INTEGER) AS method_id, concat(l_orderkey, '-', l_linenumber) AS reference,
        l_linenumber AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    "attempt": ((), """SELECT DISTINCT o_custkey AS property_id, CAST(l_shipdate AS DATE) AS op_date,
        CAST(1 + l_partkey % 2 AS INTEGER) AS method_id, concat(l_orderkey, '-', l_linenumber) AS reference
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    "numbered": (("attempt",), """SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY op_date, reference,
        method_id) AS n FROM attempt"""),
    "ranked": (("invoice",), """SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY invoice_date, invoice_id)
        AS rank, lead(due_date) OVER (PARTITION BY property_id ORDER BY invoice_date, invoice_id) AS next_due
        FROM invoice"""),
    "issued": (("invoice", "numbered"), """SELECT property_id, op_date, issued FROM (SELECT property_id, op_date, tries,
          coalesce(sum(bills) OVER (PARTITION BY property_id ORDER BY op_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS issued
          FROM (SELECT property_id, op_date, sum(bill) AS bills, sum(1 - bill) AS tries
            FROM (SELECT property_id, invoice_date AS op_date, 1 AS bill FROM invoice
              UNION ALL SELECT property_id, op_date, 0 FROM numbered) e GROUP BY property_id, op_date) d) t
        WHERE tries > 0"""),
    "backlog": (("numbered", "issued"), """SELECT n.*, greatest(max(n - issued) OVER (PARTITION BY n.property_id
        ORDER BY n), 0) AS backlog FROM numbered n JOIN issued i USING (property_id, op_date)"""),
    "tried": (("backlog",), """SELECT *, backlog > coalesce(lag(backlog) OVER (PARTITION BY property_id ORDER BY n), 0)
        AS rejected FROM backlog"""),
    "settled": (("ranked", "tried"), """SELECT r.*, t.op_date AS paid_on, t.method_id, t.reference FROM ranked r
        LEFT JOIN tried t ON t.property_id = r.property_id AND NOT t.rejected AND t.n - t.backlog = r.rank"""),
    "candidate": (("settled", "water_span", "gate"), """SELECT s.property_id, s.rank, s.invoice_id, s.paid_on, g.op_date
        FROM (SELECT s.*, to_date, greatest(due_date + 10, from_date - 1) AS ready FROM settled s
          JOIN water_span USING (property_id)) s
        ASOF JOIN gate g ON s.ready < g.op_date WHERE g.op_date < s.to_date"""),
    "step": (("candidate", "settled", "water_span"), """SELECT property_id, op_date, 1 AS phase,
          min(rank) AS rank FROM candidate WHERE op_date IS NOT NULL AND (paid_on IS NULL OR paid_on > op_date)
          GROUP BY property_id, op_date
        UNION ALL SELECT property_id, paid_on, 0, rank FROM settled JOIN water_span USING (property_id)
          WHERE paid_on IS NOT NULL AND from_date <= paid_on AND paid_on < to_date
            AND (next_due IS NULL OR next_due >= paid_on)"""),
    "toggle": (("step",), """SELECT * FROM (SELECT *, coalesce(lag(phase) OVER (PARTITION BY property_id
        ORDER BY op_date, phase, rank), 0) AS before FROM step) t WHERE phase <> before"""),
    "cycle": (("toggle", "ranked", "settled"), """SELECT t.property_id, c.invoice_id, t.op_date AS created_on, t.closed_on,
        f.invoice_id AS fee_invoice_id, c.paid_on FROM (SELECT *,
          lead(op_date) OVER (PARTITION BY property_id ORDER BY op_date, phase, rank) AS closed_on,
          lead(rank) OVER (PARTITION BY property_id ORDER BY op_date, phase, rank) AS fee_rank FROM toggle) t
        JOIN settled c ON c.property_id = t.property_id AND c.rank = t.rank
        LEFT JOIN ranked f ON f.property_id = t.property_id AND f.rank = t.fee_rank WHERE t.phase = 1"""),
}

# Payments of the desk beside those of the documents: after the date's invoices, in the order of the batches.
CTES |= {
    "turn": (("attempt",), """SELECT property_id, op_date AS made_on, method_id, reference, NULL::VARCHAR AS batch,
          NULL::INTEGER AS number, op_date AS turn, 0 AS phase FROM attempt
        UNION ALL SELECT DISTINCT o_custkey, CAST(l_shipdate AS DATE) + CAST(l_orderkey % 40 AS INTEGER),
          CAST(1 + l_partkey % 2 AS INTEGER), concat(l_orderkey, '-', l_linenumber), concat('desk ', l_linenumber),
          l_linenumber::INTEGER, CAST(l_shipdate AS DATE), 2
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'"""),
    "turn_backlog": (("turn", "invoice"), """SELECT *, greatest(max(n - issued) OVER (PARTITION BY property_id ORDER BY n), 0)
          AS backlog FROM (SELECT t.*, coalesce(i.issued, 0) AS issued, row_number() OVER (PARTITION BY t.property_id
            ORDER BY turn, phase, number, reference, method_id) AS n
          FROM turn t ASOF LEFT JOIN (SELECT property_id, invoice_date, sum(count(*)) OVER (PARTITION BY property_id
              ORDER BY invoice_date) AS issued FROM invoice GROUP BY property_id, invoice_date) i
            ON t.property_id = i.property_id AND turn - CASE phase WHEN 0 THEN 1 ELSE 0 END >= i.invoice_date) b"""),
    "turn_tried": (("turn_backlog",), """SELECT *, backlog > coalesce(lag(backlog) OVER (PARTITION BY property_id
        ORDER BY n), 0) AS rejected FROM turn_backlog"""),
    "desk_settled": (("ranked", "turn_tried"), """SELECT r.*, lead(invoice_date) OVER (PARTITION BY r.property_id
          ORDER BY r.rank) AS next_date, t.made_on AS paid_on, t.turn AS settled_on, t.method_id, t.reference, t.batch
        FROM ranked r LEFT JOIN turn_tried t
          ON t.property_id = r.property_id AND NOT t.rejected AND t.n - t.backlog = r.rank"""),
    "desk_step": (("desk_settled", "water_span", "gate"), """SELECT property_id, op_date, 1 AS phase, min(rank) AS rank,
          NULL::DATE AS paid_on, NULL::VARCHAR AS batch FROM
          (SELECT s.*, g.op_date FROM (SELECT s.*, to_date, greatest(due_date + 10, from_date - 1) AS ready
              FROM desk_settled s JOIN water_span USING (property_id)) s
            ASOF JOIN gate g ON s.ready < g.op_date WHERE g.op_date < s.to_date) c
          WHERE paid_on IS NULL OR settled_on > op_date OR (batch IS NOT NULL AND settled_on = op_date)
          GROUP BY property_id, op_date
        UNION ALL SELECT property_id, settled_on, CASE WHEN batch IS NULL THEN 0 ELSE 2 END, rank, paid_on, batch
          FROM desk_settled JOIN water_span USING (property_id)
          WHERE paid_on IS NOT NULL AND from_date <= settled_on AND settled_on < to_date
            AND (next_due IS NULL OR next_due >= paid_on OR (batch IS NOT NULL AND next_date > settled_on))"""),
    "desk_toggle": (("desk_step",), """SELECT * FROM (SELECT *, coalesce(lag(phase = 1) OVER (PARTITION BY property_id
        ORDER BY op_date, phase, rank), false) AS before FROM desk_step) t WHERE (phase = 1) <> before"""),
    "desk_cycle": (("desk_toggle", "ranked"), """SELECT t.property_id, c.invoice_id, t.op_date AS created_on, t.closed_on,
          f.invoice_id AS fee_invoice_id, t.closed_batch FROM (SELECT *, lead(paid_on) OVER w AS closed_on,
          lead(rank) OVER w AS fee_rank, lead(batch) OVER w AS closed_batch FROM desk_toggle
          WINDOW w AS (PARTITION BY property_id ORDER BY op_date, phase, rank)) t
        JOIN ranked c ON c.property_id = t.property_id AND c.rank = t.rank
        LEFT JOIN ranked f ON f.property_id = t.property_id AND f.rank = t.fee_rank WHERE t.phase = 1"""),
}

# The same settlement over the invoices the replay generates, with cuts on every operation date.
CTES["gen_invoice"] = (("bill_day", "line"), """SELECT d.property_id, d.op_date AS invoice_date,
        concat(d.property_id, '-', strftime(d.op_date, '%Y%m%d')) AS invoice_id, d.op_date + 15 AS due_date,
        CAST(coalesce(sum(l.amount_u), 0) AS BIGINT) AS original_u FROM bill_day d
        LEFT JOIN line l ON l.property_id = d.property_id AND l.op_date = d.op_date GROUP BY d.property_id, d.op_date""")
RENAMED = {"invoice": "gen_invoice", "gate": "op_day"} | {
    n: f"gen_{n}" for n in ("ranked", "issued", "backlog", "tried", "settled", "candidate", "step", "toggle", "cycle")
}
for _old, _new in RENAMED.items():
    if _new not in CTES:
        _needs, _text = CTES[_old]
        for _from, _to in RENAMED.items():
            _text = re.sub(rf"\b(FROM|JOIN) {_from}\b", rf"\1 {_to}", _text)
        CTES[_new] = (tuple(RENAMED.get(n, n) for n in _needs), _text)
CTES["gen_paid"] = (("gen_settled", "gen_cycle"), f"""SELECT s.*,
        {interest('s.original_u', 's.due_date', 's.paid_on')} AS interest_u,
        CASE WHEN f.fee_invoice_id IS NULL THEN 0 ELSE 300000000 END AS fee_u
        FROM gen_settled s LEFT JOIN gen_cycle f ON f.fee_invoice_id = s.invoice_id""")

LISTED = f"property_id, meter_id, area_m2, use_id, zone_id, {money('fiscal_u')} AS fiscal_value, registered_on, owners"


def fee_query(condition: str) -> tuple[tuple[str, ...], str]:
    return ("standing",), f"""SELECT property_id, invoice_id, CAST(CASE WHEN cut_off AND last_overdue AND {condition}
        THEN 30000 ELSE 0 END AS DECIMAL(19,4)) AS fee FROM standing WHERE state = 1"""


def line_query(charge_id: int) -> tuple[tuple[str, ...], str]:
    return ("line",), f"""SELECT property_id, op_date, {money('amount_u')} AS amount, description FROM line
        WHERE charge_id = {charge_id}"""


HEADER = f"""SELECT invoice_id, property_id, invoice_date, due_date, state, paid_on, use_name, zone_name, as_of,
    {money('original_u')} AS original_total, {money('interest_u')} AS interest, {money('fee_u')} AS fee,
    {money('CASE WHEN state = 1 THEN original_u + interest_u + fee_u ELSE final_u END')} AS computed_total,
    {money('final_u')} AS stored_total FROM header"""

# query -> (CTEs it needs, final SELECT)
QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "invoice_list_asof": (("standing", "paid_date"), f"""SELECT property_id, invoice_id, invoice_date, due_date, state, paid_on,
        {money('original_u')} AS original_total,
        {money(f'''CASE WHEN state = 1 THEN original_u + ({interest('original_u', 'due_date', AS_OF)})
           + CASE WHEN cut_off AND last_overdue THEN 300000000 ELSE 0 END ELSE final_u END''')} AS total
        FROM standing LEFT JOIN paid_date USING (invoice_id)"""),
    "invoice_detail_header": (("header",), HEADER),
    "payment_simulation": (("header",), HEADER + " WHERE oldest"),
    "invoice_detail_lines": (("header", "charge"), f"""SELECT l_orderkey AS invoice_id, charge_id, charge_name,
          CAST(l_extendedprice AS DECIMAL(19,4)) AS amount, concat('line ', l_linenumber) AS description
          FROM lineitem JOIN charge ON charge_id = l_linenumber
        UNION ALL SELECT invoice_id, 7, 'InteresesMoratorios', {money('interest_u')}, 'Intereses moratorios'
          FROM header WHERE state = 1 AND interest_u > 0
        UNION ALL SELECT invoice_id, 6, 'ReconexionAgua', {money('fee_u')}, 'Reconexión de agua'
          FROM header WHERE state = 1 AND fee_u > 0"""),
    "line_totals": ((), """SELECT l_orderkey AS invoice_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4)))
        AS DECIMAL(19,4)) AS total FROM lineitem GROUP BY l_orderkey"""),
    "late_interest": (("invoice",), f"""SELECT invoice_id,
        CAST(greatest(date_diff('day', due_date, {AS_OF}), 0) AS INTEGER) AS days_late,
        {money(interest('original_u', 'due_date', AS_OF))} AS interest FROM invoice"""),
    "oldest_pending": (("standing",), f"""SELECT property_id, invoice_date, invoice_id, due_date,
        {money('original_u')} AS original_total FROM standing WHERE oldest"""),
    "pending_paid_summary": (("standing",), """SELECT property_id, count(*) FILTER (state = 1) AS pending,
        count(*) FILTER (state <> 1) AS paid, max(CASE WHEN oldest THEN invoice_id END) AS oldest_pending_id,
        max(CASE WHEN oldest THEN concat('RCTP-', strftime(invoice_date, '%Y%m'), '-', property_id) END)
        AS next_reference FROM standing GROUP BY property_id"""),
    "payment_reference": (("standing",), """SELECT property_id,
        concat('RCTP-', strftime(invoice_date, '%Y%m'), '-', property_id) AS reference FROM standing WHERE oldest"""),
    "last_overdue_flag": (("standing",), "SELECT invoice_id, last_overdue FROM standing WHERE state = 1"),
    "must_have_water_flag": (("property", "water_now"), """SELECT property_id,
        property_id IN (SELECT property_id FROM water_now) AS must_have_water FROM property"""),
    "reconnection_fee_pay": fee_query("oldest"),
    "reconnection_fee_list": fee_query("TRUE"),
    "reconnection_fee_detail": fee_query(f"due_date < {AS_OF}"),
    "auto_charges": (("auto_charge",), "SELECT property_id, charge_id, op_date FROM auto_charge"),
    "new_only_insert": (("property",), """SELECT o_custkey AS property_id, CAST(min(o_orderdate) AS DATE) AS op_date,
        arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS position FROM orders
        WHERE o_custkey NOT IN (SELECT property_id FROM property WHERE use_id <= 2) GROUP BY o_custkey"""),
    "ownership_intervals": (("ownership",), "SELECT property_id, document, start_date, end_date FROM ownership"),
    "charge_intervals": (("assignment",), "SELECT property_id, charge_id, from_date, to_date FROM assignment"),
    "fiscal_asof": (("invoice", "fiscal_change", "property"), f"""SELECT d.property_id, d.op_date,
        {money('coalesce(f.value_u, p.fiscal_u)')} AS fiscal
        FROM (SELECT DISTINCT property_id, invoice_date AS op_date FROM invoice) d
        ASOF LEFT JOIN fiscal_change f ON d.property_id = f.property_id AND d.op_date >= f.op_date
        JOIN property p ON p.property_id = d.property_id"""),
    "billing_days": (("bill_day",), "SELECT property_id, op_date FROM bill_day"),
    "charge_water": line_query(1),
    "charge_licence": line_query(2),
    "charge_tax": line_query(3),
    "charge_garbage": line_query(4),
    "charge_parks": line_query(5),
    "invoice_totals": (("bill_day", "line"), f"""SELECT d.op_date,
        concat(d.property_id, '-', strftime(d.op_date, '%Y%m%d')) AS invoice_id, d.property_id,
        d.op_date + 15 AS due_date, {money('coalesce(sum(l.amount_u), 0)')} AS original_total
        FROM bill_day d LEFT JOIN line l ON l.property_id = d.property_id AND l.op_date = d.op_date
        GROUP BY d.property_id, d.op_date"""),
    "meter_balance": (("reading",), """SELECT meter_id, op_date, position, CAST(sum(CASE movement WHEN 1 THEN value
        WHEN 2 THEN -value WHEN 3 THEN value ELSE 0 END) OVER (PARTITION BY meter_id, segment ORDER BY op_date, position)
        AS DECIMAL(28,2)) AS balance FROM (SELECT *, count(*) FILTER (movement = 1) OVER (PARTITION BY meter_id
        ORDER BY op_date, position) AS segment FROM reading) t"""),
    "consumption_per_invoice": (("volume",), "SELECT property_id, op_date, consumption FROM volume"),
    "payment_dedupe": (("attempt",), "SELECT property_id, op_date, method_id, reference FROM attempt"),
    "payment_match_fifo": (("settled",), f"""SELECT property_id, invoice_id, paid_on, method_id, reference,
        {money(interest('original_u', 'due_date', 'paid_on'))} AS interest FROM settled WHERE paid_on IS NOT NULL"""),
    "payment_rejects": (("tried",), """SELECT op_date, 'payment' AS step, 50014 AS code,
        concat(property_id, '/', reference) AS key, 'nothing pending' AS reason FROM tried WHERE rejected"""),
    "desk_settlement": (("desk_settled",), f"""SELECT property_id, invoice_id, paid_on, settled_on, method_id, reference, batch,
        {money(interest('original_u', 'due_date', 'paid_on'))} AS interest FROM desk_settled WHERE paid_on IS NOT NULL"""),
    "desk_rejects": (("turn_tried",), """SELECT property_id, made_on AS op_date, method_id, reference, batch,
        turn AS settled_on FROM turn_tried WHERE rejected"""),
    "desk_cuts": (("desk_cycle",), "SELECT * FROM desk_cycle"),
    "payment_batch_positional": (("attempt", "pending"), f"""SELECT a.property_id, a.op_date, a.reference, a.method_id,
        p.invoice_id, {money(interest('original_u', 'due_date', 'op_date'))} AS interest,
        {money(f"final_u + {interest('original_u', 'due_date', 'op_date')}")} AS amount
        FROM (SELECT *, row_number() OVER (PARTITION BY property_id, op_date ORDER BY reference, method_id) AS k
          FROM attempt) a
        JOIN (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY invoice_date, invoice_id) AS k
          FROM pending) p ON p.property_id = a.property_id AND p.k = a.k"""),
    "cut_orders_day": (("active_cut",), f"SELECT property_id, invoice_id, {CUT_DATE} AS op_date FROM active_cut"),
    "cut_orders_next": (("pending", "water_now", "active_cut"), f"""SELECT property_id, invoice_id, {LATER_CUT_DATE} AS op_date
        FROM (SELECT property_id, invoice_id,
          row_number() OVER (PARTITION BY property_id ORDER BY invoice_date, invoice_id) AS rn FROM pending
          WHERE due_date + 10 < {LATER_CUT_DATE} AND property_id IN (SELECT property_id FROM water_now)
            AND property_id NOT IN (SELECT property_id FROM active_cut)) t WHERE rn = 1"""),
    "reconnections_day": (("active_cut",), f"""SELECT property_id, invoice_id, {LATER_CUT_DATE} AS op_date FROM active_cut
        WHERE invoice_id % 3 = 0 AND invoice_id % 2 <> 0"""),
    "cut_orders_bulk": (("cycle",), "SELECT property_id, invoice_id, created_on, closed_on FROM cycle"),
    "fees_bulk": (("cycle",), """SELECT property_id, fee_invoice_id AS invoice_id, closed_on AS op_date,
        CAST(30000 AS DECIMAL(19,4)) AS fee FROM cycle WHERE closed_on IS NOT NULL"""),
    "reconnection_orders_bulk": (("cycle",), """SELECT property_id, invoice_id, paid_on AS op_date FROM cycle
        WHERE paid_on IS NOT NULL AND (closed_on IS NULL OR paid_on < closed_on)"""),
    "property_search_prefix": (("property", "owner_text"), f"""SELECT {LISTED} FROM property
        LEFT JOIN owner_text USING (property_id) WHERE CAST(property_id AS VARCHAR) LIKE '1%'"""),
    "property_search_owner": (("property", "owner_text", "ownership"), f"""SELECT {LISTED} FROM property
        LEFT JOIN owner_text USING (property_id) WHERE property_id IN (SELECT property_id FROM ownership
          WHERE document = 3 AND end_date IS NULL)"""),
    "property_profile": (("property", "use_name", "zone_name", "ownership", "person", "assignment", "charge"),
        """SELECT property_id, 'property' AS part, concat(use_name, '/', zone_name) AS item, registered_on AS since
          FROM property JOIN use_name USING (use_id) JOIN zone_name USING (zone_id)
        UNION ALL SELECT property_id, 'owner', name, start_date FROM ownership JOIN person USING (document)
          WHERE end_date IS NULL
        UNION ALL SELECT property_id, 'charge', charge_name, from_date FROM assignment JOIN charge USING (charge_id)"""),
    "owner_list": (("property", "owner_text"), """SELECT property_id, owners FROM property
        LEFT JOIN owner_text USING (property_id)"""),
    "owner_split": (("ownership",), """SELECT property_id, CAST(row_number() OVER (PARTITION BY property_id
        ORDER BY document) - 1 AS INTEGER) AS place, CAST(document AS VARCHAR) AS owner FROM ownership
        WHERE end_date IS NULL"""),
    "property_codes": (("property",), """SELECT property_id, CASE WHEN property_id IN (SELECT property_id FROM property)
        THEN 0 ELSE 3 END AS code FROM (SELECT DISTINCT user_id * 13 AS property_id FROM events) t"""),
    "search_route": ((), """SELECT c_custkey AS request_id, CASE c_custkey % 3 WHEN 0 THEN 'document' WHEN 1 THEN 'prefix'
        ELSE 'all' END AS route FROM customer"""),
    "catalog_normalize": ((), """SELECT p_partkey AS item_id, CASE WHEN p_size % 4 = 3
        THEN nullif(CAST(p_retailprice AS DECIMAL(10,2)), 0) END AS value FROM part"""),
    "param_default": ((), """SELECT p_partkey AS item_id,
        CAST(CASE WHEN p_size % 4 IN (1, 3) THEN p_size ELSE 15 END AS INTEGER) AS due_days FROM part"""),
    "charge_subtypes": ((), f"""SELECT p_partkey AS charge_id,
        CASE WHEN p_size % 7 IN (0, 3) THEN CAST(p_retailprice AS DECIMAL(19,4)) END AS min_amount,
        CASE WHEN p_size % 7 = 0 THEN p_size END AS min_m3,
        CASE WHEN p_size % 7 = 0 THEN CAST(p_retailprice AS DECIMAL(19,4)) END AS per_m3,
        CASE WHEN p_size % 7 IN (2, 6) THEN CAST(p_size AS DECIMAL(10,2)) END AS rate,
        CASE WHEN p_size % 7 IN (1, 3, 4, 5) THEN CAST(p_retailprice AS DECIMAL(19,4)) END AS fixed,
        CASE WHEN p_size % 7 IN (2, 3) THEN p_size * 2 END AS min_m2,
        CASE WHEN p_size % 7 = 2 THEN p_size * 3 END AS tranche_m2,
        CASE p_size % 7 WHEN 0 THEN 'ConsumoAgua' WHEN 1 THEN 'PatenteComercial' WHEN 2 THEN 'ImpuestoPropiedad'
          WHEN 3 THEN 'RecoleccionBasura' WHEN 4 THEN 'MantenimientoParques' WHEN 5 THEN 'ReconexionAgua'
          ELSE 'InteresesMoratorios' END AS subtype FROM part"""),
    "duplicate_dates": ((), """SELECT CAST(o_orderdate AS DATE) AS op_date, count(*) AS times FROM orders GROUP BY 1
        HAVING count(*) > 1"""),
    "invoice_codes": (("invoice",), """SELECT invoice_id, CASE WHEN invoice_id IN (SELECT invoice_id FROM invoice) THEN 0
        ELSE 40002 END AS code FROM (SELECT DISTINCT l_orderkey * 2 AS invoice_id FROM lineitem) t"""),
    "person_codes": (("person",), """SELECT document, CASE WHEN document IN (SELECT document FROM person) THEN 0
        ELSE 4 END AS code FROM (SELECT DISTINCT user_id AS document FROM events) t"""),
    "xml_roundtrip": ((), """SELECT CAST(l_shipdate AS DATE) AS op_date, CAST(o_custkey AS VARCHAR) AS property_id,
        CAST(1 + l_partkey % 2 AS INTEGER) AS method_id, concat(l_orderkey, '-', l_linenumber) AS reference
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    "xml_persons": ((), """SELECT DATE '2024-01-01' AS op_date, CAST(s_suppkey AS VARCHAR) AS document, s_name AS name,
        concat('a&b<', s_suppkey, '>"@x.cr') AS email,
        CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS phone FROM supplier"""),
    "xml_properties": (("property",), f"""SELECT registered_on AS op_date, CAST(property_id AS VARCHAR) AS property_id,
        CAST(meter_id AS VARCHAR) AS meter_id, area_m2, use_id, zone_id, {money('fiscal_u')} AS fiscal_value,
        registered_on FROM property"""),
    "xml_ownership": ((), """SELECT CAST(ts AS DATE) AS op_date, CAST(user_id AS VARCHAR) AS property_id,
        CAST(event_id % 7 AS VARCHAR) AS document, CASE event_type WHEN 'signup' THEN 1 ELSE 2 END AS action
        FROM events WHERE event_type IN ('signup', 'error')"""),
    "xml_charges": ((), """SELECT DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) AS op_date,
        CAST(user_id AS VARCHAR) AS property_id, CAST(1 + event_id % 8 AS INTEGER) AS charge_id,
        CASE event_type WHEN 'view' THEN 1 ELSE 2 END AS action FROM events WHERE event_type IN ('view', 'error')"""),
    "xml_fiscal": ((), """SELECT CAST(o_orderdate AS DATE) AS op_date, CAST(o_custkey AS VARCHAR) AS property_id,
        CAST(o_totalprice AS DECIMAL(19,4)) AS value FROM orders WHERE o_orderstatus = 'P'"""),
    "xml_readings": (("reading",), """SELECT op_date, CAST(meter_id AS VARCHAR) AS meter_id, movement, value
        FROM reading"""),
    "xml_positions": (("reading",), """SELECT op_date, CAST(row_number() OVER (PARTITION BY op_date, position // 24000
        ORDER BY position) - 1 AS INTEGER) AS position, CAST(meter_id AS VARCHAR) AS meter_id, movement, value
        FROM reading"""),
    "load_rejects": (("sent",), """SELECT op_date, step, 50002 AS code, reason, count(*) AS n FROM (
          SELECT CAST(NULL AS DATE) AS op_date, 'document' AS step, 'unreadable element' AS reason FROM sent WHERE line = 1
          UNION ALL SELECT NULL, 'document', 'element without a readable date' FROM sent WHERE line = 2
          UNION ALL SELECT NULL, 'payment', 'in an element without a readable date' FROM sent WHERE line = 2
          UNION ALL SELECT op_date, 'payment', 'unreadable method_id' FROM sent WHERE line = 3) t
        GROUP BY op_date, step, reason"""),
    "load_survivors": (("sent",), """SELECT op_date, property_id, CASE WHEN line <> 3 THEN method_id END AS method_id,
        reference FROM sent WHERE line > 2"""),
    "replay_invoices": (("gen_paid",), f"""SELECT property_id, invoice_id, invoice_date, due_date,
        {money('original_u')} AS original_total,
        {money('original_u + CASE WHEN paid_on IS NULL THEN 0 ELSE interest_u + fee_u END')} AS final_total,
        CASE WHEN paid_on IS NULL THEN 1 ELSE 2 END AS state FROM gen_paid"""),
    "replay_cut_orders": (("gen_cycle",), """SELECT property_id, invoice_id, created_on, closed_on,
        CASE WHEN closed_on IS NULL THEN 1 ELSE 2 END AS state FROM gen_cycle"""),
    "replay_lines": (("line", "gen_paid"), """SELECT charge_id, count(*) AS lines,
        CAST(CAST(sum(amount_u) AS DECIMAL(33,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(38,4)) AS amount FROM (
          SELECT charge_id, amount_u FROM line
          UNION ALL SELECT 7, interest_u FROM gen_paid WHERE paid_on IS NOT NULL AND interest_u > 0
          UNION ALL SELECT 6, fee_u FROM gen_paid WHERE paid_on IS NOT NULL AND fee_u > 0) t GROUP BY charge_id"""),
    "property_balances": (("balance_day",), "SELECT property_id, op_date, balance FROM balance_day"),
    "operation_gates": ((), """SELECT CAST(o_orderdate AS DATE) AS op_date,
        count(*) FILTER (o_orderpriority = '1-URGENT') > 0 AS gate FROM orders GROUP BY ALL"""),
}


QUERIES["stream_meter_balance"] = QUERIES["stream_meter_batches"] = QUERIES["meter_balance"]


def sql(name: str) -> str:
    """The query with the CTEs it needs, each after the ones it reads."""
    needs, body = QUERIES[name]
    ordered: list[str] = []

    def visit(cte: str) -> None:
        if cte in ordered:
            return
        for dep in CTES[cte][0]:
            visit(dep)
        ordered.append(cte)

    for cte in needs:
        visit(cte)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{cte} AS MATERIALIZED ({CTES[cte][1]})" for cte in ordered) + "\n" + body


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in QUERIES}
