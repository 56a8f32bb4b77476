"""The inquiries and the payment of the billing desk, over the table store.

Every inquiry returns ``(code, tables)``: code 0, or the result code of the failed lookup with empty tables.
Without an id the inquiry answers for all properties or invoices at once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import rules as R
from cadastra.operators import inquiry, payments, service
from cadastra.plans import state
from cadastra.plans.daily import fee_closings
from cadastra.plans.replay import paid_rows, payment_lines
from cadastra.rules import Rules
from cadastra.schemas import LOGS
from cadastra.sources.catalog import Catalog
from cadastra.sources.commits import Conflict
from cadastra.sources.store import DESK, Store

Answer = tuple[int, dict[str, DataFrame]]


class BillingDesk:
    """A view of the store as it was when the object was made."""

    def __init__(self, store: Store, catalog: Catalog, rules: Rules = Rules()):
        self.store = store
        self.catalog = catalog
        self.rules = rules
        # Read first: what is committed while the tables are opened makes a payment start over.
        self.version, self.seen = store.version(), store.last_day()
        self.tables = {table: store.read(table) for table in LOGS}

    # -- state ----------------------------------------------------------------------------

    @cached_property
    def properties(self) -> DataFrame:
        return state.properties(self.tables)

    @cached_property
    def ownership(self) -> DataFrame:
        return state.ownership(self.tables["ownership_log"])

    @cached_property
    def assignments(self) -> DataFrame:
        return state.assignments(self.tables["charge_log"])

    @cached_property
    def invoice_state(self) -> DataFrame:
        return state.invoices(self.tables["invoice"], self.tables["payment"])

    @cached_property
    def payments(self) -> DataFrame:
        return state.payments(self.tables["payment"])

    @cached_property
    def water(self) -> DataFrame:
        t, c = self.tables, self.catalog
        return service.must_have_water(t["property"], c.uses, self.assignments, c.charges, self.rules)

    @cached_property
    def active_cuts(self) -> DataFrame:
        return state.active_cuts(self.tables["cut_open"], self.tables["cut_close"])

    def fee(self):
        fee = self.catalog.reconnection_fee()
        return F.lit(0).cast("decimal(19,4)") if fee is None else fee

    @cached_property
    def detail_rules(self) -> Rules:
        """The detail accrues interest only if the catalog has an interest charge."""
        listed = not self.catalog.charges.where(F.col("name") == R.LATE_INTEREST).isEmpty()
        return self.rules if listed else replace(self.rules, interest_rate=Decimal("0.00"))

    def known(self, property_id: str) -> bool:
        return not self.tables["property"].where(F.col("property_id") == property_id).isEmpty()

    # -- inquiries ------------------------------------------------------------------------

    def search(self, q: str | None = None) -> Answer:
        code, rows = inquiry.search(self.properties, self.ownership, self.tables["person"], q)
        return code, {"properties": rows.orderBy("property_id")}

    def profile(self, property_id: str | None = None) -> Answer:
        code = 0 if property_id is None or self.known(property_id) else R.PROPERTY_UNKNOWN
        persons = self.tables["person"].drop("op_date")
        parts = inquiry.property_profile(
            self.properties,
            self.catalog.uses,
            self.catalog.zones,
            self.ownership,
            persons,
            self.assignments,
            self.catalog.charges,
            property_id,
        )
        order = {"property": ["property_id"], "owners": ["start_date", "document"], "charges": ["charge_id"]}
        return code, parts if property_id is None else {k: df.orderBy(*order[k]) for k, df in parts.items()}

    def invoices(self, property_id: str | None = None, on: dt.date | None = None) -> Answer:
        code = 0 if property_id is None or self.known(property_id) else R.PROPERTY_UNKNOWN
        rows = inquiry.invoice_list(
            self.invoice_state, self.payments, self.water, self.active_cuts, _date(on), self.fee(), property_id, self.rules
        )
        return code, {"invoices": rows}

    def invoice_detail(self, invoice_id: str | None = None, on: dt.date | None = None) -> Answer:
        chosen = self.invoice_state
        if invoice_id is not None:
            one = chosen.where(F.col("invoice_id") == invoice_id).select("property_id")
            chosen = chosen.join(one, "property_id", "left_semi")
        headers = inquiry.invoice_headers(
            chosen,
            self.payments,
            self.tables["property"],
            self.catalog.uses,
            self.catalog.zones,
            self.water,
            self.active_cuts,
            _date(on),
            self.fee(),
            self.detail_rules,
        )
        lines = self.tables["invoice_line"]
        if invoice_id is not None:
            headers = headers.where(F.col("invoice_id") == invoice_id)
            lines = lines.where(F.col("invoice_id") == invoice_id)
        code = R.INVOICE_UNKNOWN if invoice_id is not None and headers.isEmpty() else 0
        shown = inquiry.invoice_lines(lines, headers, self.catalog.charges)
        ordered = shown if invoice_id is None else shown.orderBy("charge_name", "charge_id")
        return code, {"header": headers, "lines": ordered}

    def simulate_payment(self, property_id: str, on: dt.date | None = None) -> Answer:
        """Detail of the oldest pending invoice at the payment date."""
        mine = self.invoice_state.where(F.col("property_id") == property_id)
        oldest = inquiry.oldest_ids(mine).first()
        if oldest is None:
            return R.NOTHING_PENDING, {}
        return self.invoice_detail(oldest["invoice_id"], on)

    def summary(self, property_id: str | None = None) -> Answer:
        code = 0 if property_id is None or self.known(property_id) else R.PROPERTY_UNKNOWN
        return code, {"summary": inquiry.account_summary(inquiry.only(self.invoice_state, property_id))}

    # -- payment --------------------------------------------------------------------------

    def pay(self, attempts: DataFrame, on: dt.date, batch: str | None = None) -> dict[str, DataFrame]:
        """Pay the oldest pending invoices with a batch of attempts (property_id, method_id, reference) at ``on``.

        Returns the paid invoices, their lines and the rejected attempts. The batch is written aside and counts from its
        commit on; later replays keep it. ``batch`` names it; without a name its attempts and date do. A batch that is
        committed is not paid again: its rows are returned. What was committed since this desk was made is taken into
        account: the batch is worked out again on the newer state until no other commit comes first. Make a new desk to
        see the result in inquiries.
        """
        tries = attempts.withColumn("op_date", F.lit(on)).select(*payments.ATTEMPT)
        batch = batch or _batch_name(tries, on)
        desk = self
        while (folder := self.store.find_batch(batch)) is None:
            if desk.version != self.store.version():
                desk = BillingDesk(self.store, self.catalog, self.rules)
            try:
                return desk._paid(desk._commit(tries, on, batch))
            except Conflict:
                continue
        return self._paid({name: self.store.batch(name, folder) for name in DESK})

    def _commit(self, tries: DataFrame, on: dt.date, batch: str) -> dict[str, DataFrame]:
        """Write the results of a batch on this desk's state and commit them; reads the snapshot, not the history."""
        t, store, folder = self.store.state(), self.store, uuid.uuid4().hex
        if store.version() != self.version:
            raise Conflict("the store has changed since this desk was made")
        store.write_batch("attempt", folder, tries)
        pending = state.pending(t["invoice"], t["payment"])
        pending = pending.join(tries.select("property_id").distinct(), "property_id", "left_semi")
        settled, unmatched = payments.settle_batch(pending, tries, F.lit(on), self.rules)
        c, cuts = self.catalog, state.active_cuts(t["cut_open"], t["cut_close"])
        water = service.must_have_water(t["property"], c.uses, state.assignments(t["charge_log"]), c.charges, self.rules)
        closing = fee_closings(settled, water, cuts, c.reconnection_fee())
        paid = store.write_batch("payment", folder, paid_rows(settled, closing))
        closed = closing.select(F.lit(on).alias("op_date"), "property_id", F.col("cut_id").alias("invoice_id"))
        closed = store.write_batch("cut_close", folder, closed)
        extra = store.write_batch("invoice_line", folder, payment_lines(paid, self.catalog.charges))
        incomplete = payments.incomplete_attempts(tries)
        rejects = store.write_batch("reject", folder, payments.payment_rejects(unmatched).unionByName(incomplete))
        store.complete_batch(batch, folder, self.seen or on, self.version)
        return {"payment": paid, "cut_close": closed, "invoice_line": extra, "reject": rejects}

    def _paid(self, rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The answer of a payment: paid invoices, all their lines, rejects."""
        paid, extra = rows["payment"], rows["invoice_line"]
        base = self.tables["invoice_line"].join(paid.select("invoice_id"), "invoice_id", "left_semi")
        # The batch's own lines are in the table already if the desk was made after it.
        own = extra.select(*base.columns)
        lines = base.exceptAll(own).unionByName(own)
        return {"invoices": paid, "lines": lines, "rejects": rows["reject"]}


def _batch_name(tries: DataFrame, on: dt.date) -> str:
    """Name of a batch from its date and attempts, whatever their order."""
    state = tries.agg(F.count("*"), F.sum(F.xxhash64(*payments.ATTEMPT).cast("decimal(38,0)"))).first()
    return f"{on.isoformat()}-{state[0]}-{state[1]}"


def _date(on: dt.date | None):
    return F.current_date() if on is None else F.lit(on)
