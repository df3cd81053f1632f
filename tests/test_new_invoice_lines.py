"""The lines of the invoices to create, asked for at any time."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from tallyline import labels as L
from tallyline.plans import registry
from tallyline.plans.pipeline import INPUT_TABLES, Inputs, Pipeline, driver_inputs
from tallyline.sources import driver as D

from .conftest import SF_SMALL

RULES = D.driver_rules()
INN, DAY = "1000000009", dt.datetime(2024, 1, 16, 9)
ISSUER, ABOUT = RULES.issuers[0]
ROWS = {
    "leads": [("p", DAY.date(), DAY, INN, "E", "web", "c", "n", str(k), "", "b", "s", DAY, Decimal(50), Decimal(105), k) for k in (1, 2)],
    "terms_sheet": [(1, "Ann", "E", INN, None, "", "", L.WEEKLY)],
    "invoice": [(7, "INV-7", DAY.replace(year=2023), None, Decimal(40), True, False, 1, 5)],
    "invoice_line": [(7, 1, "text", RULES.billable_category, Decimal(30)), (7, 2, "text", RULES.billable_category, Decimal(10))],
    "receipt": [(8, DAY.replace(year=2023), True, False)],
    "receipt_line": [(8, 7, Decimal(40))],
    "partner": [(5, "Partner A", INN, "customer")],
    "contract": [(6, "K-6", 5, 1, "RUB", ABOUT, False)],
    "organization": [(1, "Org", ISSUER, 2)],
    "individual": [(2, "IND-2", "Head")],
}
WANTED = {
    "audit_log": {"inn": INN, "part_no": 1, "line": (
        '{"datetime":"2024-01-25T10:00:00","inn":"1000000009","status":null,"new_invoice_amount":210.00,"interval_invoice":0.00,'
        '"interval_receipt":0.00,"correction":0.00,"interval_sale":210.00,"response_body":null}')},
    "invoice_line": {"inn": INN, "part_no": 1, "line_text": L.LINE_TEXT_POSTPAY, "line_quantity": 2.0, "line_price": Decimal(105)},
    "invoice_payload": {"inn": INN, "part_no": 1, "partner_id": "5", "contract_id": "6", "new_invoice_amount": Decimal(210), "vat_amount": Decimal(10)},
    "outbox_invoices": {"as_of": D.AS_OF, "channel": L.CHANNEL_NEW_INVOICE, "severity": "invoice", "inn": INN, "part_no": 1},
    "vat_extract": {"inn": INN, "part_no": 1, "new_invoice_amount": Decimal(210), "vat_amount": Decimal(10)},
}


class OneThread(Pipeline):
    """Without cuts all stages are built in one thread: one that is asked for
    while it is being built would wait for itself."""

    building: tuple = ()

    def _memo(self, name, fn):
        assert name not in self.building, f"{name} waits for itself"
        before, self.building = self.building, (*self.building, name)
        try:
            return super()._memo(name, fn)
        finally:
            self.building = before


@pytest.fixture(scope="module")
def given(spark):
    kinds = driver_inputs(spark, SF_SMALL, RULES)
    return Inputs.of({t: spark.createDataFrame(ROWS.get(t, []), kinds[t].schema).coalesce(1) for t in INPUT_TABLES})


@pytest.mark.parametrize("report_first", [False, True])
@pytest.mark.parametrize("name", WANTED)
def test_new_invoices_do_not_wait_for_or_take_past_lines(given, name, report_first):
    p = OneThread(given, RULES, D.AS_OF, cut_lineage=False)
    if report_first:
        assert p.balance_report.columns and p.invoice_lines.columns
    got = [r.asDict() for r in getattr(registry, f"q_{name}")(p).collect()]
    assert [{k: r[k] for k in WANTED[name]} for r in got] == [WANTED[name]]
    assert p.invoice_lines.columns == given["invoice_line"].columns


def test_payload_of_a_query_asked_for_alone(given):
    row = registry.q_invoice_payload(OneThread(given, RULES, D.AS_OF, cut_lineage=False)).first()
    doc = json.loads(row.payload)
    (line,) = doc[L.DOCUMENT_LINES_FIELD]
    assert (doc["Date"], doc["Posted"]) == ("2024-01-25T10:00:00", True)
    assert {L.LINE_TEXT_POSTPAY, 2.0, 105.0, 210.0, 10.0} <= {v for v in line.values()}


def test_notice_of_a_query_asked_for_alone(given):
    body = registry.q_outbox_invoices(OneThread(given, RULES, D.AS_OF, cut_lineage=False)).first().body
    parts = [L.MSG_INVOICE + "210" + L.MSG_RUB_VAT + "10)", L.MSG_LEAD_COUNT + "2\n", L.MSG_LEAD_COST + "210\n", L.MSG_LEAD_PRICE + "105\n"]
    assert "Ann (@example_1)" in body and all(x in body for x in parts)
