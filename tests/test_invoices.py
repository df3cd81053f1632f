"""P14, P17, P19, P20, W4, A3 on literal rows (cards C2, C3, C13)."""

from decimal import Decimal

from tallyline import labels as L
from tallyline.functions.classify import categorize
from tallyline.operators import invoices
from tallyline.rules import RuleSet, with_partner_rules

RULES = RuleSet(
    branch_by_partner=(("1000000001", "Alpha North", "North"), ("1000000001", "Alpha South", "South")),
    branch_by_comment=(("0300000001", "North", "eq", "North"), ("0300000001", "North", "ne", "South")),
    channel_clients=("1000000002",),
    channel_comments=(("clicks", "C"), ("purchases", "P")),
    channel_default="V",
)


def test_branch_channel_rules(spark):
    rows = [("1000000001", "Alpha North", None), ("1000000001", "Other", "x"), ("0300000001", "Z", "North"),
            ("0300000001", "Z", "elsewhere"), ("0300000001", "Z", None), ("1000000002", "B", "clicks"),
            ("1000000002", "B", None), ("1000000003", "C", "clicks")]
    df = spark.createDataFrame(rows, "pin string, pname string, comment string").coalesce(1)
    out = with_partner_rules(df, RULES, "pin").selectExpr(
        f"{invoices.invoice_branch('pname', 'comment')} AS b",
        f"{invoices.invoice_channel('comment', RULES)} AS c",
    ).collect()
    assert [r.b for r in out] == ["North", "", "North", "South", "", "", "", ""]  # C2: NULL comment -> ''
    assert [r.c for r in out] == ["", "", "", "", "", "C", "V", ""]


def test_status_and_payment_status(spark):
    rows = [(False, True, "10", "0"), (True, True, "10", None), (True, False, "10", "5"), (True, False, "10", "10"),
            (True, False, "10", "12"), (True, False, "10", "-3"), (True, False, None, "4")]
    df = spark.createDataFrame(rows, "is_posted boolean, is_deleted boolean, invoice_amount string, receipt_amount string")
    df = df.selectExpr("is_posted", "is_deleted", "CAST(invoice_amount AS decimal(18,2)) AS invoice_amount",
                       "CAST(receipt_amount AS decimal(18,2)) AS receipt_amount")
    out = df.selectExpr(f"{invoices.invoice_status()} AS s", f"{invoices.payment_status()} AS p").collect()
    assert [r.s for r in out] == [L.STATUS_UNPOSTED, L.STATUS_DELETED] + [L.STATUS_VALID] * 5  # unposted first
    assert [r.p for r in out] == [L.PAY_UNPAID, L.PAY_UNPAID, L.PAY_PART, L.PAY_FULL, L.PAY_OVER, L.PAY_ERROR,
                                  L.PAY_ERROR]  # C3


def test_top_line_and_receipts(spark):
    lines = spark.createDataFrame(
        [(1, 1, "a", Decimal("5")), (1, 2, "b", Decimal("9")), (1, 3, "c", Decimal("9")), (2, 1, "x", None),
         (2, 2, "y", Decimal("1")), (3, 1, "only-null", None)],
        "invoice_id long, line_no int, nomenclature_text string, amount decimal(18,2)",
    ).selectExpr("*", "'cat' AS nomenclature_text_gr")
    top = {r.invoice_id: r.nomenclature_text for r in invoices.top_line(lines).collect()}
    assert top == {1: "b", 2: "y", 3: "only-null"}  # largest, then lowest line no; NULL amounts last
    receipts = spark.createDataFrame([(10, True, False), (11, False, False), (12, True, True)],
                                     "receipt_id long, is_posted boolean, is_deleted boolean").selectExpr(
        "*", "TIMESTAMP_NTZ'2024-01-05 00:00:00' AS receipt_dt")
    rlines = spark.createDataFrame([(10, 1, Decimal("3")), (10, 1, Decimal("4")), (11, 1, Decimal("100")),
                                    (12, 2, Decimal("100"))], "receipt_id long, invoice_id long, receipt_amount decimal(18,2)")
    got = {r.invoice_id: r.receipt_amount for r in invoices.receipts_by_invoice(receipts, rlines).collect()}
    assert got == {1: Decimal("7.00")}  # unposted and deleted receipts do not count (R3)


def test_reference_classifier_order(spark):
    texts = ["Оплата стоимости лидов за январь", "SMM и лиды", "Автообзвон", "Автообзвон клиентов",
             "Ведение страницы", "Настройка трафика", "Тестовый период", "лендинг", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.selectExpr(categorize("t", L.LINE_CATEGORIES)).collect()]
    assert got == ["Лиды", "SMM", "Автообзвон", L.CATEGORY_DEFAULT, "Сайт", "Трафик", "Тест", "Лендинг",
                   L.CATEGORY_DEFAULT, L.CATEGORY_DEFAULT]  # first match wins; equality branch; C13 NULL
