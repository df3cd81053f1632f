"""tallyline: a Spark-native receivables / billing-balance engine.

Leads, invoices, receipts, contracts and a payment-terms sheet in; per
account period balances, new-invoice decisions, report extracts and outbox
tables out. Pure DataFrame code: no Python UDFs, no driver-side row loops.
"""

__version__ = "0.1.0"
