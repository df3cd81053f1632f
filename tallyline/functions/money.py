"""Money: exact decimals end to end."""

from __future__ import annotations

MONEY = "decimal(18,2)"


def money(c: str) -> str:
    return f"CAST({c} AS {MONEY})"


def vat_included(amount: str, rate_pct: int = 5) -> str:
    """VAT contained in a gross amount, truncated to cents.

    Truncation is done on the exact decimal, so 1.47 gives 0.07, not the
    0.06 a binary float would give.
    """
    cents = f"CAST(CAST({amount} AS decimal(20,2)) * {100 * rate_pct} / {100 + rate_pct} AS BIGINT)"
    return f"CAST(CAST({cents} AS decimal(20,0)) / 100 AS {MONEY})"
