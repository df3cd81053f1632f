"""Ordered first-match classifier (P18) built from a rule list."""

from __future__ import annotations

from .. import labels as L
from .sqlexpr import any_of, case, lit


def categorize(text: str, rules, default: str = L.CATEGORY_DEFAULT) -> str:
    """``rules``: iterable of (kind, patterns, label); kind is contains|equals.

    NULL text matches nothing and gets the default label (the original raised).
    """
    branches = []
    for kind, patterns, label in rules:
        if kind == "equals":
            cond = any_of(f"{text} = {lit(p)}" for p in patterns)
        elif kind == "contains":
            cond = any_of(f"contains({text}, {lit(p)})" for p in patterns)
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
        branches.append((cond, lit(label)))
    return case(branches, lit(default))
