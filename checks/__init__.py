"""Registered queries, their SQL counterparts, and the views both sides share."""

from __future__ import annotations

import importlib

MODULES = ("q_clean", "q_history", "q_portfolio", "q_cohort", "q_lead", "q_funnel", "q_marts", "q_lead_mart")


def load_all() -> None:
    """Import every query module; importing registers."""
    for m in MODULES:
        importlib.import_module(f"checks.{m}")
