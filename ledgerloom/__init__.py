"""Marketplace finance documents, accruals and reconciliation as Spark DataFrame jobs."""

from ledgerloom.session import build_session, tune

__all__ = ["build_session", "tune"]
