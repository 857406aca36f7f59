"""All registered queries and their checks."""

from __future__ import annotations

from . import boosting_checks, landing_checks, model_checks, record_checks, report_checks, similar_checks, stream_checks, text_checks  # noqa: F401  (they register)
from .bridge import ORACLES, REGISTRY


def queries():
    return dict(REGISTRY)


def oracle_sql():
    return dict(ORACLES)
