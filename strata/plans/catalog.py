"""All registered test queries; importing this module fills the registry."""

from . import q_cdc, q_checks, q_dates, q_dims, q_history, q_ingest, q_report, q_silver, q_star, q_stream, q_touched, q_versions  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
