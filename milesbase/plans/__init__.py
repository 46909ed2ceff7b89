"""Registered queries. Importing this package registers every plan module."""

from milesbase.plans import (  # noqa: F401
    flatten_plans, matching_plans, monitoring_plans, queue_plans, record_plans, report_plans, serving_plans, sink_plans,
    streaming_plans, transfer_plans,
)
from milesbase.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
