"""Tables that grow by the files that have arrived since the last run, and reports that grow with them."""

from funnelwright.streaming.increments import increment_leads, increment_reports, invalid_values_of_increments
from funnelwright.streaming.model import increment_model, increments_reports, increments_tally

__all__ = [
    "increment_leads",
    "increment_model",
    "increment_reports",
    "increments_reports",
    "increments_tally",
    "invalid_values_of_increments",
]
