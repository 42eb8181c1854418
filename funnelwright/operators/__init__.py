"""DataFrame operators. None of them runs a job."""

from funnelwright.operators.cleaning import (
    clean,
    conform,
    count_invalid,
    invalid_values,
    normalise_text,
    null_sentinels,
    project_to_spec,
)
from funnelwright.operators.history import as_of_join, latest_state, previous_values, status_changes
from funnelwright.operators.joins import full_outer_join, heavy_keys, left_join, unmatched
from funnelwright.operators.metrics import (
    add_up,
    add_up_sketches,
    city_report,
    city_status_report,
    distinct_leads_report,
    global_report,
    level_report,
    month_report,
    sketch_leads,
    status_report,
    tally,
    tally_levels,
    top_and_bottom,
    with_attributes,
    with_estimate,
    with_rates,
)
from funnelwright.operators.model import (
    date_dimension,
    kpi_fact,
    kpi_fact_from_dimensions,
    lead_contacts,
    leads_dimension,
    look_up,
    match_leads,
    places_dimension,
    reconcile,
    report_contacts,
    status_dimension,
)
from funnelwright.operators.multiset import added, copies, kept, removed
from funnelwright.operators.profile import key_audit, key_multiplicity, null_counts, null_percentages
from funnelwright.operators.union import union_all_by_name

__all__ = [
    "add_up",
    "add_up_sketches",
    "added",
    "as_of_join",
    "city_report",
    "city_status_report",
    "clean",
    "conform",
    "copies",
    "count_invalid",
    "date_dimension",
    "distinct_leads_report",
    "full_outer_join",
    "global_report",
    "heavy_keys",
    "invalid_values",
    "kept",
    "key_audit",
    "key_multiplicity",
    "kpi_fact",
    "kpi_fact_from_dimensions",
    "latest_state",
    "lead_contacts",
    "leads_dimension",
    "left_join",
    "level_report",
    "look_up",
    "match_leads",
    "month_report",
    "normalise_text",
    "null_counts",
    "null_percentages",
    "null_sentinels",
    "places_dimension",
    "previous_values",
    "project_to_spec",
    "reconcile",
    "removed",
    "report_contacts",
    "sketch_leads",
    "status_changes",
    "status_dimension",
    "status_report",
    "tally",
    "tally_levels",
    "top_and_bottom",
    "union_all_by_name",
    "unmatched",
    "with_attributes",
    "with_estimate",
    "with_rates",
]
