"""DataFrame -> DataFrame operators. All are lazy and trigger no action, but
``rollup_ancestors(depth=None)``, whose rounds are as many as the data need."""

from tablero.operators.aggregate import count_when, list_join, sibling_sums, sum_by
from tablero.operators.combine import (hot_keys, lookup, members, population, role_pivot, rollup_ancestors,
                                       slot_join, slot_product, spread_join)
from tablero.operators.history import (boundary_gap_months, entered, moved, reactivations,
                                       transitions, with_last_match, with_previous)
from tablero.operators.quality import clean_listings, duplicate_keys
from tablero.operators.ranking import (any_one_per_key, first_and_last, first_per_key,
                                       latest_per_key, number_rows, transition_summary)

__all__ = [
    "any_one_per_key", "boundary_gap_months", "clean_listings", "count_when", "duplicate_keys",
    "entered", "first_and_last", "first_per_key", "hot_keys", "latest_per_key", "list_join", "lookup",
    "members", "moved", "number_rows", "population", "reactivations", "role_pivot",
    "rollup_ancestors", "sibling_sums", "slot_join", "slot_product", "spread_join", "sum_by", "transition_summary", "transitions", "with_last_match", "with_previous",
]
