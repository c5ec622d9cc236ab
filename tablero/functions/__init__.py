"""Column -> Column helpers."""

from tablero.functions.logic import (SPANISH_MONTHS, first_match, flag_int, has_bit, is_false,
                                     is_true, label_map, month_label, not_in, yes_no)
from tablero.functions.text import (full_name, initcap_words, join_parts, prefixed,
                                    split_part)
from tablero.functions.time import (as_of_date, as_of_lit, day_boundaries, month_boundaries,
                                    month_start, parse_month, to_local, year_boundaries)

__all__ = [
    "SPANISH_MONTHS", "as_of_date", "as_of_lit", "day_boundaries", "first_match", "flag_int",
    "full_name", "has_bit", "initcap_words", "is_false", "is_true", "join_parts", "label_map",
    "month_boundaries", "month_label", "month_start", "not_in", "parse_month", "prefixed",
    "split_part", "to_local", "year_boundaries", "yes_no",
]
