"""Column expressions (no actions, no Python UDFs)."""

from marquee.functions.text import (
    strip, nullify_tokens, quoted, token_null, PANDAS_NULL_TOKENS, STRIP_PATTERN, WS_CLASS,
)
from marquee.functions.numeric import (
    tolerant_double, NUMBER_PATTERN, round_half_up_int, round_float, exact_avg_int, exact_avg_cents,
    percent_return, to_decimal,
)
from marquee.functions.tiers import bucket_label, BUDGET_CUTS, BUDGET_LABELS, ROI_CUTS, ROI_LABELS
from marquee.functions.tags import (
    clean_tag_list, dictionary_lookup, GENRE_CORRECTIONS, ordered_repeat_join, split_stripped,
)

__all__ = [
    "strip", "nullify_tokens", "quoted", "token_null", "PANDAS_NULL_TOKENS", "STRIP_PATTERN", "WS_CLASS",
    "tolerant_double", "NUMBER_PATTERN", "round_half_up_int", "round_float", "exact_avg_int",
    "exact_avg_cents", "percent_return", "to_decimal",
    "bucket_label", "BUDGET_CUTS", "BUDGET_LABELS", "ROI_CUTS", "ROI_LABELS",
    "clean_tag_list", "dictionary_lookup", "GENRE_CORRECTIONS", "ordered_repeat_join", "split_stripped",
]
