"""DataFrame -> DataFrame operators. None runs a job while building its
plan, except ``global_rank`` (it checkpoints its ranges, and its input with
``stage_input=True``) and marts ranked by it."""

from marquee.operators.clean import (
    clean_titles, normalize_tags, normalize_tags_with_table, clean_wide, split_wide, transform,
    TITLE_COLUMNS,
)
from marquee.operators.staging import staged_titles, staged_tags
from marquee.operators.marts import (
    genre_mart, genre_mart_one_pass, country_mart, top_titles_mart, top_titles_compact, title_tag_counts,
    ordered_tag_string, title_sums, tag_multiplicity,
)
from marquee.operators.ranking import rank_window, global_rank
from marquee.operators.skew import lookup_join

__all__ = [
    "clean_titles", "normalize_tags", "normalize_tags_with_table", "clean_wide", "split_wide",
    "transform", "TITLE_COLUMNS", "staged_titles", "staged_tags",
    "genre_mart", "genre_mart_one_pass", "country_mart", "top_titles_mart", "top_titles_compact",
    "title_tag_counts", "ordered_tag_string",
    "title_sums", "tag_multiplicity", "rank_window", "global_rank", "lookup_join",
]
