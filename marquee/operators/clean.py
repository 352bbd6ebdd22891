"""Cleaning: tolerant casts, trimming, return on investment, tag explode."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.numeric import percent_return, round_half_up_int, to_decimal, tolerant_double
from marquee.functions.tags import GENRE_CORRECTIONS, clean_tag_list, split_stripped
from marquee.functions.text import PANDAS_NULL_TOKENS, nullify_tokens, quoted, strip, token_null

TEXT_COLUMNS = ("title", "director", "language", "country")
# Column -> stored type after the load's assignment cast.
NUMERIC_COLUMNS = {"release_year": "int", "duration": "int", "budget": "bigint", "box_office": "bigint"}
TITLE_COLUMNS = ("title", "release_year", "director", "language", "country",
                 "duration", "budget", "box_office", "roi")


def clean_titles(raw: DataFrame, null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
                 sentinels: Mapping[str, str] | None = None, tag_column: str = "genre",
                 keep: Sequence[str] = (), audit: bool = False) -> DataFrame:
    """Raw text rows -> typed title rows (the parent table).

    Null tokens -> NULL; ``sentinels`` (column -> exact word, default
    box_office 'unknown') -> NULL; gated numeric casts; Unicode strip of the
    text columns; ROI in double from the unrounded amounts, rounded to two
    places as numpy does (``round_float``); then the store's assignment casts (round half away from zero to
    int/bigint, ROI to decimal(10,2), out-of-range -> NULL). The tag column
    is dropped. One narrow projection: no shuffle. ``audit=True`` adds
    ``roi_unbounded`` (the double ROI before the range-checked cast) for the
    reject audit.
    """
    sentinels = {"box_office": "unknown"} if sentinels is None else sentinels
    df = nullify_tokens(raw, null_tokens)
    num = {}
    for name in NUMERIC_COLUMNS:
        c = F.col(name)
        if name in sentinels:
            c = F.nullif(c, F.lit(sentinels[name]))
        num[name] = tolerant_double(c)
    roi = percent_return(num["box_office"], num["budget"])
    cols = [F.col(k) for k in keep]
    for name in TITLE_COLUMNS:
        if name in TEXT_COLUMNS:
            cols.append(strip(name).alias(name))
        elif name == "roi":
            cols.append(to_decimal(roi, 10, 2).alias("roi"))
        else:
            cols.append(round_half_up_int(num[name], NUMERIC_COLUMNS[name]).alias(name))
    extra = [c for c in df.columns if c not in TITLE_COLUMNS and c != tag_column and c not in keep]
    if audit:
        cols.append(roi.alias("roi_unbounded"))
    return df.select(*cols, *[F.col(quoted(c)) for c in extra])


def normalize_tags(raw: DataFrame, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
                   null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
                   tag_column: str = "genre", out: str = "genre", sep: str = ",",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Raw rows -> one row per (title, tag) (the child table).

    The tag list is split, each piece stripped and corrected by exact-case
    lookup, repeats removed keeping first positions, then exploded (a NULL
    list gives no rows). Narrow: no shuffle; output rows are bounded by the
    tags of each row."""
    df = nullify_tokens(raw.select(*keep, "title", tag_column), null_tokens)
    return df.select(*[F.col(k) for k in keep], strip("title").alias("title"),
                     F.explode(clean_tag_list(tag_column, mapping, sep)).alias(out))


def normalize_tags_with_table(raw: DataFrame, dictionary: DataFrame, key: Sequence[str],
                              null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
                              tag_column: str = "genre", out: str = "genre", sep: str = ",",
                              src: str = "src", dst: str = "dst") -> DataFrame:
    """``normalize_tags`` for a dictionary too large for a map literal.

    The dictionary is a DataFrame (src, dst). Pieces are exploded first and
    corrected by an equi-join; Spark broadcasts the dictionary only when its
    measured size is under the broadcast threshold, else it shuffle-joins
    (a hot tag is split by AQE skew-join). Repeats within one source row
    are then removed by a distinct on (key, title, tag), a partial aggregate
    bounded by the tags of one row; ``key`` must identify a source row. The
    output rows equal ``normalize_tags``' (a stored table has no order)."""
    df = nullify_tokens(raw.select(*key, "title", tag_column), null_tokens)
    pieces = df.select(*key, strip("title").alias("title"),
                       F.explode(split_stripped(F.col(tag_column), sep)).alias("_piece"))
    d = dictionary.select(F.col(src).alias("_src"), F.col(dst).alias("_dst"))
    fixed = pieces.join(d, pieces["_piece"] == d["_src"], "left").select(
        *key, "title", F.coalesce("_dst", "_piece").alias(out))
    return fixed.distinct()


def clean_wide(raw: DataFrame, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
               null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
               tag_column: str = "genre", list_column: str = "genre_list", sep: str = ",",
               keep: Sequence[str] = (), audit: bool = False) -> DataFrame:
    """Title rows plus the cleaned tag list in one narrow projection: the
    common parent of ``clean_titles`` and ``normalize_tags``, to be written
    once and split with ``split_wide``."""
    tags = token_null(tag_column, null_tokens) if null_tokens else F.col(tag_column)
    with_list = raw.withColumn(list_column, clean_tag_list(tags, mapping, sep))
    return clean_titles(with_list, null_tokens, tag_column=tag_column, keep=keep, audit=audit)


def split_wide(wide: DataFrame, list_column: str = "genre_list", out: str = "genre",
               keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(titles, tags) from a ``clean_wide`` frame."""
    titles = wide.drop(list_column)
    tags = wide.select(*[F.col(k) for k in keep], "title", F.explode(list_column).alias(out))
    return titles, tags


def transform(raw: DataFrame, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
              keep: Sequence[str] = (), **kw) -> tuple[DataFrame, DataFrame]:
    """Both outputs of the cleaning step from one raw frame. Catalyst prunes
    each branch to its own columns, so a columnar raw source is scanned
    without caching; cache ``raw`` first only for a row-format source."""
    return clean_titles(raw, keep=keep, **kw), normalize_tags(raw, mapping, keep=keep)
