"""String cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The strings that pandas.read_csv turns into NaN when
# na_values is not given (public pandas default, pandas 2.x). Stated in the
# order pandas documents them.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Characters Python's str.strip() removes: Unicode White_Space plus the four
# information separators U+001C..U+001F. Written as explicit code points so
# the same pattern runs in Java regex and in RE2.
_WS = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
STRIP_PATTERN = rf"^[{_WS}]+|[{_WS}]+$"
WS_CLASS = f"[{_WS}]"
WS_CHARS = "".join(map(chr, (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column | str) -> Column:
    """Unicode-aware trim equal to Python ``str.strip()`` (a character-set
    trim: no regular expression runs). Spark's set trim goes through the whole
    text, so one without such a character at an end is left alone."""
    c = F.col(c) if isinstance(c, str) else c
    ends = F.substring(c, 1, 1).isin(*WS_CHARS) | F.substring(c, -1, 1).isin(*WS_CHARS)
    return F.when(ends, F.btrim(c, F.lit(WS_CHARS))).otherwise(c)


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def token_null(name: str, tokens: Iterable[str] = PANDAS_NULL_TOKENS) -> Column:
    """``CASE WHEN name IN (tokens) THEN NULL ELSE name END`` for one column
    (a single SQL expression; Catalyst makes the list a hash-set lookup)."""
    in_list = ", ".join(_sql_str(t) for t in tokens)
    c = quoted(name)
    return F.expr(f"CASE WHEN {c} IN ({in_list}) THEN NULL ELSE {c} END")


def nullify_tokens(df: DataFrame, tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
                   columns: Iterable[str] | None = None) -> DataFrame:
    """Turn exact (untrimmed) null tokens into SQL NULL in string columns.

    One projection; string columns not listed and non-string columns pass
    through unchanged. The test is ``col IN (...)``, which Catalyst turns
    into a hash-set lookup for long token lists.
    """
    if not tokens:
        return df
    str_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    targets = set(columns) & str_cols if columns is not None else str_cols
    return df.select([
        token_null(name, tokens).alias(name)
        if name in targets else F.col(quoted(name))
        for name in df.columns
    ])
