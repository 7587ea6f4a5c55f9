"""Text helpers: null spellings, quotes, placeholders and file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The spellings of a missing value in landed text.
NULL_TOKENS = ("NULL", "null", "nan", "")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def token_to_null(col: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    c = _col(col)
    return F.when(~c.isin(*tokens), c)


def null_tokens(df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn every spelling of null into null, in the given string columns."""
    names = cols if cols is not None else [f.name for f in df.schema if f.dataType.typeName() == "string"]
    return df.withColumns({name: token_to_null(name, tokens) for name in names})


def unquote(col: Column | str) -> Column:
    """Strip double quotes from both ends."""
    return F.btrim(_col(col), F.lit('"'))


def fill_placeholders(template: Column | str, values: dict[str, Column | str]) -> Column:
    """Replace ``<name>`` by the value column, every occurrence."""
    out = _col(template)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), _col(value))
    return out


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def extension(path: Column | str) -> Column:
    return F.regexp_extract(base_name(path), r"\.([^.]*)$", 1)


def ordinal_of(path: Column | str) -> Column:
    """The whole number between the last ``_`` and the extension, else null."""
    return F.regexp_extract(base_name(path), r"_(\d+)\.[^.]*$", 1).try_cast("bigint")


def date_of(path: Column | str) -> Column:
    """The ``yyyy-MM-dd`` between underscores in a file name, else null."""
    return F.regexp_extract(base_name(path), r"_(\d{4}-\d{2}-\d{2})_", 1).try_cast("date")
