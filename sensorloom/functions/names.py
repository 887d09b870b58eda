"""Column names: cleaning, quoting, default aggregates, alias lookup."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sanitize(name: str) -> str:
    """Runs of non-word characters become one underscore, none at the ends."""
    return re.sub(r"\W+", "_", name).strip("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    clean = [sanitize(c) for c in df.columns]
    if len(set(clean)) != len(clean):
        raise ValueError(f"column names collide after cleaning: {clean}")
    return df.toDF(*clean)


def unquote(name: str) -> str:
    return name.strip("`").strip('"')


def quote(name: str) -> str:
    return "`" + unquote(name).replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by its literal name, also with dots, blanks or parentheses."""
    return F.col(quote(name))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns {missing}, available {df.columns}")


# Name fragments that decide a column's default aggregate, in
# order of precedence.
DEFAULT_AGG_FRAGMENTS = (
    (("temperature", "humidity", "pressure", "vapor", "avg"), "mean"),
    (("rainfall", "radiation", "total"), "sum"),
    (("id", "uuid"), "first"),
)


def default_aggregate(name: str) -> str:
    lowered = name.lower()
    for fragments, method in DEFAULT_AGG_FRAGMENTS:
        if any(f in lowered for f in fragments):
            return method
    return "mean"


def resolve_alias(term: str, aliases: Mapping[str, Iterable[str]]) -> str | None:
    """Canonical field for one term: exact name, else the first alias list."""
    if term in aliases:
        return term
    return next((name for name, terms in aliases.items() if term in terms), None)


def resolve_alias_column(terms: Column, aliases: Mapping[str, Iterable[str]]) -> Column:
    """The same lookup for a whole column, as a constant map."""
    table: dict[str, str] = {}
    for name, others in aliases.items():
        for term in others:
            table.setdefault(term, name)
    table.update({name: name for name in aliases})
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.create_map(*entries)[terms]
