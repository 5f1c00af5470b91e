"""Finding columns by name or content, and parsing switches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Name patterns of id, alias and name columns, and what an identifier looks like.
ID_NAMES, ALIAS_NAMES, PREFERRED_NAMES = "STRING_id|string.*id|protein.*id|external.*id", "alias|synonym", "preferred_name|^gene$|symbol"
ID_VALUES = "^9606\\.|ENSP"
TRUE, FALSE = {"1", "true", "t", "yes", "y"}, {"0", "false", "f", "no", "n"}
MODES = {"offline": {"offline", "local", "local_only", "reproducible"}, "online_validation": {"online", "online_validation", "validation", "validate", "online_validate", "online_validation_mode"}}


def by_name(columns: list[str], pattern: str) -> str | None:
    return next((c for c in columns if re.search(pattern, c, re.IGNORECASE)), None)


def first_of(columns: list[str], candidates: list[str]) -> str | None:
    """The first candidate that is there, ignoring case and punctuation."""
    plain = lambda x: re.sub(r"[^a-z0-9]", "", x.lower())
    have = {}
    for c in columns:
        have.setdefault(plain(c), c)
    return next((have[plain(c)] for c in candidates if plain(c) in have), None)


def id_column(df: DataFrame, sniff: int = 200) -> str:
    """By name, else the first text column with an identifier among its first non-null values."""
    if found := by_name(df.columns, ID_NAMES):
        return found
    for c, t in df.dtypes:
        if t == "string" and not df.where(F.col(f"`{c}`").isNotNull()).select(F.col(f"`{c}`").alias("v")).limit(sniff).where(F.col("v").rlike(ID_VALUES)).isEmpty():
            return c
    raise ValueError("no identifier column")


def alias_column(df: DataFrame, id_col: str) -> str:
    rest = [c for c in df.columns if c != id_col]
    found = by_name(rest, ALIAS_NAMES) or next((c for c, t in df.dtypes if c in rest and t == "string"), None)
    if found is None:
        raise ValueError("no alias column")
    return found


def name_column(df: DataFrame) -> str:
    if (found := by_name(df.columns, PREFERRED_NAMES)) is None:
        raise ValueError("no name column")
    return found


def require(df: DataFrame, columns: list[str], what: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{what} lacks {', '.join(missing)}")


def parse_bool(x: str) -> bool:
    return x.strip().lower() in TRUE


def is_bool(x: str) -> bool:
    return x.strip().lower() in TRUE | FALSE


def enrichment_mode(x: str | None) -> str:
    text = (x or "").strip().lower().replace("-", "_") or "offline"
    for mode, names in MODES.items():
        if text in names:
            return mode
    raise ValueError(f"not an enrichment mode: {x!r}")
