"""Column expressions; every one stays inside whole-stage code generation."""

from layerkit.functions.columns import (
    audited,
    bool_text,
    change_hash,
    coded,
    date_key,
    date_text,
    day_of,
    earliest_allowed,
    join_reasons,
    key_year,
    stamped,
)

__all__ = [
    "audited",
    "bool_text",
    "change_hash",
    "coded",
    "date_key",
    "date_text",
    "day_of",
    "earliest_allowed",
    "join_reasons",
    "key_year",
    "stamped",
]
