"""All registered queries and their SQL twins."""

from __future__ import annotations

from . import (
    dense_plans,
    grounding_plans,
    lexical_plans,
    prepare_plans,
    streaming_plans,
    text_plans,
)
from .tables import Query

AREAS = (
    prepare_plans,
    text_plans,
    lexical_plans,
    dense_plans,
    grounding_plans,
    streaming_plans,
)


def all_queries() -> dict[str, Query]:
    return {name: query for area in AREAS for name, query in area.R.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: text for area in AREAS for name, text in area.R.sql.items()}
