"""Checks on call arguments; they run on the driver before any plan is built."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from semstore.errors import RecordError
from semstore.functions.text import WHITE_SPACE

# Defaults and limits of the calls.
DEFAULT_COLLECTION = "default"
DEFAULT_TOP_K = 10
DEFAULT_TOOL_TOP_K = 5
MAX_TOOL_TOP_K = 1_000
MAX_QUERY_LENGTH = 10_000


def utf16_units(text: str) -> int:
    return len(text.encode("utf-16-be", "surrogatepass")) // 2


def top_k(value: int | None) -> int:
    """The number of results of a search; none given, and 0, mean the default."""
    if value is None or value == 0:
        return DEFAULT_TOP_K
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise RecordError("top_k must be a positive integer")
    return value


def tool_top_k(value: int | None) -> int:
    """The stricter form used by the memory calls: 1 to 1,000, 5 when not given."""
    if value is None:
        return DEFAULT_TOOL_TOP_K
    if isinstance(value, bool) or not isinstance(value, int):
        raise RecordError("top_k must be an integer")
    if not 1 <= value <= MAX_TOOL_TOP_K:
        raise RecordError(f"top_k must lie between 1 and {MAX_TOOL_TOP_K}")
    return value


def query_text(value: Any, limit: int | None = None) -> str:
    """A text to search for, trimmed."""
    if not isinstance(value, str) or not value.strip(WHITE_SPACE):
        raise RecordError("the text to search for must not be blank")
    if limit is not None and utf16_units(value) > limit:
        raise RecordError(f"the text to search for is longer than {limit} characters")
    return value.strip(WHITE_SPACE)


def record_id(value: Any, limit: int | None = None) -> str:
    """One id, trimmed; by default of any length."""
    if not isinstance(value, str) or not value.strip(WHITE_SPACE):
        raise RecordError("an id must not be blank")
    if limit is not None and utf16_units(value) > limit:
        raise RecordError(f"an id is longer than {limit} characters")
    return value.strip(WHITE_SPACE)


def record_ids(values: Iterable[Any]) -> list[str]:
    """A list of ids, trimmed, each once."""
    ids = [str(v).strip(WHITE_SPACE) for v in values]
    if not ids:
        raise RecordError("the list of ids must not be empty")
    return list(dict.fromkeys(ids))


def collection_name(value: str | None) -> str:
    if value is None:
        return DEFAULT_COLLECTION
    if not isinstance(value, str) or not value.strip(WHITE_SPACE):
        raise RecordError("a collection needs a name")
    return value


def filter_dict(value: Any) -> Mapping | None:
    if value is not None and not isinstance(value, Mapping):
        raise RecordError("a filter must be a dict")
    return value


def effort(value: Any) -> int:
    """How many cells a search reads."""
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise RecordError("the effort is the number of cells to read, at least 1")
    return value
