"""Bounded results: how many rows to hand back, and what to say when there were more."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from rankfield.operators.topk import check_k
from rankfield.session import written

CLIENT_WARNING = "client_warning"


@dataclass(frozen=True)
class CappedResult:
    """At most ``max_rows`` rows, with the count of all rows beside them."""

    rows: DataFrame
    metadata: dict[str, Any] = field(default_factory=dict)

    @property
    def row_count(self) -> int:
        return self.metadata["row_count"]


def truncation_warning(returned: int, matched: int) -> str | None:
    """Return a note when rows were cut, else ``None``."""
    if returned >= matched:
        return None
    return (
        f"{returned} of {matched} matching rows are included. row_count counts all of them; "
        "page, filter or aggregate to see the others."
    )


def clamp_k(k: int | None, default: int, max_rows: int) -> tuple[int, str | None]:
    """Return the ``k`` to rank with and a note if a larger one was asked for.

    For a ``k`` that a program was given by a model or a form; a caller's own is ranked as is.

    The cut comes before ranking. A ``k`` below one counts as one; the default is used
    as it is.
    """
    if k is None:
        return default, None
    k = max(1, k)
    if k <= max_rows:
        return k, None
    return max_rows, (
        f"k={k} is above the limit of {max_rows} rows, so only the best {max_rows} were ranked."
    )


def capped_result(
    df: DataFrame,
    *,
    max_rows: int,
    order: Sequence[Column] = (),
    warnings: Sequence[str | None] = (),
    warning: str | None = None,
) -> CappedResult:
    """Cut ``df`` to ``max_rows`` rows and report the total.

    The rows are written once and then counted and cut, so a search runs once.

    The caller's ``warnings`` come first in ``client_warning``, the note about the cut
    last; the key is absent when there is nothing to say. ``warning`` is passed through
    under its own name.
    """
    check_k(max_rows, "max_rows")
    df = written(df, "result")
    total = df.count()
    ordered = df.orderBy(*order) if order else df
    metadata: dict[str, Any] = {"row_count": total}
    if warning is not None:
        metadata["warning"] = warning
    notes = [n for n in [*warnings, truncation_warning(min(total, max_rows), total)] if n]
    if notes:
        metadata[CLIENT_WARNING] = " ".join(notes)
    return CappedResult(ordered.limit(max_rows), metadata)

