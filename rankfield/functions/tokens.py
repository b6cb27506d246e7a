"""Word splitting shared by text search and by the built-in embedder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a token is a run of letters and digits of the lowercased text.
TOKEN_PATTERN = r"([\p{L}\p{N}]+)"


def tokens(column: str | Column) -> Column:
    """Return the tokens of a text column in order; NULL text has none."""
    column = F.col(column) if isinstance(column, str) else column
    text = F.coalesce(column, F.lit(""))
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(1))


def check_text(value: str) -> str:
    """Return query text unchanged; everything in it is data, a null byte is refused."""
    if "\x00" in value:
        raise ValueError("search text may not contain null bytes")
    return value


#: Words that a task flattens at a time, whatever a batch's rows hold.
FLAT_WORDS = 500_000


def word_slices(lists: pa.Array, most: int = FLAT_WORDS) -> Iterator[tuple[int, int]]:
    """Cut lists of words into runs of rows (start, length) with at most ``most`` words each.

    A row with more is a run by itself.
    """
    ends = np.cumsum(np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    start, before = 0, 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop - start
        start, before = stop, ends[stop - 1]
