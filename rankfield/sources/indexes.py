"""Search indexes of managed tables: building, refreshing and opening them.

Each index is a folder and a record that names the version of the table it was built on. Only
indexes of the current version are used.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from rankfield.operators.embed import Embedder
from rankfield.operators.merge import check_keys
from rankfield.sources import records
from rankfield.sources.cells import CellIndex
from rankfield.sources.database import ManagedTable
from rankfield.sources.postings import PostingsIndex
from rankfield.sources.rankings import Rankings, TextIndex, VectorIndex


#: Parts of an index beyond which it is built again.
MOST_PARTS = 32


@dataclass(frozen=True)
class StoredIndex:
    """An index of one version of a table, with what is needed to build it again."""

    version: int
    what: TextIndex | VectorIndex
    buckets: int = 64
    cells: int | None = None
    carry: tuple[str, ...] = ()


def stored_indexes(table: ManagedTable) -> list[StoredIndex]:
    """Return the newest record of each index, whatever version of the table it is of."""
    folder = f"{table.folder}/indexes"
    newest: dict[tuple, StoredIndex] = {}
    for name in records.names(table._spark, folder):
        found = records.read(table._spark, f"{folder}/{name}")
        kind = VectorIndex if "metric" in found["what"] else TextIndex
        found |= {"what": kind(**found["what"]), "carry": tuple(found["carry"])}
        index = StoredIndex(**found)
        key = (kind, index.what.column)
        if key not in newest or newest[key].version < index.version:
            newest[key] = index
    return list(newest.values())


def table_rankings(table: ManagedTable) -> Rankings:
    """Return the rankings of the table's current version."""
    version = table.record.version
    current = [i.what for i in stored_indexes(table) if i.version == version]
    return Rankings(
        tuple(i for i in current if isinstance(i, TextIndex)),
        tuple(i for i in current if isinstance(i, VectorIndex)),
    )


def single_key(table: ManagedTable) -> str:
    key = table.record.key
    if len(key) != 1:
        raise ValueError(f"an index needs a table with one key column, this one has {list(key)}")
    return key[0]


def _store(table: ManagedTable, index: StoredIndex) -> None:
    name = f"{table.folder}/indexes/{index.what.column}-{uuid.uuid4().hex}.json"
    records.create(table._spark, name, asdict(index))


def _refuse_beside_made(table: ManagedTable) -> None:
    if table_rankings(table).made_columns:
        raise ValueError("the table has an index that makes its own vectors, which stands alone")


def create_text_index(table: ManagedTable, column: str, *, buckets: int = 64) -> TextIndex:
    """Build a BM25 index on one text column of the table's current version."""
    _refuse_beside_made(table)
    path = f"{table.folder}/index-data/words-{uuid.uuid4().hex}"
    version = table.record.version
    PostingsIndex.build(table.read(), key=single_key(table), text=column, path=path, buckets=buckets)
    index = TextIndex(column, path)
    _store(table, StoredIndex(version, index, buckets=buckets))
    return index


def create_vector_index(
    table: ManagedTable,
    column: str,
    *,
    metric: str = "cosine",
    cells: int | None = None,
    embedder: Embedder | None = None,
    carry: Sequence[str] = (),
) -> VectorIndex | None:
    """Build a vector index, or return ``None`` when a matching one is there.

    With ``embedder`` the column is text and the index makes its vectors itself; such an
    index has to be the table's only one. An index on this column with another metric is an
    error. Without ``cells`` their number follows the number of rows.
    """
    wanted = VectorIndex(column, metric)
    rankings = table_rankings(table)
    for found in rankings.vectors:
        if column in (found.column, found.text):
            if found.metric != wanted.metric:
                raise ValueError(f"{column!r} already has a vector index with metric {found.metric!r}")
            return None
    if embedder is not None and (rankings.texts or rankings.vectors):
        raise ValueError("an index that makes its own vectors has to be the table's only one")
    _refuse_beside_made(table)
    version = table.record.version
    path = f"{table.folder}/index-data/vectors-{uuid.uuid4().hex}"
    rows, vector = table.read(), column
    if embedder is not None:
        vector = f"{column}_embedding"
        rows = rows.withColumn(vector, embedder.column(column))
    options = {"metric": wanted.metric, "cells": cells, "carry": carry}
    CellIndex.build(rows, key=single_key(table), vector=vector, path=path, **options)
    index = VectorIndex(vector, wanted.metric, None if embedder is None else column, path)
    _store(table, StoredIndex(version, index, cells=cells, carry=tuple(carry)))
    return index


def refresh_indexes(table: ManagedTable, embedder: Embedder | None = None) -> None:
    """Bring the indexes of an older version up to the table's current one.

    Only the rows that loads have added, changed or deleted since are indexed or voided, as a
    further part of each index. If most of the indexed rows are gone, or beyond ``MOST_PARTS``
    parts, an index is built again. Keys that an append has repeated are an error: a ranking could not tell which
    of their rows it has found.
    """
    record = table.record
    for index in stored_indexes(table):
        if index.version == record.version:
            continue
        what = index.what
        kind = PostingsIndex if isinstance(what, TextIndex) else CellIndex
        old = kind.open(table._spark, what.path)
        changes = table.changed_since(index.version) if len(old.parts) < MOST_PARTS else None
        if changes is not None and changes[1] is not None and 2 * changes[1].count() > old.rows:
            changes = None
        made = isinstance(what, VectorIndex) and what.text is not None
        if made and embedder is None:
            raise ValueError(f"the vectors of {what.text!r} were made by an embedder, which is needed again")
        rows, gone = (table.read(), None) if changes is None else changes
        if changes is not None:
            key = single_key(table)
            check_keys(table.lookup(rows.select(key).distinct()).select(key), [key])
        if made:
            rows = rows.withColumn(what.column, embedder.column(what.text))
        path = f"{table.folder}/index-data/{'words' if kind is PostingsIndex else 'vectors'}-{uuid.uuid4().hex}"
        if changes is not None:
            path = old.change(rows, gone)
        elif kind is PostingsIndex:
            kind.build(rows, key=single_key(table), text=what.column, path=path, buckets=index.buckets)
        else:
            options = {"metric": what.metric, "cells": index.cells, "carry": index.carry}
            kind.build(rows, key=single_key(table), vector=what.column, path=path, **options)
        fresh = replace(what, path=path)
        _store(table, StoredIndex(record.version, fresh, index.buckets, index.cells, index.carry))


def open_text_index(table: ManagedTable, column: str) -> PostingsIndex:
    """Open the current text index on a column."""
    found = table_rankings(table).words_of(column)
    if found is None:
        raise LookupError(f"No BM25 index found on column {column!r} for {table.full_name}")
    return PostingsIndex.open(table._spark, found.path)


def open_vector_index(table: ManagedTable, column: str) -> CellIndex:
    """Open the current index on the vectors of a column, or made from it."""
    for found in table_rankings(table).vectors:
        if column in (found.column, found.text):
            return CellIndex.open(table._spark, found.path)
    raise LookupError(f"No vector index found on column {column!r} for {table.full_name}")
