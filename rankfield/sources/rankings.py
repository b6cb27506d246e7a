"""The rankings a table can give: by the words of a column, or by the meaning of one."""

from __future__ import annotations

from dataclasses import dataclass

from rankfield.functions.distances import check_metric


@dataclass(frozen=True)
class TextIndex:
    """Ranks rows by the words of ``column``. Without a ``path`` the column is scanned."""

    column: str
    path: str | None = None
    use = "text relevance"


@dataclass(frozen=True)
class VectorIndex:
    """Ranks rows by the vectors in ``column``.

    ``text`` names the text column that the index made the vectors from; without it they came
    with the table, from a model that a query has to be embedded with too.
    """

    column: str
    metric: str = "cosine"
    text: str | None = None
    path: str | None = None
    use = "meaning"

    def __post_init__(self) -> None:
        object.__setattr__(self, "metric", check_metric(self.metric.lower()))

    @property
    def asked_by(self) -> str:
        """The column that a search by meaning names."""
        return self.text or self.column


@dataclass(frozen=True)
class Rankings:
    """All rankings of one table that can be used now."""

    texts: tuple[TextIndex, ...] = ()
    vectors: tuple[VectorIndex, ...] = ()

    def words_of(self, column: str) -> TextIndex | None:
        return next((i for i in self.texts if i.column == column), None)

    def meaning_of(self, column: str) -> VectorIndex | None:
        return next((i for i in self.vectors if i.asked_by == column), None)

    @property
    def partners(self) -> tuple[VectorIndex, ...]:
        """Vectors that came with the table, which a ranking by words can be fused with."""
        return tuple(i for i in self.vectors if i.text is None)

    @property
    def made_columns(self) -> set[str]:
        """Vector columns that an index made; they are no columns of the table."""
        return {i.column for i in self.vectors if i.text is not None}

    def uses(self, column: str) -> list[str]:
        """What a column can be searched by."""
        found = [self.words_of(column), self.meaning_of(column)]
        return [i.use for i in found if i is not None]
