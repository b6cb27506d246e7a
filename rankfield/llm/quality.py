"""Text quality by pairwise ranking (Bradley-Terry).

A text is a short vector of measures of its form. The chance that one text is preferred to
another is the logistic function of the difference of their scores; the weights minimise the
logistic loss on the feature differences of preference pairs. A quantile of the scores is then
the threshold: the share of labelled texts of the lower kind.

Every labelled text is in the fit. They are dealt into groups by a hash; a task pairs the rows
of its groups and passes on sums, from which the driver takes Newton's steps. The threshold is
found by counting the scores digit by digit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.llm import hashing
from rankfield.llm.common import quoted, runs, text_or_empty
from rankfield.session import written

#: Preference pairs for each row of the larger class in a group.
PAIRS = 4

#: Rows of the larger class in a group, about, and the least where that leaves cores idle.
GROUP_ROWS = 1 << 15
LEAST_ROWS = 1 << 10

#: Groups that a table is dealt into unless they had fewer rows than the least.
LEAST_GROUPS = 64

#: Rows of the smaller class that each group has, about; the class is copied to reach it.
PARTNERS = 64

#: Rows that a task holds of one group; what is beyond is a group of its own.
MOST_ROWS = 4 * GROUP_ROWS

#: Files that the groups are written to, at most.
FILES = 1_000

RIDGE = 1e-3

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BEYOND = np.zeros(256, bool)
_BEYOND[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_COMMA = np.zeros(256, bool)
_COMMA[[ord(c) for c in ",;:"]] = True
_SYMBOL = ~(_WHITE | _LOWER | _UPPER | _DIGIT | _BEYOND | _STOP | _COMMA)

FEATURES = [
    "log_bytes", "lower", "upper", "digit", "beyond_ascii", "white", "stop", "comma", "symbol",
    "word_length", "long_words", "distinct_words", "commonest_word", "symbol_words", "upper_words",
    "digit_words", "log_words_per_line", "repeated_lines", "repeated_triples", "entropy", "empty",
]


def features(text: bytes) -> np.ndarray:
    """Measure a whole text; all measures are finite, and those of an empty text are zero
    except ``empty``."""
    data = np.frombuffer(text, np.uint8)
    begin, end = runs(~_WHITE[data])
    if not len(begin):
        return np.array([0.0] * (len(FEATURES) - 1) + [1.0])
    counts = np.bincount(data, minlength=256)
    n, words = len(data), len(begin)
    share = lambda kind: counts[kind].sum() / n
    size = end - begin
    sums = hashing.prefix_sums(data, hashing.BASES[0])
    hashes = hashing.range_hashes(sums, begin, end, hashing.BASES[0])
    _, times = np.unique(hashes, return_counts=True)
    within = lambda kind: np.add.reduceat(kind[data].astype(np.int32), begin)
    cut = np.flatnonzero(data == 10)
    line_begin, line_end = np.concatenate(([0], cut + 1)), np.concatenate((cut, [n]))
    filled = line_end > line_begin
    lines = hashing.range_hashes(sums, line_begin[filled], line_end[filled], hashing.BASES[0])
    triples = hashes[:-2] + 3 * hashes[1:-1] + 5 * hashes[2:]
    p = counts[counts > 0] / n
    return np.array(
        [
            np.log1p(n), share(_LOWER), share(_UPPER), share(_DIGIT), share(_BEYOND), share(_WHITE),
            share(_STOP), share(_COMMA), share(_SYMBOL), size.mean(), (size > 15).mean(),
            len(times) / words, times.max() / words, (within(_SYMBOL) > 0).mean(),
            (within(_UPPER) * 2 > size).mean(), (within(_DIGIT) > 0).mean(),
            np.log1p(words / max(len(lines), 1)), 1 - len(np.unique(lines)) / max(len(lines), 1),
            1 - len(np.unique(triples)) / max(len(triples), 1), float(-(p * np.log2(p)).sum()), 0.0,
        ]
    )


@dataclass
class Model:
    """Weights on standardised features, and the score that counts as one half."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Row by row, so that a score does not depend on what else is in the batch.
        return ((x - self.mean) / self.scale * self.weights).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.raw(x) - self.threshold, -500, 500)
        return 1 / (1 + np.exp(-z))


#: Applies a function of a group's measures, labels and marks of first copies to every group
#: and returns the results, one row for each, in a fixed order.
Groups = Callable[[Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def pairs(y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield places of better and worse rows to compare; every row is in ``PAIRS`` pairs or more."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if len(good) and len(bad):
        n, draw = max(len(good), len(bad)), np.random.default_rng(7)
        for _ in range(PAIRS):
            yield np.resize(draw.permutation(good), n), np.resize(draw.permutation(bad), n)


def _standard(groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Return mean and deviation of each measure over all rows."""

    def moments(x, y, own):
        x = x[own]
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        return np.concatenate([[len(x)], mean, ((x - mean) ** 2).sum(axis=0)])

    found = groups(moments)
    n, means, squares = found[:, :1], *np.split(found[:, 1:], 2, axis=1)
    mean = (n * means).sum(axis=0) / n.sum()
    scale = np.sqrt((squares + n * (means - mean) ** 2).sum(axis=0) / n.sum())
    scale[scale < 1e-12] = 1.0
    return mean, scale


def fit_pairs(groups: Groups, scale: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Minimise the mean logistic loss on differences, with a ridge, by Newton's method."""
    w = np.zeros(len(scale))
    for _ in range(rounds):

        def slopes(x, y, own, w=w):
            count, gradient, hessian = 0, np.zeros(len(w)), np.zeros((len(w), len(w)))
            for better, worse in pairs(y):
                d = (x[better] - x[worse]) / scale
                p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
                count += len(d)
                gradient += d.T @ p
                hessian += (d * (p * (1 - p))[:, None]).T @ d
            return np.concatenate([[count], gradient, hessian.ravel()])

        total = groups(slopes).sum(axis=0)
        n = max(total[0], 1.0)
        gradient = ridge * w - total[1 : 1 + len(w)] / n
        hessian = total[1 + len(w) :].reshape(len(w), len(w)) / n + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _ordered(values: np.ndarray) -> np.ndarray:
    """Return whole numbers that sort as the values do."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def quantile(groups: Groups, model: Model, below: int) -> float:
    """Return the middle between the ``below``-th least score of all rows and the next one."""
    prefix, left = 0, below - 1
    for shift in range(56, -1, -8):

        def digits(x, y, own, shift=shift, prefix=prefix):
            bits = _ordered(model.raw(x[own])) >> np.uint64(shift)
            bits = bits[bits >> np.uint64(8) == np.uint64(prefix)] & np.uint64(255)
            return np.bincount(bits.astype(np.int64), minlength=256).astype(np.float64)

        counts = groups(digits).sum(axis=0).astype(np.int64)
        ends = np.cumsum(counts)
        digit = int(np.searchsorted(ends, left, side="right"))
        left, more = left - int(ends[digit] - counts[digit]), int(ends[digit]) - left - 1
        prefix = prefix << 8 | digit
    found = np.array([prefix], np.uint64)
    value = np.where(found >> np.uint64(63) == 1, found & np.uint64((1 << 63) - 1), ~found).view(np.float64)[0]
    if more:
        return float(value)

    def above(x, y, own):
        scores = model.raw(x[own])
        return np.array([scores[scores > value].min(initial=np.inf)])

    following = groups(above).min()
    return float((value + following) / 2) if np.isfinite(following) else float(value)


def _fit(groups: Groups, below: int) -> Model:
    mean, scale = _standard(groups)
    model = Model(mean, scale, fit_pairs(groups, scale), 0.0)
    return replace(model, threshold=quantile(groups, model, below))


def fit(x: np.ndarray, y: np.ndarray, count: dict[int, int]) -> Model:
    """Fit on rows of both classes, as a single group; ``count`` says how many each class has."""
    own = np.ones(len(y), bool)
    return _fit(lambda function: function(x, y, own)[None], count[0])


def _measure(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        rows = [features((t.as_py() or "").encode()) for t in batch.column(3)]
        if rows:
            x = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], x], names=["row", "key", "hash", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def _pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turn rows that are sorted by group into a row for each group, cut at ``MOST_ROWS``."""
    held, rows, current, number = [], 0, None, 0

    def packed():
        y, own, x = (np.concatenate(c) for c in zip(*held))
        cells = [y.astype(np.int8), own, x]
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([number], pa.int32())]
            + [pa.array([c.tobytes()], pa.binary()) for c in cells],
            names=["part", "number", "y", "own", "x"],
        )

    for batch in source:
        part = batch.column(0).to_numpy()
        y, own = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
        x = _matrix(batch.column(3))
        begin = 0
        while begin < len(part):
            if current != part[begin] or rows >= MOST_ROWS:
                if held:
                    yield packed()
                number = number + 1 if current == part[begin] else 0
                held, rows, current = [], 0, int(part[begin])
            end = min(int(np.searchsorted(part, current, side="right")), begin + MOST_ROWS - rows)
            held.append((y[begin:end], own[begin:end], x[begin:end]))
            rows, begin = rows + end - begin, end
    if held:
        yield packed()


def _over(table: DataFrame) -> Groups:
    """Run functions on the groups that ``_pack`` made; sums are in the order of the groups."""

    def run(function):
        def each(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                for part, number, y, own, x in zip(*batch.columns):
                    x = np.frombuffer(x.as_buffer(), np.float64).reshape(-1, len(FEATURES))
                    y, own = np.frombuffer(y.as_buffer(), np.int8), np.frombuffer(own.as_buffer(), bool)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.as_py()]), pa.array([number.as_py()]), pa.array([function(x, y, own)])],
                        names=["part", "number", "found"],
                    )

        found = table.mapInArrow(each, "part bigint, number bigint, found array<double>").toArrow()
        found = found.sort_by([("part", "ascending"), ("number", "ascending")])["found"].combine_chunks()
        return found.flatten().to_numpy().reshape(len(found), -1)

    return run


def train(measured: DataFrame, labels: DataFrame, *, key: str, label: str) -> Model | None:
    """Fit on all labelled rows of ``(key, hash, x)``; None if a class has none."""
    known = labels.filter(F.col(quoted(label)).isin(0, 1)).select(
        F.col(quoted(key)).alias("label_key"), F.col(quoted(label)).cast("int").alias("y")
    )
    met = measured.join(known, F.col("key") == F.col("label_key"))
    count = {r["y"]: r["n"] for r in met.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return None
    large = max(count.values())
    groups = max(-(-large // GROUP_ROWS), min(LEAST_GROUPS, -(-large // LEAST_ROWS)))
    copies = {y: min(groups, -(-PARTNERS * groups // n)) for y, n in count.items()}
    hashed = F.xxhash64("key", "hash")
    copy = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1]).otherwise(copies[0]) - 1))
    part = F.pmod(F.pmod("at", F.lit(groups)) + F.col("copy"), F.lit(groups)).cast("int")
    dealt = (
        met.select(hashed.alias("at"), "y", "x", copy.alias("copy"))
        .select(part.alias("part"), "at", "y", "copy", "x")
        .repartition(min(groups, FILES), "part")
        .sortWithinPartitions("part", "at", "y", "copy", "x")
        .select("part", "y", (F.col("copy") == 0).alias("own"), "x")
    )
    packed = dealt.mapInArrow(_pack, "part int, number int, y binary, own binary, x binary")
    return _fit(_over(written(packed, "quality-groups")), count[0])


def _scorer(model: Model | None):
    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                scores = model.score(x) if model else np.full(len(x), 0.5)
                predicted = (scores >= 0.5).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores), pa.array(predicted)], names=["row", "score", "predicted"]
                )

    return score


def held_out(key: str | Column) -> Column:
    """Whether a document is kept from training: crc32 of the key as text, modulo 3, is 1."""
    key = F.col(quoted(key)) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Score every whole text; labels, key and other columns are never looked at for a score.

    Adds ``score`` (0 to 1, higher: class 1 is likelier) and ``predicted`` (1 if the score is
    at least 0.5) in place of columns of those names. ``columns`` are those to return, all by
    default; they are written to the shared folder with the measures, so that each text is
    measured once. The fit is on every labelled document. Null and empty texts are scored as
    empty ones; equal texts get equal scores. Labels other than 0 and 1 and null keys are not
    used, and repeated labels count repeatedly. Without labelled texts of both classes all
    scores are 0.5.
    """
    names = documents.columns if columns is None else columns
    kept = [F.col(quoted(c)) for c in names if c.lower() not in ("score", "predicted")]
    held = documents.select(
        F.struct(*kept).alias("row"), F.col(quoted(key)).alias("key"),
        F.xxhash64(text_or_empty(quoted(text))).alias("hash"), text_or_empty(quoted(text)).alias("text"),
    )
    schema = StructType([*held.drop("text").schema, *StructType.fromDDL("x array<double>")])
    measured = written(held.mapInArrow(_measure, schema), "quality-measures")
    model = train(measured.select("key", "hash", "x"), labels, key=key, label=label)
    scored = StructType([*held.select("row").schema, *StructType.fromDDL("score double, predicted int")])
    return measured.select("row", "x").mapInArrow(_scorer(model), scored).select("row.*", "score", "predicted")
