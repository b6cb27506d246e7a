"""Phrase collocations, counted by double-array tries over texts as word numbers.

Texts become lists of numbers of the words that are frequent themselves; other words and ends of
pieces are breaks. Level by level, the phrases of n words that can be frequent are those of which
the first and the last n - 1 words are: neighbours in a text of the numbers of phrases, which one
scan sums; what stays below the threshold goes. Double-array tries of what is left make the next
level's text, which holds only positions where such a phrase begins. All phrases are then put in
tries. A scan advances the states of all text positions at once, one word after the other, and
counts accepting states by bincount; the sums over all tasks are the phrases' frequencies.

A trie holds some bounded number of phrases, those whose first words fall into its part, so that
a position is walked in one trie only. A scan broadcasts a few of them; more phrases take more
scans, in proportion. Tries are built in tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfield.llm.common import quoted, text_or_empty
from rankfield.session import written

LEAST = 100
MOST_WORDS = 5
FIRST = 2000
COVER = 100

#: Language of a document without one.
NO_LANG = "und"

#: Phrases in one trie, tries in a broadcast, and words and their bytes that are sent out at a time.
TRIE_PHRASES = 1 << 19
FOREST = 4
VOCABULARY = 1 << 19
VOCABULARY_BYTES = 1 << 25

#: Counts that a task adds up before it hands them on.
HELD = 1 << 21

#: Words of text for one slice of the counts, and the most slices, as powers of two.
SLICE_WORDS = 20
SLICES = 16

#: Bytes of text and numbers of words that are turned into arrays at a time.
BLOCK_BYTES = 1 << 21
BLOCK_WORDS = 1 << 18

#: Places that are tried for the children of a node before the array grows.
PLACES = 256

#: Largest word number that is looked up in a plain array.
PLAIN = 1 << 22

#: Parts of a language that are ranked by themselves before the whole is.
PARTS = 64

_ENDS = bytes([*b".,;:!?", *range(0x0A, 0x0E)])
_GAPS = _ENDS + b" \t"

#: 0 for bytes of words, 1 for gaps, 2 for ends of pieces.
_KINDS = bytes(2 if c in _ENDS else 1 if c in _GAPS else 0 for c in range(256))


def split_words(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Return the words of lower-case text, where they begin and where pieces end."""
    kinds = np.frombuffer(b"\n".join([b"", data, b""]).translate(_KINDS), np.uint8)
    gap = kinds > 0
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    begin, end = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, _GAPS))]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), buffers)
    return words.dictionary_encode(), begin, np.flatnonzero(kinds[1:-1] == 2)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """Yield language, rows and lower-case texts of (lang, text), a bounded block at a time."""
    held: dict[str, tuple[list[int], list[bytes]]] = {}
    sizes: dict[str, int] = {}
    for row, (lang, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
        rows, texts = held.setdefault(lang, ([], []))
        rows.append(row)
        texts.append(text.as_buffer().to_pybytes().lower())
        sizes[lang] = sizes.get(lang, 0) + len(texts[-1])
        if sizes[lang] >= BLOCK_BYTES:
            yield lang, *held.pop(lang)
            del sizes[lang]
    for lang, (rows, texts) in held.items():
        yield lang, rows, texts


def _added_words(held: list[pa.Table]) -> pa.Table:
    """Return the sums of (lang, word, n)."""
    together = pa.concat_tables(held)
    added = together.group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")])
    return added.select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """Return (lang, word, n) of all words of (lang, text)."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in source:
            for lang, _, block in _blocks(batch):
                words, *_ = split_words(b"\n".join(block))
                kinds = words.dictionary.cast(pa.binary()).cast(pa.string())
                n = np.bincount(words.indices.to_numpy(), minlength=len(kinds))
                columns = [pa.array([lang] * len(kinds), pa.string()), kinds, pa.array(n)]
                held.append(pa.table(columns, names=["lang", "word", "n"]))
                size += len(kinds)
                if size >= HELD:
                    held = [_added_words(held)]
                    size = held[0].num_rows
                    if size > HELD // 2:
                        yield from held.pop().to_batches(BLOCK_WORDS)
                        size = 0
        if held:
            yield from _added_words(held).to_batches(BLOCK_WORDS)

    counted = texts.mapInArrow(count, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _dense(rows: DataFrame, label: str, name: str) -> DataFrame:
    """Return ``rows`` with their numbers, from 0 without gaps, in the order of their partitions."""
    ordered = written(rows.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.shiftright("at", 33).alias("part")
    # One row for each task that wrote the table.
    sizes = sorted(ordered.groupBy(part).agg(F.count("*")).collect())
    starts = itertools.accumulate((n for _, n in sizes), initial=0)
    offsets = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "part bigint, start bigint")
    numbers = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    row = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return written(numbers.select(*rows.columns, (F.col("start") + row).alias(name)), label)


def numbered(words: DataFrame) -> DataFrame:
    """Return the words with ``id``, from 0 without gaps, the commonest first."""
    ordered = words.orderBy(F.col("n").desc(), "lang", "word")
    return _dense(ordered.select("lang", "word", "n"), "vocabulary", "id")


def _encode(shared):
    def encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in source:
            out: list[np.ndarray | None] = [None] * batch.num_rows
            before = batch.column(2)
            for lang, rows, block in _blocks(batch):
                # The newlines that part the texts are ends of pieces, so no piece is of two.
                words, begin, ends = split_words(b"\n".join(block))
                number = np.full(len(words.dictionary), -1, np.int32)
                if lang in known:
                    listed, ids = known[lang]
                    at = pc.index_in(words.dictionary.cast(pa.binary()), value_set=listed)
                    found = at.is_valid().to_numpy(zero_copy_only=False)
                    number[found] = ids[at.drop_null().to_numpy()]
                # A break before the first word behind each end.
                new = np.searchsorted(begin, ends)
                new = new[np.diff(new, append=len(begin)) > 0]
                number = np.insert(number[words.indices.to_numpy()], new, -1)
                cuts = np.searchsorted(begin, np.cumsum([0, *(len(t) + 1 for t in block)]))
                cuts += np.searchsorted(new, cuts)
                for row, a, b in zip(rows, cuts, cuts[1:]):
                    out[row] = number[a:b]
            if before.null_count < len(before):
                old = before.to_pylist()
                out = [np.maximum(n, np.array(o, np.int32)) for n, o in zip(out, old)]
            lists = pa.array(out, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["lang", "text", "ids"])

    return encode


def encoded(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Return ``ids``, the word numbers of each text, -1 for other words and before each piece.

    The vocabulary is sent out in bounded parts, each read by a scan of its own.
    """
    spark = texts.sparkSession
    rows, size = vocabulary.agg(F.count("*"), F.sum(F.octet_length("word"))).first()
    parts = max(1, -(-rows // VOCABULARY), -(-(size or 0) // VOCABULARY_BYTES))
    current = texts.select("lang", "text", F.lit(None).cast("array<int>").alias("ids"))
    for part in range(parts):
        some = vocabulary.filter(F.pmod(F.xxhash64("lang", "word"), F.lit(parts)) == part)
        known: dict[str, tuple[pa.Array, np.ndarray]] = {}
        words = some.select("lang", "word", "id").toArrow()
        for lang in pc.unique(words["lang"]).to_pylist():
            own = words.filter(pc.equal(words["lang"], lang))
            known[lang] = (own["word"].combine_chunks().cast(pa.binary()), own["id"].to_numpy())
        shared = spark.sparkContext.broadcast(known)
        current = current.mapInArrow(_encode(shared), "lang string, text string, ids array<int>")
        current = written(current.select("ids") if part == parts - 1 else current, "word-numbers")
        shared.destroy()
    return current


class _Slots:
    """The growing arrays of a trie. Children of the largest families are placed first, at the
    least of some places drawn from all; only children fill the gaps that are left."""

    def __init__(self, words: int):
        self.first = words + 1
        self.end = self.first
        self.check = np.full(2 * words + PLACES, -1, np.int64)
        self.base = np.zeros(len(self.check), np.int64)
        self.draw = np.random.default_rng(7)

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def place(self, states: np.ndarray, parent: np.ndarray, word: np.ndarray, root: bool) -> np.ndarray:
        """Return the states of children, ordered by parent, a place in ``states``, and word."""
        out = np.zeros(len(word), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.zeros(0, np.int64)
        size = np.diff(np.append(starts, len(parent)))
        families = np.argsort(-size, kind="stable")
        single = np.searchsorted(-size[families], -1, side="left")
        for f in families[: len(families) if root else single].tolist():
            kids = word[starts[f] : starts[f] + size[f]]
            up = states[parent[starts[f]]]
            at = 1 if root else self._room(kids)
            self._grow(at + int(kids[-1]) + 1)
            self.base[up] = at
            self.check[at + kids] = up
            self.end = max(self.end, at + int(kids[-1]) + 1)
            out[starts[f] : starts[f] + size[f]] = at + kids
        if not root and single < len(families):
            only = starts[families[single:]]
            self._grow(self.end + len(only))
            free = np.flatnonzero(self.check[self.first : self.end + len(only)] < 0)[: len(only)] + self.first
            up = states[parent[only]]
            self.base[up] = free - word[only]
            self.check[free] = up
            self.end = max(self.end, int(free[-1]) + 1)
            out[only] = free
        return out

    def _room(self, kids: np.ndarray) -> int:
        """Return a place for a family: the first of those drawn where all its slots are free."""
        places = np.sort(self.draw.integers(self.first, self.end + 1, PLACES)) - kids[0]
        self._grow(self.end + int(kids[-1]) + 2)
        fits = (self.check[places[:, None] + kids] < 0).all(axis=1)
        return int(places[np.argmax(fits)] if fits.any() else self.end - kids[0])


class Trie:
    """A double array over the words ``used``: the child of state s by word w is
    ``base[s] + w`` if ``check`` of that is s. ``accept`` has the phrase that ends at a state."""

    def __init__(self, used: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.used, self.base, self.check, self.accept = used, base, check, accept
        self.plain = np.zeros(0, np.int32)
        if len(used) and used[-1] < PLAIN:
            self.plain = np.full(int(used[-1]) + 2, -1, np.int32)
            self.plain[used] = np.arange(len(used))

    @classmethod
    def build(cls, phrases: Sequence[Sequence[int]], numbers: Sequence[int]) -> Trie:
        """Build the trie of different phrases; ``numbers`` are what ``accept`` says of them."""
        flat = np.fromiter(itertools.chain.from_iterable(phrases), np.int64)
        return cls.of_lists(np.array([len(p) for p in phrases]), flat, np.asarray(numbers, np.int64))

    @classmethod
    def of_lists(cls, length: np.ndarray, flat: np.ndarray, numbers: np.ndarray) -> Trie:
        """Build the trie of phrases of such lengths, whose words follow each other in ``flat``."""
        used, flat = np.unique(flat, return_inverse=True)
        depth = int(length.max(initial=1))
        words = np.full((len(length), depth), -1)
        words[np.arange(depth) < length[:, None]] = flat
        order = np.lexsort(words.T[::-1])
        words, length, numbers = words[order], length[order], numbers[order]
        # The root is state 0 and its children the states from 1; all others lie behind them.
        slots = _Slots(len(used))
        node = np.zeros(len(length), np.int64)  # of each phrase's first words
        ends = np.zeros(len(length), np.int64)  # the state in which each phrase ends
        states = np.zeros(1, np.int64)
        for n in range(depth):
            rows = np.flatnonzero(length > n)
            parent, word = node[rows], words[rows, n]
            new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (word[1:] != word[:-1])])
            first = np.flatnonzero(new)
            placed = slots.place(states, parent[first], word[first], root=n == 0)
            node[rows] = np.cumsum(new) - 1
            states = placed
            done = rows[length[rows] == n + 1]
            ends[done] = states[node[done]]
        size = max(int(slots.base.max()) + len(used), slots.end) + 1
        check = np.concatenate([slots.check[:size], np.full(max(0, size - len(slots.check)), -1)])
        base = np.concatenate([slots.base[:size], np.zeros(max(0, size - len(slots.base)), np.int64)])
        accept = np.full(size, -1, np.int32)
        accept[ends] = numbers
        return cls(used.astype(np.int32), base.astype(np.int32), check.astype(np.int32), accept)

    def local(self, ids: np.ndarray) -> np.ndarray:
        """Return the trie's own numbers of words, -1 for those it has not."""
        used, plain = self.used, self.plain
        if not len(used):
            return np.full(len(ids), -1, np.int32)
        if len(plain):
            return plain[np.where((ids < 0) | (ids > used[-1]), len(plain) - 1, ids)]
        at = np.minimum(np.searchsorted(used, ids), len(used) - 1)
        return np.where(used[at] == ids, at, -1)

    def levels(self, ids: np.ndarray, depth: int, starts: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield, for 1 to ``depth`` words, the positions whose states live and the states.

        Walks begin at ``starts``, or at all positions."""
        words = np.concatenate([self.local(ids), np.full(depth, -1, np.int32)])
        at = np.arange(len(ids)) if starts is None else starts
        state = np.zeros(len(at), np.int32)
        for n in range(depth):
            word = words[at + n]
            known = word >= 0
            at, state, word = at[known], state[known], word[known]
            next_ = self.base[state] + word
            moved = self.check[next_] == state
            at, state = at[moved], next_[moved]
            yield at, state


def _streams(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
    """Yield the numbers in each column's lists, whole rows, a break behind each.

    Rows are taken together up to ``BLOCK_WORDS`` numbers, one at least.
    """
    ends = np.cumsum(pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_WORDS, side="right")))
        some = [c.slice(first, last - first).flatten().to_numpy() for c in batch.columns]
        yield [np.insert(c, ends[first:last] - before, -1) for c in some]
        first = last


def _cuts(ids: np.ndarray, overlap: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Yield where blocks of a stream begin, they and an overlap, and their own positions."""
    for at in range(0, len(ids), BLOCK_WORDS):
        yield at, ids[at : at + BLOCK_WORDS + overlap], min(BLOCK_WORDS, len(ids) - at)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Return the different codes in order and the sums of their counts."""
    codes, counts = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _slices(codes: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row for each slice of the codes, by a hash."""
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    part = (mixed >> np.uint64(64 - SLICES)).astype(np.uint16) >> (SLICES - bits)
    order = np.argsort(part, kind="stable")
    part, codes, counts = part[order], codes[order], counts[order]
    first = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
    ends = np.append(first[1:], len(part))
    columns = [
        pa.array(part[first].astype(np.int32)),
        pa.array([codes[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
        pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["slice", "codes", "counts"])


def _handed_on(found: Iterator[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """Add up counts of codes, a bounded number at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for codes, counts in found:
        held.append((codes, counts))
        size += len(codes)
        if size >= HELD:
            held = [_added(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield _slices(*held.pop(), bits)
                size = 0
    if size:
        yield _slices(*_added(held), bits)


def _summed(least: int):
    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size, bound = 0, 2 * HELD
        for batch in source:
            for part, codes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                slices.setdefault(part, []).append((np.frombuffer(codes, np.int64), np.frombuffer(counts, np.int64)))
                size += len(codes) // 8
                if size > bound:
                    slices = {k: [_added(v)] for k, v in slices.items()}
                    size = sum(len(v[0][0]) for v in slices.values())
                    bound = size + 2 * HELD
        for part in list(slices):
            codes, n = _added(slices.pop(part))
            often = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(codes[often]), pa.array(n[often])], names=["code", "n"])

    return add


def _sums(texts: DataFrame, scan, bits: int, least: int, label: str) -> DataFrame:
    """Return (code, n) of the codes that a scan counts at least so often, added slice by slice."""
    found = texts.mapInArrow(lambda source: _handed_on(scan(source), bits), "slice int, codes binary, counts binary")
    dealt = found.repartition(max(1, (1 << bits) // 4), "slice")
    return written(dealt.mapInArrow(_summed(least), "code bigint, n bigint"), label)


def _adjacent(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of neighbours p and q, as p << 32 | q."""
    for batch in source:
        for (stream,) in _streams(batch):
            for _, ids, _ in _cuts(stream, 1):
                both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                yield np.unique(ids[both].astype(np.int64) << 32 | ids[both + 1], return_counts=True)


def _raised(shared, parts: int, last: bool):
    """The numbers of the phrases of two numbers that begin at each position.

    Positions where none does are breaks. The last scan leaves one break of those that follow
    each other and gives up what the numbers were made of.
    """

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {k: Trie(*arrays) for k, arrays in shared.value.items()}
        for batch in source:
            for stream, *before in _streams(batch):
                out = before[0] if before else np.full(len(stream), -1, np.int32)
                for at, ids, _ in _cuts(stream, 1):
                    starts = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                    for k, trie in tries.items():
                        *_, (where, state) = trie.levels(ids, 2, starts[ids[starts] % parts == k])
                        out[at + where] = trie.accept[state]
                if last:
                    live = out >= 0
                    live[1:] |= live[:-1]
                    streams = [out[live]]
                else:
                    streams = [stream, out]
                breaks = np.flatnonzero(streams[0] < 0)
                cuts = breaks[np.searchsorted(breaks, range(BLOCK_WORDS, int(breaks[-1]) if len(breaks) else 0, BLOCK_WORDS))] + 1
                ends = pa.array(np.unique([0, *cuts, len(streams[0])]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(s, pa.int32())) for s in streams]
                yield pa.RecordBatch.from_arrays(lists, names=["ids", "numbers"][: len(lists)])

    return scan


def _accepted(shared, parts: int, depth: int):
    """Counts of accepting states."""

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tries = {k: Trie(*arrays) for k, arrays in shared.value.items()}
        totals = {k: np.zeros(len(trie.accept), np.int64) for k, trie in tries.items()}
        for batch in source:
            for (stream,) in _streams(batch):
                for _, ids, own in _cuts(stream, depth):
                    starts = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                    starts = starts[starts < own]
                    of = (ids[starts].astype(np.int64) * 31 + ids[starts + 1]) % parts
                    for k, trie in tries.items():
                        states = [state for _, state in trie.levels(ids, depth, starts[of == k])]
                        totals[k] += np.bincount(np.concatenate(states), minlength=len(totals[k]))
        for k, trie in tries.items():
            seen = np.flatnonzero((trie.accept >= 0) & (totals[k] > 0))
            yield trie.accept[seen].astype(np.int64), totals[k][seen]

    return scan


def _built(table: pa.Table) -> pa.Table:
    lists = table["ids"].combine_chunks()
    length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    trie = Trie.of_lists(length, lists.flatten().to_numpy().astype(np.int64), table["number"].to_numpy())
    arrays = (trie.used, trie.base, trie.check, trie.accept)
    return pa.table([table["part"][:1], *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], names=["part", "used", "base", "check", "accept"])


def _tries(phrases: DataFrame, parts: int) -> Iterator:
    """Yield some broadcast tries at a time, by part, of phrases (number, ids, part)."""
    dealt = phrases.select("number", "ids", "part").repartition(parts, "part")
    tries = dealt.groupBy("part").applyInArrow(_built, "part bigint, used binary, base binary, check binary, accept binary")
    tries = written(tries, "tries")
    for first in range(0, parts, FOREST):
        some = tries.filter((F.col("part") >= first) & (F.col("part") < first + FOREST)).toArrow().to_pylist()
        arrays = ("used", "base", "check", "accept")
        yield phrases.sparkSession.sparkContext.broadcast({r["part"]: [np.frombuffer(r[a], np.int32) for a in arrays] for r in some})


def _trie_count(phrases: int) -> int:
    return max(1, -(-phrases // TRIE_PHRASES))


def _grown(level: DataFrame, pairs: DataFrame) -> DataFrame:
    """Return the phrases that pairs of a level's phrases make, with what they are made of."""
    pairs = pairs.select(F.shiftright("code", 32).alias("p"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).alias("q"))
    first = level.select(F.col("number").alias("p"), F.col("ids").alias("head"))
    last = level.select(F.col("number").alias("q"), F.element_at("ids", -1).alias("tail"))
    joined = pairs.join(first, "p").join(last, "q")
    return _dense(joined.select("p", "q", F.concat("head", F.array("tail")).alias("ids")), "phrases", "number")


def _next_texts(texts: DataFrame, level: DataFrame, size: int) -> DataFrame:
    """Return the texts (ids) of the numbers of a level's phrases, from those of the level before."""
    parts = _trie_count(size)
    made_of = F.array(F.col("p").cast("int"), F.col("q").cast("int")).alias("ids")
    current = texts
    for done, shared in enumerate(_tries(level.select("number", made_of, F.expr(f"p % {parts}").alias("part")), parts), 1):
        last = done * FOREST >= parts
        scan = _raised(shared, parts, last)
        current = written(current.mapInArrow(scan, "ids array<int>" if last else "ids array<int>, numbers array<int>"), "phrase-numbers")
        shared.destroy()
    return current


def candidate_phrases(texts: DataFrame, vocabulary: DataFrame, least: int, most_words: int, bits: int) -> list[tuple[DataFrame, int]]:
    """Return (ids, number) of the phrases of 2, 3, … words that can occur ``least`` times, and how many."""
    level = vocabulary.select(F.array(F.col("id").cast("int")).alias("ids"), F.col("id").alias("number"))
    levels = []
    for words in range(2, most_words + 1):
        pairs = _sums(texts, _adjacent, bits, least, "phrase-pairs")
        level = _grown(level, pairs)
        size = level.count()
        if not size:
            break
        levels.append((level.select("ids", "number"), size))
        if words < most_words:
            texts = _next_texts(texts, level, size)
    return levels


def phrase_counts(texts: DataFrame, phrases: DataFrame, size: int, most_words: int, bits: int) -> DataFrame:
    """Return (ids, n): how often each of the different phrases occurs, by the tries' states."""
    counted = []
    parts = _trie_count(size)
    part = F.expr(f"(cast(ids[0] as bigint) * 31 + ids[1]) % {parts}").alias("part")
    for shared in _tries(phrases.select("number", "ids", part), parts):
        counted.append(_sums(texts, _accepted(shared, parts, most_words), bits, 1, "phrase-counts"))
        shared.destroy()
    total = counted[0]
    for some in counted[1:]:
        total = total.unionByName(some)
    return phrases.join(total.withColumnRenamed("code", "number"), "number").select("ids", "n")


def _scores(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(1000 · a · n / (l · r)) in whole numbers of any size."""
    for batch in source:
        a, n, l, r = (batch.column(i).to_pylist() for i in range(1, 5))
        score = [1000 * x * y // (u * v) for x, y, u, v in zip(a, n, l, r)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.int64())], names=[*batch.schema.names, "score"])


def _cut_scores(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Return (ids, a, n, l, r, score) of each phrase's lowest-scoring cut, the first of equals.

    ``phrases`` has ``ids``, ``a`` and the ``n`` of its language, ``counts`` the frequencies of
    all phrases and words.
    """
    cut = phrases.select("ids", "a", "n", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cut = cut.withColumn("first", F.expr("slice(ids, 1, k)")).withColumn("rest", F.expr("slice(ids, k + 1, size(ids) - k)"))
    left = counts.select(F.col("ids").alias("first"), F.col("f").alias("l"))
    right = counts.select(F.col("ids").alias("rest"), F.col("f").alias("r"))
    known = cut.join(left.hint("merge"), "first").join(right.hint("merge"), "rest")
    known = known.select(F.struct("ids", "k").alias("cut"), "a", "n", "l", "r")
    schema = "cut struct<ids: array<int>, k: int>, a bigint, n bigint, l bigint, r bigint, score bigint"
    scored = known.mapInArrow(_scores, schema)
    least = scored.groupBy(F.col("cut.ids").alias("ids")).agg(F.min(F.struct("score", "cut.k", "a", "n", "l", "r")).alias("m"))
    return least.select("ids", "m.a", "m.n", "m.l", "m.r", "m.score")


def _covered(counts: DataFrame, cover: int) -> DataFrame:
    """Return the ``ids`` of phrases inside a longer one with ``cover`` percent of their frequency."""
    inside = F.expr(
        """flatten(transform(sequence(2, size(ids) - 1), w ->
        transform(sequence(1, size(ids) - w + 1), i -> slice(ids, i, w))))"""
    )
    parts = counts.filter(F.size("ids") > 2).select(F.explode(inside).alias("ids"), F.col("f").alias("longer"))
    most = parts.groupBy("ids").agg(F.max("longer").alias("longer"))
    return counts.join(most.hint("merge"), "ids").filter(F.lit(100) * F.col("longer") >= F.lit(cover) * F.col("f")).select("ids")


def collocations(
    documents: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    first: int = FIRST,
    cover: int = COVER,
) -> DataFrame:
    """Rank each language's phrases of 2 to ``most_words`` words by how much they stick together.

    Words are what spaces and tabs part, A-Z in lower case, within pieces that end at ``.,;:!?``
    and line ends. With a, l and r the frequencies of a phrase, of its first words and of the
    rest, and n all words of the language, a cut scores floor(1000 · a · n / (l · r)); a phrase's
    lowest cut counts, the earliest of equals. Phrases with a ≥ ``least`` count, unless they lie
    within a longer such phrase that occurs ``cover`` percent as often. Returns ``lang, rank,
    phrase, a, l, r, n, score``, the ``first`` phrases of each language by falling score and
    frequency, then by the phrase's bytes.

    A null language is ``und``, a null text is empty; no key is needed, and equal rows all
    count. Other columns are not read. Without frequent phrases, or rows, the result is empty.
    """
    texts = documents.select(
        F.coalesce(F.col(quoted(lang)), F.lit(NO_LANG)).alias("lang"), text_or_empty(quoted(text)).alias("text")
    )
    counted = written(word_counts(texts), "words")
    totals = written(counted.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    vocabulary = numbered(counted.filter(F.col("n") >= least))
    schema = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
    if vocabulary.isEmpty():
        return documents.sparkSession.createDataFrame([], schema)
    numbers = encoded(texts, vocabulary)
    bits = min(SLICES, (totals.agg(F.sum("total")).first()[0] >> SLICE_WORDS).bit_length())
    levels = candidate_phrases(numbers, vocabulary, least, most_words, bits)
    if not levels:
        return documents.sparkSession.createDataFrame([], schema)
    found, size = None, 0
    for level, more in levels:
        level = level.withColumn("number", F.col("number") + size)
        found = level if found is None else found.unionByName(level)
        size += more
    phrases = phrase_counts(numbers, found, size, most_words, bits).withColumnRenamed("n", "f")
    phrases = written(phrases.filter(F.col("f") >= least), "phrases")
    words = vocabulary.select(F.array(F.col("id").cast("int")).alias("ids"), F.col("n").alias("f"))
    left = phrases.join(_covered(phrases, cover).hint("merge"), "ids", "left_anti")
    # All words of a phrase are of one language, that of its first.
    of = vocabulary.join(totals, "lang").select(F.col("id").cast("int").alias("word"), "lang", "total")
    left = left.withColumn("word", F.element_at("ids", 1)).join(of.hint("merge"), "word")
    left = written(left.select("ids", "lang", F.col("f").alias("a"), F.col("total").alias("n")), "candidates")
    scored = _cut_scores(left.select("ids", "a", "n"), phrases.unionByName(words))
    spelled = (
        left.select("ids", "lang", F.posexplode("ids").alias("at", "word"))
        .join(vocabulary.select(F.col("id").cast("int").alias("word"), F.col("word").alias("spelling")).hint("merge"), "word")
        .groupBy("ids", "lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "spelling"))).alias("words"))
        .select("ids", "lang", F.concat_ws(" ", "words.spelling").alias("phrase"))
    )
    rows = written(scored.join(spelled.hint("merge"), "ids").drop("ids"), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = rows.withColumn("at", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    some = some.filter(F.col("at") <= first).drop("at")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
