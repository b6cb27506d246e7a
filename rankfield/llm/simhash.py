"""Near-duplicate documents by SimHash, their links found by pigeonring filtering.

A fingerprint of 64 bits is cut into ``bits + 1`` segments that lie on a ring. If two
fingerprints differ in at most ``bits`` bits, there is a segment from which on every chain of l
consecutive segments differs in at most l · bits / (bits + 1) bits, rounded down l - 1: the first
segment not at all, the first two in one bit at most, and so on around the ring. The first two
segments make keys: a fingerprint has that of its own bits and those with one set bit of the
second segment cleared, so that any two that agree so far have a key in common. The sums of the
longer chains are tested before the whole distance.

Equal fingerprints are one node from the start. The fingerprints of one key are compared in one
task if they are at most ``RUN``; those of a commoner key get the third segment into their keys,
after which their number is bounded, because few bits are left to differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfield.llm.common import free_name, quoted, runs, text_or_empty, with_row_id
from rankfield.llm.components import components
from rankfield.session import written

SHINGLE = 3
BITS = 3
SEED = 42

#: Fingerprints of one key that are compared with each other; commoner keys get finer.
RUN = 2048

#: Shingles that are hashed, and pairs that are compared, at a time.
BLOCK = 1 << 16

#: Fingerprints whose keys are written at a time.
ROWS = 1 << 13

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Return the SimHash of the runs of ``size`` words, repeats counted, A-Z in lower case.

    A bit is set if it is in over half of the shingles' hashes. A text of fewer words is one
    shingle; one without words has the fingerprint zero.
    """
    raw = np.frombuffer(text.lower(), np.uint8)
    begin, end = runs(~_WHITE[raw])
    if not len(begin):
        return 0
    # Words with one space between them: a shingle is then a slice of the text.
    length = end - begin
    ends = np.cumsum(length + 1)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    plain = np.full(ends[-1], 0x20, np.uint8)
    plain[inside] = raw[~_WHITE[raw]]
    spaced = memoryview(plain.tobytes())
    width = min(size, len(begin))
    starts = (ends - length - 1)[: len(begin) - width + 1].tolist()
    stops = (ends - 1)[width - 1 :].tolist()
    digest, seen = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        slices = zip(starts[at : at + BLOCK], stops[at : at + BLOCK])
        hashes = np.array([digest(spaced[a:b], SEED) for a, b in slices], "<u8")
        # Counts of set bits, up to 255 hashes at a time in single bytes.
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for first in range(0, len(bits), 255):
            seen += bits[first : first + 255].sum(axis=0, dtype=np.uint8)
    over = 2 * seen > len(starts)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def sign(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [fingerprint((t.as_py() or "").encode(), size) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "f"])

    return sign


def segments(bits: int) -> list[tuple[int, int]]:
    """Return shift and width of each of ``bits + 1`` segments of a fingerprint."""
    cuts = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def chain_masks(bits: int, slot: int) -> list[np.uint64]:
    """Return the bits of the first one, two, … segments of the ring from ``slot`` on."""
    ring = segments(bits)
    mask, out = 0, []
    for i in range(bits + 1):
        shift, width = ring[(slot + i) % (bits + 1)]
        mask |= ((1 << width) - 1) << shift
        out.append(np.uint64(mask))
    return out


def ring_keys(values: np.ndarray, bits: int, slot: int) -> tuple[np.ndarray, np.ndarray]:
    """Return keys and the fingerprint numbers they are of, from the chain of two at ``slot``.

    Two fingerprints equal in the first segment of the chain, and different in at most one bit
    of the second, share one key: of two that differ, that of the one without the bit.
    """
    first_two = chain_masks(bits, slot)[1]
    shift, width = segments(bits)[(slot + 1) % (bits + 1)]
    base = values & first_two
    keys, owners = [base], [np.arange(len(values))]
    for bit in range(shift, shift + width):
        has = np.flatnonzero(values >> np.uint64(bit) & np.uint64(1))
        keys.append(base[has] ^ np.uint64(1 << bit))
        owners.append(has)
    return np.concatenate(keys), np.concatenate(owners)


def _keys(bits: int):
    def keys(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), ROWS):
                part = values[at : at + ROWS]
                for slot in range(bits + 1):
                    key, owner = ring_keys(part, bits, slot)
                    columns = [np.full(len(key), slot, np.int32), key.view(np.int64), part[owner].view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "key", "f"])

    return keys


def linked(values: np.ndarray, group: np.ndarray, bits: int, slot: int) -> tuple[np.ndarray, np.ndarray]:
    """Return a spanning set of the links within groups: index pairs of similar fingerprints.

    ``group`` is sorted. Pairs are met at a growing distance in the order, a chunk at a time;
    their chains of segments have to keep within their budgets before the whole is counted.
    """
    masks = chain_masks(bits, slot)
    ends = np.searchsorted(group, group, side="right")
    label = np.arange(len(values))
    at = np.flatnonzero(ends - np.arange(len(values)) > 1)
    step = 1
    while len(at):
        for start in range(0, len(at), BLOCK):
            some = at[start : start + BLOCK]
            some = some[label[some] != label[some + step]]
            differ = values[some] ^ values[some + step]
            for budget, mask in enumerate(masks):
                within = np.bitwise_count(differ & mask) <= budget
                some, differ = some[within], differ[within]
            if len(some):
                _join(label, some, some + step)
        step += 1
        at = at[at + step < ends[at]]
    root = _roots(label)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return moved, root[moved]


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _join(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Give all linked ones the least label, in place; labels always point at smaller indexes."""
    while True:
        a, b = label[one], label[other]
        open_ = a != b
        if not open_.any():
            return
        one, other, a, b = one[open_], other[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        label[:] = _roots(label)


def _links(bits: int):
    """Links of rows (slot, key, f) that are sorted by slot and key, all rows of a key together."""

    def links_of(slot: np.ndarray, key: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(np.concatenate([[False], (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])]))
        for one in np.unique(slot):
            of = slice(*np.searchsorted(slot, [one, one + 1]))
            values = f[of]
            node, root = linked(values.view(np.uint64), group[of], bits, int(one))
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(values[node]), pa.array(values[root])], names=["u", "v"])

    def search(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in source:
            rows = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
            slot, key, _ = rows
            if not len(slot):
                continue
            # The last key's rows may go on in the next batch.
            other = np.flatnonzero((slot != slot[-1]) | (key != key[-1]))
            cut = other[-1] + 1 if len(other) else 0
            if cut:
                yield from links_of(*[c[:cut] for c in rows])
            held = [c[cut:] for c in rows]
        if held is not None:
            yield from links_of(*held)

    return search


def _finer(bits: int):
    """Add the third segment of the chain to the key, as it is and with each of its bits flipped.

    Fingerprints that differ there in two bits or fewer, as the chain's budgets ask for, share
    one of these keys.
    """

    def finer(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            slots, keys, values = (batch.column(i).to_numpy() for i in range(3))
            for slot in np.unique(slots):
                of = slots == slot
                key, f = keys[of].view(np.uint64), values[of]
                shift, width = segments(bits)[(int(slot) + 2) % (bits + 1)]
                key = key | (f.view(np.uint64) & np.uint64(((1 << width) - 1) << shift))
                for flip in (0, *(1 << bit for bit in range(shift, shift + width))):
                    columns = [slots[of], (key ^ np.uint64(flip)).view(np.int64), f]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "key", "f"])

    return finer


_KEYED = "slot int, key bigint, f bigint"


def _shared(keys: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame]:
    """Return the rows of keys that several fingerprints have: of up to ``most``, and of more."""
    counted = keys.groupBy("slot", "key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = keys.join(written(counted, "counts").hint("merge"), ["slot", "key"])
    if most is None:
        return rows, rows.limit(0)
    rows = written(rows, "shared")
    return rows.filter(F.col("n") <= most), rows.filter(F.col("n") > most)


def _search(rows: DataFrame, bits: int) -> DataFrame:
    dealt = rows.select("slot", "key", "f").repartition("slot", "key").sortWithinPartitions("slot", "key")
    return dealt.mapInArrow(_links(bits), "u bigint, v bigint")


def fingerprint_links(fingerprints: DataFrame, bits: int = BITS) -> DataFrame:
    """Return links (u, v) that connect all distinct fingerprints ``f`` within ``bits`` bits.

    Links that follow from others of the same key are left out, so components are those of all
    similar pairs. No pair of fingerprints leaves a task unless it is such a link.
    """
    keys = written(fingerprints.select("f").mapInArrow(_keys(bits), _KEYED), "ring-keys")
    few, many = _shared(keys, RUN)
    links = written(_search(few, bits), "ring-links")
    if many.isEmpty():
        return links
    # Of three segments out of four all bits are in the key, so a run has at most as many
    # fingerprints as the rest can tell apart and as many again for each flipped bit.
    finer = written(many.select("slot", "key", "f").mapInArrow(_finer(bits), _KEYED), "finer-keys")
    return links.unionByName(_search(_shared(finer, None)[0], bits))


def near_duplicates(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """Group documents whose fingerprints differ in at most ``bits`` bits, or through others.

    Returns the columns of ``documents`` with ``fingerprint`` (16 hex digits) and
    ``component_id`` (the least key reachable), in place of columns of those names. ``bits`` is
    1 to 7. A null or wordless text has the fingerprint zero, which links like any other. A null
    key sorts after all others, and the least key of a component is null only if all are. Rows
    equal in key and text are one document. An empty table gives an empty one.
    """
    if not 1 <= bits <= 7:
        raise ValueError(f"bits must be from 1 to 7, got {bits}")
    marked, row_id, plain = with_row_id(documents, key, text)
    ids = marked.select(F.col(quoted(row_id)).alias("id"), text_or_empty(quoted(text)).alias("text"))
    signed = ids.mapInArrow(_fingerprints(size), "id bigint, f bigint")
    signed = written(signed if plain else signed.distinct(), "fingerprints")
    classes = written(signed.groupBy("f").agg(F.min("id").alias("least")), "classes")
    labels = components(fingerprint_links(classes, bits))
    joined = classes.join(labels.hint("merge"), F.col("f") == F.col("node"), "left")
    joined = written(joined.select("f", "least", F.coalesce("component", "f").alias("component")), "labels")
    leasts = written(joined.groupBy("component").agg(F.min("least").alias("least_id")), "leasts")
    named = written(joined.join(leasts.hint("merge"), "component").select("f", "least_id"), "named")
    members = signed.join(named.hint("merge"), "f").select("id", "f", "least_id")
    return _beside(documents, marked, row_id, key, members, plain)


def _beside(documents: DataFrame, marked: DataFrame, row_id: str, key: str, members: DataFrame, plain: bool) -> DataFrame:
    """Put fingerprint and component beside the columns of the documents."""
    digits = F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint")
    least = F.col("least_id")
    if not plain:
        keys = marked.select(F.col(quoted(row_id)).alias("r"), F.col(quoted(key)).alias("least_key")).distinct()
        members, least = members.join(keys, F.col("least_id") == F.col("r")), F.col("least_key")
    match = free_name(marked, "_member_id")
    found = members.select(F.col("id").alias(match), digits, least.alias("component_id"))
    kept = [quoted(c) for c in documents.columns if c.lower() not in ("fingerprint", "component_id")]
    held = marked.select(*kept, quoted(row_id))
    out = held.join(found.hint("merge"), F.col(quoted(row_id)) == F.col(match))
    return out.select(*kept, "fingerprint", "component_id")
