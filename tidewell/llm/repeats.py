"""Removing repeated passages: sorted suffixes of all documents, exchanged as front-coded runs and merged.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. Only suffixes that can
have an equal are sorted, and all that rule them out are exact, so none is lost:

1. Documents are cut into pieces where their content says so. Of equal pieces, with the bytes that their last strings
   reach into, only the document with the least id goes on; for the others all strings of the piece are repeated.
2. Every string of ``LENGTH`` bytes has a fingerprint, the least hash of the shorter strings in it. Equal strings have equal
   fingerprints, so those found in one document only are done. Fingerprints travel as sorted runs, and those that are shared come back.
3. What is left is sorted by block of documents, equal strings folded, and sent to ranges of strings as runs that
   name only the bytes by which a string differs from the one before. A range merges its runs (``runs.merge_runs``).

A string that many documents share arrives once per block and range, never once per document.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import release, scratch_path, staged
from .runs import AT_ONCE, common_prefixes, decoded_rows, front_coded, merge_runs

LENGTH = 50
PIECE = 128  # mean bytes of a piece
TOGETHER = 1 << 19  # bytes hashed at a time
BLOCK_BYTES = 16 << 20
BLOCKS_A_FILE = 8
RUN = 1 << 20  # strings of a run before it is cut into ranges
FOLD = 1 << 21  # fingerprints of a bucket
RANGE = 300_000  # strings of a range
MOST_RANGES = 1 << 14
SAMPLES = 64  # strings drawn for each range
BROADCAST_BYTES = 48 << 20
BATCH_BYTES = 2 << 20  # packed bytes of runs that leave a task at a time
MIX = np.uint64(0xBF58476D1CE4E5B9)

_BYTES = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)


@functools.cache
def _coders() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One of each for all of a worker: a run has small parts for very many ranges."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def packed(numbers: np.ndarray | bytes) -> bytes:
    """Bytes as they travel and are stored."""
    return _coders()[0].compress(numbers if isinstance(numbers, bytes) else numbers.tobytes())


def unpacked(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(_coders()[1].decompress(value.as_buffer()), kind)


def _steps(numbers: np.ndarray) -> np.ndarray:
    """The first number, and by how much each is greater than the one before."""
    out = numbers.copy()
    out[1:] -= numbers[:-1]
    return out


def _gram(length: int) -> int:
    """Fingerprints are hashes of this many bytes: longer ones tell more strings apart, but there are more of them."""
    return 2 * length // 3


def string_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` bytes, by doubling: it depends on those bytes alone."""
    part, held, length, skip = _BYTES[data], None, 1, 0
    power = np.uint64(0x9E3779B97F4A7C15)
    n, rest = len(data) - k + 1, k
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                seen = part[skip : skip + n]
                held = seen.copy() if held is None else held * power + seen
                skip += length
            rest >>= 1
            if rest:
                part = part[: len(part) - length] * power + part[length:]
                power, length = power * power, 2 * length
        held ^= held >> np.uint64(32)
        held *= MIX
        held ^= held >> np.uint64(29)
    return held


def fingerprints(data: np.ndarray, length: int) -> np.ndarray:
    """Per string of ``length`` bytes the least hash of the shorter strings in it, mixed again to be even."""
    gram = _gram(length)
    least, width, spread = string_hashes(data, gram), length - gram + 1, 1
    n = len(data) - length + 1
    while 2 * spread <= width:
        least = np.minimum(least[:-spread], least[spread:])
        spread *= 2
    least = np.minimum(least[:n], least[width - spread : width - spread + n])
    with np.errstate(over="ignore"):
        least = least * np.uint64(0x94D049BB133111EB)
        return least ^ (least >> np.uint64(31))


def _grouped(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbours that add up to about ``most``."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += int(size)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


# Pieces


def cut_pieces(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(text, first string, end of strings, digest) of every piece of the texts."""
    gram = _gram(length)
    for a, b in _grouped(np.array([len(t) for t in texts]), TOGETHER):
        data = b"".join(texts[a:b])
        if len(data) < length:
            continue
        cuts = np.flatnonzero((string_hashes(np.frombuffer(data, np.uint8), gram) & np.uint64(PIECE - 1)) == 0)
        at = 0
        for i in range(a, b):
            strings = len(texts[i]) - length + 1
            if strings > 0:
                inner = cuts[np.searchsorted(cuts, at + 1) : np.searchsorted(cuts, at + strings)]
                ends = [*inner.tolist(), at + strings]
                start = at
                for end in ends:
                    yield i, start - at, end - at, hashlib.blake2b(data[start : end + length - 1], digest_size=16).digest()
                    start = end
            at += len(texts[i])


PIECES = "k1 bigint, k2 bigint, doc_id bigint, tag bigint, starts array<int>, ends array<int>"
_PIECES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _pieces(docs: DataFrame, length: int) -> DataFrame:
    """Pieces per document, folded within a batch: a key is null where a smaller document of the batch has the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, texts = (batch.column(i).to_pylist() for i in range(3))
            pieces = list(cut_pieces(texts, length))
            least: dict[bytes, int] = {}
            for i, _, _, key in pieces:
                if least.setdefault(key, ids[i]) > ids[i]:
                    least[key] = ids[i]
            mine: dict[tuple[bytes, int], tuple[list[int], list[int]]] = {}
            done: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
            for i, start, end, key in pieces:
                own = least[key] == ids[i]
                starts, ends = mine.setdefault((key, tags[i]), ([], [])) if own else done.setdefault((ids[i], tags[i]), ([], []))
                starts.append(start)
                ends.append(end)
            rows: list[tuple[object, ...]] = [(*struct.unpack(">qq", key), least[key], tag, *spans) for (key, tag), spans in mine.items()]
            rows += [(None, None, *doc, *spans) for doc, spans in done.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _PIECES)], schema=_PIECES)

    return docs.select("doc_id", "tag", "data").mapInArrow(run, PIECES)


def _known(docs: DataFrame, length: int, scratch: list[str]) -> DataFrame:
    """Per document the pieces that a document with a smaller id has, too (``spans``: from a string to the end of strings)."""
    pieces = staged(_pieces(docs, length), "pieces", scratch)
    first = pieces.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = pieces.join(first, ["k1", "k2"]).filter("doc_id > least")
    spans = F.arrays_zip("starts", "ends")
    both = later.select("doc_id", "tag", spans.alias("spans")).unionByName(pieces.filter("k1 IS NULL").select("doc_id", "tag", spans.alias("spans")))
    # A document's own pieces: no more than its text has.
    return both.groupBy("doc_id", "tag").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


# Blocks


class Block:
    """Parts of documents that may hold repeated strings; ``doc`` counts in ``ids``, which ascend, ``start`` in the document."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        self.name = batch.column(0)[i].as_py()
        self.ids, self.tags = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (1, 2))
        self.doc, self.start, self.size = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32) for c in (3, 4, 5))
        self.data = np.frombuffer(batch.column(6)[i].as_buffer(), np.uint8)

    def strings(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Some parts at a time: the places of their strings in ``data``, their parts and fingerprints, and where these change."""
        begin = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        for a, b in _grouped(self.size, TOGETHER):
            low, high = int(begin[a]), int(begin[b])
            inside = np.ones(high - low, bool)
            for end in begin[a + 1 : b + 1] - low:
                inside[end - length + 1 : end] = False
            places = np.flatnonzero(inside)
            part = np.repeat(np.arange(a, b), self.size[a:b] - length + 1)
            prints = fingerprints(self.data[low:high], length)[places]
            change = np.concatenate([[True], (prints[1:] != prints[:-1]) | (part[1:] != part[:-1])])
            yield low + places, part, prints, change


BLOCKS = "block bigint, ids array<bigint>, tags array<bigint>, doc binary, start binary, size binary, data binary, drawn binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("tags", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("doc", "start", "size", "data", "drawn")]])


def _blocks(docs: DataFrame, length: int, draw: float) -> DataFrame:
    """What the known ``spans`` leave of the documents, packed; ``drawn`` are strings of it, ``draw`` for each byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        tags: list[int] = []
        parts: list[tuple[int, int, bytes]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal total
            order = sorted(range(len(ids)), key=ids.__getitem__)
            place = {doc: k for k, doc in enumerate(order)}
            parts[:] = sorted(((place[d], s, t) for d, s, t in parts), key=lambda p: p[:2])
            ids[:], tags[:] = [ids[k] for k in order], [tags[k] for k in order]
            numbers = [np.array(c, np.int32).tobytes() for c in ([p[0] for p in parts], [p[1] for p in parts], [len(p[2]) for p in parts])]
            data = b"".join(p[2] for p in parts)
            at = np.random.default_rng(len(data)).integers(0, len(data) - length + 1, math.ceil(draw * len(data)))
            row = [uuid.uuid4().int >> 65, list(ids), list(tags), *numbers, data, b"".join(data[k : k + length] for k in at)]
            ids.clear(), tags.clear(), parts.clear()
            total = 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS)], schema=_BLOCKS)

        for batch in batches:
            for doc, tag, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                strings, at, left = len(text) - length + 1, 0, []
                for s in spans or []:
                    if s["starts"] > at:
                        left.append((at, s["starts"]))
                    at = max(at, s["ends"])
                if strings > at:
                    left.append((at, strings))
                if left:
                    parts += [(len(ids), a, text[a : b + length - 1]) for a, b in left]
                    ids.append(doc)
                    tags.append(tag)
                    total += sum(b - a + length - 1 for a, b in left)
                if total >= BLOCK_BYTES:
                    yield flush()
        if parts:
            yield flush()

    return docs.select("doc_id", "tag", "data", "spans").mapInArrow(run, BLOCKS)


def _bucketed(block: Block, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct fingerprints of a block, sorted, and which of them two of its documents have."""
    seen, whose = [], []
    for _, part, prints, change in block.strings(length):
        seen.append(prints[change] >> np.uint64(32 - bits))
        whose.append(block.ids[block.doc[part[change]]])
    values, docs = np.concatenate(seen), np.concatenate(whose)
    # Documents ascend within a block, and so they do among equal fingerprints.
    order = np.argsort(values, kind="stable")
    values, docs = values[order], docs[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    ends = np.concatenate([starts[1:], [len(values)]]) - 1
    return values[starts], docs[starts] != docs[ends]


def _prints(blocks: DataFrame, length: int, bits: int) -> DataFrame:
    """Sorted runs of fingerprints by bucket: 32 bits of each, stored as steps, and a bit for those that two documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                values, many = _bucketed(block, length, bits)
                rows = []
                cuts = np.searchsorted(values >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
                for bucket in range(1 << bits):
                    s = slice(cuts[bucket], cuts[bucket + 1])
                    if s.stop > s.start:
                        steps = np.diff((values[s] & np.uint64(0xFFFFFFFF)).astype(np.uint32), prepend=np.uint32(0))
                        rows.append((bucket, block.name, packed(steps), packed(np.packbits(many[s]))))
                names = ["bucket", "block", "vals", "many"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names)

    return blocks.mapInArrow(run, "bucket int, block bigint, vals binary, many binary")


SHARED = "block bigint, bucket int, vals binary, n bigint"


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket: per run, the fingerprints that another document has, too."""
    runs = [np.cumsum(unpacked(v, np.uint32), dtype=np.uint32) for v in table.column("vals")]
    values = np.concatenate(runs)
    shared = np.concatenate([np.unpackbits(unpacked(m, np.uint8), count=len(r)).astype(bool) for m, r in zip(table.column("many"), runs)])
    order = np.argsort(values, kind="stable")
    sorted_ = values[order]
    again = sorted_[1:] == sorted_[:-1]
    twice = np.concatenate([[False], again]) | np.concatenate([again, [False]])
    shared[order[twice]] = True
    ends = np.cumsum([len(r) for r in runs])
    found = [r[shared[e - len(r) : e]] for e, r in zip(ends, runs)]
    replies = [packed(np.diff(f, prepend=np.uint32(0))) for f in found]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "vals": pa.array(replies, pa.binary()), "n": pa.array([len(f) for f in found], pa.int64())})


# Runs of strings

RUNS = "`range` int, block bigint, prefixes binary, tails binary, counts binary, whose binary, places binary, docs binary, ids binary"
_RUNS = pa.schema([("range", pa.int32()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("prefixes", "tails", "counts", "whose", "places", "docs", "ids")]])


def _candidates(block: Block, wanted: np.ndarray, length: int, bits: int) -> Iterator[np.ndarray]:
    """Places in a block whose strings may be found elsewhere, by the fingerprints that are."""
    for places, _, prints, change in block.strings(length):
        mine = prints[change] >> np.uint64(32 - bits)
        at = np.searchsorted(wanted, mine)
        hit = np.zeros(len(mine), bool)
        fine = at < len(wanted)
        hit[fine] = wanted[at[fine]] == mine[fine]
        yield places[hit[np.cumsum(change) - 1]]


def _run_rows(block: Block, where: np.ndarray, length: int, splitters: np.ndarray) -> Iterator[tuple[object, ...]]:
    """Sorted strings of some places of a block as a run per range; what the block itself shows to be repeated has range -1."""
    begin = np.concatenate([[0], np.cumsum(block.size, dtype=np.int64)])
    part = np.searchsorted(begin, where, side="right") - 1
    doc, place = block.doc[part], (block.start[part] + where - begin[part]).astype(np.int32)
    # Parts stand by document, and the sort of strings is stable, so the least document leads its equals.
    rows = np.empty((len(where), length + 1), np.uint8)
    rows[:, :length] = sliding_window_view(block.data, length)[where]
    rows[:, length] = 1  # so that no string ends in zeros, which numpy drops
    flat = rows.view(f"S{length + 1}").ravel()
    # Sorted by the first bytes as numbers; what is left for whole strings is nearly in order.
    head = np.zeros((len(where), 8), np.uint8)
    head[:, : min(8, length)] = rows[:, : min(8, length)]
    order = np.argsort(head.view(">u8").ravel().astype(np.uint64), kind="stable")
    order = order[np.argsort(flat[order], kind="stable")]
    rows, flat = rows[order, :length], flat[order]
    doc, place = doc[order].astype(np.int32), place[order]
    prefixes = common_prefixes(rows)
    starts = np.flatnonzero(np.concatenate([[True], prefixes[1:] < length]))
    group = np.cumsum(np.concatenate([[0], (prefixes[1:] < length).astype(np.int64)]))
    least = block.ids[doc[starts]]
    later = block.ids[doc] > least[group]

    number = np.zeros(len(block.ids), np.int32)

    def owners(chosen: np.ndarray) -> tuple[bytes, ...]:
        mine = doc[chosen]
        held = np.unique(mine) if len(mine) * 8 < len(number) else np.flatnonzero(np.bincount(mine, minlength=len(number)))
        number[held] = np.arange(len(held), dtype=np.int32)
        return packed(number[mine]), packed(place[chosen]), packed(_steps(held.astype(np.int32))), packed(_steps(block.ids[held]))

    if later.any():
        yield (-1, block.name, b"", b"", b"", *owners(np.flatnonzero(later)))
    counts = np.bincount(group[~later], minlength=len(starts)).astype(np.int32)
    rows, prefixes = rows[starts], prefixes[starts]
    cuts = np.concatenate([[0], np.searchsorted(flat[starts], splitters), [len(starts)]])
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    # Every range decodes its part alone.
    prefixes[cuts[full]] = 0
    added = np.concatenate([[0], np.cumsum(length - prefixes.astype(np.int64))])
    kept = np.flatnonzero(~later)
    upto = np.concatenate([[0], np.cumsum(counts)])
    # Coded for several ranges at a time.
    for first, last in _grouped((cuts[1:] - cuts[:-1])[full], AT_ONCE):
        low = cuts[full[first]]
        tails = front_coded(rows[low : cuts[full[last - 1] + 1]], prefixes[low : cuts[full[last - 1] + 1]])
        for k in full[first:last]:
            a, b = cuts[k], cuts[k + 1]
            mine = tails[added[a] - added[low] : added[b] - added[low]]
            yield (int(k), block.name, packed(prefixes[a:b]), packed(mine), packed(counts[a:b]), *owners(kept[upto[a] : upto[b]]))


def _runs(blocks: DataFrame, length: int, bits: int, splitters: np.ndarray) -> DataFrame:
    ranges = len(splitters) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                replies = sorted((m["bucket"], m["vals"]) for m in batch.column(8)[i].as_py())
                wanted = np.concatenate([np.uint64(k << 32) + np.cumsum(np.frombuffer(_coders()[1].decompress(v), np.uint32), dtype=np.uint64) for k, v in replies])
                held: list[np.ndarray] = []
                n = 0

                def out() -> Iterator[pa.RecordBatch]:
                    rows: list[tuple[object, ...]] = []
                    size = 0
                    for row in _run_rows(block, np.concatenate(held), length, splitters):
                        # What is settled passes through the same exchange, spread over numbers below 0.
                        rows.append((row[0] if row[0] >= 0 else -1 - block.name % ranges, *row[1:]))
                        size += sum(len(v) for v in row[2:])
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RUNS)], schema=_RUNS)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RUNS)], schema=_RUNS)

                for where in _candidates(block, wanted, length, bits):
                    held.append(where)
                    n += len(where)
                    if n >= RUN:
                        yield from out()
                        held, n = [], 0
                if n:
                    yield from out()

    return blocks.mapInArrow(run, RUNS)


HITS = "block bigint, docs binary, places binary"


def merged_range(table: pa.Table, length: int) -> pa.Table:
    """The places of a range's strings that a document with a smaller id has, too: by block and document in it."""
    blocks = table.column("block").to_pylist()
    docs, ids, place = [], [], []
    for i in range(table.num_rows):
        numbers = unpacked(table.column("whose")[i], np.int32)
        docs.append(np.cumsum(unpacked(table.column("docs")[i], np.int32))[numbers].astype(np.int32))
        ids.append(np.cumsum(unpacked(table.column("ids")[i], np.int64))[numbers])
        place.append(unpacked(table.column("places")[i], np.int32))
    ends = np.cumsum([len(p) for p in place])
    hit = np.ones(ends[-1], bool)
    if table.column("range")[0].as_py() >= 0:
        prefixes, tails, counts = ([unpacked(v, kind) for v in table.column(name)] for name, kind in (("prefixes", np.uint8), ("tails", np.uint8), ("counts", np.int32)))
        rows = decoded_rows(np.concatenate(prefixes), np.concatenate(tails), length)
        del tails
        upto = np.cumsum([0] + [len(p) for p in prefixes])
        which, shared = (np.array(c) for c in merge_runs([(rows[a:b], p) for a, b, p in zip(upto[:-1], upto[1:], prefixes)], length))
        del rows
        each = np.concatenate(counts).astype(np.int64)
        first_place = np.concatenate([[0], np.cumsum(each)])
        # The strings of a run come out in their own order.
        string = np.empty(len(which), np.int64)
        string[np.argsort(which.astype(np.uint16 if len(prefixes) < 1 << 16 else np.int64), kind="stable")] = np.arange(len(which))
        starts = np.flatnonzero(shared < length)
        # All places of a string in a run are of one document.
        doc = np.concatenate(ids)[first_place[string]]
        least = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.concatenate([starts, [len(doc)]])))
        later = np.zeros(len(each), bool)
        later[string[doc > least]] = True
        hit = np.repeat(later, each)
    rows = []
    for i, end in enumerate(ends):
        mine = hit[end - len(place[i]) : end]
        if mine.any():
            rows.append((blocks[i], packed(docs[i][mine]), packed(place[i][mine])))
    names = ["block", "docs", "places"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.binary(), pa.binary()))], names)


SPANS = "array<struct<starts:int,ends:int>>"
_SPANS = pa.list_(pa.struct([("starts", pa.int32()), ("ends", pa.int32())]))


def united(starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    """Runs of bytes, those that touch as one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(new)]]) - 1
    return [{"starts": s, "ends": e} for s, e in zip(starts[new].tolist(), reach[last].tolist())]


def _hit_spans(hits: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """The places found of a block's documents as runs of bytes per document; a block has no more places than bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, tags = (batch.column(c)[i].values for c in (0, 1))
                found = batch.column(2)[i].values
                docs, places = (np.concatenate([unpacked(v, np.int32) for v in found.field(name)]) for name in ("docs", "places"))
                order = np.lexsort((places, docs))
                docs, places = docs[order], places[order].astype(np.int64)
                starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
                made = [united(p, p + length) for p in np.split(places, starts[1:])]
                which = pa.array(docs[starts].astype(np.int64))
                yield pa.RecordBatch.from_arrays([ids.take(which), tags.take(which), pa.array(made, _SPANS)], ["doc_id", "tag", "spans"])

    gathered = hits.groupBy("block").agg(F.collect_list(F.struct("docs", "places")).alias("found"))
    return gathered.join(blocks.select("block", "ids", "tags"), "block").select("ids", "tags", "found").mapInArrow(run, f"doc_id bigint, tag bigint, spans {SPANS}")


# The whole


def _join_docs(docs: DataFrame, told: DataFrame, sizes: str) -> DataFrame:
    """Documents with what is told of them; broadcast only if its measured bytes are few."""
    total = told.agg(F.sum(F.expr(sizes) + 32)).first()[0] or 0
    return docs.join(F.broadcast(told) if total <= BROADCAST_BYTES else told, ["doc_id", "tag"], "left")


def _armed(blocks: DataFrame, replies: DataFrame, path: str, scratch: list[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks with the fingerprints that others share, without a shuffle of their text; and the blocks as they are stored now.

    Replies of up to ``BROADCAST_BYTES`` are broadcast. More are broadcast for some files of blocks at a time, which are stored
    anew with them and removed; a block without a reply has no shared string, and ends here.
    """
    spark = blocks.sparkSession
    names = [*[c.split()[0] for c in BLOCKS.split(", ")], "replies"]
    # One number per block of some megabytes.
    sizes = dict(replies.select("block", F.expr("aggregate(replies, 0L, (t, m) -> t + octet_length(m.vals) + 24)")).collect())
    if not sizes or sum(sizes.values()) <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(replies), "block").select(*names), blocks
    files: dict[str, list[int]] = {}
    for name, block in blocks.select(F.col("_metadata.file_name"), "block").collect():
        files.setdefault(name, []).append(block)
    chosen = sorted(files)
    target = scratch_path(spark, "armed")
    scratch.append(target)
    for a, b in _grouped(np.array([sum(sizes.get(k, 0) for k in files[f]) for f in chosen]), BROADCAST_BYTES):
        paths = [f"{path}/{f}" for f in chosen[a:b]]
        mine = replies.filter(F.col("block").isin([k for f in chosen[a:b] for k in files[f] if k in sizes]))
        some = spark.read.schema(BLOCKS).parquet(*paths).join(F.broadcast(mine), "block").select(*names)
        some.write.mode("append").option("maxRecordsPerFile", BLOCKS_A_FILE).option("compression", "zstd").parquet(target)
        release(spark, paths)
    stored = spark.read.schema(StructType([*blocks.schema, replies.schema["replies"]])).parquet(target)
    return stored, stored


def _settle(spark: SparkSession, scratch: list[str]) -> None:
    """Remove what is stored in ``scratch``, and have Spark remove the shuffle files of plans that are out of use.

    It does so only when the driver's garbage is collected; until then every step would keep the disk of all before.
    """
    release(spark, scratch)
    gc.collect()
    spark._jvm.System.gc()


def _removed(docs: DataFrame, length: int, scratch: list[str]) -> DataFrame:
    """Per document (``doc_id``, ``tag``): the maximal runs of bytes that go, as ``spans`` of ``starts`` and ``ends``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    bits = max(2, math.ceil(math.log2(max(1, total * 0.08 / FOLD))))
    pieces: list[str] = []
    known = staged(_known(docs, length, pieces), "known", scratch)
    _settle(spark, pieces)
    path = scratch_path(spark, "blocks")
    scratch.append(path)
    ranges = min(MOST_RANGES, max(2, math.ceil(total * 0.06 / RANGE)))
    packs = _blocks(_join_docs(docs, known, "8 * size(spans)"), length, ranges * SAMPLES / max(1, total))
    packs.write.option("maxRecordsPerFile", BLOCKS_A_FILE).option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    told = _prints(blocks, length, bits).groupBy("bucket").applyInArrow(_shared, SHARED)
    replies = staged(told.filter("n > 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "vals")).alias("replies")), "replies", scratch)
    del told, packs
    # Bounded: about SAMPLES strings for each of at most MOST_RANGES ranges.
    drawn = b"".join(bytes(r[0]) for r in blocks.select("drawn").collect())
    strings = np.sort(np.array([drawn[k : k + length] + b"\x01" for k in range(0, len(drawn), length)], f"S{length + 1}"))
    splitters = np.unique(strings[:: max(1, len(strings) // ranges)][1:])

    armed, blocks = _armed(blocks, replies, path, scratch)
    _settle(spark, [])

    def merge(table: pa.Table) -> pa.Table:
        return merged_range(table, length)

    hits = _runs(armed, length, bits, splitters).groupBy("range").applyInArrow(merge, HITS)
    reached = F.transform("spans", lambda s: F.struct(s["starts"].alias("starts"), (s["ends"] + length - 1).alias("ends")))
    parts = known.select("doc_id", "tag", reached.cast(SPANS).alias("spans")).unionByName(_hit_spans(hits, blocks, length))
    whole = parts.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            sides = [spans.flatten().field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("starts", "ends")]
            cuts = np.cumsum([len(s) for s in spans])[:-1]
            made = [united(a, b) for a, b in zip(*(np.split(side, cuts) for side in sides))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, _SPANS)], ["doc_id", "tag", "spans"])

    return whole.mapInArrow(join, f"doc_id bigint, tag bigint, spans {SPANS}")


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents without the passages that a document with a smaller ``doc_id`` holds, too.

    Texts are UTF-8 bytes. A byte goes if any string of ``length`` bytes that covers it starts in a document with a smaller id as well, judged
    on the texts as they are. Gives ``doc_id``, the columns ``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``removed`` (the maximal runs that go, as
    ``starts`` and ``ends``) and ``kept``: the remaining bytes, which may not be whole characters at their seams.

    Null texts are empty; texts shorter than ``length`` stay. A document without an id is neither smaller nor greater than others, and stays. Rows
    with equal ids are one document's: they take nothing from each other. Empty tables give no rows; other columns are not read.
    """
    if length < 4:
        raise ValueError("strings of at least 4 bytes")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    taken = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), data.alias("data"), *[F.col(f"`{c}`") for c in keep])
    searched = taken.filter(F.col("doc_id").isNotNull() & (F.octet_length("data") >= length)).select("doc_id", "tag", "data")
    scratch: list[str] = []
    removed = staged(_removed(searched, length, scratch), "removed")
    _settle(docs.sparkSession, scratch)
    told = _join_docs(taken, removed, "8 * size(spans)")
    told = told.withColumns({"_n": F.octet_length("data"), "removed": F.coalesce("spans", F.array().cast("array<struct<starts:int,ends:int>>"))})
    # What stays lies between the end of one run and the start of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["ends"]))
    stops = F.concat(F.transform("removed", lambda s: s["starts"]), F.array("_n"))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), stops.alias("e")), lambda p: F.hex(F.substring(F.col("data"), p["b"] + 1, p["e"] - p["b"])))
    kept = F.when(F.size("removed") == 0, F.col("data")).otherwise(F.unhex(F.array_join(pieces, "")))
    return told.select(
        "doc_id", *[F.col(f"`{c}`") for c in keep], F.col("_n").cast("bigint").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["ends"] - s["starts"]).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), "removed", kept.alias("kept"),
    )
