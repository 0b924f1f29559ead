"""Packing documents into fixed-length sequences: bounded-space online best-fit over a bitset of free spaces."""

import base64
import functools
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import materialise, ship_package, small_batches, texts

LENGTH = 1024
OPEN_BINS = 512
END_ID = 2
CACHE_PARTS = 400_000
#: How text is cut before merges: the fixed pattern of the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed value: the vocabulary's added token, which stands for itself wherever a text holds its string.
ADDED, ADDED_ID = "<|endoftext|>", 50256
#: Pieces that one task of the second round takes.
SECOND_ROUND = 500_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Tokens(dict):
    """Token ids of whole texts as little-endian unsigned 32-bit values.

    Merges never cross a space that stands alone between two other characters, so the parts of a text between
    such spaces are encoded one by one and remembered, up to a bounded number. A text with any other spacing
    is encoded in one go. The added token's string parts a text, and what lies between is encoded by itself.
    """

    def __init__(self, ranks_path):
        super().__init__()
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _packed(self, text):
        ids = self.encode(text)
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def __missing__(self, part):
        if len(self) >= CACHE_PARTS:
            self.clear()
        value = self[part] = self._packed(part)
        return value

    def of(self, text):
        if ADDED in text:
            return ADDED_ID.to_bytes(4, "little").join([self._plain(t) if t else b"" for t in text.split(ADDED)])
        return self._plain(text)

    def _plain(self, text):
        parts = text.split(" ")
        for p in parts:
            if not p or p[0].isspace() or p[-1].isspace():
                return self._packed(text)
        return self[parts[0]] + b"".join([self[" " + p] for p in parts[1:]])


class BestFit:
    """Open bins by free space: bit f of `free` is set while some open bin has f places left."""

    def __init__(self, length, open_bins, first_id):
        self.length, self.limit, self.next_id = length, open_bins, first_id
        self.free, self.bins, self.open = 0, [[] for _ in range(length + 1)], 0

    def place(self, size):
        """Bin and offset for `size` tokens: the open bin they fill best, or a new one."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(space)
        else:
            space, bin_id = self.length, self.next_id
            self.next_id += 1
        left = space - size
        if left:
            self.bins[left].append(bin_id)
            self.free |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        return bin_id, self.length - space

    def _take(self, space):
        stack = self.bins[space]
        bin_id = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.open -= 1
        return bin_id


    def left_open(self):
        """(bin, places filled) of the bins that are still open."""
        return [(bin_id, self.length - space) for space, stack in enumerate(self.bins) for bin_id in stack]


def _pack_batches(batches, ranks_path, length, open_bins):
    """Rows of PIECES; at the end one with piece -1 per sequence still open, its offset the places filled."""
    tokens, packer = Tokens(ranks_path), BestFit(length, open_bins, TaskContext.get().partitionId() << 40)
    end = END_ID.to_bytes(4, "little")
    names = [c.split()[0] for c in PIECES.split(", ")]
    for batch in batches:
        rows = []
        for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = (tokens.of(raw.decode("utf-8", "replace")) if raw else b"") + end
            total, start, piece = len(ids) // 4, 0, 0
            while start < total:
                size = (total - start) % length or length
                sequence, offset = packer.place(size)
                rows.append((doc, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), sequence, offset))
                start, piece = start + size, piece + 1
        yield _record(rows, names)
    yield _record([(None, -1, 0, 0, 0, sequence, filled) for sequence, filled in packer.left_open()], names)


def _record(rows, names):
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * (len(names) - 2)]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _again_batches(batches, length, open_bins):
    """Pieces as they come, each in a sequence and at a place of this round."""
    packer = BestFit(length, open_bins, (1 << 62) + (TaskContext.get().partitionId() << 40))
    for batch in batches:
        places = [packer.place(size) for size in batch.column("length").to_pylist()]
        sequence, offset = (pa.array(c, pa.int64()) for c in zip(*places, strict=True)) if places else (pa.array([], pa.int64()),) * 2
        kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays([*kept, sequence, offset], names=[c.split()[0] for c in PIECES.split(", ")])


def pack(docs, ranks_path, length=LENGTH, open_bins=OPEN_BINS):
    """Row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id. One longer than a sequence is cut into full pieces after a shorter
    first one; any other stays whole. Every task tokenizes its rows as they come and keeps at most `open_bins`
    sequences open, in a bitset keyed by free space: a piece goes where it leaves the least room, and beyond the
    bound the fullest sequence closes. No text is shuffled and no state grows. The pieces of the sequences that tasks
    leave open at their end, `open_bins` per task at most, are packed in a second round of the same kind, the longest
    first, SECOND_ROUND in a task. Sequence numbers hold the task's partition number, so they repeat when a task reruns
    on the same rows.

    Null or empty text: the end id alone. A null doc_id stays null; repeated rows are packed once each. An empty
    table gives an empty result; other columns are ignored. `ranks_path` is the vocabulary file on every executor.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    job = functools.partial(_pack_batches, ranks_path=ranks_path, length=length, open_bins=open_bins)
    packed = materialise(texts(docs).mapInArrow(job, PIECES))
    left_open = packed.where("piece = -1").select("sequence_id")
    pieces = packed.where("piece >= 0")
    loose = materialise(pieces.join(left_open, "sequence_id", "left_semi").select(pieces.columns))
    tasks = -(-loose.count() // SECOND_ROUND) or 1
    order = [F.desc("length"), "doc_id", "piece", "ids_crc32"]
    placed = loose.repartition(tasks, "doc_id", "piece", "ids_crc32").sortWithinPartitions(*order)
    again = functools.partial(_again_batches, length=length, open_bins=open_bins)
    closed = pieces.join(left_open, "sequence_id", "left_anti").select(pieces.columns)
    return closed.unionByName(placed.mapInArrow(again, PIECES))
