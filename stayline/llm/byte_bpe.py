"""Byte-level BPE encoding and decoding by rank files, on length-bucketed padded numpy matrices.

A text is split by the rank file's pattern; each match (a piece) is encoded on its own. A piece that is itself a
token is that token. The others are grouped by byte length into buckets; a bucket is a matrix, a padded piece beside
the other, holding the ranks of its current parts. Every round, each piece merges its leftmost pair of minimum rank:
the ranks of adjacent pairs are kept in a second matrix, found in a hash table of all pairs whose bytes join to a
token, and after a merge only the two pairs beside it are looked up again. A merged part stays at the place of its
first byte, and links lead to the parts beside it. When half of the cells are idle, finished pieces leave the matrix,
the parts of the others move together and the width shrinks to the longest piece still merging (compaction). This is
the merge rule of the rank-file libraries, so ids equal theirs.

Decoding gathers the bytes of each id from one buffer of all tokens.

Defined results: a null text is empty (no tokens, empty bytes); empty and very long texts are encoded whole; repeated
rows are encoded again; columns other than ``doc_id`` and the text are not read, so clashing extra columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import repeat
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import slices, table, worker_store

RANKS = "byte_bpe_multi_50k.tiktoken"
SLICE = 1 << 20
#: A worker keeps the ids of pieces up to this many bytes, in up to this much memory.
CACHED_PIECE = 64
CACHE_BYTES = 32 << 20
#: Memory of a cached piece beside its own and its ids.
CACHE_ENTRY = 160
#: Cells of a matrix of pieces, if it has more than one row.
CELLS = 1 << 18
#: Values gathered at once, if they are of more than one list.
BLOCK = 1 << 15
#: Rank of a pair that joins to no token.
NONE = np.int32(2**31 - 1)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class PairTable:
    """Open addressing over int64 keys ``a << shift | b`` of two ranks whose bytes join to a token; value: its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.shift = max(1, max(ranks.values()).bit_length())
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append((a << self.shift) | b)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys) + 1).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        self.longest = 0
        slots = self._slots(np.array(keys, np.int64)) if keys else []
        for key, value, slot in zip(keys, values, slots, strict=True):
            slot, probe = int(slot), 0
            while self.keys[slot] != -1 and self.keys[slot] != key:
                slot, probe = (slot + 1) & self.mask, probe + 1
            self.keys[slot], self.values[slot] = key, value
            self.longest = max(self.longest, probe)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (a, b); ``NONE`` where there is none or either side is padding (-1)."""
        key = (a.astype(np.int64) << self.shift) | b  # negative with padding, as no key held but that of empty slots
        slot = self._slots(key)
        held = self.keys[slot]
        out = np.where(held == key, self.values[slot], NONE)
        pending = np.nonzero((held != key) & (held != -1) & (key >= 0))[0]
        for _ in range(self.longest):
            if not len(pending):
                break
            slot[pending] = next_slot = (slot[pending] + 1) & self.mask
            held, wanted = self.keys[next_slot], key[pending]
            hit = held == wanted
            out[pending[hit]] = self.values[next_slot[hit]]
            pending = pending[~hit & (held != -1)]
        return out


class IdLists:
    """Lists of ids in one array: list i is ``flat[starts[i] : starts[i] + counts[i]]``."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        self.flat, self.starts, self.counts = flat, starts, counts

    @classmethod
    def empty(cls, lists: int = 0) -> IdLists:
        return cls(np.zeros(0, np.int32), np.zeros(lists, np.int64), np.zeros(lists, np.int64))

    def __len__(self) -> int:
        return len(self.starts)

    def __iter__(self) -> Iterator[np.ndarray]:
        return (self.flat[start : start + count] for start, count in zip(self.starts, self.counts, strict=True))

    def take(self, lists: np.ndarray) -> IdLists:
        counts = self.counts[lists]
        return IdLists(gather(self.flat, self.starts[lists], counts), np.cumsum(counts) - counts, counts)

    def plus(self, other: IdLists) -> IdLists:
        join = np.concatenate
        return IdLists(join([self.flat, other.flat]), join([self.starts, other.starts + len(self.flat)]), join([self.counts, other.counts]))


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], split: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(split)
        self.pairs = PairTable(ranks)
        self.byte_rank = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte_rank[token[0]] = rank
        #: Rank of each pair of bytes, at first byte * 256 + second byte.
        self.byte_pairs = self.pairs.lookup(np.repeat(self.byte_rank, 256), np.tile(self.byte_rank, 256))
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        order = sorted(ranks.items(), key=lambda item: item[1])
        for token, rank in order:
            lengths[rank] = len(token)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.lengths = lengths
        buffer = bytearray(int(lengths.sum()))
        for token, rank in order:
            buffer[self.starts[rank] : self.starts[rank] + len(token)] = token
        self.buffer = np.frombuffer(bytes(buffer), np.uint8)
        #: Place of a cached piece in ``known``; ``uses`` and ``sizes`` (bytes of memory) go by the same places.
        self.cache: dict[str, int] = {}
        self.known = IdLists.empty()
        self.uses = self.sizes = np.zeros(0, np.int64)

    # -- merges ---------------------------------------------------------------------------------------------------

    def merge_rows(self, pieces: list[bytes]) -> IdLists:
        """Ids of pieces of one length bucket: one padded matrix, one merge per piece and round.

        A piece is a column of the matrices, so that the least pair of all pieces is one pass over contiguous rows.
        ``pair`` holds rank and place of the left part in one number: its minimum is the leftmost pair of minimum rank.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        singles = self.byte_rank[data]
        if (singles < 0).any():
            raise ValueError("the rank file has no token for some single byte")
        width, rows = int(sizes.max()), np.arange(len(pieces))
        row = np.repeat(rows, sizes)
        place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        shift = width.bit_length()
        kind = np.int32 if self.pairs.shift + shift <= 30 else np.int64
        stop, low = np.iinfo(kind).max, (1 << shift) - 1
        parts = np.full((width + 1, len(pieces)), -1, np.int32)  # the last place stays empty: beside either end
        parts[place, row] = singles
        pair = np.full((width + 1, len(pieces)), stop, kind)
        rank = self.byte_pairs[(data[:-1].astype(np.int64) << 8) | data[1:]]
        real = np.nonzero((rank != NONE) & (place[1:] > 0))[0]
        pair[place[real], row[real]] = (rank[real].astype(kind) << shift) | place[real]
        after, before = links(width, len(pieces))
        out, where = IdLists.empty(), []
        while True:
            least = pair[:width].min(axis=0, initial=stop)
            going = np.nonzero(least != stop)[0]
            longest = int(sizes[going].max(initial=0))
            if 2 * len(going) * longest <= len(rows) * width:  # finished pieces leave, the others move together
                over = np.nonzero(least == stop)[0]
                ids = parts[:width, over].T
                counts = (ids >= 0).sum(axis=1)
                out = out.plus(IdLists(ids[ids >= 0], np.cumsum(counts) - counts, counts))
                where.append(rows[over])
                if not len(going):
                    break
                parts, pair = parts[:width, going], pair[:width, going]
                old, row = np.nonzero(parts >= 0)
                place = (np.cumsum(parts >= 0, axis=0) - 1)[old, row]
                ids, ranks = parts[old, row], pair[old, row]
                rows, sizes, width = rows[going], sizes[going], longest
                parts = np.full((width + 1, len(rows)), -1, np.int32)
                parts[place, row] = ids
                pair = np.full((width + 1, len(rows)), stop, kind)
                pair[place, row] = np.where(ranks == stop, stop, (ranks & ~low) | place)
                after, before = links(width, len(rows))
                continue
            least, stride = least[going], len(rows)
            at, rank = (least & low).astype(np.int64), (least >> shift).astype(np.int32)
            here = at * stride + going
            gone = after.ravel()[here] * stride + going
            right, left = after.ravel()[gone], before.ravel()[here]
            behind, ahead = right * stride + going, left * stride + going
            parts.ravel()[here], parts.ravel()[gone], pair.ravel()[gone] = rank, -1, stop
            after.ravel()[here], before.ravel()[behind] = right, at
            beside = np.concatenate([parts.ravel()[behind], parts.ravel()[ahead]])
            found = self.pairs.lookup(np.concatenate([rank, beside[len(rank) :]]), np.concatenate([beside[: len(rank)], rank]))
            found = np.where(found == NONE, stop, (found.astype(kind) << shift) | np.concatenate([at, left]))
            pair.ravel()[here], pair.ravel()[ahead] = found[: len(rank)], found[len(rank) :]
            sizes[going] -= 1
        return out.take(np.argsort(np.concatenate(where)))

    def encode_pieces(self, pieces: list[bytes]) -> IdLists:
        """Ids of pieces, in their order; pieces that are tokens take no merge."""
        ranks = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int32, len(pieces))
        whole = np.nonzero(ranks >= 0)[0]
        out, where = IdLists(ranks[whole], np.arange(len(whole)), np.ones(len(whole), np.int64)), [whole]
        buckets: dict[int, list[int]] = {}
        for at in np.nonzero(ranks < 0)[0].tolist():
            buckets.setdefault(max(0, len(pieces[at]) - 1).bit_length(), []).append(at)
        for width, bucket in buckets.items():
            rows = max(1, CELLS >> width)
            for start in range(0, len(bucket), rows):
                members = bucket[start : start + rows]
                out = out.plus(self.merge_rows([pieces[m] for m in members]))
                where.append(np.array(members, np.int64))
        return out.take(np.argsort(np.concatenate(where)))

    def encode_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the offsets of each text's ids (one more than texts)."""
        pieces: list[str] = []
        bounds = [0]
        for text in texts:
            pieces.extend(self.split.findall(text or ""))
            bounds.append(len(pieces))
        used = np.fromiter(map(self.cache.get, pieces, repeat(-1)), np.int64, len(pieces))
        missed = np.nonzero(used < 0)[0]
        fresh: dict[str, int] = {}
        used[missed] = [len(self.cache) + fresh.setdefault(pieces[at], len(fresh)) for at in missed.tolist()]
        encoded = [piece.encode("utf-8") for piece in fresh]
        lists = self.known.plus(self.encode_pieces(encoded))
        ids = gather(lists.flat, lists.starts[used], lists.counts[used])
        ends = np.concatenate([[0], np.cumsum(lists.counts[used])])
        self.remember(fresh, encoded, lists, np.bincount(used, minlength=len(lists)))
        return ids, ends[np.array(bounds, np.int64)]

    def remember(self, fresh: dict[str, int], encoded: list[bytes], lists: IdLists, uses: np.ndarray) -> None:
        """Adds the fresh pieces to the cache; when it is full, the pieces used most stay in half of its memory."""
        held = len(self.cache)
        memory = np.fromiter(map(getsizeof, fresh), np.int64, len(fresh)) + lists.counts[held:] * lists.flat.itemsize + CACHE_ENTRY
        short = np.fromiter(map(len, encoded), np.int64, len(encoded)) <= CACHED_PIECE
        sizes, uses = np.concatenate([self.sizes, memory]), np.concatenate([self.uses, np.zeros(len(fresh), np.int64)]) + uses
        stay = np.concatenate([np.arange(held), held + np.nonzero(short)[0]])
        full = sizes[stay].sum() > CACHE_BYTES
        if full:
            stay = stay[np.argsort(-uses[stay], kind="stable")]
            stay = stay[np.cumsum(sizes[stay]) <= CACHE_BYTES // 2]
            uses = uses // 2  # so that pieces of long ago make room
        names = [*self.cache, *fresh] if full else list(fresh)
        added = stay if full else stay[held:] - held
        self.cache = {} if full else self.cache
        self.cache.update(zip([names[at] for at in added.tolist()], range(len(self.cache), len(stay)), strict=True))
        self.known = lists.take(stay) if full else self.known.plus(lists.take(stay[held:]))
        self.sizes, self.uses = sizes[stay], uses[stay]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or (self.lengths[ids] == 0).any()):
            raise ValueError("an id that is no token of the rank file")
        return gather(self.buffer, self.starts[ids], self.lengths[ids]).tobytes()


def links(width: int, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """Place after and place before each place of each piece; before the first one is the empty last one."""
    after = np.repeat(np.arange(1, width + 2)[:, None], pieces, axis=1)
    before = np.repeat(np.arange(-1, width)[:, None], pieces, axis=1)
    before[0] = width
    return after, before


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[0]:starts[0]+lengths[0]] + values[starts[1]:...] + ..., in blocks whose places stay in the CPU's cache."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.empty(total, values.dtype)
    shift, done, first = starts - (ends - lengths), 0, 0
    while done < total:
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        to = int(ends[last - 1])
        out[done:to] = values[np.arange(done, to) + np.repeat(shift[first:last], lengths[first:last])]
        done, first = to, last
    return out


def codec(path: str) -> Codec:
    """The worker's codec of a rank file, built once."""
    kept = worker_store()
    key = ("byte bpe", path)
    if key not in kept:
        kept[key] = Codec(read_ranks(path), pattern())
    return kept[key]


def encode(docs: DataFrame, path: str | None = None, column: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array<int>) of each row of ``docs``; a null text has no ids. No shuffle."""
    path = path or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches, "text", SLICE):
            ids, offsets = coder.encode_texts(batch.column("text").to_pylist())
            listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), listed], ["doc_id", "ids"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))
    return read.mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and ``decoded`` (the bytes of the ids) of each row; null ids decode to empty bytes."""
    path = path or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            ids, offsets = flat_lists(batch.column("ids"))
            data = coder.decode(ids)
            byte_ends = np.concatenate([[0], np.cumsum(coder.lengths[ids])]).astype(np.int64)[offsets]
            out = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(byte_ends.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), out], ["doc_id", "ids", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (int64) and offsets of a list column; a null list has no values."""
    column = pa.compute.fill_null(column, pa.scalar([], column.type))
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.int64)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lowercase hex SHA-256 of each row's ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        ids, offsets = flat_lists(batch.column("ids"))
        raw = ids.astype("<u4").tobytes()
        digests = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(digests), batch.column("decoded_sha256")],
                                         ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = decode(encode(table(spark, folder, "documents")))
    measured = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return measured.mapInArrow(ids_digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
