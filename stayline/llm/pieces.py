"""SentencePiece encoding and decoding with one automaton over the pieces.

An Aho-Corasick automaton reports, at every position of a text, the pieces that end there, longest first along its
output links. A single pass over these matches relaxes the best path to each position:

* for a unigram model the path's score is the sum of its pieces' scores;
* for a BPE model a path is allowed if each two neighbours are what the merges would leave of their joint text.
  Exactly one allowed path reaches each position and it is the merges' own result, so the first allowed match wins.

No piece reaches from another character into the white-space mark, so a text is the sequence of its marked words, and
a bounded cache in each worker keeps the path of words that it has met.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from stayline.llm.common import slices, table, worker_store

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: A character without a piece scores so much less than the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Words in a worker's cache, in each of two generations; longer words are not kept.
CACHE, LONGEST = 250_000, 64
SLICE = 2 << 20


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields (number, value) of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = 4 if kind == 5 else 8
            if kind == 2:
                size, at = varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """Pieces (text, score, type) by id and the settings of a model file."""

    pieces: list[tuple[str, float, int]]
    bpe: bool
    dummy_prefix: bool
    squeeze_spaces: bool


def load_model(path: str | None = None, data: bytes | None = None) -> PieceModel:
    """A unigram or BPE model with byte fallback and without a character map; others raise ValueError."""
    if data is None:
        with open(path or model_path(), "rb") as file:
            data = file.read()
    pieces, kind, prefix, squeeze, escape, charmap = [], 1, True, True, True, b""
    for number, value in _message(data):
        if number == 1:
            own = dict(_message(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_message(value)).get(3, 1)
        elif number == 3:
            own = dict(_message(value))
            charmap, prefix, squeeze, escape = own.get(2, b""), own.get(3, 1), own.get(4, 1), own.get(5, 1)
    kinds = {k for _, _, k in pieces}
    if kind not in (1, 2) or not escape or charmap or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds:
        raise ValueError("only unigram and BPE models with byte fallback and identity normalisation are supported")
    return PieceModel(pieces, kind == 2, bool(prefix), bool(squeeze))


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        self.ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        self.bytes = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.score = [s for _, s, _ in model.pieces]
        self.size = [len(text) for text, _, _ in model.pieces]
        self.unknown = min(self.score[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        if any(MARK in text.lstrip(MARK) for text in self.ids):
            raise ValueError("a piece reaches from another character into the white-space mark")
        inner = set("".join(text for text in self.ids if len(text) > 1))
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inner)
        self.words = re.compile((f"[{alone}]|" if alone else "") + f"{MARK}*[^{MARK}{alone}]+|{MARK}+")
        self.allowed: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        out = []
        for text, _, kind in model.pieces:
            out.append(bytes([int(text[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else text.replace(MARK, " ").encode() if kind == NORMAL else " ⁇ ".encode())
        self.plain = out

    def halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces of a piece's last merge; (-1, -1) for a single character, None if merges never make it."""
        known = self.split.get(piece, 0)
        if known == 0:
            parts, last = list(self.model.pieces[piece][0]), (-1, -1)
            while True:
                found = [(self.score[i], -at) for at in range(len(parts) - 1) if (i := self.ids.get(parts[at] + parts[at + 1])) is not None]
                if not found:
                    break
                at = -max(found)[1]
                last = self.ids.get(parts[at], -1), self.ids.get(parts[at + 1], -1)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.split[piece] = last if len(parts) == 1 else None
        return known

    def neighbours(self, a: int, b: int) -> bool:
        """``beside`` with a bounded memory of earlier answers."""
        key = (a << 20) + b
        known = self.allowed.get(key)
        if known is None:
            if len(self.allowed) > 2 * CACHE:
                self.allowed.clear()
            known = self.allowed[key] = self.beside(a, b)
        return known

    def beside(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side; ``a`` is -1 at the start and behind an unknown character.

        The merges that made the two are undone from the last to the first. They stay apart if at no time a merge
        over their border was due before the merge that is undone next; of equal merges the left one is due first.
        """
        right = self.halves(b)
        if right is None or a < 0:
            return right is not None
        left, text, due = self.halves(a), self.model.pieces, np.inf
        while True:
            joint = self.ids.get(text[a][0] + text[b][0])
            if joint is not None and -self.score[joint] < due:
                return False
            first, second = left[0] >= 0, right[0] >= 0
            if not first and not second:
                return True
            if first and (not second or self.score[a] < self.score[b]):
                due = -self.score[a]
                a = left[1]
                left = self.halves(a)
            else:
                due = -self.score[b] + 0.5
                b = right[0]
                right = self.halves(b)

    def _path(self, word: str) -> list[int]:
        """Pieces of one marked word, -1 for an unknown character."""
        n, size = len(word), self.size
        last = [-2] * (n + 1)  # piece that ends here; -2: none so far
        if self.model.bpe:
            last[0], at, known, keep = -1, 1, self.allowed, self.neighbours
            for end, piece in self.automaton.iter(word):
                end += 1
                while at < end:
                    if last[at] == -2:
                        last[at] = -1
                    at += 1
                if last[end] == -2:
                    before = last[end - size[piece]]
                    if before != -2:
                        allowed = known.get((before << 20) + piece)
                        if allowed or allowed is None and keep(before, piece):
                            last[end] = piece
        else:
            best = [0.0] + [-np.inf] * n
            matches: dict[int, list[int]] = {}
            for end, piece in self.automaton.iter(word):
                matches.setdefault(end + 1, []).append(piece)
            for end in range(1, n + 1):
                single = False
                for piece in matches.get(end, ()):
                    single |= size[piece] == 1
                    score = best[end - size[piece]] + self.score[piece]
                    if score > best[end]:
                        best[end], last[end] = score, piece
                if not single and best[end - 1] + self.unknown > best[end]:
                    best[end], last[end] = best[end - 1] + self.unknown, -1
        path, end = [], n
        while end:
            piece = last[end] if last[end] != -2 else -1
            path.append(piece if piece >= 0 else -end)
            end -= size[piece] if piece >= 0 else 1
        return path[::-1]

    def word(self, word: str) -> bytes:
        """Ids of one marked word as packed 32-bit integers."""
        ids = array("i")
        for piece in self._path(word):
            if piece > 0 or piece == 0 and self.model.pieces[0][2] == NORMAL:
                ids.append(piece)
            else:
                ids.extend(self.bytes[b] for b in word[-piece - 1].encode("utf-8", "replace"))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if self.model.squeeze_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return b""
        words = self.words.findall(((MARK if self.model.dummy_prefix else "") + text).replace(" ", MARK))
        young = self.young
        for word in set(words):
            if word not in young:
                young[word] = self.old.get(word) or self.word(word)
        return b"".join(map(young.__getitem__, words))

    def trim(self) -> None:
        """Called between slices: keeps the cache bounded."""
        if len(self.young) > CACHE:
            self.young, self.old = {}, {w: v for w, v in self.young.items() if len(w) <= LONGEST}

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _codec(parts: tuple) -> Codec:
    """This worker's codec of a model, with the words that earlier tasks met."""
    key = ("pieces", hash(tuple(parts[0])), *parts[1:])
    if key not in worker_store():
        worker_store()[key] = Codec(PieceModel(*parts))
    return worker_store()[key]


ENCODED = [StructField("piece_ids", ArrayType(IntegerType(), False)), StructField("n_pieces", LongType()), StructField("round_trip", BooleanType())]


def encode(docs: DataFrame, model: PieceModel | None = None) -> DataFrame:
    """All columns of ``docs`` with piece_ids, n_pieces and round_trip (the ids decode to the text).

    A null text has no ids (an empty list) and round_trip null; an empty text has none and round_trip true. A text
    with the white-space mark itself, or with spaces that the model squeezes, doesn't decode to the same text. Columns
    of these three names are replaced. Repeated rows are encoded again. Texts of any length are one sequence.
    """
    model = model or load_model()
    shared = docs.sparkSession.sparkContext.broadcast((model.pieces, model.bpe, model.dummy_prefix, model.squeeze_spaces))
    names = {f.name for f in ENCODED}
    kept = [c for c in docs.columns if c not in names]
    read = docs.select(*[docs[c] for c in kept])
    fields = [f for f in read.schema.fields] + ENCODED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            packed, same = [], []
            for text in texts:
                ids = codec.encode(text or "")
                packed.append(ids)
                same.append(None if text is None else codec.decode(np.frombuffer(ids, np.int32).tolist()) == text)
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            offsets = np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes).astype(np.int32)))
            values = pa.array(np.frombuffer(b"".join(packed), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(sizes), pa.array(same, pa.bool_())], [*kept, *(f.name for f in ENCODED)])
            codec.trim()

    return read.mapInArrow(run, StructType(fields))


def decode(encoded: DataFrame, model: PieceModel | None = None) -> DataFrame:
    """All columns of ``encoded`` with ``decoded``: the text of ``piece_ids``; null where that is null."""
    model = model or load_model()
    shared = encoded.sparkSession.sparkContext.broadcast((model.pieces, model.bpe, model.dummy_prefix, model.squeeze_spaces))
    read = encoded.drop("decoded")
    kept = read.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, "decoded"])

    return read.mapInArrow(run, StructType(read.schema.fields + StructType().add("decoded", "string").fields))


def piece_codes(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces, round_trip of every document."""
    return encode(table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
