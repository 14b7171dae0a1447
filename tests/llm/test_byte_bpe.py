"""Byte-level BPE (op13) against the rank-file library itself, and its round trip."""

import hashlib

import numpy as np
import pytest

from stayline.llm import byte_bpe

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\n\t  "),
    (4, "日本語のテキストです" * 400),
    (5, "x" * 6000),
    (6, "<|endoftext|> special strings are plain text"),
    (7, "Ünïcödé wörds, numbers 1234567 and 'quotes' we'll've"),
    (8, "Ünïcödé wörds, numbers 1234567 and 'quotes' we'll've"),
    (8, "Ünïcödé wörds, numbers 1234567 and 'quotes' we'll've"),
    (9, "emoji 🙂🙃 and no-break line"),
]


def test_codec_equals_library_on_documents(library):
    import pyarrow.parquet as pq

    coder = byte_bpe.Codec(byte_bpe.read_ranks(byte_bpe.ranks_path()), byte_bpe.pattern())
    texts = pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist() + [t for _, t in ODD]
    ids, offsets = coder.encode_texts(texts)
    for at, text in enumerate(texts):
        mine = ids[offsets[at] : offsets[at + 1]]
        assert mine.tolist() == library.encode_ordinary(text or "")
        assert coder.decode(mine) == (text or "").encode()


def test_merge_rows_leftmost_minimum():
    # a tiny rank file: single bytes, then "ab" before "bc" before "abc"
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259}
    coder = byte_bpe.Codec(ranks, r"\S+|\s+")
    got = coder.merge_rows([b"abc", b"bcab", b"aaa", b"zzz"])
    assert [g.tolist() for g in got] == [[258], [257, 256], [259, 97], [122, 122, 122]]


def test_query_edges(spark, docs, library):
    frame = docs(*ODD)
    frame = frame.withColumn("ids", frame["doc_id"])  # a clashing extra column
    got = byte_bpe.decode(byte_bpe.encode(frame)).collect()
    assert len(got) == len(ODD)
    for (doc_id, text), row in zip(sorted(ODD, key=lambda r: r[0]), sorted(got, key=lambda r: r.doc_id), strict=True):
        assert row.doc_id == doc_id
        assert list(row.ids) == library.encode_ordinary(text or "")
        assert bytes(row.decoded) == (text or "").encode()


def test_registered_query(spark, library):
    rows = byte_bpe.byte_bpe(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == expected(library, texts[row.doc_id])


def test_memory_of_cache_and_matrices(monkeypatch):
    from sys import getsizeof

    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 200_000)
    coder = byte_bpe.Codec({bytes([b]): b for b in range(256)} | {b"00": 256, b"11": 257}, r"\S+|\s+")
    merge, cells = coder.merge_rows, []

    def seen(pieces):
        cells.append(len(pieces) * max(map(len, pieces)))
        return merge(pieces)

    monkeypatch.setattr(coder, "merge_rows", seen)
    for start in range(0, 6000, 3000):
        texts = [f"{i:07d}" for i in range(start, start + 3000)] + ["x" * 5000 + str(i) for i in range(start, start + 100)]
        ids, offsets = coder.encode_texts(texts)
        assert all(coder.decode(ids[a:b]) == t.encode() for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True))
        held = getsizeof(coder.cache) + sum(getsizeof(k) + getsizeof(v) for k, v in coder.cache.items())
        assert coder.cache and held <= byte_bpe.CACHE_BYTES
    assert max(cells) <= byte_bpe.CELLS


def test_calls_grow_with_rounds_not_with_pieces(library):
    import random
    import sys

    coder = byte_bpe.Codec(byte_bpe.read_ranks(byte_bpe.ranks_path()), byte_bpe.pattern())
    draw = random.Random(3)

    def calls(pieces):
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(1) if event in ("call", "c_call") else None)
        try:
            found = coder.merge_rows(pieces)
        finally:
            sys.setprofile(None)
        assert [x.tolist() for x in found] == [library.encode_ordinary(p.decode()) for p in pieces]
        return len(seen)

    words = ["".join(draw.choices("aeinrst", k=draw.randint(9, 16))).encode() for _ in range(2200)]
    assert calls(words[200:]) < 3 * calls(words[:200])


def test_frequent_pieces_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 100_000)
    coder = byte_bpe.Codec({bytes([b]): b for b in range(256)} | {b"aa": 256}, r"\S+|\s+")
    merge, merged = coder.merge_rows, []

    def seen(pieces):
        merged.extend(pieces)
        return merge(pieces)

    monkeypatch.setattr(coder, "merge_rows", seen)
    for start in range(0, 5000, 250):
        text = " ".join(f"often aab {i:05d}" for i in range(start, start + 250))
        ids, _ = coder.encode_texts([text, None, ""])
        assert coder.decode(ids) == text.encode()
    assert merged.count(b"often") == merged.count(b"aab") == 1
    assert len(merged) == 5002
