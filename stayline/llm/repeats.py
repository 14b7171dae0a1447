"""Removal of word sequences that occur more than once, by suffix automata of reference shards.

The reference is the corpus itself. To broadcast every shard of it to every document would cost shards times documents, so
a text's windows are led to the one shard that can hold their other occurrences: the window's least hash among
its n-grams, its anchor, is the same wherever the window stands. Windows whose anchor occurs once are done. The
stretches around each repeated anchor are one shard, in blocks of bounded size; a suffix automaton is built over a
block's stretches with the number of occurrences of each state, the stretches are streamed through it, and
where the longest match that occurs twice has the full length, its span is removed. An anchor of several blocks has
its windows compared over the blocks by digest as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Staged, row_key, slices, table
from stayline.llm.words import runs, words

#: Words of a window, and of the n-grams that anchor it.
LENGTH, ANCHOR = 35, 10
#: Distinct stretches of one anchor that make a block.
BLOCK = 2048
SLICE = 2 << 20
STRETCHES = "anchor long, row_key long, first int, windows int"
REPEATED = "anchor long, block int, content string, starts array<int>, ends array<int>"


def least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of every ``width`` consecutive values and the first place where it stands, in steps that double."""
    out, place, reach = values, np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left = out[: len(out) - step] <= out[step:]
        place = np.where(left, place[: len(place) - step], place[step:])
        out = np.where(left, out[: len(out) - step], out[step:])
        reach += step
    return out, place


def anchors(texts: pa.Array, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, anchor) of each run of consecutive windows that one occurrence of an anchor is in."""
    found = words(texts)
    bounds = found.bounds()
    n = len(found.hash)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, none
    anchor, place = least(runs(found.hash, gram), length - gram + 1)
    at = np.flatnonzero(bounds[1:][found.text[: n - length + 1]] - np.arange(n - length + 1) >= length)
    text, anchor, place = found.text[at], anchor[at], place[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    return text[starts], at[starts] - bounds[text[starts]], np.diff(np.append(starts, len(at))), anchor[starts].view(np.int64)


def _stretches(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            text, first, count, anchor = anchors(batch.column("text"), length, gram)
            key = batch.column("row_key").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(key), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], ["anchor", "row_key", "first", "windows"])

    return keyed.select("row_key", "text").mapInArrow(run, STRETCHES)


def _repeated_anchors(stretches: DataFrame) -> DataFrame:
    """Stretches whose anchor occurs again; rows come sorted and are streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, False  # the last row so far, and whether it has a fellow before it
        names = ["anchor", "row_key", "first", "windows"]
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(4)]
            if held:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
            same = np.concatenate(([before], columns[0][1:] == columns[0][:-1]))
            keep = same.copy()
            keep[:-1] |= same[1:]
            held, before = [c[-1:] for c in columns], bool(same[-1])
            keep[-1] = False
            chosen = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(c[chosen]) for c in columns], names)
        if held and before:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names)

    return stretches.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, STRETCHES)


class Automaton:
    """Suffix automaton of several sequences with the number of occurrences of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def _parent(self, state: int, symbol) -> int:
        """The state of exactly the strings of ``state`` with ``symbol`` behind them, split off if it holds longer ones."""
        target = self.next[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        own = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = own
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = own
            state = self.link[state]
        return own

    def add(self, sequence: list, times: int) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._parent(last, symbol)
            else:
                new, state = self._state(self.length[last] + 1, 0, {}), last
                while state >= 0 and symbol not in self.next[state]:
                    self.next[state][symbol] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._parent(state, symbol)
                last = new
            self.count[last] += times

    def finish(self) -> None:
        """Adds every state's occurrences to those of its suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, sequence: list, length: int) -> list[int]:
        """Where windows of ``length`` symbols start that the sequences have twice or more.

        Walks the sequence keeping the state of its longest suffix, and looks at the suffix of ``length`` symbols.
        """
        state = matched = 0
        found = []
        for at, symbol in enumerate(sequence):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol not in self.next[state]:
                continue
            state, matched = self.next[state][symbol], matched + 1
            while self.length[self.link[state]] >= length:
                state = self.link[state]
                matched = self.length[state]
            if matched >= length and self.count[state] > 1:
                found.append(at - length + 1)
        return found


def _ranges(starts: list[int]) -> tuple[list[int], list[int]]:
    """First and last of each run of consecutive numbers."""
    x = np.array(starts)
    cut = np.flatnonzero(np.diff(x) != 1)
    return x[np.concatenate(([0], cut + 1))].tolist(), x[np.append(cut, len(x) - 1)].tolist()


def _search_shards(contents: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each distinct stretch, by an automaton of each block of an anchor; a block at a time is held."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "block", "content", "starts", "ends"])

        for (anchor, block), group in groupby(rows(batches), key=lambda r: r[:2]):
            held = [(content, stretch.split(b" "), times) for _, _, content, stretch, times in group]
            if len(held) == 1:
                content, stretch, times = held[0]  # every state of its automaton occurs so often
                if times > 1:
                    out.append((anchor, block, content, [0], [len(stretch) - length]))
            else:
                shard = Automaton()
                for _, stretch, times in held:
                    shard.add(stretch, times)
                shard.finish()
                for content, stretch, _ in held:
                    if found := shard.repeated(stretch, length):
                        out.append((anchor, block, content, *_ranges(found)))
            if len(out) > 2000:
                yield batch()
                out = []
        if out:
            yield batch()

    keys = ["anchor", "block"]
    return contents.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, REPEATED)


def _search_blocks(contents: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the stretches of anchors with several blocks, compared by the windows' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, block, content, stretch, times in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                parts = stretch.split(b" ")
                for at in range(len(parts) - length + 1):
                    out.append((anchor, block, content, at, times, hashlib.blake2b(b" ".join(parts[at : at + length]), digest_size=16).digest()))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "block", "content", "at", "times", "window"])

    windows = contents.mapInArrow(run, "anchor long, block int, content string, at int, times long, window binary")
    often = windows.groupBy("window").agg(F.sum("times").alias("n")).where("n > 1").select("window")
    return windows.join(often, "window").select("anchor", "block", "content", F.array("at").alias("starts"), F.array("at").alias("ends"))


def remove_repeats(docs: DataFrame, staged: Staged, length: int = LENGTH, gram: int = ANCHOR, texts: bool = True) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_words, n_removed, spans (first and last word of each removed
    stretch) and kept, the words that stay joined by one space; without ``texts`` its SHA-256 instead.

    A word goes if a window of ``length`` words covers it whose words also start anywhere else in the table, the same
    text included; windows are judged on the input. Null and empty texts have no words and an empty kept text; texts
    shorter than a window lose nothing; repeated rows repeat each other. An empty table gives no rows.
    """
    keyed = row_key(docs)
    found = staged.write(_repeated_anchors(_stretches(keyed, length, gram)), "anchors")
    places = found.groupBy("row_key").agg(F.collect_set(F.struct("first", "windows", "anchor")).alias("places"))
    texts_of = staged.write(keyed.join(places, "row_key").select("row_key", "text", "places"), "texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            out = []
            for key, text, stretches in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                parts = text.encode().split()
                for s in stretches:
                    stretch = b" ".join(parts[s["first"] : s["first"] + s["windows"] + length - 1])
                    out.append((key, s["first"], s["anchor"], hashlib.blake2b(stretch, digest_size=16).hexdigest(), stretch))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["row_key", "first", "anchor", "content", "stretch"])

    pieces = texts_of.mapInArrow(cut, "row_key long, first int, anchor long, content string, stretch binary")
    # Equal stretches of an anchor are one, with their number, before they are dealt over blocks.
    contents = pieces.groupBy("anchor", "content").agg(F.first("stretch").alias("stretch"), F.count("*").alias("times"))
    contents = staged.write(contents, "contents")
    split = contents.groupBy("anchor").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    split = staged.write(split, "split")  # one row for more than a block of stretches
    block = F.coalesce(F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"), F.lit(0)).alias("block")
    dealt = contents.join(split, "anchor", "left")
    several = _search_blocks(dealt.where("blocks > 1").select("anchor", block, "content", "stretch", "times"), length)
    repeated = _search_shards(dealt.select("anchor", block, "content", "stretch", "times"), length).union(several).drop("block")
    repeated = staged.write(repeated, "repeated")
    staged.drop("contents", "split")
    hit = pieces.select("row_key", "first", "anchor", "content").distinct().join(repeated, ["anchor", "content"])
    spans = hit.select("row_key", F.explode(F.arrays_zip((F.transform("starts", lambda x: x + F.col("first"))).alias("a"), (F.transform("ends", lambda x: x + F.col("first"))).alias("b"))).alias("s"))
    removed = staged.write(spans.groupBy("row_key").agg(F.collect_set(F.struct(F.col("s.a").alias("a"), (F.col("s.b") + length).alias("b"))).alias("removed")), "removed")
    staged.drop("texts", "repeated", "anchors")
    span_type = pa.struct([("first", pa.int32()), ("last", pa.int32())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            counts, gone, spans, kept = [], [], [], []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True):
                parts = (text or "").encode().split()
                stays = np.ones(len(parts) + 2, bool)
                for r in removed or ():
                    stays[r["a"] + 1 : r["b"] + 1] = False
                counts.append(len(parts))
                gone.append(int(len(stays) - stays.sum()))
                edges = np.flatnonzero(stays[1:] != stays[:-1])
                spans.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                text = b" ".join(p for p, s in zip(parts, stays[1:-1].tolist(), strict=True) if s) if gone[-1] else b" ".join(parts)
                kept.append(text.decode() if texts else hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(span_type)), pa.array(kept, pa.string())],
                ["row_key", "doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    every = keyed.join(removed, "row_key", "left").select("row_key", "doc_id", "text", "removed")
    return every.mapInArrow(keep, "row_key long, doc_id long, n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string")


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans of every document."""
    found = remove_repeats(table(spark, folder, "documents"), Staged(spark, "repeats"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d
), k AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY md5(array_to_string(w[i:i + 34], ' '))) AS n FROM p
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM k WHERE n > 1
), g AS (
  SELECT doc_id, list(i ORDER BY i) AS gone FROM c GROUP BY doc_id
), a AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, coalesce(gone, []) AS gone,
         list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(coalesce(gone, []), i) THEN '' ELSE w[i] END), lambda x: x <> '') AS kept
  FROM d LEFT JOIN g USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256,
       len(list_filter(gone, lambda i: NOT list_contains(gone, i - 1))) AS n_spans
FROM a
"""
