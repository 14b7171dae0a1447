"""Set-similarity join by PartEnum signatures.

A document's set is its distinct word shingles. Sets whose sizes can differ within one similar pair share a size band.
In a band two similar sets differ in at most ``k`` shingles. The shingles' domain is cut into ``k // 2 + 1`` groups, so
there is a group in which they differ in one shingle at most; each group is cut into ``second`` parts, and the subsets of its
parts that leave one part out are enumerated, so the two agree in a whole subset. Each subset's content is a
signature: similar sets share one. Spare groups make up for those in which a set has an empty subset, which says
nothing. Common phrases are signatures of sets that have little else in common, so sets with a common signature are first
looked at by sketches, bits that tell how many of a set's shingles of each hash are odd in number: two sketches differ in no
more bits than the sets in shingles, so no similar pair is lost. What sketches link forms a cluster and is compared exactly.

What keeps large groups apart: equal sets are one set from the start; sets that only a chain of phrases connects never meet,
since a signature of up to ``BLOCK`` sets is looked at by itself, in pairs if it has few sets and else at once, unless its
consecutive sets are already connected; one of more sets links each to the one before, so it costs n links and not all pairs;
a large cluster is compared in blocks of bounded size, by sketches only with blocks of like size, and only a spanning forest of
each comparison leaves the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.common import Staged, components, row_key, slices, table
from stayline.llm.words import U64, mixed, words

#: Shingles of so many words; sets are similar from this percentage of common shingles on.
SHINGLE, PERCENT = 3, 90
#: Sets of a cluster that are compared in one task, and shingles that they may have together.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Parts of a group; with more of them a signature covers more of a set, and there are more signatures.
SECOND = 3
#: Sets with a common signature of which all pairs are looked at one by one.
PAIRS = 8
#: What a row of ``_candidates`` is: two sets, a group and a set of it, two sets of a cluster.
PAIR, MEMBER, LINK = 0, 1, 2
#: Shingles that the sets of a block may have together when only their sketches are compared, of 2 bits a shingle at most.
BLOCK_SKETCHED = 32 * BLOCK_SHINGLES
SLICE = 2 << 20
#: Attempts to cut the domain so that a set has no more empty subsets than spare groups; the last one also signs empty ones.
CUTS = 6
#: Sets that a task remembers to have signed.
SEEN = 200_000


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, one text after the other; and where each text's begin."""
    found = words(texts, lower=True)
    bounds = found.bounds()
    sizes = np.diff(bounds)
    h, n = found.hash, len(found.hash)
    value = np.full(n, 0, U64)
    last = bounds[1:][found.text] if n else np.empty(0, np.int64)
    room = last - np.arange(n)
    whole = np.minimum(sizes[found.text], size) if n else room
    starts = np.flatnonzero(room >= whole)
    for j in range(size):
        use = starts[whole[starts] > j]
        value[use] = mixed(value[use] * U64(3) + h[use + j] + U64(j + 1))
    text, value = found.text[starts], value[starts]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    text, value = text[keep], value[keep]
    return value, np.searchsorted(text, np.arange(len(texts) + 1))


def bands(percent: int, most: int = 1 << 40) -> np.ndarray:
    """First size of every band: a set is similar only to sets of its own band and the two beside it."""
    edges = [1]
    while edges[-1] < most:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, np.int64)


def errors(band: np.ndarray, percent: int) -> np.ndarray:
    """Most shingles in which two similar sets differ whose sizes lie in ``band`` or the one before.

    Of sizes a and b with a similarity of p % or more at most (a + b) * (100 - p) / (100 + p) shingles differ.
    """
    return (2 * (bands(percent)[band + 1] - 1) * (100 - percent)) // (100 + percent)


def spare(band: np.ndarray, groups: np.ndarray, percent: int, second: int) -> np.ndarray:
    """Groups beyond those of the bound: as many as may hold an empty subset, by their mean and twice the deviation.

    With ``groups`` and e more, two similar sets differ in one shingle at most in e + 1 groups or more, so a set
    with an empty subset in e groups at most still has a whole subset in common with each set similar to it.
    """
    subset = bands(percent)[np.maximum(band - 1, 0)] * (second - 1) / (groups * second)
    mean = groups * np.minimum(second * np.exp(-subset), 1.0)
    return np.floor(mean + 2 * np.sqrt(mean) + 0.5).astype(np.int64)


def signatures(value: np.ndarray, ptr: np.ndarray, percent: int = PERCENT, second: int = SECOND) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of all sets. Every set signs in its own band and in the next one, where it may meet larger sets."""
    sizes = np.diff(ptr)
    own = np.searchsorted(bands(percent), sizes, "right") - 1
    found, of = [], []
    for ahead in (0, 1):
        todo = np.flatnonzero(sizes > 0)
        for cut in range(CUTS):
            if not len(todo):
                break
            band = own[todo] + ahead
            k = errors(band, percent)
            groups, per = k // 2 + 1, np.where(k > 0, second, 1)
            more = np.where(k > 0, spare(band, groups, percent, second), 0)
            groups = groups + more
            parts = groups * per
            length = sizes[todo]
            at = np.repeat(ptr[todo] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            row = np.repeat(np.arange(len(todo)), length)
            spread = mixed(value[at] ^ U64(0x1234567 * (cut + 1)))
            part = ((spread >> U64(32)) * parts[row].astype(U64) >> U64(32)).astype(np.int64)
            base = np.concatenate(([0], np.cumsum(parts)))
            slot = base[row] + part
            content = np.zeros(base[-1], U64)
            np.add.at(content, slot, mixed(value[at] + U64(cut)))
            count = np.bincount(slot, minlength=base[-1])
            owner = np.repeat(np.arange(len(todo)), parts)
            number = np.arange(base[-1]) - base[owner]
            # A subset's content is its group's without that of the part left out.
            group = np.concatenate(([0], np.cumsum(groups)))[owner] + number // per[owner]
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            alone = (per == 1)[owner]
            subset = np.add.reduceat(content, first)[group] - np.where(alone, U64(0), content)
            held = np.add.reduceat(count, first)[group] - np.where(alone, 0, count)
            tag = mixed((band[owner].astype(U64) << U64(32)) + (number.astype(U64) << U64(3)) + U64(cut))
            good = (held > 0) | (cut == CUTS - 1)
            found.append(mixed(subset ^ tag)[good])
            of.append(todo[owner[good]])
            # Two sets that may agree in empty subsets alone both get here again, with the domain cut in another way.
            bad, _ = np.unique(np.stack((owner[held == 0], group[held == 0])), axis=1)
            todo = todo[np.bincount(bad, minlength=len(todo)) > more]
    if not found:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(of)


def set_ids(value: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A number for the content of each set; equal sets have one."""
    total = np.concatenate((np.zeros(1, U64), np.cumsum(mixed(value ^ U64(0xABCDEF)), dtype=U64)))
    return mixed(total[ptr[1:]] - total[ptr[:-1]] + np.diff(ptr).astype(U64)).view(np.int64)


def sketches(value: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """Each set's sketch: whether the number of its shingles is odd at each of as many places as it has shingles, or up to twice.

    The number of places is a power of two. Folded by exclusive or, a sketch is that of fewer places.
    """
    sizes = np.diff(ptr)
    places = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(places)))
    at = (mixed(value ^ U64(0x5CE7C4)) & np.repeat(places - 1, sizes).astype(U64)).astype(np.int64)
    odd = np.bincount(np.repeat(base[:-1], sizes) + at, minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((base >> 3).astype(np.int32)), pa.py_buffer(packed)])


def _sets(keyed: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            value, ptr = shingle_sets(batch.column("text"), shingle)
            columns = [batch.column("row_key"), batch.column("doc_id"), pa.array(np.diff(ptr)), pa.array(set_ids(value, ptr)), sketches(value, ptr)]
            yield pa.RecordBatch.from_arrays(columns, ["row_key", "doc_id", "n_shingles", "vertex", "sketch"])

    return keyed.mapInArrow(run, "row_key long, doc_id long, n_shingles long, vertex long, sketch binary")


def _signed(keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The signatures of all sets. A task signs equal sets once, so a group of copies costs no more than one set a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", SLICE):
            value, ptr = shingle_sets(batch.column("text"), shingle)
            vertex = set_ids(value, ptr)
            first = np.zeros(len(vertex), bool)
            for i, v in enumerate(vertex.tolist()):
                if v not in seen:
                    seen.add(v)
                    first[i] = True
            if len(seen) > SEEN:
                seen.clear()
            # Sets that were signed before become empty ones, which have no signature.
            sizes = np.diff(ptr)
            value = value[np.repeat(first, sizes)]
            ptr = np.concatenate(([0], np.cumsum(np.where(first, sizes, 0))))
            sign, of = signatures(value, ptr, percent)
            for at in range(0, len(sign), 1 << 18):
                part = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(sign[part].view(np.int64)), pa.array(vertex[of[part]])], ["signature", "vertex"])

    return keyed.select("text").mapInArrow(run, "signature long, vertex long")


def _grouped(sign: np.ndarray, sets: np.ndarray, open_end: bool, long: bool) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray, bool]]:
    """Rows (kind, a, b) of the groups of equal signatures, and what the next rows may go on with; rows are sorted.

    ``long``: the first group goes on from earlier rows and is one of more than ``BLOCK`` sets.
    """
    new = np.ones(len(sign), bool)
    new[1:] = (sign[1:] != sign[:-1]) | (sets[1:] != sets[:-1])
    sign, sets = sign[new], sets[new]
    starts = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1]))) if len(sign) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(sign))
    count = ends - starts
    large = count > BLOCK
    if long and len(large):
        large[0] = True
    kept = sign[:0], sets[:0], False
    if open_end and len(starts):
        at = starts[-1] if not large[-1] else len(sign) - 1
        kept = sign[at:], sets[at:], bool(large[-1])
        if not large[-1]:
            starts, ends, count, large = starts[:-1], ends[:-1], count[:-1], large[:-1]
    out = []
    for n in range(2, PAIRS + 1):
        first = starts[(count == n) & ~large]
        if len(first):
            i, j = np.triu_indices(n, 1)
            out.append((PAIR, sets[first[:, None] + i].ravel(), sets[first[:, None] + j].ravel()))
    chained = (count > PAIRS) | large
    inside = np.repeat(chained, count)
    follows = np.flatnonzero(inside)[~np.isin(np.flatnonzero(inside), starts)]
    out.append((PAIR, sets[follows - 1], sets[follows]))
    of_large = np.repeat(large, count)[follows]
    out.append((LINK, sets[follows - 1][of_large], sets[follows][of_large]))
    middle = (count > PAIRS) & ~large
    if middle.any():
        rows = np.flatnonzero(np.repeat(middle, count))
        # Groups of the same sets are one.
        name = mixed(np.add.reduceat(mixed(sets[rows].view(U64)), np.concatenate(([0], np.cumsum(count[middle])[:-1]))))
        out.append((MEMBER, np.repeat(name, count[middle]).view(np.int64), sets[rows]))
    return out, kept


def _candidates(signed: DataFrame) -> DataFrame:
    """Rows ``kind``, ``a``, ``b`` of the groups of sets with a common signature; sorted rows are streamed.

    A group of up to ``PAIRS`` sets gives all its pairs. A larger one gives its consecutive sets as pairs, and its members (``a``
    is the group) or, with more than ``BLOCK`` sets, the consecutive sets as links of a cluster that is compared in blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, sets, long = np.empty(0, np.int64), np.empty(0, np.int64), False
        held: list[pa.RecordBatch] = []

        def result(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sign, sets, long
            out, (sign, sets, long) = _grouped(
                np.concatenate((sign, *(b.column(0).to_numpy() for b in held))), np.concatenate((sets, *(b.column(1).to_numpy() for b in held))), not last, long
            )
            held.clear()
            for kind, a, b in out:
                rows = np.unique(np.stack((a, b), axis=1), axis=0)
                for at in range(0, len(rows), 1 << 17):
                    part = rows[at : at + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part[:, 0]), pa.array(part[:, 1])], ["kind", "a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 1 << 16:
                yield from result(False)
        yield from result(True)

    return signed.repartition("signature").sortWithinPartitions("signature", "vertex").mapInArrow(run, "kind byte, a long, b long").distinct()


def near_pairs(n_a: np.ndarray, n_b: np.ndarray, sketch_a: pa.Array, sketch_b: pa.Array, percent: int) -> np.ndarray:
    """Whether the sets of each pair may be similar by their sizes and sketches, as in ``alike``."""
    near = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    room = (n_a + n_b) * (100 - percent) // (100 + percent)
    length = [pa.compute.binary_length(s).to_numpy(zero_copy_only=False).astype(np.int64) for s in (sketch_a, sketch_b)]
    for one, two in np.unique(np.stack((length[0][near], length[1][near]), axis=1), axis=0).tolist():
        rows = np.flatnonzero(near & (length[0] == one) & (length[1] == two))
        level = min(one, two)
        bits = [
            np.bitwise_xor.reduce(np.frombuffer(b"".join(s.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), -1, level), axis=1)
            for s in (sketch_a, sketch_b)
        ]
        near[rows] = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64) <= room[rows]
    return near


def _near_pairs(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = [batch.column(i).to_numpy() for i in (2, 4)]
                near = near_pairs(*n, batch.column(3), batch.column(5), percent)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    side = lambda c: groups.select(F.col("vertex").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    return both.mapInArrow(run, "a long, b long")


def spanning(linked: np.ndarray, left: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of a symmetric matrix; with ``left``, of those between the first ``left`` and the others."""
    if left:
        linked[:left, :left] = linked[left:, left:] = False
    links: list[tuple[int, int]] = []
    unseen = np.ones(len(linked), bool)
    for start in range(len(linked)):
        todo = [start] if unseen[start] else []
        unseen[start] = False
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & unseen)
            unseen[new] = False
            links += [(i, j) for j in new.tolist()]
            todo += new.tolist()
    return links


def alike(sizes: np.ndarray, sketched: list[bytes], left: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that may be similar by their sizes and sketches; ``left`` as in ``spanning``.

    Of sizes a and b with a similarity of p % or more at most (a + b) * (100 - p) / (100 + p) shingles differ, and no more
    bits of the sketches.
    """
    total = sizes[:, None] + sizes[None, :]
    linked = 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    length = np.array([len(s) for s in sketched])
    for level in np.unique(length).tolist():
        # Sketches of one length with each other and with longer ones, folded.
        cols = np.flatnonzero(length >= level)
        rows = np.flatnonzero(length[cols] == level)
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(sketched[c], np.uint8).reshape(-1, level), axis=0) for c in cols.tolist()])
        agree = np.zeros((len(rows), len(cols)), np.float32)
        for at in range(0, level, 512):
            bits = np.unpackbits(folded[:, at : at + 512], axis=1).astype(np.float32) * 2 - 1
            agree += bits[rows] @ bits.T
        near = (8 * level - agree) / 2 <= total[np.ix_(cols[rows], cols)] * (100 - percent) // (100 + percent)
        linked[np.ix_(cols[rows], cols)] &= near
        linked[np.ix_(cols, cols[rows])] &= near.T
    return spanning(linked, left)


def _sketched_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between sets of each cluster that may be similar, so that all similar ones stay connected.

    A cluster of more than one block is cut into bands of sizes, of which two in a row hold all similar pairs, and these
    into blocks; a block is compared with those of its own band and of the bands beside it.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SKETCHED)).cast("int").alias("blocks")
    large = members.groupBy("cluster").agg(blocks).where("blocks > 1").select("cluster", F.lit(True).alias("large"))
    # A little wider than the ratio of sizes, so rounding parts no similar pair.
    band = F.floor(F.log("n_shingles") / (math.log(100 / percent) + 1e-3)).cast("int")
    banded = members.join(large, "cluster", "left").withColumn("band", F.when(F.col("large"), band).otherwise(0)).drop("large")
    near = Window.partitionBy("cluster").orderBy("band")
    beside = lambda move, step: F.coalesce(F.when(move("band").over(near) == F.col("band") + step, move("blocks").over(near)), F.lit(0))
    extent = banded.groupBy("cluster", "band").agg(blocks).withColumns({"below": beside(F.lag, -1), "above": beside(F.lead, 1)})
    own = F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int")
    placed = banded.join(extent, ["cluster", "band"]).withColumn("block", own)
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    here, there = F.col("band"), F.col("block")
    pair = lambda low, one, high, two: F.struct(low.alias("low"), one.alias("one"), high.alias("high"), two.alias("two"))
    every = F.concat(
        F.transform(upto("blocks"), lambda x: pair(here, F.least(there, x), here, F.greatest(there, x))),
        F.transform(upto("above"), lambda x: pair(here, there, here + 1, x)),
        F.transform(upto("below"), lambda x: pair(here - 1, x, here, there)),
    )
    pairs = placed.select("cluster", F.explode(every).alias("p"), "band", "block", "vertex", "n_shingles", "sketch")
    order = ["cluster", "low", "one", "high", "two"]
    pairs = pairs.select("cluster", "p.*", "band", "block", "vertex", "n_shingles", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(10)), strict=True))
        out: list[tuple[int, int]] = []
        for (_, low, one, high, two), group in groupby(rows, key=lambda r: r[:5]):
            held = sorted(group, key=lambda r: r[5:8])
            left = sum(r[5:7] == (low, one) for r in held) if (low, one) != (high, two) else 0
            if left < len(held):
                links = alike(np.array([r[8] for r in held]), [r[9] for r in held], left, percent)
                out += [(held[i][7], held[j][7]) for i, j in links]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return pairs.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def forest(sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``; with ``left``, of those between the first ``left`` and the others.

    Only shingles that several of the sets have can be common to two, so the sets become rows of a table over these,
    and the table's product with itself holds all intersections.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    distinct, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[column]
    own = shared[np.searchsorted(distinct, every)]
    row, column = owner[own], column[own]
    # A set with too many shingles of its own is similar to none.
    inside = np.bincount(row, minlength=n)
    alive = np.flatnonzero(100 * inside >= percent * sizes)
    place = np.full(n, -1)
    place[alive] = np.arange(len(alive))
    held = place[row] >= 0
    row, column = place[row[held]], column[held]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    common = np.zeros((len(alive), len(alive)), np.float32)
    starts = np.searchsorted(column, np.arange(0, width + 4096, 4096))
    for at in range(len(starts) - 1):
        part = slice(starts[at], starts[at + 1])
        dense = np.zeros((len(alive), 4096), np.float32)
        dense[row[part], column[part] - at * 4096] = 1
        used = np.flatnonzero(dense.any(axis=0))
        dense = dense[:, used]
        common += dense @ dense.T
    size = sizes[alive]
    linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    return [(int(alive[i]), int(alive[j])) for i, j in spanning(linked, int(np.searchsorted(alive, left)))]


def _compare(blocks: DataFrame, percent: int) -> DataFrame:
    """Links between similar sets of each comparison (cluster, one, two); rows come sorted and a comparison at a time is held."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            lists = batch.column(5)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, key in enumerate(keys):
                yield key, values[ends[i] : ends[i + 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for (_, one, two), group in groupby(rows(batches), key=lambda r: r[0][:3]):
            held = sorted(group, key=lambda r: (r[0][3], r[0][4]))
            left = sum(key[3] == one for key, _ in held) if one != two else 0
            vertex = [key[4] for key, _ in held]
            out += [(vertex[i], vertex[j]) for i, j in forest([s for _, s in held], left, percent)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    order = ["cluster", "one", "two"]
    return blocks.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def similar(docs: DataFrame, staged: Staged, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links reach. Null and empty texts have no shingles and component_id is
    their own doc_id; a text with fewer words than a shingle has one. A row without doc_id is linked, but names a
    component only where no row of it has a doc_id. Equal texts are linked, repeated rows too. An empty table gives no rows.
    """
    keyed = row_key(docs)
    sets = staged.write(_sets(keyed, shingle), "sets")
    candidates = staged.write(_candidates(_signed(keyed, shingle, percent)), "candidates")
    # One row of each set of a cluster. A cluster of one block is compared at once, another in all pairs of its blocks.
    groups = sets.where("n_shingles > 0").groupBy("vertex").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.min("row_key").alias("row_key"), F.first("sketch").alias("sketch")
    )
    groups = staged.write(groups, "groups")
    paired = components(staged, staged.write(_near_pairs(candidates.where(F.col("kind") == PAIR).select("a", "b"), groups, percent), "paired"), "paired-cc")
    # Of the groups that are no pairs, those count whose sets the pairs haven't connected.
    listed = candidates.where(F.col("kind") == MEMBER).select(F.col("a").alias("cluster"), F.col("b").alias("vertex"))
    reached = listed.join(paired, "vertex", "left").groupBy("cluster").agg(F.min(F.coalesce("root", "vertex")).alias("low"), F.max(F.coalesce("root", "vertex")).alias("high"))
    listed = listed.join(reached.where("low <> high").select("cluster"), "cluster", "left_semi")
    links = candidates.where(F.col("kind") == LINK).select("a", "b")
    clusters = components(staged, links, "clusters").select(F.col("root").alias("cluster"), "vertex")
    rough = staged.write(listed.union(clusters).join(groups, "vertex").select("vertex", "cluster", "n_shingles", "sketch"), "rough")
    staged.drop("candidates", "paired")
    found = _sketched_links(rough, percent).union(paired.where("vertex <> root").select(F.col("vertex").alias("a"), F.col("root").alias("b")))
    clusters = components(staged, staged.write(found, "alike"), "alike-cc")
    members = clusters.join(groups, "vertex").select("row_key", "vertex", F.col("root").alias("cluster"), "n_shingles")
    members = staged.write(members, "members")
    most = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    extent = members.groupBy("cluster").agg(most.cast("int").alias("blocks"))
    placed = members.join(extent, "cluster").select("row_key", "vertex", "cluster", "blocks", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int").alias("block"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            value, ptr = shingle_sets(batch.column("text"), shingle)
            lists = pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), lists], ["cluster", "block", "blocks", "vertex", "shingles"])

    # Sort-merge at every size: how many sets have a near copy isn't bounded.
    # A row that repeats is one row here, also before the shuffle, so a block has as many sets as were counted.
    once = keyed.groupBy("row_key").agg(F.first("text").alias("text"))
    texts = once.hint("merge").join(placed.hint("merge"), "row_key").select("cluster", "block", "blocks", "vertex", "text")
    full = texts.mapInArrow(shingled, "cluster long, block int, blocks int, vertex long, shingles array<long>")
    pairs = full.select("cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "block", "vertex", "shingles").select(
        "cluster", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "vertex", "shingles"
    )
    links = staged.write(_compare(pairs, percent), "links")
    staged.drop("rough", "alike", "members")
    roots = components(staged, links, "links-cc")
    reached = staged.write(groups.select("vertex", "least").join(roots, "vertex", "left").select("vertex", "least", F.coalesce("root", "vertex").alias("root")), "reached")
    named = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    components_of = reached.join(named, "root").select("vertex", "component_id")
    # A row that repeats has one key, and its set one vertex, so this keeps the number of rows.
    return sets.join(components_of, "vertex", "left").select(
        "row_key", "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return similar(table(spark, folder, "documents"), Staged(spark, "similar")).drop("row_key")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), r AS (
  SELECT doc_id AS v, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v WHERE r.c < l.b
), m AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM d JOIN m ON m.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
