"""Clusters of sets that share common phrases are cut before their texts move."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayline.llm import similar_sets as sim
from stayline.llm.common import Staged
from tests.llm.test_similar import brute


def phrased(seed, n=150):
    """Texts of different words around phrases that all have, and near copies of some."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    phrases = [[word() for _ in range(6)] for _ in range(12)]
    texts = []
    for i in range(n):
        if texts and i % 3 == 0:
            w = texts[rng.randrange(len(texts))][1].split()
            w[rng.randrange(len(w))] = word()
        else:
            w = [x for _ in range(rng.randint(4, 12)) for x in (*rng.choice(phrases), *(word() for _ in range(rng.randint(1, 8))))]
        texts.append((i, " ".join(w)))
    return texts


@pytest.mark.parametrize("block", [7, 1024])
def test_texts_move_only_with_sets_that_may_be_similar(spark, docs, got, monkeypatch, block):
    monkeypatch.setattr(sim, "BLOCK", block)
    compare, moved = sim._compare, []

    def seen(blocks, percent):
        moved.append(blocks.agg(F.countDistinct("vertex"), F.max("block")).first())
        return compare(blocks, percent)

    monkeypatch.setattr(sim, "_compare", seen)
    texts = phrased(3)
    want = brute(texts, 5, 80)
    found = got(sim.similar(docs(*texts), Staged(spark, "test"), 5, 80), "doc_id", "n_shingles", "component_id")
    assert found == want
    near = [c for _, c in want.values()]
    assert moved[0][0] <= 1.1 * sum(near.count(c) > 1 for c in near)


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_sketches_lose_no_similar_pair(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for size in (1, 3, 60, 64, 65, 120, 130, 500, 520):
        base = rng.integers(0, 2**62, size).astype(np.uint64)
        for _ in range(6):
            drop = rng.random(size) < rng.choice([0, 0.02, 0.05, 0.1])
            more = rng.integers(0, 2**62, rng.integers(0, size // 8 + 1)).astype(np.uint64)
            sets.append(np.unique(np.concatenate((base[~drop], more))) if (~drop).any() else base)
    ptr = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sketched = sim.sketches(np.concatenate(sets), ptr).to_pylist()
    assert all(pa.scalar(s).as_py() is not None for s in sketched)
    size = np.diff(ptr)
    root = list(range(len(sets)))
    for left in (0, 20):
        root = np.arange(len(sets))
        for a, b in sim.alike(size, sketched, left, percent):
            assert not left or (a < left) != (b < left)
            root[root == root[a]] = root[b]
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and (not left or j < left <= i):
                    assert root[i] == root[j]


def test_sets_that_only_a_chain_of_phrases_connects_never_meet(spark, docs, got, monkeypatch):
    """Each text has a phrase in common with the next one, so all are one chain; with the corpus such a chain would take it whole."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phrases = [[word() for _ in range(14)] for _ in range(121)]
    texts = [(i, " ".join([*phrases[i], *(word() for _ in range(6)), *phrases[i + 1]])) for i in range(120)]
    texts += [(i + 1000, t.rsplit(" ", 1)[0] + " other") for i, t in texts[::10]]
    links, met = sim._sketched_links, []

    def seen(members, percent):
        met.append(members.groupBy("cluster").count().agg(F.max("count")).first()[0] or 0)
        return links(members, percent)

    monkeypatch.setattr(sim, "_sketched_links", seen)
    found = got(sim.similar(docs(*texts), Staged(spark, "test"), 5, 80), "doc_id", "n_shingles", "component_id")
    assert found == brute(texts, 5, 80)
    assert met[0] < 20


@pytest.mark.parametrize("block", [3, 12, 1024])
@pytest.mark.parametrize("rows", [1, 5, 1000])
def test_groups_of_signatures_over_batches(block, rows, monkeypatch):
    """Pairs, members and links hold every group together, however the sorted rows are cut into batches."""
    monkeypatch.setattr(sim, "BLOCK", block)
    rng = np.random.default_rng(rows)
    sizes = [1, 2, 3, 8, 9, 12, 13, 1, 1, 30, 2, 9]
    groups = [np.sort(rng.choice(500, n, replace=False)) for n in sizes]
    groups[-1] = groups[4]
    sign = np.repeat(np.arange(len(sizes)), sizes)
    sets = np.concatenate(groups)
    sign, sets = np.repeat(sign, 1 + (sets % 3 == 0)), np.repeat(sets, 1 + (sets % 3 == 0))  # repeated rows
    found = {sim.PAIR: set(), sim.MEMBER: set(), sim.LINK: set()}
    kept = np.empty(0, np.int64), np.empty(0, np.int64), False
    for at in range(0, len(sign), rows):
        last = at + rows >= len(sign)
        out, kept = sim._grouped(np.concatenate((kept[0], sign[at : at + rows])), np.concatenate((kept[1], sets[at : at + rows])), not last, kept[2])
        for kind, a, b in out:
            found[kind] |= set(zip(a.tolist(), b.tolist(), strict=True))
    listed = {frozenset(b for x, b in found[sim.MEMBER] if x == a) for a, _ in found[sim.MEMBER]}
    for group in groups:
        every = {(a, b) for i, a in enumerate(group.tolist()) for b in group.tolist()[i + 1 :]}
        chain = set(zip(group[:-1].tolist(), group[1:].tolist(), strict=True))
        if len(group) > block:
            assert chain <= found[sim.LINK] and chain <= found[sim.PAIR]
        elif len(group) <= sim.PAIRS:
            assert every <= found[sim.PAIR]
        else:
            assert frozenset(group.tolist()) in listed and chain <= found[sim.PAIR]


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_pairs_are_judged_as_in_a_block(percent):
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 2**62, 700).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(700) < part], rng.integers(0, 2**62, more).astype(np.uint64)))) for part in (0.08, 0.1, 0.5, 0.9, 1) for more in (0, 5, 60)]
    size = np.array([len(s) for s in sets])
    sketched = sim.sketches(np.concatenate(sets), np.concatenate(([0], np.cumsum(size))))
    a, b = np.triu_indices(len(sets), 1)
    near = sim.near_pairs(size[a], size[b], sketched.take(pa.array(a)), sketched.take(pa.array(b)), percent)
    for i, j, one in zip(a.tolist(), b.tolist(), near.tolist(), strict=True):
        assert one == bool(sim.alike(size[[i, j]], [sketched[i].as_py(), sketched[j].as_py()], 0, percent))
