import random
import re

import numpy as np
import pytest

from stayline.llm import similar_sets as sim
from stayline.llm.common import Staged


def shingles(text, size):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    bases = [[word() for _ in range(size)] for size in (2, 5, 12, 30, 60, 120, 200)]
    texts = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, "\x0bone\t"), (5, "é É"), (6, "É é")]
    for i in range(7, n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 8])):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            w = w or ["q"]
        texts.append((i, " ".join(w)))
    return texts


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_against_brute_force(spark, docs, got, size, percent):
    texts = near_copies(percent)
    found = got(sim.similar(docs(*texts), Staged(spark, "test"), size, percent), "doc_id", "n_shingles", "component_id")
    assert found == brute(texts, size, percent)


def test_a_cluster_of_many_blocks(spark, docs, got, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 7)
    texts = near_copies(11, 90)
    found = got(sim.similar(docs(*texts), Staged(spark, "test")), "doc_id", "n_shingles", "component_id")
    assert found == brute(texts, 3, 90)


@pytest.mark.parametrize("percent, second", [(90, 2), (80, 2), (90, 3)])
def test_similar_sets_share_a_signature(percent, second):
    rng = np.random.default_rng(percent + second)
    for size in [*range(1, 40), 99, 100, 250, 1000]:
        for _ in range(6):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            low = -(-percent * size // 100)
            drop = int(rng.integers(0, size - low + 1))
            grow = max(0, (100 * (size - drop)) // percent - size)
            b = np.concatenate((a[drop:], rng.integers(0, 2**63, int(rng.integers(0, grow + 1)), dtype=np.uint64)))
            common, union = size - drop, len(b) + drop
            assert 100 * common >= percent * union
            sign, of = sim.signatures(np.concatenate((np.sort(a), np.sort(b))), np.array([0, len(a), len(a) + len(b)]), percent, second)
            assert set(sign[of == 0].tolist()) & set(sign[of == 1].tolist())


def test_repeated_rows_null_ids_and_empty_table(spark, docs):
    rows = sim.similar(docs((4, "a b c d"), (4, "a b c d"), (None, "A B C D"), (None, "x"), (9, "")), Staged(spark, "test")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == [(4, 2, 4), (4, 2, 4), (9, 0, 9), (None, 1, None), (None, 2, 4)]
    assert sim.similar(docs(), Staged(spark, "test")).count() == 0
