"""Found pairs against the alignment of whole texts with all items."""

import random

import pytest

from stayline.llm import decontaminate as dec
from tests.llm.test_decontaminate import pairs, prose


def edited(rng, words, share, kinds):
    out = []
    for w in words:
        kind = rng.choice(kinds) if rng.random() < share else "keep"
        out += {"keep": [w], "change": [prose(rng, 1)], "drop": [], "add": [w, prose(rng, 1)]}[kind]
    return out


@pytest.mark.parametrize("pairs_at_once", [2_000_000, 50])
def test_against_alignment_of_everything(spark, docs, monkeypatch, pairs_at_once):
    monkeypatch.setattr(dec, "PAIRS", pairs_at_once)
    rng = random.Random(8)
    common = prose(rng, 12).split()
    items = [(n, " ".join(rng.choice(common) if rng.random() < 0.3 else prose(rng, 1) for _ in range(size))) for n, size in enumerate([15, 15, 18, 20, 25, 38, 60])]
    texts = []
    for _, item in items:
        for share in (0.1, 0.2, 0.25, 0.3):
            for kinds in (["change"], ["change", "drop", "add"]):
                copy = " ".join(edited(rng, item.split(), share, kinds))
                texts.append(f"{prose(rng, 20)} {' '.join(rng.choices(common, k=10))} {copy} {prose(rng, 30)}")
    every_fourth = " ".join(prose(rng, 1) if i % 4 == 3 else w for i, w in enumerate(items[2][1].split()))
    texts += [every_fourth, "", *(prose(rng, 15) + " " + " ".join(rng.choices(common, k=40)) for _ in range(5))]
    number = {}
    ids = lambda t: dec.np.array([number.setdefault(w, len(number)) for w in dec.words_of(t)], dec.np.int64)
    want = {}
    for d, text in enumerate(texts):
        for n, item in items:
            best = dec.align(ids(item), ids(text))[0] / (2 * len(item.split())) if text else 0
            if best >= dec.SIMILARITY:
                want[d, n] = best
    assert (len(texts) - 7, 2) in want and len(want) > 40
    assert pairs(spark, docs(*enumerate(texts)), items) == want


def test_few_stretches_of_common_words_are_aligned(monkeypatch):
    rng = random.Random(4)
    item = prose(rng, 30).split()
    items = dec.Items([(0, " ".join(item))], dec.SIMILARITY)
    # Half of the item's words, scattered so that the words between cost more than they add, and one whole copy.
    words = [w for n in range(2000) for w in (item[n * 7 % 30], *["other"] * 3)] + item
    ids = dec.np.array([items.vocabulary.get(w, -1) for w in words], dec.np.int64)
    align, calls = dec.align, []
    monkeypatch.setattr(dec, "align", lambda *a: calls.append(1) or align(*a))
    assert list(items.passages(ids)) == [(0, 1.0, 8000, 8029)]
    assert len(calls) < 5
