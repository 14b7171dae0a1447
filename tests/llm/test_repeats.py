import hashlib
import random
from collections import Counter

import pytest

from stayline.llm import repeats
from stayline.llm.common import Staged


def brute(texts, length):
    parts = {i: (t or "").encode().split() for i, t in texts}
    seen = Counter(tuple(w[i : i + length]) for w in parts.values() for i in range(len(w) - length + 1))
    out = {}
    for doc, w in parts.items():
        stays = [True] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                stays[i : i + length] = [False] * length
        kept = b" ".join(x for x, s in zip(w, stays) if s)
        out[doc] = (len(w), stays.count(False), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def check(spark, docs, texts, length, gram):
    want = brute(texts, length)
    for full in (True, False):
        found = repeats.remove_repeats(docs(*texts), Staged(spark, "test"), length, gram, texts=full)
        rows = {r.doc_id: r for r in found.collect()}
        assert len(rows) == len(texts)
        for doc, (n, gone, digest, kept) in want.items():
            assert (rows[doc].n_words, rows[doc].n_removed, rows[doc].kept) == (n, gone, kept if full else digest), doc
            assert sum(s["last"] - s["first"] + 1 for s in rows[doc].spans) == gone


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 60))
    passage = [word() for _ in range(30)]
    texts = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "x y " * 40), (5, "z " * 300)]
    for i in range(6, 60):
        w = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            a = rng.randint(0, 12)
            w[rng.randint(0, len(w)) :][:0] = []
            at = rng.randint(0, len(w))
            w[at:at] = passage[a : a + rng.randint(6, 18)]
        texts.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return texts + [(100 + i, texts[10 + i][1]) for i in range(5)]


@pytest.mark.parametrize("length, gram", [(8, 3), (12, 5)])
def test_against_brute_force(spark, docs, length, gram):
    check(spark, docs, corpus(length), length, gram)


def test_an_anchor_of_many_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 4)
    check(spark, docs, corpus(1), 8, 3)


def test_repeated_rows_and_empty_table(spark, docs):
    text = " ".join(str(i) for i in range(20))
    rows = repeats.remove_repeats(docs((1, text), (1, text)), Staged(spark, "test"), 8, 3).collect()
    assert [(r.n_removed, r.kept) for r in rows] == [(20, ""), (20, "")]
    assert repeats.remove_repeats(docs(), Staged(spark, "test")).count() == 0


def test_automaton_counts_every_substring():
    rng = random.Random(4)
    for _ in range(40):
        words = [[rng.randint(0, 2) for _ in range(rng.randint(1, 10))] for _ in range(3)]
        times = [rng.randint(1, 2) for _ in words]
        shard = repeats.Automaton()
        for w, t in zip(words, times):
            shard.add(w, t)
        shard.finish()
        for length in (1, 2, 3):
            seen = Counter()
            for w, t in zip(words, times):
                for i in range(len(w) - length + 1):
                    seen[tuple(w[i : i + length])] += t
            for w in words:
                want = [i for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1]
                assert shard.repeated(w, length) == want


def test_copies_of_a_stretch_make_no_further_block(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 4)
    search, several = repeats._search_blocks, []

    def seen(contents, length):
        several.append(contents.count())
        return search(contents, length)

    monkeypatch.setattr(repeats, "_search_blocks", seen)
    text = " ".join(str(i) for i in range(30))
    check(spark, docs, [(i, text) for i in range(40)] + [(50, "a b " * 100), (51, text + " more")], 8, 3)
    assert several == [0, 0]
