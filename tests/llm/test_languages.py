import random
from itertools import product

import numpy as np
import pytest

from stayline.llm import langid

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["schu", "ung", "ber", "tz"], "cc": ["ción", "ñe", "lla", "os"]}


def sentence(rng, lang, n=20):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(0)
    return langid.fit([(lang, sentence(rng, lang, 60)) for lang in SYLLABLES for _ in range(30)])


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    move, first = rng.normal(size=(3, 3)), rng.normal(size=3)
    sizes = [4, 0, 1, 3]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    emissions = rng.normal(size=(bounds[-1], 3))
    marginal, expected = langid.forward_backward(emissions, bounds, move, first)
    both = np.zeros((3, 3))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            continue
        total, own = 0.0, np.zeros((b - a, 3))
        pairs = np.zeros((3, 3))
        for path in product(range(3), repeat=int(b - a)):
            score = first[path[0]] + sum(emissions[a + t, y] for t, y in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:]))
            weight = np.exp(score)
            total += weight
            for t, y in enumerate(path):
                own[t, y] += weight
            for x, y in zip(path, path[1:]):
                pairs[x, y] += weight
        assert np.allclose(marginal[a:b], own / total)
        both += pairs / total
    assert np.allclose(expected, both)


def test_unseen_texts_and_code_switching(model, docs, got):
    rng = random.Random(9)
    rows = [(i, sentence(rng, lang), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 10)]
    mixed = sentence(rng, "aa", 30) + " " + sentence(rng, "bb", 30)
    found = {r.doc_id: r for r in langid.predict(docs(*rows, (100, mixed)), model).collect()}
    assert all(found[i].lang_pred == lang and 0.9 < found[i].score <= 1 for i, _, lang in rows)
    spans = found[100].spans
    assert [s.lang for s in spans] == ["aa", "bb"] and abs(spans[0].last - 29) <= 1 and spans[-1].last == 59


def test_texts_without_letters_nulls_repeats_and_clashing_columns(model, spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "12 !? \n", "k"), (4, "kato", "k"), (4, "kato", "k"), (5, "ka " * 300_000, "k")]
    table = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = langid.predict(table, model).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score, r.n_words, r.spans) for r in found[:3]] == [("und", 0.0, 0, [])] * 3
    assert found[3] == found[4] and found[3].lang_pred == "aa" and found[5].n_words == 300_000
    assert langid.predict(table.limit(0), model).count() == 0


def test_nothing_to_learn_from(docs):
    empty = langid.fit(langid.sample(docs((1, "abc"), (2, None, "en"))))
    assert [r.lang_pred for r in langid.predict(docs((1, "abc")), empty).collect()] == ["und"]


def test_sample_is_bounded_and_even(docs, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 5)
    rows = [(i, f"text {i}", "aa" if i % 10 else "bb") for i in range(300)] + [(900 + i, "same", "aa") for i in range(300)]
    picked = langid.sample(docs(*rows))
    assert sorted(lang for lang, _ in picked) == ["aa"] * 5 + ["bb"] * 5


def test_held_out_accuracy(spark):
    from stayline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op5_languages"](spark, folder).collect() if r.held_out]
    assert len(rows) > 200 and sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)
