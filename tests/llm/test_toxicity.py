import random

import numpy as np
import pytest

from stayline.llm import toxicity

BAD = ["blarg", "snoxi", "vrump"]


def text(rng, bad, n=30):
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    if bad:
        words[rng.randrange(n)] = rng.choice(BAD) + rng.choice(["", "s", "en"])
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(0)
    return toxicity.fit([(int(i % 3 == 0), text(rng, i % 3 == 0)) for i in range(300)], 0.2)


def test_unseen_texts_of_any_length(model, docs):
    rng = random.Random(7)
    rows = [(i, text(rng, i % 2 == 0, 30 if i < 60 else 1500)) for i in range(80)]
    found = {r.doc_id: r for r in toxicity.predict(docs(*rows), model).collect()}
    wrong = [i for i, _ in rows if found[i].predicted != int(i % 2 == 0)]
    assert len(wrong) <= 4 and all(0 <= found[i].score <= 1 for i in found)
    assert all(found[i].worst_word[:5] in BAD for i in found if i % 2 == 0 and found[i].predicted)


def test_swapped_identity_terms_keep_the_score():
    """In the sample one group's mentions are toxic more often; the penalty takes most of that away."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        term = "muslim" if i % 2 else "christian"
        bad = rng.random() < (0.7 if term == "muslim" else 0.1)
        words = text(rng, bad, 14).split()
        words.insert(rng.randrange(14), term)
        rows.append((int(bad), " ".join(words)))
    gap = lambda m: abs(m.word_scores(["muslim"])[0] - m.word_scores(["christian"])[0])
    fair = toxicity.fit(rows)
    weight, toxicity.COUNTERFACTUAL = toxicity.COUNTERFACTUAL, 0.0
    try:
        plain = toxicity.fit(rows)
    finally:
        toxicity.COUNTERFACTUAL = weight
    assert gap(fair) < 0.5 * gap(plain)


def test_pairs_differ_in_one_term():
    rng = np.random.default_rng(0)
    texts = [["the", "women", "went", "home"], ["nothing", "here"], []]
    pairs = toxicity.counterfactuals(texts, rng)
    assert len(pairs) == 2
    for a, b in pairs:
        assert len(set(a) - set(b)) == len(set(b) - set(a)) == 1
        assert any((set(a) ^ set(b)) <= set(g) for g in toxicity.IDENTITY)


def test_nulls_repeats_long_texts_and_clashing_columns(model, spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "12 !!", "k"), (4, "blarg la", "k"), (4, "blarg la", "k"), (5, "la lo " * 200_000 + "snoxi", "k")]
    table = spark.createDataFrame(rows, "doc_id long, text string, predicted string")
    found = toxicity.predict(table, model).orderBy("doc_id").collect()
    assert len({(r.score, r.predicted, r.worst_word) for r in found[:3]}) == 1 and found[0].worst_word is None and found[0].predicted == 0
    assert found[3] == found[4] and found[3].predicted == 1 and found[5].predicted == 1
    assert toxicity.predict(table.limit(0), model).count() == 0


def test_labels_of_one_class_or_none(docs):
    for rows in ([], [(0, "a b")], [(1, "a")]):
        found = toxicity.predict(docs((1, "a b c")), toxicity.fit(rows)).first()
        assert found.predicted == int(bool(rows) and rows[0][0] == 1)


def test_held_out_accuracy(spark):
    from stayline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_toxicity"](spark, folder).collect() if r.held_out and truth.get(r.doc_id) is not None]
    hit = sum(r.predicted == truth[r.doc_id] for r in rows)
    assert len(rows) > 60 and hit >= 0.88 * len(rows)
