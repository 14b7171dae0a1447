"""Toxicity by a counterfactually regularised classifier.

A text is a bag of words; a word's score is the sum of the weights of its affixes, character n-grams and itself, and the text's
score is that of its worst word, so a long text isn't diluted. In training, identity terms of labelled
sentences are swapped and the change of the score is penalised, so the mention of a group tells nothing by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayline.llm.common import hash_sample, slices, table, worker_store
from stayline.llm.langid import held_out
from stayline.llm.wordfeat import BITS, WordTable, features, letters, summed

# -- fixed values: identity terms, interchangeable within a group ---------------------------------------
IDENTITY = [
    ["women", "men", "girls", "boys", "woman", "man", "girl", "boy"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "atheist"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "catholics", "atheists"],
    ["black", "white", "asian", "african", "european", "american", "arab", "latino"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["immigrants", "refugees", "foreigners", "natives", "migrants"],
    ["old", "young", "elderly", "disabled", "deaf", "blind"],
    ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés"],
    ["frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"],
    ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados"],
]
# -------------------------------------------------------------------------------------------------------
#: Bounds of the training sample: labelled documents of each class, and bytes of a text that is learned from.
SAMPLE_DOCS, SAMPLE_BYTES = {1: 2000, 0: 4000}, 32_768
AFFIX, GRAMS = 6, (3, 4)
#: Passes over the sample, more of them if it is small, so that there are so many steps at least.
EPOCHS, STEPS, RATE, DECAY, BATCH = 6, 300, 0.25, 1e-4, 128
#: How sharply the worst word stands for its text, from the first pass to the last.
SHARPNESS = (1.0, 8.0)
#: Words whose features are computed at once.
CHUNK = 20_000
#: Weight of the penalty, and words of a sentence in which terms are swapped.
COUNTERFACTUAL, SENTENCE = 1.0, 16
THRESHOLD = 0.3
TABLE, SLICE = 150_000, 2 << 20


class Model:
    """Feature weights and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def word_scores(self, words: list[str]) -> np.ndarray:
        number, word = features(words, AFFIX, GRAMS)
        return summed(self.weights[number], word, len(words))

    def logit(self, text: str | None) -> float:
        words = sorted(set(letters(text)))
        return self.bias + (float(self.word_scores(words).max()) if words else 0.0)


def counterfactuals(texts: Iterable[list[str]], random: np.random.Generator) -> list[tuple[list[str], list[str]]]:
    """Pairs of sentences of labelled texts, given as words, that differ in one identity term.

    A sentence with a term gets another one of its group; a sentence without any gets one term, then another, put in
    at the same place, so that every term is met.
    """
    group = {t: g for g in IDENTITY for t in g}
    pairs = []
    for words in texts:
        if not words:
            continue
        at = int(random.integers(max(len(words) - SENTENCE, 0) + 1))
        own = [i for i, w in enumerate(words) if w in group]
        if own:
            i = int(random.choice(own))
            at = max(0, i - SENTENCE // 2)
            terms, left, right = group[words[i]], words[at:i], words[i + 1 : at + SENTENCE]
            first = words[i]
        else:
            terms = IDENTITY[int(random.integers(len(IDENTITY)))]
            sentence = words[at : at + SENTENCE]
            cut = int(random.integers(len(sentence) + 1))
            left, right, first = sentence[:cut], sentence[cut:], terms[int(random.integers(len(terms)))]
        second = [t for t in terms if t != first][int(random.integers(len(terms) - 1))]
        pairs.append((sorted({*left, first, *right}), sorted({*left, second, *right})))
    return pairs


def fit(rows: list[tuple[int, str]], rate: float | None = None) -> Model:
    """Learn from (label, text) rows; ``rate`` is the share of label 1 among all labelled rows, to which the
    intercept is set if the sample's own share differs."""
    weights = np.zeros(1 << BITS, np.float64)
    squares = np.full(1 << BITS, 1e-3)
    labels = np.array([y for y, _ in rows])
    if not len(rows) or labels.min() == labels.max():
        share = float(labels.mean()) if len(rows) else 0.0
        return Model(weights, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    random = np.random.default_rng(0)
    place: dict[str, int] = {}
    numbers = lambda words: np.fromiter((place.setdefault(w, len(place)) for w in words), np.int32)
    texts = [numbers(letters(t)) for _, t in rows]
    numbers(t for g in IDENTITY for t in g)
    vocabulary = list(place)
    parts, reach = [], [np.zeros(1, np.int64)]
    for at in range(0, len(vocabulary), CHUNK):  # in parts, so that the driver holds the features of a few words twice
        chunk = vocabulary[at : at + CHUNK]
        number, word = features(chunk, AFFIX, GRAMS)
        parts.append(number.astype(np.int32))
        reach.append(np.searchsorted(word, np.arange(1, len(chunk) + 1)) + reach[-1][-1])
    number, reach = np.concatenate(parts), np.concatenate(reach)
    del parts
    bags = [np.unique(ids) for ids in texts]
    bias, bias_square = -1.0, 1e-3
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(rows)))
    for sharpness in np.linspace(*SHARPNESS, epochs):
        pairs = [(numbers(a), numbers(b)) for a, b in counterfactuals(([vocabulary[i] for i in ids.tolist()] for ids in texts), random)]
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = [i for i in order[at : at + BATCH] if len(bags[i])]
            swapped = pairs[at : at + BATCH]
            sets = [bags[i] for i in chosen] + [s for pair in swapped for s in pair]
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            distinct, of = np.unique(np.concatenate(sets), return_inverse=True)
            lengths = reach[distinct + 1] - reach[distinct]
            begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            used = number[np.repeat(reach[distinct] - begin, lengths) + np.arange(lengths.sum())]
            score = np.add.reduceat(weights[used], begin)[of]
            top = np.repeat(np.maximum.reduceat(score, starts), sizes)
            pull = np.exp(sharpness * (score - top))
            pull /= np.repeat(np.add.reduceat(pull, starts), sizes)
            pooled = np.add.reduceat(pull * score, starts)
            n = len(chosen)
            slope = np.empty(len(sets))
            slope[:n] = labels[chosen] - 1 / (1 + np.exp(-(pooled[:n] + bias)))
            change = pooled[n::2] - pooled[n + 1 :: 2]
            slope[n::2], slope[n + 1 :: 2] = -2 * COUNTERFACTUAL * change, 2 * COUNTERFACTUAL * change
            by_word = np.bincount(of, pull * np.repeat(slope, sizes), len(distinct))
            grad = np.bincount(used, np.repeat(by_word, lengths), len(weights)) / BATCH
            grad -= DECAY * np.where(np.bincount(used, minlength=len(weights)) > 0, weights, 0)
            squares += grad**2
            weights += RATE * grad / np.sqrt(squares)
            step = float(slope[:n].sum()) / BATCH
            bias_square += step**2
            bias += RATE * step / np.sqrt(bias_square)
    if rate is not None and 0 < rate < 1:
        own = labels.mean()
        bias += np.log(rate / (1 - rate)) - np.log(own / (1 - own))
    return Model(weights.astype(np.float32), float(bias))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[int, str]], float | None]:
    """The bounded training sample of (toxic, text), by the hash of doc_id, and the share of toxic among all labels.

    Documents are chosen on their ids and sizes; only the chosen ones' texts, ``SAMPLE_DOCS`` in all, are fetched. A
    document with several labels is toxic if one of them says so; of rows with one doc_id one text is taken.
    """
    marks = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = docs.where(F.col("text").isNotNull()).groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("bytes"))
    usable = sizes.join(marks, "doc_id")
    counts = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = hash_sample(usable.where(F.col("bytes") <= SAMPLE_BYTES), "toxic", SAMPLE_DOCS, ["doc_id"]).select("doc_id", "toxic")
    fitting = docs.where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id", "text")
    texts = fitting.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = sorted((r.toxic, r.text) for r in texts.select("toxic", "text").collect())
    total = sum(counts.values())
    return rows, counts.get(1, 0) / total if total else None


def predict(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with score (0 to 1, higher: more likely toxic), predicted (1 from ``threshold`` on) and worst_word.

    A text that is null or has no letter gets the intercept's score and no worst word. Of equal worst words the
    first in the text is given. Columns of these names are replaced; repeated rows are scored again.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    new = ["score", "predicted", "worst_word"]
    kept = [c for c in docs.columns if c not in new]
    read = docs.select(*[docs[c] for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        key = ("toxicity", model.bias, hash(model.weights[:: 1 << 6].tobytes()))
        scores = worker_store().setdefault(key, WordTable(model.word_scores, TABLE))
        for batch in slices(batches, "text", SLICE):
            per_text = [letters(t) for t in batch.column("text").to_pylist()]
            words = [w for found in per_text for w in found]
            sizes = np.array([len(found) for found in per_text], np.int64)
            pooled, worst = np.zeros(batch.num_rows), [None] * batch.num_rows
            if words:
                value = scores.rows(words).astype(np.float64)
                full = np.flatnonzero(sizes)
                starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))[full]
                pooled[full] = np.maximum.reduceat(value, starts)
                for i, start in zip(full.tolist(), starts.tolist(), strict=True):
                    worst[i] = words[start + int(value[start : start + sizes[i]].argmax())]
            score = 1 / (1 + np.exp(-(pooled + model.bias)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(worst, pa.string())], [*kept, *new])

    return read.mapInArrow(run, StructType(read.schema.fields + StructType.fromDDL("score double, predicted int, worst_word string").fields))


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_word of every document, learned from labels that aren't held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows, rate = sample(docs.where(~held_out()), labels.where(~held_out()))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return predict(read, fit(rows, rate)).drop("text")
