"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes, its character n-grams, the word itself and its membership in the lexicon of each
language. Feature weights and the weights of transitions between languages are learned together; forward-backward
gives every word's distribution over languages, so the parts of a code-switched text are labelled word by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayline.llm.common import hash_sample, slices, table, worker_store
from stayline.llm.wordfeat import BITS, WordTable, features, letters, summed, whole

#: Bound of the training sample: so many documents of each language, and of each one stretch of so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 600, 1500
SEGMENT = 32
AFFIX, GRAMS = 3, (2, 3)
EPOCHS, RATE, DECAY = 4, 0.3, 1e-6
#: A word is in a language's lexicon if the sample has it so often, and so much of that in this language.
LEXICON_COUNT, LEXICON_SHARE = 3, 0.8
TABLE, SLICE = 150_000, 2 << 20
NONE = "und"
PREDICTED = "lang_pred string, score double, n_words long, spans array<struct<first:int,last:int,lang:string>>"


@dataclass
class Model:
    """Languages, feature weights, weights of transitions and of a text's first language, and the lexicons."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray
    lexicon: tuple[np.ndarray, np.ndarray]
    lexicon_weights: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        number, word = features(words, AFFIX, GRAMS)
        total = summed(self.weights[number], word, len(words))
        keys, owner = self.lexicon
        if len(keys):
            hashes = whole(words)
            slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[slot] == hashes
            total[hit] += self.lexicon_weights[owner[slot[hit]]]
        return total.astype(np.float32)


def forward_backward(emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word, and expected transitions summed over all texts.

    ``bounds`` has the first word of each text and the number of words. All texts are stepped through together, the
    longest first, so the work of a step is over the texts that are still going on.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    k = emissions.shape[1]
    expected = np.zeros((k, k))
    if not len(order):
        return np.zeros_like(emissions), expected
    starts, lengths = bounds[:-1][order], sizes[order]
    going = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # texts longer than t
    value = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    forward = np.empty_like(value)
    state = np.exp(first - first.max()) * value[starts]
    state /= state.sum(axis=1, keepdims=True)
    forward[starts] = state
    for t in range(1, int(lengths[0])):
        at = starts[: going[t]] + t
        state = (state[: going[t]] @ move) * value[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    marginal = forward.copy()
    backward = np.ones((len(starts), k))
    for t in range(int(lengths[0]) - 1, 0, -1):
        live = going[t]
        at = starts[:live] + t
        ahead = value[at] * backward[:live]
        before = forward[at - 1]
        joint = (before.T @ (ahead / ((before @ move) * ahead).sum(axis=1, keepdims=True))) * move
        expected += joint
        back = ahead @ move.T
        back /= back.sum(axis=1, keepdims=True)
        backward[:live] = back
        now = before * back
        marginal[at - 1] = now / now.sum(axis=1, keepdims=True)
    return marginal, expected


def fit(rows: list[tuple[str, str]]) -> Model:
    """Learn from (language, text) rows by adaptive gradient steps on the conditional log-likelihood."""
    languages = sorted({lang for lang, _ in rows})
    k = len(languages)
    segments: list[tuple[int, list[str]]] = []
    counts = [Counter() for _ in languages]
    for lang, text in rows:
        found, y = letters(text), languages.index(lang)
        counts[y].update(found)
        segments += [(y, found[i : i + SEGMENT]) for i in range(0, len(found), SEGMENT)]
    total = sum(counts, Counter())
    lexicon = sorted((int(h), y) for y, own in enumerate(counts) for w, c in own.items() if c >= LEXICON_COUNT and c >= LEXICON_SHARE * total[w] for h in whole([w]))
    keys, owner = np.array([h for h, _ in lexicon], np.uint64), np.array([y for _, y in lexicon], np.int64)
    weights, squares = np.zeros((1 << BITS, k), np.float32), np.full((1 << BITS, k), 1e-4, np.float32)
    small = {name: (np.zeros(shape), np.full(shape, 1e-4)) for name, shape in (("transitions", (k, k)), ("first", (k,)), ("lexicon", (k, k)))}
    model = Model(languages, weights, small["transitions"][0], small["first"][0], (keys, owner), small["lexicon"][0])
    random = np.random.default_rng(0)
    for _ in range(EPOCHS if k > 1 else 0):
        order = random.permutation(len(segments))
        for at in range(0, len(order), 256):
            batch = [segments[i] for i in order[at : at + 256]]
            words = [w for _, s in batch for w in s]
            if not words:
                continue
            sizes = np.array([len(s) for _, s in batch])
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            gold = np.repeat([y for y, _ in batch], sizes)
            distinct = sorted(set(words))
            place = {w: i for i, w in enumerate(distinct)}
            of = np.array([place[w] for w in words])
            marginal, expected = forward_backward(model.emissions(distinct)[of], bounds, model.transitions, model.first)
            slope = -marginal
            slope[np.arange(len(words)), gold] += 1
            by_word = np.stack([np.bincount(of, slope[:, y], len(distinct)) for y in range(k)], axis=1) / len(batch)
            number, word = features(distinct, AFFIX, GRAMS)
            used, inverse = np.unique(number, return_inverse=True)
            grad = np.stack([np.bincount(inverse, by_word[word, y], len(used)) for y in range(k)], axis=1) - DECAY * weights[used]
            squares[used] += grad**2
            weights[used] += RATE * grad / np.sqrt(squares[used])
            seen = -expected
            inside = np.repeat(sizes - 1, 1).clip(0)
            seen[np.arange(k), np.arange(k)] += np.bincount([y for y, _ in batch], inside, k)
            begin = np.zeros(k)
            full = sizes > 0
            np.add.at(begin, np.array([y for y, _ in batch])[full], 1)
            begin -= marginal[bounds[:-1][full]].sum(axis=0)
            hashes = whole(distinct)
            in_lexicon = np.zeros((k, k))
            if len(keys):
                slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[slot] == hashes
                np.add.at(in_lexicon, owner[slot[hit]], by_word[hit])
            for name, step in (("transitions", seen / len(words)), ("first", begin / len(batch)), ("lexicon", in_lexicon)):
                value, square = small[name]
                step = step - 1e-4 * value
                square += step**2
                value += RATE * step / np.sqrt(square)
    return model


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded training sample: of each language the ``SAMPLE_DOCS`` documents with the smallest hash, and of each
    one stretch of ``SAMPLE_CHARS`` characters at a place that its hash gives, anywhere in the text."""
    stretch = F.expr(f"substring(text, 1 + int(pmod(xxhash64(text, 1), greatest(char_length(text) - {SAMPLE_CHARS}, 1))), {SAMPLE_CHARS})")
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("lang", "doc_id", stretch.alias("stretch"))
    picked = hash_sample(usable, "lang", {None: SAMPLE_DOCS}, ["stretch", "doc_id"])
    return sorted((r.lang, r.stretch) for r in picked.select("lang", "stretch").collect())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with lang_pred, score, n_words and spans (first and last word and language of each run of
    words with one most likely language).

    lang_pred has the largest share of the words, each weighted by its letters and by its distribution; score is that
    share. A text that is null or has no letter is ``und`` with score 0, no words and no spans; so is every text if
    nothing was learned. Equal shares go to the language that sorts first. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model.__dict__.values()))
    new = ["lang_pred", "score", "n_words", "spans"]
    kept = [c for c in docs.columns if c not in new]
    read = docs.select(*[docs[c] for c in kept])
    span = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        store = worker_store()
        key = ("language", hash(model.weights[:: 1 << 6].tobytes()))
        scores = store.setdefault(key, WordTable(model.emissions, TABLE))
        names = np.array([*model.languages, NONE], object)
        k = len(model.languages)
        for batch in slices(batches, "text", SLICE):
            per_text = [letters(t) for t in batch.column("text").to_pylist()]
            words = [w for found in per_text for w in found]
            sizes = np.array([len(found) for found in per_text], np.int64)
            if not k:
                words, sizes = [], np.zeros_like(sizes)
            bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
            n, best, share = batch.num_rows, np.full(batch.num_rows, k), np.zeros(batch.num_rows)
            starts = lasts = label = np.empty(0, np.int64)
            if words:
                marginal, _ = forward_backward(scores.rows(words).astype(np.float64), bounds, model.transitions, model.first)
                weight = np.fromiter(map(len, words), np.float64, len(words))
                full = np.flatnonzero(sizes)
                mass = np.add.reduceat(marginal * weight[:, None], bounds[:-1][full], axis=0)
                mass /= mass.sum(axis=1, keepdims=True)
                best[full], share[full] = mass.argmax(axis=1), mass.max(axis=1)
                likely = marginal.argmax(axis=1)
                change = np.ones(len(words), bool)
                change[1:] = likely[1:] != likely[:-1]
                change[bounds[:-1][full]] = True
                starts = np.flatnonzero(change)
                lasts = np.append(starts[1:], len(words)) - 1
                label = likely[starts]
            text_of = np.searchsorted(bounds, starts, "right") - 1
            runs = np.searchsorted(text_of, np.arange(n + 1))
            inner = pa.StructArray.from_arrays([pa.array((starts - bounds[text_of]).astype(np.int32)), pa.array((lasts - bounds[text_of]).astype(np.int32)), pa.array(names[label], pa.string())], fields=list(span))
            spans = pa.ListArray.from_arrays(pa.array(runs.astype(np.int32)), inner)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best], pa.string()), pa.array(np.minimum(share, 1.0)), pa.array(sizes), spans], [*kept, *new])

    return read.mapInArrow(run, StructType(read.schema.fields + StructType.fromDDL(PREDICTED).fields))


def held_out() -> Column:
    """Documents that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_spans of every document, learned from those not held out."""
    docs = table(spark, folder, "documents")
    model = fit(sample(docs.where(~held_out())))
    predicted = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"), model)
    return predicted.select("doc_id", "held_out", "lang_pred", "score", "n_words", F.size("spans").cast("long").alias("n_spans"))
