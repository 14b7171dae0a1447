"""Importance resampling (op12) against a brute-force version of the contract, and the radix sort alone."""

import hashlib
import math
import re
import zlib

from stayline.llm import resample
from stayline.llm.common import Staged

WORD = re.compile(resample.WORDS)


def grams(text):
    w = WORD.findall((text or "").translate(str.maketrans(resample.UPPER, resample.LOWER)))
    return len(w), w + [" ".join(w[i : i + 2]) for i in range(len(w) - 1)] + [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]


def brute(docs, targets):
    def counts(texts):
        c = [0] * resample.BUCKETS
        for t in texts:
            for f in grams(t)[1]:
                c[zlib.crc32(f.encode()) % resample.BUCKETS] += 1
        return c

    s, t = counts(d[1] for d in docs), counts(targets)
    big_s, big_t = float(sum(s)), float(sum(t))
    gain = [math.floor(1000.0 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0) * (big_t + 10000)))) for b in range(resample.BUCKETS)]
    out = []
    for doc_id, text in docs:
        n, feats = grams(text)
        weight = sum(gain[zlib.crc32(f.encode()) % resample.BUCKETS] for f in feats)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(feats), weight, score, n])
    eligible = sorted((r for r in out if r[4] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    rank = {id(r): at for at, r in enumerate(eligible[: 5 * len(eligible) // 100], 1)}
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2], r[3], rank.get(id(r))) for r in out)


def spark_rows(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_features, r.weight, r.score, r.rank) for r in df.collect())


def test_against_brute_force(spark, docs):
    import random

    random.seed(7)
    vocab = ["alpha", "Beta", "gamma", "délta", "épsilon", "zeta", "eta", "theta", "42", "x9"]
    rows = [(i, " ".join(random.choice(vocab) for _ in range(random.randrange(0, 60)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "word " * 5000), (403, "ALPHA beta; gamma!" * 10), (None, "alpha " * 30), (7, rows[7][1])]
    targets = ["alpha beta gamma", "Zeta eta theta", None]
    frame = docs(*rows)
    frame = frame.withColumn("rank", frame["doc_id"])  # a clashing extra column
    target_frame = spark.createDataFrame(list(enumerate(targets)), "doc_id long, text string")
    got = spark_rows(resample.resample(frame, target_frame))
    assert got == brute(rows, targets)
    assert sum(1 for r in got if r[4] is not None) >= 10


def test_radix_sort_orders_like_a_sort(spark):
    import random

    random.seed(3)
    keys = [(i, random.randrange(0, 5000), random.randrange(0, 70000)) for i in range(3000)] + [(3000, 0, 0), (3001, 0, 0)]
    keyed = spark.createDataFrame(keys, "row long, a long, b long").repartition(5)
    got = {r.row: r.rank for r in resample.radix_ranks(Staged(spark, "t"), keyed, len(keys)).collect()}
    order = sorted(keys, key=lambda k: (k[1], k[2]))
    assert sorted(got.values()) == list(range(1, len(keys) + 1))
    for at, key in enumerate(order, 1):
        assert (key[1], key[2]) == (order[got[key[0]] - 1][1], order[got[key[0]] - 1][2])
        assert got[key[0]] == at or (key[1], key[2]) == (0, 0)


def test_empty_and_tiny(spark, docs):
    targets = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    got = resample.resample(docs((1, None), (2, "")), targets).collect()
    assert sorted((r.doc_id, r.n_features, r.weight, r.rank) for r in got) == [(1, 0, 0, None), (2, 0, 0, None)]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    targets = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = spark_rows(resample.importance_sample(spark, folder))
    assert got == brute(rows, targets)
