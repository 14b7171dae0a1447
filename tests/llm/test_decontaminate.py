import random

from stayline.llm import decontaminate as dec
from stayline.llm.common import Staged

ITEM = "the quick brown fox jumps over a lazy dog while nine bright birds sing near old river banks tonight"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def pairs(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.similarity for r in dec.matches(docs, bench, Staged(spark, "test")).collect()}


def test_verbatim_edited_and_clean(spark, docs):
    rng = random.Random(5)
    edited = ITEM.split()
    edited[9] = "because"
    del edited[14]
    table = docs(
        (1, f"{prose(rng, 50)} {ITEM} {prose(rng, 50)}"), (2, prose(rng, 30) + " " + " ".join(edited)), (3, prose(rng, 400)), (4, None), (5, ""),
        (6, ITEM.upper().replace(" ", ", ")), (7, " ".join(ITEM.split()[:5])), (8, prose(rng, 60_000) + " " + ITEM),
    )
    found = pairs(spark, table, [(10, ITEM), (11, ITEM), (12, None), (13, "")])
    assert set(found) == {(d, i) for d in (1, 2, 6, 8) for i in (10, 11)}
    assert found[1, 10] == 1.0 and 0.8 < found[2, 10] < 1.0


def test_a_seed_that_many_documents_have_loses_no_copy(spark, docs):
    rng = random.Random(6)
    found = pairs(spark, docs(*[(i, f"{prose(rng, 5)} {ITEM} {prose(rng, 5)}") for i in range(300)]), [(1, ITEM), (2, prose(rng, 20))])
    assert set(found) == {(i, 1) for i in range(300)}


def test_short_items_repeated_rows_and_empty_tables(spark, docs):
    table = docs((1, "so said three words exactly here"), (1, "so said three words exactly here"))
    assert set(pairs(spark, table, [(1, "three words exactly")])) == {(1, 1)}
    assert pairs(spark, table, []) == {} and pairs(spark, docs(), [(1, ITEM)]) == {}


def test_alignment_against_a_plain_table():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i][j] = max(0, table[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
        best, first, last = dec.align(dec.np.array(a), dec.np.array(b))
        assert best == max(map(max, table)) and (best == 0 or 0 <= first <= last < len(b))
