import random

import sentencepiece

from stayline.llm import pieces

MODEL = pieces.load_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def samples(n=400):
    rng = random.Random(3)
    own = [p[0].replace(pieces.MARK, " ") for p in MODEL.pieces if p[2] == pieces.NORMAL]
    odd = "aeio ntsrléß 中\n\t  123😀—…ab"
    texts = ["".join(rng.choice(own) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["", " ", "  a  b ", "aaaaaaaaaaaaaaaaaaaa", "<s>hi</s><unk>", "▁x"]


def test_same_ids_and_text_as_the_library(docs, got):
    texts = samples()
    encoded = pieces.encode(docs(*enumerate(texts)), MODEL)
    found = got(encoded, "doc_id", "piece_ids", "n_pieces", "round_trip")
    decoded = got(pieces.decode(encoded, MODEL), "doc_id", "decoded")
    for i, text in enumerate(texts):
        ids = LIBRARY.encode(text)
        assert found[i][0] == ids and found[i][1] == len(ids), text
        assert decoded[i][0] == LIBRARY.decode(ids)
        assert found[i][2] == (decoded[i][0] == text)


def test_null_repeated_rows_long_text_and_clashing_columns(spark):
    long = "ab cd " * 200_000
    table = spark.createDataFrame([(1, None, "k"), (2, "ab", "k"), (2, "ab", "k"), (3, long, "k")], "doc_id long, text string, n_pieces string")
    rows = sorted(pieces.encode(table, MODEL).select("doc_id", "piece_ids", "n_pieces", "round_trip").collect(), key=lambda r: r[0])
    assert tuple(rows[0]) == (1, [], 0, None) and rows[1] == rows[2] and rows[3].round_trip
    assert rows[3].n_pieces == len(rows[3].piece_ids) == len(LIBRARY.encode(long))
    assert pieces.encode(table.limit(0), MODEL).count() == 0


def test_unigram_scores_reach_the_best_path():
    model = pieces.PieceModel(
        [("<unk>", 0.0, pieces.UNKNOWN)] + [(f"<0x{b:02X}>", -20.0, pieces.BYTE) for b in range(256)]
        + [(t, s, pieces.NORMAL) for t, s in {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.5, "ba": -2.2, "aba": -7.0, "▁a": -2.6}.items()],
        False, True, False,
    )
    codec = pieces.Codec(model)
    scores = {t: s for t, s, k in model.pieces if k == pieces.NORMAL}

    def best(text):
        if not text:
            return 0.0
        low = min(scores.values()) - pieces.UNKNOWN_PENALTY
        paths = [best(text[: -len(t)]) + s for t, s in scores.items() if text.endswith(t)]
        return max(paths + ([] if text[-1] in scores else [best(text[:-1]) + low]))

    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("aab ") for _ in range(rng.randint(1, 9)))
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        ids = memoryview(codec.encode(text)).cast("i").tolist()
        assert abs(sum(model.pieces[i][1] for i in ids) - best(marked)) < 1e-9
        assert codec.decode(ids) == text
