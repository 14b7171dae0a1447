import random

from tokenizers import Tokenizer

from stayline.llm import licences, token_counts

LIBRARY = Tokenizer.from_file(token_counts.tokenizer_path())


def test_counts_of_the_library(docs, got):
    rng = random.Random(1)
    odd = "aZ é́ßİǅΣς ​ \x1c\x85\t\n 12'³中😀<|endoftext|>"
    texts = [None, "", "  ", "don't 'S it's<|endoftext|>b <|startoftext|> x", "Hello  World " * 3000]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    table = docs(*enumerate(texts)).selectExpr("doc_id", "text", "'k' AS n_tokens", "0 AS chunk")
    found = got(token_counts.token_counts(table), "doc_id", "n_bytes", "n_tokens", "over_limit")
    for i, text in enumerate(texts):
        n = len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
        assert found[i] == (len((text or "").encode()), n, n > 2048), text


def test_small_caches_repeated_rows_and_empty_table(docs, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 10)
    monkeypatch.setattr(token_counts, "FREQUENT", 3)
    monkeypatch.setattr(token_counts, "SLICE", 200)
    texts = [" ".join(f"word{(i * j) % 97}" for j in range(40)) for i in range(60)]
    rows = token_counts.token_counts(docs(*[(i // 2, texts[i // 2]) for i in range(120)])).collect()
    assert len(rows) == 120
    assert all(r.n_tokens == len(LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in rows)
    assert token_counts.token_counts(docs()).count() == 0


def test_licence_rules(docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    texts = [
        (1, None), (2, ""), (3, "Some prose. Nothing known."), (4, "x\nReleased under the MIT License.\ny"), (5, "LICENSED under the Apache License, Version 2.0.  More."),
        (6, mit), (7, "All rights reserved.\nLicensed under CC BY-NC 4.0."), (8, "Licensed under CC BY 4.0. Released under the MIT License."), (9, "w " * 400_000 + "\nMIT License\n"),
        (10, "I was not released under the MIT License at all"),
    ]
    found = {r.doc_id: r for r in licences.scan(docs(*texts, (4, "x\nReleased under the MIT License.\ny"))).collect()}
    assert {k: (list(r.licences), list(r.unmatched)) for k, r in found.items()} == {
        1: ([], []), 2: ([], []), 3: ([], []), 4: (["MIT"], []), 5: (["Apache-2.0"], []), 6: (["MIT"], []), 7: (["CC-BY-NC-4.0"], ["rights"]),
        8: (["CC-BY-4.0", "MIT"], []), 9: (["MIT"], []), 10: ([], []),
    }
    assert found[6].sentences == ["mit_grant", "mit_notice"]
    assert licences.scan(docs()).count() == 0
    plan = licences.scan(docs((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_every_sentence_passes_the_filter_and_is_in_normal_form():
    import re

    for texts in licences.SENTENCES.values():
        for text in texts:
            assert re.search(licences.HINTS.removeprefix("(?i)"), text) and re.sub("[^a-z0-9]+", " ", text.lower()).strip() == text
    assert {i for _, ids in licences.RULES for i in ids} <= set(licences.SENTENCES)
