import random

import pytest


def messy_rows():
    """Documents with everything that may go wrong; the columns beyond the five clash with names the operators use."""
    draw = random.Random(5)
    words = "the of and ing tion with Straße élan übung niño 漢字 слово x9 don't it's".split()
    prose = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 400))) + "." for _ in range(40)]
    texts = [
        None, "", " ", "\n\n", "a", "ab ab ab ab", "1 2 3 ...", "<|endoftext|> x <|startoftext|><|endoftext|>",
        "Licensed under the Apache License, Version 2.0.", "x " * 30_000, "ΑΣ Σ İstanbul ﬁ", "\x00\x1c\x85 z", "😀👍🏽 ok",
        *prose, *prose[:5], prose[0], prose[0].upper(), "same line\nsame line\nother\nsame line\n" + "w1 w2 w3 w4 w5 w6 w7 w8 " * 3,
    ]
    rows = [(k, t, ("en", "fr", None)[k % 3], f"src{k % 4}" if k % 5 else None, None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, "no id at all", None, None, None), (None, None, None, None, None), (-3, prose[3], "de", "src0", 1)]
    return [(*r, "n", 1.0, "s", "x", 7) for r in rows]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(
        messy_rows(), "doc_id long, text string, lang string, source string, n_chars long, name string, score double, shard string, n_tokens string, rank int"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def sorted_rows():
    return lambda df, *columns: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
