"""Repeated strings against a count of all of them."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from geosync.llm import bwt, repeats
from geosync.llm.textbytes import text_slices


def plain_strip(texts, least):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - least + 1):
            if counts[d[i : i + least]] > 1:
                gone[i : i + least] = True
        runs = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2).tolist()
        out.append((len(d), int(gone.sum()), [(a, b - a) for a, b in runs], bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def result(df, least=None):
    rows = df.collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows), key=repr)


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["ab", "abc", "é", "x", "longer", "漢", "qq"]
    say = lambda k: " ".join(draw.choice(words) + str(draw.randrange(300)) for _ in range(k))
    common = [say(12), say(5), say(30)]
    texts = [None, "", "a", "a" * 500, "ab" * 120, "a" * 37]
    for _ in range(n):
        text = say(draw.randint(0, 40))
        for _ in range(draw.choice([0, 0, 1, 2])):
            passage = draw.choice(common)
            cut = draw.randrange(len(passage))
            text = f"{text}{passage[cut // 3:]} {say(draw.randint(0, 10))}"
        texts.append(text)
    texts += [texts[10], texts[11], texts[11], texts[12][3:], "z" + texts[13]]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(
    "seed,rules",
    [
        (1, repeats.Rules(least=24, gram=6, cell=5, block=200)),
        (2, repeats.Rules(least=40, gram=8, cell=16)),
        (3, repeats.Rules(least=24, gram=6, cell=5, segments=2)),  # every larger key is dealt again
        (4, repeats.Rules(least=16, gram=5, cell=1)),
    ],
)
def test_exactly_the_repeated_bytes_go(spark, seed, rules):
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = sorted(((k, *row) for k, row in enumerate(plain_strip(texts, rules.least))), key=repr)
    assert result(repeats.strip(df, rules=rules)) == want
    assert any(w[2] for w in want)


def test_odd_input(spark, messy, nothing):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    rules = repeats.Rules(least=60, gram=16, cell=20)
    want = sorted(((d, *row) for (d, _), row in zip(rows, plain_strip([t for _, t in rows], 60))), key=repr)
    got = repeats.strip(messy, rules=rules, keep=("score", "n_tokens"))
    assert result(got) == want
    assert {(r["score"], r["n_tokens"]) for r in got.collect()} == {(1.0, "x")}
    assert repeats.strip(nothing, rules=rules).count() == 0


def test_long_texts_in_chunks(spark, monkeypatch):
    draw = random.Random(9)
    text = " ".join(str(draw.randrange(10**6)) for _ in range(3000))
    texts = [text, f"{text[5000:9000]} and more", f"{'x' * 1000}{text[:300]}"]
    part = next(text_slices(__import__("pyarrow").array([text])))
    monkeypatch.setattr(repeats, "CHUNK", 1 << 11)
    rules = repeats.Rules(least=100, gram=20, cell=30)
    starts = [(s + shift, s + shift + n) for piece, shift in repeats.pieces(part, rules) for s, n in zip(*repeats.cells_of(piece, rules)[3:])]
    assert sorted(x for a, b in starts for x in range(a, b)) == list(range(len(text) - 99))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(repeats.strip(df, rules=rules)) == sorted(((k, *row) for k, row in enumerate(plain_strip(texts, 100))), key=repr)


def test_interval_expansion():
    draw = random.Random(0)
    for _ in range(150):
        letters = draw.choice([b"ab", b"abc", b"abcdefgh"])
        base = bytes(draw.choice(letters) for _ in range(draw.randint(1, 60)))
        segments = []
        for _ in range(draw.randint(1, 12)):
            lo = draw.randint(0, len(base))
            part = bytearray(base[lo : draw.randint(lo, len(base))])
            if part and draw.random() < 0.5:
                part[draw.randrange(len(part))] = draw.choice(letters)
            segments.append(bytes(part))
        least = draw.randint(1, 12)
        counts = Counter(s[i : i + least] for s in segments for i in range(len(s) - least + 1))
        want = [i + least <= len(s) and counts[s[i : i + least]] > 1 for s in segments for i in range(len(s) + 1)]
        line = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, 0) for s in segments]).astype(np.uint16)
        order, rank = bwt.suffix_order(line)
        assert (rank[order] == np.arange(len(line))).all()
        assert bwt.repeated(line, least).tolist() == want


def plain_words(texts, words):
    """What stays when repeated runs of words go."""
    data = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    said = [[d[a:b].decode().lower() for a, b in p] for d, p in zip(data, places)]
    runs = [[tuple(w[i : i + words]) for i in range(len(w) - words + 1)] for w in said]
    counts = Counter(r for rs in runs for r in rs)
    out = []
    for d, p, rs in zip(data, places, runs):
        stays = np.ones(len(d), bool)
        for i, r in enumerate(rs):
            if counts[r] > 1:
                stays[p[i][0] : p[i + words - 1][1]] = False
        out.append(bytes(np.frombuffer(d, np.uint8)[stays]))
    return out


@pytest.mark.parametrize("seed,rules", [(1, repeats.Rules(gram=16, cell=24, block=200)), (2, repeats.Rules(gram=8, cell=16)), (3, repeats.Rules(gram=12, cell=5, segments=2))])
def test_repeated_words(spark, seed, rules):
    texts = [t and t.replace(" longer", "\n\n Longer", 1) if k % 3 else t for k, t in enumerate(corpus(seed))]
    texts += ["É a É a É a É a É a É a É a", "one\ttwo three four five six Seven", "x One two  three four five six seven\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in repeats.strip(df, rules=rules, words=7).collect()}
    assert kept == dict(enumerate(plain_words(texts, 7)))
    assert kept[len(texts) - 1] == b"x \n" and sum(k == b"" for k in kept.values()) < len(texts) / 2
