"""Encoding, packing, licenses, quality rules and language against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from geosync.llm import bpe, fertility, language, licenses, packing

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.default_path())


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_round_trip(spark, messy, nothing, library):
    want = []
    for doc_id, text in texts_of(messy):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(messy, bpe.default_path()).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(nothing, bpe.default_path()).count() == 0
    ids = bpe.encode(messy.where("doc_id = 10"), bpe.default_path())
    assert bpe.decode(ids, bpe.default_path()).first()["text"] == library.decode(ids.first()["ids"], skip_special_tokens=False)


def test_encoder_agrees_with_the_library(library):
    own, other = bpe.encoder(bpe.default_path()), bpe.library_encoder(bpe.default_path())
    draw = random.Random(3)
    pool = "aAbBzZ 'stTvelLdDmM09²½ \t\n\x1c\x85éÉßİΣσςΑαДж漢字あ😀👍🏽ǅﬁK.,!?‍﻿\x00"
    for _ in range(4000):
        text = "".join(draw.choice(pool if draw.random() < 0.6 else "aeioußéœ×÷'sr_9²\x1c\x0b\xa0.,ÿ ") for _ in range(draw.randint(0, 14))) + draw.choice(["", "", "<|endoftext|>q"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert np.frombuffer(other.encode(text), "<u4").tolist() == ids, text


def least_cost(ends, penalties, window, power):
    places, cost = [0, *ends], [0.0]
    for j in range(1, len(places)):
        spans = [(places[j] - places[i], i) for i in range(j) if places[j] - places[i] <= window]
        cost.append(min(cost[i] + (0 if s & (s - 1) == 0 and s >= power else window - s) for s, i in spans) + penalties[j - 1])
    return cost[-1]


def test_cuts_are_the_cheapest():
    draw = random.Random(1)
    rules = packing.Rules(window=32, shortest_power=4)
    for _ in range(200):
        ends = np.cumsum([draw.randint(1, 12) for _ in range(draw.randint(1, 40))])
        penalties = np.array([draw.choice([0.0, 6.0, 48.0]) for _ in ends])
        cuts = packing.choose_cuts(ends, penalties, rules, True)
        sizes = np.diff([0, *cuts])
        cost = sum(0 if s & (s - 1) == 0 and s >= 4 else 32 - s for s in sizes.tolist()) + penalties[np.searchsorted(ends, cuts)].sum()
        assert cuts[-1] == ends[-1] and sizes.max() <= 32
        assert cost == pytest.approx(least_cost(ends.tolist(), penalties, 32, 4))


def check_packing(rows, want, window):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, ids in want.items():
        pieces = sorted(docs.pop(doc_id), key=lambda r: r["start"])
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
        assert sum(p["length"] for p in pieces) == len(ids) == pieces[0]["doc_tokens"]
        for p in pieces:
            assert p["length"] > 0 and p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
    assert not docs
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
        assert sum(p["length"] for p in pieces) <= window
    return sequences


def test_packing_keeps_every_token(spark, messy, nothing, library):
    once = messy.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts_of(once)}
    for rules in (packing.Rules(), packing.Rules(window=64, longest=16, planned=200, shortest_power=8)):
        check_packing(packing.pack(once, bpe.default_path(), rules=rules).collect(), want, rules.window)
    assert packing.pack(nothing, bpe.default_path()).count() == 0
    assert packing.pack(messy, bpe.default_path()).where("start = 0").count() == messy.count()


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = packing.pack(docs, bpe.default_path()).groupBy("sequence_id").sum("length").collect()
    held = [r[1] for r in sizes]
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in held) < 0.015 * sum(held)


def plain_scan(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    extra, best = set(), 1.0 if places else 0.0
    for label, template in licenses.TEMPLATES:
        own, half = set(template.split()), len(template.split())
        for j in range(0, max(1, len(words)), half):
            share = len(own & set(words[j : j + 2 * half])) / len(own)
            if share >= licenses.THRESHOLD:
                extra.add(label)
                best = max(best, share)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | extra)), round(best, 9),
    )


def test_license_scan(spark, messy, nothing):
    filler = "ordinary words of a page about nothing at all with some more of them in the middle here"
    extra = [(1000 + k, f"{filler} {text.title()}, {filler}") for k, (_, text) in enumerate(licenses.TEMPLATES)]
    extra += [(2000, "MIT License\nGNU  General Public-License mit license cc by CC-BY"), (2001, "cc\nby"), (2002, " ".join(filler.split()[::-1]))]
    extra += [(2003, " ".join(w for i, w in enumerate(licenses.TEMPLATES[3][1].split()) if i not in (2, 9)))]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = [(r[0], *r[1:7], round(r[7], 9)) for r in licenses.scan(docs).collect()]
    want = [(d, *plain_scan(t)) for d, t in texts_of(docs)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(bool(w[6]) for w in want) > len(licenses.TEMPLATES)
    assert licenses.scan(nothing).count() == 0


def plain_counts(text):
    words = SPACED.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, messy, nothing):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    path = bpe.default_path(fertility.VOCABULARY)
    measured = fertility.measure(messy, path, keep=("lang",)).cache()
    got = sorted(((r["doc_id"], *(r[c] for c in columns)) for r in measured.collect()), key=repr)
    assert got == sorted(((d, *plain_counts(t)) for d, t in texts_of(messy)), key=repr)
    judged = fertility.judge(measured, "lang").collect()
    assert len(judged) == messy.count()
    for r in judged:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert fertility.judge(fertility.measure(nothing, path, keep=("lang",)), "lang").count() == 0


def test_fertility_measures(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = bpe.default_path(fertility.VOCABULARY)
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["The quick brown fox.", "ὦ 😀 ΩΩ \x01", "a a a a a a a a", "", "слово и дело"]
    rows = fertility.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).orderBy("doc_id").collect()
    for text, row in zip(texts, rows):
        ids = pieces.encode(text)
        shares = np.array(list(Counter(ids).values())) / max(1, len(ids))
        assert row["n_tokens"] == len(ids)
        assert row["byte_share"] == pytest.approx(sum(map(pieces.is_byte, ids)) / max(1, len(ids)))
        assert row["chars_per_token"] == pytest.approx(len(text) / max(1, len(ids)))
        if len(ids) > 1:
            assert row["entropy"] == pytest.approx(-(shares * np.log2(shares)).sum() / np.log2(min(len(ids), fertility.ENTROPY_TOKENS)))
    assert [r["script"] for r in rows] == ["latin", "greek", "latin", "latin", "cyrillic"]


def test_bands_reject_odd_documents_and_keep_the_rest(spark):
    draw = random.Random(2)
    clean = [" ".join(draw.choice(["the", "people", "of", "this", "house", "walk", "often", "along", "rivers", "and", "talk"]) for _ in range(200)) for _ in range(80)]
    odd = [" ".join("".join(draw.choice("qxzjkvw#*") for _ in range(6)) for _ in range(200)), "Ⱥ𐍈ꙮ " * 3 + " ".join(f"𐍈{chr(0x10380 + k)}{k}" for k in range(150))]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(clean + odd)], "doc_id long, text string, lang string")
    rows = fertility.judge(fertility.measure(docs, bpe.default_path(fertility.VOCABULARY), keep=("lang",)), "lang").collect()
    assert {r["doc_id"] for r in rows if not r["kept"] and not r["base_failed"]} == {80, 81}


def plain_grams(text):
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", language.lowered(pa.array([text]))[0].as_py()):
        word = f" {word} "
        for n in (1, 2, 3):
            counts.update(word[i : i + n] for i in range(len(word) - n + 1) if word[i : i + n] != " ")
    return counts


def name(gram):
    return "".join(" " if c == language.BLANK else chr(c) for c in (gram >> 42 & 0x1FFFFF, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF) if c)


def code(gram):
    return sum((language.BLANK if c == " " else ord(c)) << 21 * k for k, c in enumerate(reversed(gram)))


def plain_language(text, profiles, length):
    top = sorted(plain_grams(text or "").items(), key=lambda x: (-x[1], code(x[0])))[:length]
    if not top or not profiles:
        return "und", 0.0
    away = {lang: sum(abs(ranks[g] - k) if g in ranks else length for k, (g, _) in enumerate(top)) for lang, ranks in profiles.items()}
    best = min(sorted(away), key=away.get)
    return best, round(1 - away[best] / (len(top) * length), 9)


def test_language(spark, messy, nothing):
    held = [zlib.crc32(str("" if d is None else d).encode()) % 5 == 0 for d, _ in texts_of(messy)]
    got = sorted(((r[0], r[1], r[2], round(r[3], 9)) for r in language.identify(messy).collect()), key=repr)
    tallies = {}
    for r in messy.collect():
        if r["lang"] and r["text"] and zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5:
            tallies.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    length = language.PROFILE
    profiles = {x: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda y: (-y[1], code(y[0])))[:length])} for x, c in tallies.items()}
    want = [(d, h, *plain_language(t, profiles, length)) for (d, t), h in zip(texts_of(messy), held)]
    assert got == sorted(want, key=repr)
    assert language.identify(nothing).count() == 0
    assert {r["lang_pred"] for r in language.identify(messy.withColumn("lang", messy["lang"].substr(9, 1).isNull().cast("string")).where("text IS NULL")).collect()} == {"und"}


def test_language_accuracy_on_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)


def test_line_breaks_are_no_byte_fallback(spark):
    draw = random.Random(4)
    words = "the people of this house walk often along rivers and talk about old stories while children play near water every summer evening".split()
    prose = [[draw.choice(words[k % 7 : 12 + k % 11]) for _ in range(240)] for k in range(80)]
    texts = [" ".join(w) for w in prose] + ["\n".join(" ".join(w[i : i + 12]) for i in range(0, 240, 12)) for w in prose[:8]]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate([*texts, "a\nb\r\n\tc ὦ"])], "doc_id long, text string, lang string")
    rows = fertility.judge(fertility.measure(docs, bpe.default_path(fertility.VOCABULARY), keep=("lang",)), "lang").collect()
    assert {r["doc_id"] for r in rows if not r["kept"] and not r["base_failed"]} == set()
    assert {r["doc_id"] for r in rows if r["byte_share"] > 0} == {88}


def test_rare_languages_share_bands_by_script(spark):
    draw = random.Random(2)
    words = ["the", "people", "of", "this", "house", "walk", "often", "along", "rivers", "and", "talk"]
    clean = [" ".join(draw.choice(words) for _ in range(200)) for _ in range(120)]
    odd = " ".join("".join(draw.choice("qxzjkvw#*") for _ in range(6)) for _ in range(200))
    langs = [f"rare{k // 8}" if k < 80 else None if k < 85 else "en" for k in range(120)]
    rows = [*zip(range(120), clean, langs), (120, odd, "rare3"), (121, odd + " x", None), (122, " ".join(["слово"] * 3 + [f"дело{k}" for k in range(60)]), "rare1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = fertility.judge(fertility.measure(docs, bpe.default_path(fertility.VOCABULARY), keep=("lang",)), "lang")
    assert judged.columns == [*(x.split()[0] for x in fertility.RESULT.split(", ")), "lang", "base_failed", "kept"]
    assert {r["doc_id"] for r in judged.collect() if not r["kept"]} == {120, 121}
