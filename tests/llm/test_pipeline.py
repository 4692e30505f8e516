"""The pipeline's stages on a small corpus, each against plain rules on its own input."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from geosync.llm import bpe, fertility, jaccard, language, packing  # noqa: E402
from test_jaccard import plain_components, plain_set  # noqa: E402
from test_repeats import plain_strip, plain_words  # noqa: E402
from test_text_operators import check_packing  # noqa: E402

COLUMNS = list(pipeline.COLUMNS)


def near_words(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Real documents, some null and empty ones, and a repeated row."""
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 250").select(*COLUMNS)
    more = [(9000, None, "en", "src0", None), (9001, "", None, None, 0), (9002, "... 123 !!", "en", "src1", 10)]
    first = real.where("doc_id = 11").collect()
    path = tmp_path_factory.mktemp("tables")
    real.unionByName(spark.createDataFrame(more + [tuple(first[0])], real.schema)).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = pipeline.documents(spark, folder)
    seen = {}
    for name, function in pipeline.STAGES[:-1]:
        made = pipeline.stage(function(spark, docs, folder), name)
        assert made.columns == COLUMNS
        seen[name] = (docs, made)
        docs = made

    before, after = seen["language"]
    found = {r["doc_id"]: r for r in language.identify(before).collect()}
    want = sorted(d for d, r in found.items() if r["lang_pred"] != "und" and r["score"] >= language.LEAST_SCORE)
    assert sorted({r["doc_id"] for r in after.collect()}) == want and not {9000, 9001, 9002} & set(want) and len(want) == 250
    assert after.count() == 251

    before, after = seen["quality"]
    judged = fertility.judge(fertility.measure(before, bpe.default_path(fertility.VOCABULARY), keep=("lang",)), "lang")
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r in judged.where("kept").collect())

    before, after = seen["near_duplicates"]
    sets = [(r["doc_id"], near_words(r["text"])) for r in before.collect()]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    tops = plain_components([d for d, _ in sets], [(a, b) for a, b in links if a != b])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(tops.values()))

    before, after = seen["repeated_passages"]
    rows = before.collect()
    kept = [x[3].decode("utf-8", "ignore") for x in plain_strip([r["text"] for r in rows], 400)]
    kept = [x if isinstance(x, str) else bytes(x).decode() for x in plain_words(kept, pipeline.PASSAGE)]
    assert {r["doc_id"]: r["text"] for r in after.collect()} == dict(zip([r["doc_id"] for r in rows], kept))
    assert [name for name, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "repeated_passages", "packing"]
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_run(spark, folder):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.default_path())
    packed = pipeline.run(spark, folder).collect()
    docs = pipeline.documents(spark, folder)
    for _, function in pipeline.STAGES[:-1]:
        docs = pipeline.stage(function(spark, docs, folder), "again")
    want = {r["doc_id"]: [*library.encode(r["text"], add_special_tokens=False).ids, 2] for r in docs.collect()}
    check_packing(packed, want, packing.Rules().window)


def test_repeated_ids(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1)] * 3 + [(2, "a b c d e f g", "en", "s", 1), (3, "something else altogether here", "en", "s", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(docs, pipeline.NEAR).collect()) == [1, 3]
    assert len(plain_set("a b c d")) == 2


def test_empty(spark, folder):
    docs = pipeline.documents(spark, folder).limit(0)
    for name, function in pipeline.STAGES:
        docs = pipeline.stage(function(spark, docs, folder), name)
        assert docs.count() == 0


def test_short_passages_of_over_fifty_words_go(spark):
    passage = [f"w{k}" for k in range(51)]
    rest = [" ".join(f"{c}{k}" for k in range(80)) for c in "abcd"]
    texts = [f"{rest[0]} {' '.join(passage)} {rest[1]}", f"{rest[2]}\n{' '.join(passage)}", f"{' '.join(passage[1:])} {rest[3]}"]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.cut_repeated_passages(spark, docs, "").collect()}
    want = [f"{rest[0]}  {rest[1]}", f"{rest[2]}\n", texts[2]]
    assert len(" ".join(passage)) < 400 and kept == {k: (t, len(t)) for k, t in enumerate(want)}


def test_passages_of_messy_rows(spark, messy, nothing):
    passage = " ".join(f"w{k}" for k in range(51))
    more = [(700, f"{passage} tail", "en", "s", 1), (701, f"head {passage}", None, None, None), (None, None, None, None, None)]
    columns = list(pipeline.COLUMNS)
    docs = messy.select(*columns).unionByName(spark.createDataFrame(more, messy.select(*columns).schema)).withColumn("cell", F.lit(1)).withColumn("key", F.lit("x"))
    made = pipeline.cut_repeated_passages(spark, docs, "")
    assert made.columns == columns and made.count() == docs.count()
    assert {r["doc_id"]: r["text"] for r in made.where("doc_id IN (700, 701)").collect()} == {700: " tail", 701: "head "}
    assert pipeline.cut_repeated_passages(spark, nothing.withColumn("key", F.lit(1)), "").count() == 0


def test_no_language_to_learn_from(spark):
    rows = [(k, t, lang, "s", 1) for k, (t, lang) in enumerate([("some text", None), ("слово", None), ("12 !", None), ("", None), (None, "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.keep_known_languages(spark, docs, "")
    assert kept.columns == COLUMNS and sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


def test_only_halves_of_characters_go(spark):
    passage = " ".join(f"abc{k}" for k in range(100))
    # beside the passage: characters whose halves lie in it, in the first text two that would make a third together
    texts = [f"\ufffd one é{passage}è", f"two ©{passage}é \ufffd", f"three {'漢'}{passage}{'漣'}"]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.cut_repeated_passages(spark, docs, "").collect()}
    want = ["\ufffd one ", "two  \ufffd", "three 漢漣"]
    assert kept == {k: (t, len(t)) for k, t in enumerate(want)}
