"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm import fertility, jaccard, language, packing, repeats
from geosync.llm.bitmaps import without
from geosync.llm.bpe import default_path
from geosync.llm.staging import discard, documents, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates here: shingles of five words, similarity of 80 percent or more.
NEAR = jaccard.Rules(words=5, percent=80)
#: Words of a passage that is cut where it repeats, however few bytes it has.
PASSAGE = 51
#: Cells twice as wide as usual, as two searches' shuffles lie on the disks at once; what is found is the same.
WIDE = repeats.Rules(cell=192)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that are like none of the languages learned; without any, only the former."""
    docs = docs.select(*COLUMNS)
    may_learn = ~language.is_held_out(docs["doc_id"]) & docs["lang"].isNotNull() & docs["text"].rlike(r"\p{L}")
    if docs.where(may_learn).isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, keep=COLUMNS[1:])
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= language.LEAST_SCORE)).select(*COLUMNS)


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the quality rules."""
    rows = docs.select(*COLUMNS).withColumn("_key", F.xxhash64("doc_id", "text"))
    measured = stage(fertility.measure(rows, default_path(fertility.VOCABULARY), keep=("lang", "_key")), "measured")
    rejected = fertility.judge(measured, "lang").where("NOT kept").select("_key").distinct()
    return without(rows, "_key", rejected).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but one document of each group of near copies."""
    return jaccard.one_of_each(docs.select(*COLUMNS), NEAR)


def what_is_kept(found: DataFrame) -> DataFrame:
    """The documents with what ``repeats.strip`` left of them."""
    cut = F.col("n_removed") > 0
    return found.withColumn("text", F.when(cut, F.col("kept").cast("string")).otherwise(F.col("text"))).select(
        "doc_id", "text", "lang", "source", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    )


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 400 bytes that come more than once, then passages of over 50 words that still do.

    The latter may have far fewer bytes. Characters cut in half go, and ``n_chars`` follows.
    """
    scratch: list[DataFrame] = []
    whole = stage(what_is_kept(repeats.strip(docs, keep=COLUMNS[1:], rules=WIDE, characters=True, scratch=scratch)), "passages")
    for table in scratch:
        discard(table)
    return what_is_kept(repeats.strip(whole, keep=COLUMNS[1:], rules=WIDE, words=PASSAGE))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 tokens."""
    return packing.pack(docs, default_path())


STAGES = [
    ("language", keep_known_languages),
    ("quality", keep_good_documents),
    ("near_duplicates", keep_one_of_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: No SQL for the vocabularies, models and search of these stages: the tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for k, (name, function) in enumerate(STAGES):
        made = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            discard(docs)
        docs = made
    return docs
