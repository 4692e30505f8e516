"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams (one to three letters, words padded by a blank), most
frequent first. A document's own list is compared with each: an n-gram adds the difference of its two ranks, or the
profile's length where the profile lacks it. The smallest sum wins.

Only text is compared. The label column is read in ``learn`` alone, from the rows it may learn from.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geosync.llm.staging import carried, carried_arrays, documents, per_worker, tidy
from geosync.llm.textbytes import Slice, text_slices

#: Length of a language's profile and most n-grams taken of a document.
PROFILE = 400
#: A profile is learned from about so many documents of a language at most, chosen by a hash of the id.
LEARN_DOCUMENTS = 5_000
#: Languages learned at most, those with the most documents first; so what is broadcast has a bound.
LANGUAGES = 500
#: Rows of a result below this score look like none of the learned languages.
LEAST_SCORE = 0.25
#: Stands for the blank beside a word in an n-gram; 0 is for n-grams of fewer letters.
BLANK = 1
RESULT = "doc_id long, lang_pred string, score double"


def letter_table() -> np.ndarray:
    """Which code points are letters."""

    def make() -> np.ndarray:
        return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])

    return per_worker("letters", make)


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, n-gram and count, by text and n-gram. An n-gram is its code points in 21 bits each, U+0001 for a blank.

    ``part`` holds lower-cased texts.
    """
    points = np.frombuffer(part.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    heads = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.offsets]
    text = np.repeat(np.arange(len(part)), np.diff(heads))
    symbols = np.where(letter_table()[points], points, 0)
    first = np.zeros(len(points), bool)
    first[heads[:-1][heads[:-1] < len(points)]] = True
    before = np.concatenate([[0], symbols[:-1]])
    keep = (symbols > 0) | ((before > 0) & ~first)
    symbols, text, first = symbols[keep], text[keep], first[keep]
    opens = (symbols > 0) & np.concatenate([[True], (symbols[:-1] == 0) | (text[1:] != text[:-1])])[: len(symbols)]
    closes = (symbols > 0) & np.concatenate([text[1:] != text[:-1], [True]])[: len(symbols)]
    # a word's blanks: one before its first letter, one after its last
    places = np.arange(len(symbols)) + np.cumsum(opens) + np.concatenate([[0], np.cumsum(closes)])[:-1]
    total = len(symbols) + int(opens.sum()) + int(closes.sum())
    line = np.zeros(total, np.int64)
    owner = np.zeros(total, np.int64)
    line[places], owner[places] = symbols, text
    owner[places[opens] - 1] = text[opens]
    owner[places[closes] + 1] = text[closes]
    alphabet, dense = np.unique(line, return_inverse=True)
    bits = max(1, int(len(alphabet)).bit_length())
    blank = np.searchsorted(alphabet, 0) if len(alphabet) and alphabet[0] == 0 else -1
    keys = []
    letters = dense != blank
    keys.append(((owner << 2) << 3 * bits | dense)[letters])
    if total > 1:
        near = owner[1:] == owner[:-1]
        two = near & (letters[1:] | letters[:-1])
        keys.append(((owner[1:] << 2 | 1) << 3 * bits | dense[:-1] << bits | dense[1:])[two])
    if total > 2:
        three = near[1:] & near[:-1] & letters[1:-1]
        keys.append(((owner[2:] << 2 | 2) << 3 * bits | dense[:-2] << 2 * bits | dense[1:-1] << bits | dense[2:])[three])
    key = np.sort(np.concatenate(keys))
    if not len(key):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(at, len(key)))
    key = key[at]
    size = key >> 3 * bits & 3
    low = (1 << bits) - 1
    parts = [alphabet[np.minimum(key >> k * bits & low, len(alphabet) - 1)] for k in (2, 1, 0)]
    for k in (0, 1, 2):
        parts[k][parts[k] == 0] = BLANK
        parts[k][size < 2 - k] = 0
    return key >> 3 * bits + 2, parts[0] << 42 | parts[1] << 21 | parts[2], counts


def top_grams(text: np.ndarray, gram: np.ndarray, counts: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the ``most`` most frequent n-grams, ties by n-gram: text, n-gram, rank from 0."""
    order = np.lexsort((gram, -counts, text))
    text, gram = text[order], gram[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
    rank = np.arange(len(text)) - starts[text]
    kept = rank < most
    return text[kept], gram[kept], rank[kept]


class Profiles:
    """The learned profiles as one table: a row per n-gram, a column per language, ranks within."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int):
        self.length = length
        self.names = sorted({name for name, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int32)
        for name, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), self.names.index(name)] = rank

    def distances(self, text: np.ndarray, gram: np.ndarray, rank: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the out-of-place distance, and per text the number of n-grams compared."""
        at = np.searchsorted(self.grams, gram)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != gram)] = len(self.grams)
        other = self.ranks[at]
        away = np.where(other < 0, self.length, np.abs(other - rank[:, None]))
        starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
        sums = np.concatenate([np.zeros((1, len(self.names)), np.int64), np.cumsum(away, axis=0, dtype=np.int64)])
        return sums[starts[1:]] - sums[starts[:-1]], np.diff(starts)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.string()), ""))


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id's text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def learn(rows: DataFrame, label: str, text: str, chosen_by: str, length: int = PROFILE, most_documents: int = LEARN_DOCUMENTS) -> Profiles:
    """Profiles from ``rows`` with a label and a text.

    Of each label about ``most_documents`` rows are read, those whose hash of ``chosen_by`` is smallest in share; the
    profiles that come to the driver are ``length`` rows for each label.
    """
    known = rows.where(rows[label].isNotNull() & rows[text].isNotNull()).select(
        rows[label].cast("string").alias("name"), rows[text].cast("string").alias("text"), F.xxhash64(rows[chosen_by].cast("string")).alias("draw")
    )
    sizes = known.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(LANGUAGES)
    drawn = F.shiftrightunsigned("draw", 33) < F.lit(float(1 << 31)) * most_documents / F.col("n")
    sample = known.join(F.broadcast(sizes), "name").where(drawn).select("name", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes = np.asarray(names.indices)
            for part in text_slices(lowered(batch.column(1))):
                owner, gram, counts = grams(part)
                code = codes[part.lo : part.hi][owner]
                order = np.lexsort((gram, code))
                code, gram, counts = code[order], gram[order], counts[order]
                at = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (code[1:] != code[:-1])])[: len(gram)])
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [names.dictionary.take(pa.array(code[at])), pa.array(gram[at]), pa.array(np.add.reduceat(counts, at))],
                        names=["name", "gram", "n"],
                    )

    counted = sample.mapInArrow(tidy(count), "name string, gram long, n long").groupBy("name", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "gram")) - 1)
    return Profiles([tuple(r) for r in ranked.where(F.col("rank") < length).select("name", "gram", "rank").collect()], length)


def predict(docs: DataFrame, profiles: Profiles, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document the nearest language and a score: one less the distance as a share of the largest possible one.

    ``keep`` are columns carried along.
    A null text, one without a letter, and any text where nothing was learned, give ``und`` and 0. Of equally near
    languages the first by name wins. Repeated rows each give a row; other columns are not read. No shuffle.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = profiles
        names = np.array([*own.names, "und"], object)
        for batch in batches:
            picks, scores = [], []
            for part in text_slices(lowered(batch.column(1))):
                best, score = np.full(len(part), len(own.names)), np.zeros(len(part))
                if own.names and len(part.data):
                    text, gram, rank = top_grams(*grams(part), len(part), own.length)
                    away, compared = own.distances(text, gram, rank, len(part))
                    some = compared > 0
                    best[some] = away[some].argmin(axis=1)
                    score[some] = 1 - away[some].min(axis=1) / (compared[some] * own.length)
                picks.append(best)
                scores.append(score)
            picks = np.concatenate(picks) if picks else np.zeros(0, np.int64)
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[picks], pa.string()), pa.array(np.clip(scores, 0, 1), pa.float64()), *carried_arrays(keep, text_column, batch.column(1), batch.columns[2:])],
                names=["doc_id", "lang_pred", "score", *keep],
            )

    schema = RESULT + "".join(f", {name} {kind}" for name, kind in docs.select(*keep).dtypes) if keep else RESULT
    return carried(docs, id_column, text_column, keep).mapInArrow(tidy(run), schema)


def identify(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Predictions for all ``docs`` by profiles learned from those that are not held out."""
    profiles = learn(docs.where(~is_held_out(docs["doc_id"])), "lang", "text", "doc_id")
    found = predict(docs, profiles, keep=keep)
    return found.select("doc_id", is_held_out(found["doc_id"]).alias("held_out"), "lang_pred", "score", *keep)


def op5_rank_order_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(documents(spark, folder))
