"""Quality rules: repetition and symbol counts, and the fertility of a public tokeniser with bands per language or script.

A subword vocabulary splits ordinary prose into few, varied pieces. Text that it was not made for falls into short
pieces or bytes, and repetitive text uses few different ones. Three measures say so: characters per token, the share of
tokens that are single bytes (not those of line breaks and tabs), and the entropy of the tokens as a share of the most that their number allows. A document
is rejected where a measure lies outside its language's band. The bands come from the quartiles over all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.bpe import default_path
from geosync.llm.staging import carried, carried_arrays, documents, per_worker, stage, tidy
from geosync.llm.textbytes import SPACE, Hashes, Slice, mix, shingle_hashes, text_slices

VOCABULARY = "piece_bpe_32k.model"
#: Byte tokens that say nothing of a text's language: line breaks and other white space have no tokens of their own.
BLANK_BYTES = {f"<0x{b:02X}>" for b in np.flatnonzero(SPACE).tolist()}
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True
WINDOW = 8
#: Beyond so many tokens a text's entropy hardly grows; below, it is compared with the logarithm of their number.
ENTROPY_TOKENS = 512
MEASURES = ("chars_per_token", "byte_share", "entropy")
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, entropy double, script string"
)
#: First code point, last code point and name of the scripts told apart; letters of no such range are "other".
SCRIPTS = (
    (0x41, 0x24F, "latin"), (0x370, 0x3FF, "greek"), (0x400, 0x52F, "cyrillic"), (0x590, 0x5FF, "hebrew"),
    (0x600, 0x6FF, "arabic"), (0x900, 0x97F, "devanagari"), (0xE00, 0xE7F, "thai"), (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
)


@dataclass(frozen=True)
class Bands:
    """How far from its language's middle half a measure may lie, in widths of that half; ``least`` is the least width.

    Measures of few tokens scatter more: the reach grows by ``scatter`` over the root of the number of tokens.
    """

    reach: float = 2.0
    scatter: float = 16.0
    least: tuple[float, float, float] = (0.04, 0.006, 0.02)
    fewest_words: int = 20
    #: Fewer documents than this give no band; at most so many bands are made, of the largest groups.
    fewest_documents: int = 30
    most_bands: int = 1_000


def base_counts(part: Slice) -> dict[str, np.ndarray]:
    """Word, symbol and repetition counts of each text."""
    inside = ~SPACE[part.data]
    starts, ends, text = part.runs(inside)
    n = len(part)
    out = {"n_words": np.bincount(text, minlength=n)}
    out["word_chars"] = part.per_text(inside & ((part.data & 0xC0) != 0x80))
    out["n_symbols"] = part.per_text(SYMBOLS[part.data])
    hashes = Hashes(part.data)

    lo, hi, line_text = part.runs(part.data != 0x0A)
    worded = np.concatenate([[0], np.cumsum(inside)])
    full = worded[hi] > worded[lo]
    lo, hi, line_text = lo[full], hi[full], line_text[full]
    own = mix(hashes.of(lo, hi) + line_text.astype(np.uint64))
    _, firsts = np.unique(own, return_index=True)
    out["n_dup_lines"] = np.bincount(line_text, minlength=n) - np.bincount(line_text[firsts], minlength=n)

    windows, window_text = shingle_hashes(hashes.of(starts, ends), text, WINDOW)
    word_at = np.arange(max(0, len(starts) - WINDOW + 1))
    word_at = word_at[text[: len(word_at)] == text[WINDOW - 1 :]] if len(word_at) else word_at
    keys = mix(windows + window_text.astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(starts) + 1, np.int64)
    np.add.at(covered, word_at[twice], 1)
    np.add.at(covered, word_at[twice] + WINDOW, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = np.bincount(text[repeated], minlength=n)
    return out


def scripts(texts: list[str]) -> list[str]:
    """The script most letters of each text belong to."""
    bounds = np.array([x for lo, hi, _ in SCRIPTS for x in (lo, hi + 1)])
    names = np.array([*(name for _, _, name in SCRIPTS), "other"], object)
    out = []
    for text in texts:
        if text.isascii():
            out.append("latin")
            continue
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        k = np.searchsorted(bounds, points, side="right")
        kind = np.where(k % 2 == 1, k // 2, len(SCRIPTS))[points >= 0x41]
        out.append(names[np.bincount(kind, minlength=len(names)).argmax()] if len(kind) else "other")
    return out


def fertility(part: Slice, texts: list[str], pieces, is_byte: np.ndarray) -> dict[str, np.ndarray]:
    """Tokens, characters per token, share of byte tokens (``is_byte``, by id) and relative entropy of each text."""
    coded = [np.array(ids, np.int64) for ids in pieces.encode(texts, num_threads=1)]
    n = len(texts)
    sizes = np.array([len(x) for x in coded])
    text = np.repeat(np.arange(n), sizes)
    line = np.concatenate(coded) if coded else np.zeros(0, np.int64)
    key = np.sort(text << 32 | line)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    counts = np.diff(np.append(at, len(key)))
    part_text = key[at] >> 32
    # entropy = log2 n - sum(c log2 c) / n
    logs = np.bincount(part_text, counts * np.log2(counts), minlength=n)
    safe = np.maximum(sizes, 1)
    entropy = np.log2(safe) - logs / safe
    chars = part.per_text((part.data & 0xC0) != 0x80)
    return {
        "n_tokens": sizes,
        "chars_per_token": chars / safe,
        "byte_share": np.bincount(text[is_byte[line]], minlength=n) / safe,
        "entropy": np.where(sizes > 1, entropy / np.log2(np.clip(sizes, 2, ENTROPY_TOKENS)), 1.0),
    }


def measure(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """All counts and measures of each whole text; ``keep`` are columns carried along.

    A null text has no words, lines or tokens. Repeated rows each give a row. No shuffle.
    """
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        def load():
            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return pieces, np.array([pieces.is_byte(i) and pieces.id_to_piece(i) not in BLANK_BYTES for i in range(pieces.get_piece_size())])

        pieces, is_byte = per_worker(("pieces", path), load)
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in names[1:]}
            values = batch.column(1)
            for part in text_slices(values):
                texts = [x or "" for x in values.slice(part.lo, len(part)).to_pylist()]
                found = base_counts(part) | fertility(part, texts, pieces, is_byte) | {"script": scripts(texts)}
                for name in names[1:]:
                    columns[name].extend(found[name])
            kinds = {"script": pa.string()} | {name: pa.float64() for name in MEASURES}
            arrays = [pa.array(columns[name], kinds.get(name, pa.int64())) for name in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, *carried_arrays(keep, text_column, batch.column(1), batch.columns[2:])], names=[*names, *keep])

    schema = RESULT + "".join(f", {name} {kind}" for name, kind in docs.select(*keep).dtypes) if keep else RESULT
    return carried(docs, id_column, text_column, keep).mapInArrow(tidy(run), schema)


def judge(measured: DataFrame, group: str, bands: Bands = Bands()) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``: the base rules, then the bands of the rows' group.

    Bands come from the quartiles of all rows that pass the base rules. Rows without a group, or whose group has no band
    as it is small or beyond the largest ``most_bands``, share bands by script; only where these rows are too few for a
    band as well are they kept. A large group's band would not do for them, as it rejects what is usual in a rare
    language. Only the quartiles are shuffled, and ``most_bands`` of them broadcast at most.
    """
    failed = (F.col("n_words") < bands.fewest_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = measured.withColumn("base_failed", failed)

    def quartiles(some: DataFrame, by: str, name: str) -> DataFrame:
        found = some.where("NOT base_failed").groupBy(F.col(by).alias(f"{name}_of")).agg(
            F.count("*").alias("band_rows"), F.struct(*(F.percentile_approx(m, [0.25, 0.75], 2000).alias(m) for m in MEASURES)).alias(name)
        )
        found = found.where((F.col("band_rows") >= bands.fewest_documents) & F.col(f"{name}_of").isNotNull())
        found = found.orderBy(F.desc("band_rows"), f"{name}_of").limit(bands.most_bands).drop("band_rows")
        return F.broadcast(found)

    own = quartiles(rows, group, "own_band")
    judged = rows.join(own, rows[group] == own["own_band_of"], "left")
    shared = quartiles(judged.where("own_band IS NULL"), "script", "shared_band")
    judged = judged.join(shared, judged["script"] == shared["shared_band_of"], "left").withColumn("band", F.coalesce("own_band", "shared_band"))
    good = F.lit(True)
    for m, least in zip(MEASURES, bands.least):
        low, high = F.col(f"band.{m}")[0], F.col(f"band.{m}")[1]
        width = F.greatest(high - low, F.lit(least)) * bands.reach * (1 + bands.scatter / F.sqrt(F.greatest("n_tokens", F.lit(1))))
        good &= F.col(m) <= high + width if m == "byte_share" else F.col(m) >= low - width
    kept = ~F.col("base_failed") & F.coalesce(good, F.lit(True))
    return judged.withColumn("kept", kept).drop("band", *(f"{name}_band{end}" for name in ("own", "shared") for end in ("", "_of")))


def op8_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    measured = stage(measure(documents(spark, folder), default_path(VOCABULARY), keep=("lang",)), "fertility")
    return judge(measured, "lang").drop("lang")
