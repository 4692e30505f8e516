"""Byte-pair encoding by backtracking over longest token matches, and decoding from an offset table.

A sequence of tokens is what the merges make of a text exactly when each pair of neighbours is what the merges make of
the pair's own text. So an encoder need not merge: an Aho-Corasick automaton lists the tokens that start at each place,
the longest one that agrees with its left neighbour is taken, and where none fits the encoder steps back. A place is
given up at most once, so the work is linear in the text. Neighbours are looked up in a compatibility table, filled when
a pair is first met.

Texts are cut into words as the vocabulary file says (special tokens, NFC, lower case, the split pattern), and the ids of
a word are kept, since most words of a corpus come again.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from geosync.llm.staging import documents, per_worker, tidy

#: Fixed by the byte-level alphabet: the bytes that stand for themselves; all others follow from U+0100 on.
PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))
#: Fixed by the vocabulary file: how words are split, and the suffix of a word's last symbol.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"
#: The same split for texts of these characters only, which a simpler pattern can do.
LATIN_ONLY = r"[^\x00-\x7fß-öø-ÿœ]"
LATIN_PATTERN = r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿœ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿœ]+"
#: Stands for the suffix inside the encoder; not in the byte-level alphabet.
END = "Ȁ"
#: Words and pairs kept per worker; a full table is emptied and filled anew.
KEPT_WORDS = 300_000
KEPT_LIBRARY_WORDS = 100_000
KEPT_PAIRS = 500_000

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte."""
    chars = {b: chr(b) for b in PLAIN_BYTES}
    for k, b in enumerate(b for b in range(256) if b not in PLAIN_BYTES):
        chars[b] = chr(256 + k)
    return [chars[b] for b in range(256)]


class Vocabulary:
    """The tokens and merges of a vocabulary file, with the tables that encoding and decoding need.

    Without ``own_encoding`` those for ``encode_word`` are left out.
    """

    def __init__(self, path: str, own_encoding: bool = True):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.chars = byte_alphabet()
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in [*vocab.items(), *self.special.items()]:
            names[i] = name
        parts = [f"{name} ".encode() for name in names]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        if not own_encoding:
            return
        own = {c: c for c in self.chars} | {c + WORD_END: c + END for c in self.chars}
        self.merges: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            own[a + b] = own[a] + own[b]
            self.merges.setdefault((own[a], own[b]), rank)
        self.ids = {mine: vocab[name] for name, mine in own.items() if name in vocab}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        self.symbols = {i: self.split(token) for token, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}

    @staticmethod
    def split(token: str) -> list[str]:
        """The symbols that the merges start from."""
        return [*token[:-2], token[-2:]] if token.endswith(END) else list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges make of a few symbols, in the order of their ranks."""
        out = list(symbols)
        while len(out) > 1:
            ranks = [self.merges.get(pair, -1) for pair in zip(out, out[1:])]
            found = [r for r in ranks if r >= 0]
            if not found:
                break
            k = ranks.index(min(found))
            out[k : k + 2] = [out[k] + out[k + 1]]
        return out

    def is_sound(self, token: int) -> bool:
        """Whether the merges make the token of its own text."""
        known = self.sound.get(token)
        if known is None:
            known = self.sound[token] = len(self.merged(self.symbols[token])) == 1
        return known

    def fits(self, left: int, right: int) -> bool:
        """The compatibility table: whether two tokens stay as they are side by side."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            a, b = self.symbols[left], self.symbols[right]
            known = self.pairs[key] = self.merged(a + b) == ["".join(a), "".join(b)]
        return known

    def spelled(self, word: str) -> str:
        """A word in the byte-level alphabet."""
        chars = self.chars
        return "".join([chars[b] for b in word.encode()])

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word."""
        text = self.spelled(word) + END
        size = len(text)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for last, (token, length) in self.automaton.iter(text):
            starting[last - length + 1].append((token, last + 1))  # shorter ones come first
        path: list[int] = []
        ends: list[int] = []
        dead = bytearray(size + 1)
        at = 0
        while at < size:
            taken = -1
            left = path[-1] if path else -1
            for token, end in reversed(starting[at]):
                if not dead[end] and self.is_sound(token) and (left < 0 or self.fits(left, token)):
                    taken = token
                    break
            if taken >= 0:
                path.append(taken)
                ends.append(end)
                at = end
            else:
                dead[at] = 1
                if not path:
                    raise ValueError(f"the vocabulary can't encode {word!r}")
                path.pop()
                ends.pop()
                at = ends[-1] if ends else 0
        return path

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with spaces between, cut from one array by the offset table."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        out = self.blob[np.repeat(self.places[ids] - ends + sizes, sizes) + np.arange(ends[-1])]
        return out[:-1].tobytes()


class Encoder(dict):
    """Ids of whole texts as little-endian 32-bit integers; a dictionary of the words met so far.

    ``word_ids`` gives the ids of a word not met yet.
    """

    def __init__(self, vocabulary: Vocabulary, word_ids: Callable[[str], list[int]], kept: int = KEPT_WORDS):
        super().__init__()
        self.kept = kept
        self.vocabulary = vocabulary
        self.word_ids = word_ids
        self.words = regex.compile(WORD_PATTERN).findall
        self.latin_words = re.compile(LATIN_PATTERN).findall
        self.beyond_latin = re.compile(LATIN_ONLY).search
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.word_ids(word), "<u4").tobytes()
        if len(self) >= self.kept:
            self.clear()
        self[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a capital sigma doesn't look at its neighbours
        text = text.lower()
        words = self.words(text) if self.beyond_latin(text) else self.latin_words(text)
        return b"".join(map(self.__getitem__, words))

    def encode(self, text: str) -> bytes:
        if self.marks is None or "<|" not in text:
            return self._plain(text)
        special = self.vocabulary.special
        parts = self.marks.split(text)
        return b"".join(np.uint32(special[x]).tobytes() if x in special else self._plain(x) for x in parts)


def encoder(path: str) -> Encoder:
    """The worker's backtracking encoder for a vocabulary file."""

    def make() -> Encoder:
        vocabulary = Vocabulary(path)
        return Encoder(vocabulary, vocabulary.encode_word)

    return per_worker(("bpe", path), make)


def library_encoder(path: str) -> Encoder:
    """The worker's encoder whose words are encoded by the tokenizers library."""

    def make() -> Encoder:
        from tokenizers import Tokenizer

        vocabulary, model = Vocabulary(path, own_encoding=False), Tokenizer.from_file(path).model
        return Encoder(vocabulary, lambda word: [x.id for x in model.tokenize(vocabulary.spelled(word))], KEPT_LIBRARY_WORDS)

    return per_worker(("library", path), make)


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: number of tokens, and the digests of its ids and of the text decoded from them.

    A null text counts as empty, and an empty text has no tokens; the digests are then those of nothing. Repeated rows
    each give a row. Other columns of ``docs`` are not read. One pass without a shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        decode = own.vocabulary.decode
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs[id_column].cast("long"), docs[text_column].cast("string")).mapInArrow(tidy(run), RESULT)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document its ids as an array; the rules are those of ``round_trip``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(own.encode(x.as_py() or ""), "<u4").astype(np.int32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(docs[id_column].cast("long"), docs[text_column].cast("string")).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Per row the text of its ids; null ids give an empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(np.array(x.as_py() or [], np.int64)).decode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(rows[id_column].cast("long"), rows[ids_column].cast("array<int>")).mapInArrow(tidy(run), "doc_id long, text string")


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(documents(spark, folder), default_path())
