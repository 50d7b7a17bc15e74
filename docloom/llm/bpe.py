"""Operator 3, BPE encoding and decoding with a word-ending vocabulary file.

Texts are normalised and cut into words as the file's rules say; words not met before are merged together, in rounds, over one flat
array of symbols: in each round every word merges its lowest-ranked pair, found by binary search over
the sorted pair keys.  A word of over ``LONG_WORD`` letters, such as a page of a script without spaces, is merged by itself with its pairs in a heap.  The ids of words already met come from a bounded cache.  Decoding joins the tokens' strings by one space.

Null text: no tokens.  Null doc_id, repeated rows: encoded like any other.  Empty table: no rows.  Columns other than
doc_id and text are ignored.  The strings of special tokens inside a text are those tokens, as the library has it by default.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import handing_back

CACHE_WORDS = 200_000
LONGEST_CACHED = 64
#: Characters of neighbouring texts that are cut into words at once; a word takes some ten times its letters.
SLICE = 1 << 18
#: Letters from which a word is merged by itself.
LONG_WORD = 1000
NO_RANK = np.int32(2**31 - 1)

# White space and the word pattern of the vocabulary file.
SPACE = "\t-\r \x85\xa0  -     　"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_ANY = regex.compile(rf"{_ENDINGS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
_LATIN_L, _LATIN_N = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN = re.compile(f"{_ENDINGS}|[{_LATIN_L}]+|[{_LATIN_N}]|[^\t-\r \x85\xa0{_LATIN_L}{_LATIN_N}]+")
_ASCII = re.compile(f"{_ENDINGS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints in Latin-1, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Vocabulary:
    """The tables of one vocabulary file; a few MB, whatever the corpus."""

    def __init__(self, text: str):
        model = json.loads(text)
        ids = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for t, i in (ids | self.special).items():
            self.tokens[i] = t
        end = model["model"]["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([ids[c] for c in symbols], np.int32)
        self.last = np.array([ids[c + end] for c in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]


def merge_words(vocab: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Ids of each word (UTF-8, not empty)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocab.inner[raw]
    symbols[np.cumsum(lengths) - 1] = vocab.last[raw[np.cumsum(lengths) - 1]]
    owner = np.repeat(np.arange(len(words)), lengths)
    out: list[np.ndarray] = [None] * len(words)
    while len(symbols):
        pair = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(vocab.keys, pair), len(vocab.keys) - 1)
        known = (vocab.keys[at] == pair) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(known, vocab.ranks[at], NO_RANK), NO_RANK)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbols)))
        done = least == NO_RANK
        for k in np.flatnonzero(done):
            out[owner[starts[k]]] = symbols[starts[k] : starts[k] + sizes[k]].astype("<u4")
        chosen = np.flatnonzero((rank == np.repeat(least, sizes)) & (rank != NO_RANK))
        # Of pairs that overlap (a a a) the first, third, ... of each run are merged.
        breaks = np.append(True, np.diff(chosen) != 1)
        heads = np.flatnonzero(breaks)
        nth = np.arange(len(chosen)) - np.repeat(heads, np.diff(np.append(heads, len(chosen))))
        chosen = chosen[nth % 2 == 0]
        symbols = symbols.copy()
        symbols[chosen] = vocab.made[at[chosen]]
        stay = np.repeat(~done, sizes)
        stay[chosen + 1] = False
        symbols, owner = symbols[stay], owner[stay]
    return out


def merge_long(vocab: Vocabulary, word: bytes) -> np.ndarray:
    """Ids of one long word, whose pairs wait in a heap by rank and place: every round of ``merge_words`` would go through all of it."""
    raw = np.frombuffer(word, np.uint8)
    first = vocab.inner[raw]
    first[-1] = vocab.last[raw[-1]]
    pair = first[:-1].astype(np.int64) << 32 | first[1:]
    at = np.minimum(np.searchsorted(vocab.keys, pair), len(vocab.keys) - 1)
    known = np.flatnonzero(vocab.keys[at] == pair)
    heap = list(zip(vocab.ranks[at[known]].tolist(), known.tolist(), vocab.made[at[known]].tolist(), pair[known].tolist(), strict=True))
    heapq.heapify(heap)
    symbols, n = first.tolist(), len(first)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    keys, ranks, made = vocab.keys, vocab.ranks, vocab.made

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            own = symbols[i] << 32 | symbols[j]
            k = int(keys.searchsorted(own))
            if k < len(keys) and keys[k] == own:
                heapq.heappush(heap, (int(ranks[k]), i, int(made[k]), own))

    while heap:
        _, i, new, own = heapq.heappop(heap)
        j = after[i]
        if j >= n or symbols[i] < 0 or symbols[i] << 32 | symbols[j] != own:
            continue  # one of the two is merged by now
        symbols[i], symbols[j] = new, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([x for x in symbols if x >= 0], "<u4")


class Codec:
    """Encoder and decoder with a cache of words, which is emptied when it is full."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.cache = vocab, {}
        self.split = re.compile("|".join(map(re.escape, sorted(vocab.special, key=len, reverse=True)))) if vocab.special else None

    def words(self, text: str) -> list[str]:
        """Normalised words of a stretch without special tokens."""
        if text.isascii():
            return _ASCII.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()  # the library lower-cases letter by letter, without the final sigma
        return (_LATIN if max(text) <= "\xff" else _ANY).findall(text)

    def pieces(self, text: str) -> list[list[str] | int]:
        """Words of each stretch, and the ids of special tokens between them."""
        if not any(x in text for x in self.vocab.special):
            return [self.words(text)]
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [self.words(text[at : m.start()]), self.vocab.special[m[0]]]
            at = m.end()
        return [*out, self.words(text[at:])]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        fresh = list({w for own in cut for p in own if not isinstance(p, int) for w in p if w not in cache})
        short = [w for w in fresh if len(w) <= LONG_WORD]
        encoded = dict(zip(short, (x.tobytes() for x in merge_words(self.vocab, [w.encode() for w in short])), strict=True)) if short else {}
        encoded.update((w, merge_long(self.vocab, w.encode()).tobytes()) for w in fresh if len(w) > LONG_WORD)
        cache.update((w, x) for w, x in encoded.items() if len(w) <= LONGEST_CACHED)
        look = (lambda w: cache.get(w) or encoded[w]) if any(len(w) > LONGEST_CACHED for w in fresh) else cache.__getitem__
        return [b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(look, p)) for p in own) for own in cut]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _slices(texts, limit: int = SLICE):
    """Neighbouring texts of together about ``limit`` characters."""
    own, held = [], 0
    for t in texts:
        own.append(t.as_py() or "")
        held += len(own[-1])
        if held >= limit:
            yield own
            own, held = [], 0
    if own:
        yield own


def _over(docs: DataFrame, vocab_text: str, fields: list[tuple[str, pa.DataType]], row, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocab_text)

    def run(batches):
        codec = Codec(Vocabulary(shared.value))
        for batch in batches:
            rows = [row(codec, ids) for own in _slices(batch.column(1)) for ids in codec.encode_batch(own)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *[n for n, _ in fields]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(handing_back(run), f"doc_id {kind}, {schema}")


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and n_tokens.  The driver reads the file; executors get its text."""
    fields = [("ids", pa.binary()), ("n_tokens", pa.int64())]
    return _over(docs, _read(vocab_path), fields, lambda codec, ids: (ids, len(ids) // 4), "ids binary, n_tokens bigint")


def round_trip_report(docs: DataFrame, vocab_path: str) -> DataFrame:
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def row(codec, ids):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()

    return _over(docs, _read(vocab_path), fields, row, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, ids) -> doc_id and the decoded text."""
    shared = encoded.sparkSession.sparkContext.broadcast(_read(vocab_path))

    def run(batches):
        codec = Codec(Vocabulary(shared.value))
        for batch in batches:
            texts = pa.array([codec.decode(x.as_py() or b"") for x in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(handing_back(run), f"doc_id {kind}, text string")
