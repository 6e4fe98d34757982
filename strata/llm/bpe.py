"""BPE encoding and decoding with the vocabulary of a tokenizers JSON file.

A word is a doubly linked list of symbols (its bytes, the last one carrying the
end-of-word mark). A priority queue holds the merge ranks of adjacent pairs,
leftmost first among equals; an entry whose symbols have changed since it was
pushed is stale and skipped. Decoding concatenates vocabulary strings.

Supported files: BPE over bytes with an end-of-word suffix, NFC and lower-case
normalization, white space dropped, no post-processor, no decoder. Others are
rejected when the file is read.

The file is read on the driver and its tables (a few MB, fixed by the file) are
broadcast. Each Python worker memoizes the ids of words in a bounded number of
entries.

Defined results: a null text is empty and has no ids; ids outside the vocabulary
are skipped when decoding; repeated rows get equal results.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, prepare

CACHED, LONGEST_CACHED = 100_000, 32
CACHED_WORDS = 200_000   # more: words come back beside other punctuation, and are what takes time
_LOW = (1 << 32) - 1

# The file's own split pattern (fixed value); white space never matches.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
_SPLIT_IN_FILE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters and digits of Unicode 16.0 that 15.1 does not have (first and last code
# point), and capital letters of 16.0 and 17.0 with their small ones.
_NEWER_RANGES = """1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B
1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D
16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA"""
_NEWER_CASES = "1C89-1C8A A7CB-0264 A7CC-A7CD A7CE-A7CF A7D2-A7D3 A7D4-A7D5 A7DA-A7DB A7DC-019B"
_NEWER = frozenset(c for r in _NEWER_RANGES.split() for a, b in [r.split("-")] for c in range(int(a, 16), int(b, 16) + 1))
_NEWER_LOWER = {int(a, 16): int(b, 16) for a, b in (p.split("-") for p in _NEWER_CASES.split())} | \
    {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
_SPACE = regex.compile(r"\p{White_Space}+")
# str.split() also splits at these, which are not white space in Unicode.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files:
    printable Latin-1 characters stand for themselves, the rest follow U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b], extra = chr(extra), extra + 1
    return [symbols[b] for b in range(256)]


class Memo(dict):
    """Results of ``compute`` by key, in two generations of bounded size; long keys
    are not kept."""

    def __init__(self, compute, most):
        super().__init__()
        self.compute, self.most, self.aged = compute, most, {}

    def __missing__(self, key):
        value = self.aged.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= self.most:
                self.aged = dict(self)
                self.clear()
            self[key] = value
        return value


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if (model["type"] != "BPE" or spec["decoder"] or spec["post_processor"]
                or [s["type"] for s in steps] != ["Split", "ByteLevel"]
                or steps[0]["pattern"] != {"Regex": _SPLIT_IN_FILE}
                or normal != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]):
            raise ValueError(f"{path}: not a lower-case byte-level BPE file with word ends")
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        self.inner = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + end] for s in byte_symbols()]
        self.pairs = [(vocab[a] << 32) + vocab[b] for a, b in model["merges"]]   # by rank
        self.merged = [vocab[a + b] for a, b in model["merges"]]
        self.rank = {pair: rank for rank, pair in enumerate(self.pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self._start()

    def _start(self) -> None:
        self.special_at = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.by_id = pa.array([self.strings.get(i) for i in range(max(self.strings) + 1)], pa.large_string())
        self.known = self.by_id.is_valid().to_numpy(zero_copy_only=False)
        self.chunks = Memo(self._chunk, CACHED)
        self.words = Memo(lambda word: array("I", self.merge(word.encode())).tobytes(), CACHED_WORDS)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("special_at", "by_id", "known", "chunks", "words")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word. A queue entry is a rank and, below it, the left position."""
        symbol = [self.inner[b] for b in word]
        symbol[-1] = self.last[word[-1]]
        rank_of, pairs, merged = self.rank.get, self.pairs, self.merged
        queue = [(rank << 32) + i for i, (a, b) in enumerate(zip(symbol, symbol[1:]))
                 if (rank := rank_of((a << 32) + b)) is not None]
        if not queue:
            return symbol
        count = len(symbol)
        following = [*range(1, count), -1]
        previous = [*range(-1, count - 1)]
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            rank, left = entry >> 32, entry & _LOW
            right = following[left]
            if right < 0 or symbol[left] < 0 or (symbol[left] << 32) + symbol[right] != pairs[rank]:
                continue   # stale: one of the two has been merged since
            new = symbol[left] = merged[rank]
            symbol[right] = -1
            after = following[left] = following[right]
            if after >= 0:
                previous[after] = left
                if (rank := rank_of((new << 32) + symbol[after])) is not None:
                    push(queue, (rank << 32) + left)
            before = previous[left]
            if before >= 0 and (rank := rank_of((symbol[before] << 32) + new)) is not None:
                push(queue, (rank << 32) + before)
        return [s for s in symbol if s >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as 32-bit integers."""
        text = unicodedata.normalize("NFC", chunk)
        # One letter at a time: a final sigma is no special case.
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in text):
            # Unassigned characters are no letters, whatever a newer table says. The library's tables
            # are some versions ahead of ``unicodedata``.
            text = text.translate(_NEWER_LOWER)
            shape = "".join("\ue000" if unicodedata.category(c) == "Cn" and ord(c) not in _NEWER else c for c in text)
            pieces = [text[m.start():m.end()] for m in _PIECES.finditer(shape)]
        else:
            pieces = _PIECES.findall(text)
        return b"".join(map(self.words.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if self.special_at and any(s in text for s in self.special):
            return b"".join(
                array("I", [self.special[part]]).tobytes() if part in self.special
                else self._plain(part) for part in self.special_at.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        chunks = _SPACE.split(text) if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings, one space between: these files name no decoder."""
        return " ".join([s for s in map(self.strings.get, ids) if s is not None])

    def decode_lists(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The same for many lists of ids, one after the other: list i ends at ends[i + 1]."""
        known = (ids >= 0) & (ids < len(self.by_id))
        known[known] = self.known[ids[known]]
        if not known.all():
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            ids = ids[known]
        words = self.by_id.take(pa.array(ids.astype(np.int64)))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), pa.scalar(" ", pa.large_string()))
        return joined.cast(pa.string())


def _lists(blobs: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(b) // 4 for b in blobs)])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), "<i4"), pa.int32()))


def encode(df: DataFrame, vocabulary: str, *, text_col: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the column ``to``: array<int> of the text's ids (replaces a
    column of that name)."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Bpe(vocabulary))

    def run(text: pa.Array) -> pa.Array:
        one = shared.value.encode
        return _lists([one(t) if t else b"" for t in text.to_pylist()])

    return df.withColumn(to, arrow_column(run, "array<int>")(df[f"`{text_col}`"].cast("string")))


def decode(df: DataFrame, vocabulary: str, *, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the column ``to``: the concatenated vocabulary strings."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Bpe(vocabulary))

    def run(ids: pa.Array) -> pa.Array:
        values = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        return shared.value.decode_lists(values, _ends(ids))

    return df.withColumn(to, arrow_column(run, "string")(F.col(f"`{ids_col}`")))


def _ends(lists: pa.Array) -> np.ndarray:
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def round_trip(df: DataFrame, vocabulary: str, *, text_col: str = "text", to: str = "coded") -> DataFrame:
    """``df`` with the struct column ``to``: ids (little-endian unsigned 32-bit integers,
    one after the other, for storage) and decoded (their vocabulary strings), both in
    one pass over the texts."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Bpe(vocabulary))

    def run(text: pa.Array) -> pa.Array:
        codec = shared.value
        ids = [codec.encode(t) if t else b"" for t in text.to_pylist()]
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
        decoded = codec.decode_lists(np.frombuffer(b"".join(ids), "<u4"), ends)
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), decoded], ["ids", "decoded"])

    return df.withColumn(to, arrow_column(run, "struct<ids:binary,decoded:string>")(
        df[f"`{text_col}`"].cast("string")))
