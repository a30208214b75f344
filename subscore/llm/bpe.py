"""Byte-level BPE: texts to token ids and back, by a contiguous rank array per word."""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType

from subscore.llm.text import append_columns

#: Fixed value: how byte-level BPE cuts a text into words.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Words up to this many bytes are merged by scanning their rank array, longer ones with a heap.
SHORT = 128
NO_RANK = 1 << 30


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary, as letter -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    letters = {chr(byte): byte for byte in plain}
    return letters | {chr(256 + place): byte for place, byte in enumerate(others)}


class Bpe:
    """A vocabulary with its merges. Encoded words are remembered up to a bounded number (some 200 MB)."""

    def __init__(self, file: bytes, remembered: int = 200_000):
        described = json.loads(file)
        letters = byte_letters()
        vocab = described["model"]["vocab"]
        special = {x["content"]: x["id"] for x in described.get("added_tokens", [])}
        size = max([*vocab.values(), *special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, number in vocab.items():
            self.token_bytes[number] = bytes(letters[letter] for letter in token)
        for token, number in special.items():
            self.token_bytes[number] = token.encode()
        self.byte_id = [0] * 256
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        #: (left id, right id) -> rank of the merge, and rank -> id of the merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for merge in described["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault((vocab[left], vocab[right]), len(self.merged))
            self.merged.append(vocab[left + right])
        self.special = special
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
            if special
            else None
        )
        self.words = regex.compile(PATTERN)
        self.wide = regex.compile(r" \s|\s ")
        self.known = _Remembered(self.packed_word, remembered)
        self.spaced = _Remembered(self.packed_spaced, remembered)

    def merge_short(self, ids: list[int]) -> list[int]:
        """Scan the ranks of neighbouring parts for the least, join there, refresh its neighbours."""
        get, merged = self.rank.get, self.merged
        ranks = list(map(get, zip(ids, ids[1:]), repeat(NO_RANK)))
        while ranks and (least := min(ranks)) < NO_RANK:
            at = ranks.index(least)
            ids[at] = merged[least]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), NO_RANK)
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), NO_RANK)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for a word without a length limit: a heap of ranks over linked parts."""
        rank, size = self.rank, len(ids)
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        heap = [(r, at) for at in range(size - 1) if (r := rank.get((ids[at], ids[at + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            least, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right < 0 or rank.get((ids[at], ids[right])) != least:
                continue
            ids[at], ids[right] = self.merged[least], -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
                if (r := rank.get((ids[at], ids[after[at]]))) is not None:
                    heapq.heappush(heap, (r, at))
            if before[at] >= 0 and (r := rank.get((ids[before[at]], ids[at]))) is not None:
                heapq.heappush(heap, (r, before[at]))
        return [number for number in ids if number >= 0]

    def word_ids(self, word: str) -> list[int]:
        ids = [self.byte_id[byte] for byte in word.encode()]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text; the strings of special tokens become these tokens."""
        if self.cut is None or not any(token in text for token in self.special):
            packed = self.plain(text)
        else:
            packed = b"".join(
                np.int32(self.special[part]).tobytes() if part in self.special else self.plain(part)
                for part in self.cut.split(text)
            )
        return np.frombuffer(packed, np.int32)

    def plain(self, text: str) -> bytes:
        """Packed ids of a text without special tokens.

        A blank between two other characters that are not white space always begins a word,
        so a text without longer white space around blanks is coded blank by blank.
        """
        if self.wide.search(text):
            return b"".join(map(self.known.__getitem__, self.words.findall(text)))
        first, _, rest = text.partition(" ")
        packed = b"".join(map(self.known.__getitem__, self.words.findall(first)))
        if len(first) == len(text):
            return packed
        return packed + b"".join(map(self.spaced.__getitem__, rest.split(" ")))

    def packed_word(self, word: str) -> bytes:
        return np.array(self.word_ids(word), np.int32).tobytes()

    def packed_spaced(self, chunk: str) -> bytes:
        """Packed ids of a blank and the characters up to the next one."""
        return b"".join(map(self.known.__getitem__, self.words.findall(" " + chunk)))

    def decode(self, ids: np.ndarray) -> str:
        """The bytes of the tokens as UTF-8; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Remembered(dict):
    """Results for short strings: at most ``limit`` young ones and as many old ones."""

    def __init__(self, compute: Callable[[str], bytes], limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= SHORT:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def encode_decode(
    docs: DataFrame, tokenizer: str, text: str = "text", keep: Iterable[str] | None = None
) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), the tokens of each whole text, and ``decoded``, their text.

    ``tokenizer`` is the path of a byte-level BPE file on the driver; the file (a few MB
    whatever the input) is broadcast. Words up to 128 bytes are merged by the rank array,
    longer ones, such as a text without blanks, by a heap with the same result.

    A null or empty text has no ids and decodes to the empty text. Repeated rows come out as
    often as they came in; an empty table gives an empty table. Columns of ``docs`` (``keep``:
    only these) stay, except that ``ids`` and ``decoded`` replace columns of these names.
    """
    with open(tokenizer, "rb") as file:
        # Each Python worker keeps the vocabulary that it built beside the file's bytes.
        shared = docs.sparkSession.sparkContext.broadcast({"file": file.read()})

    def prepare():
        value = shared.value
        bpe = value.get("bpe")
        if bpe is None:
            bpe = value["bpe"] = Bpe(value["file"])

        def compute(texts):
            encoded = [bpe.encode(t.decode("utf-8", "replace") if t else "") for t in texts]
            offsets = np.zeros(len(encoded) + 1, np.int32)
            np.cumsum([len(ids) for ids in encoded], out=offsets[1:])
            flat = np.concatenate(encoded) if encoded else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            return ids, pa.array([bpe.decode(x) for x in encoded], pa.string())

        return compute

    added = [("ids", ArrayType(IntegerType())), ("decoded", StringType())]
    return append_columns(docs, text, keep, added, prepare)
