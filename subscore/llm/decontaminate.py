"""Benchmark passages in documents, found by Wu-Manber search over words."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from subscore.llm.text import WordHashes, append_columns, mixed, window_hashes, words_of

#: Windows searched for in one pass over the documents, some 40 bytes each in every Python
#: worker; a larger benchmark takes more passes.
BLOCK_WINDOWS = 2_000_000
#: Slots of a shift table, a byte each, for every window and at most.
SLOTS, MOST_SLOTS = 8, 1 << 26

#: A word before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])


def pair_hashes(words: np.ndarray, block: int) -> np.ndarray:
    """Hash of the last ``block`` words (1 or 2) at each position, the first one undefined for two."""
    if block == 1:
        return mixed(words)
    before = np.concatenate([words[:1], words[:-1]])
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + words)


class WuManber:
    """All windows of equal length of some texts, for one scan over the words of documents.

    ``shift`` has a byte per slot of the hash of two words: how far the next end of a window is from
    a position that ends with them, at least. All positions of a batch are looked up at once, and
    those with a shift are passed over. Where it is 0, the windows whose last two words have this
    hash, a bucket of the sorted ``suffixes``, are those whose ``hashes`` are compared, and of
    those that agree the words themselves. All of it lies in arrays.
    """

    def __init__(self, length: int, texts: Sequence[tuple[int, list[bytes]]]):
        self.length, self.block = length, min(2, length)
        hashes = WordHashes()
        sizes = np.array([len(words) for _, words in texts], np.int64)
        # Word w of a text begins at offsets[first + w] of the blob, where words stand between blanks.
        self.blob = b" ".join(b" ".join(words) for _, words in texts) + b" "
        lengths = np.fromiter((len(word) + 1 for _, words in texts for word in words), np.int64, int(sizes.sum()))
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        own = hashes.of([word for _, words in texts for word in words])
        places = [np.arange(size - length + 1) + first for size, first in zip(sizes, firsts)]
        starts = np.concatenate(places) if places else np.empty(0, np.int64)
        which = np.repeat(np.array([number for number, _ in texts], np.int32), [len(x) for x in places])
        pairs, whole = pair_hashes(own, self.block), window_hashes(own, length, 5)[starts]
        suffixes = pairs[starts + length - 1]
        order = np.lexsort((which, whole, suffixes))
        self.suffixes, self.hashes = suffixes[order], whole[order]
        self.starts, self.texts = starts[order].astype(np.uint32 if len(own) < 2**32 else np.int64), which[order]
        slots = 1 << min(MOST_SLOTS, max(256, SLOTS * len(starts))).bit_length() - 1
        self.mask = np.uint64(slots - 1)
        self.shift = np.full(slots, min(255, length - self.block + 1), np.uint8)
        for end in range(self.block - 1, length):  # later ends shift less, and overwrite
            slot = (pairs[starts + end] & self.mask).astype(np.int64)
            self.shift[slot] = np.minimum(self.shift[slot], min(255, length - 1 - end))

    def occurrences(self, documents: Words) -> Iterator[tuple[int, int, int]]:
        """(document, start, text) of every occurrence of a window of a text."""
        length, flat = self.length, documents.hashes
        pairs = pair_hashes(flat, self.block)
        # What the shift table leaves: positions where a window can end.
        ends = np.flatnonzero(self.shift[(pairs & self.mask).astype(np.int64)] == 0)
        low = np.searchsorted(self.suffixes, pairs[ends], "left")
        high = np.searchsorted(self.suffixes, pairs[ends], "right")
        which = np.searchsorted(documents.first, ends, "right") - 1
        starts = ends - length + 1
        inside = (low < high) & (starts >= documents.first[which])
        if not inside.any():
            return
        low, high, which, starts = low[inside], high[inside], which[inside], starts[inside]
        whole = window_hashes(flat, length, 5)[starts]
        # Most buckets hold one window: it is compared without a call of its own.
        possible = (high - low > 1) | (self.hashes[low] == whole)
        for at in np.flatnonzero(possible).tolist():
            first, last = int(low[at]), int(high[at])
            bucket = self.hashes[first:last]
            left, right = (int(np.searchsorted(bucket, whole[at], side)) for side in ("left", "right"))
            if left == right:
                continue
            document = int(which[at])
            start = int(starts[at] - documents.first[document])
            text = b" ".join(documents.words[document][start : start + length]) + b" "
            for window in range(first + left, first + right):
                place = int(self.starts[window])
                if self.blob[self.offsets[place] : self.offsets[place + length]] == text:
                    yield document, start, int(self.texts[window])

    @property
    def nbytes(self) -> int:
        arrays = (self.offsets, self.suffixes, self.hashes, self.starts, self.texts, self.shift)
        return len(self.blob) + sum(array.nbytes for array in arrays)


class Words:
    """The words of some documents, and the hashes of all of them one after the other."""

    def __init__(self, words: list[list[bytes]], hashes: WordHashes):
        self.words = words
        sizes = np.array([len(own) for own in words], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.hashes = hashes.of([word for own in words for word in own])


def searches(texts: Iterable[list[bytes]], window: int) -> list[WuManber]:
    """One search per window length: ``window``, and the lengths of shorter texts."""
    by_length: dict[int, list[tuple[int, list[bytes]]]] = {}
    for number, words in enumerate(texts):
        if words:
            by_length.setdefault(min(window, len(words)), []).append((number, words))
    return [WuManber(length, own) for length, own in by_length.items()]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (start, end) spans as one each."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def benchmark_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words`` and the ``spans`` of words that are inside benchmark windows.

    A window is ``window`` consecutive words of an item; a shorter item is one window. ``spans``
    are the union of all occurrences, as word positions from 0, and ``items`` the ids (as text,
    sorted, each once) of the items with an occurrence. Words are compared whole and in lower
    case (A-Z), so punctuation and spacing do not matter.

    Equal item texts are searched for once. The benchmark is broadcast as arrays, in blocks of
    about 2 million windows (some 80 MB in each Python worker), counted before; a single item
    is never divided. Each further block is one more narrow pass over the documents, so neither
    the documents nor a benchmark of any size are shuffled. Documents of any length are searched
    whole, one in one task.

    Null and empty texts have no words and no spans, as have items without words, which never
    occur. Repeated items or ids count once; an item without id is named by the empty text.
    Repeated documents come out as often as they came in; an empty table on either side is
    fine. Columns of ``docs`` (``keep``: only these) stay, except that ``n_words``, ``spans``
    and ``items`` replace columns of these names.
    """
    context = docs.sparkSession.sparkContext
    item_id = F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item")
    wanted = (
        benchmark.select(item_id, F.col(f"`{item_text}`").cast("string").alias("text"))
        .where("text IS NOT NULL")
        .groupBy("text")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    n_words = F.regexp_count("text", F.lit(WORD))
    total = wanted.agg(F.sum(F.greatest(n_words - window + 1, F.least(n_words, F.lit(1))))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WINDOWS))
    kept = list(docs.columns if keep is None else keep)
    added = [
        ("n_words", LongType()),
        ("~spans", ArrayType(SPAN)),
        ("~items", ArrayType(StringType())),
    ]
    carried: list[str] = []
    found = docs
    for block in range(blocks):
        here = wanted.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        tables = searches((words_of(row.text.encode()) for row in here), window)
        shared = context.broadcast((tables, [row["items"] for row in here]))

        def prepare(shared=shared):
            (tables, named), hashes = shared.value, WordHashes()

            def compute(texts):
                words = [words_of(text) for text in texts]
                hits: list[list[tuple[int, int]]] = [[] for _ in words]
                ids: list[set[str]] = [set() for _ in words]
                documents = Words(words, hashes)
                for search in tables:
                    for at, start, which in search.occurrences(documents):
                        hits[at].append((start, start + search.length))
                        ids[at].update(named[which])
                counts = [len(own) for own in words]
                spans = [[{"start": a, "end": b} for a, b in merged(own)] for own in hits]
                items = [sorted(own) for own in ids]
                span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                return (
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(span)),
                    pa.array(items, pa.list_(pa.string())),
                )

            return compute

        last = block == blocks - 1
        fields = [*kept, *carried, *([] if last else [text])]
        found = append_columns(found, text, dict.fromkeys(fields), added, prepare)
        if not last:
            found = found.withColumnsRenamed(
                {"~spans": f"~spans{block}", "~items": f"~items{block}"}
            )
            carried += [f"~spans{block}", f"~items{block}"]
    spans = [F.col(f"`{c}`") for c in found.columns if c.startswith("~spans")]
    items = [F.col(f"`{c}`") for c in found.columns if c.startswith("~items")]
    new = ("n_words", "spans", "items")
    return found.select(
        *(f"`{name}`" for name in kept if name.lower() not in new),
        "n_words",
        (spans[0] if blocks == 1 else _union(F.array_sort(F.concat(*spans)))).alias("spans"),
        (
            items[0] if blocks == 1 else F.array_sort(F.array_distinct(F.concat(*items)))
        ).alias("items"),
    )


def _union(spans):
    """Sorted spans of several passes, overlapping or touching ones as one."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(found, span):
        last = F.element_at(found, -1)
        apart = (F.size(found) == 0) | (span["start"] > last["end"])
        grown = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(apart, F.concat(found, F.array(span))).otherwise(
            F.concat(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), F.array(grown))
        )

    return F.aggregate(spans, empty, add)


def n_covered(spans):
    """Column: number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
