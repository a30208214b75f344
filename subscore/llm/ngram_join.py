"""Texts whose word n-grams have a high Jaccard similarity, with Bayesian pruning of candidates."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.components import connected_components
from subscore.llm.text import WordHashes, as_bytes, small_batches, window_hashes, words_of
from subscore.session import scratch_path, shared_root

#: Bands and values in a band: texts of similarity 0.8 share no band with probability 5e-8.
BANDS, IN_BAND = 32, 4
VALUES = BANDS * IN_BAND
#: Values compared before each look at the posterior probability.
STEP = 16
#: A pair is dropped when similarity above the threshold is less likely than this.
TOLERANCE = 1e-6
#: Texts of a block; larger groups are compared block by block.
BLOCK = 256
BLOCK_SHINGLES = 250_000


def shingles_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; a shorter text is one run."""
    return np.unique(window_hashes(hashes, min(width, len(hashes)), 3)) if len(hashes) else hashes


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(3).integers(0, 1 << 32, (2, VALUES, 1), np.uint64)
    return (numbers[0] | np.uint64(1)).astype(np.uint32), numbers[1].astype(np.uint32)


def minhash(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least of each of ``VALUES`` linear permutations of the shingles."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 2048):
        np.minimum(least, (factors * short[start : start + 2048] + offsets).min(1), out=least)
    return least


def required_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """Of the first 16, 32, ... values, how many must match for a pair to stay a candidate.

    With a uniform prior, m matches of n leave P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    Signatures keep one byte of each value, so different values match with probability 1/256.
    """
    t = threshold + (1 - threshold) / 256
    needed = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        needed.append(m)
    return needed


def surviving_pairs(left: np.ndarray, right: np.ndarray | None, needed: list[int]):
    """(i, j) of the pairs of rows that the posterior keeps; ``right`` None: pairs within ``left``."""
    found = [], []
    other = left if right is None else right
    for start in range(0, len(left), 256):
        part = left[start : start + 256]
        same = np.zeros((len(part), len(other)), np.uint8)
        for value in range(STEP):
            same += part[:, value, None] == other[None, :, value]
        i, j = np.nonzero(same >= needed[0])
        count = same[i, j].astype(np.int64)
        i = i + start
        if right is None:
            ahead = i < j
            i, j, count = i[ahead], j[ahead], count[ahead]
        for look, least in enumerate(needed[1:], 1):
            if not len(i):
                break
            columns = slice(look * STEP, look * STEP + STEP)
            kept_i, kept_j, kept_count = [], [], []
            for at in range(0, len(i), 100_000):
                a, b = i[at : at + 100_000], j[at : at + 100_000]
                seen = count[at : at + 100_000] + (left[a, columns] == other[b, columns]).sum(1)
                good = seen >= least
                kept_i.append(a[good])
                kept_j.append(b[good])
                kept_count.append(seen[good])
            i, j, count = map(np.concatenate, (kept_i, kept_j, kept_count))
        found[0].append(i)
        found[1].append(j)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in found)


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs really have this Jaccard similarity, by their shingles."""
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.full(len(i), -1, np.int64)
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    able = np.flatnonzero(small >= threshold * large - 1e-9)
    if len(able) > 20 * len(sets):
        common[able] = _common_by_columns(sets, i[able], j[able])
    else:
        as_sets: dict[int, set[int]] = {}
        for at in able:
            a, b = int(i[at]), int(j[at])
            for one in (a, b):
                if one not in as_sets:
                    as_sets[one] = set(sets[one].tolist())
            common[at] = len(as_sets[a] & as_sets[b])
    # In whole numbers: common / union >= threshold.
    union = sizes[i] + sizes[j] - common
    return (common >= 0) & (common >= threshold * union - 1e-9)


def _common_by_columns(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of very many pairs, by products of indicator columns."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shingles, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = counts > 1
    column = np.cumsum(often) - 1
    shared = often[place]
    owner, place = owner[shared], column[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for start in range(0, int(often.sum()), width):
        low, high = np.searchsorted(place, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[low:high], place[low:high] - start] = 1
        common += part @ part.T
    return common[i, j].astype(np.int64)


def forest(size: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """For each of ``size`` nodes the least one that the pairs connect it to."""
    root = list(range(size))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(a) for a in range(size)]


def _groups(batches, keys: int):
    """(key, rows) of consecutive rows that agree in the first ``keys`` columns."""
    held, now = [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(keys)]
        names = list(zip(*columns))
        start = 0
        while start < len(names):
            end = start + 1
            while end < len(names) and names[end] == names[start]:
                end += 1
            if held and names[start] != now:
                yield now, held
                held = []
            now = names[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield now, held


def _in_blocks(rows: DataFrame, group: str, blocks) -> DataFrame:
    """Rows of a group once for each pair of blocks (low, high) that theirs is in."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return dealt.drop("blocks", "other")


def similar_texts(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, node, root, class_id, n_links) for every row of ``docs``.

    Two texts are linked where the Jaccard similarity of their sets of ``width`` consecutive
    words is ``threshold`` or more. Words are in lower case (A-Z) and without ASCII
    punctuation; a shorter text is one run of all its words. ``n_links`` counts the other
    texts that the row's text is linked to, equal texts counting as one; ``class_id`` is the
    smallest id of all rows whose texts are connected by links, copies included. ``node`` is
    the text's digest and ``root`` names the class.

    1. Each distinct text gets 128 MinHash values. Texts that share one of 32 bands of four
       values are candidates (a pair of similarity 0.8 is missed with probability 5e-8).
    2. Within a band, pairs are compared 16 values at a time and dropped once the posterior
       probability of the threshold is below one in a million. What stays is reduced to a
       spanning forest in the task: pairs are not written out.
    3. The texts of each connected group are brought together once, compared the same way,
       and verified exactly by their shingles, again in the task: each text comes out with the
       number of its links and the least text that it is connected to.

    A group of any size, a third of all texts included, is compared block by block (256
    texts or 250,000 shingles) in as many tasks as it has pairs of blocks. A text of any
    length is one row, shingled in one task.

    A null text counts as the empty one; texts without words equal only the same text. A
    missing id is never a class id, unless all ids of a class are missing. Repeated rows come
    out as often as they came in; an empty table gives an empty table. Other columns are not
    looked at.
    """
    spark = docs.sparkSession
    shared_root(spark)
    small_batches(spark)
    folder = scratch_path(spark, "similar")
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).withColumn("node", F.unhex(F.md5("text")))
    factors, offsets = _permutations()
    needed = required_matches(threshold)

    def sketch(batches):
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sizes, signatures, bands = [], [], []
                for document in as_bytes(part.column(2)):
                    shingles = shingles_of(hashes.of(words_of(document)), width)
                    sizes.append(len(shingles))
                    if not len(shingles):
                        signatures.append(None)
                        bands.append([])
                        continue
                    values = minhash(shingles, factors, offsets)
                    signatures.append(values.astype(np.uint8).tobytes())
                    rows = values.reshape(BANDS, IN_BAND)
                    bands.append(
                        [xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) - (1 << 63) for k, row in enumerate(rows)]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array(signatures, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["id", "node", "size", "signature", "bands"],
                )

    (
        source.select("id", "node", "text")
        .mapInArrow(sketch, "id long, node binary, size long, signature binary, bands array<long>")
        .write.parquet(f"{folder}/sketches")
    )
    sketches = spark.read.parquet(f"{folder}/sketches")
    nodes = sketches.where("size > 0").groupBy("node").agg(
        F.first("size").alias("size"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")

    # Candidates: texts that share a band.
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    together = (
        banded.join(shared, "bucket")
        .join(nodes.select("node", "signature"), "node")
        .select("bucket", "n", "node", "signature")
    )
    dealt = _in_blocks(together, "bucket", F.ceil(F.col("n") / BLOCK)).drop("n")
    dealt = (
        dealt.select("bucket", "low", "high", "block", "node", "signature")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high", "block", "node")
    )

    def candidates(batches):
        made: tuple[list, list] = [], []
        for (_, low, high), parts in _groups(batches, 3):
            names, signatures = [], []
            for part in parts:
                names += part.column(4).to_pylist()
                signatures += part.column(5).to_pylist()
            values = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, VALUES)
            i, j = _pairs(values, [b for part in parts for b in part.column(3).to_pylist()], low, high, needed)
            for a, root in enumerate(forest(len(names), i, j)):
                if a != root:
                    made[0].append(names[a])
                    made[1].append(names[root])
            if len(made[0]) > 10_000:
                yield _edges(*made)
                made = [], []
        yield _edges(*made)

    edges = dealt.mapInArrow(candidates, "a binary, b binary")
    grouped = connected_components(edges).checkpoint()

    # Groups of candidates, with their texts.
    weighed = grouped.join(nodes.select("node", "size"), "node")
    # Written down, as the least ids below: a join can then divide the texts of a large group.
    sizes = weighed.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    sizes = sizes.checkpoint()
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    earliest = sketches.groupBy("node").agg(F.min("id").alias("first"))
    wanted = grouped.join(earliest, "node").join(
        sizes.select("root", blocks.cast("int").alias("blocks")), "root"
    )
    texts = source.join(wanted.withColumnRenamed("node", "~node"), F.col("node") == F.col("~node")).where(
        F.col("id").eqNullSafe(F.col("first"))
    )

    def shingled(batches):
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [shingles_of(hashes.of(words_of(d)), width) for d in as_bytes(part.column(3))]
                signatures = [minhash(s, factors, offsets).astype(np.uint8).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array(signatures, pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["root", "blocks", "node", "signature", "shingles"],
                )

    members = texts.select("root", "blocks", "node", "text").mapInArrow(
        shingled, "root binary, blocks int, node binary, signature binary, shingles binary"
    )
    units = (
        _in_blocks(members, "root", F.col("blocks"))
        .select("root", "low", "high", "block", "node", "signature", "shingles")
        .repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high", "block", "node")
    )

    def links(batches):
        for (_, low, high), parts in _groups(batches, 3):
            names, block, signatures, sets = [], [], [], []
            for part in parts:
                for number, node, signature, packed in zip(
                    *(part.column(k).to_pylist() for k in (3, 4, 5, 6))
                ):
                    if not names or names[-1] != node:  # a repeated row
                        names.append(node)
                        block.append(number)
                        signatures.append(signature)
                        sets.append(np.frombuffer(packed, np.uint64))
            values = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, VALUES)
            i, j = _pairs(values, block, low, high, needed)
            good = verified(sets, i, j, threshold)
            i, j = i[good], j[good]
            count = np.bincount(i, minlength=len(names)) + np.bincount(j, minlength=len(names))
            root = forest(len(names), i, j)
            linked = np.flatnonzero(count)
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[a] for a in linked], pa.binary()),
                        pa.array([names[root[a]] for a in linked], pa.binary()),
                        pa.array(count[linked].astype(np.int64)),
                    ],
                    names=["node", "root", "links"],
                )

    units.mapInArrow(links, "node binary, root binary, links long").write.parquet(f"{folder}/links")
    linked = spark.read.parquet(f"{folder}/links")
    counts = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = connected_components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    about = counts.join(roots, "node")
    known = sketches.select("id", "node")
    least = (
        known.groupBy("node").agg(F.min("id").alias("id"))
        .join(about, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "id")
    )
    classes = least.groupBy("root").agg(F.min("id").alias("class_id")).checkpoint()
    per_text = least.drop("id").join(classes, "root")
    return known.join(per_text, "node").select("id", "node", "root", "class_id", "n_links")


def _pairs(values: np.ndarray, block: list[int], low: int, high: int, needed: list[int]):
    """Pairs within a block, or between two blocks whose rows follow each other."""
    if low == high:
        return surviving_pairs(values, None, needed)
    cut = block.index(high) if high in block else len(block)
    i, j = surviving_pairs(values[:cut], values[cut:], needed)
    return i, j + cut


def _edges(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def drop_similar_texts(
    docs: DataFrame, threshold: float = 0.8, width: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each class of ``similar_texts``: the one with the smallest id.

    Of rows with that id and different texts, the text with the smallest digest stays, and one
    row of those that are wholly equal in id and text.
    """
    found = similar_texts(docs, threshold, width, doc_id, text)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("kept")
    )
    first = first.select(F.col("kept.id").alias("~id"), F.col("kept.node").alias("~node"))
    own = F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
    keyed = docs.withColumn("~own", own)
    kept = keyed.join(
        first,
        F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("`~id`")) & (F.col("`~own`") == F.col("`~node`")),
        "left_semi",
    )
    return kept.dropDuplicates([doc_id, "~own"]).drop("~own")
