"""Allow and block rules for URLs, in a trie over reversed host labels and path segments."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from subscore.llm.text import append_columns

#: Rules broadcast at once, about 100 bytes each in every Python worker; more take more narrow passes.
BLOCK_RULES = 1_000_000

RULE = StructType(
    [
        StructField("labels", IntegerType()),
        StructField("length", IntegerType()),
        StructField("verdict", StringType()),
        StructField("rule", StringType()),
    ]
)
RULE_FIELDS = [
    ("labels", pa.int32()),
    ("length", pa.int32()),
    ("verdict", pa.string()),
    ("rule", pa.string()),
]

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: bytes | None) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path, without query and fragment."""
    _, found, rest = (url or b"").partition(b"://")
    if not found:
        return b"", b""
    rest = rest.partition(b"#")[0].partition(b"?")[0]
    host, slash, path = rest.partition(b"/")
    return host.translate(_LOWER), slash + path


class RuleTrie:
    """Host labels from the last to the first, then whole path segments, then the start of one.

    A node is the 64-bit hash of the labels and segments that lead to it, and an edge is followed
    by hashing one more and looking the result up among the sorted ``nodes``. Rules end at a node
    with the start of a segment; what is found by hash is compared with the rule's own text. All
    of it lies in arrays: about 100 bytes for a rule.
    """

    ROOT, PATHS = 0, b"/paths"

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        nodes, ends, at_nodes, sizes = array("Q"), array("Q"), array("Q"), array("I")
        verdicts, blob, self.offsets = bytearray(), bytearray(), array("Q", [0])
        for verdict, host, path in rules:
            *whole, start = path.encode().split(b"/")
            labels = reversed(host.encode().translate(_LOWER).split(b".")) if host else ()
            node = self.ROOT
            for token in (*labels, self.PATHS, *whole):
                node = self.child(node, token)
                nodes.append(node)
            ends.append(self.end(node, start))
            at_nodes.append(node)
            sizes.append(len(start))
            verdicts.append(verdict == "block")
            blob += host.encode() + b"\0" + path.encode()
            self.offsets.append(len(blob))
        self.verdicts, self.blob = bytes(verdicts), bytes(blob)
        self.nodes = _packed("Q", np.unique(_view(nodes, np.uint64)))
        ends, blocks = _view(ends, np.uint64), np.frombuffer(self.verdicts, np.uint8)
        # Of equal rules a block rule comes first, then the last one.
        order = np.lexsort((-np.arange(len(ends)), -blocks.astype(np.int8), ends))
        self.ends, self.rules = _packed("Q", ends[order]), _packed("I", order)
        # The lengths of the starts at each node.
        pairs = np.unique(np.stack([_view(at_nodes, np.uint64), _view(sizes, np.uint32).astype(np.uint64)]), axis=1)
        self.starting, first = np.unique(pairs[0], return_index=True)
        self.starting, self.lengths = _packed("Q", self.starting), _packed("I", pairs[1])
        self.first = _packed("I", np.append(first, len(pairs[1])))

    @staticmethod
    def child(node: int, token: bytes) -> int:
        return xxhash.xxh3_64_intdigest(token, node)

    @staticmethod
    def end(node: int, start: bytes) -> int:
        return xxhash.xxh3_64_intdigest(start, node ^ 0x9E3779B97F4A7C15)

    @property
    def nbytes(self) -> int:
        arrays = (self.offsets, self.nodes, self.ends, self.rules, self.starting, self.first, self.lengths)
        return len(self.blob) + len(self.verdicts) + sum(x.itemsize * len(x) for x in arrays)

    def rule(self, number: int) -> tuple[bytes, bytes]:
        host, _, path = self.blob[self.offsets[number] : self.offsets[number + 1]].partition(b"\0")
        return host, path

    def best(self, host: bytes, path: bytes) -> tuple[str, str, tuple[int, int]] | None:
        """The longest rule that fits: most host labels first, then the longest path."""
        found, node = None, self.ROOT
        labels = host.split(b".")
        segments = path.split(b"/")
        for depth in range(len(labels) + 1):
            paths = self.child(node, self.PATHS)
            if _place(self.nodes, paths) is not None:
                longest = self._longest(paths, segments, host, path)
                found = found if longest is None else longest
            if depth == len(labels):
                break
            node = self.child(node, labels[-1 - depth])
            if _place(self.nodes, node) is None:
                break
        if found is None:
            return None
        own_host, own_path = (x.decode() for x in self.rule(found))
        verdict = "block" if self.verdicts[found] else "allow"
        return verdict, own_host + own_path, (own_host.count(".") + bool(own_host), len(own_path))

    def _longest(self, node: int, segments: list[bytes], host: bytes, path: bytes) -> int | None:
        found = None
        for segment in segments:
            at = _place(self.starting, node)
            if at is not None:
                for size in reversed(self.lengths[self.first[at] : self.first[at + 1]]):
                    if size <= len(segment):
                        hit = self._ending(self.end(node, segment[:size]), host, path)
                        if hit is not None:
                            found = hit
                            break
            node = self.child(node, segment)
            if _place(self.nodes, node) is None:
                break
        return found

    def _ending(self, key: int, host: bytes, path: bytes) -> int | None:
        """The first rule with this hash whose text fits."""
        at = _place(self.ends, key)
        while at is not None and at < len(self.ends) and self.ends[at] == key:
            own_host, own_path = self.rule(self.rules[at])
            own_host = own_host.translate(_LOWER)
            if path.startswith(own_path) and (not own_host or host == own_host or host.endswith(b"." + own_host)):
                return self.rules[at]
            at += 1
        return None


def _place(keys: array, key: int) -> int | None:
    at = bisect_left(keys, key)
    return at if at < len(keys) and keys[at] == key else None


def _view(values: array, kind) -> np.ndarray:
    return np.frombuffer(values, kind) if len(values) else np.empty(0, kind)


def _packed(code: str, values: np.ndarray) -> array:
    packed = array(code)
    packed.frombytes(np.ascontiguousarray(values, np.dtype(f"u{packed.itemsize}")).tobytes())
    return packed


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, the longest fitting ``rule`` and its ``verdict``.

    ``rules`` are (allow or block, host, path). A rule fits its host and all subdomains where
    the URL's path starts with the rule's path; a rule with an empty host fits every URL. The
    rule with more host labels wins, then the one with the longer path; of two equal rules,
    block wins. Without a fitting rule, ``rule`` is null and the verdict is ``default``.

    The trie is built once and broadcast as arrays, of at most a million rules at a time;
    further rules take one more narrow pass each over the pages, which are never shuffled.
    URLs of any length are judged whole.

    A null URL, or one without ``://``, has empty host and path. Repeated pages come out as
    often as they came in; an empty table gives an empty table. Columns of ``pages`` (``keep``:
    only these) stay, except that the four new ones replace columns of these names.
    """
    context = pages.sparkSession.sparkContext
    rules = [tuple(rule) for rule in rules]
    for rule in rules:
        if rule[0] not in ("allow", "block"):
            raise ValueError(f"a rule is allow or block, not {rule[0]!r}")
    blocks = [rules[at : at + BLOCK_RULES] for at in range(0, max(1, len(rules)), BLOCK_RULES)]
    kept = list(pages.columns if keep is None else keep)
    found = pages
    carried: list[str] = []
    for number, block in enumerate(blocks):
        shared = context.broadcast(RuleTrie(block))

        def prepare(shared=shared):
            trie = shared.value

            def compute(urls):
                parts = [host_and_path(u) for u in urls]
                best = [trie.best(host, path) for host, path in parts]
                rules = [
                    x and {"labels": x[2][0], "length": x[2][1], "verdict": x[0], "rule": x[1]}
                    for x in best
                ]
                return (
                    pa.array([host.decode() for host, _ in parts], pa.string()),
                    pa.array([path.decode() for _, path in parts], pa.string()),
                    pa.array(rules, pa.struct(RULE_FIELDS)),
                )

            return compute

        rule = f"~rule{number}"
        added = [("host", StringType()), ("path", StringType()), (rule, RULE)]
        fields = [*kept, *carried, *([] if number == len(blocks) - 1 else [url])]
        found = append_columns(found, url, dict.fromkeys(fields), added, prepare)
        carried.append(rule)
    rules = [F.col(f"`{name}`") for name in carried]
    # The fields compare in the order of precedence, and "block" is greater than "allow".
    best = F.greatest(*rules) if len(rules) > 1 else rules[0]
    new = ("host", "path", "rule", "verdict")
    return found.withColumn("~best", best).select(
        *(f"`{name}`" for name in kept if name.lower() not in new),
        "host",
        "path",
        F.col("`~best`.rule").alias("rule"),
        F.coalesce(F.col("`~best`.verdict"), F.lit(default)).alias("verdict"),
    )
