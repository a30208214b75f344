"""The parts that run inside tasks, against plain versions. No Spark."""

from __future__ import annotations

import heapq
import pickle
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subscore.llm.bpe import Bpe, byte_letters
from subscore.llm.decontaminate import Words, merged, searches
from subscore.llm.licenses import PHRASES, TEMPLATES, LicenseScanner
from subscore.llm.ngram_join import (
    VALUES,
    _permutations,
    forest,
    minhash,
    required_matches,
    surviving_pairs,
    verified,
)
from subscore.llm.quality import Features, Ftrl, Settings
from subscore.llm.substring_dedup import pack, unpack
from subscore.llm.text import WordHashes, window_hashes, words_of
from subscore.llm.url_filter import RuleTrie, host_and_path
from subscore.llm.warc import LoserTree, read_record, record_bytes

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    with open(FILE, "rb") as file:
        return Bpe(file.read(), remembered=500)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "1", "²", "'s", "'ll", "'", "!", "\x1c", "\x85",
    "\u00a0", "\u2003", "\u200b", "😀", "e\u0301", "\x00", "<|endoftext|>", "<|", "the", " The", "_",
]


@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_the_library(bpe, library, text):
    ids = bpe.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert bpe.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_bpe_of_long_words(bpe, library):
    for text in ("x" * 5000, "ab" * 3000 + "é" * 200, "".join(chr(0x4E00 + n) for n in range(900))):
        assert bpe.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_rank_array_and_heap_agree(bpe):
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("theinganoé ") for _ in range(rng.randint(0, 40))).encode()
        ids = [bpe.byte_id[byte] for byte in word]
        assert bpe.merge_short(list(ids)) == bpe.merge_long(list(ids))


def test_bytes_that_are_no_text(bpe, library):
    letters = {byte: letter for letter, byte in byte_letters().items()}
    vocabulary = library.get_vocab()
    ids = [vocabulary[letters[byte]] for byte in (0xC3, 0x28, 0xF0, 0x9F, 0x98)]
    assert bpe.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)


def test_words():
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text in ("", "  ", "It's É-3 ÄÖ_x\u00a0y\u0085z", "\x00A\x7fB~c9"):
        lowered = regex.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert [w.decode() for w in words_of(text.encode())] == plain.findall(lowered)
    assert words_of(None) == []


def test_window_hashes_tell_windows_apart():
    rng, hashes = random.Random(2), WordHashes(limit=2)
    words = [rng.choice([b"a", b"b"]) for _ in range(3000)]
    for width in (1, 2, 3, 5, 7, 10):
        found = window_hashes(hashes.of(words), width, 1)
        runs = [tuple(words[n : n + width]) for n in range(len(words) - width + 1)]
        assert len(found) == len(runs)
        assert len(set(found.tolist())) == len(set(runs)) == len(set(zip(runs, found.tolist())))
    assert len(window_hashes(hashes.of(words[:4]), 5, 1)) == 0


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(3)
    for _ in range(300):
        letters = [b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]
        items = [
            (str(n), [rng.choice(letters) for _ in range(rng.randint(0, 7))])
            for n in range(rng.randint(0, 4))
        ]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 30))]
        documents = Words([[b"a"], words, [], [b"b"]], WordHashes())
        got = {
            (start, search.length, items[which][0])
            for search in searches([own for _, own in items], 4)
            for at, start, which in search.occurrences(documents)
            if at == 1
        }
        want = set()
        for item, own in items:
            length = min(4, len(own))
            for at in range(len(own) - length + 1 if length else 0):
                for start in range(len(words) - length + 1):
                    if words[start : start + length] == own[at : at + length]:
                        want.add((start, length, item))
        assert got == want


def test_eight_megabytes_of_benchmark_stay_small():
    rng = random.Random(4)
    vocabulary = [bytes(rng.choices(range(97, 123), k=rng.randint(3, 9))) for _ in range(50_000)]
    texts = [rng.choices(vocabulary, k=100) for _ in range(14_000)]
    assert sum(len(word) + 1 for words in texts for word in words) > 8 << 20
    (search,) = searches(texts, 10)
    assert search.nbytes < 90 << 20 and len(pickle.dumps(search)) < 90 << 20
    words = rng.choices(vocabulary, k=30) + texts[77][20:45] + rng.choices(vocabulary, k=30)
    found = list(search.occurrences(Words([words[:30], words], WordHashes())))
    assert found == [(1, start, 77) for start in range(30, 46)]


def test_spans_merge():
    assert merged([(5, 8), (0, 2), (2, 3), (6, 7)]) == [(0, 3), (5, 8)]


def test_license_phrases_are_all_found():
    rng = random.Random(4)
    for _ in range(300):
        letters = "abcde"[: rng.randint(1, 5)]
        run = lambda n: " ".join(rng.choice(letters) for _ in range(n))
        phrases = [(f"p{n}", run(rng.randint(1, 3))) for n in range(rng.randint(1, 3))]
        templates = [(f"t{n}", run(rng.randint(2, 8))) for n in range(rng.randint(0, 3))]
        scanner = LicenseScanner(phrases, templates, 2, 3, 0.6)
        words = [rng.choice(letters + "z").encode() for _ in range(rng.randint(0, 40))]
        places, spans = scanner.scan(words)
        want = []
        for label, phrase in phrases:
            own = [w.encode() for w in phrase.split()]
            for n in range(len(words) - len(own) + 1):
                if words[n : n + len(own)] == own:
                    want.append((label, n, n + len(own)))
        assert sorted(places) == sorted(want)
        assert all(0.6 <= c <= 1 and 0 <= s < e <= len(words) for _, s, e, c in spans)
        for label, template in templates:
            whole = [b"z", *(w.encode() for w in template.split()), b"z"]
            assert any(x == label and c == 1 for x, _, _, c in scanner.scan(whole)[1])


def test_license_template_with_changes():
    scanner = LicenseScanner(PHRASES, TEMPLATES, 3, 8, 0.8)
    text = TEMPLATES[0][1].replace("in compliance", "in full compliance").replace("express", "open")
    places, spans = scanner.scan(words_of(b"some words " + text.encode() + b" other words"))
    assert [x for x, _, _ in places] == ["apache"]
    assert any(label == "apache" and coverage > 0.9 for label, _, _, coverage in spans)


RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
    ("block", "net", ""),
    ("allow", "net", ""),
]


@pytest.mark.parametrize(
    ("url", "verdict", "rule"),
    [
        (b"http://a.example.org/es/1", "block", "example.org/es/"),
        (b"http://example.org/en/12?x#y", "block", "example.org/en/1"),
        (b"http://example.org/en/2", "allow", "org/"),
        (b"HTTP://A.COM/de/", "block", "com/de/"),
        (b"http://b.com/fr", None, None),
        (b"http://myexample.org/es/", "allow", "org/"),
        (b"http://x.net?a://b.org/", "block", "net"),
        (b"http://org", None, None),
        (b"http://org:80/", None, None),
        (b"no url", None, None),
        (None, None, None),
    ],
)
def test_longest_rule(url, verdict, rule):
    found = RuleTrie(RULES).best(*host_and_path(url))
    assert (found and found[0], found and found[1]) == (verdict, rule)


def test_trie_equals_all_rules():
    rng = random.Random(6)
    hosts = ["", "a", "b.a", "c.b.a", "b", "a.a"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/y"]
    for _ in range(300):
        rules = {(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(6)}
        trie = RuleTrie([(verdict, host, path) for (host, path), verdict in rules.items()])
        host, path = rng.choice([*hosts[1:], "d.c.b.a"]), rng.choice([*paths[1:], "/x/yz", "/xyz/x"])
        fits = [
            (h.count(".") + bool(h), len(p), v, h + p)
            for (h, p), v in rules.items()
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        found = trie.best(host.encode(), path.encode())
        assert (found and (*found[2], found[0], found[1])) == (max(fits) if fits else None)


@given(st.lists(st.lists(st.integers(0, 9)).map(sorted), max_size=9))
@settings(deadline=None)
def test_loser_tree_merges(runs):
    found = list(LoserTree([iter([(x, n) for x in run]) for n, run in enumerate(runs)], lambda x: x[0]))
    assert found == list(heapq.merge(*([(x, n) for x in run] for n, run in enumerate(runs))))


@pytest.mark.parametrize("kind", ["response", "revisit"])
def test_warc_record_round_trip(kind):
    import hashlib

    payload = b"a\r\n\r\nContent-Length: 7\r\n\r\nb"
    page = {
        "page_id": 7,
        "url": "http://x.org/ä%0A\r\nWARC-Type: no",
        "timestamp": 1_700_000_007,
        "payload": payload,
        "digest": hashlib.sha1(payload).hexdigest(),
        "record_type": kind,
        "refers_to": 9 if kind == "revisit" else None,
    }
    back = read_record(record_bytes(page))
    assert back["url"] == page["url"] and back["page_id"] == 7 and back["timestamp"] == page["timestamp"]
    assert back["payload"] == (payload if kind == "response" else None)
    assert back["payload_bytes"] == len(payload) and back["payload_digest"] == page["digest"]
    assert (back["record_type"], back["refers_to"]) == (kind, page["refers_to"])


@given(st.dictionaries(st.integers(0, 1 << 23), st.booleans()))
@settings(deadline=None)
def test_sketch_cells_round_trip(cells):
    numbers = np.array(sorted(cells), np.int64)
    flags = np.array([cells[n] for n in sorted(cells)], bool)
    back, more = unpack(pack(numbers, flags))
    assert back.tolist() == numbers.tolist() and more.tolist() == flags.tolist()


def test_pruning_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(1)
    factors, offsets = _permutations()
    base = rng.integers(0, 1 << 63, 600, np.uint64)
    sets = [np.unique(np.append(base[k:], rng.integers(0, 1 << 63, k, np.uint64))) for k in range(0, 300, 10)]
    values = np.stack([minhash(s, factors, offsets).astype(np.uint8) for s in sets])
    assert values.shape == (30, VALUES)
    i, j = surviving_pairs(values, None, required_matches(0.8))
    kept = set(zip(i.tolist(), j.tolist()))
    similarity = {
        (a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
        for a in range(30)
        for b in range(a + 1, 30)
    }
    assert {pair for pair, s in similarity.items() if s >= 0.8} <= kept
    assert not {pair for pair, s in similarity.items() if s < 0.4} & kept
    good = verified(sets, i, j, 0.8)
    assert {(a, b) for a, b, g in zip(i, j, good) if g} == {p for p, s in similarity.items() if s >= 0.8}
    cut = 11
    a, b = surviving_pairs(values[:cut], values[cut:], required_matches(0.8))
    assert set(zip(a.tolist(), (b + cut).tolist())) == {(x, y) for x, y in kept if x < cut <= y}


def test_products_of_columns_count_like_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40, np.uint64)) for _ in range(50)]
    i, j = (x.ravel() for x in np.triu_indices(50, 1))
    want = [len(set(sets[a]) & set(sets[b])) >= 0.5 * len(set(sets[a]) | set(sets[b])) for a, b in zip(i, j)]
    assert len(i) > 20 * len(sets)
    assert verified(sets, i, j, 0.5).tolist() == want


def test_forest_links_to_the_least():
    assert forest(6, np.array([5, 3]), np.array([3, 1])) == [0, 1, 2, 1, 4, 1]


def test_ftrl_learns_a_rule():
    rng = np.random.default_rng(3)
    model = Ftrl(Settings(bits=4))
    for _ in range(2000):
        at = np.array([int(rng.integers(0, 16)), 16])
        model.learn(at, np.array([8.0, 1.0]), int(at[0] % 2))
    weights = model.weights(np.arange(16)) * 8 + model.weights(np.array([16]))
    assert ((weights > 0) == (np.arange(16) % 2 == 1)).all()


def test_features_see_shapes_and_repeats():
    features = Features(16)
    forms = lambda text: set(features.of(text)[1].tolist())
    assert forms(b"one two three") == forms(b"four five six")
    assert forms(b"ONE!! TWO!!") != forms(b"one!! two!!")
    assert forms(b"a a a") != forms(b"a b c")
    assert [len(x) for x in features.of(None)] == [0, 0]


def test_a_million_rules_stay_small():
    names = [f"site{n}.example{n % 97}.com" for n in range(250_000)]
    rules = [("block" if k else "allow", name, f"/p{n % 50}/{k}") for n, name in enumerate(names) for k in range(4)]
    trie = RuleTrie(rules)
    assert len(rules) == 1_000_000 and trie.nbytes < 130 << 20 and len(pickle.dumps(trie)) < 130 << 20
    assert trie.best(b"a.site77.example77.com", b"/p27/2x/y") == ("block", "site77.example77.com/p27/2", (3, 6))
    assert trie.best(b"a.site77.example77.com", b"/p28/2") is None
