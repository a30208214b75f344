"""The operators on small tables: nulls, empty and long texts, repeats, clashing names, no rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscore.llm import decontaminate, ngram_join, substring_dedup, topk, url_filter
from subscore.llm.bpe import encode_decode
from subscore.llm.components import connected_components
from subscore.llm.decontaminate import benchmark_spans, n_covered
from subscore.llm.licenses import license_spans
from subscore.llm.line_dedup import remove_repeated_lines, repeated_runs
from subscore.llm.ngram_join import drop_similar_texts, similar_texts
from subscore.llm.quality import Settings, fit_quality, score_quality
from subscore.llm.queries import tokenizer_path
from subscore.llm.substring_dedup import remove_repeated_passages
from subscore.llm.text import words_of
from subscore.llm.topk import exact_top_k
from subscore.llm.url_filter import judge_urls
from subscore.llm.warc import INDEX, archive_round_trip, merged_index, write_archives
from subscore.session import scratch_path

DOCS = "doc_id long, text string"


def docs(spark, rows, extra: str = ""):
    return spark.createDataFrame(rows, DOCS + extra).repartition(3)


def random_words(rng, n, letters="abcdefgh"):
    return [rng.choice(letters) + rng.choice(letters) for _ in range(n)]


# --- BPE ----------------------------------------------------------------------


def test_bpe_cases(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7), (None, "x" * 30_000, 8), (5, "é\x00<|endoftext|>", 9)]
    found = encode_decode(docs(spark, rows, ", ids long"), tokenizer_path())
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    got = found.collect()
    assert sorted(r.decoded for r in got) == sorted(text or "" for _, text, _ in rows)
    assert [r.ids for r in got if not r.text] == [[], []]
    assert sum(r.doc_id == 3 for r in got) == 2
    assert encode_decode(docs(spark, [], ", x int"), tokenizer_path(), keep=["doc_id"]).collect() == []


# --- decontamination ----------------------------------------------------------


def covered(text, items, window=10):
    words, hit, ids = words_of((text or "").encode()), set(), set()
    for item, own in items:
        own = words_of((own or "").encode())
        n = min(window, len(own))
        for at in range(len(own) - n + 1 if n else 0):
            for start in range(len(words) - n + 1):
                if words[start : start + n] == own[at : at + n]:
                    hit |= set(range(start, start + n))
                    ids.add("" if item is None else str(item))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_benchmark_spans(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(decontaminate, "MOST_SLOTS", 256)
    rng = random.Random(1)
    words = random_words(rng, 400, "abc")
    items = [(n, " ".join(words[n * 17 : n * 17 + rng.randint(1, 30)])) for n in range(12)]
    items += [(3, items[3][1]), (None, "Zz-zz zz"), (20, None), (21, "--"), (10, "ab")]
    rows = [(n, " ".join(words[n * 9 : n * 9 + 60]).upper(), n) for n in range(30)]
    rows += [(40, None, 1), (41, "", 1), (None, "x zz ZZ zz. y", 1), (0, rows[0][1], 0)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = benchmark_spans(docs(spark, rows, ", items long"), benchmark)
    assert found.columns == ["doc_id", "text", "n_words", "spans", "items"]
    got = found.select("doc_id", "text", "n_words", n_covered(F.col("spans")), "items").collect()
    assert len(got) == len(rows)
    for doc_id, text, n_words, n_hit, ids in got:
        assert (n_words, n_hit, ids) == covered(text, items), doc_id
    empty = benchmark.limit(0)
    assert benchmark_spans(docs(spark, rows, ", items long"), empty).where("size(spans) > 0").isEmpty()
    assert benchmark_spans(docs(spark, []), benchmark).isEmpty()


# --- similar texts ------------------------------------------------------------


def classes_by_hand(rows, threshold=0.8):
    texts = {text or "" for _, text in rows}
    grams = {}
    for text in texts:
        words = words_of(text.encode())
        n = min(5, len(words))
        grams[text] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    links = {
        a: [b for b in texts if a != b and grams[a] and grams[b]
            and len(grams[a] & grams[b]) >= threshold * len(grams[a] | grams[b])]
        for a in texts
    }
    want = []
    for doc_id, text in rows:
        reached, todo = {text or ""}, [text or ""]
        while todo:
            for other in links[todo.pop()]:
                if other not in reached:
                    reached.add(other)
                    todo.append(other)
        ids = [i for i, t in rows if (t or "") in reached and i is not None]
        want.append((doc_id, min(ids, default=None), len(links[text or ""])))
    return sorted(want, key=str)


@pytest.mark.parametrize("block", [1024, 7])
def test_similar_texts(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(2)
    rows = []
    for group in range(6):
        base = random_words(rng, 120)
        for _ in range([1, 2, 3, 8, 30, 2][group]):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice("xyz") * 3
            rows.append((len(rows), " ".join(own)))
    rows += [(100, None), (101, ""), (102, "..."), (103, "one two"), (104, "One, two!"), (105, "two one")]
    rows += [(None, rows[0][1]), (106, rows[0][1]), (None, "alone here"), rows[5], rows[5]]
    found = similar_texts(docs(spark, [(*r, 1) for r in rows], ", node int"))
    got = [tuple(r) for r in found.select("id", "class_id", "n_links").collect()]
    assert sorted(got, key=str) == classes_by_hand(rows)
    kept = drop_similar_texts(docs(spark, [(*r, 1) for r in rows], ", node int"))
    assert kept.columns == ["doc_id", "text", "node"]
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted({c for _, c, _ in got}, key=str)


def test_similar_texts_of_nothing(spark):
    assert similar_texts(docs(spark, [])).isEmpty()
    assert drop_similar_texts(docs(spark, [])).isEmpty()
    assert similar_texts(docs(spark, [(1, None)])).first().class_id == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    root = {n: n for edge in edges for n in edge}
    for _ in range(50):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    scratch_path(spark, "x")  # sets the folder for checkpoints
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {tuple(r) for r in found.collect()} == {(n, r) for n, r in root.items() if n in linked}


# --- licences inside longer matches -------------------------------------------


def test_template_inside_a_longer_match(spark):
    templates = [("long", "a b c d e f g h i j k l m n o p q r s t"), ("short", "d e f g"), ("other", "f g x y")]
    rows = [(1, "a b c d e f g h i and more"), (2, "d e f g"), (3, "a b c d e f g x y z")]
    found = license_spans(docs(spark, rows), [], templates)
    got = {r.doc_id: {(s.label, s.start, s.end, s.coverage) for s in r.spans} for r in found.collect()}
    assert got[1] == {("short", 3, 7, 1.0)} and got[2] == {("short", 0, 4, 1.0)}
    assert got[3] == {("short", 3, 7, 1.0), ("other", 5, 9, 1.0)}
    line = "Licensed under the Apache License, Version 2.0. The rest is ours."
    spans = license_spans(docs(spark, [(1, line)])).first().spans
    assert [(s.label, s.start, s.end) for s in spans] == [("apache", 0, 8)]


# --- lines --------------------------------------------------------------------


def lines_by_hand(rows, least):
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None}, key=str)
    order = sorted(order, key=lambda r: r[:2])
    seen, gone = set(), {}
    for key in order:
        lines = key[2].split("\n")
        out = set()
        for at in range(len(lines) - least + 1):
            run = tuple(lines[at : at + least])
            if run in seen:
                out |= set(range(at, at + least))
            seen.add(run)
        gone[key] = ("\n".join(x for n, x in enumerate(lines) if n not in out), len(lines), len(out))
    return [
        (i, *((None, 0, 0) if t is None else gone[(i is not None, i or 0, t)])) for i, t in rows
    ]


@pytest.mark.parametrize("least", [1, 2, 3, 5, 6])
def test_repeated_lines(spark, least):
    rng = random.Random(least)
    rows = []
    for n in range(40):
        lines = [rng.choice(["a", "b", "", "c d"]) for _ in range(rng.randint(1, 12))]
        rows.append((n * 3, "\n".join(lines)))
    rows += [(500, None), (501, ""), (None, rows[3][1]), rows[4], rows[4], (502, "\n" * 40)]
    found = remove_repeated_lines(docs(spark, [(*r, 1) for r in rows], ", n_lines int"), least)
    assert found.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(lines_by_hand(rows, least), key=str)


def test_maximal_runs(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\nd\ny"), (3, "a\nb\nc\nd\ne\na\nb"), (4, "c\nd\ny")]
    found = repeated_runs(docs(spark, rows), 2)
    got = found.select("id", "start", "end", "source_id", "source_start").collect()
    assert sorted(map(tuple, got)) == [
        (2, 1, 4, 1, 1), (3, 0, 5, 1, 0), (3, 5, 7, 1, 0), (4, 0, 2, 1, 2), (4, 1, 3, 2, 3),
    ]


def lines_by_words(rows, least, words):
    """The rule for runs that count by their words, every run of every length compared."""
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None}, key=lambda r: r[:2])
    seen, gone = set(), {}
    for key in order:
        lines = key[2].split("\n")
        full = [at for at, line in enumerate(lines) if line.split()]
        out = set()
        for start in range(len(full)):
            for end in range(start + least, len(full) + 1):
                run = tuple(lines[at] for at in full[start:end])
                if sum(len(line.split()) for line in run) >= words:
                    out |= set(range(start, end)) if run in seen else set()
                    seen.add(run)
        for at, line in enumerate(lines):
            sides = [*[n for n, x in enumerate(full) if x < at][-1:], *[n for n, x in enumerate(full) if x > at][:1]]
            if not line.split() and sides and all(n in out for n in sides):
                out.add(-1 - at)
        removed = {full[n] if n >= 0 else -1 - n for n in out}
        left = "\n".join(x for n, x in enumerate(lines) if n not in removed)
        gone[key] = (left, len(lines), len(removed))
    return [(i, *((None, 0, 0) if t is None else gone[(i is not None, i or 0, t)])) for i, t in rows]


@pytest.mark.parametrize("least, words", [(1, 1), (1, 3), (1, 5), (2, 3), (4, 3), (1, 9)])
def test_repeated_lines_by_words(spark, least, words):
    rng = random.Random(words)
    lines = ["a", "b c", "", " ", "d e f", "g h i j k l m", "n o p q r"]
    rows = [(n * 3, "\n".join(rng.choices(lines, k=rng.randint(1, 9)))) for n in range(40)]
    rows += [(n + 200, f"own words {n} of this line") for n in range(9)]
    rows += [(500, None), (501, ""), (None, rows[3][1]), rows[4], rows[4], (502, "\n" * 40), rows[41]]
    found = remove_repeated_lines(docs(spark, rows), least, min_words=words)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(lines_by_words(rows, least, words), key=str)


def test_single_lines_and_short_texts_repeat(spark):
    rows = [(n, f"text {n}\n\nall rights are reserved by us") for n in range(5)]
    rows += [(9, "all rights are reserved by us\n"), (10, "text 0")]
    found = remove_repeated_lines(docs(spark, rows), 1, min_words=5)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in found.collect()}
    assert got[0] == (rows[0][1], 3, 0) and got[4] == ("text 4\n", 3, 1)
    assert got[9] == ("", 2, 2) and got[10] == ("text 0", 1, 0)


@pytest.mark.parametrize("words", [0, 5])
def test_hot_runs_are_divided(spark, words):
    """The side with the first copies is no aggregate above the shuffle of their join."""
    found = repeated_runs(docs(spark, [(1, "a\nb\nc"), (2, "a\nb\nc")]), 3, min_words=words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan[plan.index("Join") :]


def test_repeated_lines_use_no_python(spark):
    found = remove_repeated_lines(docs(spark, [(1, "a\nb\nc"), (2, "a\nb\nc")]), 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow") if word in plan]
    assert remove_repeated_lines(docs(spark, []), 2).isEmpty()


# --- URLs ---------------------------------------------------------------------


@pytest.mark.parametrize("block", [1_000_000, 1])
def test_urls(spark, monkeypatch, block):
    monkeypatch.setattr(url_filter, "BLOCK_RULES", block)
    rules = [("allow", "org", "/"), ("block", "a.org", "/x"), ("block", "org", "/"), ("allow", "com", "")]
    rows = [(1, None), (2, "x"), (3, "h://B.A.org/xy?q#f"), (3, "h://B.A.org/xy?q#f"), (None, "h://c.org/"), (4, "h://z.com")]
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, host int")
    found = judge_urls(pages, rules, default="block")
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.na.fill({"page_id": 0}).collect())
    assert got == [
        (0, "c.org", "/", "org/", "block"),
        (1, "", "", None, "block"),
        (2, "", "", None, "block"),
        (3, "b.a.org", "/xy", "a.org/x", "block"),
        (3, "b.a.org", "/xy", "a.org/x", "block"),
        (4, "z.com", "", "com", "allow"),
    ]
    assert judge_urls(pages.limit(0), rules).isEmpty()
    assert judge_urls(pages, []).where("rule IS NOT NULL").isEmpty()


# --- WARC ---------------------------------------------------------------------


def test_archives(spark):
    long, other = "é" * 600, "b" * 1500
    rows = [
        (1, "http://b.org/x", long), (2, "http://a.org/x", long), (3, None, long), (4, "no url", None),
        (5, "http://a.b.org/", other), (5, "http://a.b.org/", other), (None, "http://c", other),
        (6, "http://a.org/x\r\ny", "short"), (7, "http://a.org/x", "short"),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    back = archive_round_trip(pages.repartition(3), F.lit(1000) + F.coalesce("page_id", F.lit(0))).collect()
    assert len(back) == len(rows)
    for row in back:
        html = next(h for p, u, h in rows if (p, u) == (row.page_id, row.url)) or ""
        data = html.encode()
        assert (row.payload_bytes, row.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        latest = {long: 3, other: 5}.get(html)
        revisit = latest is not None and row.page_id != latest
        assert (row.record_type, row.refers_to) == (("revisit", latest) if revisit else ("response", None))
        assert row.payload == (None if revisit else data)
    assert archive_round_trip(pages.limit(0), F.lit(0)).isEmpty()


def test_merged_index_is_sorted(spark):
    rng = random.Random(4)
    rows = [(n, f"http://{rng.choice('abé')}.org/{rng.randint(0, 3)}", "x") for n in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        runs = write_archives(pages, scratch_path(spark, "warc"), F.col("page_id") % 7)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    index = merged_index(runs, 4)
    parts = index.withColumn("part", F.spark_partition_id()).collect()
    keys = [(r.urlkey.encode(), r.timestamp, r.archive, r.place) for r in sorted(parts, key=lambda r: r.part)]
    assert keys == sorted(keys) and len(keys) == 300
    assert index.columns == [part.split()[0] for part in INDEX.split(", ")]
    assert len({r.archive for r in parts}) > 1


# --- licences -----------------------------------------------------------------


def test_license_families_in_other_wording(spark):
    """Notices as files carry them: comment marks, other case and line ends, words left out or changed."""
    notices = {
        "agpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as\n# published by the Free Software Foundation, either version 3 of the\n# License, or (at your option) any later version.",
        "lgpl": " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or any later version.",
        "isc": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
        "bsd-3": "3. Neither the name of the Regents nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "cc-by-sa": "<p>This work is licensed under a <a>Creative Commons Attribution-ShareAlike 4.0 International License</a>.",
        "unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.",
        "zlib": "THIS SOFTWARE IS PROVIDED 'AS-IS', WITHOUT ANY EXPRESS OR IMPLIED WARRANTY. IN NO EVENT WILL THE AUTHORS BE HELD LIABLE FOR ANY DAMAGES ARISING FROM THE USE OF THIS SOFTWARE.",
        "mpl": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0, available at https://www.eclipse.org/legal/epl-2.0/",
    }
    rows = list(enumerate([f"some code first {text} and code behind" for text in notices.values()]))
    rows += [(100, "the licence of this library lets anyone use the software for any purpose"), (101, "permission is needed")]
    found = {r.doc_id: {x.label for x in r.spans} for r in license_spans(docs(spark, rows)).collect()}
    for number, label in enumerate(notices):
        assert label in found[number], label
    assert found[100] == found[101] == set()
    with pytest.raises(ValueError, match="words of templates"):
        license_spans(docs(spark, rows), templates=[("x", "word " * 100_001)])


def test_licenses(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "MIT-License, the MIT  license", 1), (3, "mit", 1), (None, "cc by " * 20_000, 1)]
    found = license_spans(docs(spark, rows, ", spans int"))
    assert found.columns == ["doc_id", "text", "n_words", "places", "spans"]
    got = {(r.doc_id, r.n_words): [tuple(p) for p in r.places] for r in found.collect()}
    assert got[(1, 0)] == got[(2, 0)] == got[(3, 1)] == []
    assert got[(3, 5)] == [("mit", 0, 2), ("mit", 3, 5)]
    assert got[(None, 40_000)] == [("cc-by", n, n + 2) for n in range(0, 40_000, 2)]
    assert license_spans(docs(spark, [])).isEmpty()


# --- passages -----------------------------------------------------------------


def passages_by_hand(rows, width):
    starts = {}
    for doc_id, text in rows:
        words = (text or "").split()
        for at in range(len(words) - width + 1 if doc_id is not None else 0):
            run = tuple(words[at : at + width])
            starts[run] = min(doc_id, starts.get(run, doc_id))
    want = []
    for doc_id, text in rows:
        words, gone = (text or "").split(), set()
        for at in range(len(words) - width + 1 if doc_id is not None else 0):
            if starts[tuple(words[at : at + width])] < doc_id:
                gone |= set(range(at, at + width))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        want.append((doc_id, None if text is None else kept, len(words), len(gone)))
    return want


@pytest.mark.parametrize("chunk", [12 << 20, 200])
def test_repeated_passages(spark, monkeypatch, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substring_dedup, "SHARD_BITS", 8)
    rng = random.Random(5)
    passage, rows = random_words(rng, 30), []
    for n in range(60):
        words = random_words(rng, rng.randint(0, 40))
        if n % 3 == 0:
            at = rng.randint(0, 20)
            words[5:5] = passage[at : at + rng.randint(4, 12)]
        rows.append((n * 2, "  ".join(words)))
    rows += [(300, None), (301, ""), (302, rows[6][1]), (303, rows[6][1]), rows[9], rows[9]]
    rows += [(None, rows[12][1]), (12, "\t".join(passage)), (304, "same " * 50), (305, " ".join(passage[:6]))]
    found = remove_repeated_passages(docs(spark, [(*r, 1) for r in rows], ", n_words int"), width=6)
    assert found.columns == ["doc_id", "text", "n_words", "n_removed"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(passages_by_hand(rows, 6), key=str)


def test_repeated_passages_of_nothing(spark):
    assert remove_repeated_passages(docs(spark, [])).isEmpty()
    assert remove_repeated_passages(docs(spark, [(None, None)])).first().n_words == 0


# --- search -------------------------------------------------------------------


def best_by_hand(rows, k):
    usable = {
        n: np.floor(1024 * np.array(v, np.float64)).astype(np.int64)
        for n, v in rows
        if n is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    want = []
    for q, own in usable.items():
        if q % 100 == 0:
            scores = []
            for n, v in usable.items():
                if n != q:
                    size = min(len(own), len(v))
                    scores.append((-int(own[:size] @ v[:size]), n))
            want += [(q, rank, n, -s) for rank, (s, n) in enumerate(sorted(scores)[:k], 1)]
    return sorted(want)


@pytest.mark.parametrize("block", [4096, 16])
def test_top_k(spark, monkeypatch, block):
    for name in ("BLOCK", "QUERIES", "SAMPLE"):
        monkeypatch.setattr(topk, name, block)
    rng = np.random.default_rng(6)
    rows = [(n, rng.normal(size=8).round(2).tolist()) for n in range(0, 1200, 2)]
    rows += [(n, [0.25] * 8) for n in range(2001, 2200)]
    rows += [(3000, None), (3100, [None] * 8), (3200, [float("nan")] * 8), (3300, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (3400, [0.5, 0.5]), (3500, []), (3600, [0.0] * 8)]
    schema = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame(rows, schema).repartition(3)
    got = exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=5, pivots=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == best_by_hand(rows, 5)
    few = spark.createDataFrame(rows[:3] + [rows[0]], schema)
    # A repeated row is a candidate as often as it is there, a query once, never its own.
    got = exact_top_k(few, few.where("vec_id = 2"), k=5).collect()
    assert [r.vec_id for r in got if r.vec_id == 0] == [0, 0] and len(got) == 3
    assert exact_top_k(vectors.limit(0), vectors).isEmpty()
    assert exact_top_k(vectors, vectors.limit(0)).isEmpty()
    assert exact_top_k(few.where("vec_id = 0").limit(1), few.where("vec_id = 0")).isEmpty()


def test_top_k_pairs_few_blocks(spark, monkeypatch):
    """Bundles of vectors far apart: a block of queries meets the annuli of its own bundles alone."""
    for name, size in (("BLOCK", 20), ("QUERIES", 8), ("INDEX", 7), ("UNIT", 3)):
        monkeypatch.setattr(topk, name, size)
    paths = []
    monkeypatch.setattr(topk, "scratch_path", lambda spark, name: paths.append(scratch_path(spark, name)) or paths[-1])
    rng = np.random.default_rng(7)
    centres = np.eye(20) * 10
    rows = [(n, (centres[n % 20] + rng.normal(0, 0.05, 20)).tolist()) for n in range(4000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=5, pivots=20)
    assert sorted(map(tuple, got.collect())) == best_by_hand(rows, 5)
    annuli, queries, pairs = (
        spark.read.parquet(next(path for path in paths if f"/{name}-" in path)).count()
        for name in ("annuli", "queries", "pairs")
    )
    assert annuli > 100 and queries > 3 and pairs < annuli * queries / 3


def test_top_k_of_large_numbers(spark):
    rows = [(0, [3e12, 1.0]), (1, [1.0, 7.0]), (2, [1.0, 8.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_top_k(vectors, vectors.where("vec_id = 0"), k=5).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2**20 * (3 * 10**12 + 8)), (1, 2**20 * (3 * 10**12 + 7))]


# --- quality ------------------------------------------------------------------


def test_quality(spark):
    rng = random.Random(7)
    rows, marks = [], []
    for n in range(400):
        words = random_words(rng, rng.randint(5, 80))
        rows.append((n, " ".join(words if n % 3 else [w.upper() + "!!" for w in words]), n))
        marks.append((n, int(n % 3 > 0)))
    marks += [(None, 0), (1, None), (2, 7), (5000, 0)]
    rows += [(900, None, 1), (901, "", 1), (None, "Ab cd", 1), (3, rows[3][1], 3)]
    table = docs(spark, rows, ", score int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    settings = Settings(bits=14, max_rows=200, shards=2)
    weights = fit_quality(table, labels, settings)
    assert (weights == fit_quality(table.repartition(5), labels, settings)).all()
    found = score_quality(table, weights, settings)
    assert found.columns == ["doc_id", "text", "score"]
    got = found.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    assert sum((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in known) > 0.99 * len(known)
    assert len({r.score for r in got if not r.text}) == 1
    none = fit_quality(table, labels.limit(0), settings)
    assert {r.score for r in score_quality(table, none, settings).collect()} == {0.5}
    assert score_quality(table.limit(0), weights, settings).isEmpty()
