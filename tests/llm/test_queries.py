"""The registered queries against SQL, the tokenizers library and plain versions."""

from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from subscore.llm.bpe import encode_decode
from subscore.llm.decontaminate import benchmark_spans
from subscore.llm.licenses import license_spans
from subscore.llm.line_dedup import remove_repeated_lines
from subscore.llm.ngram_join import drop_similar_texts
from subscore.llm.quality import score_quality
from subscore.llm.queries import MORE_ORACLES, MORE_QUERIES, ORACLES, QUERIES, RUN_WORDS, tokenizer_path
from subscore.llm.substring_dedup import remove_repeated_passages
from subscore.llm.url_filter import judge_urls

from .test_operators import classes_by_hand, covered, lines_by_hand, lines_by_words

SF_DIR = "/root/testdata/sf0.001"


def rows_of(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(*columns).collect()]


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_all_are_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 13
    assert QUERIES.items() <= contract.queries().items()
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    want = database.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert want
    assert ordered(tuple(row[c] for c in columns) for row in found.collect()) == ordered(want)


@pytest.mark.parametrize("name", sorted(MORE_ORACLES))
def test_other_setting_equals_sql(spark, name):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = MORE_QUERIES[name](spark, SF_DIR)
    want = database.execute(f"SELECT {', '.join(found.columns)} FROM ({MORE_ORACLES[name]})").fetchall()
    assert ordered(map(tuple, found.collect())) == ordered(want)
    assert MORE_QUERIES.items() <= contract.queries().items()
    assert MORE_ORACLES.items() <= contract.oracle_sql().items()


def test_no_line_with_words_stays_twice(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").dropDuplicates(["text"])
    left = remove_repeated_lines(docs, 1, min_words=RUN_WORDS).select(F.explode(F.split("text", "\n")).alias("line"))
    long = left.where(F.size(F.split(F.trim("line"), " +")) >= RUN_WORDS)
    assert long.groupBy("line").count().where("count > 1").isEmpty() and not long.isEmpty()


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(tokenizer_path())
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for doc_id, text in rows_of(spark, "documents", "doc_id", "text"):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(decoded)))
    assert ordered(map(tuple, QUERIES["op1_bpe"](spark, SF_DIR).collect())) == ordered(want)


def test_licenses_equal_regular_expressions(spark):
    phrases = {
        "gpl": "gnu general public license",
        "apache": "apache license",
        "cc-by": "cc by",
        "mit": "mit license",
    }
    found = {r.doc_id: r for r in QUERIES["op7_licenses"](spark, SF_DIR).collect()}
    for doc_id, text in rows_of(spark, "documents", "doc_id", "text"):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [
            (n, label)
            for label, phrase in phrases.items()
            for n in range(len(words))
            if words[n : n + len(phrase.split())] == phrase.split()
        ]
        row, starts = found[doc_id], [n for n, _ in places]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op10_quality"](spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = scored.join(labels, "doc_id").where("held_out")
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[0] > 0.97 and right[1] > 50
    assert scored.where("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)").isEmpty()


def test_pipeline_equals_plain_stages(spark):
    library = Tokenizer.from_file(tokenizer_path())
    kept = {r.doc_id for r in QUERIES["op10_quality"](spark, SF_DIR).where("predicted = 1").collect()}
    docs = [(i, t) for i, t in rows_of(spark, "documents", "doc_id", "text") if i in kept]
    docs = [(i, t) for i, t, n, gone in lines_by_words(docs, 1, RUN_WORDS) if not gone or gone < n]
    first = {i for i, c, _ in classes_by_hand(docs) if i == c}
    benchmark = rows_of(spark, "benchmark", "item_id", "text")
    docs = [(i, t) for i, t in docs if i in first and not covered(t, benchmark)[1]]
    want = [(i, library.encode(t, add_special_tokens=False).ids, t) for i, t in docs]
    found = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "ids", "text").collect()
    assert ordered(tuple(r) for r in found) == ordered(want)
    lines = [x for r in found for x in r.text.split("\n") if len(x.split()) >= RUN_WORDS]
    assert 0 < len(lines) == len(set(lines))
    assert 0 < len(want) < len(kept)


def test_line_stage_keeps_columns(spark):
    rows = [(1, "one two three four five\nx", 25, 7), (2, "one two three four five\n", 24, 8), (3, None, 0, 9)]
    rows += [(4, "y\none two three four five", 25, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, n_removed int")
    left = corpus_pipeline.line_dedup(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert ordered(map(tuple, left.collect())) == ordered([rows[0], rows[2], (4, "y", 1, 10)])


#: Names that operators use for columns of their own, and names that need quoting.
CLASHING = [
    "id", "node", "root", "rank", "tie", "pos", "line", "first", "score", "spans", "items", "ids", "decoded",
    "n_words", "n_lines", "n_removed", "chunk", "place", "label", "size", "_metadata", "a b", "c.d",
]


@pytest.mark.parametrize("rows", [0, 12])
def test_stages_keep_clashing_columns(spark, rows):
    words = ["one two three four five six", "a different text of other words", None, ""]
    texts = [words[n % 4] if n < 8 else f"own {n}\nlines {n}\nof {n}" for n in range(rows)]
    data = [(n, t, None, *(n * 100 + k for k in range(len(CLASHING)))) for n, t in enumerate(texts)]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHING)
    docs = spark.createDataFrame(data, schema).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns, name
        found = {r[0]: tuple(r) for r in left.collect()}
        assert all(row == data[key] for key, row in found.items()), name
        assert name == "quality" or len(found) >= min(rows, 7), name
    assert corpus_pipeline.bpe(spark, docs, SF_DIR).count() == rows


def test_operators_keep_clashing_columns(spark):
    data = [(n, f"text {n}", *(n * 100 + k for k in range(len(CLASHING)))) for n in range(9)]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHING)
    docs = spark.createDataFrame(data, schema).repartition(3)
    items = spark.createDataFrame([("b", "other")], "item_id string, text string")
    made = [
        encode_decode(docs, tokenizer_path()),
        benchmark_spans(docs, items),
        license_spans(docs),
        remove_repeated_lines(docs),
        remove_repeated_passages(docs),
        drop_similar_texts(docs),
        judge_urls(docs, [("block", "x.org", "/")], url="text"),
        score_quality(docs, np.zeros((1 << 20) + 1)),
    ]
    for found in made:
        own = {"ids", "decoded", "n_words", "spans", "items", "n_lines", "n_removed", "score"}
        kept = [c for c in docs.columns if c not in own]
        assert set(kept) <= set(found.columns)
        names = [f"`{c}`" for c in kept]
        assert ordered(map(tuple, found.select(*names).collect())) == ordered(
            map(tuple, docs.select(*names).collect())
        )
