"""The operators as queries over whole tables, with SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.llm.bpe import encode_decode
from subscore.llm.decontaminate import benchmark_spans, n_covered
from subscore.llm.hard_negatives import mine_hard_negatives
from subscore.llm.licenses import PHRASES, license_spans
from subscore.llm.line_dedup import remove_repeated_lines
from subscore.llm.ngram_join import similar_texts
from subscore.llm.quality import fit_quality, in_training, score_quality
from subscore.llm.secret_ledger import BASE, RULES, digest_spans, findings, scan_versions
from subscore.llm.substring_dedup import remove_repeated_passages
from subscore.llm.topk import exact_top_k
from subscore.llm.url_filter import judge_urls
from subscore.llm.warc import archive_round_trip
from subscore.llm.whitening import whiten
from subscore.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Queries with other settings of an operator, beside the one that each has above, and their SQL.
MORE_QUERIES: dict[str, Query] = {}
MORE_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, more: bool = False) -> Callable[[Query], Query]:
    queries, oracles = (MORE_QUERIES, MORE_ORACLES) if more else (QUERIES, ORACLES)

    def register(function: Query) -> Query:
        queries[name] = function
        if sql is not None:
            oracles[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])
    numbers = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: SQL for the words of a text.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(
    "op2_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    i AS (
      SELECT item_id::VARCHAR AS item, words, least(10, len(words)) AS n
      FROM (SELECT item_id, {_WORDS} AS words FROM benchmark)),
    windows AS (
      SELECT DISTINCT item, n, list_slice(words, s, s + n - 1) AS run
      FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM i WHERE n > 0)),
    places AS (
      SELECT doc_id, n, s, list_slice(words, s, s + n - 1) AS run
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
            FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
    hits AS (SELECT doc_id, item, p.n, s FROM places p JOIN windows w ON p.run = w.run),
    words AS (
      SELECT doc_id, count(DISTINCT s) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS s FROM hits) GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
      coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN words AS hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_spans(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    n_hit = n_covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: Verdict, host and start of the path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_FITS = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
    f"THEN '{verdict} {host}{path}'"
    for verdict, host, path in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
)


@query(
    "op5_url_filter",
    f"""
    WITH parts AS (
      SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    judged AS (SELECT *, CASE {_FITS} END AS found FROM parts)
    SELECT page_id, host, path, split_part(found, ' ', 2) AS rule,
      coalesce(split_part(found, ' ', 1), 'allow') AS verdict
    FROM judged""",
)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    labels = lambda *lists: F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")
    coverage = F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"),
        labels(F.col("places.label"), F.col("spans.label")).alias("labels"),
        # A phrase is a template that is covered in full.
        F.when(F.size("places") > 0, 1.0).otherwise(coverage).alias("score"),
    )


_PHRASES = [
    f"list_transform(list_filter(range(1, len(words) + 1), lambda i: "
    f"list_slice(words, i, i + {len(phrase.split()) - 1}) = {phrase.split()!r}), lambda i: ('{label}', i - 1))"
    for label, phrase in PHRASES
]


@query(
    "op7_licenses_base",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    p AS (SELECT doc_id, len(words) AS n, flatten([{", ".join(_PHRASES)}]) AS places FROM d)
    SELECT doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base,
      list_min(list_transform(places, lambda x: x[2]))::BIGINT AS first_word,
      list_max(list_transform(places, lambda x: x[2]))::BIGINT AS last_word,
      array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x[1]))), ',') AS base_labels
    FROM p""",
    more=True,
)
def op7_licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL can say."""
    return op7_licenses(spark, sf_dir).drop("labels", "score")


@query(
    "op9_top_k",
    """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS at FROM whole),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM parts q JOIN parts c ON q.at = c.at AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0 GROUP BY ALL),
    ranked AS (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT
        AS rank, vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, weights, keep=["doc_id"])
    return scored.select(
        "doc_id",
        (~in_training("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query(
    "op6_warc",
    """
    WITH payloads AS (
      SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
      FROM pages),
    kept AS (
      SELECT *, max(page_id) OVER (PARTITION BY html) AS latest FROM payloads)
    SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
      CASE WHEN n >= 1000 AND latest IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN n >= 1000 AND latest IS DISTINCT FROM page_id THEN latest END AS refers_to
    FROM kept""",
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pages carry no time of capture; their number stands for it.
    captured = F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)) % 1_000_000_000
    back = archive_round_trip(table(spark, sf_dir, "pages"), captured)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op4_line_dedup",
    """
    WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    l AS (
      SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
    w AS (
      SELECT doc_id, pos, line, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c
      FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
    r AS (
      SELECT doc_id, pos, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) AS k
      FROM w WHERE b IS NOT NULL AND c IS NOT NULL),
    gone AS (
      SELECT DISTINCT doc_id, pos + more AS pos
      FROM r, (VALUES (0), (1), (2)) AS t(more) WHERE k > 1),
    kept AS (
      SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
        string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text
      FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
      coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = remove_repeated_lines(docs, min_lines=3)
    return left.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


#: Fixed value: words of a repeated run of lines, from a single line on.
RUN_WORDS = 5


@query(
    "op4_line_dedup_words",
    f"""
    WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    l AS (
      SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
    n AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM l),
    a AS (
      SELECT *, (count(*) FILTER (WHERE n > 0) OVER d - (n > 0)::INT)::BIGINT AS place,
        count(*) FILTER (WHERE n > 0) OVER (PARTITION BY doc_id) AS n_full
      FROM n WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
    f AS (
      SELECT doc_id, list(line ORDER BY place) AS lines, list(n ORDER BY place) AS ns
      FROM a WHERE n > 0 GROUP BY doc_id),
    p AS (SELECT *, unnest(range(1, len(lines) + 1)) AS s FROM f),
    w AS (
      SELECT doc_id, s - 1 AS place, k, list_slice(lines, s, s + k - 1) AS run
      FROM (SELECT *, unnest(range(1, {RUN_WORDS} + 1)) AS k FROM p)
      WHERE s + k - 1 <= len(lines) AND list_sum(list_slice(ns, s, s + k - 1)) >= {RUN_WORDS}),
    r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, place) AS copy FROM w),
    gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + k)) AS place FROM r WHERE copy > 1),
    judged AS (
      SELECT a.*, CASE WHEN a.n > 0 THEN g.place IS NOT NULL ELSE n_full > 0
          AND (a.place = 0 OR b.place IS NOT NULL) AND (a.place = n_full OR g.place IS NOT NULL) END AS out
      FROM a LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.place = a.place
        LEFT JOIN gone b ON b.doc_id = a.doc_id AND b.place = a.place - 1),
    kept AS (
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed,
        string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT out) AS text
      FROM judged GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
      coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    more=True,
)
def op4_line_dedup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = remove_repeated_lines(docs, min_lines=1, min_words=RUN_WORDS)
    return left.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query(
    "op8_substring_dedup",
    """
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
      FROM documents),
    w AS (
      SELECT doc_id, s, md5(array_to_string(list_slice(words, s, s + 49), ' ')) AS run
      FROM (SELECT *, unnest(range(1, len(words) - 48)) AS s FROM d WHERE len(words) >= 50)),
    f AS (SELECT run, min(doc_id) AS first FROM w GROUP BY run),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS at
      FROM w JOIN f ON w.run = f.run AND w.doc_id > f.first),
    kept AS (
      SELECT l.doc_id, count(g.at) AS n_removed,
        string_agg(word, ' ' ORDER BY l.at) FILTER (WHERE g.at IS NULL) AS text
      FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM d) l
      LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.at = l.at GROUP BY l.doc_id)
    SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
      sha256(coalesce(k.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = remove_repeated_passages(docs)
    return left.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query(
    "op3_ngram_join",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
    t AS (SELECT text, any_value(words) AS words, min(doc_id) AS id FROM d GROUP BY text),
    s AS (
      SELECT DISTINCT id, array_to_string(list_slice(words, p, p + least(5, len(words)) - 1), ' ') AS g
      FROM (SELECT *, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS p
            FROM t WHERE len(words) > 0)),
    n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
    c AS (
      SELECT a.id AS a, b.id AS b, count(*) AS common
      FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
    links AS (
      SELECT a, b FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b
      WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9),
    reached AS (
      WITH RECURSIVE r(id, other) AS (
        SELECT id, id FROM t UNION SELECT r.id, l.b FROM r JOIN links l ON l.a = r.other)
      SELECT id, min(other) AS class_id FROM r GROUP BY id),
    counted AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
    SELECT d.doc_id, r.class_id, coalesce(n_links, 0)::BIGINT AS n_links
    FROM d JOIN t ON t.text = d.text JOIN reached r ON r.id = t.id
    LEFT JOIN counted k ON k.id = t.id""",
)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_texts(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


@query(
    "op11_hard_negatives",
    """
    WITH whole AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (
      SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS at FROM whole),
    scored AS (
      SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, any_value(a.label = c.label) AS same,
        sum(a.x * c.x)::BIGINT AS score
      FROM parts a JOIN parts c ON a.at = c.at AND a.vec_id <> c.vec_id
      WHERE a.vec_id % 100 = 0 GROUP BY ALL),
    near AS (
      SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
      FROM scored WHERE same),
    hard AS (
      SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
        p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (
          PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INT AS rank
      FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND n.score <= p.score
      WHERE place <= 5)
    SELECT * FROM hard WHERE rank <= 5""",
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def _secrets_sql() -> str:
    """SQL for the spans of every rule, with the rules' own patterns; places are prefix sums."""
    made = []
    for place, rule in enumerate(RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        made.append(
            f"SELECT row, {place} AS place, '{rule.kind}' AS kind, string_split_regex(text, {pattern}) AS gaps, "
            f"regexp_extract_all(text, {pattern}, 0) AS found, "
            f"regexp_extract_all(text, {pattern}, {rule.group}) AS value, {rule.least} AS least "
            f"FROM d WHERE regexp_matches(text, {pattern})"
        )
    base = len(BASE)
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE
    )
    told = "kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, place"
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    matched AS ({" UNION ALL ".join(made)}),
    places AS (
      SELECT row, place, kind, least, value[i] AS value, length(found[i]) AS size,
        (list_sum(list_transform(list_slice(gaps, 1, i), lambda x: length(x)))
          + list_sum(list_transform(list_slice(found, 1, i), lambda x: length(x))))::BIGINT AS end_at
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matched)),
    spans AS (
      SELECT row, place, kind, end_at - size AS start_at, end_at FROM places
      WHERE length(value) >= least),
    told AS (
      SELECT row, {counts},
        string_agg({told}) FILTER (WHERE place < {base}) AS base, string_agg({told}) AS spans
      FROM spans GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0)::BIGINT AS n_{rule.kind}" for rule in BASE)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN told USING (row)"""


@query("op13_secrets", _secrets_sql())
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = scratch_path(spark, "ledger")
    run = scan_versions(table(spark, sf_dir, "documents"), ledger, RULES)
    found = findings(spark, ledger, RULES, run)
    of_kind = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["place"] < len(BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *(of_kind(rule.kind).alias(f"n_{rule.kind}") for rule in BASE),
        F.sha2(digest_spans(base), 256).alias("base_sha256"),
        digest_spans(F.col("spans")).alias("spans"),
    )
