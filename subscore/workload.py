"""Every operator as a query over the given tables, next to the SQL that must agree.

The subscriber table's place is taken by ``orders``: a key, a label, a category
and two numbers. Reading it as text with faults planted by rule gives the raw
form that preparation has to clean.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from subscore.functions import (
    map_values,
    parse_json,
    sigmoid,
    substitute_values,
    vector_item,
)
from subscore.operators import prep
from subscore.operators.correlation import correlation_matrix, label_correlation, wide_correlation
from subscore.operators.encode import encode_sparse, learn_options, one_hot, one_hot_learned, one_hot_text
from subscore.operators.histogram import histogram
from subscore.operators.metrics import class_metrics, roc_areas
from subscore.operators.profile import (
    column_summary,
    distinct_values,
    null_counts,
    row_count,
    segment_shares,
    value_counts,
    value_shares,
)
from subscore.operators.quantiles import box_outliers, box_stats, medians
from subscore.operators.small import settle
from subscore.operators.split import first_rows, random_split, split_by_key, union_by_name
from subscore.plans.evaluate import evaluate_models
from subscore.plans.explain import (
    attributions,
    attributions_within,
    class_probability,
    explain_model,
    explain_models,
    explained_scorer,
    importance,
    probability_scorer,
    sample_background,
)
from subscore.plans.models import build_pipeline, fit, fit_models, fold
from subscore.plans.prepare import (
    TableSpec,
    clean,
    model_features,
    prepare,
    prepare_encode_first,
    rejects,
)
from subscore.plans.score import score, score_events
from subscore.plans.trees import tree_attributions
from subscore.plans.tune import (
    RUNGS,
    Choice,
    draw_params,
    rung_sizes,
    rungs_frame,
    search_families,
    selections_frame,
    trials_frame,
)
from subscore.session import remove_scratch, scratch_path
from subscore.sources.message_log import append_messages
from subscore.sources.messages import decode_messages, message_stream, parse_messages
from subscore.sources.model_store import publish_model
from subscore.sources.tables import (
    load_model,
    read_csv,
    read_typed_csv,
    save_model,
    write_csv,
    write_scores,
)
from subscore.streaming import start_batch_scoring, start_scoring, start_versioned_scoring

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly, once, for fits that read them dozens of times and explanations.

    Into as many parts as the session says a shuffle has, whatever the table's files are.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# --- the raw form of orders -------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

ORDERS = TableSpec(
    key="o_orderkey",
    label="o_orderstatus",
    types={"o_custkey": "int", "o_totalprice": "double"},
    options={"o_orderpriority": PRIORITIES},
    label_values={"F": 1, "O": 0},
)

MESSAGE_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def dirty(orders: DataFrame) -> DataFrame:
    """Orders as text, with fractions, blanks and null tokens planted by key."""
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("o_orderkey"),
        F.concat(
            F.col("o_custkey").cast("string"), F.when(key % 83 == 0, ".7").otherwise("")
        ).alias("o_custkey"),
        F.when(key % 89 == 0, " ").otherwise(F.col("o_totalprice").cast("string")).alias(
            "o_totalprice"
        ),
        F.when(key % 97 == 0, "?").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderstatus",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(table(spark, sf_dir, "orders"))


RAW = """raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 83 = 0 THEN '.7' ELSE '' END AS o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN ' ' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
         CASE WHEN o_orderkey % 97 = 0 THEN '?' ELSE o_orderpriority END AS o_orderpriority,
         o_orderstatus
  FROM orders)"""

TYPED = f"""{RAW}, typed AS (
  SELECT o_orderkey,
         CAST(trunc(TRY_CAST(o_custkey AS DOUBLE)) AS INTEGER) AS o_custkey,
         TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice,
         nullif(o_orderpriority, '?') AS o_orderpriority,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus
  FROM raw)"""

COMPLETE = "o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL"


def dummies(column: str, options: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{option}' THEN 1 ELSE 0 END AS \"{column}_{option}\""
        for option in options
    )


# --- casts, cleaning, projection --------------------------------------------


@query("cast_numbers", f"WITH {TYPED} SELECT o_orderkey, o_custkey, o_totalprice FROM typed")
def cast_numbers(spark, sf_dir):
    raw = raw_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return prep.coerce_numbers(prep.cast_columns(raw, {"o_custkey": "int"}), ["o_totalprice"])


@query(
    "map_label",
    """SELECT o_orderkey,
              CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label,
              CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE o_orderstatus END AS kept
       FROM orders"""
)
def map_label(spark, sf_dir):
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        map_values(status, {"F": 1, "O": 0}).alias("label"),
        substitute_values(status, {"F": 1, "O": 0}).alias("kept"),
    )


@query(
    "null_tokens",
    f"""WITH {RAW} SELECT o_orderkey, o_custkey, o_totalprice,
        nullif(o_orderpriority, '?') AS o_orderpriority, o_orderstatus FROM raw"""
)
def null_tokens(spark, sf_dir):
    return prep.null_tokens(raw_orders(spark, sf_dir))


@query(
    "drop_null_rows",
    f"""WITH {TYPED} SELECT o_custkey, o_totalprice, o_orderpriority, o_orderstatus
        FROM typed WHERE {COMPLETE} AND o_orderstatus IS NOT NULL"""
)
def drop_null_rows(spark, sf_dir):
    return prep.drop_null_rows(clean(raw_orders(spark, sf_dir), ORDERS)).drop(ORDERS.key)


@query(
    "filter_equal",
    """SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
       FROM lineitem WHERE l_returnflag = 'R'"""
)
def filter_equal(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
    )
    return prep.drop_first_column(prep.filter_equal(rows, "l_returnflag", "R"))


# --- encoding and preparation -----------------------------------------------


@query("one_hot_given", f"SELECT o_orderkey, {dummies('o_orderpriority', PRIORITIES)} FROM orders")
def one_hot_given(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return one_hot(orders, ORDERS.options)


@query(
    "one_hot_learned",
    f"""SELECT l_orderkey, l_linenumber, l_quantity,
        {dummies('l_returnflag', ['A', 'N', 'R'])}, {dummies('l_linestatus', ['F', 'O'])}
        FROM lineitem"""
)
def run_one_hot_learned(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    return one_hot_learned(rows, ["l_returnflag", "l_linestatus"], max_options=100)


@query(
    "one_hot_text",
    f"""SELECT o_orderkey, o_totalprice, {dummies('o_orderstatus', ['F', 'O', 'P'])},
        {dummies('o_orderpriority', PRIORITIES)} FROM orders"""
)
def run_one_hot_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return one_hot_text(
        orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"),
        max_options=100,
    )


@query(
    "one_hot_sparse",
    """WITH options AS (
          SELECT 'o_custkey' AS name, CAST(o_custkey AS VARCHAR) AS option FROM orders WHERE o_custkey IS NOT NULL
          UNION SELECT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY option) - 1 AS index FROM options),
        size AS (SELECT count(*) AS size, count(*) FILTER (WHERE name = 'o_custkey') AS first FROM options)
        SELECT o_orderkey, size::INT AS size, index::INT AS place FROM orders, size
          JOIN numbered ON name = 'o_custkey' WHERE option = CAST(o_custkey AS VARCHAR)
        UNION ALL SELECT o_orderkey, size::INT, (first + index)::INT FROM orders, size
          JOIN numbered ON name = 'o_orderpriority' WHERE option = o_orderpriority"""
)
def one_hot_sparse(spark, sf_dir):
    """A place for every customer and priority, without a column for each."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    vectors = encode_sparse(orders, ["o_custkey", "o_orderpriority"])
    parts = vectors.select("o_orderkey", F.unwrap_udt("features").alias("v"))
    return parts.select("o_orderkey", "v.size", F.explode("v.indices").alias("place"))


@query(
    "prepare_full",
    f"""WITH {TYPED} SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
        {dummies('o_orderpriority', PRIORITIES)}
        FROM typed WHERE {COMPLETE} AND o_orderstatus IS NOT NULL"""
)
def prepare_full(spark, sf_dir):
    return prepare(raw_orders(spark, sf_dir), ORDERS)


@query(
    "prepare_unlabelled",
    f"""WITH {TYPED} SELECT o_custkey, o_totalprice, {dummies('o_orderpriority', PRIORITIES)}
        FROM typed WHERE {COMPLETE}"""
)
def prepare_unlabelled(spark, sf_dir):
    return prepare(raw_orders(spark, sf_dir).drop(ORDERS.label), ORDERS, keep_key=False)


@query(
    "prepare_encode_first",
    f"""WITH {RAW}, encoded AS (
          SELECT o_orderkey,
                 CAST(trunc(TRY_CAST(o_custkey AS DOUBLE)) AS INTEGER) AS o_custkey,
                 TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice,
                 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus,
                 {dummies('o_orderpriority', [*PRIORITIES, '?'])}
          FROM raw)
        SELECT * FROM encoded WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL"""
)
def run_prepare_encode_first(spark, sf_dir):
    raw = raw_orders(spark, sf_dir)
    return prepare_encode_first(raw, replace(ORDERS, options=learn_options(raw, ORDERS.options, max_options=100)))


# --- profiling --------------------------------------------------------------


@query(
    "distinct_values",
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders GROUP BY 2
       UNION ALL
       SELECT 'o_orderpriority', o_orderpriority FROM orders GROUP BY 2
       UNION ALL
       SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders GROUP BY 2"""
)
def run_distinct_values(spark, sf_dir):
    return distinct_values(
        table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    )


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def run_row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "null_profile",
    f"""WITH {TYPED}
        SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS nulls FROM typed
        UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM typed
        UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM typed
        UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM typed
        UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM typed"""
)
def null_profile(spark, sf_dir):
    return null_counts(clean(raw_orders(spark, sf_dir), ORDERS))


@query(
    "column_summary",
    f"""WITH {TYPED}
        SELECT 0 AS position, 'o_orderkey' AS "column", 'string' AS type,
               count(o_orderkey) AS non_null FROM typed
        UNION ALL SELECT 1, 'o_custkey', 'int', count(o_custkey) FROM typed
        UNION ALL SELECT 2, 'o_totalprice', 'double', count(o_totalprice) FROM typed
        UNION ALL SELECT 3, 'o_orderpriority', 'string', count(o_orderpriority) FROM typed
        UNION ALL SELECT 4, 'o_orderstatus', 'int', count(o_orderstatus) FROM typed"""
)
def run_column_summary(spark, sf_dir):
    return column_summary(clean(raw_orders(spark, sf_dir), ORDERS))


@query("value_counts", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def run_value_counts(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "value_shares",
    """SELECT o_orderpriority AS value, count(*) AS n,
              round(count(*) / sum(count(*)) OVER (), 6) AS share
       FROM orders GROUP BY 1"""
)
def run_value_shares(spark, sf_dir):
    shares = value_shares(table(spark, sf_dir, "orders"), "o_orderpriority")
    return shares.withColumn("share", F.round("share", 6))


@query(
    "segment_shares",
    """SELECT l_returnflag AS segment, l_linestatus AS value, count(*) AS n,
              round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS share,
              CAST(round_even(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 0)
                   AS INTEGER) AS percent
       FROM lineitem GROUP BY 1, 2"""
)
def run_segment_shares(spark, sf_dir):
    shares = segment_shares(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    return shares.withColumn("share", F.round("share", 6))


def histogram_sql(source: str, column: str, group: str | None, bins: int = 30) -> str:
    key = f"{group} AS grp" if group else "0 AS grp"
    shown = "h.grp AS \"group\", " if group else ""
    return f"""WITH v AS (SELECT {key}, {column} AS x FROM {source}),
      lim AS (SELECT grp, min(x) AS lo, max(x) AS hi FROM v GROUP BY grp),
      rough AS (SELECT v.grp, x, lo, hi,
                       least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS b
                FROM v JOIN lim USING (grp)),
      placed AS (SELECT grp, b - (x < b * ((hi - lo) / {bins}) + lo)::INT
                        + (x >= (b + 1) * ((hi - lo) / {bins}) + lo AND b < {bins - 1})::INT AS bin
                 FROM rough),
      h AS (SELECT grp, lo, hi, i AS bin FROM lim, range({bins}) AS r(i))
      SELECT {shown}CAST(h.bin AS INTEGER) AS bin,
             round(h.bin * ((hi - lo) / {bins}) + lo, 6) AS "left",
             round(CASE WHEN h.bin = {bins - 1} THEN hi
                   ELSE (h.bin + 1) * ((hi - lo) / {bins}) + lo END, 6) AS "right",
             count(p.bin) AS n
      FROM h LEFT JOIN placed p ON p.grp = h.grp AND p.bin = h.bin
      GROUP BY h.grp, h.bin, lo, hi"""


def rounded_edges(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in ("left", "right")})


@query("histogram", histogram_sql("lineitem", "l_quantity", None))
def run_histogram(spark, sf_dir):
    return rounded_edges(histogram(table(spark, sf_dir, "lineitem"), "l_quantity"))


@query("histogram_by_group", histogram_sql("lineitem", "l_quantity", "l_returnflag"))
def histogram_by_group(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rounded_edges(histogram(rows, "l_quantity", by="l_returnflag"))


BOX = """b AS (SELECT event_type AS g, quantile_cont(value, 0.25) AS q1,
                     quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
              FROM events GROUP BY 1),
  f AS (SELECT g, q1, q2, q3, value AS x,
               value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM events JOIN b ON g = event_type)"""


@query(
    "box_stats",
    f"""WITH {BOX} SELECT g AS "group", count(*) AS n, round(q1, 6) AS q1,
          round(q2, 6) AS median, round(q3, 6) AS q3,
          round(least(min(x) FILTER (inside), q1), 6) AS whisker_low,
          round(greatest(max(x) FILTER (inside), q3), 6) AS whisker_high,
          count(*) FILTER (NOT inside) AS outliers
        FROM f GROUP BY g, q1, q2, q3"""
)
def run_box_stats(spark, sf_dir):
    stats = box_stats(table(spark, sf_dir, "events"), "value", "event_type")
    return stats.withColumns(
        {n: F.round(n, 6) for n in ("q1", "median", "q3", "whisker_low", "whisker_high")}
    )


@query(
    "box_outliers",
    f"""WITH {BOX} SELECT g AS "group", x AS value, count(*) AS n
        FROM f WHERE NOT inside GROUP BY g, x"""
)
def run_box_outliers(spark, sf_dir):
    return box_outliers(table(spark, sf_dir, "events"), "value", "event_type")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "label_correlation",
    """WITH e AS (SELECT l_quantity, l_discount, (l_returnflag = 'A')::INT AS a,
                         (l_returnflag = 'N')::INT AS n, (l_returnflag = 'R')::INT AS r,
                         (l_quantity > 25)::INT AS label FROM lineitem)
       SELECT 'l_quantity' AS "column", round(corr(l_quantity, label), 6) AS correlation FROM e
       UNION ALL SELECT 'l_discount', round(corr(l_discount, label), 6) FROM e
       UNION ALL SELECT 'l_returnflag_A', round(corr(a, label), 6) FROM e
       UNION ALL SELECT 'l_returnflag_N', round(corr(n, label), 6) FROM e
       UNION ALL SELECT 'l_returnflag_R', round(corr(r, label), 6) FROM e
       UNION ALL SELECT 'label', round(corr(label, label), 6) FROM e"""
)
def run_label_correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_discount", "l_returnflag", (F.col("l_quantity") > 25).cast("int").alias("label")
    )
    encoded = one_hot_text(rows, max_options=100)
    found = label_correlation(encoded, "label", prep.feature_columns(encoded, {"label"}))
    return found.withColumn("correlation", F.round("correlation", 6))


WIDE = [*NUMBERS, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "correlation_matrix",
    "WITH c AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS {a}__{b}" for a in NUMBERS for b in NUMBERS)
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round({a}__{b}, 6) AS correlation FROM c"
        for a in NUMBERS
        for b in NUMBERS
    )
)
def run_correlation_matrix(spark, sf_dir):
    found = correlation_matrix(table(spark, sf_dir, "lineitem"), NUMBERS)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    "correlation_wide",
    "WITH c AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS {a}__{b}" for a in WIDE for b in WIDE)
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round({a}__{b}, 6) AS correlation FROM c"
        for a in WIDE
        for b in WIDE
    )
)
def run_correlation_wide(spark, sf_dir):
    """By blocks of three columns, as tables of thousands of columns are done in larger ones."""
    found = wide_correlation(table(spark, sf_dir, "lineitem"), WIDE, block=3)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    "medians",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", round(median({name}), 6) AS median FROM lineitem"
        for name in NUMBERS
    )
)
def run_medians(spark, sf_dir):
    found = medians(table(spark, sf_dir, "lineitem"), NUMBERS)
    return found.withColumn("median", F.round("median", 6))


# --- first rows, splits, unions ---------------------------------------------


@query(
    "first_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice, o_orderkey LIMIT 100"""
)
def run_first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return first_rows(orders, ["o_totalprice", "o_orderkey"], 100)


def fraction_sql(seed: int, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({key} AS VARCHAR)" for key in keys]])
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0"


@query(
    "split_by_key",
    f"""SELECT o_orderkey, CASE WHEN {fraction_sql(7, 'o_orderkey')} < 0.8
                           THEN 'train' ELSE 'test' END AS part FROM orders"""
)
def run_split_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = split_by_key(orders, ["o_orderkey"], 0.8, seed=7)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query(
    "random_split",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {fraction_sql(7, 'o_orderkey', 'o_custkey')} < 0.8
                                      THEN 'train' ELSE 'test' END AS part FROM orders"""
)
def run_random_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    train, test = random_split(orders, 0.8, seed=7)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("union_by_name", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def run_union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    train, test = split_by_key(orders, ["o_orderkey"])
    return union_by_name(train, test.select("o_totalprice", "o_custkey", "o_orderkey"))


@query(
    "union_missing",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {fraction_sql(0, 'o_orderkey')} < 0.8
                                      THEN o_orderstatus END AS o_orderstatus FROM orders"""
)
def run_union_missing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    train, test = split_by_key(orders, ["o_orderkey"])
    return union_by_name(train, test.drop("o_orderstatus"), missing=True)


# --- files and messages -----------------------------------------------------


@query(
    "csv_round_trip",
    f"""WITH {RAW} SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus
        FROM raw"""
)
def run_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    raw = raw_orders(spark, sf_dir)
    write_csv(raw, path)
    return read_csv(spark, path, raw.columns)


@query("csv_typed", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal FROM customer")
def run_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return read_typed_csv(spark, path)


@query(
    "json_fields",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, user_id, event_type
       FROM events"""
)
def json_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = parse_json(F.col("props"), "k string")
    return events.select("event_id", parsed.alias("props"), "user_id", "event_type").select(
        "event_id", "props.*", "user_id", "event_type"
    )


def as_json(raw: DataFrame, columns: list[str] = MESSAGE_COLUMNS, number: str = "o_orderkey") -> DataFrame:
    """(data): each row as a JSON object; in every 101st the text is cut off."""
    text = F.to_json(F.struct(*columns))
    cut = F.col(number).cast("long") % 101 == 0
    return raw.select(
        F.when(cut, F.substring(text, 1, 10)).otherwise(text).cast("binary").alias("data")
    )


MESSAGES = f"""{RAW}, parsed AS (
  SELECT CASE WHEN CAST(o_orderkey AS BIGINT) % 101 <> 0 THEN o_orderkey END AS o_orderkey,
         CASE WHEN CAST(o_orderkey AS BIGINT) % 101 <> 0 THEN o_custkey END AS o_custkey,
         CASE WHEN CAST(o_orderkey AS BIGINT) % 101 <> 0 THEN o_totalprice END AS o_totalprice,
         CASE WHEN CAST(o_orderkey AS BIGINT) % 101 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM raw)"""


@query("json_messages", f"WITH {MESSAGES} SELECT * FROM parsed")
def json_messages(spark, sf_dir):
    return parse_messages(as_json(raw_orders(spark, sf_dir)), MESSAGE_COLUMNS)


def as_base64(messages: DataFrame) -> DataFrame:
    """(data): the messages in base64, between quotes."""
    return messages.select(F.concat(F.lit('"'), F.base64("data"), F.lit('"')).alias("data"))


@query("base64_messages", f"WITH {MESSAGES} SELECT * FROM parsed")
def base64_messages(spark, sf_dir):
    decoded = decode_messages(as_base64(as_json(raw_orders(spark, sf_dir))))
    return parse_messages(decoded, MESSAGE_COLUMNS)


# --- models -----------------------------------------------------------------


@query(
    "standardise",
    """WITH s AS (SELECT stddev_samp(l_quantity) AS q, stddev_samp(l_tax) AS t FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / q, 6) AS quantity,
              round(l_tax / t, 6) AS tax FROM lineitem, s"""
)
def standardise(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_tax"]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    scaler = StandardScaler(inputCol="features", outputCol="scaled").fit(assembled)
    scaled = F.col("scaled")
    return scaler.transform(assembled).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(vector_item(scaled, 0), 6).alias("quantity"),
        F.round(vector_item(scaled, 1), 6).alias("tax"),
    )


METRICS = """k AS (SELECT c, sum(n) AS n, sum(t) AS t, sum(p) AS p FROM (
       SELECT label AS c, count(*) AS n, sum((label = prediction)::INT) AS t, 0 AS p
       FROM scored GROUP BY 1
       UNION ALL SELECT prediction, 0, 0, count(*) FROM scored GROUP BY 1) GROUP BY c),
  m AS (SELECT sum(2.0 * n * t / (n + p)) / sum(n) AS f1, sum(t) / sum(n) AS accuracy,
               sum(CASE WHEN n > 0 THEN t ELSE 0 END) / sum(n) AS recall,
               sum(CASE WHEN p > 0 THEN 1.0 * n * t / p ELSE 0 END) / sum(n) AS "precision"
        FROM k)"""

METRIC_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, round(\"{name}\", 6) AS value FROM m"
    for name in ("f1", "accuracy", "recall", "precision")
)


@query(
    "metric_table",
    f"""WITH scored AS (SELECT (l_returnflag = 'R')::INT AS label,
                               (l_quantity > 25)::INT AS prediction FROM lineitem),
        {METRICS} {METRIC_ROWS}"""
)
def metric_table(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
    )
    return class_metrics(scored, "label").withColumn("value", F.round("value", 6))


@query(
    "auc",
    """WITH s AS (SELECT l_quantity AS x, sum((l_returnflag = 'R')::INT) AS pos,
                         sum((l_returnflag <> 'R')::INT) AS neg FROM lineitem GROUP BY 1),
       r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING), 0) AS below FROM s)
       SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM r"""
)
def auc(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), "l_quantity"
    )
    return roc_areas(scored, "label", "l_quantity").withColumn("roc_auc", F.round("roc_auc", 6))


# Share of label 1 differs by segment: the label is 1 above these quantities.
THRESHOLDS = {"A-F": 10, "A-O": 20, "N-F": 30, "N-O": 40, "R-F": 15, "R-O": 35}
SEGMENT_FEATURES = [f"segment_{name}" for name in THRESHOLDS]

LABELLED = (
    "l AS (SELECT *, l_returnflag || '-' || l_linestatus AS segment FROM lineitem), "
    "labelled AS (SELECT *, (l_quantity > CASE segment "
    + " ".join(f"WHEN '{name}' THEN {limit}" for name, limit in THRESHOLDS.items())
    + " END)::INT AS label FROM l)"
)

ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def labelled_lines(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lineitem with one-hot segments, from which the best guess of the label is known."""
    segment = F.concat_ws("-", "l_returnflag", "l_linestatus")
    label = F.col("l_quantity") > map_values(segment, THRESHOLDS)
    rows = table(spark, sf_dir, "lineitem").select(
        *keep, segment.alias("segment"), label.cast("int").alias("label")
    )
    return one_hot(
        spread(rows).withColumn("named", F.col("segment")), {"segment": list(THRESHOLDS)}
    ).withColumnRenamed("named", "segment")


@contextmanager
def kept(df: DataFrame):
    """The table, stored while models are fitted on it: every fit reads it many times."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fitted(spark, df: DataFrame, family: str, **params):
    """Fitted pipeline after a round trip through the model store."""
    with kept(df) as rows:
        model = fit_models(rows, {family: (family, params)}, SEGMENT_FEATURES, "label")[family]
    path = scratch_path(spark, f"model-{family}")
    save_model(model, path)
    loaded = load_model(path)
    remove_scratch(spark, path)
    return loaded


FOREST = {"numTrees": 20, "maxDepth": 8, "seed": 1}
BOOSTED = {"maxDepth": 3, "maxIter": 20, "stepSize": 0.1, "seed": 1}
PLAIN_LOGIT = {"regParam": 0.0, "maxIter": 100, "tol": 1e-9}
MARGINS = {"regParam": 0.01}

SEGMENT_MEANS = f"""WITH {LABELLED} SELECT segment, count(*) AS n,
    CAST(avg(label) > 0.5 AS DOUBLE) AS prediction,
    round(avg(label), 3) AS probability FROM labelled GROUP BY segment"""

SEGMENT_CLASSES = f"""WITH {LABELLED} SELECT segment, count(*) AS n,
    CAST(avg(label) > 0.5 AS DOUBLE) AS prediction
    FROM labelled GROUP BY segment"""


def by_segment(scored: DataFrame, probability: bool) -> DataFrame:
    found = {"n": F.count("*"), "prediction": F.max("prediction")}
    if probability:
        found["probability"] = F.round(F.max(vector_item(F.col("probability"))), 3)
    return scored.groupBy("segment").agg(*[c.alias(name) for name, c in found.items()])


@query("fit_lr", SEGMENT_MEANS)
def run_fit_lr(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    model = fitted(spark, rows, "log_reg", **PLAIN_LOGIT)
    return by_segment(model.transform(rows), probability=True)


@query("fit_rf", SEGMENT_CLASSES)
def fit_rf(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    model = fitted(spark, rows, "rf", **FOREST)
    return by_segment(model.transform(rows), probability=False)


@query("fit_gbdt", SEGMENT_CLASSES)
def fit_gbdt(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    model = fitted(spark, rows, "gbdt", **BOOSTED)
    return by_segment(model.transform(rows), probability=False)


@query("fit_svm", SEGMENT_CLASSES)
def fit_svm(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    model = fitted(spark, rows, "svm", **MARGINS)
    return by_segment(model.transform(rows), probability=False)


MODEL_AUC = """sums AS (SELECT share, sum(label) AS pos, sum(1 - label) AS neg FROM judged GROUP BY 1),
  below AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY share ROWS BETWEEN UNBOUNDED PRECEDING
                                      AND 1 PRECEDING), 0) AS lower FROM sums),
  area AS (SELECT sum(pos * (lower + neg / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc FROM below)"""


@query(
    "compare_models",
    f"""WITH {LABELLED}, judged AS (SELECT label, avg(label) OVER (PARTITION BY segment) AS share
                                    FROM labelled),
        scored AS (SELECT label, (share > 0.5)::INT AS prediction FROM judged),
        {METRICS}, {MODEL_AUC},
        every AS ({METRIC_ROWS} UNION ALL SELECT 'roc_auc', round(roc_auc, 6) FROM area)
        SELECT model, metric, value FROM every, (VALUES ('LR'), ('GBDT'), ('RF'), ('SVM')) AS names(model)
        WHERE NOT (model = 'SVM' AND metric = 'roc_auc')"""
)
def compare_models(spark, sf_dir):
    """All families. Only the sign of an SVM's margin is known, so its ROC is left to the tests."""
    rows = labelled_lines(spark, sf_dir)
    settings = {
        "LR": ("log_reg", PLAIN_LOGIT),
        "GBDT": ("gbdt", BOOSTED),
        "RF": ("rf", FOREST),
        "SVM": ("svm", MARGINS),
    }
    with kept(rows):
        models = fit_models(rows, settings, SEGMENT_FEATURES, "label")
        found = evaluate_models(models, rows, "label")
    known = ~((F.col("model") == "SVM") & (F.col("metric") == "roc_auc"))
    return found.where(known).withColumn("value", F.round("value", 6))


OPTIMUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "(intercept)"]


@query(
    "fit_lr_numeric",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{name}', 0.0::DOUBLE)" for name in OPTIMUM)
    + ") AS t(feature, gradient)"
)
def fit_lr_numeric(spark, sf_dir):
    """A ridge regression on numbers: at its optimum the loss has no slope in any weight."""
    names, strength = OPTIMUM[:-1], 0.05
    rows = spread(
        table(spark, sf_dir, "lineitem").select(
            *names, (F.col("l_returnflag") == "R").cast("int").alias("label")
        )
    )
    with kept(rows) as data:
        model = build_pipeline(
            "log_reg", names, "label", regParam=strength, tol=1e-12, maxIter=500
        ).fit(data)
        scored = model.transform(data)
        miss = vector_item(F.col("probability")) - F.col("label")
        slopes = [F.avg(miss * vector_item(F.col("features_scaled"), i)) for i in range(len(names))]
        found = scored.agg(*slopes, F.avg(miss)).first()
    # The features are scaled to a deviation of one, so each weight's penalty is its own.
    weights = [*map(float, model.stages[-1].coefficients), 0.0]
    rounded = [round(slope + strength * w, 5) + 0.0 for slope, w in zip(found, weights, strict=True)]
    return spark.createDataFrame(list(zip(OPTIMUM, rounded)), "feature string, gradient double")


# A setting that learns the segments and one that learns nothing, so that it is known what each
# trial scores.
GOOD_OR_BAD = {
    "log_reg": {
        "regParam": Choice([0.0, 1000.0]),
        "elasticNetParam": Choice([1.0]),
        "tol": Choice([1e-9]),
    },
}
# Fixed value: the trials that the reference draws from each family's ranges.
TRIALS, SEARCH_SEED = 40, 3
FEW_TRIALS = 4
LEARNS = [
    params["regParam"] == 0.0
    for params in draw_params(GOOD_OR_BAD["log_reg"], FEW_TRIALS, SEARCH_SEED)
]


def searched(spark, sf_dir, families: list[str], **options):
    """Forty settings of each family from its whole ranges, by halving, unless told otherwise."""
    rows = labelled_lines(spark, sf_dir, tuple(ROW_KEY))
    train, test = split_by_key(rows, ROW_KEY, 0.8)
    options = {"trials": TRIALS, "rungs": RUNGS, "parallelism": 8} | options
    return search_families(
        train, test, SEGMENT_FEATURES, "label", families, seed=SEARCH_SEED, keys=ROW_KEY, **options
    )


def judged_sql(fitted_on: str, scored_on: str, learns: bool) -> str:
    """(label, prediction) of the rows ``scored_on`` by the best guess from ``fitted_on``."""
    group = "segment" if learns else "0"
    return f"""SELECT label, prediction FROM labelled JOIN (
        SELECT {group} AS g, (avg(label) > 0.5)::INT AS prediction FROM labelled
        WHERE {fitted_on} GROUP BY 1) AS best ON {group} = g WHERE {scored_on}"""


IN_TRAIN = f"{fraction_sql(0, *ROW_KEY)} < 0.8"
IN_FIT = f"{fraction_sql(SEARCH_SEED, *ROW_KEY)} < 0.8"
VALIDATION = (f"{IN_TRAIN} AND {IN_FIT}", f"{IN_TRAIN} AND NOT ({IN_FIT})")
TEST = (IN_TRAIN, f"NOT ({IN_TRAIN})")


def search_sql(*families: str) -> str:
    names = ", ".join(f"('{name}')" for name in families)
    return f"""WITH {LABELLED}, scored AS ({judged_sql(*TEST, True)}), {METRICS}
      SELECT family, round(f1, 6) AS test FROM m, (VALUES {names}) AS names(family)"""


def test_scores(spark, selections) -> DataFrame:
    return selections_frame(spark, selections).select("family", F.round("test", 6).alias("test"))


@query("search_lr", search_sql("log_reg"))
def run_search_lr(spark, sf_dir):
    return test_scores(spark, searched(spark, sf_dir, ["log_reg"]))


@query("search_all", search_sql("rf", "log_reg", "gbdt", "svm"))
def search_all(spark, sf_dir):
    """Forty settings of every family from its whole ranges, each fitted and measured on all rows."""
    return test_scores(spark, searched(spark, sf_dir, ["rf", "log_reg", "gbdt", "svm"], rungs=(1.0,)))


@query(
    "search_trials",
    f"""WITH {LABELLED},
        good AS (WITH scored AS ({judged_sql(*VALIDATION, True)}), {METRICS} SELECT f1 FROM m),
        bad AS (WITH scored AS ({judged_sql(*VALIDATION, False)}), {METRICS} SELECT f1 FROM m),
        t(trial, learns) AS (VALUES {", ".join(f"({n}, {x})" for n, x in enumerate(LEARNS))})
        SELECT 'log_reg' AS family, trial, round(CASE WHEN learns THEN good.f1 ELSE bad.f1 END, 6) AS validation,
               trial = {LEARNS.index(True)} AS chosen
        FROM t, good, bad"""
)
def search_trials(spark, sf_dir):
    few = {"spaces": GOOD_OR_BAD, "trials": FEW_TRIALS, "rungs": (1.0,)}
    found = trials_frame(spark, searched(spark, sf_dir, ["log_reg"], **few))
    return found.select("family", "trial", F.round("validation", 6).alias("validation"), "chosen")


def drawn_sql(name: str) -> str:
    fraction = f"CAST(('0x' || substr(md5('{SEARCH_SEED}|' || trial || '|{name}'), 1, 8)) AS BIGINT) / 4294967296.0"
    return f"SELECT 'log_reg' AS family, trial, '{name}' AS name, round(0.3 - 0.3 * ({fraction}), 9) AS value FROM t"


@query(
    "search_draws",
    f"WITH t AS (SELECT unnest(range({TRIALS}))::INT AS trial) "
    + " UNION ALL ".join(map(drawn_sql, ["regParam", "elasticNetParam"])),
)
def search_draws(spark, sf_dir):
    """The settings that the trials of a search were fitted with."""
    found = trials_frame(spark, searched(spark, sf_dir, ["log_reg"]))
    setting = found.select("family", "trial", F.explode("params").alias("name", "value"))
    return setting.withColumn("value", F.round(F.col("value").cast("double"), 9))


@query(
    "search_rungs",
    f"WITH {LABELLED}, placed AS (SELECT {fraction_sql(SEARCH_SEED, *ROW_KEY)} AS f FROM labelled "
    f"WHERE {fraction_sql(0, *ROW_KEY)} < 0.8) "
    + " UNION ALL ".join(
        f"SELECT 'log_reg' AS family, {rung} AS rung, {trials}::BIGINT AS trials, "
        f"count(*) FILTER (WHERE f < {0.8 * share!r}) AS fitted_rows, "
        f"count(*) FILTER (WHERE f >= 0.8 AND f < {0.8 + (1 - 0.8) * share!r}) AS measured_rows FROM placed"
        for rung, (share, trials) in enumerate(zip(RUNGS, rung_sizes(TRIALS, RUNGS)), 1)
    ),
)
def search_rungs(spark, sf_dir):
    """How many trials and rows each rung of a search had."""
    return rungs_frame(spark, searched(spark, sf_dir, ["log_reg"])).drop("share")


@query(
    "search_smallest",
    f"""WITH {LABELLED},
        v AS (WITH scored AS ({judged_sql(*VALIDATION, True)}) SELECT avg((label <> prediction)::INT) AS x FROM scored),
        t AS (WITH scored AS ({judged_sql(*TEST, True)}) SELECT avg((label <> prediction)::INT) AS x FROM scored)
        SELECT 'log_reg' AS family, round(v.x, 6) AS validation, round(t.x, 6) AS test FROM v, t"""
)
def search_smallest(spark, sf_dir):
    """The search by the share of wrong classes, of which the smallest is best."""
    found = searched(spark, sf_dir, ["log_reg"], metric="hammingLoss", greater_is_better=False)
    figures = {name: F.round(name, 6) for name in ("validation", "test")}
    return selections_frame(spark, found).drop("params").withColumns(figures)


# --- scoring ----------------------------------------------------------------

# Lineitem in raw form: key, segment, quantity and label as text, with faults planted by order.
LINES = TableSpec(
    key="line",
    label="label",
    types={"quantity": "double"},
    options={"segment": list(THRESHOLDS)},
    label_values={"1": 1, "0": 0},
)
LINE_COLUMNS = ["line", "segment", "quantity"]


def dirty_lines(rows: DataFrame) -> DataFrame:
    order = F.col("l_orderkey")
    segment = F.concat_ws("-", "l_returnflag", "l_linestatus")
    label = (F.col("l_quantity") > map_values(segment, THRESHOLDS)).cast("int").cast("string")
    return rows.select(
        F.concat_ws("-", *ROW_KEY).alias("line"),
        F.when(order % 97 == 0, "?").otherwise(segment).alias("segment"),
        F.when(order % 89 == 0, " ").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        label.alias("label"),
        order.alias("order"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_lines(table(spark, sf_dir, "lineitem"))


#: Where each table's scoring model was saved, for the queries that share it.
_SAVED: dict[tuple[str, str], str] = {}


def segment_regression(lines: DataFrame, params: dict):
    """Logistic regression on the segments; equal lines are read once and counted, if many are equal."""
    pipeline = build_pipeline("log_reg", SEGMENT_FEATURES, "label", **params)
    few = fold(lines, [*SEGMENT_FEATURES, "label"])
    with kept(spread(lines) if few is None else few) as rows:
        return fit(pipeline, rows)


def segment_model(spark: SparkSession, sf_dir: str):
    """Logistic regression on the segments of the usable raw lines, fitted once, loaded each time."""
    place = spark.sparkContext.applicationId, sf_dir
    if place not in _SAVED:
        model = segment_regression(prepare(raw_lines(spark, sf_dir).drop("order"), LINES), PLAIN_LOGIT)
        path = scratch_path(spark, "scoring-model")
        save_model(model, path)
        _SAVED[place] = path
    return load_model(_SAVED[place])


def scores_sql(cut: bool) -> str:
    """Each usable line with the class that is more frequent in its segment."""
    good = "l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0"
    key = " || '-' || ".join(f"CAST({name} AS VARCHAR)" for name in ROW_KEY)
    return f"""WITH {LABELLED}, best AS (SELECT segment, CAST(avg(label) > 0.5 AS DOUBLE) AS prediction
                                         FROM labelled WHERE {good} GROUP BY 1)
      SELECT {key} AS line, prediction FROM labelled JOIN best USING (segment)
      WHERE {good} {"AND l_orderkey % 101 <> 0" if cut else ""}"""


def written_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("line string, prediction double").json(path).select("line", "prediction")


@query("score_keyed", scores_sql(cut=False))
def score_keyed(spark, sf_dir):
    path = scratch_path(spark, "scores")
    raw = raw_lines(spark, sf_dir).select(*LINE_COLUMNS)
    write_scores(score(raw, segment_model(spark, sf_dir), LINES), path)
    return written_scores(spark, path)


@query(
    "score_rejects",
    f"""WITH {RAW} SELECT * FROM raw WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NULL
        OR o_orderpriority = '?' OR o_orderstatus NOT IN ('F', 'O')"""
)
def score_rejects(spark, sf_dir):
    return rejects(raw_orders(spark, sf_dir), ORDERS)


@query("score_events", scores_sql(cut=True))
def run_score_events(spark, sf_dir):
    path = scratch_path(spark, "event-scores")
    events = as_base64(as_json(raw_lines(spark, sf_dir), LINE_COLUMNS, "order"))
    score_events(events, LINE_COLUMNS, segment_model(spark, sf_dir), LINES, path)
    return written_scores(spark, path)


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "lineitem").schema
    # A pattern, because a streaming file source refuses the name of a single file.
    path = f"{sf_dir}/lineitem.parque[t]"
    lines = message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, schema, path)
    return as_json(dirty_lines(lines), LINE_COLUMNS, "order")


def streamed(spark, sf_dir, start, once: bool) -> DataFrame:
    path, checkpoint = scratch_path(spark, "stream-scores"), scratch_path(spark, "stream-state")
    running = start(
        line_stream(spark, sf_dir),
        LINE_COLUMNS,
        segment_model(spark, sf_dir),
        LINES,
        path,
        checkpoint,
        once=once,
    )
    if once:
        running.awaitTermination()
    else:
        running.processAllAvailable()
        running.stop()
    remove_scratch(spark, checkpoint)
    return written_scores(spark, path)


@query("stream_score", scores_sql(cut=True))
def stream_score(spark, sf_dir):
    return streamed(spark, sf_dir, start_scoring, once=True)


@query("stream_score_batches", scores_sql(cut=True))
def stream_score_batches(spark, sf_dir):
    """Runs on until it is stopped, when all there is has been scored."""
    return streamed(spark, sf_dir, start_batch_scoring, once=False)


def line_log(spark, sf_dir, log: str, wanted: str = "true") -> int:
    """Add the raw lines that are ``wanted`` to a message log, in the order of their key; its end."""
    lines = raw_lines(spark, sf_dir).where(wanted)
    messages = lines.select("line", F.to_json(F.struct(*LINE_COLUMNS)).alias("value"))
    return append_messages(messages, log, ["line"])


START = 1000


def numbered_sql(condition: str, version: str = "") -> str:
    key = " || '-' || ".join(f"CAST({name} AS VARCHAR)" for name in ROW_KEY)
    return f"""WITH {LABELLED}, n AS (SELECT *, {key} AS line, row_number() OVER (ORDER BY {key}) - 1 AS number FROM labelled),
        good AS (SELECT * FROM n WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0),
        best AS (SELECT segment, CAST(avg(label) > 0.5 AS DOUBLE) AS prediction FROM good GROUP BY 1)
      SELECT line, prediction{version} FROM good JOIN best USING (segment) WHERE {condition}"""


@query("stream_from_offset", numbered_sql(f"number >= {START}"))
def stream_from_offset(spark, sf_dir):
    """A log of all raw lines, scored from a given message on."""
    log, path, checkpoint = (scratch_path(spark, name) for name in ("log", "stream-scores", "stream-state"))
    line_log(spark, sf_dir, log)
    messages = message_stream(spark, "message_log", {"startingOffset": str(START)}, path=log)
    model = segment_model(spark, sf_dir)
    start_scoring(
        messages, LINE_COLUMNS, model, LINES, path, checkpoint, once=True, payload="value"
    ).awaitTermination()
    remove_scratch(spark, log)
    remove_scratch(spark, checkpoint)
    return written_scores(spark, path)


@query(
    "stream_versions",
    f"""SELECT line, CASE WHEN model_version = 1 THEN prediction ELSE usual END AS prediction, model_version
        FROM ({numbered_sql("true", ", CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS model_version")}),
          (WITH {LABELLED} SELECT CAST(avg(label) > 0.5 AS DOUBLE) AS usual FROM labelled
           WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0)"""
)
def stream_versions(spark, sf_dir):
    """A running stream takes up the next model when it is complete: lines of odd orders come after."""
    log, store, path, checkpoint = (
        scratch_path(spark, name) for name in ("log", "store", "stream-scores", "stream-state")
    )
    publish_model(spark, segment_model(spark, sf_dir), store)
    line_log(spark, sf_dir, log, "order % 2 = 0")
    running = start_versioned_scoring(
        message_stream(spark, "message_log", {}, path=log), LINE_COLUMNS, store, LINES, path, checkpoint, payload="value"
    )
    running.processAllAvailable()
    # A model that knows no segment, and one that is never finished.
    constant = {"regParam": 1000.0, "elasticNetParam": 1.0}
    publish_model(spark, segment_regression(prepare(raw_lines(spark, sf_dir).drop("order"), LINES), constant), store)
    segment_model(spark, sf_dir).write().save(f"{store}/version=000003/model")
    line_log(spark, sf_dir, log, "order % 2 = 1")
    running.processAllAvailable()
    running.stop()
    for name in (log, store, checkpoint):
        remove_scratch(spark, name)
    return spark.read.schema("line string, prediction double, model_version long").json(path).select(
        "line", "prediction", "model_version"
    )


# --- probabilities and attribution ------------------------------------------


@query(
    "class_probability",
    f"""WITH {LABELLED} SELECT l_orderkey, l_linenumber, l_partkey,
          round(avg(label) OVER (PARTITION BY segment), 3) AS score FROM labelled"""
)
def run_class_probability(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir, tuple(ROW_KEY))
    scored = fitted(spark, rows, "log_reg", **PLAIN_LOGIT).transform(rows)
    score = F.round(class_probability(scored), 3).alias("score")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", score)


@query(
    "margin_probability",
    f"""WITH {LABELLED} SELECT segment, avg(label) > 0.5 AS likely, 0.0::DOUBLE AS difference
        FROM labelled GROUP BY segment"""
)
def margin_probability(spark, sf_dir):
    """An SVM has no probability: the sigmoid of its margin, above one half for class 1."""
    rows = labelled_lines(spark, sf_dir)
    model = fitted(spark, rows, "svm", **MARGINS)
    scored = probability_scorer(model)(rows)
    found = scored.groupBy("segment").agg(F.max("score").alias("score"), F.min("score").alias("least"))
    margins = model.transform(rows).groupBy("segment").agg(
        F.max(vector_item(F.col("rawPrediction"))).alias("margin")
    )
    expected = sigmoid(F.col("margin"))
    return found.join(margins, "segment").select(
        "segment",
        (F.col("score") > 0.5).alias("likely"),
        (F.round(F.greatest(F.col("score"), F.col("least")) - expected, 9) + 0.0).alias("difference"),
    )


WEIGHTS = {
    "o_custkey": 0.001,
    "o_totalprice": 0.00001,
    "o_orderpriority_1-URGENT": 1.5,
    "o_orderpriority_2-HIGH": 0.7,
    "o_orderpriority_3-MEDIUM": 0.1,
    "o_orderpriority_4-NOT SPECIFIED": 0.0,
    "o_orderpriority_5-LOW": -2.0,
}

LINEAR_EFFECTS = f"""WITH {TYPED}, ready AS (
    SELECT o_orderkey, o_custkey, o_totalprice, {dummies('o_orderpriority', PRIORITIES)}
    FROM typed WHERE {COMPLETE}),
  base AS (SELECT * FROM ready ORDER BY md5('1|' || o_orderkey), o_orderkey LIMIT 10),
  effects AS ({" UNION ALL ".join(
      f'''SELECT o_orderkey, '{name}' AS feature, CAST("{name}" AS DOUBLE) AS value,
          {weight!r} * ("{name}" - (SELECT avg("{name}") FROM base)) AS attribution FROM ready'''
      for name, weight in WEIGHTS.items())})"""


def linear_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("score", linear(df, WEIGHTS))


def linear(df: DataFrame, weights: dict[str, float]):
    terms = [F.col(f"`{name}`") * weight for name, weight in weights.items()]
    return sum(terms[1:], terms[0])


def linear_effects(spark, sf_dir) -> DataFrame:
    rows = prepare(spread(raw_orders(spark, sf_dir).drop(ORDERS.label)), ORDERS)
    background = sample_background(rows, ORDERS.features, [ORDERS.key], 10, seed=1)
    return attributions(rows, background, [ORDERS.key], linear_scorer)


@query(
    "attribution_linear",
    f"""{LINEAR_EFFECTS} SELECT o_orderkey, feature, value, coalesce(nullif(round(attribution, 8), 0), 0) AS attribution
        FROM effects"""
)
def attribution_linear(spark, sf_dir):
    # The numbers have eight decimals, so nothing is rounded at a tie.
    found = linear_effects(spark, sf_dir)
    return found.withColumn("attribution", F.round("attribution", 8) + 0.0)


@query(
    "attribution_rank",
    f"""{LINEAR_EFFECTS} SELECT feature, round(avg(abs(attribution)), 6) AS importance
        FROM effects GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 5"""
)
def attribution_rank(spark, sf_dir):
    found = importance(linear_effects(spark, sf_dir), top=5)
    return found.withColumn("importance", F.round("importance", 6))


def curve(price: str, customer: str) -> str:
    return f"1 / (1 + exp(-({price} * 0.00001 - {customer} * 0.002)))"


@query(
    "attribution_curved",
    f"""WITH base AS (SELECT o_totalprice AS bp, o_custkey AS bc FROM orders
                      ORDER BY md5('2|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 4),
        points AS (SELECT o_orderkey, o_totalprice AS p, o_custkey AS c,
                          {curve('o_totalprice', 'o_custkey')} AS pc, {curve('o_totalprice', 'bc')} AS pb,
                          {curve('bp', 'o_custkey')} AS bc, {curve('bp', 'bc')} AS bb
                   FROM orders, base)
        SELECT o_orderkey, 'o_totalprice' AS feature, p AS value,
               coalesce(nullif(round(avg((pc - bc + pb - bb) / 2), 6), 0), 0) AS attribution FROM points GROUP BY 1, p
        UNION ALL
        SELECT o_orderkey, 'o_custkey', CAST(c AS DOUBLE),
               coalesce(nullif(round(avg((pc - pb + bc - bb) / 2), 6), 0), 0) FROM points GROUP BY 1, c"""
)
def attribution_curved(spark, sf_dir):
    def scorer(df: DataFrame) -> DataFrame:
        margin = F.col("o_totalprice") * 0.00001 - F.col("o_custkey") * 0.002
        return df.withColumn("score", sigmoid(margin))

    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey"))
    background = sample_background(orders, ["o_custkey", "o_totalprice"], ["o_orderkey"], 4, seed=2)
    found = attributions(orders, background, ["o_orderkey"], scorer)
    return found.withColumn("attribution", F.round("attribution", 6) + 0.0)


PRODUCT = ["balance", "number", "nation"]


@query(
    "attribution_error",
    """WITH c AS (SELECT c_custkey AS key, c_acctbal::DOUBLE / 1000 AS balance, (c_custkey % 97)::DOUBLE / 10 AS number,
            c_nationkey::DOUBLE AS nation FROM customer),
        base AS (SELECT balance AS a, number AS b, nation AS c FROM c ORDER BY md5('7|' || key), key LIMIT 10),
        effects AS ("""
    + " UNION ALL ".join(
        f"SELECT key, '{f}' AS feature, {f} AS value, avg(0.7182818284 * ({f} - {m}) "
        f"* ({g} * {h} / 3 + ({g} * {q} + {p} * {h}) / 6 + {p} * {q} / 3)) AS exact FROM c, base GROUP BY key, {f}"
        for f, m, g, p, h, q in [
            ("balance", "a", "number", "b", "nation", "c"),
            ("number", "b", "balance", "a", "nation", "c"),
            ("nation", "c", "balance", "a", "number", "b"),
        ]
    )
    + """) SELECT key, feature, value, coalesce(nullif(round(exact, 6), 0), 0) AS exact, true AS within, true AS precise
        FROM effects"""
)
def attribution_error(spark, sf_dir):
    """Sampled attributions of a product of three numbers: the stated errors hold and are small."""
    customers = spread(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("key"),
            (F.col("c_acctbal").cast("double") / 1000).alias("balance"),
            ((F.col("c_custkey") % 97).cast("double") / 10).alias("number"),
            F.col("c_nationkey").cast("double").alias("nation"),
        )
    )

    def scorer(df: DataFrame) -> DataFrame:
        product = F.col("balance") * F.col("number") * F.col("nation")
        return df.withColumn("score", product * 0.7182818284)

    background = sample_background(customers, PRODUCT, ["key"], 10, seed=7)
    tolerance = 6.0
    found = attributions_within(customers, background, ["key"], scorer, tolerance, orders=16)
    exact = by_subsets(customers, "key", background, scorer)
    off = F.abs(F.col("attribution") - F.col("exact"))
    return found.join(exact, ["key", "feature"]).select(
        "key", "feature", "value", (F.round("exact", 6) + 0.0).alias("exact"),
        (off <= 6 * F.col("error") + 1e-9).alias("within"), (F.col("error") <= tolerance).alias("precise"),
    )


def usable_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spread(raw_orders(spark, sf_dir)), ORDERS)


# All priorities but the last: the weights of a plain logistic regression are then known.
PRIORITY_FEATURES = [f"o_orderpriority_{name}" for name in PRIORITIES[:-1]]


@query(
    "attribution_model",
    f"""WITH {TYPED}, ready AS (
          SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS label FROM typed
          WHERE {COMPLETE} AND o_orderstatus IS NOT NULL),
        rates AS (SELECT p, ln(avg(label) / (1 - avg(label))) AS logit FROM ready GROUP BY p),
        zero AS (SELECT logit AS b FROM rates WHERE p = '{PRIORITIES[-1]}'),
        base AS (SELECT p FROM ready ORDER BY md5('3|' || o_orderkey), o_orderkey LIMIT 6),
        pairs AS (
          SELECT own.p AS own, base.p AS other, own.logit AS s, other.logit AS t, b
          FROM rates own, base JOIN rates other ON other.p = base.p, zero),
        points AS (
          SELECT own, other, 1 / (1 + exp(-s)) AS fs, 1 / (1 + exp(-t)) AS ft,
                 1 / (1 + exp(-b)) AS f0, 1 / (1 + exp(-(s + t - b))) AS fst FROM pairs),
        effects AS (
          SELECT own, feature, avg(CASE
            WHEN own = other OR feature NOT IN (own, other) THEN 0
            WHEN feature = own THEN ((fst - ft) + (fs - f0)) / 2
            ELSE ((f0 - ft) + (fs - fst)) / 2 END) AS attribution
          FROM points, (VALUES {", ".join(f"('{name}')" for name in PRIORITIES[:-1])}) AS f(feature)
          GROUP BY ALL)
        SELECT o_orderkey, 'o_orderpriority_' || feature AS feature, CAST(p = feature AS INT)::DOUBLE AS value,
               coalesce(nullif(round(attribution, 5), 0), 0) AS attribution
        FROM ready JOIN effects ON own = p"""
)
def attribution_model(spark, sf_dir):
    rows = usable_orders(spark, sf_dir)
    with kept(rows):
        model = build_pipeline(
            "log_reg", PRIORITY_FEATURES, ORDERS.label, regParam=0.0, maxIter=200, tol=1e-12
        ).fit(rows)
    background = sample_background(rows, PRIORITY_FEATURES, [ORDERS.key], 6, seed=3)
    found = explain_model(model, rows, background, [ORDERS.key])
    return found.withColumn("attribution", F.round("attribution", 5) + 0.0)


def sum_errors(rows: DataFrame, scorers: dict, background, found: DataFrame) -> DataFrame:
    """(key, model, difference): each row's attributions less (score - the background's mean)."""
    fields = ", ".join(f"`{name}` double" for name in background.features)
    base = rows.sparkSession.createDataFrame([tuple(row) for row in background.rows], fields)
    figures = []
    for at, (name, add_score) in enumerate(scorers.items()):
        mean = add_score(base).agg(F.avg("score")).first()[0]
        difference = F.round(F.col(f"_total{at}") - (F.col(f"_score{at}") - mean), 6) + 0.0
        figures.append(F.struct(F.lit(name).alias("model"), difference.alias("difference")))
        rows = add_score(rows).withColumnRenamed("score", f"_score{at}")
    # All models of a row together, so that each row is sent once on either side.
    totals = found.groupBy(ORDERS.key).agg(
        *[F.sum(F.when(F.col("model") == name, F.col("attribution"))).alias(f"_total{at}") for at, name in enumerate(scorers)]
    )
    wide = rows.select(ORDERS.key, *[f"_score{at}" for at in range(len(scorers))])
    return totals.join(wide, ORDERS.key).select(ORDERS.key, F.inline(F.array(*figures)))


def sum_sql(*models: str) -> str:
    names = ", ".join(f"('{name}')" for name in models)
    return f"""WITH {TYPED} SELECT o_orderkey, model, 0.0::DOUBLE AS difference
        FROM typed, (VALUES {names}) AS names(model)
        WHERE {COMPLETE} AND o_orderstatus IS NOT NULL"""


@query("attribution_sum", sum_sql("LR"))
def attribution_sum(spark, sf_dir):
    """A row's attributions add up to its score less the background's mean score."""
    rows = usable_orders(spark, sf_dir)
    features = model_features(rows, ORDERS)
    with kept(rows):
        model = build_pipeline("log_reg", features, ORDERS.label, regParam=0.01).fit(rows)
    background = sample_background(rows, features, [ORDERS.key], 4, seed=4)
    found = explain_model(model, rows, background, [ORDERS.key]).withColumn("model", F.lit("LR"))
    return sum_errors(rows, {"LR": probability_scorer(model)}, background, found)


@query("attribution_of_models", sum_sql("RF", "SVM", "GBDT", "LR"))
def attribution_of_models(spark, sf_dir):
    """Trees by their leaves, the others by walks, all against the same 20 rows; the sums must be right."""
    rows = usable_orders(spark, sf_dir)
    features = model_features(rows, ORDERS)
    settings = {
        "RF": ("rf", FOREST),
        "SVM": ("svm", MARGINS),
        "GBDT": ("gbdt", BOOSTED),
        "LR": ("log_reg", {"regParam": 0.01}),
    }
    with kept(rows):
        models = fit_models(rows, settings, features, ORDERS.label)
    background = sample_background(rows, features, [ORDERS.key], 20, seed=5)
    found = explain_models(models, rows, background, [ORDERS.key], boosted="margin")
    return sum_errors(rows, {name: explained_scorer(model) for name, model in models.items()}, background, found)


def by_subsets(rows: DataFrame, key: str, background, scorer) -> DataFrame:
    """(key, feature, exact): Shapley values by scoring every subset of the features, for a few rows."""
    n = len(background.features)
    own = F.array(*[F.col(f"`{name}`").cast("double") for name in background.features])
    bases = F.array(*[F.array(*map(F.lit, row)) for row in background.rows])
    mixed = rows.select(key, own.alias("_own"), F.explode(bases).alias("_base")).withColumn(
        "_in", F.explode(F.sequence(F.lit(0), F.lit(2**n - 1)))
    )
    inside = lambda i: F.col("_in").bitwiseAND(1 << i) > 0
    mixed = mixed.select(
        key,
        "_in",
        *[
            F.when(inside(i), F.get("_own", F.lit(i))).otherwise(F.get("_base", F.lit(i))).alias(name)
            for i, name in enumerate(background.features)
        ],
    )
    size = F.bit_count("_in")
    share = lambda k: F.factorial(k) * F.factorial(n - 1 - k) / math.factorial(n)
    parts = [
        F.struct(
            F.lit(name).alias("feature"),
            F.when(inside(i), share(size - 1)).otherwise(-share(size)).alias("share"),
        )
        for i, name in enumerate(background.features)
    ]
    scored = scorer(mixed).select(key, "score", F.inline(F.array(*parts)))
    total = F.sum(F.col("score") * F.col("share")) / len(background.rows)
    return scored.groupBy(key, "feature").agg(total.alias("exact"))


@query(
    "attribution_trees",
    f"""WITH {LABELLED} SELECT model, segment, feature, count(*) AS n, 0.0::DOUBLE AS difference
        FROM labelled, (VALUES ('RF'), ('GBDT')) AS m(model),
          (VALUES {", ".join(f"('{name}')" for name in SEGMENT_FEATURES)}) AS f(feature)
        GROUP BY ALL"""
)
def attribution_trees(spark, sf_dir):
    """Attributions by leaves of every line, against those by all subsets of the features."""
    rows = labelled_lines(spark, sf_dir, tuple(ROW_KEY))
    with kept(rows):
        models = fit_models(rows, {"RF": ("rf", FOREST), "GBDT": ("gbdt", BOOSTED)}, SEGMENT_FEATURES, "label")
        background = sample_background(rows, SEGMENT_FEATURES, ROW_KEY, 20, seed=6)
        patterns = settle(rows.select("segment", *SEGMENT_FEATURES).distinct())
    exact = [
        by_subsets(patterns, "segment", background, explained_scorer(model)).withColumn("model", F.lit(name))
        for name, model in models.items()
    ]
    exact = settle(exact[0].unionByName(exact[1]))
    found = tree_attributions(rows, background, ["segment"], models)
    limits = found.groupBy("model", "segment", "feature").agg(
        F.count("*").alias("n"), F.min("attribution").alias("least"), F.max("attribution").alias("most")
    )
    off = F.greatest(F.abs(F.col("least") - F.col("exact")), F.abs(F.col("most") - F.col("exact")))
    return limits.join(exact, ["model", "segment", "feature"]).select(
        "model", "segment", "feature", "n", (F.round(off, 9) + 0.0).alias("difference")
    )
