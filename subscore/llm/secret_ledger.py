"""Secrets in texts, by an incremental ledger of content-addressed blobs.

A ledger is a folder with one subfolder per run: ``versions`` (which path held which blob),
``blobs`` (which rules have read a blob, and what they found). Every blob is the SHA-256 of
a text. A run reads a text only for those rules, in their present version, that have not read
its blob yet; findings are joined back to every path that ever held the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subscore.session import scratch_path, shared_root

SPANS = "array<struct<start:int,place:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and without overlap, whose ``group`` is long enough.

    A match that is too short is passed over as a whole: the next one begins behind it.
    Patterns are regular expressions that match at least one character.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        """Name of the rule as it is now: another pattern or length makes another version."""
        told = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}@{sha256(told.encode()).hexdigest()[:16]}"


def either_case(word: str) -> str:
    """Pattern of a word with its ASCII letters in either case, and of no other letters."""
    return "".join(f"[{x.upper()}{x.lower()}]" if x.isascii() and x.isalpha() else x for x in word)


#: The base kinds, in their order.
BASE = [
    Rule(
        "assign",
        "(" + "|".join(map(either_case, ["password", "passwd", "secret", "token", "api_?key"])) + ")"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    # Shorter runs need not be matched to be passed over: a run is matched whole or not at all.
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
]

#: Kinds of the library's own: tokens whose issuers gave them a form that tells them.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z0-9\x20]{0,40}PRIVATE KEY-----", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 30),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}", 0, 39),
    Rule("basic_auth", r"[a-z]{2,10}://[^\x00-\x20:/@]{1,64}:([^\x00-\x20:/@]{3,128})@", 1, 3),
]

RULES = [*BASE, *MORE]


def _committed(spark: SparkSession, ledger: str, table: str) -> DataFrame | None:
    """What complete runs have written to a table of the ledger; None if there is nothing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return None
    runs = [x.getPath().toString() for x in system.listStatus(root) if x.getPath().getName().startswith("run=")]
    # A run whose blobs are not complete never happened: its texts are read again by the next.
    done = [run for run in runs if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{run}/blobs/_SUCCESS"))]
    return spark.read.parquet(*(f"{run}/{table}" for run in sorted(done))) if done else None


def _matches(text: Column, rule: Rule) -> Column:
    """(gap, size, kept) of every match: characters since the one before, its own, long enough."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("size"),
        F.transform(
            F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda value: F.length(value) >= rule.least
        ).alias("kept"),
    )
    # The last gap is followed by no match.
    return F.when(F.regexp_like(text, pattern), F.filter(found, lambda match: match["size"].isNotNull()))


def scan_blobs(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, spans) of the rows of ``texts`` (blob, versions, text) that hold a secret.

    Only the rules whose version is among ``versions`` read a text. Places are counted in
    characters by a running sum over the matches of a blob, not over those of the corpus.
    """

    def placed(place: int, rule: Rule) -> Column:
        matches = F.when(F.array_contains("versions", rule.version), _matches(F.col("text"), rule))
        columns = ("gap", "size", "kept")
        return F.transform(
            matches, lambda match, at: F.struct(F.lit(place).alias("place"), at.alias("at"), *(match[x].alias(x) for x in columns))
        )

    per_rule = [placed(place, rule) for place, rule in enumerate(rules)]
    found = F.flatten(F.array_compact(F.array(*per_rule)))
    # Rows that repeat a blob give its matches again.
    found = texts.select("blob", F.explode(found).alias("match")).select("blob", "match.*").distinct()
    so_far = Window.partitionBy("blob", "place").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = found.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    span = F.struct(
        (F.col("end") - F.col("size")).alias("start"), "place", kinds[F.col("place")].alias("kind"), "end"
    )
    return ends.where("kept").groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scan_versions(
    versions: DataFrame,
    ledger: str,
    rules: Sequence[Rule] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> str:
    """Add ``versions`` (path, text) to a ledger and scan what it has not scanned; the run's folder.

    Each row is one version of a file: the same path may come with several texts, in one run or
    in later ones. Distinct blobs that some rule, in its present version, has not read yet are
    scanned once, whatever number of paths hold them; a rule that is new or has changed reads
    the known blobs that this run brings again, the others do not. A run that ended before its
    end left nothing: its folder is not looked at.

    A null text is the empty one. Paths may be null and may repeat, with the same text or
    others; an empty table adds an empty run. Texts of any length are read whole, one text in
    one task. Other columns are not looked at, whatever their names. Only built-in column
    functions are used.

    Addresses are dealt without the texts; then each unread blob fetches its text from one of
    its rows, keyed by blob and path, so that a text which a third of all rows hold is one row.
    """
    spark = versions.sparkSession
    shared_root(spark)
    run = f"{ledger.rstrip('/')}/run={scratch_path(spark, 'run').rpartition('-')[2]}"
    own_text = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = versions.select(F.col(f"`{path}`").alias("path"), own_text.alias("text"))
    source = source.withColumn("blob", F.unhex(F.sha2("text", 256)))
    seen = _committed(spark, ledger, "blobs")
    source.select("path", "blob").write.parquet(f"{run}/versions")
    held = spark.read.parquet(f"{run}/versions").groupBy("blob").agg(F.min(F.struct("path")).alias("from"))
    wanted = F.array(*(F.lit(rule.version) for rule in rules))
    if seen is not None:
        read = seen.select("blob", F.explode("versions").alias("version"))
        read = read.groupBy("blob").agg(F.collect_set("version").alias("read"))
        wanted = F.array_except(wanted, F.coalesce("read", F.array().cast("array<string>")))
        held = held.join(read, "blob", "left")
    unread = held.select(F.col("blob").alias("~blob"), "from", wanted.alias("versions")).where(F.size("versions") > 0)
    # Written down: Spark then knows whether it is small enough to be sent to the texts.
    unread.write.parquet(f"{run}/unread")
    unread = spark.read.parquet(f"{run}/unread")
    texts = source.join(
        unread, (F.col("blob") == F.col("~blob")) & F.col("path").eqNullSafe(F.col("from.path"))
    ).select("blob", "versions", "text")
    found = scan_blobs(texts, rules).withColumnRenamed("blob", "~found")
    (
        unread.join(found, F.col("~blob") == F.col("~found"), "left")
        .select(F.col("~blob").alias("blob"), "versions", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
        .write.parquet(f"{run}/blobs")
    )
    return run


def findings(
    spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES, run: str | None = None
) -> DataFrame:
    """(path, blob, spans) for every version in a ledger, or for those that one run brought.

    ``spans`` are (start, place, kind, end) of what ``rules``, in their present version, found,
    by start, then by the place of the rule among ``rules``; characters are counted in code
    points and ``end`` is exclusive. A version comes out as often as it was brought. Versions
    of rules that have not read a blob find nothing in it. A ledger without runs gives no rows.
    """
    blobs = _committed(spark, ledger, "blobs")
    if blobs is None:
        raise FileNotFoundError(f"{ledger} holds no complete run")
    versions = spark.read.parquet(f"{run}/versions") if run else _committed(spark, ledger, "versions")
    places = {rule.version: place for place, rule in enumerate(rules)}
    current = reduce(
        lambda done, at: F.when(
            (F.col("span.kind") == rules[at].kind) & F.array_contains("versions", rules[at].version), F.lit(at)
        ).otherwise(done),
        places.values(),
        F.lit(None).cast("int"),
    )
    spans = blobs.select("blob", "versions", F.explode("spans").alias("span")).withColumn("now", current)
    span = F.struct("span.start", F.col("now").alias("place"), "span.kind", "span.end")
    per_blob = (
        spans.where("now IS NOT NULL")
        .groupBy(F.col("blob").alias("~blob"))
        .agg(F.array_sort(F.collect_set(span)).alias("spans"))
    )
    # Written down, so that both sides are shuffled for the join and AQE can divide a blob of many paths.
    path = scratch_path(spark, "found")
    per_blob.write.parquet(path)
    joined = versions.join(spark.read.parquet(path), F.col("blob") == F.col("~blob"), "left")
    return joined.select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def digest_spans(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
