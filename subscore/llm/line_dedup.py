"""Runs of lines that repeat in a corpus, by a suffix array over line ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscore.session import scratch_path, shared_root

#: The columns of a position: document, text within documents of one id, line.
AT = ["id", "tie", "pos"]

#: A word of a line: what stands between white space of ASCII.
WORD = r"[^\x20\x09-\x0D]+"


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """``keys`` with a ``rank`` in the order of the columns ``by``, for any number of rows.

    Ranges of keys are sorted apart; a rank is the number of the range and the place in it.
    """
    ranges = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    # The ranks must not change when a part is computed again, so they are written down.
    return ranges.withColumn("rank", F.monotonically_increasing_id()).checkpoint()


def numbered_lines(docs: DataFrame, doc_id: str, text: str, blank: bool = True) -> DataFrame:
    """(id, tie, pos, line, n_words, start, end): the lines of all texts as 128-bit ids.

    ``pos`` counts the lines of a text, without ``blank`` only those with a word. The lines of
    the text from ``start`` up to ``end`` go with a line: itself and, without ``blank``, lines
    without words ahead of the first and behind the last. ``tie`` orders rows with the same id
    by their text. Words are counted only without ``blank``.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    n_words = lambda line: F.lit(0) if blank else F.regexp_count(line, F.lit(WORD))
    every = F.transform(
        F.split("text", "\n"),
        lambda line, at: F.struct(at.alias("at"), line.alias("line"), n_words(line).alias("n_words")),
    )
    kept = F.col("every") if blank else F.filter("every", lambda line: line["n_words"] > 0)
    lines = source.select("id", F.xxhash64("text").alias("tie"), every.alias("every"))
    lines = lines.select("id", "tie", F.size("every").alias("n_lines"), kept.alias("kept"))
    lines = lines.select("id", "tie", "n_lines", F.size("kept").alias("n_kept"), F.posexplode("kept"))
    first, last = F.col("pos") == 0, F.col("pos") == F.col("n_kept") - 1
    return lines.select(
        *AT,
        F.unhex(F.md5("col.line")).alias("line"),
        F.col("col.n_words").alias("n_words"),
        F.when(first, 0).otherwise(F.col("col.at")).alias("start"),
        F.when(last, F.col("n_lines")).otherwise(F.col("col.at") + 1).alias("end"),
    )


def shortest_runs(found: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """``found`` with ``sizes``, (size, end) of the shortest runs of lines that count from each line on.

    A run counts from ``min_lines`` lines and ``min_words`` words on; it is one of the shortest
    if it does not count any more without its first or without its last line. Every line of a
    run that counts is in one of the shortest, so these decide what repeats. None has more
    lines than the larger of both numbers, as each line has a word where words are asked for.
    """
    if min_words <= 0:
        shortest = F.struct(F.lit(min_lines).alias("size"), (F.col("start") + min_lines).alias("end"))
        return found.withColumn("sizes", F.array(shortest))
    ahead = Window.partitionBy("id", "tie").orderBy("pos").rangeBetween(0, max(min_lines, min_words) - 1)
    # Rows with the same id and text give each line several times.
    following = F.array_sort(F.collect_set(F.struct("pos", "n_words", "end")).over(ahead))
    gapless = F.filter("~lines", lambda line, at: line["pos"] == F.col("pos") + at)
    sums = F.aggregate(
        F.col("~lines.n_words"),
        F.array(F.lit(0)),
        lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
    )

    def counts(size, before):
        """Whether ``size`` lines count, those up to line ``before`` left out of the words."""
        words = F.col("~sums")[size + before] - F.col("~sums")[before]
        return (size >= min_lines) & (words >= min_words)

    zero, one = F.lit(0), F.lit(1)
    chosen = F.filter(
        F.sequence(one, F.size("~lines")),
        lambda size: counts(size, zero) & ~(counts(size - 1, zero) & counts(size - 1, one)),
    )
    sizes = F.transform(
        chosen, lambda size: F.struct(size.alias("size"), F.col("~lines")[size - 1]["end"].alias("end"))
    )
    found = found.withColumn("~lines", following).withColumn("~lines", gapless).withColumn("~sums", sums)
    return found.withColumn("sizes", sizes).drop("~lines", "~sums")


def repeated_suffixes(lines: DataFrame, min_lines: int, min_words: int = 0) -> DataFrame:
    """(id, tie, pos, start, size, end, head, then): the suffix array's intervals where runs count.

    Prefix doubling: suffixes ranked by their first h lines are ranked by their first h + s
    lines (s <= h) from their own rank, ``head``, and that of the suffix s lines on, ``then``. A
    suffix whose prefix occurs once is in no interval and leaves; so do suffixes that end
    before. Rows of equal ``size``, ``head`` and ``then`` are one interval with a common prefix
    of ``size`` lines, one of the sizes of :func:`shortest_runs`. The order inside an interval
    does not matter here, so sorting stops at the largest of these sizes.

    Groups are counted before they are ranked, so a line that a third of all rows share is one
    row when ranges are dealt out; rows come back to their rank by a join that AQE can split.
    """
    depth = max(min_lines, min_words)
    counted = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line")
    found = lines.join(ranked(counted, ["line"]), "line").drop("line")
    found = shortest_runs(found, min_lines, min_words).drop("n_words", "end").checkpoint()
    single = F.inline(F.filter("sizes", lambda run: run["size"] == 1))
    columns = [*AT, "start", "size", "end", "head", "then"]
    levels = [found.select(*AT, "start", F.col("rank").alias("head"), F.lit(-1).cast("long").alias("then"), single)]
    reached = 1
    while reached < depth:
        step = min(reached, depth - reached)

        def then(more):
            ahead = Window.partitionBy("id", "tie").orderBy("pos").rangeBetween(more, more)
            return F.first("rank").over(ahead)

        # Sizes up to the next level are told by the ranks of the first and the last lines.
        least = max(min_lines - reached, 1)
        if least <= step:
            thens = F.array(*(then(more) for more in range(least, step + 1)))
            own = F.filter("sizes", lambda run: (run["size"] > reached) & (run["size"] <= reached + step))
            runs = F.transform(
                own, lambda run: run.withField("then", F.col("~thens")[run["size"] - reached - least])
            )
            told = found.withColumn("~thens", thens).select(
                *AT, "start", F.col("rank").alias("head"), F.inline(runs)
            )
            levels.append(told.where("then IS NOT NULL"))
        reached += step
        if reached < depth:
            pairs = found.withColumn("then", then(step)).where("then IS NOT NULL")
            pairs = pairs.withColumnRenamed("rank", "head")
            counted = pairs.groupBy("head", "then").agg(F.count("*").alias("n")).where("n > 1").drop("n")
            found = pairs.join(ranked(counted, ["head", "then"]), ["head", "then"]).drop("head", "then")
            found = found.checkpoint()
    return reduce(DataFrame.unionAll, (level.select(*columns) for level in levels))


def repeated_runs(
    docs: DataFrame, min_lines: int = 3, doc_id: str = "doc_id", text: str = "text", min_words: int = 0
) -> DataFrame:
    """Runs of lines that repeat earlier ones, as long as they follow the same first copy.

    (id, tie, start, end): the lines from ``start`` up to ``end`` of a document, at least
    ``min_lines`` with at least ``min_words`` words; (source_id, source_tie, source_start):
    where the first copies of their shortest stretches that count stand, one after the other.
    Where stretches of a repeated run have different first copies, it comes in pieces, which
    may overlap; the same lines are covered either way. ``tie`` tells rows with the same id apart. With
    ``min_words``, lines without words are passed over, and ``from_pos`` and ``to_pos`` are
    places among the other lines; otherwise they are ``start`` and ``end``.
    """
    spark = docs.sparkSession
    shared_root(spark)
    path = scratch_path(spark, "lines")
    numbered_lines(docs, doc_id, text, blank=min_words <= 0).write.parquet(path)
    repeated = repeated_suffixes(spark.read.parquet(path), min_lines, min_words).checkpoint()
    interval, place = ["size", "head", "then"], F.struct(*AT, "start")
    # Written down, so that both sides are shuffled for the join and AQE can divide a hot run.
    first = repeated.groupBy(*interval).agg(F.min(place).alias("first")).checkpoint()
    copies = repeated.join(first, interval).where(place != F.col("first"))
    copies = copies.select(*AT, "start", "size", "end", "first").distinct()
    side = ["id", "tie", "first.id", "first.tie", F.col("pos") - F.col("first.pos")]
    # Copies with the same source are one run as long as they overlap or follow each other.
    in_order = Window.partitionBy(*side).orderBy("pos", "size")
    before = F.max(F.col("pos") + F.col("size")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        copies.withColumn("apart", F.coalesce(F.col("pos") > before, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("apart").over(in_order))
        .withColumn("ahead", F.col("pos") - F.col("first.pos"))
        .groupBy(
            "id", "tie", F.col("first.id").alias("source_id"), F.col("first.tie").alias("source_tie"), "ahead", "run"
        )
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min("first.start").alias("source_start"),
            F.min("pos").alias("from_pos"),
            F.max(F.col("pos") + F.col("size")).alias("to_pos"),
        )
        .drop("ahead", "run")
    )


def remove_repeated_lines(
    docs: DataFrame, min_lines: int = 3, doc_id: str = "doc_id", text: str = "text", min_words: int = 0
) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines, with counts of lines.

    A run of at least ``min_lines`` consecutive lines that also stands, line for line, earlier
    in the corpus (in a document with a smaller id, or further up in the same document) is
    removed from ``text``; overlapping copies are removed together. The first copy stays, as
    does all else. Runs are judged on the input, not on what is left. Lines end at ``\\n``
    and are compared exactly. ``n_lines`` and ``n_removed`` count lines before and removed.

    With ``min_words``, a run counts only if it has so many words as well, and lines without
    words are passed over: they are neither compared nor counted for ``min_lines``, and go if
    the nearest lines with words on both sides, or on the only side that has any, go. So
    ``min_lines=1, min_words=5`` removes single lines and short texts too.

    A null text stays null, with no lines; an empty one has one empty line, as have blank
    lines everywhere. A missing id comes before all others. Rows with the same id are ordered
    by a hash of their text; rows with the same id and text are one document and come out as
    often as they came in, with the same result. An empty table gives an empty table. All
    columns of ``docs`` stay, except that ``n_lines`` and ``n_removed`` replace columns of
    these names. Only built-in column functions are used.
    """
    found = repeated_runs(docs, min_lines, doc_id, text, min_words)
    by_document = Window.partitionBy("id", "tie").orderBy("from_pos", "to_pos")
    before = F.max("to_pos").over(by_document.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("from_pos") > before, F.lit(True))
    runs = (
        found.withColumn("apart", apart)
        .withColumn("span", F.sum(F.col("apart").cast("int")).over(by_document))
        .groupBy("id", "tie", "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("id").alias("~id"), F.col("tie").alias("~tie"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("~runs"))
    )
    source = docs.select(
        *(f"`{name}`" for name in docs.columns if name.lower() not in ("n_lines", "n_removed"))
    )
    own_text = F.col(f"`{text}`").cast("string")
    joined = source.withColumn("~own", F.xxhash64(own_text)).join(
        runs,
        F.col(f"`{doc_id}`").eqNullSafe(F.col("`~id`")) & (F.col("`~own`") == F.col("`~tie`")),
        "left",
    )
    lines = F.split(own_text, "\n")
    runs_of = F.col("`~runs`")
    from_lines = F.concat(F.array(F.lit(0)), runs_of["end"])
    to_lines = F.concat(runs_of["start"], F.array(F.size(lines)))
    left = F.zip_with(
        from_lines, to_lines, lambda start, end: F.slice(F.col("`~lines`"), start + 1, end - start)
    )
    counted = joined.withColumn("~lines", lines).select(
        *(f"`{name}`" for name in source.columns if name != text),
        F.when(runs_of.isNull(), own_text).otherwise(F.array_join(F.flatten(left), "\n")).alias(text),
        F.coalesce(F.size("~lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(
            F.aggregate(runs_of, F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"]),
            F.lit(0).cast("long"),
        ).alias("n_removed"),
    )
    return counted.select(*(f"`{name}`" for name in source.columns), "n_lines", "n_removed")
