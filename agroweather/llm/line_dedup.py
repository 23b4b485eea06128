"""Line dedup (operator 1), DataFrame functions only.

Method: every line of at least ``LEAST_LENGTH`` code points becomes a row of its
key's hash, document and position. These narrow rows are stored, so that the
texts are split once, then range-partitioned by hash, document (last first) and
position and sorted alike: equal lines stand together, the document that keeps
them first. A line that fills many documents is spread over neighbouring
partitions, as document and position belong to the range. Each partition's
slice of a key is streamed in that order for its first document and its number
of documents. Only keys that reach over a partition's edge, at most one for each
pair of neighbours, have several slices; theirs are joined along the edges. The
other documents' positions are gathered to one run-length-compressed keep bitmap
per document. Texts are only joined with their bitmap at the end.

A key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. A key found in at least ``LEAST_DOCUMENTS`` documents loses all its
lines except those of the largest document id. Two 64-bit hashes stand for a key.

Defined results: a NULL or empty text is one empty line; a row with a NULL id
neither holds a key nor loses a line; rows of one id count as one document and
each loses its own lines; repeated rows give repeated rows; an empty table
gives an empty table; further columns are kept by ``dedup_lines`` as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroweather.llm.common import lower_ascii, set_aside, stored

LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def long_lines(docs: DataFrame) -> DataFrame:
    """Rows ``h1, h2, doc, body, pos`` of all long lines.

    ``body`` is the hash of the whole text; with the id it names a row, so that
    rows which share an id keep their positions apart.
    """
    return (
        docs.where("doc IS NOT NULL")
        .select("doc", F.xxhash64("text").alias("body"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .where(F.length("line") >= LEAST_LENGTH)
        .select("doc", "body", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= LEAST_LENGTH)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "body", "pos")
    )


def line_runs(lines: DataFrame) -> DataFrame:
    """The rows of ``long_lines`` in sorted runs, with the number ``part`` of their range partition."""
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("pos")]
    return lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def streamed(runs: DataFrame) -> DataFrame:
    """``runs`` with ``first_doc``, ``last_doc`` and ``documents`` of each row's slice, and whether it is its ``head``.

    A slice is what one range partition holds of a key, so it is never larger than that.
    """
    ordered = Window.partitionBy("part", "h1", "h2").orderBy(F.col("doc").desc(), "pos")
    slice_of = Window.partitionBy("part", "h1", "h2")
    before = F.lag("doc").over(ordered)
    return (
        runs.withColumn("head", F.row_number().over(ordered) == 1)
        .withColumn("opens", (F.col("head") | (before != F.col("doc"))).cast("long"))
        .withColumn("first_doc", F.first("doc").over(ordered))
        .withColumn("last_doc", F.min("doc").over(slice_of))
        .withColumn("documents", F.sum("opens").over(slice_of))
        .drop("opens")
    )


def joined_slices(runs: DataFrame) -> DataFrame:
    """``h1, h2, whole_first, whole_documents`` of the keys that reach over a partition's edge.

    Such a key is the last of one partition and the first of the next, so there are
    fewer of them than partitions. A document cut by the edge counts once.
    """
    ends = runs.groupBy("part").agg(F.array(F.min("h1"), F.max("h1")).alias("ends"))
    reaching = (
        ends.select("part", F.explode(F.array_distinct("ends")).alias("h1"))
        .groupBy("h1")
        .agg(F.count(F.lit(1)).alias("slices"))
        .where(F.col("slices") > 1)
        .select("h1")
    )
    slices = streamed(runs.join(F.broadcast(reaching), "h1", "left_semi")).where("head")
    along = Window.partitionBy("h1", "h2").orderBy("part")
    cut = (F.lag("last_doc").over(along) == F.col("first_doc")).cast("long")
    return (
        slices.withColumn("cut", F.coalesce(cut, F.lit(0)))
        .groupBy("h1", "h2")
        .agg(F.max("first_doc").alias("whole_first"), F.sum(F.col("documents") - F.col("cut")).alias("whole_documents"))
    )


def dropped_runs(runs: DataFrame) -> DataFrame:
    """Per row (``doc``, ``body``) the dropped positions and the compressed keep bitmap.

    ``runs`` are stored. ``keep`` lists the runs of kept lines as start and end, the last one open.
    """
    reaching = stored(joined_slices(runs), "line-edges")
    dropped = (
        streamed(runs)
        .join(F.broadcast(reaching), ["h1", "h2"], "left")
        .where(F.coalesce("whole_documents", "documents") >= LEAST_DOCUMENTS)
        .where(F.col("doc") < F.coalesce("whole_first", "first_doc"))
    )
    gathered = dropped.groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 1))
    ends = F.concat("gone", F.array(F.lit(2147483647)))
    pairs = F.arrays_zip(starts.alias("start"), ends.alias("end"))
    return gathered.select(
        "doc",
        "body",
        F.size("gone").cast("long").alias("n_gone"),
        F.filter(pairs, lambda run: run["start"] < run["end"]).alias("keep"),
    )


HELPERS = ["__doc", "__body", "__keep", "__lines", "__gone", "__kept"]


def with_kept_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__lines`` (before dropping), ``__gone`` (number dropped) and ``__kept`` (text)."""
    lines = stored(long_lines(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))), "lines")
    runs = stored(line_runs(lines), "line-runs")
    marks = dropped_runs(runs).select(
        F.col("doc").alias("__doc"), F.col("body").alias("__body"), F.col("n_gone").alias("__gone"), F.col("keep").alias("__keep")
    )
    joined = docs.join(
        marks,
        (F.col(doc_id) == F.col("__doc")) & (F.xxhash64(F.col(text)) == F.col("__body")),
        "left",
    )
    lines = lines_of(F.col(text))
    kept = F.flatten(
        F.transform(
            "__keep", lambda run: F.slice(lines, run["start"] + 1, F.least(run["end"], F.size(lines)) - run["start"])
        )
    )
    return joined.select(
        *[docs[name] for name in docs.columns],
        F.size(lines).cast("long").alias("__lines"),
        F.coalesce("__gone", F.lit(0).cast("long")).alias("__gone"),
        F.when(F.col("__keep").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias("__kept"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) its lines, dropped lines and a digest of the rest."""
    return with_kept_lines(docs.select(F.col("doc_id").cast("long"), "text")).select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__gone").alias("n_dropped"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with repeated lines dropped from the texts; rows and columns stay.

    A column ``n_chars``, where there is one, is counted anew for changed texts.
    """
    docs, back = set_aside(docs, HELPERS)
    found = with_kept_lines(docs, text=text)
    columns = []
    for name in docs.columns:
        column = F.col(name)
        if name == text:
            column = F.col("__kept")
        elif name == "n_chars":
            changed = F.length("__kept").cast(docs.schema[name].dataType)
            column = F.when(F.col("__gone") > 0, changed).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns).withColumnsRenamed(back)
