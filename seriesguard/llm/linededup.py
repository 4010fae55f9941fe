"""Line dedup across documents: keep bitmaps from range-partitioned line hashes.

1. Each text is split at line feeds. A line's key is the line without ASCII white space at both ends and
   with A-Z lower-cased. Keys of at least ``min_chars`` code points leave one slim row for each occurrence:
   128-bit key hash, document, row, position. This table is written once.
2. The slim rows are range-partitioned by hash (and a slice of the documents, so that a line found in a
   third of all documents still spreads over ``SLICES`` ranges) and sorted by document, largest first, and
   position. Streaming each run marks the first row of each document and the run's first document.
3. Runs are summed to one row for each key (partial aggregates first): in how many documents, which document comes first,
   and which slices have it. Keys in at least ``min_docs`` documents lose all other documents' lines; occurrences meet
   their key slice by slice, so that a line found everywhere isn't one task.
4. The dropped positions of a document become a run-length keep bitmap: the runs of kept lines. No text
   moves up to here.

``apply_bitmaps`` joins the bitmaps with the documents and cuts the texts: by the same plan at every size, in which each text moves
once. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, ascii_lower, free_name, hash128, shuffle_partitions

SLICES = 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(text: Column) -> Column:
    """Tells rows with the same document id and different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs`` that loses lines: ``doc_id``, ``row_key`` (hash of its text),
    ``n_lines``, ``n_dropped`` and ``keep_runs``, an array of (first, length) over the kept lines, from 0.
    Documents without a row here keep all their lines.

    A null or empty text is one empty line. Rows with a null id take no part: they lose nothing and don't
    count as holders. Repeated rows count as one document and each gets the same bitmap; the occurrences
    inside the largest holder all stay. Equal bitmaps aren't repeated. An empty table gives an empty one.
    """
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACES)))
    split = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), _row_key(F.col(text_col)).alias("row_key"), _lines(F.col(text_col)).alias("lines"))
    found = split.select("doc_id", "row_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    found = found.select("doc_id", "row_key", "n_lines", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    h1, h2 = hash128(F.col("key"))
    found = materialize(found.select(h1.alias("h1"), h2.alias("h2"), "doc_id", "row_key", "n_lines", "pos"), "lines")

    run = ["h1", "h2", "slice"]
    slices = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int")
    by_doc = Window.partitionBy(*run).orderBy(F.col("doc_id").desc(), "pos")
    ranged = found.withColumn("slice", slices).repartitionByRange(shuffle_partitions(docs.sparkSession), *run)
    seen = ranged.withColumn("new_doc", F.lag("doc_id").over(by_doc).eqNullSafe(F.col("doc_id")) == F.lit(False))
    heads = seen.where("new_doc").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"),
                                                          F.expr("bit_or(shiftleft(1L, slice))").alias("in_slices"))
    here = F.expr(f"filter(sequence(0, {SLICES - 1}), i -> shiftright(in_slices, i) & 1L = 1L)")
    common = heads.where(F.col("n_docs") >= min_docs).select("h1", "h2", "holder", F.explode(here).alias("slice"))
    dropped = found.withColumn("slice", slices).join(common, run).where(F.col("doc_id") != F.col("holder"))
    per_row = dropped.groupBy("doc_id", "row_key", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    edges = F.concat(F.array(F.lit(-1)), F.col("drops"), F.array(F.col("n_lines")))
    runs = F.transform(F.array(edges), lambda e: F.filter(
        F.transform(F.sequence(F.lit(1), F.size(e) - 1),
                    lambda i: F.struct((F.element_at(e, i) + 1).alias("first"),
                                       (F.element_at(e, i + 1) - F.element_at(e, i) - 1).alias("length"))),
        lambda r: r["length"] > 0))[0]
    return per_row.select("doc_id", "row_key", F.col("n_lines").cast("long").alias("n_lines"),
                          F.size("drops").cast("long").alias("n_dropped"), runs.alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with cut texts, and ``n_lines`` and ``n_dropped`` (long). The remaining lines are joined by a
    line feed; a text that loses no line is unchanged (null stays null); one that loses all is empty."""
    rk, bid = free_name(docs, "_row_key"), free_name(docs, "_bitmap_doc")
    rest = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    marks = bitmaps.select(F.col("doc_id").alias(bid), F.col("row_key").alias("_rk"), F.col("n_dropped").alias("_nd"),
                           F.col("keep_runs").alias("_runs"))
    marks = marks.toDF(bid, *(free_name(docs, c) for c in ("_marked_key", "_marked_drops", "_marked_runs")))
    key, drops, runs = (F.col(c) for c in marks.columns[1:])
    left = docs.select(*rest).withColumn(rk, _row_key(F.col(text_col)))
    joined = left.join(marks.hint("shuffle_hash"), (F.col(id_col) == F.col(bid)) & (F.col(rk) == key), "left")
    cut = F.transform(F.array(_lines(F.col(text_col))), lambda lines: F.array_join(F.transform(
        runs, lambda r: F.array_join(F.slice(lines, r["first"] + 1, r["length"]), "\n")), "\n"))[0]
    text = F.when(drops > 0, cut).otherwise(F.col(text_col)).alias(text_col)
    n_lines = F.size(_lines(F.col(text_col))).cast("long").alias("n_lines")
    return joined.select(*(text if c == text_col else F.col(c) for c in rest), n_lines,
                         F.coalesce(drops, F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Both steps; the bitmaps are written in between."""
    bitmaps = materialize(keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), "bitmaps")
    return apply_bitmaps(docs, bitmaps, id_col, text_col)
