"""Repeated passages from a sparse suffix array.

1. Anchors. The smallest hash among the 5-word runs of every ``ANCHOR`` words is an anchor, chosen by content alone, so
   two copies of a passage of at least ``ANCHOR`` words have the same anchors inside. Only suffixes that begin at
   anchors are kept, named by the hash of their first ``HEAD`` words. Documents with equal texts are one here.
2. Heads found in one document only leave. The suffixes that stay get the words around them, ``LEFT`` before the
   anchor and ``RIGHT`` after the head: as far as a match can go before it has another anchor.
3. The suffixes are range-partitioned and sorted by head and following words, and once more by head and preceding
   words (backwards), so the suffix sharing the longest continuation stands next. A range may begin inside a head
   found everywhere; the first and last suffix of each range meet those of the next one afterwards. Neighbours from
   different documents are extended to the right and to the left; at least ``min_words`` words make a match.
4. A document's matches are merged into spans; copies of a text get their representative's spans, and the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import hash128, shuffle_partitions

#: Words of an anchor's run, words among which one begins, and words of a suffix's head.
RUN, ANCHOR, HEAD = 5, 30, 20
#: Words kept before an anchor and after a head.
LEFT, RIGHT = 25, 40
BROADCAST_IDS = 2_000_000
_WORDS_HELD = 500_000
_U = np.uint64
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(HEAD)], _U)


class Words(dict):
    """A text's words (between ASCII white space) as 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().split()
        return np.fromiter(map(self.__getitem__, words), _U, len(words))


def anchors(h: np.ndarray) -> np.ndarray:
    """Positions of a text's anchors whose head is inside the text."""
    n = len(h) - RUN + 1
    w = ANCHOR - RUN + 1
    if n < w:
        return np.zeros(0, np.int64)
    run = np.zeros(n, _U)
    for i in range(RUN):
        run = (run ^ h[i:i + n]) * _U(0x9E3779B97F4A7C15)
        run ^= run >> _U(29)
    out = []
    for a in range(0, n - w + 1, 100_000):  # bounded memory for very long texts
        part = np.lib.stride_tricks.sliding_window_view(run[a:min(n, a + 100_000 + w - 1)], w)
        out.append(np.unique(part.argmin(1) + np.arange(a, a + len(part))))
    at = np.unique(np.concatenate(out))
    return at[at + HEAD <= len(h)]


def heads(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (h[at[:, None] + np.arange(HEAD)] * _POWERS).sum(1, dtype=_U)


def _suffix_heads(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` has ``id``, ``text`` and the text's digest ``d1``, ``d2``: ``id``, ``n_words``, ``d1``, ``d2`` and ``suffixes``, an array of (head, pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = part.column(1).to_pylist()
                n, at, of = [], [], []
                for t in texts:
                    h = words(t)
                    n.append(len(h))
                    at.append(anchors(h) if len(h) >= min_words else np.zeros(0, np.int64))
                    of.append(heads(h, at[-1]))
                edges = np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(of).astype(_U).view(np.int64)), pa.array(np.concatenate(at).astype(np.int32))],
                    names=["head", "pos"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), part.column(2), part.column(3),
                     pa.ListArray.from_arrays(pa.array(edges), pairs)], names=["id", "n_words", "d1", "d2", "suffixes"])

    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
    schema.add("suffixes", T.ArrayType(T.StructType([T.StructField("head", T.LongType()), T.StructField("pos", T.IntegerType())])))
    return docs.mapInArrow(run, schema)


def _with_contexts(texts: DataFrame) -> DataFrame:
    """``texts`` has ``id``, ``var`` (tells different texts of one id apart), ``text`` and ``at`` (positions): ``head``, ``id``, ``pos``, ``left``
    (the words before, nearest first, 4 bytes each), ``right`` (the words after the head) and ``var``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                ids, variants, head, pos, left, right, owner = part.column(0), part.column(1), [], [], [], [], []
                for i, (text, at) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    h = words(text)
                    at = np.sort(np.array(at, np.int64))
                    forth = (h >> _U(32)).astype(">u4").tobytes()
                    back = (h[::-1] >> _U(32)).astype(">u4").tobytes()
                    n = len(h)
                    head.append(heads(h, at))
                    pos += at.tolist()
                    owner += [i] * len(at)
                    left += [back[4 * (n - p):4 * (n - p + LEFT)] for p in at.tolist()]
                    right += [forth[4 * (p + HEAD):4 * (p + HEAD + RIGHT)] for p in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(head).astype(_U).view(np.int64)), ids.take(pa.array(owner, pa.int64())),
                     pa.array(pos, pa.int32()), pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                     variants.take(pa.array(owner, pa.int64()))], names=["head", "id", "pos", "left", "right", "var"])

    schema = T.StructType([T.StructField("head", T.LongType()), T.StructField("id", texts.schema["id"].dataType),
                           T.StructField("pos", T.IntegerType()), T.StructField("left", T.BinaryType()),
                           T.StructField("right", T.BinaryType()), T.StructField("var", T.LongType())])
    return texts.select("id", "var", "text", "at").mapInArrow(run, schema)


def _common(a: bytes, b: bytes) -> int:
    """Leading 4-byte words that two strings share."""
    n = min(len(a), len(b)) // 4 * 4
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return (8 * n - differ.bit_length()) // 32


def _neighbours(rows: DataFrame, min_words: int) -> DataFrame:
    """Matches between neighbours in the order of ``rows`` (sorted within its partitions): ``id``, ``var``, ``first`` and ``end``
    words, ``partner``; and, with a null ``partner``, the first and last row of each partition (``part``, ``edge`` 0 or 1)."""
    kind = rows.schema["id"].dataType
    fields = ["head", "id", "pos", "left", "right", "var"]
    schema = T.StructType([*(rows.schema[c] for c in fields), T.StructField("end", T.IntegerType()), T.StructField("partner", kind),
                           T.StructField("part", T.IntegerType()), T.StructField("edge", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before, group, out, first = None, [], [], None  # the last row of another document, the current document's rows

        def match(a, b):
            left, right = _common(a[3], b[3]), _common(a[4], b[4])
            if left + HEAD + right >= min_words:
                for x, y in ((a, b), (b, a)):
                    out.append((None, x[1], x[2] - left, None, None, x[5], x[2] + HEAD + right, y[1], None, None))

        def batch_of(found):
            columns = zip(*found, strict=True) if found else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(fields))), strict=True):
                first = first or row
                if group and group[-1][0] == row[0]:
                    if group[-1][1] == row[1]:
                        if before:
                            match(before, row)
                        group.append(row)
                    else:
                        for other in group:
                            match(other, row)
                        before, group = group[-1], [row]
                else:
                    before, group = None, [row]
                if len(out) >= 20_000:
                    yield batch_of(out)
                    out.clear()
        if first:
            out += [(*first, None, None, part, 0), (*group[-1], None, None, part, 1)]
        yield batch_of(out)

    return rows.select(*fields).mapInArrow(run, schema)


def _matches(suffixes: DataFrame, by: str, n: int, min_words: int) -> DataFrame:
    """``id``, ``var``, ``first``, ``end``, ``partner`` of the neighbours by ``head`` and the column ``by``."""
    ordered = suffixes.repartitionByRange(n, "head", by).sortWithinPartitions("head", by, "id", "pos")
    found = materialize(_neighbours(ordered, min_words), "neighbours")
    # two rows of each range: the last of one and the first of the next are neighbours
    edges = found.where("part is not null").repartition(1).sortWithinPartitions("part", "edge")
    across = _neighbours(edges.select("head", "id", "pos", "left", "right", "var"), min_words)
    both = found.where("part is null").unionByName(across.where("part is null"))
    return both.select("id", "var", F.col("pos").alias("first"), "end", "partner")


def repeated_passages(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of at least ``min_words`` words that occur in more than one document, found between neighbours of the suffix order.

    A passage shared by two documents is found whole, and so is one that more documents share exactly. In large groups of near
    copies (hundreds, each with edits of its own) the neighbour with the longest context to one side may have an edit on the
    other, so that some words at the edges of such passages are missed: 19 of 45,476 words in 300 copies with 3 % edits.

    Returns ``doc_id``, ``start_word`` and ``end_word`` (from 0, end excluded), ``n_words`` and ``partner_id``, another
    document with words of the span; overlapping and touching matches of a document are one span. Words lie between
    ASCII white space and are compared as they are (by 32-bit hashes beyond the first ``HEAD`` of a suffix).

    Documents with equal texts repeat each other wholly if they have ``min_words`` words. Null ids, and null, empty and
    shorter texts have no spans; rows with the same id are one document, whose repeats inside itself don't count. If such rows
    have different texts, each text has its own spans under that id.
    """
    if min_words < 50:
        raise ValueError("anchors and heads are laid out for passages of at least 50 words")
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    d1, d2 = hash128(F.coalesce("text", F.lit("")))
    rows = rows.select("id", "text", d1.alias("d1"), d2.alias("d2"))
    found = materialize(_suffix_heads(rows, min_words).where(F.col("n_words") >= min_words), "anchors")
    classes = found.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.first("n_words").alias("n_words"),
                                            F.first("suffixes").alias("suffixes"))
    classes = materialize(classes, "texts")
    var = F.xxhash64("d1", "d2").alias("var")  # an id may come with several texts
    suffix = classes.select("rep", "d1", "d2", F.explode("suffixes").alias("s")).select("rep", "d1", "d2", "s.head", "s.pos")
    shared = suffix.groupBy("head").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("head")
    at = suffix.join(shared, "head").groupBy("rep", "d1", "d2").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    at = materialize(at, "positions")
    texts = rows
    if at.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(at.select(F.col("rep").alias("of"))), F.col("id") == F.col("of"), "left_semi")
    named = at.toDF("of", "e1", "e2", "at")
    texts = texts.join(named, (F.col("id") == F.col("of")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")))
    texts = texts.select("id", F.xxhash64("e1", "e2").alias("var"), "text", "at").dropDuplicates(["id", "var"])
    suffixes = materialize(_with_contexts(texts), "suffixes")
    n = shuffle_partitions(docs.sparkSession)
    matches = _matches(suffixes, "right", n, min_words).unionByName(_matches(suffixes, "left", n, min_words))

    by_start = Window.partitionBy("id", "var").orderBy("first", "end", "partner")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = matches.withColumn("fresh", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    spans = fresh.withColumn("island", F.sum("fresh").over(by_start)).groupBy("id", "var", "island").agg(
        F.min("first").alias("first"), F.max("end").alias("end"), F.min("partner").alias("partner"))
    spans = spans.select(F.col("id").alias("rep"), "var", "first", "end", "partner")

    members = found.select("id", "d1", "d2").distinct().join(classes.select("d1", "d2", "rep", "last", "n_words"), ["d1", "d2"]).withColumn("var", var)
    copies = members.where("rep <> last").select("id", F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end"),
                                                 F.when(F.col("id") == F.col("rep"), F.col("last")).otherwise(F.col("rep")).alias("partner"))
    single = members.where("rep = last").join(spans, ["rep", "var"]).select("id", "first", "end", "partner")
    out = single.unionByName(copies)
    return out.select(F.col("id").alias("doc_id"), F.col("first").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"),
                      (F.col("end") - F.col("first")).cast("long").alias("n_words"), F.col("partner").alias("partner_id")).distinct()
