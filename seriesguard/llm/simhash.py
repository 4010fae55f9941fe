"""SimHash fingerprints of 128 bits, and all pairs of them within a Hamming radius.

Terms are runs of ``TERM_WORDS`` words (all the words of a shorter text), each as often as it occurs. A term's two 64-bit
hashes vote for or against each bit; a bit is set where the votes for it outweigh. Votes for bits
i and i + 32 of one hash share a sum: ``(hash >>> i) & 0x100000001`` adds to the low and the high half of a
long, so 64 sums count all 128 bits and partial sums are made before any shuffle, whatever a text's length.

``pairs_within`` finds all pairs of different fingerprints that differ in at most ``radius`` bits: cut into
radius + 1 blocks, at least one block of both is equal, so each table permutes one block to the front and
joins on it. Equal fingerprints are one class and aren't paired. DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, shuffle_partitions

TERM_WORDS = 3
BITS = 128
_LANES = 0x100000001
#: Row numbers of one range of ids begin at a multiple of this.
_RANGE = 1 << 40
#: First digit and number of digits of the pieces of a SHA-256 in hexadecimal.
_PIECES = [(1, 13), (14, 13), (27, 13), (40, 13), (53, 12)]


def words(text: Column) -> Column:
    """The lower-cased words between ASCII white space; none for a null text."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def terms(text: Column) -> Column:
    """The text's runs of ``TERM_WORDS`` words as an array of structs; one run of all words in a shorter text."""
    def runs(w: Column) -> Column:
        shifted = [F.slice(w, i + 1, F.size(w) - (TERM_WORDS - 1)).alias(f"w{i}") for i in range(TERM_WORDS)]
        whole = F.array(F.struct(F.array_join(w, " ").alias("w0"), *(F.lit("").alias(f"w{i}") for i in range(1, TERM_WORDS))))
        return F.when(F.size(w) >= TERM_WORDS, F.arrays_zip(*shifted)).when(F.size(w) > 0, whole)
    return F.transform(F.array(words(text)), runs)[0]


def fingerprints(texts: DataFrame, key: list[str], text_col: str) -> DataFrame:
    """``key`` columns, ``f1`` and ``f2`` (longs: the bits) and ``n_terms`` for each different key.

    Rows with equal keys are taken as one text. A text without words (or null) has no terms and all bits zero.
    """
    rows = texts.select(*key, F.explode_outer(terms(F.col(text_col))).alias("_t"))
    parts = [F.col(f"_t.w{i}") for i in range(TERM_WORDS)]
    some = F.col("_t").isNotNull()
    rows = rows.select(*key, some.cast("long").alias("_one"),
                       F.when(some, F.xxhash64(*parts)).alias("_h1"), F.when(some, F.xxhash64(F.lit("b"), *parts)).alias("_h2"))
    lanes = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES))).alias(f"_{h}_{i}") for h in ("_h1", "_h2") for i in range(32)]
    votes = rows.groupBy(*key).agg(F.sum("_one").alias("n_terms"), *lanes)

    def bits(h: str) -> Column:
        out = []
        for i in range(32):
            both = F.col(f"_{h}_{i}")
            low, high = both.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(both, 32)
            for at, count in ((i, low), (i + 32, high)):
                mask = 1 << at
                out.append(F.when(count * 2 > F.col("n_terms"), F.lit(mask - (1 << 64) if at == 63 else mask)).otherwise(F.lit(0).cast("long")))
        return reduce(lambda a, b: a.bitwiseOR(b), out)

    zero = F.lit(0).cast("long")
    some = F.col("n_terms") > 0
    return votes.select(*key, F.when(some, bits("_h1")).otherwise(zero).alias("f1"),
                        F.when(some, bits("_h2")).otherwise(zero).alias("f2"), "n_terms")


def to_hex(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def distance(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def likeness(d: Column) -> Column:
    """The cosine of the term vectors that a distance stands for: 1 at no differing bit, 0 from half of the bits on."""
    return F.greatest(F.lit(0.0), F.cos(d.cast("double") * (math.pi / BITS)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text`` (null: empty), ``next_text`` (that of the next row by ascending id; after the last the first)
    and numbers of both rows, ``row`` and ``next_row``. One shuffle of the texts.

    Ids are cut into ranges of about equal counts, at most ``spark.sql.shuffle.partitions``; each range also
    gets the first row of the range after it. Null ids come first; equal ids follow their texts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = max(2, shuffle_partitions(docs.sparkSession))
    cuts = sorted(set(rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000)).first()[0] or []))
    part = F.lit(0)
    if cuts:
        part = F.when(F.col("id").isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("id"))))
    rows = rows.withColumn("part", part.cast("long"))
    first = F.min_by("text", F.struct(F.col("id").isNotNull(), "id", "text"))
    heads = materialize(rows.groupBy("part").agg(first.alias("text")), "heads")  # a row for each range
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy(F.lit(0))))
    heads = heads.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "text", before.alias("part"),
                         (F.col("part") * _RANGE).alias("head_row"))
    both = rows.withColumn("head_row", F.lit(None).cast("long")).unionByName(heads)
    order = Window.partitionBy("part").orderBy(F.col("head_row").isNotNull(), F.col("id").asc_nulls_first(), "text")
    row = F.coalesce("head_row", F.col("part") * _RANGE + F.row_number().over(order) - 1)
    both = both.withColumn("row", row)
    both = both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_row", F.lead("row").over(order))
    return both.where("head_row is null").select("id", "text", "next_text", "row", "next_row")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first as many (or all) of ``next_text``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, and how like it is to that of its edited text and of the next document.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex), ``near_edited`` and
    ``near_next``. A null text is empty. Repeated ids keep a row each, in the order of their texts; a single
    document is its own next one; an empty table gives an empty result. No column but id and text is read.
    """
    rows = with_next(docs, id_col, text_col)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sha = F.sha2("edited", 256)  # as five longs, which partial sums carry more cheaply than a string
    pieces = [F.conv(F.substring(sha, a, n), 16, 10).cast("long").alias(f"s{a}") for a, n in _PIECES]
    versions = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("version")),
                       F.struct(F.lit(1).alias("kind"), F.col("edited").alias("version")))
    meta = ["id", "row", "next_row", "n_chars", *(f"s{a}" for a, _ in _PIECES)]
    rows = rows.select("id", "row", "next_row", F.length("text").cast("long").alias("n_chars"), *pieces, F.explode(versions).alias("v"))
    found = fingerprints(rows.select(*meta, "v.kind", "v.version"), [*meta, "kind"], "version")
    of = lambda kind, f: F.max(F.when(F.col("kind") == kind, F.col(f)))
    prints = materialize(found.groupBy(*meta).agg(
        of(0, "f1").alias("f1"), of(0, "f2").alias("f2"), of(1, "f1").alias("e1"), of(1, "f2").alias("e2")), "prints")
    following = prints.select(F.col("row").alias("of_row"), F.col("f1").alias("n1"), F.col("f2").alias("n2"))
    joined = prints.join(following, F.col("next_row") == F.col("of_row"))
    digits = [F.lpad(F.lower(F.hex(f"s{a}")), n, "0") for a, n in _PIECES]
    c = F.col
    return joined.select(
        c("id").alias("doc_id"), "n_chars", F.concat(*digits).alias("edited_sha256"), to_hex(c("f1"), c("f2")).alias("fingerprint"),
        to_hex(c("e1"), c("e2")).alias("edited_fingerprint"), likeness(distance(c("f1"), c("f2"), c("e1"), c("e2"))).alias("near_edited"),
        likeness(distance(c("f1"), c("f2"), c("n1"), c("n2"))).alias("near_next"))


def pairs_within(prints: DataFrame, radius: int = 3, id_col: str = "doc_id", f1: str = "f1", f2: str = "f2") -> tuple[DataFrame, DataFrame]:
    """Classes and pairs of fingerprints: ``members`` (``id``, ``class_id``: the smallest id with this fingerprint) and
    ``pairs`` (``a``, ``b``, ``distance``) of all classes a < b that differ in 1 to ``radius`` bits.

    Null ids take no part. Radius 0 gives no pairs. A pair found in several tables is kept from the first
    block that both share. Radius up to 31.
    """
    rows = prints.where(F.col(id_col).isNotNull() & F.col(f1).isNotNull() & F.col(f2).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(f1).alias("f1"), F.col(f2).alias("f2"))
    classes = materialize(rows.groupBy("f1", "f2").agg(F.min("id").alias("class_id")), "classes")
    members = rows.join(classes, ["f1", "f2"]).select("id", "class_id")
    if radius < 1:
        none = classes.where(F.lit(False))
        return members, none.select(F.col("class_id").alias("a"), F.col("class_id").alias("b"), F.lit(0).alias("distance"))
    n = radius + 1
    edges = [BITS * i // n for i in range(n + 1)]

    def block(i: int) -> Column:
        """The bits from edges[i] up to edges[i + 1], of f1 (the low 64) and f2."""
        parts = []
        for name, base in (("f1", 0), ("f2", 64)):
            a, b = max(edges[i], base), min(edges[i + 1], base + 64)
            if a < b:
                mask = ((1 << (b - a)) - 1) << (a - base)
                parts.append(F.col(name).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))
        return F.struct(F.lit(i).alias("i"), *(p.alias(f"p{j}") for j, p in enumerate([*parts, F.lit(0).cast("long")][:2])))

    blocks = F.array(*map(block, range(n)))
    tables = classes.select("class_id", "f1", "f2", blocks.alias("blocks"), F.explode(blocks).alias("block"))
    left = tables.select(*(F.col(c).alias(f"l_{c}") for c in tables.columns))
    found = left.join(tables, (F.col("l_block") == F.col("block")) & (F.col("l_class_id") < F.col("class_id")))
    d = distance(F.col("l_f1"), F.col("l_f2"), F.col("f1"), F.col("f2"))
    first = F.filter(F.zip_with("l_blocks", "blocks", lambda a, b: F.when(a == b, a["i"])), lambda i: i.isNotNull())[0]
    found = found.where((d <= radius) & (first == F.col("block.i")))
    return members, found.select(F.col("l_class_id").alias("a"), F.col("class_id").alias("b"), d.alias("distance"))
