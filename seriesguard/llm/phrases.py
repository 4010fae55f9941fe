"""Phrase collocation mining with stripes: every first word keys a counter of the words that follow it.

1. Words are counted, for the languages' sizes, the counts of single words, and the frequent words: those that make up
   1/1024 of all words or more, at most 1,024 of them.
2. Each task counts its texts in chunks: the stripe of a word ``w1`` maps (``w2``, ``w3``) to how often they follow it
   inside a piece, with an end mark for ``w3`` where the piece ends behind ``w2``. So a stripe holds every occurrence of its
   prefixes ``w1 w2`` once. Stripes of frequent words are cut into ``SLICES`` by a hash of ``w2``, others are one row of a chunk.
3. One shuffle deals the stripes out by (language, ``w1``, slice) and sorts them; equal ones stream by and are added up
   elementwise. A merged stripe gives all that is needed: the counts of its three-word extensions, the totals of the
   prefixes ``w1 w2``, and each prefix's most frequent extension. Phrases below ``min_count`` go no further; nothing else
   is dropped.
4. Joins on candidates alone bring the counts of their parts together; scores are exact (decimal) integers.

Memory is a chunk of text in steps 1 and 2, and in step 3 ``MERGE_ENTRIES`` entries and the different entries of one slice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import shuffle_partitions

SLICES, FREQUENT = 64, 1024
#: Bytes of text counted at a time, and entries gathered before stripes are added up.
CHUNK_BYTES, MERGE_ENTRIES = 16_000_000, 400_000
#: Code points that end a piece (fixed values of the contract); the byte that stands for them occurs in no UTF-8 text.
BREAKS, BREAK = b".,;:!?\x0a\x0b\x0c\x0d", b"\xff"
_TABLE = bytes(BREAK[0] if bytes([b]) in BREAKS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Stands for ``w3`` in a stripe where the piece ends; no word holds it.
END = b"."

#: ``nexts`` is ``w2 w3 w2 w3 ...``, separated by spaces; ``counts`` has 8 little-endian bytes for each pair.
STRIPE_SCHEMA = "lang string, w1 string, slice int, nexts binary, counts binary"
PHRASE_SCHEMA = "lang string, w1 string, w2 string, w3 string, a long, extended long"


class _Words(dict):
    """Word -> its number, from 1; 0 is what it is made with."""

    def __init__(self, zero: bytes):
        super().__init__({zero: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def number(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers, with a 0 behind each piece, and the words by number."""
    words = _Words(BREAK)
    raw = BREAK.join([*texts, b"", b""]).translate(_TABLE)
    ids = words.number(raw.replace(BREAK, b" \xff ").split())  # only spaces are left to split at
    return ids, list(words)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Languages and texts, of about ``CHUNK_BYTES`` at a time (a longer text is alone)."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``w1`` and ``f``, how often the word occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches):
            ids, words = _numbered(texts)
            n = np.bincount(ids, minlength=len(words))
            for lo in range(1, len(words), 20_000):
                own = words[lo:lo + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array(own, pa.binary()).cast(pa.string()),
                                                  pa.array(n[lo:lo + len(own)], pa.int64())], names=["lang", "w1", "f"])

    parts = _rows(docs, lang_col, text_col).mapInArrow(run, "lang string, w1 string, f long")
    return parts.groupBy("lang", "w1").agg(F.sum("f").alias("f"))


def _count(ids: np.ndarray, words: list[bytes], sliced: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different (w1, w2, w3) sorted by w1, slice, w2 and w3, and how often each occurs; w3 is 0 where the piece ends."""
    size = len(words)
    part = np.fromiter((zlib.crc32(w) % SLICES for w in words), np.int64, size)
    at = np.flatnonzero(ids[:-2] * ids[1:-1])  # two breaks stand at the end
    first, second, third = ids[at], ids[at + 1], ids[at + 2]
    pairs, rank = np.unique((first * SLICES + part[second] * sliced[first]) * size + second, return_inverse=True)
    keys, n = np.unique(rank * size + third, return_counts=True)
    pair = pairs[keys // size]
    slot = pair // size
    return slot // SLICES, slot % SLICES, pair % size, keys % size, n


def _packed(second: np.ndarray, third: np.ndarray, n: np.ndarray, edges: np.ndarray, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """``nexts`` and ``counts`` of the runs between edges; ``words[0]`` is the end mark."""
    flat = list(map(words.__getitem__, np.column_stack([second, third]).ravel().tolist()))
    raw = n.astype("<u8").tobytes()
    spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
    return [b" ".join(flat[2 * a:2 * b]) for a, b in spans], [raw[8 * a:8 * b] for a, b in spans]


def _stripes(lang: str, texts: list[bytes], frequent: set[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
    """One row for each word (of a frequent one, for each slice) of a chunk, in batches."""
    ids, words = _numbered(texts)
    words[0] = END
    sliced = np.fromiter(((lang, w) in frequent for w in words), np.int64, len(words))
    first, part, second, third, n = _count(ids, words, sliced)
    if not len(first):
        return
    edges = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (part[1:] != part[:-1]), [True]]))
    for lo in range(0, len(edges) - 1, 20_000):
        own = edges[lo:lo + 20_001]
        inside, rows = slice(own[0], own[-1]), own[:-1]
        nexts, counts = _packed(second[inside], third[inside], n[inside], own - own[0], words)
        prefixes = [words[i] for i in first[rows].tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(rows), pa.string()), pa.array(prefixes, pa.binary()).cast(pa.string()), pa.array(part[rows], pa.int32()),
             pa.array(nexts, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "w1", "slice", "nexts", "counts"])


def stripes(docs: DataFrame, frequent: set[tuple[str, bytes]] = frozenset(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``w1``, ``slice``, ``nexts`` and ``counts`` (see ``STRIPE_SCHEMA``) of each chunk of texts. Words in ``frequent`` are sliced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches):
            yield from _stripes(lang, texts, frequent)

    return _rows(docs, lang_col, text_col).mapInArrow(run, STRIPE_SCHEMA)


class _Merged:
    """Stripes added up elementwise. Rows are (lang, w1, slice, nexts, counts), equal keys next to each other."""

    def __init__(self, rows: list[tuple]):
        words = _Words(END)
        pairs = words.number(b" ".join([r[3] for r in rows]).split(b" ")).reshape(-1, 2)
        n = np.frombuffer(b"".join([r[4] for r in rows]), "<u8").astype(np.int64)
        group, last, self.keys = [], None, []
        for r in rows:
            if r[:3] != last:
                last = r[:3]
                self.keys.append(last)
            group.append(len(self.keys) - 1)
        groups = np.repeat(np.array(group, np.int64), [len(r[4]) // 8 for r in rows])
        self.words = list(words)
        size = len(self.words)
        slots, rank = np.unique(groups * size + pairs[:, 0], return_inverse=True)
        key = rank * size + pairs[:, 1]
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.n = np.add.reduceat(n[order], starts)
        self.slot, self.third = key[starts] // size, key[starts] % size
        self.group, self.second = slots[self.slot] // size, slots[self.slot] % size

    def __len__(self) -> int:
        return len(self.n)

    def last(self) -> tuple:
        """The last key's merged stripe as a row."""
        a = int(np.searchsorted(self.group, len(self.keys) - 1))
        nexts, counts = _packed(self.second[a:], self.third[a:], self.n[a:], np.array([0, len(self) - a]), self.words)
        return (*self.keys[-1], nexts[0], counts[0])

    def phrases(self, min_count: int, whole: int) -> Iterator[pa.RecordBatch]:
        """Phrases of the first ``whole`` keys: two words (``w3`` null) with their most frequent extension, and three words."""
        end = int(np.searchsorted(self.group, whole))
        if not end:
            return
        slot, n = self.slot[:end], self.n[:end]
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        total = np.add.reduceat(n, starts)
        longest = np.maximum.reduceat(np.where(self.third[:end] > 0, n, 0), starts)
        two, three = np.flatnonzero(total >= min_count), np.flatnonzero((n >= min_count) & (self.third[:end] > 0))
        rows = np.concatenate([starts[two], three])
        spelt = lambda ids: pa.array([self.words[i] for i in ids], pa.binary()).cast(pa.string())
        keys = [self.keys[g] for g in self.group[rows].tolist()]
        none = [None] * len(two)
        third = pa.concat_arrays([pa.nulls(len(two), pa.string()), spelt(self.third[three].tolist())])
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), spelt(self.second[rows].tolist()), third,
             pa.array(np.concatenate([total[two], n[three]]), pa.int64()), pa.array(longest[two].tolist() + [None] * len(three), pa.int64())],
            names=["lang", "w1", "w2", "w3", "a", "extended"])


def merged(parts: DataFrame, min_count: int, merge_entries: int = MERGE_ENTRIES) -> DataFrame:
    """Adds up the stripes: ``lang``, ``w1``, ``w2``, ``w3``, ``a`` and, of two-word phrases (``w3`` null), ``extended``, the count of the
    most frequent phrase of one more word behind. Phrases have ``a`` >= ``min_count``."""
    keys = ["lang", "w1", "slice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, limit = 0, merge_entries
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[4]) // 8
                if size >= limit:  # rows come sorted, so only the last key can go on
                    added = _Merged(held)
                    yield from added.phrases(min_count, len(added.keys) - 1)
                    held = [added.last()]
                    size = len(held[0][4]) // 8
                    limit = merge_entries + 2 * size
        if held:
            added = _Merged(held)
            yield from added.phrases(min_count, len(added.keys))

    dealt = parts.repartition(shuffle_partitions(parts.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, PHRASE_SCHEMA)


def _exact(c: Column) -> Column:
    return c.cast("decimal(16,0)")


def _score(l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1,000,000 a^2 / (l r)) in whole numbers of up to 38 digits."""
    square = (_exact(F.col("a")) * _exact(F.col("a"))).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), (_exact(l) * _exact(r)).cast("decimal(33,0)")).cast("long")


def collocations(docs: DataFrame, min_count: int = 10, inside_pct: int = 50, top: int | None = 2000, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """Phrases of two and three words by how closely their words belong together, for each language.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words between spaces and tabs. A
    phrase counts wherever it occurs inside a piece. Candidates occur at least ``min_count`` times. Of a candidate's cuts in two the
    one with the lowest floor(1,000,000 a^2 / (l r)) counts. A candidate inside a longer one that is at least ``inside_pct`` percent
    as frequent is left out. Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``, all phrases or the ``top`` of each
    language by score, ``a`` (both falling) and phrase (by UTF-8 bytes).

    A null language is ``und`` (together with a language of that name). A null or empty text has no words; texts without
    words add nothing. Repeated rows count each. An empty table gives an empty result. Only the two columns are read. Counts up
    to 10^16 are exact.
    """
    words = materialize(word_counts(docs, lang_col, text_col), "words")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    often = words.where(F.col("f") * FREQUENT >= n).select("lang", F.col("w1").cast("binary")).collect()
    frequent = {(r[0], bytes(r[1])) for r in often}
    found = materialize(merged(stripes(docs, frequent, lang_col, text_col), min_count), "phrases")
    words = words.where(F.col("f") >= min_count)
    pairs = found.where("w3 is null")
    triples = found.where("w3 is not null")

    def word(name: str, out: str) -> DataFrame:
        return words.select("lang", F.col("w1").alias(name), F.col("f").alias(out))

    def pair(first: str, second: str, out: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(out))

    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("led"))
    two = pairs.join(before, ["lang", "w1", "w2"], "left")
    most = F.greatest("extended", F.coalesce("led", F.lit(0).cast("long")))
    two = two.where((most < min_count) | (most * 100 < F.col("a") * inside_pct))
    two = two.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("l"), F.col("r")).alias("score"))
    three = triples.join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
    three = three.join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"])
    cuts = [F.struct(_score(F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                     F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(*cuts).alias("cut"))
    three = three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    scored = two.unionByName(three)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
