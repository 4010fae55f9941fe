"""Exact Jaccard join of word-shingle sets, and its components.

The Jaccard distance is a metric. Two documents link at a distance of at most r = 1 - t.

1. Sets. Texts become sorted sets of hashed shingles; documents with equal sets are one class from here on.
2. Top-level regions. A pair that links differs in at most D shingles, D = 2 (1-t)/(1+t) times the largest
   size of its band. Cutting the hash space into more than D slices leaves a slice in which both sets
   are equal (distance 0 there), so every slice's content is the pivot of a region that holds all sets with
   exactly this content. (Documents as top-level pivots don't divide this space: unrelated texts are all
   at a distance near 1, so that the window d(x,q) <= d(x,p) + 2r holds for all pivots q; see the README.)
   A set is replicated into the regions of its own band and, as a boundary case, of larger bands that
   may hold partners. Sets with so many empty slices that a pair could share only those go, in addition,
   to the regions of their smallest shingles (prefix).
3. Second regions. Only documents that share a top-level region go on. A sketch of how often their shingles occur
   (``SKETCH`` counters, whatever the corpus) orders all shingles, rare ones first; a pair that links shares a shingle among
   the first n - ceil(t n) + 1 of each set, so each of these shingles is the pivot of a region, and the sets that hold it
   within that window are its members. Near copies whose own edits outweigh the threshold meet nobody here.
4. Inside regions, documents are pivots. Each document meets the smallest of its regions' pivots first: that one is
   its home, at a known distance. Then, round by round, every region whose members aren't all connected yet takes
   new pivots (more in each round). The members of other components meet them, unless a lower bound of their distance rules the
   pair out: the triangle inequality on a common home, |d(x,h) - d(p,h)| > r, or the number of hash slices in which
   the two sets differ, for sets that link differ in at most (1-t)/(1+t) of their sizes' sum. Slices are compared twice:
   ``DIGEST`` longs a set inside the join, then, for the pairs it leaves, digests that grow with the sets (2 to 4 bits a shingle).
   Whole sets move for the pairs that are left after that. Then the pivots leave the region. Rounds end when no region holds two
   components. A region costs a bounded number of pairs for each member in a round, and a group of near copies is connected
   after a few rounds without all its pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import LOWER, UPPER
from .graph import components

#: Ratio of the largest to the smallest set size of a band.
BAND = 1.4
#: Ids and regions are broadcast up to this many (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS, BROADCAST_REGIONS = 2_000_000, 6_000_000
#: Counters of the shingle sketch (by the top 16 bits of the hash).
SKETCH = 1 << 16
#: Longs of a set's digest: 16 slices each, 4 bits of content a slice.
DIGEST = 16
#: Pivots that a region takes in the first rounds, and in each later one.
PIVOTS = (16, 64, 256)
#: Bytes of text hashed at a time (a longer text is alone).
CHUNK = 400_000
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_U = np.uint64
_FIRST = np.ones(1, bool)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A 64-bit number for each byte, the same for a letter's two cases, and the base that positions count in.
_BYTES = _mixed(np.frombuffer(bytes(range(256)).translate(_FOLD), np.uint8).astype(_U) + _U(1))
_BASE = 0x9E3779B97F4A7C15


class Shingler:
    """Texts to sorted sets of 64-bit shingle hashes, some hundred kilobytes of text at a time.

    A word's hash is the polynomial of its bytes' numbers: the difference of two running sums over the whole chunk, divided
    by the base to the power of the word's position."""

    def __init__(self, n_words: int):
        self.n_words = n_words
        self.powers = self.inverse = np.zeros(0, _U)

    def _words(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' hashes, one text after another, and each text's number of words."""
        buf = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
        if len(self.powers) < len(buf):
            room = len(buf) + len(buf) // 4
            self.powers, self.inverse = (np.cumprod(np.full(room, x, _U), dtype=_U) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[buf], [True]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[buf] * self.powers[:len(buf)], dtype=_U)])
        h = _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(_U))
        text_ends = np.cumsum([len(r) + 1 for r in raws])
        return h, np.diff(np.concatenate([[0], np.searchsorted(starts, text_ends)]))

    def _runs(self, h: np.ndarray, n: int) -> np.ndarray:
        """The hash of the ``n`` words from each position on."""
        out = np.full(max(len(h) - n + 1, 0), n, _U)
        for i in range(n):
            out = _mixed(out + h[i:len(h) - n + i + 1])
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sets of many texts."""
        out, held, size = [], [], 0
        for t in texts:
            raw = (t or "").encode()
            if held and size + len(raw) > CHUNK:
                out += self._sets(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw)
        return out + self._sets(held) if held else out

    def _sets(self, raws: list[bytes]) -> list[np.ndarray]:
        h, lengths = self._words(raws)
        ends = np.cumsum(lengths)
        n = self.n_words
        runs = self._runs(h, n)
        inside = np.ones(len(runs), bool)  # runs that don't reach into the next text
        for i in range(1, n):
            at = ends - i
            inside[at[(at >= 0) & (at < len(runs))]] = False
        for a, b in zip(ends - lengths, ends, strict=True):
            if b - a < n:  # a short text
                inside[a:b] = False
        runs = runs[inside]
        sizes = np.maximum(lengths - n + 1, 0)
        last = np.cumsum(sizes)
        out = []
        for a, b, words, end in zip((last - sizes).tolist(), last.tolist(), lengths.tolist(), ends.tolist(), strict=True):
            if b > a:
                own = runs[a:b]
                own.sort()
                if b - a > 1:
                    own = own[np.concatenate([_FIRST, own[1:] != own[:-1]])]
            elif words:  # fewer words than a shingle has: all of them as one
                own = self._runs(h[end - words:end], words)
            else:
                own = runs[:0]
            out.append(own)
        return out


class Regions:
    """The regions of a set for the threshold pct / 100."""

    def __init__(self, pct: int):
        self.pct = pct
        self.bands: dict[int, list[tuple]] = {}
        self.largest = [1]
        while self.largest[-1] < 1 << 40:
            self.largest.append(max(self.largest[-1] + 1, math.ceil(self.largest[-1] * BAND)))

    def _bands(self, n: int) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """Band, slices, empty slices allowed, the slices' edges and names, for each band that a set of n may meet."""
        first = int(np.searchsorted(self.largest, n))
        last = int(np.searchsorted(self.largest, n * 100 // self.pct))
        out = []
        for band in range(first, last + 1):
            differing = 2 * self.largest[band] * (100 - self.pct) // (100 + self.pct)
            if differing:  # else only equal sets link
                empty = 1 + differing // 12
                slices = differing + 1 + empty
                edges = np.array([(i << 64) // slices for i in range(1, slices)], _U)
                salt = _mixed(np.arange(slices, dtype=_U) + _U(band << 32))
                out.append((band, slices, empty, edges, salt))
        return out

    def __call__(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        if not n:
            return s
        if n not in self.bands:
            if len(self.bands) > 5000:
                self.bands.clear()
            self.bands[n] = self._bands(n)
        out = []
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mixed(s), dtype=_U)])
        for band, slices, empty, edges, salt in self.bands[n]:
            at = np.concatenate([[0], np.searchsorted(s, edges), [n]])
            full = np.flatnonzero(at[1:] > at[:-1])
            content = sums[at[1:][full]] - sums[at[:-1][full]]
            out.append(_mixed(content ^ salt[full]))
            if slices - len(full) > empty:
                prefix = n - -(-n * self.pct // 100) + 1
                out.append(_mixed(s[:prefix] ^ _U(0x9E3779B97F4A7C15 + (band << 8) + 1)))
        return np.concatenate(out) if out else s[:0]


def _sets_of(docs: DataFrame, n_words: int, id_col: str, text_col: str, schema: T.StructType, columns) -> DataFrame:
    """One Arrow pass over ``docs``: ``columns`` gets the ids and the sets of up to 500 texts and returns a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n_words)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays(columns(part.column(0), shingler(part.column(1).to_pylist())),
                                                 names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _listed(sets: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*sets, np.zeros(0, _U)]).astype(_U).view(np.int64)))


def set_digests(docs: DataFrame, n_words: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` (set size), ``d1`` and ``d2`` (a 128-bit digest of the set)."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n", "d1", "d2"))])

    def columns(ids, sets):
        digest = [np.array([xxhash.xxh64_intdigest(s.tobytes(), seed) for s in sets], _U).view(np.int64) for seed in (0, 1)]
        return [ids, pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, digest)]

    return _sets_of(docs, n_words, id_col, text_col, schema, columns)


def shingle_sets(docs: DataFrame, n_words: int, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``shingles``, the sorted set."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))])
    return _sets_of(docs, n_words, id_col, text_col, schema, lambda ids, sets: [ids, _listed(sets)])


def top_regions(docs: DataFrame, n_words: int, pct: int, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``regions``, the set's top-level regions."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("regions", T.ArrayType(T.LongType()))])
    regions = []

    def columns(ids, sets):
        if not regions:
            regions.append(Regions(pct))
        return [ids, _listed([regions[0](s) for s in sets])]

    return _sets_of(docs, n_words, id_col, text_col, schema, columns)


def _active(docs: DataFrame, n_words: int, pct: int, id_col: str, text_col: str) -> DataFrame:
    """``rep`` of the documents that share a top-level region with another one. Regions are computed twice, to be counted
    and to be looked up, and never written."""
    rows = top_regions(docs, n_words, pct, id_col, text_col)
    counted = rows.select(F.explode("regions").alias("region")).groupBy("region").agg(F.count(F.lit(1)).alias("m"))
    shared = materialize(counted.where("m > 1").select("region"), "regions")
    if shared.count() > BROADCAST_REGIONS:
        member = rows.select(F.col("id").alias("rep"), F.explode("regions").alias("region"))
        return materialize(member.join(shared, "region", "left_semi").select("rep").distinct(), "active")
    known = np.sort(shared.toArrow()["region"].to_numpy().view(_U))
    shipped = docs.sparkSession.sparkContext.broadcast(known)
    schema = T.StructType([T.StructField("rep", docs.schema[id_col].dataType)])
    regions = []

    def columns(ids, sets):
        if not regions:
            regions.append(Regions(pct))
        known = shipped.value
        hit = []
        for s in sets:
            r = regions[0](s)
            at = np.minimum(np.searchsorted(known, r), len(known) - 1) if len(known) else r[:0]
            hit.append(bool(len(at)) and bool((known[at] == r).any()))
        return [ids.filter(pa.array(hit))]

    return materialize(_sets_of(docs, n_words, id_col, text_col, schema, columns).distinct(), "active")


def _fine(h: np.ndarray) -> np.ndarray:
    """The sums modulo 16 of the scrambled shingles of 2^k slices of the hash space, two to a byte; at least half as many slices
    as shingles. Sums of neighbouring slices add up, so a digest can be halved."""
    k = max(8, (max(len(h) - 1, 1) >> 1).bit_length())
    slot = (h >> _U(64 - k)).astype(np.int64)
    sums = np.bincount(slot, weights=(_mixed(h) & _U(15)).astype(np.float64), minlength=1 << k).astype(np.int64) & 15
    return (sums[::2] | sums[1::2] << 4).astype(np.uint8)


def _halved(fine: np.ndarray) -> np.ndarray:
    sums = (fine & 15) + (fine >> 4) & 15
    return sums[::2] | sums[1::2] << 4


def _fine_differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many slices two digests differ, at the coarser one's number of slices."""
    while len(a) > len(b):
        a = _halved(a)
    while len(b) > len(a):
        b = _halved(b)
    other = a ^ b
    return int(np.count_nonzero(other & 15) + np.count_nonzero(other >> 4))


def _bounded(pairs: DataFrame, digests: DataFrame, pct: int) -> DataFrame:
    """``x``, ``p``, ``low``, a lower bound of their distance by their digests, and ``near``: the bound lets them link."""
    def of(side: str) -> DataFrame:
        return digests.select(F.col("rep").alias(side), F.col("n").alias(f"n{side}"), F.col("fine").alias(f"f{side}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = ([np.frombuffer(v, np.uint8) for v in batch.column(i).to_pylist()] for i in (3, 4))
            differing = np.fromiter(map(_fine_differing, own, other), np.int64, batch.num_rows)
            both = batch.column(2).to_numpy()
            low = 2 * differing / (both + differing)  # difference / union, which is half of both and the difference
            near = differing * (100 + pct) <= both * (100 - pct)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low), pa.array(near)], names=schema.names)

    joined = pairs.join(of("p"), "p").join(of("x"), "x").select("x", "p", (F.col("nx") + F.col("np")).alias("both"), "fx", "fp")
    schema = T.StructType([*joined.select("x", "p").schema, T.StructField("low", T.DoubleType()), T.StructField("near", T.BooleanType())])
    return joined.mapInArrow(run, schema)


def _meet(pairs: DataFrame, sets: DataFrame, digests: DataFrame, pct: int) -> DataFrame:
    """``x``, ``p``, bounds ``low`` and ``high`` of their distance, and whether they ``link``. Pairs that their digests don't rule out
    meet by their whole sets (both bounds are the distance then), and only the sets of these pairs move."""
    bounded = materialize(_bounded(pairs.select("x", "p"), digests, pct), "bounded")
    ruled_out = bounded.where(~F.col("near")).select("x", "p", "low", F.lit(1.0).alias("high"), F.lit(False).alias("link"))
    pairs = bounded.where("near").select("x", "p")
    few = pairs.count() <= BROADCAST_IDS

    def of(side: str, name: str) -> DataFrame:
        ids = pairs.select(side).distinct()
        ids = F.broadcast(ids) if few else ids
        return sets.join(ids, F.col("id") == F.col(side), "left_semi").select(F.col("id").alias(side), F.col("shingles").alias(name))

    joined = pairs.join(of("p", "sp"), "p").join(of("x", "sx"), "x")
    common = F.size(F.array_intersect("sx", "sp")).cast("long").alias("common")
    joined = joined.select("x", "p", common, (F.size("sx") + F.size("sp")).cast("long").alias("both"))
    union = F.col("both") - F.col("common")
    distance = 1 - F.col("common") / union
    met = joined.select("x", "p", distance.alias("low"), distance.alias("high"), (100 * F.col("common") >= pct * union).alias("link"))
    return met.unionByName(ruled_out)


def _sketch(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each counter; tasks hand on their own counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            h = batch.column(0).flatten().to_numpy().view(_U)
            total += np.bincount((h >> _U(48)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["counter", "n"])

    rows = sets.select("shingles").mapInArrow(run, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SKETCH, np.int64)
    out[rows["counter"].to_numpy()] = rows["n"].to_numpy()
    return out


def _rare_first(sets: DataFrame, pct: int) -> DataFrame:
    """``region`` (a shingle), ``rep`` and ``n`` for the first shingles of each set in the sketch's order."""
    shipped = sets.sparkSession.sparkContext.broadcast(_sketch(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shipped.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                lengths = part.column(1).value_lengths().to_numpy()
                h = part.column(1).flatten().to_numpy().view(_U)
                first, sizes = [], []
                for a, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
                    own = h[a:a + n]
                    sizes.append(int(n) - -(-int(n) * pct // 100) + 1)
                    first.append(own[np.lexsort((own, count[(own >> _U(48)).astype(np.int64)]))[:sizes[-1]]])
                owner = np.repeat(np.arange(part.num_rows), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(first).view(np.int64)), part.column(0).take(pa.array(owner)), pa.array(lengths[owner].astype(np.int64))],
                    names=["region", "rep", "n"])

    schema = T.StructType([T.StructField("region", T.LongType()), T.StructField("rep", sets.schema["id"].dataType),
                           T.StructField("n", T.LongType())])
    return sets.select("id", "shingles").mapInArrow(run, schema)


def _digests(sets: DataFrame) -> DataFrame:
    """``rep``, ``n`` (set size), ``fine`` (see ``_fine``) and ``g0``, ``g1``, ...: 4 bits of the content of each of 16 * DIGEST slices
    of the hash space."""
    slices = 16 * DIGEST
    edges = np.array([(i << 64) // slices for i in range(1, slices)], _U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = _U(4) * np.arange(16, dtype=_U)
        for batch in batches:
            out = np.zeros((batch.num_rows, DIGEST), _U)
            fine = []
            for i, own in enumerate(batch.column(1)):
                h = own.values.to_numpy().view(_U)
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mixed(h), dtype=_U)])
                at = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
                bits = _mixed(sums[at[1:]] - sums[at[:-1]]) >> _U(60)
                out[i] = (bits.reshape(DIGEST, 16) << shift).sum(1, dtype=_U)
                fine.append(_fine(h).tobytes())
            n = batch.column(1).value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(fine, pa.binary()),
                                              *(pa.array(out[:, j].view(np.int64)) for j in range(DIGEST))], names=schema.names)

    schema = T.StructType([T.StructField("rep", sets.schema["id"].dataType), T.StructField("n", T.LongType()), T.StructField("fine", T.BinaryType()),
                           *(T.StructField(f"g{j}", T.LongType()) for j in range(DIGEST))])
    return sets.select("id", "shingles").mapInArrow(run, schema)


def _differing(other: str) -> Column:
    """In how many slices the digests g0, g1, ... and those of the name ``other`` differ."""
    out = F.lit(0)
    for j in range(DIGEST):
        x = F.col(f"g{j}").bitwiseXOR(F.col(f"{other}{j}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        out = out + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def _shared(member: DataFrame) -> DataFrame:
    """The members of regions with more than one, and each region's smallest member ``p``; written."""
    shared = member.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("p")).where("m > 1").select("region", "p")
    return materialize(member.join(shared, "region").select("region", "rep", "n", "p"), "members")


def near_components(docs: DataFrame, n_words: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` (long) and ``component_id``, one row for each row of ``docs``.

    A set holds the distinct runs of ``n_words`` words (fewer words: all as one run), A-Z lower-cased, words between
    ASCII white space. Two rows link when 100 * intersection >= ``pct`` * union. A component's id is the
    smallest doc_id in it. Rows without words are linked with nothing. A null id has a null component and
    takes no part. Rows with the same id are one document; if their texts differ, one of its sets (the smallest, compared as
    sorted lists) stands for it in links.
    """
    found = materialize(set_digests(docs, n_words, id_col, text_col), "sets")
    known = found.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = materialize(known.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "classes")
    # all but one document of each class of equal sets, and those that take no part, are left out from here on
    others = known.select("id", "d1", "d2").join(classes, ["d1", "d2"]).where("id <> rep").select(F.col("id").alias("other"))
    others = others.unionByName(found.where("n = 0 and id is not null").select(F.col("id").alias("other"))).distinct()
    others = materialize(others.join(classes, F.col("other") == F.col("rep"), "left_anti"), "others")
    single = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    single = single.join(F.broadcast(others) if others.count() <= BROADCAST_IDS else others, F.col("id") == F.col("other"), "left_anti")
    active = _active(single, n_words, pct, "id", "text")
    repeated = known.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id")
    links = _links(docs, active, materialize(repeated, "repeated"), n_words, pct, id_col, text_col)
    reps = classes.select("d1", "d2", "rep")
    if links is not None:
        labels = links.select(F.col("node").alias("rep"), "label")
        reps = reps.join(labels, "rep", "left").select("d1", "d2", F.coalesce("label", "rep").alias("rep"))
    slim = found.select("id", "n", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("d1")).alias("d1"), "d2")
    out = slim.join(reps, ["d1", "d2"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("rep", "id").alias("component_id"))


def _links(docs: DataFrame, active: DataFrame, repeated: DataFrame, n_words: int, pct: int, id_col: str, text_col: str) -> DataFrame | None:
    """Component labels of the representatives in ``active``, None without any link. ``repeated`` has the ids of several rows."""
    n_active = active.count()
    if not n_active:
        return None
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(
        F.broadcast(active) if n_active <= BROADCAST_IDS else active, F.col("doc") == F.col("rep"))
    sets = materialize(shingle_sets(texts, n_words, "doc", "text"), "shingles")
    if not repeated.isEmpty():  # other sets don't move
        one = sets.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("shingles").alias("shingles"))
        sets = materialize(sets.join(repeated, "id", "left_anti").unionByName(one), "shingles")
    digests = materialize(_digests(sets), "digests")
    member = _shared(_rare_first(sets, pct))
    size = digests.select("rep", "n")
    r = 1 - pct / 100

    # every document meets its smallest pivot of a fitting size: its home
    first = member.where("rep <> p").select(F.col("rep").alias("x"), "n", "p").distinct()
    fits = lambda a, b: (100 * F.col(a) >= pct * F.col(b)) & (100 * F.col(b) >= pct * F.col(a))
    first = first.join(size.select(F.col("rep").alias("p"), F.col("n").alias("np")), "p").where(fits("n", "np"))
    first = first.groupBy("x").agg(F.min("p").alias("p"))
    met = materialize(_meet(first, sets, digests, pct), "met")
    homes = met.select(F.col("x").alias("rep"), F.col("p").alias("home"), "low", "high")
    at_home = homes.select(F.col("home").alias("rep"), "home", F.lit(0.0).alias("low"), F.lit(0.0).alias("high")).distinct()
    homes = homes.unionByName(at_home.join(homes.select("rep"), "rep", "left_anti"))
    homes = materialize(homes, "homes")
    links = materialize(met.where("link").select(F.col("x").alias("a"), F.col("p").alias("b")), "links")
    tested = met.select("x", "p")
    left = member.select("region", "rep", "n")
    names = [f"g{j}" for j in range(DIGEST)]
    labels = components(links)
    for k in itertools.count():
        named = left.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
        named = named.select("region", "rep", "n", F.coalesce("label", "rep").alias("label"))
        mixed = named.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("region")
        left = materialize(named.join(mixed, "region"), "left")
        if left.isEmpty():
            return labels
        # the next pivots: components with large labels first, so that single documents come before the groups they may belong to
        rank = F.row_number().over(Window.partitionBy("region").orderBy(F.col("label").desc(), F.col("rep").desc()))
        pivots = left.withColumn("rank", rank).where(F.col("rank") <= PIVOTS[min(k, len(PIVOTS) - 1)]).select(
            F.col("region").alias("of"), F.col("rep").alias("q"), F.col("label").alias("q_label"), F.col("n").alias("nq"))
        pivots = materialize(pivots.join(digests.select(F.col("rep").alias("q"), *[F.col(g).alias(f"q_{g}") for g in names]), "q"), "pivots")
        near = _differing("q_g") <= F.floor((100 - pct) * (F.col("n") + F.col("nq")) / (100 + pct))
        pairs = left.join(digests.select("rep", *names), "rep").join(pivots, (F.col("region") == F.col("of")) & (F.col("label") != F.col("q_label"))
                                               & fits("n", "nq") & near)
        pairs = pairs.select(F.greatest("rep", "q").alias("x"), F.least("rep", "q").alias("p")).distinct()
        of_x, of_p = (homes.select(F.col("rep").alias(s), F.col("home").alias(f"h{s}"), F.col("low").alias(f"low_{s}"),
                                   F.col("high").alias(f"high_{s}")) for s in ("x", "p"))
        apart = F.greatest(F.col("low_x") - F.col("high_p"), F.col("low_p") - F.col("high_x"))
        far = (F.col("hx") == F.col("hp")) & (apart > r + 1e-9)
        pairs = pairs.join(of_x, "x", "left").join(of_p, "p", "left").where(~F.coalesce(far, F.lit(False))).select("x", "p")
        met = materialize(_meet(pairs.join(tested, ["x", "p"], "left_anti"), sets, digests, pct), "met")
        tested = tested.unionByName(met.select("x", "p"))
        new = met.where("link").select(F.col("x").alias("a"), F.col("p").alias("b"))
        if not new.isEmpty():
            links = links.unionByName(new)
            labels = components(links)
        left = left.join(pivots, (F.col("region") == F.col("of")) & (F.col("rep") == F.col("q")), "left_anti").select("region", "rep", "n")
