"""Quality classifier: an interpolated modified Kneser-Ney model of bytes, trained on trusted texts.

1. One Arrow pass over all texts counts byte n-grams (order ``ORDER``): how often each occurs in the trusted
   training texts (0 for n-grams found elsewhere only). Spark sums the tasks' counts.
2. Continuation counts of the lower orders, discounts (from counts of counts), context totals and back-off
   weights are aggregates and equi-joins of n-gram tables, from order 1 up, each order's written for the next. They end in
   one table with the log-probability of every n-gram of the corpus.
3. That table is hashed into shards of about ``SHARD`` n-grams, each small enough to ship, and each shard
   gives every document the part of its code length that lies in it.
4. A language's limit is its median plus ``margin`` times the distance from there to its ``q`` quantile,
   over held-back trusted documents (a quarter of them, by id), from a histogram of bits per byte. Both are
   drawn towards those of all languages, the less the more such documents the language has.

Counting and scoring touch whole texts of all documents and move n-gram rows and scores, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ngrams
from .common import free_name

ORDER = 5
#: N-grams of one shard (12 bytes each) and, in a counting task, distinct ones held before they are handed on.
SHARD, HELD = 2_000_000, 600_000
#: Trusted ids are broadcast up to this many (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Bits per byte of one histogram bin.
BIN = 0.001
#: A language with n held-back trusted documents has n / (n + MIN_CALIBRATION) of its own limit and the rest of that of all
#: languages: the 0.99 quantile of 200 documents rests on two of them.
MIN_CALIBRATION = 200
#: Limits are broadcast up to this many languages; more are joined by a shuffle.
BROADCAST_LANGS = 100_000
#: Bytes at the language's typical rate that are added to each text, so that short ones aren't judged on noise.
PRIOR_BYTES = 100


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic. A null label is neither; contradicting labels don't make trust."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    by_id = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("ok"))
    return by_id.where("ok").select("doc_id")


def _marked(docs: DataFrame, trusted: DataFrame, n_trusted: int, id_col: str, name: str) -> DataFrame:
    """``docs`` with ``name``: 0 not trusted, 1 trusted for training, 2 trusted and held back."""
    tid = free_name(docs, "_trusted_id")
    ids = trusted.select(F.col("doc_id").alias(tid))
    joined = docs.join(F.broadcast(ids) if n_trusted <= BROADCAST_IDS else ids, F.col(id_col) == F.col(tid), "left")
    held_back = F.pmod(F.xxhash64(F.col(tid)), F.lit(4)) == 0
    mark = F.when(F.col(tid).isNull(), 0).when(held_back, 2).otherwise(1)
    return joined.withColumn(name, mark.cast("int")).drop(tid)


def count_ngrams(docs: DataFrame, text_col: str, mark_col: str) -> DataFrame:
    """``key`` of every n-gram of the corpus and ``n``, its count in the texts marked 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

        def merged(parts):
            both = np.concatenate([p[0] for p in parts])
            amount = np.concatenate([p[1] for p in parts])
            at = both.argsort(kind="stable")
            both, amount = both[at], amount[at]
            first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
            return both[first], np.add.reduceat(amount, first) if len(first) else amount

        held, size = [], 0  # counted chunks that aren't merged yet
        for batch in batches:
            texts, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for train in (True, False):
                for _, raws in ngrams.chunks([t for t, m in zip(texts, marks, strict=True) if (m == 1) == train]):
                    found = ngrams.keys(raws, ORDER)[0]
                    found.sort()
                    found, times = ngrams.counted(found)
                    held.append((found, times if train else np.zeros(len(found), np.int64)))
                    size += len(found)
                    if size > HELD:
                        key, n = merged([(key, n), *held])
                        held, size = [], 0
                        if len(key) > HELD:
                            yield rows()
                            key, n = key[:0], n[:0]
        key, n = merged([(key, n), *held])
        yield rows()

    counts = docs.select(F.col(text_col).alias("text"), F.col(mark_col).alias("mark")).mapInArrow(run, "key long, n long")
    return counts.groupBy("key").agg(F.sum("n").alias("n"))


def _suffix(order: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << 8 * order) - 1))


def _context() -> Column:
    return F.shiftrightunsigned("key", 8).alias("ctx")


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``key`` and ``logp`` (log2, float) for every n-gram of ``counts`` under the model of its training counts.

    Without any training counts every byte has probability 1/256.
    """
    seen, corpus = {ORDER: counts.where("n > 0").select("key", F.col("n").alias("c"))}, {ORDER: counts.select("key")}
    for k in range(ORDER - 1, 0, -1):  # how many different bytes come before: the lower orders' counts
        seen[k] = seen[k + 1].groupBy(_suffix(k).alias("key")).agg(F.count(F.lit(1)).alias("c"))
        corpus[k] = materialize(corpus[k + 1].select(_suffix(k).alias("key")).distinct(), f"corpus{k}")
    seen = {k: materialize(v, f"seen{k}") for k, v in seen.items()}
    tallies = None
    for k, v in seen.items():
        row = v.agg(F.lit(k).alias("k"), *(F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)))
        tallies = row if tallies is None else tallies.unionByName(row)
    discounts = {r["k"]: _discounts(r["n1"], r["n2"], r["n3"], r["n4"]) for r in tallies.collect()}

    below = None
    for k in range(1, ORDER + 1):
        d = F.element_at(F.array(*map(F.lit, discounts[k])), F.least(F.col("c"), F.lit(3)).cast("int"))
        contexts = seen[k].select(_context(), "c", d.alias("d")).groupBy("ctx").agg(
            F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("backoff"))
        rows = corpus[k].select("key", _context(), _suffix(k - 1).alias("low"))
        rows = rows.join(seen[k].select("key", "c", d.alias("d")), "key", "left").join(contexts, "ctx", "left")
        if below is None:
            lower = F.lit(1 / 256)
        else:
            rows = rows.join(below, "low")
            lower = F.col("lower")
        own = F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0))
        p = (own + F.coalesce(F.col("backoff"), F.lit(1.0)) * lower).alias("p")
        below = rows.select(F.col("key").alias("low"), p.alias("lower"))
        if k < ORDER:  # a plan for each order: the driver plans one anew whenever a stage of it ends
            below = materialize(below, f"below{k}")
    return below.select(F.col("low").alias("key"), F.log2("lower").cast("float").alias("logp"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more; plain values where counts of counts are missing."""
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.01), i + 0.99) for i, x in enumerate(raw)]


def code_lengths(docs: DataFrame, model: DataFrame, text_col: str, bits: str, size: str) -> DataFrame:
    """``docs`` with ``bits`` (double, code length of the text under ``model``) and ``size`` (long, its bytes).

    ``model`` has ``log_probabilities`` of every n-gram of these documents.
    """
    n_shards = -(-model.count() // SHARD) or 1
    if n_shards == 1:
        return _score(docs, model, 1, 0, text_col, bits, size)
    # each shard scans the texts and gives the part of every distinct text's code length that lies in it
    h1, h2 = (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h1"),
              F.xxhash64(F.lit("b"), F.coalesce(F.col(text_col), F.lit(""))).alias("h2"))
    texts = docs.select(F.col(text_col).alias("text"), h1, h2)
    parts = [materialize(_score(texts, model, n_shards, i, "text", "bits", "size").groupBy("h1", "h2").agg(
        F.max("bits").alias("bits"), F.max("size").alias("size")), "shard") for i in range(n_shards)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    whole = whole.groupBy("h1", "h2").agg(F.sum("bits").alias(bits), F.max("size").alias(size))
    keys = [free_name(docs, "_text_key1"), free_name(docs, "_text_key2")]
    whole = whole.withColumnsRenamed(dict(zip(["h1", "h2"], keys, strict=True)))
    return docs.withColumns({keys[0]: h1, keys[1]: h2}).join(whole, keys, "left").drop(*keys)


def _score(docs: DataFrame, model: DataFrame, n_shards: int, shard: int, text_col: str, bits: str, size: str) -> DataFrame:
    part = model.where(F.pmod(F.hash("key"), F.lit(n_shards)) == shard) if n_shards > 1 else model
    rows = part.toArrow()
    key = rows["key"].to_numpy().view(np.uint64)
    at = np.argsort(key)
    shipped = docs.sparkSession.sparkContext.broadcast((key[at], rows["logp"].to_numpy()[at].astype(np.float32)))
    schema = T.StructType([*docs.schema, T.StructField(bits, T.DoubleType()), T.StructField(size, T.LongType())])
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, logp = shipped.value
        index = ngrams.Index(found)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):  # bounded output batches
                part = batch.slice(first, 500)
                total, length = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
                for start, raws in ngrams.chunks(part.column(column).to_pylist()):
                    k, lengths = ngrams.keys(raws, ORDER)
                    row = index.find(k)
                    value = np.where(row >= 0, logp[row], np.float32(0)) if len(found) else np.zeros(len(k))
                    total[start:start + len(raws)] = -ngrams.sums(value, lengths)
                    length[start:start + len(raws)] = lengths
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(total), pa.array(length)], names=schema.names)

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The model (``log_probabilities`` of all n-grams of ``docs``), the trusted ids and their number."""
    trusted = materialize(trusted_ids(labels), "trusted")
    n_trusted = trusted.count()
    mark = free_name(docs, "_mark")
    counts = count_ngrams(_marked(docs.select(id_col, text_col), trusted, n_trusted, id_col, mark), text_col, mark)
    return materialize(log_probabilities(materialize(counts, "ngrams")), "model"), trusted, n_trusted


def limits(scored: DataFrame, q: float, margin: float) -> DataFrame:
    """``pooled``, ``lang`` (null: all languages), ``typical`` and ``limit`` in bits per byte, from held-back trusted
    rows (``lang``, ``rate``): the median, and ``margin`` times its distance to the ``q`` quantile above it. A language
    with n rows has the weighted mean of its own values (n) and those of all languages (``MIN_CALIBRATION``)."""
    bins = scored.select("lang", F.round(F.col("rate") / BIN).cast("long").alias("bin"))
    bins = bins.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    every = bins.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "bin", "n", F.lit(True).alias("pooled"))
    bins = bins.where(F.col("lang").isNotNull()).withColumn("pooled", F.lit(False)).unionByName(every)
    up_to = F.sum("n").over(Window.partitionBy("pooled", "lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("pooled", "lang"))
    bins = bins.withColumn("up_to", up_to).withColumn("total", total)
    at = lambda x: F.min(F.when(F.col("up_to") >= F.lit(x) * F.col("total"), F.col("bin"))) * BIN
    own = bins.groupBy("pooled", "lang").agg(at(0.5).alias("typical"), at(q).alias("high"), F.max("total").alias("total"))
    own = own.select("pooled", "lang", "total", "typical", (F.col("typical") + margin * (F.col("high") - F.col("typical"))).alias("limit"))
    own = materialize(own, "own_limits")
    pooled = own.where("pooled").select(F.col("typical").alias("all_typical"), F.col("limit").alias("all_limit"))
    weight = F.when(F.col("pooled"), F.lit(1.0)).otherwise(F.col("total") / (F.col("total") + MIN_CALIBRATION))
    drawn = lambda c: (weight * F.col(c) + (1 - weight) * F.col(f"all_{c}")).alias(c)
    return own.crossJoin(F.broadcast(pooled)).select("pooled", "lang", drawn("typical"), drawn("limit"))  # pooled is one row


def classify(docs: DataFrame, labels: DataFrame, q: float = 0.99, margin: float = 2.0, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", slim: bool = False) -> DataFrame:
    """``docs`` with ``perplexity`` (per byte, double), ``max_perplexity`` (its language's limit) and ``keep``.

    ``slim`` leaves the text out, and scores each document once instead of twice. A null or empty text has no
    perplexity and isn't kept. A null language and one without held-back trusted documents take the limit of
    all languages; without any such document there is no limit and every non-empty text is kept. Null ids are scored but never
    trusted. Equal texts of one language are judged alike. Columns of the result's names are replaced.
    """
    out = ["perplexity", "max_perplexity", "keep"]
    docs = docs.select(*(c for c in docs.columns if c.lower() not in out))
    model, trusted, n_trusted = train(docs, labels, id_col, text_col)
    bits, size, mark = free_name(docs, "_bits"), free_name(docs, "_bytes"), free_name(docs, "_mark")
    scored = code_lengths(docs, model, text_col, bits, size)
    if slim:
        scored = materialize(scored.drop(text_col), "scored")
    rate = F.when(F.col(size) > 0, F.col(bits) / F.col(size))
    held_back = _marked(scored.select(id_col, F.col(lang_col).alias("lang"), bits, size), trusted, n_trusted, id_col, mark)
    held_back = held_back.where((F.col(mark) == 2) & (F.col(size) > 0)).select("lang", rate.alias("rate"))
    found = materialize(limits(held_back, q, margin), "limits")
    pooled = found.where("pooled").first()
    typical, limit = (pooled["typical"], pooled["limit"]) if pooled else (0.0, None)
    own = found.where("not pooled").select("lang", "typical", "limit").toDF(
        *(free_name(scored, c) for c in ("_limit_lang", "_typical", "_limit")))
    own_lang, own_typical, own_limit = (F.col(c) for c in own.columns)
    own = F.broadcast(own) if found.count() <= BROADCAST_LANGS else own  # a row for each language
    joined = scored.join(own, F.col(lang_col) == own_lang, "left")
    typical = F.coalesce(own_typical, F.lit(typical))
    limit = F.coalesce(own_limit, F.lit(limit).cast("double"))
    judged = (F.col(bits) + PRIOR_BYTES * typical) / (F.col(size) + PRIOR_BYTES)
    keep = (F.col(size) > 0) & F.coalesce(judged <= limit, F.lit(True))
    columns = [c for c in scored.columns if c not in (bits, size)]
    return joined.select(*columns, F.pow(F.lit(2.0), rate).alias("perplexity"),
                         F.pow(F.lit(2.0), limit).alias("max_perplexity"), keep.alias("keep"))
