"""Language identification by prediction by partial matching (PPM) over bytes.

A language's model is a variable-order context tree: for each context of up to ``DEPTH`` bytes, which bytes
followed it and how often. A byte is coded in the longest context of the tree that has been seen; if it
hasn't followed there, an escape is coded and the next shorter context is tried, down to 1/256. With n
followers of which t are different, a byte met c times gets c/(n+t) and the escape t/(n+t). The counts are
frozen after training, so a text's code length under a language is a sum over its bytes, and the language
with the shortest code wins.

Training takes a bounded sample: ``sample_docs`` documents for each language, however many there are. Spark counts the sample's
n-grams; the merged trees are shipped to the workers, those of ``GROUP_LANGS`` languages at a time. Every text is then
scored whole in one Arrow pass a group, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ngrams
from .common import free_name

#: Longest context in bytes.
DEPTH = 3
#: Languages whose trees are held at a time; with more of them the texts pass by once for each group.
GROUP_LANGS = 64
#: Ids of a sample are broadcast up to this many (with their languages); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def is_held_out(id_col: Column) -> Column:
    """Whether crc32 of the id's text has remainder 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, sample_docs: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang`` and ``text`` of up to ``sample_docs`` documents (by the hash of their id) of each language.

    Held-out documents, null ids, null languages and null texts take no part."""
    usable = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() &
                        ~is_held_out(F.col(id_col)))
    slim = usable.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("_sample_id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("_sample_id"), "_sample_id"))
    chosen = slim.withColumn("rank", rank).where(F.col("rank") <= sample_docs).select("lang", "_sample_id").distinct()
    chosen = materialize(chosen, "sample")
    texts = usable.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("text"))
    few = chosen.count() <= BROADCAST_IDS
    return texts.join(F.broadcast(chosen) if few else chosen, (F.col("_id") == F.col("_sample_id")) & (F.col("_lang") == F.col("lang"))).select("lang", "text")


def count_contexts(sample: DataFrame) -> DataFrame:
    """``lang``, ``order`` (1 to DEPTH + 1), ``key`` (context and byte) and ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for _, raws in ngrams.chunks([t for x, t in zip(langs, texts, strict=True) if x == lang]):
                    key = ngrams.keys(raws, DEPTH + 1)[0]
                    for order in range(1, DEPTH + 2):
                        found, n = ngrams.counted(np.sort(key & np.uint64((1 << 8 * order) - 1)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), order, np.int32)),
                             pa.array(found.view(np.int64)), pa.array(n)], names=["lang", "order", "key", "n"])

    return sample.mapInArrow(run, "lang string, order int, key long, n long").groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))


class Trees:
    """All languages' context trees as tables over the n-grams that any of them has."""

    def __init__(self, langs: list[str], rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """rows: by order the keys, the numbers of their languages and their counts."""
        self.langs = langs
        wide = len(langs)
        self.index: dict[int, ngrams.Index] = {}
        self.cost: dict[int, np.ndarray] = {}
        self.contexts: dict[int, ngrams.Index] = {}
        self.escape: dict[int, np.ndarray] = {}
        for order in range(1, DEPTH + 2):
            key, lang, n = rows[order]
            distinct, at = np.unique(key, return_inverse=True)
            count = np.zeros((len(distinct), wide))
            count[at, lang] = n
            context, where = np.unique(distinct >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(context), wide)), np.zeros((len(context), wide))
            np.add.at(total, where, count)
            np.add.at(kinds, where, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):  # an unseen context escapes at no cost
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
                cost = -np.log2(count / (total + kinds)[where])
            lower = np.full((len(distinct), wide), 8.0) if order == 1 else self.costs(distinct, order - 1)
            cost = np.where(count > 0, cost, escape[where] + lower)
            self.index[order], self.cost[order] = ngrams.Index(distinct), cost.astype(np.float32)
            self.contexts[order], self.escape[order] = ngrams.Index(context), escape.astype(np.float32)

    def costs(self, key: np.ndarray, order: int = DEPTH + 1) -> np.ndarray:
        """Bits of the last byte of each n-gram after its context, for each language."""
        if order == 0:
            return np.full((len(key), len(self.langs)), 8.0, np.float32)
        key = key & np.uint64((1 << 8 * order) - 1)
        row = self.index[order].find(key)
        out = self.cost[order][row]
        miss = np.flatnonzero(row < 0)
        if len(miss):
            rest = key[miss]
            context = self.contexts[order].find(rest >> np.uint64(8))
            escape = np.where((context >= 0)[:, None], self.escape[order][context], np.float32(0))
            out[miss] = escape + self.costs(rest, order - 1)
        return out


def train(docs: DataFrame, sample_docs: int = 400, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], DataFrame]:
    """Every language with usable documents (sorted) and the counts of their contexts, from ``training_sample``."""
    counts = materialize(count_contexts(training_sample(docs, sample_docs, id_col, text_col, lang_col)), "contexts")
    return sorted(r["lang"] for r in counts.select("lang").distinct().collect()), counts


def _arrays(counts: DataFrame, langs: list[str]) -> dict:
    """The counts of some languages by order: keys, the languages' numbers, counts. Their size is bounded by the sample."""
    rows = counts.where(F.col("lang").isin(langs)).toArrow()
    number = {x: i for i, x in enumerate(langs)}
    lang = np.array([number[x] for x in rows["lang"].to_pylist()], np.int64)
    order, key, n = rows["order"].to_numpy(), rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    return {k: (key[order == k], lang[order == k], n[order == k]) for k in range(1, DEPTH + 2)}


def identify(docs: DataFrame, model: tuple[list[str], DataFrame], text_col: str = "text", drop_text: bool = False,
             group_langs: int = GROUP_LANGS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the winner in 2^(-code length / 16), from 0 to 1.

    Any number of languages: ``group_langs`` of them are scored at a time, and the shortest code of all wins. A text that is null or
    has no letter gives ``und`` and score 0; so does every text without a learned language. Ties go to the smaller name.
    Only the text is read. Columns of the result's names are replaced; repeated rows get equal results.
    """
    out = ["lang_pred", "score"]
    docs = docs.select(*(c for c in docs.columns if c.lower() not in out))
    kept = [c for c in docs.columns if not (drop_text and c == text_col)]
    langs, counts = model
    bits, total = free_name(docs, "_bits"), free_name(docs, "_total")
    scored = docs
    for a in range(0, len(langs), group_langs):
        scored = _scored(scored, langs[a:a + group_langs], counts, text_col, bits, total, first=not a)
    if not langs:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return scored.select(*kept, F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
                         F.when(F.col("lang_pred").isNotNull(), 1 / F.col(total)).otherwise(0.0).alias("score"))


def _scored(docs: DataFrame, langs: list[str], counts: DataFrame, text_col: str, bits: str, total: str, first: bool) -> DataFrame:
    """``docs`` with the best language up to this group, its code length, and the sum of all languages' shares against it."""
    shipped = docs.sparkSession.sparkContext.broadcast(_arrays(counts, langs))
    rest = [c for c in docs.columns if c not in ("lang_pred", bits, total)]
    at = [docs.columns.index(c) for c in rest]
    text_at = docs.columns.index(text_col)
    found = [T.StructField("lang_pred", T.StringType()), T.StructField(bits, T.DoubleType()), T.StructField(total, T.DoubleType())]
    schema = T.StructType([*(docs.schema[c] for c in rest), *found])
    before = None if first else [docs.columns.index(f.name) for f in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(langs, shipped.value)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            name, best, share = ([None] * len(texts) for _ in range(3)) if first else (batch.column(i).to_pylist() for i in before)
            for start, raws in ngrams.chunks(texts):
                code = _totals(trees, raws)
                least = code.min(1)
                own = np.exp2((least[:, None] - code) / 16).sum(1)
                for i in range(len(raws)):
                    k = start + i
                    if not raws[i] or not _LETTER.search(texts[k]):
                        continue
                    if name[k] is None or least[i] < best[k]:
                        kept = 0.0 if name[k] is None else share[k] * 2 ** ((least[i] - best[k]) / 16)
                        name[k], best[k], share[k] = langs[int(code[i].argmin())], float(least[i]), float(own[i]) + kept
                    else:
                        share[k] += float(own[i]) * 2 ** ((best[k] - least[i]) / 16)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), pa.array(name, pa.string()), pa.array(best, pa.float64()),
                                              pa.array(share, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _totals(trees: Trees, raws: list[bytes]) -> np.ndarray:
    """Code lengths of the texts: bytes are costed a million at a time, and summed by text."""
    key, lengths = ngrams.keys(raws, DEPTH + 1)
    if not len(key):
        return np.zeros((len(raws), len(trees.langs)))
    text = np.repeat(np.arange(len(raws)), lengths)
    total = np.zeros((len(raws), len(trees.langs)))
    for a in range(0, len(key), 1_000_000):
        cost, of = trees.costs(key[a:a + 1_000_000]), text[a:a + 1_000_000]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        total[of[starts]] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
    return total
