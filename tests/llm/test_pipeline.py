"""The pipeline against a plain Python version of all its stages, and each stage on awkward tables."""

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from seriesguard.llm import bpe, quality

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_quality(docs, labels, q=0.99, margin=2.0):
    good = defaultdict(list)
    for x in labels:
        good[x["doc_id"]].append(x["quality"] == 1 and x["toxic"] == 0)
    trusted = {i for i, ok in good.items() if all(ok)}

    def held_back(i):
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
        return (h - (1 << 64) if h >> 63 else h) % 4 == 0

    n = quality.ORDER
    grams = lambda t: [(bytes(n - 1) + t)[i:i + n] for i in range(len(t))]
    raw = {x["doc_id"]: (x["text"] or "").encode() for x in docs}
    seen = {n: Counter(g for i, t in raw.items() if i in trusted and not held_back(i) for g in grams(t))}
    for k in range(n - 1, 0, -1):
        seen[k] = Counter(g[1:] for g in seen[k + 1])
    inside, discount = {}, {}
    for k, found in seen.items():
        times = Counter(found.values())
        discount[k] = quality._discounts(times[1], times[2], times[3], times[4])
        for g, c in found.items():
            inside.setdefault(g[:-1], {})[g] = c
    total = {c: sum(f.values()) for c, f in inside.items()}
    backoff = {c: sum(discount[len(c) + 1][min(v, 3) - 1] for v in f.values()) / total[c] for c, f in inside.items()}
    known = {}

    def p(g):
        if not g:
            return 1 / 256
        if g not in known:
            context = g[:-1]
            if context not in inside:
                known[g] = p(g[1:])
            else:
                c = inside[context].get(g, 0)
                own = (c - discount[len(g)][min(c, 3) - 1]) / total[context] if c else 0.0
                known[g] = own + backoff[context] * p(g[1:])
        return known[g]

    bits = {i: -sum(math.log2(p(g)) for g in grams(t)) for i, t in raw.items()}
    lang = {x["doc_id"]: x["lang"] for x in docs}
    rates = defaultdict(list)
    for i, t in raw.items():
        if i in trusted and held_back(i) and t:
            for key in {lang[i], "all"}:
                rates[key].append(round(bits[i] / len(t) / quality.BIN))
    def limit(found):
        found = sorted(found)
        at = lambda x: next(v for k, v in enumerate(found, 1) if k >= x * len(found)) * quality.BIN
        return at(0.5), at(0.5) + margin * (at(q) - at(0.5))
    limits = {key: limit(v) for key, v in rates.items() if key == "all" or len(v) >= quality.MIN_CALIBRATION}
    keep = []
    for x in docs:
        i = x["doc_id"]
        typical, most = limits.get(lang[i]) or limits["all"]
        if raw[i] and (bits[i] + quality.PRIOR_BYTES * typical) / (len(raw[i]) + quality.PRIOR_BYTES) <= most:
            keep.append(x)
    return keep


def plain_lines(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    holders = defaultdict(set)
    for x in docs:
        for line in (x["text"] or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(x["doc_id"])
    out = []
    for x in docs:
        lines = (x["text"] or "").split("\n")
        kept = [y for y in lines if len(holders.get(key(y), ())) < 5 or max(holders[key(y)]) == x["doc_id"]]
        text = "\n".join(kept) if len(kept) < len(lines) else x["text"]
        out.append(dict(x, text=text, n_chars=len(text) if len(kept) < len(lines) else x["n_chars"]))
    return out


def plain_near(docs):
    sets = {}
    for x in docs:
        w = [y for y in re.split(r"[\x20\x09-\x0D]+", (x["text"] or "").translate(FOLD)) if y]
        sets[x["doc_id"]] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, s in sets.items():
        for b, t in sets.items():
            if a < b and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [x for x in docs if root(x["doc_id"]) == x["doc_id"]]


def plain_mix(docs):
    """Slot by slot: the released block with the earliest deadline, in rounds."""
    streams = defaultdict(list)
    for x in docs:
        streams["null" if x["source"] is None else "=" + x["source"]].append(x)
    for found in streams.values():
        found.sort(key=lambda x: (hashlib.md5(str(x["doc_id"]).encode()).hexdigest(), x["doc_id"]))
    whole = sum(math.sqrt(len(v)) for v in streams.values())
    share = {s: max(1, math.floor(max(200.0, 20.0 * len(streams)) * math.sqrt(len(v)) / whole + 0.5)) for s, v in streams.items()}
    blocks = {s: [v[i:i + 32] for i in range(0, len(v), 32)] for s, v in streams.items()}
    out, r = [], 0
    while any(r * share[s] < len(b) for s, b in blocks.items()):
        own = {s: b[r * share[s]:(r + 1) * share[s]] for s, b in sorted(blocks.items()) if r * share[s] < len(b)}
        n, done = sum(map(len, own.values())), Counter()
        for t in range(n):
            ready = [(-(-(done[s] + 1) * n // len(b)), s) for s, b in own.items() if done[s] < len(b) and done[s] * n // len(b) <= t]
            s = min(ready)[1]
            out += own[s][done[s]]
            done[s] += 1
        r += 1
    return [dict(x, mix_position=k) for k, x in enumerate(out)]


def test_pipeline_equals_plain_python(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [r.asDict() for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    plain = plain_mix(plain_near(plain_lines(plain_quality(docs, labels))))
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {x["doc_id"]: (x["mix_position"], x["lang"], x["source"], coder.encode_ordinary(x["text"] or "")) for x in plain}
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == len(want) < len(docs)
    for x in got:
        assert (x["mix_position"], x["lang"], x["source"], bpe.to_ids(x["ids_le"]).tolist()) == want[x["doc_id"]]
        assert x["exact"] and x["n_tokens"] == len(want[x["doc_id"]][3])


def test_stages_keep_the_columns_and_take_awkward_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    first = docs.first()
    odd = [(None, "a text without an id, read twice", "en", "src0", 3), (None, None, None, None, None), (9001, "", "en", None, 0),
           (9002, None, "xx", "src1", None), (first["doc_id"], *list(first)[1:]), (9003, "x " * 4000, "de", "odd", 8000)]
    table = docs.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(odd, docs.select(*corpus_pipeline.COLUMNS).schema))
    for rows in (table.withColumn("keep", F.lit("own")).withColumn("rep", F.lit(1)), table.limit(0)):
        made = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, made, SF)
            path = str(tmp_path / f"{name.split()[0]}-{len(rows.columns)}")
            made.write.parquet(path)
            made = spark.read.parquet(path)
            assert made.columns[:5] == corpus_pipeline.COLUMNS and set(rows.columns) <= set(made.columns)
        tokens = corpus_pipeline.STAGES[-1][1](spark, made, SF)
        assert tokens.where("not exact").count() == 0 and tokens.count() == made.count()
    ids = [x["doc_id"] for x in spark.read.parquet(str(tmp_path / f"n-gram-{len(table.columns) + 2}")).collect()]
    assert ids.count(first["doc_id"]) <= 1 and len(corpus_pipeline.STAGES) == 5
