"""Tokens, lines, shingles, fingerprints and passages against brute force, with awkward rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from seriesguard.llm import bpe, graph, jaccard, linededup, simhash, suffixes

RANKS = "byte_bpe_multi_50k.tiktoken"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if w]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def corpus():
    """Documents with exact and near copies, shared passages, repeated words, and no words."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(r.choices(vocabulary, k=r.choice([0, 1, 2, 4, 12, 60, 200, 400]))) for _ in range(120)]
    passage = " ".join(r.choices(vocabulary, k=64))
    for i in range(0, 30, 3):
        w = texts[i].split()
        w.insert(len(w) // 2, passage)
        texts[i] = " ".join(w)
    for i in range(40):  # near copies of a few texts
        w = texts[r.randrange(6, 12)].split()
        for _ in range(r.choice([0, 1, 2, 6])):
            if w:
                w[r.randrange(len(w))] = r.choice(vocabulary)
        texts.append(" ".join(w))
    texts += ["que " * 300, "que " * 280, "", None, " \n\t ", "A b  c\nD", "a B c d"]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows + [rows[7], (None, "no id " * 40), (None, None)]


# -- tokens ---------------------------------------------------------------------------------------------------


def test_bpe_equals_tiktoken_and_round_trips(spark):
    texts = ["Hello  world's 123\n\n x", "éè 中文 \U0001f600", "\x1c\x85​ a", "a" * 5000, " " * 300, "", None, "Hello  world's 123\n\n x"]
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    docs = frame(spark, rows, "doc_id long, text string, n_tokens int")  # a clashing column is replaced
    out = bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).collect()
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path(RANKS)))
    other = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(out) == len(texts)
    for row in out:
        text = texts[row["doc_id"]] or ""
        ids = other.encode_ordinary(text)
        assert bpe.to_ids(row["ids_le"]).tolist() == ids and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == text.encode()
    assert bpe.encode_decode(docs.limit(0), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).count() == 0


# -- lines ----------------------------------------------------------------------------------------------------


def brute_lines(rows, min_chars, min_docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)

    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, "\n".join(kept) if len(kept) < len(lines) else t, len(lines), len(lines) - len(kept)))
    return out


def test_line_dedup(spark):
    common = ["  The same long Line here ", "the same long line here", "Änother long line, éè"]
    r = random.Random(2)
    rows = []
    for i in range(40):
        lines = [r.choice([*common, "short", f"only here {i} and long", "", "\t"]) for _ in range(r.randrange(1, 9))]
        rows.append((i % 30, "\n".join(lines)))
    rows += [(50, None), (51, ""), (None, common[0]), (52, "x\n" * 3000 + common[1]), (52, common[1]), (52, common[1])]
    docs = frame(spark, rows)
    got = linededup.dedup_lines(docs.withColumn("n_lines", F.lit("clash")).withColumn("_row_key", F.lit(1)), 15, 3)
    got = [(x["doc_id"], x["text"], x["n_lines"], x["n_dropped"]) for x in got.collect()]
    assert sorted(got, key=str) == sorted(brute_lines(rows, 15, 3), key=str)
    assert sum(x[3] for x in got) > 20
    marks = linededup.keep_bitmaps(docs, 15, 3).collect()
    assert all(sum(run["length"] for run in m["keep_runs"]) == m["n_lines"] - m["n_dropped"] for m in marks)
    assert linededup.dedup_lines(docs.limit(0), 15, 3).count() == 0


# -- shingle sets ---------------------------------------------------------------------------------------------


def brute_components(rows, n, pct):
    sets = defaultdict(list)
    for i, t in rows:
        w = words_of(t)
        sets[i].append(frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= pct * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i in sets for s in sets[i]), key=str)


@pytest.mark.parametrize("n,pct", [(5, 80), (3, 90), (2, 60)])
def test_jaccard_components(spark, corpus, n, pct):
    docs = frame(spark, corpus).withColumn("rep", F.lit("clash"))
    got = jaccard.near_components(docs, n, pct).collect()
    assert sorted(((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got), key=str) == brute_components(corpus, n, pct)


def test_jaccard_large_region_takes_pivot_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOTS", (1, 3))
    r = random.Random(9)
    base = [f"v{i}" for i in range(80)]
    rows = []
    for i in range(60):  # a chain of near copies, each changed a little from the one before
        base = list(base)
        base[r.randrange(80)] = f"c{i}"
        rows.append((i, " ".join(base)))
    got = jaccard.near_components(frame(spark, rows), 3, 90).collect()
    assert sorted(((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got), key=str) == brute_components(rows, 3, 90)


def test_jaccard_digests_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n, kept in ((1, 1), (40, 30), (700, 650), (3000, 2900), (3000, 100), (5000, 4000)):
        a = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[:kept]], rng.integers(0, 1 << 64, n - kept, np.uint64)]))
        fine = jaccard._fine(a), jaccard._fine(b)
        assert jaccard._fine_differing(fine[0], fine[0]) == 0
        assert jaccard._fine_differing(*fine) == jaccard._fine_differing(*fine[::-1]) <= len(np.setxor1d(a, b))
        half = jaccard._halved(fine[0])  # halving gives what fewer slices would have given
        slot = (a >> np.uint64(64 - (2 * len(half)).bit_length() + 1)).astype(np.int64)
        sums = np.bincount(slot, weights=(jaccard._mixed(a) & np.uint64(15)).astype(float), minlength=2 * len(half)).astype(int) % 16
        assert (sums[::2] + 16 * sums[1::2]).tolist() == half.tolist()


def test_jaccard_long_texts_and_repeated_ids(spark):
    """Long texts that share passages, below and above the limit, and one id with several texts."""
    rng = random.Random(8)
    base = [[f"w{rng.randrange(4000)}" for _ in range(2500)] for _ in range(6)]
    rows = []
    for i in range(60):
        own, share = list(base[i % 6]), (0.999, 0.97, 0.9, 0.6)[i // 6 % 4]
        for at in range(0, len(own), 25):
            if rng.random() > share:
                own[at:at + 25] = [f"v{rng.randrange(4000)}" for _ in range(25)]
        rows.append((i, " ".join(own)))
    got = jaccard.near_components(frame(spark, rows), 5, 80).collect()
    assert sorted(((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got), key=str) == brute_components(rows, 5, 80)
    assert 6 < len({r.component_id for r in got}) < 60
    twice = [(1, "a b c d e f g h"), (1, "p q r s t u v w"), (2, "p q r s t u v w"), (3, "x y"), (3, "x y"), (None, "x y")]
    got = [jaccard.near_components(frame(spark, rows), 3, 90).collect() for rows in (twice, twice[::-1])]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1])) and len(got[0]) == 6
    assert {r.component_id for r in got[0] if r.doc_id == 3} == {3}


def test_jaccard_empty(spark):
    assert jaccard.near_components(frame(spark, []), 5, 80).count() == 0
    alone = jaccard.near_components(frame(spark, [(1, None), (2, ""), (3, "a b")]), 5, 80).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in alone) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (200, 200)]
    got = dict(graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 300: 200, 200: 200}


# -- fingerprints ---------------------------------------------------------------------------------------------


def brute_print(text):
    w = words_of(text)
    terms = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else ([[" ".join(w), "", ""]] if w else [])
    out = []
    for first in ([], ["b"]):
        votes = [0] * 64
        for term in terms:
            h = 42
            for part in first + term:
                h = xxhash.xxh64_intdigest(part.encode(), seed=h)
            votes = [v + (h >> i & 1) for i, v in enumerate(votes)]
        out.append(sum(1 << i for i, v in enumerate(votes) if 2 * v > len(terms)))
    return out


def test_simhash_of_edits(spark, corpus):
    rows = corpus[::3] + [(500, "x"), (501, "\U0001f600é abc " * 9)]
    got = simhash.compare_edits(frame(spark, rows).withColumn("row", F.lit(1))).collect()
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    texts = [t or "" for _, t in ordered]
    expected = []
    for k, (i, _) in enumerate(ordered):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edit = text[:len(text) - half] + following[:half]
        a, e, n = brute_print(text), brute_print(edit), brute_print(following)
        near = [max(0.0, math.cos(sum((x ^ y).bit_count() for x, y in zip(a, o, strict=True)) * math.pi / 128)) for o in (e, n)]
        expected.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), "%016x%016x" % tuple(a), "%016x%016x" % tuple(e),
                         round(near[0], 9), round(near[1], 9)))
    seen = [(x["doc_id"], x["n_chars"], x["edited_sha256"], x["fingerprint"], x["edited_fingerprint"], round(x["near_edited"], 9),
             round(x["near_next"], 9)) for x in got]
    assert sorted(seen, key=str) == sorted(expected, key=str)
    assert simhash.compare_edits(frame(spark, [])).count() == 0
    alone = simhash.compare_edits(frame(spark, [(1, "a b c d")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


@pytest.mark.parametrize("radius", [0, 1, 3, 9])
def test_simhash_pairs(spark, radius):
    r = random.Random(radius)
    base = [r.getrandbits(128) for _ in range(6)]
    prints = [b ^ sum({1 << r.randrange(128) for _ in range(r.randrange(7))}) for b in base for _ in range(12)] + base[:2]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(p & (1 << 64) - 1), signed(p >> 64)) for i, p in enumerate(prints)] + [(None, 0, 0), (900, None, 1)]
    members, pairs = simhash.pairs_within(spark.createDataFrame(rows, "doc_id long, f1 long, f2 long"), radius)
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(p, i)
    assert sorted(map(tuple, members.collect())) == sorted((i, first[p]) for i, p in enumerate(prints))
    expected = sorted((a, b, (p ^ q).bit_count()) for p, a in first.items() for q, b in first.items() if a < b and (p ^ q).bit_count() <= radius)
    assert sorted(map(tuple, pairs.collect())) == expected


# -- passages -------------------------------------------------------------------------------------------------


def test_repeated_passages(spark, corpus):
    docs = frame(spark, corpus).withColumn("end", F.lit(3))
    found = suffixes.repeated_passages(docs).collect()
    words = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for i, t in corpus if i is not None}
    where = defaultdict(set)
    for i, w in words.items():
        for j in range(len(w) - 49):
            where[tuple(w[j:j + 50])].add(i)
    expected, got = defaultdict(set), defaultdict(set)
    for i, w in words.items():
        for j in range(len(w) - 49):
            if len(where[tuple(w[j:j + 50])]) > 1:
                expected[i].update(range(j, j + 50))
    for x in found:
        assert x["n_words"] == x["end_word"] - x["start_word"] >= 50 and x["partner_id"] != x["doc_id"]
        got[x["doc_id"]].update(range(x["start_word"], x["end_word"]))
    assert got == expected and len(expected) > 30
    assert suffixes.repeated_passages(frame(spark, [])).count() == 0


def test_passages_of_one_id_with_several_texts(spark):
    """Each text keeps its own spans; what two texts of one id share is no repeat."""
    r = random.Random(8)
    passage, own = ([" ".join(f"{c}{r.randrange(900)}" for _ in range(n)) for c, n in (("p", 70), ("q", 60))], lambda n: " ".join(f"w{r.randrange(9000)}" for _ in range(n)))
    rows = [(5, own(30) + " " + passage[0] + " " + own(900)), (5, own(12) + " " + passage[1]), (9, passage[0]), (9, passage[0]), (7, own(700) + " " + passage[1]),
            (8, own(80)), (8, own(10) + " " + own(50))]
    inside = own(55)
    rows += [(20, inside + " " + own(20)), (20, own(40) + " " + inside)]
    found = sorted((x["doc_id"], x["start_word"], x["end_word"], x["partner_id"]) for x in suffixes.repeated_passages(frame(spark, rows)).collect())
    assert found == [(5, 12, 72, 7), (5, 30, 100, 9), (7, 700, 760, 5), (9, 0, 70, 5)]


def test_lines_found_everywhere_are_dropped_slice_by_slice(spark):
    common = "a line that most of all documents hold, longer than forty"
    rows = [(i, f"own {i}\n{common}\n" + (common if i % 3 else "x")) for i in range(400)] + [(None, common), (7, common)]
    cut = {(x["doc_id"], x["n_lines"], x["n_dropped"]) for x in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert cut == {(i, 3, 0 if i == 399 else 1 + (i % 3 > 0)) for i in range(400)} | {(None, 1, 0), (7, 1, 1)}


def test_components_of_random_graphs(spark):
    r = random.Random(11)
    for n, m in ((60, 40), (200, 190), (50, 300)):
        links = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
        parent = {x: x for link in links for x in link}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        got = dict(graph.components(spark.createDataFrame(links, "a long, b long")).collect())
        assert got == {x: root(x) for x in parent}
