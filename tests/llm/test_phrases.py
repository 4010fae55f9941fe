"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from seriesguard.llm import phrases

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_counting(rows, min_count, inside_pct, top):
    """The contract, one phrase at a time."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside_pct * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed=3):
    r = random.Random(seed)
    words = [*"abcdefgh", "É", "Über", "x\x00y", "中文", "\U0001f600", "a b"]  # the last holds a no-break space
    def text():
        return "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b", "?!"]) for _ in range(r.choice([0, 1, 5, 40, 300])))
    rows = [(r.choice(["en", "de", None, "und"]), text()) for _ in range(60)]
    return rows + [("en", None), ("en", ""), ("xx", " . "), (None, "New York city " * 40), ("en", "the the " * 500), rows[5], rows[5]]


@pytest.mark.parametrize(("min_count", "inside_pct", "top"), [(10, 50, 2000), (3, 80, 12), (2, 0, 2000)])
def test_collocations_equal_plain_counting(spark, min_count, inside_pct, top):
    rows = texts()
    docs = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, n int, phrase string")
    found = phrases.collocations(docs, min_count, inside_pct, top).collect()
    assert sorted(map(tuple, found)) == by_counting(rows, min_count, inside_pct, top)


@pytest.mark.parametrize("frequent", [frozenset(), {("en", b"the"), ("en", b"a"), ("und", b"new")}])
def test_small_stripes_and_merges_give_the_same(spark, frequent):
    """Stripes of many chunks, sliced or not, that pass the limit of entries, are added up to the same counts."""
    rows = [(lang or "und", t) for lang, t in texts(4)]
    totals = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words) - 1):
                totals[lang, words[i], words[i + 1], words[i + 2] if i + 2 < len(words) else None] += 1
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    added = phrases.merged(phrases.stripes(docs, frequent), 1, merge_entries=5).cache()
    triples = {(r["lang"], r["w1"], r["w2"], r["w3"]): r["a"] for r in added.where("w3 is not null").collect()}
    assert triples == {k: v for k, v in totals.items() if k[3] is not None}
    want = defaultdict(lambda: [0, 0])
    for (lang, w1, w2, w3), n in totals.items():
        want[lang, w1, w2][0] += n
        want[lang, w1, w2][1] = max(want[lang, w1, w2][1], n if w3 is not None else 0)
    pairs = [(r["lang"], r["w1"], r["w2"], r["a"], r["extended"]) for r in added.where("w3 is null").collect()]
    assert sorted(pairs) == sorted((*k, *v) for k, v in want.items())


def test_no_rows_and_no_candidates(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", "one two three")], "lang string, text string")).count() == 0


def test_scores_past_64_bits(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000, 9_000_000_000_000_001, 9_500_000_000_000_000)], "a long, l long, r long")
    from pyspark.sql import functions as F

    a, l, r = 9_000_000_000_000_000, 9_000_000_000_000_001, 9_500_000_000_000_000  # noqa: E741
    assert df.select(phrases._score(F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (l * r)
