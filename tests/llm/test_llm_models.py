"""Mixing, search, extraction, quality and language against brute force or held-out labels."""

import math
import random
import re
from collections import Counter, defaultdict
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from seriesguard.llm import html_text, langid, mixing, ngrams, quality, topk

SF = "/root/testdata/sf0.01"


# -- mixing ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("sizes,shares", [({"a": 500, "b": 90, "c": 7, None: 33}, {"a": 5, "b": 3, "c": 2, None: 1}), ({"a": 10}, {"a": 3}),
                                          ({"a": 64, "b": 64, "c": 64}, {"a": 7, "b": 2, "c": 1})])
def test_mix_keeps_every_source_within_a_block(spark, sizes, shares):
    rows = [(k, s) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, source string").withColumn("mix_slot", F.lit("clash"))
    wanted = spark.createDataFrame([("null" if s is None else f"={s}", n) for s, n in shares.items()], "stream string, share long")
    got = mixing.mix(docs, wanted, block_docs=4).collect()
    assert sorted((x["doc_id"], str(x["source"])) for x in got) == sorted((i, str(s)) for i, s in rows + rows[:3])
    assert sorted(x["mix_position"] for x in got) == list(range(len(got)))
    slots = {x["mix_slot"]: x["source"] for x in got}
    assert sorted(slots) == list(range(len(slots)))  # one block a slot, none idle
    n = Counter(x["source"] for x in got)
    blocks = {s: -(-n[s] // 4) for s in n}
    slot = r = 0
    while slot < len(slots):  # round by round: each source less than one block from its share of the round
        quota = {s: max(0, min(shares[s], blocks[s] - r * shares[s])) for s in blocks}
        total, taken = sum(quota.values()), Counter()
        for t in range(total):
            taken[slots[slot + t]] += 1
            assert all(abs(taken[s] - quota[s] * (t + 1) / total) < 1 for s in quota)
        slot, r = slot + total, r + 1


def test_mix_pools_unlisted_sources_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"s{i % 7}") for i in range(70)], "doc_id long, source string")
    got = mixing.mix(docs, spark.createDataFrame([("=s0", 2)], "stream string, share long"), block_docs=2).collect()
    assert len(got) == 70 and sorted(x["mix_position"] for x in got) == list(range(70))
    shares = mixing.temperature_shares(docs, max_streams=3)
    assert shares.count() == 3
    empty = docs.limit(0)
    assert mixing.mix(empty, mixing.temperature_shares(empty)).count() == 0


# -- search ---------------------------------------------------------------------------------------------------


def test_topk_is_exact(spark):
    r = random.Random(4)
    vectors = [[r.gauss(0, 0.2) for _ in range(8)] for _ in range(150)]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[50]) for i in range(40)]  # a large group of equal vectors
    rows += [(300, None), (301, [1.0, None] + [0.0] * 6), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, vectors[0]), (304, []),
             (350, [0.5, 0.5]), (351, [0.25, 0.5]), (7, vectors[7])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = defaultdict(list)
    for x in topk.search(table, F.pmod(F.col("id"), F.lit(50)) == 0, k=5).collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    stored = {x[0]: x[1] for x in table.select("vec_id", "embedding").collect() if x[0] is not None}
    ints = {i: [math.floor(256 * c) for c in v] for i, v in stored.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    for q in (i for i in ints if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert set(got) == {i for i in ints if i % 50 == 0}
    assert topk.search(table.limit(0), F.lit(True)).count() == 0


# -- extraction -----------------------------------------------------------------------------------------------


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p><p>no';</script></head><body>{body}</body></html>"


def test_extract_main_text(spark):
    rows = [(1, "http://a.example/x", page("<nav><p>menu</p></nav><article><h1>Head &amp; &eacute;</h1><p>one <b>two<br><p>th<i>r</i>ee &lt;3"
                                           "<div class='ad'>buy</div><aside>x</aside><ul><li>l1<li>l2</ul></article>"
                                           "<section id=comments><p>nice</p></section><footer>f</footer>")),
            (2, None, page("<div class='site-header'>h</div><main><p>main  text\n here</p><form>f</form></main>")),
            (3, "not a url", page("<p>only<!-- c --> body</p><p hidden>no</p><div role=navigation>no</div>")),
            (4, "http://a.example/", None), (5, "http://a.example/", ""), (6, "http://a.example/", "<p>cut <b>off &am"), (7, "u", "a < b <3 c"),
            (1, "http://a.example/x", page("<article><article>in</article> out</article>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("_host", F.lit(1))
    got = sorted((x["page_id"], x["text"]) for x in html_text.extract(pages).collect())
    assert got == [(1, "Head & é\none two\nthree <3\nl1\nl2"), (1, "in\nout"), (2, "main text here"), (3, "only body"), (4, ""), (5, ""),
                   (6, "cut off &am"), (7, "a < b <3 c")]
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_extract_removes_what_recurs_on_a_host(spark, broadcast):
    rows = [(i, f"https://u:p@S.example:80/{i}", page(f"<div><p>welcome to our site</p><p>all rights</p></div><p>text {i}</p>")) for i in range(30)]
    rows += [(100 + i, f"https://other.example/{i}", page("<div><p>welcome to our site</p></div>")) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {x["page_id"]: x["text"] for x in html_text.extract(pages, min_pages=12, broadcast=broadcast).collect()}
    assert all(got[i] == f"text {i}" for i in range(30)) and got[100] == "welcome to our site" and len(got) == 35


def brute_templates(rows, min_pages, min_share):
    """Texts without recurring subtrees, by ElementTree: subtrees as strings, counted in plain Python."""
    hosts, trees, seen = defaultdict(int), [], defaultdict(list)
    prose = set("p h1 li".split())
    for _, url, source in rows:
        host = re.match(r"https://([^/]+)", url)[1]
        body = ElementTree.fromstring(source).find("body")
        blocks = [e.text for e in body.iter() if e.text]
        longest = max(blocks, key=len, default="")
        hosts[host] += 1
        trees.append((host, body))
        for key in {ElementTree.tostring(e) for e in body.iter() if e.tag not in prose | {"body", "article"} and any(x.text for x in e.iter())}:
            seen[host, key].append(longest)
    gone = {k for k, longest in seen.items() if max(min_pages, min_share * hosts[k[0]]) <= len(set(longest))
            or max(min_pages, 12, 0.6 * hosts[k[0]]) <= len(longest)}

    def kept(host, e):
        if (host, ElementTree.tostring(e)) not in gone:
            yield from [e.text] if e.text else []
            for x in e:
                yield from kept(host, x)

    return {i: "\n".join(kept(host, body)) for (i, _, _), (host, body) in zip(rows, trees, strict=True)}, gone


@pytest.mark.parametrize("article", ["article", "div"])
def test_templates_by_counting_alone(spark, article):
    """Menus, notices and adverts of no listed name go by their counts; copied and near copied articles stay whole."""
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    line = lambda n: " ".join(word() for _ in range(n))
    rows, texts, quoted = [], {}, line(30)
    for host, size in (("one.example", 120), ("two.example", 14), ("three.example", 2)):
        menus = [f"<div class='top'><ul>{''.join(f'<li>{word()}</li>' for _ in range(5))}</ul></div>" for _ in range(4)]
        boxes = [f"<div class='box'><div><p>{line(6)}</p></div><p>{line(4)}</p></div>" for _ in range(3)]
        copied = [line(40), line(25), line(9)]
        for k in range(size):
            body = list(copied) if k % 5 == 0 else [line(40), *copied[1:]] if k % 7 == 0 else [line(35), quoted, line(20)]
            i = len(rows)
            texts[i] = [f"{line(3)} {i}" if k % 5 else "a title", *body]
            inside = f"<h1>{texts[i][0]}</h1>" + "".join(f"<p>{x}</p>" for x in body)
            rows.append((i, f"https://{host}/{k}", f"<html><body>{r.choice(menus)}<{article} id='a'>{inside}</{article}>"
                         f"{r.choice(boxes)}<div id='end'><p>{line(5)}</p></div></body></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {x["page_id"]: x["text"] for x in html_text.extract(pages, lists=False).collect()}
    want, gone = brute_templates(rows, 3, 0.05)
    assert got == want and len(gone) >= 14
    assert all("\n".join(texts[i]) in got[i] for i in texts)
    assert all(got[i].count("\n") == len(texts[i]) for i in range(120))  # the article and the line of its own at the end
    if article == "article":
        assert {x["page_id"]: x["text"] for x in html_text.extract(pages).collect()} == {i: "\n".join(t) for i, t in texts.items()}


def test_implied_ends_below_many_open_elements():
    deep = html_text.Page("<ul><li>one" + "<b>" * 200 + "x<li>two</ul>", "h")
    assert deep.blocks == ["onex", "two"]


def test_deep_and_broken_markup():
    assert html_text.Page("<b>" * 50_000 + "x" + "</i>" * 1000, "h").blocks == ["x"]
    assert html_text.Page("<div>" * 5_000 + "x", "h").blocks == ["x"]
    assert html_text.Page('<p class="a>x</p><p>y', "h").blocks[-1].endswith("y")


# -- quality --------------------------------------------------------------------------------------------------


def brute_model(counts, order):
    """Interpolated modified Kneser-Ney with the same discounts, by dictionaries over byte strings."""
    seen = {order: counts}
    for k in range(order - 1, 0, -1):
        seen[k] = Counter(g[1:] for g in seen[k + 1])
    discounts = {}
    for k, v in seen.items():
        n = Counter(v.values())
        discounts[k] = quality._discounts(n[1], n[2], n[3], n[4])

    def p(g):
        if not g:
            return 1 / 256
        k, context = len(g), g[:-1]
        followers = {h: c for h, c in seen[k].items() if h[:-1] == context}
        if not followers:
            return p(g[1:])
        d = lambda c: discounts[k][min(c, 3) - 1]
        total = sum(followers.values())
        own = (followers[g] - d(followers[g])) / total if g in followers else 0
        return own + sum(map(d, followers.values())) / total * p(g[1:])

    return p


def test_kneser_ney_equals_brute_force(spark):
    train = ["the cat sat on the mat and the cat ate", "a dog sat éè on the log", "the the the cat", ""]
    other = ["the dog ate é", "zzz", None]
    docs = spark.createDataFrame([(t, 1) for t in train] + [(t, 0) for t in other], "text string, mark int")
    model = quality.log_probabilities(quality.count_ngrams(docs, "text", "mark"))
    grams = lambda t: [(bytes(4) + t.encode())[i:i + 5] for i in range(len(t.encode()))]
    p = brute_model(Counter(g for t in train for g in grams(t)), quality.ORDER)
    got = {x["key"].to_bytes(8, "big")[3:]: x["logp"] for x in model.collect()}
    assert set(got) == {g for t in train + other for g in grams(t or "")}
    assert all(abs(math.log2(p(g)) - x) < 1e-5 for g, x in got.items())
    scored = quality.code_lengths(docs.withColumn("n", F.lit(1)), model, "text", "bits", "size").collect()
    for x in scored:
        text = x["text"] or ""
        assert abs(x["bits"] + sum(math.log2(p(g)) for g in grams(text))) < 1e-3 and x["size"] == len(text.encode())


def test_model_is_planned_order_by_order(spark):
    """The last plan joins the tables of two orders only, whatever the orders below took."""
    docs = spark.createDataFrame([("one two", 1), ("two three", 0)], "text string, mark int")
    model = quality.log_probabilities(quality.count_ngrams(docs, "text", "mark"))
    plan = model._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3 and plan.count("Aggregate ") <= 2
    keys = ngrams.keys([b"one two", b"two three"], quality.ORDER)[0]
    assert model.count() == len(set(keys.tolist()))


def test_shards_give_the_same_code_lengths(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionByName(spark.createDataFrame([(9001, None), (9002, "")], docs.schema))
    model = quality.log_probabilities(quality.count_ngrams(docs.withColumn("mark", F.lit(1)), "text", "mark"))
    whole = {x["doc_id"]: (x["bits"], x["size"]) for x in quality.code_lengths(docs, model, "text", "bits", "size").collect()}
    monkeypatch.setattr(quality, "SHARD", model.count() // 3)
    parts = {x["doc_id"]: (x["bits"], x["size"]) for x in quality.code_lengths(docs, model, "text", "bits", "size").collect()}
    assert whole.keys() == parts.keys()
    assert all(abs(whole[i][0] - parts[i][0]) < 1e-6 * (1 + whole[i][0]) and whole[i][1] == parts[i][1] for i in whole)


def test_quality_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("keep", F.lit("clash"))
    odd = spark.createDataFrame([(90_001, None, "en"), (90_002, "", None), (None, "the of and", None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    labels = spark.read.parquet(f"{SF}/labels.parquet").unionByName(
        spark.createDataFrame([(None, 1, 0), (0, None, None), (1, 1, None)], "doc_id long, quality int, toxic int"))
    for slim in (True, False):
        got = {x["doc_id"]: x["keep"] for x in quality.classify(docs, labels, slim=slim).collect()}
        truth = {x["doc_id"]: x["quality"] for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
        good, bad = [[got[i] for i, q in truth.items() if q == v] for v in (1, 0)]
        assert sum(good) / len(good) >= 0.99 and sum(bad) / len(bad) <= 0.25
        assert got[90_001] is False and got[90_002] is False and None in got
    nothing = quality.classify(docs, labels.limit(0), slim=True)
    assert nothing.where("keep").count() == docs.where("text <> ''").count()
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_every_language_has_a_limit_of_its_own(spark):
    r = random.Random(7)
    sizes = {"aa": 1, "bb": 20, "cc": 199, "dd": 200, "ee": 900, None: 40}
    rates = {x: [round(1 + k / 2 + r.random() / 5, 3) for _ in range(n)] for k, (x, n) in enumerate(sizes.items())}
    rows = spark.createDataFrame([(x, v) for x, vs in rates.items() for v in vs], "lang string, rate double")
    got = {x["lang"]: (x["typical"], x["limit"]) for x in quality.limits(rows, 0.99, 2.0).collect()}

    def own(vs):
        vs = sorted(vs)
        typical, high = (vs[math.ceil(p * len(vs)) - 1] for p in (0.5, 0.99))
        return typical, typical + 2 * (high - typical)

    pooled = own([v for vs in rates.values() for v in vs])
    assert set(got) == set(sizes) and got[None] == pytest.approx(pooled)
    for x, n in sizes.items():
        if x:
            w = n / (n + quality.MIN_CALIBRATION)
            assert got[x] == pytest.approx([w * a + (1 - w) * b for a, b in zip(own(rates[x]), pooled, strict=True)], abs=2e-3)


def test_small_languages_are_judged_by_their_own_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"), slim=True)
    by_lang = {x["lang"]: x["limits"] for x in got.groupBy("lang").agg(F.collect_set("max_perplexity").alias("limits")).collect()}
    assert all(len(x) == 1 for x in by_lang.values()) and len({x[0] for x in by_lang.values()}) == len(by_lang) == 4


# -- language -------------------------------------------------------------------------------------------------


def test_ppm_costs_equal_brute_force(spark):
    sample = spark.createDataFrame([("xx", "abracadabra abra"), ("yy", "banana band é"), ("xx", "cab")], "lang string, text string")
    rows = langid.count_contexts(sample).collect()
    counts = defaultdict(Counter)
    for x in rows:
        counts[x["lang"], x["order"]][x["key"].to_bytes(4, "big")[4 - x["order"]:]] += x["n"]

    def cost(lang, g):
        if not g:
            return 8.0
        inside = {h: c for h, c in counts[lang, len(g)].items() if h[:-1] == g[:-1]}
        total = sum(inside.values()) + len(inside)
        if g in inside:
            return -math.log2(inside[g] / total)
        return (-math.log2(len(inside) / total) if inside else 0.0) + cost(lang, g[1:])

    usable = sample.withColumn("doc_id", F.monotonically_increasing_id() * 0 + F.crc32(F.col("text").cast("binary")))
    usable = usable.where(~langid.is_held_out(F.col("doc_id")))
    langs = sorted({x["lang"] for x in rows})
    table = {k: [] for k in range(1, langid.DEPTH + 2)}
    for x in rows:
        table[x["order"]].append((x["key"], langs.index(x["lang"]), x["n"]))
    import numpy as np
    arrays = {k: (np.array([r[0] for r in v], np.uint64), np.array([r[1] for r in v]), np.array([r[2] for r in v])) for k, v in table.items()}
    trees = langid.Trees(langs, arrays)
    texts = ["abra band", "zzzé", "cabana", ""]
    got = langid._totals(trees, [t.encode() for t in texts])
    for t, row in zip(texts, got, strict=True):
        raw = bytes(langid.DEPTH) + t.encode()
        for k, lang in enumerate(langs):
            expected = sum(cost(lang, raw[i:i + langid.DEPTH + 1]) for i in range(len(t.encode())))
            assert abs(row[k] - expected) < 1e-3


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(70_000, None, "en"), (70_001, "", "en"), (70_002, "123 --- !!", None), (None, "the of and", "en"), (70_003, "é", None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("score", F.lit("clash"))
    model = langid.train(docs, sample_docs=100)
    got = langid.identify(docs.withColumn("held_out", langid.is_held_out(F.col("doc_id"))), model).collect()
    held = [x for x in got if x["held_out"] and x["lang"] and x["doc_id"] < 70_000]
    assert len(held) > 150 and sum(x["lang_pred"] == x["lang"] for x in held) / len(held) >= 0.98
    assert all(0 <= x["score"] <= 1 for x in got) and len(got) == docs.count()
    odd_pred = {x["doc_id"]: x["lang_pred"] for x in got}
    assert odd_pred[70_000] == odd_pred[70_001] == odd_pred[70_002] == "und" and odd_pred[70_003] != "und"
    untrained = langid.identify(docs, langid.train(docs.limit(0))).select("lang_pred").distinct().collect()
    assert [x[0] for x in untrained] == ["und"]


def test_any_number_of_languages(spark):
    """70 languages with alphabets of their own, scored in groups; the groups' size changes nothing."""
    def text(k, seed):
        return " ".join(chr(0x4E00 + 40 * k + (seed * j * j + 3 * j) % 40) for j in range(60))

    rows = [(100 * k + i, text(k, i + 2), f"l{k:02d}") for k in range(70) for i in range(6)]
    docs = spark.createDataFrame([*rows, (9001, "½ ² Ⅷ", None), (9002, "١٢ _", None)], "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=50)
    assert len(model[0]) == 70
    first = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.identify(docs, model).collect()}
    assert all(first[i][0] == lang for i, _, lang in rows) and first[9001] == first[9002] == ("und", 0.0)
    again = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.identify(docs, model, group_langs=9).collect()}
    assert all(again[i][0] == first[i][0] and abs(again[i][1] - first[i][1]) < 1e-9 for i in first)


# -- n-grams --------------------------------------------------------------------------------------------------


def test_ngram_keys_and_index():
    import numpy as np
    raws = [b"abc", b"", b"z", b"\x00\xffq"]
    key, lengths = ngrams.keys(raws, 3)
    assert lengths.tolist() == [3, 0, 1, 3]
    assert [int(k).to_bytes(3, "big") for k in key] == [b"\0\0a", b"\0ab", b"abc", b"\0\0z", b"\0\0\0", b"\0\0\xff", b"\0\xffq"]
    assert ngrams.sums(np.arange(7.0), lengths).tolist() == [3.0, 0.0, 3.0, 15.0]
    assert ngrams.keys([b""], 3)[0].tolist() == [] and ngrams.keys([b"", b""], 3)[0].tolist() == []
    r = np.random.default_rng(1)
    known = np.unique(r.integers(0, 1 << 62, 50_000, dtype=np.uint64))
    asked = np.concatenate([known[::3], r.integers(0, 1 << 62, 20_000, dtype=np.uint64)])
    at = np.searchsorted(known, asked).clip(0, len(known) - 1)
    assert (ngrams.Index(known).find(asked) == np.where(known[at] == asked, at, -1)).all()
