"""Mixing with more sources than a round of the old limit had."""

from collections import Counter

from seriesguard.llm import mixing


def plain_slots(streams):
    """Stream and block of every slot: earliest deadline first, over (stream, share, blocks) sorted by name."""
    out, r = [], 0
    while live := [(s, share, min(share, blocks - r * share)) for s, share, blocks in streams if r * share < blocks]:
        n, done = sum(q for _, _, q in live), [0] * len(live)
        for t in range(n):
            _, i = min((-(-(done[i] + 1) * n // q), i) for i, (_, _, q) in enumerate(live) if done[i] < q and done[i] * n // q <= t)
            out.append((live[i][0], r * live[i][1] + done[i]))
            done[i] += 1
        r += 1
    return out


def test_every_one_of_many_sources_has_its_own_stream(spark):
    sizes = {f"s{k:04d}": 1 + (k % 3 == 0) + 40 * (k % 100 == 7) for k in range(1300)}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    shares = mixing.temperature_shares(docs, total=2000)
    share = {x["stream"][1:]: x["share"] for x in shares.collect()}
    assert set(share) == set(sizes)
    got = mixing.mix(docs, shares, block_docs=1).collect()
    assert sorted(x["doc_id"] for x in got) == list(range(len(rows)))
    by_slot = {x["mix_slot"]: (x["source"], x["mix_block"]) for x in got}
    assert [by_slot[t] for t in range(len(rows))] == plain_slots([(s, share[s], sizes[s]) for s in sorted(sizes)])
    assert all(x["mix_position"] == x["mix_slot"] for x in got)


def test_positions_count_short_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 3)
    monkeypatch.setattr(mixing, "FOLD", 4)
    monkeypatch.setattr(mixing, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(mixing, "BROADCAST_STREAMS", 0)
    rows = [(k, s) for k, s in enumerate("a" * 50 + "b" * 33 + "c" * 7 + "d" * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    wanted = spark.createDataFrame([("=a", 5), ("=b", 2), ("=c", 1), ("=d", 2)], "stream string, share long")
    got = sorted(mixing.mix(docs, wanted, block_docs=4).collect(), key=lambda x: x["mix_position"])
    assert [x["mix_position"] for x in got] == list(range(len(rows)))
    runs = [(x["source"], x["mix_block"]) for x in got]
    blocks = plain_slots([("a", 5, 13), ("b", 2, 9), ("c", 1, 2), ("d", 2, 2)])
    assert list(dict.fromkeys(runs)) == blocks and all(n <= 4 for n in Counter(runs).values())
    assert [x["mix_slot"] for x in got] == sorted(x["mix_slot"] for x in got)


def test_shares_are_the_target_weights(spark):
    """400 small sources beside a large one: every share is less than a block from its weight's part of the round."""
    sizes = {"big": 40_000, **{f"s{k:03d}": 200 + k for k in range(400)}}
    docs = spark.range(sum(sizes.values())).select("id")
    edges, at = [], 0
    for s, n in sizes.items():
        edges.append((s, at, at + n))
        at += n
    spans = spark.createDataFrame(edges, "source string, a long, b long").selectExpr("source", "explode(sequence(a, b - 1)) AS id")
    shares = {x["stream"][1:]: x["share"] for x in mixing.temperature_shares(docs.join(spans, "id")).collect()}
    whole, slots = sum(n ** 0.5 for n in sizes.values()), max(200, mixing.SLOTS_OF_SOURCE * len(sizes))
    assert all(abs(shares[s] - slots * n ** 0.5 / whole) < 1 for s, n in sizes.items())
    assert abs(shares["big"] / sum(shares.values()) - 40_000 ** 0.5 / whole) < 0.001
