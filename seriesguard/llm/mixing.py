"""Mixing sources to target weights by Pfair scheduling.

Every source's documents, in a fixed pseudo-random order, are cut into blocks of ``block_docs``. A round
gives source s at most ``share_s`` blocks (fewer once it runs out), and takes one slot for each block. In
a round of N slots, the i-th of a source's q blocks (i from 1) is released at slot floor((i-1)*N/q) and due
before slot ceil(i*N/q); each slot takes the released block with the earliest deadline, ties to the smaller
source. These windows are those of Pfair scheduling on one processor, so at every slot each source
is less than one block away from its exact proportion of the round.

A round's schedule depends only on the quotas. They change only where a source runs out, so there are at
most 2 * sources + 1 different schedules, however many rounds there are, and all together they have no more slots
than there are blocks. Each is a fold over the slots of one round in a single SQL expression. Sources of one quota
have the same windows, so they take turns in the order of their names, and the fold compares quotas, not sources:
few, as different quotas add up to no more than a round. Blocks get their slots and first positions, and documents
look their block up. Every document is kept once, and the number of sources has no limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, shuffle_partitions

#: Shares of up to this many streams are broadcast; more are joined by a shuffle.
BROADCAST_STREAMS = 100_000
#: Blocks are broadcast up to this many (a name and three numbers each); more are joined by a shuffle.
BROADCAST_BLOCKS = 500_000
#: Slots whose positions are counted in one task, and slots of a fold's picks that are copied for each slot.
CHUNK, FOLD = 4096, 512
#: Slots of a round for each source, at least, so that a share of one block is a small weight.
SLOTS_OF_SOURCE = 20


def _stream(source: Column) -> Column:
    """A non-null name for each source; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def temperature_shares(docs: DataFrame, alpha: float = 0.5, total: int = 200, source_col: str = "source",
                       max_streams: int | None = None) -> DataFrame:
    """``stream`` and ``share`` (blocks in a round, at least 1): target weights follow documents ** alpha, and a share is the
    weight's part of a round, rounded, so less than one block from it. A round has ``total`` slots, or ``SLOTS_OF_SOURCE`` for each
    source if that is more, so that many sources don't distort the weights. Every source gets a row, or with
    ``max_streams`` only so many of the largest (ties to the smaller name)."""
    sizes = docs.groupBy(_stream(F.col(source_col)).alias("stream")).agg(F.count(F.lit(1)).alias("n"))
    if max_streams is not None:
        sizes = sizes.orderBy(F.col("n").desc(), "stream").limit(max_streams)
    power = F.pow(F.col("n").cast("double"), F.lit(float(alpha)))
    in_order = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), "stream")
    whole = F.sum(power).over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    slots = F.greatest(F.lit(total), F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) * SLOTS_OF_SOURCE).cast("double")
    return sizes.select("stream", F.greatest(F.floor(slots * power / whole + 0.5), F.lit(1)).cast("long").alias("share"))


def _edf(classes: Column, slots: Column) -> Column:
    """The picks of one round: for each slot, (index into the round's sources, which of its blocks).

    ``classes`` has the different quotas ``q`` and the sorted indexes of their ``members``. Blocks of a class are dealt
    by number, then member: all members' j-th blocks have one window, and end before the next ones are due."""
    at = lambda i: F.element_at(classes, i + 1)
    done = lambda s, i: F.element_at(s["done"], i + 1)
    block = lambda s, i: F.floor(done(s, i) / F.size(at(i)["members"]))
    none = F.expr("cast(array() as array<struct<i:int,j:bigint>>)")

    def step(s: Column, t: Column) -> Column:
        ready = F.filter(F.sequence(F.lit(0), F.size(classes) - 1), lambda i: (block(s, i) < at(i)["q"]) & (
            F.floor(block(s, i) * slots / at(i)["q"]) <= t))
        due = F.transform(ready, lambda i: F.struct(
            F.ceil((block(s, i) + 1) * slots / at(i)["q"]).alias("due"),
            F.element_at(at(i)["members"], (F.pmod(done(s, i), F.size(at(i)["members"])) + 1).cast("int")).alias("member"),
            i.alias("i"), block(s, i).alias("j")))
        return F.transform(F.array(F.array_min(due)), lambda p: F.struct(
            F.transform(s["done"], lambda d, i: d + (i == p["i"]).cast("long")).alias("done"),
            F.array_append(s["picks"], F.struct(p["member"].alias("i"), p["j"].alias("j"))).alias("picks")))[0]

    def steps(s: Column, first: Column) -> Column:
        ticks = F.sequence(first, F.least(first + F.lit(FOLD - 1).cast("long"), slots - 1))
        part = F.aggregate(ticks, F.struct(s["done"].alias("done"), none.alias("picks")), step)
        return F.transform(F.array(part), lambda x: F.struct(
            x["done"].alias("done"), F.array_append(s["picks"], x["picks"]).alias("picks")))[0]

    start = F.struct(F.transform(classes, lambda x: F.lit(0).cast("long")).alias("done"),
                     F.expr("cast(array() as array<array<struct<i:int,j:bigint>>>)").alias("picks"))
    firsts = F.sequence(F.lit(0).cast("long"), slots - 1, F.lit(FOLD).cast("long"))
    return F.aggregate(firsts, start, steps, lambda s: F.flatten(s["picks"]))


def schedules(streams: DataFrame) -> DataFrame:
    """The blocks of ``streams`` (stream, share, n, blocks) that the different rounds deal out: ``stream``, ``share``, ``n``,
    ``r0`` and ``r1`` (the first round of a kind and of the next), ``base`` (slots before ``r0``), ``slots`` of a
    round, ``slot`` in it and ``j``, which of the stream's blocks in the round takes that slot."""
    spark = streams.sparkSession
    n_tasks = shuffle_partitions(spark)
    full = F.floor(F.col("blocks") / F.col("share"))
    rounds = streams.select(F.explode(F.array(F.lit(0).cast("long"), full, full + 1)).alias("r0")).distinct()
    rounds = rounds.withColumn("r1", F.lead("r0").over(Window.orderBy("r0"))).where("r1 is not null")  # none begins in the last
    gone = F.least(F.col("blocks"), F.col("r0") * F.col("share"))
    q = F.least(F.col("share"), F.col("blocks") - gone)
    kinds = streams.crossJoin(F.broadcast(rounds)).groupBy("r0", "r1").agg(
        F.sum(gone).alias("base"), F.sum(q).alias("slots"),
        F.sort_array(F.collect_list(F.when(q > 0, F.struct("stream", q.alias("q"), "share", "n")))).alias("quota"))
    kinds = kinds.where("slots > 0").repartition(n_tasks, "r0")
    places = F.sequence(F.lit(0), F.size("quota") - 1)
    classes = F.transform(F.array_distinct(F.col("quota.q")), lambda v: F.struct(
        v.alias("q"), F.filter(places, lambda i: F.element_at(F.col("quota"), i + 1)["q"] == v).alias("members")))
    kinds = kinds.withColumn("classes", classes)
    picks = kinds.withColumn("picks", _edf(F.col("classes"), F.col("slots")))
    named = F.transform("picks", lambda p: F.struct(F.element_at(F.col("quota"), p["i"] + 1).alias("of"), p["j"].alias("j")))
    rows = picks.select("r0", "r1", "base", "slots", named.alias("named"))
    rows = rows.select("r0", "r1", "base", "slots", F.posexplode("named").alias("slot", "pick"))
    return rows.select("pick.of.stream", "pick.of.share", "pick.of.n", "r0", "r1", "base", "slots", F.col("slot").cast("long").alias("slot"),
                       F.col("pick.j").alias("j"))


def _blocks(streams: DataFrame, block_docs: int) -> DataFrame:
    """Every block's ``stream``, ``block``, ``slot`` and ``first`` position."""
    plan = schedules(streams).repartition(shuffle_partitions(streams.sparkSession), "r0", "slot")
    every = plan.withColumn("r", F.explode(F.sequence(F.col("r0"), F.col("r1") - 1)))
    block = F.col("r") * F.col("share") + F.col("j")
    every = every.select("stream", block.alias("block"), (F.col("base") + (F.col("r") - F.col("r0")) * F.col("slots") + F.col("slot")).alias("slot"),
                         F.least(F.lit(block_docs).cast("long"), F.col("n") - block * block_docs).alias("size"))
    every = materialize(every.withColumn("chunk", F.floor(F.col("slot") / CHUNK)), "blocks")
    ahead = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = every.groupBy("chunk").agg(F.sum("size").alias("size")).select(
        "chunk", ahead(Window.orderBy("chunk")).alias("before"))  # a row for CHUNK blocks
    first = F.col("before") + ahead(Window.partitionBy("chunk").orderBy("slot"))
    return materialize(every.join(chunks, "chunk").select("stream", "block", "slot", first.alias("first")), "positions")


def mix(docs: DataFrame, shares: DataFrame, block_docs: int = 32, rest_share: int = 1, id_col: str = "doc_id",
        source_col: str = "source") -> DataFrame:
    """``docs`` with ``mix_block`` (number of the document's block in its stream), ``mix_slot`` (the block's
    slot) and ``mix_position`` (0, 1, ... over all documents); sorting by the last gives the mixture.

    ``shares`` has ``stream`` and ``share`` as ``temperature_shares`` gives them, any number of rows;
    sources without a row share one stream of ``rest_share``. Null sources are a source of their own. Inside
    a source documents follow the MD5 of their id, then the id; null ids come first. Repeated rows are kept,
    in any order among themselves. Texts aren't read. An empty table gives an empty one. Columns of the
    result's names are replaced.
    """
    out = ["mix_block", "mix_slot", "mix_position"]
    docs = docs.select(*(c for c in docs.columns if c.lower() not in out))
    columns = docs.columns
    named = lambda base: free_name(docs, base)
    stream, own, code, bucket, place = (named(c) for c in ("_stream", "_own_stream", "_code", "_bucket", "_rank"))

    wanted = materialize(shares.select("stream", F.col("share").cast("long").alias("share")), "shares")
    small = wanted.count() <= BROADCAST_STREAMS
    names = wanted.select(F.col("stream").alias(own))
    code_of = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.withColumn(named("_named"), _stream(F.col(source_col)))
    rows = rows.join(F.broadcast(names) if small else names, F.col(named("_named")) == F.col(own), "left")
    rows = rows.withColumn(stream, F.coalesce(F.col(own), F.lit("rest"))).withColumn(code, code_of)
    rows = rows.withColumn(bucket, F.substring(code, 1, 3)).select(*columns, stream, code, bucket)

    # the rank of a document in its stream: rank in its bucket of codes, plus the buckets before
    counts = materialize(rows.groupBy(stream, bucket).agg(F.count(F.lit(1)).alias("n")), "buckets").toDF("s", "b", "n")
    before = counts.select("s", "b", F.coalesce(F.sum("n").over(
        Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    before = before.toDF(*(named(c) for c in ("_s", "_b", "_before")))
    s, b, first = (F.col(c) for c in before.columns)
    local = F.row_number().over(Window.partitionBy(stream, bucket).orderBy(code, F.col(id_col).asc_nulls_first()))
    ranked = rows.withColumn(place, local).join(before, (F.col(stream) == s) & (F.col(bucket) == b))
    ranked = ranked.withColumn(place, first + F.col(place) - 1).select(*columns, stream, place)

    sizes = counts.groupBy(F.col("s").alias("stream")).agg(F.sum("n").alias("n"))
    streams = sizes.join(F.broadcast(wanted) if small else wanted, "stream", "left").select(
        "stream", "n", F.coalesce("share", F.lit(rest_share).cast("long")).alias("share"),
        F.floor((F.col("n") + block_docs - 1) / block_docs).alias("blocks"))
    streams = materialize(streams, "streams")
    placed = _blocks(streams, block_docs)
    few = placed.count() <= BROADCAST_BLOCKS
    placed = placed.toDF(*(named(c) for c in ("_p_stream", "_p_block", "_p_slot", "_p_first")))
    p_stream, p_block, p_slot, p_first = (F.col(c) for c in placed.columns)
    block = F.floor(F.col(place) / block_docs)
    joined = ranked.join(F.broadcast(placed) if few else placed, (F.col(stream) == p_stream) & (block == p_block))
    position = p_first + F.pmod(F.col(place), F.lit(block_docs))
    return joined.select(*columns, block.alias("mix_block"), p_slot.alias("mix_slot"), position.cast("long").alias("mix_position"))
