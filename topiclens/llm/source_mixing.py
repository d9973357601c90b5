"""Mixing sources to target weights (DataFrame functions only).

The words of each source form one stream (documents in a fixed order), cut into blocks of
``block_words``.  The mix is a sequence of slots, grouped into output shards:

* each shard draws how many of its slots every source fills (a multinomial draw by strata:
  slot numbers are dealt to the sources' shares by a pseudorandom permutation, so shards
  vary at random while the totals meet the targets to one slot);
* the slots of a source are numbered through all shards, and number i takes block
  P(i mod b) of the source's b blocks, with another permutation P on each further pass, so
  a block comes at most once a pass and no block comes more than ``cap`` times;
* blocks join slots by (source, block number).

A source that holds a third of all rows is never one group: documents are placed by (source,
chunk) with chunk starts summed apart, slots are expanded from segments of bounded length, and
joins use the block number.  Running sums over sources, chunks and shards are made over range
partitions, so neither the number of sources nor the size of one decides what a task holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_WORDS = 64
CHUNK_ROWS = 512
SEGMENT_SLOTS = 1 << 14
SHARD_SLOTS = 1 << 14
TASK_SLOTS = 1 << 17  # slots that one task expands
ROUNDS = 12
FRACTION = 1 << 20  # parts of a slot in which shares are summed
SEED = 20240607
BROADCAST_SOURCES = 10_000  # above this many sources their table is joined by shuffle

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """All words of a text (null: none)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def permuted(df: DataFrame, x: str, n: Column, key: list[Column], out: str) -> DataFrame:
    """Add ``out``: a pseudorandom permutation of [0, n) applied to ``x``, keyed by ``key``.

    Swap-or-not shuffle: each round pairs y with (k - y) mod n and a hash of the pair decides
    whether they swap; every round is a bijection on [0, n) for any n.
    """
    df = df.withColumn(out, F.col(x))
    for r in range(ROUNDS):
        k = F.pmod(F.xxhash64(F.lit(SEED), F.lit(r), *key), n)
        df = df.withColumn("_other", F.pmod(k - F.col(out), n))
        swap = F.xxhash64(F.lit(SEED + 1), F.lit(r), F.greatest(F.col(out), F.col("_other")), *key)
        df = df.withColumn(out, F.when(swap.bitwiseAND(F.lit(1)) == 1, F.col("_other")).otherwise(F.col(out)))
    return df.drop("_other")


def _running(df: DataFrame, order: list[str | Column], sums: dict[str, str], name: str) -> DataFrame:
    """Add, per new name in ``sums``, the sum of a column over all rows up to this one in ``order`` (no two rows equal).

    Range partitions with a running sum each, written once, and one row of totals per
    partition: a hot source's rows are spread like any others.
    """
    ranged = df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id())
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = materialize(ranged.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()]), name)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()]).select(
        "_pid", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums])
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.withColumns({n: F.col(n) + F.col(f"_off_{n}") for n in sums}) \
        .drop("_pid", *[f"_off_{n}" for n in sums])


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source, source_size, sid, base, target``: one row per source (``sizes``: source, source_size).

    Sources in code point order (null last) take the weights in turn; ``base`` is the words of the
    sources before.  Shares of all words are filled like vessels: with the sources in the order of
    cap * size / weight, the common level is the first one that the next source's cap does not
    undercut.  No step holds all sources in one task.
    """
    ranked = _running(sizes.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()],
                      {"place": "one", "upto": "source_size"}, "mix_order")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    full = ranked.select("source", "source_size", (F.col("place") - 1).alias("sid"),
                         (F.col("upto") - F.col("source_size")).alias("base"),
                         (F.lit(float(cap)) * F.col("source_size")).alias("most")) \
        .withColumn("weight", turn[(F.col("sid") % F.lit(len(weights))).cast("int")]) \
        .withColumn("ratio", F.col("most") / F.col("weight"))
    summed = _running(full, ["ratio", "sid"], {"most_upto": "most", "weight_upto": "weight"}, "mix_levels")
    all_words, all_weight = (x or 0 for x in summed.agg(F.sum("source_size"), F.sum("weight")).first())
    level = (F.lit(all_words) - (F.col("most_upto") - F.col("most"))) \
        / (F.lit(all_weight) - (F.col("weight_upto") - F.col("weight")))
    common = summed.withColumn("level", level).filter("level <= ratio") \
        .agg(F.min(F.struct("ratio", "sid", "level")).alias("first")).first()["first"]
    filled = F.col("most") if common is None else F.least(F.col("most"), F.col("weight") * F.lit(common["level"]))
    return summed.select("source", "source_size", "sid", "base", filled.alias("target"))


def _chunked(docs: DataFrame, targets: DataFrame, chunks: int) -> DataFrame:
    """Rows with the columns of their source and the chunk they are placed in."""
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    table = targets.withColumnRenamed("source", "_source")
    joined = docs.join(F.broadcast(table) if few else table, docs["source"].eqNullSafe(F.col("_source"))) \
        .drop("_source")
    return joined.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(chunks)).cast("int"))


def _chunk_starts(sized: DataFrame, targets: DataFrame, chunks: int) -> DataFrame:
    """``_sid, _of, _start``: the words before each chunk of a source."""
    sums = _chunked(sized, targets, chunks).groupBy("sid", "_chunk").agg(F.sum("size").alias("_sum"))
    upto = _running(sums, ["sid", "_chunk"], {"_upto": "_sum"}, "mix_chunks")
    return upto.select(F.col("sid").alias("_sid"), F.col("_chunk").alias("_of"),
                       (F.col("_upto") - F.col("_sum")).alias("_start"))


def _placed(docs: DataFrame, targets: DataFrame, starts: DataFrame, chunks: int) -> DataFrame:
    """Rows with ``sid, source_size, target`` and ``pos``, the words of their source before them.

    Rows that the order leaves equal have one id, text and source, so their places may be
    exchanged: two readings give the same places to the same texts."""
    inside = Window.partitionBy("sid", "_chunk").orderBy("doc_id", "tie", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    own = _chunked(docs, targets, chunks).withColumn("_own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return own.join(starts, (own["sid"] == starts["_sid"]) & (own["_chunk"] == starts["_of"])) \
        .withColumn("pos", (F.col("_start") - F.col("base") + F.col("_own")).cast("long")) \
        .drop("_sid", "_of", "_start", "_own", "_chunk", "base")


def draws(targets: DataFrame, words: int, block_words: int = BLOCK_WORDS, cap: int = CAP) -> DataFrame:
    """``sid, block, pass``: the blocks that the mix takes, one row per slot."""
    # whole numbers, so that sums do not depend on their order
    want = F.col("target") / F.col("source_size") * F.ceil(F.col("source_size") / block_words)
    sources = targets.filter("source_size > 0").select(
        "sid", F.ceil(F.col("source_size") / block_words).alias("blocks"),
        F.round(want * FRACTION).cast("long").alias("want"))
    cut = _running(sources, ["sid"], {"upto": "want"}, "mix_strata").select(
        "sid", "blocks", F.round((F.col("upto") - F.col("want")) / FRACTION).cast("long").alias("from"),
        F.round(F.col("upto") / FRACTION).cast("long").alias("to"))
    slots = F.lit(max(1, cut.agg(F.max("to")).first()[0] or 0)).cast("long")
    segments = cut.filter("to > from").select("sid", "blocks", "from", "to", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("to") - F.col("from") - 1) / SEGMENT_SLOTS))).alias("segment"))
    low = F.col("from") + F.col("segment") * SEGMENT_SLOTS
    # small rows that grow when expanded: the number of tasks follows the slots, not their bytes
    tasks = max(1, math.ceil(words / block_words / TASK_SLOTS))
    strata = segments.repartition(tasks, "sid", "segment").select(
        "sid", "blocks", "from", F.explode(F.sequence(low, F.least(low + SEGMENT_SLOTS, F.col("to")) - 1)).alias("stratum"))
    dealt = permuted(strata, "stratum", slots, [], "slot")
    # how many slots of each output shard every source fills
    counts = dealt.groupBy("sid", "blocks", "from", F.floor(F.col("slot") / SHARD_SLOTS).alias("shard")) \
        .agg(F.count(F.lit(1)).alias("n"))
    # the sources before fill as many slots as their strata, so the rest of the sum is the source's own
    numbered = _running(counts, ["sid", "shard"], {"upto": "n"}, "mix_shards") \
        .withColumn("start", F.col("upto") - F.col("n") - F.col("from"))
    taken = numbered.repartition(tasks, "sid", "shard").select(
        "sid", "blocks", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("i"))
    taken = taken.withColumn("pass", F.floor(F.col("i") / F.col("blocks"))) \
        .filter(F.col("pass") < cap).withColumn("j", F.col("i") % F.col("blocks"))
    blocks = permuted(taken, "j", F.col("blocks"), [F.col("sid"), F.col("pass")], "block")
    # written: a join key's null check would otherwise be pushed through every round of the chain
    return materialize(blocks.select("sid", "block", "pass"), "mix_slots")


def _parts(placed: DataFrame, block_words: int) -> DataFrame:
    """One row per document and block it stands in: the document's words in that block."""
    some = placed.filter("size > 0").select("sid", "pos", "size")
    end = F.col("pos") + F.col("size")
    spread = some.select("sid", "pos", "size", F.explode(F.sequence(
        F.floor(F.col("pos") / block_words), F.floor((end - 1) / block_words))).alias("block"))
    return spread.withColumn("low", F.greatest(F.col("pos"), F.col("block") * block_words) - F.col("pos")) \
        .withColumn("high", F.least(end, (F.col("block") + 1) * block_words) - F.col("pos"))


def _sized(docs: DataFrame, extra: list[Column]) -> DataFrame:
    return docs.select(*extra, F.col("doc_id"), F.col("source"),
                       F.xxhash64("text").alias("tie"), F.size(words_in(F.col("text"))).cast("long").alias("size"))


def _plan(sized: DataFrame, weights: tuple, cap: int, block_words: int) -> tuple[Callable[[DataFrame], DataFrame], DataFrame]:
    """What gives rows of ``_sized`` their places, and the slots."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = materialize(totals, "mix_sources")
    rows, words = (x or 0 for x in totals.agg(F.sum("rows"), F.sum("source_size")).first())
    targets = materialize(source_targets(totals.drop("rows"), weights, cap), "mix_targets")
    chunks = max(1, math.ceil(rows / CHUNK_ROWS))
    starts = _chunk_starts(sized, targets, chunks)
    return lambda docs: _placed(docs, targets, starts, chunks), draws(targets, words, block_words, cap)


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP,
                block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken``.

    ``size`` counts the words of the text (null: 0), ``taken`` the words the mix takes of it,
    repeats counted; a text of no words has 0.  Null sources are one source, the last.  Null
    and repeated ids are placed like any other (by id, then a hash of the text).  All draws are
    hashes of fixed seeds, so reruns agree.  An empty table gives an empty one.  Only
    ``doc_id``, ``text`` and ``source`` are read.
    """
    sized = materialize(_sized(docs.select("doc_id", "text", "source"), []), "mix_sizes")
    place, slots = _plan(sized, weights, cap, block_words)
    placed = materialize(place(sized), "mix_placed")
    uses = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"))
    taken = _parts(placed, block_words).join(uses, ["sid", "block"]).groupBy("sid", "pos") \
        .agg(F.sum(F.col("uses") * (F.col("high") - F.col("low"))).alias("taken"))
    counted = placed.filter("size > 0").join(taken, ["sid", "pos"], "left")
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")]
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return counted.select(*columns).union(none.select(*columns))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents (all columns of ``docs``): one row per document and pass that takes words of it.

    A document taken whole keeps its text; of one taken in part the taken runs of words stay, one
    space between words (``n_chars``, if there, is recounted).  A document no pass takes is not in
    the mix, nor is one without words (null, empty or blank text).  Null sources are one source, null and
    repeated ids are placed like any other, and an empty table gives an empty one.
    """
    names = docs.columns
    given = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{i}" for i, n in enumerate(names)}
    packed = given.select(*[F.col(at[c]).alias(c) for c in ("doc_id", "text", "source")], F.struct("*").alias("row"))
    # only sizes are written; the texts get the same places when they meet their runs
    sized = materialize(_sized(packed, []), "mix_sizes")
    place, slots = _plan(sized, weights, cap, block_words)
    runs = _parts(materialize(place(sized).select("sid", "pos", "size"), "mix_placed"), block_words).join(slots, ["sid", "block"]).groupBy("sid", "pos", "pass").agg(
        F.sum(F.col("high") - F.col("low")).alias("words"),
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs"))
    mixed = place(_sized(packed, [F.col("row")])).filter("size > 0").join(runs, ["sid", "pos"])
    text = F.col(f"row.{at['text']}")
    # the words are an element of an array of one: a lambda evaluates a column that it names anew for each run
    whole = F.array(F.struct(words_in(text).alias("all"), F.col("runs").alias("runs")))
    cut = F.transform(whole, lambda d: F.array_join(F.flatten(F.transform(
        d["runs"], lambda r: F.slice(d["all"], (r["low"] + 1).cast("int"), (r["high"] - r["low"]).cast("int")))), " "))[0]
    mixed = mixed.withColumn("new", F.when(F.col("words") < F.col("size"), cut).otherwise(text))
    out = []
    for n in names:
        value = F.col(f"row.{at[n]}")
        if n == "text":
            value = F.col("new")
        elif n == "n_chars":
            value = F.length("new").cast(docs.schema[n].dataType)
        out.append(value.alias(n))
    return mixed.select(*out)
