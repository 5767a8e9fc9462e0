"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in a seeded shuffled order, lie end to end on a
line of words that is cut into blocks of (almost) equal length.  Slot n of the
mix lies at the point frac((n + 1) * golden ratio); the cumulative weights of
the sources turn that point into a source, and the rank of the slot among its
source's slots picks the block: rank modulo the number of blocks.  A source is
served until its target is reached, the last block in part.

Nothing here depends on how rows are partitioned: slots are ranked within
fixed chunks of slot numbers and documents are placed within fixed hash
buckets, each with a prefix sum over the (small) table of chunks or buckets, so
that a source with a third of all rows is spread over all tasks.

Defined results: a null text has no words; a null source is a source of its
own, ordered last; documents without words are never taken; rows that repeat
are separate documents.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonekeep.store import stage

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block at most, and blocks of a source at least (a source with fewer words has blocks of one word).
BLOCK_WORDS = 4096
LEAST_BLOCKS = 256
#: Slot numbers that are ranked together, and documents that are placed together on average.
SLOT_CHUNK = 1 << 14
BUCKET_ROWS = 1024
#: No document is taken more often than this.
MOST_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = MOST_REPEATS) -> DataFrame:
    """Targets of a table (source, source_size, source_docs), one row a source.

    Sources by code point, null last, take the weights in turn and share the
    total.  A target stops at ``cap`` times its source's size and the excess is
    shared by weight among the others until none is above: the sources that
    stop are a prefix in order of cap / weight, so prefix sums find the level.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(order) - 1)
    numbered = numbered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights)).cast("int") + 1))
    numbered = numbered.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy(F.lit(0))
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "source_no")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    rest = rising.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    stepped = numbered.withColumn("level", level)
    stepped = stepped.withColumn("free", F.col("most") / F.col("weight") > F.col("level"))
    first_free = F.min(F.when(F.col("free"), F.struct(F.col("most") / F.col("weight"), F.col("source_no"), F.col("level")))).over(everything)
    stepped = stepped.withColumn("water", first_free["level"])
    return stepped.select("source", "source_no", "source_size", "source_docs", F.coalesce(F.least(F.col("most"), F.col("water") * F.col("weight")), F.col("most")).alias("target"))


def plan_sources(targets: DataFrame, block_words: int = BLOCK_WORDS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """Adds n_blocks, block_len (words of a block, a real number), goal (whole words to take), and low, high: the source's share of the unit interval."""
    size = F.col("source_size")
    blocks = F.greatest(F.lit(1), F.least(size, F.greatest(F.ceil(size / block_words), F.lit(least_blocks)))).cast("long")
    out = targets.withColumn("n_blocks", blocks).withColumn("block_len", size / F.col("n_blocks")).withColumn("goal", F.round("target").cast("long"))
    out = out.withColumn("slots", F.when(size > 0, F.ceil(F.col("goal") / F.col("block_len"))).otherwise(0).cast("long"))
    line = Window.partitionBy(F.lit(0)).orderBy("source_no")
    total = F.sum("slots").over(Window.partitionBy(F.lit(0)))
    high = F.sum("slots").over(line)
    # the upper end is a running sum of whole numbers, so the intervals meet exactly
    return out.withColumn("total_slots", total).withColumn("high", F.try_divide(high, total)).withColumn("low", F.try_divide(high - F.col("slots"), total))


def schedule(sources: DataFrame, slot_chunk: int = SLOT_CHUNK, surplus: float = 0.01) -> DataFrame:
    """Slots of the mix in order: slot, source_no, rank, block, words (of the block, from its start) for planned ``sources``.

    A few more slots than needed are drawn, as the ranks that a source gets
    differ from its share by a few; ranks past its goal are not served.
    """
    served = sources.filter("slots > 0")
    total, n = served.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    # each source needs `slots` ranks: draw until the shortest share has them too
    drawn = int(total * (1 + surplus)) + 64 * n
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    slots = sources.sparkSession.range(0, drawn, 1, max(1, min(4096, drawn // slot_chunk))).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", point - F.floor(point)).withColumn("chunk", F.floor(F.col("slot") / slot_chunk))
    # a point finds its source among those whose interval reaches into the point's piece of the line, one or two as a rule
    pieces = max(64, n)
    piece = lambda x: F.least(F.floor(x * pieces), F.lit(pieces - 1)).cast("long")
    cuts = served.select("source_no", "low", "high", "n_blocks", "source_size", "goal", "slots").withColumn("piece", F.explode(F.sequence(piece(F.col("low")), piece(F.col("high")))))
    slots = slots.withColumn("piece", piece(F.col("point"))).join(cuts, "piece").filter("point >= low and point < high").drop("piece", "low", "high")
    slots = slots.withColumn("near", F.row_number().over(Window.partitionBy("chunk", "source_no").orderBy("slot")) - 1)
    counts = slots.groupBy("chunk", "source_no").agg(F.count("*").alias("n"))
    prior = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("prior", F.coalesce(F.sum("n").over(prior), F.lit(0))).drop("n")
    ranked = slots.join(counts, ["chunk", "source_no"]).withColumn("rank", F.col("near") + F.col("prior"))
    ranked = ranked.filter(F.col("rank") < F.col("slots")).withColumn("block", F.col("rank") % F.col("n_blocks"))
    lo, hi = _edge("block"), _edge("block", 1)
    rounds = F.floor(F.col("rank") / F.col("n_blocks")) * F.col("source_size")
    left = F.col("goal") - rounds - lo
    return ranked.select("slot", "source_no", "rank", "block", F.greatest(F.lit(0), F.least(hi - lo, left)).cast("long").alias("words"))


def _edge(block: str, more: int = 0) -> Column:
    """First word of a block: the first (size mod n_blocks) blocks have one word more than the others."""
    return F.expr(f"({block} + {more}) * (source_size div n_blocks) + least({block} + {more}, source_size % n_blocks)")


def _block_of(word: str) -> Column:
    """The block that holds a word of the line."""
    return F.expr(
        f"case when ({word}) < (source_size % n_blocks) * (source_size div n_blocks + 1) then ({word}) div (source_size div n_blocks + 1)"
        f" else source_size % n_blocks + (({word}) - (source_size % n_blocks) * (source_size div n_blocks + 1)) div (source_size div n_blocks) end"
    )


def place(docs: DataFrame, sources: DataFrame, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``at``: the first word of each document on its source's shuffled line."""
    known = sources.select("source", "source_no", "source_size", "source_docs", "n_blocks")
    docs = docs.join(known, docs["source"].eqNullSafe(known["source"])).drop(known["source"])
    key = F.xxhash64("doc_id", F.lit(seed))
    docs = docs.withColumn("key", key)
    # as many buckets as rows in each, once a source is large: neither the buckets nor the table of buckets outgrows a task
    rows = F.greatest(F.lit(float(bucket_rows)), F.sqrt("source_docs"))
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col("source_docs") / rows)).cast("long")
    docs = docs.withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 11), n_buckets))
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    prior = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("prior", F.coalesce(F.sum("n").over(prior), F.lit(0))).drop("n")
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(sums, ["source_no", "bucket"]).withColumn("at", F.col("prior") + F.col("inside")).drop("prior", "inside", "key", "bucket")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), seed: int = 17, block_words: int = BLOCK_WORDS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for ``docs`` (doc_id, text, source): the words of each document that the mix takes."""
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    sources = stage(plan_sources(source_targets(totals, weights), block_words, least_blocks).coalesce(1), "mix-sources")
    blocks = schedule(sources).groupBy("source_no", "block").agg(F.count("*").alias("times"), F.sum("words").alias("sum_words"), F.max("words").alias("most_words"), F.min("words").alias("part_words"))
    placed = stage(place(sized, sources, seed), "mix-placed")
    span = placed.filter("size > 0")
    span = span.withColumn("block", F.explode(F.sequence(_block_of("at"), _block_of("at + size - 1"))))
    lo, hi = _edge("block"), _edge("block", 1)
    begin, end = F.greatest(lo, F.col("at")), F.least(hi, F.col("at") + F.col("size"))
    span = span.withColumn("begin", begin - lo).withColumn("end", end - lo).filter("end > begin")
    cut = F.least(F.col("end"), F.col("part_words")) - F.col("begin")
    whole = (F.col("times") - 1) * (F.least(F.col("end"), F.col("most_words")) - F.col("begin"))
    parts = span.join(blocks, ["source_no", "block"]).withColumn("words", F.greatest(F.lit(0), cut) + F.greatest(F.lit(0), whole))
    taken = parts.groupBy("source_no", "at").agg(F.sum("words").alias("taken"))
    goals = sources.select("source_no", "target")
    # documents without words share a place with the next one that has some
    have = placed.withColumn("spot", F.when(F.col("size") > 0, F.col("at")))
    out = have.join(taken.withColumnRenamed("at", "spot"), ["source_no", "spot"], "left").join(goals, "source_no")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: each document of ``docs`` as often as the mix takes it, to the nearest whole number.

    A document of which the mix takes less than half goes; one without words has nothing to take and stays once.
    Rows that repeat an id and text are given the same number together, dealt out the same way in every run.
    """
    names = docs.columns
    key = F.xxhash64("doc_id", "text")
    taken = mix_sources(docs.select(key.alias("doc_id"), "source", "text"), **options)
    times = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))).cast("long")
    # rows with the same key repeat each other: together they stay as often as all of them are taken
    copies = stage(taken.groupBy(F.col("doc_id").alias("__mix_key")).agg(F.sum(times).alias("__mix_all"), F.count("*").alias("__mix_rows")), "mix-copies")
    keyed = docs.withColumn("__mix_key", key)
    out = keyed.join(copies.filter("__mix_rows = 1"), "__mix_key").withColumn("__mix_n", F.col("__mix_all"))
    again = copies.sparkSession.read.schema(copies.schema).parquet(copies._staged_at).filter("__mix_rows > 1")
    if not again.isEmpty():
        # equal rows are counted first; what a key's rows are taken is dealt out by running sums over its different rows
        others = F.xxhash64(F.to_json(F.struct(*[c for c in names if c not in ("doc_id", "text")])))
        same = keyed.join(again, "__mix_key").groupBy("__mix_key", "__mix_all", "__mix_rows", others.alias("__mix_like")).agg(*[F.first(c).alias(c) for c in names], F.count("*").alias("__mix_same"))
        until = F.sum("__mix_same").over(Window.partitionBy("__mix_key").orderBy("__mix_like"))
        dealt = lambda n: F.expr(f"({n}) * __mix_all div __mix_rows")
        same = same.withColumn("__mix_until", until).withColumn("__mix_n", dealt("__mix_until") - dealt("__mix_until - __mix_same"))
        out = out.select(*names, "__mix_n").unionByName(same.select(*names, "__mix_n"))
    return out.filter("__mix_n > 0").withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_n")))).select(*names)
