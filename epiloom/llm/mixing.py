"""Mix sources to target weights, in blocks of words, without collecting or sorting a source as a whole.

The documents of a source, one behind the other, are a stream of words that is cut into
blocks of a fixed number of words. A source's target says how many slots for blocks the mix has for it.
Its slots are dealt to the output shards by a multinomial draw, so that in each shard the counts of the
sources are those of independent draws by target weight, while each source's total is as planned.
In each shard a source has a range of slot numbers; a slot number is mapped to a block
by a pseudorandom permutation of the source's block numbers (one for each pass over
the source), and blocks are joined by number. Everything is made of DataFrame functions.

Nothing is gathered by source: streams are summed up in buckets of about `BUCKET_ROWS` documents, draws are made in
chunks of `CHUNK` slots, slots are unrolled for each source and shard, and joins are on the block.

Defined results: a null text has no words, like an empty one or one of only white space; such documents take
no part. A null source is a source of its own, the last one. Null and repeated ids, and repeated rows, are documents like any other:
each row is taken by its own place in the stream. Empty tables give empty results. Only the named columns are
read, so that further ones, of whatever name, don't matter. A rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiloom.functions.ordinals import number_rows
from epiloom.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 128
SHARD_BLOCKS = 8192
BUCKET_ROWS = 50_000
CHUNK = 16_384
ROUNDS = 12
PRIME = 2_147_483_647


def hashed(seed: str, *parts: Column, digits: int = 15) -> Column:
    """A number of `digits` hexadecimal digits from the parts."""
    text = F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def permuted(df: DataFrame, at: str, n: str, base: str) -> DataFrame:
    """`df` with the column `at`, from 0 to n-1, replaced by where a pseudorandom permutation takes it; `base` chooses the permutation.

    Swap or not (Hoang, Morris and Rogaway, 2012): in each round a number x is paired with key - x modulo n,
    and a bit that depends on the pair alone says whether it goes there. Any n will do. A projection for each round, in generated code.
    """
    others = [c for c in df.columns if c != at]
    for r in range(1, ROUNDS + 1):
        key = f"(({base} * {(2 * r + 1) * 1_000_003}L + {r * 7919}L) % {PRIME}L)"
        df = df.selectExpr(*others, at, f"pmod({key} - {at}, {n}) AS _other")
        df = df.selectExpr(*others, at, "_other", f"(greatest({at}, _other) + {key}) % {PRIME}L AS _pair")
        df = df.selectExpr(*others, f"CASE WHEN (_pair * _pair) % {PRIME}L % 2 = 1 THEN _other ELSE {at} END AS {at}")
    return df


def sized(docs: DataFrame, words: bool = False) -> DataFrame:
    """doc_id, source, size (number of words) and, on request, the words; bucket and tie order the documents of a source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    held = [F.regexp_extract_all(text, F.lit(WORD), 0).alias("words")] if words else []
    found = docs.select("doc_id", "source", size.alias("size"), F.md5(text.cast("binary")).alias("tie"), *held)
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    key = hashed("bucket", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digits=8)
    return stored(found.withColumn("bucket", key % buckets), "sized")


def targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """source, rank, source_size and target from (source, source_size).

    The targets share `percent` of all words by the weights, which repeat in the order of the sources; no target is above `most` times its
    source, and what that leaves over is shared by weight again until none is. A row for each source.
    """
    named = sizes.withColumn("absent", F.col("source").isNull())
    named = number_rows(named, "absent", "source", [], "number").withColumn("rank", F.col("number") - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    named = named.select("source", "rank", "source_size", weight.cast("bigint").alias("weight"))
    named = stored(named.withColumn("cap", F.col("source_size") * most), "sources")
    total = named.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, free = named.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        before = level
        level = level if free is None else (total * percent - 100 * (capped or 0)) / (100 * free)
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return named.select("source", "rank", "source_size", target.alias("target"))


def streams(docs: DataFrame, weights: Sequence[int], percent: int, most: int, block: int, words: bool = False) -> tuple[DataFrame, DataFrame]:
    """The sources with rank, source_size, target, blocks and slots; the documents with source_size, target, rank and start (words of the stream before)."""
    found = sized(docs, words)
    sums = stored(found.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket")), "bucket-sums")
    sources = targets(sums.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, percent, most)
    blocks = F.ceil(F.col("source_size") / block).cast("bigint")
    wanted = F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5).cast("bigint")
    slots = F.when(F.col("source_size") > 0, F.least(F.col("blocks") * most, wanted)).otherwise(F.lit(0))
    sources = stored(sources.withColumn("blocks", blocks).withColumn("slots", slots.cast("bigint")), "targets")
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "offset", "rank", "source_size", "target"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(stored(offsets, "offsets"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return sources, placed.withColumn("start", F.col("offset") + F.col("inside")).drop("s", "b", "offset", "inside", "tie", "bucket")


def shard_counts(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: str = "mix") -> DataFrame:
    """rank, blocks, shard, count: how many slots of a source are in each shard, by a multinomial draw."""
    spark = sources.sparkSession
    many = sources.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-many // shard_blocks))
    chunks = sources.where("slots > 0").select(
        "rank", "blocks", "slots", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})")).alias("chunk")
    )
    chunks = chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rank", "chunk")
    draws = chunks.select(
        "rank", "blocks", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(slots, (chunk + 1) * {CHUNK}) - 1)")).alias("k")
    )
    shard = hashed(seed, F.col("rank"), F.col("k")) % shards
    return draws.groupBy("rank", "blocks", shard.alias("shard")).agg(F.count(F.lit(1)).alias("count"))


def shard_slots(counts: DataFrame, seed: str = "mix") -> DataFrame:
    """rank, shard, slot (number of the slot in its source), round (passes over the source before) and block."""
    ahead = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.withColumn("first", F.coalesce(F.sum("count").over(ahead), F.lit(0)))
    # A source's shards leave the window in one task; they are dealt anew before their slots are unrolled.
    ranges = ranges.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "shard")
    slots = ranges.select("rank", "blocks", "shard", F.explode(F.expr("sequence(first, first + count - 1)")).alias("slot"))
    slots = slots.withColumn("round", F.expr("slot div blocks"))
    base = hashed(seed + "-order", F.col("rank"), F.col("round"), digits=7)
    slots = slots.withColumn("base", base).withColumn("block", F.col("slot") % F.col("blocks"))
    # Stored: the plan of the mix, and Spark would push what it infers for later joins through all rounds.
    return stored(permuted(slots, "block", "blocks", "base").select("rank", "shard", "slot", "round", "block"), "slots")


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """A row for each document and block that it has words in: block, piece (words of the document before it) and length."""
    whole = placed.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    piece = F.greatest(F.col("start"), F.col("block") * block) - F.col("start")
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.col("start")
    return whole.withColumn("piece", piece).withColumn("length", end - piece)


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS, seed: str = "mix",
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words that the mix takes of the row, repeats counted)."""
    sources, placed = streams(docs, weights, percent, most, block)
    placed = stored(placed, "placed")
    slots = shard_slots(stored(shard_counts(sources, shard_blocks, seed), "shard-counts"), seed)
    used = slots.groupBy(F.col("rank").alias("r"), F.col("block").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    parts = pieces(placed, block)
    both = parts.join(used, (F.col("rank") == F.col("r")) & (F.col("block") == F.col("b")), "left")
    taken = F.sum(F.col("length") * F.coalesce("times", F.lit(0))).cast("bigint")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    # Each row with words has a place of its own in its source's stream.
    whole = both.groupBy("rank", "start", *columns).agg(taken.alias("taken"))
    rest = placed.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    return whole.select(*columns, "taken").union(rest.select(*columns, "taken"))


def mixed_blocks(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS, seed: str = "mix",
) -> DataFrame:
    """The mix itself: shard, place (order of the slots within a shard), source, block, doc_ids and text, the block's words by single spaces."""
    sources, placed = streams(docs, weights, percent, most, block, words=True)
    parts = pieces(stored(placed, "placed-words"), block)
    text = F.array_join(F.slice("words", F.col("piece").cast("int") + 1, F.col("length").cast("int")), " ")
    held = F.struct("start", "doc_id", text.alias("text"))
    # At most `block` documents have words in a block.
    whole = parts.groupBy("source", "rank", "block").agg(F.sort_array(F.collect_list(held)).alias("held"))
    slots = shard_slots(stored(shard_counts(sources, shard_blocks, seed), "shard-counts"), seed)
    return slots.join(whole, ["rank", "block"]).select(
        "shard", hashed(seed + "-place", F.col("rank"), F.col("slot")).alias("place"), "source", "block",
        F.col("held.doc_id").alias("doc_ids"), F.array_join("held.text", " ").alias("text"),
    )
