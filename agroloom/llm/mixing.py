"""Mixing sources to target weights with blocks of fixed length.

The words of a source's documents form one stream, cut into blocks. Each output shard draws a multinomial
number of slots per source; a source's slots are numbered through all shards, and slot number k takes block
``permutation(k mod blocks)`` of epoch ``k div blocks``, so blocks and slots meet in a join by index.
Only sizes travel; texts are read where whole documents are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.llm.text import WORD, own_columns
from agroloom.operators.scale import null_safe_join, row_numbers
from agroloom.session import checkpointed

BLOCK_WORDS = 1024
SHARD_BLOCKS = 1024
REPEAT_LIMIT = 3
WEIGHTS = (1, 2, 3)
CELLS = 4096  # parts of a source in which offsets are summed up
ROUNDS = 24  # at least
SEED = 20


def permuted(x: Column, n: Column, stream: Column, backwards: bool = False) -> Column:
    """Pseudorandom permutation of 0..n-1 by swap-or-not rounds; each round is its own inverse.

    Each round leaves about half of the places, so for large n there are enough rounds to leave 1 in 256 n."""
    last = F.greatest(F.lit(ROUNDS), F.ceil(F.log2(n.cast("double"))).cast("int") + 8) - 1
    rounds = F.sequence(last, F.lit(0)) if backwards else F.sequence(F.lit(0), last)

    def swap(at: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(stream, i, F.lit("k")), n) + n - at, n)
        return F.when(F.pmod(F.xxhash64(stream, i, F.greatest(at, other)), F.lit(2)) == 1, other).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), swap)


def prefix_sums(df: DataFrame, rank: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all smaller ranks, in two steps so that no task sorts more than a chunk."""
    chunked = df.withColumn("__chunk", F.floor(F.col(rank) / 8192))
    before = Window.partitionBy("__chunk").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy("__chunk").agg(F.sum(value).alias("__sum"))
    all_before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("__chunk", F.coalesce(F.sum("__sum").over(all_before), F.lit(0)).alias("__base"))
    out = chunked.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    return out.join(chunks, "__chunk").withColumn(name, F.col(name) + F.col("__base")).drop("__chunk", "__base")


def with_targets(sources: DataFrame, limit: int = REPEAT_LIMIT) -> DataFrame:
    """Targets by weight, stopped at ``limit`` times the size; the excess goes to the others by weight until all fit."""
    capped, most = F.col("weight") * F.col("__level") > limit * F.col("source_size"), limit * F.col("source_size")
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level, last = 0.0, -1
    while True:
        r = (
            sources.withColumn("__level", F.lit(level))
            .agg(
                F.sum(F.when(capped, most).otherwise(0)).alias("full"),
                F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("free"),
                F.count(F.when(capped, 1)).alias("n"),
            )
            .first()
        )
        if r["n"] == last or not r["free"]:
            break
        level, last = (total - r["full"]) / r["free"], r["n"]
    target = F.least(F.col("weight") * F.lit(level), most.cast("double"))
    return sources.withColumn("target", target.cast("double"))


def source_plan(sized: DataFrame, block: int) -> DataFrame:
    """One row per source: rank s, size, target, whole epochs, words and slots of the last one."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = row_numbers(sources, [], [F.col("source").asc_nulls_last()], "s")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = ranked.withColumn("s", F.col("s") - 1).withColumn("weight", F.element_at(weights, (F.col("s") % len(WEIGHTS) + 1).cast("int")))
    plan = with_targets(checkpointed(ranked))
    whole = F.col("source_size") > 0
    want = F.least(F.round("target").cast("long"), REPEAT_LIMIT * F.col("source_size"))
    plan = plan.withColumn("want", want).withColumn("epochs", F.when(whole, F.floor(F.col("want") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumns(
        {
            "rest": F.col("want") - F.col("epochs") * F.col("source_size"),
            "blocks": F.greatest(F.ceil(F.col("source_size") / block), F.lit(1)),
        }
    )
    plan = plan.withColumn("lack", F.col("blocks") * block - F.col("source_size"))  # words missing in the last block
    stream = F.struct("s", "epochs", F.lit(SEED))
    plan = plan.withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), stream, backwards=True))
    least = F.ceil(F.col("rest") / block)
    reached = least * block - F.when(F.col("short_at") < least, F.col("lack")).otherwise(0)
    last_slots = F.when(F.col("rest") <= 0, 0).when(reached >= F.col("rest"), least).otherwise(least + 1)
    plan = plan.withColumn("slots", F.when(whole, F.col("epochs") * F.col("blocks") + last_slots).otherwise(0).cast("long"))
    return checkpointed(prefix_sums(plan, "s", "slots", "slots_before"))


def drawn_slots(plan: DataFrame, block: int, shard_blocks: int) -> DataFrame:
    """shard, s, k, epoch, block, take of every slot.

    Shard counts are multinomial with the sources' shares. A source's draws beyond its slots are left out; a source
    that has drawn too few gets the rest in one more shard, so that its words come out exactly.
    """
    spark = plan.sparkSession
    r = plan.agg(F.sum("slots").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total, cells = int(r["t"] or 0), max(CELLS, r["n"])
    width = max(1, -(-total // cells))
    shards = -(-total // shard_blocks)
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard_blocks).alias("shard"), F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(max(total, 1))).alias("x")
    )
    draws = draws.withColumn("cell", F.floor(F.col("x") / width))
    some = plan.where("slots > 0")
    last = F.col("slots_before") + F.col("slots") - 1
    reach = some.select("s", "slots", "slots_before", F.explode(F.sequence(F.floor(F.col("slots_before") / width), F.floor(last / width))).alias("cell"))
    hit = draws.join(reach, "cell").where("x >= slots_before and x < slots_before + slots")
    counts = hit.groupBy("shard", "s").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    drawn = counts.groupBy("s").agg(F.sum("n").alias("first"))
    runs = counts.join(some, "s").withColumn("end", F.least(F.col("first") + F.col("n"), F.col("slots"))).drop("n")
    rest = some.join(drawn, "s", "left").withColumn("first", F.coalesce("first", F.lit(0))).withColumns({"end": F.col("slots"), "shard": F.lit(shards)})
    # a run of few bytes holds many slots, so runs are dealt out before they are unrolled
    slots = runs.unionByName(rest).where("first < end").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "s")
    slots = slots.withColumn("k", F.explode(F.sequence(F.col("first"), F.col("end") - 1)))
    slots = slots.withColumns({"epoch": F.floor(F.col("k") / F.col("blocks")), "r": F.col("k") % F.col("blocks")})
    slots = slots.withColumn("block", permuted(F.col("r"), F.col("blocks"), F.struct("s", "epoch", F.lit(SEED))))
    length = block - F.when(F.col("block") == F.col("blocks") - 1, F.col("lack")).otherwise(0)
    done = F.col("r") * block - F.when(F.col("short_at") < F.col("r"), F.col("lack")).otherwise(0)
    take = F.when(F.col("epoch") == F.col("epochs"), F.least(length, F.col("rest") - done)).otherwise(length)
    return slots.select("shard", "s", "k", "epoch", "block", take.alias("take")).where("take > 0")


def laid_out(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Each document's place ``first`` in its source's stream; (s, cell, row) names a document."""
    known = null_safe_join(sized, plan.select("source", "s", "source_size", "target", "epochs", "want"), ["source"])
    known = known.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(CELLS)))
    sums = known.groupBy("s", "cell").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "cell", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    order = Window.partitionBy("s", "cell").orderBy("doc_id", "text_hash", "size")
    own = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = known.withColumns({"own": own, "row": F.row_number().over(order)})
    return null_safe_join(placed, sums, ["s", "cell"]).withColumn("first", F.col("base") + F.col("own")).drop("base", "own")


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row per document: doc_id, text_hash, size, source_size, target, epochs, taken, parts.

    ``taken`` counts the words the mix takes, repeats included; ``parts`` lists (from, words) of the last, partial epoch.
    Null texts have no words; a null source is a source of its own, the last. Repeated rows are documents of their own;
    documents without words are taken 0 times. The same rows give the same mix in any order or partitioning.
    """
    sized = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = checkpointed(sized)
    plan = source_plan(sized, block)
    slots = drawn_slots(plan, block, shard_blocks)
    use = F.struct("take", "epoch")
    uses = slots.groupBy("s", "block").agg(F.collect_list(use).alias("uses"))  # one for each epoch at most
    last = F.col("first") + F.col("size") - 1
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("first") / block), F.floor(last / block)))
    pieces = laid_out(sized, plan).withColumn("block", F.explode_outer(blocks))
    start = F.greatest(F.col("first"), F.col("block") * block)
    end = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block)
    pieces = pieces.withColumns({"at": start - F.col("block") * block, "from": start - F.col("first"), "words": end - start})
    # Spark judges the slots by the few bytes of the runs that they were unrolled from, and would broadcast them all
    pieces = null_safe_join(pieces, uses.hint("merge"), ["s", "block"])

    def overlap(u: Column) -> Column:
        return F.greatest(F.least(F.col("words"), u["take"] - F.col("at")), F.lit(0))

    taken = F.aggregate(F.col("uses"), F.lit(0).cast("long"), lambda n, u: n + overlap(u))
    late = F.aggregate(F.filter("uses", lambda u: u["epoch"] == F.col("epochs")), F.lit(0).cast("long"), lambda n, u: n + overlap(u))
    pieces = pieces.withColumns({"taken": F.coalesce(taken, F.lit(0)), "late": F.coalesce(late, F.lit(0))})
    part = F.when(F.col("late") > 0, F.struct("from", F.col("late").alias("words")))
    whole = ["s", "cell", "row", "doc_id", "text_hash", "size", "source_size", "target", "epochs"]
    out = pieces.groupBy(*whole).agg(F.sum("taken").alias("taken"), F.array_sort(F.collect_list(part)).alias("parts"))
    return out.drop("s", "cell", "row")


def mix_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


@own_columns
def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole epoch of a document, and one with the words
    that the last epoch takes of it (joined by one space, unless it is the whole text)."""
    names = docs.columns
    marked = docs.withColumns({"__id": F.col("doc_id"), "__hash": F.coalesce(F.xxhash64("text"), F.lit(0))})
    plans = mixed(docs).where("taken > 0").groupBy("doc_id", "text_hash")
    plans = plans.agg(F.array_sort(F.collect_list(F.struct("epochs", "size", "parts"))).alias("__plans"))
    plans = plans.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    # rows with the same key and text share their plans, one each; a mix usually has none
    same = Window.partitionBy("__id", "__hash").orderBy(F.col("source").asc_nulls_last())
    rows = null_safe_join(marked.withColumn("__n", F.row_number().over(same)), plans, ["__id", "__hash"], "inner")
    rows = rows.withColumn("__plan", F.get("__plans", F.col("__n") - 1)).where("__plan is not null")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.flatten(F.transform("__plan.parts", lambda p: F.slice(words, (p["from"] + 1).cast("int"), p["words"].cast("int"))))
    late = F.aggregate("__plan.parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    piece = F.when(late == F.col("__plan.size"), F.col("text")).when(late > 0, F.array_join(cut, " "))
    copies = F.concat(F.array_repeat(F.col("text"), F.col("__plan.epochs").cast("int")), F.when(late > 0, F.array(piece)).otherwise(F.array().cast("array<string>")))
    out = rows.withColumn("text", F.explode(copies))
    return out.select(*[F.col(f"`{c}`") for c in names])
