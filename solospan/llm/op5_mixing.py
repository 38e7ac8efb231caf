"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words; the targets become integer quotas
of equal blocks of ``block_words`` words by highest quotients (Sainte-Laguë),
first over the sources and then, within a source, over its shards of about
``shard_rows`` documents.  In a shard the documents stand in seeded order, laid
end to end on a line of blocks; the quota takes the shard's blocks in that
order, round by round, so a document is taken whole except at the quota's end.

A source of any size is spread over shards by a hash of id and text; no task
holds more than a shard.  The table of sources is broadcast while it has at
most ``BROADCAST_SOURCES`` rows, otherwise joined by shuffle.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 are taken 0 times; repeated rows count each
for itself; an empty table gives no rows; other columns are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solospan.llm.common import WORD, checkpointed, plain_names

WEIGHTS = (3, 1, 2)
BROADCAST_SOURCES = 100_000
SEED = 5


def sainte_lague(rows: DataFrame, weight: str, seats: str, key: str, within: list[str]) -> DataFrame:
    """``rows`` and a column ``won``: the ``seats`` of each group ``within``, allocated to its rows by highest quotients.

    Rounding ``weight / (total / seats)`` misses the total by at most half the
    number of rows; the seats over or under are settled among the quotients
    next in turn.  A row can gain or lose no more than its share of that
    difference and one seat, so only so many quotients of a row are listed.
    Ties go to the smaller key.
    """
    group = Window.partitionBy(*within)
    w, base = F.col(weight), F.col("_base")
    rounded = F.floor(w * F.col(seats) / F.col("_total") + 0.5)
    rows = (
        rows.withColumn("_total", F.sum(weight).over(group))
        .withColumn("_n", F.count("*").over(group))
        .withColumn("_base", F.when(F.col("_total") > 0, rounded).otherwise(F.lit(0)).cast("long"))
        .withColumn("_miss", F.when(F.col("_total") > 0, F.col(seats) - F.sum("_base").over(group)).otherwise(F.lit(0)))
    )
    most = (F.ceil(w / F.col("_total") * F.col("_n") / 2) + 1).cast("int")
    turns = F.when(F.col("_miss") > 0, most).when(F.col("_miss") < 0, F.least(most, base.cast("int"))).otherwise(F.lit(0))
    turns = F.when(turns > 0, F.sequence(F.lit(0), turns - 1)).otherwise(F.array().cast("array<int>"))
    quotient = F.when(F.col("_miss") > 0, w / (2 * (base + F.col("_turn")) + 1)).otherwise(-w / (2 * (base - F.col("_turn")) - 1))
    # of equal quotients the smaller key's counts more: it gains first and loses last
    tie = (F.when(F.col("_miss") > 0, F.col(key)).asc(), F.when(F.col("_miss") < 0, F.col(key)).desc())
    rank = F.row_number().over(group.orderBy(F.col("_quotient").desc(), *tie))
    settled = (
        rows.select(*within, key, weight, "_base", "_miss", F.explode(turns).alias("_turn"))
        .withColumn("_quotient", quotient)
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= F.abs("_miss"))
        .groupBy(*within, key)
        .agg((F.count("*") * F.max(F.signum("_miss"))).cast("long").alias("_more"))
    )
    return rows.join(settled, [*within, key], "left").withColumn("won", base + F.coalesce("_more", F.lit(0))).drop("_total", "_n", "_base", "_miss", "_more")


def source_targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) and their ``target`` words.

    The weights 3, 1, 2 repeat over the sources by code point.  A target is
    ``least(most * size, level * weight)``, with the level at which the targets
    add up to ``share`` of all sizes: resharing the excess of full sources by
    weight, until none is above its stop, ends there.  With the sources in
    the order in which they fill up, the level is the largest of what would
    remain for each unit of weight if just the sources before were full.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (nth % len(WEIGHTS) + 1).cast("int"))
    every = Window.partitionBy()
    filling = Window.orderBy(F.col("_stop") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("_stop").over(before), F.lit(0.0))
    rest = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    return (
        sources.withColumn("_weight", weight)
        .withColumn("_stop", most * F.col("source_size"))
        .withColumn("_level", (share * F.sum("source_size").over(every) - full) / rest)
        .withColumn("target", F.least("_stop", F.max("_level").over(every) * F.col("_weight")))
        .drop("_weight", "_stop", "_level")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` and ``size`` (words), ``_src`` (the source, never null) and ``_hash`` (seeded, of id and text)."""
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "_src": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
            "_hash": F.xxhash64(F.lit(SEED), "doc_id", "text"),
        }
    )


def _shard(shards: Column) -> Column:
    return F.pmod(F.xxhash64("_hash", F.lit(1)), shards)


def quotas(rows: DataFrame, block_words: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """The sources (with target and number of shards) and the shards (with blocks and quota) of the sized rows."""
    totals = rows.groupBy("_src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    sources = source_targets(totals).withColumn("_shards", F.ceil(F.col("_rows") / shard_rows))
    sources = sources.withColumn("_blocks", F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"))
    sources = checkpointed(sainte_lague(sources, "target", "_blocks", "_src", []).withColumnRenamed("won", "_won").drop("_blocks", "_rows"))
    some = sources.select("_src", "source_size", "target", "_shards", "_won")
    if sources.count() <= BROADCAST_SOURCES:
        some = F.broadcast(some)
    shards = rows.join(some, "_src").groupBy("_src", "_won", _shard(F.col("_shards")).alias("_shard")).agg(F.sum("size").alias("_words"))
    shards = sainte_lague(shards, "_words", "_won", "_shard", ["_src"]).withColumn("_blocks", F.ceil(F.col("_words") / block_words))
    return some, shards.select("_src", "_shard", "_blocks", F.least("won", 2 * F.col("_blocks")).alias("_quota"))


def take(rows: DataFrame, sources: DataFrame, shards: DataFrame, block_words: int) -> DataFrame:
    """The sized rows and source_size, target, taken and ``_rounds``, ``_cut``: whole copies, and words of the last, cut copy."""
    line = Window.partitionBy("_src", "_shard").orderBy("_hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(line), F.lit(0))
    end = F.pmod(F.col("_quota"), F.col("_blocks")) * block_words
    rounds = F.when(F.col("_blocks") > 0, F.floor(F.col("_quota") / F.col("_blocks"))).otherwise(F.lit(0))
    cut = F.when(F.col("_blocks") > 0, F.greatest(F.lit(0), F.least("size", end - F.col("_start")))).otherwise(F.lit(0))
    out = (
        rows.join(sources, "_src")
        .withColumn("_shard", _shard(F.col("_shards")))
        .withColumn("_start", start)
        .join(shards, ["_src", "_shard"])
        .withColumn("_rounds", rounds)
        .withColumn("_cut", cut)
        .withColumn("taken", (F.col("_rounds") * F.col("size") + F.col("_cut")).cast("long"))
    )
    return out.drop("_src", "_hash", "_shards", "_won", "_shard", "_start", "_blocks", "_quota")


def mix_sources(docs: DataFrame, block_words: int = 8, shard_rows: int = 2048) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (doc_id, text, source)."""
    rows = checkpointed(sized(docs.select("doc_id", "text", "source")).drop("text"))
    out = take(rows, *quotas(rows, block_words, shard_rows), block_words)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, block_words: int = 8, shard_rows: int = 2048) -> DataFrame:
    """The mix: each document as many times as it is taken whole, and its first words where the quota ends in it (n_chars follows).

    Null and empty texts have no words and are never taken; a null source is a
    source; each repeat of a row counts for itself.  All other columns come back
    as they are, whatever their names; an empty table stays empty.
    """
    kept = plain_names(docs, "doc_id", "text", "source", "n_chars")
    rows = checkpointed(sized(kept.select("doc_id", "text", "source")).drop("text"))
    out = take(sized(kept), *quotas(rows, block_words, shard_rows), block_words)
    whole = F.col("_cut") == F.col("size")
    rounds = F.col("_rounds") + F.when(whole & (F.col("size") > 0), 1).otherwise(0)
    rest = F.when(whole, F.lit(0)).otherwise(F.col("_cut"))
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_rest").cast("int")), " ")
    copies = F.concat(
        F.array_repeat(F.lit(0), rounds.cast("int")), F.when(rest > 0, F.array(rest.cast("int"))).otherwise(F.array().cast("array<int>"))
    )
    out = out.select(*kept.columns, F.explode(copies).alias("_rest")).withColumn("text", F.when(F.col("_rest") > 0, first_words).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_rest") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*kept.columns).toDF(*docs.columns)
