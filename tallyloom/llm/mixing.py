"""Mixing sources to target weights with built-in functions only.

Sources get equal-word blocks by Sainte-Lague apportionment: each next block goes to the highest quotient
``target / (2 * blocks + 1)``. A source's blocks are dealt to its shards by the same rule. Within a
shard the documents stand end to end in seeded order and its blocks are taken from the start, twice
round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, fresh, word_count

# Weights of the sources in code point order, repeated.
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Source, source_size and target words of each source from rows (source, size).

    All targets sum to ``share`` of all sizes. A target stops at ``most`` times its source's size and
    the rest is shared again by weight. With caps in order of cap / weight, a source is capped if and only if
    its cap is below its share of what the earlier ones left, so one window replaces the rounds.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn("weight", F.get(listed, (place - 1) % len(weights))).withColumn(
        "cap", F.col("source_size") * most
    )
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    spread = (
        weighed.withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        )
        .withColumn("capped", F.col("cap") < F.col("level") * F.col("weight"))
    )
    capped = F.col("capped")
    level = (F.col("total") - F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).over(everything)) / (
        F.col("weights") - F.sum(F.when(capped, F.col("weight")).otherwise(0.0)).over(everything)
    )
    return spread.withColumn("final", level).select(
        "source",
        "source_size",
        F.when(capped, F.col("cap")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def apportion(units: DataFrame, by: list[str], key: list[str], weight: str, seats: str) -> DataFrame:
    """Add ``quota``: Sainte-Lague seats of each unit within its group ``by``; ties go to the smaller key.

    Rounding each share leaves a few seats too many or too few. Only the next quotients that can be
    among those are ranked: as many rows as seats are missing, and a few for each unit.
    """
    group = Window.partitionBy(*by)
    share = F.col(weight) / F.sum(weight).over(group)
    rounded = (
        units.withColumn("_share", F.coalesce(F.when(F.col(weight) > 0, share), F.lit(0.0)))
        .withColumn("_seats", F.floor(F.col("_share") * F.col(seats) + 0.5))
        .withColumn("_left", F.col(seats) - F.sum("_seats").over(group))
        .withColumn("_units", F.count(F.lit(1)).over(group))
    )
    reach = (F.ceil(F.col("_share") * (F.abs("_left") + F.col("_units"))) + 1).cast("long")
    lacking = F.col("_left") > 0
    steps = (
        F.when(F.col(weight) <= 0, F.array().cast("array<bigint>"))
        .when(lacking, F.sequence(F.lit(1).cast("long"), reach))
        .when(
            (F.col("_left") < 0) & (F.col("_seats") > 0),
            F.sequence(F.lit(0).cast("long"), F.least(reach, F.col("_seats")) - 1),
        )
        .otherwise(F.array().cast("array<bigint>"))
    )
    tried = rounded.withColumn("_step", F.explode_outer(steps)).withColumn(
        "_quotient",
        F.when(lacking, F.col(weight) / (2 * (F.col("_seats") + F.col("_step")) - 1)).otherwise(
            F.col(weight) / (2 * (F.col("_seats") - F.col("_step")) - 1)
        ),
    )
    ties = [F.col(k).asc_nulls_last() for k in key]
    ranked = tried.withColumn(
        "_rank",
        F.row_number().over(
            group.orderBy(
                F.when(lacking, -F.col("_quotient")).otherwise(F.col("_quotient")).asc_nulls_last(),
                *[F.when(lacking, t).otherwise(None) for t in map(F.col, key)],
                *[t.desc_nulls_first() for t in map(F.col, key)],
            )
        ),
    )
    change = F.when(F.col("_step").isNull() | (F.col("_rank") > F.abs("_left")), 0).otherwise(F.signum("_left"))
    kept = [c for c in units.columns if c not in by + key]
    return (
        ranked.withColumn("_change", change)
        .groupBy(*by, *key)
        .agg(*[F.first(c).alias(c) for c in kept], (F.first("_seats") + F.sum("_change")).cast("long").alias("quota"))
    )


def _hash_number(seed: str, key: Column) -> Column:
    """Thirty-two bits of md5, as other engines compute them too."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    seed: str = "mix",
    block_words: int = 32,
    shard_words: int = 500_000,
    weights=WEIGHTS,
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, size and any others) with source_size, target and taken.

    ``taken`` is the number of the row's words in the mix, ``most`` times its size at most. Sources (null is
    one of them) come near their target by half a block. Rows that agree in doc_id and size may swap
    places. Size null counts as 0; an empty table gives an empty result. Columns of ``docs`` named like a
    result column are replaced.
    """
    docs = docs.drop("source_size", "target", "taken")
    shard, lo, quota, total, n, of_source, of_shard, source_quota = fresh(
        docs.columns, "shard", "lo", "quota", "shard_size", "shards", "of_source", "of_shard", "source_quota"
    )
    docs = docs.withColumn("size", F.coalesce(F.col("size"), F.lit(0)).cast("long"))
    targets = source_targets(docs.select("source", "size"), weights, share, most)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words)
    by_source = apportion(targets.withColumn("blocks", blocks), [], ["source"], "target", "blocks").select(
        F.col("source").alias(of_source),
        "source_size",
        "target",
        F.col("quota").alias(source_quota),
        F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).alias(n),
    )
    same_source = F.col("source").eqNullSafe(F.col(of_source))
    placed = (
        docs.join(by_source, same_source)
        .drop(of_source)
        .withColumn(shard, _hash_number(f"{seed}:shard:", F.col("doc_id")) % F.col(n))
    )
    shards = placed.groupBy("source", shard).agg(
        F.sum("size").alias(total), F.first(source_quota).alias(source_quota)
    )
    dealt = apportion(shards, ["source"], [shard], total, source_quota).select(
        F.col("source").alias(of_source), F.col(shard).alias(of_shard), F.col("quota").alias(quota), total
    )
    order = Window.partitionBy("source", shard).orderBy(
        F.md5(F.concat(F.lit(f"{seed}:order:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")),
        "doc_id",
        "size",
    )
    lined = placed.withColumn(
        lo, F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    words = F.least(F.col(quota) * block_words, F.col(total) * most)
    rounds = F.when(F.col(total) > 0, F.floor(words / F.col(total))).otherwise(0)
    rest = words - rounds * F.col(total)
    taken = rounds * F.col("size") + F.greatest(F.least(F.col("size"), rest - F.col(lo)), F.lit(0))
    return (
        lined.join(dealt, same_source & (F.col(shard) == F.col(of_shard)))
        .withColumn("taken", taken.cast("long"))
        .select(*docs.columns, "source_size", "target", "taken")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, its words; null text has none."""
    return docs.withColumn("size", F.coalesce(word_count(F.col("text")), F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole copies of a document and, for the rest, its first words.

    A document taken less than once is cut behind its last word taken. Columns are those of ``docs``;
    ``n_chars``, if there, follows the text. Rows with no words taken go.
    """
    if {"size", "source_size", "target", "taken", "part"} & {c.lower() for c in docs.columns}:
        raise ValueError("a column of the documents is named like a column of the mix")
    mix_rows = mix(sized(docs), **options).where(F.col("taken") > 0)
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    parts = F.concat(
        F.array_repeat(F.col("size").cast("int"), whole),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")),
    )
    pieces = F.regexp_extract_all(F.col("text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(F.col("part") == F.col("size"), F.col("text")).otherwise(
        F.array_join(F.slice(pieces, 1, F.col("part")), "")
    )
    out = mix_rows.withColumn("part", F.explode(parts)).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
