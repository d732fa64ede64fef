"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: the bytes its target weight asks for
over the bytes it has.  Every document inverts a Poisson distribution with that
mean at a uniform number hashed from the seed and its id, is repeated that many
times, and the copies are shuffled over all partitions by a hashed key.

A mean above ``MEAN_MAX`` is the sum of equal smaller means, each drawn by its
own hashed number (a sum of independent Poisson numbers is one), so the table
inverted stays short and a high rate is spread over rows before it is drawn.
Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import unused
from tidemark.llm.common import packed_rows, unpacked

MEAN_MAX = 8.0
TERMS = 64          # P(more than 64 | mean 8) is below 1e-35
BROADCAST_SOURCES = 50_000
SPLIT = 4096


def _uniform(seed: int, *parts: str):
    """A number in (0, 1) from the first 52 bits of an MD5."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_rates(docs: DataFrame, weights: dict[str, float], default_weight: float = 1.0,
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``__source, __bytes, __rate``: one row per source that occurs.

    Weights are shares of the bytes of all documents, relative to the sum over
    the sources that occur; a source not listed has ``default_weight`` and a
    null source counts as the source ''.  A source without any bytes cannot
    reach a share; its rate is 1 unless its weight is 0.
    """
    sums = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("__source")).agg(
        F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit("")))).cast("double").alias("__bytes"))
    weight = F.lit(float(default_weight))
    if weights:
        listed = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, float(v))])
        weight = F.coalesce(listed[F.col("__source")], weight)
    sums = sums.withColumn("__weight", weight)
    total, weights_sum = sums.agg(F.sum("__bytes"), F.sum("__weight")).first()
    share = F.col("__weight") / F.lit(weights_sum) * F.lit(total)
    return sums.select(
        "__source", "__bytes",
        F.when(F.col("__weight") <= 0, 0.0).when(F.col("__bytes") == 0, 1.0)
        .otherwise(share / F.col("__bytes")).alias("__rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """Add ``__draws`` (how many draws make a document's count) and ``__cdf``
    (P(count <= k) of one draw, k = 0 .. TERMS)."""
    rates = rates.withColumn("__draws", F.greatest(F.lit(1), F.ceil(F.col("__rate") / MEAN_MAX)).cast("long"))
    rates = rates.withColumn("__mean", F.col("__rate") / F.col("__draws"))
    cdf = F.expr(f"""aggregate(sequence(1, {TERMS}),
        struct(exp(-__mean) AS p, exp(-__mean) AS c, array(exp(-__mean)) AS t),
        (s, k) -> struct(s.p * __mean / k AS p, s.c + s.p * __mean / k AS c,
                         concat(s.t, array(s.c + s.p * __mean / k)) AS t),
        s -> s.t)""")
    return rates.withColumn("__cdf", cdf)


def mix(docs: DataFrame, weights: dict[str, float], seed: int = 0, default_weight: float = 1.0,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``draw, copy, shuffle_key``, a row per copy.

    ``(draw, copy)`` tells a document's copies apart.  Rows with the same id
    draw the same counts; a null id draws as the id ''.  An empty table gives
    an empty table.  All columns of ``docs`` keep their names and values; an
    added column whose name is taken has underscores after it.  Within a
    partition rows are in the order of the shuffle key, and the key's hash picks
    the partition, so the whole is a random order that a rerun repeats.
    """
    rates = poisson_table(source_rates(docs, weights, default_weight, source_col, text_col)).cache()
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)  # checked: at most 50,000 rows of about 600 bytes
    keyed = docs.select(packed_rows(docs).alias("row"), F.col(id_col).alias("id"),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("__source")).join(rates, "__source")
    # a long list of draws is made in two steps so that no row holds it whole
    drawn = (keyed.withColumn("block", F.explode(F.expr(f"sequence(0L, (__draws - 1) div {SPLIT})")))
             .withColumn("draw", F.explode(F.expr(
                 f"sequence(block * {SPLIT}L, least(__draws - 1, block * {SPLIT}L + {SPLIT - 1}))"))))
    drawn = drawn.withColumn("u", _uniform(seed, "id", "draw"))
    drawn = drawn.withColumn("n", F.expr("size(filter(__cdf, c -> c < u))"))
    copies = drawn.filter("n > 0").withColumn("copy", F.explode(F.expr("sequence(1, n)")))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(
        "|", F.lit(f"order {seed}"), F.coalesce(F.col("id").cast("string"), F.lit("")), "draw", "copy")))
    names = zip(("draw", "copy", "shuffle_key"), unused(docs.columns, "draw", "copy", "shuffle_key"))
    return (copies.select("row", "draw", "copy", "shuffle_key")
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key")
            .select(*unpacked(docs, "row"), *[F.col(c).alias(name) for c, name in names]))
