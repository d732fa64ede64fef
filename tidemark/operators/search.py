"""Text search across all columns, label presence, expected-kind counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import local_frame, written


def search_text(df: DataFrame, separator: str = "||") -> Column:
    """Lower-cased text of every column (NULL as empty) joined by ``||``."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return F.lower(F.concat_ws(separator, *parts))


def text_search(df: DataFrame, needle: str) -> DataFrame:
    """Rows whose all-column text contains ``needle`` (case-insensitive)."""
    return df.filter(search_text(df).contains(needle.lower()))


def presence_modes(history: DataFrame, needles: Sequence[str], id_col: str = "migration_id",
                   status_col: str = "status") -> DataFrame:
    """``(needle, loose_found, strict_found)`` for every needle.

    Loose: some row's all-column text contains it, in any status.  Strict: some
    successful row's id starts with it.  One pass: each row yields the needles
    it has (a literal list, so the plan does not grow with it), which are
    aggregated and completed with the needles no row has.
    """
    wanted = local_frame(history.sparkSession, [(n,) for n in dict.fromkeys(needles)], "needle string")
    if not needles:
        return wanted.selectExpr("needle", "false AS loose_found", "false AS strict_found")
    rows = history.select(
        search_text(history).alias("_text"), F.lit(list(dict.fromkeys(needles))).alias("_needles"),
        F.when(F.col(status_col) == F.lit("success"), F.col(id_col).cast("string")).alias("_id"))
    hits = rows.selectExpr("""inline(filter(transform(_needles, n -> struct(
        n AS needle, contains(_text, lower(n)) AS loose, coalesce(startswith(_id, n), false) AS strict)),
        h -> h.loose OR h.strict))""")
    found = hits.groupBy("needle").agg(F.bool_or("loose").alias("_loose"), F.bool_or("strict").alias("_strict"))
    return wanted.join(found, "needle", "left").select(
        "needle", F.coalesce("_loose", F.lit(False)).alias("loose_found"),
        F.coalesce("_strict", F.lit(False)).alias("strict_found"))


def search_presence(df: DataFrame, needles: Sequence[str]) -> DataFrame:
    """Per needle: does any row's all-column text contain it (any status)?"""
    rows = df.select(search_text(df).alias("_text"), F.lit(None).cast("string").alias("migration_id"),
                     F.lit(None).cast("string").alias("status"))
    return presence_modes(rows, needles).select("needle", F.col("loose_found").alias("found"))


def strict_presence(history: DataFrame, needles: Sequence[str],
                    id_col: str = "migration_id", status_col: str = "status") -> DataFrame:
    """Per needle: is there a successful row whose id starts with it?"""
    return presence_modes(history, needles, id_col, status_col).select("needle", F.col("strict_found").alias("found"))


#: Characters of the pieces by which long labels find the rows that may have them.
GRAM = 8

#: A piece is frequent if it is more than one in so many of all; so there are fewer of them than that.
FREQUENT = 65_536


def _pieces(col: str, sizes: Sequence[int]) -> Column:
    """The distinct pieces of a text that are ``sizes`` characters long."""
    of_size = [f"CASE WHEN length({col}) >= {n} THEN transform(sequence(1, length({col}) - {n} + 1), "
               f"i -> substring({col}, i, {n})) ELSE cast(array() AS array<string>) END" for n in sizes]
    return F.expr(f"array_distinct(flatten(array({', '.join(of_size)})))")


def _index(texts: DataFrame, held: DataFrame, asked: DataFrame) -> DataFrame:
    """``row, piece`` of the texts' pieces but the frequent ones (by their number
    in ``held``) that no label asks for."""
    most = (held.agg(F.sum("n")).first()[0] or 0) // FREQUENT
    unasked = held.filter(F.col("n") > most).join(asked, "piece", "left_anti").select("piece")
    index = texts.select("row", F.explode(_pieces("text", [GRAM])).alias("piece"))
    return index.join(F.broadcast(unasked), "piece", "left_anti")


def labels_in_rows(rows: DataFrame, labels: DataFrame, text: Column | None = None) -> DataFrame:
    """``needle`` of the labels (``labels`` has a ``needle`` column) that some
    row's all-column text contains, letter case aside.

    The pieces of the rows' texts answer it, not every label on every row: the
    distinct pieces of up to ``GRAM`` characters and of the lengths that occur
    among the labels are counted.  A label of one piece is found by an equi join
    on them.  A longer one must have all its pieces there, and is looked for only
    in the rows that have its rarest one; there the text decides.  Rows are dealt
    to that join by their rare pieces and those that a label asks for, as most of
    a text is pieces that many rows have."""
    wanted = labels.filter("needle IS NOT NULL").select("needle", F.lower("needle").alias("low")).distinct()
    sizes = sorted(r.n for r in wanted.select(F.least(F.length("low"), F.lit(GRAM)).alias("n")).distinct().collect())  # GRAM + 1 at most
    if not sizes:
        return wanted.select("needle")
    # texts that agree in the hash are told apart where the text decides
    texts = rows.select((search_text(rows) if text is None else text).alias("text")).distinct() \
        .withColumn("row", F.xxhash64("text"))
    held = written(texts.select(F.explode(_pieces("text", sizes)).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n")),
                   "pieces")
    short = wanted.filter(F.length("low") <= GRAM).join(held, F.col("low") == F.col("piece"), "left_semi").select("needle")
    if sizes[-1] < GRAM:
        return short
    held = held.filter(F.length("piece") == GRAM)
    long = wanted.filter(F.length("low") > GRAM)
    own = long.select("low").distinct().select("low", F.explode(_pieces("low", [GRAM])).alias("piece"))
    rarest = written(
        own.join(held, "piece").groupBy("low").agg(F.min(F.struct("n", "piece")).alias("best"), F.count(F.lit(1)).alias("had"))
        .filter(F.col("had") == F.size(_pieces("low", [GRAM]))).select("low", F.col("best.piece").alias("piece")),
        "rarest-pieces")
    pairs = rarest.join(_index(texts, held, rarest), "piece").select("low", "row")
    found = pairs.join(texts, "row").filter(F.col("text").contains(F.col("low"))).select("low")
    return short.unionByName(long.join(found, "low", "left_semi").select("needle"))


def prefixes_in_ids(ids: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``needle`` of the labels that some id starts with: an equi join of the
    labels to the ids' prefixes, as long as the longest label."""
    wanted = labels.filter("needle IS NOT NULL").select("needle").distinct()
    most = wanted.agg(F.max(F.length("needle"))).first()[0] or 0
    text = F.col(id_col).cast("string")
    starts = ids.filter(text.isNotNull()).select(text.alias("id")).distinct().select(F.explode(F.expr(
        f"transform(sequence(0, least(length(id), {most})), n -> substring(id, 1, n))")).alias("needle"))
    return wanted.join(starts.distinct(), "needle", "left_semi")


def label_presence(history: DataFrame, labels: DataFrame, id_col: str = "migration_id",
                   status_col: str = "status") -> DataFrame:
    """:func:`presence_modes` for labels that are a table (``needle``) of any
    length: ``needle, loose_found, strict_found`` for each of them."""
    wanted = labels.filter("needle IS NOT NULL").select("needle").distinct()
    loose = labels_in_rows(history, wanted).withColumn("_loose", F.lit(True))
    done = history.filter(F.col(status_col) == F.lit("success"))
    strict = prefixes_in_ids(done, wanted, id_col).withColumn("_strict", F.lit(True))
    return wanted.join(loose, "needle", "left").join(strict, "needle", "left").select(
        "needle", F.coalesce("_loose", F.lit(False)).alias("loose_found"),
        F.coalesce("_strict", F.lit(False)).alias("strict_found"))


def kind_counts(items: DataFrame, kind_col: str, expected: Sequence[str]) -> DataFrame:
    """Count of items per expected kind, zero when none (unexpected kinds are
    not reported).  Items are aggregated first (partial aggregation), then the
    per-kind counts are joined to the parameter list."""
    spark = items.sparkSession
    counts = items.groupBy(F.col(kind_col).alias("kind")).agg(F.count(F.lit(1)).alias("_n"))
    wanted = local_frame(spark, [(k,) for k in expected], "kind string")
    return (wanted.join(counts, "kind", "left")
            .select("kind", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("found")))
