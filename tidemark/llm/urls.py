"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

The labelled URLs are those that a rule fits.  Trees are boosted (Spark ML) on a
bounded, documented sample of them and score every URL from its text alone:
lengths, depth, shares of digits and letters, character entropy, parameter
counts, and statistics of the host's suffix and of the path's first segment over
all labelled URLs.  Only DataFrame functions and Spark ML are used.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

SAMPLE = 20_000
PRIOR = 20.0
BROADCAST_SUFFIXES = 100_000
FEATURES = ["u_length", "u_host_length", "u_path_length", "u_labels", "u_depth", "u_digits", "u_host_digits",
            "u_letters", "u_upper", "u_dashes", "u_entropy", "u_params", "u_query_length", "u_fragment", "u_secure",
            "u_last_length", "u_extension", "u_www", "u_suffix_share", "u_suffix_count", "u_head_share", "u_head_count"]
FOLDS = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; the path then up to ``?``, ``#`` or the end.  Both are
    empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(url.isNotNull() & (at > 0), F.substring(url, at + 3, F.length(url))).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls where none fits.

    A rule is ``(verdict, "host/path")``; it fits its host and all subdomains,
    if the path starts with the rule's.  Of rules as long, the first in
    alphabetic order counts."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def _share(text: Column, kind: str) -> Column:
    size = F.greatest(F.length(text), F.lit(1))
    return F.length(F.regexp_replace(text, f"[^{kind}]", "")) / size


def features(pages: DataFrame) -> DataFrame:
    """``pages`` (with ``__url, __host, __path``) and the lexical features."""
    url, host, path = F.col("__url"), F.col("__host"), F.col("__path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    last = F.element_at(F.split(path, "/"), -1)
    # entropy of the characters from their counts: log n - sum(c log c) / n
    pages = pages.withColumn("__letters", F.split(url, ""))
    counts = F.expr("transform(array_distinct(__letters), "
                    "x -> cast(size(array_remove(__letters, x)) as double))")  # the others' number
    n = F.size("__letters").cast("double")
    pages = pages.withColumn("__n", n).withColumn("__others", counts)
    entropy = F.when(F.col("__n") > 0, F.log("__n") - F.expr(
        "aggregate(__others, 0D, (s, o) -> s + (__n - o) * ln(__n - o))") / F.col("__n")).otherwise(0.0)
    cols = {
        "u_length": F.length(url), "u_host_length": F.length(host), "u_path_length": F.length(path),
        "u_labels": F.size(F.split(host, r"\.")), "u_depth": F.size(F.split(path, "/")) - 1,
        "u_digits": _share(url, "0-9"), "u_host_digits": _share(host, "0-9"), "u_letters": _share(url, "A-Za-z"),
        "u_upper": _share(url, "A-Z"), "u_dashes": _share(url, "_-"), "u_entropy": entropy,
        "u_params": F.length(F.regexp_replace(query, "[^=]", "")), "u_query_length": F.length(query),
        "u_fragment": url.contains("#"), "u_secure": url.startswith("https"),
        "u_last_length": F.length(last), "u_extension": last.contains("."), "u_www": host.startswith("www."),
    }
    return pages.select("*", *[c.cast("double").alias(k) for k, c in cols.items()]).drop("__letters", "__n", "__others")


def _with_share(base: DataFrame, labelled: DataFrame, key: str, name: str, prior: float) -> DataFrame:
    """Add ``u_<name>_share`` and ``u_<name>_count``: how large a share of the
    labelled URLs with the same ``key`` is blocked (smoothed toward ``prior``),
    and how many there are (as a logarithm).

    A labelled URL's own fold is left out of its numbers.  Leaving out just its
    own label would give the label away: of two URLs with one key, the blocked
    one would always see the smaller share."""
    fold = F.pmod(F.xxhash64("__url"), F.lit(FOLDS)).cast("int")
    block, one = (F.col("__ruled") == "block").cast("double"), F.lit(1.0)
    stats = written(labelled.groupBy(key).agg(*[
        F.array(*[F.sum(F.when(fold == k, x).otherwise(0.0)) for k in range(FOLDS)]).alias(n)
        for n, x in (("__blocks", block), ("__all", one))]), name)
    if stats.count() <= BROADCAST_SUFFIXES:
        stats = F.broadcast(stats)  # checked
    joined = base.join(stats, key, "left")

    def seen(column: str) -> Column:
        every = F.expr(f"aggregate({column}, 0D, (s, x) -> s + x)")
        own = F.when(F.col("__ruled").isNotNull(), F.get(column, fold)).otherwise(0.0)
        return F.coalesce(every - own, F.lit(0.0))

    return joined.withColumns({
        f"u_{name}_share": (seen("__blocks") + PRIOR * prior) / (seen("__all") + PRIOR),
        f"u_{name}_count": F.log1p(seen("__all"))}).drop("__blocks", "__all")


def _suffix(host: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host, ".", -2)


def judged(pages: DataFrame, rules: list[tuple[str, str]], sample: int = SAMPLE, seed: int = 7,
           id_col: str = "page_id", url_col: str = "url", hidden: Column | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` (and ``score``, the trees' chance
    that a URL is to be blocked; null where a rule decides) for every row.

    The trees are fitted to the ``sample`` labelled URLs of lowest hash (each
    URL once).  With no labelled URL, or labels of one kind, there is nothing to
    learn: URLs without a rule get that kind, and ``allow`` if there is none.
    Null and empty URLs have empty features and are judged like others; an
    empty table gives no rows; other columns are not read.

    ``hidden`` (a condition on ``page_id`` and ``rule``) names rows whose rule
    the method does not see: it learns nothing from them and judges them itself,
    so that its verdicts can be held against the rules'.
    """
    spark = pages.sparkSession
    base = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    base = base.withColumn("__host", host).withColumn("__path", path)
    rule, ruled = rule_of(F.col("__host"), F.col("__path"), rules)
    base = base.withColumn("rule", rule).withColumn("__ruled", ruled).withColumn("__suffix", _suffix(F.col("__host")))
    base = base.withColumn("__head", F.regexp_extract("__path", r"^/([^/]*)", 1))
    if hidden is not None:
        base = base.withColumn("__ruled", F.when(~F.coalesce(hidden, F.lit(False)), F.col("__ruled")))
    labelled = base.filter("__ruled is not null")
    block = (F.col("__ruled") == "block").cast("double")
    blocks, all_ = labelled.agg(F.coalesce(F.sum(block), F.lit(0.0)), F.count(F.lit(1)).cast("double")).first()
    plain = F.col("__ruled")
    out = ["page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), "rule"]
    if blocks in (0.0, all_):
        other = F.lit("block" if blocks else "allow")
        return base.select(*out, F.coalesce(plain, other).alias("verdict"), F.lit(None).cast("double").alias("score"))
    prior = blocks / all_
    base = _with_share(base, labelled, "__suffix", "suffix", prior)
    base = _with_share(base, labelled, "__head", "head", prior)
    full = features(base)
    picked = (full.filter("__ruled is not null").dropDuplicates(["__url"])
              .orderBy(F.xxhash64("__url"), "__url").limit(sample))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__features")
    train = written(picked.select("__url", *FEATURES, (F.col("__ruled") == "block").cast("double").alias("__label"))
                    .coalesce(1).sortWithinPartitions("__url"), "url-sample")
    if train.select("__label").distinct().count() < 2:
        other = F.lit("block" if prior >= 0.5 else "allow")
        return base.select(*out, F.coalesce(plain, other).alias("verdict"), F.lit(None).cast("double").alias("score"))
    model = GBTClassifier(featuresCol="__features", labelCol="__label", maxIter=20, maxDepth=4, stepSize=0.2,
                          seed=seed).fit(assembler.transform(train))
    scored = model.transform(assembler.transform(full))
    score = F.when(plain.isNull(), F.element_at(_to_array(F.col("probability")), 2))
    verdict = F.coalesce(plain, F.when(score >= 0.5, "block").otherwise("allow"))
    return scored.select(*out, verdict.alias("verdict"), score.alias("score"))


def _to_array(vector: Column) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(vector)
