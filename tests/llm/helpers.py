"""Small tables with the awkward rows every operator must take."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOC_SCHEMA):
    return spark.createDataFrame(rows, schema)


def docs(spark, texts, sources=None, first=0):
    sources = sources or ["s"] * len(texts)
    return frame(spark, [(first + i, t, "en", s, None if t is None else len(t))
                         for i, (t, s) in enumerate(zip(texts, sources))])


def prose(seed, n_docs, vocabulary=40, words=(0, 60), lines=False):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(vocabulary)]
    out = []
    for _ in range(n_docs):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(*words))]
        if out and rnd.random() < 0.4:  # a passage of an earlier text
            old = rnd.choice(out).split()
            if old:
                a = rnd.randrange(len(old))
                at = rnd.randint(0, len(w))
                w[at:at] = old[a:a + rnd.randint(1, 30)]
        out.append(" ".join(w))
    if lines:
        out = [t.replace(" w1 ", "\n").replace(" w2 ", "\n").replace(" w3 ", "\n") for t in out]
    return out


#: Names that operators use for helper columns, now or before.
CLASH = ["doc", "text_hash", "row", "hash", "none", "own", "own_hash", "marks", "pos", "id", "n", "u", "block", "kept",
         "__doc", "__hash", "__mean", "__source", "__score", "__id", "__count", "__u", "__rate", "__text", "__slot",
         "text_to_score", "part", "place", "at", "start", "n_lines_", "ids", "w1", "w2"]


def unchanged(rows, base):
    """All columns but the text hold what the input's have."""
    return {r.asDict()[c] for r in rows for c in base.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")} == {
        "clash"}


def awkward(spark, frame_):
    """The rows again with null ids and texts, repeats and columns that clash."""
    from pyspark.sql import functions as F
    more = frame(spark, [(None, "no id", "en", "s", 5), (900, None, None, None, None), (901, "", "en", "s", 0),
                         (901, "", "en", "s", 0), (902, "x " * 30000, "en", "t", 60000)])
    clash = [*CLASH, "score", "size", "shard", "slot", "fp", "component_id", "draw", "copy", "shuffle_key", "n_lines",
             "n_removed", "rank", "length", "sequence_id", "offset", "rule", "verdict", "mark", "found"]
    both = frame_.unionByName(more).unionByName(frame_.limit(1))
    return both.select("*", *[F.lit("clash").alias(c) for c in clash])
