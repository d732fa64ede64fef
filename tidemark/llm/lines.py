"""Line dedup over windows of three consecutive lines.

Every window of three lines is hashed (128 bits); a window that occurs more
than once stays where it occurs first, in the order (doc_id, position), and
each later occurrence marks the lines it covers.  A document loses the union of
its marked lines.  Windows are judged on the input.  Only hashes are shuffled
to find the repeats; the text moves once, with its marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import unused
from tidemark.llm.common import packed_rows, unpacked, written

WINDOW = 3


def window_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``w1, w2, doc, text_hash, pos``: a row per window of three lines."""
    lines = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"),
                        F.split(F.col(text_col), "\n", -1).alias("l"))
    at = "l[i], l[i + 1], l[i + 2]"
    windows = lines.filter(F.size("l") >= WINDOW).select("doc", "text_hash", F.posexplode(F.expr(
        f"transform(sequence(0, size(l) - {WINDOW}), "
        f"i -> struct(xxhash64({at}) AS w1, xxhash64('second', {at}) AS w2))")))
    return windows.select("col.w1", "col.w2", "doc", "text_hash", "pos")


def later_occurrences(windows: DataFrame) -> DataFrame:
    """``doc, text_hash, pos`` of every occurrence but a window's first."""
    here = F.struct("doc", "text_hash", "pos")
    # written, so that the join can split the rows of a very frequent window over tasks
    repeated = written(windows.groupBy("w1", "w2").agg(F.min(here).alias("first"), F.max(here).alias("last"))
                       .filter("first < last").drop("last"), "repeated-windows")
    return (windows.join(repeated, ["w1", "w2"])
            .filter(here > F.col("first")).select("doc", "text_hash", "pos"))


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, marks = batch.column("text"), batch.column("marks")
        kept, n_lines, n_removed = [], [], []
        for text, mark in zip(texts, marks):
            text = text.as_py()
            if text is None or not mark.is_valid:
                kept.append(text)
                n_lines.append(0 if text is None else text.count("\n") + 1)
                n_removed.append(0)
                continue
            lines = text.split("\n")
            covered = np.zeros(len(lines), bool)
            starts = mark.values.to_numpy()
            for k in range(WINDOW):
                covered[starts + k] = True
            kept.append("\n".join(x for x, c in zip(lines, covered) if not c))
            n_lines.append(len(lines))
            n_removed.append(int(covered.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()),
             pa.array(n_removed, pa.int64())], ["row", "kept", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_lines, n_removed``.

    Lines are split at newlines and compared exactly.  A null text stays null
    (no lines), one of fewer than three lines stays as it is, and one whose
    lines are all marked becomes ''.  Rows that agree in id and text are one
    document read twice: they keep and lose the same lines.  Rows that share
    only the id are ordered by a hash of their text.  All columns of ``docs``
    keep their names and, but for the text, their values; an added column whose
    name is taken has underscores after it.
    """
    windows = window_occurrences(docs, id_col, text_col)
    marks = (later_occurrences(windows).groupBy("doc", "text_hash")
             .agg(F.collect_set("pos").alias("marks")))  # at most one document's lines
    keyed = docs.select(packed_rows(docs, text_col).alias("row"), F.col(text_col).alias("text"),
                        F.col(id_col).alias("own"), F.xxhash64(text_col).alias("own_hash"))
    marked = (keyed.join(marks, F.col("own").eqNullSafe(F.col("doc")) & (F.col("own_hash") == F.col("text_hash")), "left")
              .select("row", "text", "marks"))
    schema = T.StructType([marked.schema["row"], T.StructField("kept", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = marked.mapInArrow(_drop_lines, schema)
    lines, removed = unused(docs.columns, "n_lines", "n_removed")
    return done.select(*unpacked(docs, "row", {text_col: F.col("kept")}),
                       F.col("n_lines").alias(lines), F.col("n_removed").alias(removed))
