"""Line dedup: lines that many documents share stay in one document only.

Lines are exploded with their position, normalised and hashed to 128 bits; an aggregate with map-side
combine finds the hashes of enough documents; the positions to drop go back to their document, which is
cut into the slices between them. A line that a third of all documents holds costs one partial
aggregate per task, and the join on its hash is one that AQE splits.

Defined results: a null or empty text is one empty line; a row with a null id neither drops nor takes
part; rows of one id are one document as far as counting goes, and each row is cut by its own text; an
empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import BLANKS, ascii_lower, discard, free_name, staged, text_key


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
) -> DataFrame:
    """``docs`` with ``text_col`` reduced to the kept lines, plus ``n_lines`` and ``n_dropped``.

    Lines whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more are
    dropped except in the document with the smallest id. If ``docs`` has columns of these names, the counts' names have
    underscores before them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"), text.alias("_text"))
    lines = base.select("_id", "_t", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    keyed = lines.select("_id", "_t", "_pos", line_key(F.col("_line")).alias("_key")).where(F.length("_key") >= min_chars)
    # written, as it is read twice
    keyed = staged(keyed.select("_id", "_t", "_pos", F.xxhash64("_key").alias("_h"), F.xxhash64(F.lit(1), F.col("_key")).alias("_g")), "line-keys")

    if min_docs == 2:
        common = keyed.groupBy("_h", "_g").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first < _last")
    else:
        each = keyed.select("_h", "_g", "_id").distinct()
        common = each.groupBy("_h", "_g").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where(F.col("_n") >= min_docs)
    # written: AQE splits the join on a hot line only where no aggregate stands between join and shuffle
    common = staged(common.select("_h", "_g", "_first"), "line-common")
    drops = (
        keyed.join(common, ["_h", "_g"])
        .where(F.col("_id") != F.col("_first"))
        .groupBy("_id", "_t")
        .agg(F.array_sort(F.collect_set("_pos")).alias("_drop"))
    )
    drops = staged(drops, "line-drops")
    discard(keyed, common)
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # so that no other column can clash with the names used here
    at = docs.select(packed.alias("_row"), F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"))
    joined = at.join(drops, ["_id", "_t"], "left")
    own = F.col("_row").getField(text_col)
    split, ends = F.split(own, "\n", -1), F.concat(F.array(F.lit(-1)), F.col("_drop"), F.array(F.size(F.split(own, "\n", -1))))
    # the lines between two dropped positions are one slice: linear in lines and drops
    joined = joined.withColumn("_cut", F.when(F.col("_drop").isNotNull(), F.struct(split.alias("lines"), ends.alias("ends"))))
    end = lambda k: F.get(F.col("_cut.ends"), k)
    cuts = F.transform(F.sequence(F.lit(0), F.size("_drop")), lambda k: F.slice(F.col("_cut.lines"), end(k) + 2, end(k + 1) - end(k) - 1))
    kept = F.when(F.col("_drop").isNull(), own).otherwise(F.array_join(F.flatten(cuts), "\n"))
    n_lines = F.length(F.coalesce(own, F.lit(""))) - F.length(F.replace(F.coalesce(own, F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *[(kept if c == text_col else F.col("_row").getField(c)).alias(c) for c in docs.columns],
        n_lines.cast("long").alias(free_name(docs, "n_lines")),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias(free_name(docs, "n_dropped")),
    )
