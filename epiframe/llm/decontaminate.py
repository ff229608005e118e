"""Benchmark decontamination by a prefix-filtered join of item windows with document words.

A window is ten consecutive words of a benchmark item (or a whole shorter item). Words are ordered by how
rare they are over all documents; as a window counts only when it is contained whole, its necessary prefix is its
single rarest word. A document word joins the windows of which it is the prefix; the window's start
follows from the word's position in it, must leave room for the whole window (position and length
bound), and the window's words are then compared one by one.

The windows of one block of items are sent to the tasks. A block has ``block_words`` words at most on
average, so what is broadcast is bounded by a parameter; a larger benchmark is gone through in several blocks, each
against all documents, and a document's findings are united.

Defined results: a null text has no words; an item without words or with a null text makes no window; a
null item_id marks words but is not listed; repeated items count once; repeated rows of a document are
each reported; an empty table on either side gives no hits.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import staged, text_key

#: Fixed: 0-9, a-z and all bytes from 128 are word bytes, A-Z are lower-cased, all others part words.
TO_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def windows_of(items: pd.DataFrame, width: int) -> dict[tuple[bytes, ...], set[str]]:
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item_id, text in items.itertuples(index=False):
        words = words_of(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            who = found.setdefault(tuple(words[i : i + width]), set())
            if item_id is not None and item_id == item_id:
                who.add(item_id)
    return found


def rarity(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> Counter:
    """How often each word of ``vocabulary`` occurs in all documents; the answer is no larger than the question."""
    sc = docs.sparkSession.sparkContext
    wanted = sc.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        known = wanted.value
        for b in batches:
            for t in b.column(0):
                seen.update(filter(known.__contains__, words_of(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    counts = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Counter({bytes(r.word): r.n for r in counts.toLocalIterator()})


def scan_block(docs: DataFrame, items: pd.DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id_col, _t, n_words, hits, items`` of every row against the windows of one block of items."""
    windows = windows_of(items, width)
    often = rarity(docs, text_col, {w for x in windows for w in x})
    table: dict[bytes, list[tuple[int, list[bytes], list[str]]]] = {}
    for window, who in windows.items():
        at = min(range(len(window)), key=lambda i: (often[window[i]], window[i], i))
        table.setdefault(window[at], []).append((at, list(window), sorted(who)))
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = sent.value
        known = prefix.__contains__
        for b in batches:
            n_words, hits, found = [], [], []
            for t in b.column(2):
                words = words_of(t.as_py())
                spans, who = [], set()
                for i in [i for i, yes in enumerate(map(known, words)) if yes]:
                    for at, window, ids in prefix[words[i]]:
                        start, end = i - at, i - at + len(window)
                        if start >= 0 and end <= len(words) and words[start:end] == window:
                            spans.append((start, end))
                            who.update(ids)
                spans.sort()
                merged: list[dict] = []
                for start, end in spans:
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], end)
                    else:
                        merged.append({"start": start, "end": end})
                n_words.append(len(words))
                hits.append(merged)
                found.append(sorted(who))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(hits, span), pa.array(found, pa.list_(pa.string()))], ["id", "_t", "n_words", "hits", "items"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("_t"), text_col)
    return rows.mapInArrow(run, f"id {kind}, _t long, n_words long, hits array<struct<start:long,end:long>>, items array<string>")


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    block_words: int = 500_000,
) -> DataFrame:
    """``id_col, text_hash, n_words, hits, items``: word spans that benchmark windows cover, and whose they are.

    ``hits`` are disjoint, ordered spans ``start, end`` in words, end exclusive.
    """
    items = bench.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 6 / block_words))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    parts = [scan_block(docs, items.where(F.col("block") == k).select("item", "text").toPandas(), id_col, text_col, width) for k in range(blocks)]
    if blocks == 1:
        return parts[0].select(F.col("id").alias(id_col), F.col("_t").alias("text_hash"), "n_words", "hits", "items")
    # several blocks: every row once from the first, with the findings of the others
    rows = staged(parts[0], "decontaminate")
    more = parts[1].where(F.size("hits") > 0)
    for p in parts[2:]:
        more = more.union(p.where(F.size("hits") > 0))
    more = more.groupBy("id", "_t").agg(F.flatten(F.collect_set("hits")).alias("h"), F.flatten(F.collect_set("items")).alias("i"))
    more = more.withColumnsRenamed({"id": "_id", "_t": "_u"})
    both = rows.join(more, rows.id.eqNullSafe(more._id) & (rows._t == more._u), "left")
    spans = F.array_sort(F.concat("hits", F.coalesce("h", F.array().cast("array<struct<start:long,end:long>>"))))
    start = F.array().cast("array<struct<start:long,end:long>>")

    def merge(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return both.select(
        F.col("id").alias(id_col),
        F.col("_t").alias("text_hash"),
        "n_words",
        F.aggregate(spans, start, merge).alias("hits"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i", F.array().cast("array<string>"))))).alias("items"),
    )


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window.

    Rows with null ids or texts, repeated rows and columns of any name stay as they are; of rows that share an id, only those whose own text has a
    window go.
    """
    found = contamination(docs, bench, id_col, text_col, **options).where(F.size("hits") > 0)
    found = found.select(F.col(id_col).alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("hash"))
    kept = rows.join(found, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
