"""SimHash near-dedup by multi-index hashing.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word shingles. Each distinct fingerprint is filed under the
values of its two 32-bit segments. Of two fingerprints at 2 or fewer differing bits, either the low
segments are equal or the high ones are within one bit, so a fingerprint looks up its own low value and the ball
of radius one around its high value (of two values at one bit, the smaller looks for the larger);
what a bucket returns is verified by the complete distance. Segments of 32 bits keep chance meetings few at billions of
fingerprints.

A bucket of more than ``dense`` fingerprints is a cloud of near copies, where meeting all pairs would make the square of its
size. Those that look into one are keyed by the other segment as well: by the whole fingerprint under each value of the ball of radius
one. An entry is one key and a bit mask that tells which neighbours it has, two primitive values that combine map-side, 65 members at
most; they are linked to one of them. Of two fingerprints at distance 2 that meet in an entry both hang on the same hub,
so no link is lost, and rows are linear in the cloud.

Defined results: a null text has no words, so fingerprint zero; a null id joins its component without
being its name, and a component of null ids only has a null name; repeated rows are repeated in the
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import discard, staged
from epiframe.llm.graph import components

SEED = 42


def _votes(hashes: np.ndarray) -> int:
    """Majority vote of 64-bit hashes, as a signed integer."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, size: int = 3) -> int:
    """Majority vote of the shingles' hashes, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only, as the contract has it
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    return _votes(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), dtype="<u8")) % (1 << 64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _bit(b: Column | int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(b) if isinstance(b, int) else b)


def links(fps: DataFrame, dense: int = 64) -> DataFrame:
    """Edges ``u, v`` that join all fingerprints of the column ``fp`` (distinct) at 2 or fewer differing bits."""
    low, high = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.call_function("shiftrightunsigned", F.col("fp"), F.lit(32))
    of_low = low + F.lit(1 << 32)  # keys of the low segment's table
    filed = fps.select(F.explode(F.array(high, of_low)).alias("key"), F.col("fp").alias("v"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda b: F.col("high").bitwiseAND(_bit(b)) == 0)
    ball = F.concat(F.array(F.col("high"), F.col("low")), F.transform(bits, lambda b: F.col("high") + _bit(b)))
    looked = fps.select("fp", high.alias("high"), of_low.alias("low")).select(F.col("fp").alias("u"), F.posexplode(ball).alias("at", "key"))
    crowded = staged(filed.groupBy("key").count().where(F.col("count") > dense).select("key"), "simhash-dense")
    if crowded.isEmpty():
        return _verified(looked, filed)
    cloud = staged(looked.join(crowded, "key").select(F.col("u").alias("fp")).distinct(), "simhash-cloud")
    return _verified(looked, filed.join(crowded, "key", "left_anti")).union(cloud_links(cloud))


def _verified(looked: DataFrame, filed: DataFrame) -> DataFrame:
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))).between(1, 2)
    return looked.join(filed, "key").where(near & ((F.col("at") > 1) | (F.col("u") < F.col("v")))).select("u", "v")


def cloud_links(fps: DataFrame) -> DataFrame:
    """The same edges up to those that a hub stands for, in rows linear in the fingerprints however close they lie."""
    own = fps.select(F.col("fp").alias("key"), F.lit(0).cast("long").alias("mask"), F.lit(1).alias("own"))
    flips = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    table = own.union(flips.select(F.col("fp").bitwiseXOR(_bit(F.col("bit"))).alias("key"), _bit(F.col("bit")).alias("mask"), F.lit(0).alias("own")))
    table = table.groupBy("key").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own")).where(F.bit_count("mask") + F.col("own") > 1)
    members = table.select("key", "own", F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("mask").bitwiseAND(_bit(b)) != 0).alias("bits"))
    hub = F.when(F.col("own") == 1, F.col("key")).otherwise(F.col("key").bitwiseXOR(_bit(F.element_at("bits", 1))))
    edges = members.select("key", hub.alias("v"), F.explode("bits").alias("bit")).select(F.col("key").bitwiseXOR(_bit(F.col("bit"))).alias("u"), "v")
    return edges.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``id_col, fp, component_id``: the smallest id that links of 2 or fewer differing bits reach."""
    docs_fp = staged(fingerprints(docs, id_col, text_col, size), "simhash")
    fps = staged(docs_fp.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-fps")
    roots = components(links(fps.select("fp")))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    # written, so that AQE can split the join on a fingerprint that a third of all documents have
    named = staged(named.join(names, "root").select("fp", "component_id"), "simhash-names")
    return docs_fp.join(named, "fp").select(id_col, "fp", "component_id")


def _shingle_set(text: str, size: int) -> set[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size))))) if len(words) >= size else {b" ".join(words)}


def _shingle_hashes(text: str, size: int) -> np.ndarray:
    """Distinct signed hashes of the shingles, ascending."""
    shingles = _shingle_set(text, size)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), dtype=np.uint64, count=len(shingles)).view(np.int64))


def _frequent(texts: DataFrame, size: int, share: int = 16, least: int = 4, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of shingles that are frequent in a sample. They order shingles, so they bear on cost only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(_shingle_hashes(t.as_py(), size))], ["h"])

    sample = texts.where(F.pmod(F.xxhash64("_id"), F.lit(share)) == 0).select("_id", "_text").mapInArrow(run, "h long")
    found = sample.groupBy("h").count().where(F.col("count") >= least).orderBy(F.desc("count"), "h").limit(most).collect()
    h, n = np.array([r["h"] for r in found], np.int64), np.array([r["count"] for r in found], np.int64)
    order = h.argsort()
    return h[order], n[order]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, rounds: int = 2) -> DataFrame:
    """``id_col, group_id`` of rows whose sets of ``size``-word shingles have a Jaccard similarity of ``similarity`` or more.

    Equal texts are one text first. Fingerprints over the shingle sets and multi-index hashing then join the closest texts,
    whatever the size of their group. Fingerprints alone would lose links, as two texts at a similarity of 0.8 differ by ten bits,
    give or take five; a set join finds the rest. In any one order of all shingles, two sets that are similar share one of
    their first ``n - ceil(similarity * n) + 1`` (n is a set's size), so these are a text's entries; rare shingles
    come first, which keeps tables small in a crowd that shares a template. In ``rounds`` rounds each table entry's texts
    are tried against one of them, the one with the fewest shingles of its own at first, and similar ones are joined. Then all pairs of
    an entry's texts that are not yet in one group are tried, so no link between groups is lost. All candidates are verified on
    whole texts.

    The group's id is its smallest row id; null texts are empty; rows of one id with several texts belong to a group by each; rows with
    a null id are groups of their own (null group); an empty table gives an empty result; other columns are ignored.
    """
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    key = F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), F.col("_text")).alias("b"))
    ids = staged(base.select(F.col("_id").alias(id_col), key.alias("_k")), "near-ids")
    # each distinct text under a number of its own
    texts = base.groupBy(key.alias("_k")).agg(F.min("_id").alias("_first"), F.first("_text").alias("_text"))
    texts = staged(texts.withColumn("_id", F.monotonically_increasing_id()).select("_id", "_text", "_first", "_k"), "near-texts")
    common, counts = _frequent(texts, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                b = whole.slice(start, 1000)
                hs, sizes, prints = [np.zeros(0, np.int64)], [], []
                for t in b.column(1):
                    h = _shingle_hashes(t.as_py(), size)
                    prints.append(_votes(h))
                    if len(common):
                        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                        h = h[np.argsort(np.where(common[at] == h, counts[at], 0), kind="stable")]
                    sizes.append(len(h))
                    hs.append(h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1])
                lengths = [len(h) for h in hs[1:]]
                rows = np.repeat(np.arange(len(b)), lengths)
                places = np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in lengths)])
                names = ["h", "_id", "n", "at"]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs)), b.column(0).take(pa.array(rows)), pa.array(np.array(sizes, np.int32)[rows]), pa.array(places)], names)
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), b.column(0), pa.array(sizes, pa.int32()), pa.array([-1] * len(b), pa.int32())], names)

    both = staged(texts.select("_id", "_text").mapInArrow(run, "h long, _id long, n int, at int"), "near-entries")
    entries = both.where("at >= 0")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, set[bytes]] = ("", {b""})
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                if (t := y.as_py()) != last[0]:
                    last = (t, _shingle_set(t, size))
                mine = _shingle_set(x.as_py(), size)
                same = len(mine & last[1])
                keep.append(same >= similarity * (len(mine) + len(last[1]) - same))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def similar(pairs: DataFrame) -> DataFrame:
        """Of pairs ``u, v`` those whose texts are similar."""
        pairs = staged(pairs.distinct(), "near-pairs")
        with_u = pairs.join(texts.select(F.col("_id").alias("u"), F.col("_text").alias("tu")), "u")
        with_v = with_u.join(texts.select(F.col("_id").alias("v"), F.col("_text").alias("tv")), "v").select("u", "v", "tu", "tv")
        found = staged(with_v.mapInArrow(verify, "u long, v long"), "near-links")
        discard(pairs)
        return found

    # tables by fingerprint: each text against its fingerprint's first, and these against those of 2 or fewer other bits
    prints = both.where("at < 0").select(F.col("h").alias("fp"), "_id")
    fps = staged(prints.groupBy("fp").agg(F.min("_id").alias("low")), "near-prints")
    equal = prints.join(fps, "fp").where("_id <> low").select(F.col("_id").alias("u"), F.col("low").alias("v"))
    close = staged(links(fps.select("fp")).distinct(), "near-close")
    close = close.join(fps.select(F.col("fp").alias("u"), F.col("low").alias("a")), "u").join(fps.select(F.col("fp").alias("v"), F.col("low").alias("b")), "v")
    edges = similar(equal.union(close.select(F.col("a").alias("u"), F.col("b").alias("v"))))

    # written tables: AQE splits a hot key of a join only where no aggregate stands between join and shuffle
    many = staged(entries.groupBy("h").agg(F.min("_id").alias("low"), F.max("_id").alias("high")).where("low < high").select("h"), "near-common")
    shared = staged(entries.join(many, "h"), "near-shared")
    discard(both, many)

    def possible(a: str, b: str) -> Column:
        """By their sizes and what follows a shingle; it holds for two similar texts at the first shingle they share."""
        n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
        rest = F.least(n - F.col(f"{a}.at"), m - F.col(f"{b}.at"))
        return rest * (1 + similarity) + 1e-6 >= similarity * (n + m)

    def unsettled() -> DataFrame:
        """Entries of the tables that hold texts of several groups, with their ``root``."""
        roots = staged(components(edges).where("node <> root"), "near-roots")
        rooted = staged(shared.join(roots, shared._id == roots.node, "left").select("h", "_id", "n", "at", F.coalesce("root", "_id").alias("root")), "near-rooted")
        several = staged(rooted.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h"), "near-several")
        left = staged(rooted.join(several, "h"), "near-left")
        discard(roots, rooted, several)
        return left

    row = F.struct("_id", "n", "at", "root")
    for k in range(rounds):
        left = unsettled()
        by = F.struct((F.col("at") if k == 0 else F.lit(0)).alias("at"), F.xxhash64(F.lit(k), F.col("_id")).alias("by"))
        hubs = staged(left.groupBy("h").agg(F.min(F.struct(by.alias("by"), row.alias("o"))).alias("hub")).select("h", F.col("hub.o").alias("o")), "near-hubs")
        tried = left.select("h", row.alias("m")).join(hubs, "h").where((F.col("m.root") != F.col("o.root")) & possible("m", "o"))
        edges = edges.union(similar(tried.select(F.col("m._id").alias("u"), F.col("o._id").alias("v"))))
        discard(left, hubs)
    left = unsettled()
    met = (F.col("m.root") < F.col("o.root")) & possible("m", "o")
    tried = left.select("h", row.alias("m")).join(left.select(F.col("h").alias("g"), row.alias("o")), (F.col("h") == F.col("g")) & met)
    roots = components(edges.union(similar(tried.select(F.col("m._id").alias("u"), F.col("o._id").alias("v")))))
    grouped = texts.join(roots, texts._id == roots.node, "left").select("_k", "_first", F.coalesce("root", "_id").alias("root"))
    lowest = staged(grouped.groupBy("root").agg(F.min("_first").alias("group_id")), "near-lowest")
    named = staged(grouped.join(lowest, "root").select("_k", "group_id"), "near-names")
    discard(texts, shared, left, lowest)
    return ids.join(named, "_k").select(id_col, "group_id").distinct()


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id.

    Of rows that share this id the one with the smallest text stays. Rows with a null id all stay.
    """
    groups = near_groups(docs, id_col, text_col, **options)
    first = groups.where(F.col(id_col) == F.col("group_id")).select(F.col(id_col).alias("_first_id")).distinct()
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(F.col(f"`{text_col}`"), *[F.col(f"`{c}`") for c in rest])
    kept = docs.select(F.col(id_col).alias("_first_id"), row.alias("_row")).join(first, "_first_id").groupBy("_first_id").agg(F.min("_row").alias("_row"))
    back = kept.select(*[(F.col("_first_id") if c == id_col else F.col("_row").getField(c)).alias(c) for c in docs.columns])
    return back.union(docs.where(F.col(id_col).isNull()))
