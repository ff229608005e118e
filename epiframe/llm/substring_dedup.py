"""Substring dedup: fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Words are runs of letters and digits, lower-cased. Seeds are the minimizers of each window of ``window``
shingles of ``k`` words, so any ``k + window - 1`` equal words share a seed. A seed's hub is its
smallest document; every other occurrence is joined to the hub's, which makes a number of anchors linear in the
occurrences, where joining all pairs would make their square. Anchors of a document and a hub are chained
by their positions with linear gap costs through a tree of the anchors at most ``max_gap`` words back, and the words between anchors are aligned: equal ones at once, others by edit distance, with the
ends stretched while they agree, however far; a chain that is too unlike as a whole is parted at its worst gaps. Passages of ``min_words`` or more with an identity of ``similarity`` or more are
found, once per document and hub.

Seeds of one passage may have hubs of their own, none of which holds the passage. So where a document's seeds are common ones over
``min_words`` words and no passage found covers them, long seeds of ``min_words - window + 1`` words are taken at the same places and joined to
their hub (the hub itself to the largest document): any ``min_words`` equal words hold a long seed. Where three documents or more hold a
long seed in different surroundings and some are still not covered, all ``min_words`` words around it are joined in the same way: their hub holds all of them, so no
``min_words`` equal words are lost. These anchors are chained and aligned like the first ones, and a passage is returned where it reaches beyond those of
the steps before.

The first of a passage's documents is found as the hub of the others; a passage that its document repeats
within itself alone is no match. Joins on a common seed are ones that AQE splits. Texts are moved once, into a table
bucketed by document; a join with it is not split, but a hub's text is cut for a bounded number of chains at a time.

Defined results: null or empty texts and rows with a null id have no passages; repeated rows of one id are
one document (its texts' seeds are pooled, the first text by order is aligned); equal texts are passages like others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from epiframe.llm.common import bucketed, discard, staged
from epiframe.llm.decontaminate import TO_WORDS, words_of

#: Words that are fetched beyond a chain's ends at first, to stretch them; where they all agree, more are.
MARGIN = 40
#: Chains of one text that are cut together.
CUTS = 400
#: Bytes of texts whose seeds are found together.
TOGETHER = 1 << 18
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _table() -> np.ndarray:
    """A number for each byte at each of 64 places in a word."""
    x = np.arange(1, 64 * 256 + 1, dtype=np.uint64) * _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


_BYTES = _table()


def words_hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of ``words_of`` of all texts, one text behind the other, and the number of words of each text.

    A hash is a sum of numbers by byte and place, mixed with the word's length.
    """
    data = np.frombuffer(b" ".join(texts).translate(TO_WORDS), np.uint8)
    at = np.flatnonzero(data != 32)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.append(True, np.diff(at) > 1))
    starts, length = at[first], np.diff(np.append(first, len(at)))
    place = at - np.repeat(starts, length)
    h = np.add.reduceat(_BYTES[((place & 63) << 8) | data[at]], first)
    h = (h ^ length.astype(np.uint64)) * _GOLD
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h ^ (h >> np.uint64(31)), np.diff(np.searchsorted(starts, ends), prepend=0)


def together(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``words_hashed`` of TOGETHER bytes or so at once, behind the index of the first text."""
    part = np.cumsum([len(t) for t in texts]) // TOGETHER
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for first, last in zip(cuts, [*cuts[1:], len(texts)]):
        yield first, *words_hashed(texts[first:last])


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word of ``words_of(text)``."""
    return words_hashed([text.encode("utf-8", "surrogatepass")])[0]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words, mixed from those of the words in their order."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k if n else 0):
        h = (h ^ words[j : j + n]) * _GOLD
        h ^= h >> np.uint64(29)
    return h


def sliding(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        x = f(x[:-span], x[span:])
        span *= 2
    return f(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def minimizers(words: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``minimizers_of`` a single text, without its number."""
    h, _, *rest = minimizers_of(words, np.array([len(words)]), k, window)
    return h, *rest


def minimizers_of(words: np.ndarray, counts: np.ndarray, k: int, window: int) -> tuple[np.ndarray, ...]:
    """Hashes (signed), texts, word positions, numbers and ends of the seeds of texts of ``counts`` word hashes, one behind the other.

    Where one hash is the minimum over and over, as in a repeated word or line, it is a seed once a window; its end is the last
    position that it stands for. A hash that occurs again in the text is also a seed under its ordinal (and without a number: -1), so that the
    second repeat meets another text's second repeat, and repetitive passages chain like others.
    """
    n = np.maximum(counts - k + 1, 0)
    total = n.sum()
    if not total:
        return np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 4
    # shingles inside a text, their texts and places there
    text, begin = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    pos = np.arange(total) - begin[text]
    h = shingle_hashes(words, k)[pos + (np.cumsum(counts) - counts)[text]]
    wide = n > window
    picked = np.zeros(total, bool)
    if wide.any():
        # the least of each window, and where a hash is the least of any window that holds it
        whole = (wide[text] & (pos + window <= n[text]))[: total - window + 1]
        least = np.pad(np.where(whole, sliding(np.minimum, h, window), 0), window - 1)
        picked = wide[text] & (sliding(np.maximum, least, window) == h)
    if not wide.all():
        some = np.flatnonzero(n)
        least = np.flatnonzero(~wide[text] & (h == np.repeat(np.minimum.reduceat(h, begin[some]), n[some])))
        picked[least[np.append(True, text[least][1:] != text[least][:-1])[: len(least)]]] = True
    h, text, at = h[picked], text[picked], pos[picked]
    new_run = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))
    run_start = at[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
    step = (at - run_start) // window
    keep = np.flatnonzero(new_run | np.append(True, step[1:] != step[:-1]))
    end = at[np.append(keep[1:], len(at)) - 1]
    h, text, at = h[keep], text[keep], at[keep]
    order = np.lexsort((h, text))
    ranked, of = h[order], text[order]
    first = np.append(True, (ranked[1:] != ranked[:-1]) | (of[1:] != of[:-1]))
    ordinal = np.empty(len(h), np.uint64)
    ordinal[order] = np.arange(len(h)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    again = ordinal > 0
    h = np.concatenate([h, (h[again] ^ (ordinal[again] * _GOLD)) * _GOLD])
    number = np.append(np.arange(len(at)) - np.searchsorted(text, text), np.full(again.sum(), -1))
    return h.view(np.int64), *(v.astype(np.int32) for v in (np.append(text, text[again]), np.append(at, at[again]), number, np.append(end, end[again])))


class Windows:
    """Hashes of windows of a text, for positions from ``lo`` to ``hi``."""

    def __init__(self, words: np.ndarray, lo: int, hi: int, k: int):
        self.lo, self.k = max(0, lo), k
        self.parts = shingle_hashes(words[self.lo : max(0, hi)], k)

    def __call__(self, at: np.ndarray, length: int) -> np.ndarray:
        """Signed hashes of ``length`` words from each position of ``at`` on; the text must have them."""
        h = np.zeros(len(at), np.uint64)
        if len(at):
            for offset in sorted({*range(0, length - self.k + 1, self.k), length - self.k}):
                h = (h ^ self.parts[at - self.lo + offset]) * _GOLD
                h ^= h >> np.uint64(31)
        return h.view(np.int64)


def long_seeds(words: np.ndarray, at: list[int], doc: int, k: int, length: int, around: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the seeds at those of the positions ``at`` that have ``length`` words, the positions, and hashes of their surroundings.

    Surroundings are ``around`` words more on either side; those of a seed too near to an end are like no other document's.
    """
    at = np.array([p for p in at if p + length <= len(words)], np.int64)
    wide = np.full(len(at), doc, np.int64)
    if len(at):
        hashes = Windows(words, at.min() - around, at.max() + length + around, k)
        inside = (at >= around) & (at + length + around <= len(words))
        wide[inside] = hashes(at[inside] - around, length + 2 * around)
        return hashes(at, length), at.astype(np.int32), wide
    return wide, at.astype(np.int32), wide


def windows_near(words: np.ndarray, at: list[int], k: int, length: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of all windows of ``length`` words that begin at one of ``at`` or up to ``before`` words earlier."""
    at = np.unique(np.array(at, np.int64)[:, None] - np.arange(before + 1))
    at = at[(at >= 0) & (at + length <= len(words))]
    return (Windows(words, at.min(), at.max() + length, k)(at, length) if len(at) else at), at.astype(np.int32)


class Recent:
    """Maxima of (score, index) over ranges of ranks, of entries that may leave in the order they came."""

    NONE = (-1e18, -1)

    def __init__(self, n: int):
        self.n, self.best, self.at = n, [self.NONE] * (2 * n), [deque() for _ in range(n)]

    def _set(self, i: int) -> None:
        value = self.at[i][0] if self.at[i] else self.NONE
        i += self.n
        while i and self.best[i] != value:
            self.best[i] = value
            i >>= 1
            if i:
                value = max(self.best[2 * i], self.best[2 * i + 1])

    def put(self, i: int, value: tuple[float, int]) -> None:
        held = self.at[i]
        while held and held[-1] <= value:  # goes sooner and counts less
            held.pop()
        held.append(value)
        self._set(i)

    def drop(self, i: int, index: int) -> None:
        if self.at[i] and self.at[i][0][1] == index:
            self.at[i].popleft()
            self._set(i)

    def top(self, lo: int, hi: int) -> tuple[float, int]:
        """Best of ranks from ``lo`` to below ``hi``."""
        found, lo, hi = self.NONE, lo + self.n, hi + self.n
        while lo < hi:
            if lo & 1:
                found, lo = max(found, self.best[lo]), lo + 1
            if hi & 1:
                hi -= 1
                found = max(found, self.best[hi])
            lo, hi = lo >> 1, hi >> 1
        return found


def chain(x: list[int], y: list[int], k: int, gap_cost: float = 0.1, max_gap: int = 64, min_anchors: int = 2) -> list[list[int]]:
    """Indices of the anchors of each chain, best chain first; an anchor is in one chain at most.

    ``x`` is sorted (ties by y). A chain's score is k an anchor less ``gap_cost`` a word of gap on either side. An
    anchor follows the best of those within ``max_gap`` words on both sides.
    """
    n = len(x)
    ys = sorted(set(y))
    rank = {v: r for r, v in enumerate(ys)}
    tree, score, before = Recent(len(ys)), [0.0] * n, [-1] * n
    i = old = 0
    while i < n:
        while x[i] - x[old] - k > max_gap:
            tree.drop(rank[y[old]], old)
            old += 1
        j = i
        while j < n and x[j] == x[i]:  # anchors at one x must not follow each other
            best, who = tree.top(bisect_left(ys, y[j] - k - max_gap), rank[y[j]])
            gain = best - gap_cost * (x[j] + y[j])
            if who >= 0 and gain > 0:
                score[j], before[j] = k + gain, who
            else:
                score[j] = k
            j += 1
        for m in range(i, j):
            tree.put(rank[y[m]], (score[m] + gap_cost * (x[m] + y[m]), m))
        i = j
    used, chains = [False] * n, []
    for end in sorted(range(n), key=lambda m: (-score[m], m)):
        path = []
        while end >= 0 and not used[end]:
            used[end] = True
            path.append(end)
            end = before[end]
        if len(path) >= min_anchors:
            chains.append(path[::-1])
    return chains


def edits(a: list[bytes], b: list[bytes]) -> int:
    """Edit distance of two short word lists."""
    if a == b:
        return 0
    # what both begin or end with costs nothing
    least = min(len(a), len(b))
    i = next((i for i in range(least) if a[i] != b[i]), least)
    j = next((j for j in range(least - i) if a[-1 - j] != b[-1 - j]), least - i)
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if len(a) <= 1 and len(b) <= 1:
        return 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def stretch(a: list[bytes], b: list[bytes], drop: int = 6) -> tuple[int, int, bool]:
    """How many words two lists agree from their start, mismatches in them, and whether the shorter list ended it.

    +1 an equal word, -3 another, until the score falls by ``drop``.
    """
    score = best = length = wrong = missed = i = 0
    least = min(len(a), len(b))
    while i < least:
        if a[i : i + 16] == b[i : i + 16]:
            score += len(a[i : i + 16])
            i += len(a[i : i + 16])
        elif a[i] == b[i]:
            score += 1
            i += 1
        else:
            score -= 3
            missed += 1
            i += 1
        if score > best:
            best, length, wrong = score, i, missed
        if score < best - drop:
            return length, wrong, False
    return length, wrong, True


def _rows(b: pa.RecordBatch, found: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    """One row an element of the arrays of each text, with the text's id (the batch's first column) after the hashes."""
    ids = b.column(0).take(pa.array(np.repeat(np.arange(len(b)), [len(f[0]) for f in found])))
    h, *rest = (pa.array(np.concatenate(c)) for c in zip(*found))
    return pa.RecordBatch.from_arrays([h, ids, *rest], names)


def seeds(texts: DataFrame, k: int, window: int) -> DataFrame:
    """``h, doc, pos, number, last`` of the minimizers of ``doc, text``."""
    names = ["h", "doc", "pos", "number", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.slice(at, 1000)
                for first, words, counts in together(b.column(1).cast(pa.binary()).to_pylist()):
                    h, text, *rest = minimizers_of(words, counts, k, window)
                    yield pa.RecordBatch.from_arrays([pa.array(h), b.column(0).take(pa.array(text + first)), *(pa.array(v) for v in rest)], names)

    return texts.mapInArrow(run, "h long, doc long, pos int, number int, last int")


def in_several(found: DataFrame) -> DataFrame:
    """Occurrences of hashes that are in several documents, with the smallest and the largest as ``hub`` and ``far``."""
    # written tables: AQE splits a hot key of a join only where no aggregate stands between join and shuffle
    found = staged(found, "passage-found")
    common = staged(found.groupBy("h").agg(F.min("doc").alias("hub"), F.max("doc").alias("far")).where("hub < far"), "passage-common")
    shared = staged(found.join(common, "h"), "passage-shared")
    discard(found, common)
    return shared


def hub_anchors(occurrences: DataFrame, shared: DataFrame) -> DataFrame:
    """``doc, other, pos, other_pos``: occurrences of several documents against those of their hub, the hub's own against the largest document's."""
    at = [F.min(F.when(F.col("doc") == F.col(w), F.col("pos"))).alias(f"{w}_pos") for w in ("hub", "far")]
    places = staged(shared.where("doc = hub OR doc = far").groupBy("h").agg(*at), "passage-hubs")
    own = F.col("doc") == F.col("hub")
    other, other_pos = F.when(own, F.col("far")).otherwise(F.col("hub")), F.when(own, F.col("far_pos")).otherwise(F.col("hub_pos"))
    return occurrences.join(places, "h").select("doc", other.alias("other"), "pos", other_pos.alias("other_pos"))


def longest_spans(rows: DataFrame, *more: str) -> DataFrame:
    """``doc, start, end, more``: the longest passage from each word on, of either side: no more of them than the document has words."""
    sides = rows.select("doc", "start", "end", *more).union(rows.select("other", "other_start", "other_end", *more))
    return sides.groupBy("doc", "start", *more).agg(F.max("end").alias("end"))


def chained(anchors: DataFrame, k: int, max_gap: int, min_anchors: int) -> DataFrame:
    """``chain, doc, other, xs, ys`` of anchors ``doc, other, pos, other_pos``."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by document and hub; the last pair of a batch waits for the next one."""
        held: list[pd.DataFrame] = []

        def chains(pdf: pd.DataFrame) -> pd.DataFrame:
            out = []
            rows = [pdf[c].to_numpy() for c in ("doc", "other", "pos", "other_pos")]
            new = [np.append(True, c[1:] != c[:-1])[: len(c)] for c in rows]
            once = new[0] | new[1] | new[2] | new[3]
            doc, other, x, y = (c[once] for c in rows)
            starts = np.flatnonzero((new[0] | new[1])[once])
            sizes = np.diff(np.append(starts, len(doc)))
            for at, n in zip(starts[sizes >= min_anchors].tolist(), sizes[sizes >= min_anchors].tolist()):
                xs, ys = x[at : at + n].tolist(), y[at : at + n].tolist()
                for c in chain(xs, ys, k, max_gap=max_gap, min_anchors=min_anchors):
                    out.append((doc[at], other[at], [xs[m] for m in c], [ys[m] for m in c]))
            return pd.DataFrame(out, columns=["doc", "other", "xs", "ys"])

        for b in batches:
            if not len(b):
                continue
            pdf = pd.concat([*held, b]) if held else b
            tail = (pdf.doc.to_numpy() == pdf.doc.iloc[-1]) & (pdf.other.to_numpy() == pdf.other.iloc[-1])
            held = [pdf[tail]]
            yield chains(pdf[~tail])
        if held:
            yield chains(held[0])

    linked = anchors.repartition("doc").sortWithinPartitions("doc", "other", "pos", "other_pos").mapInPandas(link, "doc long, other long, xs array<int>, ys array<int>")
    return staged(linked.withColumn("chain", F.monotonically_increasing_id()), "passage-chains")


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    window: int = 16,
    min_words: int = 50,
    similarity: float = 0.8,
    max_gap: int = 64,
    min_anchors: int = 2,
) -> DataFrame:
    """``id_col, start, end, other_id, other_start, other_end, n_words, identity``: spans in words, end exclusive."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind, names = docs.schema[id_col].dataType, None
    if not isinstance(kind, IntegralType):  # then they are numbered in their order
        names = staged(texts.select(F.col("doc").alias("name")).distinct().orderBy("name").withColumn("doc", F.monotonically_increasing_id()), "passage-ids")
        texts = texts.withColumnRenamed("doc", "name").join(names, "name").select("doc", "text")
    texts = texts.withColumn("doc", F.col("doc").cast("long"))

    def found_by(anchors: DataFrame) -> DataFrame:
        chains = chained(anchors, k, max_gap, min_anchors)
        rows = passages_of(chains, texts, k, min_words, similarity)
        discard(chains)
        return rows

    shared = in_several(seeds(texts, k, window))
    texts = bucketed(texts, "passage-texts", "doc")  # they are moved once, and not again for each join below
    first = found_by(hub_anchors(shared.where("doc <> hub"), shared))

    # runs of common seeds: min_words equal words are inside one, and their first seed is at least `inner` words before its end
    inner, length = max(0, min_words - k - 2 * window + 2), max(k, min_words - window + 1)
    numbered = shared.where("number >= 0").withColumn("run", F.col("number") - F.row_number().over(Window.partitionBy("doc").orderBy("number", "pos")))
    runs = numbered.groupBy("doc", "run").agg(F.max("last").alias("last"), F.collect_list("pos").alias("at"))
    runs = runs.select("doc", F.filter("at", lambda p: p <= F.col("last") - inner).alias("at")).where(F.size("at") > 0)
    places = runs.groupBy("doc").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at"))  # no longer than the document

    def at_places(places: DataFrame, hashes: Callable[[np.ndarray, list[int], int], tuple[np.ndarray, ...]], names: list[str], kinds: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, len(whole), 1000):
                    b = whole.slice(start, 1000)
                    hashed = (w for _, words, counts in together(b.column(1).cast(pa.binary()).to_pylist()) for w in np.split(words, np.cumsum(counts)[:-1]))
                    yield _rows(b, [hashes(w, at, doc) for doc, w, at in zip(b.column(0).to_pylist(), hashed, b.column(2).to_pylist())], names)

        return texts.join(staged(places, "passage-runs"), "doc").select("doc", "text", "at").mapInArrow(run, kinds)

    def uncovered(occurrences: DataFrame, rows: DataFrame, before: int, after: int) -> DataFrame:
        """Those whose words, with so many more on either side, are in no passage found."""
        earlier = F.max("end").over(Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
        outer = longest_spans(rows).withColumn("earlier", earlier).where("earlier IS NULL OR earlier < end")  # few: none is inside another
        spans = staged(outer.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "passage-spans")
        held = F.exists("spans", lambda s: (s["start"] <= F.greatest(F.col("pos") - before, F.lit(0))) & (s["end"] >= F.col("pos") + after))
        return staged(occurrences.join(spans, "doc", "left").where(~F.coalesce(held, F.lit(False))).drop("spans"), "passage-open")

    def along(anchors: DataFrame, length: int) -> DataFrame:
        """Anchors of k words within those of ``length``, at every 3k-th word of the document, and so near enough to each other to chain."""
        step = 3 * k
        by = F.explode(F.sequence(F.pmod(-F.col("pos"), F.lit(step)), F.lit(length - k), F.lit(step))).alias("by")
        return anchors.select("*", by).select("doc", "other", (F.col("pos") + F.col("by")).alias("pos"), (F.col("other_pos") + F.col("by")).alias("other_pos")).distinct()

    # a long seed counts unless all min_words around it are covered
    around = min_words - length
    long_shared = in_several(at_places(places, lambda words, at, doc: long_seeds(words, at, doc, k, length, around), ["h", "doc", "pos", "wide"], "h long, doc long, pos int, wide long"))
    second = found_by(along(hub_anchors(uncovered(long_shared, first, around, min_words), long_shared), length))
    so_far = first.union(second)
    # a hub answers for all if the surroundings are the same, or if there are two documents
    between = (F.col("doc") != F.col("hub")) & (F.col("doc") != F.col("far"))
    mixed = long_shared.groupBy("h").agg(F.max(between).alias("more"), F.min("wide").alias("w"), F.max("wide").alias("v")).where("more AND w < v").select("h")
    mixed = staged(mixed.join(uncovered(long_shared, so_far, around, min_words).select("h").distinct(), "h"), "passage-mixed")
    near = long_shared.join(mixed, "h").groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    exact_shared = in_several(at_places(near, lambda words, at, doc: windows_near(words, at, k, min_words, around), ["h", "doc", "pos"], "h long, doc long, pos int"))
    third = found_by(along(hub_anchors(uncovered(exact_shared, so_far, 0, min_words), exact_shared), min_words))
    discard(shared, long_shared, exact_shared, texts)

    # chains that end up as one passage are one; a passage of a later step counts where none of an earlier one holds it
    found = first.withColumn("step", F.lit(0)).union(second.withColumn("step", F.lit(1))).union(third.withColumn("step", F.lit(2)))
    found = found.groupBy("doc", "other", "start", "end", "other_start", "other_end").agg(F.min("step").alias("step"), F.max("identity").alias("identity"))
    found = staged(found, "passage-found")
    marks = longest_spans(found, "step").select("doc", "start", "end", "step", F.lit(None).cast("long").alias("other"))
    every = marks.unionByName(found, allowMissingColumns=True)
    before = Window.partitionBy("doc").orderBy("start", F.col("other").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = lambda k: F.max(F.when(F.col("other").isNull() & (F.col("step") < k), F.col("end"))).over(before)
    every = every.select("*", mark(1).alias("m1"), mark(2).alias("m2")).where("other IS NOT NULL")
    found = every.where("step = 0 OR coalesce(CASE step WHEN 1 THEN m1 ELSE m2 END < end, true)")
    if names is not None:
        found = found.join(names, "doc").drop("doc").withColumnRenamed("name", "doc")
        found = found.join(names.select(F.col("doc").alias("other"), "name"), "other").drop("other").withColumnRenamed("name", "other")
    ids = [F.col(c).cast("long" if names is None else kind) for c in ("doc", "other")]
    return found.select(ids[0].alias(id_col), "start", "end", ids[1].alias("other_id"), "other_start", "other_end", (F.col("end") - F.col("start")).alias("n_words"), "identity")


def passages_of(chains: DataFrame, texts: DataFrame, k: int, min_words: int, similarity: float) -> DataFrame:
    """``doc, other, start, end, other_start, other_end, identity`` of chains; more words are fetched where ends agree beyond the margin."""
    found, todo, margin = None, chains, MARGIN
    while True:
        done = staged(aligned(todo, texts, k, margin, min_words, similarity), "passage-aligned")
        rows = done.where("NOT open").select("doc", "other", "start", "end", "other_start", "other_end", "identity")
        found = rows if found is None else found.union(rows)
        more = done.where("open").select("chain")
        if more.isEmpty():
            return staged(found, "passage-rows")
        todo, margin = chains.join(more, "chain", "left_semi"), 16 * margin


def aligned(chains: DataFrame, texts: DataFrame, k: int, margin: int, min_words: int, similarity: float) -> DataFrame:
    """Passages of chains ``chain, doc, other, xs, ys``; ``open`` rows are chains whose ends agree over more than ``margin`` words."""
    side = lambda owner, n, at: F.struct(F.col(owner).alias("owner"), F.struct("chain", F.lit(n).alias("side"), F.element_at(at, 1).alias("lo"), (F.element_at(at, -1) + k).alias("hi")).alias("cut"))
    wanted = chains.select(F.explode(F.array(side("doc", 0, "xs"), side("other", 1, "ys"))).alias("s")).select("s.*")
    # a text goes to Python once for CUTS chains or so, however many it has
    parts = staged(wanted.groupBy("owner").agg(F.ceil(F.count("*") / CUTS).alias("parts")), "passage-parts")
    wanted = wanted.join(parts, "owner").groupBy("owner", F.pmod(F.xxhash64("cut.chain"), F.col("parts")).alias("part")).agg(F.collect_list("cut").alias("cuts"))
    wanted = staged(wanted.select("owner", "cuts"), "passage-cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chain", "side", "first", "n", "words"]
        made = lambda out: pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(zip(*out), [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()])], names)
        out, held = [], 0
        for b in batches:
            for t, cuts in zip(b.column(0), b.column(1).to_pylist()):
                words = words_of(t.as_py())
                out += [(c["chain"], c["side"], max(0, c["lo"] - margin), len(words), b" ".join(words[max(0, c["lo"] - margin) : c["hi"] + margin])) for c in cuts]
                held += sum(len(r[4]) for r in out[-len(cuts) :])
                if held > TOGETHER or len(out) > 10000:
                    yield made(out)
                    out, held = [], 0
        if out:
            yield made(out)

    slices = wanted.join(texts.withColumnRenamed("doc", "owner"), "owner").select("text", "cuts").mapInArrow(cut, "chain long, side int, first int, n int, words binary")
    # a chain, its document's slice, its hub's
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    empty = [none("first", "int"), none("n", "int"), none("words", "binary")]
    rows = chains.select("chain", F.lit(-1).alias("side"), *empty, "doc", "other", "xs", "ys")
    rows = rows.union(slices.select("chain", "side", "first", "n", "words", none("doc", "long"), none("other", "long"), none("xs", "array<int>"), none("ys", "array<int>")))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = mine = None
        names = ["chain", "doc", "other", "start", "end", "other_start", "other_end", "identity", "open"]
        kinds = [*[pa.int64()] * 7, pa.float64(), pa.bool_()]
        for b in batches:
            out = []
            for number, side, first, n, words, doc, other, xs, ys in zip(*(c.to_pylist() for c in b.columns)):
                r = {"first": first, "n": n, "words": words}
                if side < 0:
                    who, mine = (doc, other, xs, ys), None
                elif side == 0:
                    mine = mine or r  # of several texts of one id the first
                elif mine:
                    got = passages(*who[2:], mine, r, k, min_words, similarity)
                    if got is None:
                        out.append((number, *[None] * 7, True))
                    else:
                        out += [(number, *who[:2], *g, False) for g in got]
                    mine = None
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(list(zip(*out)) or [()] * len(names), kinds)], names)

    paired = rows.repartition("chain").sortWithinPartitions("chain", "side", "words")
    return paired.mapInArrow(align, "chain long, doc long, other long, start long, end long, other_start long, other_end long, identity double, open boolean")


def passages(xs: list[int], ys: list[int], mine: dict, hub: dict, k: int, min_words: int, similarity: float) -> list[tuple[int, int, int, int, float]] | None:
    """Spans in both documents and identities of a chain's passages; none if the slices belie the anchors; None if one may go on beyond the slices.

    A chain that is too unlike as a whole is parted at its worst gap, and so on.
    """
    a, b, ax, by = mine["words"].split(), hub["words"].split(), mine["first"], hub["first"]
    gaps = []  # edits before each anchor
    for i, (x, y) in enumerate(zip(xs, ys)):
        if a[x - ax : x - ax + k] != b[y - by : y - by + k]:
            return []  # another text of the same id, or a hash that two shingles share
        px, py = (xs[i - 1] + k, ys[i - 1] + k) if i else (x, y)
        # anchors that overlap by different amounts hide an insertion
        gaps.append(edits(a[px - ax : max(x, px) - ax], b[py - by : max(y, py) - by]) + abs(min(0, x - px) - min(0, y - py)))
    found, todo = [], [(0, len(xs))]
    while todo:
        i, j = todo.pop()
        (x, y), (u, v) = (xs[i], ys[i]), (xs[j - 1] + k, ys[j - 1] + k)
        left, w1, out1 = stretch(a[: x - ax][::-1], b[: y - by][::-1])
        right, w2, out2 = stretch(a[u - ax :], b[v - by :])
        # the list that ended first was cut off there, not the text
        cut1 = ax > 0 if x - ax < y - by else by > 0 if x - ax > y - by else ax > 0 and by > 0
        rest, other = len(a) - (u - ax), len(b) - (v - by)
        ends, other_ends = ax + len(a) < mine["n"], by + len(b) < hub["n"]
        cut2 = ends if rest < other else other_ends if rest > other else ends and other_ends
        if out1 and cut1 or out2 and cut2:
            return None
        n, m = u + right - x + left, v + right - y + left
        alike = 1 - (sum(gaps[i + 1 : j]) + w1 + w2) / max(n, m)
        if min(n, m) >= min_words and alike >= similarity:
            found.append((x - left, u + right, y - left, v + right, alike))
        elif j - i > 1 and alike < similarity:
            at = max(range(i + 1, j), key=gaps.__getitem__)
            todo += [(i, at), (at, j)]
    return found
