"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of order ``ORDER`` over the lower-cased bytes of its training texts. A
byte's code length in a context comes from method C: with t followers of d kinds, a follower seen c times
costs log2((t + d) / c) bits and an escape to the next shorter context costs log2((t + d) / d); order -1
is uniform over 256 bytes. Statistics are frozen, so a code length depends on the last ``ORDER`` bytes
and the byte alone: each order's contexts and followers are compiled to hash tables that give the costs of all
languages at once, and a batch of texts is scored by look-ups from the longest context down. The language
of the shortest total code wins; its score is the posterior at one nat per ``TEMPER`` nats of code length.

Training takes the ``max_train_docs`` lowest documents of a language by a hash of their id, whole texts, up to ``max_train_bytes``
a language (documented bounds); the tables are broadcast and grow with these bounds and the number of languages, and more than ``max_langs`` are refused.

Defined results: a null text, or one without letters, is ``und`` with score 0; training rows with a null
language or text are ignored; of several texts of one id the smallest is learned from; with no language to learn every text is ``und``; ties go to the first
language by code point; repeated rows are repeated; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = 4
TEMPER = 8.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n bytes that end at each position, as integers; position i needs n - 1 bytes before it."""
    key = np.zeros(len(data) - n + 1, dtype=np.uint64)
    for k in range(n):
        key = (key << np.uint64(8)) | data[k : len(data) - n + 1 + k]
    return key


class Table:
    """Hash table from integer keys to rows of an array, probed for many keys at once."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        size = 1 << self.bits
        self.keys, self.at = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.rows, self.probes = rows, 0
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            self.probes += 1
            s = (slot[todo] + self.probes - 1) & (size - 1)
            free = self.at[s] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(s, return_index=True)[1]] = True
            won = free & first
            self.at[s[won]], self.keys[s[won]] = todo[won], keys[todo[won]]
            todo = todo[~won]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, or -1."""
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        at = self.at[slot]
        out = np.where(self.keys[slot] == keys, at, -1)
        todo = np.flatnonzero((out < 0) & (at >= 0))
        for p in range(1, self.probes):
            if not len(todo):
                break
            s = (slot[todo] + p) & mask
            at, hit = self.at[s], self.keys[s] == keys[todo]
            found = hit & (at >= 0)
            out[todo[found]] = at[found]
            todo = todo[~hit & (at >= 0)]
        return out


class Model:
    """Compiled context trees of all languages."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.langs, self.order = sorted(texts), order
        joined = {g: np.frombuffer(b"\n" * order + b"\n\n".join(t.encode("utf-8", "surrogatepass").lower() for t in texts[g]), np.uint8) for g in self.langs}
        n_lang = len(self.langs)
        self.base: np.ndarray = np.full((256, n_lang), 8.0, np.float32)
        self.cost: list[Table] = []  # by order: cost of context and byte, where it was seen in any language
        self.escape: list[Table] = []  # by order: cost of leaving a seen context
        lower = None
        for k in range(order + 1):
            ctx, full = [], []
            for g in self.langs:
                keys, c = np.unique(_grams(joined[g][order - k :], k + 1), return_counts=True)
                ctx_keys, start = np.unique(keys >> np.uint64(8), return_index=True)
                total, kinds = np.add.reduceat(c, start), np.diff(np.append(start, len(c)))
                ctx.append((ctx_keys, np.log2((total + kinds) / kinds)))
                full.append((keys, np.log2(np.repeat(total + kinds, kinds) / c)))
            all_ctx = np.unique(np.concatenate([x[0] for x in ctx]))
            leave = np.zeros((len(all_ctx), n_lang), np.float32)
            all_full = np.unique(np.concatenate([x[0] for x in full]))
            # a language that lacks context and byte pays its escape, if it has the context, and the shorter context's cost
            pay = self._shorter(all_full, k, lower)
            escape = Table(all_ctx, leave)
            for j, (keys, bits) in enumerate(ctx):
                leave[np.searchsorted(all_ctx, keys), j] = bits
            pay += leave[np.searchsorted(all_ctx, all_full >> np.uint64(8))]
            for j, (keys, bits) in enumerate(full):
                pay[np.searchsorted(all_full, keys), j] = bits
            self.cost.append(Table(all_full, pay))
            self.escape.append(escape)
            lower = k

    def _shorter(self, keys: np.ndarray, k: int, lower: int | None) -> np.ndarray:
        if lower is None:
            return np.repeat(self.base[:1], len(keys), axis=0).copy()
        return self.lookup(keys & ((np.uint64(1) << np.uint64(8 * k)) - np.uint64(1)), lower)

    def lookup(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Costs (keys, languages) of the last byte of each key after the k bytes before it."""
        out = np.zeros((len(keys), len(self.langs)), np.float32)
        todo = np.arange(len(keys))
        while len(todo):
            row = self.cost[k].find(keys)
            hit = row >= 0
            out[todo[hit]] += self.cost[k].rows[row[hit]]
            todo, keys = todo[~hit], keys[~hit]
            if not len(todo):
                break
            left = self.escape[k].find(keys >> np.uint64(8))
            seen = left >= 0
            out[todo[seen]] += self.escape[k].rows[left[seen]]
            if k == 0:
                out[todo] += self.base[0]
                break
            keys = keys & ((np.uint64(1) << np.uint64(8 * k)) - np.uint64(1))
            k -= 1
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits (texts, languages) of whole texts, each after a context of line ends."""
        out = np.zeros((len(texts), len(self.langs)))
        lead = b"\n" * self.order
        group: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal group, held
            data = np.frombuffer(b"".join(lead + texts[i] for i in group), np.uint8)
            keys = _grams(data, self.order + 1)
            ends = np.cumsum([len(texts[i]) + self.order for i in group])
            starts = np.append(0, ends[:-1])
            # windows that reach from a text's lead into it belong to it; those across two texts cost nothing
            costs = self.lookup(keys, self.order)
            for i, a, b in zip(group, starts, ends - self.order):
                out[i] += costs[a:b].sum(axis=0, dtype=np.float64)
            group, held = [], 0

        for i, t in enumerate(texts):
            if len(t) > _BLOCK:  # very long: in overlapping parts, so that memory stays bounded
                data = lead + t
                for a in range(0, len(t), _BLOCK):
                    part = np.frombuffer(data[a : a + _BLOCK + self.order], np.uint8)
                    out[i] += self.lookup(_grams(part, self.order + 1), self.order).sum(axis=0, dtype=np.float64)
                continue
            if t:
                group.append(i)
                held += len(t) + self.order
            if held >= _BLOCK:
                flush()
        if group:
            flush()
        return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train_docs: int = 150, max_train_bytes: int = 8 << 20, max_langs: int = 64, order: int = ORDER) -> Model | None:
    """Learn from ``docs``, which should hold training rows only; None if there is no language."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("g"), F.xxhash64(id_col).alias("h"), F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    first = Window.partitionBy("g").orderBy("h", "i")
    chosen = usable.select("g", "h", "i").withColumn("k", F.row_number().over(first)).where(F.col("k") <= max_train_docs).select("i", "g").distinct()
    picked = usable.join(F.broadcast(chosen), ["i", "g"]).groupBy("g", "h", "i").agg(F.min("t").alias("t"))
    picked = picked.withColumn("sum", F.sum(F.octet_length("t")).over(first)).where(F.col("sum") <= max_train_bytes)
    texts: dict[str, list[str]] = {}
    for r in sorted(picked.select("g", "i", "t").collect(), key=lambda r: (r.g, r.i)):  # languages times the bounds
        texts.setdefault(r.g, []).append(r.t)
    if len(texts) > max_langs:
        raise ValueError(f"{len(texts)} languages; tables are sent to all workers for up to {max_langs}")
    return Model(texts, order) if texts else None


def has_letter(texts: pa.Array) -> list[bool]:
    return [bool(x) for x in pc.match_substring_regex(texts, r"\p{L}").to_pylist()]


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.slice(at, 512)
                known = has_letter(b.column(1))
                langs, scores = ["und"] * len(b), [0.0] * len(b)
                rows = [i for i, yes in enumerate(known) if yes and m is not None]
                if rows:
                    bits = m.code_lengths([b.column(1)[i].as_py().encode("utf-8", "surrogatepass").lower() for i in rows])
                    best = bits.argmin(axis=1)
                    share = np.exp2((bits.min(axis=1, keepdims=True) - bits) / TEMPER)
                    for i, k, p in zip(rows, best, 1 / share.sum(axis=1)):
                        langs[i], scores[i] = m.langs[k], float(p)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
