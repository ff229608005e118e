"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target over its size is the number of copies each of its documents should get: the whole part
is given to all, the rest is a fractional probability. Documents are dealt into blocks by a hash; within a block two
fractional documents meet and one hands words to the other, at random and with expectations
kept, until one of them is at 0 or 1. A block leaves one fractional document, and these go up a
reduction tree, block by block, until one is left per source, which is drawn. So a source's words
end within one document's size of its target. Randomness is a hash of ids and the seed: reruns agree.

Rows of the same id, source and size are one item with a multiplicity, so repeated rows do not pile up in a
block. Blocks hold ``block`` items on average at every level whatever a source's share is.

Defined results: a null text has size 0; a document of size 0 takes nothing; null ids and null sources
are values like others (null source last); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiframe.llm.common import free_name, staged

WEIGHTS = (3.0, 1.0, 2.0)
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` per source: weights shared out, never above ``most`` times the size.

    Water-filling: rounds fix the sources at their cap and share the rest by weight. Only sums come to the driver.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source here: a table of names, not of documents
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = staged(per.select("source", "source_size", weight.alias("w")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, fixed = 0.0, -1
    while True:
        full = (F.col("w") * level >= F.col("source_size") * most) if fixed >= 0 else F.lit(False)
        row = per.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("source_size") * most)), F.sum(F.when(~full, F.col("w")))).first()
        if row[0] == fixed or not row[2]:
            break
        fixed, level = row[0], (share * total - (row[1] or 0.0)) / row[2]
    return per.select("source", "source_size", F.least(F.col("w") * level, F.col("source_size") * most).alias("target"))


_ITEM = "struct<id_hash:bigint,id:{kind},source:string,size:bigint,source_size:bigint,target:double,m:bigint,p:double>"


def _fold(seed: int, level: int) -> str:
    """SQL of one block's chain: ``_items`` to ``done`` (p is 0 or 1) and ``open`` (one item)."""
    # a gives up to b, or b to a; room1: words that fill a or empty b, room2: words that empty a or fill b
    coin = f"(pmod(xxhash64({seed}, {level}, a.id_hash, b.id_hash), 9007199254740992) / 9007199254740992D)"
    room1 = "least(a.size * (1 - a.p), b.size * b.p)"
    room2 = "least(a.size * a.p, b.size * (1 - b.p))"

    def item(x: str, p: str) -> str:
        return f"named_struct('id_hash', {x}.id_hash, 'id', {x}.id, 'source', {x}.source, 'size', {x}.size, 'source_size', {x}.source_size, 'target', {x}.target, 'm', {x}.m, 'p', CAST({p} AS DOUBLE))"

    def step(done: str, open_: str) -> str:
        return f"named_struct('done', concat(s.done, array({done})), 'open', {open_})"

    def bounded(p: str) -> str:
        return f"least(1D, greatest(0D, {p}))"

    gain = (
        f"CASE WHEN a.size * (1 - a.p) <= b.size * b.p THEN {step(item('a', '1D'), item('b', bounded('b.p - a.size * (1 - a.p) / b.size')))} "
        f"ELSE {step(item('b', '0D'), item('a', bounded('a.p + b.size * b.p / a.size')))} END"
    )
    lose = (
        f"CASE WHEN a.size * a.p <= b.size * (1 - b.p) THEN {step(item('a', '0D'), item('b', bounded('b.p + a.size * a.p / b.size')))} "
        f"ELSE {step(item('b', '1D'), item('a', bounded('a.p - b.size * (1 - b.p) / a.size')))} END"
    )
    body = f"CASE WHEN {coin} * ({room1} + {room2}) < {room2} THEN {gain} ELSE {lose} END"
    # a is the open item, b the next one of the list
    return body.replace("a.", "s.open.").replace("b.", "y.item.")


def round_pivotal(items: DataFrame, block: int = 48, seed: int = 42) -> DataFrame:
    """``items`` has ``id_hash, id, source, size, source_size, target, m, p``; p comes back as 0 or 1.

    Words of a source, ``sum(size * p)``, are kept but for the last open item, which is drawn.
    """
    kind = items.schema["id"].dataType.simpleString()
    one = _ITEM.format(kind=kind)
    names = ["id_hash", "id", "source", "size", "source_size", "target", "m", "p"]
    fixed = items.where("p <= 0 OR p >= 1 OR size = 0")
    now = items.where("p > 0 AND p < 1 AND size > 0")
    results = [fixed]
    counts = now.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    # blocks shrink by `block` a level for every source; the tree ends when each source has one
    now = now.join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    level = 0
    while True:
        now = staged(now, f"mix-open-{level}")
        most = now.agg(F.max("blocks")).first()[0]
        if most is None:
            break
        dealt = now.withColumn("at", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "id_hash", "size"), F.col("blocks")))
        groups = dealt.groupBy("source", "at", "blocks").agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("big"), F.struct(*names).alias("item")))).alias("l"))
        chain = F.expr(f"""aggregate(slice(l, 2, size(l)), named_struct('done', CAST(array() AS array<{one}>), 'open', l[0].item), (s, y) -> {_fold(seed, level)})""")
        chained = staged(groups.select("source", "at", "blocks", chain.alias("c")), f"mix-chain-{level}")
        results.append(chained.select(F.explode("c.done").alias("i")).select("i.*"))
        left = chained.select("blocks", "c.open.*")
        drawn = F.when(F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "id_hash"), F.lit(1 << 53)) / float(1 << 53) < F.col("p"), 1.0).otherwise(0.0)
        results.append(left.where("blocks = 1").withColumn("p", drawn).select(*names))
        now = left.where("blocks > 1").withColumn("blocks", F.ceil(F.col("blocks") / block).cast("long")).select(*names, "blocks")
        level += 1
    out = results[0].select(*names)
    for r in results[1:]:
        out = out.union(r.select(*names))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """``id_col, source, size, row, source_size, target, copies``: how often each row goes into the mix.

    ``row`` numbers the rows of equal id, source and size from 1.
    """
    sized = staged(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    goal = targets(sized, weights, share, most).withColumnRenamed("source", "_s")
    items = sized.groupBy("id", "source", "size").agg(F.count("*").alias("m"))
    items = items.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # of m equal rows, whole(m * fraction) get one more copy and one row stays fractional
    part = F.col("m") * (rate - F.floor(rate))
    items = items.select(F.xxhash64("id", "source").alias("id_hash"), "id", "source", "size", "source_size", "target", "m", (part - F.floor(part)).alias("p"))
    done = round_pivotal(items, seed=seed)
    row = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("row")
    done = done.select("*", row)
    copies = F.floor(rate) + F.when(F.col("row") <= F.floor(part), 1).when(F.col("row") == F.floor(part) + 1, F.col("p").cast("long")).otherwise(0)
    return done.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "row", "source_size", "target", copies.cast("long").alias("copies"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, numbered from 1 by a last column ``copy``.

    If ``docs`` has a column of this name, the number's has underscores before it. Rows of equal id, source and size are told apart by their texts; equal
    ones are taken as often as all of them together are. An empty table gives an empty mix.
    """
    taken = mix(docs, id_col, text_col, source_col, **options).where("copies > 0").select(F.col(id_col).alias("_i"), F.col(source_col).alias("_s"), F.col("size").alias("_n"), F.col("row").alias("_r"), "copies")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.xxhash64(F.col(text_col)).alias("h"))
    rank = F.row_number().over(Window.partitionBy("id", "source", "size").orderBy("h"))
    packed = packed.withColumn("row", rank)
    same = F.col("id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n")) & (F.col("row") == F.col("_r"))
    return packed.join(taken, same).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias(free_name(docs, "copy")))
