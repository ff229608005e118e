"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle.

A text is split by the tokenizer's own pre-token pattern; a pre-token's number of ids does not depend on
its neighbours, so a text's count is a sum of lengths. Tier one is a compact table of the most frequent pre-tokens of
a bounded sample, broadcast (``table_size`` entries at most). Misses are encoded by the library in the
worker and kept in its bounded cache. Both tiers only save work: any table gives the same counts.

Defined results: a null text is empty and has no tokens; a special string inside a text is one token, as by
the library's default; repeated rows are repeated; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as the library's pattern has it: the Unicode property, which lacks \x1c-\x1f.
_S = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: The standard byte-level pattern.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


@lru_cache(maxsize=4)
def strays(tokenizer: str) -> dict[int, int]:
    """Characters that ``regex`` takes for letters or numbers and the library's older Unicode version does not.

    Each is mapped to a private-use character, which both take for neither.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_str(tokenizer).pre_tokenizer.pre_tokenize_str
    word, number = regex.compile(r"\p{L}").match, regex.compile(r"\p{N}").match
    return {n: 0xE000 for n in range(0x80, 0x110000) if (word(chr(n)) and len(cut(chr(n) + "a")) > 1) or (number(chr(n)) and len(cut(chr(n) + "1")) > 1)}


class Cutter:
    """Cuts a text into pre-tokens as the library does."""

    def __init__(self, stray: dict[int, int]):
        self.stray, self.lowest = stray, chr(min(stray, default=0x10FFFF))
        self.pattern = regex.compile(PRE_TOKEN)

    def __call__(self, text: str) -> list[str]:
        if text and max(text) >= self.lowest and (shadow := text.translate(self.stray)) != text:
            return [text[m.start() : m.end()] for m in self.pattern.finditer(shadow)]
        return self.pattern.findall(text)


class Lengths(dict):
    """Pre-token to number of ids; misses are encoded and kept until there are ``room`` of them."""

    def __init__(self, frequent: dict[str, int], tokenizer: str, room: int = 100_000, longest: int = 64):
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.frequent, self.room, self.longest = frequent, room, longest
        self.tokenizer = Tokenizer.from_str(tokenizer)

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= self.longest:
            if len(self) >= len(self.frequent) + self.room:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def specials(tokenizer: str) -> list[str]:
    """Strings that the library takes for one token wherever they are. Ones that swallow their surroundings are refused."""
    spec = json.loads(tokenizer)
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        raise ValueError("only byte-level tokenizers with the standard pattern and without normalizer")
    added = spec["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    return sorted((t["content"] for t in added), key=len, reverse=True)


def splitter(special: list[str]):
    """A function from a text to its pieces between special strings, and how many of these there are."""
    if not special:
        return lambda text: ([text], 0)
    cut = regex.compile("|".join(map(regex.escape, special)))

    def run(text: str) -> tuple[list[str], int]:
        parts = cut.split(text) if any(s in text for s in special) else [text]
        return parts, len(parts) - 1

    return run


def frequent_lengths(docs: DataFrame, text_col: str, tokenizer: str, table_size: int, sample_docs: int) -> dict[str, int]:
    rows = docs.where(F.pmod(F.xxhash64(text_col), F.lit(16)) == 3).select(text_col).limit(sample_docs)
    find, counts = Cutter(strays(tokenizer)), Counter()
    for r in rows.toLocalIterator():
        counts.update(find(r[0] or ""))
    lengths = Lengths({}, tokenizer)
    return {p: lengths[p] for p, _ in counts.most_common(table_size) if len(p) <= lengths.longest}


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = 30_000, sample_docs: int = 500) -> DataFrame:
    """``id_col, n_bytes, n_tokens`` of every row."""
    tokenizer = Path(tokenizer_path).read_text(encoding="utf-8")
    cut = specials(tokenizer)
    frequent = frequent_lengths(docs, text_col, tokenizer, table_size, sample_docs)
    sent, stray = docs.sparkSession.sparkContext.broadcast((frequent, tokenizer)), strays(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = Lengths(*sent.value).__getitem__
        find, parts_of = Cutter(stray), splitter(cut)
        for b in batches:
            n_bytes, n_tokens = [], []
            for t in b.column(1):
                text = t.as_py() or ""
                parts, n = parts_of(text)
                for p in parts:
                    n += sum(map(length, find(p)))
                n_bytes.append(len(text.encode()))
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], [id_col, "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
