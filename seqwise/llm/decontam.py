"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a benchmark item if some stretch of its
normalised text (words of letters, digits and underscores, lower case, one space
between) is within k edits of the normalised item, k being ``error_rate`` of its
length, as far as every piece keeps ``min_piece`` characters. The item is split
into k + 1 pieces; k edits leave at least one piece untouched, so exact hits of
the pieces, found by one automaton over the whole text, miss no match. Around
each hit (hits of nearly the same alignment taken together) Myers' bit-parallel
distance gives the least number of edits exactly.

The benchmark is the stated query set. It is handled in blocks of at most
``block_chars`` characters (or one longer item); each block is one automaton in
the tasks and one pass over the rows at hand (no shuffle, no pairs of rows).
Blocks are normalised in tasks and streamed one at a time into broadcast
variables, which Spark keeps on disk where memory is short: neither the driver
nor a task holds more than one block, and the plan holds their handles alone.

Without an edit allowed (short items), an item is found as whole words only.

Defined results: null or empty texts are clean; benchmark items that are null or
without a word are not searched (``min_item``, 1 by default, leaves out items of
fewer normalised characters where a caller asks for it); equal items are all
reported; ids keep their type, and a null id is an id of its own, the first; repeated rows are judged row by row; extra columns stay (one
named like an output is replaced); an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, texts_of, with_text

WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    return " ".join(WORD.findall((text or "").lower()))


def budget(n: int, error_rate: float, min_piece: int) -> int:
    """Edits allowed for an item of n characters: every piece keeps min_piece."""
    return max(0, min(int(n * error_rate), n // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length."""
    n = len(item)
    ends = [round(i * n / (k + 1)) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def myers(pattern: dict[str, int], m: int, text: str) -> int:
    """Least edit distance of a pattern (its character masks, length m) to any
    stretch of ``text``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = pattern.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph = (ph << 1) & full                       # a match may begin anywhere: no carry in
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
    return best


class Matcher:
    """Automaton and masks of one block of items [(id as JSON, normalised text)]."""

    def __init__(self, items: list[tuple[str, str]], error_rate: float, min_piece: int):
        import ahocorasick
        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for i, text in items:
            k = budget(len(text), error_rate, min_piece)
            masks: dict[str, int] = {}
            for j, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << j
            for offset, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((i, text, k, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[str, int]]:
        """(id as JSON, least distance) of the items in a normalised text."""
        if not self.items or not text:
            return []
        begins: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for item, offset in where:
                begins.setdefault(item, set()).add(end + 1 - size - offset)
        out = []
        for item, at in begins.items():
            i, body, k, masks = self.items[item]
            if not k:
                if any(text[max(0, b - 1):b] in ("", " ") and text[b + len(body):b + len(body) + 1] in ("", " ") for b in at):
                    out.append((i, 0))
                continue
            best, done = k + 1, None
            for b in sorted(at):
                if done is not None and b <= done:
                    continue
                # begins up to k apart are one alignment
                done = b + k
                window = text[max(0, b - k):b + len(body) + 2 * k]
                best = min(best, 0 if body in window else myers(masks, len(body), window))
                if not best:
                    break
            if best <= k:
                out.append((i, best))
        return out


def blocks_of(benchmark: DataFrame, item_id: str, text: str, min_item: int,
              block_chars: int) -> Iterator[list[tuple[str, str]]]:
    """Blocks of the stated query set, packed by tasks and streamed one by one."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block: list[tuple[str, str]] = []
        size = 0
        for frame in frames:
            for i, t in zip(frame["i"], frame["t"]):
                item = normalise(t)
                if len(item) < max(1, min_item):
                    continue
                if block and size + len(item) > block_chars:
                    yield pd.DataFrame({"ids": [[b[0] for b in block]], "items": [[b[1] for b in block]]})
                    block, size = [], 0
                block.append((i, item))
                size += len(item)
        if block:
            yield pd.DataFrame({"ids": [[b[0] for b in block]], "items": [[b[1] for b in block]]})
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.to_json(F.struct(F.col(item_id).alias("i"))).alias("i"), F.col(text).alias("t"))
    block, size = [], 0
    for r in rows.mapInPandas(pack, "ids array<string>, items array<string>").toLocalIterator():
        # small packs of several partitions share a block
        more = sum(map(len, r["items"]))
        if block and size + more > block_chars:
            yield block
            block, size = [], 0
        block += zip(r["ids"], r["items"])
        size += more
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", keep: list[str] | None = None, error_rate: float = 0.05,
                  min_piece: int = 16, min_item: int = 1, block_chars: int = 2_000_000) -> DataFrame:
    """``docs`` (columns ``keep``; all by default) with ``contaminated``,
    ``items`` (ids found, ascending) and ``distances`` (least edits of each)."""
    made = ["contaminated", "items", "distances"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    ids, hit = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
    out, name = with_text(docs, keep, text)
    schema = T.StructType([*out.schema, T.StructField("items", ids), T.StructField("distances", hit)])
    out = out.withColumns({"items": F.array().cast(ids), "distances": F.array().cast(hit)})

    def passed(block: Broadcast):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = None
            for frame in frames:
                matcher = matcher or Matcher(block.value, error_rate, min_piece)
                for part in batches_by_bytes(frame, name):
                    items, distances = [], []
                    for t, a, b in zip(texts_of(part, name), part["items"], part["distances"]):
                        best = dict(zip(a, b))
                        for i, d in matcher.matches(normalise(t)):
                            best[i] = min(d, best.get(i, d))
                        items.append(sorted(best))
                        distances.append([best[i] for i in sorted(best)])
                    yield part.assign(items=items, distances=distances)
        return run
    for block in blocks_of(benchmark, item_id, item_text, min_item, block_chars):
        out = out.mapInPandas(passed(docs.sparkSession.sparkContext.broadcast(block)), schema)
    id_type = T.StructType([T.StructField("i", benchmark.schema[item_id].dataType)])
    found = F.sort_array(F.transform(F.arrays_zip("items", "distances"), lambda x: F.struct(
        F.from_json(x["items"], id_type)["i"].alias("i"), x["distances"].alias("d"))))
    return out.select(*keep, (F.size("items") > 0).alias("contaminated"), found.alias("__found")).select(
        *keep, "contaminated", F.col("__found.i").alias("items"), F.col("__found.d").alias("distances"))
