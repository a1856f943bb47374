"""Quality rules: length and repetition within a text, line frequency across texts.

Within a text: words are runs without ASCII white space. A document fails the
base rules with fewer than ``min_words`` words, or if more than
``max_repeat_percent`` of its words lie in ``window``-word windows that the text
has twice or more (the first one included).

Across texts: every line with a word is normalised (A-Z lowered, words joined by
one space) and hashed; per host, the distinct documents of each hash are
counted. Documents are one if all their normalised lines are equal, in order, so
exact copies of a text do not make its lines frequent: they are the business of
deduplication. A line in more than ``max_docs`` documents of its host, and in more than ``max_share`` of
them, of ``share_docs`` documents at most, is removed from every document of that
host. The share is for small hosts: in a larger one the limit stays, and by default
it is ``max_docs`` at every size. A document that keeps less
than ``min_kept`` of its words is depleted and rejected.

Counting is two-step (distinct lines of a document first), pre-aggregated and
spread over (host, line, document), so a hot host or line meets no single task.

Defined results: a null text has no words and fails; a null host is a host of its
own; repeated rows are judged row by row and count as one document; extra
columns stay (one named like an output is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, staged, texts_of, with_text, without_text

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * _MIX + h[k:k + n]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # hashes only propose: the windows themselves decide
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(rolled, twice)).tolist():
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    covered = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            covered[at] += 1
            covered[np.asarray(at) + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str, window: int) -> tuple[int, int, int, int, int]:
    """``MEASURES`` of a text."""
    words = text.encode("utf-8", "surrogatepass").split()      # ASCII white space only
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dups,
            repeated_words(words, window))


def lines_of(text: str) -> tuple[list[tuple[int, int]], int, int]:
    """((hash, words) of every line, (0, 0) for one without words), both halves
    of a hash of the whole normalised text."""
    from xxhash import xxh3_128_intdigest, xxh64_intdigest
    out, whole = [], []
    for line in text.encode("utf-8", "surrogatepass").translate(_LOWER).split(b"\n"):
        words = line.split()
        if not words:
            out.append((0, 0))
            continue
        line = b" ".join(words)
        whole.append(line)
        out.append((xxh64_intdigest(line) - (1 << 63), len(words)))
    both = xxh3_128_intdigest(b"\n".join(whole))
    return out, (both >> 64) - (1 << 63), (both & ((1 << 64) - 1)) - (1 << 63)


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None,
                  min_words: int = 20, window: int = 8, max_repeat_percent: int = 30, max_docs: int = 30,
                  max_share: float = 0.001, min_kept: float = 1 / 3,
                  share_docs: int = 30_000) -> DataFrame:
    """``docs`` (columns ``keep``, which should be narrow: they are stored; all
    by default) with the measures, ``base_failed``, ``n_removed_words`` (words
    in frequent lines), ``removed_lines`` (their numbers from 0) and ``kept``."""
    made = [*MEASURES, "base_failed", "n_removed_words", "removed_lines", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    line = T.StructType([T.StructField("hash", T.LongType()), T.StructField("words", T.IntegerType())])
    rows, name = with_text(docs.withColumn("__host", F.col(host)), [*keep, "__host"], text)
    schema = T.StructType([*(f for f in rows.schema if f.name != "__text"),
                           *(T.StructField(m, T.LongType()) for m in MEASURES),
                           T.StructField("__lines", T.ArrayType(line)), T.StructField("__high", T.LongType()),
                           T.StructField("__low", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in batches_by_bytes(frame, name):
                texts = texts_of(part, name)
                got = [measure(t, window) for t in texts]
                lines = [lines_of(t) for t in texts]
                yield without_text(part, name).assign(
                    **dict(zip(MEASURES, map(list, zip(*got)))),
                    __lines=[[{"hash": h, "words": w} for h, w in x[0]] for x in lines],
                    __high=[x[1] for x in lines], __low=[x[2] for x in lines])
    rows = staged(rows.mapInPandas(run, schema).withColumn("__row", F.monotonically_increasing_id()), "quality-rows")
    # a null host is joined like any other
    rows = rows.withColumn("__key", F.to_json(F.struct(F.col("__host").alias("h"))))

    # one row of each different text of a host speaks for it
    texts = rows.groupBy("__key", "__high", "__low").agg(F.min("__row").alias("__row")).select("__row")
    said = rows.join(texts, "__row").select("__key", F.explode(F.array_distinct("__lines.hash")).alias("hash")).filter("hash <> 0")
    often = said.groupBy("__key", "hash").count().filter(F.col("count") > max_docs)
    hosts = rows.select("__key", "__high", "__low").distinct().groupBy("__key").agg(F.count("*").alias("docs"))
    often = often.join(hosts, "__key").filter(F.col("count") > max_share * F.least("docs", F.lit(share_docs))).select("__key", "hash")
    often = staged(often, "quality-lines")
    spots = rows.select("__row", "__key", F.posexplode("__lines").alias("at", "line"))
    spots = spots.select("__row", "__key", "at", F.col("line.hash").alias("hash"), F.col("line.words").alias("words"))
    hit = spots.join(often, ["__key", "hash"])
    lost = hit.groupBy("__row").agg(F.sum("words").alias("n_removed_words"),
                                    F.array_sort(F.collect_list("at")).alias("removed_lines"))
    out = rows.join(lost, "__row", "left").withColumns({
        "n_removed_words": F.coalesce("n_removed_words", F.lit(0)),
        "removed_lines": F.coalesce("removed_lines", F.array().cast("array<int>")),
        "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))})
    left = F.col("n_words") - F.col("n_removed_words")
    out = out.withColumn("kept", ~F.col("base_failed") & (left >= min_kept * F.col("n_words")))
    return out.select(*keep, *made)


def clean_documents(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The kept rows of ``docs``, all columns, ``text`` without its frequent
    lines (null stays out: it has no words). Equal texts of a host have one
    verdict, so texts meet it by (host, MD5) and are stored nowhere."""
    key = F.to_json(F.struct(F.col(host).alias("h"), F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("m")))
    keyed = docs.withColumn("__content", key)
    judged = quality_rules(keyed, text, host, keep=["__content"], **limits)
    judged = judged.filter("kept").select(F.col("__content").alias("__judged"), "removed_lines").dropDuplicates(["__judged"])
    # the verdicts are the table of the hash join, the texts stream by unsorted
    out = keyed.join(judged.hint("shuffle_hash"), keyed["__content"] == judged["__judged"])
    lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("removed_lines"), i))
    clean = F.when(F.size("removed_lines") == 0, F.col(text)).otherwise(F.array_join(lines, "\n"))
    return out.withColumn(text, clean).select(*docs.columns)
