"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word has a class: the most frequent words of the corpus are one each, all
others are classed by shape (letter case, digits, symbols, last character,
length). The network, in numpy, predicts every class from the classes of
``SIDE`` words on each side, never from itself: position-wise embeddings are
added, passed through tanh, and a softmax over the classes follows. The word is
then predicted within its class, from counts of all words of the corpus. A
document's score is the sum of log P(class | both sides) + log P(word | class).

P(word | class) is Witten-Bell's: n(word) / (N + T) for a word of the corpus,
with N words and T different ones in the class; an unseen word has T / (N + T)
(1 in an empty class) times the chance of its spelling, of equally likely code
points, each the last one with chance 1/2. The table of all words grows with the
corpus and is stored; the logs of at most ``HEAD`` frequent words are sent to
the tasks, the others (no hot ones) are joined by word.

Training sees every document once, in ``ROUNDS`` rounds by id-independent hash:
in each round every task starts from the network so far, takes gradient steps
over its documents, and the networks are averaged in Spark, weighted by their
number of words, in a tree of sums. Only networks (fixed size), the frequent words and counts of bins reach the driver.

Defined results: a null or wordless text has 0 words, score 0 and a null mean;
without any word the network stays untrained; repeated rows are scored row by
row; extra columns stay (one named like an output is replaced), and are stored
with the scores, so they should be narrow. Whole texts are read; numbers may differ in the last digits with the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import staged

WORDS, SHAPES, SIDE, WIDTH, ROUNDS, BATCH = 95, 32, 2, 16, 3, 4096
SYMBOLS = 1 + WORDS + SHAPES                       # 0 stands for beyond the text
HEAD, CODE_POINTS = 200_000, 0x110000
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
ONES = np.ones(SYMBOLS, np.float32)
FAN = 256                                          # networks of a round are summed in this many groups, then once more


def shape(word: str) -> int:
    """Number of the shape of a word, 0 to SHAPES - 1."""
    last = word[-1]
    end = 0 if last.isalpha() else 1 if last in ".!?" else 2 if last.isdigit() else 3
    case = 0 if word.islower() else 1 if word.isupper() else 2 if word[0].isupper() else 3
    return (end * 4 + case) * 2 + (len(word) > 7)


def places(kinds: pa.StringArray, of: pa.StringArray) -> np.ndarray:
    """Place of every word in ``of``, -1 if it is not there."""
    return pc.fill_null(pc.index_in(kinds, value_set=of), -1).to_numpy(zero_copy_only=False)


def _byte_kinds() -> np.ndarray:
    """Of each byte of UTF-8, as bits: 1 lower case, 2 upper case, 4 digit, 8 in ".!?", 16 beyond ASCII."""
    out = np.zeros(256, np.uint8)
    for bit, of in ((1, range(0x61, 0x7B)), (2, range(0x41, 0x5B)), (4, range(0x30, 0x3A)), (8, b".!?"), (16, range(0x80, 0x100))):
        out[list(of)] = bit
    return out


BYTE_KINDS = _byte_kinds()


class Symbols(dict):
    """Symbols of words. ``shape`` of ASCII words is worked out from the bytes of all words
    together; the dictionary keeps that of others up to a bound."""

    def __init__(self, words: list[str], bound: int = 300_000):
        super().__init__()
        self.words, self.bound = pa.array(words, pa.string()), bound

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        got = self[word] = shape(word)
        return got

    def shapes(self, kinds: pa.StringArray) -> np.ndarray:
        """``shape`` of every word; 0 for an empty one."""
        ends = np.frombuffer(kinds.buffers()[1], np.int32)[kinds.offset:kinds.offset + len(kinds) + 1]
        data = kinds.buffers()[2]
        of = np.append(BYTE_KINDS[np.frombuffer(data or b"", np.uint8)[:ends[-1]]], np.uint8(0))
        some = np.bitwise_or.reduceat(of, ends[:-1]) if len(kinds) else of[:0]
        size = np.diff(ends)
        first, last = of[ends[:-1]], of[ends[1:] - 1]
        end = np.select([last & 3 > 0, last & 8 > 0, last & 4 > 0], [0, 1, 2], 3)
        case = np.select([some & 3 == 1, some & 3 == 2, first & 2 > 0], [0, 1, 2], 3)
        out = np.where(size > 0, (end * 4 + case) * 2 + (size > 7), 0)
        other = np.flatnonzero((some & 16 > 0) & (size > 0))
        out[other] = [self[w] for w in kinds.take(pa.array(other)).to_numpy(zero_copy_only=False).tolist()]
        return out

    def of(self, kinds: pa.StringArray) -> np.ndarray:
        listed = places(kinds, self.words)
        symbols = np.where(listed >= 0, 1 + listed, 1 + WORDS + self.shapes(kinds))
        return np.where(pc.equal(kinds, "").to_numpy(zero_copy_only=False), 0, symbols).astype(np.int64)


def numbered_words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(different words, number of each word of all texts, words of each text);
    words lie between white space as ``str.split`` has it."""
    lists = pc.utf8_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    kinds, ids = coded.dictionary, coded.indices.to_numpy()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    empty = pc.index(kinds, "").as_py()
    if empty >= 0:                                 # beside white space at either end
        real = ids != empty
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        ids = ids[real]
    return kinds, ids, np.diff(ends, prepend=0)


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``numbered_words`` of a list."""
    kinds, ids, sizes = numbered_words(pa.array(texts, pa.string()))
    return kinds.to_numpy(zero_copy_only=False).tolist(), ids, sizes


def laid_out(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, SIDE zeros around each; places of the words)."""
    at = np.arange(len(symbols)) + SIDE * (1 + np.repeat(np.arange(len(sizes)), sizes))
    s = np.zeros(len(symbols) + SIDE * (len(sizes) + 1), np.int64)
    s[at] = symbols
    return s, at


def sequence(texts: pa.StringArray | list[str], symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, SIDE zeros around each; words of each text)."""
    kinds, ids, sizes = numbered_words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    return laid_out(symbols.of(kinds)[ids], sizes)[0], sizes


class Network:
    """E: embeddings by offset, W and b: output layer, as one flat vector."""

    def __init__(self, flat: np.ndarray):
        flat = flat.astype(np.float32)
        e = len(OFFSETS) * SYMBOLS * WIDTH
        self.flat = flat
        self.E = flat[:e].reshape(len(OFFSETS), SYMBOLS, WIDTH)
        self.W = flat[e:e + WIDTH * SYMBOLS].reshape(WIDTH, SYMBOLS)
        self.b = flat[e + WIDTH * SYMBOLS:]

    @staticmethod
    def fresh(bias: np.ndarray) -> np.ndarray:
        """Small fixed random weights; the output bias is the unigram log
        probability, so training starts from the unigram model."""
        rng = np.random.default_rng(0)
        n = (len(OFFSETS) + 1) * SYMBOLS * WIDTH
        return np.concatenate([rng.normal(0, 0.1, n), bias])

    def forward(self, s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hidden layer, logits, shift) at positions ``at`` of ``s``; exp of
        the logits minus the shift is safe in single precision."""
        h = self.E[0].take(s[at + OFFSETS[0]], axis=0)
        for j, o in enumerate(OFFSETS[1:], 1):
            h += self.E[j].take(s[at + o], axis=0)
        np.tanh(h, out=h)
        z = h @ self.W
        z += self.b
        # |h| < 1 bounds every logit; only beyond a safe bound are rows shifted
        if np.abs(self.W).sum(0).max() + np.abs(self.b).max() < 60:
            return h, z, np.zeros((len(at), 1), np.float32)
        top = z.max(1, keepdims=True)
        z -= top
        return h, z, top

    def log_probabilities(self, s: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the symbol at every position of ``at``."""
        out = np.empty(len(at), np.float32)
        for k in range(0, len(at), BATCH):
            part = at[k:k + BATCH]
            _, z, _ = self.forward(s, part)
            hit = z[np.arange(len(part)), s[part]]
            out[k:k + BATCH] = hit - np.log(np.exp(z, out=z) @ ONES)
        return out

    def train(self, s: np.ndarray, at: np.ndarray, rate: float = 0.5) -> None:
        """One gradient step per BATCH positions, in order."""
        for k in range(0, len(at), BATCH):
            part = at[k:k + BATCH]
            h, z, _ = self.forward(s, part)
            g = np.exp(z, out=z)                   # gradient at the softmax, P - onehot, times the row's total
            total = g @ ONES
            g[np.arange(len(part)), s[part]] -= total
            each = ((rate / BATCH) / total).astype(np.float32)
            gh = (g @ self.W.T) * (1 - h * h)
            h *= each[:, None]
            self.W -= h.T @ g
            self.b -= each @ g
            gh *= 4 * each[:, None]                # rare contexts: larger steps
            for j, o in enumerate(OFFSETS):
                x = s[part + o].astype(np.int16)   # sorted by digits
                order = np.argsort(x, kind="stable")
                ordered = x[order]
                begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                self.E[j][ordered[begin]] -= np.add.reduceat(gh.take(order, axis=0), begin, axis=0)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text"))


def slices(batch: pa.RecordBatch, limit: int = 3_000_000) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Slices of a batch and their column ``__text``, of at most ``limit`` characters together (or a
    single row), so memory does not follow the batch size."""
    texts = batch.column(batch.schema.names.index("__text"))
    total, begin = 0, 0

    def cut(end: int) -> tuple[pa.RecordBatch, pa.StringArray]:
        return batch.slice(begin, end - begin), texts.slice(begin, end - begin).cast(pa.string())
    for k, n in enumerate(pc.utf8_length(texts).to_pylist()):
        if total and total + n > limit:
            yield cut(k)
            total, begin = 0, k
        total += n
    if begin < len(texts):
        yield cut(len(texts))


FLUSH_BYTES = 64 << 20      # of words that a task holds to count them


def word_counts(docs: DataFrame, text: str = "text", flush: int = 300_000) -> DataFrame:
    """(word, n) of every word over all documents, stored."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            got = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return got.select(["word", "n_sum"]).rename_columns(["word", "n"])
        for batch in batches:
            for _, texts in slices(batch):
                seen = pc.utf8_split_whitespace(texts).flatten().value_counts()
                held.append(pa.table({"word": seen.field(0), "n": seen.field(1)}).filter(pc.field("word") != ""))
                if sum(t.num_rows for t in held) > 2 * flush or sum(t.nbytes for t in held) > FLUSH_BYTES:
                    held = [summed()]
                    if held[0].num_rows > flush or held[0].nbytes > FLUSH_BYTES // 2:
                        yield from held[0].to_batches()      # bounded memory: partial counts go to the shuffle
                        held = []
        if held:
            yield from summed().to_batches()
    counts = _texts(docs, text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return staged(counts, "lm-words")


def vocabulary(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """(the WORDS most frequent words, first by word among equals; their counts)."""
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    return [r.word for r in top], np.array([r.n for r in top], float)


def train(docs: DataFrame, text: str = "text", counts: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """(words, network) trained over all documents; ``counts`` are their ``word_counts``."""
    words, counts = vocabulary(word_counts(docs, text) if counts is None else counts)
    share = np.full(SYMBOLS, 1.0)
    share[1:1 + len(words)] = counts
    # shapes share as much as the listed words together; training sets them right
    share[1 + WORDS:] = max(counts.sum(), 1.0) / SHAPES
    flat = Network.fresh(np.log(share / share.sum()))
    rows = _texts(docs, text)
    for r in range(ROUNDS):
        start = flat

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            net, symbols, n = Network(start.copy()), Symbols(words), 0
            for batch in batches:
                for _, texts in slices(batch):
                    s, sizes = sequence(texts, symbols)
                    at = np.flatnonzero(s)
                    net.train(s, at)
                    n += len(at)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([net.flat.astype(np.float64)])], ["n", "w"])
        mine = rows.filter(F.pmod(F.xxhash64("__text"), F.lit(ROUNDS)) == r)
        flat = averaged(mine.mapInArrow(learn, NETWORK), flat)
    return words, flat


NETWORK = "n double, w array<double>"


def averaged(networks: DataFrame, before: np.ndarray) -> np.ndarray:
    """Mean of the rows (n, w) weighted by n, one array a partition, summed as a
    tree of two levels; ``before`` without any row."""
    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        n, w = frame["n"].sum(), np.zeros(len(before))
        for share, one in zip(frame["n"] / n, frame["w"]):
            w += share * one
        return pd.DataFrame({"n": [n], "w": [w]})
    some = networks.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("part")).applyInPandas(mean, NETWORK)
    got = some.groupBy(F.lit(0).alias("part")).applyInPandas(mean, NETWORK).first()
    return before if got is None else np.array(got.w)


def frequent(counts: DataFrame, most: int, fan: int = 64) -> tuple[dict[str, int], int]:
    """(counts of all words from some count on, at most ``most`` of them; that
    count), by a search that cuts the range of counts in ``fan`` each time."""
    low, high, above = 1, (counts.agg(F.max("n")).first()[0] or 0) + 1, 0
    least = low
    while low < high:
        step = -(-(high - low) // fan)
        bins = (counts.filter(F.col("n").between(low, high - 1)).groupBy(F.floor((F.col("n") - low) / step).alias("bin"))
                .agg(F.count("*").alias("kinds")).collect())         # at most ``fan`` rows
        for r in sorted(bins, key=lambda r: -r.bin):
            if above + r.kinds > most:
                low, high = low + r.bin * step, min(high, low + (r.bin + 1) * step)
                break
            above += r.kinds
        else:
            least = low                            # all of the range fit
            break
        if step == 1:                              # the words of this one count do not fit
            least = high
            break
    return {r.word: r.n for r in counts.filter(F.col("n") >= least).collect()}, least


def class_sizes(counts: DataFrame, words: list[str]) -> np.ndarray:
    """Words N and different words T of every shape, without the listed words."""
    def shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed, out = set(words), np.zeros((2, SHAPES), np.int64)
        for frame in frames:
            for w, n in zip(frame["word"], frame["n"].tolist()):
                if w not in listed:
                    k = shape(w)
                    out[0, k] += n
                    out[1, k] += 1
        yield pd.DataFrame({"k": range(SHAPES), "n": out[0], "t": out[1]})
    got = np.zeros((2, SHAPES))
    for r in counts.mapInPandas(shapes, "k int, n long, t long").groupBy("k").agg(F.sum("n"), F.sum("t")).collect():
        got[:, r[0]] = r[1:]
    return got


def score(docs: DataFrame, words: list[str], network: np.ndarray, text: str = "text",
          keep: list[str] | None = None, counts: DataFrame | None = None, head: int = HEAD) -> DataFrame:
    """``docs`` (columns ``keep``; all by default) with ``n_words``, ``log_prob``
    (sum over the words) and ``mean_log_prob``; ``counts`` are the ``word_counts``
    of the corpus, by default of ``docs``."""
    made = ["n_words", "log_prob", "mean_log_prob"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_words", T.LongType()),
                           T.StructField("log_prob", T.DoubleType()), T.StructField("__tail", T.ArrayType(T.StringType())),
                           T.StructField("__shapes", T.ArrayType(T.IntegerType()))])
    counts = word_counts(docs, text) if counts is None else counts
    often, least = frequent(counts, head)
    sizes_of = class_sizes(counts, words)
    total = sizes_of.sum(0)
    listed = set(words)
    within = {w: math.log(n / total[shape(w)]) for w, n in often.items() if w not in listed} | dict.fromkeys(words, 0.0)
    known, logs = pa.array(list(within), pa.string()), np.array([*within.values(), math.nan])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, symbols = Network(network), Symbols(words)
        for batch in batches:
            for part, texts in slices(batch):
                kinds, ids, sizes = numbered_words(texts)
                s, at = laid_out(symbols.of(kinds)[ids], sizes)
                inner = logs[places(kinds, known)][ids]              # NaN, the last one, for a word that has none
                each = net.log_probabilities(s, at) + np.nan_to_num(inner)
                ends = np.concatenate([[0], np.cumsum(each, dtype=np.float64)])
                stop = np.cumsum(sizes)
                rare = np.flatnonzero(np.isnan(inner))
                cuts = pa.array(np.searchsorted(rare, np.concatenate([[0], stop])).astype(np.int32))
                tail, shapes = kinds.take(pa.array(ids[rare])), pa.array((s[at[rare]] - 1 - WORDS).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(sizes.astype(np.int64)), pa.array(ends[stop] - ends[stop - sizes]),
                     pa.ListArray.from_arrays(cuts, tail), pa.ListArray.from_arrays(cuts, shapes)], schema.names)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "lm-scores")
    # words of the tail meet their counts; none of them is frequent, so no key is hot
    tail = rows.select("__row", F.explode(F.arrays_zip("__tail", "__shapes")).alias("t"))
    tail = tail.select("__row", F.col("t.__tail").alias("word"), F.col("t.__shapes").alias("k"))
    tail = tail.join(counts.filter(F.col("n") < least), "word", "left")

    def of_class(values: np.ndarray):
        return F.element_at(F.array(*map(F.lit, values.tolist())), F.col("k") + 1)
    seen = F.log(F.col("n") / of_class(np.maximum(total, 1.0)))
    unseen = of_class(np.log(np.where(total > 0, sizes_of[1], 1.0) / np.maximum(total, 1.0))) \
        - F.length("word") * math.log(2 * CODE_POINTS)
    lost = tail.groupBy("__row").agg(F.sum(F.when(F.col("n").isNotNull(), seen).otherwise(unseen)).alias("__inner"))
    out = rows.join(lost, "__row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("__inner", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return out.select(*keep, "n_words", "log_prob", mean.alias("mean_log_prob"))
