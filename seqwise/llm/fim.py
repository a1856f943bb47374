"""Fill-in-middle transformation by secondary-sort assembly.

A text is a row of units (a run of ASCII letters, or any other single code
point). Two cuts drawn from a hash of the document's id split it into prefix,
middle and suffix; the output writes them in another order behind sentinels.

No task builds an output text. ``cut_pieces`` emits a document as pieces, chunks
of whole units of at most ``size`` code points (a longer unit is cut inside),
keyed by the document's row and the piece's place in the output.
``repartition(row)`` and ``sortWithinPartitions(row, place)``, the DataFrame form
of ``repartitionAndSortWithinPartitions`` (one exchange, sorted and spilled by
the JVM), bring every document's pieces one after the other into a stream that
feeds an incremental SHA-256. For restoration the stream is read as plain
output text: a scanner that knows only the three sentinels tells the segments
apart, also where a sentinel lies across two pieces, and emits what it read
keyed by (row, segment, place). A second sort within the same partitions, without
another exchange, puts the segments in their first order for the digest of the
restored text. A task holds one Arrow batch of pieces.

Defined results: a null or empty text is plain, with no unit and an empty
output; a text with a sentinel inside is plain; a null id is hashed as the empty
string; repeated rows and ids give one row each (the key is the row, not the
id); extra columns stay if asked for, and one named like an output is replaced.
Rows are numbered by ``monotonically_increasing_id``, so ``docs`` should be a scan
or another frame whose order of rows is repeatable; store it first otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = re.compile("(<[PSM]>)")
SEGMENT = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PIECE = 32_768
STEP = 1 << 20
LETTER = re.compile("[A-Za-z]")


def unit_starts(text: str, begin: int, end: int) -> np.ndarray:
    """Offsets in [begin, end) at which a unit starts."""
    left = max(begin - 1, 0)
    code = np.frombuffer(text[left:end].encode("utf-32-le", "surrogatepass"), "<u4") | 32
    letter = (code >= 97) & (code <= 122)
    start = ~letter
    start[1:] |= ~letter[:-1]
    if left == begin:
        start[:1] = True
        return begin + np.flatnonzero(start)
    return begin + np.flatnonzero(start[1:])


def unit_offsets(text: str, pick) -> tuple[int, list[int]]:
    """(units n, offset of the unit of each number in ``pick(n)``), a stretch of
    the text at a time; the number n is the end of the text."""
    steps = range(0, len(text), STEP)
    first = unit_starts(text, 0, min(STEP, len(text))) if text else np.zeros(0, np.int64)
    ends = np.cumsum([len(first) if x == 0 else len(unit_starts(text, x, min(x + STEP, len(text)))) for x in steps])
    n = int(ends[-1]) if len(ends) else 0
    out = []
    for u in pick(n):
        if u >= n:
            out.append(len(text))
            continue
        k = int(np.searchsorted(ends, u, "right"))
        starts = first if k == 0 else unit_starts(text, k * STEP, min((k + 1) * STEP, len(text)))
        out.append(int(starts[u - (int(ends[k - 1]) if k else 0)]))
    return n, out


def chunks(text: str, begin: int, end: int, size: int) -> Iterator[str]:
    """text[begin:end] in chunks of whole units, where a unit is not longer than ``size``."""
    while begin < end:
        stop = min(begin + size, end)
        if stop < end:
            back = stop
            while back > begin and LETTER.match(text[back - 1]) and LETTER.match(text[back]):
                back -= 1
            stop = back if back > begin else stop
        yield text[begin:stop]
        begin = stop


def plan(doc_id, text: str, seed: str, plain_share: int, spm_share: int) -> tuple[int, str, int | None, int | None]:
    """(units, form, offset of the first cut, of the second) of a document."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n, (a, b) = unit_offsets(text, lambda n: sorted((h[0] % (n + 1), h[1] % (n + 1))))
    if not text or h[2] % 100 >= 100 - plain_share or SENTINEL.search(text):
        return n, "plain", None, None
    return n, "spm" if h[3] % 100 < spm_share else "psm", a, b


def output_pieces(text: str, form: str, a: int | None, b: int | None, size: int) -> Iterator[str]:
    """The output of a document, a piece at a time (one empty piece at least)."""
    if form == "plain":
        spans = [("", 0, len(text))]
    elif form == "psm":
        spans = [(PREFIX, 0, a), (SUFFIX, b, len(text)), (MIDDLE, a, b)]
    else:
        spans = [(SUFFIX, b, len(text)), (PREFIX, 0, a), (MIDDLE, a, b)]
    for sentinel, begin, end in spans:
        pieces = chunks(text, begin, end, size)
        yield sentinel + next(pieces, "")
        yield from pieces


def cut_pieces(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: list[str] | None = None,
               size: int = PIECE, seed: str = "1", plain_share: int = 10, spm_share: int = 20) -> DataFrame:
    """(row, place, piece, head) of every document: ``head`` is a struct of the
    kept columns and n, form, prefix_chars, middle_chars, on place 0 only."""
    made = ["n", "form", "prefix_chars", "middle_chars"]
    keep = [c for c in (keep or [id_column]) if c not in (*made, "output", "restored", "output_sha256", "restored_sha256")]
    head = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n", T.LongType()),
                         T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                         T.StructField("middle_chars", T.LongType())])
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("piece", T.StringType()), T.StructField("head", head)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            kept, numbers = batch.column("kept"), batch.column("row")
            out = Pieces(kept, numbers)
            for k, (i, t) in enumerate(zip(ids, texts)):
                n, form, a, b = plan(i, t, seed, plain_share, spm_share)
                measured = (n, form, a, None if a is None else b - a)
                for place, piece in enumerate(output_pieces(t, form, a, b, size)):
                    out.add(k, place, piece, measured)
                    if out.held > 4_000_000:
                        yield out.batch()
            yield out.batch()

    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    sent = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), kept.alias("kept"),
                       F.monotonically_increasing_id().alias("row"))
    return sent.mapInArrow(run, schema)


class Pieces:
    """Rows of pieces on their way into an Arrow batch."""

    def __init__(self, kept: pa.Array, numbers: pa.Array):
        self.kept, self.numbers = kept, numbers
        self.clear()

    def clear(self) -> None:
        self.rows, self.places, self.pieces, self.heads, self.held = [], [], [], [], 0

    def add(self, k: int, place: int, piece: str, measured: tuple) -> None:
        self.rows.append(k)
        self.places.append(place)
        self.pieces.append(piece)
        self.heads.append(measured if place == 0 else None)
        self.held += len(piece)

    def batch(self) -> pa.RecordBatch:
        first = [k if h is not None else None for k, h in zip(self.rows, self.heads)]
        kept = self.kept.take(pa.array(first, pa.int64()))
        fields = {} if self.kept.type.field(0).name == "none" and self.kept.type.num_fields == 1 else {
            f.name: kept.field(i) for i, f in enumerate(self.kept.type)}
        for i, (name, kind) in enumerate((("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                                          ("middle_chars", pa.int64()))):
            fields[name] = pa.array([None if h is None else h[i] for h in self.heads], kind)
        none = pa.array([h is None for h in self.heads], pa.bool_())
        head = pa.StructArray.from_arrays(list(fields.values()), list(fields), mask=none)
        out = pa.RecordBatch.from_arrays(
            [self.numbers.take(pa.array(self.rows, pa.int64())), pa.array(self.places, pa.int64()),
             pa.array(self.pieces, pa.string()), head], ["row", "place", "piece", "head"])
        self.clear()
        return out


class Scanner:
    """Reads output text as it streams by and tells its segments apart by the
    sentinels alone; the last two characters wait for what may follow them."""

    def __init__(self, plain: bool):
        self.plain, self.segment, self.rest, self.place = plain, 0, "", 0

    def read(self, piece: str, last: bool = False) -> Iterator[tuple[int, int, str]]:
        if self.plain:
            yield from self.emit(piece)
            return
        parts = SENTINEL.split(self.rest + piece)
        tail = parts[-1]
        cut = len(tail)
        if not last:
            at = tail.rfind("<", max(0, len(tail) - 2))
            cut = at if at >= 0 else cut
        parts[-1], self.rest = tail[:cut], tail[cut:]
        for k, part in enumerate(parts):
            if k % 2:
                self.segment = SEGMENT[part]
            else:
                yield from self.emit(part)

    def emit(self, part: str) -> Iterator[tuple[int, int, str]]:
        if part:
            yield self.segment, self.place, part
            self.place += 1


class Gathered:
    """What becomes of a stream of strings: its digest, or the whole."""

    def __init__(self, digest: bool):
        self.hash, self.parts = (sha256(), None) if digest else (None, [])

    def add(self, piece: str) -> None:
        if self.hash is None:
            self.parts.append(piece)
        else:
            self.hash.update(piece.encode("utf-8", "surrogatepass"))

    def result(self) -> str:
        return "".join(self.parts) if self.hash is None else self.hash.hexdigest()


def stream(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """The rows of sorted batches; the column ``head`` as one-row arrays, or None."""
    for batch in batches:
        cols = [batch.column(n).to_pylist() if n != "head" else
                [batch.column(n).slice(k, 1) if ok else None for k, ok in enumerate(batch.column(n).is_valid().to_pylist())]
                for n in names]
        yield from zip(*cols)


def fill_in_middle(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: list[str] | None = None,
                   digest: bool = True, size: int = PIECE, seed: str = "1", plain_share: int = 10,
                   spm_share: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``keep`` columns, n, form, prefix_chars,
    middle_chars and the SHA-256 of the output and of the restored text as
    ``output_sha256`` and ``restored_sha256``, or with ``digest=False`` the texts
    themselves as ``output`` and ``restored``."""
    pieces = cut_pieces(docs, text, id_column, keep, size, seed, plain_share, spm_share)
    head = pieces.schema["head"].dataType
    told = T.StructType([T.StructField("row", T.LongType()), T.StructField("segment", T.IntegerType()),
                         T.StructField("place", T.LongType()), T.StructField("piece", T.StringType()),
                         T.StructField("head", head)])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held, now, scanner, whole, first, kind = 0, None, None, None, None, None

        def end():
            out.extend((now, seg, place, part, None) for seg, place, part in scanner.read("", last=True))
            out.append((now, -1, 0, whole.result(), first))
        for row, place, piece, top in stream(batches, ["row", "place", "piece", "head"]):
            kind = top.type if top is not None else kind
            if row != now:
                if now is not None:
                    end()
                now, first, whole = row, top, Gathered(digest)
                scanner = Scanner(top.field("form")[0].as_py() == "plain")
            whole.add(piece)
            out.extend((now, seg, at, part, None) for seg, at, part in scanner.read(piece))
            held += len(piece)
            if held > 4_000_000:
                yield told_batch(out, kind)
                out, held = [], 0
        if now is not None:
            end()
        if out:
            yield told_batch(out, kind)

    def told_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        r, s, p, t, h = zip(*rows)
        tops = [x for x in h if x is not None]
        at = iter(range(len(tops)))
        index = pa.array([next(at) if x is not None else None for x in h], pa.int64())
        heads = pa.concat_arrays(tops).take(index) if tops else pa.nulls(len(rows), kind)
        return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(s, pa.int32()), pa.array(p, pa.int64()),
                                           pa.array(t, pa.string()), heads], ["row", "segment", "place", "piece", "head"])

    made = ["output_sha256", "restored_sha256"] if digest else ["output", "restored"]
    final = T.StructType([T.StructField("head", head), *(T.StructField(c, T.StringType()) for c in made)])

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, top, output, whole, held = None, None, None, None, 0
        for row, segment, piece, first in stream(batches, ["row", "segment", "piece", "head"]):
            if row != now:
                if now is not None:
                    done.append((top, output, whole.result()))
                    held += 0 if digest else 2 * len(output)
                    if len(done) >= 1_000 or held > 4_000_000:
                        yield final_batch(done)
                        done, held = [], 0
                now, top, output, whole = row, first, piece, Gathered(digest)      # the row of segment -1
            else:
                whole.add(piece)
        if now is not None:
            done.append((top, output, whole.result()))
        if done:
            yield final_batch(done)

    def final_batch(rows: list[tuple]) -> pa.RecordBatch:
        h, a, b = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(h), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                          ["head", *made])

    sorted_once = pieces.repartition("row").sortWithinPartitions("row", "place").mapInArrow(assemble, told)
    back = sorted_once.sortWithinPartitions("row", "segment", "place").mapInArrow(restore, final)
    return back.select("head.*", *made)
