"""Token counts by finite-state tokenizer compilation.

A byte-level BPE tokenizer (``.json`` of the ``tokenizers`` library) is compiled
into a cascade of two deterministic transducers.

1. The *splitter* reads character classes. Its 13 states know the run (letters,
   digits, other, white space, a possible contraction) and each transition is
   annotated with the cuts it emits: before the character read, before the one
   read last, or both (a white-space run and ``'re`` are decided one character
   late). It is a complete transducer, so a chunk of text is a map from each
   entry state to an exit state. The maps of all chunks are computed in lock
   step, composed by a parallel prefix scan, and a second lock-step pass from
   the entry states found emits the cuts.
2. The *merger* reads the bytes of a piece. Each transition is annotated with
   the change of the number of emitted tokens, so the sum of annotations over a
   document is its token count. A state holds, for every open vocabulary prefix
   that ends here, the last token before it and the count there; the last token
   after a byte is the only vocabulary suffix that the merge rules leave beside
   the token before it. States are determinised on demand and kept by the
   worker process, bounded by ``max_states`` (then the table starts anew).
   Every cut resets it, so a chunk's map is constant beyond its first cut:
   lanes begin at cuts and need no entry state. In a long piece without a cut
   lanes begin anywhere; their maps, kept for the few live entry states, are
   composed by the same prefix scan.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of the
added tokens inside a text count one token each, as the library's default does;
repeated rows are counted row by row; extra columns (also with clashing names)
are returned untouched unless named like an output, which the output replaces.
Whole texts are read; memory follows the Arrow batch (or one long text).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, byte_letters

# character classes of the splitter
LETTER, SHORT, CH_R, CH_V, CH_L, CH_E, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(12)
# states of the splitter
(START, IN_L, IN_N, IN_O, SP1, WS1, SPN, WSN, AP, AP_R, AP_V, AP_L, DONE) = range(13)
CUT_HERE, CUT_BEFORE = 1, 2
N_STATES, N_CLASSES = 13, 12


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cuts) by class and state, for the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|\\s+(?!\\S)|\\s+``."""
    letters = {LETTER, SHORT, CH_R, CH_V, CH_L, CH_E}

    def begin(c: int) -> int:                      # a new piece starts with c
        if c in letters:
            return IN_L
        return {NUMBER: IN_N, SPACE: SP1, WHITE: WS1, QUOTE: AP, OTHER: IN_O, END: START}[c]

    def joined(c: int) -> int:                     # c continues a piece that began with a space
        return IN_L if c in letters else IN_N if c == NUMBER else IN_O

    def step(q: int, c: int) -> tuple[int, int]:
        if c == END:
            late = CUT_BEFORE if q in (AP_R, AP_V, AP_L) else 0
            return START, CUT_HERE | late
        if q in (SP1, WS1, SPN, WSN):
            if c in (SPACE, WHITE):
                return (SPN if c == SPACE else WSN), 0
            late = CUT_BEFORE if q in (SPN, WSN) else 0
            return (joined(c), late) if q in (SP1, SPN) else (begin(c), late | CUT_HERE)
        if q == IN_L and c in letters or q == IN_N and c == NUMBER:
            return q, 0
        if q in (IN_O, AP) and c in (OTHER, QUOTE):
            return IN_O, 0
        if q == AP and c == SHORT:
            return DONE, 0
        if q == AP and c in (CH_R, CH_V, CH_L):
            return {CH_R: AP_R, CH_V: AP_V, CH_L: AP_L}[c], 0
        if (q, c) in ((AP_R, CH_E), (AP_V, CH_E), (AP_L, CH_L)):
            return DONE, 0
        if q in (AP_R, AP_V, AP_L):                # no contraction: the quote stood alone
            if c in letters:
                return IN_L, CUT_BEFORE
            return begin(c), CUT_BEFORE | CUT_HERE
        return begin(c), CUT_HERE
    nxt = np.zeros((N_CLASSES, N_STATES), np.uint8)
    cut = np.zeros((N_CLASSES, N_STATES), np.uint8)
    for c in range(N_CLASSES):
        for q in range(N_STATES):
            nxt[c, q], cut[c, q] = step(q, c)
    return nxt, cut


def char_classes() -> np.ndarray:
    """Class of every code point, from the Unicode properties of the pattern."""
    import regex
    table = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for m in regex.finditer(pattern, points):
            a, b = ord(points[m.start()]), ord(points[m.end() - 1])
            table[a:b + 1] = c
    table[0xD800:0xE000] = OTHER
    for chars, c in (("stmd", SHORT), ("r", CH_R), ("v", CH_V), ("l", CH_L), ("e", CH_E), (" ", SPACE), ("'", QUOTE)):
        for x in chars:
            table[ord(x)] = c
    return table


def chunk_maps(classes: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """(chunks, states) map of every chunk; ``classes`` is (length, chunks)."""
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (classes.shape[1], 1))
    flat = nxt.reshape(-1)
    for row in classes:
        maps = flat[row[:, None].astype(np.int16) * N_STATES + maps]
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Exclusive scan of the maps under composition, by doubling: row i is the
    map of all chunks before i."""
    n = len(maps)
    scan = maps.copy()
    step = 1
    while step < n:
        later = scan.copy()
        # first scan[i - step], then scan[i]
        later[step:] = np.take_along_axis(scan[step:], scan[:-step].astype(np.int64), axis=1)
        scan, step = later, step * 2
    out = np.empty_like(scan)
    out[0] = np.arange(maps.shape[1])
    out[1:] = scan[:-1]
    return out


def cuts(classes: np.ndarray, nxt: np.ndarray, cut: np.ndarray, chunk: int = 256) -> np.ndarray:
    """True where a piece begins, for a class string that ends with END."""
    n = len(classes)
    lanes = -(-n // chunk)
    padded = np.full(lanes * chunk, END, np.uint8)
    padded[:n] = classes
    grid = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
    state = prefix_scan(chunk_maps(grid, nxt))[:, START]
    emitted = np.empty((chunk, lanes), np.uint8)
    to, flags = nxt.reshape(-1), cut.reshape(-1)
    for j, row in enumerate(grid):
        key = row.astype(np.int16) * N_STATES + state
        emitted[j] = flags[key]
        state = to[key]
    e = np.ascontiguousarray(emitted.T).reshape(-1)[:n]
    out = (e & CUT_HERE).astype(bool)
    out[:-1] |= (e[1:] & CUT_BEFORE).astype(bool)
    return out


class Merger:
    """The merge rules as a transducer over bytes, determinised on demand."""

    def __init__(self, vocab: dict[bytes, int], ranks: dict[tuple[int, int], tuple[int, int]],
                 max_states: int = 200_000):
        self.vocab, self.ranks, self.max_states = vocab, ranks, max_states
        self.pairs: dict[tuple[int, int], bool] = {}
        self.text = {i: s for s, i in vocab.items()}
        self.byte_id = [vocab.get(bytes([b]), -1) for b in range(256)]
        # the trie of the tokens that the rules can make: node -> byte -> node
        self.trie: list[dict[int, int]] = [{}]
        self.token = [-1]
        for s, i in vocab.items():
            if self.merge(s) != [i]:
                continue
            node = 0
            for b in s:
                child = self.trie[node].get(b)
                if child is None:
                    child = self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = child
            self.token[node] = i
        self.reset()

    def reset(self) -> None:
        # a state: ((trie node, last token before it, count there - count here), ...)
        start = ((0, -1, 0),)
        self.states, self.index = [start], {start: 0}
        # by byte and state; 0: not compiled yet, else the next state + 1
        self.next = np.zeros((256, self.max_states), np.int32)
        self.delta = np.zeros((256, self.max_states), np.int16)

    def merge(self, s: bytes) -> list[int]:
        """The merge rules applied to a short byte string."""
        ids = [self.byte_id[b] for b in s]
        while len(ids) > 1:
            best, at = None, -1
            for k in range(len(ids) - 1):
                r = self.ranks.get((ids[k], ids[k + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, k
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def beside(self, a: int, b: int) -> bool:
        """True if the rules leave token a followed by token b as they are."""
        if a < 0:
            return True
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[(a, b)] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return known

    def follow(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """Next state and the change of the token count."""
        opened = []
        found = None
        for node, last, count in state:
            child = self.trie[node].get(byte)
            if child is None:
                continue
            opened.append((child, last, count))
            t = self.token[child]
            if found is None and t >= 0 and self.beside(last, t):
                found = (t, count + 1)
        token, change = found                       # single bytes are tokens: there is always one
        return (*((n, p, c - change) for n, p, c in opened if self.trie[n]), (0, token, 0)), change

    def compile(self, state: int, byte: int) -> None:
        to, change = self.follow(self.states[state], byte)
        at = self.index.get(to)
        if at is None:
            at = self.index[to] = len(self.states)
            self.states.append(to)
            if at == self.next.shape[1]:           # full in the middle of a run: grow until the next reset
                self.next = np.concatenate([self.next, np.zeros_like(self.next)], axis=1)
                self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)], axis=1)
        self.next[byte, state] = at + 1
        self.delta[byte, state] = change

    def walk(self, data: np.ndarray, begins: np.ndarray, lanes: np.ndarray, length: np.ndarray, state: np.ndarray,
             out: np.ndarray | None = None) -> np.ndarray:
        """Exit states of lanes (begin, length) entered in ``state``, in lock
        step; the annotations of their bytes go to ``out``."""
        order = np.argsort(-length, kind="stable")
        lanes, length, state = lanes[order], length[order], state[order].astype(np.int64)
        active = len(lanes)
        for j in range(int(length[0]) if len(length) else 0):
            if length[active - 1] <= j:
                # lanes are sorted by length: the finished ones are the last
                active = int(np.searchsorted(-length, -j, side="left"))
            pos = lanes[:active] + j
            now = state[:active]
            now[begins[pos]] = 0
            byte = data[pos]
            to = self.next[byte, now]
            if not to.all():
                for k in np.unique(now[to == 0] * 256 + byte[to == 0]):
                    self.compile(int(k >> 8), int(k & 255))
                to = self.next[byte, now]
            if out is not None:
                out[pos] = self.delta[byte, now]
            state[:active] = to.astype(np.int64) - 1
        exits = np.empty_like(state)
        exits[order] = state
        return exits

    def entries(self, data: np.ndarray, begins: np.ndarray, lanes: np.ndarray, length: np.ndarray,
                width: int = 32) -> np.ndarray:
        """Entry state of every lane; a lane that begins at a cut is entered in
        state 0. The map of a lane before one without a cut is kept for its live
        entry states alone: the exits of the lane before it, ``width`` of them
        at most beside those found to be needed. Entries follow from the maps by
        the prefix scan; while some are open, the states they wait for go live,
        so every round settles at least the next lane of each run."""
        state = np.zeros(len(lanes), np.int64)
        inner = np.flatnonzero(~begins[lanes])
        if not len(inner):
            return state
        near = np.union1d(inner - 1, inner)
        closed = begins[lanes[near]]                # a run of lanes begins here
        live: list[dict[int, int]] = [{0: 0} for _ in near]
        exits: list[list[int]] = [[] for _ in near]
        asked = [(i, 0) for i in range(len(near))]
        while True:
            at = near[[i for i, _ in asked]]
            found = self.walk(data, begins, lanes[at], length[at], np.array([s for _, s in asked], np.int64))
            for (i, _), e in zip(asked, found.tolist()):
                exits[i].append(e)
            # local numbers of live states; the last column stands for a state not live
            unknown = max(map(len, live))
            maps = np.full((len(near), unknown + 1), unknown, np.int64)
            for i in range(len(near) - 1):
                if closed[i + 1]:
                    maps[i] = 0
                else:
                    to = live[i + 1]
                    maps[i, :len(exits[i])] = [to.get(e, unknown) for e in exits[i]]
            entry = prefix_scan(maps)[:, 0]
            if (entry < unknown).all():
                state[near] = [exits_in[k] for exits_in, k in zip(map(list, live), entry.tolist())]
                return state
            asked = []
            for i in range(1, len(near)):
                if closed[i]:
                    continue
                needed = entry[i] == unknown and entry[i - 1] < unknown
                wanted = [exits[i - 1][entry[i - 1]]] if needed else exits[i - 1]
                for e in wanted:
                    if e not in live[i] and (needed or len(live[i]) < width):
                        live[i][e] = len(live[i])
                        asked.append((i, e))

    def run(self, data: np.ndarray, begins: np.ndarray, lane: int = 512) -> np.ndarray:
        """Annotation of every byte of ``data``; ``begins`` marks cuts (the
        first byte is one). Lanes of about ``lane`` bytes begin at cuts, or
        within a piece where none is near."""
        if len(self.states) > 0.9 * self.max_states:
            self.reset()
        n = len(data)
        out = np.zeros(n, np.int16)
        at = np.append(np.flatnonzero(begins), n)
        wanted = np.arange(0, n, lane)
        cut = at[np.searchsorted(at, wanted)]
        lanes = np.unique(np.where(cut - wanted < lane, cut, wanted))
        lanes = lanes[lanes < n]
        length = np.diff(np.append(lanes, n))
        self.walk(data, begins, lanes, length, self.entries(data, begins, lanes, length), out)
        return out


_COMPILED: dict[str, tuple] = {}


def compiled(path: str) -> tuple:
    """(classes, next, cuts, merger, added strings) of a tokenizer file, kept by the process."""
    if path not in _COMPILED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        ids = spec["model"]["vocab"]
        added = {a["content"] for a in spec["added_tokens"]}
        vocab = {bytes(back[c] for c in s): i for s, i in ids.items() if s not in added}
        ranks = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[(ids[a], ids[b])] = (k, ids[a + b])
        _COMPILED[path] = (char_classes(), *splitter(), Merger(vocab, ranks), sorted(added))
    return _COMPILED[path]


def count_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of every text."""
    table, nxt, cut, merger, added = compiled(path)
    extra = np.zeros(len(texts), np.int64)
    n_bytes = np.zeros(len(texts), np.int64)
    segments, owner = [], []
    for k, text in enumerate(texts):
        parts = [text]
        for a in added:
            parts = [y for x in parts for y in x.split(a)]
        if len(parts) > 1:
            extra[k] = len(parts) - 1
            n_bytes[k] += len(text.encode()) - sum(len(x.encode()) for x in parts)
        segments += parts
        owner += [k] * len(parts)
    # one string; a NUL after each segment stands for its end
    points = np.frombuffer(("\0".join(segments) + "\0").encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    ends = np.cumsum(size + 1) - 1
    classes = table[points]
    classes[ends] = END
    begins = cuts(classes, nxt, cut)
    is_char = np.ones(len(points), bool)
    is_char[ends] = False
    width = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)) * is_char
    offset = np.concatenate([[0], np.cumsum(width)])
    data = np.frombuffer("".join(segments).encode(), np.uint8)
    start = np.zeros(len(data) + 1, bool)
    start[offset[:-1][begins & is_char]] = True
    total = np.concatenate([[0], np.cumsum(merger.run(data, start[:-1]), dtype=np.int64)])
    hi, lo = offset[ends], offset[ends - size]
    owner = np.asarray(owner, np.int64)
    tokens = extra + np.bincount(owner, total[hi] - total[lo], len(texts)).astype(np.int64)
    n_bytes += np.bincount(owner, hi - lo, len(texts)).astype(np.int64)
    return n_bytes, tokens


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` (long) of the column ``text``."""
    keep = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in batches_by_bytes(frame, "__text"):
                n_bytes, tokens = count_texts(part["__text"].tolist(), tokenizer)
                yield part.drop(columns="__text").assign(n_bytes=n_bytes, n_tokens=tokens)
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInPandas(count, schema)
