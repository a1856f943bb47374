"""BPE encoding and decoding with forced-boundary splitting.

For a BPE vocabulary with word ends (``.json`` of the ``tokenizers`` library).
A text is normalised (NFC, white space, lower case) and split into words as the
file says. A merge joins two neighbouring symbols into a vocabulary token, so
two neighbouring bytes that occur side by side inside no token can never end up
in one token: between them is a certain cut. A word falls into fragments at its
certain cuts; every fragment is merged on its own, and the ids are concatenated.
Fragments and words are kept in bounded dictionaries of the worker process.

Decoding writes the tokens with one space between (the file names no decoder),
which is what the library does.

Defined results: a null text is encoded as an empty one (no ids); the strings of
added tokens inside a text become their ids, as the library's default does;
repeated rows are encoded row by row; extra columns stay, and a column named
like an output is replaced by it. Whole texts are encoded.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, byte_letters

WORD_END = "</w>"
# white space of the normaliser's \s: Unicode White_Space
SPACES = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
# str.split() also splits at these, which are no white space to the normaliser
SEPARATORS = re.compile("[\x1c-\x1f]")


class Encoded(dict):
    """Word, or stretch without white space -> (ids, tokens, number of tokens),
    bounded by the bytes it holds. A word standing alone is encoded like the same
    word in a stretch."""
    ENTRY = 240                 # of the objects of an entry, besides its letters

    def __init__(self, bpe: WordBpe):
        self.bpe, self.held = bpe, 0

    def __missing__(self, chunk: str) -> tuple[str, str, int]:
        got = self.bpe.encode_chunk(chunk)
        if len(chunk) < 100:
            self.held += self.ENTRY + len(chunk) + len(got[0]) + len(got[1])
            if self.held > self.bpe.cache_bytes:
                self.clear()
                self.held = 0
            self[chunk] = got
        return got


class WordBpe:
    def __init__(self, path: str, decoded: bool = True, cache_bytes: int = 96 << 20):
        """``decoded``: whether ``encode_text`` gives the decoded text (empty if not)."""
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids = spec["model"]["vocab"]
        self.tokens = {i: s for s, i in self.ids.items()}
        self.ranks = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[(a, b)] = k
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: s for s, i in self.added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = byte_letters()
        self.letter_table = {b: ord(c) for b, c in letters.items()}
        inside = set()
        for s in self.ids:
            if s not in self.added:
                s = s.removesuffix(WORD_END)
                inside.update(zip(s, s[1:]))
        self.inside = {a + b for a, b in inside}
        self.decoded, self.cache_bytes = decoded, cache_bytes
        self.id_text = {s: str(i) for s, i in self.ids.items()}
        self.words = Encoded(self)
        self.fragments: dict[tuple[str, bool], list[str]] = {}

    def merge(self, fragment: str, last: bool) -> list[str]:
        """The merge rules on one fragment; ``last`` if a word ends with it."""
        if last and fragment + WORD_END in self.ids and len(fragment) == 1:
            return [fragment + WORD_END]
        symbols = list(fragment)
        if last:
            symbols[-1] += WORD_END
        return self.merge_short(symbols) if len(symbols) <= 64 else self.merge_long(symbols)

    def merge_short(self, symbols: list[str]) -> list[str]:
        get, none = self.ranks.get, len(self.ranks)
        rank = [get(pair, none) for pair in zip(symbols, symbols[1:])]
        while rank:
            best = min(rank)
            if best == none:
                break
            at = rank.index(best)                  # the leftmost of the best
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del rank[at]
            if at:
                rank[at - 1] = get((symbols[at - 1], symbols[at]), none)
            if at < len(rank):
                rank[at] = get((symbols[at], symbols[at + 1]), none)
        return symbols

    def merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of (rank, place) over a linked list."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, a, b) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                if (r := self.ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if symbols[k] != a or j >= n or symbols[j] != b:
                continue
            symbols[k], symbols[j] = a + b, ""
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < n:
                    r = self.ranks.get((symbols[left], symbols[right]))
                    if r is not None:
                        heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [s for s in symbols if s]

    def encode_word(self, word: str) -> list[str]:
        """Tokens of one word: cut where no token has the two bytes, merge each
        fragment, concatenate."""
        letters = word.encode().decode("latin-1").translate(self.letter_table)
        inside = self.inside
        at = [k for k in range(1, len(letters)) if letters[k - 1:k + 1] not in inside]
        if not at:
            return self.merge(letters, True)       # the word is one fragment, kept as a word
        out, begin, n = [], 0, len(letters)
        for k in [*at, n]:
            if k > begin:
                key = (letters[begin:k], k == n)
                got = self.fragments.get(key)
                if got is None:
                    if len(self.fragments) >= self.cache_bytes // 2_000:
                        self.fragments.clear()
                    got = self.merge(*key)
                    if len(key[0]) < 100:
                        self.fragments[key] = got
                out += got
                begin = k
        return out

    def encode_chunk(self, chunk: str) -> tuple[str, str, int]:
        """(ids, tokens, number of tokens) of a stretch without white space."""
        pieces = [chunk] if chunk.isalpha() else self.pattern.findall(chunk)
        if len(pieces) == 1 and pieces[0] == chunk:
            tokens = self.encode_word(chunk)
            return " ".join([self.id_text[t] for t in tokens]), " ".join(tokens) if self.decoded else "", len(tokens)
        return self.joined([self.words[w] for w in pieces])

    def joined(self, got: list[tuple[str, str, int]]) -> tuple[str, str, int]:
        return " ".join([x[0] for x in got]), " ".join([x[1] for x in got]) if self.decoded else "", sum([x[2] for x in got])

    def encode_text(self, text: str) -> tuple[str, str, int]:
        """(ids, decoded text, number of tokens) of a whole text."""
        got: list[tuple[str, str, int]] = []
        for k, part in enumerate(self.split_added.split(text)):
            if k % 2:
                got.append((str(self.added[part]), part, 1))
                continue
            if not part.isascii():
                # lower case character by character: a final sigma has no form of its own
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            chunks = filter(None, SPACES.split(part)) if SEPARATORS.search(part) else part.split()
            got += map(self.words.__getitem__, chunks)
        return self.joined(got)

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


_LOADED: dict[tuple[str, bool], WordBpe] = {}


def loaded(path: str, decoded: bool = True) -> WordBpe:
    if (path, decoded) not in _LOADED:
        _LOADED[path, decoded] = WordBpe(path, decoded, (96 if decoded else 48) << 20)
    return _LOADED[path, decoded]


def encode(docs: DataFrame, tokenizer: str, text: str = "text", digest: bool = False, decoded: bool = True,
           verify: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and ``token_ids`` (array<int>) and
    ``decoded`` (string; left out, and never built, with ``decoded=False``), or with
    ``digest`` their SHA-256 as ``ids_sha256`` (of the decimal ids joined by spaces)
    and ``decoded_sha256`` (UTF-8). ``verify``: the ids of every text are decoded again, and a
    text that does not come back as its merged tokens fails, whatever columns are returned."""
    decoded = decoded or digest
    made = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["token_ids", *(["decoded"] if decoded else [])])]
    keep = [c for c in docs.columns if c not in made and (c != text or not digest)]
    kinds = [T.LongType(), *([T.StringType()] * 2 if digest else [T.ArrayType(T.IntegerType()), T.StringType()])][:len(made)]
    schema = T.StructType([*(docs.schema[c] for c in keep), *map(T.StructField, made, kinds)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256
        bpe = loaded(tokenizer, decoded or verify)
        for frame in frames:
            for part in batches_by_bytes(frame, "__text"):
                rows = []
                for t in part["__text"]:
                    ids, back, n = bpe.encode_text(t)
                    if verify and bpe.decode(map(int, ids.split())) != back:
                        raise ValueError(f"{n} ids do not decode to the tokens of their text")
                    rows.append((n, sha256(ids.encode()).hexdigest(), sha256(back.encode()).hexdigest()) if digest
                                else (n, np.fromstring(ids, np.int32, sep=" "), back)[:len(made)])
                out = part.drop(columns="__text")
                yield out.assign(**dict(zip(made, map(list, zip(*rows)))))
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInPandas(run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of an id array; null ids give null."""
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(tokenizer)
        for frame in frames:
            yield frame.assign(**{out: [None if x is None else bpe.decode(list(x)) for x in frame[ids]]})
    return df.select(*keep).mapInPandas(run, schema)
