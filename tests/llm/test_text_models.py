"""Tokenizers, language model, toxicity chain, HTML text: exact or held-out checks."""

from __future__ import annotations

import random
import time
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqwise.llm import bpe, fst, html, lm, toxicity
from seqwise.llm.queries import tokenizer

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

CHARS = "abrstvldmeABÉéß中文ä123٣½ \t\n\r   　\u0085\x1c'’.,!#$%<|>😀éΣİǅ́"


def texts():
    rng = random.Random(1)
    out = [None, "", " ", "  ", "   x", "don't  we'll I've they're he's x's'll'r 'v 'l 're're", "<|endoftext|>",
           "a<|endoftext|> b <|endoftext|>", "a<|startoftext|> B", "  <|endoftext|>  x\n\n y", " 'sa 's\n's\n'rex\n'r\n'v",
           "a" * 3000, "-" * 1000, " " * 1000, "x y" * 500, "abc" * 900]
    out += ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    return out + out[:5]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "extra", 7) for i, t in enumerate(rows)],
                                 "doc_id long, text string, lang string, n_tokens int")


def test_token_counts_equal_the_library(spark):
    path, rows = tokenizer("byte_bpe_50k.json"), texts()
    lib = tokenizers.Tokenizer.from_file(path)
    want = [len(e.ids) for e in lib.encode_batch([t or "" for t in rows], add_special_tokens=False)]
    got = {r.doc_id: r for r in fst.count_tokens(frame(spark, rows), path).collect()}
    assert [got[i].n_tokens for i in range(len(rows))] == want
    assert [got[i].n_bytes for i in range(len(rows))] == [len((t or "").encode()) for t in rows]
    assert got[0].lang == "extra" and fst.count_tokens(frame(spark, rows).limit(0), path).count() == 0


def test_chunk_maps_compose():
    """The scan over chunks of any length finds the cuts of one long run."""
    rng = np.random.default_rng(4)
    nxt, cut = fst.splitter()
    for n in (1, 5, 64, 1000):
        classes = rng.integers(0, fst.END, n).astype(np.uint8)
        classes[-1] = fst.END
        whole = fst.cuts(classes, nxt, cut, chunk=10 ** 6)
        for chunk in (1, 3, 17, 256):
            assert (fst.cuts(classes, nxt, cut, chunk) == whole).all()


def test_pieces_without_a_cut_are_read_by_chunks():
    """Long pieces equal the library; the annotations do not depend on the lanes, however few states may be live."""
    path, rng = tokenizer("byte_bpe_50k.json"), random.Random(8)
    lib = tokenizers.Tokenizer.from_file(path)
    rows = ["a" * 200_000, "ab" * 60_000, "the" * 9_001, "=" * 30_001, "\u6f22\u00e9" * 9_000, " " * 20_000 + "b",
            "".join(rng.choice("acgt") for _ in range(60_000)), "one two " * 300 + "x" * 9_000 + " more " + "1234567890" * 800]
    began = time.time()
    got = fst.count_texts(rows, path)[1]
    assert time.time() - began < 20                # a byte a step took 19 s a million bytes
    assert got.tolist() == [len(e.ids) for e in lib.encode_batch(rows, add_special_tokens=False)]
    merger = fst.compiled(path)[3]
    data = np.frombuffer("".join(r[:3_000] for r in rows).encode(), np.uint8)
    begins = np.zeros(len(data), bool)
    begins[[0, 700, 701, 9_000]] = True
    want = merger.run(data, begins, lane=10 ** 6)
    for lane in (7, 64, 512):
        assert (merger.run(data, begins, lane) == want).all()
    lanes = np.arange(0, len(data), 64)
    begins[:] = lanes[0] == np.arange(len(data))
    length = np.diff(np.append(lanes, len(data)))
    assert (merger.entries(data, begins, lanes, length, width=1) == merger.entries(data, begins, lanes, length)).all()


def test_transducer_restarts_when_full():
    path = tokenizer("byte_bpe_50k.json")
    _, _, _, merger, _ = fst.compiled(path)
    small = fst.Merger(merger.vocab, merger.ranks, max_states=200)
    data = np.frombuffer(("threinble anwh " * 20 + "somewhat different words" * 5).encode(), np.uint8)
    begins = np.zeros(len(data), bool)
    begins[0] = True
    begins[1:] = data[1:] == 32
    want = merger.run(data, begins).sum()
    assert [small.run(data, begins).sum() for _ in range(3)] == [want] * 3


def test_bpe_equals_the_library(spark):
    path, rows = tokenizer("word_bpe_49k.json"), texts()
    lib = tokenizers.Tokenizer.from_file(path)
    want = [e.ids for e in lib.encode_batch([t or "" for t in rows], add_special_tokens=False)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in bpe.encode(docs, path).collect()}
    assert [got[i].token_ids for i in range(len(rows))] == want
    decoded = [lib.decode(ids, skip_special_tokens=False) for ids in want]
    assert [got[i].decoded for i in range(len(rows))] == decoded
    again = {r.doc_id: r.again for r in bpe.decode(bpe.encode(docs, path), path, out="again").collect()}
    assert [again[i] for i in range(len(rows))] == decoded
    digest = {r.doc_id: r for r in bpe.encode(docs.select("doc_id", "text"), path, digest=True).collect()}
    for i, ids in enumerate(want):
        assert digest[i].ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digest[i].decoded_sha256 == sha256(decoded[i].encode()).hexdigest()
        assert digest[i].n_tokens == len(ids)
    assert bpe.encode(docs.limit(0), path).count() == 0


def test_the_encoding_stage_decodes_what_it_encodes(spark, monkeypatch):
    """Ids that do not give the tokens of their text back stop the stage."""
    import corpus_pipeline
    docs = frame(spark, ["some words, and more", None, ""])
    out = corpus_pipeline.encoding_stage(spark, docs, "")
    assert out.columns == ["doc_id", "n_tokens", "token_ids"] and out.count() == 3
    plain = bpe.loaded

    def broken(path, decoded=True):
        coder = plain(path, decoded)
        coder.decode = lambda ids: "other"
        return coder
    monkeypatch.setattr(bpe, "loaded", broken)
    with pytest.raises(Exception, match="do not decode"):
        bpe.encode(docs, tokenizer("word_bpe_49k.json"), decoded=False, verify=True).collect()


def test_forced_cuts_never_part_a_token():
    coder = bpe.loaded(tokenizer("word_bpe_49k.json"))
    for token in list(coder.ids)[::7]:
        body = token.removesuffix(bpe.WORD_END)
        if token not in coder.added:
            assert all(body[k:k + 2] in coder.inside for k in range(len(body) - 1))
    # the two ways of merging agree
    rng = random.Random(9)
    for _ in range(300):
        s = [rng.choice("abcdeinrst") for _ in range(rng.randint(2, 40))]
        s[-1] += bpe.WORD_END
        assert coder.merge_short(list(s)) == coder.merge_long(list(s))


def language(rng, n):
    """Sentences with an order: each word determines what may follow."""
    after = {"the": ["cat", "dog"], "cat": ["sees", "hears"], "dog": ["sees", "hears"], "sees": ["the"], "hears": ["the"]}
    out, w = [], "the"
    for _ in range(n):
        out.append(w)
        w = rng.choice(after[w])
    return out


def test_lm_prefers_ordered_text(spark):
    rng = random.Random(6)
    rows = [" ".join(language(rng, 300)) for _ in range(400)]
    words, network = lm.train(frame(spark, rows))
    ordered = [" ".join(language(rng, 60)) for _ in range(20)]
    mixed = [" ".join(rng.sample(x.split(), 60)) for x in ordered]
    got = {r.doc_id: r for r in lm.score(frame(spark, ordered + mixed + [None, " "]), words, network).collect()}
    good, bad = [got[i].mean_log_prob for i in range(20)], [got[i].mean_log_prob for i in range(20, 40)]
    assert min(good) > max(bad)
    assert np.mean(good) > -1.0                           # unigrams give about -1.5
    for i in (40, 41):
        assert got[i].n_words == 0 and got[i].log_prob == 0 and got[i].mean_log_prob is None


def test_lm_scores_are_masked_sums():
    rng = np.random.default_rng(1)
    flat = lm.Network.fresh(rng.normal(0, 1, lm.SYMBOLS))
    net, symbols = lm.Network(flat), lm.Symbols(["a", "b"])
    s, sizes = lm.sequence(["a b", "", "Zz 12 a"], symbols)
    got = net.log_probabilities(s, np.flatnonzero(s))
    assert sizes.tolist() == [2, 0, 3] and len(got) == 5
    flat64 = flat.astype(np.float64)
    e = len(lm.OFFSETS) * lm.SYMBOLS * lm.WIDTH
    E, W = flat64[:e].reshape(len(lm.OFFSETS), lm.SYMBOLS, lm.WIDTH), flat64[e:e + lm.WIDTH * lm.SYMBOLS].reshape(lm.WIDTH, -1)
    for k, at in enumerate(np.flatnonzero(s)):
        z = np.tanh(sum(E[j, s[at + o]] for j, o in enumerate(lm.OFFSETS))) @ W + flat64[e + lm.WIDTH * lm.SYMBOLS:]
        assert abs(got[k] - (z[s[at]] - np.log(np.exp(z).sum()))) < 1e-4
    # beyond the safe bound the rows are shifted: still finite
    big = lm.Network(np.concatenate([flat[:e], flat[e:] * 500]))
    assert np.isfinite(big.log_probabilities(s, np.flatnonzero(s))).all()


def test_lm_gradient_step_lowers_the_loss():
    flat = lm.Network.fresh(np.zeros(lm.SYMBOLS))
    net = lm.Network(flat.copy())
    s, _ = lm.sequence([" ".join(language(random.Random(0), 2000))], lm.Symbols(["the", "cat", "dog", "sees", "hears"]))
    at = np.flatnonzero(s)
    before = net.log_probabilities(s, at).mean()
    for _ in range(30):
        net.train(s, at)
    assert net.log_probabilities(s, at).mean() > before + 1


@pytest.mark.parametrize("head", [150, 200_000])
def test_lm_scores_the_words_within_their_shape(spark, head):
    """Random strings of the same shape in place of the rarer words score lower; the sum is exact."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(4, 7)))
    kinds = sorted({word() for _ in range(400)})
    texts = [" ".join(rng.choices(kinds, [1 / (k + 1) for k in range(len(kinds))], k=60)) for _ in range(300)]
    docs = frame(spark, texts)
    counts = lm.word_counts(docs)
    words, network = lm.train(docs, counts=counts)
    assert len(words) == lm.WORDS
    real = texts[:20]
    fake = [" ".join(w if w in set(words) else "".join(rng.choice(letters) for _ in w) for w in t.split()) for t in real]
    got = [r.log_prob for r in sorted(lm.score(frame(spark, real + fake), words, network, keep=["doc_id"], counts=counts,
                                               head=head).collect(), key=lambda r: r.doc_id)]
    n = {}
    for w in " ".join(texts).split():
        n[w] = n.get(w, 0) + 1
    rare = {w: c for w, c in n.items() if w not in words}
    net = lm.Network(network)
    for t, value in zip(real + fake, got):
        s, _ = lm.sequence([t], lm.Symbols(words))
        want = float(net.log_probabilities(s, np.flatnonzero(s)).sum())
        for w in t.split():
            same = [c for x, c in rare.items() if lm.shape(x) == lm.shape(w)]
            N, kinds_of = sum(same), len(same)
            if w in rare:
                want += np.log(rare[w] / (N + kinds_of))
            elif w not in words:
                want += np.log(kinds_of / (N + kinds_of)) - len(w) * np.log(2 * 0x110000)
        assert abs(value - want) < 1e-2
    assert all(a > b for a, b, x, y in zip(got[:20], got[20:], real, fake) if x != y) and real != fake


def test_lm_words_are_those_of_split():
    rng = random.Random(4)
    for _ in range(300):
        texts = ["".join(rng.choice(["a", "b ", " ", "\n", "　", "é", "\x1c", "cc"]) for _ in range(rng.randint(0, 8)))
                 for _ in range(rng.randint(0, 5))]
        kinds, ids, sizes = lm.words_of(texts)
        assert [kinds[i] for i in ids.tolist()] == [w for t in texts for w in t.split()]
        assert sizes.tolist() == [len(t.split()) for t in texts]


def test_lm_shapes_of_many_words_at_once():
    rng = random.Random(8)
    odd = ["", "É", "straße", "ÀB", "ñ.", "日本", "٣", "ǅ", "éa8", "a\u0301", "#", "A.", "aB", "x?", "abcdefg", "abcdefgh", "ABCDEFG8"]
    odd += ["".join(rng.choice("aZ9.!#-é٣Ωλ") for _ in range(rng.randint(1, 10))) for _ in range(2000)]
    kinds = pa.array(dict.fromkeys(odd), pa.string())
    listed = ["Z", "aB", "straße"]
    for words, some in ((listed, kinds), (listed, kinds[7:60]), ([], kinds[:0]), ([], kinds[:1])):
        symbols = lm.Symbols(words, bound=50)
        want = [1 + words.index(w) if w in words else 1 + lm.WORDS + lm.shape(w) if w else 0 for w in some.to_pylist()]
        assert symbols.of(some).tolist() == want and len(symbols) <= 50


def test_lm_words_are_not_looked_at_one_by_one(spark, monkeypatch):
    """Counts of all words in bounded memory, and ASCII words classed without a call for each of them."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aé", "b", f"w{rng.randint(0, 400)}", "", " "]) for _ in range(50)) for _ in range(200)] + [None, "", " "]
    want = {}
    for w in (w for t in texts if t for w in t.split()):
        want[w] = want.get(w, 0) + 1
    docs = frame(spark, texts)
    for flush in (1, 30, 300_000):
        assert {r.word: r.n for r in lm.word_counts(docs, flush=flush).collect()} == want
    called = []
    monkeypatch.setattr(lm, "shape", lambda w: called.append(w) or 0)
    lm.sequence([t for t in texts if t], lm.Symbols(["b"]))
    assert called == ["aé"]


def test_lm_frequent_words_by_search(spark):
    rng = random.Random(5)
    n = {f"w{k}": int(rng.paretovariate(0.5)) % 5000 + 1 for k in range(300)}
    counts = spark.createDataFrame(list(n.items()), "word string, n long").cache()
    for most in (0, 1, 40, 299, 300, 1000):
        least = min([x for x in {*n.values(), max(n.values()) + 1} if sum(v >= x for v in n.values()) <= most])
        got, limit = lm.frequent(counts, most, fan=8)
        assert got == {w: v for w, v in n.items() if v >= least}
        assert all((v >= limit) == (v >= least) for v in n.values())
    assert lm.frequent(counts.limit(0), 10) == ({}, 1)


def test_lm_networks_are_averaged_by_words(spark):
    rows = [(1.0, [0.0, 4.0]), (3.0, [4.0, 0.0]), (4.0, [1.0, 1.0])]
    got = lm.averaged(spark.createDataFrame(rows, lm.NETWORK).repartition(3), np.zeros(2))
    assert np.allclose(got, [2.0, 1.0])
    before = np.array([5.0, 6.0])
    assert lm.averaged(spark.createDataFrame([], lm.NETWORK), before) is before


def test_lm_empty(spark):
    words, network = lm.train(frame(spark, [None]))
    assert words == [] and lm.score(frame(spark, []), words, network).count() == 0


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "Stupid", "vilexa", "vilezo", "moron"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_held_out(spark):
    rows = toxic_corpus(3000, 8)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 2000] + [(0, None), (None, 1)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, labels, max_rows=1500)
    assert chain.names == ["insult", "demeaning", "toxic"] and [len(m[1]) for m in chain.models] == [0, 1, 2]
    got = {r.doc_id: r.is_toxic for r in toxicity.score(docs, chain).collect()}
    held = [(y, got[i]) for i, _, y in rows if i >= 2000]
    assert sum(y == p for y, p in held) >= 0.99 * len(held)
    assert sum(p for y, p in held if y) >= 0.98 * sum(y for y, _ in held)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, "idiot"), (None, "x")], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(2, 1)], [(None, 1)]):
        marks = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
        assert len(rows) == 4 and not any(r.is_toxic for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.Chain()).count() == 0


def test_out_of_fold_probabilities_and_threshold():
    y = np.array([0, 0, 1, 0, 1, 1.0])
    t = toxicity.best_threshold(np.array([.1, .2, .3, .4, .8, .9]), y)
    assert .4 < t < .8
    rng = np.random.default_rng(3)
    rows = [sorted(set(rng.integers(0, 30, 5).tolist())) for _ in range(400)]
    label = np.array([float(3 in r) for r in rows])
    w, v, b = toxicity.logistic(rows, np.zeros((400, 0)), label, 30)
    assert w.argmax() == 3 and len(v) == 0 and b < 0


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"),
    ("<p>one<p>two <b>bold</b>\n text<br>next", "one\n\ntwo bold text\nnext"),
    ("<ul><li>a<li>b<ol><li>x<li>y</ol><li>c</ul>end", "- a\n- b\n  1. x\n  2. y\n- c\n\nend"),
    ("<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3</td><tr><td>x<td>1234</table>",
     "Cap\nName       Qty\napple pie  3\nx          1234"),
    ("<table><tr><td>a<table><tr><td>x<td>y</table>b<td>c</table>", "a     c\nx  y\nb"),
    ("<pre>a\n  b</pre>", "a\n  b"),
    ("<dl><dt>T<dd>D</dl>end", "T\n  D\n\nend"),
    ("<head><title>x</title></head><div hidden>no</div><div style='display: none'>no</div>a<script>'</p>'</script>b", "ab"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("a</b></table></p>b<!-- c --> d <b hidden>e</b>f", "ab d f"),
    ("a < b & c &lt; <p", "a < b & c < <p"),
    ("<h1>T</h1><p>x</p><hr><img alt='pic'><input type=hidden value=q>", "T\n\nx\n\n---\n\npic"),
    ("<script>unfinished <b>", ""), ("<select><option>x</select>y", "y"), ("<td>loose</td>", "loose"),
    ("<div>" * 5000 + "x" + "</div>" * 5000, "x"),
])
def test_html_layout(source, want):
    assert html.render(source, options=False) == want


@pytest.mark.parametrize("source, want", [
    ("<p title=it's>Hello visible</p><p>Text that's more</p>", "Hello visible\n\nText that's more"),
    ("""<p class="a" ">Hello</p>""", "Hello"), ("""<p class="a"" id=x>Hello</p><p>say "hi"</p>""", 'Hello\n\nsay "hi"'),
    ("<p 'x>a</p><p>it's</p>", "a\n\nit's"), ("""<p title="a > b" lang='c>d'>x</p>""", "x"),
    ("<img alt = 'a > b'><img alt=c'd><img =\">e", "a > bc'de"), ("<a href=/x/y?q=\"z>link</a> \"end", 'link "end'),
    ("""<p title="open>a</p><p>b</p>""", "a\n\nb"), ("<img alt=x/>y", "x/y"), ("<p title=\"a\"hidden>no</p>yes", "yes"),
])
def test_html_quotes_inside_tags(source, want):
    assert html.render(source) == want


@pytest.mark.parametrize("source, want", [
    ("If <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1 tex</annotation></semantics></math>, so",
     "If x=1, so"),
    ("<p>a<svg><title>t</title><defs><text>no</text></defs><path d='M0'/> <text/>z<text x=1>Label <tspan>two</tspan></text></svg>b</p>",
     "a Label two b"),
    ("x<svg/>y", "xy"), ("a<textarea name=q>\none &amp;\n  <b>two</textarea>b", "a\none &\n  <b>two\nb"),
    ("a<xmp><b>&amp;</xmp>b", "a\n<b>&amp;\nb"), ("<textarea>open", "open"), ("<div hidden><textarea>no</textarea></div>b", "b"),
    ("Pick <select><option>x<option selected>y</select>end", "Pick\nx\ny\nend"),
    ("a<video>no</video><iframe>no</iframe><datalist><option>no</datalist><canvas>no</canvas>b", "ab"),
])
def test_html_shows_formulas_drawings_and_controls(spark, source, want):
    assert html.render(source, options=True) == want


@pytest.mark.parametrize("source, want", [
    ("<table><tr><th colspan=2>Long heading here<th>C<tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>",
     "Long heading here  C\na  b               c\n   d               e"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>漢字<td>x<tr><td>ab<td>y<tr><td>abcd<td>z</table>", "漢字  x\nab    y\nabcd  z"),
    ("<table><tr><td colspan=1000>a<td>b<tr><td>c</table>", "a  b\nc"),
    ("<table><tr><td colspan=x rowspan=-2>a<td>b<tr><td colspan=0>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td rowspan=2>a<td>b<td rowspan=2>c<tr><td>d</table>", "a  b  c\n   d"),
])
def test_html_spans(source, want):
    assert html.render(source) == want


@pytest.mark.parametrize("source, want", [
    ("<style>.no{display:none}</style><p class='a no'>x</p><p class=a>y", "y"),
    ("<style>p#q, i.a.b { visibility : hidden }</style><p id=q>x</p><p id=r>y <i class=a>z</i><i class='b a'>no</i>", "y z"),
    ("<style>/* .a{display:none} */ @media print {.a{display:none} .b{display:none}} @import url(x); .c{display:none}</style>"
     "<p class=a>a<p class=b>b<p class=c>c", "a\n\nb"),
    ("<style media=print>p{display:none}</style><p>x", "x"),
    ("<style>.no{display:none}</style><b class=no style='display:inline'>x</b><style>.no{display:block}</style><b class=no>y", "xy"),
    ("<head><style>aside{display:none}</style></head><aside>no<b>no</b></aside>yes", "yes"),
    ("<template><style>p{display:none}</style></template><p>x", "x"), ("<style>p > b, p:hover{display:none}</style><p><b>x", "x"),
    ("<style>p{display:none", ""), ("<style>}{p{display:none}}</style><p>x", "x"),
])
def test_html_style_sheets(source, want):
    assert html.render(source) == want


@pytest.mark.parametrize("tag", ["div", "p", "li", "td", "blockquote", "span", "tr"])
def test_html_depth_costs_no_search(tag):
    began = time.process_time()
    assert html.render(f"<{tag}>" * 50_000 + "x" + f"</{tag}>" * 50_000).strip("- ") == "x"
    assert html.render("<div>" * 20_000 + "<li>x" * 20_000).count("x") == 20_000
    assert time.process_time() - began < 20               # a search through the stack takes minutes


def test_html_frame_shows_options(spark):
    pages = spark.createDataFrame([(1, "<select><option>x</select>y")], "page_id long, html string")
    assert html.extract(pages, keep=["page_id"]).first().text == "x\ny"


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, "<p>a", "u"), (2, None, "v"), (2, None, "v")], "page_id long, html string, text string")
    got = sorted(map(tuple, html.extract(pages, keep=["page_id"]).collect()))
    assert got == [(1, "a"), (2, ""), (2, "")]
    assert html.extract(pages).columns == ["page_id", "html", "text"] and html.extract(pages.limit(0)).count() == 0


def test_html_random_pages_do_not_fail():
    rng = random.Random(12)
    tags = ["p", "div", "table", "tr", "td", "th", "ul", "ol", "li", "b", "pre", "details", "summary", "dl", "dt", "dd", "select"]
    for _ in range(300):
        source = "".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "word ", "\n", "<br>", "&lt;", "< "])
                         for _ in range(rng.randint(0, 80)))
        visible = html.render(source)
        if "<details" not in source and "<select" not in source:
            # nothing visible is lost
            assert visible.count("word") == source.count("word")


def test_counts_follow_every_row(spark):
    """Whole texts are read: a long text counts like its parts."""
    path = tokenizer("byte_bpe_50k.json")
    part = "the cat sees the dog\n"
    got = fst.count_tokens(frame(spark, [part, part * 50_000]), path).orderBy("doc_id").select(F.col("n_tokens")).collect()
    lib = tokenizers.Tokenizer.from_file(path)
    assert got[1][0] == len(lib.encode(part * 50_000, add_special_tokens=False).ids) and got[0][0] > 0
