"""BPE codec, page text and the pipeline."""

import hashlib
import html as htmllib
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martpulse.llm import bpe, htmltext, queries
from martpulse.llm.common import blocks

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BPE_VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    with open(queries.BPE_VOCABULARY, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def encoded(codec, texts):
    out = []
    for _, _, data, offsets in blocks(pa.array(texts, pa.string())):
        ids, per_row = codec.encode_block(data, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(per_row)[:-1])]
    return out


def test_pattern_is_the_public_one():
    assert bpe.PRE_TOKEN == public_tokenizers.PATTERN


def test_bpe_equals_the_library(codec, library):
    rng = random.Random(1)
    parts = [*"aab  \n\t'stre0190é.,!|ñ中　\xa0\x1c\x85", "<|endoftext|>", " the", "ing", "'ll", "\r\n", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    texts += ["a " + chr(c) + "b 1" + chr(c) + "  " + chr(c) + " x" + chr(c) + " y" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["a" * 20_000, "ab" * 5000, " " * 5000, "!?" * 3000, "x " * 3000, None, ""]
    got = encoded(codec, texts)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want
    back = codec.decode_block(np.array([i for g in got for i in g]), np.r_[0, np.cumsum([len(g) for g in got])])
    assert back == [t or "" for t in texts]
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_bpe_tells_long_words_apart(codec, library):
    # sums of byte codes times powers of one number are equal for such a word and its complement
    texts = [w for n in (1024, 2048, 4096) for w in (thue_morse(n), thue_morse(n).translate(str.maketrans("ab", "ba")))]
    assert encoded(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_compares_bytes_behind_a_hash(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "span_hash", lambda data, starts, ends, lower: (np.asarray(ends) - starts).astype(np.uint64))
    texts = ["one two six ten", "alpha gamma delta", "", "one one", "42 43 44"]
    codec.forget()
    assert encoded(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    codec.forget()


def test_bpe_memory_is_emptied_when_full(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    texts = [f"word{i} thing{i * 7} and so on" for i in range(300)]
    for t in texts:
        assert encoded(codec, [t]) == [library.encode(t, add_special_tokens=False).ids]


def test_bpe_long_pre_token_uses_one_tree(codec, library):
    word = "thing" * 400
    assert codec.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op4_bpe"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_bpe_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "a  b", "z"), (None, "é", None)], "doc_id long, text string, token_ids string")
    tokenizer = bpe.BpeTokenizer(spark, queries.BPE_VOCABULARY)
    out = tokenizer.encode(df)
    assert [len(r.token_ids) for r in out.collect()] == [0, 0, 3, 1]
    assert [r.decoded for r in tokenizer.decode(out).collect()] == ["", "", "a  b", "é"]
    lists = spark.createDataFrame([([64, None, 65],), (None,), ([10**6],)], "token_ids array<int>")
    assert [r.decoded for r in tokenizer.decode(lists).collect()] == ["ab", "", ""]
    assert tokenizer.encode(df.limit(0)).count() == 0


PAGE = """<html><body><header class="site"><h1>Site</h1><p>{long}</p></header><div id="wrapper"><div class="sidebar">
<p>Popular posts of this week</p><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div>{open}<h1>Title &amp; more</h1>
<p>First <b>para</b>graph<br>with   a break, and a fair number of words in it.</p><div class="advert"><p>Buy now!</p></div>
<ul><li>item one<li>item two</ul><table><tr><td>cell a<td>cell b</table><form><label>Mail</label><p>Subscribe</p></form>
<aside><p>By the way</p></aside><div class="comments"><h2>Comments</h2>{comments}</div><p>Last</p>{close}</div>
<div class="cookie-notice"><p>We use cookies</p></div><script>var a="<p>no</p>";</script><footer><p>Copyright</p></footer>"""
TEXT = "Title & more\nFirst paragraph with a break, and a fair number of words in it.\nitem one\nitem two\ncell a\ncell b\nLast"


@pytest.fixture(scope="module")
def weights(spark):
    return htmltext.train(spark, spark.read.parquet(f"{SF}/pages.parquet"))


def test_marginals_match_enumeration():
    rng = np.random.default_rng(6)
    parent, unary = [-1, 0, 0, 1, 1, 4, 2], rng.normal(size=7).tolist()
    begin, end = 1.3, 0.4
    total, content = 0.0, np.zeros(7)
    for k in range(2 ** 7):
        y = [k >> i & 1 for i in range(7)]
        s = sum(u for u, v in zip(unary, y, strict=True) if v)
        s -= sum(begin * (y[i] and not y[p]) + end * (y[p] and not y[i]) for i, p in enumerate(parent) if i)
        total += np.exp(s)
        content += np.exp(s) * np.array(y)
    odds, _, _ = htmltext.marginals(parent, unary, begin, end)
    assert np.allclose(1 / (1 + np.exp(-np.array(odds))), content / total)


@pytest.mark.parametrize("wrap", [("<main><article>", "</article></main>"), ('<div class="post-content">', "</div>")])
def test_unseen_page_layouts(weights, wrap):
    prose = "A long comment that reads like prose and goes on. " * 8
    page = PAGE.format(long=prose, open=wrap[0], close=wrap[1], comments=f"<p>{prose}</p>" * 12)
    assert htmltext.main_text(page, weights) == TEXT


def test_page_query(spark):
    got = {r.page_id: r for r in queries.QUERIES["op9_html"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        cut = (" ".join(htmllib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(b for b in cut if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (text, len(text))


def test_raw_elements_end_in_place(weights):
    many = "\u0130" * 50
    page = (f"<article><p>{many}</p><script>var a = 1;</script><p>one</p><button>go</button><p>two</p><SCRIPT>b</scripts></Script\n><p>three</p>"
            "<style>p{}</STYLE ><p>four</p></article>")
    assert htmltext.main_text(page, weights) == f"{many}\none\ntwo\nthree\nfour"


@pytest.mark.parametrize("part,text", [
    ('<svg viewBox="0 0 1 1"/>', ""), ("<math/>", ""), ("<svg width=1/>", ""), ("<svg><path d=''><text>no", ""), ("<svg><title>no</svg>", ""),
    ("<svg><g><svg><path/></svg><text>no</text></g></svg>", ""), ("<svg><foreignObject><p>no</p></foreignObject></svg>", ""),
    ("<svg><title/><script/></svg>", ""), ("<button>no", ""), ("<button><span>no", ""), ("<button/>", ""), ("<select><option>no<option>no", ""),
    ("<noscript>no <b>no</b>", ""), ("<noscript><button>no", ""), ("<button><div>no</div></button>", ""), ("<noscript><p>no</p></noscript>", ""),
    ("<select><optgroup><option>no</option></optgroup></select>", ""), ("<template><template>no</template><p>no</p></template>", ""),
    ("<button>no<button>no</button>", ""), ("<object>", ""), ("<object data=x><object>in</object> out</object>", "in out"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"), ("<object><p>in</p></object>", "in")])
def test_hidden_and_foreign_elements(weights, part, text):
    page = f"<html><body><article><p>one</p>{part}<p>two</p> and <b>three</b><button>no</button><p>four</p></article><p>five</p>"
    want = [x for x in ("one", text, "two", "and three", "four") if x]
    assert htmltext.main_text(page, weights).split("\n")[:len(want)] == want
    assert "no" not in htmltext.main_text(page, weights)
    many = htmltext.parse(f"<article>{part * 3000}<p>end</p>")
    assert many.texts[-1][2] == "end" and many.tag[many.texts[-1][0]] == "p" and not any("no" in t for _, _, t in many.texts)


def test_broken_pages(spark, weights):
    pages = {None: "", "": "", "<": "", "<article>a < b": "a < b", "<article>a<p": "a", "<article><p>x &am y &amp z &#233;</p>": "x &am y & z é",
             "<article><!-- no": "", "<article><script>no": "", "<article><p>a<p>b</article></div></p><p>c": "a\nb",
             "<ARTICLE><P title='>'>a</P></ARTICLE>": "a", "<article>" + "<div>" * 5000 + "x": "x", "<article>" + "a<br>" * 5000: " ".join("a" * 5000)}
    for page, text in pages.items():
        assert htmltext.main_text(page, weights) == text, page and page[:60]
    htmltext.main_text("<a b=\">" * 30_000, weights)
    df = spark.createDataFrame([(1, None, "x"), (2, "<article><p>a</p></article>", None), (2, "<article><p>a</p></article>", "y")],
                               "page_id long, html string, text string")
    assert [r.text for r in htmltext.extract(spark, df, weights).collect()] == ["", "a", "a"]
    assert htmltext.extract(spark, df.limit(0), weights).count() == 0
    assert np.allclose(htmltext.train(spark, df.limit(0)), htmltext.PRIOR)


LONG = "A sentence of the article that goes on for a while and says what it has to say. " * 8
SHORT_NAV = "<nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>"


@pytest.mark.parametrize("page,text", [
    ("<body><p>{p}</p></body>", "{p}"),
    ("<body><section><h1>Title</h1><p>{p}</p><p>Short.</p></section></body>", "Title\n{p}\nShort."),
    ("<html><body>{nav}<div><h1>Title</h1><p>{p}</p><p>{p}</p></div><footer>Copyright</footer></body>", "Title\n{p}\n{p}"),
    ("<body>{nav}<h1>Title</h1><p>{p}</p><p>{p}</p><ul><li>one</li></ul><footer>{p}</footer></body>", "Title\n{p}\n{p}\none"),
    ("<table><tr><td><a href=x>Home</a><br><a href=y>News</a></td><td><h1>Title</h1><p>{p}</p><p>{p}</p></td></tr></table>", "Title\n{p}\n{p}"),
    ('<body><form id=page><div>{nav}</div><div><h2>Title</h2><p>{p}</p><p>{p}</p></div></form></body>', "Title\n{p}\n{p}"),
    ('<article class="post type-post category-news comments-open"><h1>T</h1><p>a</p></article>', "T\na"),
    ('<article class="post share-buttons-on"><p>a</p></article><p>{p}</p>', "a"),
    ('<article><p class="alert-intro">one</p><section id="related-work"><h2>two</h2><p>{p}</p></section><div class="text-banner-free">'
     '<p>three</p></div><section class="legal-analysis"><p>four</p></section></article>', "one\ntwo\n{p}\nthree\nfour"),
    ('<div><h1>T</h1><p>{p}</p><p>{p}</p></div><div class="site-comments"><p>{p}</p><p>{p}</p><article class="comment"><p>{p}</p></article></div>',
     "T\n{p}\n{p}"),
])
def test_pages_without_marked_article(weights, page, text):
    given, want = page.replace("{p}", LONG).replace("{nav}", SHORT_NAV), text.replace("{p}", LONG.strip())
    assert htmltext.main_text(given, weights) == want


def test_articles_made_divisions(spark, weights):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    right = [htmltext.main_text(re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)article[^>]*>", r"<\1div>", r.html)), weights)
             == htmltext.main_text(r.html, weights) for r in rows]
    assert np.mean(right) >= 0.95


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    frame, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, frame = frame, stage(spark, frame, SF)
        assert frame.columns == before.columns, name
        kept[name] = {r.doc_id: r.text for r in frame.collect()}
        frame = spark.createDataFrame(frame.collect(), before.schema)
    text = {r.doc_id: r.text for r in docs}
    after = sorted(kept["toxicity"])
    sets = [brute.grams(text[i]) for i in after]
    classes = brute.classes(after, lambda i, j: brute.similar(sets[i], sets[j]))
    assert set(kept["ngram_join"]) == set(classes)
    clean = {i for i in kept["ngram_join"] if not brute.contaminated(text[i], items)[1]}
    assert set(kept["decontamination"]) == clean
    assert set(kept["secrets"]) == clean
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == clean and all(r.exact for r in out)
    assert all(r.text == kept["secrets"][r.doc_id] and r.n_tokens == len(r.token_ids) for r in out)


def test_pipeline_edges(spark):
    rows = [(1, None, "en", "s", None), (None, "a b c", None, None, 5), (None, "a b c", None, None, 5), (3, "", "de", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "7 as node", "1 as gone", "2 as spans", "3 as bad_id", "4 as R_KEY")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns) and out.count() == 4
        assert stage(spark, docs.limit(0), SF).count() == 0
