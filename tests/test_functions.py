import re
import uuid
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lathework.functions import code, keys, text, titles, web

ODD = ["a\xa0 b\t c", " X Y\n", "a\x1cb", "", "  ", None, "é" * 40, "abc " * 60, "x" * 31, "x" * 30, "日本 語"]


def py_normalize(t):
    return re.sub(r"\s+", " ", t.lower().strip())


def py_phrases(t, n=30):
    t = py_normalize(t or "")
    counts = defaultdict(int)
    for i in range(0, len(t) - n, n // 2):
        counts[t[i : i + n]] += 1
    return max(counts.values(), default=0)


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make("v").alias("x")).collect()]


def test_normalize_like_python(spark):
    got = column(spark, ODD, text.normalize)
    assert got == [None if v is None else py_normalize(v) for v in ODD]


def test_phrases_like_python(spark):
    assert column(spark, ODD, text.repeated_phrases) == [py_phrases(v) for v in ODD]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n\xa0", max_size=200), min_size=1, max_size=20))
def test_phrases_and_words_property(spark, values):
    assert column(spark, values, text.repeated_phrases) == [py_phrases(v) for v in values]
    assert column(spark, values, text.word_count) == [len(v.split()) for v in values]


def test_tokens_and_sentences(spark):
    assert column(spark, ["", "1234567", "12345678", None], text.token_count) == [1, 1, 2, 1]
    three = "this is a sentence of some length. " * 3
    assert column(spark, [three, "x" * 21, None, ("a" * 20 + ".") * 5], text.has_repeated_sentences) == [True, False, False, False]
    two = "one sentence that is long enough. another sentence that is long. " * 2
    assert column(spark, [two, "short"], text.repetition_ratio) == [50.0, 0.0]


def test_uuid5(spark):
    values = ["a", "é", "http://x/y", ""]
    assert column(spark, values, lambda c: keys.uuid5(F.lit("d"), F.col(c))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"d-{v}")) for v in values]


def test_titles(spark):
    assert column(spark, ["Parse JSON", "How to x", "Why?"], titles.title_to_question) == ["How do I parse json?", "How to x?", "Why?"]
    assert column(spark, ["Getting-started Guide", "", "A guide", "X?"], titles.title_to_explain) == ["Explain getting", "Explain this concept", "A guide?", "X?"]


def test_web(spark):
    assert column(spark, ["http://h/a/#x", "http://h/a//", "http://u:p@h:8/x?b=1&a=2"], web.normalize_url) == ["http://h/a", "http://h/a/", "http://u:p@h:8/x?b=1&a=2"]
    assert column(spark, ["http://u:p@h:8/x", "x/y", None], web.netloc) == ["u:p@h:8", "", None]
    html = ['&lt;b&gt;x&lt;/b&gt;', '<pre><code class="y">a</code></pre>', "a\n\n\n\nb", None, '<p>a</p><a href="u">t</a>']
    assert column(spark, html, web.clean_html) == ["x", "```\na\n```", "a\n\nb", "", "a\n\n[t](u)"]
    assert column(spark, ["$ ls", "{\"a\": 1}", "x"], lambda c: web.detect_language(F.lit(""), c)) == ["bash", "json", "text"]
    assert column(spark, ["language-json"], lambda c: web.detect_language(c, F.lit(""))) == ["javascript"]
    assert web.markdown_of("<nav>x</nav><h1>T</h1><p>a <b>b</b><script>var s = '</p>'</script>") == "# T\n\na **b**"


def test_code(spark):
    assert column(spark, ["# c\n\nx = 1\n", "# only\n# comments", None], code.clean_code) == ["x = 1", "# only\n# comments", ""]
    assert column(spark, ["    a\n      b\n\n  ", "a"], code.dedent) == ["a\n  b", "a"]
    assert column(spark, ["Title\n=====\nx", "x"], code.rst_title) == ["Title", ""]
    assert column(spark, ['"""Doc.\nMore."""', "# note\nx", "x"], code.code_description) == ["Doc.", "note", None]
    block = "How:\n```py\n" + "x" * 21 + "\n```"
    assert [(r["context"], len(r["code"])) for r in column(spark, [block], code.markdown_blocks)[0]] == [("How:", 21)]


def test_unclosed_elements_drop_no_content():
    assert web.markdown_of("<html><head><title>x</title><body><p>hello world</p>") == "hello world"
    assert web.markdown_of("<nav>menu<p>hello") == "hello" and web.markdown_of("<nav><p>menu</p></nav><p>hello</p>") == "hello"
    assert web.markdown_of("<div class='ad big'><div>x</div>buy</div><p>hi</p>") == "hi"
    assert web.markdown_of("<p>a</p><footer>b<p>c") == "a\n\nc"
    assert web.plain_markdown_of("<nav>menu</nav><style>p {}</style><p>hi</p>") == "menu\n\nhi"
    long = "word " * 3000
    assert len(web.content_of(f"<p>{long}</p>")) > 5000 and len(web.selected_of(f"<p>{long}</p>")) == 5000
    assert web.content_of(f"<div class='content'><div>a</div><p>{long}</p></div>tail").startswith("a") and "tail" not in web.content_of(f"<div class='content'><div>a</div><p>{long}</p></div>tail")


def test_urljoin_like_the_standard_library(spark):
    from urllib.parse import urljoin

    bases = ["http://h/a/b?q#f", "https://h.example:8/a/b/", "http://h", "x/y", "http://h/a//b"]
    links = ["/c", "c", "../c", "//x/y", "http://k/z/../w", "http://k/z", "?q=1", "#top", "", "/a/./b", "/a//b", "mailto:x@y", "http://k", "HTTP://K/x", "https://k//x"]
    pairs = [(a, b) for a in bases for b in links] + [(None, "x"), ("http://h/", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", web.urljoin("a", "b").alias("got")).collect():
        assert r["got"] == (urljoin(r["a"], r["b"]) if r["a"] and r["b"] is not None else None), (r["a"], r["b"])
