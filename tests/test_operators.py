import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lathework.operators import dedup, extract, filters, formats, linkgraph, qa, sections
from lathework.operators.components import components

SAMPLE = "seq bigint, instruction string, input string, output string"


def sequential(edges):
    lefts, rights, kept = set(), set(), []
    for left, right, seq in sorted(edges, key=lambda e: e[2]):
        if left not in lefts and right not in rights:
            lefts.add(left)
            rights.add(right)
            kept.append(seq)
    return kept


def matched(spark, edges, finish):
    df = spark.createDataFrame(edges, "left string, right string, seq bigint")
    return sorted(r["seq"] for r in dedup.greedy_matching(df, finish_rows=finish).collect())


def test_greedy_matching_equals_the_sequential_pass(spark):
    rng = random.Random(3)
    for size in (0, 1, 30, 80):
        edges = [(f"i{rng.randint(0, size // 2 + 1)}", f"o{rng.randint(0, size // 2 + 1)}", n) for n in range(size)]
        assert matched(spark, edges, 0) == sequential(edges)
        assert matched(spark, edges, 1000) == sequential(edges)


def test_greedy_matching_chain(spark):
    edges = [(f"i{(k + 1) // 2}", f"o{k // 2}", k) for k in range(60)]
    assert matched(spark, edges, 1000) == sequential(edges)


def test_judge_reasons(spark):
    long = lambda c: " ".join(f"{c}{n}" for n in range(30))
    rows = [(1, "q1", None, long("a")), (2, "q1", "", long("b")), (3, "q2", "", long("a")), (4, "q3", "", "x" * 49), (5, "q4", "", "abc " * 60), (6, "q4", "", long("c")), (7, None, None, None)]
    got = {r["seq"]: r["reason"] for r in dedup.judge(spark.createDataFrame(rows, SAMPLE)).collect()}
    assert got == {1: "kept", 2: "duplicate_instruction", 3: "duplicate_output", 4: "short_output", 5: "repetitive_output", 6: "kept", 7: "short_output"}
    assert dedup.judge(spark.createDataFrame([], SAMPLE)).count() == 0
    counts = {r["reason"]: r["rows"] for r in dedup.reason_counts(dedup.judge(spark.createDataFrame(rows, SAMPLE))).collect()}
    assert counts["kept"] == 2


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 6, "w"), ("a", 1, "v")], "k string, n int, v string")
    first = {r["k"]: r["n"] for r in dedup.first_per_key(df, F.col("k"), "n").collect()}
    last = {r["k"]: r["v"] for r in dedup.last_per_key(df, F.col("k"), "n").collect()}
    assert first == {"a": 1, None: 5} and last == {"a": "x", None: "w"}


def test_near_recent(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away"
    df = spark.createDataFrame([(1, "s", base), (2, "s", base + "!"), (3, "s", "something else entirely here"), (4, "t", base)], "seq bigint, source string, output string")
    assert sorted(r["seq"] for r in dedup.near_recent(df, group="source").collect()) == [1, 3, 4]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(n, n + 1) for n in range(100, 140)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_sections_and_chunks(spark):
    assert sections.sections_of("a\n# T\nb\n## U\n# V\nc") == [("intro", "a"), ("T", "b"), ("V", "c")]
    assert sections.sections_of(None) == []
    line = "x" * 399
    text = "\n".join([line] * 25)
    cut = sections.chunks_of(text)
    assert len(cut) == 2 and len(cut[0]) >= 4096
    assert "\n".join(sections.chunks_of(text, lossless=True)) == text
    fenced = "```\n" + "\n".join([line] * 30) + "\n```"
    assert sections.chunks_of(fenced) == [fenced]
    df = spark.createDataFrame([(1, "a\n# T\nb", "extra"), (2, None, "x"), (3, "", "y")], "doc_id bigint, text string, chunk_id string")
    assert sections.split_chunks(df).count() == 2


def test_filters(spark):
    df = spark.createDataFrame([("i" * 9, "o" * 50), ("i" * 10, "o" * 49), ("i" * 501, "o" * 60), ("i" * 500, "o" * 10_001), ("i" * 20, "o" * 50), (None, None)], "instruction string, output string")
    got = [r[0] for r in df.select(filters.quality_reason("instruction", "output")).collect()]
    assert got == ["short_instruction", "short_output", "long_instruction", "long_output", None, "short_instruction"]
    words = spark.createDataFrame([("if a < b and c > d in words",), ("one two three four",), ("one two three four five",), (None,)], "t string")
    assert [r[0] for r in words.select(filters.grounded("t")).collect()] == [False, False, True, False]


def test_python_samples(spark):
    body = '"""Doc of it."""\n\ndef f(a):\n    """Add things up."""\n    return a + 1000000000000000000\n\nasync def g():\n    pass\n\ndef _p():\n    return 1\n'
    df = spark.createDataFrame([(1, "a/b_c.py", body), (2, "__init__.py", body), (3, "x.py", "def ("), (4, "y.py", None), (5, None, "")], "key bigint, path string, source string")
    got = {(r["kind"], r["part"], r["instruction"]) for r in extract.python_samples(df).collect()}
    assert got == {("file", 0, "Write Python code that doc of it."), ("file", 1, "Show me how to doc of it."), ("function", 0, "Write Python code that add things up.")}
    assert extract.rst_blocks("Do it:\n\n.. code-block:: python\n\n   import os\n   print(os.getcwd())\n\nend") == [("Do it:", "import os\nprint(os.getcwd())")]
    assert [n for n, _ in extract.code_sections("x\nimport a\nfrom b import c\ndef f():\n  pass\nclass D:\n  pass")] == ["Setup", "Imports", "Define f()", "Define D class"]


def test_qa_records(spark):
    answers = spark.createDataFrame([(1, 1, -1, True), (1, 2, 5, False), (2, 3, 0, True), (2, 4, 9, False), (3, 5, -2, False)], "question_id int, answer_id int, score int, is_accepted boolean")
    assert {r["question_id"]: r["answer_id"] for r in qa.best_answers(answers).collect()} == {1: 2, 2: 3}
    comments = spark.createDataFrame([(1, 0, "a", {"+1": 1}), (1, 1, "b" * 201, {"+1": 1}), (2, 0, "c", {"-1": 1}), (3, 0, "d", None), (3, 1, "e", None)], "issue_id int, seq int, body string, reactions map<string,int>")
    assert {r["issue_id"]: r["seq"] for r in qa.best_comments(comments).collect()} == {1: 1, 3: 0}
    turns = spark.createDataFrame([(1, 1, "User", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "r"), (1, 4, "USER", "s"), (1, 5, "Assistant", None)], "conv_id int, turn int, role string, text string")
    assert [(r["instruction"], r["output"]) for r in qa.turns_to_samples(turns).orderBy("turn").collect()] == [("q", "a"), ("s", "")]


def test_bfs(spark):
    links = spark.createDataFrame([("http://h/a", "http://h/b"), ("http://h/b", "http://h/c"), ("http://h/c", "http://h/a"), ("http://h/a", "http://x/z")], "src string, dst string")
    starts = spark.createDataFrame([("http://h/a",), (None,)], "url string")
    assert {r["url"]: r["depth"] for r in linkgraph.reachable(links, starts).collect()} == {"http://h/a": 0, "http://h/b": 1, "http://h/c": 2}
    barred = spark.createDataFrame([("h", "/b")], "host string, prefix string")
    urls = spark.createDataFrame([("http://h/b/x",), ("http://h/c",), ("http://h/a",)], "url string")
    assert [r["url"] for r in linkgraph.allowed(urls, starts, barred, "h").collect()] == ["http://h/c"]


def test_formats_handle_nulls(spark):
    df = spark.createDataFrame([(None, None, None), ("q", "i", "a")], "instruction string, input string, output string")
    assert [r["input"] for r in formats.alpaca(df).collect()] == ["", "i"]
    assert df.select(formats.sharegpt().alias("c")).collect()[1]["c"][0]["value"] == "q\n\ni"


def one_pass(rows, window=100, threshold=0.85):
    keys, kept, out = set(), [], []
    for at, key, text, skip in sorted(rows):
        if skip or key in keys or any(SequenceMatcher(None, text, old).ratio() > threshold for old in kept[-window:]):
            continue
        keys.add(key)
        kept.append(text)
        out.append(at)
    return out


@pytest.mark.parametrize(("window", "block"), [(3, 25), (100, 25), (100, 10_000)])
def test_near_recent_in_blocks_is_one_pass(spark, window, block):
    rng = random.Random(3)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    bases = [[rng.choice(words) for _ in range(rng.randint(8, 40))] for _ in range(10)]
    rows = []
    for n in range(120):
        t = list(rng.choice(bases))
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((n * 3, rng.choice("abcdefgh") if rng.random() < 0.3 else f"k{n}", " ".join(t), rng.random() < 0.05))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "seq bigint, key string, output string, bad boolean, at string")
    got = dedup.near_recent(df, window=window, key=df["key"], skip=df["bad"], block_rows=block)
    assert sorted(r["seq"] for r in got.collect()) == one_pass(rows, window)
    assert got.columns == df.columns and dedup.near_recent(df.limit(0)).count() == 0


def test_grams_lose_no_similar_text():
    rng = random.Random(5)
    grams = dedup._Grams(0.85)
    for _ in range(300):
        a = "".join(rng.choice("abc d") for _ in range(rng.randint(0, 80)))
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            b.insert(rng.randint(0, len(b)), rng.choice("abc d"))
            if b and rng.random() < 0.4:
                b.pop(rng.randrange(len(b)))
        b = "".join(b)
        if SequenceMatcher(None, a, b).ratio() > 0.85:
            assert grams.similar(len(a), grams.of(a), [(len(b), grams.of(b))]) == [0]
            assert 2 * dedup._common(dedup._masks(b), len(b), a) > 0.85 * (len(a) + len(b))


def long_text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_grams_leave_few_of_long_unlike_texts_and_lose_no_similar():
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlucmfwypvbgkjqxz0123"[: rng.choice((8, 16, 30))]) for _ in range(rng.randint(2, 9))) for _ in range(900)] + ["größe", "\u4f60\u597d"]
    grams = dedup._Grams(0.85)
    texts = [long_text(rng, words, rng.randint(90, 130)) for _ in range(60)]
    kept = [(len(t), grams.of(t)) for t in texts]
    assert sum(len(grams.similar(*k, kept[:i])) for i, k in enumerate(kept)) < 10
    similar = 0
    for _ in range(800):
        a = long_text(rng, words[:: rng.choice((1, 40, 300))], rng.randint(20, 120)).split(" ")
        b = list(a)
        for _ in range(rng.randint(0, 30)):
            i = rng.randrange(len(b))
            b[i : i + rng.randint(0, 2)] = rng.choice([[], [rng.choice(words)], ["e" + b[i]], [b[i][1:]]])
        a, b = " ".join(a), " ".join(b)
        if SequenceMatcher(None, a, b).ratio() > 0.85:
            similar += 1
            assert grams.similar(len(a), grams.of(a), [(len(b), grams.of(b))]) == [0]
    assert similar > 100


@pytest.mark.parametrize("block", [4, 1000])
def test_near_recent_of_empty_and_null_outputs(spark, block):
    outputs = ["", None, "some text of its own", "", "another one of them", None, "SOME text of its own", "\U0001f600 \u4f60", "\U0001f600 \u4f60"]
    df = spark.createDataFrame(list(enumerate(outputs)), "seq bigint, output string")
    got = sorted(r["seq"] for r in dedup.near_recent(df, block_rows=block).collect())
    assert got == one_pass([(i, i, (t or "").lower(), False) for i, t in enumerate(outputs)]) == [0, 2, 4, 7]


def test_near_recent_of_few_outputs_takes_few_rounds(spark, monkeypatch):
    rng = random.Random(9)
    texts = [long_text(rng, [f"{c}{n}" for n in range(50)], 12) for c in "abcdef"]
    rows = [(n, n, t, False) for n, t in enumerate(t for _ in range(14) for t in rng.sample(texts, len(texts)))]
    written = []
    real = dedup.cut_lineage
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: written.append(1) or real(df))
    df = spark.createDataFrame([(r[0], r[2]) for r in rows], "seq bigint, output string")
    got = sorted(r["seq"] for r in dedup.near_recent(df, block_rows=6).collect())
    assert got == one_pass(rows) and len(written) <= 14  # two a round


@pytest.mark.parametrize(("window", "threshold"), [(0, 0.85), (3, 0.85), (100, 0.85), (100, 0.5)])
def test_a_pass_over_parts_is_one_pass(window, threshold):
    rng = random.Random(11)
    words = [f"{c}{n}" for c in ("ab", "größe", "\u4f60", "x") for n in range(40)]
    rows = []
    for n in range(400):
        t = long_text(rng, words, rng.randint(0, 60)) if n < 5 or rng.random() < 0.6 else rows[rng.randrange(max(0, n - 150), n)][2]
        rows.append((n, rng.choice("abcdefgh") if rng.random() < 0.1 else None, t + rng.choice(["", " end", " of it"]), rng.random() < 0.05))
    got, tail = dedup._pass_over(rows[::-1], [], threshold, window)
    kept = one_pass([(n, n if k is None else k, t, s) for n, k, t, s in rows], window, threshold) if window else None
    assert window == 0 or sorted(at for at, good in got if good) == kept
    assert len(got) == len(rows) and [at for at, _ in tail] == (kept[-window:] if window else [])


def test_near_recent_passes_over_unlike_outputs_once(spark, monkeypatch):
    rng = random.Random(13)
    texts = [long_text(rng, [f"{c}{n}" for c in "abcdef" for n in range(50)], 12) for _ in range(150)]
    rows = [(n, n, texts[n] if n % 10 else texts[n - n % 20 + 1], False) for n in range(150)]
    written = []
    real = dedup.cut_lineage
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: written.append(1) or real(df))
    df = spark.createDataFrame([(r[0], r[2]) for r in rows], "seq bigint, output string")
    got = sorted(r["seq"] for r in dedup.near_recent(df, window=5, block_rows=30).collect())
    assert got == one_pass(rows, 5) and len(got) < 150 and len(written) == 6  # four before the only round, its result, and that no block is left


def test_long_chains_are_finished_in_slices(spark):
    edges = [(f"i{(k + 1) // 2}", f"o{k // 2}", k) for k in range(90)]
    df = spark.createDataFrame(edges, "left string, right string, seq bigint")
    got = dedup.greedy_matching(df, finish_rows=20, rounds=3)
    assert sorted(r["seq"] for r in got.collect()) == sequential(edges)


def test_rst_blocks_after_directives_and_colons():
    content = "Intro\n\n.. code:: python\n\n    import os\n    print(os.environ)\n\n.. testcode::\n\n    def f():\n        assert f is not None\n\nSee::\n\n    $ ls -la /tmp and more\n"
    assert extract.rst_blocks(content) == [("Intro", "import os\nprint(os.environ)"), (".. testcode", "def f():\n    assert f is not None")]


def test_crawl_is_breadth_first_with_limits(spark):
    body = "<main>" + "word " * 40 + "</main>"
    page = lambda *links: body + "".join(f'<a href="{x}">x</a>' for x in links)
    pages = [
        ("http://h/a", page("/b", "/c", "http://x/z", "/f.pdf")), ("http://h/b", page("/d")), ("http://h/c", page("/d", "/e")), ("http://h/d", page("/a")), ("http://h/e", "<p>short</p><a href='/g'>g</a>"),
        ("http://h/g", page()), ("http://x/z", page()), (None, page()), ("http://h/b", page("/d") + "zz"),
    ]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "url string, html string, title string")
    starts = spark.createDataFrame([("http://h/a",), ("http://x/z",), ("http://no/where",), (None,)], "url string")
    got = sorted((r["start"], r["depth"], r["url"]) for r in linkgraph.crawl(df, starts).collect())
    assert got == [("http://h/a", 0, "http://h/a"), ("http://h/a", 1, "http://h/b"), ("http://h/a", 1, "http://h/c"), ("http://h/a", 2, "http://h/d"), ("http://x/z", 0, "http://x/z")]
    assert sorted(r["url"] for r in linkgraph.crawl(df, starts, most_pages=2).where("start = 'http://h/a'").collect()) == ["http://h/a", "http://h/b"]
    assert linkgraph.crawl(df, starts, most_depth=0).count() == 2 and linkgraph.crawl(df.limit(0), starts).count() == 0


def test_cluster_and_rst_samples(spark):
    body = '"""List all pods.\n\nMore of it."""\n# note\nimport client\n\ndef show(space):\n    """Print the pods of a namespace."""\n    print(client.list(space))\n\ndef _hidden():\n    return 1\n'
    files = spark.createDataFrame([(1, "k8s/list_pods.py", body), (2, "bad.py", "def ("), (3, "empty.py", None)], "key bigint, path string, source string")
    got = sorted((r["kind"], r["part"], r["instruction"], r["output"][:20]) for r in extract.cluster_samples(files).collect())
    whole, rest = [g for g in got if g[0] == "file"], [g for g in got if g[0] != "file"]
    assert len(whole) >= 2 and len({g[2] for g in whole}) == len(whole) and {g[3] for g in whole} == {body[:20]}
    assert [(k, p) for k, p, _, _ in rest] == [("function", 0), ("question", 0), ("question", 1)] and rest[0][3].startswith("def show(space):")
    assert rest[1][2] == "How can I list all pods.?" and rest[2][2:] == ("What does list pods do?", "List all pods.\n\nMore")
    rst = "Pods\n====\n\nList them\n\n.. code-block:: python\n\n    for pod in client.list('default'):\n        print(pod.metadata.name)\n"
    rows = extract.rst_samples(spark.createDataFrame([(1, rst), (2, None), (3, "")], "key bigint, source string")).orderBy("part").collect()
    assert [(r["block_no"], r["part"], r["instruction"]) for r in rows] == [(0, 0, "Write code to list them"), (0, 1, "Show me how to list them")]
    assert rows[0]["output"] == "for pod in client.list('default'):\n    print(pod.metadata.name)"


def test_page_answers_have_their_code(spark):
    from lathework.functions import web

    html = "<title>Retry Guide</title><main>" + "word " * 60 + '<pre><code class="language-python">for n in range(3):\n    retry(n &lt; 2)</code></pre></main>'
    df = spark.createDataFrame([("http://docs.python.example/a", html, "x"), ("http://h/b", None, "x"), (None, "", "x")], "url string, html string, title string")
    blocks = F.transform(web.code_blocks_of("html"), lambda b: F.struct(web.detect_language(b["classes"], b["code"]).alias("language"), b["code"].alias("code")))
    crawled = df.select("url", web.netloc("url").alias("domain"), F.lit(0).alias("depth"), web.html_title("html").alias("title"), web.content_select("html").alias("content"), blocks.alias("code_blocks"))
    rows = qa.from_pages(crawled).collect()
    assert len(rows) == 1 and rows[0]["instruction"] == "Retry Guide?" and rows[0]["tags"][0] == "python"
    assert rows[0]["output"].endswith("Example code:\n\n```python\nfor n in range(3):\n    retry(n < 2)\n```\n") and rows[0]["metadata"]["code_blocks"] == "1"


def test_reports_contexts_and_templates(spark, tmp_path):
    from lathework.operators import augment, evaluate

    paired = spark.createDataFrame([(1, "a", 50.0, 70.0), (2, "b", 60.0, 40.0)], "question_id bigint, category string, base double, tuned double").withColumn("diff", F.col("tuned") - F.col("base"))
    evaluate.write_report(evaluate.markdown_report(evaluate.by_category(paired), evaluate.summary(paired), "Run"), str(tmp_path / "r"))
    lines = "".join(p.read_text() for p in (tmp_path / "r").glob("part*")).splitlines()
    assert lines[0] == "# Run" and lines[2] == "Questions: 2" and lines[3] == "Mean: 55.0 -> 55.0 (+0.0)" and lines[7:] == ["| a | 50.0 | 70.0 | +20.0 |", "| b | 60.0 | 40.0 | -20.0 |"]
    told = [r["line"] for r in evaluate.comparison_report(paired).orderBy("place").collect()]
    assert told[4:] == ["| 1 | 50.0 | 70.0 | 20.0 |", "| 2 | 60.0 | 40.0 | -20.0 |"]
    asks = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "title string")
    found = spark.createDataFrame([("x", "about", ["one", "", None, "two", "three"]), ("y", "", [])], "query string, abstract string, related array<string>")
    assert {r["title"]: r["context"] for r in augment.with_context(asks, found, "title").collect()} == {"x": "about\none", "y": None, "z": None, None: None}
    rows = augment.template_pairs(spark).collect()
    assert len(rows) == 5 and {r["score"] for r in rows} == {100} and len({r["tags"][0] for r in rows}) == 4
