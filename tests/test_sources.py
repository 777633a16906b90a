import json

import pytest
from pyspark.sql import functions as F

from lathework import config
from lathework.plans import runner
from lathework.sources import api, files, registry


def test_registry_and_question_source(spark, tmp_path):
    item = {"question_id": 7, "title": "Parse JSON", "body": "<p>short</p>", "score": 3, "tags": ["python"], "link": "u", "answers": [{"answer_id": 1, "body": "<p>" + "a" * 120 + "</p>", "score": 2, "is_accepted": True}]}
    (tmp_path / "python.1.json").write_text(json.dumps({"items": [item, item | {"question_id": 8, "answers": []}], "has_more": False}))
    got = registry.create("stackoverflow", path=str(tmp_path)).run(spark).collect()
    assert [(r["instruction"], r["source"], len(r["output"])) for r in got] == [("How do I parse json?", "stackoverflow:7", 120)]
    with pytest.raises(ValueError):
        registry.create("stackoverflow")
    with pytest.raises(ValueError):
        registry.collector("github")(registry.CodeHost)
    assert registry.describe(spark).count() == len(registry.names())


def test_code_host_source(spark, tmp_path):
    item = {"number": 4, "title": "It fails", "body": None, "html_url": "u", "comments": [{"body": "b" * 150, "reactions": {"+1": 2, "url": "x"}}]}
    (tmp_path / "a__b.1.json").write_text(json.dumps({"items": [item, item | {"pull_request": {}}], "has_more": True}))
    got = registry.create("github", path=str(tmp_path)).run(spark).collect()
    assert [(r["instruction"], r["source"], r["score"]) for r in got] == [("It fails", "github:a/b:4", 2)]


def test_combine_and_writers(spark, tmp_path):
    (tmp_path / "b_alpaca.json").write_text(json.dumps([{"instruction": "q2", "output": "a2"}]))
    (tmp_path / "a_alpaca.json").write_text(json.dumps([{"instruction": "q1", "input": None, "output": "a1"}, {"instruction": "q0", "output": "a0"}]))
    (tmp_path / "c_alpaca.json").write_text("not json")
    got = files.combine(spark, str(tmp_path)).orderBy("file_name", "position").collect()
    assert [r["instruction"] for r in got] == ["q1", "q0", "q2"]
    df = files.combine(spark, str(tmp_path)).select("instruction", "input", "output")
    files.write_array(df, str(tmp_path / "out"), [F.col("instruction")])
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    assert [x["instruction"] for x in json.loads(text)] == ["q0", "q1", "q2"]
    assert spark.read.json(files.write_collected(df, str(tmp_path), "n", "sharegpt")).count() == 3
    with pytest.raises(ValueError):
        files.write_collected(df, str(tmp_path), "n", "other")


def test_pages_with_meta(spark, tmp_path):
    (tmp_path / "p.html").write_text("<p>x</p>")
    (tmp_path / "q.html").write_text("<p>y</p>")
    (tmp_path / "p.json").write_text(json.dumps({"url": "u", "title": "t"}))
    good, bad = files.pages_with_meta(files.html_dir(spark, str(tmp_path)), files.sidecars(spark, str(tmp_path)))
    assert [r["url"] for r in good.collect()] == ["u"] and bad.count() == 1


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("name: n\nsources: [{name: a, paths: [x]}]\ndeduplication: {max_repetition: 4}\nprofiles: {test: {sources: [{name: a, enabled: false}], extraction: {min_length: 7}}}\nother: 1\n")
    c = config.load(path, "test", {"LATHEWORK_SIMILARITY": "0.5"})
    assert c.sources[0] == {"name": "a", "paths": ["x"], "enabled": False} and c.enabled_sources() == []
    assert (c.extraction.min_length, c.deduplication.max_repetition, c.deduplication.similarity_threshold, c.full_name) == (7, 4, 0.5, "n-1")
    with pytest.raises(KeyError):
        config.load(path, "none", {})


def test_stages(spark, tmp_path):
    body = '"""Count the words of a file."""\n\ndef count(path):\n    """Count the words of one file on disk."""\n    with open(path) as f:\n        return len(f.read().split())\n'
    (tmp_path / "m.py").write_text(body)
    c = config.Config(sources=({"name": "s", "paths": [str(tmp_path), str(tmp_path / "missing")]},))
    run = runner.Run(spark, c)
    log = runner.run_stages(run).collect()
    assert all(r["success"] for r in log) and [r["stage"] for r in log] == list(runner.STAGES)
    assert run.frames["dataset"].count() >= 1
    assert not runner.run_stages(runner.Run(spark, config.Config())).first()["success"]


def test_files_keep_the_last_row_of_a_name(spark, tmp_path):
    df = spark.createDataFrame([("a/x.txt", 1, "old"), ("a/x.txt", 2, "new"), ("b.txt", 1, "ü"), (None, 1, "q"), ("c.txt", 1, None)], "n string, o int, c string")
    made = files.write_files(df, str(tmp_path / "out"), df["n"], df["c"], df["o"])
    assert sorted(r["name"] for r in made.collect()) == ["a/x.txt", "b.txt"]
    assert {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()} == {"a/x.txt": "new", "b.txt": "ü"}


def test_arrays_in_parts_and_of_nothing(spark, tmp_path):
    df = spark.range(50).select(F.col("id"), F.lit(None).cast("string").alias("x"))
    files.write_array(df, str(tmp_path / "many"), [F.col("id")], files=3)
    lists = [json.loads(p.read_text()) for p in sorted((tmp_path / "many").glob("part*"))]
    assert [x["id"] for one in lists for x in one] == list(range(50)) and len(lists) == 3
    files.write_array(df.limit(0), str(tmp_path / "none"))
    assert "".join(p.read_text() for p in (tmp_path / "none").glob("part*")).split() in ([], ["[", "]"])


def test_discussions_examples_and_search(spark, tmp_path):
    talk = {"title": "t", "body": "b", "url": "u", "category": {"name": "Q&A"}, "answer": {"body": "a" * 120, "upvoteCount": 3}}
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "o__r.1.json").write_text(json.dumps({"items": [talk, talk | {"answer": None}], "has_more": False}))
    got = registry.create("github", path=str(tmp_path / "d"), kind="discussions").run(spark).collect()
    assert [(r["source"], r["score"], r["metadata"]["category"]) for r in got] == [("github:o/r:discussion", 3, "Q&A")]
    (tmp_path / "e").mkdir()
    item = {"path": "examples/a.py", "content": "# Read a file\nprint(open('x').read())  # " + "x" * 40, "html_url": "u"}
    (tmp_path / "e" / "o__r.1.json").write_text(json.dumps({"items": [item, item | {"path": "src/a.py"}, item | {"path": "examples/a.md"}], "has_more": False}))
    got = registry.create("github", path=str(tmp_path / "e"), kind="examples").run(spark).collect()
    assert [(r["instruction"], r["source"]) for r in got] == [("Show me a Python example for Read a file", "github:o/r:examples/a.py")]
    (tmp_path / "s").mkdir()
    hits = lambda *x: json.dumps({"items": [{"full_name": n, "stargazers_count": k} for n, k in x], "has_more": False})
    (tmp_path / "s" / "one.1.json").write_text(hits(("a/a", 9), ("b/b", 8), ("c/c", 1)))
    (tmp_path / "s" / "two.1.json").write_text(hits(("b/b", 8), ("d/d", 7), ("e/e", 6)))
    api.register(spark)
    found = spark.read.format("code_host_search").option("path", str(tmp_path / "s")).load()
    queries = spark.createDataFrame([("one", 0), ("two", 1)], "query string, query_no int")
    assert sorted((r["query"], r["full_name"]) for r in api.found_repositories(found, queries, 5, 1).collect()) == [("one", "a/a"), ("two", "d/d")]


def test_missing_folders_are_told(spark, tmp_path):
    (tmp_path / "a.py").write_text("x = 1")
    got = files.git_result(spark, "n", [str(tmp_path), str(tmp_path / "none")]).collect()
    assert sorted((r["source"] or "", (r["error"] or "")[:9]) for r in got) == [("", "no folder"), ("x = 1", "")]
    assert files.git_source(spark, "n", [str(tmp_path / "none")]).count() == 0


def test_environment_file(tmp_path):
    (tmp_path / ".env").write_text("# note\nLATHEWORK_NAME = mine\nLATHEWORK_VERSION=2\nbroken\n")
    env = config.env_file(tmp_path / ".env", {"LATHEWORK_VERSION": "3"})
    assert env == {"LATHEWORK_NAME": "mine", "LATHEWORK_VERSION": "3"} and config.load(None, None, env).full_name == "mine-3"
    assert config.env_file(tmp_path / "none", {}) == {}


def test_most_per_tag(spark, tmp_path):
    answer = {"answer_id": 1, "body": "a" * 120, "score": 2, "is_accepted": True}
    item = {"title": "Do it", "body": "", "tags": [], "link": "u"}
    items = [item | {"question_id": n, "score": n, "answers": [answer | {"body": f"{n}" * 120}] if n != 3 else []} for n in range(1, 5)]
    (tmp_path / "t.1.json").write_text(json.dumps({"items": items, "has_more": False}))
    got = registry.create("stackoverflow", path=str(tmp_path), max_per_tag="2").run(spark).collect()
    assert sorted(r["source"] for r in got) == ["stackoverflow:2", "stackoverflow:4"]


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from lathework import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_throttle():
    from lathework.sources.throttle import Busy, Throttle

    now, slept, answers = [0.0], [], [Busy(429), Busy(403, 7.0), "ok"]

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    def fetch(key):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return key + answer

    slow = Throttle(2.0, 3, 10.0, lambda: now[0], sleep)
    assert slow.call(fetch, "a:") == "a:ok" and slept == [10.0, 7.0]
    answers[:] = ["b"]
    assert slow.call(fetch, "") == "b" and slept[2:] == [2.0]
    answers[:] = [Busy(500)]
    with pytest.raises(Busy):
        slow.call(fetch, "")


def test_command_line(spark, tmp_path, capsys):
    from lathework import cli

    assert cli.main(["--list"]) == 0 and "github" in capsys.readouterr().out
    assert cli.main(["--help-config"]) == 0 and "deduplication.max_repetition: 3" in capsys.readouterr().out
    (tmp_path / "pairs.jsonl").write_text(json.dumps({"instruction": "What is a lease for?", "input": "", "output": "It says who owns the queue, and until when; whoever holds it may commit.", "source": "s"}) + "\n")
    (tmp_path / "c.yaml").write_text(f"name: n\nsources: [{{name: mine, collector: jsonl, options: {{path: {tmp_path / 'pairs.jsonl'}}}}}]\n")
    assert cli.main(["--config", str(tmp_path / "c.yaml"), "--all", "--out", str(tmp_path / "out"), "--format", "alpaca"]) == 0
    assert spark.read.json(str(tmp_path / "out" / "mine_alpaca")).count() == 1
    assert cli.main(["--config", str(tmp_path / "c.yaml"), "--stages", "all", "--out", str(tmp_path / "made")]) == 0
    assert "collect: done" in capsys.readouterr().out and spark.read.json(str(tmp_path / "made" / "n-1")).count() == 1


def test_many_forbidden_prefixes(spark):
    from lathework.operators import linkgraph

    urls = spark.createDataFrame([("http://h/b/x",), ("http://h/c",), ("http://h/bb",), ("http://x/b",)], "url string")
    none = urls.limit(0)
    barred = spark.createDataFrame([("h", "/b"), ("h", "/bb"), ("h", "/c/d"), ("x", "/")], "host string, prefix string")
    few, many = (sorted(r["url"] for r in linkgraph.allowed(urls, none, barred, "h", most=most).collect()) for most in (100, 1))
    assert few == many == ["http://h/c"]
