from compare import connect, rows

from lathework.plans import catalog, roundtrips  # noqa: F401


def test_queries_equal_their_sql(spark, data):
    con = connect(data)
    bad = []
    for name, sql in catalog.ORACLE.items():
        if rows(catalog.QUERIES[name](spark, data).toPandas()) != rows(con.execute(sql).df()):
            bad.append(name)
    assert bad == []


#: Rows at the smallest scale of the queries that SQL can't express; each is also tested by itself.
WITHOUT_SQL = {n for n in catalog.QUERIES if n not in catalog.ORACLE}


def test_queries_without_sql_give_rows_that_make_sense(spark, data):
    frames = {name: catalog.QUERIES[name](spark, data).toPandas() for name in {*WITHOUT_SQL, "fn_clean_html", "gen_chunks", "agg_extract_stats"}}
    assert [n for n, f in frames.items() if not len(f)] == []
    texts = {"fn_html_to_md": "markdown", "fn_clean_page": "markdown", "fn_main_content": "content", "fn_content_select": "content", "fn_clean_html": "text"}
    for name, column in texts.items():
        assert len(frames[name]) == spark.read.parquet(f"{data}/pages.parquet").count() and (frames[name][column] != "").mean() > 0.8, name
    assert (frames["fn_clean_page"]["markdown"].str.len() <= frames["fn_html_to_md"]["markdown"].str.len()).all()
    chunks, sections = frames["gen_chunks"], catalog.QUERIES["gen_sections"](spark, data).toPandas()
    sections = sections[sections["content"] != ""]
    assert set(zip(chunks["doc_id"], chunks["section_no"])) == set(zip(sections["doc_id"], sections["section_no"]))
    assert frames["agg_extract_stats"]["chunks"][0] == len(chunks)
    kept = set(frames["dedup_near"]["seq"])
    assert kept <= set(spark.read.parquet(f"{data}/qa_pairs.parquet").toPandas()["pair_id"]) and len(kept) > 100
    assert set(frames["flt_public_func"]["name"]) <= set(frames["gen_functions"]["name"]) and not frames["flt_public_func"]["name"].str.startswith("_").any()
    assert (frames["gen_rst_examples"]["output"].str.len() >= 50).all()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_chunks_equal_their_sql_at_small_sizes(spark, data):
    from lathework.operators import sections

    con = connect(data)
    documents = spark.read.parquet(f"{data}/documents.parquet")
    for most, least in ((64, 16), (20, 10)):
        sql = catalog.ORACLE["gen_chunks"].replace(">= 1024", f">= {most}").replace(">= 512", f">= {least}")
        got = sections.split_chunks(documents, most=most, least=least).toPandas()
        assert got["chunk_no"].max() > 2 and rows(got) == rows(con.execute(sql).df())
