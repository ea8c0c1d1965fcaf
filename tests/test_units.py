"""Small cases worked out by hand."""

from pyspark.sql import functions as F

from lodestream.functions import text as T
from lodestream.functions import urls as U
from lodestream.operators import bundle, content, pages, qa, urls
from lodestream.plans import catalog
from lodestream.sources import discovery
from lodestream.streaming import incremental


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_urls(spark):
    norm = lambda u: value(spark, U.normalize(F.lit(u)))
    assert norm("https://www.Ex.com/A/?utm_source=x#t") == "https://ex.com/a"
    assert norm("ex.com/a/") == "https://ex.com/a"
    assert norm("http://") == "http:"
    assert value(spark, U.resolve(F.lit("https://a.org/x/y?q=1"), F.lit("z.html"))) == "https://a.org/x/z.html"
    assert value(spark, U.unwrap_archive(F.lit("https://web.archive.org/web/2020id_/https://a.org/x"))) == "https://a.org/x"
    assert value(spark, U.is_junk(F.lit("https://a.org/x.PDF"))) and not value(spark, U.is_junk(F.lit("https://a.org/x")))


def test_text(spark):
    assert value(spark, T.slugify(F.lit("Acme & Co. Ltd"))) == "acme-co-ltd"
    assert value(spark, T.slug_to_title(F.lit("online-casinos"))) == "Online Casinos"
    assert value(spark, T.decode_entities(F.lit("&amp;lt; &#233;&#x41;&nbsp;x"))) == "< éA x"
    assert value(spark, T.split_sentences(F.lit("We met Dr. Who in Rome. It was a fine day! No."))) == ["We met Dr. Who in Rome.", "It was a fine day!"]
    assert value(spark, T.is_claim(F.lit("It was founded in 1999 there."))) and not value(spark, T.is_claim(F.lit("Globally, 45% agree.")))
    assert value(spark, T.model_json(F.lit('Sure\n```json\n{"a": 1}\n```'))) == '{"a":1}'
    assert value(spark, T.model_json(F.lit("no"))) is None


def test_scores(spark):
    one = spark.createDataFrame([("e", "A [#1] and [#2] or [#9]. It was founded in 1999 by two people.", [1, 2])], "entity_name string, markdown string, sources array<int>")
    row = qa.citation_coverage(one).first()
    assert (row.citation_score, row.qa_pass, row.uncited_claims_count, row.broken_citations_count) == (0.5, False, 1, 1)
    votes = spark.createDataFrame([("e", v) for v in ["supported"] * 8 + ["partial", "unsupported"]], "entity_name string, verdict string")
    assert qa.hallucination_score(votes).first().hallucination_score == 0.85
    plan = '{"keywords_used": {"mid_tail": ["x", "q", "r", "s", "t"]}}'
    k = spark.createDataFrame([(1, "## y\n\nx", plan), (2, "## y\n\nx q", plan)], "id int, markdown string, plan string")
    assert [r.keyword_score for r in qa.keyword_sufficiency(k).orderBy("id").collect()] == [0.25, 0.4]
    cases = [("a", True, True, True, True, 10, 3, "failed"), ("b", True, False, True, True, 5, 0, "flag_manual"), ("c", True, True, True, True, 0, 0, "failed"), ("d", None, None, None, None, 4, 0, "flag_manual"), ("e", True, True, False, True, 9, 0, "loop_tone"), ("f", True, True, True, True, 9, 0, "approve")]
    rows = spark.createDataFrame([c[:7] for c in cases], "entity_name string, hallucination_ok boolean, citation_ok boolean, keyword_ok boolean, meta_ok boolean, source_count int, loop_count int")
    assert {r.entity_name: r.decision for r in qa.route(rows).collect()} == {c[0]: c[7] for c in cases}


def test_boilerplate(spark):
    shared = "This very block stands on both of the pages."
    items = spark.createDataFrame([("e", 1, f"{shared}\n\nOne page says this at some length, so that enough of it remains."), ("e", 2, f"{shared}\n\nshort")], "entity_name string, doc_id int, text_content string")
    rows = {r.doc_id: r for r in content.boilerplate_strip(items).collect()}
    assert rows[1].stripped_chars == len(shared) + 2 and not rows[1].flagged
    assert rows[2].flagged and rows[2].stripped_chars == 0


def test_html(spark):
    html = value(spark, bundle.markdown_to_html(F.lit("# T & U\ntext *em* [#1]\n\n- a\n- b")))
    assert html == '<h1>T &amp; U</h1>\n<p>text <em>em</em> <sup><a href="#cite-1">[1]</a></sup></p>\n<ul><li>a</li><li>b</li></ul>'


def test_inputs(spark):
    grouped = spark.createDataFrame([("", [("u1", "x"), (None, "y")])], "name string, items array<struct<url: string, entity_name: string>>")
    flat = spark.createDataFrame([("u2", None, "n"), ("u3", "", "")], "url string, entity_name string, name string")
    assert sorted(map(tuple, discovery.entity_items(grouped, flat).collect())) == [("n", "u2"), ("unknown", "u3"), ("x", "u1")]


def test_streaming(spark, tmp_path):
    rows = spark.sql("SELECT timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,id,0,0) AS ts, concat('https://a.org/', id % 3, if(id % 2 = 0, '/', '')) AS url, concat('e', id % 2) AS entity_name, if(id % 4 = 0, 'approve', 'loop_tone') AS decision FROM range(12)")
    rows.write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, out, mode in (("dedup", incremental.dedup_stream(stream), "append"), ("loops", incremental.loop_counts(stream), "update"), ("growth", incremental.pool_growth(stream), "update"), ("breaker", incremental.breaker_stream(stream.select("entity_name", F.expr("minute(ts) * 1L").alias("call"), F.lit(False).alias("ok")), "entity_name", "call"), "append")):
        q = out.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("dedup").count() == 3
    written = incremental.write_partial(stream.select("url", "entity_name"), str(tmp_path / "partial"), str(tmp_path / "c")).start()
    written.processAllAvailable()
    written.stop()
    assert spark.read.parquet(str(tmp_path / "partial")).count() == 12
    assert {r.entity_name: r.loop_count for r in spark.table("loops").collect()} == {"e0": 3, "e1": 6}
    assert {r["items"] for r in spark.table("growth").collect()} == {6}
    assert sorted((r.key, r.aborted) for r in spark.table("breaker").collect()) == [(k, a) for k in ("e0", "e1") for a in [False] * 3 + [True] * 3]


def test_caps(spark, tmp_path):
    """The operators cut where they are told to; their queries take everything."""
    links = lambda name, n: "".join(f'<a href="/{name}{i}">x</a>' for i in range(n))
    html = f"<body><nav>{links('n', 3)}</nav><p>{'word ' * 12_000}</p>{links('b', 250)}</body>"
    rows = [(i, f"https://a.org/en/{i}", html.replace('"/b', f'"/b{i}-').replace('"/n', f'"/n{i}-')) for i in range(35)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert pages.page_links(table, body=True).count() == 35 * 200
    assert pages.page_links(table, most=2).count() == 35 * 2
    pool = table.withColumn("entity_name", F.lit("a.org"))
    assert pages.deep_links(pool, ["/en/"]).count() == 30 * 50
    assert pages.deep_links(pool, ["/en/"], max_pages=2, per_page=4).count() == 8
    table.write.parquet(str(tmp_path / "pages.parquet"))
    run = lambda name: catalog.queries()[name](spark, str(tmp_path))
    assert run("page_links").count() == run("deep_links").count() == 35 * 253
    assert {r.word_count for r in run("extract_text").collect()} == {12_249}  # the paragraph's last word and the first link are joined
    assert {r.n for r in pages.page_items(table).select(F.length("text_content").alias("n")).collect()} == {50_000}


def test_logo_points(spark):
    """Name, dark, wide, vector and width; a favicon; a white one; a small icon."""
    rows = [("/dark-logo-wide.svg", "", "", "", 200), ("/favicon.ico", "", "", "", 16), ("/white-logo.png", "", "", "", 0), ("/x.png", "icon", "", "", 20)]
    df = spark.createDataFrame(rows, "src string, alt string, cls string, id string, width int")
    scores = [r[0] for r in df.select(bundle.logo_score(*(F.col(c) for c in ("src", "alt", "cls", "id", "width")))).collect()]
    assert scores == [10 + 5 + 5 + 3 + 2, -5 - 3 - 3, 10 - 5, -3 - 3]


def test_analysis_schemas(spark):
    """Plain texts, {slug, why} and {detail, source}; more than five tags; claims with sources."""
    docs = ['{"categories": {"primary": "games"}, "tags": {"existing": ["a", "b", "c", "d"], "suggested": ["e", "f", "g"]}, "key_facts": {"hq": "Rome", "employees": 5}, "source_citations": ["x", {"claim": "c", "sources": ["u", "v"]}]}', '{"key_facts": {"licenses": [{"detail": "L"}], "contact": {"email": "a@b.c", "phone": "1"}}}']
    got = bundle.analysis_flat(spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "entity_name string, analysis string")).orderBy("entity_name").collect()
    assert (got[0].primary_category, got[0].tags_preview, got[0].facts_preview) == ("games", "a, b, c, d, e (+2)", "Rome \u00b7 ~5 employees")
    assert got[0].source_citations_text == "1. x\n2. c \u2014 u, v" and got[0].tags_text == "Existing: a, b, c, d\nSuggested new: e, f, g"
    assert (got[1].primary_category, got[1].key_facts_text) == ("Unknown", "Licenses: L\nEmail: a@b.c, Phone: 1")


def test_liveness_challenge(spark):
    head = spark.createDataFrame([(u, 403) for u in "abcd"], "url string, http_status int")
    browser = spark.createDataFrame([("a", 200, "ok"), ("b", 200, "Just a moment..."), ("c", 500, "x" * 1001), ("d", None, None)], "url string, http_status int, body string")
    got = {r.url: r.status for r in urls.liveness(head.select("url"), head, browser).collect()}
    assert got == {"a": "kept", "b": "dead_link", "c": "kept", "d": "dead_link"}


def test_liveness_of_repeated_urls(spark):
    """Rows with one URL each have their own answer by id; by URL a row stays one row, whatever the answers."""
    items = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, url string")
    head = spark.createDataFrame([(1, "a", 200), (2, "a", 404), (3, "b", 403)], "id int, url string, http_status int")
    browser = spark.createDataFrame([(3, "b", None, None), (3, "b", 500, "x"), (3, "b", 500, "y" * 2000)], "id int, url string, http_status int, body string")
    by_id = urls.liveness(items, head.drop("url"), browser.drop("url"), by="id").collect()
    assert sorted((r.url, r.status, r.reason or "") for r in by_id) == [("a", "dead_link", "head 404"), ("a", "kept", ""), ("b", "dead_link", "browser 500")]
    by_url = urls.liveness(items.drop("id"), head.drop("id"), browser.drop("id")).collect()
    assert sorted((r.url, r.status) for r in by_url) == [("a", "kept"), ("a", "kept"), ("b", "dead_link")]


def test_meta_checks(spark):
    rows = [("a", "A good title of the right length, cut\u2026", "d" * 155, ["good", "d"]), ("b", None, None, ["x"]), ("c", "Same title as another entity has it", "e" * 155 + "x", ["e"]), ("d", "same TITLE as another entity has it", "f" * 155, ["same", "f"])]
    got = {r.entity_name: (r.checks_passed, r.checks_total) for r in qa.meta_compliance(spark.createDataFrame(rows, "entity_name string, title string, description string, head_terms array<string>")).collect()}
    assert got == {"a": (6, 7), "b": (0, 0), "c": (6, 7), "d": (6, 7)}


def test_numbering_across_ranges(spark):
    rows = spark.createDataFrame([("e", i * 3) for i in range(50)] + [("f", 7)], "entity_name string, pool_pos long")
    got = sorted((r.entity_name, r.pool_pos, r._i) for r in content.numbered(rows, step=10).collect())
    assert got == [("e", i * 3, i) for i in range(50)] + [("f", 7, 0)]
