"""Named files, Word documents, recorded responses, files from several places, keyword automata."""

import io
import os
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestream.functions import docx
from lodestream.functions import text as T
from lodestream.operators import keywords, profiles
from lodestream.plans import more
from lodestream.sources import files


def test_files_are_written_whole_or_not_at_all(spark, tmp_path):
    rows = spark.range(20).select(F.format_string("f%02d é.txt", "id").alias("name"), F.encode(F.concat(F.lit("text "), "id"), "UTF-8").alias("content")).repartition(4)
    folder = str(tmp_path / "out")
    files.save_files(rows, folder)
    assert sorted(os.listdir(folder)) == ["_SUCCESS", *sorted(f"f{i:02d} é.txt" for i in range(20))]
    assert (tmp_path / "out" / "f07 é.txt").read_text() == "text 7"
    files.save_files(rows.where("name like 'f01%'"), folder, "overwrite")
    assert sorted(os.listdir(folder)) == ["_SUCCESS", "f01 é.txt"]
    files.save_files(rows.limit(0), folder)
    assert sorted(os.listdir(folder)) == ["_SUCCESS", "f01 é.txt"]


@pytest.mark.parametrize("bad", ["CASE WHEN id = 13 THEN NULL ELSE concat('f', id) END", "CASE WHEN id = 13 THEN '../x' ELSE concat('f', id) END", "'same'", "CASE WHEN id = 13 THEN raise_error('no') ELSE concat('f', id) END"])
def test_a_failed_job_leaves_nothing(spark, tmp_path, bad):
    rows = spark.range(0, 20, 1, 4).select(F.expr(bad).cast("string").alias("name"), F.encode(F.lit("x"), "UTF-8").alias("content"))
    folder = tmp_path / "out"
    (folder / "sub").mkdir(parents=True)
    (folder / "kept").write_text("k")
    with pytest.raises(Exception):
        files.save_files(rows, str(folder), "overwrite")
    assert sorted(os.listdir(folder)) == ["kept", "sub"]


def test_files_in_parts(spark, tmp_path):
    rows = lambda lo, hi, tail="": spark.range(lo, hi).select(F.format_string("f%03d é", "id").alias("name"), F.encode(F.concat(F.lit("text "), "id", F.lit(tail)), "UTF-8").alias("content")).repartition(3)
    folder = str(tmp_path / "out")
    there = lambda: {r.name: bytes(r.content).decode() for r in files.load_files(spark, folder).collect()}
    files.save_files(rows(0, 50), folder, folders=4)
    assert sorted(os.listdir(folder)) == ["_SUCCESS", *(f"part-{i:05d}-of-00004" for i in range(4))]
    assert there() == {f"f{i:03d} é": f"text {i}" for i in range(50)}
    files.save_files(rows(40, 60, "!"), folder, folders=4)
    assert there() == {f"f{i:03d} é": f"text {i}" + "!" * (i >= 40) for i in range(60)}
    with pytest.raises(Exception, match="4 parts, not 0"):
        files.save_files(rows(0, 3), folder)
    with pytest.raises(Exception, match="4 parts, not 5"):
        files.save_files(rows(0, 3), folder, folders=5)
    files.save_files(rows(0, 9), folder, "overwrite", folders=5)
    assert len(there()) == 9 and not [x for x in os.listdir(folder) if x.endswith("-of-00004")]
    files.save_files(rows(0, 3), folder, "overwrite")
    assert sorted(os.listdir(folder)) == ["_SUCCESS", "f000 é", "f001 é", "f002 é"] and len(there()) == 3
    files.save_files(rows(3, 5), folder, "overwrite", folders=2)
    assert there() == {"f003 é": "text 3", "f004 é": "text 4"}


@pytest.mark.parametrize("folders", [0, 1, 4])
def test_one_name_of_two_tasks_leaves_nothing(spark, tmp_path, folders):
    rows = spark.range(0, 20, 1, 4).select(F.concat(F.lit("f"), F.col("id") % 19).alias("name"), F.encode(F.lit("x"), "UTF-8").alias("content"))
    spark.dataSource.register(files.Files)
    for write in (lambda x: rows.write.format("files").option("folders", folders).mode("append").save(x), lambda x: files.save_files(rows, x, folders=folders)):
        with pytest.raises(Exception):
            write(str(tmp_path / "out"))
        assert os.listdir(tmp_path / "out") == []
    rows.where("id < 19").write.format("files").option("folders", folders).mode("append").save(str(tmp_path / "out"))  # parts that several tasks wrote
    assert files.load_files(spark, str(tmp_path / "out")).count() == 19


def test_the_driver_moves_folders(tmp_path, monkeypatch):
    """The work of a commit must not grow with the number of files."""
    moves, opened = [], files._open

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            if name == "move":
                moves.append(name)
            return getattr(self.inner, name)

    monkeypatch.setattr(files, "_open", lambda path: (Counted(opened(path)[0]), opened(path)[1]))
    task = type("Task", (), {"partitionId": lambda self: 0, "taskAttemptId": lambda self: 7})
    monkeypatch.setattr(files.TaskContext, "get", lambda: task())
    row = type("Row", (), {"content": b"x"})
    for n in (100, 400):
        moves.clear()
        writer = files.FileWriter(str(tmp_path / f"out{n}"), False, 4)
        writer.commit([writer.write(type("Row", (row,), {"name": f"f{i}"}) for i in range(n))])
        assert len(moves) == 4
        assert sum(len(x) for _, _, x in os.walk(tmp_path / f"out{n}")) == n + 1


def test_written_applications_are_listed_by_tasks(spark, sf_dir):
    df = more.queries()["application_documents"](spark, sf_dir.replace("0.001", "0.01"))
    assert not df.inputFiles() and df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert df.count() == 255


def test_documents_open_as_office_files(spark):
    p = docx.paragraph(docx.run(F.lit("A <b> & \"c\"\x01"), 36, "2B5C6E", bold=True), docx.run(F.lit(" end "), italics=True), before=10, rule=True)
    df = spark.range(2).select(F.array(p, docx.paragraph(rule=True)).cast(docx.PARAGRAPHS).alias("p")).select(docx.document("p").alias("d"))
    a, b = (bytes(r.d) for r in df.collect())
    assert a == b
    with zipfile.ZipFile(io.BytesIO(a)) as z:
        assert z.testzip() is None and {"[Content_Types].xml", "_rels/.rels", "word/document.xml", "word/styles.xml"} <= set(z.namelist())
        xml = z.read("word/document.xml").decode()
    assert '<w:b/><w:color w:val="2B5C6E"/><w:sz w:val="36"/>' in xml and "<w:pBdr>" in xml and "A &lt;b&gt; &amp;" in xml
    assert docx.unpacked(a) == ['A <b> & "c" end ', ""] and docx.unpacked(b"no zip") is None
    assert spark.createDataFrame([(bytearray(a),), (bytearray(b"x"),), (None,)], "d binary").select(docx.document_texts("d").alias("t")).collect()[1:] == [(None,), (None,)]


def test_applications_of_odd_configs(spark):
    rows = [("a", 1, '{"company_name": "X & Y", "gaps": ["bare", {"requirement": "r", "question": "q?"}]}'), ("b", 2, '{"company_name": "X - Y"}'), ("c", 3, None), ("d", 4, "{}"), ("e", 5, "no json"), ("d", 6, '{"cv": {"jobs": {}}, "suggestions": {"summary": {"has_suggestions": true, "items": []}}}')]
    configs = spark.createDataFrame(rows, "entity_name string, pool_pos long, config string")
    made = profiles.application_documents(configs, F.lit("2026-01-31"))
    got = {r.name: r.content for r in made.where("name like '%docx'").collect()}
    assert set(got) == {"CV_X_Y_tailored.docx", "SUGGESTIONS_X_Y.docx", "CV_d_tailored.docx", "SUGGESTIONS_d.docx"}
    assert len(docx.unpacked(bytes(got["SUGGESTIONS_X_Y.docx"]))) == 2  # the later of two that make one name
    status = {(r.entity_name, r.status) for r in profiles.application_summary(configs, made).collect()}
    assert status == {("a", "error"), ("b", "success"), ("c", "error"), ("d", "error"), ("d", "success"), ("e", "error")}


@pytest.fixture
def recording(spark, tmp_path):
    path = str(tmp_path / "answers")
    spark.range(1000).select(F.format_string("https://h%d.org/%04d", F.col("id") % 3, "id").alias("url"), F.when(F.col("id") % 10 == 0, 404).otherwise(200).alias("http_status"), F.when(F.col("id") % 2 == 0, "HEAD").otherwise("GET").alias("method"), F.concat(F.lit("b"), "id").alias("body")).orderBy("url").coalesce(1).write.option("parquet.block.size", 4096).parquet(path)
    return path


def test_filters_reach_the_scan_of_responses(spark, recording):
    every = files.responses(spark, recording)
    assert every.count() == 1000 and every.columns == ["url", "method", "http_status", "body"]
    one = every.where("url = 'https://h1.org/0001'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan, plan  # nothing is left for Spark to filter
    assert [tuple(r) for r in one.collect()] == [("https://h1.org/0001", "GET", 200, "b1")]
    assert every.where(F.col("url").startswith("https://h2")).count() == 333
    assert every.where(F.col("url").isin("https://h2.org/0002", "x")).where("http_status = 200").count() == 1
    assert every.where("url is not null and method = 'HEAD'").count() == 500
    assert files.responses(spark, recording, "url string").where("url like 'https://h0%'").count() == 334


def test_pushed_filters_prune_row_groups(recording):
    reader = files.ResponseReader({"path": recording}, files.Responses.schema(None) and type("S", (), {"fields": [type("F", (), {"name": n})() for n in ("url", "body")]})())
    whole = sum(len(p.groups) for p in reader.partitions())
    list(reader.pushFilters([files.StringStartsWith(("url",), "https://h2")]))
    some = sum(len(p.groups) for p in reader.partitions())
    assert 0 < some < whole or whole == 1
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 333


def test_fetched(spark, recording):
    items = spark.createDataFrame([(1, "https://h1.org/0001"), (2, "https://h1.org/0010"), (3, "https://nowhere"), (4, None), (5, "https://h2.org/0005")], "k long, url string")
    got = {r.k: (r.http_status, r.body, r.error) for r in files.fetched(items, files.responses(spark, recording)).collect()}
    assert got == {1: (200, "b1", None), 2: (None, None, "no answer"), 3: (None, None, "no answer"), 4: (None, None, "no answer"), 5: (200, "b5", None)}
    head = {r.k: r.error for r in files.fetched(items, files.responses(spark, recording), "HEAD").collect()}
    assert head[2] == "HTTP 404"


def test_first_of_several_places(spark, tmp_path):
    for name, text in {"a.md": "outer a", "cv/a.md": "inner a", "cv/b.md": "inner b é", "cv/M.md": "inner M", "M.md": "outer M", "other.md": "x"}.items():
        path = tmp_path / "src" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    got = {r.name: (r.place, r.content) for r in files.cv_files(spark, str(tmp_path / "src"), ["a.md", "b.md", "M.md", "pool.json", "none.md"], ("M.md",), {"pool.json": "{}"}).collect()}
    assert got == {"a.md": ("a.md", "outer a"), "b.md": ("cv/b.md", "inner b é"), "M.md": ("cv/M.md", "inner M"), "pool.json": (None, "{}"), "none.md": (None, "")}


def plain_counts(text, keyword):
    found = keyword.lower() in text.lower()
    return len(re.findall(rf"\b{re.escape(keyword.lower())}\b", text.lower(), re.A)) if found else None


@pytest.mark.parametrize("seed", range(5))
def test_keywords_against_regular_expressions(spark, seed):
    rnd = random.Random(seed)
    pieces = ["New", "york", " ", " ", "-", ".", "c++", "ab", "aba", "_", "1", "(x)", "É", "the"]
    texts = ["".join(rnd.choice(pieces) for _ in range(40)) for _ in range(30)]
    words = sorted({"".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 4))) for _ in range(60)} | {"New York", "aba", "c++", "ab ab", " ", "é"})
    docs = spark.createDataFrame([*enumerate(texts), (98, None), (99, "")], "doc_id long, text string")
    table = spark.createDataFrame([(w,) for w in words] + [("aba",), ("",), (None,)], "keyword string")
    want = {(i, w, n) for i, t in enumerate(texts) for w in words if (n := plain_counts(t, w)) is not None}
    assert {tuple(r) for r in keywords.keyword_counts(docs, table).collect()} == want
    assert {tuple(r) for r in keywords.keyword_counts(docs, table, most=25).collect()} == want  # several automata


def test_keywords_agree_with_the_expression(spark):
    text = "The cat, the CAT; concat the_cat cat's the  cat"
    found = dict(keywords.Matcher(["cat", "the cat", "the"]).counts(text))
    row = spark.range(1).select(*(T.count_occurrences(F.lit(text), F.lit(k)).alias(k.replace(" ", "_")) for k in found)).first()
    assert found == {k: row[k.replace(" ", "_")] for k in found} == {"cat": 4, "the cat": 2, "the": 3}


def test_no_keywords(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "keyword string")
    assert keywords.keyword_counts(docs, none).count() == 0
    assert keywords.keyword_coverage(keywords.keyword_counts(docs, none), none).count() == 0
    plan = keywords.keyword_counts(docs, spark.createDataFrame([("text",)], "keyword string"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
