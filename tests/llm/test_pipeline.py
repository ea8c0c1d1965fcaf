"""Each stage on a small table with nulls, repeats and ties, against plain Python; and the whole run on the smallest tables."""

import re

import pytest
import sentencepiece  # noqa: F401

import corpus_pipeline
from lodestream.llm import sentencepieces

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    import random

    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(n))


A, B, RUN = words(1, 80), words(2, 120), "\n".join(words(i, 20) for i in range(10, 14))
NEAR = " ".join(["another", *B.split()[1:]])
ROWS = [
    (1, A, "en", "s", 1), (2, A, "en", "s", 1), (3, B, "en", "t", 2), (3, A, "de", "t", 2), (3, B, "en", "t", 2), (None, NEAR, "fr", None, 3), (None, None, "en", "s", None), (4, "", "en", "s", 0), (4, "", "en", "s", 0),
    (5, "123 !!", "en", "s", 6), (6, f"x\n{RUN}\ny", "en", "s", 9), (7, f"z\n{RUN}\nw", "en", "s", 9), (8, f"{RUN}", "en", "s", 9), (9, words(3, 30), "de", "s", 9), (10, words(4, 70_000), "en", "s", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*(c.split()[0] for c in COLUMNS.split(", "))).collect())))


def test_language_id(spark, docs, sf_dir):
    kept = [r for r in ROWS if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert rows(corpus_pipeline.language_id(spark, docs, sf_dir)) == sorted(map(repr, kept))


def test_line_dedup(spark, docs, sf_dir):
    """Copies of a line and of a run of lines, of 50 words or more, go after the first; (3, B) twice is one document."""
    kept = [r if r[0] != 7 else (7, "z\nw", "en", "s", 3) for r in ROWS if (r[0], r[1]) not in {(2, A), (3, A), (8, RUN)}]
    assert rows(corpus_pipeline.line_dedup(spark, docs, sf_dir)) == sorted(map(repr, kept))


def test_near_duplicates(spark, docs, sf_dir):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = [shingles(r[1] or "") for r in ROWS]
    label = list(range(len(ROWS)))
    for _ in ROWS:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and len(x & y) * 100 >= 75 * len(x | y):
                    label[i] = label[j] = min(label[i], label[j])
    groups: dict = {}
    for r, g in zip(ROWS, label):
        groups.setdefault(g, []).append(r)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert rows(corpus_pipeline.near_duplicates(spark, docs, sf_dir)) == sorted(map(repr, kept))


def test_decontamination(spark, docs, sf_dir, tmp_path):
    spark.createDataFrame([(1, " ".join(A.split()[10:25]).upper()), (2, "x y"), (None, B)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def grams(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        return {tuple(w[i : i + 10]) for i in range(len(w) - 9)}

    bad = grams(" ".join(A.split()[10:25]))
    kept = [r for r in ROWS if not grams(r[1] or "") & bad]
    assert rows(corpus_pipeline.decontamination(spark, docs, str(tmp_path))) == sorted(map(repr, kept))


def test_encoding(spark, docs, sf_dir):
    """Giant and small texts alike against one search of the whole text; the ids decode to the text."""
    model = sentencepieces.load(spark)
    got = corpus_pipeline.encoding(spark, docs, sf_dir).collect()
    assert len(got) == len(ROWS)
    search = sentencepieces.Encoder(model.value)
    plain = sorted(repr((i, None if t is None else sentencepieces.data_ids(search.encode([t])[0]))) for i, t, *_ in ROWS)
    assert sorted(repr((r.doc_id, r.ids)) for r in got) == plain
    assert all((r.ids is None) == (r.n_tokens is None or r.n_tokens < 0) for r in got)


def test_empty_tables(spark, docs, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_stages_keep_the_columns_and_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= kept
        kept = now
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} == kept and all(len(r.ids) == r.n_tokens for r in out)
