"""Phrases, token counts and spelling variants against plain versions; nulls, ties, repeats, long texts and empty tables."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestream.llm import phrases, spelling, token_counts
from lodestream.llm.queries import queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


def extra(df):
    """Columns whose names clash with those of the operators."""
    for name in ("n", "key", "phrase", "word", "rank", "a", "task", "n_tokens"):
        df = df.withColumn(name, F.lit(7))
    return df


# --- token counts

ODD_TEXTS = [None, "", " \n\t ", "a", "It's THEY'LL 'sound !!'s x'", "x<|endoftext|>y <|STARTOFTEXT|> <|startoftext|>", "á Étude é İstanbul ΣΣ ẞ", "line\u0085next word wide​zero", "\x1c\x1d a\x00b \x0b\x0c", "中文 한국 ไทย \U0001f600\U0001f468‍\U0001f469", "²¹½1234 ªºµ ×÷ ­ soft", "„quotes“ … — €5 ‰", "ﬁ Ω Å ̈́ क़"]


def test_token_counts_odd(spark, tokenizer):
    rows = [(i, t, "en") for i, t in enumerate(ODD_TEXTS)] + [(None, "twice", None), (None, "twice", None), (99, "word " * 300_000, "en"), (98, "x" * 5000, "en")]
    docs = extra(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = Counter(tuple(r) for r in token_counts.count_tokens(docs, public_tokenizers.path(token_counts.TOKENIZER), frequent=4).collect())
    def true(t):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        return len((t or "").encode()), n, n > 2048
    assert got == Counter((i, *true(t)) for i, t, _ in rows)
    assert token_counts.count_tokens(docs.limit(0), public_tokenizers.path(token_counts.TOKENIZER)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aAzZ'sS<|endoftext|> \n\tàÉßµ²½—'’́")), max_size=60))
def test_token_counts_of_any_text(tokenizer, text):
    assert token_counts.Lengths({}, tokenizer).tokens(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts_query_equals_the_library(spark, sf_dir, tokenizer):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {r.doc_id: len(e.ids) for r, e in zip(rows, tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False))}
    assert {r.doc_id: r.n_tokens for r in queries()["op12_token_counts"](spark, sf_dir).collect()} == want


def test_token_counts_do_not_depend_on_slices_or_caches(tokenizer):
    text = " ".join(random.Random(1).choice(["don't", "naïve", "x1y2", "—dash", "中", "a"]) for _ in range(3000))
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert sum(token_counts.Lengths({}, tokenizer, size=2).tokens(x) for x in token_counts.slices(text, 17)) == whole
    lengths = token_counts.Lengths({"don": 1, "a": 1}, tokenizer)
    assert lengths.tokens(text) == whole and "don" not in lengths.cache and lengths.asked == len(lengths.cache)


def test_frequent_keys_through_a_tree(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FAN", 3)
    docs = spark.createDataFrame([(i, "common " * 5 + f"rare{i}", "en") for i in range(40)], DOCS).repartition(20)
    assert token_counts.frequent_keys(docs, 2)[0] == "common"


# --- phrases


def plain_phrases(rows, max_words=3, least=10, share=50, top=2000):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in candidates.items():
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        inside = [b for (other, q), b in candidates.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= share * a for b in inside):
            score, _, left, rest = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, rest))
    return sorted((lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top], 1))


def phrase_rows(seed):
    rnd = random.Random(seed)
    words = ["New", "york", "city", "été", "a", "b", "c d", "x\x01", "<i>"]
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(rnd.randrange(60))) for _ in range(60)]
    return [(i, t, rnd.choice(["en", "en", "en", "fr", None])) for i, t in enumerate(texts)] + [(1, None, "en"), (1, "", None), (None, "New York City! " * 12, "en"), (None, "New York City! " * 12, "en"), (7, "only here", "de")]


@pytest.mark.parametrize("max_words, top", [(3, 2000), (4, 5), (2, 3)])
def test_phrases_against_a_plain_version(spark, max_words, top):
    rows = phrase_rows(max_words)
    docs = extra(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = phrases.collocations(docs, max_words, 10, 50, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_phrases(rows, max_words, top=top)
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_phrases_of_empty_tables_and_long_texts(spark, monkeypatch):
    docs = spark.createDataFrame(phrase_rows(1), DOCS)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null")).count() == 0
    monkeypatch.setattr(phrases, "BLOCK", 40)
    text = "one two three. four five, six seven eight nine ten eleven twelve thirteen fourteen" * 3
    assert "".join(phrases._parts(text, 40)) == text and len(list(phrases._parts(text, 40))) > 2


def test_phrases_of_one_very_long_text(spark):
    rows = [(1, "the old mill; the old house, the mill " * 160_000, "en")]
    assert sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, DOCS)).collect()) == plain_phrases(rows)


def test_phrase_scores_pass_64_bits(spark):
    """Counts as of a hundred terabytes."""
    big = 10**13
    one = spark.createDataFrame([("en", "", 4 * big), ("en", "a", big + 7), ("en", "b", big + 9)], "lang string, phrase string, n long")
    two = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, n long")
    row = phrases.scored([one, two], 4 * big).first()
    assert (row.l, row.r, row.score) == (big + 7, big + 9, 10**6 * big * big // ((big + 7) * (big + 9)))


# --- spelling variants


def plain_variants(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(x, y):
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        x, y = sorted((x, y), key=len)
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    form, count = {}, {}
    for w in n:
        ns = [x for x in n if x != w and near(w, x)]
        best = min(ns, key=lambda x: (-n[x], x), default=None)
        count[w], form[w] = len(ns), best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n.get(form[w])))
    return sorted(out, key=repr)


def spelled(seed):
    rnd = random.Random(seed)
    bases = ["banana", "letters", "étudiant", "aaaaaa", "garçons", "running"]
    words = [w for w in bases for _ in range(60)]
    for _ in range(25):
        w = rnd.choice(bases)
        for _ in range(rnd.randrange(1, 4)):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + rnd.choice("abcé") + w[i:], w[:i] + w[i + 1 :], w[:i] + rnd.choice("abcÿ") + w[i + 1 :]])
        words += [rnd.choice([str.upper, str.lower])(w) if w.isascii() else w] * rnd.choice([5, 6, 12])
    rnd.shuffle(words)
    rows = [(rnd.choice([i, None]), " ".join(words[lo : lo + 40]), "en") for i, lo in enumerate(range(0, len(words), 40))]
    return [*rows, rows[0], (1, None, None), (2, "", None), (3, "×÷×÷×÷ " * 5, "en"), (4, "abcdef" * 30_000, "en"), (5, "1a2b3c", "en")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_against_a_plain_version(spark, seed):
    rows = spelled(seed)
    docs = extra(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = spelling.group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")
    want = plain_variants(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_variants_follow_forms_to_the_last(spark):
    """A chain of six steps, each at least fivefold, and damaged runs."""
    chain = ["abcdefgh"[:i] + "z" * (8 - i) for i in range(7)]
    counts = [5 * 5**i for i in range(7)]
    v = spark.createDataFrame(list(zip(chain, counts)), "word string, n long")
    near = {r.word: (r.n_near, r.near_word) for r in spelling.neighbours(v).collect()}
    assert near[chain[0]] == (1, chain[1]) and near[chain[3]] == (2, chain[4]) and near[chain[6]] == (1, chain[5])
    from lodestream.llm.common import Tables

    forms = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms, Tables(spark)).collect()} == dict.fromkeys(chain[:-1], chain[-1])


def test_variants_of_empty_tables_and_ties(spark):
    docs = spark.createDataFrame(spelled(1), DOCS)
    assert spelling.group_variants(docs.limit(0)).count() == 0
    v = spark.createDataFrame([("aaaaaaa", 5), ("aaaaaab", 50), ("aaaaaac", 50), ("aaaaaa", 50)], "word string, n long")
    assert {r.word: (r.n_near, r.near_word, r.near_n) for r in spelling.neighbours(v).collect()} == {
        "aaaaaaa": (3, "aaaaaa", 50), "aaaaaab": (3, "aaaaaa", 50), "aaaaaac": (3, "aaaaaa", 50), "aaaaaa": (3, "aaaaaab", 50),
    }
