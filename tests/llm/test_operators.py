"""Operators against their SQL, brute force, round trips and held-out accuracy; and nulls, ties, repeats, empty tables."""

import re

import pytest
from conftest import against_sql
from pyspark.sql import functions as F

from lodestream.llm import decontaminate, html_text, jaccard_join, langid, line_dedup, media, preference, sentencepieces, shard, toxicity
from lodestream.llm.queries import oracle_sql, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "one two three four five six seven eight nine ten eleven", "en", "s", 1), (3, "one two three four five six seven eight nine ten eleven", "en", "s", 1), (4, "ÀÉ 123 !!!", "fr", None, 9), (None, "x " * 40_000, "en", "s", 9), (5, "\n\n\n", "de", "s", 3)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("rid", F.lit(1)).withColumn("k", F.lit(2)).withColumn("sig", F.lit("x")).withColumn("score", F.lit(0.5))


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    ours, theirs = against_sql(spark, sf_dir, queries()[name], oracle_sql()[name])
    assert ours == theirs


def test_decontaminate_odd(spark, odd, none):
    items = spark.createDataFrame([(7, "TWO three four"), (8, None), (None, "one"), (9, "nothing of this kind"), (7, "two three four")], "item_id long, text string")
    rows = decontaminate.decontaminate(odd, items).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows if r.doc_id in (1, 3)} == {(1, 0, 0, ()), (3, 11, 3, ("7",))}
    assert decontaminate.decontaminate(none, items).count() == 0
    assert decontaminate.decontaminate(odd, items.limit(0)).where("contaminated").count() == 0


def test_line_dedup_odd(spark, odd, none):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == len(ODD) and {r.n_deleted for r in rows} == {0} and "sig" in rows[0].asDict()
    assert line_dedup.dedup_lines(none).count() == 0
    run = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(4))
    docs = spark.createDataFrame([(1, f"a\n{run}\nb"), (2, f"c\n{run}\nd"), (3, f"{run}\n{run}")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {1: f"a\n{run}\nb", 2: "c\nd", 3: ""}


def test_jaccard_odd(spark, odd, none):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard_join.link(odd).collect())
    assert got == [(-1, 1, -1), (1, 0, 1), (2, 0, 2), (3, 7, 3), (3, 7, 3), (4, 1, 4), (5, 0, 5)]
    assert jaccard_join.link(none).count() == 0


def test_jaccard_chain(spark):
    """Near copies of near copies are one component; brute force over all pairs."""
    import random

    rnd = random.Random(3)
    text = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        text = list(text)
        text[rnd.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(text)))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(116)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r.component_id for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == label


def test_jaccard_shared_passages(spark, monkeypatch):
    """A passage makes up most of many texts, of which few are similar, in one group and in many; brute force over all pairs."""
    import random

    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"t{i % 40 if i % 7 else i}x{j}" for j in range(rnd.randrange(8, 20))])) for i in range(150)]
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for group in (1 << 19, 64):
        monkeypatch.setattr(jaccard_join, "GROUP", group)
        assert {r.doc_id: r.component_id for r in jaccard_join.link(docs).collect()} == label
    assert 5 < len(set(label.values())) < 140


def test_langid(spark, sf_dir, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    out = langid.predict(docs, model).where("crc32(cast(doc_id as string)) % 5 = 0")
    assert out.where("lang = lang_pred").count() >= 0.97 * out.count()
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert got[1] == got[2] == got[5] == ("und", 0.0) and got[4][0] != "und"
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}


def test_langid_against_a_plain_version(spark, sf_dir):
    """Every document's language and score, counted and scored by plain Python."""
    import math
    import zlib
    from collections import Counter

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts: dict = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(langid.LETTERS.findall(r.text.lower()))
    langs = sorted(counts)
    tables = [{la: Counter() for la in langs} for _ in range(5)]
    for la in langs:
        for w, n in counts[la].items():
            if n >= 3:
                tables[0][la][w] = n
            for k in range(1, 5):
                for i in range(len(w) + 3 - k):
                    tables[k][la][f"^{w}$"[i : i + k]] += n
    keys = [set().union(*t.values()) for t in tables]
    total = [{la: sum(t[la].values()) + 0.1 * len(ks) for la in langs} for t, ks in zip(tables, keys)]

    def score(w, la):
        if w in keys[0]:
            return math.log((tables[0][la][w] + 0.1) / total[0][la])
        for k in range(4, 0, -1):
            known = [g for i in range(len(w) + 3 - k) if (g := f"^{w}$"[i : i + k]) in keys[k]]
            if known:
                return sum(math.log((tables[k][la][g] + 0.1) / total[k][la]) for g in known) / len(known)
        return 0.0

    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.query(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        words = langid.LETTERS.findall((r.text or "").lower())
        if not words:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        sums = [math.fsum(score(w, la) for w in words) for la in langs]
        best = max(sums)
        assert got[r.doc_id][0] == langs[sums.index(best)]
        assert math.isclose(got[r.doc_id][1], 1 / sum(math.exp(x - best) for x in sums), rel_tol=1e-6)


def test_backoff_prefers_words():
    import numpy as np
    import pyarrow as pa

    of = {0: {"word": (-1.0, -9.0)}, 4: {"^wor": (-9.0, -1.0)}, 3: {}, 2: {}, 1: {"q": (-2.0, -8.0)}}
    model = {"langs": ["a", "b"]} | {k: (pa.array(list(d), pa.string()), np.array(list(d.values())).reshape(-1, 2)) for k, d in of.items()}
    scores = langid.Scores(model)
    assert scores.of("word")[0] == "a" and scores.of("worst")[0] == "b" and scores.of("qz")[0] == "a"


def test_language_scores_take_little_memory():
    """Workers keep what they took for the pipeline's later stages: no object for each score."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    grams = {4: ["^abc"], 3: [], 2: [], 1: list("abcdefghijklmnop")}
    known = [f"known{i}" for i in range(10_000)]
    model = {"langs": list("wxyz")} | {k: (pa.array(g, pa.string()), -1.0 - np.arange(4.0 * len(g)).reshape(-1, 4) / 7) for k, g in (grams | {0: known}).items()}
    words = ["".join(chr(97 + (i >> 4 * k) % 16) for k in range(5)) for i in range(20_000)]
    tracemalloc.start()
    scores = langid.Scores(model)
    for w in words:
        scores[w]
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(scores) == 30_000 and taken < 190 * 30_000
    rows = model[1][1].tolist()
    assert list(scores.rows[scores["abdca"]]) == [sum(x) / 5 for x in zip(*(rows["abcdefghijklmnop".index(c)] for c in "abdca"))]


@pytest.fixture(scope="module")
def pieces(spark):
    return sentencepieces.load(spark)


def test_sentencepieces_round_trip(spark, pieces, odd, none):
    out = sentencepieces.decode(sentencepieces.encode(odd, pieces, giant=1000, chunk=64), pieces)
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(str(r[1]) for r in ODD)
    assert sentencepieces.encode(none, pieces).count() == 0


@pytest.mark.parametrize("chunk", [3, 17, 64])
def test_scan_gives_the_same_ids(pieces, chunk, monkeypatch):
    """Chunked or by words, whatever the chunk, and with many equally good segmentations."""
    import random

    monkeypatch.setattr(sentencepieces, "SEGMENT", 4)
    rnd = random.Random(chunk)
    m, words = pieces.value, ["the", "aaaaaaaaaaaa", "------", "1234567890", "über", "梦梦", "quick", "\n", "", "jumps,", "ababababa"]
    texts = ["The quick  brown fox jumps, ----------- über 1234567890 梦梦 \n x", "a" * 190, *("".join(rnd.choice("ab -1") for _ in range(150)) for _ in range(20)), *(" ".join(rnd.choices(words, k=40)) for _ in range(20))]
    for text in texts:
        s = m.prefix + text.replace(" ", sentencepieces.MARK)
        parts, sizes = [s[i : i + chunk + m.longest - 1] for i in range(0, len(s), chunk)], [min(chunk, len(s) - i) for i in range(0, len(s), chunk)]
        states = sentencepieces.boundary_states(sentencepieces.transfers(m, parts, sizes))
        scanned = sentencepieces.data_ids(b"".join(sentencepieces.backtrace(m, p, a, b, n) for p, (a, b), n in zip(parts, states, sizes)))
        assert scanned == sentencepieces.data_ids(sentencepieces.Encoder(m).encode([text])[0])
        assert b"".join(m.bytes[i] for i in scanned)[1:].decode() == text


def test_giants_get_the_same_ids(spark, pieces, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    by_word = {r.doc_id: r.ids for r in sentencepieces.encode(docs, pieces).collect()}
    assert by_word == {r.doc_id: r.ids for r in sentencepieces.encode(docs, pieces, giant=2000, chunk=128).collect()}


def test_search_is_the_best(pieces):
    """Against every segmentation of short words."""
    m = pieces.value
    value = {m.bytes[i].decode("utf-8", "replace").replace(" ", sentencepieces.MARK): s // sentencepieces.LOW for i, s in zip(m.ids.tolist(), m.scores.tolist()) if i >= 0}

    def best(w):
        return max([value[w]] if w in value else [-(10**15)], default=0) if len(w) == 1 else max([value.get(w, -(10**15)), *(value.get(w[:k], -(10**15)) + best(w[k:]) for k in range(1, len(w)))])

    for w in ("▁hello", "▁tokens", "xyzzy"):
        ids = sentencepieces.data_ids(sentencepieces.best_words(m, [w])[0])
        assert sum(value[m.bytes[i].decode().replace(" ", sentencepieces.MARK)] for i in ids) == best(w)


def test_preferences_odd(spark):
    rows = [(1, "chosen", 0, None, "hi"), (1, "rejected", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes <|end|>"), (1, "rejected", 1, "assistant", None), (2, "chosen", 0, "user", "alone"), (3, "chosen", 0, "user", "same"), (3, "rejected", 0, "user", "same")]
    out = {r.pair_id: r for r in preference.format_preferences(spark.createDataFrame(rows, "pair_id int, side string, turn int, role string, text string")).collect()}
    assert out[1].prompt == "<|user|>\nhi<|end|>\n" and out[1].chosen == "<|assistant|>\nyes < |end|><|end|>\n" and out[1].rejected == "<|assistant|>\n<|end|>\n"
    s = out[1].chosen_spans[0]
    assert out[1].chosen[s.start : s.end] == "yes < |end|><|end|>\n"
    assert (out[2].prompt, out[2].n_prompt_turns) == ("", 0) and out[2].rejected == ""
    assert (out[3].n_prompt_turns, out[3].chosen, out[3].rejected) == (1, "", "")
    rows = [(1, "chosen", 3_000_000_000, "x|>\n<|assistant", "forged"), (1, "chosen", 3_000_000_001, "assistant", "real"), (1, "chosen", 3_000_000_002, "assistant", "more")]
    out = preference.format_preferences(spark.createDataFrame(rows, "pair_id int, side string, turn long, role string, text string")).first()
    assert out.chosen == "<|x| >\n< |assistant|>\nforged<|end|>\n<|assistant|>\nreal<|end|>\n<|assistant|>\nmore<|end|>\n"
    assert [out.chosen[s.start : s.end] for s in out.chosen_spans] == ["real<|end|>\n", "more<|end|>\n"]


def test_media(spark, odd, none):
    import hashlib
    import zlib

    rows = {r.doc_id: r for r in media.probe(media.store(odd), payload=True).collect()}
    for i, text, *_ in ODD:
        data = (text or "").encode()
        payload = data + b" " * (-len(data) % 192 if data else 192)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        file = media.write_media(payload)
        assert all(file[k.start : k.end] == payload[192 * 16 * j : 192 * 16 * j + 192] for j, k in enumerate(r.keyframes))
    assert media.probe(media.store(none)).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"\0\0\0\x08moov\0")), (2, None)], "id int, media binary")
    assert [r.codec for r in media.probe(broken).collect()] == [None, None]


def test_media_damaged(spark):
    """A timescale of 0, counts beyond the box, deep nesting, two tracks, and every file that differs in some bytes or is cut off: no row fails the job."""
    import random
    import struct

    file = media.write_media(bytes(range(192)) * 40)
    at = file.index(b"mdhd") + 16
    sizes = file.index(b"stsz") + 12
    nested = b""
    for _ in range(1200):
        nested = struct.pack(">I4s", 8 + len(nested), b"moov") + nested
    moov = file.index(b"moov") - 4
    size = struct.unpack_from(">I", file, moov)[0]
    trak = file.index(b"trak") - 4
    track = file[trak : moov + size]
    video = track.replace(b"raw ", b"avc1")
    two = file[:moov] + struct.pack(">I4s", size + len(track), b"moov") + file[moov + 8 : moov + size] + video + file[moov + size :]
    cases = [file[:at] + bytes(4) + file[at + 4 :], file[:sizes] + b"\xff" * 4 + file[sizes + 4 :], nested, two]
    rnd = random.Random(1)
    for _ in range(400):
        broken = bytearray(file if rnd.random() < 0.7 else file[: rnd.randrange(len(file))])
        for _ in range(rnd.randrange(1, 4)):
            if len(broken):
                broken[rnd.randrange(min(len(broken), 800))] = rnd.randrange(256)
        cases.append(bytes(broken))
    rows = media.probe(spark.createDataFrame([(i, bytearray(c), "x") for i, c in enumerate(cases)], "id int, media binary, tracks string"), payload=True).orderBy("id").collect()
    assert len(rows) == len(cases)
    assert (rows[0].codec, rows[0].duration_s, rows[0].n_samples) == ("raw ", None, 40)
    assert rows[1].codec is None and rows[1].media_bytes is None and rows[2].tracks == []
    assert rows[3].codec == "raw " and rows[3].n_samples == 40 and [t.codec for t in rows[3].tracks] == ["raw ", "avc1"]


def test_html():
    text = html_text.render("<title>t</title><p>a<b>b</b> &amp; c<p>d<br>e<ul><li>x<li>y<ol><li>z</ol></ul><table><tr><th>Name<th>N<tr><td>long name<td>1</table><div hidden>no</div><script>no</script>end")
    assert text == "ab & c\n\nd\ne\n\n- x\n- y\n  1. z\n\nName       N\nlong name  1\n\nend"
    assert html_text.render("") == "" and html_text.render("<p") == "<p" and html_text.render("</div>x</b>") == "x"
    assert html_text.render("<p>" * 5000 + "deep") == "deep" and html_text.render("<div>" * 5000 + "deep") == "deep"


def test_html_tables():
    text = html_text.render("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>f<td>g</table>")
    assert text == "a  b  c\n   d  e\nf     g"
    assert html_text.render(f"<table><tr><td>{'x' * 500}<td>1<tr><td>y<td>2</table>") == f"{'x' * 500}  1\ny  2"


def test_html_never_fails():
    """Known traps, tags in any order, pages cut off anywhere; and time in proportion to the page."""
    import random
    import time

    for page in ("<table><div><td><tr><td>x</table>", "<div><table><div><td>q<tr><td>r", "<ul><table><div><td><tr></ul>z", "<ol start=" + "9" * 5000 + "><li>&#" + "9" * 5000 + ";</ol>", "<td colspan=" + "9" * 5000 + ">", "<a b=\"<c>\" d=\"<e>\""):
        html_text.render(page)
    rnd = random.Random(2)
    tags = "table tr td th ul ol li div p b i select option details summary pre dd dl svg math h1 tbody span a".split()
    for _ in range(3000):
        page = "".join(rnd.choice((f"<{rnd.choice(tags)}>", f"</{rnd.choice(tags)}>", f"<{rnd.choice(tags)} class='x' rowspan=3>", "word ", "<", '"', "'", "&#65;", "<!--")) for _ in range(30))
        html_text.render(page)
        html_text.render(page[: rnd.randrange(len(page))])
    for piece in ('<a b="', "<a \"<b '", "<i><div>" + "<b>" * 50 + "</i>" * 50, "<ul><li>", "</p>", "<table><tr><td>", "<select>", "<!--", "<script>"):
        began = time.perf_counter()
        html_text.render(piece * (200_000 // len(piece)))
        assert time.perf_counter() - began < 10


def test_html_against_a_plain_renderer():
    """Well-formed pages of paragraphs, lists and tables, against a renderer by recursion."""
    import random

    rnd = random.Random(4)

    def words():
        return " ".join(rnd.choice("alpha beta gamma delta".split()) for _ in range(rnd.randrange(1, 5)))

    def items(depth, mark):
        source, lines, ordered = "", [], rnd.random() < 0.5
        for i in range(rnd.randrange(1, 4)):
            w, m = words(), f"{i + 1}. " if ordered else "- "
            lines.append(mark + m + w)
            inner = items(depth - 1, mark + " " * len(m)) if depth and rnd.random() < 0.5 else ("", [])
            source += f"<li>{w}{inner[0]}</li>"
            lines += inner[1]
        return f"<ol>{source}</ol>" if ordered else f"<ul>{source}</ul>", lines

    for _ in range(200):
        page, out = "", []
        for _ in range(rnd.randrange(1, 6)):
            kind = rnd.choice("plt")
            if kind == "p":
                w = words()
                page, part = f"{page}<p>{w.replace(' ', ' <b>', 1)}{'</b>' if ' ' in w else ''}</p>", w
            elif kind == "l":
                source, lines = items(2, "")
                page, part = page + source, "\n".join(lines)
            else:
                rows = [[words() for _ in range(3)] for _ in range(rnd.randrange(1, 4))]
                page += "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
                part = "\n".join("  ".join(c.ljust(max(len(r[i]) for r in rows)) for i, c in enumerate(r)).rstrip() for r in rows)
            out.append(part)
        assert html_text.render(page) == "\n\n".join(out)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_smallest_capacity(shards):
    import random

    rnd = random.Random(shards)
    for _ in range(50):
        sizes = [rnd.randint(1, 50) for _ in range(rnd.randint(1, 60))]
        capacity, cuts = shard.smallest_capacity(sizes, shards)
        best = next(c for c in range(max(sizes), sum(sizes) + 1) if _greedy(sizes, c) <= shards)
        bounds = [0, *cuts]
        assert capacity == best and cuts[-1] == len(sizes) and all(sum(sizes[a:b]) <= capacity for a, b in zip(bounds, cuts))


def _greedy(sizes, capacity):
    n, room = 1, capacity
    for s in sizes:
        if s > room:
            n, room = n + 1, capacity
        room -= s
    return n


def test_shards(spark, odd, none, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = shard.assign_shards(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    groups = docs.groupBy(F.md5("text").alias("g")).agg(F.sum(F.octet_length("text") + 1).alias("s")).orderBy("g").collect()
    assert max(sum(r.size for r in rows) for rows in by.values()) == shard.smallest_capacity([g.s for g in groups], 16)[0]
    monkeypatch.setattr(shard, "DRIVER_GROUPS", 5)
    again = shard.assign_shards(docs).collect()
    assert sorted((r.doc_id, r.shard) for r in again) == sorted((r.doc_id, r.shard) for r in out)
    assert shard.assign_shards(odd).count() == len(ODD) and shard.assign_shards(none).count() == 0


@pytest.mark.parametrize("share", [0.01, 1 / 3])
def test_shards_collect_few_groups(spark, monkeypatch, share):
    """One large group must not send the others to the driver."""
    n = 60_000
    small = spark.range(n).select(F.md5(F.col("id").cast("string").cast("binary")).alias("g"), F.lit(2000).cast("bigint").alias("size"))
    groups = small.unionByName(spark.createDataFrame([("5" * 32, int(n * 2000 * share / (1 - share)))], "g string, size bigint")).cache()
    collected, collect = [], type(groups).collect

    def counting(self):
        rows = collect(self)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(type(groups), "collect", counting)
    monkeypatch.setattr(shard, "DRIVER_GROUPS", 2_000)
    keys = shard.cut_keys(groups, 16)
    monkeypatch.undo()
    assert sum(collected) < 12_000
    rows = sorted(map(tuple, groups.collect()))
    loads = [0] * 16
    for g, size in rows:
        loads[sum(g > k for k in keys)] += size
    assert max(loads) == shard.smallest_capacity([size for _, size in rows], 16)[0]


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("length(text) < 3000")
    logp = spark.sparkContext.broadcast(toxicity.char_model(docs))
    model = toxicity.fit(docs, labels, logp)
    out = toxicity.score(docs, logp, model).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0")
    right = out.where((F.col("score") >= 0.5) == (F.col("toxic") == 1)).count()
    assert right >= 0.97 * out.count()
    assert toxicity.score(odd, logp, model).where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(none, logp, model).count() == 0
    assert {r.score for r in toxicity.score(odd, logp, toxicity.fit(none, labels, logp)).collect()} == {0.0}
    restore = toxicity.Restorer(logp.value).restore
    assert restore("s t u p i d") == "stupid" and restore("THE!! 108.51.216.133") == "the!! 108.51.216.133"
    assert re.fullmatch("l+o+s+e+r", restore("looooser"))


def test_viterbi_against_all_readings(spark, sf_dir):
    """The cost of the reading that is found is the least of all readings of the lattice."""
    import itertools

    logp = toxicity.char_model(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    restorer = toxicity.Restorer(logp)

    def cost(reading):
        a = b = 0
        total = 0.0
        for c, p in [*reading, (" ", 0.0)]:
            k = 0 if c == " " else int(toxicity._CODES[min(ord(c), 0x24F)]) if c else -1
            total += p
            if not (k < 0 or (k == 0 and b == 0)):
                total += restorer.cost[a][b][k]
                a, b = b, k
        return total

    for token in ("h3ll0", "1d10t", "s.t.u.p", "cooool", "@ss", "b4d", "w-0-w", "x", "ki11er", "f*n"):
        for pairs in (False, True):
            readings = list(itertools.product(*restorer.options(token, pairs)))
            least = min(map(cost, readings))
            found = [r for r in readings if "".join(c for c, _ in r).strip() == restorer.viterbi(token, pairs)]
            assert min(map(cost, found)) == pytest.approx(least)


def test_toxicity_against_a_plain_version(spark, sf_dir):
    """Every document's score: its text restored whole, its features looked up one by one."""
    import math

    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    logp = spark.sparkContext.broadcast(toxicity.char_model(docs))
    model = toxicity.fit(docs, labels, logp)
    restorer = toxicity.Restorer(logp.value)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.query(spark, sf_dir).collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        z = model["bias"] + math.fsum(model["weights"].get(f, 0.0) for f in toxicity.features(restorer.restore(r.text or "")))
        p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
        assert math.isclose(got[r.doc_id][0], p, rel_tol=1e-9, abs_tol=1e-12) and got[r.doc_id][1] == int(p >= 0.5)


def test_disguises(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) < 3000")
    restorer = toxicity.Restorer(toxicity.char_model(docs))
    for shown in ("5tupid", "stuupid", '"5tupid', "-5tupid", "stup1d", "s/t/u/p/i/d", "s,t,u,p,i,d", "s|t|u|p|i|d", "s  t  u  p  i  d", "s\nt\nu\np\ni\nd", "s t u p 1 d", "5tuup1d", "s. t. u. p. 1. d."):
        assert "stupid" in restorer.restore(f"You are {shown} today").split(), shown
        assert "stupid" in restorer.features(f"You are {shown} today"), shown
    for shown, word in (("1053r", "loser"), ("1 d 1 o t", "idiot"), ("ki11", "kill"), ("hat3", "hate"), ("d13", "die"), ("fool5", "fools"), ("pass", "pass")):
        assert word in restorer.restore(f"You {shown} now").split(), shown
    for same in ("in 1999 and 2001", "1 2 3 4", "! ! !"):
        assert restorer.restore(same) == same


def test_html_formulas_pictures_and_choices():
    render = html_text.render
    assert render("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds") == "so x=2 holds"
    assert render("<p>a <svg><title>t</title><desc>d</desc><defs/><path d='M0'/><text>label</text></svg> b") == "a label b"
    assert render("<p>size <select><option>S<option selected>M<option>L</select> only") == "size M only"
    assert render("<select><option>S</option><option>M</option></select>") == "S"
    assert render("<select multiple><option>S<option>M</select>") == "S\nM"


@pytest.mark.parametrize("page", ["<table><tr><td>x" * 13_000, "<table><tr>" + "<td colspan=1000>x" * 11_000, "<table>" + "".join(f"<tr><td rowspan={9000 - i}>x" for i in range(9000)), "<table>" + "".join(f"<td rowspan={9000 - i}>x" for i in range(6000)) + "<tr><td>y" * 6000, "<td>x" * 40_000, "a</p>" * 40_000, "<ol><li value=9>x" * 12_000])
def test_pages_of_tables_take_time_and_memory_by_their_size(page):
    import time
    import tracemalloc

    began = time.time()
    out = html_text.render(page)
    assert time.time() - began < 5  # under 2 on an idle machine
    assert out.count("x") == page.count(">x") and out.count("y") == page.count(">y")
    tracemalloc.start()
    html_text.render(page)
    assert tracemalloc.get_traced_memory()[1] < 200 * len(page)
    tracemalloc.stop()


def test_ends_of_no_paragraph_and_numbers_of_items():
    assert html_text.render("<p>text</p>after</p>more") == "text\n\nafter\n\nmore"
    assert html_text.render("<ol><li>a<li value=9>b<li>c<li value=x>d</ol>") == "1. a\n9. b\n10. c\n11. d"
    spans = html_text.render("<table><tr><th colspan=9>Head<th>Z<tr><td rowspan=2>a<td>bb<td>c<tr><td>d<td>e<tr><td>long cell<td>f</table>")
    assert spans == "Head              Z\na          bb  c\n           d   e\nlong cell  f"
    assert html_text.render("<table><tr><td>left<table><tr><td>i<td>j<tr><td>kk<td>l</table><td>right</table>after") == "left\n\ni   j\nkk  l\n\nright\n\nafter"


def test_toxicity_reads_long_tokens_in_linear_time():
    import time

    import numpy as np

    r = toxicity.Restorer(np.zeros((toxicity.ALPHABET,) * 3))
    began = time.time()
    for text in ("x1" + "!" * 60_000 + "a", "x1" + "!" * 60_000, "!a" * 30_000, "a " * 30_000, "a1" * 30_000):
        r.features(text)
    assert time.time() - began < 10
    assert r.read("c0ol!!!") == r.read("c0ol") and r.read("c0ol!!") == r.read("c0ol")


def readings(restorer, token):
    """All readings of a token with the least cost of each."""
    import itertools

    costs = {}
    for path in itertools.product(*restorer.options(token), [(" ", 0.0)]):
        a = b = 0
        total = 0.0
        for c, p in path:
            k = 0 if c == " " else min(int(toxicity._CODES[min(ord(c), 0x24F)]), 60) if c else -1
            total += p
            if not (k < 0 or k == 0 and b == 0):
                total += restorer.cost[a][b][k]
                a, b = b, k
        text = "".join(c for c, _ in path).strip()
        costs[text] = min(costs.get(text, total), total)
    return costs


def test_toxicity_lattice_against_all_readings():
    import random

    import numpy as np

    rnd = random.Random(4)
    r = toxicity.Restorer(-np.abs(np.random.default_rng(5).normal(2, 1, (toxicity.ALPHABET,) * 3)))
    for _ in range(200):
        token = "".join(rnd.choice("abé013@$!*.x") for _ in range(rnd.randrange(1, 8)))
        costs = readings(r, token)
        assert costs[r.viterbi(token)] == pytest.approx(min(costs.values()))
