"""Text as Catalyst expressions. Columns in, columns out; null stays null unless said otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed

#: White space as browsers' regular expressions see it.
SPACES = " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
WS = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
_W = "[A-Za-z0-9_]"
#: A word boundary between ASCII word characters and others; Java's own \b looks at all letters.
ASCII_B = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"


def ascii_words(pattern: str) -> str:
    """The pattern's \\b between ASCII word characters and others. Next to a character that is of a word in any case, one look suffices."""
    pattern = re.sub(r"(?m)(^|\|)\\b(?=[A-Za-z]|\\d)", rf"\1(?<!{_W})", pattern)
    pattern = re.sub(r"(?<=[A-Za-z)}?])\\b(?=\||$)", f"(?!{_W})", pattern)
    return pattern.replace(r"\b", ASCII_B)


def or_else(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols))


def js_round(x: Column, digits: int = 0) -> Column:
    """Half up, as floor(x + 1/2)."""
    k = 10**digits
    return F.floor(x * k + 0.5) / k


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(tokens(text)), F.lit(0))


def trim_ws(text: Column) -> Column:
    """By character set: Spark's trim is far cheaper than a regular expression that looks for the end at every space."""
    return F.btrim(text, F.lit(SPACES))


def preview(text: Column, n: int = 150) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def is_english(text: Column, sample: int = 200, hits: int = 3) -> Column:
    """Whether the first `sample` characters hold `hits` stop words or more."""
    words = F.split(F.lower(F.left(F.coalesce(text, F.lit("")), F.lit(sample))), f"{WS}+")
    stop = F.array(*map(F.lit, fixed.STOP_WORDS))
    return F.size(F.filter(words, lambda w: F.array_contains(stop, w))) >= hits


def has_any(text: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(text, F.lit(n))
    return F.coalesce(out, F.lit(False))


def is_block_page(text: Column, markers: str = fixed.BLOCK_PAGE_MARKERS) -> Column:
    low = F.lower(text)
    return F.coalesce(sum((F.contains(low, F.lit(m)).cast("int") for m in fixed.lines(markers)), F.lit(0)) >= 2, F.lit(False))


def is_truncated(text: Column, og_description: Column) -> Column:
    return F.coalesce((F.length(og_description) >= 100) & (F.coalesce(F.length(text), F.lit(0)) <= F.length(og_description)), F.lit(False))


def split_blocks(text: Column, separator: str = r"\n\s*\n") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), separator), trim_ws), lambda b: b != "")


def collapse_ws(text: Column) -> Column:
    """Runs of white space as one blank; the regular expression runs only where there is a run."""
    blank = F.translate(text, SPACES, " " * len(SPACES))
    return let(blank, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " +", " ")).otherwise(t))


def normalize_block(block: Column) -> Column:
    return trim_ws(collapse_ws(F.lower(block)))


def is_known_boilerplate(block: Column, longest: int = 300) -> Column:
    """block is normalised and, in a lambda, worked out once."""
    return (F.length(block) <= longest) & has_any(block, fixed.lines(fixed.BOILERPLATE_PHRASES))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", " ")


def strip_html(html: Column) -> Column:
    return trim_ws(F.regexp_replace(strip_tags(html), f"{WS}+", " "))


def _decode_numeric(text: Column, pattern: str, mark: str, base: int) -> Column:
    def one(t: Column, digits: Column) -> Column:
        return F.replace(t, F.concat(F.lit(mark), digits, F.lit(";")), F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32"))

    return let(text, lambda t: F.when(F.contains(t, F.lit(mark)), F.aggregate(F.array_distinct(F.regexp_extract_all(t, F.lit(pattern), F.lit(1))), t, one)).otherwise(t))


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decode_entities(text: Column) -> Column:
    """The nine rules in order, the ampersand first; numeric references one distinct code at a time."""
    for entity, c in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'")):
        text = F.replace(text, F.lit(entity), F.lit(c))
    text = _decode_numeric(text, r"&#(\d{1,7});", "&#", 10)
    text = _decode_numeric(text, r"&#x([0-9a-fA-F]{1,6});", "&#x", 16)
    return F.replace(text, F.lit("&nbsp;"), F.lit(" "))


def escape_html(text: Column) -> Column:
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(c), F.lit(entity))
    return text


def slugify(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), r"[^\w\s-]", "")
    out = F.regexp_replace(F.regexp_replace(out, f"{WS}+", "-"), "-+", "-")
    return F.regexp_replace(out, "^-|-$", "")


def slug_to_title(slug: Column) -> Column:
    return F.array_join(F.transform(F.split(slug, "-"), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), " ")


def kb_size(text: Column) -> Column:
    return js_round(F.octet_length(text) / 1024, 1)


def escape_regex(text: Column) -> Column:
    return F.regexp_replace(text, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def count_occurrences(text: Column, keyword: Column) -> Column:
    return F.when((keyword == "") | ~F.contains(F.lower(text), F.lower(keyword)), 0).otherwise(F.regexp_count(text, F.concat(F.lit(f"(?i){ASCII_B}"), escape_regex(keyword), F.lit(ASCII_B))))


def _where(text: Column, mark: str, pattern: str, by: str) -> Column:
    """A replacement that is only tried on texts that hold the mark."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(mark)), F.regexp_replace(t, pattern, by)).otherwise(t))


def split_sentences(text: Column, shortest: int = 10, citations: bool = True) -> Column:
    """Sentences of more than `shortest` characters, free of Markdown marks; without citations also of [#n] and [n]."""
    for mark, pattern, by in fixed.MARKDOWN_MARKS:
        text = _where(text, mark, pattern, by)
    text = text if citations else _where(text, "[", r"\[#?\d+\]", "")
    same = "|".join(re.escape(long[:-1]) for long, short in fixed.ABBREVIATIONS if long == short + ".")
    text = _where(text, ".", rf"(?<!{_W})({same})\.", "$1\x01")
    for long, short in fixed.ABBREVIATIONS:
        if long != short + ".":
            text = _where(text, long, f"(?<!{_W})" + re.escape(long), short + "\x01")
    parts = F.transform(F.split(text, rf"(?<=[.!?]){WS}+"), lambda s: trim_ws(F.replace(s, F.lit("\x01"), F.lit("."))))
    return F.filter(parts, lambda s: F.length(s) > shortest)


def is_claim(sentence: Column, patterns: str = fixed.CLAIM_PATTERNS, exceptions: str = fixed.GENERAL_KNOWLEDGE_PATTERNS, stems: list[str] = fixed.CLAIM_STEMS) -> Column:
    """A factual claim that is not general knowledge. No pattern matches without a digit or one of the stems that are looked for first."""
    free, cased = ("|".join(fixed.lines(x)) for x in patterns.strip("\n").split("\n\n"))
    general = "|".join(fixed.lines(exceptions))
    may = sentence.rlike("[0-9]") | has_any(F.lower(sentence), stems)
    return may & (sentence.rlike("(?i)" + ascii_words(free)) | sentence.rlike(ascii_words(cased))) & ~sentence.rlike("(?i)" + ascii_words(general))


def is_fact(sentence: Column) -> Column:
    """A claim that a verifier looks up: more patterns and more exceptions than those of uncited claims."""
    return is_claim(sentence, fixed.FACT_PATTERNS, fixed.FACT_EXCEPTIONS, fixed.FACT_STEMS)


def front_matter(markdown: Column) -> Column:
    """What stands between the first line and the next line of ---, null if there is none."""
    return F.nullif(F.regexp_extract(markdown, r"^---\s*\n([\s\S]*?)\n---", 1), F.lit(""))


def front_field(front: Column, name: str) -> Column:
    return F.nullif(trim_ws(F.regexp_extract(front, rf"""(?m)^(?:meta_{name}|{name})\s*:\s*["']?(.*?)["']?\s*$""", 1)), F.lit(""))


def first_h1(markdown: Column) -> Column:
    return F.nullif(trim_ws(F.regexp_extract(markdown, r"(?m)^#\s+(.+)$", 1)), F.lit(""))


def first_paragraph(markdown: Column) -> Column:
    """The lines of the first paragraph that is no heading or rule, joined by blanks."""
    lines = F.transform(F.split(F.regexp_replace(markdown, r"^---\s*\n[\s\S]*?\n---\s*\n?", ""), "\n"), trim_ws)
    text = F.filter(lines, lambda x: ~x.startswith("#") & ~x.startswith("---") & ~x.startswith("==="))
    return let(text, lambda ls: let(F.filter(F.sequence(F.lit(0), F.size(ls)), lambda i: (i < F.size(ls)) & (F.get(ls, i) != "")), lambda at: F.nullif(F.array_join(_run(ls, F.get(at, F.lit(0))), " "), F.lit(""))))


def _run(lines: Column, first: Column) -> Column:
    """The lines from `first` to before the next empty one."""
    rest = F.slice(lines, first + 1, F.size(lines))
    end = F.array_position(rest, F.lit(""))
    return F.when(first.isNull(), F.array().cast("array<string>")).when(end > 0, F.slice(rest, F.lit(1), (end - 1).cast("int"))).otherwise(rest)


def markdown_sections(markdown: Column) -> Column:
    """h1, h2, h3, first_paragraphs (the first line after each heading), body, title, description, word_count. Citations don't count."""
    front = front_matter(markdown)
    rest = F.regexp_replace(trim_ws(F.regexp_replace(markdown, r"^---\s*\n[\s\S]*?\n---", "")), r"\[#?\d+\]", "")
    level = lambda x: F.length(F.regexp_extract(x, r"^(#+)\s+.", 1))
    lines = F.transform(F.split(rest, "\n"), lambda x: F.struct(trim_ws(x).alias("t"), level(trim_ws(x)).alias("n")))
    lines = F.filter(lines, lambda x: (x["t"] != "") & (~x["t"].startswith("#") | x["n"].between(1, 3)))

    def parts(ls: Column) -> Column:
        heads = lambda n: F.transform(F.filter(ls, lambda x: x["n"] == n), lambda x: trim_ws(F.regexp_replace(x["t"], r"^#+\s+", "")))
        firsts = F.filter(ls, lambda x, i: (x["n"] == 0) & (F.get(ls, i - 1)["n"] > 0))
        body = F.array_join(F.filter(ls, lambda x: x["n"] == 0)["t"], " ")
        return F.struct(heads(1).alias("h1"), heads(2).alias("h2"), heads(3).alias("h3"), firsts["t"].alias("first_paragraphs"), body.alias("body"), front_field(front, "title").alias("title"), front_field(front, "description").alias("description"), word_count(body).alias("word_count"))

    return let(lines, parts)


def refs(markdown: Column) -> Column:
    """Distinct numbers of [#n] marks, ascending."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(markdown, F.lit(r"\[#(\d+)\]"), F.lit(1)), lambda d: d.cast("int"))))


def model_json(text: Column) -> Column:
    """The JSON in a model's answer: without fences, from the first brace to the last; null if it doesn't parse."""
    body = F.regexp_extract(F.regexp_replace(text, r"```(?:json)?", ""), r"(?s)(\{.*\})", 1)
    return F.to_json(F.try_parse_json(F.nullif(body, F.lit(""))))


def month_year(month: Column, year: Column) -> Column:
    """`Mon YYYY`, the year alone without a month, null without a year."""
    name = F.get(F.array(*map(F.lit, fixed.MONTHS)), month - 1)
    return F.when(F.coalesce(year, F.lit(0)) == 0, F.lit(None)).when(F.coalesce(month, F.lit(0)) == 0, year.cast("string")).otherwise(F.concat(name, F.lit(" "), year.cast("string")))


def date_rank(date: Column) -> Column:
    """A number by which `Mon YYYY` and `YYYY` dates stand in order; 0 for none."""
    year = F.coalesce(F.nullif(F.regexp_extract(date, r"(\d{4})", 1), F.lit("")).cast("int"), F.lit(0))
    return year * 13 + F.coalesce(F.array_position(F.array(*map(F.lit, fixed.MONTHS)), F.left(date, F.lit(3))), F.lit(0)).cast("int")


def file_slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9_]", "_"), "_+", "_")
