"""URLs as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed

_PARSABLE = r"^https?://[^/?#\s@]+"


def normalize(url: Column, www: bool = True, slash: bool = True, query: bool = True, fragment: bool = True, ignore_case: bool = True) -> Column:
    """The key under which URLs are equal. One that doesn't parse is only lowered and stripped of slashes."""
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    host = F.regexp_extract(full, r"^([a-zA-Z]+://[^/?#]*)", 1)
    rest = F.substr(full, F.length(host) + 1)
    out = F.concat(F.lower(host), F.when(F.left(rest, F.lit(1)) == "/", F.lit("")).otherwise(F.lit("/")), rest)
    out = F.regexp_replace(out, "#.*$", "") if fragment else out
    out = F.regexp_replace(out, r"\?[^#]*", "") if query else out
    out = F.regexp_replace(out, r"^([a-z]+://)www\.", "$1") if www else out
    plain = url
    if slash:
        out, plain = F.regexp_replace(out, "/+$", ""), F.regexp_replace(plain, "/+$", "")
    if ignore_case:
        out, plain = F.lower(out), F.lower(plain)
    return F.when(full.rlike(_PARSABLE), out).otherwise(plain)


def domain(url: Column) -> Column:
    """Host without www., lower case; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)), r"^www\.", "")


def origin(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([a-zA-Z]+://[^/?#]+)", 1))


def strip_tracking(url: Column) -> Column:
    """Without fragment and tracking parameters; others keep their order."""
    url = F.regexp_replace(url, "#.*$", "")
    path = F.regexp_extract(url, r"^([^?]*)", 1)
    query = F.filter(F.split(F.regexp_extract(url, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^([^=]*)", 1)).isin([x.lower() for x in fixed.TRACKING_PARAMS]))
    return F.when(F.size(query) > 0, F.concat(path, F.lit("?"), F.array_join(query, "&"))).otherwise(path)


def _without_dots(url: Column) -> Column:
    """Dot segments of the path folded away, a segment at a time onto a stack; `..` at the root stays there, one at the end leaves the slash."""
    parts = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"

    def fold(path: Column) -> Column:
        segments = F.split(F.substring(path, 2, 1 << 30), "/")
        last = F.element_at(segments, -1)
        empty = F.array().cast("array<string>")
        step = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
        kept = F.aggregate(segments, empty, step)
        return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))

    some = F.regexp_extract(url, parts, 2).rlike(r"/\.{1,2}(/|$)")
    return F.when(some, F.concat(F.regexp_extract(url, parts, 1), fold(F.regexp_extract(url, parts, 2)), F.regexp_extract(url, parts, 3))).otherwise(url)


def absolute(base: Column, href: Column) -> Column:
    """A reference against a base, as RFC 3986 resolves it: absolute, scheme-relative, root-relative, query or fragment alone, or relative with dot segments."""
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(F.regexp_replace(bare, r"^([a-zA-Z]+://[^/]+)$", "$1/"), r"[^/]*$", "")
    scheme = F.regexp_extract(base, r"^([a-zA-Z]+:)", 1)
    out = (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1), href))
        .when(href.startswith("?"), F.concat(bare, href)).when((href == "") | href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href)).otherwise(F.concat(folder, href))
    )
    return _without_dots(out)


def resolve(base: Column, href: Column) -> Column:
    """A reference against a base, cleaned of tracking."""
    return strip_tracking(absolute(base, href))


def unwrap_archive(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"web\.archive\.org/web/\d+[a-z_]*/(https?://.+)$", 1), F.lit(""))


def is_junk(url: Column) -> Column:
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))
    out = path.rlike(fixed.JUNK_EXTENSIONS) | ~url.rlike(_PARSABLE)
    for p in fixed.JUNK_PATHS:
        out = out | F.contains(path, F.lit(p))
    return out


def profile_slug(url: Column) -> Column:
    """The name in a profile's URL, or a bare name with a hyphen; null for others."""
    slug = F.nullif(F.regexp_extract(url, "/in/([^/?#]+)", 1), F.lit(""))
    return F.coalesce(slug, F.when(url.rlike("^[a-zA-Z0-9-]+$") & F.contains(url, F.lit("-")), url))
