"""Markdown as HTML: blocks by a fold over lines that keeps what is open, then the marks inside lines. Plain Python for Arrow batches."""

from __future__ import annotations

import re
from html import escape

_ATX = re.compile(r" {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
_RULE = re.compile(r" {0,3}([-*_])[ \t]*(?:\1[ \t]*){2,}$")
_FENCE = re.compile(r"( {0,3})(`{3,}|~{3,})[ \t]*([^`]*)$")
_ITEM = re.compile(r"( {0,3})([-*+]|\d{1,9}[.)])(?:([ \t]+)(.*)|())$")
_QUOTE = re.compile(r" {0,3}> ?")
_ALIGN = re.compile(r"[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
_HTML = re.compile(r" {0,3}<(?:/?[a-zA-Z][\w-]*(?=[\s/>])[^>]*>|!--)")
_SETEXT = re.compile(r" {0,3}(=+|-+)[ \t]*$")
DEEPEST = 100  # blocks inside one another; what lies deeper is text


def _cells(line: str) -> list[str]:
    line = line.strip()
    line = line[1:] if line.startswith("|") else line
    line = line[:-1] if line.endswith("|") and not line.endswith("\\|") else line
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line)]


def _item_body(lines: list[str], at: int, m: re.Match) -> tuple[list[str], int, bool]:
    """The lines of the item that begins at `at`, without its indent; the next line's place; whether a blank line lies inside or after it before a sibling."""
    width = len(m[1]) + len(m[2]) + (len(m[3].expandtabs(4)) if m[3] and len(m[3].expandtabs(4)) < 5 and m[4] else 1)
    body, k, blank, loose = [m[4] or ""], at + 1, False, False
    while k < len(lines):
        line = lines[k].expandtabs(4)
        if not line.strip():
            blank = True
            k += 1
            continue
        if len(line) - len(line.lstrip(" ")) >= width:
            if blank:
                body.append("")
                loose = True
            body.append(line[width:])
        elif blank or _ITEM.match(line) or _ATX.match(line) or _FENCE.match(line) or _QUOTE.match(line) or _RULE.match(line):
            break
        else:
            body.append(line.lstrip())  # a lazy line
        blank = False
        k += 1
    return body, k, loose or blank and k < len(lines)


def blocks(lines: list[str], depth: int = 0, tight: bool = False) -> str:
    """HTML of some lines."""
    out: list[str] = []
    para: list[str] = []

    def flush() -> None:
        if para:
            text = inline("\n".join(x.lstrip() for x in para).rstrip())
            out.append(text if tight else f"<p>{text}</p>")
            para.clear()

    k = 0
    while k < len(lines):
        line = lines[k]
        if not line.strip():
            flush()
            k += 1
        elif m := _FENCE.match(line):
            flush()
            close, body, k = re.compile(rf" {{0,3}}{re.escape(m[2][0])}{{{len(m[2])},}}[ \t]*$"), [], k + 1
            while k < len(lines) and not close.match(lines[k]):
                indent = len(m[1])
                body.append(lines[k][min(indent, len(lines[k]) - len(lines[k].lstrip(" "))) :])
                k += 1
            k += 1
            lang = m[3].split()[0] if m[3].strip() else ""
            out.append(f"<pre><code{f' class="language-{escape(lang)}"' if lang else ''}>{escape(''.join(x + chr(10) for x in body))}</code></pre>")
        elif line.startswith("    ") and not para:
            body = []
            while k < len(lines) and (lines[k].startswith("    ") or not lines[k].strip()):
                body.append(lines[k][4:])
                k += 1
            out.append(f"<pre><code>{escape('\n'.join(body).rstrip())}\n</code></pre>")
        elif m := _ATX.match(line):
            flush()
            n = len(m[1])
            out.append(f"<h{n}>{inline((m[2] or '').strip())}</h{n}>")
            k += 1
        elif para and (m := _SETEXT.match(line)):
            text = inline(" ".join(x.strip() for x in para))
            para.clear()
            out.append(f"<h{1 if m[1][0] == '=' else 2}>{text}</h{1 if m[1][0] == '=' else 2}>")
            k += 1
        elif _RULE.match(line):
            flush()
            out.append("<hr>")
            k += 1
        elif _QUOTE.match(line) and depth < DEEPEST:
            flush()
            body = []
            while k < len(lines) and lines[k].strip() and (_QUOTE.match(lines[k]) or body and body[-1].strip() and not (_ITEM.match(lines[k]) or _ATX.match(lines[k]) or _FENCE.match(lines[k]) or _RULE.match(lines[k]))):
                body.append(_QUOTE.sub("", lines[k], count=1))
                k += 1
            out.append(f"<blockquote>\n{blocks(body, depth + 1)}\n</blockquote>")
        elif (m := _ITEM.match(line)) and depth < DEEPEST and not (para and (not (m[4] or "").strip() or m[2][:-1].isdigit() and m[2][:-1] != "1")):
            flush()
            mark, items, loose = m[2][-1], [], False
            first = m[2][:-1]
            while k < len(lines) and (m := _ITEM.match(lines[k])) and m[2][-1] == mark and not _RULE.match(lines[k]):
                body, k, blank = _item_body(lines, k, m)
                loose = loose or blank and (k < len(lines) and bool((x := _ITEM.match(lines[k])) and x[2][-1] == mark) or "" in body)
                items.append(body)
            tag = "ul" if mark in "-*+" else "ol"
            start = f' start="{int(first)}"' if tag == "ol" and int(first) != 1 else ""
            out.append(f"<{tag}{start}>\n{''.join(_list_item(x, depth, loose) for x in items)}</{tag}>")
        elif "|" in line and not para and k + 1 < len(lines) and "-" in lines[k + 1] and _ALIGN.match(lines[k + 1]) and len(_cells(lines[k + 1])) == len(_cells(line)):
            heads = _cells(line)
            sides = [{(True, True): "center", (True, False): "left", (False, True): "right"}.get((c.startswith(":"), c.endswith(":")), "") for c in _cells(lines[k + 1])]
            k, rows = k + 2, []
            while k < len(lines) and lines[k].strip() and not (_ATX.match(lines[k]) or _FENCE.match(lines[k]) or _QUOTE.match(lines[k])):
                rows.append((_cells(lines[k]) + [""] * len(heads))[: len(heads)])
                k += 1
            cell = lambda tag, text, side: f"<{tag}{f' align="{side}"' if side else ''}>{inline(text)}</{tag}>\n"
            row = lambda tag, cells: f"<tr>\n{''.join(cell(tag, c, s) for c, s in zip(cells, sides))}</tr>\n"
            body = f"<tbody>{''.join(row('td', r) for r in rows)}</tbody>" if rows else ""
            out.append(f"<table>\n<thead>\n{row('th', heads)}</thead>\n{body}</table>")
        elif _HTML.match(line) and not para:
            body = []
            while k < len(lines) and lines[k].strip():
                body.append(lines[k])
                k += 1
            text = "\n".join(body)
            out.append(f"<p>{inline(text.strip())}</p>" if re.match(r" {0,3}<(?:a|b|i|em|strong|sup|sub|span|code|img|u|s)\b", text) else text)
        else:
            para.append(line)
            k += 1
    flush()
    return "\n".join(out)


def _list_item(body: list[str], depth: int, loose: bool) -> str:
    task = re.match(r"\[([ xX])\][ \t]+", body[0])
    box = f'<input {"checked=\"\" " if task and task[1] != " " else ""}disabled="" type="checkbox"> ' if task else ""
    lines = [body[0][task.end() :] if task else body[0], *body[1:]]
    return f"<li>{box}{blocks(lines, depth + 1, tight=not loose)}{chr(10) if loose else ''}</li>\n"


_CODE = re.compile(r"(?<!`)(`+)(?!`)")
_MARKS = re.compile(r"""\\([!-/:-@\[-`{-~])|(!?)\[((?:[^\[\]\\]|\\.)*)\]\(\s*<?([^\s()<>]*(?:\([^\s()<>]*\)[^\s()<>]*)*)>?(?:\s+["']([^"']*)["'])?\s*\)|<(https?://[^\s<>]*)>|(</?[a-zA-Z][^<>]*>|<!--.*?-->)|(?<![\w/"'=.])(https?://[^\s<>()]*[^\s<>().,;:!?'"*_~])| {2,}\n|\\\n""", re.S)
_STRONG = [(re.compile(r"(?<![*\w\x00])\*\*\*(?=\S)(.+?)(?<=\S)\*\*\*(?!\*)", re.S), r"<em><strong>\1</strong></em>"), (re.compile(r"\*\*(?=[^\s*])((?:[^*]|\*(?!\*))+?)(?<=\S)\*\*", re.S), r"<strong>\1</strong>"), (re.compile(r"(?<!\w)__(?=\S)((?:[^_]|_(?!_))+?)(?<=\S)__(?!\w)", re.S), r"<strong>\1</strong>"), (re.compile(r"\*(?=[^\s*])([^*]+?)(?<=[^\s*])\*", re.S), r"<em>\1</em>"), (re.compile(r"(?<!\w)_(?=\S)([^_]+?)(?<=\S)_(?!\w)", re.S), r"<em>\1</em>"), (re.compile(r"~~(?=\S)([^~]+?)(?<=\S)~~", re.S), r"<del>\1</del>")]
_ENTITY = re.compile(r"&(?!(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});)")


def _plain(text: str) -> str:
    return _ENTITY.sub("&amp;", text).replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("'", "&#39;")


def inline(text: str) -> str:
    """Marks inside lines. Code, links, tags and escaped signs are put aside first, so that no mark is found in them."""
    aside: list[str] = []

    def put(html: str) -> str:
        aside.append(html)
        return f"\x00{len(aside) - 1}\x01"

    text = text.replace("\x00", "�").replace("\x01", "�")
    out, at, closing = [], 0, {}
    spots = [(m.start(), m.end(), len(m[1])) for m in _CODE.finditer(text)]
    for i in range(len(spots) - 1, -1, -1):  # the next run of equal length
        start, end, n = spots[i]
        spots[i] = (start, end, closing.get(n))
        closing[n] = (start, end)
    for start, end, close in spots:
        if start >= at and close and not (start and text[start - 1] == "\\"):
            code = text[end : close[0]].replace("\n", " ")
            code = code[1:-1] if len(code) > 2 and code[0] == code[-1] == " " and code.strip() else code
            out += [text[at:start], put(f"<code>{escape(code)}</code>")]
            at = close[1]
    text = "".join([*out, text[at:]])

    def mark(m: re.Match) -> str:
        sign, image, label, address, title, auto, tag, bare = m.groups()
        if sign:
            return put(_plain(sign))
        if label is not None:
            t = f' title="{_plain(title)}"' if title else ""
            if image:
                return put(f'<img src="{_plain(address)}" alt="{_plain(re.sub("[*_`]", "", label))}"{t}>')
            return f'{put(f"<a href=\"{_plain(address)}\"{t}>")}{label}{put("</a>")}'
        if auto or bare:
            return put(f'<a href="{_plain(auto or bare)}">{_plain(auto or bare)}</a>')
        return put(tag) if tag else put("<br>") + "\n"

    text = _plain(_MARKS.sub(mark, text))
    for pattern, by in _STRONG:
        text = pattern.sub(by, text)
    for _ in range(2):  # what is aside may hold marks of code
        text = re.sub("\x00(\\d+)\x01", lambda m: aside[int(m[1])], text)
    return text




def to_html(markdown: str) -> str:
    html = blocks(markdown.replace("\r\n", "\n").replace("\r", "\n").split("\n"))
    return f"{html}\n" if html else ""
