"""MDX to Markdown: exact rules as Arrow UDFs, and their native subset.

The exact rules need Python's regular expressions (back-references, Unicode white
space) and a line state machine; they run vectorised over Arrow batches. The
native functions cover what has no such needs and stay in generated code.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What opens a fence, and the marks of a comment.
FENCE = re.compile(r"(`{3,}|~{3,})")
OPENS, CLOSES = "<!--", "-->"

#: Component and line patterns, in the order they apply.
PASCAL = r"[A-Z][A-Za-z0-9]*"
IMPORT_LINE = re.compile(r"^[ \t]*(?:import|export)\b.*$", re.M)
LINK_PAIR = re.compile(r"<(Link|OutboundLink)\b[^>]*>(.*?)</\1\s*>", re.S)
PAIR = re.compile(r"<(" + PASCAL + r")\b[^>]*>.*?</\1\s*>", re.S)
SELF_CLOSED = re.compile(r"<" + PASCAL + r"\b[^<>]*?/>")
PROPS_TAIL = re.compile(r"[^>]\{props\.[^>}]*\}>")
BRACE_LINE = re.compile(r"^[ \t]*\{[^}]*\}[ \t]*$")

#: Tags by what becomes of them.
MARKED = (("b", "**"), ("strong", "**"), ("em", "*"), ("i", "*"), ("u", ""))
DROPPED = ("div", "p", "span", "section", "article", "figure", "ul", "ol", "li", "sup", "sub", "code", "pre", "table", "thead", "tbody", "tr", "td", "th")
ANCHOR = re.compile(r"<\s*a\b[^>]*?href\s*=\s*['\"]([^'\"]+)['\"][^>]*>(.*?)</\s*a\s*>", re.I | re.S)
BREAK = re.compile(r"<\s*/?\s*br\b\s*/?\s*>", re.I)
IMAGE_OPENS = re.compile(r"!\[[^\]]*\]\(")

_TAG = re.compile(r"<[^>]+>")
_tags = {name: re.compile(rf"<\s*/?\s*{name}\b[^>]*>", re.I) for name in (*(n for n, _ in MARKED), *DROPPED)}


def chunks(body: str) -> list[tuple[str, str]]:
    """(kind, text) of a body in order; kind is text, fence or comment."""
    lines = body.split("\n")
    found: list[tuple[str, str]] = []
    prose: list[str] = []

    def end_prose() -> None:
        if prose:
            found.append(("text", "".join(prose)))
            prose.clear()

    def whole(part: list[str]) -> str:
        return "".join(f"{x}\n" for x in part)

    at = 0
    while at < len(lines):
        line = lines[at]
        marker = FENCE.match(line.strip())
        if marker:
            end_prose()
            stop = next((k for k in range(at + 1, len(lines)) if lines[k].strip() == marker[1]), len(lines) - 1)
            found.append(("fence", whole(lines[at : stop + 1])))
            at = stop + 1
        elif OPENS in line:
            head, start = line.partition(OPENS)[0], line.index(OPENS)
            if head.strip():
                prose.append(head + "\n")
            end_prose()
            stop = next((k for k in range(at, len(lines)) if CLOSES in lines[k]), None)
            if stop is None:
                found.append(("comment", "\n".join(lines[at:])))
                break
            cut = lines[stop].index(CLOSES) + len(CLOSES)
            inside = [line[start:cut]] if stop == at else [*lines[at:stop], lines[stop][:cut]]
            found.append(("comment", "\n".join(inside)))
            if lines[stop][cut:].strip():
                prose.append(lines[stop][cut:] + "\n")
            at = stop + 1
        else:
            prose.append(line + "\n")
            at += 1
    end_prose()
    return found


def _children(match: re.Match) -> str:
    inner = match[0].partition(">")[2]
    return inner[: inner.rindex("</")]


def _anchor(match: re.Match) -> str:
    return f"[{_TAG.sub('', match[2].strip())}]({match[1]})"


def inline_html(text: str) -> str:
    """Known inline HTML as Markdown; common block tags dropped, their children kept."""
    for name, mark in MARKED:
        text = _tags[name].sub(mark, text)
    text = ANCHOR.sub(_anchor, BREAK.sub("\n", text))
    for name in DROPPED:
        text = _tags[name].sub("", text)
    return text


def clean_prose(text: str) -> str:
    text = IMPORT_LINE.sub("", text)
    text = LINK_PAIR.sub(lambda m: m[2].strip(), text)
    text = PAIR.sub(_children, text)
    text = inline_html(PROPS_TAIL.sub("", SELF_CLOSED.sub("", text)))
    text = "\n".join(line for line in text.split("\n") if not BRACE_LINE.match(line))
    return re.sub(r"\n{4,}", "\n\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip("\n")


def clean(body: str) -> str:
    """Markdown content of a body: prose cleaned, fences verbatim, comments gone."""
    parts = [(kind, clean_prose(t) if kind == "text" else t.rstrip("\n")) for kind, t in chunks(body) if kind != "comment"]
    return "\n\n".join(p for kind, p in parts if p or kind == "fence").strip()


def effective_body(body: str) -> str:
    """A body without fences and comments."""
    return "".join(t for kind, t in chunks(body) if kind == "text")


def image_dests(text: str) -> Iterator[str]:
    """Raw destinations of Markdown images; parentheses in them balance, on one line."""
    at = 0
    while opener := IMAGE_OPENS.search(text, at):
        depth, end = 0, None
        for mark in re.finditer(r"[()\n]", text[opener.end() :]):
            if mark[0] == "\n":
                break
            depth += 1 if mark[0] == "(" else -1
            if depth < 0:
                end = opener.end() + mark.start()
                break
        if end is None:
            at = opener.end()
        else:
            yield text[opener.end() : end].strip()
            at = end + 1


def dest_without_title(dest: str) -> str:
    titled = re.match(r"^(\S.*?)\s+[\"']([^\"']*)[\"']$", dest)
    return (titled[1] if titled else dest).strip()


def _plain(value):
    """YAML values as JSON can hold them: text keys, no NaN, unknown types as text."""
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if value is None or isinstance(value, (str, int, float, bool)) else str(value)


def _mapping(source: str) -> tuple[dict, str | None]:
    import yaml  # without it the rows have no true front matter, so its absence is an error

    try:
        value = yaml.safe_load(source)
    except (yaml.YAMLError, ValueError) as e:
        return {}, f"frontmatter: {type(e).__name__}"
    return (value if isinstance(value, dict) else {}), None


def frontmatter(text: str) -> dict:
    """meta_json, title, path, body and error of a text with or without a YAML block at its start."""
    found = {"meta_json": "{}", "title": "", "path": "", "body": text, "error": None}
    closer = re.search(r"^(?:---)\s*$", text[3:], re.M) if text.startswith("---") else None
    if closer:
        meta, error = _mapping(text[3 : 3 + closer.start()])
        named = {k: "" if meta.get(k) is None or meta.get(k) is False else str(meta[k]).strip() for k in ("title", "path")}
        others = {str(k): _plain(v) for k, v in meta.items() if k not in ("title", "path")}
        found |= {"meta_json": json.dumps(others, sort_keys=True, ensure_ascii=False), **named, "body": text[3 + closer.end() :].lstrip("\n"), "error": error}
    return found


def _mapped(kind: pa.DataType, function):
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else function(t) for t in column.to_pylist()], kind)

    return run


_PARTS = [("meta_json", pa.string()), ("title", pa.string()), ("path", pa.string()), ("body", pa.string()), ("error", pa.string())]
_CHUNK = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))


def split_frontmatter(text: Column) -> Column:
    run = _mapped(pa.struct(_PARTS), frontmatter)
    return F.arrow_udf(run, "meta_json string, title string, path string, body string, error string")(text)


def tokenise(body: Column) -> Column:
    run = _mapped(_CHUNK, lambda b: [{"kind": k, "text": t} for k, t in chunks(b)])
    return F.arrow_udf(run, "array<struct<kind:string,text:string>>")(body)


def cleaned(body: Column) -> Column:
    return F.arrow_udf(_mapped(pa.string(), clean), "string")(body)


def stripped_code(body: Column) -> Column:
    return F.arrow_udf(_mapped(pa.string(), effective_body), "string")(body)


def dests(body: Column) -> Column:
    """Destinations, less their titles, of the images in a body outside fences and comments."""
    run = _mapped(pa.list_(pa.string()), lambda b: [dest_without_title(d) for d in image_dests(effective_body(b))])
    return F.arrow_udf(run, "array<string>")(body)


# Native subset: ASCII white space, one level of parentheses.

_S = r"[ \t\n\r\f\x0B]"


def native_inline_html(text: Column) -> Column:
    for name, mark in MARKED:
        text = F.regexp_replace(text, f"(?i)<{_S}*/?{_S}*{name}\\b[^>]*>", mark)
    text = F.regexp_replace(text, f"(?i)<{_S}*/?{_S}*br\\b{_S}*/?{_S}*>", "\n")
    text = native_links(text)
    for name in DROPPED:
        text = F.regexp_replace(text, f"(?i)<{_S}*/?{_S}*{name}\\b[^>]*>", "")
    return text


def native_links(text: Column) -> Column:
    """Anchors with a quoted target as Markdown links; inner tags are left to the exact rule."""
    return F.regexp_replace(text, f"(?is)<{_S}*a\\b[^>]*?href{_S}*={_S}*['\"]([^'\"]+)['\"][^>]*>{_S}*(.*?){_S}*</{_S}*a{_S}*>", "[$2]($1)")


def native_without_comments(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)<!--.*?-->", "")


def native_without_imports(text: Column) -> Column:
    return F.regexp_replace(text, r"(?md)^[ \t]*(?:import|export)\b.*$", "")


def native_without_self_closed(text: Column) -> Column:
    return F.regexp_replace(text, f"<{PASCAL}\\b[^<>]*?/>", "")


def native_without_props(text: Column) -> Column:
    return F.regexp_replace(text, r"[^>]\{props\.[^>}]*\}>", "")


def native_link_pairs(text: Column) -> Column:
    return F.regexp_replace(text, f"(?s)<(Link|OutboundLink)\\b[^>]*>{_S}*(.*?){_S}*</\\1{_S}*>", "$2")


def native_without_brace_lines(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(r"^[ \t]*\{[^}]*\}[ \t]*$")), "\n")


def native_tidy(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(text, r"[ \t]+\n", "\n"), r"\n{4,}", "\n\n\n"), F.lit("\n"))


def native_effective_body(text: Column) -> Column:
    """Three-backtick fences and comments removed by pattern; the exact rule is ``stripped_code``."""
    return native_without_comments(F.regexp_replace(text, r"(?s)```.*?```\n?", ""))


def native_dests(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"!\[[^\]]*\]\(([^()\n]*)\)"), F.lit(1))
