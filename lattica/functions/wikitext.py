"""Wiki markup: sections, templates, plain text, blocks and chunks.

A small reader of nested brackets is enough for these; it runs in Arrow
batches, one page at a time, and never looks across pages.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT_PARAGRAPH, LONG_CHUNK = 100, 4000
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_HEADING = re.compile(r"^(={1,6})[ \t]*(.+?)[ \t]*\1[ \t]*$", re.M)
_LINK = re.compile(r"\[\[(?:[^\]\[|]*\|)?([^\]\[|]*)\]\]")
_EXTERNAL = re.compile(r"\[(?:https?:)?//\S+\s*([^\]]*)\]")
_DROPPED = re.compile(r"<(ref|sup|small|gallery|math)\b[^>/]*>.*?</\1\s*>|<ref\b[^>]*/>", re.S | re.I)
_TAG = re.compile(r"</?[A-Za-z][^>]*>")


def mask_comments(text: str) -> str:
    """Comments become spaces, but for their line breaks, so that offsets and lines stay."""
    return _COMMENT.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text)


def find_headings(text: str) -> list[tuple[int, int, int, str]]:
    """Headings outside comments: level, start, end, title as plain text."""
    return [(len(m[1]), m.start(), m.end(), " ".join(plain_text(m[2]).split())) for m in _HEADING.finditer(mask_comments(text))]


def split_sections(text: str) -> list[dict[str, object]]:
    """Sections in page order: level, title, path of the headings that a section lies under, its own last, and text up to the next heading."""
    headings = [(0, 0, 0, ""), *find_headings(text)]
    # a heading lies under those before it that no heading of its level or a higher one has closed since
    paths = accumulate(headings, lambda path, h: [*(p for p in path if p[0] < h[0]), h], initial=[])
    ends = [*(start for _, start, _, _ in headings[1:]), len(text)]
    return [{"level": level, "title": title, "path": [t for n, _, _, t in path if n], "text": text[begin:end]} for (level, _, begin, title), end, path in zip(headings, ends, list(paths)[1:], strict=True)]


_NESTING = {"{{": 1, "[[": 1, "}}": -1, "]]": -1}


def split_top_level(body: str, by: str = "|") -> list[str]:
    """Parts between separators that lie in no inner brackets."""
    depth, cuts = 0, [-1]
    for token in re.finditer(r"\{\{|\[\[|\}\}|\]\]|" + re.escape(by), body):
        change = _NESTING.get(token[0])
        if change is not None:
            depth = max(0, depth + change)
        elif not depth:
            cuts.append(token.start())
    return [body[a + 1 : b] for a, b in pairwise([*cuts, len(body)])]


def find_templates(text: str, names: Iterable[str] | None = None) -> list[tuple[int, int, str]]:
    """Templates: start, end, what is between the braces. Unclosed ones are none.

    Without ``names`` only outermost ones; with them, all of these canonical
    names, inside others too, in the order of their starts.
    """
    out, open_ = [], []
    for m in re.finditer(r"\{\{|\}\}", text):
        if m[0] == "{{":
            open_.append(m.start())
        elif open_:
            start = open_.pop()
            if names is not None or not open_:
                out.append((start, m.end(), text[start + 2 : m.start()]))
    if names is None:
        return out
    wanted = set(names)
    return sorted(t for t in out if canonical_name(t[2]) in wanted)


def canonical_name(body: str) -> str:
    """A template's name: one letter case, single spaces for runs of spaces and underscores."""
    return " ".join(split_top_level(body)[0].replace("_", " ").split()).lower()


def read_template(body: str) -> tuple[str, dict[str, str]]:
    """Name in canonical form, and parameters; of a repeated one the last."""
    name, *params = split_top_level(body)
    values, position = {}, 0
    for p in params:
        key, mark, value = p.partition("=")
        if mark and "{{" not in key and "[[" not in key:
            values[key.strip()] = value.strip()
        else:
            position += 1
            values[str(position)] = p.strip()
    return canonical_name(name), values


def plain_text(text: str, render: Callable[[str, dict[str, str]], str | None] = lambda name, params: params.get("2") or params.get("1")) -> str:
    """Markup rendered: links by their text, templates by ``render`` (None drops them), notes and tags dropped, br a new line."""
    text = _DROPPED.sub("", _COMMENT.sub("", text))
    out, at = [], 0
    for start, end, body in find_templates(text):
        name, params = read_template(body)
        out += [text[at:start], plain_text(render(name, params) or "", render)]
        at = end
    text = "".join([*out, text[at:]])
    for _ in range(3):
        text = _LINK.sub(r"\1", text)
    text = _EXTERNAL.sub(r"\1", text)
    text = re.sub(r"<br\s*/?>", "\n", text, flags=re.I)
    return re.sub(r"'{2,5}", "", _TAG.sub("", text))


def small_captions(text: str) -> list[str]:
    """What stands in small print, as plain text, without the brackets around it."""
    found = [plain_text(m[1]) for m in re.finditer(r"<small\b[^>]*>(.*?)</small\s*>", _COMMENT.sub("", text), re.S | re.I)]
    return [t for x in found if (t := " ".join(x.split()).strip("() "))]


def captured_templates(text: str, names: Iterable[str]) -> tuple[str, list[tuple[str, dict[str, str]]]]:
    """Plain text, and the named templates in it with their parameters, which leave no text."""
    wanted = frozenset(names)
    found = [read_template(body) for _, _, body in find_templates(_COMMENT.sub("", text), wanted)]
    return plain_text(text, lambda name, params: None if name in wanted else params.get("2") or params.get("1")), found


def categories(text: str) -> list[str]:
    return sorted({m[1].strip() for m in re.finditer(r"\[\[\s*[Cc]ategory\s*:\s*([^\]|]+)", _COMMENT.sub("", text))})


def split_blocks(text: str) -> list[tuple[str, str]]:
    """Paragraphs and bullets, without tables and galleries."""
    text = re.sub(r"\{\|.*?\|\}", "", _DROPPED.sub("", _COMMENT.sub("", text)), flags=re.S)
    out = []
    for group in re.split(r"\n\s*\n", text):
        lines: list[str] = []
        for line in group.strip().split("\n"):
            if line[:1] in ("*", "#", ":", ";"):
                if lines:
                    out.append(("paragraph", " ".join(lines)))
                    lines = []
                out.append(("bullet", line.lstrip("*#:; ")))
            elif line.strip():
                lines.append(line.strip())
        if lines:
            out.append(("paragraph", " ".join(lines)))
    return out


def merge_short(blocks: Iterable[tuple[str, str]], least: int = SHORT_PARAGRAPH) -> list[tuple[str, str]]:
    """Short paragraphs join the next one; those left at the end join the last; bullets stand."""
    blocks = list(blocks)
    at = [k for k, (kind, _) in enumerate(blocks) if kind == "paragraph"]
    # characters gathered up to each paragraph, from the one after the last that was long enough
    gathered = accumulate((len(blocks[k][1]) for k in at), lambda n, more: more if n >= least else n + 1 + more)
    ends = [k for k, n in zip(at, gathered, strict=True) if n >= least]
    home: dict[int, list[str]] = defaultdict(list)
    for k in at:
        after = bisect_left(ends, k)
        home[ends[after] if after < len(ends) else ends[-1] if ends else len(blocks)].append(blocks[k][1])
    out = [(kind, text if kind != "paragraph" else " ".join(home[k])) for k, (kind, text) in enumerate(blocks) if kind != "paragraph" or k in home]
    return out + [("paragraph", " ".join(texts)) for k, texts in home.items() if k == len(blocks)]


_S = T.StringType()
SECTION = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("title", _S), T.StructField("path", T.ArrayType(_S)), T.StructField("text", _S)])
_SECTION = pa.struct([("level", pa.int32()), ("title", pa.string()), ("path", pa.list_(pa.string())), ("text", pa.string())])
TEMPLATE = T.StructType([T.StructField("name", _S), T.StructField("params", T.MapType(_S, _S))])
_TEMPLATE = pa.struct([("name", pa.string()), ("params", pa.map_(pa.string(), pa.string()))])
BLOCK = T.StructType([T.StructField("kind", _S), T.StructField("text", _S)])
_BLOCK = pa.struct([("kind", pa.string()), ("text", pa.string())])


@F.arrow_udf(T.ArrayType(SECTION))
def sections(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else split_sections(p) for p in pages.to_pylist()], pa.list_(_SECTION))


@F.arrow_udf(T.ArrayType(TEMPLATE))
def templates(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else [{"name": n, "params": list(v.items())} for _, _, b in find_templates(_COMMENT.sub("", p)) for n, v in [read_template(b)]] for p in pages.to_pylist()], pa.list_(_TEMPLATE))


@F.arrow_udf(T.ArrayType(_S))
def page_categories(pages: pa.Array) -> pa.Array:
    return pa.array([[] if p is None else categories(p) for p in pages.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(_S)
def plain(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else plain_text(p) for p in pages.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(BLOCK))
def chunks(pages: pa.Array) -> pa.Array:
    """Blocks of a section, rendered, short paragraphs merged."""
    render = lambda p: [(k, t) for k, b in split_blocks(p) if (t := " ".join(plain_text(b).split()))]
    return pa.array([None if p is None else [{"kind": k, "text": t} for k, t in merge_short(render(p))] for p in pages.to_pylist()], pa.list_(_BLOCK))


def merge_short_column(texts: Column, least: int = SHORT_PARAGRAPH) -> Column:
    """:func:`merge_short` for an array of paragraphs, in the JVM."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("held"))

    def step(acc: Column, text: Column) -> Column:
        joined = F.when(F.length(acc["held"]) > 0, F.concat(acc["held"], F.lit(" "), text)).otherwise(text)
        full = F.length(joined) >= least
        return F.struct(F.when(full, F.concat(acc["out"], F.array(joined))).otherwise(acc["out"]).alias("out"), F.when(full, F.lit("")).otherwise(joined).alias("held"))

    def finish(acc: Column) -> Column:
        n = F.size(acc["out"])
        tail = F.concat(F.slice(acc["out"], 1, F.greatest(n - 1, F.lit(0))), F.array(F.concat(F.element_at(acc["out"], -1), F.lit(" "), acc["held"])))
        return F.when(F.length(acc["held"]) == 0, acc["out"]).when(n == 0, F.array(acc["held"])).otherwise(tail)

    return F.aggregate(texts, start, step, finish)
