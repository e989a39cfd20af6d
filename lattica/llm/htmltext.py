"""Main text of web pages, by boosted trees over DOM nodes.

A tolerant parser makes a page's block elements into nodes in page order. Each
node gets features: its tag and attribute tokens and those of its ancestors,
depth, text and link density of its subtree, and how it compares with its
siblings. Boosted trees give the odds that a node holds main text somewhere.
Decoding finds the likeliest labels for the whole page under one constraint: a
node whose ancestor holds no main text holds none either.

The trees are fitted to pages that this module makes up, of known main text:
:func:`made_up_page` varies layout, wording, nesting and carelessness.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm import boosting

#: Pages that the trees are fitted to.
PAGES = 700

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

# fixed values: element names of HTML
_SKIPPED = frozenset("script style noscript template svg head iframe object canvas audio video map select datalist textarea button".split())
_RAW = frozenset("script style noscript template iframe textarea title".split())
_BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
_CLOSED_BY = {"p": _BLOCK - {"html", "body"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot", "thead"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"])}
_SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"])}

_TAGS = [frozenset(x.split()) for x in ("nav menu", "header", "footer", "aside", "form fieldset legend search", "article", "main", "section", "div center", "p", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dir dl", "li dt dd", "table tbody thead tfoot tr", "td th", "blockquote pre figure figcaption", "details dialog summary")]
_TAG_NUMBER = {name: k + 1 for k, names in enumerate(_TAGS) for name in names}
_STEMS = {
    "menu": "nav navbar menu breadcrumb breadcrumbs pagination pager toc tabs toolbar sitemap skip navigation".split(),
    "frame": "header masthead topbar footer bottom colophon copyright legal site-header site-footer banner contentinfo".split(),
    "side": "sidebar aside side widget widgets rail secondary complementary related recommended recommendations popular trending more-stories tags tagcloud".split(),
    "advert": "ad ads advert adverts advertisement advertising adbox adsense promo promoted sponsor sponsored sponsorship banner-ad dfp".split(),
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe subscription signup paywall notification toast warning disclaimer".split(),
    "social": "share sharing social follow byline author-box".split(),
    "comment": "comment comments comment-list disqus reply replies respond discussion reader-comments feedback commentlist thread".split(),
    "form": "form search login searchbox contact".split(),
    "main": "content article post main body entry story text maintext articlebody post-body entry-content article-body main-content prose page-content".split(),
}
_GROUPS = list(_STEMS)
_STEM_BIT = {stem: 1 << k for k, name in enumerate(_GROUPS) for stem in _STEMS[name]}
_WORD = re.compile(r"[a-z]+")


@lru_cache(maxsize=4096)
def _attribute_flags(attributes: str) -> int:
    """Bits of the token groups that class, id and role name; the highest for hidden."""
    flags = 1 << len(_GROUPS) if _HIDDEN.search(attributes) else 0
    for match in _ATTRIBUTE.finditer(attributes):
        for token in (match[1] or match[2] or match[3] or "").lower().split():
            if token in _STEM_BIT:
                flags |= _STEM_BIT[token]
                continue
            for word in _WORD.findall(token):
                flags |= _STEM_BIT.get(word, 0)
    return flags


@dataclass
class Page:
    """Nodes of a page, in page order, as columns."""

    tag: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    above_tags: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    text: list[int] = field(default_factory=list)
    link: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def clean(raw: str) -> str:
    """A block's text: character references decoded, white space single, none at the ends."""
    return " ".join((html.unescape(raw) if "&" in raw else raw).split())


def parse(source: str) -> Page:
    """The block elements of a page and their text; never fails, whatever the markup."""
    page = Page()
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    linked = 0
    in_link = False

    def open_(name: str, attributes: str) -> None:
        parent = stack[-1][1] if stack else -1
        k = len(page.tag)
        tag = _TAG_NUMBER.get(name, 0)
        flags = _attribute_flags(attributes) if attributes else 0
        page.tag.append(tag)
        page.flags.append(flags)
        page.above.append(page.above[parent] | page.flags[parent] if parent >= 0 else 0)
        page.above_tags.append(page.above_tags[parent] | 1 << page.tag[parent] if parent >= 0 else 0)
        page.depth.append(len(stack))
        page.parent.append(parent)
        page.end.append(0)
        page.text.append(0)
        page.link.append(0)
        page.stops.append(0)
        stack.append((name, k))

    def flush() -> None:
        nonlocal linked
        if held:
            text = clean("".join(held))
            held.clear()
            if text:
                k = stack[-1][1]
                page.blocks.append((k, text))
                page.text[k] += len(text)
                page.link[k] += min(linked, len(text))
                page.stops[k] += text.count(".") + text.count(",")
            linked = 0

    def close(to: int) -> None:
        while len(stack) > to:
            page.end[stack.pop()[1]] = len(page.tag)

    open_("body", "")
    at = 0
    find = _TOKEN.search
    while True:
        m = find(source, at)
        stop = m.start() if m else len(source)
        if stop > at:
            held.append(source[at:stop])
            if in_link:
                linked += stop - at
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                held.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        closing = m[1] or m[4]
        if not closing and (name in _SKIPPED or name == "title"):
            if (m[3] or m[6] or "").endswith("/"):
                continue
            tail = re.compile(rf"</{name}\s*>|</{name}\b[^>]*>", re.I).search(source, at)
            if name == "head" and not tail:
                tail = re.compile(r"(?=<body\b)", re.I).search(source, at)
            if tail:
                at = tail.end()
            elif name in _RAW:
                at = len(source)
            continue
        if name == "a":
            in_link = not closing
        elif name == "br":
            held.append(" ")
        elif name == "hr":
            flush()
        elif name in _BLOCK:
            flush()
            in_link = False
            if name in ("html", "body"):
                if not closing and len(stack) == 1 and (m[3] or m[6]):
                    page.flags[0] |= _attribute_flags(m[3] or m[6]) & ~((1 << len(_GROUPS)) - 1)
                continue
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
            else:
                for k in range(len(stack) - 1, 0, -1):
                    top = stack[k][0]
                    if name in _CLOSED_BY.get(top, ()):
                        close(k)
                        if top == "p":
                            break
                        continue
                    if top in _SCOPE.get(name, ()) or top not in _CLOSED_BY:
                        break
                open_(name, m[3] or m[6] or "")
                if (m[3] or "").endswith("/") and name not in ("p", "div"):
                    close(len(stack) - 1)
    flush()
    close(0)
    return page


def features(pages: Sequence[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all nodes of ``pages``, and where each page's nodes start."""
    sizes = np.array([len(p.tag) for p in pages], np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    column = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    tag, flags, above, above_tags, depth = map(column, ("tag", "flags", "above", "above_tags", "depth"))
    shift = np.repeat(starts[:-1], sizes)
    root = np.zeros(starts[-1], bool)
    root[starts[:-1]] = True
    parent = np.where(root, np.arange(starts[-1]), column("parent") + shift)
    end = column("end") + shift
    own = {name: column(name) for name in ("text", "link", "stops")}
    index = np.arange(starts[-1])
    sums = {name: (c := np.r_[0, np.cumsum(v)])[end] - c[index] for name, v in own.items()}
    text = sums["text"]
    nodes = end - index
    all_text = np.maximum(text[starts[:-1]], 1)
    before = np.r_[0, np.cumsum(own["text"])][index] - np.r_[0, np.cumsum(own["text"])][shift]
    siblings = np.bincount(parent[~root], minlength=len(index))[parent]
    beside = np.bincount(parent[~root], text[~root], minlength=len(index))[parent]
    alike_key = parent * 32 + tag
    _, inverse, counts = np.unique(alike_key, return_inverse=True, return_counts=True)
    paragraphs = (c := np.r_[0, np.cumsum(tag == _TAG_NUMBER["p"])])[end] - c[index]
    items = (c := np.r_[0, np.cumsum(tag == _TAG_NUMBER["li"])])[end] - c[index]
    mains = (c := np.r_[0, np.cumsum((tag == _TAG_NUMBER["article"]) | (tag == _TAG_NUMBER["main"]) | (flags >> _GROUPS.index("main") & 1 > 0))])[end] - c[index]
    columns = [
        np.log1p(text),
        sums["link"] / np.maximum(text, 1),
        sums["stops"] / np.maximum(text, 1) * 100,
        text / nodes,
        own["text"] / np.maximum(text, 1),
        depth,
        np.minimum(nodes, 200),
        text / np.repeat(all_text, sizes),
        before / np.repeat(all_text, sizes),
        siblings,
        text / np.maximum(beside, 1),
        counts[inverse.reshape(-1)],
        paragraphs,
        items / nodes,
        mains,
        text[parent] / np.repeat(all_text, sizes),
    ]
    other = (1 << len(_GROUPS)) - 1 - (1 << _GROUPS.index("main"))
    columns += [(flags & other) > 0, (above & other) > 0, ((flags | above) & other) > 0]
    columns += [tag == k for k in range(1, len(_TAGS) + 1)]
    columns += [flags >> k & 1 for k in range(len(_GROUPS) + 1)]
    columns += [above >> k & 1 for k in range(len(_GROUPS) + 1)]
    columns += [above_tags >> k & 1 for k in range(1, 8)]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1), starts


def decode(log_odds: np.ndarray, page: Page) -> list[bool]:
    """The likeliest labels of a page's nodes such that none is true below one that is false."""
    n = len(page.tag)
    yes = (-np.logaddexp(0, -log_odds)).tolist()
    no = (-np.logaddexp(0, log_odds)).tolist()
    parent = page.parent
    best = [0.0] * n
    for k in range(n - 1, 0, -1):
        p = parent[k]
        best[k] = max(yes[k], no[k])
        yes[p] += best[k]
        no[p] += no[k]
    labels = [False] * n
    for k in range(n):
        labels[k] = (k == 0 or labels[parent[k]]) and yes[k] > no[k]
    return labels


def main_texts(trees: boosting.Trees, sources: Sequence[str | None]) -> list[str]:
    """Main texts of pages; null and empty pages have none."""
    pages = [parse(s or "") for s in sources]
    x, starts = features(pages)
    odds = trees.log_odds(x)
    out = []
    for page, a, b in zip(pages, starts[:-1], starts[1:], strict=True):
        labels = decode(odds[a:b], page)
        out.append("\n".join(text for k, text in page.blocks if labels[k]))
    return out


# --- pages to learn from ---------------------------------------------------

_SYLLABLES = "an be co da el fi go ha in ja ko la mi no or pa qui re sa ti un ve wo xa yl zu er ou st th".split()


def _sentence(r: random.Random, least: int = 3, most: int = 18) -> str:
    words = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(least, most))]
    for k in range(4, len(words) - 1, 7):
        words[k] += ","
    return " ".join(words).capitalize() + r.choice(".....!?")


def _prose(r: random.Random, most: int = 6) -> str:
    return " ".join(_sentence(r) for _ in range(r.randint(1, most)))


def _named(r: random.Random, group: str, tags: str) -> tuple[str, str]:
    tag = r.choice(tags.split())
    stem = r.choice(_STEMS[group])
    stem = r.choice([stem, stem, f"{r.choice(['site', 'page', 'block', 'x', 'top', 'c'])}-{stem}", f"{stem}_{r.randint(1, 9)}", f"{stem} {r.choice(['wide', 'box', 'left', 'inner'])}"])
    return tag, f'<{tag} {r.choice(["class", "class", "id"])}="{stem}">'


def _links(r: random.Random) -> str:
    count = r.randint(2, 12)
    body = [f'<a href="/{k}">{_sentence(r, 1, 3)[:-1]}</a>' for k in range(count)]
    return "<ul>" + "".join(f"<li>{x}{r.choice(['</li>', '</li>', ''])}" for x in body) + "</ul>" if r.random() < 0.7 else r.choice([" | ", " "]).join(body)


def _boilerplate(r: random.Random, kind: str) -> str:
    if kind == "menu":
        tag, start = r.choice([("nav", "<nav>"), _named(r, "menu", "div nav ul section")])
        return start + _links(r) + f"</{tag}>"
    if kind == "frame":
        tag, start = r.choice([("header", "<header>"), ("footer", "<footer>"), _named(r, "frame", "div header footer section")])
        return start + r.choice([f"<p>{_sentence(r)}</p>", f"&copy; {_sentence(r)}", _links(r), f"<h1>{_sentence(r, 1, 4)[:-1]}</h1>", f"<div>{_sentence(r)}</div>{_links(r)}"]) + f"</{tag}>"
    if kind == "side":
        tag, start = r.choice([("aside", "<aside>"), _named(r, "side", "div aside section ul")])
        return start + r.choice(["", f"<h3>{_sentence(r, 1, 3)[:-1]}</h3>"]) + r.choice([_links(r), f"<p>{_prose(r, 3)}</p>", f"{_sentence(r)}"]) + f"</{tag}>"
    if kind == "advert":
        tag, start = _named(r, "advert", "div div section p aside")
        return start + r.choice([_prose(r, 3), f"<p>{_prose(r, 2)}</p>", f"<a href='/x'>{_sentence(r)}</a>"][: 1 if tag == "p" else 3]) + f"</{tag}>"
    if kind == "notice":
        tag, start = _named(r, "notice", "div section p aside dialog")
        return start + r.choice([_prose(r, 3), f"<p>{_sentence(r)}</p>"][: 1 if tag == "p" else 2]) + f"</{tag}>"
    if kind == "social":
        tag, start = _named(r, "social", "div ul section")
        return start + _links(r) + f"</{tag}>"
    if kind == "comment":
        tag, start = _named(r, "comment", "div section ol ul aside")
        inner = "li" if tag in ("ol", "ul") else r.choice(["div", "article", "div class='comment'", "p"])
        return start + r.choice(["", "<h3>Comments</h3>", "<h2>" + _sentence(r, 1, 3)[:-1] + "</h2>"]) + "".join(f"<{inner}>{r.choice(['', '<b>' + _sentence(r, 1, 2)[:-1] + '</b> '])}{r.choice(['<p>' + _prose(r, 3) + '</p>', _prose(r, 3)][: 1 if inner == 'p' else 2][::-1])}</{inner.split()[0]}>" for _ in range(r.randint(1, 6))) + f"</{tag}>"
    tag, start = r.choice([("form", "<form>"), ("form", '<form action="/go">'), _named(r, "form", "form div")])
    return start + f"<label>{_sentence(r, 1, 4)[:-1]}</label><input name=q>{r.choice(['', '<p>' + _sentence(r) + '</p>', '<select><option>' + _sentence(r, 1, 2) + '</select>'])}<button>{_sentence(r, 1, 2)[:-1]}</button></{tag}>"


def made_up_page(seed: int) -> tuple[str, list[str]]:
    """A page and the blocks of its main text."""
    r = random.Random(seed)
    blocks: list[str] = []

    def said(text: str) -> str:
        blocks.append(clean(re.sub(r"<(?!br)[^>]*>", "", text).replace("<br>", " ")))
        return text

    def paragraph() -> str:
        text = _prose(r) if r.random() < 0.85 else _sentence(r, 1, 4)
        if r.random() < 0.3:
            words = text.split()
            k = r.randrange(len(words))
            words[k] = r.choice([f"<b>{words[k]}</b>", f'<a href="/y">{words[k]}</a>', f"<em>{words[k]}</em>", f"{words[k]} &amp;", f"{words[k]}&#39;s", f"{words[k]}<br>"])
            text = " ".join(words)
        elif r.random() < 0.1:
            return f"<p><b>{said(text)}<br>"
        return r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>\n", "<p>{}", "<div>{}</div>", '<p class="x">{}</p>']).format(said(text))

    def part() -> str:
        kind = r.random()
        if kind < 0.72:
            return paragraph()
        if kind < 0.8:
            tag = r.choice(["h2", "h3"])
            return f"<{tag}>{said(_sentence(r, 1, 6)[:-1])}</{tag}>"
        if kind < 0.86:
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{said(_sentence(r))}</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>"
        if kind < 0.9:
            return f"<blockquote>{paragraph()}</blockquote>" if r.random() < 0.5 else f"<pre>{said(_sentence(r))}</pre>"
        if kind < 0.93:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{said(_sentence(r, 1, 3)[:-1])}</td>" for _ in range(2)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if kind < 0.96:
            return f"<section>{paragraph()}{paragraph()}</section>"
        return _boilerplate(r, r.choice(["advert", "social", "notice", "side", "advert", "form"]))

    before = [_boilerplate(r, r.choice(["menu", "menu", "frame", "frame", "notice", "advert", "form", "side", "social"])) for _ in range(r.randint(0, 5))]
    main = []
    if r.random() < 0.85:
        main.append(f"<h1>{said(_sentence(r, 1, 9)[:-1])}</h1>")
    main += [part() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20]))]
    if r.random() < 0.2:
        main.append(_boilerplate(r, r.choice(["comment", "social", "side"])))
    after = [_boilerplate(r, r.choice(["frame", "frame", "comment", "comment", "side", "menu", "advert", "social", "notice", "form"])) for _ in range(r.randint(0, 5))]
    shell = r.random()
    if shell < 0.5:
        body = ("article", "<article>")
    elif shell < 0.65:
        body = ("main", "<main>")
    elif shell < 0.95:
        body = _named(r, "main", "div div section article td")
        if body[0] == "td":
            body = ("div", body[1].replace("<td", "<div"))
    else:
        body = ("div", "<div>")
    middle = body[1] + "".join(main) + f"</{body[0]}>"
    if r.random() < 0.3:
        middle = "<main>" + middle + "</main>" if body[0] != "main" else f"<div class='wrap'>{middle}</div>"
    page = "".join(before) + middle + "".join(after)
    if r.random() < 0.3:
        page = f"<div class='{r.choice(['page', 'wrapper', 'container', 'site', 'layout'])}'>{page}</div>"
    head = f"<!DOCTYPE html><html><head><title>{_sentence(r, 2, 6)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
    return head + page + r.choice(["</body></html>", ""]), [b for b in blocks if b]


def _labels(page: Page, wanted: list[str]) -> np.ndarray:
    """Which nodes hold main text: wanted blocks, in page order, are matched one by one."""
    out = np.zeros(len(page.tag), bool)
    at = 0
    for k, text in page.blocks:
        if at < len(wanted) and text == wanted[at]:
            at += 1
            while k >= 0 and not out[k]:
                out[k] = True
                k = page.parent[k]
    return out


@functools.cache
def fit(pages: int = PAGES, seed: int = 0) -> boosting.Trees:
    """Trees fitted to ``pages`` made-up pages; equal arguments give equal trees, which a process fits once."""
    made = [made_up_page(seed + k) for k in range(pages)]
    parsed = [parse(source) for source, _ in made]
    x, _ = features(parsed)
    y = np.concatenate([_labels(p, wanted) for p, (_, wanted) in zip(parsed, made, strict=True)])
    return boosting.fit(x, y.astype(float))


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, trees: boosting.Trees | None = None) -> DataFrame:
    """Per row of ``pages``: (page_id, url, text, n_chars).

    The whole html is read; null and empty html give an empty text, null ids
    and urls stay null, rows that repeat give rows that repeat, an empty table
    gives an empty table. Other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(fit() if trees is None else trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = main_texts(shared.value, batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=_SCHEMA)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
