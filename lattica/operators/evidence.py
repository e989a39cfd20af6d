"""Guarded queries and their results as evidence: allowed terms, caps, slices, rendering, citation checks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS, SHOWN_ROWS = 5000, 50

_LEXEME = re.compile(r"""//[^\n]*|/\*.*?(?:\*/|\Z)|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|(?P<quoted>`(?:[^`]|``)*`)|(?P<word>[A-Za-z_]\w*)|(?P<mark>::|\$\(|[:{}()\[\]|&!,.])|\S""", re.S)


class RejectedQuery(ValueError):
    """A query names what it may not, or could."""


def query_terms(query: str) -> set[str]:
    """Labels and relationship types that a graph query names: what follows a colon in a node or relationship pattern.

    Strings, comments, the keys of maps and casts don't count. A term computed
    at run time is refused.
    """
    found: set[str] = set()
    lexemes = [(m.lastgroup, m[0]) for m in _LEXEME.finditer(query) if m[0][:2] not in ("//", "/*") and m[0][0] not in "'\""]
    depth = 0  # of maps
    k = 0
    while k < len(lexemes):
        kind, text = lexemes[k]
        if text == "{":
            depth += 1
        elif text == "}":
            depth = max(0, depth - 1)
        elif text == ":" and not depth:
            k += 1
            while k < len(lexemes):
                kind, text = lexemes[k]
                if text == "$(":
                    raise RejectedQuery("labels and types must be written out")
                if kind == "quoted":
                    found.add(text[1:-1].replace("``", "`"))
                elif kind == "word":
                    found.add(text)
                elif text not in ("|", "&", "!", "(", ")", ":"):
                    break
                if kind in ("quoted", "word") and (k + 1 >= len(lexemes) or lexemes[k + 1][1] not in ("|", "&", ":")):
                    break
                k += 1
        k += 1
    return found


def check_terms(query: str, allowed: Iterable[str]) -> None:
    """Raises RejectedQuery with the names that are not allowed."""
    if unknown := sorted(query_terms(query) - set(allowed)):
        raise RejectedQuery(f"unknown terms: {', '.join(unknown)}")


@dataclass(frozen=True)
class Evidence:
    """What a query gave: status ok, empty, rejected or failed."""

    number: int
    status: str
    columns: Sequence[str] = ()
    rows: Sequence[tuple] = ()
    truncated: bool = False
    message: str = ""


@dataclass
class EvidenceLog:
    """Numbers evidence in the order of the calls."""

    items: list[Evidence] = field(default_factory=list)

    def record(self, df: DataFrame | None, message: str = "", status: str = "ok") -> Evidence:
        """The first MOST_ROWS rows of a result; one more is read to tell whether there are others."""
        number = len(self.items) + 1
        if df is None:
            item = Evidence(number, status, message=message)
        else:
            rows = df.limit(MOST_ROWS + 1).collect()
            item = Evidence(number, "ok" if rows else "empty", df.columns, [tuple(r) for r in rows[:MOST_ROWS]], len(rows) > MOST_ROWS)
        self.items.append(item)
        return item


def render(item: Evidence) -> str:
    """A padded table of the first SHOWN_ROWS rows, with how many there are."""
    if item.status in ("rejected", "failed"):
        return f"[{item.number}] {item.status}: {item.message}"
    lines = [tuple(map(str, item.columns)), *[tuple("" if v is None else str(v) for v in r) for r in item.rows[:SHOWN_ROWS]]]
    widths = [max(len(line[k]) for line in lines) for k in range(len(item.columns))]
    body = "\n".join(" | ".join(v.ljust(w) for v, w in zip(line, widths, strict=True)).rstrip() for line in lines)
    total = f"{len(item.rows)}{'+' if item.truncated else ''} rows" + (f", {SHOWN_ROWS} shown" if len(item.rows) > SHOWN_ROWS else "")
    return f"[{item.number}] {total}\n{body}"


def citation_issues(claims: DataFrame, evidence: DataFrame, nodes: DataFrame) -> DataFrame:
    """(claim, evidence, node, issue) of citations whose evidence doesn't exist or doesn't hold the node.

    claims: claim, evidence, node. evidence: evidence. nodes: evidence, node.
    """
    known = evidence.select("evidence").distinct().withColumn("_e", F.lit(True))
    held = nodes.select("evidence", "node").distinct().withColumn("_n", F.lit(True))
    rows = claims.join(known, "evidence", "left").join(held, ["evidence", "node"], "left")
    issue = F.when(F.col("_e").isNull(), "no such evidence").when(F.col("node").isNotNull() & F.col("_n").isNull(), "node is not in the evidence")
    return rows.withColumn("issue", issue).where("issue is not null").select("claim", "evidence", "node", "issue")


_MARKER = re.compile(r"\[(e\d+)\]")


def number_footnotes(text: str) -> tuple[str, list[str]]:
    """Markers such as [e12] numbered by first use, and the markers in that order."""
    numbers = {marker: k for k, marker in enumerate(dict.fromkeys(_MARKER.findall(text)), 1)}
    return _MARKER.sub(lambda m: f"[{numbers[m[1]]}]", text), list(numbers)


def fill_prompt(template: str, values: dict[str, str]) -> str:
    """Replaces {{markers}}; every marker needs a value and every value a marker."""
    markers = set(re.findall(r"\{\{(\w+)\}\}", template))
    if odd := markers ^ set(values):
        raise ValueError(f"markers and values differ: {', '.join(sorted(odd))}")
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values[m[1]], template)


_SPECIAL = re.compile(r'([+\-!(){}\[\]^"~*?:\\/]|&&|\|\|)')


def escape_word(word: str) -> str:
    """A word whose characters mean nothing to a full-text query."""
    return _SPECIAL.sub(r"\\\1", word)


def render_names(names: Iterable[tuple[str, Sequence[tuple[str, str, str]]]]) -> str:
    """Mentions and what they may mean, one line each: (mention, [(label, id, name)])."""
    return "\n".join(f"{mention}: " + ("; ".join(f"{name} ({label} {id_})" for label, id_, name in found) or "nothing found") for mention, found in names)


def select_questions(questions: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Questions by id, all if none is asked for; ids that no question has are an error."""
    if not ids:
        return questions
    found = questions.where(F.col("id").isin(list(ids)))
    if lost := sorted(set(ids) - {r.id for r in found.select("id").collect()}):  # as many rows as ids at most
        raise ValueError(f"no such questions: {', '.join(lost)}")
    return found
