"""Triples from the part of Turtle that ontologies use: prefixes, ; and , lists, blank nodes, collections, literals."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"

_TOKEN = re.compile(
    r'\s+|#[^\n]*|(?P<iri><[^>]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<string>"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\')'
    r"|(?P<lang>@[A-Za-z][\w-]*)|(?P<mark>\^\^|[;,.\[\]()](?!\d))|(?P<number>[+-]?(?:\d+\.\d+|\.\d+|\d+)(?:[eE][+-]?\d+)?)|(?P<name>[^\s;,\[\]()<>\"']*[^\s;,.\[\]()<>\"'])"
)
_ESCAPE = {"n": "\n", "t": "\t", "r": "\r", '"': '"', "'": "'", "\\": "\\", "b": "\b", "f": "\f"}


class Term(NamedTuple):
    kind: str  # iri, blank or literal
    value: str
    datatype: str | None = None
    language: str | None = None


Triple = tuple[Term, Term, Term]


def _unescape(text: str) -> str:
    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPE.get(m[1], m[1]), text)


def _tokens(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m or m.end() == at:
            raise ValueError(f"not Turtle at {text[at : at + 40]!r}")
        at = m.end()
        if m.lastgroup:
            yield m.lastgroup, m[0]


class _Reader:
    def __init__(self, text: str) -> None:
        self.tokens = [*_tokens(text), ("end", "")]
        self.at = 0
        self.prefixes: dict[str, str] = {}
        self.triples: list[Triple] = []
        self.blanks = 0

    def next(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def sees(self, value: str) -> bool:
        return self.tokens[self.at][1] == value and self.tokens[self.at][0] in ("mark", "name", "lang")

    def fresh(self) -> Term:
        self.blanks += 1
        return Term("blank", f"b{self.blanks}")

    def iri(self, kind: str, value: str) -> Term:
        if kind == "iri":
            return Term("iri", value[1:-1])
        prefix, mark, local = value.partition(":")
        if prefix == "_":
            return Term("blank", local)
        if not mark or prefix not in self.prefixes:
            raise ValueError(f"unknown prefix in {value!r}")
        return Term("iri", self.prefixes[prefix] + local)

    def node(self) -> Term:
        kind, value = self.next()
        if (kind, value) == ("mark", "["):
            blank = self.fresh()
            if not self.sees("]"):
                self.predicates(blank)
            self.expect("]")
            return blank
        if (kind, value) == ("mark", "("):
            items = []
            while not self.sees(")"):
                items.append(self.node())
            self.expect(")")
            head = Term("iri", RDF + "nil")
            for item in reversed(items):
                cell = self.fresh()
                self.triples += [(cell, Term("iri", RDF + "first"), item), (cell, Term("iri", RDF + "rest"), head)]
                head = cell
            return head
        if kind in ("string", "long"):
            text = _unescape(value[3:-3] if kind == "long" else value[1:-1])
            if self.tokens[self.at][0] == "lang":
                return Term("literal", text, None, self.next()[1][1:])
            if self.sees("^^"):
                self.next()
                return Term("literal", text, self.iri(*self.next()).value)
            return Term("literal", text)
        if kind == "number":
            return Term("literal", value, XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"))
        if value in ("true", "false"):
            return Term("literal", value, XSD + "boolean")
        return self.iri(kind, value)

    def expect(self, value: str) -> None:
        found = self.next()[1]
        if found != value:
            raise ValueError(f"{value!r} expected, not {found!r}")

    def predicates(self, subject: Term) -> None:
        while True:
            kind, value = self.next()
            predicate = Term("iri", RDF + "type") if value == "a" else self.iri(kind, value)
            while True:
                self.triples.append((subject, predicate, self.node()))
                if not self.sees(","):
                    break
                self.next()
            while self.sees(";"):
                self.next()
            if self.sees(".") or self.sees("]"):
                return

    def read(self) -> list[Triple]:
        while self.tokens[self.at][0] != "end":
            value = self.tokens[self.at][1]
            if value.lower() in ("@prefix", "prefix", "@base", "base"):
                self.next()
                if "prefix" in value.lower():
                    name = self.next()[1].rstrip(":")
                    self.prefixes[name] = self.next()[1][1:-1]
                else:
                    self.next()
                if self.sees("."):
                    self.next()
                continue
            subject = self.node()
            if not self.sees("."):
                self.predicates(subject)
            self.expect(".")
        return self.triples


def read_turtle(text: str) -> list[Triple]:
    """All triples, in order. Raises ValueError where the text is not of the part described."""
    return _Reader(text).read()
