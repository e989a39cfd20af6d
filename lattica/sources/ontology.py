"""Ontologies and individuals from Turtle: classes, properties, labels, and the nodes and edges of reference data.

An ontology is small (hundreds of classes), so it is read by the driver; what
comes of it, closures and rows, are DataFrames.
"""

from __future__ import annotations

import tomllib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lattica.operators.validate import Ontology
from lattica.sources.turtle import RDF, XSD, Term, Triple, read_turtle

RDFS, OWL = "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"
TYPE = RDF + "type"


def local_name(iri: str) -> str:
    """What follows the last # or, without one, the last slash."""
    return iri.rpartition("#")[2] if "#" in iri else iri.rpartition("/")[2]


def objects(triples: Iterable[Triple], subject: str, predicate: str) -> list[Term]:
    return [o for s, p, o in triples if s.value == subject and p.value == predicate]


def closure(direct: Mapping[str, Iterable[str]]) -> dict[str, frozenset[str]]:
    """All that each key reaches, itself left out; circles end."""
    out = {}
    for start in direct:
        reached: set[str] = set()
        front = set(direct[start])
        while front:
            reached |= front
            front = {b for a in front for b in direct.get(a, ())} - reached
        out[start] = frozenset(reached - {start})
    return out


@dataclass(frozen=True)
class Model:
    """Classes with ancestors, and properties with domains, ranges and datatypes, all by IRI."""

    ancestors: Mapping[str, frozenset[str]]
    object_properties: frozenset[str]
    datatype_properties: frozenset[str]
    domains: Mapping[str, frozenset[str]]
    ranges: Mapping[str, frozenset[str]]
    datatypes: Mapping[str, str]

    def labels(self, iri: str) -> list[str]:
        """A class's own label, then those of its ancestors by name."""
        return [local_name(iri), *sorted(map(local_name, self.ancestors.get(iri, ())))]

    def key_label(self, iri: str, key_classes: Iterable[str]) -> str:
        """The nearest of ``key_classes`` among the class and its ancestors: the one with the most ancestors of its own, then the greatest IRI."""
        keys = set(key_classes)
        if nested := sorted(k for k in keys if keys & self.ancestors.get(k, frozenset())):
            raise ValueError(f"key classes lie within others: {', '.join(map(local_name, nested))}")
        found = [c for c in {iri, *self.ancestors.get(iri, ())} if c in keys]
        return local_name(max(found, key=lambda c: (len(self.ancestors.get(c, ())), c))) if found else local_name(iri)

    def ontology(self) -> Ontology:
        """By local names, as the checks take it."""
        names = lambda of: {local_name(k): frozenset(map(local_name, v)) for k, v in of.items()}
        return Ontology(names(self.ancestors), names(self.domains), names(self.ranges), {local_name(k): local_name(v) for k, v in self.datatypes.items()})


def _members(triples: Sequence[Triple], node: Term) -> frozenset[str]:
    """Classes that a domain or range names: itself, or the members of unions, within one another too."""
    if node.kind == "iri":
        return frozenset([node.value])
    out: set[str] = set()
    for heads in (objects(triples, node.value, OWL + "unionOf"),):
        for at in heads:
            while at.value != RDF + "nil":
                for first in objects(triples, at.value, RDF + "first"):
                    out |= _members(triples, first)
                at = next(iter(objects(triples, at.value, RDF + "rest")), Term("iri", RDF + "nil"))
    return frozenset(out)


def _inherited(own: Mapping[str, frozenset[str]], above: Mapping[str, set[str]], properties: Iterable[str]) -> dict[str, frozenset[str]]:
    """Each property's classes, or else those of the nearest level of properties above it that has any."""
    out = {}
    for p in properties:
        level, met = {p}, set()
        while level and not any(own.get(q) for q in level):
            met |= level
            level = {b for q in level for b in above.get(q, ())} - met
        if found := frozenset().union(*[own.get(q, frozenset()) for q in level]) if level else frozenset():
            out[p] = found
    return out


def model(triples: Sequence[Triple]) -> Model:
    """The model that an ontology's triples describe."""
    of_type = lambda name: {s.value for s, p, o in triples if p.value == TYPE and o.value == OWL + name and s.kind == "iri"}
    direct: dict[str, set[str]] = {c: set() for c in of_type("Class")}
    above: dict[str, set[str]] = {}
    for s, p, o in triples:
        if p.value == RDFS + "subClassOf" and o.kind == "iri" and s.kind == "iri":
            direct.setdefault(s.value, set()).add(o.value)
        elif p.value == RDFS + "subPropertyOf":
            above.setdefault(s.value, set()).add(o.value)
    links, values = of_type("ObjectProperty"), of_type("DatatypeProperty")
    own = {name: {q: frozenset().union(*[_members(triples, o) for o in objects(triples, q, RDFS + name)]) for q in links | values} for name in ("domain", "range")}
    types = {q: min(r) for q in values if (r := [x for x in own["range"][q] if x.startswith(XSD)])}
    return Model(closure(direct), frozenset(links), frozenset(values), _inherited(own["domain"], above, links | values), _inherited(own["range"], above, links), types)


def read_model(paths: Iterable[str | Path]) -> Model:
    return model([t for p in sorted(map(str, paths)) for t in read_turtle(Path(p).read_text(encoding="utf-8"))])


def _value(term: Term, datatype: str | None) -> object:
    kind = local_name(term.datatype or datatype or "string")
    if kind in ("integer", "int", "long", "nonNegativeInteger", "positiveInteger"):
        return int(term.value)
    if kind in ("decimal", "double", "float"):
        return float(term.value)
    return term.value == "true" if kind == "boolean" else term.value


class BadIndividuals(ValueError):
    """All that is wrong with a file of individuals."""


@dataclass(frozen=True)
class Individuals:
    """Rows of reference data: (class IRI, id, name, values by property) and (property IRI, subject key, object key)."""

    nodes: list[tuple[str, str, str, dict[str, object]]]
    edges: list[tuple[str, tuple[str, str], tuple[str, str]]]

    def tables(self, spark: SparkSession, m: Model, universe: str) -> tuple[DataFrame, DataFrame]:
        """(universe, label, id, labels, name, values as texts) and (universe, property, src_label, src_id, dst_label, dst_id)."""
        texts = lambda v: {local_name(k): str(x) for k, x in sorted(v.items())}
        nodes = [(universe, local_name(c), i, m.labels(c), n, texts(v)) for c, i, n, v in self.nodes]
        edges = [(universe, local_name(p), local_name(a[0]), a[1], local_name(b[0]), b[1]) for p, a, b in self.edges]
        return (
            spark.createDataFrame(nodes, "universe string, label string, id string, labels array<string>, name string, values map<string,string>"),
            spark.createDataFrame(edges, "universe string, property string, src_label string, src_id string, dst_label string, dst_id string"),
        )


def individuals(triples: Sequence[Triple], m: Model, slug) -> Individuals:  # noqa: ANN001
    """Nodes and edges of a file of individuals; ``slug`` makes an id of a name.

    Every subject has one declared class and one English label, and only
    declared properties; links end at individuals of the file. What is wrong is
    told all at once, and nothing is returned then.
    """
    wrong: list[str] = []
    by_subject: dict[str, list[tuple[str, Term]]] = {}
    for s, p, o in triples:
        if s.kind == "iri":
            by_subject.setdefault(s.value, []).append((p.value, o))
    by_subject = {s: said for s, said in by_subject.items() if not any(p == TYPE and o.value == OWL + "Ontology" for p, o in said)}
    keys: dict[str, tuple[str, str]] = {}
    nodes = []
    for s, said in sorted(by_subject.items()):
        classes = [o.value for p, o in said if p == TYPE and o.value != OWL + "NamedIndividual"]
        names = [o.value for p, o in said if p == RDFS + "label" and o.language == "en"]
        if len(classes) != 1 or classes[0] not in m.ancestors:
            wrong.append(f"{s}: one declared class expected")
        elif len(names) != 1:
            wrong.append(f"{s}: one English label expected")
        else:
            found: dict[str, object] = {}
            for p, o in said:
                if p in m.datatype_properties:
                    value = _value(o, m.datatypes.get(p))
                    found[p] = sorted([*(v if isinstance(v := found[p], list) else [v]), value]) if p in found else value
            keys[s] = classes[0], slug(names[0])
            nodes.append((*keys[s], names[0], found))
    edges = []
    for s, said in sorted(by_subject.items()):
        for p, o in said:
            if p in m.object_properties:
                if o.value not in keys:
                    wrong.append(f"{s}: {local_name(p)} ends at {o.value}, which is no individual of the file")
                elif s in keys:
                    edges.append((p, keys[s], keys[o.value]))
            elif p not in m.datatype_properties and not p.startswith((RDF, RDFS, OWL)):
                wrong.append(f"{s}: {p} is not declared")
    twice = sorted({f"{local_name(k[0])}/{k[1]}" for k in keys.values() if list(keys.values()).count(k) > 1})
    wrong += [f"{k}: several individuals have this key" for k in twice]
    if wrong:
        raise BadIndividuals("\n".join(wrong))
    return Individuals(nodes, sorted(edges))


@dataclass(frozen=True)
class Universe:
    """A universe's manifest: its prefix, title and files."""

    prefix: str
    title: str
    files: Mapping[str, Path]


def universes(folder: str | Path) -> dict[str, Universe]:
    """Manifests ``universe.toml`` of the folders in ``folder``, by prefix.

    The prefix is the folder's name, and files lie within the folder; anything
    else is an error that names the folder.
    """
    out = {}
    for path in sorted(Path(folder).glob("*/universe.toml")):
        said = tomllib.loads(path.read_text(encoding="utf-8"))
        home = path.parent.resolve()
        if said.get("prefix") != home.name:
            raise ValueError(f"{home.name}: the prefix must be the folder's name")
        files = {k: (home / v).resolve() for k, v in said.get("files", {}).items()}
        for name, file in files.items():
            if home not in file.parents or not file.is_file():
                raise ValueError(f"{home.name}: {name} must be a file in the folder")
        out[home.name] = Universe(home.name, str(said.get("title", home.name)), files)
    return out


def select_universe(known: Mapping[str, Universe], wanted: str | None = None) -> Universe:
    """The universe asked for, or the only one there is."""
    if wanted is None and len(known) == 1:
        return next(iter(known.values()))
    if wanted not in known:
        raise ValueError(f"choose one of: {', '.join(sorted(known)) or 'none'}")
    return known[wanted]
