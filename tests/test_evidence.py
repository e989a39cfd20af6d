import pytest

from lattica.operators import evidence


@pytest.mark.parametrize(
    "query, terms",
    [
        ("MATCH (a:Gadget)-[:HAS_COLOR]->(c:Color {id: 'x'}) RETURN a", {"Gadget", "HAS_COLOR", "Color"}),
        ("MATCH (a:A|B&!C)-[r:X|Y*1..3]-() WHERE a:D RETURN a", {"A", "B", "C", "X", "Y", "D"}),
        ("// (n:No)\nMATCH (n /* :No */) WHERE n.name = ':No' RETURN {key: n.id}", set()),
        ("MATCH (n:`My Label`) RETURN n.x::INTEGER", {"My Label"}),
    ],
)
def test_terms(query, terms):
    assert evidence.query_terms(query) == terms
    evidence.check_terms(query, terms)


def test_refusals():
    with pytest.raises(evidence.RejectedQuery):
        evidence.check_terms("MATCH (n:Secret) RETURN n", {"Open"})
    with pytest.raises(evidence.RejectedQuery):
        evidence.query_terms("MATCH (n:$(label)) RETURN n")


def test_log_and_rendering(spark, monkeypatch):
    monkeypatch.setattr(evidence, "MOST_ROWS", 3)
    log = evidence.EvidenceLog()
    first = log.record(spark.range(5))
    assert (first.number, first.status, len(first.rows), first.truncated) == (1, "ok", 3, True)
    assert log.record(spark.range(0)).status == "empty" and log.record(None, "no", "rejected").number == 3
    assert evidence.render(first).startswith("[1] 3+ rows\nid\n0")


def test_citations(spark):
    claims = spark.createDataFrame([("c1", 1, "n"), ("c2", 1, "m"), ("c3", 9, None)], "claim string, evidence int, node string")
    got = evidence.citation_issues(claims, spark.createDataFrame([(1,)], "evidence int"), spark.createDataFrame([(1, "n")], "evidence int, node string"))
    assert {r.claim: r.issue for r in got.collect()} == {"c2": "node is not in the evidence", "c3": "no such evidence"}


def test_text_helpers():
    assert evidence.number_footnotes("a [e7] b [e2] c [e7]") == ("a [1] b [2] c [1]", ["e7", "e2"])
    assert evidence.fill_prompt("{{a}}-{{b}}", {"a": "1", "b": "2"}) == "1-2"
    with pytest.raises(ValueError):
        evidence.fill_prompt("{{a}}", {})
