"""Reference joins on small tables."""

from pyspark.sql import functions as F

from lattica.operators import reference as ref


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, columns, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c in columns.split()))


def test_moves_and_machines(spark):
    moves = table(spark, "id identifier power accuracy pp priority type_id damage_class_id effect_id", ("1", "pound", "40", "100", "35", "0", "t1", "c1", "e1"), ("2", "old-name", "", "", "5", "-1", "t1", "c1", "e2"), ("10001", "shadow", "1", "1", "1", "0", "t1", "c1", "e1"))
    types, classes = table(spark, "id identifier", ("t1", "normal")), table(spark, "id identifier", ("c1", "physical"))
    meta = table(spark, "move_id crit_rate min_hits max_hits", ("1", "1", "2", "5"))
    prose = table(spark, "move_effect_id local_language_id short_effect", ("e1", "9", "Hits."), ("e1", "5", "Touche."), ("e2", "9", ""))
    got = {r.move: r for r in ref.move_index(moves, types, classes, meta, prose, below=10000, renamed={"old-name": "new-name"}, crit_stages={"1": 2}).collect()}
    assert set(got) == {"pound", "new-name"} and (got["pound"].power, got["pound"].crit_stage, got["pound"].max_hits, got["pound"].effect_text) == (40, 2, 5, "Hits.")
    assert (got["new-name"].power, got["new-name"].has_meta, got["new-name"].effect_text, got["new-name"].priority) == (None, False, None, -1)
    machines = table(spark, "version_group_id item_id move_id", ("1", "i1", "1"), ("2", "i1", "1"), ("3", "i1", "1"), ("1", "i2", "1"))
    keys = ref.machine_keys(machines, table(spark, "id identifier", ("i1", "tm07"), ("i2", "berry")), table(spark, "id identifier", ("1", "red"), ("2", "red-dlc"), ("3", "stadium")), skipped=["stadium"], folded={"red-dlc": "red"})
    assert rows(keys) == [("1", "TM", 7, "red")]
    page = spark.createDataFrame([("pound", "TM", 7, "red"), ("pound", "HM", 1, "red"), ("lost", "TM", 1, "red")], "move string, kind string, number int, version_group string")
    own = spark.createDataFrame([("pound", "TM", 7, "red"), ("pound", "TM", 8, "blue")], page.schema)
    assert rows(ref.machine_differences(page, own)) == [("pound", "HM1 red", "page"), ("pound", "TM8 blue", "table")]
    found = ref.ability_index(table(spark, "id identifier", ("1", "stench"), ("2", "none")), table(spark, "ability_id local_language_id short_effect", ("1", "9", "Smells."), ("7", "9", "x")))
    assert rows(found) == [("none", None), ("stench", "Smells.")]


def test_forms_labels_and_mentions(spark):
    names, forms = table(spark, "name base", ("Alpha", "alpha")), table(spark, "id", ("alpha",), ("alpha-x",))
    got = ref.resolve_forms(table(spark, "name code", ("Alpha", None), ("Alpha", "x"), ("Alpha", "y"), ("Beta", "x")), names, forms)
    assert rows(got) == [("Alpha", "x", "alpha-x", False), ("Alpha", "y", "alpha", True), ("Alpha", None, "alpha", False), ("Beta", "x", None, False)]
    people = table(spark, "class label id", ("Type", "Fire", "fire"))
    assert rows(ref.resolve_labels(table(spark, "class label", ("Type", "Fire"), ("Type", "Ice")), people)) == [("Type", "Fire", "fire"), ("Type", "Ice", None)]
    said = table(spark, "subject class target", ("alpha", "PokemonSpecies", "Alpha"), ("b", "PokemonSpecies", "Alpha"), ("b", "Type", "Fire"), ("b", "Move", "Mega Kick"), ("b", "Type", "Ice"))
    got = {(r.subject, r.target): (r.id, r.how) for r in ref.resolve_mentions(said, table(spark, "name id", ("Alpha", "alpha")), people, ["Move"]).collect()}
    assert got == {("alpha", "Alpha"): ("alpha", "self"), ("b", "Alpha"): ("alpha", "species"), ("b", "Fire"): ("fire", "individual"), ("b", "Mega Kick"): ("mega-kick", "stub"), ("b", "Ice"): (None, "unresolved")}
    assert rows(ref.title_index(table(spark, "title", ("Mr. Mime (x)",), ("Abra (x)",)), " (x)")) == [("Abra", "abra"), ("Mr. Mime", "mr-mime")]


def test_owners_and_counts(spark):
    stubs = table(spark, "class id", ("A", "1"), ("A", "1"), ("A", "2"), ("B", "1"), ("B", "2"))
    assert rows(ref.unowned(stubs, table(spark, "class id", ("A", "2"), ("B", "1")), ["class", "id"])) == [("A", "1", 2), ("B", "2", 1)]
    assert rows(ref.miss_counts(stubs, table(spark, "class id", ("A", "2")), table(spark, "class id", ("B", "1")), ["B"])) == [(1, 1)]
    assert [tuple(r) for r in ref.ranked_counts(stubs, "id").collect()] == [("1", 3), ("2", 2)]
    assert rows(ref.case_counts(table(spark, "class id", ("A", None), ("A", "2")), ["class", "id"])) == [("class", "A", 2), ("id", "2", 1), ("id", "none", 1)]
    flags = spark.createDataFrame([(["a"], ["b", "a"], ["c"], ["b"])], "f array<string>, c array<string>, a array<string>, r array<string>")
    assert flags.select(ref.final_flags(*[F.col(x) for x in "fcar"])).first()[0] == ["a", "c"]


def test_locations(spark):
    pages = table(spark, "title wikitext", ("town", "{{Infobox location|n=1}}\nx\n== A ==\n"), ("Hill", "text\n== B ==\n{{infobox location}}"), ("Old town", "#REDIRECT [[Town]]"), ("Older", "#REDIRECT [[Old town]]"), ("Far", "#REDIRECT [[Nowhere]]"), ("To move", "#REDIRECT [[Cut]]"))
    index = ref.location_index(pages, table(spark, "title", ("Cut",), ("cut",)), ["infobox location"])
    got = {r.title: (r.verdict, r.page) for r in ref.classify_locations(table(spark, "title", ("town",), ("Hill",), ("Old_town",), ("Older",), ("Far",), ("To move",), ("cut",), ("New",)), index).collect()}
    assert got == {
        "town": ("location", "Town"),
        "Hill": ("not_a_location", "Hill"),
        "Old_town": ("location", "Town"),
        "Older": ("not_a_location", "Older"),
        "Far": ("unknown_location", "Nowhere"),
        "To move": ("not_a_location", "To move"),
        "cut": ("not_a_location", "Cut"),
        "New": ("unknown_location", "New"),
    }
    assert rows(ref.candidate_titles(index, table(spark, "title", ("new",), ("Cut",)))) == [(t,) for t in ("Far", "Hill", "New", "Old town", "Older", "To move", "Town")]
