from pyspark.sql import functions as F

from helpers import physical, rows
from quantelle.functions import text
from quantelle.operators import annotate, labels, process, sites, summaries

CANDIDATE = ("feature int, sequence string, modifications string, score double, unique_peptides int, "
             "confidence_score double, ordinal int, accession string")


def test_reduce_features_rules(spark):
    df = spark.createDataFrame([
        (1, "AAA", None, 20.0, 2, 5.0, 1, "p1"), (1, "AAA", None, 20.0, 3, 1.0, 2, "p2"),  # most unique peptides wins
        (2, "AAA", None, 20.0, 2, 5.0, 3, "p1"), (2, "AAA", None, 20.0, 2, 9.0, 4, "p2"),  # then confidence
        (3, "AAA", None, 20.0, 2, 9.0, 6, "p1"), (3, "AAA", None, 20.0, 2, 9.0, 5, "p2"),  # then input order
        (4, "AAA", None, 20.0, None, 9.0, 7, "p1"),  # no statistics: disappears
        (5, "AAA", None, 20.0, 4, None, 8, "p1"), (5, "AAA", None, 20.0, 3, 9.0, 9, "p2"),  # winner lacks confidence
        (6, "CCC", None, 30.0, 1, 1.0, 10, "p1"), (6, "BBB", None, 30.0, 1, 1.0, 11, "p2"),  # tied score: sequence order
        (6, "AAA", None, 10.0, 9, 9.0, 12, "p3"),
        (7, "AAA", None, 50.0, None, None, 13, "p1"), (7, "BBB", None, 20.0, 1, 1.0, 14, "p2"),  # next best group
    ], CANDIDATE)
    best = process.reduce_features(df)
    assert rows(best.select("feature", "accession"), "feature") == [(1, "p2"), (2, "p2"), (3, "p2"), (6, "p2"), (7, "p2")]
    assert physical(best).count("WindowGroupLimit") == 4  # pruned before each exchange


def test_reduce_identifiers_sums_and_propagates_null(spark):
    df = spark.createDataFrame([
        ("x", 10.0, 2, 7, "late", 1.0, 1.0), ("x", 10.0, 1, 9, "early", 2.0, None), ("x", 5.0, 0, 1, "low", 3.0, 1.0),
        ("y", 1.0, 3, 1, "only", 4.0, 0.0)], "identifier string, score double, ordinal int, feature int, tag string, s1 double, s2 double")
    got = process.reduce_identifiers(df, ["s1", "s2"]).select("identifier", "tag", "s1", "s2")
    assert rows(got, "identifier") == [("x", "early", 6.0, None), ("y", "only", 4.0, 0.0)]


def test_row_filters_follow_three_valued_logic(spark):
    df = spark.createDataFrame([("---", "a"), ("13", "b"), ("13.5", None), (None, "cRAP"), ("99", "cRAP")],
                               "score string, description string")
    assert rows(process.filter_score(df).select("score"), "score") == [(13.5,), (99.0,)]
    assert rows(process.drop_contaminants(df).select("score"), "score") == [("---",), ("13",)]


def test_accession_groups(spark):
    df = spark.createDataFrame([("a;b;c", 1, 1, 1.0), ("d", 2, 2, 2.0)],
                               "accession string, peptide_count int, unique_peptides int, confidence_score double")
    assert rows(process.split_accession_group(df).select("accession", "group_members"), "accession") == [
        ("a", "b;c"), ("d", None)]
    assert [r[0] for r in process.explode_accessions(df).orderBy("accession").collect()] == ["a", "b", "c", "d"]


def test_site_identifiers(spark):
    db = spark.createDataFrame([("P", "MAASCTCK"), ("Q", "MMMM")], "accession string, sequence string")
    df = spark.createDataFrame([
        (1, "P", "SCTC", "[1] Phospho (ST)|[2] Nethylmaleimide (C)|[3] Phospho (ST)"),
        (2, "Q", "SCTC", "[1] Phospho (ST)"),  # not part of its protein
        (3, "P", "SCTC", "[2] Nethylmaleimide (C)"), (4, "P", "SCTC", None), (5, "Z", "SCTC", "[1] Phospho (ST)"),
        (6, "P", "SCTC", "Phospho (ST)"),  # no position
    ], "feature int, accession string, sequence string, modifications string")
    phospho = sites.phospho_identifier(df, db)
    assert rows(phospho.select("feature", "identifier"), "feature") == [
        (1, "P--S4-T6"), (2, None), (5, None), (6, None)]
    located, rejected = sites.split_located(phospho)
    assert located.count() == 1 and rejected.count() == 3
    redox = sites.redox_identifier(process.filter_redox(df), db)
    assert rows(redox.select("feature", "identifier"), "feature") == [
        (1, "P--C7"), (2, None), (3, "P--C7"), (4, "P--C5-C7"), (5, None), (6, "P--C5-C7")]
    cys = sites.explode_cys_sites(df.where("feature in (1, 4)"))
    assert rows(cys.select("feature", "cys", "blocked"), "feature", "cys") == [
        (1, 2, True), (1, 4, False), (4, 2, False), (4, 4, False)]
    assert sites.explode_cys_sites(df.where("feature = 1"), drop_blocked=True).count() == 1
    pruned = sites.attach_sequence(df, db, prune=True)
    assert pruned.count() == 6 and pruned.where("protein_sequence is null").count() == 1


def test_empty_and_cysteine_free_peptides(spark):
    df = spark.createDataFrame([(1, "P", "", None), (2, "P", "AAA", None), (3, "P", None, None)],
                               "feature int, accession string, sequence string, modifications string")
    assert sites.explode_cys_sites(df).count() == 0
    assert process.filter_redox(df).count() == 0


def test_peptide_stripping(spark):
    df = spark.createDataFrame([("K.AC(+125.05)DE(-1).R",), ("ACD.K",), ("M.ACDE",), ("G.ACDE.K",), ("R.A.B.C",)], "peptide string")
    got = [r[0] for r in df.select(text.strip_peptide(F.col("peptide"))).collect()]
    assert got == ["ACDE", "ACD", "ACDE", "GCDE.K", "A.C"]
    assert df.select(text.strip_peptide(F.col("peptide"), r"^[A-Z]\.")).collect()[3][0] == "ACDE"


def test_label_states(spark):
    df = spark.createDataFrame([
        ("i", "C2:N-ethylmaleimide(D5):1000.00", 1.0, 3.0), ("i", "C2:N-ethylmaleimide:20.5", 3.0, 0.0),
        ("j", "C2:N-ethylmaleimide:20.5", 5.0, 5.0), ("k", "C2:N-ethylmaleimide(D5):0.10", 2.0, 2.0)],
        "identifier string, ascore string, s1 double, s2 double")
    tagged = labels.tag_label_state(df)
    assert rows(tagged.select("label_identifier", "h_or_l", "modification"), "label_identifier") == [
        ("i-H", 2, "C2:N-ethylmaleimide(D5)"), ("i-L", 1, "C2:N-ethylmaleimide"), ("j-L", 1, "C2:N-ethylmaleimide"),
        ("k-H", 2, "C2:N-ethylmaleimide(D5)")]
    state = labels.redox_state(tagged)
    assert {(r.identifier, r.redox_state) for r in state.collect()} == {("i", 2), ("j", 1), ("k", 1)}
    assert rows(labels.percent_oxidized(state, ["s1", "s2"])) == [("i-H", 0.25, 1.0)]
    split = labels.split_reduced_oxidized(state)
    assert rows(split.select("identifier", "red_or_ox"), "identifier") == [("j", "Reduced"), ("k", "Oxidized")]


def test_undefined_share_is_zero(spark):
    df = spark.createDataFrame([("i", 2, 2, 0.0), ("i", 1, 2, 0.0)], "identifier string, h_or_l int, redox_state int, s1 double")
    assert rows(labels.percent_oxidized(df, ["s1"])) == [("i-H", 0.0)]


def test_accessions_and_annotation(spark):
    df = spark.createDataFrame([("sp|E1|N--S1-T2--x",), ("plain",), (None,)], "identifier string")
    split = annotate.add_accession(df)
    assert rows(split, F.col("identifier").desc_nulls_last()) == [
        ("sp|E1|N--S1-T2--x", "sp|E1|N", "S1-T2"), ("plain", "plain", None), (None, None, None)]
    notes = spark.createDataFrame([("E1", "kinase")], "entry string, note string")
    joined = annotate.add_annotation(split, notes)
    assert {(r.accession, r.note) for r in joined.collect()} == {("E1", "kinase"), ("", None), (None, None)}


def test_terms(spark):
    long_name = "x" * 60
    df = spark.createDataFrame([
        ("p", "A", f"alpha [GO:0000001]; {long_name} [GO:0000002]", 1), ("p", "B", "never [GO:0000009]", 2),
        ("q", "B", "alpha [GO:0000001]", 3), ("r", "B", None, 4)],
        "accession string, cluster string, `Gene ontology (process)` string, ordinal int")
    terms = annotate.explode_terms(df, ordinal="ordinal")
    assert rows(terms, "accession", "term") == [
        ("p", "process", "alpha"), ("p", "process", "x" * 47 + "..."), ("q", "process", "alpha")]
    assert rows(annotate.go_top_terms(df, 1, ordinal="ordinal")) == [("process", "alpha", 2)]
    by_cluster = annotate.go_top_terms_by_cluster(df, 1, ordinal="ordinal")
    assert rows(by_cluster.select("term", "cluster", "n"), "cluster") == [("alpha", "A", 1), ("alpha", "B", 1)]


def test_site_counts(spark):
    df = spark.createDataFrame([("p--S1-S2", "p", "S1-S2"), ("p--S2", "p", "S2"), ("q--S1", "q", "S1"), ("r", "r", None)],
                               "identifier string, accession string, sites string")
    got = summaries.site_counts(df).select("identifier", "sites_identifier", "identifiers_accession", "sites_accession")
    assert rows(got, "identifier") == [("p--S1-S2", 2, 2, 2), ("p--S2", 1, 2, 2), ("q--S1", 1, 1, 1), ("r", None, 1, 1)]
    assert summaries.sites_per_accession(summaries.site_counts(df)).count() == 3


def test_counts_and_truncation(spark):
    df = spark.createDataFrame([("a" * 30,)] * 3 + [("b",)] + [(None,)], "v string")
    got = summaries.count_terms(df, "v", 1).collect()
    assert [(r.n, r.freq, r.term) for r in got] == [(3, 0.75, "a" * 22 + "...")]


def test_protein_texts_do_not_reach_the_rows(spark):
    """Only positions are joined to peptide rows, of which equal ones are looked up once."""
    df = spark.createDataFrame([(i, "P1" if i % 2 else None, "AC" if i % 3 else "GG") for i in range(60)], "feature int, accession string, sequence string")
    db = spark.createDataFrame([("P1", "MKACAC"), ("P2", "AC")], "accession string, sequence string")
    found = sites.locate_peptides(df, db)
    assert {(r.accession, r.sequence, r.start) for r in found.collect()} == {("P1", "AC", 3), ("P1", "GG", None), (None, "AC", None), (None, "GG", None)}
    assert found.count() == 60 and found.columns == [*df.columns, "start"]
    plan = found._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().apply(0)
    sides = [plan.children().apply(i).output().mkString(",") for i in (0, 1)]
    assert not any("_protein" in s for s in sides) and "start" in sides[1]


def test_labelled_sites_as_by_state_and_reduction(spark):
    df = spark.createDataFrame([
        ("A--C1", "A--C1-H", 2, 5.0, 1, 1.0), ("A--C1", "A--C1-L", 1, None, 2, 2.0),  # light without a score: both states, one row
        ("A--C2", "A--C2-H", 2, 3.0, 3, None), ("A--C2", "A--C2-H", 2, 4.0, 4, 1.0), ("A--C2", "A--C2-L", 1, 4.0, 5, 1.0), ("A--C2", "A--C2-L", 1, 4.0, 6, 3.0),
        ("A--C3", "A--C3-L", 1, 1.0, 7, 4.0), ("A--C4", "A--C4-H", 2, None, 8, 4.0)],
        "identifier string, label_identifier string, h_or_l int, lgp double, scan long, s1 double")
    want = process.reduce_identifiers(labels.redox_state(df), ["s1"], "label_identifier", "lgp", ["scan"])
    got = labels.reduce_labelled(df, ["s1"])
    assert got.columns == want.columns and rows(got, "label_identifier") == rows(want, "label_identifier") and got.count() == 4
    assert {r.label_identifier: r.redox_state for r in got.collect()}["A--C1-H"] == 2
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString() and "checkpoint" not in got._jdf.queryExecution().executedPlan().toString()
