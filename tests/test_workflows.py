import pytest

from helpers import rows
from quantelle.design import Contrast, Design
from quantelle.operators import labels
from quantelle.plans import workflows

SAMPLES = ["a1", "a2", "a3", "b1", "b2", "b3"]


@pytest.fixture(scope="module")
def database(spark):
    return spark.createDataFrame([("P", "MACDEFCGHK"), ("Q", "MKKCAAA")], "accession string, sequence string")


def test_labelled_sites_to_change_in_oxidation(spark, database):
    heavy, light = "C2:N-ethylmaleimide(D5):99.0;M1:Oxidation:1.0", "C2:N-ethylmaleimide:99.0"
    peptides = spark.createDataFrame([
        (1, "P", "K.ACDE.F", heavy, 10.0, *[1.0, 1.1, 0.9, 3.0, 3.1, 2.9]),
        (2, "P", "K.ACDE.F", light, 20.0, *[9.0, 8.9, 9.1, 7.0, 6.9, 7.1]),
        (3, "P", "M.A(+1)CDE.F", light, 30.0, *[0.0] * 6),
        (4, "Q", "K.KCAA.A", light, 30.0, *[5.0] * 6),  # one state only
        (5, "Q", "K.WWWW.A", light, 30.0, *[5.0] * 6),  # not part of its protein
    ], "scan int, accession string, peptide string, ascore string, lgp double, " + ", ".join(f"{s} double" for s in SAMPLES))
    sites = workflows.labelled_sites(peptides, database, SAMPLES)
    got = sites.select("label_identifier", "scan", "a1", "redox_state")
    assert rows(got, "label_identifier") == [("P--C3-H", 1, 1.0, 2), ("P--C3-L", 3, 9.0, 2), ("Q--C4-L", 4, 5.0, 1)]
    assert rows(labels.split_reduced_oxidized(sites).select("identifier", "red_or_ox")) == [("Q--C4", "Reduced")]
    design = Design.from_counts({"WT": 3, "H2O2": 3})
    result = workflows.occupancy_analysis(sites, SAMPLES, design, [Contrast("WT", "H2O2")])
    r = result.tests.first()
    assert (r.identifier, r.comparison) == ("P--C3-H", "WT-H2O2")
    assert r.fc == pytest.approx(0.2) and r.p_value == r.fdr < 1e-4


def test_peptides_to_sites(spark, database):
    peptides = spark.createDataFrame([
        (1, 1, "20", "ACDE", "[2] Phospho (C)", "P", "kinase", 1.0), (1, 2, "30", "ACDE", "[2] Phospho (C)", "P", "kinase", 2.0),
        (2, 3, "40", "ACDE", "[2] Phospho (C)", "P", "kinase", 4.0), (3, 4, "---", "FCGH", None, "P", "kinase", 8.0),
        (4, 5, "50", "FCGH", None, "P", "cRAP", 16.0), (5, 6, "50", "FCGH", None, "P", "kinase", 32.0)],
        "feature int, ordinal int, score string, sequence string, modifications string, accession string, "
        "description string, s double")
    proteins = spark.createDataFrame([("P;R", 3, 2, 9.0, "kinase"), ("Q", 1, 1, 1.0, "x")],
                                     "accession string, peptide_count int, unique_peptides int, confidence_score double, "
                                     "description string")
    assert rows(workflows.phospho_abundance(peptides, proteins, database, ["s"])) == [("P--C3", 6.0)]
    assert rows(workflows.redox_abundance(peptides, proteins, database, ["s"]), "identifier") == [("P--C3", 6.0), ("P--C7", 32.0)]
    assert rows(workflows.peptide_abundance(peptides, proteins, ["s"]), "identifier") == [("P--ACDE", 6.0), ("P--FCGH", 32.0)]
    assert rows(workflows.protein_abundance(proteins, ["confidence_score"])) == [("P", 9.0)]
