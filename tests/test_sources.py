import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from quantelle import sources
from quantelle.operators import keys
from quantelle.plans import inputs, registry
from quantelle.session import ensure_checkpoint_dir
from quantelle.sources.measurements import PEPTIDE_EXPORT, unique_names

SF_DIR = "/root/testdata/sf0.001"


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_banner_csv(spark, tmp_path):
    path = write(tmp_path / "pep.csv", (
        ',,,,,,"Raw abundance",\n,,,,,,A,A\n'
        '#,Score,Sequence,Modifications,Accession,Description,run,run\n'
        '1,20.5,ACD,[2] Phospho (ST),sp|P1|X,"kinase, ""big""",100.5,0\n'
        '2,---,EFG,,sp|P2|X,cRAP,1e3,x\n'))
    df = sources.read_measurements(spark, path, samples=[7, 8], types={"#": "long"}, columns=PEPTIDE_EXPORT)
    assert df.columns == ["feature", "score", "sequence", "modifications", "accession", "description", "run", "run_2", "ordinal"]
    assert dict(df.dtypes)["feature"] == "bigint" and dict(df.dtypes)["run_2"] == "double"
    assert rows(df, "feature") == [
        (1, "20.5", "ACD", "[2] Phospho (ST)", "sp|P1|X", 'kinase, "big"', 100.5, 0.0, 3),
        (2, "---", "EFG", None, "sp|P2|X", "cRAP", 1000.0, None, 4)]


def test_banner_csv_of_several_files(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"f{i}.csv", f",,note\n,,A\nid,d,s\np{i},x,{i}\n")
    df = sources.read_measurements(spark, str(tmp_path), samples=[3])
    assert rows(df, "id") == [("p0", "x", 0.0, 3), ("p1", "x", 1.0, 7), ("p2", "x", 2.0, 11)]
    other = write(tmp_path / "g.csv", "note 7,,\n,,A\nid,d,s\nq,x,9\n")
    both = sources.read_measurements(spark, [str(tmp_path / "f0.csv"), other], samples=[3],
                                     is_banner=F.col("c1").startswith("note"))
    assert [r.id for r in both.orderBy("id").collect()] == ["p0", "q"]


def test_files_with_own_headers_and_quoted_line_breaks(spark, tmp_path, monkeypatch):
    """Records keep their order and their text wherever files are split."""
    first = "note,,\n,,A\nid,d,s\n" + "".join(f'p{i},"text ""{i}""\nmore, of it\n\nend",{i}\n' if i % 3 else f"p{i},plain,{i}\n" for i in range(40))
    second = "other note,,\n,,A\ns,id,e,d\n" + "".join(f'{i},q{i},x,"a\n{i}"\n' for i in range(20)) + ",,,\n"
    write(tmp_path / "a.csv", first), write(tmp_path / "b.csv", second), write(tmp_path / "c.csv", "")
    want = [(f"p{i}", f'text "{i}"\nmore, of it\n\nend' if i % 3 else "plain", float(i), None) for i in range(40)]
    want += [(f"q{i}", f"a\n{i}", float(i), "x") for i in range(20)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "100", "37"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = sources.read_measurements(spark, str(tmp_path), samples=[3])
            assert df.columns == ["id", "d", "s", "e", "ordinal"]
            assert [tuple(r)[:4] for r in df.orderBy("ordinal").collect()] == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.openCostInBytes")
    monkeypatch.setattr(keys, "MAX_BROADCAST_ROWS", 0)  # joined by shuffles
    assert [tuple(r)[:4] for r in sources.read_measurements(spark, str(tmp_path), samples=[3]).orderBy("ordinal").collect()] == want


def test_unpaired_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,d\np,5" pipe\nq,x\n')
    df = sources.read_peaks_peptides(spark, path, columns=None, quoted_breaks=False)
    assert [(r.id, r.ordinal) for r in df.orderBy("ordinal").collect()] == [("p", 1), ("q", 2)]


def test_too_short_file(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.read_measurements(spark, write(tmp_path / "x.csv", "a\nb\n"))


def test_unique_names():
    assert unique_names(["A", "A", "", "A_2", "A"]) == ["A", "A_2", "column_3", "A_2_2", "A_3"]


def test_headed_csv_and_tsv(spark, tmp_path):
    prot = write(tmp_path / "proteins.csv", "Accession,-10lgP,#Peptides,#Unique,PTM,Description,s\nP1,55.5,3,2,,kinase,7\n")
    df = sources.read_peaks_proteins(spark, prot, samples=[7])
    assert rows(df) == [("P1", 55.5, 3, 2, None, "kinase", 7.0)]
    pep = write(tmp_path / "pep.csv", "Protein Accession,scan,Peptide,-10lgP,PTM,AScore,s,extra\nP1,5,K.AC.R,9.5,,C2:x:1.0,3,zz\n")
    df = sources.read_peaks_peptides(spark, pep, samples=[7], last=7)
    assert rows(df) == [("P1", 5, "K.AC.R", 9.5, None, "C2:x:1.0", 3.0, 1)]
    tsv = write(tmp_path / "anno.tsv", "Entry\tGene ontology (process)\nE1\talpha [GO:0000001]; beta [GO:0000002]\n")
    assert rows(sources.read_annotation(spark, tsv)) == [("E1", "alpha [GO:0000001]; beta [GO:0000002]")]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_fasta(spark, tmp_path, newline):
    text = newline.join([">sp|P1|ONE first > protein OS=x", "MAAK", "CCC", ">sp|P2|TWO", "MK", ">sp|P3|EMPTY", ""])
    path = write(tmp_path / "db.fasta", text)
    assert rows(sources.read_fasta(spark, path), "accession") == [
        ("sp|P1|ONE", "MAAKCCC"), ("sp|P2|TWO", "MK"), ("sp|P3|EMPTY", "")]
    pieces = sources.read_fasta(spark, path, accession_pattern="[^A-Za-z0-9]+")
    assert [r[0] for r in pieces.orderBy("accession").collect()] == ["P1", "P2", "P3"]


def test_fasta_split_over_many_partitions(spark, tmp_path):
    records = [(f"sp|P{i:04d}|X", "ACDEFGHIK" * (1 + i % 5)) for i in range(500)]
    path = write(tmp_path / "big.fasta", "".join(f">{a} text\n{s}\n" for a, s in records))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = sources.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 3
        assert rows(df, "accession") == records
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5, "e1"), ('c"d', None, "e2")], "id string, s double, experiment string")
    sources.write_table(df, str(tmp_path / "out.parquet"), by=["experiment"])
    assert os.path.isdir(tmp_path / "out.parquet" / "experiment=e1")
    assert rows(sources.read_processed(spark, str(tmp_path / "out.parquet")), "id") == rows(df, "id")
    sources.write_table(df.drop("experiment"), str(tmp_path / "out.csv"), "csv")
    assert rows(sources.read_processed(spark, str(tmp_path / "out.csv")), "id") == rows(df.drop("experiment"), "id")
    with pytest.raises(ValueError):
        sources.write_table(df, str(tmp_path / "x"), "json")


def test_checkpoint_folder_of_the_session_is_used(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not available")
def test_only_needed_columns_are_scanned_and_no_row_is_cut(spark):
    plan = inputs.quant(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_linenumber,4)" not in plan  # every line item is read
    scan = registry.QUERIES["select_abundance"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in scan and "l_tax" not in scan


def test_files_follow_keys_and_bytes(spark, tmp_path):
    df = spark.range(0, 30_000, 1, 40).select((F.col("id") % 3).alias("experiment"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    sources.write_table(df, str(tmp_path / "small"), by=["experiment"])
    files = [f for f in (tmp_path / "small").rglob("part-*")]
    assert len(files) == 3
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        sources.write_table(df, str(tmp_path / "large"), by=["experiment"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert 6 <= len([f for f in (tmp_path / "large").rglob("part-*")]) <= 40
    assert spark.read.parquet(str(tmp_path / "large")).count() == 30_000


def test_records_are_parsed_once_and_lines_stay_where_they_are_read(spark, tmp_path):
    write(tmp_path / "a.csv", 'x\ny\nid,d,s\np,"one\ntwo",1\n')
    write(tmp_path / "b.csv", 'x\ny\nd,id,s\n"three, ""3""",q,2\n')
    df = sources.read_measurements(spark, str(tmp_path), samples=[3])
    assert rows(df, "ordinal") == [("p", "one\ntwo", 1.0, 3), ("q", 'three, "3"', 2.0, 8)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("Join") == 2  # files' splits and headers, both broadcast
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_headers_with_line_breaks_and_beyond_the_first_split(spark, tmp_path):
    path = write(tmp_path / "a.csv", '"a banner\nof two lines"\n\nid,"d\ne",s\n' + "".join(f'p{i},"one\ntwo",{i}\n' for i in range(50)))
    want = [(f"p{i}", "one\ntwo", float(i)) for i in range(50)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "7"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = sources.read_measurements(spark, path, skip=3, samples=[3])
            assert df.columns == ["id", "d\ne", "s", "ordinal"] and [tuple(r)[:3] for r in df.orderBy("ordinal").collect()] == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
