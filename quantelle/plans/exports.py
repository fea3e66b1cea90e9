"""Export files derived from the given tables, written to the shared folder for the readers.

Every function writes with Spark when it is called and returns the paths, so the
files are as large as the tables and the readers work on many part files.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_finished, ensure_checkpoint_dir
from ..sources.measurements import PEPTIDE_EXPORT, PROTEIN_EXPORT
from . import inputs

HEADER = ["#", "Score", "Sequence", "Modifications", "Accession", "Description", "Abundance", "Abundance"]


def folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}-{label}"


def _lines(df: DataFrame, label: str) -> str:
    path = folder(df.sparkSession, label)
    df.write.text(path)
    return path


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def _under_headers(lines: DataFrame, head: list[str], path: str, compression: str = "none") -> str:
    """Text files that begin with the lines of ``head`` each. Compressed files are read by one task each."""
    def each(batches):
        yield pa.RecordBatch.from_pydict({"value": head})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    lines.mapInArrow(each, "value string").write.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED"}).text(path)
    return path


def _in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows in ascending order over the files that will be written."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _row(cells: list[Column]) -> Column:
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])


def measurements(spark: SparkSession, sf_dir: str) -> list[str]:
    """Files with two banner lines and a header each, in two folders whose columns differ in
    order. Some first cells, scores and abundances are missing, descriptions hold commas and
    quotes, in the second folder also line breaks, sample names repeat, and lines without any
    value lie between the rows."""
    width = len(HEADER)
    banner = ["," * (width - 2) + "Raw,Raw", "," * (width - 2) + "A,N"]
    order, part, number = F.col("l_orderkey"), F.col("l_partkey").cast("string"), F.col("l_linenumber")
    odd = order % 2 == 1
    cells = [
        F.when(order % 50 != 0, order.cast("string")),
        F.when(number == 3, F.lit("---")).otherwise(F.col("l_quantity").cast("string")),
        F.concat("l_returnflag", "l_linestatus"),
        F.when(number % 2 == 0, F.lit("[2] Phospho (S)")),
        F.concat(F.lit("P"), part),
        _quoted(F.concat(F.lit('so-called "P'), part, F.when(odd, F.lit('",\nline ')).otherwise(F.lit('", line ')), number.cast("string"))),
        F.when(number != 2, F.col("l_extendedprice").cast("string")),
        F.col("l_tax").cast("string"),
    ]
    items = _in_order(inputs.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    base, paths = folder(spark, "measurements"), []
    for name, chosen, places in (("1", ~odd, range(width)), ("2", odd, [5, 0, 4, 6, 7, 3, 2, 1])):
        line = _row([cells[i] for i in places])
        lines = F.when(number == 1, F.array(line, F.lit("," * (width - 1)))).otherwise(F.array(line))
        head = [*banner, ",".join(HEADER[i] for i in places)]
        paths.append(_under_headers(items.where(chosen).select(F.explode(lines).alias("value")), head, f"{base}/{name}"))
    return paths


def peptides(spark: SparkSession, sf_dir: str, samples: Sequence[str], view: Callable[[DataFrame], DataFrame] = inputs.as_peptides) -> str:
    """The peptide view as compressed files with two banner lines and a header, in the order of
    ``ordinal``. The table rows are put in order before the view makes its wide columns of them."""
    rows = view(_in_order(inputs.peptide_rows(spark, sf_dir), F.expr(inputs.PEPTIDE_ORDINAL), F.col("l_orderkey")))
    names = {v: k for k, v in PEPTIDE_EXPORT.items()}
    head = ["exported", "", ",".join([*names.values(), *samples])]
    cells = [_quoted(F.col(c).cast("string")) if c in ("modifications", "description") else F.col(c).cast("string") for c in names]
    line = _row([*cells, *[F.col(f"`{s}`").cast("string") for s in samples]])
    path = _under_headers(rows.select(line.alias("value")), head, folder(spark, "peptides"), "gzip")
    drop_finished(spark)
    return path


def proteins(spark: SparkSession, sf_dir: str) -> str:
    """The protein view as files with two banner lines and a header."""
    names = {v: k for k, v in PROTEIN_EXPORT.items()}
    line = _row([F.col(c).cast("string") for c in names])
    return _under_headers(inputs.proteins(spark, sf_dir).select(line.alias("value")), ["", "exported", ",".join(names.values())],
                          folder(spark, "proteins"))


def database(spark: SparkSession, sf_dir: str) -> str:
    """The sequences of the peptides' proteins as FASTA records."""
    return _lines(inputs.sequences(spark, sf_dir).select(
        F.concat_ws("\n", F.concat(F.lit(">"), "accession", F.lit(" protein > of the database")), "sequence").alias("value")), "database.fasta")


def _headed(df: DataFrame, label: str, sep: str = ",") -> str:
    path = folder(df.sparkSession, label)
    df.write.option("header", True).option("escape", '"').option("sep", sep).csv(path)
    return path


def peaks_proteins(spark: SparkSession, sf_dir: str) -> str:
    key = F.col("s_suppkey")
    return _headed(inputs.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("Accession"),
        F.when(key % 7 == 0, F.lit("-")).otherwise(F.col("s_acctbal").cast("string")).alias("-10lgP"),
        (key % 9).alias("#Peptides"), (key % 4).alias("#Unique"), F.when(key % 2 == 0, "Oxidation").alias("PTM"),
        F.concat(F.col("s_name"), F.lit(', "kinase"')).alias("Description"),
        F.col("s_acctbal").alias("sample 1"), F.col("s_nationkey").alias("sample 2")), "proteins.csv")


def peaks_peptides(spark: SparkSession, sf_dir: str) -> str:
    number = F.col("l_linenumber")
    return _headed(inputs.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("Protein Accession"),
        F.col("l_orderkey").alias("scan"), F.concat(F.lit("K."), "l_returnflag", "l_linestatus", F.lit(".R")).alias("Peptide"),
        F.when(number != 3, F.col("l_quantity")).alias("-10lgP"), F.when(number == 1, "Carbamidomethylation").alias("PTM"),
        F.concat(F.lit("C"), number.cast("string"), F.lit(":Carbamidomethylation:"), F.col("l_discount").cast("string")).alias("AScore"),
        F.col("l_extendedprice").alias("sample 1"), F.col("l_shipdate").alias("beyond the last column")), "peptides.csv")


def fasta(spark: SparkSession, sf_dir: str) -> str:
    """Records with two sequence lines and a ``>`` inside the header."""
    letters = F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("")))
    header = F.concat(F.lit(">sp|P"), F.col("p_partkey").cast("string"), F.lit("|"), letters, F.lit(" > "), "p_type")
    return _lines(inputs.table(spark, sf_dir, "part").select(
        F.concat_ws("\n", header, letters, F.reverse(letters)).alias("value")), "sequences.fasta")


def annotation(spark: SparkSession, sf_dir: str) -> str:
    return _headed(inputs.annotation(spark, sf_dir).withColumnRenamed("entry", "Entry"), "annotation.tsv", "\t")


# Ship this module's code with the function, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
