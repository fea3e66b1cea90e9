"""Readers for exported measurement tables and sinks for results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import headed_records

#: Column names of peptide and protein exports and the names the operators use.
PEPTIDE_EXPORT = {
    "#": "feature",
    "Score": "score",
    "Sequence": "sequence",
    "Modifications": "modifications",
    "Accession": "accession",
    "Description": "description",
}
PROTEIN_EXPORT = {
    "Accession": "accession",
    "Peptide count": "peptide_count",
    "Unique peptides": "unique_peptides",
    "Confidence score": "confidence_score",
    "Description": "description",
}
PEAKS_PROTEINS = {
    "Accession": "accession",
    "-10lgP": "lgp",
    "#Peptides": "peptide_count",
    "#Unique": "unique_peptides",
    "PTM": "ptm",
    "Description": "description",
}
PEAKS_PEPTIDES = {
    "Protein Accession": "accession",
    "Peptide": "peptide",
    "-10lgP": "lgp",
    "PTM": "ptm",
    "AScore": "ascore",
}


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeated names get a counter: ``A, A`` -> ``A, A_2``."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for position, name in enumerate(names, start=1):
        name = name.strip() or f"column_{position}"
        seen[name] = seen.get(name, 0) + 1
        candidate = name if seen[name] == 1 else f"{name}_{seen[name]}"
        while candidate in out:
            seen[name] += 1
            candidate = f"{name}_{seen[name]}"
        out.append(candidate)
    return out


def _typed(df: DataFrame, types: Mapping[str, str], samples: Sequence[str]) -> DataFrame:
    """Cast without failing: text that is not a number becomes NULL."""
    wanted = {**types, **{s: "double" for s in samples}}
    return df.select(*[
        F.col(f"`{c}`").try_cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns
    ])


def _positions(names: Sequence[str], samples: Sequence[int]) -> list[str]:
    return [names[p - 1] for p in samples]


def read_measurements(spark: SparkSession, path: str | Sequence[str], skip: int = 2,
                      samples: Sequence[int] = (), types: Mapping[str, str] | None = None,
                      columns: Mapping[str, str] | None = None, is_banner: Column | None = None,
                      ordinal: str | None = "ordinal", quoted_breaks: bool = True) -> DataFrame:
    """CSV exports with ``skip`` banner lines above the header of each file.

    Every file is read by its own header, so files may differ in the order of their columns;
    the columns are those of the first file by path, then those that only others have.
    ``samples`` are 1-based positions of the abundance columns among them (their names may
    repeat, so they are made unique). Rows whose cells are all empty are dropped; exports
    with further banner lines can pass ``is_banner``, an expression over the positional
    columns ``c1, c2, ...``.

    ``ordinal`` names a column with the position of each row over all files in the order of
    their paths: the input order by which reductions settle ties. Quoted cells may hold
    line breaks; ``quoted_breaks=False`` is for files whose quotes do not pair.
    """
    records, names = headed_records(spark, path, skip, quoted_breaks=quoted_breaks, name=unique_names)
    drop = F.trim(F.concat_ws("", "_cells")) == ""
    if is_banner is not None:
        positional = records.withColumns({f"c{i + 1}": F.get("_cells", F.lit(i)) for i in range(len(names))})
        records = positional.where(~F.coalesce(is_banner, F.lit(False))).select(*records.columns)
    return _by_name(records.where(~drop), names, samples, types, columns, ordinal)


def _by_name(records: DataFrame, names: Sequence[str], samples: Sequence[int], types: Mapping[str, str] | None,
             columns: Mapping[str, str] | None, ordinal: str | None) -> DataFrame:
    taken = [F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    named = records.select(*taken, F.col("ordinal").alias("_ordinal"))
    done = _finish(named, names, samples, types, columns)
    return done.withColumnRenamed("_ordinal", ordinal) if ordinal else done.drop("_ordinal")


def _finish(df: DataFrame, names: Sequence[str], samples: Sequence[int], types: Mapping[str, str] | None,
            columns: Mapping[str, str] | None) -> DataFrame:
    typed = _typed(df, types or {}, _positions(names, samples))
    return typed.withColumnsRenamed(dict(columns or {}))


def _read_headed(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, sep=sep,
                          quote='"', escape='"', inferSchema=False)


def read_peaks_proteins(spark: SparkSession, path: str | Sequence[str], samples: Sequence[int] = (),
                        types: Mapping[str, str] | None = None,
                        columns: Mapping[str, str] | None = PEAKS_PROTEINS) -> DataFrame:
    """Protein table: plain CSV with a header."""
    defaults = {"-10lgP": "double", "#Peptides": "int", "#Unique": "int"}
    df = _read_headed(spark, path)
    return _finish(df, df.columns, samples, {**defaults, **(types or {})}, columns)


def read_peaks_peptides(spark: SparkSession, path: str | Sequence[str], samples: Sequence[int] = (),
                        last: int | None = None, types: Mapping[str, str] | None = None,
                        columns: Mapping[str, str] | None = PEAKS_PEPTIDES, ordinal: str | None = "ordinal",
                        quoted_breaks: bool = True) -> DataFrame:
    """Protein-peptide tables: plain CSV with a header in each file; the protein accession is
    renamed, the columns after position ``last`` are left out, and ``ordinal`` is added as by
    :func:`read_measurements`."""
    defaults = {"-10lgP": "double", "scan": "long"}
    records, names = headed_records(spark, path, quoted_breaks=quoted_breaks, name=unique_names)
    return _by_name(records, names[:last], [s for s in samples if not last or s <= last], {**defaults, **(types or {})},
                    columns, ordinal)


def read_annotation(spark: SparkSession, path: str | Sequence[str], entry: str = "Entry",
                    out: str = "accession") -> DataFrame:
    """Tab-separated annotation table; the entry column becomes the accession."""
    return _read_headed(spark, path, sep="\t").withColumnRenamed(entry, out)


def read_processed(spark: SparkSession, path: str, samples: Sequence[int] | None = None) -> DataFrame:
    """A processed wide table (CSV or Parquet): identifier, then abundances."""
    if path.rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    df = _read_headed(spark, path)
    positions = samples if samples is not None else range(2, len(df.columns) + 1)
    return _typed(df, {}, _positions(df.columns, list(positions)))


def write_table(df: DataFrame, path: str, format: str = "parquet", by: Sequence[str] = (),
                mode: str = "errorifexists") -> None:
    """Parquet or CSV sink, optionally partitioned by experiment keys.

    With keys, rows are rebalanced by them first: adaptive execution puts small keys
    together and splits large ones at the advisory partition size, so the number of files
    follows the bytes and the keys, not the tasks that made the rows.
    """
    if format not in ("parquet", "csv"):
        raise ValueError(f"unknown format {format!r}")
    if by:
        df = df.hint("rebalance", *[F.col(f"`{k}`") for k in by])
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    if format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)
