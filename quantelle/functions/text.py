"""String expressions on accessions, peptides and annotation terms (all in-row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piece(c: Column, pattern: str, n: int) -> Column:
    """n-th piece (1-based) of a split, NULL when there are fewer pieces."""
    return F.try_element_at(F.split(c, pattern), F.lit(n))


def lead_accession(c: Column) -> Column:
    return F.split(c, ";", 2).getItem(0)


def other_accessions(c: Column) -> Column:
    """Everything after the first ``;`` or NULL."""
    return F.try_element_at(F.split(c, ";", 2), F.lit(2))


def uniprot_entry(c: Column) -> Column:
    """``db|ENTRY|NAME`` -> ``ENTRY``; empty string when there is no second field."""
    return F.coalesce(piece(c, r"\|", 2), F.when(c.isNotNull(), F.lit("")))


def truncate(c: Column, width: int) -> Column:
    """Shorten to ``width`` characters, the last three being dots."""
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def drop_last(c: Column, n: int) -> Column:
    """Without the last ``n`` characters (empty when shorter)."""
    return F.substr(c, F.lit(1), F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def strip_peptide(c: Column, flank: str = r"^[KRM]\.") -> Column:
    """Bare residues of a flanked, annotated peptide: ``K.AC(+125.05)DE.R`` -> ``ACDE``."""
    bare = F.regexp_replace(c, r"\(.*?\)", "")
    bare = F.regexp_replace(bare, flank, "")
    return F.regexp_replace(bare, r"^(.*?)\.[A-Z]", "$1")


def find(text: Column, word: Column) -> Column:
    """1-based start of ``word`` in ``text``; NULL when it does not occur."""
    return F.nullif(F.instr(text, word), F.lit(0))


def label_class(c: Column, pattern: str = "_UPS", yes: str = "UPS1", no: str = "Background") -> Column:
    """Ground-truth class by regular expression."""
    return F.when(c.rlike(pattern), F.lit(yes)).when(c.isNotNull(), F.lit(no))
