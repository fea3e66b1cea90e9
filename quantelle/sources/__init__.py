"""Readers and sinks."""

from .fasta import read_fasta
from .measurements import (read_annotation, read_measurements, read_peaks_peptides, read_peaks_proteins,
                           read_processed, write_table)

__all__ = ["read_annotation", "read_fasta", "read_measurements", "read_peaks_peptides", "read_peaks_proteins",
           "read_processed", "write_table"]
