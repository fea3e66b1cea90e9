"""Differential-abundance analytics for mass-spectrometry tables on Spark DataFrames."""

from .design import Contrast, Design, Sample

__all__ = ["Contrast", "Design", "Sample"]
