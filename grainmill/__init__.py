"""grainmill: a PySpark engine for building, auditing and scoring claim-grounding datasets."""

__version__ = "0.1.0"
