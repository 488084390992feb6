"""fernworks: a Spark-first engine for matching free text to occupations and scoring the matches."""

__version__ = "0.1.0"
