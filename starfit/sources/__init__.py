from starfit.sources.delimited import MOVIE_FIELDS, RATING_FIELDS, Parsed, read_delimited
from starfit.sources.staging import stage, staging_path

__all__ = [
    "MOVIE_FIELDS",
    "RATING_FIELDS",
    "Parsed",
    "read_delimited",
    "stage",
    "staging_path",
]
