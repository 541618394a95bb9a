"""Column expressions shared by the operators (all JVM built-ins, no UDFs)."""

from reviewlens.functions.hashing import hash_bucket
from reviewlens.functions.stopwords import ENGLISH_STOP_WORDS
from reviewlens.functions.votes import INT_TEXT, lenient_int, vote_part

__all__ = ["hash_bucket", "ENGLISH_STOP_WORDS", "INT_TEXT", "lenient_int", "vote_part"]
