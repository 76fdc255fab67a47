"""Plain versions that several tests compare with."""

from test_dedup import brute_lines  # noqa: F401
from test_ngram_join import brute as brute_classes  # noqa: F401
