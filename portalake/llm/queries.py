"""All queries of this subpackage, by name, and their SQL."""

from . import (query_alignment, query_attribution, query_bpe, query_compression, query_contamination, query_jaccard, query_langid,  # noqa: F401
               query_maxent, query_minhash, query_negatives, query_quality, query_substring, query_urls)
from .registry import QUERIES, SQL  # noqa: F401
