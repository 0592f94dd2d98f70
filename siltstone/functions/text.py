"""Full-text terms as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# English words that ``remove_stop_words`` leaves out.
STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()


def terms(text: Column, lower_case: bool = True, remove_stop_words: bool = False) -> Column:
    """Array of terms: runs of letters and digits, in order."""
    text = F.lower(text) if lower_case else text
    out = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda t: t != "")
    if remove_stop_words:
        out = F.filter(out, lambda t: ~t.isin(STOP_WORDS))
    return out


def query_terms(query: str, lower_case: bool = True, remove_stop_words: bool = False) -> list[str]:
    words = re.findall(r"[^\W_]+", query.lower() if lower_case else query)
    return [w for w in words if not (remove_stop_words and w in STOP_WORDS)]
