"""Tokenising and n-gram expressions over string columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The 136 stop words of the synonym-detection job, as shipped.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but",
    "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on",
    "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same",
    "so", "than", "too", "very", "should", "can", "now", "will", "just", "would", "could", "may", "must", "one", "much",
    "it's", "can't", "won't", "don't", "shouldn't", "hasn't",
]

# Fixed value: a word is a maximal run of ASCII letters.
WORD_PATTERN = "[a-z]+"
WORD_PATTERN_ANY_CASE = "[A-Za-z]+"


def words(text: Column | str, lower: bool = True) -> Column:
    """Array of letter runs; with ``lower=False`` the case is kept."""
    text = F.col(text) if isinstance(text, str) else text
    if lower:
        return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN_ANY_CASE), F.lit(0))


def space_tokens(text: Column | str) -> Column:
    """Lower-cased tokens between single spaces, the n-gram file convention."""
    return F.split(F.lower(F.col(text) if isinstance(text, str) else text), " ")


def once(value: Column) -> Column:
    """The value, as a generator of one row. A filter on it stays above the
    generator; else Spark would move it down to the scan and compute the value
    there as well, in as few tasks as a small table has splits."""
    return F.explode(F.array(value))


def join_text(*parts: Column | str) -> Column:
    """Subject and body as one text; null parts are skipped."""
    return F.concat_ws(" ", *parts)


def ngrams(tokens: Column, n: int) -> Column:
    """Array of space-joined runs of ``n`` neighbouring tokens.

    ``tokens`` should be a plain column, so that the tokeniser runs once per
    row and not once per position.
    """
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def is_stop_word(word: Column) -> Column:
    return word.isin(*STOP_WORDS)
