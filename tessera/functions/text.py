"""Text cleaning and tokenising as native Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list of the NLTK corpus, in its own
# order, followed by the extra tokens the complaint pipeline also drops
# (the masking token "xxxx" and its shorter forms, and the empty token).
NLTK_ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself "
    "it it's its itself they them their theirs themselves what which who whom "
    "this that that'll these those am is are was were be been being have has "
    "had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will "
    "just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan "
    "shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
EXTRA_STOP_WORDS = ["xxxx", "xxx", "", "xx", "x"]
STOP_WORDS = NLTK_ENGLISH_STOP_WORDS + EXTRA_STOP_WORDS

NON_LETTERS = "[^a-zA-Z]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(line, index: int, sep: str = ",") -> Column:
    """The ``index``-th (0-based) field of a delimited line that has more
    than ``index`` fields (the last field if it has fewer). ``split`` looks for
    a plain separator by a native search, ``substring_index`` byte by byte."""
    parts = F.split(_col(line), re.escape(sep), index + 2)
    return F.element_at(parts, F.least(F.size(parts), F.lit(index + 1)))


def clean_text(c) -> Column:
    """Runs of non-letters become one space, then lower case, then trim."""
    return F.trim(F.lower(F.regexp_replace(_col(c), NON_LETTERS, " ")))


def words(c) -> Column:
    """Split cleaned text on single spaces (an empty text gives [""])."""
    return F.split(_col(c), " ", -1)


def is_stop_word(c, stop_words=STOP_WORDS) -> Column:
    # isin over literals compiles to a hash-set lookup (InSet) inside codegen.
    return _col(c).isin(list(stop_words))
