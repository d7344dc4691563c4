"""Text expressions: cleaning, stop words and tokenisers (all built-in functions)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_of

# Fixed values.
# ASCII punctuation, the 32 characters of Python's string.punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Whitespace class written so Java regex and RE2 agree.
WS = r"[ \t\n\r\f\x0B]+"
# Word/punctuation tokeniser: runs of letters/digits/underscore, or runs of
# anything else that is not whitespace.
WORDPUNCT = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)"
LITERAL_NEWLINE = "\\n"  # the two characters backslash + n


def strip_punctuation_word(w: str) -> str:
    return "".join(ch for ch in w if ch not in PUNCTUATION)


# Spark's built-in English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english")), 181 words, in its order.
SPARK_ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()


@lru_cache(maxsize=None)
def default_stopwords() -> tuple[str, ...]:
    """The English stop words with punctuation removed (``i'll`` -> ``ill``),
    deduplicated and sorted."""
    return tuple(sorted({strip_punctuation_word(w) for w in SPARK_ENGLISH_STOPWORDS}))


def split_ws(c: str | Column) -> Column:
    """Whitespace split without empty tokens."""
    return F.filter(F.split(col_of(c), WS), lambda t: t != "")


def delete_punctuation(c: str | Column) -> Column:
    return F.translate(col_of(c), PUNCTUATION, "")


def clean_tokens(c: str | Column, stopwords: Iterable[str] | None = None) -> Column:
    """Tokens of the cleaned text: literal ``\\n`` to blank, punctuation deleted,
    whitespace split, stop words dropped by their lower case (case kept)."""
    sw = list(stopwords) if stopwords is not None else list(default_stopwords())
    text = delete_punctuation(F.replace(col_of(c), F.lit(LITERAL_NEWLINE), F.lit(" ")))
    # isin with many literals plans as a hash-set lookup (InSet), not a list scan
    return F.filter(split_ws(text), lambda w: ~F.lower(w).isin(sw))


def clean_text(c: str | Column, stopwords: Iterable[str] | None = None) -> Column:
    return F.array_join(clean_tokens(c, stopwords), " ")


def wordpunct_tokens(c: str | Column, lower: bool = True) -> Column:
    x = F.lower(col_of(c)) if lower else col_of(c)
    return F.regexp_extract_all(x, F.lit(WORDPUNCT), F.lit(1))


def vectorizer_tokens(c: str | Column) -> Column:
    """Tokens of a text encoder that lower-cases, strips punctuation and splits
    on whitespace (literal ``\\n`` first turned into a blank)."""
    x = F.replace(col_of(c), F.lit(LITERAL_NEWLINE), F.lit(" "))
    return split_ws(delete_punctuation(F.lower(x)))
