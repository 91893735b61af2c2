"""Text expressions: every function takes and returns a Column and stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ENGLISH_STOPWORDS, FUSED_WORDS, QUESTION_WORDS

# Whitespace that a strip removes; the same characters are listed in the SQL twins.
BLANKS = " \t\n\r\f\x0b"
_NOT_WORD = r"[^a-zA-Z0-9 \t\n\r\f\x0b]"
_SPACES = r"[ \t\n\r\f\x0b]+"
_FUSED = "|".join(f"{head}(?={tail}(?![a-z0-9]))" for head, tail in FUSED_WORDS)
_FUSED_HEAD = f"(?<![a-z0-9])(?:{_FUSED})"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Catalyst may paste a projected expression into the lambdas that use it, which would run a
    tokeniser once per array element; a lambda variable cannot be pasted over.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def clean_text(c: Column | str) -> Column:
    """Lower-case, then turn every character outside ASCII letters, digits and blanks to a space."""
    return F.regexp_replace(F.lower(col(c)), _NOT_WORD, " ")


def _without(tokens: Column, unwanted: Iterable[str]) -> Column:
    """Elements that are not in a word list.

    The list goes in as SQL text, which becomes one hash set; building it word by word as columns
    would cost the driver far more than the query plan itself.
    """
    escaped = (w.replace("\\", "\\\\").replace("'", "\\'") for w in unwanted)
    listed = ", ".join(f"'{w}'" for w in escaped)
    return F.call_function("filter", tokens, F.expr(f"w -> w NOT IN ({listed})"))


def _words(c: Column | str, drop: Iterable[str]) -> Column:
    # Splitting on runs of non-word characters gives the same words as cleaning and then
    # splitting on blanks, in one regex pass over the text instead of two.
    lowered = F.regexp_replace(F.lower(col(c)), _FUSED_HEAD, "$0 ")
    kept = _without(F.split(lowered, "[^a-z0-9]+"), ["", *drop])
    return F.coalesce(kept, F.array().cast("array<string>"))


def tokenize(c: Column | str) -> Column:
    """Words of the cleaned text; single characters stay, null gives an empty array."""
    return _words(c, ())


def remove_stopwords(tokens: Column | str, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """Drop stop words and keep repeats of everything else."""
    words = list(stopwords)
    return _without(col(tokens), words) if words else col(tokens)


def tokenize_and_clean(
    c: Column | str,
    remove_stopwords: bool = True,
    stopwords: Iterable[str] | None = None,
) -> Column:
    """Clean, split into words and drop stop words (all in one filter pass)."""
    drop: Iterable[str] = ()
    if remove_stopwords:
        drop = ENGLISH_STOPWORDS if stopwords is None else tuple(stopwords)
    return _words(c, drop)


def preview_stages(
    c: Column | str, stopwords: Iterable[str] = ENGLISH_STOPWORDS
) -> list[Column]:
    """Three columns side by side: lowered text, raw tokens, content tokens."""
    return [
        F.lower(col(c)).alias("lowered"),
        tokenize(c).alias("raw_tokens"),
        tokenize_and_clean(c, stopwords=stopwords).alias("content_tokens"),
    ]


def ngrams(tokens: Column | str, min_n: int = 1, max_n: int = 1) -> Column:
    """All n-grams for n in [min_n, max_n], words joined by one space."""
    if not 1 <= min_n <= max_n:
        raise ValueError("need 1 <= min_n <= max_n")

    def of_size(words: Column, n: int) -> Column:
        if n == 1:
            return words
        def gram(word: Column, i: Column) -> Column:
            return F.concat_ws(" ", word, *[F.get(words, i + j) for j in range(1, n)])

        starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
        grams = F.when(F.size(words) >= n, F.transform(starts, gram))
        return F.coalesce(grams, F.array().cast("array<string>"))

    def every_size(words: Column) -> Column:
        return F.concat(*[of_size(words, n) for n in range(min_n, max_n + 1)])

    return let(col(tokens), every_size)


def run_lengths(values: Column, name: str = "value", count: str = "n") -> Column:
    """Distinct elements of an array with their counts, as array<struct>, inside the row.

    Sorts once and measures runs, so a row of n elements costs O(n log n) and no shuffle.
    """

    def measure(s: Column) -> Column:
        def starts_run(i: Column) -> Column:
            here, before = F.element_at(s, i), F.get(s, i - 2)
            return (F.size(s) > 0) & ((i == 1) | (here != before))

        def to_struct(b: Column) -> Column:
            def one(p: Column, j: Column) -> Column:
                following = F.coalesce(F.get(b, j + 1), F.size(s) + 1)
                return F.struct(F.get(s, p - 1).alias(name), (following - p).alias(count))

            return F.transform(b, one)

        return let(F.filter(F.sequence(F.lit(1), F.size(s)), starts_run), to_struct)

    return let(F.sort_array(values), measure)


def word_count(c: Column | str) -> Column:
    """Number of blank-separated words."""
    return let(
        strip(c), lambda s: F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, _SPACES)))
    )


def text_lengths(c: Column | str) -> list[Column]:
    return [
        F.length(strip(c)).alias("char_length"),
        word_count(c).alias("token_estimate"),
    ]


def split_sentences(c: Column | str, longer_than: int = 10) -> Column:
    """Cut after . ! ? followed by blanks, so that 2.1 stays whole; trim; keep long pieces."""
    pieces = F.split(col(c), r"(?<=[.!?])" + _SPACES)
    trimmed = F.transform(pieces, strip)
    return F.filter(trimmed, lambda s: F.length(s) > longer_than)


def word_set(c: Column | str) -> Column:
    """Distinct lower-case words: letters of any script, digits and underscore."""
    return F.array_distinct(F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\p{L}\p{N}_]+)")))


def query_terms(c: Column | str, ignored: Iterable[str] = QUESTION_WORDS) -> Column:
    words = list(ignored)
    return _without(word_set(c), words) if words else word_set(c)


def word_overlap(terms: Column | str, sentence: Column | str) -> Column:
    """Query words that also occur in the sentence."""
    return F.array_intersect(col(terms), word_set(sentence))


def token_recall(query_tokens: Column | str, doc_tokens: Column | str) -> list[Column]:
    """Share of query tokens (repeats counted) found in a document, and which ones."""
    q = col(query_tokens)
    found = let(
        F.array_distinct(col(doc_tokens)),
        lambda d: F.filter(q, lambda w: F.array_contains(d, w)),
    )
    return [
        found.alias("matched_tokens"),
        (F.size(found) / F.nullif(F.size(q), F.lit(0))).alias("token_recall"),
    ]


def excerpt(c: Column | str, n: int = 110) -> Column:
    return F.concat(F.substring(col(c), 1, n), F.lit("..."))


def round4(c: Column | str) -> Column:
    return F.round(col(c), 4)


def format4(c: Column | str) -> Column:
    return F.format_string("%.4f", col(c))
