"""Text preparation as columns: clean, tokenize, stop words, lemmas, n-grams, term counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom.functions.lexicon import ENGLISH_STOP_WORDS

# Everything but ASCII letters, white space and ':'.  Written as a positive class: Java scans a
# negated class with several ranges about five times slower.
_NOT_LETTERS = r"[\x00-\x08\x0E-\x1F!-9;-@\[-`{-\x{10FFFF}]"
_WORD = r"\p{L}\p{N}_"
# ASCII punctuation without '.' and '$', digits, and words of one or two letters, with the space after them.
_STRICT = rf"(?:[!-#%-\-/:-@\[-`{{-~0-9]|(?<![{_WORD}])\p{{L}}{{1,2}}(?![{_WORD}]))\s*"
_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean(text: Column | str, mode: str = "letters") -> Column:
    """Replace the characters that ``mode`` does not want.

    letters          all but ASCII letters, white space and ':' become a space
    letters_nocolon  the same, and ':' is dropped
    strict           punctuation, digits and words of one or two letters become a space
    brackets         '[' and '%]%' become a space
    ner              like strict but ';' is dropped and runs of white space shrink by pairs
    """
    text = _col(text)
    if mode == "letters":
        return F.regexp_replace(text, _NOT_LETTERS, " ")
    if mode == "letters_nocolon":
        return F.regexp_replace(F.regexp_replace(text, _NOT_LETTERS, " "), ":", "")
    if mode == "strict":
        return F.regexp_replace(F.regexp_replace(text, _STRICT, " "), _PUNCTUATION, " ")
    if mode == "brackets":
        return F.regexp_replace(text, r"\[|%\]%", " ")
    if mode == "ner":
        kept = F.regexp_replace(F.translate(text, "\t", " "), _STRICT, " ")
        return F.regexp_replace(F.translate(kept, ",.\t;", "   "), r"\s\s", " ")
    raise ValueError(f"unknown cleaning mode: {mode}")


def tokenize(text: Column | str, mode: str = "regex") -> Column:
    """Split text into an array of tokens.

    simple  lower case, split at every white space character, inner empty tokens stay
    regex   lower case, split at runs of white space, no empty tokens
    space   case kept, split at single spaces
    """
    text = _col(text)
    if mode == "simple":
        # Empty tokens at the end are dropped, all others stay.
        blank = F.array().cast("array<string>")

        def pieces(whole: Column) -> Column:
            kept = F.rtrim(F.lower(whole), F.lit(" \t\n\x0b\f\r"))
            return F.when(whole.rlike(r"\A\s+\z"), blank).otherwise(F.split(kept, r"\s"))

        return let(text, pieces)
    if mode == "regex":
        return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")
    if mode == "space":
        return F.split(text, " ")
    raise ValueError(f"unknown tokenizer mode: {mode}")


def words(text: Column | str) -> Column:
    """Letters cleaning and regex tokenizing in one pass over the text.

    Equal to ``tokenize(clean(text, "letters"), "regex")``: the tokens are the
    runs of ASCII letters and ':'.
    """
    return F.transform(F.regexp_extract_all(_col(text), F.lit("[a-zA-Z:]+"), F.lit(0)), F.lower)


def remove_stop_words(
    tokens: Column | str, extra: Sequence[str] = (), stop_words: Sequence[str] = tuple(ENGLISH_STOP_WORDS)
) -> Column:
    """Drop stop words from a token array, ignoring case."""
    listed = sorted({w.lower() for w in (*stop_words, *extra)})
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(listed))


def content_words(text: Column | str) -> Column:
    """Lower-case letter words of a text without English stop words."""
    # ``words`` is already lower case, so the list is compared directly.
    return F.filter(words(text), lambda t: ~t.isin(ENGLISH_STOP_WORDS))


def strip_plural(word: Column) -> Column:
    """The three-rule plural stemmer published by Harman (1991)."""

    def ends(*suffixes: str) -> Column:
        return reduce(or_, [word.endswith(x) for x in suffixes])

    def without_last(n: int) -> Column:
        return F.substring(word, F.lit(1), F.length(word) - n)

    return (
        F.when(~ends("s"), word)
        .when(ends("ies") & ~ends("eies", "aies"), F.concat(without_last(3), F.lit("y")))
        .when(ends("es") & ~ends("aes", "ees", "oes"), without_last(1))
        .when(~ends("us", "ss"), without_last(1))
        .otherwise(word)
    )


def lemma_array(tokens: Column | str, exceptions: Mapping[str, str]) -> Column:
    """Lemmas of a token array from a short list of exceptions and the plural rule.

    For a lexicon of any size use ``operators.terms.lemmatize``.
    """
    lookup = F.create_map(*[F.lit(x) for pair in exceptions.items() for x in pair])
    return F.transform(_col(tokens), lambda t: F.coalesce(F.element_at(lookup, t), strip_plural(t)))


def ngrams(tokens: Column | str, n: int = 2) -> Column:
    """Space-joined n-grams; empty when there are fewer than ``n`` tokens."""
    tokens = _col(tokens)
    size = F.size(tokens)
    grams = tokens
    for i in range(1, n):
        later = F.slice(tokens, F.lit(i + 1), size)
        grams = F.zip_with(grams, later, lambda left, right: F.concat_ws(" ", left, right))
    return F.slice(grams, F.lit(1), F.greatest(size - (n - 1), F.lit(0)))


def sentence_lines(text: Column | str) -> Column:
    """The lines of a text, in order; each line is one sentence of an article."""
    return F.split(_col(text), "\n")
