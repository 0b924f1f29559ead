"""Text expressions: Turkish-aware normalising, whole-phrase matching, tokens."""

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lexicon import CATEGORY_SYNONYMS

# Turkish letters and the ASCII letters they fold to.
TURKISH_LETTERS = "çÇğĞıIİöÖşŞüÜ"
ASCII_LETTERS = "ccggiiioossuu"

# What `\w` means for str patterns in Python: letters, numbers, underscore.
WORD_CHARS = r"[\p{L}\p{N}_]"
# Unicode white space plus the four separators Python also counts as space.
SPACES = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def normalize(text, nfkc=False):
    """Fold Turkish letters, lower, collapse white space, trim; null gives ''.

    Runs inside the JVM. `nfkc` adds compatibility composition (full-width letters, ligatures,
    '½'): only values with non-ASCII characters left are then handed to an Arrow UDF.
    """
    # Lower-casing gives the dotted capital a mark of its own, and every other capital the small letter that is folded.
    folded = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("İ"), F.lit("i")))
    for letter, plain in zip(TURKISH_LETTERS, ASCII_LETTERS, strict=True):
        if letter.islower():
            folded = F.replace(folded, F.lit(letter), F.lit(plain))
    if nfkc:
        odd = F.when(folded.rlike(r"[^\x00-\x7F]"), folded)
        folded = F.coalesce(_compose(odd), folded)
    return F.trim(F.regexp_replace(folded, SPACES, " "))


def _fold(term):
    table = str.maketrans(TURKISH_LETTERS, ASCII_LETTERS)
    return " ".join(unicodedata.normalize("NFKC", term.translate(table).lower()).split())


def _plain_words(plain):
    """The words of a folded phrase if it is words and single blanks alone and can't overlap itself, else None."""
    words = plain.split(" ")
    if not all(re.fullmatch(r"\w+", w) for w in words) or any(words[:n] == words[-n:] for n in range(1, len(words))):
        return None
    return words


def _spelled(words):
    """A pattern of the words as a tree of letters, which takes the longest one that what follows allows."""
    heads = {}
    for word in words:
        if word:
            heads.setdefault(word[0], []).append(word[1:])
    branches = "|".join(re.escape(head) + _spelled(tails) for head, tails in sorted(heads.items()))
    return f"(?:{branches}){'?' if '' in words else ''}" if branches else ""


def _let(value, body):
    """`body` of a value that is computed once per row, however often `body` refers to it."""
    return F.transform(F.array(value), body)[0]


def _beginnings(phrase, within):
    """The phrase with those that it begins with."""
    all_of = F.array(phrase)
    for longer, shorter in within.items():
        if shorter:
            all_of = F.when(phrase == longer, F.array(*map(F.lit, [longer, *shorter]))).otherwise(all_of)
    return all_of


def find_phrases(text, *families):
    """Every occurrence of a phrase of any family in the normalised text as whole words, folded, in one pass.

    At every letter that starts a word, the longest phrase is looked up in a tree of all phrases; what else starts there
    is the beginning of it. A phrase nested in another is found beside it; one phrase never overlaps itself. Phrases that
    are not plain words are counted by a pattern each.
    """
    plain = {_fold(term) for terms in families for term in terms}
    words = {p: w for p in sorted(plain) if (w := _plain_words(p))}
    found = F.array().cast("array<string>")
    if words:
        # Most places fall out by their first letters.
        likely = "".join(f"[{''.join(sorted({p[n] for p in words}))}]" for n in range(min(2, *map(len, words))))
        # A look behind sees letters of two units whole only if one is written in it.
        before = WORD_CHARS.replace("_", "_\U00010400")
        pattern = f"(?={likely})(?<!{before})(?=({_spelled(words)})(?!{WORD_CHARS}))"
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        within = {p: [s for s in words if p.startswith(f"{s} ")] for p in words}
        if any(within.values()):
            found = F.flatten(F.transform(found, lambda p: _beginnings(p, within)))
    for term in sorted(plain - set(words)):
        pattern = f"(?<!{WORD_CHARS}){re.escape(term)}(?!{WORD_CHARS})"
        found = F.concat(found, F.array_repeat(F.lit(term), F.regexp_count(text, F.lit(pattern))))
    return found


def any_found(found, terms):
    """Whether `found` (of find_phrases) holds any of the phrases."""
    return F.arrays_overlap(found, F.array(*[F.lit(_fold(t)) for t in terms]))


def found_hits(found, terms):
    """Array of the phrases that `found` holds, in list order."""
    return F.array_compact(F.array(*[F.when(F.array_contains(found, _fold(t)), F.lit(t)) for t in terms]))


def found_count(found, terms):
    """Occurrences in `found` summed over the phrases."""
    return F.size(F.filter(found, lambda p: p.isin(sorted({_fold(t) for t in terms}))))


def any_phrase(text, terms):
    """True where the normalised text holds any of the phrases as whole words."""
    return any_found(find_phrases(text, terms), terms)


def phrase_hits(text, terms):
    """Array of the phrases found in the normalised text, in list order."""
    return _let(find_phrases(text, terms), lambda found: found_hits(found, terms))


def phrase_count(text, terms):
    """Occurrences summed over the phrases; a phrase nested in another counts for both."""
    return found_count(find_phrases(text, terms), terms)


def reason(hits, prefix="keyword"):
    """'prefix:hit' for every hit, joined by '; '."""
    return F.array_join(F.transform(hits, lambda hit: F.concat(F.lit(f"{prefix}:"), hit)), "; ")


def word_count(text, nfkc=False):
    """Number of words of the normalised text."""
    clean = normalize(text, nfkc)
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, " ")))


def strip(text):
    """Trim any white space, line breaks included."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_category(category, nfkc=False):
    """A category heading without markdown marks, normalised."""
    plain = F.coalesce(category.cast("string"), F.lit(""))
    return normalize(F.replace(F.replace(plain, F.lit("**"), F.lit("")), F.lit("#"), F.lit("")), nfkc)


def category_terms(category, synonyms=CATEGORY_SYNONYMS, nfkc=False):
    """The cleaned category followed by its synonyms, as an array."""
    clean = clean_category(category, nfkc)
    known = F.create_map(
        *[part for key, words in synonyms.items() for part in (F.lit(key), F.array(*map(F.lit, words)))]
    )
    return F.concat(F.array(clean), F.coalesce(F.try_element_at(known, clean), F.array().cast("array<string>")))


def word_tokens(text):
    """Runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CHARS + "{2,}"), F.lit(0))


def with_bigrams(tokens):
    """A token array followed by every pair of neighbouring tokens."""
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, 2, F.size(tokens)),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return F.when(F.size(tokens) > 1, F.concat(tokens, pairs)).otherwise(tokens)
