"""Text columns: cleaning, counting, tokens. All of them are JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.bind import let
from matchlake.functions.entities import unescape_entities

# Unicode-aware classes; Java's bare \w, \s and \S only know ASCII.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
WS = f"[{SPACE}]"
NS = f"[^{SPACE}]"
URL = f"http{NS}+|www\\.{NS}+"
EMAIL = f"{NS}+@{NS}+"
# Runs of anything else, whitespace included, become one space.
NOT_KEPT = r"[^\p{L}\p{N}_\-/.,;:()&+#]++"
TAG = "<[^>]+>"
# The token shape with possessive repeats: the same matches without backtracking.
TOKEN = fixed.TOKEN_PATTERN.replace("]+", "]++").replace(")*", ")*+")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip_ends(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of whitespace become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def _where(c: Column, marks: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """`change` for texts that hold one of the marks; a plain search is far cheaper than a regex."""
    return let(c, lambda t: F.when(reduce(or_, [F.contains(t, F.lit(m)) for m in marks]), change(t)).otherwise(t))


def _without_tags(c: Column) -> Column:
    return _where(c, ("<",), lambda t: F.regexp_replace(t, TAG, " "))


def strip_html(c: Column) -> Column:
    """Entities are decoded before tags go, so escaped tags go too."""
    return squeeze(_without_tags(unescape_entities(text_or_empty(c))))


def strip_tags(c: Column) -> Column:
    """The profiling variant: tags only, inner whitespace stays."""
    return strip_ends(_without_tags(text_or_empty(c)))


def clean_text(c: Column) -> Column:
    """Drops links, mail addresses and characters outside the kept set."""
    c = _where(text_or_empty(c), ("http", "www."), lambda t: F.regexp_replace(t, URL, ""))
    c = _where(c, ("@",), lambda t: F.regexp_replace(t, EMAIL, ""))
    return F.trim(F.regexp_replace(c, NOT_KEPT, " "))


def clean_html(c: Column) -> Column:
    """clean_text of strip_html, squeezed once."""
    return clean_text(_without_tags(unescape_entities(text_or_empty(c))))


def word_count(c: Column) -> Column:
    """Pieces between runs of whitespace; only the first and the last can be empty."""
    return let(F.split(text_or_empty(c), f"{WS}+"), lambda w: F.greatest(
        F.size(w) - (F.get(w, F.lit(0)) == "").cast("int") - (F.element_at(w, -1) == "").cast("int"), F.lit(0)))


def clean_word_count(c: Column) -> Column:
    """Word count of a cleaned text, whose words are one space apart."""
    return F.when(c == "", 0).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)


def stem(token: Column) -> Column:
    """Cuts the longest listed suffix that leaves at least three characters."""
    ending = "|".join(fixed.SUFFIXES)
    return F.regexp_replace(token, f"^(.{{{fixed.MIN_STEM},}}?)(?:{ending})$", "$1")


def tokens(c: Column, stemmed: bool = False) -> Column:
    """Lower-case tokens without stopwords and single characters; stems are cut last."""
    found = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(TOKEN), F.lit(0))
    # No token holds an apostrophe, so the words that do are left out of the test.
    stop = [w for w in fixed.STOPWORDS if "'" not in w]
    kept = F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*stop))
    return F.transform(kept, stem) if stemmed else kept


def job_embed_text(title: Column, description: Column) -> Column:
    """The title counts twice; the model reads the first 500 characters of the description."""
    t = text_or_empty(title)
    return F.concat(t, F.lit(". "), t, F.lit(". "), F.substring(text_or_empty(description), 1, 500))


def resume_embed_text(text: Column) -> Column:
    return F.substring(text_or_empty(text), 1, 1000)


def resume_snippet(text: Column) -> Column:
    return F.substring(text_or_empty(text), 1, 600)
