"""Small column functions: categories, links, labels, judge prompts."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.text import text_or_empty


def title_category(title: Column) -> Column:
    """First category, in list order, with a keyword inside the lower-cased title."""
    low = F.lower(text_or_empty(title))
    branches = [F.when(reduce(or_, [F.contains(low, F.lit(w)) for w in words]), F.lit(name))
                for name, words in fixed.TITLE_KEYWORDS]
    return F.coalesce(*branches, F.lit(fixed.OTHER_CATEGORY))


def hash_order(seed: int, *ids: Column) -> Column:
    """A reproducible random order: the same on any cluster and partitioning."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hash_number(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def wide_number(digest: Column) -> Column:
    """The first 60 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def search_link(title: Column, company: Column | None = None) -> Column:
    t = text_or_empty(title)
    words = t if company is None else F.when(text_or_empty(company) != "", F.concat_ws(" ", t, company)).otherwise(t)
    # url_encode and the form encoding wanted here differ in two characters.
    coded = F.replace(F.replace(F.url_encode(words), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.concat(F.lit(fixed.SEARCH_LINK), coded)


def display_score(score: Column) -> Column:
    return F.round(score, 4)


def match_label(score: Column) -> Column:
    return F.when(score <= 1, F.concat(F.round(score * 100, 1).cast("string"), F.lit("% match"))) \
        .otherwise(F.concat(F.round(score, 3).cast("string"), F.lit(" match")))


def category_label(category: Column) -> Column:
    return F.coalesce(F.nullif(category, F.lit("")), F.lit("Unclassified"))


def file_label(category: Column) -> Column:
    return F.translate(F.lower(category_label(category)), " .,", "-")


def judge_prompt(resume: Column, title: Column, description: Column) -> Column:
    """The instructions with the pair filled in; the judge reads bounded excerpts."""
    head, rest = fixed.JUDGE_PROMPT.split("{resume_text}")
    middle, rest = rest.split("{job_title}")
    before, tail = rest.split("{job_description}")
    return F.concat(F.lit(head), F.substring(text_or_empty(resume), 1, 2000), F.lit(middle), text_or_empty(title),
                    F.lit(before), F.substring(text_or_empty(description), 1, 1000), F.lit(tail))


def parse_grade(reply: Column) -> Column:
    """First character of the trimmed reply as a grade 0..3; anything else is 0."""
    from matchlake.functions.text import strip_ends

    first = F.substring(strip_ends(reply), 1, 1).try_cast("int")
    return F.coalesce(F.least(F.greatest(first, F.lit(0)), F.lit(3)), F.lit(0))
