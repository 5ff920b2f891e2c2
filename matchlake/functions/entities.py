"""HTML entity decoding as one column expression, over the names the standard library lists."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.functions.bind import let

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that also count without a closing semicolon, longest first so a regex prefers them.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
# The names nearly every page is made of are tried before the full table.
_COMMON = ["amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;", "copy;", "middot;"]


def _map_of(pairs: dict[str, str]) -> Column:
    """A constant map; parsing one JSON literal is folded away when the query is planned."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _windows_1252() -> dict[str, str]:
    """Numeric references 128-159 mean the Windows code page, as browsers read them."""
    table = {}
    for code in range(0x80, 0xA0):
        try:
            table[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[str(code)] = chr(code)
    return table


def _code_point(ref: Column) -> Column:
    """The number a reference names; null when it has too many digits for Unicode in either base."""
    is_hex = F.substring(ref, 3, 1).isin("x", "X")
    digits = F.regexp_replace(ref, "^&#[xX]?0*|;$", "")
    return let(F.when(digits == "", F.lit("0")).otherwise(digits), lambda d: F.when(
        F.length(d) <= 7, F.when(is_hex, F.conv(d, 16, 10)).otherwise(d).cast("long")))


def _character(cp: Column) -> Column:
    dropped = (cp.between(1, 8) | cp.between(0xE, 0x1F) | (cp == 0x7F) | cp.between(0xFDD0, 0xFDEF)
               | (cp == 0xB) | (F.pmod(cp, F.lit(0x10000)) >= 0xFFFE))
    return (F.when(cp.isNull() | (cp == 0) | (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(cp == 0xD, F.lit("\r"))
            .when(cp.between(0x80, 0x9F), F.element_at(_map_of(_windows_1252()), cp.cast("string")))
            .when(dropped, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")))


def _numeric(ref: Column) -> Column:
    return let(_code_point(ref), _character)


def _named(ref: Column) -> Column:
    name = F.substring(ref, 2, 40)
    common = F.coalesce(*[F.when(name == n, F.lit(html5[n])) for n in _COMMON])
    full = F.try_element_at(_map_of(html5), name)
    bare = _map_of({n: html5[n] for n in _BARE})
    by_prefix = let(F.regexp_extract(name, "^(" + "|".join(_BARE) + ")", 1), lambda head: F.when(
        head != "", F.concat(F.try_element_at(bare, head), F.substring(name, F.length(head) + 1, F.lit(40)))))
    return F.coalesce(common, full, by_prefix, ref)


def unescape_entities(c: Column) -> Column:
    """Decodes every reference once, left to right; text without '&' is passed through."""
    def one(ref: Column) -> Column:
        return F.when(F.substring(ref, 2, 1) == "#", _numeric(ref)).otherwise(_named(ref))

    between = F.split(c, REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0)), one)
    woven = F.zip_with(between, decoded, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(woven, "")).otherwise(c)
