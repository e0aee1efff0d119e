"""Text expressions: cleaning, markup, keys, labels, tokens. All of them stay in the JVM."""

from __future__ import annotations

import html.entities
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that never reach a cleaned text, and those that XML forbids.
INVISIBLE = "[\u00ad\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]"
FORBIDDEN_IN_XML = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"
#: Characters stripped from both ends of a term.
EDGE = " ,;.:()[]\"'"
WHITE = "(?U)\\s+"


def clean(x: Column) -> Column:
    """Without invisible characters, white space collapsed and trimmed; empty becomes null.

    Invisible ones go first, so that what they hide is collapsed too; white space includes
    the no-break space.
    """
    seen = F.regexp_replace(x, INVISIBLE, "")
    return F.nullif(F.trim(F.regexp_replace(seen, WHITE, " ")), F.lit(""))


def is_clean(x: Column) -> Column:
    """Whether `clean` would leave the text as it is; null is."""
    return F.coalesce((F.length(x) > 0) & ~x.rlike(INVISIBLE) & ~x.rlike("(?U)\\s\\s|^\\s|\\s$|[\\t\\n\\r\\u00a0]"), F.lit(True))


# ---------------------------------------------------------------- character references

#: Named references by name; the standard's own table, those without a semicolon too.
NAMED = dict(html.entities.html5)
#: Names that count without a semicolon, longest first.
BARE = sorted((k for k in NAMED if not k.endswith(";")), key=lambda k: (-len(k), k))
PIECE = r"(?s)(&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&)"
MOST = 0x10FFFF


def _by_initial() -> str:
    """The table as JSON, by first letter, so that a look-up compares few names."""
    out: dict[str, dict[str, str]] = {}
    for name, said in NAMED.items():
        out.setdefault(name[0], {})[name] = said
    return json.dumps(out)


def _character(n: Column) -> Column:
    """The character that a numeric reference means: bytes of the old code page stand for what they were there,
    surrogates and what lies beyond all characters for the replacement character; controls and non-characters vanish."""
    old = F.from_json(F.lit(json.dumps({str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)})), "map<string,string>")
    control = n.between(1, 8) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > MOST), F.lit("\ufffd"))
        .when(n.between(0x80, 0x9F), F.try_element_at(old, n.cast("string")))
        .when(control, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    )


def _decoded(piece: Column) -> Column:
    """What a piece of text says: a reference's character, with the rest of a longer word, or the piece as it is."""
    table = F.from_json(F.lit(_by_initial()), "map<string,map<string,string>>")
    look = lambda name: F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)
    digits = lambda pattern: F.regexp_extract(piece, pattern, 1)
    hexes, tens = digits("^&#[xX]0*([0-9a-fA-F]*);?$"), digits("^&#0*([0-9]*);?$")
    number = lambda d, base, longest: F.when(F.length(d) > longest, F.lit(MOST + 1)).when(d == "", F.lit(0)).otherwise(F.conv(d, base, 10).cast("long"))
    name = F.substring(piece, 2, 40)
    start = F.regexp_extract(name, f"^({'|'.join(BARE)})", 1)
    return (
        F.when(~piece.startswith("&") | (piece == "&"), piece)
        .when(piece.rlike("^&#[xX]"), _character(number(hexes, 16, 6)))
        .when(piece.startswith("&#"), _character(number(tens, 10, 7)))
        .otherwise(F.coalesce(look(name), F.when(start != "", F.concat(look(start), F.substring(name, F.length(start) + 1, F.lit(40)))), piece))
    )


def unescape(x: Column) -> Column:
    """Every character reference decoded once, so `&amp;lt;` is `&lt;`. A text without any is left alone."""
    return F.when(x.contains("&"), F.array_join(F.transform(F.regexp_extract_all(x, F.lit(PIECE), F.lit(1)), _decoded), "")).otherwise(x)


def strip_html(x: Column) -> Column:
    """Decoded, without CDATA markers, tags as spaces, cleaned."""
    bare = F.replace(F.replace(unescape(x), F.lit("<![CDATA["), F.lit("")), F.lit("]]>"), F.lit(""))
    return clean(F.regexp_replace(bare, "<[^>]+>", " "))


def leaf(x: Column) -> Column:
    """What follows the last slash; null if nothing does."""
    return F.nullif(F.regexp_extract(x, "([^/]+)$", 1), F.lit(""))


def after_first(x: Column, separator: str) -> Column:
    """What follows the first separator; empty without one."""
    at = F.instr(x, separator)
    return F.when(at > 0, F.substring(x, at + F.lit(len(separator)), F.length(x))).otherwise(F.when(x.isNotNull(), F.lit("")))


def id_slug(url: Column, separator: str) -> Column:
    """A page's own path as one lower-case word."""
    path = F.regexp_replace(after_first(url, separator), "\\.html$", "")
    return F.lower(F.translate(path, "/", "-"))


def id_hash(slug: Column) -> Column:
    return F.md5(slug)


def without_prefix(x: Column, prefix: str) -> Column:
    return F.regexp_replace(x, f"^{re.escape(prefix)}", "")


def classifier(x: Column) -> Column:
    """The name of a classifier link."""
    return F.nullif(F.regexp_extract(x, "/Common/([^/]+)$", 1), F.lit(""))


def page_url(base: str, href: Column) -> Column:
    return F.concat(F.lit(base), href, F.lit(".html"))


def normal_label(x: Column) -> Column:
    """A label for comparison: lower case, `&` as a word, dashes as spaces, no other signs."""
    low = F.lower(x)
    for old, new in (("&", " und "), ("-", " "), ("/", " ")):
        low = F.replace(low, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(F.regexp_replace(low, "[^0-9a-zäöüß ]", " "), " +", " "))


def tokens(x: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(F.trim(x), WHITE), lambda t: t != "")


def bare(x: Column) -> Column:
    """Without edge punctuation."""
    return F.btrim(x, F.lit(EDGE))


def snake(name: str) -> str:
    """camelCase to snake_case: every capital but the first begins a word."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def classifier_column(name: str, whole: tuple[str, ...] = (), prefixes: tuple[str, ...] = ()) -> str:
    """A column's name for a classifier: `whole` ones are one word, a prefix of capitals is one too."""
    if name in whole:
        return name.lower()
    for p in prefixes:
        if name.startswith(p):
            return f"{p.lower()}_{snake(name[len(p):])}"
    return snake(name)


def camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(x.capitalize() for x in rest)


def snake_case(x: Column) -> Column:
    """`snake` of a column's values."""
    return F.lower(F.regexp_replace(x, "(?<!^)(?=[A-Z])", "_"))


def classifier_case(x: Column, whole: tuple[str, ...] = (), prefixes: tuple[str, ...] = ()) -> Column:
    """`classifier_column` of a column's values."""
    out = snake_case(x)
    for p in reversed(prefixes):
        out = F.when(x.startswith(p), F.concat(F.lit(f"{p.lower()}_"), snake_case(F.substring(x, len(p) + 1, 1 << 30)))).otherwise(out)
    return F.when(x.isin(*whole), F.lower(x)).otherwise(out) if whole else out


def camel_case(x: Column) -> Column:
    """`camel` of a column's values."""
    parts = F.split(x, "_")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
    return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))
