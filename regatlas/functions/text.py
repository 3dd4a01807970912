"""Text functions of the engine as column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..profile import Profile

SPACE = r"(?U)\s+"
# Words that keep their form.
UNSTEMMED = ("does", "this", "was", "has", "his", "its", "ours", "theirs", "yes")
# End of fixed values.


@F.pandas_udf(T.StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def _squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE, " "))


def clean_text(text: Column, entities: bool = True) -> Column:
    """Entities decoded, Markdown escapes, control, private-use and replacement characters removed, white space one blank.

    Null becomes ''. Only texts with '&' leave the JVM; ``entities=False`` keeps them as they are.
    """
    out = F.coalesce(text, F.lit(""))
    if entities:
        out = F.when(out.contains("&"), _unescaped(F.when(out.contains("&"), out))).otherwise(out)
    out = F.regexp_replace(out, r"\\([_*#`\[\]()])", "$1")
    return _squeeze(F.regexp_replace(out, r"[\p{C}\x{FFFD}&&[^\n\t]]", ""))


def strip_noise(text: Column, profile: Profile = Profile()) -> Column:
    """Drop the blank-separated tokens that hold a noise word, where the text holds any."""
    low = F.lower(text)
    holds = lambda x: F.array_contains(F.array(*[x.contains(n) for n in profile.noise]), True)
    kept = F.array_join(F.filter(F.split(_squeeze(text), " "), lambda t: ~holds(F.lower(t))), " ")
    return F.when(holds(low), kept).otherwise(text)


def normalize_ocr(name: Column) -> Column:
    return F.replace(name, F.lit("(O.."), F.lit("(0.."))


def section_id(module: Column, title: Column) -> Column:
    """``module:slug`` in lower case, at most 120 characters; '' for an empty title."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(title, F.lit("")) == "", "").otherwise(F.substring(F.concat(F.lower(module), F.lit(":"), slug), 1, 120))


def is_register_name(text: Column, profile: Profile = Profile()) -> Column:
    name = normalize_ocr(text)
    ok = (F.length(name) >= 4) & name.rlike(f"^(?:{profile.register_name})")
    return ok & name.contains("_") if profile.require_underscore else ok


def register_token(text: Column, profile: Profile = Profile()) -> Column:
    """First register name among the tokens and their pieces at a change from lower to upper case; '' if none."""
    tokens = F.split(_squeeze(normalize_ocr(text)), " ")
    bare = F.transform(tokens, lambda t: F.regexp_replace(t, r"^[.,:；;]+|[.,:；;]+$", ""))
    pieces = F.flatten(F.transform(bare, lambda t: F.concat(F.array(t), F.split(t, "(?<=[a-z])(?=[A-Z])"))))
    return F.coalesce(F.get(F.filter(pieces, lambda t: is_register_name(t, profile)), F.lit(0)), F.lit(""))


def first_hex(text: Column) -> Column:
    return F.regexp_extract(text, "0x[0-9A-Fa-f]+", 0)


def image_path(module: Column, path: Column) -> Column:
    given = F.coalesce(path, F.lit(""))
    return F.when(given == "", "").otherwise(F.concat(F.lit("images/"), module, F.lit("/"), F.regexp_extract(given, "([^/]+)/*$", 1)))


def chunk_clean(text: Column) -> Column:
    """Markdown escapes and heading marks removed, white space one blank."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\([_*#`\[\]()])", "$1")
    return _squeeze(F.regexp_replace(out, r"(?U)(^|\s)#{1,6}\s+", "$1"))


def norm_title(title: Column) -> Column:
    return _squeeze(F.lower(F.coalesce(title, F.lit(""))))


def norm_field(name: Column) -> Column:
    """Bit-field name with one '_' between its parts, lower case."""
    return F.replace(_squeeze(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("_"))


def light_stem(word: Column) -> Column:
    """Careful English stem of a lower-case word; short words, words with digits and UNSTEMMED keep their form."""
    n = F.length(word)
    cut = lambda k: F.left(word, n - k)
    stem = (
        F.when((n > 5) & word.endswith("ies"), F.concat(cut(3), F.lit("y")))
        .when((n > 5) & word.endswith("ing"), cut(3))
        .when((n > 4) & word.endswith("ed"), cut(2))
        .when((n > 4) & word.endswith("es") & ~word.rlike("(?:ses|xes)$"), cut(2))
        .when(word.endswith("s") & ~word.rlike("(?:ss|us|is)$"), cut(1))
        .when((n > 4) & word.endswith("e") & ~word.endswith("ee"), cut(1))
        .otherwise(word)
    )
    single = F.regexp_replace(stem, r"^(.{2,})([^aeiou])\2$", "$1$2")
    return F.when(~word.rlike("^[a-z]{4,}$") | word.isin(*UNSTEMMED), word).otherwise(single)


def tokenize(text: Column) -> Column:
    """Identifier-aware tokens: an identifier with '_' whole and its stemmed parts, any other word as its stem."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+(?:_[a-z0-9]+)*"), 0)
    each = lambda t: F.when(t.contains("_"), F.concat(F.array(t), F.transform(F.split(t, "_"), light_stem))).otherwise(F.array(light_stem(t)))
    return F.flatten(F.transform(found, each))


def _full(items: list[Column], sep: str) -> Column:
    return F.array_join(F.filter(F.array(*[F.coalesce(x.cast("string"), F.lit("")) for x in items]), lambda x: x != ""), sep)


def register_text(name: Column, address: Column, description: Column, bit_fields: Column) -> Column:
    """Register as text: name, address, description, then each field without its typical value."""
    head = F.array(*[F.coalesce(x, F.lit("")) for x in (name, address, description)])
    fields = F.transform(F.coalesce(bit_fields, F.array()), lambda f: _full([f["bit_range"], f["name"], f["access"], f["reset_value"], f["description"]], " "))
    return F.array_join(F.filter(F.concat(head, fields), lambda x: x != ""), ". ")


def enum_text(name: Column, values: Column) -> Column:
    each = F.transform(F.coalesce(values, F.array()), lambda v: _full([v["value"], v["mnemonic"], v["description"]], " "))
    return F.array_join(F.filter(F.concat(F.array(F.coalesce(name, F.lit(""))), each), lambda x: x != ""), ". ")


def table_text(header: Column, rows: Column) -> Column:
    body = F.array_join(F.transform(rows, lambda r: F.array_join(r, " | ")), "\n")
    return F.regexp_replace(F.concat(F.array_join(header, " | "), F.lit("\n"), body), r"(?U)^\s+|\s+$", "")


def haystack(name: Column, description: Column, bit_fields: Column) -> Column:
    """What a register search looks in: name, description, names and descriptions of the fields, lower case."""
    e = F.lit("")
    parts = F.flatten(F.transform(F.coalesce(bit_fields, F.array()), lambda f: F.array(F.coalesce(f["name"], e), F.coalesce(f["description"], e))))
    return F.lower(F.array_join(F.concat(F.array(F.coalesce(name, e), F.coalesce(description, e)), parts), " "))
