"""Characters that look alike: fixed pairs and a cheap JVM-side fold for identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other scripts with the shape of a Latin letter.
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "у": "y", "ԝ": "w", "х": "x", "ѵ": "v", "ӏ": "l",
}
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "υ": "u", "κ": "k",
}
ARMENIAN = {"Օ": "O", "Ս": "U", "օ": "o", "ո": "n", "ս": "u", "հ": "h"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
ZERO_WIDTH = "\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff\u180e\u034f"
HARD_SPACES = "\u00a0\u2007\u202f"
# End of fixed values.

LETTERS = CYRILLIC | GREEK | ARMENIAN
FULL_WIDTH = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F) if chr(c).isalnum() or chr(c) == "_"}


def plain_identifier(name: Column) -> Column:
    """Upper-case ASCII form of an identifier; equal-looking names become equal.

    Null stays null. Outer blanks, zero-width characters and combining accents go,
    full-width forms, ligatures and letters of other scripts become Latin.
    """
    single = LETTERS | FULL_WIDTH
    src = "".join(single) + HARD_SPACES + ZERO_WIDTH
    dst = "".join(single.values()) + " " * len(HARD_SPACES)
    out = F.translate(name, src, dst)
    for ligature, plain in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(plain))
    out = F.regexp_replace(out, r"\p{Mn}", "")
    return F.upper(F.regexp_replace(out, r"(?U)^\s+|\s+$", ""))


def blank(text: Column) -> Column:
    """True for null, empty and white-space-only values."""
    return ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))
