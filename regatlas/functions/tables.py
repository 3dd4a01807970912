"""Tables in HTML: rows, classes and typed contents."""

from __future__ import annotations

import html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..profile import Profile
from .text import first_hex, normalize_ocr

FIELD = "struct<name:string,bit_range:string,access:string,reset_value:string,typical_value:string,description:string>"


class _Rows(HTMLParser):
    """Cells of all rows at any depth; pieces of text in a cell are joined by a blank."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list[str]]] = []
        self.open: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.open.append([])
            self.rows[-1].append(self.open[-1])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.open:
            self.open.pop()
        elif tag == "tr":
            self.open.clear()

    def handle_data(self, data: str) -> None:
        for cell in self.open:
            cell.append(data)


def parse_rows(body: str) -> list[list[str]]:
    parser = _Rows()
    parser.feed(body)
    parser.close()
    return [[" ".join(cell) for cell in row] for row in parser.rows]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _rows(body: pd.Series) -> pd.Series:
    return body.map(lambda b: [[html.unescape(c) for c in row] for row in parse_rows(b)], na_action="ignore")


def html_rows(body: Column, profile: Profile = Profile()) -> Column:
    """Cleaned cells of an HTML table, rows without any text left out; null or empty gives no rows.

    The tolerant parser is the one Python step; cleaning the cells stays in the JVM.
    """
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    noisy = lambda x: F.array_contains(F.array(*[x.contains(n) for n in profile.noise]), True)

    def cell(c: Column) -> Column:
        out = squeeze(F.regexp_replace(F.regexp_replace(c, r"\\([_*#`\[\]()])", "$1"), r"[\p{C}\x{FFFD}&&[^\n\t]]", ""))
        kept = F.array_join(F.filter(F.split(out, " "), lambda t: ~noisy(F.lower(t))), " ")
        return F.when(noisy(F.lower(out)), kept).otherwise(out)

    rows = F.transform(F.coalesce(_rows(body), F.array()), lambda r: F.transform(r, cell))
    return F.filter(rows, lambda r: F.exists(r, lambda c: c != ""))


def find_col(header: Column, key: str, profile: Profile = Profile()) -> Column:
    """0-based column whose header holds an alias of ``key``; an earlier alias wins over an earlier column; null if none."""
    holds = lambda alias: F.transform(header, lambda c: F.lower(c).contains(alias))
    at = [F.nullif(F.array_position(holds(a), True), F.lit(0)) for a in profile.aliases[key]]
    return (F.coalesce(*at) - 1).cast("int")


def classify_table(header: Column, profile: Profile = Profile()) -> Column:
    """``bitfield``, ``summary``, ``enum`` or ``other`` by the header's words."""
    joined = F.lower(F.array_join(header, " "))
    holds = lambda key: F.array_contains(F.array(*[joined.contains(a) for a in profile.aliases[key]]), True)
    return (
        F.when(holds("bit_position") & holds("field_name"), "bitfield")
        .when(holds("register") & holds("address"), "summary")
        .when(holds("mnemonic") & holds("value"), "enum")
        .otherwise("other")
    )


def cell_at(row: Column, column: Column) -> Column:
    return F.coalesce(F.when(column.isNotNull(), F.get(row, column)), F.lit(""))


def _body(rows: Column) -> Column:
    return F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))


def bit_fields(rows: Column, profile: Profile = Profile()) -> Column:
    """Fields of the rows whose position matches; a field without a name is RESERVED."""
    header = F.get(rows, 0)
    col = {k: find_col(header, k, profile) for k in ("bit_position", "field_name", "access", "reset", "typical", "description")}
    pattern = "|".join(f"(?:^(?:{p}))" for p in profile.bit_positions)
    kept = F.filter(_body(rows), lambda r: cell_at(r, col["bit_position"]).rlike(pattern))
    return F.transform(
        kept,
        lambda r: F.struct(
            F.coalesce(F.nullif(cell_at(r, col["field_name"]), F.lit("")), F.lit("RESERVED")).alias("name"), cell_at(r, col["bit_position"]).alias("bit_range"),
            cell_at(r, col["access"]).alias("access"), cell_at(r, col["reset"]).alias("reset_value"), cell_at(r, col["typical"]).alias("typical_value"),
            cell_at(r, col["description"]).alias("description"),
        ),
    )


def summary_rows(rows: Column, profile: Profile = Profile()) -> Column:
    """``(register_name, address)`` of each row with a register name that holds '_'; no hex number means ''."""
    header = F.get(rows, 0)
    name_at, address_at = find_col(header, "register", profile), find_col(header, "address", profile)
    tokens = lambda r: F.split(normalize_ocr(cell_at(r, name_at)), r"(?U)\s+")
    name = lambda r: F.get(F.filter(tokens(r), lambda t: t.contains("_") & t.rlike(f"^(?:{profile.register_name})")), F.lit(0))
    each = F.transform(_body(rows), lambda r: F.struct(name(r).alias("register_name"), first_hex(cell_at(r, address_at)).alias("address")))
    return F.filter(each, lambda s: s["register_name"].isNotNull())


def enum_values(rows: Column, profile: Profile = Profile()) -> Column:
    """``(value, mnemonic, description)`` of the rows that have a value or a mnemonic."""
    header = F.get(rows, 0)
    value, mnemonic, about = (find_col(header, k, profile) for k in ("value", "mnemonic", "description"))
    each = F.transform(_body(rows), lambda r: F.struct(cell_at(r, value).alias("value"), cell_at(r, mnemonic).alias("mnemonic"), cell_at(r, about).alias("description")))
    return F.filter(each, lambda s: (s["value"] != "") | (s["mnemonic"] != ""))
