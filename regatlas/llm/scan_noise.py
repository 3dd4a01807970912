"""Noise in text from scanned pages: broken words, misread characters, page furniture; and its repair."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.lookalike import FULL_WIDTH, HARD_SPACES, LETTERS, LIGATURES, ZERO_WIDTH
from ..session import cut
from .misreadings import misread_words, word_filter
from .source_lines import is_body

# Letters taken for digits by their shape, and marks at the end of a broken line.
DIGIT_SHAPES = {"O": "0", "o": "0", "Q": "0", "l": "1", "I": "1", "i": "1", "|": "1", "S": "5", "s": "5", "Z": "2", "z": "2"}
BREAK_MARKS = "-¬‐­"
PAGE_WORDS = ["page", "pg", "seite", "стр", "страница", "第"]
PAGE_LETTERS = ["s", "p"]  # only with a full stop
PAGE_TOTALS = ["of", "von", "из", "/", "共"]
# End of fixed values.

#: Share of the documents with a known offset between printed and counted pages that must share an offset for it to be trusted elsewhere.
OFFSET_SHARE = 0.01
#: Positions of a document that one window sorts.
SPAN = 4096

_FOLD = {**LETTERS, **FULL_WIDTH, **LIGATURES, **dict.fromkeys(ZERO_WIDTH, ""), **dict.fromkeys(HARD_SPACES, " ")}
_USUAL = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\uff21-\uff3a\uff41-\uff5a\ufb00-\ufb06"
_LOOK = "".join(LETTERS)
_FOLDS = re.compile(rf"[{''.join(c for c in _FOLD if c not in LETTERS)}\u0300-\u036f]|[{_USUAL}]\w*[{_LOOK}]|[{_LOOK}]\w*[{_USUAL}]")
_FOREIGN, _FOLD_MARKS = frozenset(LETTERS), frozenset(_FOLD) | frozenset(map(chr, range(0x300, 0x370)))
_WORD = re.compile(rf"[\ẁ-ͯ{ZERO_WIDTH}]+")
_LATIN = re.compile(f"[{_USUAL}]")
_TOKEN = re.compile(r"[^\W_㐀-鿿]+(?:_[^\W㐀-鿿]*)*")
_MAY_BREAK = re.compile(rf"[{BREAK_MARKS}]\s*(?:\n|$|<(?i:br))")
_BROKEN = re.compile(rf"([^\W\d_]+)([{BREAK_MARKS}])\s*$")
_GOES_ON = re.compile(r"\s*([^\W\d_]+)(\S*)")
_HEX = re.compile(r"[0oOQ][xX][0-9A-Fa-fOoQlIi|SsZz]{1,16}")
_TRUE_HEX = re.compile(r"0[xX][0-9A-Fa-f]+")
_NUMBER = re.compile(r"[0-9OoQlIi|SsZz]{2,12}")
_CELL = r"(?i:</?(?:table|thead|tbody|tr|td|th)\b[^>]*>)"
_CELL_TAG, _LINE_TAG, _TAG = re.compile(_CELL), re.compile(r"(?i)<br\s*/?>"), re.compile(r"(<[^>]*>)")


# -- reading ---------------------------------------------------------------------------------------------------------


def fold(text: str) -> tuple[str, list[int] | None]:
    """``text`` as it is read, look-alike characters as Latin ones, and where each of its characters stands in ``text``.

    Only words that hold a Latin letter have letters of other scripts folded, so words wholly in another script stay as they
    are. The places are None where nothing changed; else there is one more, for the end.
    """
    if text.isascii() or _FOLD_MARKS.isdisjoint(text) or not _FOLDS.search(text):
        return text, None
    out: list[str] = []
    places: list[int] = []

    def put(new: str, at: int) -> None:
        out.append(new)
        places.extend([at] * len(new))

    def put_all(start: int, end: int, foreign: bool) -> None:
        at = start
        while at < end:
            ch = text[at]
            new = _FOLD.get(ch, ch) if foreign or ch not in _FOREIGN else ch
            size = 1
            if at + 1 < end and "̀" <= text[at + 1] <= "ͯ" and len(whole := unicodedata.normalize("NFC", new + text[at + 1])) == 1:
                new, size = whole, 2
            put(new, at)
            at += size

    at = 0
    for m in _WORD.finditer(text):
        put_all(at, m.start(), False)
        put_all(m.start(), m.end(), bool(_LATIN.search(m.group())))
        at = m.end()
    put_all(at, len(text), False)
    return "".join(out), [*places, len(text)]


def number_misread(token: str) -> str | None:
    """The number that ``token`` should be, if it holds letters taken for digits."""
    if _HEX.fullmatch(token) and not _TRUE_HEX.fullmatch(token):
        rest = "".join(c if c in "0123456789ABCDEFabcdef" else DIGIT_SHAPES[c] for c in token[2:])
        return "0x" + rest
    if _NUMBER.fullmatch(token) and not token.isdigit() and any(c.isdigit() for c in token):
        return "".join(DIGIT_SHAPES.get(c, c) for c in token)
    return None


def is_wordlike(token: str) -> bool:
    """Lower-case letters, perhaps one capital first, perhaps digits among them."""
    if "_" in token or len(token) < 2 or not any(c.islower() for c in token):
        return False
    return not any(c.isupper() for c in token[1:])


def is_suspect(token: str) -> bool:
    """Like a word, or one with capitals inside that small letters are taken for by their shape; not with other capitals inside."""
    if is_wordlike(token):
        return True
    if "_" in token or any(c.isupper() and c not in DIGIT_SHAPES for c in token[1:]):
        return False
    return sum(map(str.islower, token)) > sum(map(str.isupper, token))


def pieces(field: str, text: str, furniture: Iterable[int] = ()) -> list[list[str]]:
    """Runs of lines that read on: one for a text, one a cell for a table. Furniture lines (numbered from 1) are left out."""
    if field == "text":
        skip = set(furniture)
        return [[x for i, x in enumerate(text.split("\n"), 1) if i not in skip]]
    if not _MAY_BREAK.search(text):
        return [_plain(text).split("\n")]
    return [_plain(_LINE_TAG.sub("\n", c)).split("\n") for c in _CELL_TAG.split(text) if c.strip()]


def _plain(cell: str) -> str:
    """``cell`` without tags and entities."""
    bare = _TAG.sub(" ", cell)
    return html.unescape(bare) if "&" in bare else bare


def join_lines(lines: list[str], after: str | None, before: bool, compounds: Iterable[tuple[str, str]] = ()) -> tuple[list[str], list[tuple[str, str, str]]]:
    """The lines with words broken at their ends made whole, and ``(head, mark, tail)`` of each that was.

    The rest of the broken token moves to the line where it begins. ``after`` is the first token of the block that follows;
    ``before``: the first token's head stands in the block before, so it is left out. ``compounds`` are the (head, tail) that
    keep their hyphen.
    """
    lines, broken = list(lines), []
    full = [i for i, x in enumerate(lines) if x.strip()]
    if before and full and (m := _GOES_ON.match(lines[full[0]])) and m.group(1)[0].islower():
        lines[full[0]] = lines[full[0]][m.end() :]
        if not lines[full[0]].strip():
            full = full[1:]
    for k, i in enumerate(full):
        if lines[i].rstrip()[-1:] not in BREAK_MARKS or not (m := _BROKEN.search(lines[i])) or not m.group(1)[-1].islower():
            continue
        inside = k + 1 < len(full)
        n = _GOES_ON.match(lines[full[k + 1]] if inside else after or "")
        if not n or not n.group(1)[0].islower():
            continue
        head, mark, tail = m.group(1), m.group(2), n.group(1)
        broken.append((head, mark, tail))
        lines[i] = lines[i][: m.end(1)] + ("-" if (head, tail) in compounds else "") + tail + n.group(2)
        if inside:
            lines[full[k + 1]] = lines[full[k + 1]][n.end() :].lstrip()
    return lines, broken


def _read_rows(batch: pa.RecordBatch, *more: str) -> Iterator[tuple]:
    yield from zip(*(batch.column(c).to_pylist() for c in ("block_id", "field", "text", "furniture", "after", "before", *more)))


def whole_text(field: str, text: str, furniture: list[int] | None, after: str | None, before: bool) -> tuple[str, list[tuple[str, str, str]]]:
    """A block as it is read, without furniture and with broken words made whole, and its broken words."""
    if not (furniture or before) and not _MAY_BREAK.search(text):
        return fold(text if field == "text" else _plain(text))[0], []
    out, broken = [], []
    for lines in pieces(field, text, furniture or ()):
        lines, each = join_lines(lines, after if field == "text" else None, before)
        out += lines
        broken += each
    return fold("\n".join(out))[0], broken


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a first reading tells, by ``kind``: ``word`` rows count the words (``n``; those broken at line ends are left out),
    ``number`` rows are blocks with a misread number, ``hyphen`` rows broken words (``word``, ``mark``, ``tail``)."""
    judged: dict[str, str | None] = {}  # tokens in lower case, None for what is no word, '' for misread numbers
    for batch in batches:
        rows: set[tuple] = set()
        texts, cut_up = [], []
        for block, field, text, furniture, after, before in _read_rows(batch):
            whole, broken = whole_text(field, text, furniture, after, before)
            texts.append((block, field, _TOKEN.findall(whole)))
            for head, mark, tail in broken:
                rows.add(("hyphen", block, field, fold(head)[0].lower(), mark, fold(tail)[0].lower(), 0))
                cut_up.append(fold(head + tail)[0])
        counted = Counter(chain.from_iterable(tokens for _, _, tokens in texts))
        if len(judged) > 500_000:
            judged.clear()
        for token in counted.keys() - judged.keys():
            judged[token] = "" if number_misread(token) else token.lower() if is_suspect(token) else None
        numbers = {t for t in counted if judged[t] == ""}
        rows.update(("number", block, field, None, None, None, 0) for block, field, tokens in texts if not numbers.isdisjoint(tokens))
        counted.subtract(cut_up)
        found: Counter = Counter()
        for token, n in counted.items():
            if n > 0 and (word := judged[token]):
                found[word] += n
        cols = list(zip(*rows, *(("word", None, None, w, None, None, n) for w, n in found.items()))) or [[]] * 7
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["kind", "block_id", "field", "word", "mark", "tail", "n"])


_READ = "kind string, block_id long, field string, word string, mark string, tail string, n long"


# -- blocks with their furniture and the block that follows ---------------------------------------------------------


def _line_key(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", ""), r"(?U)\s+", " "))


_ROMAN = "(?=[mdclxvi])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"


def _roman(text: Column) -> Column:
    """Value of a Roman numeral."""
    value = lambda c: F.element_at(F.create_map(*[F.lit(x) for k, v in {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}.items() for x in (k, v)]), c)
    digits = F.filter(F.split(F.lower(text), ""), lambda c: c != "")
    return F.aggregate(
        F.transform(digits, lambda c, i: F.struct(value(c).alias("v"), F.coalesce(value(F.get(digits, i + 1)), F.lit(0)).alias("next"))),
        F.lit(0), lambda total, d: total + F.when(d["v"] < d["next"], -d["v"]).otherwise(d["v"]),
    )


def _page_shape() -> str:
    """Pattern of a line that gives only a number: 1 what names it a page, 2 the number, 3 the number of pages, 4 the same as 1."""
    words = "|".join([rf"(?:{'|'.join(PAGE_WORDS)})\.?", rf"(?:{'|'.join(PAGE_LETTERS)})\."])
    return rf"(?iU)^[\W_]*(?:({words})\s*)?([0-9]{{1,9}}|{_ROMAN})\s*(?:(?:{'|'.join(PAGE_TOTALS)})\s*([0-9]{{1,9}}|{_ROMAN}))?\s*(页?)[\W_]*$"


def page_numbers(lines: DataFrame, marks: DataFrame, pages: DataFrame) -> DataFrame:
    """``(block_id, doc_file, line_no)`` of the ``lines``, of the shape of one, that give only the number of their page.

    A line that names itself a page (PAGE_WORDS) is one. Another is one when printed number and ``page_idx`` stand apart as
    they do throughout its document: by the offset that most pages' headers and footers (``marks``) and lines of numbers agree
    on, two pages at least. Where a document has no such offset, any dressed number is one, and a bare one by an offset that
    OFFSET_SHARE of the other documents have.
    Roman numerals need a dress or a second page with the same offset. A null ``page_idx`` takes any page of the document.
    """
    shape = _page_shape()
    part = lambda i: F.regexp_extract("line", shape, i)
    number = lambda c: F.when(c.rlike(r"^\d+$"), c.cast("long")).when(c != "", _roman(c).cast("long"))
    found = lines.select(
        "block_id", "doc_file", "page_idx", "line_no", "range_end", number(part(2)).alias("n"), number(part(3)).alias("of"), (~part(2).rlike(r"^\d")).alias("roman"),
        ((part(1) != "") | (part(4) != "")).alias("named"), (~F.col("line").rlike(r"(?U)^\s*\w+\s*$")).alias("dressed"),
    ).where("n > 0 AND (of IS NULL OR n <= of)").where("NOT (roman AND named AND NOT dressed)")
    found = cut(found)
    in_marks = marks.where("page_idx IS NOT NULL").select("doc_file", "page_idx", F.lit(False).alias("roman"), F.explode(F.regexp_extract_all("line", F.lit(r"(\d{1,9})"), 1).cast("array<bigint>")).alias("n"))
    seen = in_marks.unionByName(found.where("page_idx IS NOT NULL").select("doc_file", "page_idx", "roman", "n"))
    agreed = seen.groupBy("doc_file", "roman", (F.col("n") - F.col("page_idx")).alias("offset")).agg(F.count_distinct("page_idx").alias("pages")).where("pages > 1")
    offsets = agreed.groupBy("doc_file", "roman").agg(F.max_by("offset", F.struct("pages", -F.abs("offset"), "offset")).alias("offset"))
    share = F.sum("n").over(W.Window.partitionBy())
    usual = offsets.where("NOT roman").groupBy("offset").agg(F.count(F.lit(1)).alias("n")).withColumn("all", share).where(F.col("n") >= F.col("all") * OFFSET_SHARE).select("offset", F.lit(True).alias("usual"))
    rows = found.join(offsets.withColumnRenamed("offset", "own"), ["doc_file", "roman"], "left").join(pages, "doc_file", "left")
    rows = rows.withColumn("offset", F.col("n") - F.col("page_idx")).join(usual, "offset", "left")
    within = F.col("n") - F.coalesce("own", F.lit(0))
    fits = (
        F.when(F.col("roman") & F.col("own").isNull(), False)
        .when(F.col("page_idx").isNull(), within.between(0, F.coalesce("last_page", F.lit(0)) + F.when(F.col("own").isNull(), 1).otherwise(0)))
        .when(F.col("own").isNotNull(), F.col("offset") == F.col("own"))
        .otherwise(F.col("dressed") | F.coalesce("usual", F.lit(False)))
    )
    return rows.where(F.col("named") | (fits & ~(~F.col("dressed") & F.col("range_end")))).select("block_id", "doc_file", "line_no")


def furniture_lines(blocks: DataFrame) -> DataFrame:
    """``(block_id, doc_file, line_no, kind)``: ``running`` and ``page_number`` lines of body blocks.

    Only (document, line hash) and the lines of numbers are shuffled, never other text.
    """
    body = blocks.where(is_body(blocks)).select("block_id", "doc_file", "page_idx", "text").where("text <> ''")
    prior = F.get(F.split("text", "\n"), F.col("at") - 1)
    each = body.select("block_id", "doc_file", "page_idx", "text", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = cut(
        each.select(
            "block_id", "doc_file", "page_idx", (F.col("at") + 1).alias("line_no"), F.when(F.col("line").rlike(_page_shape()), F.col("line")).alias("line"),
            F.when(F.col("line").rlike(r"\p{L}"), F.xxhash64(_line_key(F.col("line")))).alias("h"),
            (F.col("line").rlike(r"^\s*\d+\s*$") & F.coalesce(prior.rlike(rf"[{BREAK_MARKS}–—]\s*$"), F.lit(False))).alias("range_end"),
        ).where("line IS NOT NULL OR h IS NOT NULL")
    )
    marks = blocks.where(F.col("type").isin("header", "footer")).select("doc_file", "page_idx", F.explode(F.split("text", "\n")).alias("line"))
    keys = marks.where(_line_key(F.col("line")).rlike(r"\p{L}")).select("doc_file", F.xxhash64(_line_key(F.col("line"))).alias("h")).distinct()
    keyed = lines.where("h IS NOT NULL").select("block_id", "doc_file", "line_no", "h")
    running = keyed.join(keys, ["doc_file", "h"], "left_semi").select("block_id", "doc_file", "line_no", F.lit("running").alias("kind"))
    pages = blocks.groupBy("doc_file").agg(F.max("page_idx").alias("last_page"))
    page = page_numbers(lines.where("line IS NOT NULL"), marks, pages).withColumn("kind", F.lit("page_number"))
    return running.unionByName(page.select("block_id", "doc_file", "line_no", "kind")).distinct()


def scanned_blocks(blocks: DataFrame, furniture: DataFrame) -> DataFrame:
    """``(block_id, field, text, furniture, after, before)``: body texts and tables, once each.

    ``furniture`` are the numbers of furniture lines; ``after`` the first token of the document's next body block where this
    block ends in a broken word, and ``before`` whether the block before ends so. Blocks of furniture alone are passed over.
    Neighbours are found within spans of SPAN positions first and then among the spans, so that no task sorts a whole document.
    """
    body = blocks.where(is_body(blocks)).where("text <> ''").select("block_id", "doc_file", "pos", "text").dropDuplicates(["block_id"])
    marks = furniture.groupBy("block_id").agg(F.collect_set("line_no").alias("furniture"))
    body = body.join(marks, "block_id", "left")
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), F.coalesce(F.array_contains("furniture", i + 1), F.lit(False)).alias("f"))),
        lambda s: ~s["f"] & s["x"].rlike(r"(?U)\S"),
    )
    broken_end = rf"\p{{Ll}}[{BREAK_MARKS}](?U)\s*"
    may_end = F.col("text").rlike(rf"{broken_end}(?:\n|$)")
    first = F.when(F.col("furniture").isNull(), F.regexp_extract("text", r"(?U)^\s*(\S+)", 1)).otherwise(F.regexp_extract(F.get(lines, F.lit(0))["x"], r"(?U)(\S+)", 1))
    ends = F.when(may_end, F.coalesce(F.get(lines, F.size(lines) - 1)["x"].rlike(f"{broken_end}$"), F.lit(False))).otherwise(False)
    heads = body.select("block_id", "doc_file", "pos", F.floor(F.col("pos") / SPAN).alias("span"), first.alias("head"), ends.alias("ends")).where("head <> ''")
    heads = heads.withColumn("head", F.when(F.col("head").rlike(r"^\p{Ll}"), F.col("head")))
    own = F.struct("head", "ends")
    within = W.Window.partitionBy("doc_file", "span").orderBy("pos", "block_id")
    near = heads.withColumn("next", F.lead(own).over(within)).withColumn("prev", F.lag(own).over(within))
    order = F.struct("pos", "block_id")
    spans = heads.groupBy("doc_file", "span").agg(F.min_by(own, order).alias("first"), F.max_by(own, order).alias("last"))
    over = W.Window.partitionBy("doc_file").orderBy("span")
    spans = spans.select("doc_file", "span", F.lead("first").over(over).alias("next_first"), F.lag("last").over(over).alias("prev_last"))
    edge = "next IS NULL AND ends OR prev IS NULL AND head IS NOT NULL"
    link = lambda n, p: [F.when(F.col("ends"), n["head"]).alias("after"), (F.col("head").isNotNull() & F.coalesce(p["ends"], F.lit(False))).alias("before")]
    inner = near.where(f"NOT ({edge})").where("ends OR prev.ends").select("block_id", *link(F.col("next"), F.col("prev")))
    outer = near.where(edge).join(spans, ["doc_file", "span"], "left").select("block_id", *link(F.coalesce("next", "next_first"), F.coalesce("prev", "prev_last")))
    links = inner.unionByName(outer).where("after IS NOT NULL OR before")
    texts = body.join(links, "block_id", "left").select("block_id", F.lit("text").alias("field"), "text", "furniture", "after", F.coalesce("before", F.lit(False)).alias("before"))
    tables = blocks.where("type = 'table' AND table_body <> ''").dropDuplicates(["block_id"])
    none = F.lit(None)
    cells = tables.select(
        "block_id", F.lit("table_body").alias("field"), F.col("table_body").alias("text"), none.cast("array<int>").alias("furniture"), none.cast("string").alias("after"), F.lit(False).alias("before")
    )
    return texts.unionByName(cells)


# -- detection -------------------------------------------------------------------------------------------------------


def _read(blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Furniture, scanned blocks, their first reading, the broken words that are compounds, and the misread words."""
    furniture = cut(furniture_lines(blocks))
    scanned = cut(scanned_blocks(blocks, furniture))
    reading = cut(scanned.mapInArrow(read_blocks, _READ))
    counts = cut(reading.where("kind = 'word'").groupBy("word").agg(F.sum("n").alias("n")))
    broken = reading.where("kind = 'hyphen'").groupBy("word", "mark", "tail").agg(F.lit(1)).select("word", "mark", "tail", F.concat("word", "tail").alias("whole"))
    known = lambda c: counts.select(F.col("word").alias(c), F.col("n").alias(f"{c}_n"))
    told = cut(broken.withColumnRenamed("word", "head").join(known("head"), "head", "left").join(known("tail"), "tail", "left").join(known("whole"), "whole", "left"))
    compound = F.coalesce((F.col("mark") == "-") & (F.coalesce("whole_n", F.lit(0)) < F.least("head_n", "tail_n")) & F.col("head_n").isNotNull() & F.col("tail_n").isNotNull(), F.lit(False))
    compounds = told.where(compound).select("head", "mark", "tail")
    misread = cut(misread_words(counts, told.where(~compound).select(F.col("whole").alias("word")).distinct()))
    return furniture, scanned, reading, compounds, misread


def _occurrences(scanned: DataFrame, misread: DataFrame, contexts: bool) -> DataFrame:
    """``(block_id, field, word, left, right)``: where misread words stand; the neighbours only if ``contexts``."""
    wrong = word_filter(misread.select("word").distinct())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(block, field, _TOKEN.findall(whole_text(field, text, furniture, after, before)[0])) for block, field, text, furniture, after, before in _read_rows(batch)]
            said = {t: t.lower() for t in set().union(*(tokens for _, _, tokens in rows)) if is_suspect(t) and t.lower() in wrong}
            out = set()
            for block, field, tokens in rows:
                if said.keys().isdisjoint(tokens):
                    continue
                if not contexts:
                    out.update((block, field, said[t], None, None) for t in said.keys() & set(tokens))
                    continue
                low = ["", *map(str.lower, tokens), ""]
                out.update((block, field, low[i], low[i - 1], low[i + 1]) for i, t in enumerate(tokens, 1) if t in said)
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["block_id", "field", "word", "left", "right"])

    return scanned.mapInArrow(read, "block_id long, field string, word string, left string, right string")


def scan_noise(blocks: DataFrame) -> DataFrame:
    """Distinct ``(block_id, field, noise)`` of every damaged block: ``hyphen``, ``misread``, ``running``, ``page_number``.

    Null and empty texts hold no noise; a block delivered twice counts once, blocks of one position follow by id; a null
    ``page_idx`` accepts any page number of the document. Words wholly in another script are read as they are. An empty
    table gives an empty result.

    Scale: counts, tries and joins are partitioned by word; what goes to every task is a filter of at most 16 MB, whose false
    hits the join removes.
    """
    furniture, scanned, reading, _, misread = _read(blocks)
    held = _occurrences(scanned, misread, False).join(misread.select("word").distinct(), "word", "left_semi").select("block_id", "field")
    of = lambda kind: reading.where(F.col("kind") == kind).select("block_id", "field")
    return (
        held.union(of("number")).select("block_id", "field", F.lit("misread").alias("noise"))
        .union(of("hyphen").select("block_id", "field", F.lit("hyphen").alias("noise")))
        .union(furniture.select("block_id", F.lit("text").alias("field"), F.col("kind").alias("noise")))
        .distinct()
    )


# -- repair ----------------------------------------------------------------------------------------------------------


def _reflow(lines: list[str]) -> str:
    """Lines of one paragraph on one line; blank lines, list items and lines after a sentence's end keep their break."""
    out: list[str] = []
    for line in (x.strip() for x in lines):
        if not line:
            if out and out[-1]:
                out.append("")
        elif out and out[-1] and not re.search(r"[.!?:。！？：]$", out[-1]) and not re.match(r"[-*•]\s|\d+[.)]\s", line):
            out[-1] += ("" if re.search(r"[㐀-鿿，、]$", out[-1]) else " ") + line
        else:
            out.append(line)
    return "\n".join(out).strip()


def corrected(text: str, fixes: dict[tuple[str, str, str], str]) -> str:
    """``text`` with misread numbers, and with the words of ``fixes`` (by themselves and their neighbours, or else by
    themselves alone), replaced where they stand; everything else stays as it is, whatever its script."""
    read, places = fold(text)
    tokens = list(_TOKEN.finditer(read))
    low = ["", *(m.group().lower() for m in tokens), ""]
    out, at = [], 0
    for i, m in enumerate(tokens, 1):
        new = number_misread(m.group())
        if new is None and fixes and is_suspect(m.group()):
            new = fixes.get((low[i], low[i - 1], low[i + 1])) or fixes.get((low[i], "", ""))
            new = new.capitalize() if new and m.group()[0].isupper() else new
        if new is not None:
            start, end = (m.start(), m.end()) if places is None else (places[m.start()], places[m.end()])
            out += [text[at:start], new]
            at = end
    return "".join(out) + text[at:]


def repaired_cell(cell: str, fixes: dict[tuple[str, str, str], str], compounds: Iterable[tuple[str, str]]) -> str:
    """A table cell with words broken at its line breaks made whole and misread words corrected; its tags and entities stay."""
    parts = _TAG.split(cell)  # text at even places, tags at odd ones
    for i in range(0, len(parts) - 2, 2):
        if _LINE_TAG.fullmatch(parts[i + 1]) and (m := _BROKEN.search(parts[i])) and m.group(1)[-1].islower() and (n := _GOES_ON.match(parts[i + 2])) and n.group(1)[0].islower():
            parts[i] = parts[i][: m.end(1)] + ("-" if (m.group(1), n.group(1)) in compounds else "") + n.group(1) + n.group(2)
            parts[i + 1], parts[i + 2] = "", parts[i + 2][n.end() :]
    plain = [html.unescape(x) for x in parts[::2]]
    for i, text in enumerate(plain):
        if "\n" in text:
            lines, broken = join_lines(text.split("\n"), None, False, compounds)
            text = "\n".join(lines) if broken else text
        new = corrected(text, fixes)
        if new != plain[i]:
            parts[2 * i] = html.escape(new, quote=False) if "&" in parts[2 * i] else new
    return "".join(parts)


def repaired_texts(blocks: DataFrame) -> DataFrame:
    """``(block_id, field, repaired)`` of every body text and table: no furniture, whole words, continuous paragraphs.

    A word broken over two blocks goes, with what is joined to it, to the first. A misread word becomes the candidate that
    follows its left and precedes its right neighbour most often, then the one misread at less cost, then the more frequent
    one. Sound words of any script keep their characters. In a table only misread words and numbers and broken words within
    a cell change, so a sound one comes out as it was. Null and empty texts have no row; repeated blocks have one.
    """
    _, scanned, reading, compounds, misread = _read(blocks)
    seen = cut(_occurrences(scanned, misread, True).join(misread.select("word").distinct(), "word", "left_semi"))
    options = seen.select("word", "left", "right").distinct().join(misread, "word")
    asked = options.select(F.col("left").alias("a"), F.col("candidate").alias("b")).union(options.select("candidate", "right")).where("a <> '' AND b <> ''").distinct()
    asked = cut(asked.withColumn("pair", F.concat_ws(" ", "a", "b")))
    wanted = word_filter(asked.select(F.col("pair").alias("word")))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for _, *block in _read_rows(batch):
                low = _TOKEN.findall(whole_text(*block)[0].lower())
                found.update(f"{a} {b}" for a, b in zip(low, low[1:]))
            rows = [(p, n) for p, n in found.items() if p in wanted]
            cols = list(zip(*rows)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], ["pair", "pair_n"])

    counted = scanned.mapInArrow(pairs, "pair string, pair_n long").groupBy("pair").agg(F.sum("pair_n").alias("pair_n"))
    known = cut(asked.join(counted, "pair").select("a", "b", "pair_n"))
    scored = (
        options.join(known.select(F.col("a").alias("left"), F.col("b").alias("candidate"), F.col("pair_n").alias("left_n")), ["left", "candidate"], "left")
        .join(known.select(F.col("a").alias("candidate"), F.col("b").alias("right"), F.col("pair_n").alias("right_n")), ["candidate", "right"], "left")
        .withColumn("context", F.log1p(F.coalesce("left_n", F.lit(0))) + F.log1p(F.coalesce("right_n", F.lit(0))))
    )
    best = scored.groupBy("word", "left", "right").agg(F.max_by("candidate", F.struct("context", -F.col("cost"), "candidate_n", "candidate")).alias("candidate"))
    fixes = seen.join(best, ["word", "left", "right"]).groupBy("block_id", "field").agg(F.collect_set(F.struct("word", "left", "right", "candidate")).alias("fixes"))
    hyphens = reading.where("kind = 'hyphen'").select("block_id", "field", F.col("word").alias("head"), "mark", "tail").join(compounds, ["head", "mark", "tail"], "left_semi")
    hyphens = hyphens.groupBy("block_id", "field").agg(F.collect_set(F.struct("head", "tail")).alias("compounds"))

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            done = []
            for field, text, furniture, after, before, fix, keep in zip(df.field, df.text, df.furniture, df.after, df.before, df.fixes, df.compounds):
                change = {(f["word"], f["left"], f["right"]): f["candidate"] for f in fix} if fix is not None else {}
                for word, candidate in sorted((w, c) for (w, _, _), c in change.items()):
                    change.setdefault((word, "", ""), candidate)
                held = _Compounds((f["head"], f["tail"]) for f in keep) if keep is not None else ()
                if field == "text":
                    lines = pieces(field, text, furniture if furniture is not None else ())[0]
                    done.append(corrected(_reflow(join_lines(lines, after, bool(before), held)[0]), change))
                else:
                    parts = re.split(f"({_CELL})", text)
                    parts[::2] = [repaired_cell(x, change, held) if x else x for x in parts[::2]]
                    done.append("".join(parts))
            yield pd.DataFrame({"block_id": df.block_id, "field": df.field, "repaired": done})

    rows = scanned.join(fixes, ["block_id", "field"], "left").join(hyphens, ["block_id", "field"], "left")
    return rows.mapInPandas(repair, "block_id long, field string, repaired string")


class _Compounds(frozenset):
    """Heads and tails of compounds, without letter case."""

    def __contains__(self, pair: object) -> bool:
        head, tail = pair  # type: ignore[misc]
        return super().__contains__((fold(head)[0].lower(), fold(tail)[0].lower()))
