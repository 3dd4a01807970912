"""One form for text that looks the same: transitive look-alike classes and greedy rewriting."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lookalike import FULL_WIDTH, HARD_SPACES, LETTERS, LIGATURES, ZERO_WIDTH

_MARK = re.compile(r"[^\W\d_][\u0300-\u036f]")
_WORD = re.compile(rf"[\w\u0300-\u036f{ZERO_WIDTH}{''.join(LIGATURES)}\uff3f]+")
_LATIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\uff21-\uff3a\uff41-\uff5a\ufb00-\ufb06]")
_ODD = "[^\\x00-\\x7F]"
#: Share of the count of its family that counts for a member.
FAMILY_SHARE = 0.1


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Code points of all words that hold a Latin letter, full-width and blank ones anywhere, and letters with a separate accent."""
    strings = [s for s in LIGATURES.values()]
    for batch in batches:
        found: Counter = Counter()
        plain = []
        for text in batch.column(0).to_pylist():
            if text is None:
                continue
            if text.isascii():
                plain.append(text)
                continue
            words = [w for w in _WORD.findall(text) if _LATIN.search(w)]
            plain.extend(words)
            plain.append("".join(ch for ch in text if ch in ZERO_WIDTH or ch in HARD_SPACES or ch in FULL_WIDTH or ch == " " or "\u0300" <= ch <= "\u036f"))
            found.update(_MARK.findall(text))
        whole = "\n".join(plain)
        for s in strings:
            found[s] += whole.count(s)
        points, counts = np.unique(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
        found.update({chr(p): int(n) for p, n in zip(points, counts)})
        yield pa.RecordBatch.from_pydict({"s": list(found), "n": list(found.values())}, pa.schema([("s", pa.string()), ("n", pa.int64())]))


def alike(s: str) -> str | None:
    """The usual string that ``s`` looks like, if ``s`` is a variant."""
    if len(s) == 1:
        if s in FULL_WIDTH or s in LETTERS or s in LIGATURES:
            return FULL_WIDTH.get(s) or LETTERS.get(s) or LIGATURES[s]
        return "" if s in ZERO_WIDTH or "\u0300" <= s <= "\u036f" else " " if s in HARD_SPACES else None
    if _MARK.fullmatch(s):
        base = LETTERS.get(s[0], FULL_WIDTH.get(s[0], s[0]))
        whole = unicodedata.normalize("NFC", base + s[1])
        return whole if len(whole) == 1 else None
    return None


def _family(s: str) -> str:
    """Usual characters, or the kind of variant."""
    if alike(s) is None:
        return "usual"
    return "wide" if s in FULL_WIDTH else "script" if s in LETTERS else "other"


def lookalike_classes(texts: DataFrame) -> dict[str, str]:
    """Representative of every observed string of a look-alike class, of those that aren't their own.

    ``texts`` has one string column. Strings are single code points, ligatures spelled out and letters with a separate
    accent; there are at most as many as Unicode has code points and accents, so their counts (and nothing else) come
    to the driver. Classes are the connected components of "looks like" under union-find, so Ａ, А and Α meet through
    A; the most frequent member in words with Latin letters represents its class, by code point where counts tie; to each
    count FAMILY_SHARE of its family's (usual, full-width, other script) is added, so a rare letter follows the others. The
    class of zero-width characters, and of accents that no letter before them takes up, is represented by the empty string.
    """
    counted = texts.mapInArrow(_count_strings, "s string, n long").groupBy("s").agg(F.sum("n").alias("n"))
    count = {r.s: r.n for r in counted.collect()}
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s in sorted(count):
        if (other := alike(s)) is not None:
            parent[find(s)] = find(other)
    classes: dict[str, list[str]] = {}
    for s in list(parent):
        classes.setdefault(find(s), []).append(s)
    families: Counter = Counter()
    for s, n in count.items():
        families[_family(s)] += n

    def weight(m: str) -> float:
        return count.get(m, 0) + FAMILY_SHARE * families[_family(m)]

    rewrite = {}
    for members in classes.values():
        best = "" if "" in members else min(members, key=lambda m: (-weight(m), len(m), m))
        rewrite |= {m: best for m in members if m != best and m != ""}
    return rewrite


def _automaton(rewrite: dict[str, str]):  # noqa: ANN202
    import ahocorasick

    trie = ahocorasick.Automaton()
    for variant, usual in rewrite.items():
        trie.add_word(variant, (len(variant), usual))
    trie.make_automaton()
    return trie


def _pass(text: str, trie) -> str:  # noqa: ANN001
    out, at = [], 0
    for end, (size, usual) in trie.iter_long(text):
        out += [text[at : end + 1 - size], usual]
        at = end + 1
    return "".join(out) + text[at:] if out else text


def rewriter(rewrite: dict[str, str]):  # noqa: ANN201
    """``str -> str`` that replaces leftmost-longest variants, again until nothing changes.

    Letters of other scripts, and marks on them, are replaced only in words that hold a Latin letter.
    """
    if not rewrite:
        return lambda text: text
    foreign = set(LETTERS)
    mixed = _automaton(rewrite)
    rest = {v: u for v, u in rewrite.items() if not (set(v) | set(u)) & foreign}
    other = _automaton(rest) if rest else None

    def once(text: str) -> str:
        if not any(ch in foreign for ch in text):
            return _pass(text, other) if other else text
        out, at = [], 0
        for m in _WORD.finditer(text):
            gap, word = text[at : m.start()], m.group()
            latin = _LATIN.search(word)
            out.append(_pass(gap, other) if other else gap)
            out.append(_pass(word, mixed) if latin else (_pass(word, other) if other else word))
            at = m.end()
        tail = text[at:]
        out.append(_pass(tail, other) if other else tail)
        return "".join(out)

    def whole(text: str) -> str:
        while (new := once(text)) != text:  # every change leaves fewer variants, or a shorter text
            text = new
        return text

    return whole


def canonical_column(text: Column, rewrite: dict[str, str]) -> Column:
    """``text`` in its one form; ASCII texts and nulls don't leave the JVM."""

    @F.pandas_udf(T.StringType())
    def fix(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        whole = rewriter(rewrite)
        for texts in it:
            yield texts.map(whole, na_action="ignore")

    return F.when(text.rlike(_ODD), fix(F.when(text.rlike(_ODD), text))).otherwise(text)


def canonical_texts(sources: dict[str, DataFrame]) -> DataFrame:
    """``(src, row_key, text, canonical)`` for each of ``sources``, which have ``row_key, text``.

    All sources share one set of classes. Null text stays null, empty text empty; repeated rows count once; an empty
    table gives an empty result. Words wholly in another script, Chinese punctuation, signs and precomposed letters
    keep their form.
    """
    rows = None
    for src, df in sources.items():
        part = df.select(F.lit(src).alias("src"), F.col("row_key").cast("long").alias("row_key"), "text")
        rows = part if rows is None else rows.unionByName(part)
    rewrite = lookalike_classes(rows.where(F.col("text").isNotNull()).select("text"))
    return rows.withColumn("canonical", canonical_column(F.col("text"), rewrite))


def unusual_rows(sources: dict[str, DataFrame]) -> DataFrame:
    """``(src, row_key)`` of rows whose text isn't in its one form."""
    rows = canonical_texts(sources)
    return rows.where(F.col("text").rlike(_ODD)).where(~F.col("canonical").eqNullSafe(F.col("text"))).select("src", "row_key").distinct()
