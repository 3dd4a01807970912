"""Candidates for misread words: Levenshtein automata intersected with vocabulary tries, spread over Spark by word segments."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, parallelism

# What a letter, or two, is taken for by its shape.
MISREADINGS = [
    ("e", "c"), ("a", "o"), ("t", "f"), ("i", "j"), ("l", "1"), ("l", "i"), ("i", "l"), ("i", "1"), ("o", "0"), ("d", "cl"), ("d", "ci"), ("d", "c1"),
    ("s", "5"), ("n", "u"), ("u", "n"), ("u", "ii"), ("n", "ii"), ("m", "rn"), ("w", "vv"), ("g", "q"), ("g", "9"), ("h", "b"), ("b", "6"), ("b", "h"), ("ri", "n"), ("rn", "m"),
    ("cl", "d"), ("vv", "w"), ("z", "2"), ("c", "e"), ("o", "a"), ("f", "t"), ("j", "i"), ("q", "g"), ("h", "li"), ("li", "h"), ("ti", "n"), ("in", "m"), ("m", "in"), ("nn", "m"), ("y", "v"),
    ("ä", "a"), ("ö", "o"), ("ü", "u"), ("ü", "ii"), ("ß", "b"), ("0", "o"), ("1", "l"), ("5", "s"),
]
# End of fixed values.

#: Cost of a shape misreading, of one taken for a second shape in turn, and of any other substitution inside a word.
SHAPE, CHAIN, OTHER = 1, 2, 3
#: Times that a word must be as frequent as what it is misread as, by the cost of the misreading.
RATIO = {1: 50.0, 2: 150.0, 3: 3000.0}
_TRUE_HEX = re.compile(r"0[xX][0-9A-Fa-f]+")


def distance_allowed(length: int) -> int:
    """Levenshtein distance within which candidates of a token of this length are sought; one letter read as two takes 2."""
    return 1 if length <= 2 else 2 if length <= 4 else 3 if length <= 8 else 4


def cost_allowed(length: int) -> int:
    return 1 if length <= 4 else 2 if length <= 7 else 3


def _shapes() -> dict[str, dict[str, int]]:
    """By what was printed: what it is read as, with its cost."""
    single: dict[str, set[str]] = {}
    table: dict[str, dict[str, int]] = {}
    for true, seen in MISREADINGS:
        table.setdefault(true, {})[seen] = SHAPE
        if len(true) == len(seen) == 1:
            single.setdefault(true, set()).add(seen)
    for true, seen in MISREADINGS:
        for i, ch in enumerate(seen):
            for other in single.get(ch, ()):
                if (twice := seen[:i] + other + seen[i + 1 :]) != true:
                    table[true].setdefault(twice, CHAIN)
    return table


_READ_AS = _shapes()


def shape_cost(true: str, seen: str, most: int) -> int | None:
    """Least cost, up to ``most``, at which ``true`` is read as ``seen``: shape misreadings, and one other substitution that is
    neither at the word's start nor its end; None where there is none."""
    best: dict[tuple[int, int, bool], int] = {}
    todo = [(0, 0, 0, False)]
    found = None
    while todo:
        i, j, cost, other = todo.pop()
        if cost > most or best.get((i, j, other), most + 1) <= cost or abs((len(true) - i) - (len(seen) - j)) > most - cost:
            continue
        best[i, j, other] = cost
        if i == len(true) and j == len(seen):
            found, most = cost, cost - 1
            continue
        if i < len(true) and j < len(seen):
            if true[i] == seen[j]:
                todo.append((i + 1, j + 1, cost, other))
            elif not other and 0 < i < len(true) - 1:
                todo.append((i + 1, j + 1, cost + OTHER, True))
        for size in (1, 2):
            for read, price in _READ_AS.get(true[i : i + size], {}).items() if i + size <= len(true) else ():
                if seen.startswith(read, j):
                    todo.append((i + size, j + len(read), cost + price, other))
    return found


class Levenshtein:
    """Automaton that accepts all strings within ``most`` edits of ``token``; its states are built when first met."""

    def __init__(self, token: str, most: int) -> None:
        self.token, self.most, self.letters = token, most, set(token)
        self.start = tuple(min(i, most + 1) for i in range(len(token) + 1))
        self.moves: dict[tuple[tuple[int, ...], str], tuple[int, ...] | None] = {}

    def step(self, state: tuple[int, ...], letter: str) -> tuple[int, ...] | None:
        key = (state, letter if letter in self.letters else "")
        if key in self.moves:
            return self.moves[key]
        row = [state[0] + 1]
        for i, own in enumerate(self.token):
            row.append(min(state[i] + (own != letter), row[i] + 1, state[i + 1] + 1))
        new = tuple(min(x, self.most + 1) for x in row)
        self.moves[key] = out = new if min(new) <= self.most else None
        return out

    def distance(self, state: tuple[int, ...]) -> int:
        return state[-1]


class Trie:
    """Vocabulary words by their letters."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, n: int) -> None:
        node = self.root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = (word, n)

    def near(self, automaton: Levenshtein) -> Iterator[tuple[str, int, int]]:
        """``(word, n, distance)`` of every word that ``automaton`` accepts: both are walked together."""
        todo = [(self.root, automaton.start)]
        while todo:
            node, state = todo.pop()
            for ch, nxt in node.items():
                if ch == "":
                    if (d := automaton.distance(state)) <= automaton.most:
                        yield (*nxt, d)
                elif (new := automaton.step(state, ch)) is not None:
                    todo.append((nxt, new))


def _parts(length: int, most: int) -> list[tuple[int, int]]:
    """``(start, size)`` of most + 1 segments of a word of ``length``, as even as can be."""
    size, longer = divmod(length, most + 1)
    sizes = [size + (i >= most + 1 - longer) for i in range(most + 1)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(most + 1)]


def vocabulary_keys(word: str) -> set[str]:
    """Keys under which ``word`` stands in the vocabulary: its segments for each distance it may be sought with."""
    n = len(word)
    classes = {distance_allowed(k) for k in range(max(1, n - 4), n + 5) if abs(k - n) <= distance_allowed(k)}
    return {f"{d}.{n}.{i}.{word[at : at + size]}" for d in classes for i, (at, size) in enumerate(_parts(n, d))}


def query_keys(token: str) -> set[str]:
    """Keys of all words within reach of ``token``: of the most + 1 segments of such a word one stands in ``token`` unchanged,
    moved by no more than the edits to its left, nor than those to its right."""
    n = len(token)
    most = distance_allowed(n)
    keys = set()
    for length in range(max(1, n - most), n + most + 1):
        gap = n - length
        for i, (at, size) in enumerate(_parts(length, most)):
            low, high = max(at - i, at + gap - (most - i), 0), min(at + i, at + gap + (most - i), n - size)
            keys.update(f"{most}.{length}.{i}.{token[s : s + size]}" for s in range(low, high + 1))
    return keys


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row ``(word, n, known, asks)`` under all its keys: as a word of the vocabulary if ``known``, as a token if it ``asks``."""
    for batch in batches:
        rows = []
        for word, n, known, asks in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "known", "asks"))):
            rows += [(k, False, word, n) for k in vocabulary_keys(word)] if known else []
            rows += [(k, True, word, n) for k in query_keys(word)] if asks else []
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.string(), pa.int64()))], ["key", "asks", "word", "n"])


def any_candidate(word: str, n: int, candidate: str, candidate_n: int) -> int | None:
    return 0


def misread_cost(word: str, n: int, candidate: str, candidate_n: int) -> int | None:
    """At what cost ``word`` is a misreading of ``candidate``; None where it is none, by shape or by the ratio of their counts."""
    most = max((c for c in RATIO if candidate_n >= RATIO[c] * n), default=0)
    return shape_cost(candidate, word, min(most, cost_allowed(len(word)))) if most and may_be_misread(word) else None


def _searcher(judge):  # noqa: ANN001, ANN202
    """Rows sorted by key, vocabulary before tokens: a trie per key, met by the automaton of each of its tokens."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, trie = None, None
        machines: dict[str, Levenshtein] = {}
        judged: dict[tuple[str, str], int | None] = {}
        for batch in batches:
            out = set()
            for k, asks, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "asks", "word", "n"))):
                if k != key:
                    key, trie = k, None
                if not asks:
                    trie = trie or Trie()
                    trie.add(word, n)
                elif trie:
                    if word not in machines:
                        if len(machines) >= 4096:
                            machines.clear()
                        machines[word] = Levenshtein(word, distance_allowed(len(word)))
                    for v, m, d in trie.near(machines[word]):
                        if d and (word, v) not in judged:
                            if len(judged) >= 500_000:
                                judged.clear()
                            judged[word, v] = judge(word, n, v, m)
                        if d and (cost := judged[word, v]) is not None:
                            out.add((word, v, d, cost, m))
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["word", "candidate", "distance", "cost", "candidate_n"])

    return search


def candidates(words: DataFrame, judge=any_candidate) -> DataFrame:  # noqa: ANN001
    """``(word, candidate, distance, cost, candidate_n)``: every ``known`` word of ``words(word, n, known, asks)``, other than the
    token itself, within distance_allowed of each one that ``asks``, and to which ``judge`` gives a cost.

    Rows are shuffled by the segments that tokens and words share, so no task holds more of the vocabulary than the words of
    one segment, and the tokens of a segment pass by it one at a time.
    """
    rows = words.select("word", "n", "known", "asks").mapInArrow(_spread, "key string, asks boolean, word string, n long")
    rows = rows.repartition(parallelism(words.sparkSession), "key").sortWithinPartitions("key", "asks")
    return rows.mapInArrow(_searcher(judge), "word string, candidate string, distance int, cost int, candidate_n long").distinct()


def may_be_misread(word: str) -> bool:
    """At least two letters, and more of them than digits; no hexadecimal number."""
    letters = sum(map(str.isalpha, word))
    return letters >= 2 and letters > len(word) - letters and not _TRUE_HEX.fullmatch(word)


def misread_words(counts: DataFrame, extra: DataFrame) -> DataFrame:
    """``(word, candidate, cost, candidate_n)``: the words that are misreadings, with the words that each may stand for.

    ``counts(word, n)`` are the words of the corpus, ``extra(word)`` others to judge, seen once. A word is a misreading when
    it is read from another by shape (shape_cost) and that other is RATIO times as frequent; so every judgement rests on the
    ratio of two counts and is the same at every size of the corpus. Misreadings are nobody's candidates.
    """
    judged = counts.select("word", "n").unionByName(extra.select("word", F.lit(1).cast("long").alias("n"))).groupBy("word").agg(F.max("n").alias("n"))
    top = counts.agg(F.max("n")).first()[0] or 0
    least = min(RATIO.values())
    letters = F.col("word").rlike(r"^\p{L}+$")
    two_letters = F.col("word").rlike(r"\p{L}[^\p{L}]*\p{L}") & ~F.col("word").rlike(r"^0[xX][0-9A-Fa-f]+$")
    words = judged.select("word", "n", (letters & (F.col("n") >= least)).alias("known"), (two_letters & (F.col("n") * least <= top)).alias("asks")).where("known OR asks")
    found = cut(candidates(words, misread_cost).select("word", "candidate", "cost", "candidate_n"))
    wrong = found.select(F.col("word").alias("candidate")).distinct()
    return found.join(wrong, "candidate", "left_anti").unionByName(
        # a misreading all of whose candidates are misreadings stays one
        found.join(found.join(wrong, "candidate", "left_anti").select("word").distinct(), "word", "left_anti")
    )


# -- finding the words in the texts again ------------------------------------------------------------------------------

#: Bits of the filter of misread words: 16 for each of them, within these bounds, so that it never takes more than 16 MB.
LEAST_BITS, MOST_BITS, BITMAP = 1 << 20, 1 << 27, 32768


class WordFilter:
    """One-hash Bloom filter: true for every word that is in, and for some others; the exact join comes after."""

    def __init__(self, bits: int, maps: dict[int, bytes]) -> None:
        self.bits, self.maps, self.known = bits, maps, {}

    def __contains__(self, word: str) -> bool:
        if (hit := self.known.get(word)) is None:
            import xxhash

            at = xxhash.xxh64_intdigest(word.encode(), seed=42) & (self.bits - 1)  # Spark's xxhash64 of a string
            part = self.maps.get(at // BITMAP)
            hit = part is not None and bool(part[at % BITMAP // 8] >> (at % 8) & 1)
            if len(self.known) >= 500_000:
                self.known.clear()
            self.known[word] = hit
        return hit


def word_filter(words: DataFrame) -> WordFilter:
    """Filter of ``words.word``, built by Spark's bitmap aggregates; at most MOST_BITS come to the driver."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(LEAST_BITS.bit_length() - 1, math.ceil(math.log2(16 * max(1, words.count())))))
    at = words.select(F.pmod(F.xxhash64("word"), F.lit(bits)).alias("at")).select(F.floor(F.col("at") / BITMAP).alias("part"), F.pmod("at", F.lit(BITMAP)).alias("bit"))
    maps = {r.part: bytes(r.bits) for r in at.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()}
    return WordFilter(bits, maps)
