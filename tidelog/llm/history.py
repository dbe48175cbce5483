"""New batches against all history: exact repeats, and records that say the same in slightly altered form.

Records that could repeat each other share a key and a time, by which everything is laid out. A batch becomes an immutable segment on
disk: blocks of records of one slot of time, each with the sorted identifiers of its rows and a suffix array over the concatenated texts,
its suffixes ordered by key and words. A new batch is looked up in the blocks of history that share a slot with it, and in no others. A
record is looked up in a suffix array by binary search: from its first word on the longest stretch that stands there, then on behind
it; whoever stands in the narrowest ranges found is met and compared exactly. A lookup goes both ways, for the one that ended early may
be the older one. Another record may hide a partner by sharing a longer stretch, so a record that has not met an earlier one like it is
then looked up from its beginning (:class:`Lines`, :class:`Rows`), where every record that could be its partner is met.

Segments follow the logarithmic method: as soon as there are enough of a level they are merged into one of the next. A slot with more
records than a block holds has several blocks, in tasks of their own, so no key is ever gathered in one place.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.delivered import Runs, identity
from tidelog.runtime import settled, shared_dir
from tidelog.sources.runs import WAITING, RunList, waiting, within

#: Ranges wider than this are left to the lookup from the beginning.
WIDE = 64
#: Records, and characters of their texts, of a block at most; a longer text has a block of its own.
BLOCK, BLOCK_CHARS = 20_000, 8_000_000
#: Nanoseconds of a slot of time, at least and at most; the first batch's rows a minute decide, so that a slot fills half a block.
SLOT = 1_000_000, 86_400_000_000_000
MINUTE = 60_000_000_000
#: Words whose numbers a task remembers before it begins anew.
REMEMBERED = 200_000

_WORDS = re.compile(r"\w+|[^\w\s]")


class Texts:
    """Records as runs of word numbers: ``key`` (a number), ``start`` and ``length`` of each. A word's number is a hash; words that share one
    only add to those that are met."""

    def __init__(self, keys: np.ndarray, texts: list[str], words: dict[str, int]):
        """``words`` remembers numbers."""
        flat: list[int] = []
        length = np.zeros(len(texts), np.int64)
        get, number = words.get, xxhash.xxh32_intdigest
        for i, t in enumerate(texts):
            found = _WORDS.findall(t)
            here = [get(w) for w in found]
            if None in here:
                here = [n if n is not None else words.setdefault(w, number(w) >> 1) for n, w in zip(here, found)]
            flat += here
            length[i] = len(here)
        self._set(keys.astype(np.int64), np.array(flat, np.int32), length)

    def _set(self, key: np.ndarray, words: np.ndarray, length: np.ndarray) -> None:
        self.key, self.words, self.length, self.start = key, words, length, np.cumsum(length) - length

    @classmethod
    def of(cls, key: np.ndarray, words: np.ndarray, length: np.ndarray) -> "Texts":
        out = object.__new__(cls)
        out._set(key, words, length)
        return out

    def subset(self, rows: np.ndarray, key: np.ndarray) -> "Texts":
        """Some of the records under other keys; the words are shared."""
        out = object.__new__(Texts)
        out.words, out.key, out.length, out.start = self.words, key, self.length[rows], self.start[rows]
        return out


def _alike(x: np.ndarray, at_x: np.ndarray, rest_x: np.ndarray, y: np.ndarray, at_y: np.ndarray, rest_y: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """How many words stretches of ``x`` and ``y`` have in common, of which ``depth`` are known to be."""
    most, out, step = np.minimum(rest_x, rest_y), depth.copy(), np.arange(16)
    live = np.flatnonzero(out < most)
    while len(live):
        ahead = out[live, None] + step
        inside = ahead < most[live, None]
        same = inside & (x[np.where(inside, at_x[live, None] + ahead, 0)] == y[np.where(inside, at_y[live, None] + ahead, 0)])
        n = np.where(same.all(1), len(step), same.argmin(1))
        out[live] += n
        live = live[(n == len(step)) & (out[live] < most[live])]
    return out


class Segment:
    """A suffix array over some records; ``suffixes`` if it is known already."""

    def __init__(self, texts: Texts, suffixes: np.ndarray | None = None):
        self.texts = texts
        n = int(texts.length.sum())
        self.record = np.repeat(np.arange(len(texts.key)), texts.length)
        offset = np.arange(n) - np.repeat(np.cumsum(texts.length) - texts.length, texts.length)
        self.at = np.repeat(texts.start, texts.length) + offset  # in the shared words
        self.rest = np.repeat(texts.length, texts.length) - offset  # words to the end of the record
        self.key = texts.key[self.record]
        if suffixes is not None:
            self.suffixes = suffixes
            return
        word = texts.words[self.at]
        # prefix doubling: ranks by the first 1, 2, 4 ... words, the key before all
        order = np.lexsort((word, self.key))
        rank = self._ranks(order, self.key, word)
        step, longest = 1, int(texts.length.max()) if len(texts.length) else 0
        while step < longest and n and rank.max() < n - 1:
            nxt = np.full(n, -1)
            ok = self.rest > step
            nxt[ok] = rank[np.flatnonzero(ok) + step]
            order = np.lexsort((nxt, rank))
            rank = self._ranks(order, rank, nxt)
            step *= 2
        self.suffixes = order

    @staticmethod
    def _ranks(order: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        if len(order):
            a, b = first[order], second[order]
            rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        return rank

    def _word(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The word ``depth`` words into the suffixes at ``place`` of the array; -1 past their ends."""
        s = self.suffixes[place]
        inside = self.rest[s] > depth
        return np.where(inside, self.texts.words[np.where(inside, self.at[s] + depth, 0)], -1) if len(self.texts.words) else np.full(len(place), -1)

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray, word: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            w = self._word(mid, depth[open_])
            up = w <= word[open_] if right else w < word[open_]
            lo[open_[up]] = mid[up] + 1
            hi[open_[~up]] = mid[~up]

    def longest(self, key: np.ndarray, at: np.ndarray, rest: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For stretches of ``words`` beginning ``at`` with ``rest`` words to go: how many of these stand in the segment, and the range of suffixes
        that begin so. What a whole range has in common is what its ends have; only where it branches is searched."""
        keys = self.key[self.suffixes]
        lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        length = np.zeros(len(key), np.int64)
        live = np.flatnonzero((lo < hi) & (rest > 0))
        while len(live):
            first, last, depth = self.suffixes[lo[live]], self.suffixes[hi[live] - 1], length[live]
            ours = _alike(words, at[live], rest[live], self.texts.words, self.at[first], self.rest[first], depth)
            whole = _alike(self.texts.words, self.at[first], self.rest[first], self.texts.words, self.at[last], self.rest[last], depth)
            length[live] = np.minimum(ours, whole)
            branch = (ours >= whole) & (whole < rest[live])
            live, depth = live[branch], whole[branch]
            w = words[at[live] + depth]
            a = self._bound(lo[live], hi[live], depth, w, False)
            b = self._bound(a, hi[live], depth, w, True)
            found = a < b
            live = live[found]
            lo[live], hi[live] = a[found], b[found]
            length[live] += 1
            live = live[length[live] < rest[live]]
        return length, lo, hi

    def candidates(self, query: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (record of ``query``, record of the segment) that meet in one of the three narrowest ranges of the former."""
        n = len(query.key)
        pos, single = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rows, lows, highs = [], [], []
        live = np.flatnonzero(np.isin(query.key, np.unique(self.texts.key)) & (query.length > 0))
        while len(live):
            length, lo, hi = self.longest(query.key[live], query.start[live] + pos[live], query.length[live] - pos[live], query.words)
            good = (length > 0) & (hi - lo <= WIDE)
            rows.append(live[good]), lows.append(lo[good]), highs.append(hi[good])
            pos[live] += np.maximum(length, 1)
            single[live] += (length > 0) & (hi - lo == 1)
            live = live[(pos[live] < query.length[live]) & (single[live] < 3)]  # three ranges of one suffix: none is narrower
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, lo, hi = (np.concatenate(x) for x in (rows, lows, highs))
        order = np.lexsort((hi - lo, row))
        row, lo, hi = row[order], lo[order], hi[order]
        met = np.arange(len(row)) - np.searchsorted(row, row, "left") < 3
        n_hit = (hi - lo)[met]
        ours = np.repeat(row[met], n_hit)
        place = np.repeat(lo[met] - np.cumsum(n_hit) + n_hit, n_hit) + np.arange(n_hit.sum())
        pair = np.unique(np.stack([ours, self.record[self.suffixes[place]]], 1), axis=0)
        return pair[:, 0], pair[:, 1]


def _both_ways(a: Texts, b: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (record of ``a``, record of ``b``), each looked up in the other's segment."""
    j, i = Segment(a).candidates(b)
    i2, j2 = Segment(b).candidates(a)
    pairs = np.unique(np.stack([np.concatenate([i, i2]), np.concatenate([j, j2])], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def pairs_within(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (earlier, later) among records of a key in their order: at level k blocks of 2^k records are looked up in
    the block before them, so that each pair meets once."""
    n = len(texts.key)
    order = np.argsort(texts.key, kind="stable")
    key = texts.key[order]
    nth = np.empty(n, np.int64)
    nth[order] = np.arange(n) - np.searchsorted(key, key, "left")
    out_a, out_b = [], []
    level = 0
    while n and (nth.max() >> level) > 0:
        block = nth >> level
        # odd blocks and the even ones before them, as keys of their own
        _, pair_key = np.unique(np.stack([texts.key, block >> 1], 1), axis=0, return_inverse=True)
        pair_key = pair_key.ravel()
        odd = (block & 1) == 1
        later = np.flatnonzero(odd)
        earlier = np.flatnonzero(~odd & np.isin(pair_key, pair_key[later]))
        i, j = _both_ways(texts.subset(earlier, pair_key[earlier]), texts.subset(later, pair_key[later]))
        out_a.append(earlier[i]), out_b.append(later[j])
        level += 1
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *out_a]), np.concatenate([nothing, *out_b])


def _lost(a: str, b: str) -> int:
    """How many characters of two texts of a length are illegible in one of them; -1 if they differ otherwise."""
    if a == b:
        return 0
    lost = 0
    for x, y in zip(a, b):
        if x != y:
            if x != "�" and y != "�":
                return -1
            lost += 1
    return lost


class Lines:
    """The lines of a key as a tree over their sorted array: a node is the range of lines that begin alike, made when it is first visited."""

    def __init__(self, lines: list[str], numbers: list[int]):
        first: dict[str, int] = {}
        for i, line in sorted(zip(numbers, lines)):
            first.setdefault(line, i)
        self.lines = sorted(first)
        self.numbers = np.array([first[x] for x in self.lines], np.int64)
        self.nodes: dict[tuple[int, int], tuple[int, int, dict[str, tuple[int, int]]]] = {}

    def _node(self, lo: int, hi: int) -> tuple[int, int, dict[str, tuple[int, int]]]:
        """How long all of the range are alike, its least number, and the ranges by the next character."""
        if (node := self.nodes.get((lo, hi))) is None:
            a, b = self.lines[lo], self.lines[hi - 1]
            m, over = 0, min(len(a), len(b)) + 1
            while over - m > 1:
                mid = (m + over) // 2
                m, over = (mid, over) if a[m:mid] == b[m:mid] else (m, mid)
            below, i = {}, lo + (len(a) == m)
            while i < hi:
                c = self.lines[i][m]
                j = bisect_left(self.lines, a[:m] + chr(ord(c) + 1), i, hi) if ord(c) < 0x10FFFF else hi
                below[c] = (i, j)
                i = j
            node = self.nodes[lo, hi] = (m, int(self.numbers[lo:hi].min()), below)
        return node

    def like(self, line: str, before: int) -> Iterator[int]:
        """All numbers less than ``before`` whose lines say the same as ``line`` as far as both go, an illegible character being like any."""
        most = max(3, len(line) // 10)
        todo = [(0, len(self.lines), 0, 0)] if self.lines else []
        while todo:
            lo, hi, depth, lost = todo.pop()
            m, least, below = self._node(lo, hi)
            if least >= before:
                continue
            end = min(m, len(line))
            more = _lost(self.lines[lo][depth:end], line[depth:end])
            if more < 0 or lost + more > most:
                continue
            if m >= len(line):
                here = self.numbers[lo:hi]
                yield from here[here < before].tolist()
                continue
            if len(self.lines[lo]) == m and self.numbers[lo] < before:
                yield int(self.numbers[lo])
            c = line[m]
            todo += [(*below[k], m, lost + more) for k in (below if c == "�" else (c, "�")) if k in below]


class Rows:
    """The row forms of a key by their strings, and by the double that varies most among rows of these."""

    def __init__(self, forms: list[str], numbers: list[int]):
        groups: dict[tuple, list[tuple[list[float], int]]] = {}
        for f, i in zip(forms, numbers):
            kind, doubles = self._cut(f)
            groups.setdefault(kind, []).append((doubles, i))
        self.groups = {}
        for kind, rows in groups.items():
            varied = [len(set(v)) for v in zip(*(d for d, _ in rows))]
            by = varied.index(max(varied)) if varied else -1
            rows = sorted((d[by] if varied else 0.0, i) for d, i in rows)
            self.groups[kind] = by, [v for v, _ in rows], [i for _, i in rows]

    @staticmethod
    def _cut(form: str) -> tuple[tuple, list[float]]:
        """What has to be equal, and the finite doubles."""
        strings, _, doubles = form.partition("\x1f")
        printed = doubles.split(" ")
        finite = [d not in ("", "~") and abs(float(d)) < float("inf") for d in printed]
        return (strings, *("" if ok else d for d, ok in zip(printed, finite))), [float(d) for d, ok in zip(printed, finite) if ok]

    def like(self, form: str, before: int) -> Iterator[int]:
        kind, doubles = self._cut(form)
        if kind in self.groups:
            by, values, numbers = self.groups[kind]
            v = doubles[by] if doubles else 0.0
            off = 2e-6 * abs(v)
            yield from (i for i in numbers[bisect_left(values, v - off) : bisect_right(values, v + off)] if i < before)


# What makes two records one


def line_form(message: Column) -> Column:
    """A message without differences of presentation: case, blanks, and the separators of the wire."""
    flat = F.regexp_replace(F.lower(message), r"\^a|[\x00-\x20\x7f |;]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(flat, r" +", " "), r" #", "#"))


#: An identifier or number that is legible and goes on no further.
_NAMED = re.compile(r"(?<![\w.:/#\-�])[\w.:/#\-]*\d[\w.:/#\-]*(?=[^\w.:/#\-�])")


def same_line(a: str, b: str) -> bool:
    """Two line forms are one line: equal as far as both go, but for illegible characters; the shorter has a whole identifier or number, or
    at least half of the longer."""
    if len(a) > len(b):
        a, b = b, a
    if 2 * len(a) < len(b) and not _NAMED.search(a + b[len(a)]):
        return False
    if b.startswith(a):
        return True
    if "�" not in a and "�" not in b:
        return False
    lost = 0
    for x, y in zip(a, b):
        if x != y:
            if x != "�" and y != "�":
                return False
            lost += 1
    return lost <= max(3, len(a) // 10)


def _same_row(a: str, b: str) -> bool:
    """Two row forms (strings, then doubles behind the last unit separator) agree: strings equal, doubles within a millionth."""
    x, p = a.split("\x1f")
    y, q = b.split("\x1f")
    if x != y:
        return False
    p, q = p.split(" "), q.split(" ")
    return len(p) == len(q) and all(u == v or (u != "~" != v and abs(float(u) - float(v)) <= 1e-6 * max(abs(float(u)), abs(float(v)))) for u, v in zip(p, q))


def _is_double(kind) -> bool:
    return kind.typeName() in ("double", "float")


def _split(c: Column, kind) -> tuple[list[Column], list[Column]]:
    """The doubles in a column, as arrays of text, and the rest of it as text."""
    name = kind.typeName()
    number = lambda x: F.coalesce(x.cast("string"), F.lit("~"))
    if _is_double(kind):
        return [F.array(number(c))], []
    if name == "struct":
        doubles, rest = [], [F.when(c.isNull(), "~").otherwise("{")]
        for f in kind.fields:
            d, r = _split(c.getField(f.name), f.dataType)
            doubles += d
            rest += r
        return doubles, rest
    if name == "array" and kind.elementType.typeName() in ("struct", "double", "float"):
        inner = lambda part: F.transform(c, lambda x: part(x))
        d = F.flatten(inner(lambda x: F.concat(*(_split(x, kind.elementType)[0] or [F.array().cast("array<string>")]))))
        r = F.array_join(inner(lambda x: F.concat_ws("\x1d", *(_split(x, kind.elementType)[1] or [F.lit("")]))), "\x1e")
        return [F.coalesce(d, F.array().cast("array<string>"))], [F.coalesce(r, F.lit("~"))]
    if name == "map":
        return [], [F.coalesce(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c)))), F.lit("~"))]
    if name == "array":
        return [], [F.coalesce(F.array_join(c.cast("array<string>"), ",", "~"), F.lit("~"))]
    return [], [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))]


def row_form(df: DataFrame, leave: tuple[str, ...]) -> tuple[Column, Column]:
    """All content of a row but the columns in ``leave``: its strings without case and blanks, and its doubles."""
    doubles, rest = [], []
    for f in df.schema.fields:
        if f.name not in leave:
            d, r = _split(F.col(f"`{f.name}`"), f.dataType)
            doubles += d
            rest += r
    flat = F.regexp_replace(F.lower(F.concat_ws("\x1c", *rest)), r"(?U)[\s\x00]+", "")
    return F.regexp_replace(flat, "\x1f", ""), F.array_join(F.flatten(F.array(*doubles)) if doubles else F.array(), " ")


_SAME = {"line": (same_line, Lines), "row": (_same_row, Rows)}


def _searched(form: str) -> str:
    """A form as it is searched for: doubles to four digits."""
    strings, sep, doubles = form.partition("\x1f")
    if not sep:
        return form
    return strings.replace("\x1c", " ") + " " + " ".join("~" if d == "~" else f"{float(d):.4g}" for d in doubles.split(" ") if d)


def _again(key: np.ndarray) -> np.ndarray:
    """Which of sorted keys come more than once."""
    same = key[1:] == key[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(key) else np.zeros(0, bool)


class Block:
    """Some records of a slot, in the order of their keys: the sorted identifiers of rows (``exact``); of each text its key, the first row that
    has it, its identifier, and its place in the suffix array. A text that is alone under its key is nobody's partner here: its own suffix
    array is made when another block brings the key."""

    def __init__(self, exact: np.ndarray, key: np.ndarray, first: np.ndarray, ids: np.ndarray, forms: list[str], texts: Texts, suffixes: np.ndarray):
        self.exact, self.key, self.first, self.ids, self.forms, self.texts, self.suffixes = exact, key, first, ids, forms, texts, suffixes

    @classmethod
    def made(cls, exact: np.ndarray, key: np.ndarray, first: np.ndarray, ids: np.ndarray, forms: list[str], words: dict[str, int]) -> "Block":
        """Sorted, each identifier once."""
        order = np.lexsort((first, ids["lo"], ids["hi"], key))
        key, first, ids = key[order], first[order], ids[order]
        once = np.ones(len(order), bool)
        once[1:] = (ids[1:] != ids[:-1]) | (key[1:] != key[:-1])
        forms, key = [forms[i] for i in order[once].tolist()], key[once]
        again = np.flatnonzero(_again(key))
        some = Texts(key[again], [_searched(forms[i]) for i in again.tolist()], words)
        length = np.zeros(len(key), np.int64)
        length[again] = some.length
        texts = Texts.of(key, some.words, length)
        if len(words) > REMEMBERED:
            words.clear()
        return cls(Runs.run(exact["hi"], exact["lo"], exact["row"]), key, first[once], ids[once], forms, texts, Segment(texts).suffixes)

    def row(self, slot: int, number: int) -> dict:
        return {
            "slot": slot, "block": number, "exact": self.exact.tobytes(), "keys": self.key.tobytes(), "firsts": self.first.tobytes(), "ids": self.ids.tobytes(), "forms": self.forms,
            "words": self.texts.words.tobytes(), "lengths": self.texts.length.astype(np.int32).tobytes(), "suffixes": self.suffixes.astype(np.int32).tobytes(),
        }

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int, prefix: str = "") -> "Block":
        raw = lambda name, kind: np.frombuffer(batch.column(prefix + name)[i].as_buffer(), kind)
        key = raw("keys", np.int64)
        out = object.__new__(cls)
        out.exact, out.key, out.first, out.ids, out.suffixes = raw("exact", Runs.KIND), key, raw("firsts", np.int64), raw("ids", _ID), raw("suffixes", np.int32)
        out.forms = batch.column(prefix + "forms")[i].values  # taken out one by one
        out.texts = Texts.of(key, raw("words", np.int32), raw("lengths", np.int32).astype(np.int64))
        return out

    def form(self, i: int) -> str:
        f = self.forms[i]
        return f if isinstance(f, str) else f.as_py()

    @cached_property
    def segment(self) -> Segment:
        return Segment(self.texts, self.suffixes)

    def texts_of(self, at: np.ndarray, words: dict[str, int]) -> Texts:
        return Texts(self.key[at], [_searched(self.form(i)) for i in at.tolist()], words)

    def candidates(self, query: Texts, at: np.ndarray, words: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (record of ``query``, position here); ``at`` are the positions of the keys of ``query``."""
        i, j = self.segment.candidates(query)
        alone = at[self.texts.length[at] == 0]
        i2, j2 = Segment(self.texts_of(alone, words)).candidates(query)
        return np.concatenate([i, i2]), np.concatenate([j, alone[j2]])

    def members(self, key: int) -> range:
        return range(int(np.searchsorted(self.key, key, "left")), int(np.searchsorted(self.key, key, "right")))


_ID = np.dtype([("hi", "<i8"), ("lo", "<i8")])
_SEGMENT = "slot long, block long, exact binary, keys binary, firsts binary, ids binary, forms array<string>, words binary, lengths binary, suffixes binary, hi long, lo long, after long"
_BLOCK_COLUMNS = ("block", "exact", "keys", "firsts", "ids", "forms", "words", "lengths", "suffixes")
_B = pa.binary()
_SEGMENT_ARROW = pa.schema(
    [("slot", pa.int64()), ("block", pa.int64()), ("exact", _B), ("keys", _B), ("firsts", _B), ("ids", _B), ("forms", pa.list_(pa.string())), ("words", _B), ("lengths", _B), ("suffixes", _B), ("hi", pa.int64()), ("lo", pa.int64()), ("after", pa.int64())]
)
_TOLD_ARROW = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("after", pa.int64())])


class _Compared:
    """Which records of two blocks (or of one) repeat an earlier one: positions in each."""

    def __init__(self, a: Block, b: Block | None, kind: str, words: dict[str, int]):
        """``words`` remembers their numbers."""
        self.same, self.index = _SAME[kind]
        self.words = words
        self.a, self.b = a, b if b is not None else a
        self.found: tuple[set[int], set[int]] = (set(), set())
        self.one = b is None
        if self.one:
            self.found = self.found[0], self.found[0]

    def _pair(self, i: int, j: int) -> None:
        a, b = self.a, self.b
        side, later = (0, i) if a.first[i] > b.first[j] else (1, j)
        if later not in self.found[side] and (self.one is False or i != j) and self.same(a.form(i), b.form(j)):
            self.found[side].add(later)

    def run(self, both: bool) -> tuple[set[int], set[int]]:
        """``both``: whether records of the second block may be the later ones."""
        a, b = self.a, self.b
        if self.one:
            mine = np.flatnonzero(_again(a.key))
            mine = mine[np.argsort(a.first[mine], kind="stable")]
            earlier, later = pairs_within(a.texts.subset(mine, a.key[mine]))
            pairs = zip(mine[earlier].tolist(), mine[later].tolist())
            theirs = mine
        else:
            common = np.intersect1d(a.key, b.key)
            if not len(common):
                return self.found
            mine, theirs = np.flatnonzero(np.isin(a.key, common)), np.flatnonzero(np.isin(b.key, common))
            i, j = b.candidates(a.texts_of(mine, self.words), theirs, self.words)
            j2, i2 = a.candidates(b.texts_of(theirs, self.words), mine, self.words)
            if len(self.words) > REMEMBERED:
                self.words.clear()
            pairs = {*zip(mine[i].tolist(), j.tolist()), *zip(i2.tolist(), theirs[j2].tolist())}
        for i, j in pairs:
            self._pair(i, j)
        # whoever is left is looked up from the beginning, among all of its key
        self._rest(mine, a, b, self.found[0])
        if both and not self.one:
            self._rest(theirs, b, a, self.found[1])
        return self.found

    def _rest(self, whose: np.ndarray, ours: Block, theirs: Block, found: set[int]) -> None:
        known: dict[int, tuple[Lines | Rows, dict[int, int]]] = {}
        for i in whose.tolist():
            if i in found:
                continue
            k, form, before = int(ours.key[i]), ours.form(i), int(ours.first[i])
            if k not in known:
                members = theirs.members(k)
                firsts = [int(theirs.first[j]) for j in members]
                known[k] = self.index([theirs.form(j) for j in members], firsts), dict(zip(firsts, members))
            index, at = known[k]
            if any(self.same(theirs.form(at[n]), form) for n in index.like(form, before)):
                found.add(i)


def _told(block: Block, found: set[int], exact: np.ndarray | None = None) -> pa.RecordBatch:
    """Identifiers of which rows from the block's first on are repeats."""
    at = np.array(sorted(found), np.int64)
    hi, lo, after = block.ids["hi"][at], block.ids["lo"][at], block.first[at] - 1
    if exact is not None:
        hi, lo, after = np.concatenate([hi, exact["hi"]]), np.concatenate([lo, exact["lo"]]), np.concatenate([after, exact["row"] - 1])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (hi, lo, after)], schema=_TOLD_ARROW)


def _as_segment(told: pa.RecordBatch) -> pa.RecordBatch:
    n = told.num_rows
    return pa.RecordBatch.from_arrays([told.column(f.name) if f.name in told.schema.names else pa.nulls(n, f.type) for f in _SEGMENT_ARROW], schema=_SEGMENT_ARROW)


def _numbers(number: int) -> int:
    """A number of its own for each block of a segment."""
    return TaskContext.get().partitionId() << 32 | number


def _built(batches: Iterator[pa.RecordBatch], kind: str, most: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Blocks of entries (``slot, key, hi, lo, form, first, n``; without a key: of a row), which come sorted by slot and key, and what repeats within each."""
    words: dict[str, int] = {}
    held: list[pa.RecordBatch] = []
    size = [0, 0, 0]  # records, characters, blocks so far

    def flush() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        ids = np.empty(t.num_rows, Runs.KIND)
        ids["hi"], ids["lo"], ids["row"] = (t.column(c).to_numpy() for c in ("hi", "lo", "first"))
        keyed = t.column("key").is_valid().to_numpy()
        both = np.empty(int(keyed.sum()), _ID)
        both["hi"], both["lo"] = ids["hi"][keyed], ids["lo"][keyed]
        mine = t.filter(pa.array(keyed))
        block = Block.made(ids[~keyed], mine.column("key").to_numpy(), ids["row"][keyed], both, mine.column("form").to_pylist(), words)
        yield pa.RecordBatch.from_pylist([block.row(t.column("slot")[0].as_py(), _numbers(size[2]))], _SEGMENT_ARROW)
        found, _ = _Compared(block, None, kind, words).run(True)
        many = t.column("n").to_numpy() > 1
        copied = pa.RecordBatch.from_arrays([pa.array(ids[c][many]) for c in ("hi", "lo", "row")], schema=_TOLD_ARROW)
        for told in (copied, _told(block, found)):
            if told.num_rows:
                yield _as_segment(told)
        size[:] = 0, 0, size[2] + 1

    for b in batches:
        slot = b.column("slot").to_numpy()
        long = np.cumsum(pc.fill_null(pc.utf8_length(b.column("form")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < b.num_rows:
            if held and (held[-1].column("slot")[0].as_py() != slot[i] or size[0] >= most or size[1] >= chars):
                yield from flush()
            end = int(np.searchsorted(slot[i:], slot[i], "right")) + i
            taken = int(long[i - 1]) if i else 0
            end = max(i + 1, min(end, i + most - size[0], int(np.searchsorted(long, taken + chars - size[1], "right"))))
            held.append(b.slice(i, end - i))
            size[0] += end - i
            size[1] += int(long[end - 1]) - taken
            i = end
    if held:
        yield from flush()


def _searched_for(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Pairs of a new block and another one of its slot: what repeats."""
    words: dict[str, int] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            older = batch.column("older")[i].as_py()
            a, b = Block.read(batch, i), Block.read(batch, i, "o_")
            rep, known = Runs([b.exact]).look_up(a.exact)
            exact = a.exact[known & (rep < a.exact["row"])]
            ours, theirs = _Compared(a, b, kind, words).run(not older)
            for told in (_told(a, ours, exact), *([] if older else [_told(b, theirs)])):
                if told.num_rows:
                    yield told


def _rejoined(batches: Iterator[pa.RecordBatch], most: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Blocks, which come sorted by slot, put together up to the size of a block."""
    words: dict[str, int] = {}
    held: list[Block] = []
    slot, size, number = None, [0, 0], 0

    def flush() -> pa.RecordBatch:
        parts = [np.concatenate([getattr(x, name) for x in held]) for name in ("exact", "key", "first", "ids")]
        block = Block.made(*parts, [f for x in held for f in x.forms.to_pylist()], words)
        held.clear()
        return pa.RecordBatch.from_pylist([block.row(slot, _numbers(number))], _SEGMENT_ARROW)

    for batch in batches:
        for i in range(batch.num_rows):
            b, at = Block.read(batch, i), batch.column("slot")[i].as_py()
            n, c = len(b.key), sum(pc.utf8_length(b.forms).to_pylist())
            if held and (at != slot or size[0] + n > most or size[1] + c > chars):
                yield flush()
                size, number = [0, 0], number + 1
            slot = at
            held.append(b)
            size = [size[0] + n, size[1] + c]
    if held:
        yield flush()


class History:
    """Everything accepted so far, as segments under ``path``: ``add`` takes in a batch and says which of its rows repeat an earlier one.

    Rows come as :func:`log_rows` or :func:`order_rows` give them; ``kind`` names how their texts are compared (``line`` or ``row``). Batches come in
    the order of ``row_id``. ``slot``: nanoseconds (whole milliseconds), else the first batch decides. A null ``unix`` repeats nothing; without ``key`` or ``form`` a row can only repeat as a whole (``hi, lo``), without these
    only by its text.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str, slot: int | None = None, block: int = BLOCK, chars: int = BLOCK_CHARS):
        self.list, self.kind, self.slot, self.size = RunList(spark, path), kind, slot, (block, chars)

    def _blocks(self, runs: list[dict]) -> DataFrame:
        return self.list.read(runs, _SEGMENT).where(F.col("block").isNotNull())

    def _slot(self, rows: DataFrame) -> int:
        """Nanoseconds in which half a block's entries come, two a row."""
        minutes = rows.where(F.col("unix").isNotNull()).groupBy(F.expr(f"unix div {MINUTE}L")).count()
        a_minute = minutes.agg(F.avg("count")).first()[0] or 1.0
        return min(max(int(MINUTE * self.size[0] / 4 / a_minute) // SLOT[0] * SLOT[0], SLOT[0]), SLOT[1])

    @staticmethod
    def _entries(rows: DataFrame, slot: int) -> DataFrame:
        """``row_id, slot, key, hi, lo, form``: each row by its identifier, and by its text."""
        long = lambda: F.lit(None).cast("long")
        hi, lo = identity(F.col("key"), F.col("form"))
        whole = F.struct(long().alias("key"), F.col("hi").alias("hi"), F.col("lo").alias("lo"), F.lit(None).cast("string").alias("form"))
        text = F.struct(F.when(hi.isNotNull(), F.xxhash64("key")).alias("key"), hi.alias("hi"), lo.alias("lo"), F.col("form").alias("form"))
        at = F.expr(f"(unix - pmod(unix, {slot}L)) div {slot}L")
        return rows.where(F.col("unix").isNotNull()).select("row_id", at.alias("slot"), F.inline(F.array(whole, text))).where(F.col("hi").isNotNull())

    def add(self, rows: DataFrame) -> DataFrame:
        """``row_id`` of the rows that repeat an earlier one, each once; the batch is part of history then. Rows of equal key and form are combined
        before anything is searched, and only blocks that share a slot with the batch are read."""
        head = self.list.head()
        size, kind = self.size, self.kind
        slot = head.get("slot") or self.slot or self._slot(rows)
        entries = self._entries(rows, slot)
        combined = entries.groupBy("slot", "key", "hi", "lo", "form").agg(F.min("row_id").alias("first"), F.count("*").alias("n"))
        sorted_ = combined.hint("rebalance", "slot").sortWithinPartitions("slot", "key")
        name, folder = self.list.fresh()
        sorted_.mapInArrow(lambda b: _built(b, kind, *size), _SEGMENT).write.option("compression", "zstd").parquet(folder)
        run = {"name": name, "level": 0}
        new = self._blocks([run])
        slots = [r[0] for r in new.select("slot").distinct().orderBy("slot").collect()]  # no more than blocks
        others = new.select("slot", *_BLOCK_COLUMNS, F.lit(False).alias("older"))
        if head["runs"]:
            others = others.union(self._blocks(head["runs"]).where(within("slot", slots)).select("slot", *_BLOCK_COLUMNS, F.lit(True)))
        others = others.select("slot", "older", *[F.col(c).alias(f"o_{c}") for c in _BLOCK_COLUMNS])
        pairs = new.select("slot", *_BLOCK_COLUMNS).join(others, "slot").where("older or block < o_block")
        found = settled(pairs.mapInArrow(lambda b: _searched_for(b, kind), "hi long, lo long, after long"), "found")
        self.list.publish(head, slot=slot, runs=[*head["runs"], run])
        told = self.list.read([run], _SEGMENT).where(F.col("block").isNull()).select("hi", "lo", "after").union(found).groupBy("hi", "lo").agg(F.min("after").alias("after"))
        return entries.select("row_id", "hi", "lo").join(told, ["hi", "lo"]).where(F.col("row_id") > F.col("after")).select("row_id").distinct()

    def merge(self, everything: bool = False) -> bool:
        """Merge the segments of a level that has enough of them, or ``everything``; whether there was anything to do. The old ones stay until
        :meth:`RunList.vacuum`."""
        head = self.list.head()
        runs = head["runs"] if everything else self.list.due(head)
        if len(runs) < 2:
            return False
        size = self.size
        name, folder = self.list.fresh()
        sorted_ = self._blocks(runs).hint("rebalance", "slot").sortWithinPartitions("slot")
        sorted_.mapInArrow(lambda b: _rejoined(b, *size), _SEGMENT).write.option("compression", "zstd").parquet(folder)
        gone = {r["name"] for r in runs}
        self.list.publish(head, runs=[*(r for r in head["runs"] if r["name"] not in gone), {"name": name, "level": max(r["level"] for r in runs) + 1}])
        return True


def repeats(rows: DataFrame, kind: str, path: str | None = None, together: int = WAITING, **how) -> DataFrame:
    """``row_id`` of the rows that repeat a row of smaller ``row_id``: the deliveries of ``rows`` one after the other, or so many together as wait,
    against a :class:`History` under ``path`` (else in the shared folder) that begins empty."""
    rows = settled(rows, "forms")
    history = History(rows.sparkSession, path or f"{shared_dir(rows.sparkSession)}/history-{uuid.uuid4().hex}", kind, **how)
    found = [rows.sparkSession.createDataFrame([], "row_id long")]
    for some in waiting(rows, together):
        found.append(history.add(some))
        while history.merge():
            pass
    return reduce(DataFrame.union, found)


def _whole() -> tuple[Column, Column]:
    hi, lo = identity(F.col("hash"), F.col("unix"))
    return hi.alias("hi"), lo.alias("lo")


def log_rows(log: DataFrame) -> DataFrame:
    """``batch_id, row_id, unix, hi, lo, key, form`` of log lines: ``hash`` and ``unix`` as identifier, driver, thread and millisecond as key, and the
    message without its presentation."""
    milli = F.expr("(unix - pmod(unix, 1000000L)) div 1000000L")
    key = F.concat(F.octet_length("driver_name").cast("string"), F.lit(":"), "driver_name", F.octet_length("thread_name").cast("string"), F.lit(":"), "thread_name", F.lit("@"), milli.cast("string"))
    return log.select("batch_id", "row_id", "unix", *_whole(), key.alias("key"), line_form(F.col("message")).alias("form"))


def order_rows(orders: DataFrame) -> DataFrame:
    """``batch_id, row_id, unix, hi, lo, key, form`` of order rows: ``hash`` and ``unix`` as identifier, lifecycle, version and instant as key, and all other
    content but when and as what it was written down."""
    strings, doubles = row_form(orders, ("row_id", "batch_id", "runix", "hash", "xhash", "version", "unix"))
    key = F.concat(F.col("xhash").cast("string"), F.lit("/"), F.col("version").cast("string"), F.lit("@"), F.col("unix").cast("string"))
    return orders.select("batch_id", "row_id", "unix", *_whole(), key.alias("key"), F.concat(strings, F.lit("\x1f"), doubles).alias("form"))
