"""Fields that pack several values into rows of one value each, with their positions kept.

A field is covered by pieces from left to right: known whole values found by a multi-pattern automaton, quoted values, bare runs,
and separators. Dynamic programming picks the cheapest cover: a known value, whatever delimiters it holds, costs less than the pieces
the grammar would make of it, and of known values that overlap those win that leave least to the grammar. A piece inside quotes or
inside a known value never splits. Each distinct field text is cut once per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known whole values a dictionary may have.
DICTIONARY = 10_000

_QUOTED = re.compile(r"\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*'")
_BARE = re.compile(r"[\w.:\-]+")
_BLANK = re.compile(r"\s+")
_COSTS = {"known": 1, "quoted": 2, "bare": 2, "sep": 3, "blank": 3, "stray": 9}


def _plain(text: str, i: int) -> bool:
    return text[i].isalnum() or text[i] in "._:-"


class Segmenter:
    """Cuts fields. ``known`` are whole values as printed, quotes included where they have them. A known value counts where it stands
    alone: at an end of the field, or beside what is neither part of a bare value nor a quote."""

    def __init__(self, known: Iterable[str] = ()):
        self.known = [k for k in known if k]
        self.automaton = None
        if self.known:
            self.automaton = ahocorasick.Automaton()
            for k in self.known:
                self.automaton.add_word(k, k)
            self.automaton.make_automaton()
        self.seen: dict[str, list[str]] = {}

    def _pieces(self, text: str) -> list[list[tuple[int, str]]]:
        """For each position the pieces that may begin there: their ends and kinds."""
        n = len(text)
        out: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        quoted = {}
        i = 0
        while i < n:
            c = text[i]
            if c in "\"'" and (m := _QUOTED.match(text, i)):
                quoted[i] = m.end()  # what a quotation holds begins nothing
                out[i].append((m.end(), "quoted"))
                i = m.end()
            elif c.isspace():
                j = _BLANK.match(text, i).end()
                out[i].append((j, "blank"))
                i = j
            elif _plain(text, i):
                j = i
                while j < n and _plain(text, j):
                    j += 1
                out[i].append((j, "bare"))
                i = j
            else:
                j = i + 2 if text.startswith("||", i) else i + 1
                out[i].append((j, "stray" if c in "\"'" else "sep"))
                i = j
        if self.automaton is not None:
            for end, k in self.automaton.iter(text):
                i, j = end - len(k) + 1, end + 1
                if quoted.get(i) == j or not (i and self._joins(text, i - 1)) and not (j < n and self._joins(text, j)):
                    out[i].append((j, "known"))
        return out

    @staticmethod
    def _joins(text: str, i: int) -> bool:
        return _plain(text, i) or text[i] in "\"'"

    def cover(self, text: str) -> list[tuple[int, int, str]]:
        """The cheapest cover; among equals the one with the longer first piece."""
        pieces, n = self._pieces(text), len(text)
        cost: list[float] = [float("inf")] * n + [0]
        take: list[tuple[int, str] | None] = [None] * n
        for i in range(n - 1, -1, -1):
            for j, kind in pieces[i]:
                c = _COSTS[kind] + cost[j]
                if c < cost[i] or (c == cost[i] and take[i] and j > take[i][0]):
                    cost[i], take[i] = c, (j, kind)
        out, i = [], 0
        while i < n:
            if take[i] is None:  # inside what only a longer piece covers: a single stray character
                out.append((i, i + 1, "stray"))
                i += 1
            else:
                out.append((i, *take[i]))
                i = take[i][0]
        return out

    def values(self, field: str | None) -> list[str]:
        """The values of a field in order. Null and blank fields have none; a slot left empty is ''."""
        if field is None or not (text := field.strip()):
            return []
        if (known := self.seen.get(text)) is not None:
            return known
        out: list[str] = []
        slot: str | None = None  # the value of the open slot
        blank = False  # blanks since that value: they separate unless a separator follows
        for i, j, kind in self.cover(text):
            if kind == "blank":
                blank = slot is not None
            elif kind in ("sep", "stray"):
                out.append(slot or "")
                slot, blank = None, False
            else:
                value = text[i:j]
                if text[i] in "\"'" and (kind == "quoted" or kind == "known" and _QUOTED.fullmatch(value)):
                    value = value[1:-1].replace(text[i] * 2, text[i])
                if slot is not None:  # blanks, or nothing, between two values
                    out.append(slot)
                slot, blank = value, False
        out.append(slot or "")
        if len(self.seen) < 50_000:
            self.seen[text] = out
        return out


def braces(message: str) -> Iterator[str]:
    """What stands between braces, in order; a brace inside quotes counts for nothing, one that is never closed holds nothing."""
    i = 0
    dead: set[int] = set()  # places from which no closing brace is met
    while (i := message.find("{", i)) >= 0:
        j, seen = i + 1, []
        while j < len(message) and message[j] != "}" and j not in dead:
            seen.append(j)
            m = _QUOTED.match(message, j) if message[j] in "\"'" else None
            j = m.end() if m else j + 1
        if j >= len(message) or message[j] != "}":
            dead.update(seen)
            i += 1
            continue
        yield message[i + 1 : j]
        i = j + 1


def quoted_values(fields: DataFrame, limit: int = DICTIONARY) -> list[str]:
    """The distinct quotations in ``fields`` (``text``) that come more than once, of at most 200 characters, the ``limit`` commonest. What stands in
    quotes is one value to the grammar as well, so a quotation that is not among these is cut alike."""
    found = fields.select(F.explode(F.regexp_extract_all("text", F.lit("(\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*')"), F.lit(1))).alias("q"))
    top = found.groupBy("q").count().where("count > 1 and length(q) <= 200").orderBy(F.desc("count"), "q").limit(limit)
    return [r["q"] for r in top.collect()]


def packed_fields(log: DataFrame, tags: tuple[int, ...] = (18, 276, 277), suffix: str = "LIST") -> DataFrame:
    """``row_id, field, item_no, text`` of the packed fields of ``log``: entries of ``fix_tags`` with one of ``tags``, of ``keyval`` with
    a key ending in ``suffix``, and ``message`` where it has braces. Null and blank texts are left out."""
    entry: Column = F.posexplode(F.transform("fix_tags", lambda x: F.when(x["tag"].isin(*tags), x["value"])))
    pair: Column = F.posexplode(F.transform("keyval", lambda x: F.when(F.upper(x["key"]).endswith(suffix), x["value"])))
    of_tags = log.where(F.exists("fix_tags", lambda x: x["tag"].isin(*tags))).select("row_id", F.lit("fix_tags").alias("field"), entry.alias("item_no", "text"))
    of_pairs = log.where(F.exists("keyval", lambda x: F.upper(x["key"]).endswith(suffix))).select("row_id", F.lit("keyval").alias("field"), pair.alias("item_no", "text"))
    of_message = log.where(F.col("message").contains("{")).select("row_id", F.lit("message").alias("field"), F.lit(0).alias("item_no"), F.col("message").alias("text"))
    return of_tags.unionByName(of_pairs).unionByName(of_message).where(F.col("text").isNotNull() & (F.trim("text") != ""))


def unpacked(fields: DataFrame, known: Iterable[str] = ()) -> DataFrame:
    """``row_id, field, item_no, pos, value`` of ``fields`` (``row_id, field, item_no, text``). A value of ``known`` (at most ``DICTIONARY``) is
    one value wherever it stands alone, whatever it holds.

    Bare values are letters, digits and ``. _ : -``; a quoted value may hold anything, a doubled quote meaning one, and loses its
    quotes; all else separates. Blanks around a separator are part of it, two bars side by side are one, blanks at either end mean
    nothing; a slot left empty is ''. Of a ``message`` all that stands between braces counts.
    """
    known = list(known)
    if len(known) > DICTIONARY:
        raise ValueError(f"a dictionary has at most {DICTIONARY} values, not {len(known)}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(known)
        for b in batches:
            rows, field, item, pos, value = [], [], [], [], []
            for r, f, n, t in zip(*(b.column(c).to_pylist() for c in ("row_id", "field", "item_no", "text"))):
                texts = braces(t) if f == "message" else (t,)
                p = 0
                for text in texts:
                    for v in segmenter.values(text):
                        rows.append(r), field.append(f), item.append(n), pos.append(p), value.append(v)
                        p += 1
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(field, pa.string()), pa.array(item, pa.int32()), pa.array(pos, pa.int32()), pa.array(value, pa.string())], ["row_id", "field", "item_no", "pos", "value"])

    return fields.select("row_id", "field", "item_no", "text").mapInArrow(cut, "row_id long, field string, item_no int, pos int, value string")
