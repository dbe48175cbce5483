"""Test items that stand in the corpus, as they are or with other numbers and names.

Texts become templates: numbers, the units behind them, and names are replaced by typed placeholders, by a lexicon made of all
items. Windows of ``RUN`` template words of items and documents are joined by hash, whatever the number of items; then words and the
slots behind the placeholders are compared: all equal is a leak, a consistent exchange (each value always for the same other) is a
re-parameterised question. Words are runs of letters and digits of the case-folded compatibility form without format characters.

What is broadcast has a fixed size: the lexicon as bitmaps over word hashes, and a filter over the hashes of the items' windows that
keeps windows no item has from travelling. Bits that words share make a template coarser, on both sides alike: it joins
more, and the words decide.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.runtime import settled

RUN = 12
#: Item windows that the filter is made for, at 32 bits each (8 MB). More of them let more windows of documents through to the join, nothing else.
WINDOWS = 2_000_000
#: Bits of each plane of the lexicon (2 MB).
LEXICON = 1 << 24
#: Words whose templates a task remembers before it begins anew.
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
NUMBER, UNIT, NAME = 1, 2, 3  # the placeholders
_PLANES = KNOWN, MEASURE, UPPER, LOWER = range(4)  # of the lexicon: in any item, behind a number, capitalised within a sentence, not capitalised
_BUCKET = 1 << 15  # bits that a row of a bitmap has


def _format_free(text: str) -> str:
    return "".join(c for c in text if unicodedata.category(c) != "Cf")


def normal(text: str) -> str:
    """``text`` as far as letters and digits go: compatibility forms, case and format characters evened out."""
    if text.isascii():
        return text.lower()
    if not text.isprintable():
        text = _format_free(text)
    out = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return out if out.isprintable() else _format_free(out)


def words_of(text: str) -> list[str]:
    return _WORD.findall(normal(text))


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def lexicon_entries(text: str) -> set[tuple[int, str]]:
    """The planes that a text puts its words in."""
    words = words_of(text)
    out = {(KNOWN, w) for w in words}
    out |= {(MEASURE, b) for a, b in zip(words, words[1:]) if a.isdigit() and b.isalpha()}
    raw = _format_free(text)
    for m in re.finditer(r"[^\W_]+", raw):
        w = normal(m[0])
        if not w or not w[0].isalpha():
            continue
        begins = re.search(r"(?:\A|[.!?:]\s*[\"'(]*)\s*\Z", raw[max(0, m.start() - 8) : m.start()]) is not None
        if not m[0][:1].isupper():
            out.add((LOWER, w))
        elif not begins:
            out.add((UPPER, w))
    return out


class Bits:
    """A bitmap of a fixed number of bits."""

    def __init__(self, size: int):
        self.size, self.data = size, np.zeros(max(size, _BUCKET) // 8, np.uint8)

    @classmethod
    def gathered(cls, cells: DataFrame, size: int) -> dict[int, "Bits"]:
        """A bitmap for each ``plane`` of ``cells`` (``plane, cell``), put together by Spark in rows of ``_BUCKET`` bits; at most ``size`` bits a plane come here."""
        rows = cells.groupBy("plane", F.expr(f"cell div {_BUCKET}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("cell") % _BUCKET).alias("bits"))
        out: dict[int, Bits] = {}
        for r in rows.collect():
            at = r["bucket"] * _BUCKET // 8
            out.setdefault(r["plane"], cls(size)).data[at : at + _BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
        return out

    def has(self, cell: int) -> bool:
        return bool(self.data[cell >> 3] >> (cell & 7) & 1)

    def all_of(self, cells: np.ndarray) -> np.ndarray:
        return (self.data[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Lexicon:
    """Templates of words by the planes of all items."""

    def __init__(self, planes: dict[int, Bits]):
        self.planes = {p: planes.get(p) or Bits(_BUCKET) for p in _PLANES}
        self.seen: dict[str, int] = {}

    def _in(self, plane: int, h: int) -> bool:
        return self.planes[plane].has(h % self.planes[plane].size)

    def template(self, word: str) -> int:
        """The placeholder of a word of the items, or the word's own number; 0 if no item has it."""
        t = self.seen.get(word)
        if t is None:
            h = _hash(word)
            if not self._in(KNOWN, h):
                t = 0
            elif word.isdigit():
                t = NUMBER
            elif self._in(UPPER, h) and not self._in(LOWER, h):
                t = NAME
            else:
                t = UNIT if self._in(MEASURE, h) else h | 4
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = t
        return t

    def read(self, text: str, free: bool = False) -> tuple[list[str], list[int]]:
        """The words of a text and their templates. ``free``: words the items don't have may fill slots (numbers, capitalised words)."""
        get, template = self.seen.get, self.template
        if not free:
            words = words_of(text)
            return words, [get(w) or template(w) for w in words]
        words, templates = [], []
        for m in _WORD.finditer(unicodedata.normalize("NFKC", _format_free(text))):
            w = normal(m[0])
            words.append(w)
            templates.append(template(w) or (NUMBER if w.isdigit() else NAME if m[0][:1].isupper() else 0))
        return words, templates


def _windows(template: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of which every word has a template."""
    if len(template) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    bad = np.concatenate([[0], np.cumsum(template == 0)])
    starts = np.flatnonzero(bad[run:] == bad[:-run])
    h = np.zeros(len(starts), np.uint64)
    for k in range(run):
        h = h * _MULTIPLIER + template[starts + k].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return starts, h


def _probes(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of a filter of ``size`` bits that stand for a hash."""
    return h % np.uint64(size), (h * _MULTIPLIER >> np.uint64(17)) % np.uint64(size)


def _cut(df: DataFrame, key: str, run: int, lexicon, free: bool, only=None) -> DataFrame:
    """``t, <key>, w, kinds``: of each window of the texts, once a batch, the hash of its template, its words and their placeholders (0 for a word
    that stands for itself). ``lexicon`` and ``only`` are broadcast; ``only`` is a filter on the hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(lexicon.value)
        for b in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            words: list[str] = []
            templates: list[int] = []
            ends, keys = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws, ts = known.read(text, free)
                if len(ws) >= run:
                    words += ws
                    templates += ts
                    words.append(""), templates.append(0)
                    ends.append(len(words)), keys.append(k)
            template = np.array(templates, np.int64)
            starts, h = _windows(template, run)
            if only is not None and len(starts):
                first, second = _probes(h, only.value.size)
                kept = only.value.all_of(first) & only.value.all_of(second)
                starts, h = starts[kept], h[kept]
            whose = np.searchsorted(np.array(ends, np.int64), starts, "right")
            rows = {(t, keys[o], " ".join(words[s : s + run])): s for t, o, s in zip(h.view(np.int64).tolist(), whose.tolist(), starts.tolist())}
            kinds = pa.array([[t if t <= NAME else 0 for t in templates[s : s + run]] for s in rows.values()], pa.list_(pa.int32()))
            ts, ks, wds = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ts, pa.int64()), pa.array(ks, pa.int64()), pa.array(wds, pa.string()), kinds], ["t", key, "w", "kinds"])

    return df.select(F.col(key).cast("long"), "text").where(F.col(key).isNotNull() & F.col("text").isNotNull()).mapInArrow(cut, f"t long, `{key}` long, w string, kinds array<int>")


def lexicon_of(items: DataFrame, size: int = LEXICON) -> dict[int, Bits]:
    """The planes of the words of ``items`` (``text``)."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {(p, _hash(w) % size) for t in b.column(0).to_pylist() for p, w in lexicon_entries(t)}
            yield pa.RecordBatch.from_pydict({"plane": pa.array([p for p, _ in found], pa.int32()), "cell": pa.array([c for _, c in found], pa.int64())})

    return Bits.gathered(items.where(F.col("text").isNotNull()).select("text").mapInArrow(entries, "plane int, cell long"), size)


def _exchanged(ours: Column, theirs: Column, kinds: Column) -> Column:
    """Equal but for slots, which are exchanged one to one, at least one of them."""
    all_ = F.arrays_zip(F.split(ours, " ").alias("p"), F.split(theirs, " ").alias("q"), kinds.alias("k"))
    slot = lambda x: x["k"].isin(NUMBER, NAME)
    slots = F.filter(all_, slot)
    kinds_of = lambda *names: F.size(F.array_distinct(F.transform(slots, lambda x: F.struct(*[x[n].alias(n) for n in names]))))
    pairs = kinds_of("k", "p", "q")
    return F.forall(all_, lambda x: slot(x) | (x["p"] == x["q"])) & (pairs == kinds_of("k", "p")) & (pairs == kinds_of("k", "q")) & F.exists(slots, lambda x: x["p"] != x["q"])


def leaks(docs: DataFrame, items: DataFrame, run: int = RUN, exchanged: bool = False, windows: int = WINDOWS) -> DataFrame:
    """``doc_id, item_id`` of every document and item whose texts share a run of at least ``run`` words; with ``exchanged``, share
    one but for a consistent exchange of numbers and names.

    Null, empty and shorter texts share nothing, nor do rows without an id; repeated rows count once. ``windows``: item windows that the filter is
    made for; it changes how much is joined, not the result.
    """
    share = docs.sparkSession.sparkContext.broadcast
    lexicon = share(lexicon_of(items))
    theirs = settled(_cut(items, "item_id", run, lexicon, False).distinct(), "item-windows")
    size = max(_BUCKET, 1 << (32 * windows - 1).bit_length())

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.unique(np.concatenate(_probes(b.column(0).to_numpy().view(np.uint64), size)))
            yield pa.RecordBatch.from_pydict({"plane": pa.array(np.zeros(len(cell), np.int32)), "cell": pa.array(cell.astype(np.int64))})

    filter_ = Bits.gathered(theirs.select("t").mapInArrow(cells, "plane int, cell long"), size).get(0) or Bits(_BUCKET)
    ours = _cut(docs, "doc_id", run, lexicon, exchanged, share(filter_)).select("t", "doc_id", F.col("w").alias("here"))
    met = ours.join(theirs, (ours["t"] == theirs["t"]) & (_exchanged(F.col("here"), F.col("w"), F.col("kinds")) if exchanged else ours["here"] == theirs["w"]))
    return met.select("doc_id", "item_id").distinct()
