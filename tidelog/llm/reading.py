"""Reading level of each document, 1 (anyone) to 4 (specialists), learnt from human readers.

Every sentence of a document's own prose gets a distribution over the levels from two regularised linear models fitted
together: one on its words, one on the character n-grams of these words (so that unseen words count too), beside a few
figures of its shape. The distributions of a document's sentences are then put together and calibrated by a second small
model into the level of the document. Pasted log lines, tables, code and quoted mail are no prose and are left out; what
stands in documents of all levels alike, such as footers, has no weight in the models.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 4
#: Labelled documents that are used for fitting, at most: those with the smallest hash of their id.
LABELLED = 1_500
GRAMS = 1 << 16
#: Words a task remembers; beyond, those met on the way are forgotten and scored anew.
VOCABULARY = 200_000

#: How lines that are no prose begin, and the characters by which such a beginning shows.
_STAMPED = re.compile(
    r"[<\[(]?\d{4}-\d\d-\d\d[ T]\d\d:\d\d|[A-Z][a-z]{2} +\d{1,2},? .*\d\d:\d\d:\d\d|time=\S|<\d+>\d |\{.*\}?$|\}|\[|\||>|\$ |at [\w.$]+\(|Caused by: |Traceback |File \"|\.\.\. \d+ more|```"
)
_SUSPECT = frozenset("0123456789<[({}|>$.`atCTFJMASOND")
_WIRE = re.compile(r"\b8=FIX|[|#\x01;]\w+=[^|#\x01;]*[|#\x01;]\w+=")
_LEAD = re.compile(r"(?:[-*+•·]|\d{1,3}[.)])\s+")
_STOP = re.compile(r"(?<=[.!?])[\"')\]*]*\s+")
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*|\d+")
_LINES = re.compile(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]")


def sentences(text: str) -> list[str]:
    """The sentences of a text's prose: lines that are none dropped, paragraphs joined, list items apart."""
    blocks: list[str] = []
    open_ = False
    for line in _LINES.split(text):
        line = line.strip()
        if not line or line[0] == "#" or line[0] in _SUSPECT and _STAMPED.match(line) or "=" in line and _WIRE.search(line):
            open_ = False
        elif (line[0] in "-*+•·" or line[0].isdigit()) and (m := _LEAD.match(line)):
            blocks.append(line[m.end() :])
            open_ = False
        elif open_:
            blocks[-1] += " " + line
        else:
            blocks.append(line)
            open_ = True
    return [s for b in blocks for s in _STOP.split(b)]


def _grams(word: str) -> list[int]:
    w = f"<{word}>"
    out = [xxhash.xxh32_intdigest(w[i : i + n]) % GRAMS for n in (3, 4, 5) for i in range(len(w) - n + 1)]
    return out or [xxhash.xxh32_intdigest(w) % GRAMS]


_SHAPE = 12


def _shape(x: np.ndarray) -> np.ndarray:
    """Figures of sentences from their words, characters, longest word, commas, semicolons and clauses."""
    words, chars, longest, commas, semis, clauses = x.T
    capped, mean = np.minimum(words, 80), chars / np.maximum(words, 1) / 6
    return np.stack([np.ones_like(words), capped / 20, np.sqrt(capped) / 4, words < 5, words > 25, words > 45, mean, mean**2, longest / 12, np.minimum(commas, 8) / 4, np.minimum(semis, 3), np.minimum(clauses, 8) / 4], 1)


class Batch:
    """Texts as sentences of word numbers. ``words`` grows over batches."""

    def __init__(self, texts: list[str], words: dict[str, int]):
        ids: list[int] = []
        lengths, shape, doc = [], [], []
        get, find = words.get, _WORD.findall
        for d, text in enumerate(texts):
            for s in sentences(text):
                found = find(s.lower())
                if not found:
                    continue
                here = [get(w) for w in found]
                if None in here:
                    here = [i if i is not None else words.setdefault(w if not w[0].isdigit() else "0", len(words)) for i, w in zip(here, found)]
                ids += here
                n = len(found)
                lengths.append(n)
                commas = s.count(",")
                shape.append((n, len(s) - n, max(map(len, found)), commas, s.count(";"), commas + s.count(" and ") + s.count(" but ")))
                doc.append(d)
        shape = _shape(np.array(shape, np.float64).reshape(-1, 6))
        self.ids, self.doc = np.array(ids, np.int64), np.array(doc, np.int64)
        self.lengths, self.shape = np.array(lengths, np.int64), shape
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.texts = len(texts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _incidence(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, n-grams and weights of all words: each word's n-grams weigh one together."""
    row, gram, weight = [], [], []
    for i, w in enumerate(words):
        g = _grams(w)
        row += [i] * len(g)
        gram += g
        weight += [1 / len(g)] * len(g)
    return np.array(row, np.int64), np.array(gram, np.int64), np.array(weight)


class Model:
    """``word``: score of each known word by level; ``gram``: of each n-gram; ``shape``: of the figures; ``top``: the calibration."""

    def __init__(self, words: dict[str, int], word: np.ndarray, gram: np.ndarray, shape: np.ndarray, top: np.ndarray | None = None):
        self.words, self.word, self.gram, self.shape, self.top = words, word, gram, shape, top
        self.scored, self.known = word, len(word)  # room for words met on the way, and how much of it is taken

    def _vectors(self, words: dict[str, int]) -> np.ndarray:
        if len(words) > len(self.scored):
            self.scored = np.concatenate([self.scored, np.zeros((len(words), LEVELS))])
        if len(words) > self.known:
            for i, w in enumerate(islice(words, self.known, None), self.known):
                self.scored[i] = self.gram[_grams(w)].mean(0)
            self.known = len(words)
        return self.scored

    def distributions(self, batch: Batch, words: dict[str, int]) -> np.ndarray:
        if not len(batch.starts):
            return np.zeros((0, LEVELS))
        vec = self._vectors(words)[batch.ids]
        summed = np.add.reduceat(vec, batch.starts, axis=0) / np.sqrt(batch.lengths)[:, None]
        return _softmax(summed + batch.shape @ self.shape)

    def levels(self, texts: list[str]) -> np.ndarray:
        batch = Batch(texts, self.words)
        out = _softmax(document_figures(batch, self.distributions(batch, self.words)) @ self.top)
        if len(self.words) > VOCABULARY:  # forget the words met on the way, not those learnt
            self.words = dict(islice(self.words.items(), len(self.word)))
            self.scored, self.known = self.word, len(self.word)
        return settle(out)


def settle(p: np.ndarray) -> np.ndarray:
    """The median of a distribution over levels: the level that is least far off on average."""
    return 1 + (np.cumsum(p, 1) < 0.5).sum(1).clip(0, LEVELS - 1)


def document_figures(batch: Batch, dist: np.ndarray) -> np.ndarray:
    """Per document, from the distributions of its sentences weighted by their words: mean, mean of logarithms, quantiles of the expected level."""
    n = batch.texts
    out = np.zeros((n, 3 * LEVELS + 6))
    out[:, 0] = 1
    if not len(batch.doc):
        return out
    w = np.minimum(batch.lengths, 40).astype(float)
    total = np.maximum(np.bincount(batch.doc, w, n), 1e-9)
    logs = np.log(dist + 0.02)
    level = dist @ np.arange(LEVELS)
    sure = np.eye(LEVELS)[dist.argmax(1)]
    for k in range(LEVELS):
        out[:, 1 + k] = np.bincount(batch.doc, w * dist[:, k], n) / total
        out[:, 1 + LEVELS + k] = np.bincount(batch.doc, w * logs[:, k], n) / total
        out[:, 1 + 2 * LEVELS + k] = np.bincount(batch.doc, w * sure[:, k], n) / total
    order = np.lexsort((level, batch.doc))
    run = np.cumsum(w[order])
    end = np.cumsum(np.bincount(batch.doc, w, n))
    begin = end - np.bincount(batch.doc, w, n)
    has = np.bincount(batch.doc, minlength=n) > 0
    for j, q in enumerate((0.2, 0.35, 0.5, 0.65, 0.8)):
        at = np.searchsorted(run, begin + q * (end - begin)).clip(0, len(run) - 1)
        out[:, 1 + 3 * LEVELS + j] = np.where(has, level[order][at], 0)
    return out


def _adam(grad, params: list[np.ndarray], steps: int, rate: float) -> list[np.ndarray]:
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        for i, g in enumerate(grad(params)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return params


def _fit_sentences(batch: Batch, words: dict[str, int], target: np.ndarray, weight: np.ndarray, steps: int, ridge: float) -> Model:
    """``target``: a distribution per text; ``weight`` per text, spread over its sentences."""
    row, gram, part = _incidence(list(words))
    used, gram_at = np.unique(gram, return_inverse=True)
    per_doc = np.maximum(np.bincount(batch.doc, batch.lengths.clip(0, 40), batch.texts), 1)
    w = (weight[batch.doc] * batch.lengths.clip(0, 40) / per_doc[batch.doc])[:, None]
    y, scale = target[batch.doc], 1 / np.sqrt(batch.lengths)[:, None]
    sentence = np.repeat(np.arange(len(batch.lengths)), batch.lengths)
    n_words, n_grams = len(words), len(used)
    total = weight.sum()

    def spread(grams: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(row, part * grams[gram_at, k], n_words) for k in range(LEVELS)], 1)

    def grad(params):
        word, grams, shape = params
        vec = word + spread(grams)
        p = _softmax(np.add.reduceat(vec[batch.ids], batch.starts, axis=0) * scale + batch.shape @ shape)
        err = (p - y) * w / total
        per_token = (err * scale)[sentence]
        d_vec = np.stack([np.bincount(batch.ids, per_token[:, k], n_words) for k in range(LEVELS)], 1)
        d_gram = np.stack([np.bincount(gram_at, part * d_vec[row, k], n_grams) for k in range(LEVELS)], 1)
        return [d_vec + ridge * word, d_gram + ridge * grams, batch.shape.T @ err + ridge * shape]

    word, grams, shape = _adam(grad, [np.zeros((n_words, LEVELS)), np.zeros((n_grams, LEVELS)), np.zeros((_SHAPE, LEVELS))], steps, 0.08)
    full = np.zeros((GRAMS, LEVELS))
    full[used] = grams
    return Model(dict(words), word + spread(grams), full, shape)


def fit(texts: list[str], levels: list[list[int]], steps: int = 45, ridge: float = 2e-5, folds: int = 2) -> Model:
    """A model from texts and what readers said of each (one or more levels). Sentence models are fitted on all but one fold in turn,
    so that the calibration learns from distributions of texts they haven't seen."""
    target = np.zeros((len(texts), LEVELS))
    for i, said in enumerate(levels):
        for x in said:
            target[i, x - 1] += 1 / len(said)
    weight = np.array([1.0 + 0.5 * (len(x) - 1) for x in levels])
    words: dict[str, int] = {}
    batch = Batch(texts, words)
    held = np.arange(len(texts)) % folds
    figures = np.zeros((len(texts), 3 * LEVELS + 6))
    for f in range(folds):
        part = _fit_sentences(batch, words, target, np.where(held == f, 0.0, weight), steps, ridge)
        figures[held == f] = document_figures(batch, part.distributions(batch, words))[held == f]
    model = _fit_sentences(batch, words, target, weight, steps, ridge)

    def grad(params):
        p = _softmax(figures @ params[0])
        return [figures.T @ ((p - target) * weight[:, None]) / weight.sum() + 1e-4 * params[0]]

    model.top = _adam(grad, [np.zeros((figures.shape[1], LEVELS))], 600, 0.05)[0]
    return model


def _blank(text: str) -> Column:
    return F.coalesce(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", ""), F.lit("")) == ""


def trained(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> bytes:
    """A pickled :class:`Model` from the texts and labels of at most ``limit`` documents, fitted in one task. Labels outside 1 to 4,
    of documents not there, or of blank texts don't count."""
    said = labels.where(F.col("level").between(1, LEVELS)).groupBy("doc_id").agg(F.collect_list("level").alias("said"))
    picked = F.broadcast(said.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # the corpus is read where it lies; only one text of each picked document travels to the task that fits
    texts = docs.join(picked.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.when(~_blank("text"), F.col("text"))).alias("text"))
    rows = texts.where(F.col("text").isNotNull()).join(picked, "doc_id").select("doc_id", "text", "said")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = [b for b in batches if b.num_rows]
        frame = pa.Table.from_batches(t).to_pandas().sort_values("doc_id") if t else None
        model = fit(frame["text"].tolist(), [sorted(map(int, x)) for x in frame["said"]]) if frame is not None else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.repartition(1).mapInArrow(learn, "model binary").first()
    return bytes(made[0]) if made else pickle.dumps(None)  # no rows at all: no task ran


def leveled(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """``doc_id, level`` of every document of ``docs`` whose text is neither null nor blank. Without any usable label there is no model, and so
    every level is null; a text without prose gets the level that nothing speaks against."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, limit))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                level = pa.nulls(b.num_rows, pa.int32()) if model is None else pa.array(model.levels(b.column(1).to_pylist()), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), level], ["doc_id", "level"])

    return docs.where(~_blank("text")).select("doc_id", "text").mapInArrow(judge, "doc_id long, level int")
