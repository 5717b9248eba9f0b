"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A text is the set of its shingles of five consecutive words (lower case; a text of fewer words is one shingle). A
shingle weighs its number of occurrences times 1 + IDF_GAIN * ln(N / df) / ln(N). The df of all shingles is exact, in a
stored table of those above 1. A shingle is common if its df is at least 2 and one ``COMMON``-th of the sum of all df,
so there are at most COMMON of them, whatever the corpus; these are sent to every task. Sampling, which only proposes
pairs, takes all others for rare; the similarity that decides has the df of every shingle.

Documents with the same words form one content, which is sampled by improved consistent weighted sampling (two
contents agree in a sample with a probability equal to their weighted Jaccard similarity) and by plain min-hashes (the
same for the plain similarity, whatever the numbers of occurrences), and hashed band by band.
The contents of a bucket are first compared with the smallest one. Buckets in which one of them fails are compared
again in blocks, every content with every other that is not linked yet, inside tasks of bounded size that emit only
the links they need. A link is kept if the weighted or the plain Jaccard similarity is at least ``SIMILARITY``.
Classes are the connected components of the links, found by passing on the smallest label and by jumping over it.

Defined results: a document without words is a class of its own, unless its text is repeated exactly (a missing or
empty text is always alone). The class id is the smallest doc_id of the class; a missing doc_id counts as above all
others. As doc_ids may be missing or repeat, classes are told apart by their label, not by their id. Repeated rows
give one row each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.session import passing, settings, stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
COMMON = 100_000       # common shingles at most: each has one such part of the sum of all document frequencies
IDF_GAIN = 0.5
COUNTED_TOGETHER = 250_000  # shingles a task counts before it hands the counts on
SENT_TOGETHER = 50_000
SENT_ROWS = 10_000
SENT_RANGES = 256
WORD_BYTES = 6              # of a usual word and the space behind it; only sizes the ranges
COUNTED_BYTES = 16 << 20    # smaller splits are counted together
RANGE = 2_000_000           # shingles that are added up together, about
TOGETHER = 100_000          # random numbers at a time, in memory that is used again
PART = 1 << 16               # characters whose words are hashed together; longer texts are cut behind a word
LONG_WORD = 64               # longer words are never taken from the table
ROWS_AT_ONCE = 1000          # rows, each with a whole text, vector or range of counts, that a Python worker is sent at once
BYTES_AT_ONCE = "4m"         # and their size: a row of counts has tens of KB, and a batch lies in memory several times
BLOCK_BYTES = 2 << 20  # vectors of a bucket that are compared with those of another block in one task, about

_WORD, _GAP = re.compile(r"\w+"), re.compile(r"\W")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_WORD_BITS = 18
_TABLE_BITS = 16


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Words:
    """Hashes of words, those of words seen lately from a table.

    The place in the table is a polynomial of the word's characters, which running sums give for all words of a text at
    once; only words that are not in their place are cut out and hashed one by one."""

    def __init__(self):
        every = "".join(map(chr, range(sys.maxunicode + 1)))
        self.values = np.zeros(len(every), np.uint32)     # of characters, 0 if not of a word
        for run in _WORD.finditer(every):
            self.values[run.start():run.end()] = np.arange(run.start(), run.end())
        self.ascii = bytes(self.values[:128].tolist()) + bytes(128)
        self.powers, self.inverse = (np.multiply.accumulate(
            np.append(np.uint64(1), np.full(PART + 2 * LONG_WORD, x, np.uint64))) for x in (_BASE, pow(_BASE, -1, 2 ** 64)))
        self.keys, self.hashes = (np.zeros(1 << _WORD_BITS, np.uint64) for _ in range(2))
        self.keys[0] = 1      # 0 belongs here, 1 does not: no place holds a key of its own as yet

    def of(self, text: str) -> np.ndarray:
        """The hashes of the words of a text in lower case."""
        if len(text) <= PART:
            return self._of_part(text)
        found, begin = [], 0
        while begin < len(text):
            cut = _GAP.search(text, begin + PART - LONG_WORD, begin + PART)
            if cut or begin + PART >= len(text):
                end = cut.end() if cut else len(text)
                found.append(self._of_part(text[begin:end]))
            else:                          # a word too long for a part; it ends beyond it
                end = cut.end() if (cut := _GAP.search(text, begin + PART)) else len(text)
                found.append(np.array([xxhash.xxh3_64_intdigest(w) for w in _WORD.findall(text[begin:end])], np.uint64))
            begin = end
        return np.concatenate(found)

    def _of_part(self, text: str) -> np.ndarray:
        text = f" {text} "
        if text.isascii():
            values = np.frombuffer(text.encode().translate(self.ascii), np.uint8)
        else:
            values = self.values[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        inside = values != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        begins, ends = edges[::2], edges[1::2]
        sums = np.cumsum(values * self.powers[:len(values)])
        keys = (sums[ends] - sums[begins - 1]) * self.inverse[begins]
        places = ((keys * _MULTIPLY) >> np.uint64(64 - _WORD_BITS)).view(np.int64)
        found = self.hashes[places]
        missing = np.flatnonzero((self.keys[places] != keys) | (ends - begins > LONG_WORD))
        if len(missing):
            spans = zip(begins[missing].tolist(), ends[missing].tolist())
            found[missing] = new = np.array([xxhash.xxh3_64_intdigest(text[i:j]) for i, j in spans], np.uint64)
            self.keys[places[missing]], self.hashes[places[missing]] = keys[missing], new
        return found


@lru_cache(maxsize=1)
def _words() -> _Words:
    """One table per Python worker."""
    return _Words()


def word_hashes(text: str | None) -> np.ndarray:
    return _words().of(text.lower()) if text else np.empty(0, np.uint64)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes in ascending order; sorting takes a sixth of the time of NumPy's table of hashes."""
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of every run of five words, with repeats."""
    n = min(len(words), SHINGLE_WORDS)
    if not n:
        return words
    count = len(words) - n + 1
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = out * _MULTIPLY + words[i:i + count]
    return _mixed(out)


class Weights:
    """Weights of shingles: the inverse document frequencies of the common ones, sorted by hash. Those of all others are
    from ``least`` to ``rare``."""

    def __init__(self, hashes: np.ndarray, factors: np.ndarray, documents: int, least: float = 1.0):
        self.hashes, self.factors, self.rare, self.documents = hashes, factors, 1 + IDF_GAIN, documents
        self.least = min(least, self.rare)

    def common(self, distinct: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(distinct), bool)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return self.hashes[at] == distinct

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in ascending order, and their weights."""
        distinct, counts = np.unique(shingles(words), return_counts=True)
        weights = counts * self.rare
        if len(self.hashes) and len(distinct):
            at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            common = self.hashes[at] == distinct
            weights[common] = counts[common] * self.factors[at[common]]
        return distinct, weights


class Sampler:
    """Improved consistent weighted sampling. The three random numbers of a shingle and sample come from a table."""

    def __init__(self, usual: float, samples: int = BANDS * ROWS):
        random = np.random.default_rng(20240229)
        self.factors = random.integers(1, 2 ** 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.r = random.gamma(2, 1, 1 << _TABLE_BITS)
        self.log_c = np.log(random.gamma(2, 1, 1 << _TABLE_BITS))
        self.beta = random.random(1 << _TABLE_BITS)
        # all that depends on the usual weight is computed once
        self.numbers, self.keys = np.empty(TOGETHER, np.uint64), np.empty(TOGETHER, np.float32)
        self.usual, usual_t = usual, np.floor(np.log(usual) / self.r + self.beta)
        self.usual_key = (self.log_c - self.r * (usual_t - self.beta) - self.r).astype(np.float32)
        self.usual_t = usual_t.astype(np.int64)
        self.plain_factors = np.random.default_rng(20240301).integers(
            1, 2 ** 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _memory(self, samples: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Room for a number and a key per sample and shingle; new memory each time would cost more than the work."""
        if samples * n > len(self.numbers):
            self.numbers, self.keys = np.empty(samples * n, np.uint64), np.empty(samples * n, np.float32)
        return tuple(x[:samples * n].reshape(samples, n) for x in (self.numbers, self.keys))

    def sample(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every sample, a hash of the chosen shingle and its level."""
        out = np.empty(len(self.factors), np.uint64)
        odd = np.flatnonzero(weights != self.usual)
        odd_log = np.log(weights[odd])
        step = max(1, TOGETHER // len(hashes))
        for at in range(0, len(out), step):
            factors = self.factors[at:at + step]
            numbers, key = self._memory(len(factors), len(hashes))
            np.multiply(hashes[None, :], factors[:, None], out=numbers)
            place = np.right_shift(numbers, np.uint64(64 - _TABLE_BITS), out=numbers).view(np.int64)
            np.take(self.usual_key, place, out=key, mode="clip")
            if len(odd):
                odd_place = place[:, odd]
                r, beta, odd_key = (x[odd_place] for x in (self.r, self.beta, self.log_c))
                odd_t = np.floor(odd_log / r + beta)
                odd_key -= r * (odd_t - beta)
                odd_key -= r
                key[:, odd] = odd_key
            best = key.argmin(axis=1)
            level = self.usual_t[place[np.arange(len(best)), best]]
            if len(odd):
                index = np.searchsorted(odd, best)
                hit = np.flatnonzero((index < len(odd)) & (odd[np.minimum(index, len(odd) - 1)] == best))
                level[hit] = odd_t[hit, index[hit]].astype(np.int64)
            out[at:at + step] = _mixed(hashes[best] + level.astype(np.uint64) * _MULTIPLY)
        return out

    def plain(self, hashes: np.ndarray) -> np.ndarray:
        """For every sample, the smallest hash; the weights do not matter."""
        out = np.empty(len(self.plain_factors), np.uint64)
        step = max(1, TOGETHER // len(hashes))
        for at in range(0, len(out), step):
            factors = self.plain_factors[at:at + step]
            numbers, _ = self._memory(len(factors), len(hashes))
            np.multiply(hashes[None, :], factors[:, None], out=numbers).min(axis=1, out=out[at:at + step])
        return out

    def bands(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A hash per band, the number of the band included: BANDS weighted ones, then as many plain ones."""
        rows = np.concatenate([self.sample(hashes, weights), self.plain(hashes)]).reshape(2 * BANDS, ROWS)
        out = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            out = _mixed(out * _MULTIPLY + rows[:, i])
        return out.view(np.int64)


class Vector:
    """Sorted shingles, their weights, and what bounds both similarities from above."""

    def __init__(self, raw: bytes):
        self.shingles, self.weights = from_bytes(raw)
        self.n, self.total = len(self.shingles), self.weights.sum()

    def may_link(self, other: Vector) -> bool:
        """A Jaccard similarity is at most the ratio of the sizes; the margin is for rounding."""
        return max(min(self.n, other.n) / max(self.n, other.n),
                   min(self.total, other.total) / max(self.total, other.total)) >= SIMILARITY - 1e-9

    def links(self, other: Vector) -> bool:
        """Whether the weighted or the plain Jaccard similarity is high enough."""
        if not self.may_link(other):
            return False
        few, many = (self, other) if self.n <= other.n else (other, self)
        at = np.minimum(np.searchsorted(many.shingles, few.shingles), many.n - 1)
        both = np.flatnonzero(many.shingles[at] == few.shingles)
        least = np.minimum(few.weights[both], many.weights[at[both]]).sum()
        weighted = least / (self.total + other.total - least)
        return max(weighted, len(both) / (self.n + other.n - len(both))) >= SIMILARITY


def settled(a: bytes, b: bytes, least: float, most: float) -> bool | None:
    """Whether two contents link, by the factors of common shingles alone; None if that depends on those of the others.

    A negative weight is the number of occurrences of a shingle whose factor is from ``least`` to ``most``. The weighted
    similarity is s / (s + d), s summed over what two contents share and d over what they differ in."""
    few, many = sorted((from_bytes(a), from_bytes(b)), key=lambda v: len(v[0]))
    at = np.minimum(np.searchsorted(many[0], few[0]), len(many[0]) - 1)
    both = np.flatnonzero(many[0][at] == few[0])
    if len(both) / (len(few[0]) + len(many[0]) - len(both)) >= SIMILARITY:
        return True
    shared = np.where(few[1][both] > 0, 1, -1) * np.minimum(np.abs(few[1][both]), np.abs(many[1][at[both]]))
    known, other = (sum(np.maximum(sign * v, 0).sum() for v in (few[1], many[1])) for sign in (1, -1))
    s_known, s_other = (np.maximum(sign * shared, 0).sum() for sign in (1, -1))
    d_known, d_other = known - 2 * s_known, other - 2 * s_other
    highest = (s_known + s_other * most) / max(s_known + s_other * most + d_known + d_other * least, 1e-300)
    lowest = (s_known + s_other * least) / max(s_known + s_other * least + d_known + d_other * most, 1e-300)
    # the margin is for rounding: the weights that decide are singles
    return True if lowest >= SIMILARITY + 1e-5 else False if highest < SIMILARITY - 1e-5 else None


def to_bytes(vector: tuple[np.ndarray, np.ndarray]) -> bytes:
    return vector[0].tobytes() + vector[1].astype("<f4").tobytes()


def from_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, "<f4", n, 8 * n).astype(float)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[str | None]:
    """One text after the other, without a list of all texts of a batch."""
    return (value.as_py() for batch in batches for value in batch.column(column))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """shingle, n (its exact df) of all shingles in two or more documents; of all others df is 1. A row without a
    shingle has the number of documents as n and the sum of all df as ``sums``.

    Tasks hand on sorted counts cut at the borders of hash ranges, one row per range; a range is added up in a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size, documents, sums = [], 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            found, n = np.unique(np.concatenate(pending), return_counts=True)
            pending.clear()
            of = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            ends = [*starts[1:], len(found)]
            for at in range(0, len(starts), SENT_RANGES):
                spans = list(zip(starts[at:at + SENT_RANGES], ends[at:at + SENT_RANGES]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(of[i]) for i, _ in spans], pa.int64()),
                    pa.array([found[i:j].tobytes() for i, j in spans], pa.binary()),
                    pa.array([n[i:j].astype("<u4").tobytes() for i, j in spans], pa.binary()),
                    pa.nulls(len(spans), pa.int64()), pa.nulls(len(spans), pa.int64())], names=names)

        for text in _texts(batches, 0):
            documents += 1
            pending.append(_distinct(shingles(word_hashes(text))))
            size, sums = size + len(pending[-1]), sums + len(pending[-1])
            if size > COUNTED_TOGETHER:
                yield from flush()
                size = 0
        if size:
            yield from flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int64()), *[pa.nulls(1, pa.binary())] * 2, pa.array([documents], pa.int64()),
             pa.array([sums], pa.int64())], names=names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*batch.columns))
        for part, group in groupby(rows, key=lambda row: row[0].as_py()):
            if part < 0:
                totals = [[x[k].as_py() for x in group] for group in [list(group)] for k in (3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.int64()) for x in (None, *map(sum, totals))], names=["shingle", "n", "sums"])
                continue
            hashes, counts = zip(*((x[1].as_buffer(), x[2].as_buffer()) for x in group))
            hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in hashes])
            counts = np.concatenate([np.frombuffer(x, "<u4") for x in counts])
            order = np.argsort(hashes, kind="stable")
            hashes, counts = hashes[order], counts[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            n = np.add.reduceat(counts, first, dtype=np.int64)
            found, n = hashes[first][n >= 2].view(np.int64), n[n >= 2]
            for at in range(0, len(found), SENT_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[at:at + SENT_ROWS]), pa.array(n[at:at + SENT_ROWS]),
                     pa.nulls(len(found[at:at + SENT_ROWS]), pa.int64())], names=["shingle", "n", "sums"])

    names = ["part", "shingles", "counts", "documents", "sums"]
    # small splits are counted together, so that fewer counts of one shingle are shuffled
    texts = docs.select(F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    splits = max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / COUNTED_BYTES))
    bits = max(splits, size // (WORD_BYTES * RANGE)).bit_length()
    counted = texts.coalesce(splits).mapInArrow(count, "part long, shingles binary, counts binary, documents long, sums long")
    return stage(counted.repartition("part").sortWithinPartitions("part").mapInArrow(
        add_up, "shingle long, n long, sums long"), "document-frequencies")


def corpus_weights(docs: DataFrame, frequencies: DataFrame | None = None) -> Weights:
    """The weights by which contents are sampled: of the common shingles, at most COMMON, by their exact df."""
    frequencies = document_frequencies(docs) if frequencies is None else frequencies
    documents, sums = frequencies.filter("shingle IS NULL").agg(F.sum("n"), F.sum("sums")).first()
    if not sums:
        return Weights(np.empty(0, np.uint64), np.empty(0), documents or 0)
    rows = frequencies.filter(F.col("shingle").isNotNull() & (F.col("n") * COMMON >= sums)).select("shingle", "n").collect()
    hashes = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order, df = np.argsort(hashes), np.array([r[1] for r in rows], float)
    least = 1 + IDF_GAIN * math.log(documents / max(sums / COMMON, 1)) / math.log(max(documents, 2))
    return Weights(
        hashes[order], 1 + IDF_GAIN * np.log(documents / df[order]) / math.log(max(documents, 2)), documents, least)


def contents(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, raw (a hash of the text), content (a hash of its words), bands; texts without words have no bands."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(sent.value.rare)
        for batch in batches:
            keys, bands = [], []
            for text in _texts([batch], 2):
                words = word_hashes(text)
                if len(words):
                    keys.append(xxhash.xxh3_128_digest(words.tobytes()))
                    bands.append(sampler.bands(*sent.value.of(words)))
                else:
                    keys.append(b"=" + xxhash.xxh3_128_digest(text) if text else None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "raw", "content", "bands"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), F.col("text").cast("string").alias("text")
    ).mapInArrow(read, "doc_id long, raw long, content binary, bands array<long>")


def _counted(docs: DataFrame, wanted: DataFrame, weights: Weights) -> DataFrame:
    """content, vector of the wanted contents (content, doc_id, raw): the weights of common shingles, and of all others
    the numbers of occurrences, below 0."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in _texts([batch], 1):
                distinct, found = sent.value.of(word_hashes(text))
                out.append(to_bytes((distinct, np.where(sent.value.common(distinct), found, -found / sent.value.rare))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["content", "vector"])

    texts = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("x"), F.col("text").cast("string").alias("text"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("x") == F.col("raw"))
    return texts.join(wanted, same).groupBy("content").agg(F.any_value("text").alias("text")).mapInArrow(
        read, "content binary, vector binary")


def _exact(counted: DataFrame, weights: Weights, frequencies: DataFrame) -> DataFrame:
    """The vectors of ``_counted`` by the exact df of every shingle.

    The common shingles have theirs, the others get them by a join; so no key of the join is in many rows."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents, parts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array(contents, pa.binary()), *map(pa.array, columns)],
                names=["content", "shingle", "key", "weight", "known"])

        for batch in batches:
            for content, vector in zip(batch.column(0).to_pylist(), _texts([batch], 1)):
                distinct, found = from_bytes(vector)
                known = found > 0
                # what is known already is spread over the join by keys that are no shingles
                key = np.where(known, _mixed(distinct ^ np.frombuffer(content, np.uint64, 1)[0]), distinct)
                contents += [content] * len(distinct)
                parts.append((distinct.view(np.int64), key.view(np.int64), np.abs(found), known))
                size += len(distinct)
                if size > SENT_TOGETHER:
                    yield flush()
                    contents, parts, size = [], [], 0
        if size:
            yield flush()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                found = batch.column(1)[i].values
                hashes, weights = (np.asarray(found.field(k)) for k in ("shingle", "weight"))
                hashes = hashes.view(np.uint64)
                order = np.argsort(hashes)
                out.append(to_bytes((hashes[order], weights[order])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["content", "vector"])

    rows = counted.mapInArrow(read, "content binary, shingle long, key long, weight double, known boolean")
    idf = F.lit(1.0) + IDF_GAIN * F.log(F.lit(weights.documents) / F.col("n")) / math.log(max(weights.documents, 2))
    factors = frequencies.filter("shingle IS NOT NULL").select(F.col("shingle").alias("key"), idf.alias("factor"))
    factor = F.when(F.col("known"), 1.0).otherwise(F.coalesce("factor", F.lit(weights.rare)))
    return rows.join(factors, "key", "left").select(
        "content", F.struct("shingle", (F.col("weight") * factor).alias("weight")).alias("s")).groupBy("content").agg(
        F.collect_list("s").alias("found")).mapInArrow(pack, "content binary, vector binary")


def _vectors(docs: DataFrame, wanted: DataFrame, weights: Weights, frequencies: DataFrame) -> DataFrame:
    """content, vector of the wanted contents (content, doc_id, raw), by the exact df of every shingle."""
    return _exact(_counted(docs, wanted, weights), weights, frequencies)


def _verified(pairs: DataFrame, vectors: DataFrame, links=lambda x, y: Vector(x).links(Vector(y))) -> DataFrame:
    """a, b, linked for pairs of contents."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [links(x, y) for x, y in zip(_texts([batch], 2), _texts([batch], 3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    left = vectors.select(F.col("content").alias("a"), F.col("vector").alias("x"))
    right = vectors.select(F.col("content").alias("b"), F.col("vector").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(
        compare, "a binary, b binary, linked boolean")


class _Sets:
    """Disjoint sets of small whole numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.find(i)] = self.find(j)


def _links_inside(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """a, b of the links that join the members of a bucket (bucket, content, label), as far as they are similar.

    Members with one label are linked already. A large bucket is cut into blocks; each task has two of them."""
    sizes = members.join(vectors.select("content", F.octet_length("vector").alias("bytes")), "content").groupBy("bucket").agg(
        F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    rows = members.join(sizes, "bucket").withColumn(
        "own", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "content", "label", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = rows.join(vectors, "content")

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by("content")
        names, own, labels = (group[c].to_pylist() for c in ("content", "own", "label"))
        vectors = [Vector(x.as_py()) for x in group["vector"]]
        sets, out, first = _Sets(len(names)), [], {}
        for i, label in enumerate(labels):
            sets.join(first.setdefault(label, i), i)
        whole = group["low"][0] == group["high"][0]
        for i in range(len(names)):
            for j in range(i):
                if (whole or own[i] != own[j]) and vectors[i].may_link(vectors[j]) and (
                        sets.find(i) != sets.find(j)) and vectors[i].links(vectors[j]):
                    sets.join(i, j)
                    out.append((names[j], names[i]))
        return pa.table({c: pa.array([pair[k] for pair in out], pa.binary()) for k, c in enumerate("ab")})

    return rows.groupBy("bucket", "low", "high").applyInArrow(link, "a binary, b binary")


def links(docs: DataFrame, rows: DataFrame, weights: Weights, frequencies: DataFrame) -> DataFrame:
    """a, b: pairs of contents whose classes are one."""
    with_bands = rows.filter(F.col("bands").isNotNull())
    single = with_bands.groupBy("content").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)), "doc_id", "raw")).alias("first"), F.any_value("bands").alias("bands"))
    single = stage(single.select("content", F.col("first.doc_id").alias("doc_id"), F.col("first.raw").alias("raw"), "bands"), "contents")
    buckets = single.select("content", F.explode("bands").alias("bucket"))
    first = buckets.groupBy("bucket").agg(F.min("content").alias("a"), F.max("content").alias("z")).filter("a <> z").drop("z")
    stars = stage(buckets.join(first, "bucket").select("bucket", "a", F.col("content").alias("b")).filter("a <> b"), "stars")
    pairs = stars.select("a", "b").distinct()
    touched = stars.select(F.col("a").alias("content")).union(stars.select(F.col("b").alias("content"))).distinct()
    counted = stage(_counted(docs, single.select("content", "doc_id", "raw").join(touched, "content"), weights), "counted")
    # most pairs are settled by the common shingles; the others, and buckets that may be open, need the df of every shingle
    least, most = weights.least, weights.rare
    first_look = stage(_verified(pairs, counted, lambda x, y: settled(x, y, least, most)), "settled")
    unsure = first_look.filter("linked IS NULL").select("a", "b")
    loose = stars.join(first_look, ["a", "b"]).groupBy("bucket").agg(
        F.count("*").alias("n"), F.bool_and(F.coalesce("linked", F.lit(False))).alias("closed")).filter("NOT closed AND n > 1")
    wanted = unsure.union(stars.join(loose, "bucket").select("a", "b")).select(
        F.explode(F.array("a", "b")).alias("content")).distinct()
    vectors = stage(_exact(counted.join(wanted, "content"), weights, frequencies), "vectors")
    checked = stage(first_look.filter("linked IS NOT NULL").union(_verified(unsure, vectors)), "checked")
    # buckets with a content that is not like the smallest; equal buckets of several bands are compared once
    marked = stars.join(checked, ["a", "b"])
    open_ = marked.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bool_and("linked").alias("closed"), F.min("a").alias("a"),
        F.bit_xor(F.xxhash64("b")).alias("members")).filter("NOT closed AND n > 1")
    open_ = open_.groupBy("a", "n", "members").agg(F.min("bucket").alias("bucket"))
    chosen = marked.join(open_.select("bucket"), "bucket").select(
        "bucket", F.col("b").alias("content"), F.when(F.col("linked"), F.col("a")).otherwise(F.col("b")).alias("label"))
    chosen = chosen.union(open_.select("bucket", F.col("a").alias("content"), F.col("a").alias("label")))
    return checked.filter("linked").select("a", "b").union(_links_inside(stage(chosen, "open-buckets"), vectors))


def components(edges: DataFrame) -> DataFrame:
    """content, label: the smallest content that links lead to. Contents without links are left out.

    Links have a < b. Each b is first tied to its smallest a alone, and its other a to that one: members of a large
    class share these, so few links are left."""
    edges = stage(edges.select("a", "b").distinct(), "links")
    nearest = edges.groupBy("b").agg(F.min("a").alias("least"))
    tied = edges.join(nearest, "b").filter("a <> least").select("least", "a").distinct()
    edges = nearest.select(F.col("least").alias("a"), "b").union(tied.select(F.col("least"), F.col("a")))
    edges = stage(edges.union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("a").alias("content")).agg(F.min("b").alias("l")).select(
        "content", F.least("content", "l").alias("label")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("content").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("content")).agg(F.min("label").alias("near"))
        passed = labels.join(seen, "content").select("content", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("content").alias("label"), F.col("label").alias("further"))
        labels = stage(passed.join(jump, "label").select(
            "content", "old", F.least("label", "further").alias("label")), "labels")
        if labels.filter("label <> old").isEmpty():
            return labels.select("content", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, raw (xxhash64 of the text), label: one row per document.

    Rows of one class, and no others, have one label; it is missing for a missing or empty text, which is alone."""
    spark = docs.sparkSession
    few = settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(ROWS_AT_ONCE),
                   spark__sql__execution__arrow__maxBytesPerBatch=BYTES_AT_ONCE)
    with passing(spark), few:
        frequencies = document_frequencies(docs)
        weights = corpus_weights(docs, frequencies)
        rows = stage(contents(docs, weights), "samples")
        labels = components(links(docs, rows, weights, frequencies))
        labelled = rows.select("doc_id", "raw", "content").join(labels, "content", "left").withColumn(
            "label", F.coalesce("label", "content"))
        labelled = stage(labelled.select("doc_id", "raw", "label"), "classes", keep=True)
    above = F.lit(2 ** 63 - 1)
    named = labelled.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.min(F.struct(F.coalesce("doc_id", above), "doc_id")).getField("doc_id").alias("class_id"))
    return labelled.join(named, "label").select("doc_id", "class_id", "raw", "label").union(
        labelled.filter(F.col("label").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), "raw", "label"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, one with the smallest doc_id; all columns stay as they are.

    A class is known by its label, as its class_id may be missing or stand for several classes. Of rows with the same
    doc_id and text any one stays."""
    first = F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)), "doc_id", "raw")
    found = near_duplicates(docs).filter(F.col("label").isNotNull()).groupBy("label").agg(F.min(first).alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.raw").alias("__raw"))
    raw, alone = F.xxhash64("text"), F.coalesce(F.col("text").cast("string"), F.lit("")) == ""
    kept = docs.filter(~alone).join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (raw == F.col("__raw")), "left_semi")
    kept = kept.withColumn("__hash", raw).dropDuplicates(["doc_id", "__hash"])   # combined before the shuffle
    return kept.select(*docs.columns).union(docs.filter(alone))
