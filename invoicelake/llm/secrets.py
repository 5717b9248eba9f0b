"""Secrets in whole texts: fixed forms, and strings that a battery of tests takes for random.

Fixed forms: an assignment to a secret's name, a cloud access key, and a long run of hex digits. The battery looks at
all other runs of 20 or more encoding characters: it infers the alphabet, tests uniformity (chi-squared), the number
of runs around the middle of the alphabet and the serial correlation, and combines the three p-values (Fisher) into
one value that is large for strings that look random. Words of letters in one case, of the same corpus, show how often
ordinary strings reach a value: long words as they are, and, at every length, all other words of each text written
together and cut into strings of the least length of the class (the shorter a string, the more random it looks). For the strings
that mix letters and digits this gives p-values, and in each class of length the Benjamini-Hochberg rule picks the
threshold. All strings of the whole corpus are tested; what reaches the driver is one histogram per class of length.

Defined results: a missing or empty text has no spans. Each row gives one row, repeated rows too; a missing doc_id is
kept; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.session import stage

# fixed values: names and forms of secrets
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")
SHORTEST = 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")
LENGTHS = (24, 32, 48, 80)      # borders of the classes of length
SHORTEST_OF_CLASS = (SHORTEST, *LENGTHS)
ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[a-z]+|[A-Z][a-z]*|[A-Z]+)(?![A-Za-z0-9+/_-])")
ORDINARY_TOGETHER = 1 << 18     # letters whose strings are tested at once
BINS = 200
FALSE_SHARE = 0.05


def alphabet_of(text: str) -> str | None:
    """The smallest alphabet that has all characters of the string."""
    used = set(text)
    return next((a for a in ALPHABETS if used <= set(a)), None)


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(text: str) -> float | None:
    """Combined p-value under uniform random characters; None if no alphabet has them all."""
    alphabet = alphabet_of(text)
    if alphabet is None:
        return None
    n, size = len(text), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    codes = np.array([place[c] for c in text])
    counts = np.bincount(codes, minlength=size)
    chi = float((counts * counts).sum()) * size / n - n
    uniform = _tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = codes * 2 >= size
    ups = int(high.sum())
    spread = 2 * ups * (n - ups)
    if spread > n:
        mean = spread / n + 1
        sd = math.sqrt(spread * (spread - n) / (n * n * (n - 1)))
        runs = 2 * _tail(abs(int((high[1:] != high[:-1]).sum()) + 1 - mean) / sd)
    else:
        runs = 2.0 ** (1 - n)
    centred = codes - codes.mean()
    power = float((centred * centred).sum())
    serial = 2 * _tail(abs(float((centred[1:] * centred[:-1]).sum()) / power) * math.sqrt(n)) if power else 0.0
    half = -sum(math.log(max(min(p, 1.0), 1e-300)) for p in (uniform, runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def fixed_spans(text: str, long_tokens: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """start, kind, end of the fixed forms; the last two lie inside the long tokens."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for at, token in long_tokens:
        if "AKIA" in token:
            found += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(token)]
        found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(token)]
    return sorted(found)


def long_tokens(text: str) -> list[tuple[int, str]]:
    out, at = [], 0
    for token in text.split():
        if len(token) >= SHORTEST:
            at = text.index(token, at)
            out.append((at, token))
            at += len(token)
    return out


def candidates(tokens: list[tuple[int, str]], fixed: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """start, end, class of length, bin of the combined p-value, whether it is tested (else: an ordinary word)."""
    for at, token in tokens:
        for m in CANDIDATE.finditer(token):
            begin, end = at + m.start(), at + m.end()
            if any(s < end and begin < e for s, _, e in fixed):
                continue
            text = m[0]
            digit, upper, lower = (re.search(p, text) is not None for p in ("[0-9]", "[A-Z]", "[a-z]"))
            tested = digit and (upper or lower)
            if not tested and not (text.isalpha() and (text.islower() or text.isupper() or text.istitle())):
                continue
            value = randomness(text if tested else text.lower())
            if value is not None:
                yield begin, end, bisect_right(LENGTHS, end - begin), min(int(value * BINS), BINS - 1), tested


def joined_words(text: str) -> str:
    """All words of the text in lower case, written together; long ones are among the ``candidates``."""
    return "".join(w for w in ORDINARY.findall(text) if len(w) < SHORTEST).lower()


def _tails(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.fromiter(map(math.erfc, (z / math.sqrt(2)).tolist()), np.float64, len(z))


def word_values(strings: np.ndarray) -> np.ndarray:
    """``randomness`` of many strings of a to z and of one length at once: a row of codes 0 to 25 each."""
    rows, n = strings.shape
    codes = strings.astype(np.int32)
    few = strings.max(axis=1) < 6       # a to f alone: the last six of the hex digits, all in the upper half
    size = np.where(few, 16, 26)
    counts = np.bincount((codes + 26 * np.arange(rows)[:, None]).ravel(), minlength=26 * rows).reshape(rows, 26)
    chi = np.einsum("ij,ij->i", counts, counts) * size / n - n
    uniform = _tails((chi - (size - 1)) / np.sqrt(2 * (size - 1) * (n - 1) / n))
    high = strings >= 13
    ups = np.where(few, n, np.count_nonzero(high, axis=1))
    spread = 2 * ups * (n - ups)
    mixed = spread > n
    wide = np.where(mixed, spread, 2 * n)
    sd = np.sqrt(wide * (wide - n) / (n * n * (n - 1)))
    changes = np.count_nonzero(high[:, 1:] != high[:, :-1], axis=1)
    runs = np.where(mixed, 2 * _tails(np.abs(changes + 1 - (wide / n + 1)) / sd), 2.0 ** (1 - n))
    # sums of squares and of neighbours' products around the mean, both in whole numbers
    total = codes.sum(axis=1, dtype=np.int64)
    power = n * (n * np.einsum("ij,ij->i", codes, codes).astype(np.int64) - total * total)
    beside = np.einsum("ij,ij->i", codes[:, 1:], codes[:, :-1]).astype(np.int64)
    together = n * n * beside - n * total * (2 * total - codes[:, 0] - codes[:, -1]) + (n - 1) * total * total
    serial = np.where(power > 0, 2 * _tails(np.abs(together) / np.maximum(power, 1) * math.sqrt(n)), 0.0)
    half = -sum(np.log(np.clip(p, 1e-300, 1.0)) for p in (uniform, runs, serial))
    return np.exp(-half) * (1 + half + half * half / 2)


def ordinary_counts(texts: list[str]) -> np.ndarray:
    """Strings of ordinary words per class of length and bin. Each text's words are cut into strings from their first
    letter on, once for every class; a rest shorter than the class is none."""
    out = np.zeros((len(SHORTEST_OF_CLASS), BINS), np.int64)
    waiting: list[list[bytes]] = [[] for _ in SHORTEST_OF_CLASS]
    letters = 0

    def test() -> None:
        for stratum, length in enumerate(SHORTEST_OF_CLASS):
            codes = np.frombuffer(b"".join(waiting[stratum]), np.uint8).reshape(-1, length) - ord("a")
            waiting[stratum].clear()
            if len(codes):
                bins = np.minimum((word_values(codes) * BINS).astype(np.int64), BINS - 1)
                out[stratum] += np.bincount(bins, minlength=BINS)

    for text in texts:
        joined = joined_words(text).encode()
        for begin in range(0, len(joined), 240 * (ORDINARY_TOGETHER // 240)):     # 240: every length divides it
            part = joined[begin:begin + 240 * (ORDINARY_TOGETHER // 240)]
            for stratum, length in enumerate(SHORTEST_OF_CLASS):
                waiting[stratum].append(part[:len(part) // length * length])
            letters += len(part)
            if letters >= ORDINARY_TOGETHER:
                test()
                letters = 0
    test()
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the fixed spans with their digest columns, the candidates of the battery, and with the first row of a batch
    how often the batch's ordinary strings reach each value."""
    kinds = ("assign", "access", "hex")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        candidate = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.int32()),
                                        ("bin", pa.int32()), ("tested", pa.bool_())]))
        word = pa.list_(pa.struct([("stratum", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, digests, spans, tested = [], [], [], []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            reached = ordinary_counts(texts)
            words = [[{"stratum": s, "bin": b, "n": reached[s, b]} for s, b in np.argwhere(reached).tolist()]]
            for text in texts:
                tokens = long_tokens(text)
                fixed = fixed_spans(text, tokens)
                counts.append([sum(k == i for _, k, _ in fixed) for i in range(3)])
                joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in fixed)
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in fixed])
                tested.append([dict(zip(("start", "end", "stratum", "bin", "tested"), c))
                               for c in candidates(tokens, fixed)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)],
                 pa.array(digests, pa.string()), pa.array(spans, span), pa.array(tested, candidate),
                 pa.array(words + [[]] * (batch.num_rows - 1), word)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "fixed", "candidates", "words"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        read, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "fixed array<struct<start: long, kind: int, end: long>>, "
        "candidates array<struct<start: long, end: long, stratum: int, bin: int, tested: boolean>>, "
        "words array<struct<stratum: int, bin: int, n: long>>")


def thresholds(histogram: list[tuple[int, int, bool, int]], false_share: float = FALSE_SHARE) -> dict[int, int]:
    """The least bin that counts as random, by class of length; classes without one are left out.

    ``histogram``: stratum, bin, tested, count.
    """
    out = {}
    for stratum in sorted({row[0] for row in histogram}):
        tests, words = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for s, b, tested, n in histogram:
            if tested and s == stratum:
                tests[b] += n
            if not tested and s == stratum:
                words[b] += n
        passed = np.cumsum(tests[::-1])[::-1]
        p = (1 + np.cumsum(words[::-1])[::-1]) / (1 + words.sum())
        if tests.sum():
            good = np.flatnonzero((p <= false_share * passed / tests.sum()) & (passed > 0))
            if len(good):
                out[stratum] = int(good[0])
    return out


def find_secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end by start, then kind, comma-joined)."""
    scanned = stage(scan(docs), "secrets")
    one = F.lit(1).cast("long")
    histogram = scanned.select(F.inline("candidates")).select("stratum", "bin", "tested", one.alias("n")).unionByName(
        scanned.select(F.inline("words")).withColumn("tested", F.lit(False))
    ).groupBy("stratum", "bin", "tested").agg(F.sum("n"))
    limits = thresholds([tuple(r) for r in histogram.collect()], false_share)
    least = F.lit(BINS)
    random = lambda c: F.lit(False)
    if limits:
        table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        random = lambda c: c["tested"] & (c["bin"] >= F.coalesce(F.try_element_at(table, c["stratum"]), least))
    added = F.transform(F.filter("candidates", random), lambda c: F.struct(
        c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat("fixed", added)), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                          F.array_join(spans, ",").alias("spans"))
