"""Language identification by hierarchical discrimination.

Texts become unit vectors of hashed byte trigrams of the whole lower-cased text. Families of languages are those whose
mean vectors are closer than the average pair's. One linear machine per family against the others finds the family;
inside it, one-versus-one linear support vector machines vote. Every machine is fitted in a task of its own on a
bounded sample of labelled documents (``SAMPLE_PER_LANGUAGE`` each, those with the smallest hash of doc_id).

Defined results: a missing text, and one without a letter, is ``und`` with score 0. Documents whose
crc32(doc_id) mod 3 is 1 are held out: nothing is learnt from them; a missing doc_id is not held out, but nothing is
learnt from it either. Without a labelled document every text is ``und``. Repeated rows give the same row each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.session import stage

DIMENSIONS = 2048
SAMPLE_PER_LANGUAGE = 300
ROUNDS = 200
UNDETERMINED = "und"
MULTIPLIERS = np.array([257, 7919, 40503], np.uint16)      # of the three bytes of a trigram
PART = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    """Square roots of the trigram counts, as a unit vector."""
    counts = np.zeros(DIMENSIONS)
    for at in range(0, len(text), PART):
        raw = np.frombuffer(f" {text[max(0, at - 2):at + PART].lower()} ".encode(), np.uint8).astype(np.uint16)
        h = raw[:-2] * MULTIPLIERS[0] + raw[1:-1] * MULTIPLIERS[1] + raw[2:] * MULTIPLIERS[2]
        counts += np.bincount((h ^ (h >> 7)) & (DIMENSIONS - 1), minlength=DIMENSIONS)
    found = np.sqrt(counts)
    return found / np.linalg.norm(found)


def linear_machine(x: np.ndarray, y: np.ndarray, decay: float = 1e-4, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and bias with the least squared hinge loss, by accelerated gradient steps; both classes weigh the same.

    The last column of ``x`` is 1."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    step = 1 / (4 + decay)
    w = ahead = np.zeros(x.shape[1])
    for i in range(rounds):
        slope = -2 * (x.T @ (weight * y * np.maximum(0, 1 - y * (x @ ahead)))) + decay * ahead
        new = ahead - step * slope
        w, ahead = new, new + i / (i + 3) * (new - w)
    return w


def stacked(vectors: Sequence[bytes]) -> np.ndarray:
    """Stored vectors as rows, and a 1 behind each. They are widened in their place: a second copy of the largest group
    would be what an executor's memory is taken for."""
    x = np.ones((len(vectors), DIMENSIONS + 1))
    for row, raw in zip(x, vectors):
        row[:-1] = np.frombuffer(raw, "<f4")
    return x


def families_of(names: list[str], centres: np.ndarray) -> list[list[str]]:
    """Languages linked by a similarity above the average of all pairs."""
    unit = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    close = unit @ unit.T
    pairs = list(combinations(range(len(names)), 2))
    border = np.mean([close[p] for p in pairs]) if pairs else 0
    family = list(range(len(names)))
    for a, b in pairs:
        if close[a, b] > border:
            family = [family[a] if f == family[b] else f for f in family]
    return [[n for n, f in zip(names, family) if f == g] for g in sorted(set(family))]


class Model:
    """Families and the machines that tell them, and their languages, apart."""

    def __init__(self, families: list[list[str]], machines: dict[str, np.ndarray]):
        self.families = families
        self.first = np.array([machines[f"family {i}"] for i in range(len(families))]) if len(families) > 1 else None
        self.pairs = {(a, b): machines[f"{a} {b}"] for f in families for a, b in combinations(f, 2)}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = np.append(features(text), 1.0)
        family, score = self.families[0], 1.0
        if self.first is not None:
            margins = np.clip(8 * (self.first @ x), -50, 50)
            shares = np.exp(margins - margins.max())
            family, score = self.families[int(margins.argmax())], float(shares.max() / shares.sum())
        if len(family) == 1:
            return family[0], score
        won = dict.fromkeys(family, 0.0)
        for a, b in combinations(family, 2):
            p = 1 / (1 + np.exp(-np.clip(8 * float(self.pairs[a, b] @ x), -50, 50)))
            won[a] += p
            won[b] += 1 - p
        best = max(family, key=lambda name: (won[name], name))
        return best, score * won[best] / (len(family) - 1)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learns from documents that have a doc_id and a language and are not held out."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                        & (F.col("text") != "") & ~held_out())
    known = known.select("lang", "text", F.xxhash64("doc_id", "lang").alias("order"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}     # one row per language
    if not sizes:
        return Model([], {})
    # twice the wanted share passes a filter on the hash; the few that remain are ranked
    border = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (
        lang, int(min(1.0, 2 * per_language / n + 20 / n) * 2 ** 62))])
    few = known.filter(F.col("order").bitwiseAND(2 ** 62 - 1) <= F.element_at(border, F.col("lang")))
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", F.xxhash64("text"))))
    few = few.filter(F.col("rank") <= per_language).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, features(text).astype("<f4").tobytes())
                    for lang, text in zip(*[c.to_pylist() for c in batch.columns]) if has_letter(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary()))],
                names=["lang", "vector"])

    sample = stage(few.mapInArrow(vectors, "lang string, vector binary"), "language-sample")

    def centre(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "vector": [stacked(group["vector"]).mean(axis=0)[:-1].tobytes()]})

    centres = sorted(tuple(r) for r in sample.groupBy("lang").applyInPandas(
        centre, "lang string, vector binary").collect())
    names = [c[0] for c in centres]
    if not names:
        return Model([], {})
    families = families_of(names, np.array([np.frombuffer(c[1]) for c in centres]))
    sides = [(f"family {i}", lang, 1 if lang in family else -1)
             for i, family in enumerate(families) for lang in names if len(families) > 1]
    sides += [(f"{a} {b}", lang, y) for f in families for a, b in combinations(f, 2) for lang, y in ((a, 1), (b, -1))]
    if not sides:
        return Model(families, {})

    def machine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "vector"])
        w = linear_machine(stacked(group["vector"]), group["y"].to_numpy(float))
        return pd.DataFrame({"machine": group["machine"].iloc[:1], "w": [w.tobytes()]})

    plan = sample.sparkSession.createDataFrame(sides, "machine string, lang string, y int")
    fitted = sample.join(F.broadcast(plan), "lang").groupBy("machine").applyInPandas(machine, "machine string, w binary")
    return Model(families, {r[0]: np.frombuffer(r[1]) for r in fitted.collect()})


def texts(column: pa.Array) -> Iterator[str | None]:
    """One text after the other, without a list of them all."""
    return (value.as_py() for value in column)


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predictions(docs, fit(docs))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are written in a language; all columns stay as they are."""
    model = fit(docs)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(
                [model.predict(t)[0] != UNDETERMINED for t in texts(batch.column(place))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
