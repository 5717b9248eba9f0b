"""Personal data in whole texts: fixed forms, and further spans that boosted trees pick from many candidates.

Fixed forms (e-mail, IP, card and phone numbers with their validity rules) are found first. Generators with a high
recall then propose spans of digits, of words around an at sign and of account codes; their spans may overlap. Trees
see the format and the words before a candidate, not the rules of the fixed forms, and learn which candidates meet a
valid one; what they learn from is a bounded sample (``TRAIN_CANDIDATES``). On candidates they have not seen, the
lowest score from which at least ``PRECISION`` are right is the threshold; candidates above it are added under the
kind ``other`` where no fixed form lies. All steps are DataFrame expressions and Spark's own trees.

Defined results: a missing or empty text has no spans. Each row gives one row, repeated rows too; a missing doc_id is
kept; other columns are ignored. Where the candidates do not hold both right and wrong ones, nothing is added. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.session import stage

KINDS = ("email", "ip", "card", "phone", "other")
# fixed values: the forms. A match starts where a run of its first characters starts or the last match ended, which
# changes no match and keeps long runs linear; possessive marks stand where giving back could not help.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# generators
DIGITS = r"\+?[0-9(][0-9\x20().:/-]{5,40}+"
AT_WORDS = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[(]at[\])])\x20?[A-Za-z0-9.-]{1,64}+"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+"
CUES = r"(?i)\b(?:mail|e-mail|contact|call|phone|tel|fax|mobile|card|visa|account|iban|ip|host|address|ssn|id)\b"
BEFORE = 24

FEATURES = ("length", "digits", "digit_share", "letters", "dots", "dashes", "spaces", "at", "plus", "brackets",
            "groups", "cue", "word_before", "line_start", "generator")
TRAIN_CANDIDATES = 20_000
ROUNDS = 15
DEPTH = 4
PRECISION = 0.95
BINS = 200
STRETCH = 128         # matches of a text whose positions are counted together

SPAN = "array<struct<start:bigint,end:bigint,m:string>>"


def _matches(df: DataFrame, name: str, pattern: str, gate: Column) -> DataFrame:
    """Column ``name``: start, end (code points) and text of the matches, leftmost and not overlapping.

    Spark gives the matches and what lies between them; their lengths give the positions."""
    found, between = f"__{name}_found", f"__{name}_between"
    df = df.withColumn(found, F.when(gate, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn(between, F.when(F.size(found) > 0, F.split("text", pattern, -1)))
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, m: F.struct(
        F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("n"), m.alias("m")))
    # An array that grows in an aggregate is copied at every step. Positions are therefore counted within stretches of
    # STRETCH matches, and then those of the stretches.
    last = F.floor((F.size(found) - 1) / STRETCH).cast("int")
    stretches, local, starts = f"__{name}_stretches", f"__{name}_local", f"__{name}_starts"
    df = df.withColumn(found, F.when(F.size(found) > 0, pairs)).drop(between)
    df = df.withColumn(stretches, F.when(F.col(found).isNotNull(), F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(found, i * STRETCH + 1, STRETCH))))
    df = df.withColumn(local, F.transform(stretches, lambda stretch: F.aggregate(
        stretch, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + p["gap"] + p["n"]).alias("at"),
            F.concat(a["spans"], F.array(F.struct(
                (a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + p["n"]).alias("end"),
                p["m"].alias("m")))).alias("spans"))))).drop(found, stretches)
    df = df.withColumn(starts, F.aggregate(
        local, F.array(F.lit(0).cast("long")), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s["at"]))))
    grown = F.flatten(F.zip_with(local, F.slice(starts, 1, F.size(local)), lambda s, at: F.transform(
        s["spans"], lambda x: F.struct(
            (x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["m"].alias("m")))))
    return df.withColumn(name, F.when(F.size(local) > 0, grown).otherwise(F.array().cast(SPAN))).drop(local, starts)


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def part(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when(i % 2 == 1, d).when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(IP_PARTS)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def _candidate(span: Column, generator: int, text: Column, base: Column) -> Column:
    """start, end, whether it meets a fixed form (right), and its features."""
    m = F.trim(span["m"])
    before = F.substring(text, F.greatest(F.lit(1), span["start"] - BEFORE + 1).cast("int"),
                         F.least(F.lit(BEFORE), span["start"]).cast("int"))
    n = F.length(m).cast("double")
    digits = _count(m, "[0-9]")
    values = [
        n, digits, digits / F.greatest(n, F.lit(1.0)), _count(m, "[A-Za-z]"), _count(m, "[.]"), _count(m, "-"),
        _count(m, " "), _count(m, "@"), _count(m, "[+]"), _count(m, "[()]"),
        F.size(F.split(m, "[^0-9]+")).cast("double"), before.rlike(CUES).cast("double"),
        before.rlike("[A-Za-z] ?$").cast("double"), before.rlike("(?:^|\n) *$").cast("double"),
        F.lit(float(generator))]
    end = span["start"] + F.length(F.rtrim(span["m"]))
    return F.struct(
        span["start"].alias("start"), end.alias("end"),
        F.exists(base, lambda b: (b["start"] < end) & (span["start"] < b["end"])).alias("right"),
        F.array(*values).alias("features"))


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (kind, start, end by kind, then start) and candidates."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scan_texts(df.withColumn("row", F.monotonically_increasing_id()))


def scan_texts(df: DataFrame) -> DataFrame:
    df = df.withColumn("__digit", F.coalesce(F.col("text").rlike("[0-9]"), F.lit(False)))
    has = lambda c: F.coalesce(F.contains(F.col("text"), F.lit(c)), F.lit(False))
    forms = (("email", EMAIL, has("@")), ("ip", IP, F.col("__digit")), ("card", CARD, F.col("__digit")),
             ("phone", PHONE, has("+") & F.col("__digit")))
    makers = (("g0", DIGITS, F.col("__digit")), ("g1", AT_WORDS, has("@") | has("at)") | has("at]")),
              ("g2", ACCOUNT, F.col("__digit")))
    for name, pattern, gate in (*forms, *makers):
        df = _matches(df, name, pattern, gate)

    def valid_ones(number: int, name: str) -> Column:
        return F.transform(F.filter(name, lambda s: _valid(name, s["m"])), lambda s: F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def proposed(number: int, name: str) -> Column:
        return F.transform(name, lambda s: _candidate(s, number, F.col("text"), F.col("base")))

    df = df.withColumn("base", F.concat(*[valid_ones(i, f[0]) for i, f in enumerate(forms)]))
    return df.select("row", "doc_id", "base", F.concat(
        *[proposed(i, m[0]) for i, m in enumerate(makers)]).alias("candidates"))


def score_candidates(scanned: DataFrame) -> DataFrame | None:
    """row, start, end of the candidates to add; None where there is nothing to learn from."""
    every = scanned.select("row", F.explode("candidates").alias("c")).select(
        "row", "c.start", "c.end", "c.right", *[F.col("c.features")[i].alias(f) for i, f in enumerate(FEATURES)])
    every = every.withColumn("draw", F.pmod(F.xxhash64("row", "start", "generator"), F.lit(1_000_000)) / 1_000_000)
    n, right = every.agg(F.count("*"), F.count_if("right")).first()
    share = min(1.0, TRAIN_CANDIDATES / max(1, n))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    learnt = every.filter(F.col("draw") < share * 2 / 3).withColumn("label", F.col("right").cast("double"))
    learnt = stage(learnt.select("label", *FEATURES).coalesce(4), "pii-sample")
    sides = {r[0] for r in learnt.select("label").distinct().collect()}
    if len(sides) < 2:
        return None
    trees = GBTClassifier(featuresCol="vector", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=32, seed=7, cacheNodeIds=False)
    model = trees.fit(vectors.transform(learnt))
    score = (vector_to_array("probability")[1] * BINS).cast("int").alias("bin")
    scored = model.transform(vectors.transform(every.filter(~F.col("right") | (F.col("draw") >= share * 2 / 3)))).select(
        "row", "start", "end", "right", "draw", score)
    unseen = scored.filter(F.col("draw") >= share * 2 / 3).groupBy("bin").agg(
        F.count("*").alias("n"), F.count_if("right").alias("k")).collect()      # at most BINS + 1 rows
    least, total, hits = None, 0, 0
    for row in sorted(unseen, reverse=True):
        total, hits = total + row["n"], hits + row["k"]
        if hits >= PRECISION * total:
            least = row["bin"]
    if least is None:
        return None
    return scored.filter(~F.col("right") & (F.col("bin") >= least)).select("row", "start", "end").distinct()


def find_spans(scanned: DataFrame) -> DataFrame:
    """row, doc_id, base and all spans (by kind, then start)."""
    added = score_candidates(scanned)
    rows = scanned.select("row", "doc_id", "base")
    if added is None:
        return rows.withColumn("spans", F.col("base"))
    more = added.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        F.lit(4).alias("kind"), "start", "end"))).alias("more"))      # candidates of one document
    return rows.join(more, "row", "left").withColumn(
        "spans", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))).drop("more")


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end by kind, then start)."""
    found = find_spans(stage(scan(docs), "pii"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *[count(k) for k in range(4)], F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars, if there, is the new length.

    The spans are kept per document and text, so rows with equal text share them."""
    key = lambda: F.sha2(F.col("text").cast("string"), 256)
    texts = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key().alias("row"))
    scanned = stage(scan_texts(texts.filter(F.col("text").isNotNull())), "pii")
    found = find_spans(scanned).filter(F.size("spans") > 0).groupBy("row").agg(
        F.any_value("spans").alias("__spans")).withColumnRenamed("row", "__row")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("text")
    # one pass from left to right; what overlaps an earlier span is cut off with it
    built = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.element_at(names, s["kind"] + 1))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    out = docs.withColumn("__key", key()).join(found, F.col("__key") == F.col("__row"), "left").withColumn(
        "text", F.when(F.col("__spans").isNull(), text).otherwise(built))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
