"""Toxicity: gradient-boosted trees over dense features of the whole text, calibrated by isotonic regression.

Features: densities of a lexicon of words and of word beginnings learned from labelled texts, as written
and after undoing disguises (``1d1ot``, ``i.d.i.o.t``); hits per text and in the densest stretch of
words; hits close to a second-person word and the share of such words; rates of capitals, shouted
words, punctuation, disguised words and drawn-out letters.

Learning uses a sample of about ``sample`` labelled rows, chosen by a hash of the id: its size is a
parameter, so the cost of the fit does not grow with the corpus. Part of it learns the lexicon and trees, the
rest the calibration. Every text is scored, in one pass over the table that carries features only.

Defined results: null and empty texts have all features zero and get the score of such a text. Repeated
labels of a document count once, toxic if any says so; labels without a document teach nothing. If the
sample lacks one of the classes every score is the share of toxic rows (0 without labels). Rows are kept
one for one. Texts are used whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_map, crc_residue, utf8
from ledgerpulse.sources.workspace import materialize

#: Second-person words of the languages at hand.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes "
    "vous votre vos tú ti usted ustedes tus contigo vosotros".encode().split()
)
FEATURES = [
    "words", "word_density", "stem_density", "hidden_density", "hits", "peak", "near_second", "second_density",
    "capitals", "shouted", "exclaims", "questions", "marks", "disguised", "drawn_out",
]
STEM = 5
#: A hit is near a second-person word within so many words; the densest stretch has so many.
NEAR, STRETCH = 4, 40
#: Share of the sample that learns lexicon and trees; the rest calibrates.
FIT_SHARE = 0.7
_UPPER = bytes(range(65, 91))
_MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum())
#: A-Z to a-z, punctuation to blanks.
_PLAIN = bytes(i + 32 if 65 <= i <= 90 else 32 if i in _MARKS else i for i in range(256))
#: The same with look-alikes read as the letters they stand for.
_LOOKS = dict(zip(b"013457@$!|+", b"oieastasiit"))
_HIDDEN = bytes(_LOOKS.get(i, _PLAIN[i]) for i in range(256))
#: Characters put between letters to break a word up.
_BREAKS = b"*._-~^`'"
_DRAWN = re.compile(rb"([A-Za-z])\1\1")
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BEYOND = re.compile(r"[^\x00-\x7f]")
_MIXED = re.compile(rb"[A-Za-z](?:[0-9@$!|+]|[*._~^-][A-Za-z][*._~^-])[A-Za-z]?(?=[A-Za-z*._~^-])")


@dataclass(frozen=True)
class Lexicon:
    """Words and word beginnings that toxic texts hold far more often, lower-cased, in UTF-8."""

    words: frozenset[bytes]
    stems: frozenset[bytes]

    def holds(self, word: bytes) -> bool:
        return word in self.words or word[:STEM] in self.stems


def terms(text: bytes | None) -> set[bytes]:
    """Distinct words (marked ``w``) and beginnings of longer words (marked ``s``) of a text."""
    words = set((text or b"").translate(_PLAIN).split())
    return {b"w" + w for w in words} | {b"s" + w[:STEM] for w in words if len(w) > STEM}


def letter_counts(data: bytes) -> tuple[int, int]:
    """Letters and capitals of any script, each counted once."""
    letters, capitals = (len(data) - len(data.translate(None, some)) for some in (_LETTERS, _UPPER))
    if not data.isascii():
        for c, times in Counter(_BEYOND.findall(data.decode("utf-8", "replace"))).items():
            letters += times * c.isalpha()
            capitals += times * c.isupper()
    return letters, capitals


def features(text: bytes | None, lexicon: Lexicon) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    data = text or b""
    words = data.translate(_PLAIN).split()
    n = max(1, len(words))
    vocabulary, stems = lexicon.words, lexicon.stems
    hits = [i for i, w in enumerate(words) if w in vocabulary or w[:STEM] in stems]
    exact = sum(words[i] in vocabulary for i in hits)
    hidden = [w for w in data.translate(_HIDDEN, _BREAKS).split() if w in vocabulary or w[:STEM] in stems]
    second = sum(map(SECOND_PERSON.__contains__, words))
    near = sum(1 for i in hits if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]))
    peak, first = 0, 0
    for last, at in enumerate(hits):
        while at - hits[first] >= STRETCH:
            first += 1
        peak = max(peak, last - first + 1)
    size = max(1, len(data))
    letters, capitals = letter_counts(data)
    return [
        math.log1p(len(words)), exact / n, (len(hits) - exact) / n, max(0, len(hidden) - len(hits)) / n,
        math.log1p(len(hits)), float(peak), near / n, second / n, capitals / max(1, letters),
        sum(1 for w in data.split() if len(w) > 3 and w.isupper()) / n,
        data.count(b"!") / n, data.count(b"?") / n, (len(data) - len(data.translate(None, _MARKS))) / size,
        len(_MIXED.findall(data)) / n, len(_DRAWN.findall(data)) / n,
    ]


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[Column | str]) -> DataFrame:
    """``keep`` and one column per feature of every text."""
    rows = docs.select(*keep, F.col("text").alias("__text"))
    kept = [f for f in rows.schema if f.name != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"__{f} double" for f in FEATURES])

    def measured(batch: pa.RecordBatch) -> dict:
        found = list(zip(*(features(t, lexicon) for t in utf8(batch.column("__text"))))) or [()] * len(FEATURES)
        return {f.name: batch.column(f.name) for f in kept} | {f"__{f}": list(v) for f, v in zip(FEATURES, found)}

    return arrow_map(rows, measured, schema)


def learn_lexicon(sample: DataFrame, size: int = 300, least: int = 4, odds: float = 3.0) -> Lexicon:
    """Terms in at least ``least`` toxic texts whose log odds against the others reach ``odds``, best ``size``.

    ``sample`` has ``text`` and ``label``. Counts are of texts, summed in each task first.
    """

    def counted(batch: pa.RecordBatch) -> dict:
        toxic, clean = Counter(), Counter()
        for text, label in zip(utf8(batch.column("text")), batch.column("label").to_pylist()):
            (toxic if label else clean).update(terms(text))
        found = list(toxic.keys() | clean.keys())
        return {"term": found, "toxic": [toxic[t] for t in found], "clean": [clean[t] for t in found]}

    counts = arrow_map(sample.select("text", "label"), counted, "term binary, toxic bigint, clean bigint")
    n = sample.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    t_all, c_all = n["toxic"] or 0, n["all"] - (n["toxic"] or 0)
    t, c = F.col("toxic"), F.col("clean")
    log_odds = F.log((t + 0.5) / (t_all - t + 0.5)) - F.log((c + 0.5) / (c_all - c + 0.5))
    best = (
        counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(t >= least).withColumn("odds", log_odds).filter(F.col("odds") >= odds)
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(size).collect()
    )
    found = [bytes(r["term"]) for r in best]
    return Lexicon(frozenset(f[1:] for f in found if f[:1] == b"w"), frozenset(f[1:] for f in found if f[:1] == b"s"))


@dataclass(frozen=True)
class ToxicityModel:
    """A fitted model; without trees every text scores ``base``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float

    def score(self, docs: DataFrame, keep: list[Column | str], out: str = "score") -> DataFrame:
        """``keep`` and ``out``, the score (0 to 1) of every row."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.base).alias(out))
        rows = with_features(docs, self.lexicon, keep)
        names = [c for c in rows.columns if c not in {f"__{f}" for f in FEATURES}]
        scored = self.calibration.transform(_raw(self.trees, rows))
        # Isotonic steps are flat; a trace of the trees' own order keeps texts on one step apart.
        score = F.col("__calibrated") * 0.999 + F.col("__raw") * 0.001
        return scored.select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias(out))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__features").transform(rows)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(_assembled(rows)).withColumn("__raw", vector_to_array("__probability")[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Callable[[str], Column] | None, key: str, sample: int) -> DataFrame:
    """``text``, ``label`` and ``part`` (0 to 1) of about ``sample`` labelled rows.

    The sample's ids are bounded by ``sample``, so they are broadcast to the documents.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
    if usable is not None:
        known = known.filter(usable(key))
    known = materialize(known.groupBy(key).agg(F.max(F.col("toxic").cast("int")).alias("label")), "labels")
    n = known.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000)) / F.lit(1e6)
    chosen = known.filter(place < min(1.0, sample / max(1, n)))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(1_000_000)) / F.lit(1e6)
    return docs.select(key, "text").join(F.broadcast(chosen), key).select("text", "label", part.alias("part"))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Callable[[str], Column] | None = None, key: str = "doc_id",
    sample: int = 20_000, rounds: int = 20, depth: int = 3, seed: int = 3,
) -> ToxicityModel:
    """Learn from labelled rows for which ``usable(key)`` holds."""
    rows = materialize(labelled_sample(docs, labels, usable, key, sample), "sample")
    counts = rows.groupBy(F.col("part") < FIT_SHARE, "label").count().collect()
    n = sum(r["count"] for r in counts)
    base = sum(r["count"] for r in counts if r["label"]) / n if n else 0.0
    if len(counts) < 4:  # a class is missing from one of the parts
        return ToxicityModel(Lexicon(frozenset(), frozenset()), None, None, base)
    learning = rows.filter(F.col("part") < FIT_SHARE)
    lexicon = learn_lexicon(learning)
    measured = materialize(with_features(rows, lexicon, ["label", "part"]), "features")
    booster = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__prediction", maxIter=rounds, maxDepth=depth,
        maxBins=32, seed=seed, cacheNodeIds=False,
    ).setProbabilityCol("__probability").setRawPredictionCol("__raw_prediction")
    trees = booster.fit(_assembled(measured.filter(F.col("part") < FIT_SHARE)).select("__features", "label"))
    apart = _raw(trees, measured.filter(F.col("part") >= FIT_SHARE)).select("__raw", F.col("label").cast("double").alias("label"))
    calibration = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__calibrated").fit(apart)
    return ToxicityModel(lexicon, trees, calibration, base)


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", folds: int = 3, held_fold: int = 1, threshold: float = 0.7
) -> DataFrame:
    """Learn outside the held-out fold (CRC-32 of the id) and score every row."""
    model = fit(docs, labels, lambda c: crc_residue(c, folds) != held_fold, key)
    held = (crc_residue(key, folds) == held_fold).alias("held_out")
    scored = model.score(docs, [key, held])
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
