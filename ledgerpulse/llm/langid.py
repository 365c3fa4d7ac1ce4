"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone. A trigram binds its
letters: their vectors, permuted (rotated) by place, are multiplied. A text bundles its trigrams: the vectors
are added, once per occurrence. A language's prototype bundles the unit profiles of its training
texts, and a text belongs to the prototype with the largest cosine.

Letters are Unicode letters in lower case; anything between them counts as one blank, which is a letter here
so that word ends matter. Trigram vectors are made when first met and kept in a table of bounded size
per task. Prototypes, a row of ``dims`` numbers per language, are summed by Spark from one partial sum per
batch and language; only the finished rows reach the driver. Languages must be few.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing could be learned. Ties go to the language that sorts first. Rows are kept one for one; a null
language teaches nothing. Texts are used whole, in spans of bounded size. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_map, crc_residue, mix64

UNKNOWN = "und"
BLANK = 32
#: Trigram vectors that a task keeps before it starts afresh (one byte per dimension each).
KEPT = 1 << 15
#: Characters of a text that are turned into trigrams at once.
_SPAN = 1 << 18

_alphabet: np.ndarray | None = None
_tables: dict[tuple[int, int], Profiles] = {}


def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter; made once per process."""
    global _alphabet
    if _alphabet is None:
        surrogate = range(0xD800, 0xE000)
        _alphabet = np.fromiter((i not in surrogate and chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _alphabet


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text, 21 bits per letter, and how often each occurs; empty without a letter."""
    found: dict[str, list] = {"codes": [], "counts": []}
    text = text or ""
    tail = np.array([BLANK], dtype=np.uint64)
    for at in range(0, len(text), _SPAN):
        points = np.frombuffer(text[at : at + _SPAN].lower().encode("utf-32-le", "replace"), np.uint32)
        points = np.where(_is_letter()[points], points, BLANK).astype(np.uint64)
        line = np.concatenate([tail, points, *([[np.uint64(BLANK)]] if at + _SPAN >= len(text) else [])])
        # Of a run of blanks the first stays; a blank that opens the span stays unless the tail ends in one.
        line = np.delete(line, 1 + np.flatnonzero((line[1:] == BLANK) & (line[:-1] == BLANK)))
        tail = line[-2:]
        if len(line) >= 3:
            codes = (line[:-2] << np.uint64(42)) | (line[1:-1] << np.uint64(21)) | line[2:]
            codes, counts = np.unique(codes, return_counts=True)
            found["codes"].append(codes)
            found["counts"].append(counts)
    if not found["codes"]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(found["codes"]) == 1:
        return found["codes"][0], found["counts"][0]
    codes, where = np.unique(np.concatenate(found["codes"]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate(found["counts"])).astype(np.int64)


class Profiles:
    """Vectors of letters and trigrams, and the bundles of texts."""

    def __init__(self, dims: int, seed: int) -> None:
        self.dims, self.seed = dims, seed
        self._letters: dict[int, np.ndarray] = {}
        self._rows: dict[int, int] = {}
        self._table = np.zeros((0, dims), np.int8)

    @staticmethod
    def of(dims: int, seed: int) -> Profiles:
        """The one of this process, so that batches share its table."""
        return _tables.setdefault((dims, seed), Profiles(dims, seed))

    def letter(self, point: int) -> np.ndarray:
        """The +1/-1 vector of a code point: bits of a mixed counter."""
        if point not in self._letters:
            words = -(-self.dims // 64)
            start = np.uint64((point << 20 ^ self.seed * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
            bits = np.unpackbits(mix64(mix64(np.arange(words, dtype=np.uint64) + start)).view(np.uint8))[: self.dims]
            self._letters[point] = bits.astype(np.int8) * 2 - 1
        return self._letters[point]

    def trigram(self, code: int) -> np.ndarray:
        """Letters bound in order: the first rotated by two places, the second by one."""
        a, b, c = (self.letter(code >> shift & 0x1FFFFF) for shift in (42, 21, 0))
        return np.roll(a, 2) * np.roll(b, 1) * c

    def _places(self, codes: list[int]) -> list[int]:
        if len(self._rows) + len(codes) > KEPT:
            self._rows.clear()
        missing = [c for c in codes if c not in self._rows]
        for c in missing:
            self._rows[c] = len(self._rows)
        if len(self._rows) > len(self._table):
            room = np.zeros((max(len(self._rows), min(KEPT, 2 * len(self._table))), self.dims), np.int8)
            room[: len(self._table)] = self._table
            self._table = room
        for c in missing:
            self._table[self._rows[c]] = self.trigram(c)
        return [self._rows[c] for c in codes]

    def bundle(self, text: str | None) -> np.ndarray | None:
        """Sum of the vectors of all trigrams of the text, each as often as it occurs."""
        codes, counts = trigrams(text)
        if not len(codes):
            return None
        out = np.zeros(self.dims, np.float64)
        for at in range(0, len(codes), 4096):
            places = self._places(codes[at : at + 4096].tolist())
            out += counts[at : at + 4096].astype(np.float32) @ self._table[places].astype(np.float32)
        return out

    def unit(self, text: str | None) -> np.ndarray | None:
        v = self.bundle(text)
        n = 0.0 if v is None else float(np.linalg.norm(v))
        return v / n if n else None


def learn(docs: DataFrame, dims: int = 1024, seed: int = 5) -> dict[str, np.ndarray]:
    """Unit prototypes by language, from all rows with text and ``lang``."""

    def partial(batch: pa.RecordBatch) -> dict:
        profiles = Profiles.of(dims, seed)
        sums: dict[str, np.ndarray] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            v = profiles.unit(text)
            if v is not None:
                sums[lang] = sums.get(lang, 0) + v
        return {"lang": list(sums), "profile": [list(v) for v in sums.values()]}

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    parts = arrow_map(known, partial, "lang string, profile array<double>")
    # One row per language and dimension after map-side sums, so the last grouping is of `dims` rows a language.
    rows = (
        parts.select("lang", F.posexplode("profile").alias("place", "value"))
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("profile"))
        .select("lang", F.transform("profile", lambda x: x["value"]).alias("profile"))
        .collect()
    )
    out = {}
    for row in sorted(rows, key=lambda r: r["lang"]):
        v = np.array(row["profile"])
        n = float(np.linalg.norm(v))
        if n:
            out[row["lang"]] = v / n
    return out


def scorer(prototypes: dict[str, np.ndarray], dims: int, seed: int) -> Callable[[str | None], tuple[str, float]]:
    """Language and cosine (not below 0) of a text."""
    langs = sorted(prototypes)
    matrix = np.array([prototypes[x] for x in langs]).reshape(len(langs), dims)

    def score(text: str | None) -> tuple[str, float]:
        v = Profiles.of(dims, seed).unit(text) if langs else None
        if v is None:
            return UNKNOWN, 0.0
        cosines = matrix @ v
        best = int(np.argmax(cosines))
        return langs[best], float(min(1.0, max(0.0, cosines[best])))

    return score


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[Column | str], dims: int = 1024, seed: int = 5) -> DataFrame:
    """``keep`` and ``lang_pred``, ``score`` of every row; reads the text alone."""
    rows = docs.select(*keep, F.col("text").alias("__text"))
    kept = [f for f in rows.schema if f.name != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string, score double"])

    def judged(batch: pa.RecordBatch) -> dict:
        score = scorer(prototypes, dims, seed)
        found = [score(text) for text in batch.column("__text").to_pylist()]
        own = {f.name: batch.column(f.name) for f in kept}
        return own | {"lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    return arrow_map(rows, judged, schema)


def identify(docs: DataFrame, key: str = "doc_id", folds: int = 4, held_fold: int = 2, dims: int = 1024, seed: int = 5) -> DataFrame:
    """Learn outside the held-out fold (CRC-32 of the id) and predict every row."""
    held = crc_residue(key, folds) == held_fold
    prototypes = learn(docs.filter(~held), dims, seed)
    return predict(docs, prototypes, [key, held.alias("held_out")], dims, seed)
