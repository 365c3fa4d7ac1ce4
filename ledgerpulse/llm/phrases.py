"""Phrase collocations by partitioned mining: local support first, then one exact count of all candidates.

Before that all phrases are counted by the bucket their hash falls into. A bucket holds the occurrences of all its phrases, so none of a bucket
below the support can reach it, and shards report phrases of the other buckets only. In a large table a shard's share of the support
falls to one; without the buckets it would then report all its phrases.

A shard is a run of documents of one task, at most `SHARD_WORDS` words. Of a phrase that occurs ``support`` times
in a language, some shard holds at least its share of them: ``support * (words of the shard) / (words of the
language)``. Every shard is mined completely at that lowered support, level by level: a phrase can only be frequent if
the phrases without its last and without its first word are. A shard that does not report a phrase holds fewer than its
lowered support. What the shards report and what the others may hold add up to a bound; phrases whose bound
reaches the support are the candidates, and any phrase with enough occurrences is among them. A second pass counts all of them everywhere:
membership is asked of a Bloom filter over the candidates, which is at most `MEMBER_BITS` large. What it
lets through by chance it lets through in every shard alike, so counts are exact for those too and the
support decides. With a phrase that has enough occurrences all its parts are candidates, so this pass goes level by level as well.

Texts are stored by language first, so that shards are of one language as far as may be. Shards count in arrays of word numbers; only distinct phrases with their counts are shuffled, and are summed before.

Defined results: a null text counts as the empty text, a null language is ``und``. Languages must be few; their word
counts come to the driver. Repeated rows count as often as they are there. Phrases that tie for the last
place are told apart by the order of the contract, which ends with the phrase. Columns other than the text and
the language are not read. An empty table, or one in which nothing is frequent, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm import bloom
from ledgerpulse.llm.common import _steps, arrow_schema, keyed_join, mix64, utf8
from ledgerpulse.sources.workspace import drop_stored, materialize, sweep

#: Words of the longest phrase.
LONGEST = 5
#: Words of a shard, of all languages together; bounds the memory of a task.
SHARD_WORDS = 4_000_000
#: Words of a stored range of texts; two such tasks fit into an executor of 3 GB.
DEALT_WORDS = 3_000_000
#: Most bits of the filter over the candidates (64 MB). Beyond some 50 million candidates it lets more through, never less.
MEMBER_BITS = 1 << 29
#: Binary logarithm of the buckets in which phrases are counted (a filter of 32 MB). With very many words they let more through, never less.
BUCKET_BITS = 28
#: Ranges of buckets that are added up in one place.
RANGES = 256
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(_BREAKS)
)

Keep = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def words_of(texts: list[bytes | None]) -> pa.Array:
    """The words of all texts in order, with ``.`` (which no word holds) wherever a piece ends."""
    joined = b" . ".join(t.translate(_FOLD).replace(b".", b" . ") for t in texts if t)
    words = pc.ascii_split_whitespace(pa.array([joined], pa.binary()).cast(pa.string())).flatten()
    return words.filter(pc.not_equal(words, ""))


def levels(ids: np.ndarray, n_words: int, words_kept: np.ndarray, keep: Keep, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, first places and counts of the distinct phrases that ``keep`` wants, from one word on.

    ``ids`` are word numbers, ``words_kept`` says of each word (breaks excluded) whether it is wanted.
    """
    counts = np.bincount(ids, minlength=n_words)
    seen, first = np.unique(ids, return_index=True)
    wanted = words_kept[seen]
    yield 1, first[wanted], counts[seen[wanted]]
    rank, n_ranks = np.where(words_kept[ids], ids, -1), n_words
    for n in range(2, longest + 1):
        at = np.flatnonzero((rank[:-1] >= 0) & (rank[1:] >= 0))
        if not len(at):
            return
        _, first, inverse, counts = np.unique(
            rank[at] * n_ranks + rank[at + 1], return_index=True, return_inverse=True, return_counts=True
        )
        first = at[first]
        wanted = keep(n, first, counts)
        yield n, first[wanted], counts[wanted]
        number = np.where(wanted, np.cumsum(wanted) - 1, -1)
        rank = np.full(len(rank) - 1, -1, np.int64)
        rank[at] = number[inverse]
        n_ranks = max(1, int(wanted.sum()))


@dataclass(frozen=True)
class Buckets:
    """Which of 2 ** ``bits`` buckets hold enough occurrences, one bit each."""

    bits: int
    enough: np.ndarray

    def hold(self, spots: np.ndarray) -> np.ndarray:
        return (self.enough[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).astype(bool)


def packed(spots: np.ndarray) -> bytes:
    """Sorted numbers as bytes: what each is more than the one before, where 255 stands for 255 and more to come."""
    gaps = np.diff(spots, prepend=spots.dtype.type(0))
    ends = np.cumsum(gaps // 255 + 1, dtype=np.int64)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = gaps % 255
    return out.tobytes()


def unpacked(gaps: bytes) -> np.ndarray:
    steps = np.frombuffer(gaps, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


class Shard:
    """Words of one language as numbers, with two hashes of every phrase."""

    def __init__(self, lang: str, words: pa.ChunkedArray):
        coded = words.combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.lang = lang
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.vocabulary = coded.dictionary.to_pylist()
        self.is_word = np.array([w != "." for w in self.vocabulary])
        self.n = int(self.is_word[self.ids].sum())
        digests = b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in self.vocabulary)
        self._words = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self._seed = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=16).digest(), np.uint64)

    def hashes(self, n: int, first: np.ndarray) -> np.ndarray:
        h = np.tile(mix64(self._seed + np.uint64(n)), (len(first), 1))
        for k in range(n):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + self._words[self.ids[first + k]])
        return h

    def spots(self, n: int, first: np.ndarray, bits: int) -> np.ndarray:
        """The bucket (of 2 ** ``bits``) of phrases of ``n`` words."""
        h = self._words[self.ids[first], 0] ^ self._seed[0]
        for k in range(1, n):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + self._words[self.ids[first + k], 0])
        return (mix64(h) >> np.uint64(64 - bits)).astype(np.uint32)

    def all_spots(self, longest: int, bits: int) -> Iterator[np.ndarray]:
        """`spots` of all phrases of up to ``longest`` words, one array per length."""
        own, word = self._words[self.ids, 0], self.is_word[self.ids]
        h, whole = own ^ self._seed[0], word
        for n in range(1, longest + 1):
            if n > 1:
                h = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[n - 1 :])
                whole = whole[:-1] & word[n - 1 :]
            yield (mix64(h[whole]) >> np.uint64(64 - bits)).astype(np.uint32)

    def phrases(self, n: int, first: np.ndarray) -> list[str]:
        words = self.vocabulary
        return [" ".join([words[w] for w in row]) for row in (self.ids[first[:, None] + np.arange(n)]).tolist()]

    def frequent(self, least: int, longest: int, buckets: Buckets) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phrases with at least ``least`` occurrences, of the ``buckets`` that reach the support."""

        def keep(n: int, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
            wanted = counts >= least
            wanted[wanted] = buckets.hold(self.spots(n, first[wanted], buckets.bits))
            return wanted

        seen, first, counts = np.unique(self.ids, return_index=True, return_counts=True)
        words = self.is_word.copy()
        words[seen] &= keep(1, first, counts)
        return levels(self.ids, len(self.vocabulary), words, keep, longest)

    def members(self, level: bloom.Level, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phrases that the filter holds, however rare they are here."""
        seen, first = np.unique(self.ids, return_index=True)
        words = self.is_word.copy()
        words[seen] &= level.passes(self.hashes(1, first))
        return levels(self.ids, len(self.vocabulary), words, lambda n, first, _: level.passes(self.hashes(n, first)), longest)


def over_shards(docs: DataFrame, work: Callable[[Shard], Iterator[dict]], schema: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """What ``work`` makes of every shard of ``docs`` (``text``, ``lang``), as rows of ``schema``."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                shard = Shard(lang, pa.chunked_array(held.pop(lang)))
                for made in work(shard):
                    columns = [pa.array(made[f.name], type=f.type) for f in target]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)
                pa.default_memory_pool().release_unused()

        for batch in batches:
            for part in _steps(batch):
                texts: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), utf8(part.column("text"))):
                    texts.setdefault(lang, []).append(text)
                for lang, own in texts.items():
                    words = words_of(own)
                    if len(words):
                        held.setdefault(lang, []).extend((words, pa.array(["."])))
                        total += len(words)
                if total >= shard_words:
                    yield from flush()
                    total = 0
        yield from flush()

    return docs.mapInArrow(run, schema)


def by_language(docs: DataFrame, words: int) -> DataFrame:
    """The rows in ranges of their language, one that holds many of them in several ranges of about `DEALT_WORDS`.

    A task then spends its words on one or two languages, so a language is in few shards with a high share of the support each,
    and few phrases can reach the support that do not. Within a language rows are told apart by where they lie, as
    texts may be equal. Of few ``words`` every core gets a part.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    ranges = max(-(-words // DEALT_WORDS), min(cores, -(-8 * words // DEALT_WORDS)))
    return docs.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(ranges, "lang", "_at").drop("_at")


def first_counts(docs: DataFrame, support: int, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> tuple[dict[str, int], Buckets]:
    """Words of every language, and the buckets in which phrases occur ``support`` times in all.

    A shard sends the sorted numbers of its buckets, about a byte per occurrence; ranges of buckets are added up in tasks of their own.
    """
    bits = BUCKET_BITS
    width = (1 << bits) // RANGES

    def spots(shard: Shard) -> Iterator[dict]:
        yield {"part": [-1], "lang": [shard.lang], "n": [shard.n], "gaps": [None]}
        own = np.sort(np.concatenate(list(shard.all_spots(longest, bits))))
        # As many of one shard as the support are enough.
        more = np.ones(len(own), bool)
        more[support:] = own[support:] != own[: max(0, len(own) - support)]
        own = own[more]
        edges = np.searchsorted(own, np.arange(RANGES + 1) * width)
        for part in np.flatnonzero(np.diff(edges)).tolist():
            gaps = packed(own[edges[part] : edges[part + 1]] - np.uint32(part * width))
            yield {"part": [part], "lang": [None], "n": [None], "gaps": [gaps]}

    schema = "part int, lang string, n bigint, enough binary"
    target = arrow_schema(schema)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, at, words = np.zeros(width, np.uint32), -1, Counter()

        def found() -> pa.RecordBatch:
            enough = np.flatnonzero(counts >= support).astype(np.uint32).tobytes()
            return pa.RecordBatch.from_pylist([{"part": at, "lang": None, "n": None, "enough": enough}], schema=target)

        for batch in batches:
            for i, part in enumerate(batch.column("part").to_pylist()):
                if part < 0:
                    words[batch.column("lang")[i].as_py()] += batch.column("n")[i].as_py()
                    continue
                if part != at:
                    if at >= 0:
                        yield found()
                    counts[:] = 0
                    at = part
                own = unpacked(batch.column("gaps")[i].as_py())
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                counts[own[first]] += np.diff(np.r_[first, len(own)]).astype(np.uint32)
        if at >= 0:
            yield found()
        if words:
            yield pa.RecordBatch.from_pylist([{"part": -1, "lang": k, "n": n, "enough": None} for k, n in words.items()], schema=target)

    rows = over_shards(docs, spots, "part int, lang string, n bigint, gaps binary", shard_words)
    rows = rows.repartition("part").sortWithinPartitions("part").mapInArrow(added, schema)
    sizes: dict[str, int] = {}
    enough = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows.collect():
        if row["part"] < 0:
            sizes[row["lang"]] = row["n"]
        else:
            here = np.zeros(width, np.uint8)
            here[np.frombuffer(row["enough"], np.uint32)] = 1
            enough[row["part"] * width // 8 : (row["part"] + 1) * width // 8] = np.packbits(here, bitorder="little")
    return sizes, Buckets(bits, enough)


def possible(mined: DataFrame, hidden: dict[int, int], support: int) -> DataFrame:
    """Hashes of phrases that can have ``support`` occurrences: those reported, and in every other shard as many as it may hide.

    ``n`` has what shards reported beyond that, ``hidden`` the sum of it over all shards of a language.
    """
    short = F.create_map(*[x for lang, n in hidden.items() for x in (F.lit(lang), F.lit(support - n).cast("bigint"))])
    return mined.filter("h1 IS NOT NULL").filter(F.col("n") >= short[F.col("lang")]).select("h1", "h2")


def frequent_phrases(
    docs: DataFrame, sizes: dict[str, int], buckets: Buckets, support: int, longest: int = LONGEST, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``lang``, ``phrase``, ``words`` and exact ``f`` of every phrase with at least ``support`` occurrences."""

    order = {lang: i for i, lang in enumerate(sorted(sizes))}
    enough = docs.sparkSession.sparkContext.broadcast(buckets)

    def mine(shard: Shard) -> Iterator[dict]:
        least = max(1, -(-support * shard.n // sizes[shard.lang])) if shard.n else 1
        # What the shard may hold of a phrase that it does not report.
        yield {"lang": [order[shard.lang]], "h1": [None], "h2": [None], "n": [least - 1]}
        for n, first, counts in shard.frequent(least, longest, enough.value):
            h = shard.hashes(n, first)
            yield {
                "lang": np.full(len(first), order[shard.lang], np.int32), "h1": h[:, 0].view(np.int64), "h2": h[:, 1].view(np.int64),
                "n": counts - (least - 1),
            }

    mined = over_shards(docs, mine, f"lang int, {bloom.HASHES}, n bigint", shard_words)
    mined = materialize(mined.groupBy("lang", "h1", "h2").agg(F.sum("n").alias("n")), "mined")
    hidden = {r["lang"]: r["n"] for r in mined.filter("h1 IS NULL").collect()}
    candidates = materialize(possible(mined, hidden, support), "candidates")
    drop_stored(mined)
    sweep(docs.sparkSession)
    n_candidates = max(1, candidates.count())
    bits = min(MEMBER_BITS, -(-12 * n_candidates // 64) * 64)
    level = bloom.filled(candidates, bloom.Level(bits, max(1, min(6, round(bits / n_candidates * 0.69))), 11))
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def count(shard: Shard) -> Iterator[dict]:
        for n, first, counts in shard.members(shared.value, longest):
            yield {"lang": [shard.lang] * len(first), "phrase": shard.phrases(n, first), "words": [n] * len(first), "f": counts}

    counted = over_shards(docs, count, "lang string, phrase string, words int, f bigint", shard_words)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= support)


def scored(grams: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The lowest-scoring cut of every phrase that no longer one takes along, in whole-number arithmetic of 38 digits."""
    n_words = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(n).cast("bigint"))])
    cut = grams.filter("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("tail"),
    )
    parts = grams.select("lang", "phrase", "f")
    cut = keyed_join(cut, parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = keyed_join(cut, parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cut = cut.withColumn("n", n_words[F.col("lang")])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    cut = cut.select("lang", "phrase", "k", "a", "l", "r", "n", (F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]).alias("up"),
                     (exact["l"] * exact["r"]).alias("down")).withColumn("score", F.expr("up div down"))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    # A longer phrase that holds this one as often does so through one that is longer by a word.
    sides = F.expr("explode(array(substring_index(phrase, ' ', words - 1), substring_index(phrase, ' ', 1 - words)))")
    longer = grams.filter("words > 2").select("lang", sides.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    own = keyed_join(best, longer, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < best.a")
    return own.select("lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])


def collocations(docs: DataFrame, support: int = 100, top: int = 2000, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``top`` phrases of every language by score, then occurrences, then the phrase itself."""
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    sizes, buckets = first_counts(texts, support, longest, shard_words)
    spark = docs.sparkSession
    sweep(spark)
    if not sizes:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    texts = materialize(by_language(texts, sum(sizes.values())), "texts")
    sweep(spark)
    grams = materialize(frequent_phrases(texts, sizes, buckets, support, longest, shard_words), "phrases")
    drop_stored(texts)
    out = scored(grams, sizes)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within slices of a language, so that no task sorts all phrases of one.
    sliced = out.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    sliced = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
