"""Repeated passages by a sparse suffix order: front-coded sorted runs, exchanged by range, merged by loser trees.

A byte goes when a string of `PASSAGE` bytes that covers it starts anywhere else too. Sorting all suffixes
would move every text some hundred times, so only suffixes at *anchors* are sorted. The anchor of a start is
the place with the least 16-byte hash among the next `SLIDE` places, all of them inside the passage; equal passages therefore
have their anchors at the same distance, and every start belongs to exactly one anchor.

1. All passages of an anchor hold the ``PASSAGE - SLIDE + 1`` bytes from it on, its *core*. An anchor whose core (by hash) is met only once has
   no repeat and is left out, as duplicate detection does for distinguishing prefixes in distributed string sorting.
2. *Turned suffixes*: ``PASSAGE`` bytes from the anchor on, then the bytes before it backwards. Neighbours in this order that
   share ``PASSAGE + d`` bytes prove the starts at 0 to d bytes before the anchor repeated, and since the order is lexicographic no other
   suffix proves more. A start further off can only be shared with suffixes that differ within ``PASSAGE`` bytes from here,
   and the most any of those shares says how far off that is at least.
3. There the anchors that are still open, and all with their core, are turned again, and so on until none is open. A step settles one end
   of a repeat, so there are few, and all but the first two are small.

Each step is one merge sort: a task sorts what it has into runs in which equal suffixes are one entry with all its
places, front-codes them in blocks and deals them out by splitters from a seeded sample; a loser tree per range merges the runs.
An entry knows how many bytes it shares with the last one put out, losers keep what they share with their winner, and only
bytes behind that are ever compared. The ends of neighbouring ranges (two per range) are compared on the driver.

Defined results: a null text counts as the empty text; texts shorter than a passage lose nothing. Rows that repeat an
id and a text are different places, so both lose all that is long enough. Columns other than the id and the text
are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import _steps, arrow_map, arrow_schema, keyed_join, mix64, utf8
from ledgerpulse.sources.workspace import drop_stored, materialize

#: Bytes of a passage, starts among which an anchor is chosen (a power of two), bytes hashed for the choice.
PASSAGE, SLIDE, GRAM = 400, 128, 16
#: Bytes of suffixes that a task sorts at once, and that a range holds about.
RUN_BYTES, RANGE_BYTES = 32 << 20, 32 << 20
#: Suffixes of a front-coded block; sampled suffixes per range.
BLOCK, SAMPLED = 256, 64
#: Bytes of text that anchors are sought in at once.
_SPAN = 1 << 20
_PLACE = "p int, back smallint, upto smallint, core bigint"
_FIELDS = ("p", "back", "upto", "core", "near")
_RUNS = "part int, run bigint, seq int, payload binary"
_FOUND = f"k1 bigint, k2 bigint, {_PLACE}, near smallint, shared int, beside int, part int, at_low boolean, at_high boolean, low binary, high binary"
_RANDOM = np.random.Generator(np.random.PCG64(20250311)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    n = _SPAN + 4096
    up, down = (np.full(n, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _anchors_in(data: np.ndarray, valid: np.ndarray, passage: int, slide: int) -> tuple[np.ndarray, ...]:
    """Anchor, first and last start, and core hash; ``valid`` marks the starts (``passage`` bytes lie in one text)."""
    h = _RANDOM[data]
    prefix = np.zeros(len(data) + 1, np.uint64)
    up, down = _powers()
    np.cumsum(h * up[: len(data)], out=prefix[1:])
    grams = (h >> np.uint64(20)).astype(np.uint32)
    for step in (1, 2, 4, 8):
        grams = grams[:-step] * np.uint32(pow(0x2C9277B5, step, 1 << 32)) + grams[step:]
    grams ^= grams >> np.uint32(15)
    least = (grams * np.uint32(0x7FEB352D)).astype(np.uint64) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < slide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    starts = np.flatnonzero(valid)
    chosen = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    ends = np.concatenate([begins[1:], [len(chosen)]]) - 1
    p = chosen[begins]
    core = mix64((prefix[p + passage - slide + 1] - prefix[p]) * down[p])
    return p, starts[begins], starts[ends], core


def anchors(texts: Sequence[bytes | None], passage: int = PASSAGE, slide: int = SLIDE) -> dict[str, np.ndarray]:
    """Anchors of all texts: number of the text, place in it, how far before it its starts reach, core hash."""
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    marks = np.zeros(len(data) + 1, np.int32)
    long = sizes >= passage
    np.add.at(marks, offsets[:-1][long], 1)
    np.add.at(marks, (offsets[1:] - passage + 1)[long], -1)
    valid = np.cumsum(marks)[:-1] > 0
    found = []
    for at in range(0, len(data), _SPAN):
        here = valid[at : at + _SPAN]
        if here.any():
            p, first, last, core = _anchors_in(data[at : at + _SPAN + passage], here, passage, slide)
            found.append((p + at, first + at, last + at, core))
    p, first, last, core = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    text = np.searchsorted(offsets, p, side="right") - 1
    return {"text": text, "p": p - offsets[text], "back": p - first, "upto": p - last, "core": core.view(np.int64)}


def shared_bytes(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are settled."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def coded_block(keys: list[bytes], places: list[np.ndarray]) -> bytes:
    """Sorted suffixes as shared length and rest, each with its places."""
    shared = [0] + [shared_bytes(a, b, 0) for a, b in zip(keys, keys[1:])]
    head = np.array([len(keys), sum(map(len, places))], np.int64)
    numbers = np.array([shared, [len(k) for k in keys], [len(p) for p in places]], np.int32)
    rests = b"".join(k[s:] for k, s in zip(keys, shared))
    return zlib.compress(head.tobytes() + numbers.tobytes() + np.concatenate(places).tobytes() + rests, 1)


def decoded_block(payload: bytes) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Bytes shared with the suffix before (0 for the first), suffix and places."""
    raw = zlib.decompress(payload)
    n, n_places = np.frombuffer(raw, np.int64, 2)
    shared, sizes, counts = np.frombuffer(raw, np.int32, 3 * n, 16).reshape(3, n)
    at = 16 + 12 * n
    places = np.frombuffer(raw, np.int64, 7 * n_places, at).reshape(n_places, 7)
    at, upto, key = int(at + 56 * n_places), 0, b""
    for s, size, count in zip(shared.tolist(), sizes.tolist(), counts.tolist()):
        key = key[:s] + raw[at : at + size - s]
        at += size - s
        yield s, key, places[upto : upto + count]
        upto += count


class Run:
    """The suffixes of one run in order, with the bytes shared with the one before."""

    def __init__(self, payloads: list[bytes]):
        self._payloads = payloads

    def __iter__(self) -> Iterator[tuple[int, bytes, np.ndarray]]:
        last = b""
        for payload in self._payloads:
            for i, (shared, key, places) in enumerate(decoded_block(payload)):
                yield (shared if i else shared_bytes(last, key, 0)), key, places
                last = key


def merged(runs: Sequence[Iterator[tuple[int, bytes, np.ndarray]]]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """All suffixes of sorted runs in order, with the bytes shared with the one put out before.

    ``known[r]`` is what the head of run r shares with the suffix that beat it last, or with the one put out last. Of two heads the one
    that shares more with that suffix is the smaller; only if both share as much are they compared, from there on.
    """
    streams = [iter(r) for r in runs]
    heads = [next(s, None) for s in streams]
    n = len(streams)
    known = [0] * n
    losers = [-1] * n

    def climb(r: int) -> int:
        """The winner after run ``r`` has a new head; -1 while the tree is being filled."""
        node = (r + n) // 2
        while node:
            other = losers[node]
            if other < 0:
                losers[node] = r
                return -1
            wins = False
            if heads[r] is None or heads[other] is None:
                wins = heads[other] is not None
            elif known[r] != known[other]:
                wins = known[other] > known[r]
            else:
                a, b = heads[r][1], heads[other][1]
                same = shared_bytes(a, b, known[r])
                wins = b[same : same + 1] < a[same : same + 1]
                known[r if wins else other] = same
            if wins:
                losers[node], r = r, other
            node //= 2
        return r

    winner = -1
    for r in range(n):
        winner = climb(r)
    while winner >= 0 and heads[winner] is not None:
        _, key, places = heads[winner]
        yield known[winner], key, places
        heads[winner] = after = next(streams[winner], None)
        known[winner] = after[0] if after else 0
        winner = climb(winner)


def turned(text: bytes, start: int, first: int, passage: int) -> bytes:
    """A passage and, if it is whole, the bytes before it backwards down to ``first``."""
    ahead = text[start : start + passage]
    return ahead + text[first:start][::-1] if len(ahead) == passage else ahead


def _cut(batch: pa.RecordBatch, passage: int, one_in: int = 1) -> Iterator[tuple[bytes, tuple[int, ...]]]:
    """Suffix and place of all anchors of the batch, or of a seeded choice among them."""
    lists = batch.column("places")
    flat = lists.flatten()
    ends = np.cumsum([0, *[n or 0 for n in lists.value_lengths().to_pylist()]]).tolist()
    fields = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _FIELDS])
    texts = utf8(batch.column("text"))
    for i, (k1, k2) in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())):
        rows, text = fields[ends[i] : ends[i + 1]], texts[i]
        if one_in > 1:
            rows = rows[mix64((rows[:, 0] * 31 + k1 + rows[:, 4]).view(np.uint64)) % np.uint64(one_in) == 0]
        for p, back, upto, core, near in rows.tolist():
            yield turned(text, p - near, p - back, passage), (k1, k2, p, back, upto, core, near)


def sorted_runs(held: DataFrame, splitters: list[bytes], passage: int, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Front-coded blocks of sorted runs, dealt out to the ranges between ``splitters``."""
    target = arrow_schema(_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[bytes, list[tuple[int, ...]]] = {}
        number, held_bytes = TaskContext.get().partitionId() << 24, 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = sorted(entries)
            at, seq = 0, 0
            while at < len(keys):
                part = bisect_right(splitters, keys[at])
                upto = min(len(keys), at + BLOCK)
                if part < len(splitters):
                    upto = bisect_left(keys, splitters[part], at, upto)
                block = keys[at:upto]
                payload = coded_block(block, [np.array(entries[k], np.int64) for k in block])
                columns = [pa.array([x], f.type) for x, f in zip((part, number, seq, payload), target)]
                yield pa.RecordBatch.from_arrays(columns, schema=target)
                at, seq = upto, seq + 1
            entries.clear()

        for batch in batches:
            for step in _steps(batch):
                for key, place in _cut(step, passage):
                    if key in entries:
                        entries[key].append(place)
                        held_bytes += 64
                    else:
                        entries[key] = [place]
                        held_bytes += len(key) + 192
                    if held_bytes >= run_bytes:
                        yield from flush()
                        number, held_bytes = number + 1, 0
        yield from flush()

    return held.mapInArrow(run, _RUNS)


def _splitters(held: DataFrame, n_places: int, passage: int, range_bytes: int) -> list[bytes]:
    """Ends of the ranges, from a sample of at most some `SAMPLED` suffixes per range."""
    ranges = -(-n_places * (passage + SLIDE // 2) // range_bytes)
    if ranges < 2:
        return []
    one_in = max(1, n_places // (SAMPLED * ranges))

    def sample(batch: pa.RecordBatch) -> dict:
        return {"suffix": [key for key, _ in _cut(batch, passage, one_in)]}

    drawn = sorted(r["suffix"] for r in arrow_map(held, sample, "suffix binary").collect())
    drawn = [bytes(s) for s in drawn]
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []


def merge_range(payloads: dict[int, list[bytes]], passage: int, part: int) -> dict:
    """Places of one range with the most bytes they share with any other (``shared``) and with any other
    that shares less than a passage (``beside``), as far as this range can tell.

    Entries that share a whole passage are a stretch; what they share with others shows at its two ends. ``at_low`` and ``at_high`` mark
    stretches that reach an end of the range.
    """
    below, sizes, counts, places, low, high = [], [], [], [], b"", b""
    for shared, key, own in merged([iter(Run(p)) for p in payloads.values()]):
        if sizes and shared == len(key) == sizes[-1]:
            counts[-1] += len(own)
        else:
            low = low if sizes else key
            below.append(shared if sizes else 0)
            sizes.append(len(key))
            counts.append(len(own))
        high = key
        places.append(own)
    below, sizes, counts = (np.array(x, np.int64) for x in (below, sizes, counts))
    above = np.append(below[1:], 0)
    best = np.where(counts > 1, sizes, np.maximum(below, above))
    opens = np.flatnonzero(below < passage)
    stretch = np.cumsum(below < passage) - 1
    beside = np.maximum(below[opens], np.append(below[opens[1:]], 0))[stretch]
    beside = np.where((sizes < passage) & (counts > 1), np.maximum(beside, sizes), beside)
    rows = np.concatenate(places)
    entry = np.repeat(np.arange(len(sizes)), counts)
    lows, highs = [None] * len(rows), [None] * len(rows)
    lows[0], highs[int(np.flatnonzero(entry == entry[-1])[0])] = low, high
    made = {c: rows[:, i] for i, c in enumerate(("k1", "k2", *_FIELDS))}
    return made | {
        "shared": best[entry], "beside": beside[entry], "part": np.full(len(rows), part),
        "at_low": (stretch == 0)[entry], "at_high": (stretch == stretch[-1])[entry], "low": lows, "high": highs,
    }


def _across(ends: Sequence, passage: int) -> list[tuple[int, int, int, int, int]]:
    """Per range what its first and last entry share with the neighbouring ranges, and the most that the
    stretches at its two ends share with anything beyond that is no whole passage."""
    lows = {r["part"]: r for r in ends if r["low"] is not None}
    highs = {r["part"]: r for r in ends if r["high"] is not None}
    parts = sorted(lows)
    shared = [shared_bytes(bytes(highs[a]["high"]), bytes(lows[b]["low"]), 0) for a, b in zip(parts, parts[1:])]
    after, before = [0] * len(parts), [0] * len(parts)
    for i in range(len(parts) - 2, -1, -1):
        here = lows[parts[i + 1]]
        beyond = max(here["beside"], after[i + 1] if here["at_high"] else 0)
        after[i] = shared[i] if shared[i] < passage else beyond
    for i in range(1, len(parts)):
        here = highs[parts[i - 1]]
        beyond = max(here["beside"], before[i - 1] if here["at_low"] else 0)
        before[i] = shared[i - 1] if shared[i - 1] < passage else beyond
    return [(p, ([0] + shared)[i], (shared + [0])[i], before[i], after[i]) for i, p in enumerate(parts)]


def neighbours(held: DataFrame, passage: int, run_bytes: int = RUN_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``shared`` and ``beside`` of every place in ``held`` (k1, k2, text, places), stored, by one distributed merge sort."""
    n_places = held.agg(F.sum(F.size("places"))).first()[0] or 0
    runs = sorted_runs(held, _splitters(held, n_places, passage, range_bytes), passage, run_bytes)
    target = arrow_schema(_FOUND)

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("run", "seq", "payload"))), key=lambda r: r[:2])
        payloads: dict[int, list[bytes]] = {}
        for number, _, payload in rows:
            payloads.setdefault(number, []).append(payload)
        made = merge_range(payloads, passage, table["part"][0].as_py())
        return pa.table([pa.array(made[f.name], type=f.type) for f in target], schema=target)

    found = materialize(runs.groupBy("part").applyInArrow(merge, _FOUND), "suffixes")
    ends = found.filter("low IS NOT NULL OR high IS NOT NULL").collect()
    columns = ["k1", "k2", *_FIELDS, "shared", "beside"]
    if len({r["part"] for r in ends}) < 2:
        return found
    # One row per range.
    beyond = held.sparkSession.createDataFrame(_across(ends, passage), "part int, low_shared int, high_shared int, before int, after int")
    joined = found.join(F.broadcast(beyond), "part")
    known = joined.withColumns({
        "shared": F.greatest("shared", F.when(F.col("low").isNotNull(), F.col("low_shared")), F.when(F.col("high").isNotNull(), F.col("high_shared"))),
        "beside": F.greatest("beside", F.when(F.col("at_low"), F.col("before")), F.when(F.col("at_high"), F.col("after"))),
    })
    out = materialize(known.select(*columns), "step")
    drop_stored(found)
    return out


def _gathered(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Texts with the list of their places."""
    lists = places.groupBy("k1", "k2").agg(F.collect_set(F.struct(*_FIELDS)).alias("places"))
    return keyed_join(texts, lists, ["k1", "k2"]).select("k1", "k2", "text", "places")


def repeated_starts(docs: DataFrame, passage: int = PASSAGE, slide: int = SLIDE, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """Texts that may lose something (k1, k2, text), and the stretches ``first`` to ``last`` of repeated starts in them."""
    if slide & slide - 1 or slide + GRAM > passage:
        raise ValueError("slide must be a power of two and leave a core")

    def found(batch: pa.RecordBatch) -> dict:
        made = anchors(utf8(batch.column("text")), passage, slide)
        text = pa.array(made.pop("text"))
        return {"k1": batch.column("k1").take(text), "k2": batch.column("k2").take(text)} | made

    long = docs.filter(F.octet_length("text") >= passage)
    places = materialize(arrow_map(long, found, f"k1 bigint, k2 bigint, {_PLACE}"), "anchors")
    often = places.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    near = F.lit(0).cast("smallint")
    # Most anchors go here, before the texts are moved.
    repeated = materialize(keyed_join(places, often, ["core"], "left_semi"), "repeated")
    drop_stored(places)
    held = materialize(_gathered(long, repeated.withColumn("near", near)), "held")
    drop_stored(repeated)
    texts = held.select("k1", "k2", "text")
    start = F.col("p") - F.col("near")
    stretches, every, turn = [], None, held
    while True:
        step = neighbours(turn, passage, **sizes)
        if turn is not held:
            drop_stored(turn)
        stretches.append(step.filter(F.col("shared") >= passage).select(
            "k1", "k2", (start - F.col("shared") + passage).alias("first"), start.alias("last")
        ))
        if every is None:
            every = step.select("k1", "k2", "p", "back", "upto", "core").distinct()
        else:
            step = keyed_join(step, opened, ["k1", "k2", *_FIELDS], "left_semi")
        # The least distance before the anchor at which a start can still be shared.
        further = F.greatest(F.col("upto"), F.col("near") + F.greatest(F.col("shared") - passage + 1, passage - F.col("beside")))
        opened = step.withColumn("near", further.cast("smallint")).filter("near <= back").select("k1", "k2", *_FIELDS)
        opened = materialize(opened.distinct(), "open")
        if opened.isEmpty():
            return texts, reduce(DataFrame.unionByName, stretches)
        wanted = opened.select("core", "near").distinct()
        turn = materialize(_gathered(texts, keyed_join(every, wanted, ["core"]).filter("near <= back")), "turn")


def without_passages(text: bytes, stretches: Sequence[tuple[int, int]], passage: int = PASSAGE) -> tuple[bytes, int]:
    """The bytes that no repeated passage covers, and how many runs were cut out."""
    kept, at, spans = [], 0, 0
    upto = -1
    for first, last in sorted(stretches):
        if first > upto:
            spans += 1
            kept.append(text[max(at, 0) : first])
        upto = max(upto, last + passage)
        at = upto
    kept.append(text[max(at, 0) :])
    return b"".join(kept), spans


def repeated_passages(docs: DataFrame, key: str = "doc_id", passage: int = PASSAGE, slide: int = SLIDE, **sizes: int) -> DataFrame:
    """One row per document: bytes, bytes and runs removed, and the digest of what stays."""
    names = [F.xxhash64(F.col(key), "text").alias("k1"), F.xxhash64(F.lit("again"), F.col(key), "text").alias("k2")]
    texts, stretches = repeated_starts(docs.select(*names, "text"), passage, slide, **sizes)
    lists = stretches.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("stretches"))
    held = keyed_join(texts, lists, ["k1", "k2"]).select("k1", "k2", "text", "stretches")

    def shortened(batch: pa.RecordBatch) -> dict:
        removed, spans, digests = [], [], []
        for text, own in zip(utf8(batch.column("text")), batch.column("stretches").to_pylist()):
            kept, n = without_passages(text, [(s["first"], s["last"]) for s in own], passage)
            removed.append(len(text) - len(kept))
            spans.append(n)
            digests.append(hashlib.sha256(kept).hexdigest())
        return {"k1": batch.column("k1"), "k2": batch.column("k2"), "n_removed": removed, "n_spans": spans, "digest": digests}

    changed = arrow_map(held, shortened, "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, digest string").distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(key), *names, F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    out = keyed_join(rows, changed, ["k1", "k2"], "left")
    return out.select(
        key, "n_bytes", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_removed", "n_spans")],
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )
