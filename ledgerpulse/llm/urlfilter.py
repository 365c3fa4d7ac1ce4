"""URL lists as a Bloom filter cascade: exact answers over a known universe of keys, without a join.

A URL is judged by its candidate keys: every suffix of its host, by whole labels, followed by every
prefix of its path of a length that the list uses. A key is ``host + path``, such as ``net/``.

Level 1 of a cascade encodes the listed keys. The keys of the corpus that are not listed but pass it
are its false positives; level 2 encodes those. The listed keys that pass level 2 are encoded by
level 3, and so on until a level lets nothing wrong through. Walking down the levels until one says
no then gives exact membership for every key of the universe, and the universe is every candidate key
of every URL of the corpus. Only the levels' bits reach the driver and the executors; their number
follows the length of the list (level 1 is sized so that about as many keys pass as are listed).

Defined results: a URL that is null or has no ``://`` has empty host and path and no rule. The longest
key wins; between keys of one length the one with the longer host, then ``block``. Rows are kept one
for one, repeated ones too; other columns of the input are not read. An empty list or an empty table
gives a cascade without levels, which lists nothing. A rule that no URL of the corpus touches costs bits only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm.bloom import HASHES, Level, filled, passing
from ledgerpulse.llm.common import arrow_map
from ledgerpulse.sources.workspace import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most levels before the build gives up; each level lets a fixed share through, so a dozen is usual.
MOST_LEVELS = 60


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``host`` (A-Z lower-cased) and ``path`` of a URL; both empty without ``://``."""
    known = F.col(url).contains("://")
    rest = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    return df.withColumns({
        "host": F.when(known, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)).otherwise(""),
        "path": F.when(known, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(""),
    })


def _hosts(host: str) -> list[str]:
    """The host and its parents, longest first."""
    cuts = [i + 1 for i, c in enumerate(host) if c == "."]
    return [host, *(host[i:] for i in cuts)] if host else []


def _candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Keys that could fit, longest first; of one length the longer host first."""
    fitting = [n for n in lengths if n <= len(path)]
    keys = [(len(h) + n, len(h), h + path[:n]) for h in _hosts(host) if h for n in fitting]
    return [k for _, _, k in sorted(keys, key=lambda x: (-x[0], -x[1]))]


def _hash(keys: list[str]) -> np.ndarray:
    """128 bits of each key, as two columns."""
    digests = b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys)
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 2)


@dataclass(frozen=True)
class Cascade:
    """Levels that alternately encode listed keys and keys that passed by mistake."""

    levels: tuple[Level, ...]

    def lists(self, h: np.ndarray) -> np.ndarray:
        """Membership of hashed keys; exact for keys of the universe it was built over."""
        out = np.zeros(len(h), dtype=bool)
        alive = np.arange(len(h))
        for i, level in enumerate(self.levels):
            ok = level.passes(h[alive]) if len(alive) else np.zeros(0, dtype=bool)
            out[alive[~ok]] = i % 2 == 1
            alive = alive[ok]
        out[alive] = len(self.levels) % 2 == 1
        return out

    @property
    def n_bytes(self) -> int:
        return sum(level.n_bits // 8 for level in self.levels)


def build_cascade(listed: DataFrame, universe: DataFrame, rate: float = 0.05, max_bytes: int = 256 << 20) -> Cascade:
    """A cascade for ``listed`` that is exact for every key of ``universe`` (both: distinct h1, h2).

    ``rate`` is the share that levels from the second on let through by mistake. A list whose level 1
    would take more than ``max_bytes`` raises: bits are sent to every executor, so they need a bound.
    """
    n_listed = listed.count()
    if not n_listed:
        return Cascade(())
    others = materialize(universe.join(listed, ["h1", "h2"], "left_anti"), "unlisted")
    n_others = others.count()
    first_rate = min(0.5, max(1e-9, n_listed / max(1, n_others)))
    own, opposite, n = listed, others, n_listed
    levels: list[Level] = []
    while n:
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("two different keys share all 128 bits of their hash")
        level = Level.sized(n, rate if levels else first_rate, len(levels) + 1)
        if level.n_bits // 8 > max_bytes:
            raise ValueError(f"a level of {level.n_bits // 8} bytes; raise max_bytes or split the list")
        levels.append(filled(own, level))
        wrong = materialize(passing(opposite, levels[-1]), "passed")
        own, opposite, n = wrong, own, wrong.count()
    return Cascade(tuple(levels))


def key_universe(parts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Hashes of the distinct candidate keys of all rows with ``host`` and ``path``."""

    def keys(batch: pa.RecordBatch) -> dict:
        pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
        found = sorted({k for host, path in pairs for k in _candidates(host, path, lengths)})
        h = _hash(found).view(np.int64)
        return {"h1": h[:, 0], "h2": h[:, 1]}

    return arrow_map(parts.select("host", "path"), keys, HASHES).distinct()


def _listed(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    h = _hash(sorted(set(keys))).view(np.int64)
    return spark.createDataFrame([(int(a), int(b)) for a, b in h], HASHES)


def judge_urls(
    df: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow",
    rate: float = 0.05,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` (the longest that fits, or null) and ``verdict`` of every row.

    One cascade per verdict, both exact over all candidate keys of ``df``; rows without a fitting
    key get ``default``, the verdict of a URL that no list holds. A key under both verdicts blocks.
    """
    lengths = sorted({len(r.path) for r in rules})
    parts = with_parts(df.select(key, url), url).select(key, "host", "path")
    universe = materialize(key_universe(parts, lengths), "urlkeys")
    cascades = [
        (verdict, build_cascade(_listed(df.sparkSession, [r.key for r in rules if r.verdict == verdict]), universe, rate))
        for verdict in ("block", "allow")
    ]
    shared = df.sparkSession.sparkContext.broadcast(cascades)

    def judged(batch: pa.RecordBatch) -> dict:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        own = [_candidates(h, p, lengths) for h, p in zip(hosts, paths)]
        flat = [k for keys in own for k in keys]
        h = _hash(flat)
        verdicts = np.full(len(flat), "", dtype=object)
        for verdict, cascade in reversed(shared.value):
            verdicts[cascade.lists(h)] = verdict
        rule, verdict, at = [], [], 0
        for keys in own:
            hit = next((i for i in range(at, at + len(keys)) if verdicts[i]), None)
            rule.append(None if hit is None else flat[hit])
            verdict.append(default if hit is None else verdicts[hit])
            at += len(keys)
        return {key: batch.column(key), "host": hosts, "path": paths, "rule": rule, "verdict": verdict}

    type_ = dict(df.dtypes)[key]
    return arrow_map(parts, judged, f"`{key}` {type_}, host string, path string, rule string, verdict string")
