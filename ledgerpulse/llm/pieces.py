"""SentencePiece encoding and decoding by a max-plus scan.

The best segmentation of a text into pieces maximises the sum of the pieces' scores. A short text is segmented
at once. A giant one is split into chunks that are worked on apart. A piece may reach across the end of a chunk, by
less than the longest piece: the state at a chunk's start is how far back the last piece ended. A chunk is then
a matrix, the best score from every state at its start to every state at its end, and chunks are
put together by max-plus products, which are associative: blocks of chunks first, then the blocks. With the best
scores at its start known, a chunk says, for each state at its end, from which state it is
reached; these maps are composed the same way from the end of the text, and then every chunk traces its own
pieces back. Matrices are a small part of the text, and a group holds those of one block or of the blocks of one text.

Where no piece can reach across a place (before a blank that follows another character, and on either side of a
character that only stands alone) every segmentation has a border there. Units between such places are
segmented once per task, the new ones of a batch side by side, and remembered by number; a chunk's matrix and map are made from its first and last unit and the sum over
those in between, and only these two are traced anew.

A file of the unigram kind has log probabilities for scores, taken as they are. One of the BPE kind has merge
ranks; a piece of rank r is then given the log of Zipf's share 1 / (1 + r), in units of 1/1024 rounded to
whole numbers. Of equal sums the one whose last piece is longer wins, from the end of the text. Whole
numbers add up alike in any order, so results do not depend on the chunks.

Normalisation is the file's dummy prefix and blanks written as U+2581; a file that asks for more is refused.
Characters without a piece become byte pieces (or the unknown piece, if the file has none); so does a U+2581
of the text itself, so decoding gives back the text exactly.

Defined results: null gives null ids, the empty text no ids (score 0). Rows are kept one for one, repeated ones too,
with all their other columns; columns named like the added ones are replaced. Texts are used whole.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_map, arrow_schema
from ledgerpulse.sources.workspace import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Stands for a U+2581 of the text; valid texts hold no lone surrogate.
_OWN_BLANK = "\udfff"
#: Characters of a chunk, and chunks of a block of the scan.
CHUNK, BLOCK = 32768, 64
#: Units that a task remembers before it starts anew.
REMEMBERED = 1 << 17
#: Longest unit, and characters of units, that are searched side by side.
SIDE_BY_SIDE, SPAN = 40, 1 << 15
NONE = -math.inf


class _Memory:
    """Units by number, with the ids and scores of all of them in arrays."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.ends, self.scores = array("i"), array("q", [0]), array("d")

    def add(self, found: list[tuple[tuple[int, ...], float]]) -> None:
        """What belongs to the units that were numbered last, in their order."""
        last = self.ends[-1]
        self.ids.extend(chain.from_iterable([ids for ids, _ in found]))
        self.ends.extend(accumulate([len(ids) for ids, _ in found], initial=last))
        self.ends.pop(len(self.scores))
        self.scores.extend([score for _, score in found])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """Ids of these units, one after the other, where each ends, and the scores."""
        ids, ends, scores = np.frombuffer(self.ids, np.int32), np.frombuffer(self.ends, np.int64), np.frombuffer(self.scores)
        starts = ends[numbers]
        sizes = ends[numbers + 1] - starts
        until = np.cumsum(sizes)
        at = np.repeat(starts - until + sizes, sizes)
        at += np.arange(len(at))
        return ids[at], until, scores[numbers].tolist()


class _Steps:
    """What begins a piece, by number, and in a hash table the number that each goes to by one character more."""

    def __init__(self, table: dict[str, float], ids: dict[str, int]) -> None:
        begun = ["", *sorted(table, key=len)]
        number = {p: i for i, p in enumerate(begun)}
        kinds = {c: i for i, c in enumerate(sorted({p[-1] for p in begun[1:]}), 1)}
        self.kind = np.zeros(0x110000, np.int32)  # 0 for characters of no piece
        self.kind[[ord(c) for c in kinds]] = list(kinds.values())
        self.kinds = len(kinds) + 1
        self.single = np.array([False, *(table.get(c, NONE) != NONE for c in kinds)])
        self.score = np.array([NONE, *(table[p] for p in begun[1:])])
        self.id = np.array([ids.get(p, -1) for p in begun], np.int32)
        goes = np.array([number[p[:-1]] * self.kinds + kinds[p[-1]] for p in begun[1:]], np.int64)
        bits = max(4, (4 * len(begun)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        for place, key, to in zip(self._place(goes).tolist(), goes.tolist(), range(1, len(begun))):
            while self.keys[place] >= 0:
                place = (place + 1) % len(self.keys)
            self.keys[place], self.to[place] = key, to

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def next(self, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The number after each of ``at`` by a character, or 0."""
        key = at.astype(np.int64) * self.kinds + kind
        place = self._place(key)
        there = self.keys[place]
        out = np.where(there == key, self.to[place], 0)
        left = np.flatnonzero((there != key) & (there >= 0))
        while len(left):
            place[left] = (place[left] + 1) % len(self.keys)
            there = self.keys[place[left]]
            hit = there == key[left]
            out[left[hit]] = self.to[place[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their ids and scores; what a text is turned into is decided by these alone."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    unknown: int
    prefix: bool
    penalty: float = 10.0
    _units: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ids", "scores", "bytes_", "unknown", "prefix", "penalty")} | {"_units": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids))

    @cached_property
    def alone(self) -> float:
        """Score of a character without a piece, as the library has it."""
        return min(self.scores.values()) - self.penalty

    @cached_property
    def table(self) -> dict[str, float]:
        """Scores of pieces, and minus infinity for what only begins one."""
        begun = {p[:n]: NONE for p in self.scores for n in range(1, len(p))}
        return begun | self.scores

    @cached_property
    def steps(self) -> _Steps:
        return _Steps(self.table, self.ids)

    @cached_property
    def unit(self) -> re.Pattern:
        """Matches the text between two places that no piece reaches across."""
        joined = {c for p in self.ids if len(p) > 1 for c in p if c != BLANK}
        inner = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        if inner or not joined:  # blanks inside pieces: no place is safe
            return re.compile(".+", re.S)
        some = "[" + "".join(map(re.escape, sorted(joined))) + "]"
        return re.compile(f"{BLANK}*{some}+|{BLANK}+|.", re.S)

    @cached_property
    def bodies(self) -> list[bytes]:
        """What each id stands for, blanks as blanks."""
        out = [b""] * (max([*self.ids.values(), *self.bytes_, self.unknown]) + 1)
        for piece, i in self.ids.items():
            out[i] = piece.replace(BLANK, " ").encode()
        for b, i in enumerate(self.bytes_):
            out[i] = bytes([b])
        return out

    def normal(self, text: str) -> str:
        text = text.replace(BLANK, _OWN_BLANK).replace(" ", BLANK)
        return BLANK + text if self.prefix and text else text

    def spelled(self, pieces: list[str]) -> list[int]:
        """Ids of pieces; a character that is none is spelled in bytes."""
        out: list[int] = []
        for p in pieces:
            known = self.ids.get(p)
            if known is not None:
                out.append(known)
            elif self.bytes_:
                out += [self.bytes_[b] for b in (BLANK if p == _OWN_BLANK else p).encode()]
            else:
                out.append(self.unknown)
        return out

    def forward(self, text: str, first: dict[int, float], start: int, end: int) -> tuple[list[float], list[int]]:
        """Best score of a border at each place up to ``end`` and where its last piece began.

        ``first`` has the scores of the borders to start from; those before ``start`` are left by a piece
        that ends after it.
        """
        best, back = [NONE] * (end + 1), [-1] * (end + 1)
        for at, score in first.items():
            best[at] = score
        known, scores, alone = self.table.get, self.scores, self.alone
        for at in range(min(first, default=end), end):
            here = best[at]
            if here == NONE:
                continue
            if text[at] not in scores and at >= start and here + alone > best[at + 1]:
                best[at + 1], back[at + 1] = here + alone, at
            for stop in range(at + 1, end + 1):
                score = known(text[at:stop])
                if score is None:
                    break
                if here + score > best[stop] and stop > start:
                    best[stop], back[stop] = here + score, at
        return best, back

    def _best(self, units: list[str]) -> Iterator[tuple[tuple[int, ...], float]]:
        """Ids and score of each unit, as `forward` finds them."""
        if not units:
            return iter(())
        kinds = self.steps.kind[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.array([*map(len, units)])
        ends = np.cumsum(sizes)
        side = (sizes <= SIDE_BY_SIDE) & np.logical_and.reduceat(self.steps.single[kinds], ends - sizes)
        found: list = [None] * len(units)
        for i in np.flatnonzero(~side).tolist():
            best, back = self.forward(units[i], {0: 0.0}, 0, len(units[i]))
            found[i] = tuple(self.spelled(_trace(units[i], back, 0, len(units[i])))), best[-1]
        at = np.flatnonzero(side)
        for part in np.split(at, np.flatnonzero(np.diff(ends[at] // SPAN)) + 1):
            if len(part):
                whole = np.repeat(np.isin(np.arange(part[0], part[-1] + 1), part), sizes[part[0] : part[-1] + 1])
                own = self._side_by_side(kinds[ends[part[0]] - sizes[part[0]] : ends[part[-1]]][whole], sizes[part])
                for i, best in zip(part.tolist(), own):
                    found[i] = best
        return iter(found)

    def _side_by_side(self, kinds: np.ndarray, sizes: np.ndarray) -> list[tuple[tuple[int, ...], float]]:
        """`forward` of many short units at once, place by place, from the kinds of all their characters and their sizes.

        Every character must be a piece.
        """
        steps = self.steps
        order = np.argsort(-sizes, kind="stable")
        rank = np.argsort(order)
        here = len(sizes) - np.r_[0, np.cumsum(np.bincount(sizes))[1:-1]]  # units that have a character at a place
        base = np.r_[0, np.cumsum(here)]
        # Characters by place, at each place the longer units first; so those that go on come first everywhere.
        place = np.arange(len(kinds)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        moved = np.empty_like(kinds)
        moved[base[place] + np.repeat(rank, sizes)] = kinds
        kinds, place = moved, np.repeat(np.arange(len(here)), here)
        unit = np.arange(len(kinds)) - base[place]
        reach = np.r_[here, np.zeros(self.longest + 1, np.int64)]
        at, node = np.arange(len(kinds)), steps.next(np.zeros(len(kinds), np.int32), kinds)
        scores, ids, found = [], [], []
        for length in range(1, self.longest + 1):
            score, own = np.full(len(kinds), NONE), np.zeros(len(kinds), np.int32)
            score[at], own[at] = steps.score[node], steps.id[node]
            scores.append(score)
            ids.append(own)
            found.append(np.bincount(place[at[score[at] != NONE]], minlength=len(here)).tolist())
            goes = unit[at] < reach[place[at] + length]
            at, node = at[goes], node[goes]
            node = steps.next(node, kinds[base[place[at] + length] + unit[at]])
            at, node = at[node > 0], node[node > 0]
            if not len(at):
                break
        best, back = [np.zeros(len(sizes))], [np.zeros(len(sizes), np.int8)]
        for stop, n in enumerate(here.tolist(), 1):
            top, last = np.full(n, NONE), np.zeros(n, np.int8)
            for length in range(1, min(stop, len(scores)) + 1):
                start = stop - length
                if not found[length - 1][start]:
                    continue
                reached = best[start][:n] + scores[length - 1][base[start] : base[start] + n]
                better = reached >= top  # of equals, the one that begins first
                top[better], last[better] = reached[better], length
            best.append(top)
            back.append(last)
        first = np.r_[0, np.cumsum([len(x) for x in back])]
        best, back, ids = np.concatenate(best), np.concatenate(back), np.array(ids)
        at, stop, traced = np.arange(len(sizes)), sizes[order], []
        total = best[first[stop] + at]
        while len(at):
            length = back[first[stop] + at]
            stop = stop - length
            traced.append((at, ids[length - 1, base[stop] + at]))
            at, stop = at[stop > 0], stop[stop > 0]
        ends = np.r_[0, np.cumsum(np.bincount(np.concatenate([at for at, _ in traced])))]
        own = np.empty(ends[-1], np.int32)
        for back_from, (at, piece) in enumerate(traced, 1):
            own[ends[at + 1] - back_from] = piece
        own = own.tolist()
        return [(tuple(own[a:b]), score) for a, b, score in zip(ends[rank].tolist(), ends[rank + 1].tolist(), total[rank].tolist())]

    def numbered(self, units: list[str]) -> tuple[_Memory, np.ndarray]:
        """The numbers of these units in the memory; each that is not remembered is looked at once."""
        memory = self._units.get("memory")
        if memory is None or len(memory.numbers) >= REMEMBERED:
            memory = self._units["memory"] = _Memory()
        n = len(memory.numbers)
        numbers = np.fromiter(map(memory.numbers.__getitem__, units), np.int64, len(units))  # new ones get the next numbers
        fresh = [*islice(reversed(memory.numbers), len(memory.numbers) - n)][::-1]
        if fresh:
            memory.add(list(self._best(fresh)))
        return memory, numbers

    def segmented(self, units: list[str]) -> tuple[dict[str, tuple[int, ...]], dict[str, float]]:
        """Ids and scores by unit."""
        memory, numbers = self.numbered(units)
        ids, until, scores = memory.of(numbers)
        parts = np.split(ids, until[:-1])
        return {unit: tuple(own.tolist()) for unit, own in zip(units, parts)}, dict(zip(units, scores))

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """Ids of whole texts, one after the other, where each begins and the last ends, and the scores."""
        per_text = [self.unit.findall(self.normal(text)) for text in texts]
        memory, numbers = self.numbered(list(chain.from_iterable(per_text)))
        ids, until, scores = memory.of(numbers)
        edges = np.cumsum([0, *map(len, per_text)])
        sums = [sum(scores[a:b], 0.0) for a, b in zip(edges.tolist(), edges[1:].tolist())]
        return ids, np.concatenate([[0], until])[edges], sums

    def encode_all(self, texts: list[str]) -> list[tuple[list[int], float]]:
        """Ids and score of whole texts."""
        ids, edges, scores = self.encoded(texts)
        return [(ids[a:b].tolist(), score) for a, b, score in zip(edges, edges[1:], scores)]

    def encode(self, text: str) -> tuple[list[int], float]:
        """Ids and score of a whole text."""
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; without byte pieces, unknown ones give nothing."""
        bodies = self.bodies
        text = b"".join([bodies[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def _trace(text: str, back: list[int], start: int, end: int) -> list[str]:
    """Pieces that end after ``start`` and up to ``end``."""
    out = []
    while end > start:
        out.append(text[back[end] : end])
        end = back[end]
    return out[::-1]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece file; read on the driver, sent to tasks as a value."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError(f"{path} asks for a normalisation that is not supported")
    sp = SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    ]
    bytes_ = tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)) if any(map(sp.is_byte, range(sp.get_piece_size()))) else ()
    scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
    penalty = 10.0
    if model.trainer_spec.model_type == model.trainer_spec.BPE:
        total = math.log(math.fsum(1 / (1 - s) for s in scores.values()))
        scores = {p: float(-round(1024 * (math.log1p(-s) + total))) for p, s in scores.items()}
        penalty *= 1024
    return Vocabulary({sp.id_to_piece(i): i for i in plain}, scores, bytes_, sp.unk_id(), spec.add_dummy_prefix, penalty)


def _parted(v: Vocabulary, text: str, lead: int) -> tuple[int, int, list[str]] | None:
    """The first and the last place from ``lead`` on that no piece reaches across, and the units between them.

    The ends of the text are not known to be such places.
    """
    units = v.unit.findall(text)
    at = first = 0
    while first < len(units) and at < max(1, lead):
        at += len(units[first])
        first += 1
    return (at, len(text) - len(units[-1]), units[first:-1]) if first < len(units) else None


def transfer(v: Vocabulary, text: str, lead: int) -> np.ndarray:
    """Best score from each state at ``lead`` to each state at the end of ``text``.

    A state is the distance back to the last border. ``text`` begins ``lead`` characters before the chunk.
    """
    k, end = v.longest, len(text)
    out = np.full((k, k), NONE)
    head_end, tail_start, units = _parted(v, text, lead) or (end, None, [])
    heads = []
    for state in range(k):
        if state > lead:
            heads.append(None)
            continue
        heads.append(v.forward(text, {lead - state: 0.0}, lead, head_end)[0])
    if tail_start is None:
        for state, best in enumerate(heads):
            if best:
                out[state, : min(k, end - lead + 1)] = best[end : max(lead, end - k + 1) - 1 if max(lead, end - k + 1) else None : -1][:k]
        return _closed(out, lead, end, k)
    memory, numbers = v.numbered(units)
    middle = sum(memory.of(numbers)[2])
    tail = v.forward(text, {tail_start: 0.0}, tail_start, end)[0]
    ends = np.full(k, NONE)
    for state in range(min(k, end - tail_start + 1)):
        ends[state] = tail[end - state]
    starts = np.array([h[head_end] if h else NONE for h in heads])
    return starts[:, None] + middle + ends[None, :]


def _closed(matrix: np.ndarray, lead: int, end: int, k: int) -> np.ndarray:
    """A border of the end state must lie in the chunk: after its start, or at it for the state that starts there."""
    for state in range(1, k):
        reach = end - lead  # the state whose border is the chunk's own start
        if reach < k:
            matrix[state, reach] = NONE
    return matrix


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _entered(entry: np.ndarray, lead: int) -> dict[int, float]:
    """Places and scores of the borders that the states at a chunk's start stand for."""
    return {lead - s: float(entry[s]) for s in range(min(lead, len(entry) - 1), -1, -1) if entry[s] != NONE}


def _origin(back: list[int], lead: int, at: int) -> int:
    """The state at the chunk's start from which the border at ``at`` is reached."""
    while at > lead:
        at = back[at]
    return lead - at


def backward(v: Vocabulary, text: str, lead: int, entry: np.ndarray) -> list[int]:
    """For each state at the end, the state at the start it is reached from, or -1."""
    end, parted = len(text), _parted(v, text, lead)
    best, back = v.forward(text, _entered(entry, lead), lead, parted[0] if parted else end)
    places = [end - state for state in range(v.longest)]
    if not parted:
        return [_origin(back, lead, at) if at >= lead and best[at] != NONE else -1 for at in places]
    head_end, tail_start, _ = parted
    # Every segmentation has a border where the head ends, so all states at the end come from one at the start.
    origin = _origin(back, lead, head_end) if best[head_end] != NONE else -1
    tail = v.forward(text, {tail_start: 0.0}, tail_start, end)[0]
    return [origin if at >= tail_start and tail[at] != NONE else -1 for at in places]


def _split(v: Vocabulary, size: int) -> Callable[[pa.RecordBatch], dict]:
    def split(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"rid": [], "no": [], "lead": [], "part": []}
        for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
            whole = v.normal(text)
            n = max(1, len(whole) // size)  # the last chunk takes the rest
            for no in range(n):
                start, stop = no * size, (no + 1) * size if no + 1 < n else len(whole)
                lead = min(start, v.longest - 1)
                out["rid"].append(rid)
                out["no"].append(no)
                out["lead"].append(lead)
                out["part"].append(whole[start - lead : stop].encode("utf-8", "surrogatepass"))
        return out

    return split


def _each(rows: DataFrame, shared: Broadcast, work: Callable[[Vocabulary, dict], list], keep: str, out: str) -> DataFrame:
    """A chunk at a time: ``rid``, ``no`` and what ``work`` returns for it."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batch: pa.RecordBatch) -> dict:
        made = [work(shared.value, row | {"part": row["part"].decode("utf-8", "surrogatepass")}) for row in batch.to_pylist()]
        return {c: batch.column(c) for c in names} | {out.split()[0]: _lists(made) if out.endswith("array<int>") else made}

    return arrow_map(rows, run, f"{keep}, {out}")


def _grouped(rows: DataFrame, keys: list[str], work: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    target = arrow_schema(schema)
    return rows.groupBy(*keys).applyInArrow(
        lambda table: pa.Table.from_pylist(work(table.sort_by("no").to_pylist()), schema=target), schema
    )


def _entries(matrices: DataFrame, k: int) -> DataFrame:
    """``entry`` of every chunk, the best scores of the states at its start: a two-level scan from the left."""

    def square(x: list[float]) -> np.ndarray:
        return np.array(x).reshape(k, k)

    def reduced(rows: list[dict]) -> list[dict]:
        total = square(rows[0]["matrix"])
        for row in rows[1:]:
            total = product(total, square(row["matrix"]))
        return [{"rid": rows[0]["rid"], "no": rows[0]["block"], "matrix": total.ravel().tolist()}]

    def scanned(rows: list[dict]) -> list[dict]:
        state = np.full(k, NONE)
        state[0] = 0.0
        out = []
        for row in rows:
            out.append({"rid": row["rid"], "block": row["no"], "start": state.tolist()})
            state = (state[:, None] + square(row["matrix"])).max(axis=0)
        return out

    def spread(rows: list[dict]) -> list[dict]:
        state = np.array(rows[0]["start"])
        out = []
        for row in rows:
            out.append({"rid": row["rid"], "no": row["no"], "entry": state.tolist()})
            state = (state[:, None] + square(row["matrix"])).max(axis=0)
        return out

    blocks = _grouped(matrices, ["rid", "block"], reduced, "rid bigint, no int, matrix array<double>")
    starts = _grouped(blocks, ["rid"], scanned, "rid bigint, block int, start array<double>")
    return _grouped(matrices.join(starts, ["rid", "block"]), ["rid", "block"], spread, "rid bigint, no int, entry array<double>")


def _exits(maps: DataFrame) -> DataFrame:
    """``leave`` of every chunk, the state at its end: maps composed in two levels from the right."""

    def reduced(rows: list[dict]) -> list[dict]:
        total = list(range(len(rows[0]["map"])))
        for row in reversed(rows):
            total = [row["map"][s] if s >= 0 else -1 for s in total]
        return [{"rid": rows[0]["rid"], "no": rows[0]["block"], "map": total}]

    def scanned(rows: list[dict]) -> list[dict]:
        state, out = 0, []
        for row in reversed(rows):
            out.append({"rid": row["rid"], "block": row["no"], "stop": state})
            state = row["map"][state]
        return out

    def spread(rows: list[dict]) -> list[dict]:
        state, out = rows[0]["stop"], []
        for row in reversed(rows):
            out.append({"rid": row["rid"], "no": row["no"], "leave": state})
            state = row["map"][state]
        return out

    blocks = _grouped(maps, ["rid", "block"], reduced, "rid bigint, no int, map array<int>")
    stops = _grouped(blocks, ["rid"], scanned, "rid bigint, block int, stop int")
    return _grouped(maps.join(stops, ["rid", "block"]), ["rid", "block"], spread, "rid bigint, no int, leave int")


def _traced(v: Vocabulary, row: dict) -> list[int]:
    """Ids of the pieces that end in the chunk, up to the state it leaves in."""
    text, lead, stop = row["part"], row["lead"], len(row["part"]) - row["leave"]
    parted = _parted(v, text, lead)
    back = v.forward(text, _entered(np.array(row["entry"]), lead), lead, parted[0] if parted else len(text))[1]
    if not parted:
        return v.spelled(_trace(text, back, lead, stop))
    head_end, tail_start, units = parted
    ids = v.spelled(_trace(text, back, lead, head_end))
    memory, numbers = v.numbered(units)
    ids += memory.of(numbers)[0].tolist()
    back = v.forward(text, {tail_start: 0.0}, tail_start, len(text))[1]
    return ids + v.spelled(_trace(text, back, tail_start, stop))


def encode_giants(texts: DataFrame, vocabulary: Broadcast, size: int) -> DataFrame:
    """``rid``, ``ids`` and ``score`` of every text (``rid``, ``text``) by the parallel scan; stored tables in between."""
    v = vocabulary.value
    k = v.longest
    block = F.expr(f"no div {BLOCK}").cast("int").alias("block")
    chunks = materialize(arrow_map(texts, _split(v, size), "rid bigint, no int, lead int, part binary"), "chunks")
    matrices = _each(chunks, vocabulary, lambda v, row: transfer(v, row["part"], row["lead"]).ravel().tolist(), "rid bigint, no int", "matrix array<double>")
    matrices = materialize(matrices.select("*", block), "matrices")
    entries = materialize(_entries(matrices, k), "entries")
    entered = chunks.join(entries, ["rid", "no"])
    maps = _each(entered, vocabulary, lambda v, row: backward(v, row["part"], row["lead"], np.array(row["entry"])), "rid bigint, no int", "map array<int>")
    exits = materialize(_exits(materialize(maps.select("*", block), "maps")), "exits")
    traced = _each(entered.join(exits, ["rid", "no"]), vocabulary, _traced, "rid bigint, no int", "ids array<int>")
    # The best score of the whole text: the last chunk's entry against its matrix, in state 0.
    last = matrices.join(entries, ["rid", "no"]).groupBy("rid").agg(F.max_by(F.struct("entry", "matrix"), "no").alias("at"))
    final = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda s: F.get("at.entry", s) + F.get("at.matrix", s * k)))
    parts = F.array_sort(F.collect_list(F.struct("no", "ids")))
    ids = traced.groupBy("rid").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    return ids.join(last.select("rid", final.alias("score")), "rid")


def _arrow_schema_of(rows: DataFrame, added: str, without: tuple[str, ...] = ()) -> tuple[list[str], str]:
    own = [f for f in rows.schema if f.name not in without]
    return [f.name for f in own], ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own), added])


def encode(docs: DataFrame, path: str = MODEL, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The rows with ``ids`` and ``score``; texts of more than ``chunk`` characters go through the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    rows = docs.drop("ids", "score")
    names, schema = _arrow_schema_of(rows, "ids array<int>, score double")

    def encoded(batch: pa.RecordBatch) -> dict:
        v = shared.value
        texts = batch.column(text).to_pylist()
        missing = np.array([t is None for t in texts], bool)
        ids, edges, scores = v.encoded([t or "" for t in texts])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids), mask=pa.array(missing))
        return {c: batch.column(c) for c in names} | {"ids": lists, "score": pa.array(scores, pa.float64(), mask=missing)}

    giant = F.coalesce(F.char_length(text) > chunk, F.lit(False))
    short = arrow_map(rows.filter(~giant), encoded, schema)
    giants = materialize(rows.filter(giant).withColumn("__rid", F.monotonically_increasing_id()), "giants")
    scanned = encode_giants(giants.select(F.col("__rid").alias("rid"), F.col(text).alias("text")), shared, chunk)
    long = giants.join(scanned.withColumnRenamed("rid", "__rid"), "__rid").drop("__rid")
    return short.unionByName(long.select(*short.columns))


def _lists(values: list[list[int] | None]) -> pa.Array:
    """Lists of ids as an Arrow array, without a Python object per id on the way."""
    sizes = np.array([0 if x is None else len(x) for x in values], np.int64)
    flat = np.fromiter(chain.from_iterable(x for x in values if x), np.int32, int(sizes.sum()))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    mask = pa.array([x is None for x in values])
    return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=mask)


def _id_lists(column: pa.ListArray) -> list[list[int] | None]:
    """The reverse: lists cut from one, without an Arrow scalar per id on the way."""
    if column.values.null_count:
        return column.to_pylist()
    ends = column.offsets.to_numpy()
    flat = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy().tolist()
    at = (ends - ends[0]).tolist()
    return [flat[a:b] if valid else None for a, b, valid in zip(at, at[1:], column.is_valid().to_pylist())]


def decode(rows: DataFrame, path: str = MODEL, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of ``ids``."""
    shared = rows.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    names, schema = _arrow_schema_of(rows.drop(out), f"{out} string")

    def decoded(batch: pa.RecordBatch) -> dict:
        v = shared.value
        texts = [None if x is None else v.decode(x) for x in _id_lists(batch.column(ids))]
        return {c: batch.column(c) for c in names} | {out: texts}

    return arrow_map(rows.drop(out), decoded, schema)
