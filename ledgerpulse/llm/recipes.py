"""Exact duplicates through content-defined chunks: texts are equal when their chunk recipes are.

A text, without its white space, is cut where a rolling hash of the last 32 bytes meets a pattern, so
a passage that many documents share is cut alike in all of them. Chunks are named by a BLAKE2 digest; a
store of the distinct chunks, grouped by their bytes, verifies that every name stands for one content.
A document is then its recipe, the ordered list of names, about 1% of its length: documents are
grouped, compared and joined by recipe, and a long text is read where it lies but never moved whole;
of its chunks one copy per task goes to the store.

Should two contents ever share a name, the documents that hold it are cut again and the ordinal of the
content among those of its name is added to the recipe, so the result does not rest on the digest.

Defined results: null counts as the empty text, whose recipe is empty; all such rows are one group. Of
equal texts the row with the most code points in the original stays, then the smallest id; a null id
comes after all others. Rows that repeat an id and a text are one row each and share ``kept``. Other
columns of the input are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import WHITE, arrow_map, keyed_join, utf8
from ledgerpulse.sources.workspace import materialize

#: Shortest and longest chunk in bytes; a cut is expected every 2 ** CUT_BITS bytes in between.
SHORTEST, LONGEST, CUT_BITS = 256, 8192, 10
_GEAR = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bytes hashed at once, which bounds the memory for a giant text.
_SPAN = 1 << 20


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length. Empty data has none.

    The hash at a byte is the sum of a random word for each of the last 32 bytes, shifted by its
    distance; five doublings give it for all positions at once.
    """
    size = len(data)
    if size <= SHORTEST:
        return [size] if size else []
    marks = []
    for start in range(0, size, _SPAN):
        lead = min(start, 31)
        h = _GEAR[np.frombuffer(data, np.uint8, min(_SPAN, size - start) + lead, start - lead)]
        for step in (1, 2, 4, 8, 16):
            shifted = h[:-step] << np.uint32(step)
            h = h.copy()
            h[step:] += shifted
        marks.append(np.flatnonzero((h[lead:] >> np.uint32(32 - CUT_BITS)) == 0) + start + 1)
    ends, last = [], 0
    for end in [*np.concatenate(marks).tolist(), size]:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end - last >= SHORTEST or end == size and end > last:
            last = end
            ends.append(end)
    return ends


def chunks(text: bytes | None) -> list[bytes]:
    """The chunks of a text without its white space, in order."""
    data = (text or b"").translate(None, WHITE)
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _name(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def chunk_store(docs: DataFrame, name_bytes: int = 16) -> DataFrame:
    """Every distinct chunk of all texts with its name."""

    def cut(batch: pa.RecordBatch) -> dict:
        found = {c for text in utf8(batch.column("text")) for c in chunks(text)}
        return {"name": [_name(c, name_bytes) for c in found], "chunk": list(found)}

    return arrow_map(docs.select("text"), cut, "name binary, chunk binary").distinct()


def _recipes(docs: DataFrame, key: str, name_bytes: int) -> DataFrame:
    def recipe(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        plain = [(t or b"").translate(None, WHITE) for t in texts]
        return {
            key: batch.column(key),
            "points": batch.column("points"),
            "recipe": [b"".join(_name(c, name_bytes) for c in chunks(p)) for p in plain],
            "text_sha256": [hashlib.sha256(p).hexdigest() for p in plain],
        }

    rows = docs.select(key, "text", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("points"))
    type_ = dict(docs.dtypes)[key]
    return arrow_map(rows, recipe, f"`{key}` {type_}, points bigint, recipe binary, text_sha256 string")


def _told_apart(docs: DataFrame, recipes: DataFrame, shared: DataFrame, key: str, name_bytes: int) -> DataFrame:
    """Recipes of the documents that hold a name of several contents, with the ordinal of each content.

    ``shared`` has those names with all their contents. The documents' own chunks of such names are
    listed, numbered through a join with it and put behind the plain recipe in the order of the text.
    """
    numbered = shared.select(
        "name", "chunk", F.row_number().over(_by_name()).cast("bigint").alias("ordinal")
    )

    def occurrences(batch: pa.RecordBatch) -> dict:
        rows = [
            (i, p, _name(c, name_bytes), c)
            for i, text in enumerate(utf8(batch.column("text")))
            for p, c in enumerate(chunks(text))
        ]
        ids, hashes = batch.column(key), batch.column("text_sha256")
        at = pa.array([r[0] for r in rows], pa.int64())
        return {
            key: ids.take(at), "text_sha256": hashes.take(at), "position": [r[1] for r in rows],
            "name": [r[2] for r in rows], "chunk": [r[3] for r in rows],
        }

    type_ = dict(docs.dtypes)[key]
    bare = F.translate(F.coalesce("text", F.lit("")), WHITE.decode(), "")
    listed = arrow_map(
        docs.select(key, "text", F.sha2(bare, 256).alias("text_sha256")), occurrences,
        f"`{key}` {type_}, text_sha256 string, position bigint, name binary, chunk binary",
    )
    # The tail depends on the text alone, so rows that repeat a text need it once.
    found = listed.select("text_sha256", "position", "name", "chunk").distinct().join(numbered, ["name", "chunk"])
    tail = found.groupBy("text_sha256").agg(
        F.concat_ws(",", F.transform(
            F.array_sort(F.collect_list(F.struct("position", "ordinal"))), lambda x: x["ordinal"].cast("string")
        )).alias("tail")
    )
    joined = keyed_join(recipes, tail, ["text_sha256"], "left")
    return joined.withColumn("recipe", F.concat("recipe", F.coalesce("tail", F.lit("")).cast("binary"))).drop("tail")


def _by_name():
    from pyspark.sql import Window

    return Window.partitionBy("name").orderBy("chunk")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", name_bytes: int = 16) -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the bare text."""
    names = chunk_store(docs, name_bytes)
    per_name = names.groupBy("name").agg(F.count(F.lit(1)).alias("contents"))
    shared = materialize(per_name.filter("contents > 1").select("name"), "names")
    recipes = materialize(_recipes(docs, key, name_bytes), "recipes")
    if not shared.isEmpty():
        contents = names.join(shared, "name", "left_semi")
        recipes = materialize(_told_apart(docs, recipes, contents, key, name_bytes), "recipes")
    # Least (-points, id) with a null id last.
    first = F.min(F.struct((-F.col("points")).alias("less"), F.col(key).isNull().alias("none"), F.col(key).alias("id")))
    groups = recipes.groupBy("recipe").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    joined = keyed_join(recipes, groups, ["recipe"])
    return joined.select(
        key, F.col("first.id").alias("keep_id"), "group_size",
        F.col(key).eqNullSafe(F.col("first.id")).alias("kept"), "text_sha256",
    )
