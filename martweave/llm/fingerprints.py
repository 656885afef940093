"""Document fingerprints by Order MinHash.

Every k-mer of a text (k code points) is numbered by how often it has occurred
before. A permutation, here a keyed hash, orders the numbered k-mers; the ``l``
least are taken, put back into text order, and their contents are hashed as one
tuple. ``m`` permutations give a signature of ``m`` tuple hashes. Two texts
agree in a tuple when they share the k-mers, their multiplicities *and* their
order, so the share of equal tuples falls with the edit distance, not only with
the overlap of the k-mer sets.

A text is signed in one pass of array operations, and long texts are worked
through a few permutations at a time, so that memory grows with the text's
length only. Signing needs no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.common import add_column, partitions, settled, whole_text
from martweave.llm.rolling import Rolling, mixed

K, L, M = 8, 2, 64
_CELLS = 1 << 21
_TOP = np.uint32(0xFFFFFFFF)


def _keys(m: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    words = (seeds >> np.uint64(32)).astype(np.uint32)
    return words[:m, None], words[m:, None] | np.uint32(1)


def _numbered(grams: np.ndarray) -> np.ndarray:
    """For each gram, how many equal grams stand before it."""
    n = len(grams)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    place = np.uint64((1 << int(bits)) - 1)
    keys = np.sort((grams & ~place) | np.arange(n, dtype=np.uint64))
    at, value = (keys & place).astype(np.int64), keys >> bits
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = value[1:] != value[:-1]
    starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    number = np.empty(n, dtype=np.uint64)
    number[at] = (np.arange(n) - starts).astype(np.uint64)
    return number


def signature(text: str, k: int = K, l: int = L, m: int = M) -> np.ndarray:
    """``m`` 32-bit tuple hashes; none for an empty text. A text shorter than ``k`` is one k-mer."""
    symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(symbols):
        return np.zeros(0, dtype=np.uint32)
    grams = Rolling(symbols).grams(min(k, len(symbols)))
    hashes = (mixed(grams ^ (_numbered(grams) * np.uint64(0xD6E8FEB86659FD93))) >> np.uint64(32)).astype(np.uint32)
    seeds, factors = _keys(m)
    n, count = len(grams), min(l, len(grams))
    chosen = np.empty((m, count), dtype=np.int64)
    step = max(1, _CELLS // n)
    for low in range(0, m, step):
        rows = (hashes[None, :] ^ seeds[low : low + step]) * factors[low : low + step]
        every = np.arange(len(rows))
        for j in range(count):
            least = rows.argmin(axis=1)
            chosen[low : low + step, j] = least
            rows[every, least] = _TOP
    chosen.sort(axis=1)
    tuples = np.zeros(m, dtype=np.uint64)
    for j in range(count):
        tuples = mixed((tuples + np.uint64(j + 1)) * np.uint64(0x9E3779B97F4A7C15) ^ grams[chosen[:, j]])
    return (tuples >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples, 0 to 1; two empty texts are alike, an empty and another text are not."""
    if len(a) != len(b):
        return 0.0
    return float(np.mean(a == b)) if len(a) else 1.0


def written(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def add_fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", k: int = K, l: int = L, m: int = M) -> DataFrame:
    """``docs`` with the fingerprint of ``text_col`` as lowercase hex, 8 digits per tuple.

    A null or empty text has the empty fingerprint; equal texts have equal
    fingerprints. A column called ``name`` is replaced, all others stay.
    """

    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([written(signature(t, k, l, m)) for t in texts.to_pylist()], pa.string())

    return add_column(docs, name, T.StringType(), text_col, compute)


_MID = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double, part int, edge int, text string, place bigint"
)


def with_next_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit by the next text, in descending order of ids.

    The edit replaces the last third of the code points (rounded down) by as
    many from the start of the next text, or all of it; after the last document
    comes the first. Null ids come last, equal ids are in descending order of the
    64-bit hash of the text (Spark's xxhash64), then of the text. A single document
    is its own next.

    Texts are range-sorted once and passed through in order. Only the last
    document of each partition lacks its next one; it is finished from a small
    table of partition edges, whose size is the number of partitions.
    """
    spark = docs.sparkSession
    # Bounds of the ranges are sampled on the driver, so no text is part of them.
    bounds = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()]
    order = [*bounds, F.col("text").desc()]
    laid = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
        .repartitionByRange(partitions(spark), *bounds)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    done = settled(laid.mapInArrow(_pass, _MID), "fingerprints")
    edges = done.where("edge > 0")
    firsts = edges.where("edge in (1, 3)").select("part", "text", "fingerprint")
    ring = spark.createDataFrame(_ring([r[0] for r in firsts.select("part").collect()]), "part int, next_part int")
    pairs = (
        edges.where("edge >= 2")
        .join(ring, "part")
        .join(
            firsts.select(
                F.col("part").alias("next_part"),
                F.col("text").alias("next_text"),
                F.col("fingerprint").alias("next_fingerprint"),
            ),
            "next_part",
        )
    )
    finished = pairs.select(*done.columns, "next_text", "next_fingerprint").mapInArrow(_finish, _MID)
    return done.where("edge < 2").unionByName(finished).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def _ring(parts: list[int]) -> list[tuple[int, int]]:
    parts = sorted(parts)
    return list(zip(parts, parts[1:] + parts[:1], strict=True))


def _edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _row(doc_id, text: str, sig: np.ndarray, following: str | None, next_sig: np.ndarray | None, part: int, edge: int):
    row = {"doc_id": doc_id, "n_chars": len(text), "fingerprint": sig.astype(">u4").tobytes(), "part": part, "edge": edge}
    row["text"] = text if edge else None
    if following is not None:
        edited = _edited(text, following)
        edited_sig = sig if edited == text else signature(edited)
        row["edited_sha256"] = hashlib.sha256(edited.encode()).hexdigest()
        row["edited_fingerprint"] = edited_sig.astype(">u4").tobytes()
        row["near_edited"], row["near_next"] = likeness(sig, edited_sig), likeness(sig, next_sig)
    return row


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("part", pa.int32()),
        ("edge", pa.int32()),
        ("text", pa.string()),
        ("place", pa.int64()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition in order. ``edge``: 1 for the first row, 2 for the last, 3 for an only row."""
    held = None
    first = True
    for batch in batches:
        rows = []
        for doc_id, text, part in zip(*(batch.column(i) for i in range(3)), strict=True):
            doc_id, text, part = doc_id.as_py(), text.as_py(), part.as_py()
            sig = held[2] if held and held[1] == text else signature(text)
            if held:
                rows.append(_row(*held[:3], text, sig, part, int(first)))
                first = False
            held = (doc_id, text, sig, part)
        if rows:
            yield _batch(rows)
    if held:
        yield _batch([_row(*held[:3], None, None, held[3], 3 if first else 2)])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            sig, next_sig = (np.frombuffer(r[c], dtype=">u4") for c in ("fingerprint", "next_fingerprint"))
            rows.append(_row(r["doc_id"], r["text"], sig, r["next_text"], next_sig, r["part"], 0))
        yield _batch(rows)
