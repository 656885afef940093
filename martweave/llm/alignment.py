"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over a corpus.

A text's bytes (one blank, then the text) are cut into tokens twice, by a byte-level
merge model A and a sentencepiece model B. Offsets where tokens of both end cut
the tokens into groups; two tokens are linked where their bytes overlap. The
count of a pair of ids is the number of documents that hold the pair linked.

Counting is external and in sorted runs:

1. Each task cuts its documents into *runs* of about ``RUN_LINKS`` links. A run's
   pair-document records are sorted by pair (A id first) and document; documents
   of a pair are counted, and pairs are dealt by the radix of their A id into zstd
   blocks. The records stay with the run.
2. Blocks meet by radix, twice each: first they are merged in a k-way heap, which
   counts every pair, and as all pairs of an A id follow each other, finds each A id's
   highest count; then they pass by once more and go back to their runs with
   the counts and marks of their pairs.
3. A run adds up the counts over its documents' links.

So no record of a document is shuffled by pair: a pair that every document holds is
one row per run. What a merging task holds is one radix's table, bounded by the
vocabularies, and ``FAN_IN`` blocks. Spark's shuffle sorts and spills the blocks.

Both models cut a text independently at every single blank between two other
characters (checked for B's pieces, else texts are taken whole), so what lies
between such blanks is tokenised and aligned once per task and looked up after.

Defined cases:

* Texts that are null, empty, or whose joined tokens of A or B are not the bytes of
  blank and text (a literal U+2581, say) have no tokens: zeros and the empty digest ``''``.
* Every row is a document: repeated rows and repeated or null ids are counted
  and returned one by one. Ties for the highest count all are highest.
* A text is one task's work, whatever its length; it is never cut.
* An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.llm.common import partitions, settled, whole_text

RUN_LINKS = 1 << 21
RADIX_BITS = 8
FAN_IN = 64
STEP = 1 << 20  # code points that are tokenised and looked up at once
CACHE_UNITS, CACHE_LINKS = 300_000, 3_000_000

# A key holds an A id, a B id and a document's place in its run, in 20, 20 and 24 bits.
_ID_BITS, _DOC_BITS = 20, 24
_SPREAD = 0x9E3B5  # odd: A ids are permuted, so that the radix parts frequent ids evenly
_MARK = "▁"
_UNIT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


# ---- two tokenizers


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Pair:
    """Both tokenizers, and the bytes of each of their tokens."""

    first: object
    second: object
    first_bytes: list[bytes]
    second_bytes: list[bytes]
    parts: bool  # whether single blanks cut texts

    def __post_init__(self) -> None:
        self.first_sizes, self.second_sizes = list(map(len, self.first_bytes)), list(map(len, self.second_bytes))
        self.first_keys = [first_key(i) for i in range(len(self.first_bytes))]

    def tokenise(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        encoded = self.first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in encoded], self.second.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def load_pair(byte_bpe: str, piece_model: str) -> Pair:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(byte_bpe)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    known, vocabulary = byte_characters(), first.get_vocab(with_added_tokens=True)
    if max(len(vocabulary), second.get_piece_size()) > 1 << _ID_BITS:
        raise ValueError(f"vocabularies of more than {1 << _ID_BITS} ids are not supported")
    first_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        plain = all(c in known for c in token)
        first_bytes[i] = bytes(known[c] for c in token) if plain else token.encode()
    pieces = [second.id_to_piece(i) for i in range(second.get_piece_size())]
    second_bytes = []
    for piece in pieces:
        byte = _BYTE_PIECE.fullmatch(piece)
        second_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_MARK, " ").encode())
    return Pair(first, second, first_bytes, second_bytes, not any(_MARK in p.lstrip(_MARK) for p in pieces))


# ---- alignment of one stretch of text


@dataclass
class Aligned:
    """A stretch's number of A's tokens, its linked id pairs as codes, and its groups as text."""

    n_a: int
    codes: np.ndarray
    groups: str


def first_key(a: int) -> int:
    """The A id's part of a pair's code: permuted, before the bits of the B id."""
    return ((a * _SPREAD) & ((1 << _ID_BITS) - 1)) << _ID_BITS


def align(pair: Pair, text: str, a_ids: list[int], b_ids: list[int]) -> Aligned | None:
    """The alignment of a text's tokens; None where their bytes are not blank and text."""
    raw = b" " + text.encode()
    if b"".join([pair.first_bytes[i] for i in a_ids]) != raw or b"".join([pair.second_bytes[i] for i in b_ids]) != raw:
        return None
    sizes, widths, keys = pair.first_sizes, pair.second_sizes, pair.first_keys
    if len(a_ids) == 1 or len(b_ids) == 1:  # one token covers all: one group, every pair linked
        codes = [keys[a] | b for a in a_ids for b in b_ids]
        group = f"{','.join(map(str, a_ids))}|{','.join(map(str, b_ids))}"
        return Aligned(len(a_ids), np.array(codes, dtype=np.uint64), group)
    codes, groups, a_start, b_start, i, j = [], [], 0, 0, 0, 0
    gap = sizes[a_ids[0]] - widths[b_ids[0]]  # by how many bytes the present token of A ends after that of B
    while True:
        codes.append(keys[a_ids[i]] | b_ids[j])
        if gap < 0:
            i += 1
            gap += sizes[a_ids[i]]
        elif gap > 0:
            j += 1
            gap -= widths[b_ids[j]]
        else:
            i, j = i + 1, j + 1
            if i - a_start == 1 and j - b_start == 1:
                groups.append(f"{a_ids[a_start]}|{b_ids[b_start]}")
            else:
                groups.append(f"{','.join(map(str, a_ids[a_start:i]))}|{','.join(map(str, b_ids[b_start:j]))}")
            if i == len(a_ids):
                break
            a_start, b_start = i, j
            gap = sizes[a_ids[i]] - widths[b_ids[j]]
    return Aligned(len(a_ids), np.array(codes, dtype=np.uint64), ";".join(groups))


# A stretch in the table: its groups as text (None: no tokens), its number of A's tokens, its links' codes.
Known = tuple[str | None, int, np.ndarray]


class Units:
    """Alignments of the stretches seen so far; a table of bounded size that only saves work."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.known: dict[str, Known] = {}
        self.failed: set[str] = set()
        self.links = 0

    def learn(self, texts: list[str]) -> None:
        if not texts:
            return
        for text, a_ids, b_ids in zip(texts, *self.pair.tokenise(texts)):
            found = align(self.pair, text, a_ids, b_ids)
            if found is None:
                self.failed.add(text)
                self.known[text] = (None, 0, np.zeros(0, np.uint64))
            else:
                self.known[text] = (found.groups, found.n_a, found.codes)
                self.links += len(found.codes)

    def make_room(self, wanted: set[str]) -> None:
        """Forgets a full table but for what is ``wanted`` now, which is most of what is frequent."""
        if len(self.known) > CACHE_UNITS or self.links > CACHE_LINKS:
            self.known = {s: self.known[s] for s in wanted if s in self.known}
            self.failed &= self.known.keys()
            self.links = sum(len(codes) for _, _, codes in self.known.values())


@lru_cache(maxsize=2)
def shared_units(byte_bpe: str, piece_model: str) -> Units:
    """One table for all tasks that a worker process runs."""
    return Units(load_pair(byte_bpe, piece_model))


def aligned_texts(units: Units, texts: list[str]) -> Iterator[tuple[tuple[int, int, int, int], str, list[np.ndarray]]]:
    """Counts (tokens of A and of B, groups, links), digest and link codes of each text."""
    stretches = [_UNIT.split(t) if units.pair.parts else [t] for t in texts]
    wanted = set().union(*stretches)
    wanted.discard("")
    units.make_room(wanted)
    units.learn(sorted(wanted - units.known.keys()))
    # Where a stretch fails by itself, only the whole text can tell.
    failed = [i for i, t in enumerate(texts) if t and units.failed and not units.failed.isdisjoint(stretches[i])]
    units.learn(sorted({texts[i] for i in failed} - units.known.keys()))
    for i in failed:
        stretches[i] = [texts[i]]
    known = units.known
    for text, of_text in zip(texts, stretches):
        found = [known[s] for s in of_text] if text else []
        if not found or found[0][0] is None:
            yield (0, 0, 0, 0), "", []
            continue
        whole = ";".join([f[0] for f in found]).encode()
        codes = np.concatenate([f[2] for f in found])
        n_a, n_groups, n_links = sum([f[1] for f in found]), whole.count(b";") + 1, len(codes)
        # Every end of a token but the common ones ends one link, and each common end ends one link too.
        yield (n_a, n_links + n_groups - n_a, n_groups, n_links), hashlib.sha256(whole).hexdigest(), [codes]


# ---- runs


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as zstd: the bytes of equal weight stand together."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=3).compress(bytes([width]) + planes.tobytes())


def unpack(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), dtype=np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), dtype=np.uint8)
    out[:, :width] = raw[1:].reshape(width, -1).T
    return out.view(np.uint64).ravel()


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])


def _widths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


def pair_block(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pair codes and their counts."""
    return pack(np.concatenate([np.diff(codes, prepend=np.uint64(0)), counts.astype(np.uint64)]))


def open_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = unpack(block)
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.uint64), both[half:]


_DOC_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
_RUN_SCHEMA = (
    "run bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>,"
    " groups_sha256 array<string>, holders binary, times binary, per_pair binary, blocks array<binary>"
)


class Run:
    """Documents and their links, until the run is written."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.counts: list[tuple[int, int, int, int]] = []
        self.digests: list[str] = []
        self.keys: list[np.ndarray] = []
        self.links = 0

    def add(self, doc_id: int | None, counts, digest: str, codes: list[np.ndarray]) -> None:
        if codes:
            keys = np.concatenate(codes) << np.uint64(_DOC_BITS)
            keys |= np.uint64(len(self.ids))
            self.keys.append(keys)
            self.links += len(keys)
        self.ids.append(doc_id)
        self.counts.append(counts)
        self.digests.append(digest)

    def full(self, run_links: int) -> bool:
        return self.links >= run_links or len(self.ids) >= (1 << _DOC_BITS) - 1

    def row(self, number: int, radix_bits: int) -> dict:
        keys = np.sort(np.concatenate(self.keys)) if self.keys else np.zeros(0, np.uint64)
        starts = _starts(keys)
        times = _widths(starts, len(keys))
        records = keys[starts]
        codes = records >> np.uint64(_DOC_BITS)
        places = records & np.uint64((1 << _DOC_BITS) - 1)
        firsts = _starts(codes)
        per_pair = _widths(firsts, len(codes))
        steps = np.diff(places, prepend=np.uint64(0))
        steps[firsts] = places[firsts]
        pairs = codes[firsts]
        radix = pairs >> np.uint64(2 * _ID_BITS - radix_bits)
        cuts = np.searchsorted(radix, np.arange((1 << radix_bits) + 1, dtype=np.uint64))
        blocks = [pair_block(pairs[a:b], per_pair[a:b]) if b > a else None for a, b in zip(cuts[:-1], cuts[1:])]
        row = {"run": number, "doc_id": self.ids, "groups_sha256": self.digests, "blocks": blocks}
        row |= {name: [c[i] for c in self.counts] for i, name in enumerate(_DOC_COLUMNS)}
        return row | {"holders": pack(steps), "times": pack(times), "per_pair": pack(per_pair)}


def _slices(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    low = size = 0
    for high, text in enumerate(texts):
        if high > low and size + len(text) > STEP:
            yield ids[low:high], texts[low:high]
            low, size = high, 0
        size += len(text)
    if low < len(texts):
        yield ids[low:], texts[low:]


def _record(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_ARROW_RUN = pa.schema(
    [("run", pa.int64()), ("doc_id", pa.list_(pa.int64())), *[(n, pa.list_(pa.int64())) for n in _DOC_COLUMNS]]
    + [("groups_sha256", pa.list_(pa.string())), ("holders", pa.binary()), ("times", pa.binary()), ("per_pair", pa.binary())]
    + [("blocks", pa.list_(pa.binary()))]
)


def runs_of(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str, text_col: str, run_links: int, radix_bits: int) -> DataFrame:
    """The corpus as runs: one row per run, in the columns of ``_RUN_SCHEMA``."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"), F.spark_partition_id().alias("part")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, run, number = shared_units(byte_bpe, piece_model), Run(), None
        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column("part")[0].as_py() << 32
            for ids, texts in _slices(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for doc_id, found in zip(ids, aligned_texts(units, texts)):
                    run.add(doc_id, *found)
                    if run.full(run_links):
                        yield _record(_ARROW_RUN, [run.row(number, radix_bits)])
                        run, number = Run(), number + 1
        if run.ids:
            yield _record(_ARROW_RUN, [run.row(number, radix_bits)])

    return rows.mapInArrow(cut, _RUN_SCHEMA)


# ---- counting


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pair codes and summed counts of several sorted runs, by a k-way heap merge."""
    if len(runs) == 1:
        return runs[0]
    codes, totals, last = [], [], None
    for code, count in heapq.merge(*[zip(c.tolist(), n.tolist()) for c, n in runs]):
        if code == last:
            totals[-1] += count
        else:
            codes.append(code)
            totals.append(count)
            last = code
    return np.array(codes, dtype=np.uint64), np.array(totals, dtype=np.uint64)


def highest_of_side(codes: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Whether each pair's total is the highest of its A id; the pairs of an A id stand together."""
    starts = _starts(codes >> np.uint64(_ID_BITS))
    return totals == np.repeat(np.maximum.reduceat(totals, starts), _widths(starts, len(codes)))


_ANSWER = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("answer", pa.binary())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to blocks that come sorted by radix, each once to be counted and once to be answered.

    An answer holds, for each pair of the block, twice its count, plus one if it is its A id's highest.
    """
    current, pending, table = None, [], None
    for batch in batches:
        answers = []
        for radix, again, run, block in zip(*[batch.column(n).to_pylist() for n in ("radix", "again", "run", "block")]):
            if radix != current:
                current, pending, table = radix, [], None
            if not again:
                pending.append(open_block(block))
                if len(pending) == FAN_IN:
                    pending = [heap_merged(pending)]
                continue
            if table is None:
                codes, totals = heap_merged(pending)
                table = codes, (totals << np.uint64(1)) | highest_of_side(codes, totals).astype(np.uint64)
                pending = []
            asked = open_block(block)[0]
            answers.append({"run": run, "radix": radix, "answer": pack(table[1][np.searchsorted(table[0], asked)])})
        yield _record(_ANSWER, answers)


def _answered(runs: DataFrame, radix_bits: int) -> DataFrame:
    """``run, answers``: each run's answers in the order of its blocks."""
    blocks = runs.select("run", F.posexplode("blocks").alias("radix", "block")).where("block IS NOT NULL")
    twice = blocks.select("run", "radix", "block", F.explode(F.array(F.lit(0), F.lit(1))).alias("again"))
    tasks = min(1 << radix_bits, partitions(runs.sparkSession))
    place = F.floor(F.col("radix") * tasks / (1 << radix_bits)).cast("int")
    met = twice.withColumn("place", place).repartitionById(tasks, "place").sortWithinPartitions("radix", "again", "run")
    answers = met.select("radix", "again", "run", "block").mapInArrow(_count, "run bigint, radix int, answer binary")
    ordered = F.sort_array(F.collect_list(F.struct("radix", "answer")))
    return answers.groupBy("run").agg(ordered.getField("answer").alias("answers"))


_RESULT = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", *_DOC_COLUMNS, "n_best", "count_sum")] + [("groups_sha256", pa.string())]
)
_RESULT_SCHEMA = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of each run, with what its links' counts add up to."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            size = len(row["doc_id"])
            n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if row["answers"].is_valid:
                answers = np.concatenate([unpack(a.as_py()) for a in row["answers"].values])
                per_pair = unpack(row["per_pair"].as_py()).astype(np.int64)
                steps, times = unpack(row["holders"].as_py()), unpack(row["times"].as_py()).astype(np.int64)
                firsts = np.cumsum(per_pair) - per_pair
                run_up = np.cumsum(steps)
                places = (run_up - np.repeat(run_up[firsts] - steps[firsts], per_pair)).astype(np.int64)
                counts, best = (answers >> np.uint64(1)).astype(np.int64), (answers & np.uint64(1)).astype(np.int64)
                np.add.at(count_sum, places, times * np.repeat(counts, per_pair))
                np.add.at(n_best, places, times * np.repeat(best, per_pair))
            columns = [row[n].values for n in ("doc_id", *_DOC_COLUMNS)]
            columns += [pa.array(n_best), pa.array(count_sum), row["groups_sha256"].values]
            yield pa.RecordBatch.from_arrays(columns, schema=_RESULT)


def align_documents(
    docs: DataFrame,
    byte_bpe: str,
    piece_model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    run_links: int = RUN_LINKS,
    radix_bits: int = RADIX_BITS,
) -> DataFrame:
    """Per document: tokens, groups and links of both tokenizers, and its links' corpus counts.

    ``n_best`` counts the links whose pair has its A id's highest count,
    ``count_sum`` adds up the counts over all links, and ``groups_sha256`` is the
    digest of the groups as ``a1,a2|b1;a3|b2,b3``. ``run_links`` and ``radix_bits``
    change only how the work is cut.
    """
    # Written, as counting and adding up both read the runs; tokenising happens once.
    runs = settled(runs_of(docs, byte_bpe, piece_model, id_col, text_col, run_links, radix_bits), "token-runs")
    kept = runs.drop("blocks").join(_answered(runs, radix_bits), "run", "left")
    return kept.mapInArrow(_add_up, _RESULT_SCHEMA)
