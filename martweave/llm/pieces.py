"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text becomes marked words: runs of blanks, each followed by a word. No piece
holds a blank after another character, so the best segmentation of a text is
that of its marked words, one by one. The distinct marked words of a slice are
sorted, which is a trie in depth-first order: going from one word to the next,
the forward table of their common prefix stands, and only the rest is computed.
Each distinct word is segmented once; documents take its ids.

The forward table holds, for each prefix, its best segmentation's score and last
piece. What is best depends on the model file:

* a unigram model: the largest sum of piece scores (ties: the longer last piece);
* a merge (BPE) model: the segmentation that merging by rank arrives at. It has
  the property that each pair of neighbouring pieces, merged by itself, stays as
  it is, and only one segmentation of a prefix has it; so a piece may follow the
  last piece of a prefix if the two pass that test. The sum of ranks would give
  other ids than the model's own.

Characters without a piece are written as byte pieces (in a unigram model at a
little more than the cost of the worst piece). Texts are not normalised, and
blanks are kept, so decoding gives back every text exactly, also one that holds
the mark character itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.common import add_column

MARK = "▁"  # stands for a blank in the model's pieces
_UNKNOWN_PENALTY = 10.0
_WORDS = re.compile(r" *[^ ]+| +")
CACHE_WORDS, CACHE_PAIRS = 150_000, 500_000
STEP = 1 << 20  # code points or ids that are worked on at once


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with blanks for the mark, their ids and scores, and the ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    bytes_of: tuple[bytes, ...]
    longest: int
    unknown: float
    merges: bool
    # Every ending of a piece. For pieces: what is known of the pieces they may follow.
    ends: dict[str, dict[str, bool] | None] = field(compare=False, repr=False)
    pairs: list[int] = field(default_factory=lambda: [0], compare=False, repr=False)

    @classmethod
    def of(
        cls,
        pieces: Iterable[tuple[str, float]],
        byte_ids: Iterable[int],
        bytes_of: Iterable[bytes],
        ids: dict[str, int] | None = None,
        merges: bool = False,
    ) -> Vocabulary:
        scores = dict(pieces)
        inner = [p for p in scores if " " in p.lstrip(" ")]
        if inner:
            raise ValueError(f"pieces with a blank after another character: {inner[:3]}")
        worst = min(scores.values(), default=0.0)
        ids = ids or {p: i for i, p in enumerate(scores)}
        ends = {p[i:]: None for p in scores for i in range(1, len(p))} | {p: {} for p in scores}
        longest = max(map(len, scores), default=1)
        return cls(ids, scores, tuple(byte_ids), tuple(bytes_of), longest, worst - _UNKNOWN_PENALTY, merges, ends)

    def stays(self, before: str, piece: str) -> bool:
        """Whether merging the characters of two pieces ends with these pieces."""
        found = merged(before + piece, self.scores) == ([before, piece] if before else [piece])
        known = self.ends.get(piece)
        if known is not None:
            if self.pairs[0] >= CACHE_PAIRS:
                for other in self.ends.values():
                    if other:
                        other.clear()
                self.pairs[0] = 0
            known[before] = found
            self.pairs[0] += 1
        return found


def merged(word: str, scores: dict[str, float]) -> list[str]:
    """Pieces left when the neighbours whose union scores best are joined until none can be."""
    parts = list(word)
    while True:
        best, at = None, 0
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def is_merge_model(path: str) -> bool:
    """Reads the model type from the file: field 3 of the trainer's settings, which are field 2; 2 means BPE."""

    def number(data: bytes, at: int) -> tuple[int, int]:
        value, shift = 0, 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    def fields(data: bytes) -> Iterator[tuple[int, object]]:
        at = 0
        while at < len(data):
            tag, at = number(data, at)
            if tag & 7 == 0:
                value, at = number(data, at)
            else:
                size, at = number(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
                value, at = data[at : at + size], at + size
            yield tag >> 3, value

    with open(path, "rb") as file:
        settings = b"".join(v for k, v in fields(file.read()) if k == 2)
    return dict(fields(settings)).get(3, 1) == 2


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """The vocabulary of a model file, which must have byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, bytes_of, byte_ids = [], {}, [], {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            bytes_of.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            bytes_of.append(b"")
        else:
            plain = piece.replace(MARK, " ")
            ids[plain] = i
            pieces.append((plain, model.get_score(i)))
            bytes_of.append(plain.encode())
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    return Vocabulary.of(pieces, (byte_ids[b] for b in range(256)), bytes_of, ids, is_merge_model(path))


def segment_sorted(words: Iterable[str], vocabulary: Vocabulary) -> Iterator[tuple[str, list[int]]]:
    """Best segmentations of sorted distinct words; the table of shared prefixes is computed once."""
    ids, extend = vocabulary.ids, _by_merges if vocabulary.merges else _by_scores
    best, pieces = [0.0], [""]  # for each prefix length: its score, its last piece
    last = ""
    for word in words:
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], pieces[shared + 1 :]
        extend(word, shared + 1, best, pieces, vocabulary)
        found, end = [], len(word)
        while end:
            piece = pieces[end]
            if piece in ids:
                found.append(ids[piece])
            else:
                found.extend(vocabulary.byte_ids[b] for b in reversed(piece.encode()))
            end -= len(piece)
        found.reverse()
        last = word
        yield word, found


def _by_scores(word: str, low: int, best: list[float], pieces: list[str], vocabulary: Vocabulary) -> None:
    """Fills the table from prefix length ``low`` on with the best sums."""
    scores, ends = vocabulary.scores, vocabulary.ends
    for end in range(low, len(word) + 1):
        top, last = None, word[end - 1]
        for begin in range(end - 1, -1, -1):
            piece = word[begin:end]
            if piece not in ends:
                break
            if piece in scores:
                score = best[begin] + scores[piece]
                if top is None or score >= top:
                    top, last = score, piece
        if word[end - 1] not in scores:
            other = best[end - 1] + vocabulary.unknown
            if top is None or other > top:
                top, last = other, word[end - 1]
        best.append(top)
        pieces.append(last)


def _by_merges(word: str, low: int, best: list[float], pieces: list[str], vocabulary: Vocabulary) -> None:
    """Fills the table from prefix length ``low`` on with the last piece of the only segmentation that stays."""
    ends, nothing = vocabulary.ends, {}
    for end in range(low, len(word) + 1):
        begin = end - 1
        piece = word[begin]
        known = ends.get(piece, nothing)
        while True:
            if known is not None:
                before = pieces[begin]
                stays = known.get(before)
                if stays or stays is None and vocabulary.stays(before, piece):
                    break
            begin -= 1
            piece = word[begin:end]
            known = ends[piece]
        best.append(0.0)
        pieces.append(piece)


def marked_words(text: str) -> list[str]:
    """The marked words of a text, which gets one blank in front; none for an empty text."""
    return _WORDS.findall(" " + text) if text else []


def encode_texts(texts: list[str], vocabulary: Vocabulary, known: dict[str, bytes]) -> pa.ListArray:
    """Ids of each text. ``known`` keeps the words of earlier calls, up to a number of them."""
    per_text = [marked_words(t) for t in texts]
    words = list(chain.from_iterable(per_text))
    found = list(map(known.get, words))
    missing = sorted({w for w, ids in zip(words, found) if ids is None})
    if missing:
        new = {word: array("i", ids).tobytes() for word, ids in segment_sorted(missing, vocabulary)}
        found = [new[w] if ids is None else ids for w, ids in zip(words, found)]
        if len(known) + len(new) <= CACHE_WORDS:  # words seen first are the frequent ones
            known.update(new)
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
    upto = ends[np.concatenate([[0], np.cumsum([len(w) for w in per_text], dtype=np.int64)])]
    values = np.frombuffer(b"".join(found), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(values, pa.int32()))


@lru_cache(maxsize=2)
def _known_words(model: str) -> dict[str, bytes]:
    """Ids of words that a worker has segmented; its tasks share them."""
    return {}


def decode_ids(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of the ids. Unknown ids give nothing, bytes that are no UTF-8 the replacement character."""
    table, n = vocabulary.bytes_of, len(vocabulary.bytes_of)
    raw = b"".join([table[i] if i is not None and 0 <= i < n else b"" for i in ids])
    return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _piece_table(model: str) -> pa.Array:
    """The bytes of every id, and no bytes for the id behind the last."""
    return pa.array([*load(model).bytes_of, b""], pa.binary())


def decode_lists(ids: pa.ListArray, model: str) -> pa.Array:
    """The texts of lists of ids, as ``decode_ids`` gives them one by one."""
    table = _piece_table(model)
    offsets = ids.offsets.to_numpy()
    flat = pc.fill_null(ids.values.slice(offsets[0], offsets[-1] - offsets[0]), -1).to_numpy()
    none = len(table) - 1
    pieces = table.take(pa.array(np.where((flat < 0) | (flat > none), none, flat)))
    data, starts = pieces.buffers()[2], np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1)
    cuts = starts[offsets - offsets[0]].astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(cuts), data])
    raw = pc.replace_substring_regex(raw, "^ ", "", max_replacements=1)
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.array([text.decode("utf-8", "replace") for text in raw.to_pylist()], pa.string())


def encode(docs: DataFrame, model: str, text_col: str = "text", name: str = "ids", without: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the piece ids of ``text_col``; a null or empty text has none.

    ``model`` is the path of a model file that every executor can open. Columns ``without`` are left out.
    """

    def compute(texts: pa.Array) -> pa.Array:
        return encode_texts(texts.to_pylist(), load(model), _known_words(model))

    return add_column(docs, name, T.ArrayType(T.IntegerType()), text_col, compute, STEP, without)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids_col``; null or no ids give an empty text."""

    def compute(ids: pa.Array) -> pa.Array:
        return decode_lists(ids, model)

    return add_column(rows, name, T.StringType(), F.coalesce(F.col(ids_col), F.array().cast("array<int>")), compute, STEP)
