"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

Encoding keeps an agenda of adjacent symbol pairs, ordered by the score of the
piece that a pair would form and, among equals, from left to right.  The best
pair is merged, the pairs with its new neighbours enter the agenda, and pairs
whose symbols have since been merged are passed over when they come up.  What
is no piece at the end becomes its UTF-8 bytes.

A pair can only merge where the vocabulary has a piece with these two
characters side by side.  So a text falls into stretches that never touch each
other, between a character and a word mark behind it and wherever else no piece holds
the two characters so; ids of stretches are remembered by the worker.

With every Arrow batch, the stretches that were merged for it are checked against
the sentencepiece library, all of them, each when it is merged: the ids must be
the library's own, else the job fails.  Decoding is the library's.

Scale: one pass over the documents without a shuffle; a task holds one Arrow
batch, and the ids of about ``BLOCK_CHARS`` characters.

Defined cases: a null text is empty, and an empty text has no ids and decodes to
the empty string; a text longer than ``BLOCK_CHARS`` is taken in parts that end
at single spaces, which gives the same ids (its longest part without such a
space is held whole); repeated rows give repeated results; a null id stays
null; an empty table gives an empty result; further columns are ignored.
Models with user-defined or unused pieces, or with a text normaliser of their
own, raise an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from sentencepiece import sentencepiece_model_pb2 as model_pb

from panelyze.llm.common import blocks, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
BREAK = "\n"
BLOCK_CHARS = 1 << 20
CACHED_STRETCHES = 300_000
# Up to so many symbols, a look through all pairs is cheaper than a heap.
SHORT = 40


class Known(dict):
    """Ids of stretches, found when first asked for; when full, what the last ``limit`` entries do not hold goes."""

    def __init__(self, find, limit: int = CACHED_STRETCHES):
        super().__init__()
        self.find, self.limit, self.older = find, limit, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.older.get(text)
        if ids is None:
            ids = self.find(text)
        # Long stretches hardly come again.
        if len(text) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Merger:
    """Ids of texts by the agenda of adjacent pairs, for one model file."""

    def __init__(self, path: str):
        model = model_pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind, norm = model_pb.ModelProto.SentencePiece, model.normalizer_spec
        if model.trainer_spec.model_type != model_pb.TrainerSpec.BPE:
            raise ValueError("not a merge-type vocabulary")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the model normalises its texts")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("the model has user-defined or unused pieces")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        normal = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.ids = {p: i for p, (_, i) in normal.items()}
        # Equal scores have equal places.
        place = {score: at for at, score in enumerate(sorted({score for score, _ in normal.values()}, reverse=True))}
        self.places = {p: place[score] for p, (score, _) in normal.items()}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        long = [p for p in normal if len(p) > 1]
        self.touching = {a + b for p in long for a, b in zip(p, p[1:])}
        inner = sorted(set("".join(long)) - {MARK})
        some = "[" + "".join(map(re.escape, inner)) + "]"
        if any(MARK in p.lstrip(MARK) for p in long):
            # A mark may then be merged with what stands before it.
            self.stretch = re.compile(f"(?:{MARK}|{some})+|.", re.DOTALL)
        else:
            self.stretch = re.compile(f"{MARK}*{some}+|{MARK}+|.", re.DOTALL)
        self.known = Known(self.stretch_ids)
        # Merged since the last check.
        self.fresh: list[tuple[str, tuple[int, ...]]] = []
        if BREAK in inner:
            raise ValueError("a piece holds the line break that parts stretches in the check")

    def merged_short(self, text: str) -> list[str]:
        """As ``merged``; the agenda is a list in order of place in the text, whose best entry is looked for."""
        place, none = self.places.get, len(self.places)
        symbols = list(text)
        agenda = [place(text[i : i + 2], none) for i in range(len(text) - 1)]
        while agenda and (best := min(agenda)) != none:
            # The first of equals.
            i = agenda.index(best)
            symbol = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = place(symbol + symbols[i + 1], none)
            if i:
                agenda[i - 1] = place(symbols[i - 1] + symbol, none)
        return symbols

    def merged(self, text: str) -> list[str]:
        """The symbols that are left of a stretch when no pair merges any more.

        The agenda is a heap, ordered by score and then by place in the text.
        ``offered[i]`` is the place of the pair that now starts at i (-1: no
        piece); entries of the agenda that say otherwise are out of date.
        """
        n, place = len(text), self.places.get
        symbols = list(text)
        before, behind, offered = list(range(-1, n - 1)), list(range(1, n + 1)), [-1] * n
        agenda = []
        for i in range(n - 1):
            at = place(text[i : i + 2])
            if at is not None:
                offered[i] = at
                agenda.append(at << 32 | i)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            if offered[left] != entry >> 32:
                continue
            right = behind[left]
            symbol = symbols[left] = symbols[left] + symbols[right]
            symbols[right] = ""
            offered[right] = offered[left] = -1
            follows = behind[left] = behind[right]
            if follows < n:
                before[follows] = left
                at = place(symbol + symbols[follows])
                if at is not None:
                    offered[left] = at
                    heappush(agenda, at << 32 | left)
            first = before[left]
            if first >= 0:
                at = place(symbols[first] + symbol)
                if at is None:
                    offered[first] = -1
                else:
                    offered[first] = at
                    heappush(agenda, at << 32 | first)
        return [s for s in symbols if s]

    def stretch_ids(self, text: str) -> tuple[int, ...]:
        touching = self.touching
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in touching]
        if cuts:
            parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
            return tuple(chain.from_iterable(map(self.known.__getitem__, parts)))
        ids = []
        for s in self.merged_short(text) if len(text) <= SHORT else self.merged(text):
            if (piece := self.ids.get(s)) is not None:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in s.encode("utf-8"))
            else:
                ids.append(self.unknown)
        self.fresh.append((text, tuple(ids)))
        return tuple(ids)

    def check(self, library: sentencepiece.SentencePieceProcessor) -> None:
        """Compare what was merged since the last check with the library, as lines of one text."""
        fresh, self.fresh = self.fresh, []
        if not fresh:
            return
        text = BREAK + BREAK.join(s.replace(MARK, " ") for s, _ in fresh)
        between = tuple(self.bytes[b] for b in BREAK.encode()) if self.bytes else (self.unknown,)
        between = (self.ids[BREAK],) if BREAK in self.ids else between
        first = (self.ids.get(self.prefix, self.unknown),) if self.prefix else ()
        if library.encode(text) != list(chain(first, chain.from_iterable(between + ids for _, ids in fresh))):
            raise AssertionError("the agenda's ids differ from the sentencepiece library's")

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        marked = self.prefix + text.replace(" ", MARK)
        return list(chain.from_iterable(map(self.known.__getitem__, self.stretch.findall(marked))))


_MERGERS: dict[str, tuple[Merger, sentencepiece.SentencePieceProcessor]] = {}


def merger(path: str) -> tuple[Merger, sentencepiece.SentencePieceProcessor]:
    """The merger of a model file and the library's processor, once per worker."""
    if path not in _MERGERS:
        _MERGERS[path] = Merger(path), sentencepiece.SentencePieceProcessor(model_file=path)
    return _MERGERS[path]


def text_parts(text: str, limit: int = BLOCK_CHARS, prefix: bool = True) -> Iterator[str]:
    """Parts of a text that encode on their own: cut at single spaces, which are left out.

    The space before a part comes back as the mark that a model puts before
    every text; a model without such marks gets texts whole.
    """
    at, n = 0, len(text)
    while prefix and n - at > limit:
        cut = text.find(" ", at + limit)
        while 0 < cut < n - 1 and (text[cut - 1] in (" ", MARK) or text[cut + 1] in (" ", MARK)):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut >= n - 1:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


def encoded_parts(texts: list[str], path: str) -> Iterator[tuple[int, list[int], str]]:
    """``(text's number, ids, decoded)`` for the parts of each text, in order; nothing comes out unchecked."""
    own, library = merger(path)
    parts = ((i, p) for i, t in enumerate(texts) for p in text_parts(t, prefix=bool(own.prefix)))
    held, size = [], 0

    def flush():
        ids = [own.encode(p) for _, p in held]
        own.check(library)
        yield from zip((i for i, _ in held), ids, library.decode(ids))

    for i, p in parts:
        held.append((i, p))
        size += len(p)
        if size > BLOCK_CHARS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


class Names(dict):
    """Ids as text."""

    def __missing__(self, i: int) -> str:
        name = self[i] = str(i)
        return name


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: the whole ids and decoded text of each document."""

    def run(batches):
        for batch in batches:
            texts = _texts(batch)
            sizes = np.array([len(t) for t in texts])
            for a, b in blocks(sizes, BLOCK_CHARS):
                ids: list[list[int]] = [[] for _ in range(a, b)]
                back: list[list[str]] = [[] for _ in range(a, b)]
                for i, some, decoded in encoded_parts(texts[a:b], path):
                    ids[i] += some
                    back[i].append(decoded)
                out = [batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(out + [pa.array([" ".join(p) for p in back])], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: ``encode`` with its columns digested as they are made."""

    def run(batches):
        names = Names()
        for batch in batches:
            rows, last = [], -1
            for i, ids, decoded in encoded_parts(_texts(batch), path):
                if i != last:
                    rows.append([0, hashlib.sha256(), hashlib.sha256()])
                row, more, last = rows[-1], i == last, i
                if ids:
                    row[1].update(("," if row[0] else "").encode() + ",".join(map(names.__getitem__, ids)).encode())
                row[2].update((" " if more else "").encode() + decoded.encode("utf-8"))
                row[0] += len(ids)
            out = [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1].hexdigest() for r in rows], pa.string()),
                pa.array([r[2].hexdigest() for r in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op12_piece_agenda(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), path or public_tokenizers.path(MODEL))
