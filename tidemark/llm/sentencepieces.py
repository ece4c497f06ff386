"""SentencePiece encoding and decoding with a weighted finite-state transducer.

A model is compiled once per worker.  The normaliser escapes spaces and puts
the dummy prefix before a text.  The pieces are arcs over characters; a
character no piece holds becomes the arcs of its UTF-8 bytes.  A BPE model's
merges aren't additive weights, but the encoding it finds is the one sequence
in which every two neighbours would stay apart if they alone were encoded.  So
a state is a position and the piece that ends there, an arc to a next piece has
weight zero if the two stay apart and none otherwise, and the shortest path in
the tropical semiring is the encoding.  Weights are composed when an input first
asks for them and kept, as are the encodings of words.  A prefix of a text has
one encoding of its own, so one state per position is ever reached, and words
that begin alike share the states of what they share: the new words of a slice
are composed in sorted order, each from where it leaves the one before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import keyed
from tidemark.llm.workers import kept, tidy

SPACE = "▁"
#: Entries that a worker keeps before it starts afresh; results don't depend on it.
MEMO_ENTRIES = 800_000
#: Bytes of texts handled together in a task, and characters up to which a word
#: is kept and shares states.
SLICE_BYTES = 4 << 20
WORD_CHARS = 64

NORMAL, UNKNOWN, BYTE, USER_DEFINED = 1, 2, 6, 4
BPE = 2


class Transducer:
    """Pieces, normaliser and byte fallback of one model."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser is compiled")
        if any(piece.type == USER_DEFINED for piece in model.pieces):
            raise ValueError("user-defined pieces are not compiled")
        self.prefix = rules.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.texts = [p.piece for p in model.pieces]
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = [0] * 256
        #: What each id stands for, as bytes; control pieces are nothing.
        self.out: list[bytes] = [b""] * len(self.texts)
        self.unknown_id = model.trainer_spec.unk_id
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value] = i
                self.out[i] = bytes([value])
            elif piece.type == NORMAL:
                self.out[i] = piece.piece.replace(SPACE, " ").encode()
            elif piece.type == UNKNOWN:
                self.out[i] = model.trainer_spec.unk_surface.encode()
        self.longest = max(map(len, self.ids))
        self.chars = set("".join(self.ids))
        #: Words may be handled one by one if no piece goes on after a space.
        self.by_word = all(SPACE not in piece.strip(SPACE) and (
            not piece.endswith(SPACE) or not piece.strip(SPACE)) for piece in self.ids)
        self.packs: dict[str, bytes] = {}
        #: Arcs composed so far: whether a piece may begin a path, and by the
        #: piece before it whether a piece may follow.
        self.alone: dict[str, bool] = {}
        self.apart: dict[str, dict[str, bool]] = {}
        self.arcs = 0
        #: How long the piece was that last came to its end with a character, by the
        #: piece that ended before it.  Only says which arc to try first.
        self.sizes: dict[str, dict[str, int]] = {}
        self.memo: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """``text`` after all merges, best score first, leftmost of equal ones."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def arc(self, before: str, after: str) -> bool:
        """Whether the arc from ``before`` to ``after`` exists (with weight zero).

        A piece that begins a path (nothing before) must be its own encoding.
        """
        self.arcs += 1
        if before:
            return self.merged(before + after) == [before, after]
        return len(self.merged(after)) == 1

    def arcs_from(self, piece: str) -> dict[str, bool]:
        found = self.apart.get(piece)
        if found is None:
            found = self.apart[piece] = {}
        return found

    def pack(self, piece: str) -> bytes:
        """Packed id of a piece, or those of its bytes."""
        found = self.packs.get(piece)
        if found is None:
            known = self.ids.get(piece)
            ids = [self.bytes[b] for b in piece.encode()] if known is None else [known]
            found = self.packs[piece] = np.asarray(ids, "<u4").tobytes()
        return found

    def forget(self) -> None:
        """Starts afresh if too much is kept."""
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        if self.arcs >= MEMO_ENTRIES:
            self.alone, self.apart, self.sizes, self.arcs = {}, {}, {}, 0

    def walk(self, text: str, ends: list[str], arcs: list[dict[str, bool]]) -> None:
        """Carries the states on from the prefix of ``text`` that they stand for.

        ``ends`` holds the piece that ends at each position, ``arcs`` what may
        follow it.
        """
        ids, longest, tried = self.ids, self.longest, self.sizes
        for end in range(len(ends), len(text) + 1):
            char = text[end - 1]
            sizes = tried.get(ends[-1])
            if sizes is None:
                sizes = tried[ends[-1]] = {}
            begin = end - sizes.get(char, end + 1)
            if begin >= 0:
                piece = text[begin:end]
                # One arc at most ends a path here.
                if arcs[begin].get(piece):
                    ends.append(piece)
                    arcs.append(self.arcs_from(piece))
                    continue
            for begin in range(max(0, end - longest), end):
                piece = text[begin:end]
                if piece not in ids and end - begin > 1:
                    continue
                fits = arcs[begin].get(piece)
                if fits is None:
                    fits = arcs[begin][piece] = self.arc(ends[begin], piece)
                if fits:
                    sizes[char] = end - begin
                    ends.append(piece)
                    arcs.append(self.arcs_from(piece))
                    break

    def path(self, text: str) -> list[bytes]:
        """Packed ids of the pieces of the shortest path over known characters."""
        ends = [""]
        self.walk(text, ends, [self.alone])
        found, at = [], len(text)
        while at:
            found.append(self.pack(ends[at]))
            at -= len(ends[at])
        return found[::-1]

    def stretch(self, text: str) -> bytes:
        """Packed ids of normalised text, bytes for what no piece holds."""
        if self.chars.issuperset(text):
            return b"".join(self.path(text))
        found, run = [], []
        for char in [*text, ""]:
            if char and char in self.chars:
                run.append(char)
                continue
            found += self.path("".join(run))
            run = []
            found.append(self.pack(char))
        return b"".join(found)

    def words(self, parts: set[str]) -> dict[str, bytes]:
        """Packed ids of words after a space, or after the line end they start with."""
        found: dict[str, bytes] = {}
        line = self.pack("\n")
        last, ends, arcs, packed = "", [""], [self.alone], [b""]
        for part in sorted(parts):
            text, before = (part[1:], line) if part[0] == "\n" else (SPACE + part, b"")
            if len(text) > WORD_CHARS or not self.chars.issuperset(text):
                found[part] = before + self.stretch(text)
                continue
            same = len(commonprefix((text, last)))
            del ends[same + 1 :], arcs[same + 1 :], packed[same + 1 :]
            self.walk(text, ends, arcs)
            for at in range(same + 1, len(text) + 1):
                packed.append(packed[at - len(ends[at])] + self.pack(ends[at]))
            found[part] = before + packed[-1]
            last = text
        return found

    def parts(self, text: str) -> list[str] | None:
        """The words of a text, none if they can't be handled one by one."""
        if SPACE in text or "\n" in self.chars or not (self.prefix and self.by_word):
            return None
        found = text.replace("\n", " \n").split(" ")
        return None if "" in found else found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        self.forget()
        cut = [self.parts(text) for text in texts]
        memo = self.memo
        found = [parts and list(map(memo.get, parts)) for parts in cut]
        new = {
            part
            for parts, ids in zip(cut, found) if parts and None in ids
            for part, one in zip(parts, ids) if one is None
        }
        once = self.words(new)
        memo.update((part, ids) for part, ids in once.items() if len(part) <= WORD_CHARS)
        return [
            self.whole(text) if parts is None
            else b"".join([one or once[part] for part, one in zip(parts, ids)] if None in ids else ids)
            for text, parts, ids in zip(texts, cut, found)
        ]

    def whole(self, text: str) -> bytes:
        """The ids of a text with runs of spaces, or one that holds the space symbol."""
        if not text:
            return b""
        normal = text.replace(" ", SPACE)
        if self.prefix:
            normal = SPACE + normal
        return b"".join(
            self.stretch(run) for run in (self.cut(normal) if self.by_word else [normal])
        )

    @staticmethod
    def cut(normal: str) -> list[str]:
        """``normal`` before each first space symbol of a run."""
        import re

        return re.split(f"(?<=[^{SPACE}])(?={SPACE})", normal)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<u4").tolist()

    def decode(self, ids: list[int | None]) -> str:
        """The text; a null or an id that no piece has is the unknown piece."""
        size, unknown = len(self.out), self.unknown_id
        if any(i is None or not 0 <= i < size for i in ids):
            ids = [unknown if i is None or not 0 <= i < size else i for i in ids]
        return self.text(ids)

    def text(self, ids: list[int]) -> str:
        """The text of ids that pieces have."""
        out = self.out
        raw = b"".join([out[i] for i in ids])
        if self.prefix and raw[:1] == b" ":
            first = next(i for i in ids if out[i])
            if self.texts[first][:1] == SPACE:
                raw = raw[1:]
        return raw.decode("utf-8", "replace")


#: Whose a worker's models and memos are.
_OWNER = "sentencepieces"


def transducer(path: str) -> Transducer:
    """The compiled model, once per worker until another operator uses that."""
    loaded = kept(_OWNER)
    if path not in loaded:
        loaded[path] = Transducer(path)
    return loaded[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(path)
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column("_text")), 0)
            slices = np.cumsum(np.asarray(sizes).astype(np.int64)) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), whole.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                batch = whole.slice(begin, end - begin)
                ids, sizes, checks, same = [], [], [], []
                texts = [
                    (text or b"").decode("utf-8", "replace")
                    for text in batch.column("_text").to_pylist()
                ]
                for text, packed in zip(texts, model.encode_all(texts)):
                    flat = np.frombuffer(packed, "<i4")
                    ids.append(flat)
                    sizes.append(len(flat))
                    checks.append(zlib.crc32(packed))
                    same.append(model.text(flat.tolist()) == text)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))),
                        pa.array(sizes, pa.int64()),
                        pa.array(checks, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["_id", "ids", "n_tokens", "ids_crc32", "decodes_back"],
                )

    return run


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, ids, n_tokens, ids_crc32, decodes_back`` for every row's whole text.

    A null or empty text has no ids.  ``decodes_back`` says whether decoding
    gives the text again (a text that holds the space symbol itself does not).
    Repeated rows are encoded each; null ids are kept; other columns don't
    matter; an empty table gives an empty result.  ``model_path`` must exist on
    every executor.
    """
    rows = keyed(docs, id_col, text_col).select(F.col("_id").cast("long").alias("_id"), "_text")
    found = rows.mapInArrow(
        tidy(_OWNER, _encode(model_path)),
        "_id long, ids array<int>, n_tokens long, ids_crc32 long, decodes_back boolean",
    )
    return found.withColumnRenamed("_id", id_col)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Adds ``text_col`` from ``ids_col``; a null list gives a null text.

    Bytes that are no UTF-8 become the replacement character.  Control pieces
    are nothing; the unknown piece, a null in a list and an id that no piece has
    are written as the model writes what it does not know.
    """
    names = [name for name in rows.columns if name != text_col]
    schema = rows.select(*[F.col(f"`{n}`") for n in names]).schema.add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(model_path)
        for batch in batches:
            texts = [
                None if ids is None else model.decode(ids)
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(texts, pa.string())],
                names=[*names, text_col],
            )

    return rows.mapInArrow(tidy(_OWNER, run), schema)
