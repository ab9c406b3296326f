"""SentencePiece encoding and decoding that keeps source offsets.

Each text is normalised by the model's compiled character map, longest prefix first, and each
normalised byte records the source byte that it came from (a model with an empty map leaves all
characters as they are; white space is treated as the model says). The normalised text is what is
segmented: it is cut where a word ends and white space begins, for no piece of a word-wise model
reaches over such a place (`PieceCodec` checks the vocabulary for it), so each part is segmented by
itself and a part seen before is not segmented again. The library segments parts that its own
normaliser leaves as they are, the others are merged pair by pair here. Every piece is then projected
to its span of source bytes. For models that aren't word-wise the library segments whole texts.

Null texts are empty; an empty text has only the begin and end ids. Bytes that aren't UTF-8 stand for
U+FFFD each, as in the library. Repeated rows and extra columns don't matter: each row is encoded for itself.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postmill.llm.common import as_bytes, portions

MARK = "▁".encode()


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift += 7
        at += 1
        if data[at - 1] < 128:
            return value, at


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind} in the model file")
        yield key >> 3, value


class CharacterMap:
    """The compiled map of a model: a double-array trie over source prefixes and a pool of replacements."""

    def __init__(self, blob: bytes):
        self.units, self.pool = [], b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of text[at:]."""
        if not self.units:
            return None
        found, unit = None, self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.pool[found[1] : self.pool.index(b"\0", found[1])]


class PieceCodec:
    """Encoder and decoder of one model, given as the bytes of its file. Make one in each worker."""

    def __init__(self, model: bytes, remembered: int = 250_000):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces, options, trainer = [], {}, {}
        for number, value in wire_fields(model):
            if number == 1:
                pieces.append(dict(wire_fields(value)))
            elif number == 2:
                trainer = dict(wire_fields(value))
            elif number == 3:
                options = dict(wire_fields(value))
        self.map = CharacterMap(options.get(2, b""))
        self.dummy, self.squeeze, self.escape = bool(options.get(3, 1)), bool(options.get(4, 1)), bool(options.get(5, 1))
        #: Bytes of normalised text by id: one for a byte piece (kind 6), none for control ids (kind 3).
        self.lengths = np.array([1 if p.get(3, 1) == 6 else 0 if p.get(3, 1) == 3 else len(p[1]) for p in pieces], np.int64)
        inner = any(MARK in p[1] or p.get(3, 1) == 4 for p in map(self._stripped, pieces))
        merging, suffixed = trainer.get(3, 1) == 2, trainer.get(24, 0)
        self.by_words = not inner and merging and not suffixed and self.dummy and self.escape
        #: Whether the library's normaliser gives back every normalised text.
        self.settled = not self.map.units and not self.squeeze
        #: (score, id) of pieces that a merge can make; ids of pieces for single bytes.
        self.merges = {p[1]: (struct.unpack("<f", p.get(2, bytes(4)))[0], i) for i, p in enumerate(pieces) if p.get(3, 1) == 1}
        self.byte_ids = {int(p[1][3:5], 16): i for i, p in enumerate(pieces) if p.get(3, 1) == 6}
        self.unknown = next((i for i, p in enumerate(pieces) if p.get(3, 1) == 2), 0)
        self.bos, self.eos, self.remembered = self.processor.bos_id(), self.processor.eos_id(), remembered
        #: Ids, as bytes, of the parts seen so far.
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _stripped(piece: dict) -> dict:
        text = piece[1]
        while text.startswith(MARK):
            text = text[len(MARK) :]
        return piece | {1: text}

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and for its end, the source byte it stands for."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.settled and _is_utf8(text):
            source = np.frombuffer(text, np.uint8)
            at = np.repeat(np.arange(len(text)), np.where((source == 32) & self.escape, len(MARK), 1))
            lead = MARK if self.dummy and self.escape else b" " if self.dummy else b""
            return lead + (text.replace(b" ", MARK) if self.escape else text), np.concatenate([np.zeros(len(lead), np.int64), at, [len(text)]])
        out, origin, i = bytearray(), [], 0
        space = MARK if self.escape else b" "

        def put(part: bytes, at: int) -> None:
            out.extend(part)
            origin.extend([at] * len(part))

        def step(i: int) -> tuple[int, bytes]:
            if (known := self.map.longest(text, i)) is not None:
                return known
            n = 1 if text[i] < 0x80 else 2 if text[i] < 0xE0 else 3 if text[i] < 0xF0 else 4
            return (n, text[i : i + n]) if _is_utf8(text[i : i + n]) else (1, REPLACEMENT)

        while self.squeeze and i < len(text):
            n, part = step(i)
            if part != b" ":
                break
            i += n
        if i == len(text):
            return b"", np.zeros(1, np.int64)
        if self.dummy:
            put(space, i)
        after_space = self.squeeze
        while i < len(text):
            n, part = step(i)
            part_at = i
            while after_space and part.startswith(b" "):
                part = part[1:]
            if part:
                for k in range(len(part)):
                    put(space if part[k] == 32 else part[k : k + 1], part_at)
                after_space = self.squeeze and part.endswith(b" ")
            i += n
        end = len(text)
        while self.squeeze and out.endswith(space):
            del out[-len(space) :]
            end = origin[-len(space)]
            del origin[-len(space) :]
        return bytes(out), np.array([*origin, end], np.int64)

    def merged(self, part: bytes) -> list[int]:
        """Ids of a normalised part: the adjacent pair with the best score is merged, the first one of equals, until none is a piece."""
        parts = [c.encode() for c in part.decode()]
        while True:
            found = [(-self.merges[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.merges]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out: list[int] = []
        for x in parts:
            if x in self.merges:
                out.append(self.merges[x][1])
            else:
                out += [self.byte_ids[b] for b in x] if self.byte_ids else [self.unknown]
        return out

    def _segment(self, new: list[bytes]) -> None:
        """Ids of parts that weren't seen before."""
        raw = [part[len(MARK) :].replace(MARK, b" ") for part in new]
        easy = [i for i, x in enumerate(raw) if x and (self.settled or self.normalised(x)[0] == new[i])]
        for i, ids in zip(easy, self.processor.encode([raw[i] for i in easy], num_threads=1), strict=True):
            self.known[new[i]] = np.array(ids, "<u4").tobytes()
        for part in new:
            if part not in self.known:
                self.known[part] = np.array(self.merged(part), "<u4").tobytes()

    def encoded(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of whole texts, begin and end ids among them, and the source byte of each normalised byte."""
        normal = [self.normalised(text) for text in texts]
        if self.by_words:
            apart = [PARTS(text) for text, _ in normal]
            if len(self.known) > self.remembered:
                self.known.clear()
            if new := list({part for parts in apart for part in parts}.difference(self.known)):
                self._segment(new)
            found = (b"".join(map(self.known.__getitem__, parts)) for parts in apart)
        else:
            found = (np.array(ids, "<u4").tobytes() for ids in self.processor.encode(texts, num_threads=1))
        first, last = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        for ids, (_, origin) in zip(found, normal, strict=True):
            yield np.frombuffer(first + ids + last, "<u4"), origin

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts, begin and end ids among them."""
        return [ids for ids, _ in self.encoded(texts)]

    def spans(self, ids: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each id in source bytes; pieces of white space that was only added are empty.

        The model must have pieces for single bytes: an unknown piece doesn't tell its length.
        """
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        last = len(origin) - 1
        return origin[np.minimum(ends - lengths, last)], origin[np.minimum(ends, last)]

    def decoded(self, ids: np.ndarray) -> bytes:
        return self.processor.decode(ids.tolist()).encode()

    @cached_property
    def size(self) -> int:
        return self.processor.get_piece_size()


REPLACEMENT = "\ufffd".encode()
#: Marks of white space and the word after them; the first ones may be missing.
PARTS: Callable[[bytes], list[bytes]] = re.compile(rb"(?:\xe2\x96\x81)+[^\xe2]*(?:\xe2(?!\x96\x81)[^\xe2]*)*").findall


def _is_utf8(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


def encode_pieces(docs: DataFrame, model_file: str, keep_ids: bool = False, keep_spans: bool = False, rows: int = 1024) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_sha256 of each whole text.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers, spans_sha256 over the
    begins and then the ends of the source spans in the same form. `keep_ids` adds the ids,
    `keep_spans` the spans as begins and ends. The model file is read on the driver and sent
    along (its size is that of a vocabulary, whatever the data).
    """
    with open(model_file, "rb") as f:
        model = f.read()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    extra = ", ids array<int>" * keep_ids + ", begins array<int>, ends array<int>" * keep_spans

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(sent.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in portions(batches, rows):
            out: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")}
            ids_of, spans_of = [], []
            texts = as_bytes(batch.column("text"))
            for ids, origin in codec.encoded(texts):
                begins, ends = codec.spans(ids, origin)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(ids.tobytes()))
                out["decoded_sha256"].append(sha(codec.decoded(ids)))
                out["spans_sha256"].append(sha(begins.astype("<u4").tobytes() + ends.astype("<u4").tobytes()))
                if keep_ids:
                    ids_of.append(ids.astype(np.int32))
                if keep_spans:
                    spans_of.append((begins.astype(np.int32), ends.astype(np.int32)))
            columns = [batch.column("doc_id"), pa.array(out["n_tokens"], pa.int64()), *(pa.array(out[k], pa.string()) for k in list(out)[1:])]
            if keep_ids:
                columns.append(_lists(ids_of))
            if keep_spans:
                columns += [_lists([b for b, _ in spans_of]), _lists([e for _, e in spans_of])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *out, *["ids"] * keep_ids, *["begins", "ends"] * keep_spans])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string{extra}")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))
