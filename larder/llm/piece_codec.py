"""Offset-preserving SentencePiece encoding and decoding.

A model file carries its normaliser: flags for white space and a compiled
character map, a double-array trie of byte strings whose leaves point to their
replacements.  :class:`Normaliser` applies it by longest prefix and records,
for every normalised byte, the source byte it came from.  Pieces partition the
normalised text, so their running byte lengths are cut points in it, and the
record projects each piece to its span of original bytes.  A piece of the byte
fallback is projected to its own source byte; the added end id has an empty
span at the end.

The ids and the decoded text are those of the sentencepiece library.

Defined cases: a null text counts as empty (the end id alone); null ids and
repeated rows are encoded row by row; other columns are ignored; texts of any
length are encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.frames import id_and_text, slices, tokenizer_path

#: The mark for a space, and what stands for a malformed byte.
SPACE_MARK, MALFORMED = "▁".encode(), "�".encode()


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message, in order."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = message[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = message[at:at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """The compiled character map: longest-prefix lookups in its trie."""

    def __init__(self, blob: bytes):
        self.units, self.texts = np.zeros(0, "<u4"), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4)
            self.texts = blob[4 + size:]
        self.trie = self.units.tolist()

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that ``data`` has at ``at``, and its
        replacement; None where no key matches."""
        trie = self.trie
        if not trie:
            return None
        node, best = self._jump(trie[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            unit = trie[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._jump(unit)
            if unit >> 8 & 1:
                best = k + 1 - at, trie[node] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.texts[best[1]:self.texts.index(b"\0", best[1])]


def char_bytes(data: bytes, at: int) -> int:
    """Bytes of the UTF-8 character at ``at``; 0 where it is malformed."""
    lead = data[at]
    size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
    try:
        return len(data[at:at + size].decode().encode()) if size else 0
    except UnicodeDecodeError:
        return 0


class Normaliser:
    """A model's own normaliser, with the source of every byte it writes."""

    def __init__(self, spec: bytes):
        got = dict(fields(spec))
        self.map = CharacterMap(got.get(2, b""))
        self.dummy_prefix, self.trim, self.mark = (bool(got.get(k, 1)) for k in (3, 4, 5))

    @classmethod
    def of_model(cls, path: str) -> Normaliser:
        with open(path, "rb") as f:
            return cls(dict(fields(f.read())).get(3, b""))

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each of them and for the end, the
        source byte where it begins."""
        if not data:
            return b"", np.zeros(1, np.int64)
        return self._plain(data) if not self.map.trie and not self.trim else self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No character map and no trimming: only spaces are rewritten."""
        mark = SPACE_MARK if self.mark else b" "
        source = np.frombuffer(data, np.uint8)
        width = np.where(source == 0x20, len(mark), 1)
        at = np.repeat(np.arange(len(source)), width)
        head = mark if self.dummy_prefix else b""
        return (head + data.replace(b" ", mark),
                np.concatenate([np.zeros(len(head), np.int64), at, [len(source)]]))

    def _next(self, data: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(data, at)
        if found:
            return found
        size = char_bytes(data, at)
        return (size, data[at:at + size]) if size else (1, MALFORMED)

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, src = bytearray(), []
        mark = SPACE_MARK if self.mark else b" "
        at = 0
        if self.trim:
            while at < len(data):
                size, text = self._next(data, at)
                if text != b" ":
                    break
                at += size
            if at == len(data):
                return b"", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out += mark
            src += [at] * len(mark)
        after_space = self.trim
        while at < len(data):
            size, text = self._next(data, at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                shown = text.replace(b" ", mark)
                out += shown
                src += [at] * len(shown)
                after_space = self.trim and text.endswith(b" ")
            at += size
        end = at
        if self.trim:
            while out.endswith(mark) and out:
                end = src[len(out) - len(mark)]
                del out[-len(mark):], src[len(out):]
        return bytes(out), np.array([*src, end], np.int64)


class Codec:
    """Encode with spans, decode, for one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = Normaliser.of_model(path)
        n = self.model.get_piece_size()
        self.end = self.model.eos_id()
        self.width = np.array([1 if self.model.is_byte(i) else 0 if self.model.is_control(i) else
                               len(self.model.id_to_piece(i).encode()) for i in range(n)])
        self.decimal = [str(i) for i in range(n)]
        self.unknown = self.model.unk_id()

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(ids with the end id, first source byte, end source byte)."""
        ids = self.model.encode(text, add_eos=True)
        data = text.encode()
        flat, source = self.normalise(data)
        arr = np.array(ids)
        width = self.width[arr]
        if self.unknown >= 0 and (arr[:-1] == self.unknown).any():
            # pieces outside the vocabulary have the width of their surface
            pieces = self.model.encode(text, out_type=str)
            width[:-1] = [len(p.encode()) if i == self.unknown else w
                          for p, i, w in zip(pieces, ids, width)]
        cuts = np.concatenate([[0], np.cumsum(width)])
        if cuts[-1] != len(flat):
            raise ValueError(f"pieces cover {cuts[-1]} of {len(flat)} normalised bytes")
        # where one source place became several pieces, the last of them has
        # its bytes and those before are empty, as in the library
        return ids, source[cuts[:-1]], source[cuts[1:]]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)

    def id_text(self, ids: list[int]) -> str:
        return " ".join(map(self.decimal.__getitem__, ids))


def encode_documents(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids, span_begin, span_end, decoded) per row: every piece with
    its span of original bytes, and the text decoded from the ids."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer_path(model))
        for ids, texts in slices(batches):
            got = [codec.encode(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.int64())),
                 pa.array([g[2] for g in got], pa.list_(pa.int64())),
                 pa.array([codec.decode(g[0]) for g in got], pa.string())],
                ["doc_id", "ids", "span_begin", "span_end", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode, "doc_id long, ids array<int>, span_begin array<long>, span_end array<long>, decoded string")


def encode_digests(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """What :func:`encode_documents` gives, as one digest row per document:
    n_tokens, ids_sha256, decoded_sha256, and of the spans the bytes they
    cover and a CRC of their cut points."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer_path(model))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for ids, texts in slices(batches):
            rows = []
            for t in texts:
                pieces, begin, end = codec.encode(t or "")
                rows.append((len(pieces), sha(codec.id_text(pieces)), sha(codec.decode(pieces)),
                             int(end[-1]) - int(begin[0]) if len(end) else 0,
                             zlib.crc32(begin.astype("<i8").tobytes(), zlib.crc32(end.astype("<i8").tobytes()))))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_span_bytes", "spans_crc32"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                "n_span_bytes long, spans_crc32 long")
