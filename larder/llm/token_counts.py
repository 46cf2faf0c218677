"""Token counts: lengths only, in Arrow functions.

Work is cut by bytes, not by rows: texts are gathered into slices of a few
megabytes, and a long text is cut into segments at safe boundaries.  A safe
boundary is a place where a character that isn't white space is followed by
one that is: the vocabulary's pre-tokeniser only has tokens in which white
space comes first, so it always starts a new token there, and the pieces' ids
are the whole text's ids.  The same boundaries cut segments into word-like
pieces whose counts a worker remembers (a bounded table), so each worker
encodes a frequent piece once.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null id is
returned as it is; repeated rows are counted each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.frames import id_and_text, slices, tokenizer_path

#: The code points with Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
#: Characters of a segment, of a remembered piece, and pieces remembered.
SEGMENT_CHARS, MEMO_CHARS, MEMO_PIECES = 1 << 16, 64, 300_000


def segments(text: str, limit: int = SEGMENT_CHARS) -> Iterator[str]:
    """The text in order, cut at the first safe boundary at or after every
    ``limit`` characters; a text without one stays whole."""
    start = 0
    while len(text) - start > limit:
        m = SAFE.search(text, start + limit)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:] if start else text


class PieceCounter:
    """Counts tokens of texts with a vocabulary file of ``tokenizers``
    (.json) or ``sentencepiece`` (.model)."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        self.memo: dict[str, int] = {}
        self.memo_pieces = memo_pieces
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.pieces = False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.whole = lambda texts: [len(x) for x in model.encode_batch_fast(
                texts, add_special_tokens=False)]
            # pieces are safe for byte-level vocabularies that add no prefix
            self.pieces = '"ByteLevel"' in (spec := str(model.pre_tokenizer.__getstate__())) and \
                '"add_prefix_space":false' in spec.replace(" ", "") and model.normalizer is None

    def counts(self, texts: list[str]) -> list[int]:
        if not self.pieces:
            return self.whole(texts)
        out = [0] * len(texts)
        queue: list[tuple[int, list[str]]] = []
        for k, t in enumerate(texts):
            for s in segments(t):
                queue.append((k, PIECE.findall(s)))
        new: set[str] = set()
        for _, pieces in queue:
            new.update(p for p in pieces if p not in self.memo)
        if len(self.memo) + len(new) > self.memo_pieces and self.memo:
            self.memo.clear()
            new = set().union(*(pieces for _, pieces in queue))
        todo = list(new)
        fresh = dict(zip(todo, self.whole(todo)))
        if fresh:
            self.memo.update(fresh)
        get = self.memo.__getitem__
        for k, pieces in queue:
            out[k] += sum(map(get, pieces))
        if len(self.memo) > self.memo_pieces or any(len(p) > MEMO_CHARS for p in fresh):
            self.memo = {p: n for p, n in self.memo.items() if len(p) <= MEMO_CHARS}
        return out


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row; no ids leave the
    function."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer_path(vocabulary))
        for ids, texts in slices(batches):
            texts = [t or "" for t in texts]
            n = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
