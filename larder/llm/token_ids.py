"""Token ids of whole texts, as little-endian unsigned 32-bit bytes.

``byte_bpe_50k.json`` and ``byte_bpe_50k.tiktoken`` are one vocabulary in two
libraries' formats, and the second library gives the same ids about six times
faster (tests/llm compare the two over every code point and over random
texts).  Where a ``.json`` vocabulary has such a twin beside it, the twin
encodes; any other file is encoded by its own library.  Special strings inside
a text become their special id, as ``tokenizers`` does by default.

The twin's pattern runs out of stack on about a million white space characters
in a row.  Long texts are therefore cut at the safe boundaries of
:mod:`larder.llm.token_counts`, and a segment that the twin refuses is encoded
by ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable

import numpy as np

from larder.llm.token_counts import segments


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids as an array of '<u4', without begin, end or added tokens."""
    twin = path[:-5] + ".tiktoken"
    if path.endswith(".json") and os.path.exists(twin):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(twin, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        library = tokenizers_encoder(path)
        special = {t.content: i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items()}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens=special)

        def segment_ids(segment: str) -> np.ndarray:
            try:
                return np.array(own.encode(segment, allowed_special="all"), dtype="<u4")
            except ValueError:
                return library(segment)

        return lambda text: np.concatenate([segment_ids(s) for s in segments(text)])
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: np.array(pieces.encode(text), dtype="<u4")
    return tokenizers_encoder(path)


def tokenizers_encoder(path: str) -> Callable[[str], np.ndarray]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda text: np.array(
        model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
