"""Token ids of a whole corpus by a byte-level BPE, with forced-boundary splitting.

A pair of bytes that occurs inside no vocabulary token can never be joined by a merge, so the text may be cut between
them, and the fragments are encoded independently and concatenated. A cut must also leave the pre-tokenizer's view of
both sides alone: it lies between characters, not after white space (which the pattern groups by what follows it) and
not before an apostrophe (which may begin a contraction). As no token of such a vocabulary reaches past a word, the
fragments are mostly single words, and a worker meets the same ones again and again: their ids are kept in a table.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.tables import spread

#: Fragments of at most KEEP_BYTES are remembered, KEEP of them; then the table starts anew.
KEEP_BYTES, KEEP = 64, 400_000
#: Bytes of text a worker splits at a time.
BLOCK = 4 << 20

# The byte-level BPE's pattern and the white space of Unicode as UTF-8.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 ᠎           ​    　﻿"

_encoders: dict = {}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Where a public vocabulary lies: in the folder given, in $OFFERLOOM_TOKENIZERS or in the installed package."""
    folder = folder or os.environ.get("OFFERLOOM_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


class Splitter:
    """Encodes texts (UTF-8 bytes) to ids; one for each vocabulary and worker process."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        inside = np.zeros((256, 256), dtype=bool)
        for token in ranks:
            b = np.frombuffer(token, dtype=np.uint8)
            inside[b[:-1], b[1:]] = True
        may = ~inside
        may[:, 0x80:0xC0] = False  # never inside a character
        may[:, ord("'")] = False
        for c in WHITE:
            if len(c.encode()) == 1:
                may[ord(c), :] = False
        self.may = may.ravel()
        self.wide_white = [c.encode() for c in WHITE if len(c.encode()) > 1]
        self.known: dict[bytes, list[int]] = {}

    def cuts(self, data: bytes) -> np.ndarray:
        """Positions where data may be cut."""
        b = np.frombuffer(data, dtype=np.uint8)
        if len(b) < 2:
            return np.zeros(0, dtype=np.int64)
        free = self.may[b[:-1].astype(np.int32) << 8 | b[1:]]
        if b.max() >= 0x80:
            for w in self.wide_white:
                at = data.find(w)
                while at >= 0:
                    if at + len(w) - 1 < len(free):
                        free[at + len(w) - 1] = False
                    at = data.find(w, at + len(w))
        return np.flatnonzero(free) + 1

    def fragment(self, piece: bytes) -> list[int]:
        ids = self.encoding.encode_ordinary(piece.decode("utf-8", "replace"))
        if len(piece) <= KEEP_BYTES:
            if len(self.known) >= KEEP:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, data: bytes) -> list[int]:
        known, out, start = self.known, [], 0
        for end in [*self.cuts(data).tolist(), len(data)]:
            piece = data[start:end]
            start = end
            ids = known.get(piece)
            out.extend(self.fragment(piece) if ids is None else ids)
        return out


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


def corpus_ids(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """One row for each row of df: the key and ids, the text's token ids without special tokens.

    Texts are taken unchanged; strings that look like special tokens are ordinary text. Null and empty texts give an
    empty list, repeated rows one row each. The vocabulary (under 1 MB) is read on the driver and broadcast. Texts
    are only shuffled where the scan has fewer partitions than there are cores. Very long texts are split like any other.
    """
    with open(vocabulary or vocabulary_path(), "rb") as f:
        raw = f.read()
    shared = df.sparkSession.sparkContext.broadcast(raw)
    mark = hash(raw)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _encoders:
            _encoders[mark] = Splitter(read_ranks(shared.value))
        coder = _encoders[mark]
        for batch in batches:
            texts, start = batch.column(1), 0
            while start < len(texts):
                flat, ends, size, at = [], [0], 0, start
                while at < len(texts) and size < BLOCK:
                    data = texts[at].as_py()
                    if data:
                        flat.extend(coder.encode(data))
                        size += len(data)
                    ends.append(len(flat))
                    at += 1
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, at - start), ids], [key, "ids"])
                start = at

    rows = spread(df).selectExpr(f"`{key}`", f"cast(`{text}` as binary) as __text")
    return rows.mapInArrow(encode, f"`{key}` {dict(df.dtypes)[key]}, ids array<int>")
