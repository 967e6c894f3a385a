"""Byte-level BPE with the tiktoken library and a local rank file.

A rank file (a parameter; nothing is trained) gives every token's bytes and rank. Each match
of the split pattern is encoded separately by the library's merges, without special tokens.
Ids decode to raw bytes, so the bytes of every text come back exactly, also where a token
ends inside a character.

Long texts. The library matches its pattern over a whole text at once, and its matcher stops
with a stack overflow at a run of about a million white-space characters. So a text is split
beforehand at *safe boundaries*, where a match ends whatever stands around:

- between a character that is no white space and a blank after it: no match goes on into
  white space, and none looks past it. Parts of at least ``PART`` characters are cut there;
- around a run of ``RUN`` or more white-space characters: the pattern makes one match of all
  but the last, which may lead the next word, or of the whole run at the end of the text.
  That match goes to the merges directly.

A single match of any length (a long run of letters, say) is merged by the library in time
near its length. The ids are those of the whole text encoded at once.

The rank file's bytes (a few hundred KB, fixed by the vocabulary) go to the workers once;
a worker keeps its encoder from task to task. Texts are coded a few at a time, and no task
holds more than a batch of texts with their ids.

Null texts give null ids, null ids null bytes; empty texts give no ids and no bytes. Repeated
rows are coded each. Other columns are untouched. An id outside the file fails the job.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from termdex.llm.common import ship, small_batches

# Characters of a text that are given to the library at once, at least.
PART = 1 << 20
# White-space characters in a row that are matched here and not by the library.
RUN = 1 << 14
# Texts coded together.
BATCH = 128

# The characters of \s in the library's matcher. Python's \s holds these and four more.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE = re.compile(r"(?<=\S) ")


class Ranks(NamedTuple):
    """A rank file (its lines: a token's bytes in base64, and its rank) and its split pattern."""

    data: bytes
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Ranks:
        with open(path, "rb") as f:
            return cls(f.read(), pattern)


def public_ranks() -> Ranks:
    import public_tokenizers

    return Ranks.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Parts of a text, at least ``size`` characters each, cut at safe boundaries."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Coder:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: Ranks, run: int = RUN, part: int = PART):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.data.splitlines()) if a}
        self.library = tiktoken.Encoding("ranks", pat_str=ranks.pattern, mergeable_ranks=table, special_tokens={})
        self.part = part
        self.blank = re.compile(f"[{_SPACE}]{{{run},}}")

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        at = 0
        for run in self.blank.finditer(text):
            # a run at the end is one match; another leaves its last character to the text after it
            end = run.end() if run.end() == len(text) else run.end() - 1
            self._plain(text[at : run.start()], ids)
            ids += self.library._encode_single_piece(text[run.start() : end])
            at = end
        self._plain(text[at:], ids)
        return ids

    def _plain(self, text: str, ids: list[int]) -> None:
        if text:
            for p in parts(text, self.part):
                ids += self.library.encode_ordinary(p)

    def decode(self, ids: list[int]) -> bytes:
        return self.library.decode_bytes(ids)


_CODER: tuple = (None, None)


def _worker_coder(ranks: Ranks) -> Coder:
    """The coder of this Python worker, kept from task to task."""
    global _CODER
    if _CODER[0] != ranks:
        _CODER = (ranks, Coder(ranks))
    return _CODER[1]


def encode(spark: SparkSession, ranks: Ranks, text: Column) -> Column:
    """``array<int>`` of a text column's ids."""
    small_batches(spark)
    shared = ship(spark, ranks)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _worker_coder(shared())
        for b in batches:
            done = [pa.array([], pa.list_(pa.int32()))]
            for a in range(0, len(b), BATCH):
                ids = [None if t is None else np.array(coder.encode(t), np.int32) for t in b.slice(a, BATCH).to_pylist()]
                done.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.concat_arrays(done)

    return run(text)


def decode(spark: SparkSession, ranks: Ranks, ids: Column) -> Column:
    """``binary`` of a column of ids: the tokens' bytes in a row."""
    small_batches(spark)
    shared = ship(spark, ranks)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _worker_coder(shared())
        for b in batches:
            done = [pa.array([], pa.binary())]
            for a in range(0, len(b), BATCH):
                done.append(pa.array([None if x is None else coder.decode(x) for x in b.slice(a, BATCH).to_pylist()], pa.binary()))
            yield pa.concat_arrays(done)

    return run(ids)


def id_bytes(ids: Column) -> Column:
    """Ids as little-endian unsigned 32-bit numbers in a row."""

    @F.arrow_udf("binary")
    def run(x: pa.Array) -> pa.Array:
        ends = x.offsets.to_numpy()
        flat = x.values.to_numpy(zero_copy_only=False).astype("<u4")
        return pa.array([None if null else flat[a:b].tobytes() for a, b, null in zip(ends[:-1], ends[1:], x.is_null().to_pylist(), strict=True)], pa.binary())

    return run(ids)
