"""Token ids in Simple-8b files.

Each text is encoded with a public tokenizer file (a parameter; nothing is trained), the
end id is appended, and the ids of all documents in rising id order are written as a table
of *segments*; reading decodes them.

Format. A segment holds whole documents with about ``SEGMENT`` ids. Its ids are cut into
blocks of ``BLOCK``; a block is a run of little-endian 64-bit words. The top four bits of
a word select how many numbers of how many bits fill its other 60: 60 of 1 bit, 30 of 2,
20 of 3, ... one of 60 (``SELECTORS``). Each word takes the selector with the most numbers
that the next ids fit; near a block's end, one that is filled exactly. Selector 0 is an
escape: the next word is one number of 64 bits. A segment also stores the offset of every
block's first word, so blocks decode on their own and all words of one selector decode
together, as arrays.

Table columns: ``part`` (range partition), ``before`` (ids before it in the part), ``n_ids``,
``doc_ids``, ``doc_lengths``, ``offsets`` (binary, uint32 per block), ``words`` (binary).

How it runs. Documents are range-partitioned by id and sorted in their partition; equal
ids fall in one partition, ordered by text. Encoding is a map whose worker remembers the
pieces it has seen (``REMEMBERED`` at most), also for its next task: the tokenizer drops
white space, so a text's ids are those of its words in a row. A task counts the ids before
each of its segments; global starts add the totals of the parts before (one number for each
part of ``PART_BYTES`` of text reaches the driver). So reading is a map over the segments.

Null and empty texts hold the end id alone. Repeated rows are written each. Null ids come
first. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from termdex.llm.common import saved, ship, small_batches

# Numbers in a word and bits of each, by selector (selector 0 is the escape).
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
BLOCK = 1024
SEGMENT = 1 << 15
END_ID = 1
PART_BYTES = 32 << 20
# Parts whose starts are broadcast; more are joined by a shuffle.
MAX_PARTS = 500_000
# Pieces a worker remembers before it starts afresh.
REMEMBERED = 500_000
_LOW60 = np.uint64((1 << 60) - 1)


# -- coding ----------------------------------------------------------------------------


_SMALL = np.concatenate([[0], np.floor(np.log2(np.arange(1, 1 << 16))) + 1]).astype(np.uint8)


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits of each number; of some above 2**53, one too many."""
    if not len(x) or x.max() < 1 << 16:
        return _SMALL[x]
    return np.frexp(x.astype(float))[1].astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of an array of numbers below 2**64, and the offset of every block's first word."""
    x = np.ascontiguousarray(ids, np.uint64)
    n = len(x)
    # the selector with the most numbers whose numbers, from here on, fit and end in the block
    choice = np.zeros(n, np.int64)
    left = np.minimum(block - np.arange(n) % block, np.arange(n, 0, -1))
    widest, size = _bit_lengths(x), 1  # widest of the next `size` numbers
    for s in range(len(SELECTORS), 0, -1):
        count, bits = SELECTORS[s - 1]
        if count > n:
            break
        while size < count:
            step = min(size, count - size)
            widest = np.maximum(widest[:-step], widest[step:])
            size += step
        if widest.min() <= bits:
            fits = (widest <= bits) & (left[: n - count + 1] >= count)
            choice[: n - count + 1][fits] = s
    step = np.array([1, *(c for c, _ in SELECTORS)])[choice].tolist()
    places, at = [], 0
    while at < n:
        places.append(at)
        at += step[at]
    first = np.array(places, np.int64)
    chosen = choice[first] if n else np.zeros(0, np.int64)
    place = np.cumsum(1 + (chosen == 0)) - 1 - (chosen == 0)
    out = np.zeros(int(place[-1] + 1 + (chosen[-1] == 0)) if n else 0, np.uint64)
    for s, (count, bits) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(chosen == s)
        if len(own):
            v = x[first[own][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            out[place[own]] = np.bitwise_or.reduce(v, 1) | np.uint64(s << 60)
    own = np.flatnonzero(chosen == 0)
    out[place[own] + 1] = x[first[own]]
    offsets = place[np.searchsorted(first, np.arange(0, n, block))]
    return out, offsets.astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The numbers of a segment; all words of a selector at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    words = np.ascontiguousarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # the word after an escape is a number, whatever its top bits: resolve runs block by block
    plain = np.ones(len(words), bool)
    escapes = np.flatnonzero(selector == 0)
    last = -2
    for e in escapes.tolist():
        if e != last + 1:
            plain[e + 1] = False
            last = e
    count = np.where(plain, np.array([1, *(c for c, _ in SELECTORS), 0])[selector], 0)
    start = np.cumsum(count) - count
    for s, (k, bits) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(plain & (selector == s))
        if len(own):
            mask = np.uint64((1 << bits) - 1)
            v = (words[own][:, None] >> (np.arange(k, dtype=np.uint64) * np.uint64(bits))) & mask
            out[start[own][:, None] + np.arange(k)] = v
    own = np.flatnonzero(plain & (selector == 0))
    out[start[own]] = words[own + 1]
    return out


def unpack_block(words: np.ndarray, offsets: np.ndarray, n: int, b: int, block: int = BLOCK) -> np.ndarray:
    """The numbers of one block, without touching the others."""
    end = offsets[b + 1] if b + 1 < len(offsets) else len(words)
    return unpack(words[offsets[b] : end], offsets[:1], min(block, n - b * block), block)


# -- encoding --------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class WordTokenizer:
    """A tokenizer file whose ids of a text are those of its blank-separated words in a row.

    Texts of printable ASCII and Latin-1 letters, which its normaliser only lowers, are cut
    as its pre-tokenizer cuts them, and each distinct piece goes straight to its merge
    model. In other texts this holds word by word, and the library encodes the words that
    are not plain whole.
    """

    SPLIT = re.compile(r"[^ \n\t\r]+")
    # Plain characters, and the file's pre-tokenizer pattern over them (letters first: no other branch takes one first).
    PLAIN = re.compile(r"[ \n\t\r!-~À-ÖØ-öø-ÿ]*")
    CUT = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^ \n\t\ra-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.json = f.read()

    def encoder(self):
        """A function from texts to id arrays that remembers the pieces it has seen."""
        from tokenizers import Tokenizer, pre_tokenizers

        t = Tokenizer.from_str(self.json)
        merge = t.model.tokenize
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        split, match, cut = self.SPLIT.findall, self.PLAIN.fullmatch, self.CUT.findall
        # the tokenizer's own spelling of the bytes of plain letters that are not ASCII
        spelling = {c: bytewise(chr(c))[0][0] for c in range(0xC0, 0x100)}

        def plain(x: str) -> bool:
            return "<|" not in x and match(x) is not None

        def keys(x: str | None) -> list[str]:
            if not x:
                return []
            if plain(x):
                return cut(x.lower())
            return [k for w in split(x) for k in (cut(w.lower()) if plain(w) else (w,))]

        def ids_of(key: str) -> list[int]:
            if not plain(key):
                return t.encode(key, add_special_tokens=False).ids
            return [x.id for x in merge(key if key.isascii() else key.translate(spelling))]

        seen = _Numbers()
        pool, length = np.zeros(0, np.int32), np.zeros(0, np.int64)
        start = length

        def run(texts: list[str | None]) -> list[np.ndarray]:
            nonlocal seen, pool, start, length
            if len(seen) > REMEMBERED:
                seen = _Numbers()
                pool, length = pool[:0], length[:0]
            number, numbered = seen.__getitem__, []
            for x in texts:
                k = keys(x)
                numbered.append(np.fromiter(map(number, k), np.int64, len(k)))
            if seen.new:
                more, flat = [], []
                for key in seen.new:
                    got = ids_of(key)
                    more.append(len(got))
                    flat += got
                seen.new.clear()
                length = np.concatenate([length, np.array(more, np.int64)])
                pool = np.concatenate([pool, np.array(flat, np.int32)])
                start = np.cumsum(length) - length
            out = []
            for k in numbered:
                n = length[k]
                ends = np.cumsum(n)
                out.append(pool[np.repeat(start[k] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)])
            return out

        return run


_ENCODER: tuple = (None, None)


def _worker_encoder(tokenizer: WordTokenizer):
    """The encoder of this Python worker, kept with its pieces from task to task."""
    global _ENCODER
    if _ENCODER[0] != tokenizer.json:
        _ENCODER = (tokenizer.json, tokenizer.encoder())
    return _ENCODER[1]


def public_tokenizer() -> WordTokenizer:
    import public_tokenizers

    return WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))


# -- tables ----------------------------------------------------------------------------


def _segment(part: int, before: int, docs: list, ids: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    words, offsets = pack(np.concatenate(ids))
    lengths = [len(x) for x in ids]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()), pa.array([before]), pa.array([sum(lengths)]), pa.array([docs], pa.list_(kind)), pa.array([lengths], pa.list_(pa.int64())),
            pa.array([offsets.astype("<u4").tobytes()]), pa.array([words.astype("<u8").tobytes()]),
        ],
        ["part", "before", "n_ids", "doc_ids", "doc_lengths", "offsets", "words"],
    )


def _write(get, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _worker_encoder(get())
        before, docs, held, size = 0, [], [], 0
        part, kind = 0, pa.int64()
        for b in batches:
            kind = b.column("doc_id").type
            part = b.column("part")[0].as_py() if b.num_rows else part
            names, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for a in range(0, len(texts), 256):
                for name, ids in zip(names[a : a + 256], encode(texts[a : a + 256]), strict=True):
                    docs.append(name)
                    held.append(np.append(ids, np.int32(end_id)))
                    size += len(ids) + 1
                    if size >= SEGMENT:
                        yield _segment(part, before, docs, held, kind)
                        before, docs, held, size = before + size, [], [], 0
        if docs:
            yield _segment(part, before, docs, held, kind)

    return run


def write(docs: DataFrame, tokenizer: WordTokenizer, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, name: str = "token-files") -> DataFrame:
    """Write the segments of ``docs`` to the shared folder; the table is read back."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    ranged = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"part int, before long, n_ids long, doc_ids array<{kind}>, doc_lengths array<long>, offsets binary, words binary"
    return saved(ranged.mapInArrow(_write(ship(docs.sparkSession, tokenizer), end_id), schema), name)


def _decoded(b: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Document ids, ends, lengths and token ids of each segment."""
    for r in range(b.num_rows):
        get = lambda n, r=r: b.column(n)[r].as_py()
        ids = unpack(np.frombuffer(get("words"), "<u8"), np.frombuffer(get("offsets"), "<u4"), get("n_ids"))
        lengths = np.array(get("doc_lengths"), np.int64)
        yield get("doc_ids"), get("before") + np.cumsum(lengths) - lengths, lengths, ids


def _read(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, start, lengths, ids in (x for b in batches for x in _decoded(b)):
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(docs, kind), pa.array(start), pa.array(lengths), lists], ["doc_id", "start", "n_tokens", "ids"])

    return run


def _digest(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, start, lengths, ids in (x for b in batches for x in _decoded(b)):
            data, ends = memoryview(ids.astype("<u4").tobytes()), 4 * np.cumsum(lengths)
            crc = [zlib.crc32(data[e - 4 * n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, kind), pa.array(start), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with ``before`` counted from the first part on."""
    totals = dict(segments.groupBy("part").agg(F.sum("n_ids")).collect())
    firsts, total = [], 0
    for part in sorted(totals):
        firsts.append((part, total))
        total += totals[part]
    starts = segments.sparkSession.createDataFrame(firsts, "part int, first long")
    starts = F.broadcast(starts) if len(firsts) <= MAX_PARTS else starts
    return segments.join(starts, "part").withColumn("before", F.col("first") + F.col("before")).drop("first")


def _id_type(segments: DataFrame) -> T.DataType:
    return segments.schema["doc_ids"].dataType.elementType


def read(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the segments."""
    kind = _id_type(segments)
    return _placed(segments).mapInArrow(_read(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, start long, n_tokens long, ids array<long>")


def digests(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document: ``read`` with the ids as a checksum."""
    kind = _id_type(segments)
    return _placed(segments).mapInArrow(_digest(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long")


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    """crc32 of ids as little-endian unsigned 32-bit numbers."""
    return pd.Series([zlib.crc32(np.asarray(x).astype("<u4").tobytes()) for x in ids])
