"""Unigram piece encoding: Viterbi over a double-array trie, with byte fallback.

Pieces come from a public SentencePiece model file (a parameter; nothing is trained). Its
whitespace marker U+2581 stands for a blank; the text is prefixed with one blank. The best
segmentation maximises the sum of the pieces' log scores. A character that no piece covers
costs ``UNKNOWN_COST`` more than the worst piece and is written as its UTF-8 bytes, one
byte piece each; so is a marker character that the text itself holds. Decoding joins the
pieces, turns markers into blanks and byte pieces into bytes, and drops the prefix: it
gives back every text exactly.

The file's own scores are merge ranks, not log probabilities, so a piece's log score is
that of its rank under Zipf's law, ``-log(rank + 1) - log(H)``.

Pieces neither contain line feeds nor continue past a blank that follows another
character (checked when the model is loaded), so a text falls into chunks (blanks and the
word after them) whose best segmentations are independent. Each task segments its distinct
chunks once, many at a time: all chunks of similar length move through the trie together.
The trie (a few MB, fixed by the vocabulary) goes to the workers once.

Null texts give null ids; empty texts give no ids. Other columns are untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from termdex.llm.common import ship, small_batches

MARKER = "▁"
UNKNOWN_COST = 10.0
# Chunks up to this many bytes are segmented together; longer ones one by one.
SHORT = 48
TOGETHER = 8192
# Texts coded together.
BATCH = 256
# Slots looked at together when the trie is laid out.
STEP = 512
# Chunks a task remembers before it starts afresh.
REMEMBERED = 400_000


class Trie:
    """Double-array trie: child of node s by byte c is ``base[s] + c`` if ``check`` there is s."""

    def __init__(self, pieces: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for piece, number in pieces:
            at = 0
            for c in piece:
                nxt = children[at].get(c)
                if nxt is None:
                    nxt = len(children)
                    children[at][c] = nxt
                    children.append({})
                    value.append(-1)
                at = nxt
            value[at] = number
        # Slots for the children of every node, large families first; single children fill gaps.
        families = sorted((n for n, k in enumerate(children) if k), key=lambda n: -len(children[n]))
        room = 2 * len(children) + 1024
        used, offset = np.zeros(room, bool), np.zeros(len(children), np.int64)
        used[0] = True
        free = 1
        for node in families:
            kids = np.array(sorted(children[node]))
            free += int(np.argmin(used[free:]))
            at = max(1, free - int(kids[0]))
            while True:
                if at + 256 + STEP > len(used):
                    used = np.concatenate([used, np.zeros(len(used), bool)])
                taken = np.zeros(STEP, bool)
                for k in kids:
                    taken |= used[at + k : at + k + STEP]
                gap = int(np.argmin(taken))
                if not taken[gap]:
                    break
                at += STEP
            offset[node] = at + gap
            used[at + gap + kids] = True
        size = int(np.flatnonzero(used)[-1]) + 257
        self.base, self.check, self.number = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        todo = [(0, 0)]
        while todo:
            node, place = todo.pop()
            self.base[place], self.number[place] = offset[node], value[node]
            for c, kid in children[node].items():
                self.check[offset[node] + c] = place
                todo.append((kid, int(offset[node]) + c))


class PieceModel:
    """Pieces, log scores and trie of a vocabulary."""

    def __init__(self, names: list[str], kinds: list[str]):
        """``kinds``: ``piece``, ``byte`` or ``other`` for each id."""
        self.surface: list[bytes] = []
        self.byte_id = np.full(256, -1, np.int64)
        plain: list[tuple[bytes, int]] = []
        for i, (name, kind) in enumerate(zip(names, kinds, strict=True)):
            if kind == "byte":
                value = int(name[3:5], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            elif kind == "piece":
                s = name.replace(MARKER, " ").encode()
                self.surface.append(s)
                plain.append((s, i))
            else:
                self.surface.append(b"")
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        rank = np.arange(1, len(plain) + 1)
        self.score = np.zeros(len(names))
        self.score[[i for _, i in plain]] = -np.log(rank + 1) - np.log((1 / (rank + 1)).sum())
        self.worst = float(self.score.min()) - UNKNOWN_COST
        self.longest = max(len(s) for s, _ in plain)
        self.chunked = not any(b" " in s.lstrip(b" ") or b"\n" in s for s, _ in plain)
        self.trie = Trie(plain)

    # -- segmentation ------------------------------------------------------------------

    def segment(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of the best segmentation of each chunk."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(chunks)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]
        short = order[: np.searchsorted(sizes[order], SHORT, side="right")]
        for a in range(0, len(short), TOGETHER):
            part = short[a : a + TOGETHER]
            for i, ids in zip(part, self._together([chunks[i] for i in part]), strict=True):
                out[i] = ids
        for i in order[len(short) :]:
            out[i] = self._alone(chunks[i])
        return out

    def _together(self, chunks: list[bytes]) -> Iterator[np.ndarray]:
        n, size = len(chunks), np.array([len(c) for c in chunks])
        width = int(size.max())
        text = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in chunks), np.uint8).reshape(n, width)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((n, width + 1), -1, np.int64)
        came = np.zeros((n, width + 1), np.int64)
        base, check, number = self.trie.base, self.trie.check, self.trie.number
        # bytes of the character that starts with a byte (0 for a continuation byte)
        chars = np.select([np.arange(256) < 0x80, np.arange(256) < 0xC0, np.arange(256) < 0xE0, np.arange(256) < 0xF0], [1, 0, 2, 3], 4)
        for i in range(width):
            rows = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
            if not len(rows):
                continue
            here = best[rows, i]
            # one character by its bytes
            end = i + chars[text[rows, i]]
            cost = here + self.worst
            better = cost > best[rows, end]
            r, e = rows[better], end[better]
            best[r, e], piece[r, e], came[r, e] = cost[better], -1, i
            # every piece that starts here
            node = np.zeros(len(rows), np.int64)
            for j in range(i, width):
                ok = size[rows] > j
                rows, here, node = rows[ok], here[ok], node[ok]
                nxt = base[node] + text[rows, j]
                ok = check[nxt] == node
                rows, here, node = rows[ok], here[ok], nxt[ok].astype(np.int64)
                if not len(rows):
                    break
                found = number[node]
                known = np.flatnonzero(found >= 0)
                cost = here[known] + self.score[found[known]]
                r = rows[known]
                better = cost > best[r, j + 1]
                r = r[better]
                best[r, j + 1], piece[r, j + 1], came[r, j + 1] = cost[better], found[known][better], i
        for r in range(n):
            yield self._path(chunks[r], piece[r], came[r])

    def _path(self, chunk: bytes, piece, came) -> np.ndarray:
        ids: list[int] = []
        at = len(chunk)
        piece, came = (piece.tolist(), came.tolist()) if isinstance(piece, np.ndarray) else (piece, came)
        while at:
            start = came[at]
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids += self.byte_id[np.frombuffer(chunk[start:at], np.uint8)][::-1].tolist()
            at = start
        return np.array(ids[::-1], np.int64)

    def _alone(self, chunk: bytes) -> np.ndarray:
        """The same for one long chunk."""
        n = len(chunk)
        base, check, number = self.trie.base, self.trie.check, self.trie.number
        best, piece, came = [float("-inf")] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        score = self.score
        for i in range(n):
            here = best[i]
            if here == float("-inf"):
                continue
            c = chunk[i]
            end = i + (1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4)
            if here + self.worst > best[end]:
                best[end], piece[end], came[end] = here + self.worst, -1, i
            node = 0
            for j in range(i, min(n, i + self.longest)):
                nxt = int(base[node]) + chunk[j]
                if check[nxt] != node:
                    break
                node = nxt
                p = int(number[node])
                if p >= 0 and here + score[p] > best[j + 1]:
                    best[j + 1], piece[j + 1], came[j + 1] = here + float(score[p]), p, i
        return self._path(chunk, piece, came)

    # -- texts -------------------------------------------------------------------------

    def encoder(self):
        """A function from texts to id arrays that remembers the chunks it has seen."""
        split = re.compile(rb" *[^ \n]+|\n| +").findall if self.chunked else lambda b: [b]
        seen: dict[bytes, int] = {}
        known: list[np.ndarray] = []

        def run(texts: list[str | None]) -> list[np.ndarray | None]:
            if len(known) > REMEMBERED:
                seen.clear()
                known.clear()
            chunks = [None if t is None else split(b" " + t.encode()) if t else [] for t in texts]
            new = [c for c in dict.fromkeys(c for x in chunks if x for c in x) if c not in seen]
            for c, ids in zip(new, self.segment(new), strict=True):
                seen[c] = len(known)
                known.append(ids.astype(np.int32))
            none = np.zeros(0, np.int32)
            return [None if x is None else np.concatenate([known[seen[c]] for c in x]) if x else none for x in chunks]

        return run

    def decode(self, ids) -> str | None:
        """Text of an id sequence; bytes that are no UTF-8 become U+FFFD."""
        if ids is None:
            return None
        surface = self.surface
        return b"".join([surface[i] for i in ids]).removeprefix(b" ").decode(errors="replace")


_LOADED: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """Read a SentencePiece model file on the driver, once per path."""
    import sentencepiece

    if path in _LOADED:
        return _LOADED[path]
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    kinds = ["byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "piece" for i in range(n)]
    _LOADED[path] = PieceModel([sp.id_to_piece(i) for i in range(n)], kinds)
    return _LOADED[path]


def public_model() -> PieceModel:
    import public_tokenizers

    return load(public_tokenizers.path("piece_bpe_32k.model"))


def encode(spark: SparkSession, model: PieceModel, text: Column) -> Column:
    """``array<int>`` of a text column's piece ids."""
    small_batches(spark)
    shared = ship(spark, model)

    @F.pandas_udf("array<int>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared().encoder()
        for t in texts:
            for a in range(0, len(t), BATCH):
                yield pd.Series(one(list(t.iloc[a : a + BATCH])), dtype=object)

    return run(text)


def decode(spark: SparkSession, model: PieceModel, ids: Column) -> Column:
    """Texts of a column of piece ids."""
    small_batches(spark)
    shared = ship(spark, model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared()
        for b in batches:
            for a in range(0, len(b), BATCH):
                yield pd.Series([m.decode(None if x is None else x.tolist()) for x in b.iloc[a : a + BATCH]], dtype=object)

    return run(ids)
