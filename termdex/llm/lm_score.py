"""Language-model scoring with a weighted backoff automaton.

Contexts of up to ``order - 1`` words are states. A state has one weighted arc per
continuation seen in training, and one failure arc to its shorter context whose weight
is the backoff mass; the empty context (the root) has an arc for every known word and one
for any unknown word. A text is read once from left to right: the current state is
carried, failure arcs are followed until an arc for the next word exists, and all weights
are added up. Probabilities are smoothed with a Dirichlet prior on the shorter context,

    p(w | h) = (c(h w) + m * p(w | h')) / (c(h) + m),      backoff(h) = m / (c(h) + m),

with a prior m for each length of context,
and at the root by absolute discounting, ``p(w) = (c(w) - d) / N``, whose freed mass
``d * V / N`` is the probability of the class of unknown words.

How it runs. Counts are taken over all training texts and never leave the executors:

1. A scan task gathers texts into blocks of about ``block_bytes``, numbers each block's
   words and writes the numbers: the corpus is read and tokenised once. A block is cut by
   its bytes, so equal rows, however many, fill one block after another.
2. Levels are exchanged one after another. A block lists its distinct n-grams (64-bit hashes)
   of a level with their counts in its training texts, cut into shards by the leading bits of
   the hash. A shard adds the counts of its n-grams over all blocks and answers each block,
   in the block's own order, with the totals and whether another block has the n-gram too.
   Hashes spread evenly, so no n-gram, however common, makes a hot shard: it is one
   entry per block.
3. From three words on, a block asks only for n-grams whose context (all words but the
   last) another block has too. The others are its own, and so is their count: most long
   n-grams never move, and none is lost.
4. Each block's part of the automaton is built, and its texts are scored.

Memory of a task is bounded by a block or a shard (a text longer than a block is one by
itself); both grow in number with the corpus, not in size. A block and a shard that share no
n-gram exchange nothing. Two different n-grams share a hash with probability about n^2 / 2^65.

Null and empty texts score their end token alone. A null id is a training document.
Repeated rows are scored, and counted, each. With no training text every token is the
unknown class with probability 1 and scores 0. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from termdex.llm.common import hashes, mix, saved, small_batches, split_of, word_ids

# Words in the longest n-gram.
ORDER = 3
# Weight of the shorter context in p(w | h), in counts, for contexts of one and of two words;
# longer ones take the last.
PRIORS = (300.0, 3.0)
# UTF-8 bytes of text in a block: bounds the memory of a task.
BLOCK_BYTES = 6 << 20
# Reserved words: a blank cannot occur in a word.
START, END = b" start", b" end"


def _planes(a: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs (the count of bytes comes first), equal places together."""
    width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
    raw = np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + raw.T.tobytes()


def _from_planes(b: memoryview, n: int) -> tuple[np.ndarray, int]:
    """``n`` numbers, and the bytes that they took."""
    width = b[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8, n * width, 1).reshape(width, n).T
    return out.view("<u8").ravel(), 1 + n * width


class _Grams:
    """The n-grams of a block: for every level 1..order the distinct keys in rising order."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, vocab: np.ndarray, order: int):
        """``tokens``: word numbers of all texts, each with its end; ``vocab``: hashes of the words, the end's last."""
        # a block has fewer than 2**31 words
        self.tokens, self.lengths = tokens.astype(np.int32), lengths.astype(np.int64)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int64)
        self.first = np.zeros(len(self.tokens), bool)
        self.first[self.starts] = True
        self.vocab_size = len(vocab)
        at = vocab[self.tokens]
        key = at
        self.uniq, self.rep, self.inv = [], [], []
        valid = np.ones(len(key), bool)
        for level in range(1, order + 1):
            if level > 1:
                before = np.empty_like(key)
                before[1:] = key[:-1]
                ok = np.empty_like(valid)
                ok[1:] = valid[:-1]
                ok[self.first] = level == 2
                before[self.first] = hashes([START])[0]
                key, valid = mix(before, at), ok
            where = np.flatnonzero(valid)
            # any place of an n-gram stands for it, so the sort need not be stable
            by = np.argsort(key[where])
            ranked = key[where][by]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            inv = np.full(len(key), -1, np.int32)
            inv[where[by]] = np.cumsum(new, dtype=np.int32) - 1
            self.uniq.append(ranked[new])
            self.rep.append(where[by[new]].astype(np.int32))
            self.inv.append(inv)

    def trained(self, held: np.ndarray) -> list[np.ndarray]:
        """Counts of every level's n-grams in the training texts of the block."""
        on = np.repeat(~held, self.lengths)
        return [np.bincount(i[on & (i >= 0)], minlength=len(u)) for u, i in zip(self.uniq, self.inv, strict=True)]


def _blocks(block_bytes: int, kind: pa.DataType):
    """Texts -> a row for each block: ids, split, and the numbered words of its texts."""

    def block(docs: list, held: list[bool], texts: list[str]) -> pa.RecordBatch:
        per_text, vocab = word_ids(texts)
        end = np.array([len(vocab)], np.int64)
        tokens = zlib.compress(_planes(np.concatenate([y for x in per_text for y in (x, end)])), 1)
        lengths = np.array([len(x) + 1 for x in per_text], "<u4")
        packed = [np.array(held, bool).tobytes(), lengths.tobytes(), tokens, hashes([*vocab, END]).astype("<u8").tobytes()]
        one = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.array(docs, kind))
        return pa.RecordBatch.from_arrays([one, *(pa.array([x], pa.binary()) for x in packed)], ["docs", "held", "lengths", "tokens", "vocab"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held, texts, size = [], [], [], 0
        for b in batches:
            for d, h, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
                docs.append(d)
                held.append(h)
                texts.append(t)
                size += len(t) + 8
                if size >= block_bytes:
                    yield block(docs, held, texts)
                    docs, held, texts, size = [], [], [], 0
        if docs:
            yield block(docs, held, texts)

    return run


def _loaded(t: pa.Table | pa.RecordBatch, row: int, order: int) -> tuple[_Grams, np.ndarray]:
    get = lambda c: t.column(c)[row].as_py()
    lengths = np.frombuffer(get("lengths"), "<u4")
    tokens, _ = _from_planes(memoryview(zlib.decompress(get("tokens"))), int(lengths.sum()))
    grams = _Grams(tokens, lengths, np.frombuffer(get("vocab"), "<u8"), order)
    return grams, np.frombuffer(get("held"), bool)


def _asked(block: int, lists: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """A block's n-grams and counts (of one or more levels) as a packed row for each shard that has any."""
    bases = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    cuts = [np.append(np.searchsorted(u, bases), len(u)) for u, _ in lists]
    some = np.flatnonzero(sum(np.diff(c) for c in cuts))
    rows = []
    for s in some.tolist():
        parts = [(u[c[s] : c[s + 1]], n[c[s] : c[s + 1]]) for (u, n), c in zip(lists, cuts, strict=True)]
        rows.append(np.array([len(u) for u, _ in parts], "<i8").tobytes() + b"".join(_planes(np.diff(u, prepend=bases[s])) + _planes(n) for u, n in parts))
    shards = pa.array(some.astype(np.int32))
    return pa.RecordBatch.from_arrays([shards, pa.array(np.full(len(rows), block, np.int64)), pa.array(rows, pa.binary())], ["shard", "block", "data"])


_ASKED = "shard int, block long, data binary"
_ANSWERED = "block long, shard int, data binary, total long, kinds long, once long, twice long"


def _first_request(order: int, bits: int):
    """Blocks -> what they ask for of one and two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                grams, held = _loaded(b, r, min(order, 2))
                yield _asked(b.column("block")[r].as_py(), list(zip(grams.uniq, grams.trained(held), strict=True)), bits)

    return run


def _reply(levels: int, bits: int):
    """All blocks' rows of a shard -> the total count of every key, for each block, and the shard's own sums."""

    def run(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        base = np.uint64(shard << (64 - bits)) if bits else np.uint64(0)
        data = [memoryview(x) for x in t.column("data").to_pylist()]
        sizes = np.array([np.frombuffer(d, "<i8", levels) for d in data])
        at = [levels * 8] * len(data)
        answers: list[list[bytes]] = []
        sums: list[int] = []
        for level in range(levels):
            keys, counts = [], []
            for k, d in enumerate(data):
                n = int(sizes[k, level])
                got, used = _from_planes(d[at[k] :], n)
                own, more = _from_planes(d[at[k] + used :], n)
                keys.append(np.cumsum(got, dtype=np.uint64) + base)
                counts.append(own)
                at[k] += used + more
            u, inv = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(u), np.int64)
            np.add.at(total, inv, np.concatenate(counts).astype(np.int64))
            shared = np.bincount(inv, minlength=len(u)) > 1
            # the total, and in the last bit whether another block has the n-gram
            mine = np.split((2 * total + shared)[inv], np.cumsum(sizes[:, level])[:-1])
            answers.append([_planes(x.astype(np.uint64)) for x in mine])
            if not sums:
                sums = [int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())]
        rows = [sizes[k].astype("<i8").tobytes() + b"".join(a[k] for a in answers) for k in range(len(data))]
        none = [None] * len(data)
        return pa.table(
            {
                "block": [*t.column("block").to_pylist(), None],
                "shard": pa.array(np.full(len(rows) + 1, shard, np.int32)),
                "data": pa.array([*rows, None], pa.binary()),
                **{c: pa.array([*none, x], pa.int64()) for c, x in zip(("total", "kinds", "once", "twice"), sums, strict=True)},
            }
        )

    return run


def _answers(replies: pa.Table, first: int, levels: int) -> list[np.ndarray]:
    """The answers to a block in its own order: an array for each level asked, from level ``first`` on."""
    of = replies.column("level").to_pylist()
    got = sorted((s, d) for at, s, d in zip(of, replies.column("shard").to_pylist(), replies.column("data").to_pylist(), strict=True) if at == first)
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(levels)]
    for _, d in got:
        at = 8 * levels
        for level, n in enumerate(np.frombuffer(d, "<i8", levels).tolist()):
            x, used = _from_planes(memoryview(d)[at:], n)
            found[level].append(x.astype(np.int64))
            at += used
    return [np.concatenate(x) for x in found]


def _totals(grams: _Grams, held: np.ndarray, replies: pa.Table, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Totals of the levels that have been answered, and whether another block has the n-gram."""
    own = grams.trained(held)
    first = _answers(replies, 1, min(order, 2))
    counts, shared = [x >> 1 for x in first], [(x & 1).astype(bool) for x in first]
    for level in range(3, order + 1):
        if len(own) < level:
            break
        moved = _moved(grams, shared, level)
        total, both = own[level - 1].astype(np.int64), np.zeros(len(own[level - 1]), bool)
        if moved.any():
            (got,) = _answers(replies, level, 1)
            total[moved], both[moved] = got >> 1, (got & 1).astype(bool)
        counts.append(total)
        shared.append(both)
    return counts, shared


def _moved(grams: _Grams, shared: list[np.ndarray], level: int) -> np.ndarray:
    """Which n-grams of a level have a context that another block has too."""
    return shared[level - 2][grams.inv[level - 2][grams.rep[level - 1] - 1]]


def _next_request(level: int, bits: int):
    """A block and its answers so far -> what it asks for of ``level`` words."""

    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for r in range(t.num_rows):
            grams, held = _loaded(t, r, level)
            _, shared = _totals(grams, held, replies, level - 1)
            moved = _moved(grams, shared, level)
            rows.append(_asked(t.column("block")[r].as_py(), [(grams.uniq[-1][moved], grams.trained(held)[-1][moved])], bits))
        return pa.Table.from_batches(rows) if rows else pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})

    return run


class Automaton:
    """The part of the backoff automaton that the texts of one block can reach.

    ``arc_key`` holds ``state * vocabulary + word`` in rising order; state 0 is the root.
    """

    def __init__(self, g: _Grams, counts: list[np.ndarray], total: int, distinct: int, once: int, twice: int, priors: list[float]):
        order = len(counts)
        W = g.vocab_size
        c1 = counts[0]
        d = (once + 1) / (once + 2 * twice + 2)
        n = max(total, 1)
        unknown = d * distinct / n if distinct else 1.0
        prob = np.where(c1 > 0, (c1 - d) / n, unknown)
        key = [g.tokens[g.rep[0]]]
        weight = [np.log10(prob)]
        # States: the root, the start of a text, then every seen context of each length.
        texts = int(c1[self._end(g)])
        bow, fail = [np.zeros(1), self._bow(np.array([texts]), priors[0])], [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        size, state = 2, []
        for level in range(1, order):
            c = counts[level - 1]
            s = np.where(c > 0, size + np.cumsum(c > 0) - 1, -1)
            seen, rep = c > 0, g.rep[level - 1]
            bow.append(self._bow(c[seen], priors[level - 1]))
            if level == 1:
                fail.append(np.zeros(int(seen.sum()), np.int64))
            else:
                fail.append(state[-1][g.inv[level - 2][rep[seen]]])
            state.append(s)
            size += int(seen.sum())
        # next state of the root's arcs: the word itself as a context, if any was trained
        after = [np.maximum(state[0], 0) if order > 1 else np.zeros(len(c1), np.int64)]
        for level in range(2, order + 1):
            c, rep, inv = counts[level - 1], g.rep[level - 1], g.inv
            seen = c > 0
            rep, c = rep[seen], c[seen]
            if level == 2:
                own = c1[inv[0][rep - 1]]
                source = np.where(g.first[rep], 1, state[0][inv[0][rep - 1]])
                own = np.where(g.first[rep], texts, own)
            else:
                own = counts[level - 2][inv[level - 2][rep - 1]]
                source = state[level - 2][inv[level - 2][rep - 1]]
            lower = prob[inv[level - 2][rep]]
            prior = priors[level - 2]
            p = np.zeros(len(counts[level - 1]))
            p[seen] = (c + prior * lower) / (own + prior)
            key.append(source * W + g.tokens[rep])
            weight.append(np.log10(p[seen]))
            after.append(state[level - 1][seen] if level < order else state[level - 2][inv[level - 2][rep]])
            prob = p
        k = np.concatenate(key)
        key.clear()
        o = np.argsort(k)
        self.arc_key = k[o]
        del k
        self.arc_weight, self.arc_next = np.concatenate(weight)[o], np.concatenate(after)[o]
        self.bow, self.fail, self.words, self.start = np.concatenate(bow), np.concatenate(fail), W, 1 if order > 1 and texts else 0

    @staticmethod
    def _end(g: _Grams) -> int:
        """Number of the end token among the distinct words."""
        return int(g.inv[0][g.starts[0] + g.lengths[0] - 1])

    @staticmethod
    def _bow(c: np.ndarray, prior: float) -> np.ndarray:
        return np.log10(prior / (c + prior))

    def score(self, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each text; all texts advance together, one word at a time."""
        by = np.argsort(-lengths, kind="stable")
        starts, left = starts[by], lengths[by]
        state = np.full(len(by), self.start, np.int64)
        total = np.zeros(len(by))
        running = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right")
        for step, n in enumerate(running):
            word = tokens[starts[:n] + step]
            todo = np.arange(n)
            while len(todo):
                key = state[todo] * self.words + word[todo]
                at = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
                hit = self.arc_key[at] == key
                go, at = todo[hit], at[hit]
                total[go] += self.arc_weight[at]
                state[go] = self.arc_next[at]
                todo = todo[~hit]
                total[todo] += self.bow[state[todo]]
                state[todo] = self.fail[state[todo]]
        out = np.empty(len(by))
        out[by] = total
        return out


def _score(order: int, priors: list[float], sums: tuple[int, int, int, int], schema: pa.Schema):
    """A block and the shards' answers to it -> one scored row per text."""
    total, distinct, once, twice = sums

    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return schema.empty_table()
        g, held = _loaded(t, 0, order)
        counts, _ = _totals(g, held, replies, order)
        c = counts[0][g.inv[0]]
        add = lambda x: np.add.reduceat(x, g.starts)
        auto = Automaton(g, counts, total, distinct, once, twice, priors)
        return pa.table(
            {
                "doc_id": t.column("docs").combine_chunks().flatten(),
                "held_out": held,
                "n_tokens": g.lengths,
                "n_known": add((c > 0).astype(np.int64)),
                "train_tokens": np.full(len(g.starts), total, np.int64),
                "base_score": add(np.log10(c + 1.0)) - g.lengths * math.log10(total + distinct + 1),
                "score": auto.score(g.tokens, g.starts, g.lengths),
            },
            schema=schema,
        )

    return run


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    prior: float | Sequence[float] = PRIORS,
    folds: int = 7,
    held_fold: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Score every text with the model learned from the texts that are not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one
    row per input row. ``base_score`` is the add-one unigram score over the same counts.
    ``prior`` is one for all contexts, or one for each length from one word on (the last for longer ones).
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    given = list(prior) if isinstance(prior, Sequence) else [prior]
    priors = (given + given[-1:] * order)[:max(order - 1, 1)]
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(split_of(id_col, folds) == held_fold, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType
    packed = rows.mapInArrow(_blocks(block_bytes, to_arrow_type(kind)), f"docs array<{kind.simpleString()}>, held binary, lengths binary, tokens binary, vocab binary")
    blocks = saved(packed.withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    n_blocks = blocks.count()
    # shards hold about as much as blocks; their number is a power of two (leading bits)
    bits = math.ceil(math.log2(n_blocks)) + 2 if n_blocks > 1 else 0
    by_block = blocks.groupBy("block")

    asked = blocks.mapInArrow(_first_request(order, bits), _ASKED)
    first = saved(asked.groupBy("shard").applyInArrow(_reply(min(order, 2), bits), _ANSWERED), "lm-answers")
    sums = first.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "kinds", "once", "twice"))).first()
    replies = first.filter("block is not null").select("block", "shard", "data", F.lit(1).alias("level"))
    for level in range(3, order + 1):
        asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(_next_request(level, bits), _ASKED)
        answered = saved(asked.groupBy("shard").applyInArrow(_reply(1, bits), _ANSWERED), "lm-answers")
        replies = replies.union(answered.filter("block is not null").select("block", "shard", "data", F.lit(level).alias("level")))
    out = f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema = to_arrow_schema(StructType.fromDDL(out))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(_score(order, priors, tuple(sums), schema), out)
