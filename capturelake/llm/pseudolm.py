"""Masked pseudo-likelihood of a bidirectional window network.

Method. Every token is predicted from the ``SPAN`` tokens on either side of it, itself
hidden; the sum of the log-probabilities scores the document. The network has embeddings of
the neighbours, a tanh layer and a softmax over the whole vocabulary in three levels:
P(class) P(leaf | class) P(word | leaf). The ``HEADS`` most frequent words are classes of
their own. All others fall into ``GROUPS`` classes of about equal mass by their last two
bytes; the ``OWN`` most frequent words of a group are leaves of their own, the rest share
``RARE`` leaves, dealt by hash. The network gives the first two levels from both sides; a
word in a shared leaf has the share of its corpus count there, and one part of each shared
leaf is left for words that no count knows, so the probabilities of all words sum to 1.

Everything is gathered over all documents. Words are counted by a partially aggregated
shuffle. Each text becomes a row of leaf numbers, written once. Rows are dealt by a digest
of id and text to rounds and to shards of about ``SHARD`` tokens, and sorted within them. In
a round every shard trains with Adagrad in numpy from the same start on its rows of that
round, and the weights are averaged by tokens. Every token is a target once. Shards, order
and batches follow from the rows alone, so the layout of the table changes results by
rounding only.

Bounds. What tasks and driver hold is bounded by ``VOCABULARY``, the weights and a slice of
text or one document. Counts of the words beyond the vocabulary are joined to their tokens.
Rows that are equal in id and text share a shard; other copies don't.

Cases. Null, empty and blank texts have no tokens, log_prob 0 and a null mean. Repeated
rows count as often as they occur. A null id stays null, extra columns are ignored, an
empty table gives an empty result. Ties of counts go to the smaller hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import text as tx
from capturelake.scratch import Scratch

HEADS, GROUPS, OWN, RARE = 32, 32, 96, 32
CLASSES, MEMBERS = HEADS + GROUPS, OWN + RARE
LEAVES = HEADS + GROUPS * MEMBERS
PAD = LEAVES
VOCABULARY = 200_000
SPAN, WIDTH, HIDDEN = 3, 12, 24
ROUNDS, BATCH, SHARD = 2, 8192, 1 << 20
PART = 2048  # tokens whose logits of classes are held at once
MOST_TASKS = 20_000
CHUNKS = 64
PLACES = [*range(-SPAN, 0), *range(1, SPAN + 1)]
SHAPES = {
    "e": (LEAVES + 1, WIDTH),
    "w": (len(PLACES) * WIDTH, HIDDEN),
    "b": (HIDDEN,),
    "u": (HIDDEN, CLASSES),
    "c": (CLASSES,),
    "v": (GROUPS, HIDDEN, MEMBERS),
    "d": (GROUPS, MEMBERS),
}


def hashed(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, last two bytes as a number (the last one first) and row bounds of a slice."""
    buf, offs = tx.string_bytes(column)
    words = tx.Words(buf, offs)
    bounds = words.bounds(len(offs) - 1)
    if not len(words):
        return words.hash, np.zeros(0, np.int64), bounds
    last = tx._LOWER[buf[words.end - 1]].astype(np.int64)
    prior = np.where(words.end - words.start > 1, tx._LOWER[buf[np.maximum(words.end - 2, 0)]], 0)
    return words.hash, last * 256 + prior, bounds


@tx.released
def _counts(batches):
    """Partial counts of words: h, tail, n."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        h, tail, n = (np.concatenate(x) for x in zip(*held, strict=True))
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        return u, tail[first], np.bincount(inverse, n, len(u)).astype(np.int64)

    def sent(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], ["h", "tail", "n"])

    for batch in batches:
        for part in tx.slices(batch, "text"):
            h, tail, _ = hashed(part.column(0))
            if len(h):
                # sorting values alone is much faster than sorting their places
                u, n = np.unique(h, return_counts=True)
                own = np.empty(len(u), tail.dtype)
                own[tx.Table(u).find(h)] = tail
                held.append((u, own, n))
                size += len(u)
            if size > 400_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 200_000:
                    yield sent(held[0])
                    held, size = [], 0
    if held:
        yield sent(merged())


class Vocabulary:
    """Leaves of words and the log-probability of a word within its leaf. Picklable."""

    def __init__(self, tails: dict[int, int], h: np.ndarray, tail: np.ndarray, n: np.ndarray):
        """Tokens by last two bytes, and the most frequent words in order with their last bytes and counts."""
        mass = np.zeros(1 << 16)
        for t, tokens in tails.items():
            mass[t] = tokens
        np.subtract.at(mass, tail[:HEADS], n[:HEADS])
        reach = np.cumsum(mass) - mass / 2
        self.group = np.minimum(reach * GROUPS / max(mass.sum(), 1), GROUPS - 1).astype(np.int16)
        group = self.group[tail[HEADS:]]
        order = np.argsort(group, kind="stable")
        rank = np.empty(len(group), np.int64)
        rank[order] = np.arange(len(group)) - np.searchsorted(group[order], group[order])
        own = HEADS + group.astype(np.int64) * MEMBERS + rank
        leaf = np.concatenate([np.arange(min(HEADS, len(h))), np.where(rank < OWN, own, self.shared(h[HEADS:], tail[HEADS:]))])
        self.known = tx.Table(h)
        self.leaf, self.log_n = leaf.astype(np.int16), np.log(n).astype(np.float32)

    def shared(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """The shared leaf of words that have none of their own."""
        return HEADS + self.group[tail].astype(np.int64) * MEMBERS + OWN + (h >> np.uint64(59)).astype(np.int64) % RARE

    def leaves(self, h: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each word and its place among the known words, -1 if it is none."""
        at = self.known.find(h)
        out = self.leaf[at].astype(np.int64) if len(self.leaf) else np.zeros(len(h), np.int64)
        lost = np.flatnonzero(at < 0)
        out[lost] = self.shared(h[lost], tail[lost])
        return out, at

    def weigh(self, mass: np.ndarray) -> None:
        """Takes the tokens of all leaves."""
        self.mass = mass
        alone = np.ones(LEAVES, bool)
        alone[HEADS:].reshape(GROUPS, MEMBERS)[:, OWN:] = False
        self.alone = alone
        # one more token of a shared leaf stands for words that no count knows
        self.base = np.where(alone, -np.log(np.maximum(mass, 1)), -np.log(mass + 1)).astype(np.float64)

    def look(self, h: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaves, log-probabilities within them, and whether those have the word's count; where not, its log is to be added."""
        leaf, at = self.leaves(h, tail)
        within = self.base[leaf]
        if len(self.log_n):
            within = within + np.where(at >= 0, self.log_n[at], 0)
        return leaf, np.where(self.alone[leaf], 0, within), at >= 0


def _leaf_mass(vocabulary):
    """Partial sums of counts by leaf: leaf, n."""

    def run(batches):
        total = np.zeros(LEAVES)
        for batch in batches:
            h, tail, n = (batch.column(i).to_numpy() for i in range(3))
            if len(h):
                total += np.bincount(vocabulary.value.leaves(h.view(np.uint64), tail.astype(np.int64))[0], n, LEAVES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], ["leaf", "n"])

    return tx.released(run)


def _code(vocabulary):
    """Leaf numbers of every row, what its counts give, and the words whose counts are still to come."""

    def run(batches):
        own, row = vocabulary.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in tx.slices(batch, "text"):
                h, tail, bounds = hashed(part.column(2))
                leaf, within, known = own.look(h, tail)
                sums = np.concatenate([[0.0], np.cumsum(within)])
                lost = np.concatenate([[0], np.cumsum(~known)])[bounds].astype(np.int32)
                raw = pa.py_buffer(leaf.astype("<i2").tobytes())
                codes = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((2 * bounds).astype(np.int32)), raw])
                rows = np.arange(row, row + part.num_rows)
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(bounds)),
                        pa.array(sums[bounds[1:]] - sums[bounds[:-1]]),
                        codes,
                        pa.ListArray.from_arrays(pa.array(lost), pa.array(h[~known].view(np.int64))),
                    ],
                    ["row", "key", "id", "n_tokens", "base", "codes", "lost"],
                )

    return tx.released(run)


CODED = "row long, key long, id long, n_tokens long, base double, codes binary, lost array<long>"


def portions(column, size: int = 1 << 17):
    """(from, to) of consecutive rows with about that many tokens; a longer row is alone."""
    offs = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + 2 * size, "right")) - 1)
        yield at, min(to, len(column))
        at = to


def leaves_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Joined leaf numbers of a binary column and the bounds of its rows."""
    offs = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    raw = np.frombuffer(column.buffers()[2], np.uint8, int(offs[-1] - offs[0]), int(offs[0])) if offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return raw.view("<i2"), (offs - offs[0]).astype(np.int64) // 2


def neighbours(leaf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Leaves of the neighbours of each token, PAD outside its row: (tokens, places)."""
    n = len(leaf)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.full((n, len(PLACES)), PAD, np.int16)
    for k, d in enumerate(PLACES):
        lo, hi = max(0, -d), min(n, n - d)
        if hi > lo:
            same = row[lo:hi] == row[lo + d : hi + d]
            out[lo:hi, k] = np.where(same, leaf[lo + d : hi + d], PAD)
    return out


def start(mass: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random weights, and the unigram probabilities of classes and leaves as biases."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.standard_normal(s) * (0.3 if k == "e" else 0.15)).astype(np.float32) for k, s in SHAPES.items()}
    p["b"][:] = 0
    members = mass[HEADS:].reshape(GROUPS, MEMBERS) + 0.0
    members[:, OWN:] += 1
    total = np.concatenate([mass[:HEADS], members.sum(1)])
    with np.errstate(divide="ignore"):
        # what no word has gets next to nothing
        p["c"] = np.maximum(np.log(total / total.sum()), -30).astype(np.float32)
        p["d"] = np.maximum(np.log(members / members.sum(1, keepdims=True)), -30).astype(np.float32)
    # nothing but the unigram at first
    p["v"] *= 0.1
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        size = int(np.prod(s))
        out[k] = x[at : at + size].reshape(s).astype(np.float32)
        at += size
    return out


def framed(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Biases above weights, as hidden() begins with ones."""
    return np.concatenate([bias[..., None, :], weights], -2)


def hidden(p, near):
    """Joined embeddings of the neighbours, and the hidden layer behind a column of ones."""
    x = p["e"].take(near.ravel(), 0).reshape(len(near), -1)
    h = x @ np.pad(p["w"], ((0, 0), (1, 0)))
    # tanh(40) is 1
    h += np.pad(p["b"], (1, 0), constant_values=40)
    return x, np.tanh(h, out=h)


def by_leaf(leaf: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of tokens by leaf, and (group, from, to) in it of every group that occurs."""
    order = np.argsort(leaf.astype(np.int16, copy=False), kind="stable")
    at = np.searchsorted(leaf[order], HEADS + MEMBERS * np.arange(GROUPS + 1)).tolist()
    return order, [(g, lo, hi) for g, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)) if hi > lo]


def split_leaf(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and member of leaves."""
    grouped = leaf >= HEADS
    return np.where(grouped, HEADS + (leaf - HEADS) // MEMBERS, leaf), np.where(grouped, (leaf - HEADS) % MEMBERS, 0)


def bounded(p) -> bool:
    """Whether no logit can overflow, as the hidden layer is within -1 and 1."""
    return all(float(np.abs(p[u]).sum(-2).max() + np.abs(p[c]).max()) < 60 for u, c in (("u", "c"), ("v", "d")))


def parts(n: int):
    return (slice(at, min(at + PART, n)) for at in range(0, n, PART))


def _exp(z: np.ndarray, safe: bool) -> np.ndarray:
    """exp(z) in place, up to a factor for each row: the sums of rows."""
    if not safe:
        z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _places(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of the own column of each row, in z as one row."""
    return np.arange(0, z.size, z.shape[1]) + own


def _log_probs(h: np.ndarray, weights: np.ndarray, own: np.ndarray, safe: bool) -> np.ndarray:
    z = h @ weights
    if not safe:
        z -= z.max(1, keepdims=True)
    at = z.ravel()[_places(z, own)]
    return at - np.log(_exp(z, True))


def log_probs(p, leaf: np.ndarray, near: np.ndarray, batch: int = 2 * BATCH) -> np.ndarray:
    """log P(leaf | neighbours) of each token."""
    out, safe = np.empty(len(leaf)), bounded(p)
    u, v = framed(p["u"], p["c"]), framed(p["v"], p["d"])
    for at in range(0, len(leaf), batch):
        here, around = leaf[at : at + batch], near[at : at + batch]
        order, groups = by_leaf(here)
        kind, member = split_leaf(here[order])
        h = np.concatenate([hidden(p, around[x])[1] for x in parts(len(here))]).take(order, 0)
        logs = np.concatenate([_log_probs(h[x], u, kind[x], safe) for x in parts(len(here))]).astype(np.float64)
        for g, lo, hi in groups:
            logs[lo:hi] += _log_probs(h[lo:hi], v[g], member[lo:hi], safe)
        out[at + order] = logs
    return out


def _slopes(h: np.ndarray, weights: np.ndarray, own: np.ndarray, n: int, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of the hidden layer and of the weights, for a mean over n tokens."""
    z = h @ weights
    total = _exp(z, safe)
    z.ravel()[_places(z, own)] -= total
    # the narrow factors are scaled, not the logits
    scale = (1 / (n * total))[:, None]
    back = z @ weights.T
    back *= scale
    return back, (h * scale).T @ z


def _embedded(p, dh: np.ndarray, leaf: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and the slopes of their embeddings.

    A neighbour that is a token of the batch, as nearly all are, gets its slope at that token's place, so that one row a token
    is sorted and not one a neighbour.
    """
    n = len(leaf)
    # rows are numbers of the embeddings, columns are tokens
    dx = (p["w"] @ dh.T).reshape(len(PLACES), WIDTH, n)
    at, slopes = [leaf.astype(np.int16)], [np.zeros((WIDTH, n), dx.dtype)]
    for k, d in enumerate(PLACES):
        lo, hi = max(0, -d), min(n, n - d)
        other = np.ones(n, bool)
        if hi > lo:
            other[lo:hi] = near[lo:hi, k] != leaf[lo + d : hi + d]
        rest = np.flatnonzero(other)
        at.append(near[rest, k])
        slopes.append(dx[k][:, rest])
        dx[k][:, rest] = 0
        if hi > lo:
            slopes[0][:, lo + d : hi + d] += dx[k][:, lo:hi]
    at = np.concatenate(at)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], np.add.reduceat(np.concatenate(slopes, 1).take(order, 1), first, 1).T


def gradient(p, leaf, near) -> dict[str, np.ndarray]:
    """Of the mean negative log-likelihood; that of the embeddings only for the rows in "at"."""
    n, safe = len(leaf), bounded(p)
    # the logits of a group are those of neighbouring rows
    order, groups = by_leaf(leaf)
    kind, member = split_leaf(leaf[order])
    x, h = hidden(p, near)
    h = h.take(order, 0)
    u, v = framed(p["u"], p["c"]), framed(p["v"], p["d"])
    back, du, dv = np.empty_like(h), np.zeros_like(u), np.zeros_like(v)
    for here in parts(n):
        back[here], more = _slopes(h[here], u, kind[here], n, safe)
        du += more
    for g, lo, hi in groups:
        more, dv[g] = _slopes(h[lo:hi], v[g], member[lo:hi], n, safe)
        back[lo:hi] += more
    h *= h
    back *= np.subtract(1, h, out=h)
    dh = np.empty_like(back)
    dh[order] = back
    dw = x.T @ dh
    at, e = _embedded(p, dh[:, 1:], leaf, near)
    return {"at": at, "e": e, "w": dw[:, 1:], "b": (np.ones(n, dh.dtype) @ dh)[1:], "u": du[1:], "c": du[0], "v": dv[:, 1:], "d": dv[:, 0]}


class Trainer:
    """Adagrad over the batches of one shard."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.08):
        self.p, self.rate = {k: v.copy() for k, v in p.items()}, rate
        self.seen = {k: np.full_like(v, 1e-6) for k, v in p.items()}
        self.tokens = 0
        self.leaves, self.nears, self.held = [], [], 0

    def step(self, leaf, near) -> None:
        g = gradient(self.p, leaf, near)
        at = g.pop("at")
        for k, d in g.items():
            if k == "e":
                seen = self.seen[k][at] + d * d
                self.seen[k][at] = seen
                self.p[k][at] -= self.rate * d / np.sqrt(seen)
            else:
                size = d * d
                self.seen[k] += size
                np.sqrt(self.seen[k], out=size)
                np.divide(d, size, out=size)
                size *= self.rate
                self.p[k] -= size
        self.tokens += len(leaf)

    def take(self, leaf, bounds) -> None:
        """More rows; steps whenever a batch is full."""
        self.leaves.append(leaf)
        self.nears.append(neighbours(leaf, bounds))
        self.held += len(leaf)
        if self.held >= BATCH:
            x, near = np.concatenate(self.leaves), np.concatenate(self.nears)
            full = self.held - self.held % BATCH
            for at in range(0, full, BATCH):
                self.step(x[at : at + BATCH], near[at : at + BATCH])
            self.leaves, self.nears, self.held = [x[full:]], [near[full:]], self.held - full

    def finish(self) -> np.ndarray:
        """The weights times the tokens they have seen."""
        if self.held:
            self.step(np.concatenate(self.leaves), np.concatenate(self.nears))
        return flat(self.p).astype(np.float64) * self.tokens


def _train(weights):
    """Of rows sorted by shard: the sums over the task's shards of weights times tokens, in chunks."""

    def run(batches):
        begin, total, tokens = shaped(weights.value), 0.0, 0
        trainer, now = None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                if a == b:
                    continue
                if shard[a] != now:
                    if trainer:
                        total, tokens = total + trainer.finish(), tokens + trainer.tokens
                    trainer, now = Trainer(begin), shard[a]
                rows = batch.column(1).slice(a, b - a)
                for lo, hi in portions(rows):
                    trainer.take(*leaves_of(rows.slice(lo, hi - lo)))
        if trainer:
            total, tokens = total + trainer.finish(), tokens + trainer.tokens
            parts = np.array_split(total, CHUNKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(CHUNKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * CHUNKS, pa.int32()), pa.array([tokens] * CHUNKS), pa.array([x.tobytes() for x in parts], pa.binary())], ["chunk", "task", "n", "v"]
            )

    return tx.released(run)


@tx.released
def _averaged(batches):
    """The mean weights of each chunk."""
    total: dict[int, np.ndarray] = {}
    tokens: dict[int, int] = {}
    for batch in batches:
        for chunk, n, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            total[chunk] = total.get(chunk, 0.0) + np.frombuffer(v.as_buffer(), np.float64)
            tokens[chunk] = tokens.get(chunk, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([(x / tokens[c]).tobytes() for c, x in total.items()], pa.binary())], ["chunk", "v"])


def _score(weights):
    def run(batches):
        p = shaped(weights.value)
        for batch in batches:
            tokens, scores = [], []
            for lo, hi in portions(batch.column(3)):
                leaf, bounds = leaves_of(batch.column(3).slice(lo, hi - lo))
                sums = np.concatenate([[0.0], np.cumsum(log_probs(p, leaf, neighbours(leaf, bounds)))])
                tokens.append(np.diff(bounds))
                scores.append(sums[bounds[1:]] - sums[bounds[:-1]])
            if tokens:
                score = batch.column(2).to_numpy() + np.concatenate(scores)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(tokens)), pa.array(score)], ["row", "id", "n_tokens", "log_prob"])

    return tx.released(run)


class PseudoLikelihood:
    """fit() gathers counts and weights from all rows; score() gives (id, n_tokens, log_prob)."""

    def __init__(self, spark: SparkSession, rounds: int = ROUNDS, shard: int = SHARD):
        self.spark, self.rounds, self.shard = spark, rounds, shard
        self.work = Scratch(spark, "pseudolm")
        self.coded: tuple[DataFrame, DataFrame] | None = None

    def _read(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        return rows.select(F.xxhash64("id", "text").alias("key"), "id", "text")

    def _vocabulary(self, texts: DataFrame) -> None:
        counts = texts.mapInArrow(_counts, "h long, tail int, n long").groupBy("h").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))
        # kept: score() reads it
        self.counts = counts = self.work.save(counts, "counts")
        # the least count of the most frequent words, from a few hundred sizes
        size = F.floor(F.log2("n") * 16).cast("int")
        sizes = {r["s"]: r["n"] for r in counts.groupBy(size.alias("s")).agg(F.count("*").alias("n")).collect()}
        room, least = VOCABULARY, 1 << 20
        for s in sorted(sizes, reverse=True):
            if sizes[s] > room:
                break
            room, least = room - sizes[s], s
        self.listed = size >= least
        top = counts.where(self.listed).select("h", "tail", "n").toArrow()
        h, tail, n = (top[c].to_numpy() for c in ("h", "tail", "n"))
        order = np.lexsort((h, -n))
        tails = {r["tail"]: r["n"] for r in counts.groupBy("tail").agg(F.sum("n").alias("n")).collect()}
        self.tokens = sum(tails.values())
        self.vocabulary = Vocabulary(tails, h[order].view(np.uint64), tail[order].astype(np.int64), n[order])
        sent = self.spark.sparkContext.broadcast(self.vocabulary)
        mass = np.zeros(LEAVES)
        for r in counts.select("h", "tail", "n").mapInArrow(_leaf_mass(sent), "leaf int, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
            mass[r["leaf"]] = r["n"]
        self.vocabulary.weigh(mass)
        self.sent = self.spark.sparkContext.broadcast(self.vocabulary)

    def fit(self, docs: DataFrame, id_col="doc_id", text_col="text") -> PseudoLikelihood:
        texts = self._read(docs, id_col, text_col)
        self._vocabulary(texts.select("text"))
        coded = self.work.save(texts.mapInArrow(_code(self.sent), CODED), "coded")
        self.coded = (docs, coded)
        shards = max(1, -(-self.tokens // (self.shard * self.rounds)))
        tasks = min(shards, MOST_TASKS)
        self.weights = flat(start(self.vocabulary.mass))
        place = F.pmod(F.xxhash64("key"), F.lit(shards))
        rows = coded.where("n_tokens > 0").select(F.pmod("key", F.lit(self.rounds)).alias("round"), place.alias("shard"), "key", "id", "codes")
        for k in range(self.rounds):
            dealt = rows.where(F.col("round") == k).repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard", "key", "id")
            gone = dealt.select("shard", "codes").mapInArrow(_train(self.spark.sparkContext.broadcast(self.weights)), "chunk int, task int, n long, v binary")
            mean = gone.repartition(CHUNKS, "chunk").sortWithinPartitions("chunk", "task").mapInArrow(_averaged, "chunk int, v binary")
            got = {r["chunk"]: np.frombuffer(r["v"], np.float64) for r in mean.collect()}
            if got:
                self.weights = np.concatenate([got[c] for c in range(CHUNKS)])
        return self

    def score(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        if self.coded and self.coded[0] is docs:
            coded = self.coded[1]
        else:
            coded = Scratch(self.spark, "pseudolm").save(self._read(docs, id_col, text_col).mapInArrow(_code(self.sent), CODED), "coded")
        sent = self.spark.sparkContext.broadcast(self.weights)
        near = coded.select("row", "id", "base", "codes").mapInArrow(_score(sent), "row long, id long, n_tokens long, log_prob double")
        # the log of a single count is 0
        logs = self.counts.where((F.col("n") > 1) & ~self.listed).select("h", F.log("n").alias("more"))
        more = coded.select("row", F.explode("lost").alias("h")).join(logs, "h").groupBy("row").agg(F.sum("more").alias("more"))
        return near.join(more, "row", "left").select("id", "n_tokens", (F.col("log_prob") + F.coalesce("more", F.lit(0.0))).alias("log_prob"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = PseudoLikelihood(spark).fit(docs).score(docs)
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "log_prob", (F.col("log_prob") / F.nullif("n_tokens", F.lit(0))).alias("mean_log_prob"))
