"""Masked pseudo-likelihood scores from a bidirectional window network.

The network's vocabulary holds the most frequent words of the corpus; the others
share hashed places, and in its place each word has the share of its count there:
every word of the corpus has a probability of its own. The most frequent words'
counts go to every task; those of the others, which are rare, are joined. Texts are
turned into places once and the places written as a table. The network sees WIDTH words on either side of a masked one and
predicts it: embeddings by position, one tanh layer, and a softmax in two steps,
the word's class and the word in its class. It is trained in numpy on all
documents at once: in each round every task starts from the shared weights, trains
on masked positions of its own documents, and the weights are averaged by the number
of positions trained on. Positions are dealt over the rounds by hash: every one is a
target once in all rounds together.
A document's score is the sum of its words' conditional log probabilities, each
given both sides.

Defined results. Null, empty or wordless text: no tokens, a score of 0 and a null
mean; so in an empty table. Rows with equal texts get equal scores, up to the last
bits of a sum, and all count in training. Words of equal count rank by hash. The
weights depend on how rows are dealt to tasks, as each task trains on its own. A text of any length
is scored whole. Columns with the names of the results are replaced; names that
begin with __ are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import textscan
from sievemark.llm.stage import checkpointed, shuffle_partitions, without

WIDTH = 2
FREQUENT = 2048
CLASSES = 64
VOCABULARY = CLASSES * CLASSES
EMBEDDING, HIDDEN = 16, 32
ROUNDS, MASKED = 2, 8
#: Tasks whose weights are averaged together; averages are averaged again, so many at a time.
FAN_IN = 16
#: Words whose counts go to every task, at most; the counts of the others are joined.
LISTED = 1 << 18
#: Positions of one training step: few at first, more the more a task has seen.
LEAST_BATCH, BATCH, RATE = 256, 2048, 0.08
#: Classes whose rows a training step takes together, and numbers that it moves at a time.
TOGETHER, STRIP = 32, 1 << 14
_PAD = VOCABULARY
#: Embeddings, hidden layer and its bias, classes, and words of each class; the last row of these two is their bias.
_SHAPES = {"e": (VOCABULARY + 1, EMBEDDING), "w": (2 * WIDTH * EMBEDDING, HIDDEN), "b": (HIDDEN,), "c": (HIDDEN + 1, CLASSES), "v": (CLASSES, HIDDEN + 1, CLASSES)}
#: Where each place's embedding stands among the numbers of all, two of which are added up as one complex number.
_SPOTS = np.arange((VOCABULARY + 1) * EMBEDDING // 2).reshape(-1, EMBEDDING // 2)
#: exp() of float32 logits up to this is summed without taking the row's most off.
_SAFE = 60.0
_SAFE_SUM = float(np.exp(_SAFE))
_ONES = np.ones(CLASSES, np.float32)
Weights = dict[str, np.ndarray]


def _hashed(column: pa.Array) -> Iterator[tuple[textscan.Texts, textscan.Runs, np.ndarray]]:
    for t in textscan.chunks(column):
        folded = textscan.FOLD[t.data]
        w = textscan.words(textscan.Texts(folded, t.offsets, t.first), textscan.ALNUM)
        yield t, w, textscan.word_hash(folded, w.starts, w.ends) if len(w) else np.zeros(0, np.uint64)


class Vocabulary:
    """Places of words, frequent ones by rank and the others by hash behind them, and what each has of its place.

    word and n are the listed words' hashes and counts; rest has, for each shared
    place, the sum of the counts of the other words in it.
    """

    def __init__(self, word: np.ndarray, n: np.ndarray, rest: np.ndarray, top: int = FREQUENT):
        order = np.argsort(word)
        self.keys = word[order]
        rank = np.empty(len(word), np.int64)
        rank[np.lexsort((word.view(np.int64), -n))] = np.arange(len(word))
        # Ranks are dealt over the classes, so that every class has frequent words.
        self.place = np.where(rank < top, rank, self._shared(word))[order]
        others = rank >= top
        total = rest + np.bincount(self._shared(word[others]) - FREQUENT, weights=n[others], minlength=VOCABULARY - FREQUENT)
        own = np.zeros(len(word))
        own[others] = np.log(n[others] / total[self._shared(word[others]) - FREQUENT])
        self.share = own[order]
        #: Of a word that is not listed: its share, but for the logarithm of its count.
        self.rest = -np.log(np.maximum(total, 1))
        #: Words of the corpus in each place.
        self.counts = np.concatenate([np.zeros(FREQUENT), total])
        np.add.at(self.counts, rank[~others], n[~others])
        self.complete = not rest.any()

    @staticmethod
    def _shared(h: np.ndarray) -> np.ndarray:
        return (FREQUENT + h % np.uint64(VOCABULARY - FREQUENT)).astype(np.int64)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each word, its log probability within it, and whether it is listed; if not, the logarithm of its count is still to be added."""
        place = self._shared(h)
        share, listed = self.rest[place - FREQUENT], np.zeros(len(h), bool)
        if len(self.keys) and len(h):
            # Equal words are looked up once, in ascending order.
            word, back = np.unique(h, return_inverse=True)
            at, known = self._find(word)
            shared = self._shared(word)
            place, share, listed = (x[back] for x in (np.where(known, self.place[at], shared), np.where(known, self.share[at], self.rest[shared - FREQUENT]), known))
        return place, share, listed


def vocabulary_of(texts: DataFrame, top: int = FREQUENT, listed: int = LISTED) -> tuple[Vocabulary, DataFrame]:
    """Counted over all texts, with the counts of all words (word, n); the least count of a listed word is the least at which there are at most `listed`."""

    def counted(seen: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(seen), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(textscan.signed(word)), pa.array(n)], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        size = 0
        for batch in textscan.bounded(batches):
            for _, _, h in _hashed(batch.column("text")):
                seen.append(h)
                size += len(h)
            if size >= 1 << 20:
                yield counted(seen)
                seen, size = [], 0
        if size:
            yield counted(seen)

    words = checkpointed(texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # Different counts are few: at most the root of twice the corpus's words.
    sizes = sorted(((r.n, r.words) for r in words.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    least, so_far = sizes[0][0] + 1 if sizes else 1, 0
    for n, size in sizes:
        so_far += size
        if so_far > listed:
            break
        least = n
    found = words.where(F.col("n") >= least).toArrow()
    shared = VOCABULARY - FREQUENT
    # A power of two, so that signed and unsigned hashes have the same remainder.
    others = words.where(F.col("n") < least).groupBy(F.pmod("word", F.lit(shared)).alias("place")).agg(F.sum("n").alias("n"))
    rest = np.zeros(shared)
    for r in others.collect():
        rest[r.place] = r.n
    return Vocabulary(found["word"].to_numpy().view(np.uint64), found["n"].to_numpy(), rest, top), words


def targets(place: np.ndarray, offsets: np.ndarray, number: int, rounds: int, masked: int) -> np.ndarray:
    """The words that are targets in a round: of `masked` slices every rounds-th, so that all are in one round.

    offsets: where the texts begin in place.
    """
    if not len(place):
        return np.zeros(0, np.int64)
    # By the words' places and where they stand in their text, so that no order of rows matters.
    at = np.arange(len(place)) - np.repeat(offsets[:-1], np.diff(offsets))
    own = textscan.mix(place.astype(np.uint64) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(masked)
    turns = min(rounds, masked)
    return np.flatnonzero(own % np.uint64(turns) == np.uint64(number % turns))


def start(vocabulary: Vocabulary, seed: int = 7) -> Weights:
    """Random weights, and biases that say what each place's share of the corpus says."""
    rng = np.random.default_rng(seed)
    w = {k: (rng.standard_normal(s) * (0.1 if k == "e" else s[0] ** -0.5 if len(s) < 3 else s[1] ** -0.5)).astype(np.float32) for k, s in _SHAPES.items()}
    # Word r of class c is place r * CLASSES + c.
    n = vocabulary.counts.reshape(CLASSES, CLASSES).T + 0.5
    cls = n.sum(axis=1)
    w["b"][:] = 0
    w["c"][-1] = np.log(cls / cls.sum())
    w["v"][:, -1] = np.log(n / cls[:, None])
    return w


def _around(place: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The WIDTH places before and after each word of the same text."""
    n = len(place)
    out = np.full((n, 2 * WIDTH), _PAD, np.int16)
    inside = offsets[(offsets > 0) & (offsets < n)]
    for j, d in enumerate([*range(-WIDTH, 0), *range(1, WIDTH + 1)]):
        a, b = max(0, -d), min(n, n - d)
        if a < b:
            out[a:b, j] = place[a + d : b + d]
        # What a text's first or last words would see of its neighbour.
        for k in range(abs(d)):
            at = inside + k if d < 0 else inside - 1 - k
            out[at[(at >= 0) & (at < n)], j] = _PAD
    return out


class _Room:
    """What a task's steps write into again and again: arrays made anew for each would cost a page fault for every 4 KB of them."""

    def __init__(self, rows: int):
        self.rows = rows
        self.x, self.dx = (np.empty((rows, 2 * WIDTH * EMBEDDING), np.float32) for _ in range(2))
        self.own, self.dh = (np.empty((rows, HIDDEN), np.float32) for _ in range(2))
        self.h = np.ones((rows, HIDDEN + 1), np.float32)
        self.logits, self.p = (np.empty((rows, CLASSES), np.float32) for _ in range(2))
        self.spots = np.empty((rows * 2 * WIDTH, EMBEDDING // 2), _SPOTS.dtype)
        self.g = {k: np.empty(s, np.float32) for k, s in _SHAPES.items()}
        self.rate = np.empty(STRIP, np.float32)


def _hidden(w: Weights, around: np.ndarray, room: _Room) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands around each word, the hidden layer, and the same with a 1 behind it; all in the room."""
    n = len(around)
    x, own, h = room.x[:n], room.own[:n], room.h[:n]
    # Places are within the table; only so take() writes where it is told to.
    np.take(w["e"], around, axis=0, out=x.reshape(n, 2 * WIDTH, EMBEDDING), mode="clip")
    np.matmul(x, w["w"], out=own)
    own += w["b"]
    np.tanh(own, out=own)
    h[:, :-1] = own
    return x, own, h


def _by_class(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """An order of the places by class, their classes and words in it, and where each class begins."""
    cls = (place % CLASSES).astype(np.uint8)
    order = np.argsort(cls, kind="stable")
    cls = cls[order]
    return order, cls, (place // CLASSES)[order], np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()


def _word_logits(w: Weights, h: np.ndarray, cuts: list[int], out: np.ndarray, first: int = 0) -> np.ndarray:
    """Of the words of each row's class; rows stand by class, those of class first and on between the cuts."""
    for v, lo, hi in zip(w["v"][first:], cuts[:-1], cuts[1:], strict=False):
        if hi > lo:
            np.matmul(h[lo:hi], v, out=out[lo:hi])
    return out


def log_probability(w: Weights, around: np.ndarray, place: np.ndarray, room: _Room | None = None) -> np.ndarray:
    out = np.empty(len(place))
    room = room or _Room(min(len(place), BATCH))
    # As the hidden layer is within -1 and 1, no logit is larger than its weights together.
    safe = max(np.abs(w["c"]).sum(axis=0).max(), np.abs(w["v"]).sum(axis=1).max()) < _SAFE
    for lo in range(0, len(place), max(room.rows, 1)):
        order, cls, word, cuts = _by_class(place[lo : lo + room.rows])
        n = np.arange(len(order))
        *_, h = _hidden(w, around[lo : lo + room.rows][order], room)
        p = np.zeros(len(order))
        for fill, own in ((lambda x: np.matmul(h, w["c"], out=x), cls), (lambda x: _word_logits(w, h, cuts, x), word)):
            x = fill(room.logits[: len(order)])
            if not safe:
                x -= x.max(axis=1, keepdims=True)
            p += x[n, own]
            p -= np.log(np.exp(x, out=x) @ _ONES)
        out[lo : lo + room.rows][order] = p
    return out


def _error(x: np.ndarray, own: np.ndarray, p: np.ndarray | None = None) -> np.ndarray:
    """Of logits: the probabilities less 1 at the right place; in p, if that is given."""
    with np.errstate(over="ignore"):
        p = np.exp(x, out=p)
        total = p @ _ONES
    if not total.max(initial=0) < _SAFE_SUM:
        # Only then some logit may be larger than what is summed safely.
        np.exp(np.minimum(x, _SAFE, out=x), out=p)
        total = p @ _ONES
    p *= (1 / total)[:, None]
    p[np.arange(len(p)), own] -= 1
    return p


def train_batch(w: Weights, sums: Weights, around: np.ndarray, place: np.ndarray, room: _Room | None = None) -> None:
    """One step of stochastic gradient descent with adaptive rates, in place; room: for as many rows, of the steps before."""
    room = room or _Room(len(place))
    order, cls, word, cuts = _by_class(place)
    around, g = around[order], room.g
    for own in g.values():
        own.fill(0)
    # Rows of some classes at a time, which with what they give rise to stay in a core's cache.
    for first in range(0, CLASSES, TOGETHER):
        lo, hi = cuts[first], cuts[first + TOGETHER]
        if hi == lo:
            continue
        rows, n, own_cuts = slice(lo, hi), hi - lo, [x - lo for x in cuts[first : first + TOGETHER + 1]]
        x, own, h = _hidden(w, around[rows], room)
        d = _error(np.matmul(h, w["c"], out=room.logits[:n]), cls[rows], room.p[:n])
        g["c"] += h.T @ d
        through = d @ w["c"][:-1].T
        dh = room.dh[:n]
        d = _error(_word_logits(w, h, own_cuts, room.logits[:n], first), word[rows], room.p[:n])
        for v, gv, a, b in zip(w["v"][first:], g["v"][first:], own_cuts[:-1], own_cuts[1:], strict=False):
            if b > a:
                np.matmul(h[a:b].T, d[a:b], out=gv)
                np.matmul(d[a:b], v[:-1].T, out=dh[a:b])
        dh += through
        own *= own
        dh *= np.subtract(1, own, out=own)
        g["w"] += x.T @ dh
        g["b"] += dh.sum(axis=0)
        # Embeddings are summed in one pass; those of words that stand around none get 0, which moves nothing.
        spots = np.take(_SPOTS, around[rows].ravel(), axis=0, out=room.spots[: n * 2 * WIDTH], mode="clip")
        np.add.at(g["e"].reshape(-1).view(np.complex64), spots.reshape(-1), np.matmul(dh, w["w"].T, out=room.dx[:n]).reshape(-1).view(np.complex64))
    for name in g:
        _moved(w[name].reshape(-1), sums[name].reshape(-1), g[name].reshape(-1), len(place), room.rate)


def _moved(w: np.ndarray, sums: np.ndarray, g: np.ndarray, n: int, rates: np.ndarray) -> None:
    """Weights against the gradient of n rows, each at its own rate; as many at a time as rates holds."""
    for lo in range(0, len(w), len(rates)):
        own, total = g[lo : lo + len(rates)], sums[lo : lo + len(rates)]
        own /= n
        rate = np.multiply(own, own, out=rates[: len(own)])
        total += rate
        np.sqrt(total, out=rate)
        rate += 1e-6
        own /= rate
        own *= RATE
        w[lo : lo + len(rates)] -= own


def _written(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The places of a batch's texts, and where each text begins."""
    t = textscan.whole(batch.column("__places"))
    return t.data.view(np.int16), t.offsets // 2


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """docs with __places (two bytes a word), __share (the sum of what is known of the words' log probabilities within their places) and __rare (words that are not listed)."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            said: list[bytes] = []
            share = np.zeros(batch.num_rows)
            rare, n_rare = [np.zeros(0, np.uint64)], np.zeros(batch.num_rows, np.int64)
            for t, w, h in _hashed(batch.column("text")):
                place, own, listed = shared.value.look_up(h)
                place = place.astype("<i2")
                said += [place[a:b].tobytes() for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)]
                rows = slice(t.first, t.first + len(t))
                share[rows] = np.bincount(w.doc, weights=own, minlength=len(t))
                rare.append(h[~listed])
                n_rare[rows] = np.bincount(w.doc[~listed], minlength=len(t))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32), pa.array(textscan.signed(np.concatenate(rare))))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(said, pa.binary()), pa.array(share), lists], names=[*names, "__places", "__share", "__rare"])

    schema = docs.select("*", F.lit(b"").alias("__places"), F.lit(0.0).alias("__share"), F.array().cast("array<long>").alias("__rare")).schema
    return docs.mapInArrow(encode, schema)


def train(places: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, masked: int = MASKED) -> Weights:
    """places: rows with __places, read once a round."""
    sc = places.sparkSession.sparkContext
    weights = start(vocabulary)
    places = places.select("__places")
    n_tasks = places.rdd.getNumPartitions()
    for number in range(rounds):
        shared = sc.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            w = {k: v.copy() for k, v in shared.value.items()}
            sums = {k: np.full(s, 1e-3, np.float32) for k, s in _SHAPES.items()}
            n = 0
            wait, room = (np.zeros((0, 2 * WIDTH), np.int16), np.zeros(0, np.int16)), _Room(BATCH)
            for batch in textscan.bounded(batches, "__places"):
                place, offsets = _written(batch)
                at = targets(place, offsets, number, rounds, masked)
                around, own = np.concatenate([wait[0], _around(place, offsets)[at]]), np.concatenate([wait[1], place[at]])
                lo = 0
                while len(own) - lo >= (size := min(BATCH, max(LEAST_BATCH, n // 8))):
                    train_batch(w, sums, around[lo : lo + size], own[lo : lo + size], room)
                    lo += size
                    n += size
                wait = around[lo:], own[lo:]
            if len(wait[1]):
                train_batch(w, sums, *wait, room)
                n += len(wait[1])
            if n:
                task = TaskContext.get().partitionId()
                for name, x in w.items():
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([task], pa.int32()), pa.array([n], pa.int64()), pa.array([x.astype(np.float64).tobytes()], pa.binary())], names=["name", "task", "n", "x"])

        parts = places.mapInArrow(learn, "name string, task int, n long, x binary")
        # FAN_IN tasks together, then these averages, and so on: no task and not the driver reads every task's weights.
        groups = n_tasks
        while groups > 1:
            groups = -(-groups // FAN_IN)
            parts = parts.withColumn("task", F.expr(f"task div {FAN_IN}").cast("int")).repartition(min(groups * len(_SHAPES), shuffle_partitions(places.sparkSession)), "name", "task").mapInArrow(_average, "name string, task int, n long, x binary")
        got = {r.name: np.frombuffer(r.x, np.float64) for r in parts.collect()}
        shared.destroy()
        if not got:
            break
        weights = {k: got[k].reshape(s).astype(np.float32) for k, s in _SHAPES.items()}
    return weights


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, task, n, x) with the same name and task as one, weighted by n."""
    total: dict[tuple[str, int], np.ndarray] = {}
    weight: dict[tuple[str, int], int] = {}
    for batch in batches:
        for name, task, n, x in zip(*(batch.column(c).to_pylist() for c in ("name", "task", "n", "x")), strict=True):
            own, key = np.frombuffer(x, np.float64) * n, (name, task)
            total[key] = total[key] + own if key in total else own
            weight[key] = weight.get(key, 0) + n
    for (name, task), x in total.items():
        n = weight[name, task]
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([task], pa.int32()), pa.array([n], pa.int64()), pa.array([(x / n).tobytes()], pa.binary())], names=["name", "task", "n", "x"])


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS, keep_text: bool = True) -> DataFrame:
    """docs (without its text, if that is not to be kept) with n_tokens, log_likelihood (summed) and mean_log_likelihood."""
    docs = without(docs, ["n_tokens", "log_likelihood", "mean_log_likelihood"]).withColumn("text", F.col("text").cast("string"))
    vocabulary, words = vocabulary_of(docs.select("text"))
    places = encoded(docs.withColumn("__row", F.monotonically_increasing_id()), vocabulary)
    places = checkpointed(places if keep_text else places.drop("text"))
    names = [c for c in places.columns if c not in ("__places", "__share", "__rare")]
    shared = docs.sparkSession.sparkContext.broadcast(train(places, vocabulary, rounds))
    schema = places.select(*names, F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("log_likelihood")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = _Room(BATCH)
        for batch in textscan.bounded(batches, "__places"):
            place, offsets = _written(batch)
            n = np.diff(offsets)
            total = np.bincount(np.repeat(np.arange(len(n)), n), weights=log_probability(shared.value, _around(place, offsets), place, room), minlength=len(n))
            total += batch.column("__share").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(n), pa.array(total)], names=[*names, "n_tokens", "log_likelihood"])

    scored = places.drop("__rare").mapInArrow(score, schema)
    if not vocabulary.complete:
        # No word of these is frequent, so neither side of the join has a hot key; equal words of a row are one.
        rare = places.select("__row", F.explode("__rare").alias("word")).groupBy("__row", "word").agg(F.count("*").alias("times"))
        rest = rare.join(words, "word").groupBy(F.col("__row").alias("__of")).agg(F.sum(F.col("times") * F.ln("n")).alias("__rest"))
        scored = scored.join(rest, F.col("__row") == F.col("__of"), "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("__rest", F.lit(0.0))).drop("__of", "__rest")
    scored = scored.drop("__row")
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def report(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pseudo_likelihood(slim, rounds, keep_text=False).select("doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")
