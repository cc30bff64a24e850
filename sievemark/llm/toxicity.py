"""Toxic passages by maximum-scoring segment search.

A token is a word or a word's first 4, 5 or 6 code points, so that inflected forms
share evidence. Its score is the log-odds of toxic against clean labelled documents,
with a Dirichlet prior from the counts of all documents; a word scores as its best
token, or a small negative constant if none has a significant lower bound. One scan per document finds all its
maximal scoring segments. Their scores follow an extreme-value law in clean text:
its two parameters, from the score distribution and the maxima of clean training
documents, turn a segment's score into an expected number of such segments, and
those that are not expected by chance are its toxic passages. A logistic model over
the passages' evidence gives the document's score; it is fitted on evidence from
tokens of the other half of the training documents. Near copies among these, which
share the least hash of their five-word shingles, count as one.

Labels are read only of rows whose crc32 of the id, modulo `folds`, is not
`held_out`, and of at most max_train rows, chosen by hash. Text is all that a score
sees. Defined results. Null or empty text has no passage and gets the base score.
Labels that are null are ignored; of several labels of an id the largest counts.
Without labels of both classes every score is 0. Rows with equal texts get equal
scores, whatever their ids. Of a word's tokens with equal scores any counts, as only
the score does; of segments, one that only ties with what came before it stands by
itself. Texts are scanned whole, whatever their length. An empty table gives an empty
one. Columns named score and passages are replaced; names that begin with __ are the
operator's own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import textscan
from sievemark.llm.stage import checkpointed, without

MAX_TRAIN = 200_000
#: Documents with a token, among the labelled ones, for it to be scored.
MIN_DOCS = 3
#: The prior's weight, in documents of each class.
PRIOR = 30.0
FLOOR = 0.05
#: Least lower bound of a token's log-odds: words that are only somewhat more common in toxic text are left out.
EFFECT = 1.5
PENALTY = -0.25
_BITMAP = 18
STEMS = (4, 5, 6)
#: Tokens that a task holds before it sums them up.
FLUSH = 1 << 20


class Tokens:
    """A run of texts with its words w, their hashes h, and the tokens of all words: hash and word number."""

    def __init__(self, t: textscan.Texts):
        folded = textscan.FOLD[t.data]
        self.t, self.w = t, textscan.words(textscan.Texts(folded, t.offsets, t.first), textscan.ALNUM)
        starts, ends = self.w.starts, self.w.ends
        self.h = textscan.span_hash(folded, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        lead = np.append(np.flatnonzero((folded & 0xC0) != 0x80), [len(folded)] * (max(STEMS) + 1))
        first = np.searchsorted(lead, starts)
        token, word = [self.h], [np.arange(len(starts))]
        for k in STEMS:
            stop = lead[first + k]
            own = np.flatnonzero(stop <= ends)
            if len(own):
                token.append(textscan.mix(textscan.span_hash(folded, starts[own], stop[own]) + np.uint64(k)))
                word.append(own)
        self.token, self.word = np.concatenate(token), np.concatenate(word)


def _read(column: pa.Array) -> Iterator[Tokens]:
    return map(Tokens, textscan.chunks(column))


class _Lookup:
    """Indices of hashes in a sorted array."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.quick = np.zeros(1 << _BITMAP, bool)
        self.quick[keys >> np.uint64(64 - _BITMAP)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.quick[h >> np.uint64(64 - _BITMAP)])
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[key] == h[at]
        return at[same], key[same]


def segments(at: list[int], score: list[float], penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score); places not in at score the penalty."""
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum with
    total, last = 0.0, -1
    for p, s in zip(at, score, strict=True):
        total += penalty * (p - last - 1)
        last = p
        first, end, low, high = p, p, total, total + s
        total = high
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, end, low, high))
    return [(a, b, high - low) for a, b, low, high in found]


class Model:
    def __init__(self, keys: np.ndarray, score: np.ndarray, rate: float, k: float, weights: tuple[float, ...]):
        self.lookup, self.score, self.rate, self.k, self.weights = _Lookup(keys) if len(keys) else None, score, rate, k, weights

    def hits(self, x: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Words with a scored token, and their scores."""
        if self.lookup is None or not len(x.token):
            return np.zeros(0, np.int64), np.zeros(0)
        at, key = self.lookup.find(x.token)
        order = np.lexsort((-self.score[key], x.word[at]))
        word, score = x.word[at][order], self.score[key][order]
        first = np.diff(word, prepend=-1) != 0
        return word[first], score[first]

    def scan(self, x: Tokens) -> dict[int, list[tuple[int, int, float]]]:
        """Segments of each text that has any, by word numbers within the text."""
        at, score = self.hits(x)
        doc = x.w.doc[at]
        place = at - x.w.bounds[doc]
        return {int(doc[lo]): segments(place[lo:hi].tolist(), score[lo:hi].tolist(), PENALTY) for lo, hi in textscan.groups(doc)}

    def expected(self, score: float, n: int) -> float:
        return self.k * max(n, 1) * math.exp(-self.rate * score)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> tuple[float, ...]:
        """Of the least expected segment, and of all that are significant; each also on a scale that tells strong ones apart."""
        e = [-math.log(max(self.expected(s, n), 1e-300)) for _, _, s in found]
        best, total = max([0.0, *e]), sum(x for x in e if x > -math.log(0.05))
        return math.log1p(best), min(best, 60.0) / 10, min(total, 60.0) / 10

    def probability(self, n: int, found: list[tuple[int, int, float]]) -> float:
        x = self.weights[0] + sum(a * b for a, b in zip(self.weights[1:], self.evidence(n, found), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _training(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, max_train: int) -> DataFrame:
    """(text, toxic, half) of the labelled rows to learn from."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    usable = usable.where(F.crc32(F.col("doc_id").cast("string")) % folds != held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    if n > max_train:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_train * 0.98 / n))
    # At most about max_train rows of 12 bytes: the bound of the broadcasts here.
    rows = docs.join(F.broadcast(usable), "doc_id")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            least = np.zeros(batch.num_rows, np.uint64)
            for x in _read(batch.column("text")):
                t, w, h = x.t, x.w, x.h
                s, at = textscan.shingles(h, w.doc, 5)
                cut = np.searchsorted(w.doc[at], np.arange(len(t) + 1))
                for d in range(len(t)):
                    if cut[d] == cut[d + 1]:
                        own = h[w.bounds[d] : w.bounds[d + 1]]
                        least[t.first + d] = textscan.sequence_hash(own) if len(own) else 0
                        continue
                    least[t.first + d] = s[cut[d] : cut[d + 1]].min()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(textscan.signed(least))], names=["doc_id", "least"])

    one = rows.select("doc_id", "text").mapInArrow(sign, "doc_id long, least long").groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    picked = checkpointed(one.join(F.broadcast(usable), "doc_id").select("doc_id", "toxic", (F.pmod(F.xxhash64("least"), F.lit(2))).cast("int").alias("half")))
    return docs.join(F.broadcast(picked), "doc_id").select("text", "toxic", "half")


def _counts(train: DataFrame) -> dict[str, np.ndarray]:
    """By token the toxic and the clean documents of each half that have it."""

    def summed(tokens: list[np.ndarray], kinds: list[np.ndarray]) -> pa.RecordBatch:
        key, at = np.unique(np.concatenate(tokens), return_inverse=True)
        n = np.bincount(at * 4 + np.concatenate(kinds), minlength=4 * len(key)).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(textscan.signed(key)), *(pa.array(np.ascontiguousarray(n[:, x])) for x in range(4))], names=["token", "good0", "good1", "bad0", "bad1"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: list[np.ndarray] = []
        kinds: list[np.ndarray] = []
        size = 0
        for batch in textscan.bounded(batches):
            kind = ((batch.column("toxic").to_numpy() > 0) * 2 + batch.column("half").to_numpy()).astype(np.uint8)
            for x in _read(batch.column("text")):
                doc = x.w.doc[x.word]
                # Each token once a document: by a hash of both.
                first = np.unique(textscan.mix(x.token ^ textscan.mix(doc.astype(np.uint64))), return_index=True)[1]
                tokens.append(x.token[first])
                kinds.append(kind[x.t.first + doc[first]])
                size += len(first)
            if size >= FLUSH:
                yield summed(tokens, kinds)
                tokens, kinds, size = [], [], 0
        if size:
            yield summed(tokens, kinds)

    rows = train.mapInArrow(count, "token long, good0 long, good1 long, bad0 long, bad1 long")
    sums = rows.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("good0", "good1", "bad0", "bad1")))
    table = sums.where(F.expr(f"good0 + good1 + bad0 + bad1 >= {MIN_DOCS} and bad0 + bad1 > 0")).toArrow()
    keys = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return {"keys": keys[order]} | {c: table[c].to_numpy()[order].astype(float) for c in ("good0", "good1", "bad0", "bad1")}


def _corpus(texts: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, float]:
    """Occurrences of each key in all documents, and the number of documents."""
    shared = texts.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        n, total = np.zeros(len(lookup.keys), np.int64), 0
        for batch in textscan.bounded(batches):
            total += batch.num_rows
            for x in _read(batch.column("text")):
                n += np.bincount(lookup.find(x.token)[1], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), -1], pa.int64()), pa.array([*n[some].tolist(), total], pa.int64())], names=["key", "n"])

    got = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    shared.destroy()
    n, total = np.zeros(len(keys)), 0.0
    for key, x in zip(got["key"], got["n"], strict=True):
        if key < 0:
            total = float(x)
        else:
            n[key] = x
    return n, total


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, max_train: int = MAX_TRAIN) -> Model:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = _training(docs, labels, folds, held_out, max_train)
    classes = {(r.bad, r.half): r.n for r in train.groupBy((F.col("toxic") > 0).alias("bad"), "half").agg(F.count("*").alias("n")).collect()}
    size = {(c, h): float(classes.get((c == "bad", h), 0)) for c in ("bad", "good") for h in (0, 1)}
    n_bad, n_good = (size[c, 0] + size[c, 1] for c in ("bad", "good"))
    if not n_bad or not n_good:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, (-30.0, 0.0, 0.0, 0.0))
    counts = _counts(train)
    keys = counts["keys"]
    base = math.log(n_bad / n_good)
    if not len(keys):
        return Model(keys, np.zeros(0), 1.0, 1.0, (base, 0.0, 0.0, 0.0))
    often, total = _corpus(docs.select("text"), keys)
    alpha = FLOOR + PRIOR * np.minimum(often / max(total, 1.0), 0.9)

    def scores(halves: tuple[int, ...], chance: float) -> tuple[np.ndarray, np.ndarray]:
        bad, good = (sum(counts[f"{c}{h}"] for h in halves) for c in ("bad", "good"))
        of_bad, of_good = (sum(size[c, h] for h in halves) for c in ("bad", "good"))
        odds = np.log((bad + alpha) / (of_bad + PRIOR - bad)) - np.log((good + alpha) / (of_good + PRIOR - good))
        sigma = np.sqrt(1 / (bad + alpha) + 1 / (good + alpha))
        take = odds / sigma >= NormalDist().inv_cdf(1 - min(0.2, chance / len(keys)))
        take &= odds - sigma >= EFFECT
        return keys[take], (odds - sigma)[take]

    raw = [Model(*scores(halves, chance), 1.0, 1.0, (base, 0.0, 0.0, 0.0)) for halves, chance in (((0, 1), 3.0), ((0,), 10.0), ((1,), 10.0))]
    return _calibrated(train, raw, base)


def _calibrated(train: DataFrame, raw: list[Model], base: float) -> Model:
    """raw: the model of all training documents and those of either half."""
    if not len(raw[0].score):
        return raw[0]
    shared = train.sparkSession.sparkContext.broadcast(raw)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in textscan.bounded(batches):
            half, n = batch.column("half").to_pylist(), [0] * batch.num_rows
            best, across, sums = ([[] for _ in range(batch.num_rows)] for _ in range(3))
            for x in _read(batch.column("text")):
                t, w = x.t, x.w
                n[t.first : t.first + len(t)] = np.diff(w.bounds).tolist()
                at, score = models[0].hits(x)
                for d, s in zip(w.doc[at].tolist(), score.tolist(), strict=True):
                    sums[t.first + d].append(s)
                for which, model in enumerate(models):
                    for d, own in model.scan(x).items():
                        if which == 0:
                            best[t.first + d] = [s for _, _, s in own]
                        elif half[t.first + d] != which - 1:
                            across[t.first + d] = [s for _, _, s in own]
            lists = (pa.array(x, pa.list_(pa.float64())) for x in (best, across, sums))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(n, pa.int64()), *lists], names=["toxic", "n", "best", "across", "scores"])

    # One small row for each labelled document: bounded by max_train. Kept in arrays, lists as values and their rows.
    table = train.mapInArrow(scan, "toxic int, n long, best array<double>, across array<double>, scores array<double>").toArrow().combine_chunks()
    shared.destroy()

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = table[name].chunk(0) if table[name].num_chunks else pa.array([], pa.list_(pa.float64()))
        return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))

    toxic, n = table["toxic"].to_numpy() > 0, table["n"].to_numpy()
    words = float(n[~toxic].sum()) or 1.0
    hits, row = flat("scores")
    hits = hits[~toxic[row]]
    top = float(raw[0].score.max())
    # Rate of the extreme-value law: where the mean of exp(rate * score) over clean words is 1.
    lo, hi = 1e-3, 50.0
    for _ in range(80):
        mid = (lo + hi) / 2
        mean = ((words - len(hits)) * math.exp(mid * PENALTY) + (np.exp(np.minimum(mid * hits, 500)).sum() if len(hits) else math.exp(min(mid * top, 500)))) / words
        lo, hi = (lo, mid) if mean > 1 else (mid, hi)
    rate = lo
    best = np.zeros(len(n))
    scores, row = flat("best")
    np.maximum.at(best, row, scores)
    k = float((~toxic).sum()) / max(float((n * np.exp(-rate * best))[~toxic].sum()), 1.0)
    model = Model(raw[0].lookup.keys, raw[0].score, rate, k, (base, 0.0, 0.0, 0.0))
    # What Model.evidence says of each row, for all at once.
    scores, row = flat("across")
    e = np.minimum(rate * scores - np.log(k * np.maximum(n[row], 1)), -math.log(1e-300))
    best, total = np.zeros(len(n)), np.zeros(len(n))
    np.maximum.at(best, row, e)
    np.add.at(total, row, np.where(e > -math.log(0.05), e, 0.0))
    x = np.stack([np.ones(len(n)), np.log1p(best), np.minimum(best, 60.0) / 10, np.minimum(total, 60.0) / 10], axis=1)
    y = toxic.astype(float)
    # Newton steps on the features that raise the score; one that would lower it is left out.
    use = [0, 1, 2, 3]
    while True:
        z, weights = x[:, use], np.array([base] + [0.0] * (len(use) - 1))
        ridge = np.diag([1e-6] + [0.1] * (len(use) - 1))
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ weights)
            weights += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if len(use) == 1 or weights[1:].min() >= 0:
            break
        del use[1 + int(weights[1:].argmin())]
    final = np.zeros(4)
    final[use] = weights
    weights = final
    return Model(model.lookup.keys, model.score, rate, k, tuple(weights.tolist()))


def passages(docs: DataFrame, model: Model, significant: float = 0.05) -> DataFrame:
    """docs with score, and passages: byte spans of the significant segments with score and expected number."""
    docs = without(docs, ["score", "passages"])
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    schema = docs.withColumn("score", F.lit(0.0)).withColumn("passages", F.array().cast(kind)).schema
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        base = model.probability(0, [])
        for batch in textscan.bounded(batches):
            score, found = np.full(batch.num_rows, base), [[] for _ in range(batch.num_rows)]
            for x in _read(batch.column("text").cast(pa.string())):
                t, w = x.t, x.w
                for d, own in model.scan(x).items():
                    n = int(w.bounds[d + 1] - w.bounds[d])
                    score[t.first + d] = model.probability(n, own)
                    for a, b, s in own:
                        if (e := model.expected(s, n)) <= significant:
                            found[t.first + d].append({"start": int(w.starts[w.bounds[d] + a] - t.offsets[d]), "end": int(w.ends[w.bounds[d] + b] - t.offsets[d]), "score": s, "expected": e})
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(score), pa.array(found, arrow)], names=[*names, "score", "passages"])

    return docs.mapInArrow(scan, schema)


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held_out: int = 1, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted, and the number of toxic passages."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = passages(slim, fit(slim, labels, folds, held_out, max_train))
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % folds == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
