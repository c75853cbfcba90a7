"""Toxic spans by a linear-chain conditional random field.

Labels stand on documents, so tokens are labelled first: a word of a toxic document is
toxic if it, or its beginning, stands (once, or twice and more) in toxic documents far
more often than in others. A chain of two states over those tokens is trained;
forward-backward marginals of every token of a text give the offsets of toxic words, and
their sum, beside the text's length, its score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, filter_slices, map_slices, staged

#: Places in which features are counted and weighed.
SPACE = 1 << 20
#: Labelled documents of the training sample at most; tokens of a segment; tasks of the training.
MOST_DOCS, SEGMENT, TASKS = 20_000, 48, 6
#: Marginals from which tokens add up in a text's score.
LIKELY = 0.2
#: What makes a feature suspect: toxic documents that hold it, its log-likelihood gain, and
#: how much oftener than elsewhere it stands in toxic documents. Chosen on fifths of the
#: training fold, each held back in turn.
LEAST, GAIN, LIFT = 4, 18, 25
#: Lengths of the beginnings and of the ends of words that are features.
STEMS, TAILS = (4, 5, 6, 7, 8), (3, 4)
N_FEATURES = 1 + len(STEMS) + len(TAILS)
#: Code points that are hashed at once, and the base of their polynomials.
PIECE, BASE, MIX = 1 << 19, 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


@cache
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, and its lower case of one code point."""
    letter, lower = np.zeros(0x110000, dtype=bool), np.arange(0x110000, dtype=np.uint32)
    for i in range(0x32000):  # beyond, there are no letters in planes that are in use
        c = chr(i)
        letter[i] = c.isalnum() and not c.isdecimal()
        if c.isupper() and len(low := c.lower()) == 1:
            lower[i] = ord(low)
    return letter, lower


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, for the places of a piece."""
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(PIECE, x, np.uint64)])) for x in (BASE, pow(BASE, -1, 1 << 64)))


def cut(text: str) -> Iterator[tuple[int, str]]:
    """(offset, piece) of a text, in pieces of less than PIECE code points that end between
    words; a word that is longer still is cut."""
    letter, at = alphabet()[0], 0
    while len(text) - at >= PIECE:
        past = at + PIECE - 1
        past = next((k for k in range(past, at, -1) if not letter[ord(text[k])]), past)
        yield at, text[at:past]
        at = past
    yield at, text[at:] if at else text


def features(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed features of words, a row each: the word itself, its beginnings that are not all
    of it, and its ends. A place that a short word lacks holds the word's own feature again."""
    place, inverse = powers()
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * place[: len(points)], dtype=np.uint64)])

        def hashed(a: np.ndarray, b: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
            h = (total[b] - total[a]) * inverse[a] + np.asarray(tag, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
            return (((h ^ (h >> np.uint64(29))) * MIX) >> np.uint64(44)).astype(np.int32)

        size, out = ends - starts, np.empty((len(starts), N_FEATURES), dtype=np.int32)
        out[:, 0] = hashed(starts, ends, 0)
        for j, k in enumerate(STEMS, 1):
            out[:, j] = hashed(starts, np.minimum(starts + k, ends), np.where(size > k, k, 0))
        for j, k in enumerate(TAILS, 1 + len(STEMS)):
            out[:, j] = hashed(np.maximum(ends - k, starts), ends, np.where(size > k, 100 + k, 0))
    return out


def words(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of its text, features, span in code points of its text) of the words of all
    texts, in order; some PIECE code points of text at once."""
    letter, lower = alphabet()
    held: list[tuple[int, int, str]] = []
    size = 0

    def found():
        line = "\n".join(t for *_, t in held) + "\n"
        points = lower[np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        edge = np.diff(letter[points].astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begun = np.cumsum([0, *(len(t) + 1 for *_, t in held)])[:-1]
        own = np.searchsorted(begun, starts, side="right") - 1
        moved = np.array([at for _, at, _ in held])[own] - begun[own]
        return np.array([i for i, *_ in held])[own], features(points, starts, ends), np.stack([starts + moved, ends + moved], axis=1)

    for i, text in enumerate(texts):
        for at, piece in cut(text or ""):
            if held and size + len(piece) >= PIECE:
                yield found()
                held.clear()
                size = 0
            held.append((i, at, piece))
            size += len(piece) + 1
    if held:
        yield found()


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at every token of many texts laid end to end.

    e: score of the toxic state against the other; first: where a text begins. The
    chain is a product of 2 x 2 matrices, so blocks of tokens are multiplied side by
    side, then joined in order, then filled in.
    """
    n = len(e)
    if not n:
        return np.zeros(0)
    steps = int(min(256, max(1, np.sqrt(n))))
    blocks = -(-n // steps)
    pad = blocks * steps - n
    hot = 1 / (1 + np.exp(-np.clip(np.concatenate([e, np.zeros(pad)]), -40, 40))).reshape(blocks, steps).T
    opens = np.concatenate([first, np.ones(pad, dtype=bool)]).reshape(blocks, steps).T
    a = np.exp(trans - trans.max())
    s = np.exp(start - start.max())
    m = [[np.where(opens, s[j], a[i, j]) * (hot if j else 1 - hot) for j in (0, 1)] for i in (0, 1)]
    one, none = np.ones(blocks), np.zeros(blocks)
    p00, p01, p10, p11 = one, none, none, one
    for t in range(steps):
        m00, m01, m10, m11 = m[0][0][t], m[0][1][t], m[1][0][t], m[1][1][t]
        p00, p01, p10, p11 = p00 * m00 + p01 * m10, p00 * m01 + p01 * m11, p10 * m00 + p11 * m10, p10 * m01 + p11 * m11
        if t % 8 == 7:
            z = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * z, p01 * z, p10 * z, p11 * z
    prod = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist(), strict=True))
    ahead, x, y = [], 0.5, 0.5
    for q00, q01, q10, q11 in prod:
        ahead.append((x, y))
        x, y = x * q00 + y * q10, x * q01 + y * q11
        x, y = x / (x + y), y / (x + y)
    back, x, y = [], 0.5, 0.5
    for q00, q01, q10, q11 in reversed(prod):
        back.append((x, y))
        x, y = q00 * x + q01 * y, q10 * x + q11 * y
        x, y = x / (x + y), y / (x + y)
    f, g = np.array(ahead).T, np.array(back[::-1]).T
    fore = np.empty((2, steps, blocks))
    x, y = f
    for t in range(steps):
        x, y = x * m[0][0][t] + y * m[1][0][t], x * m[0][1][t] + y * m[1][1][t]
        z = 1 / (x + y)
        fore[0, t] = x = x * z
        fore[1, t] = y = y * z
    out = np.empty((steps, blocks))
    x, y = g
    for t in range(steps - 1, -1, -1):
        c, h = fore[0, t] * x, fore[1, t] * y
        out[t] = h / (c + h)
        x, y = m[0][0][t] * x + m[0][1][t] * y, m[1][0][t] * x + m[1][1][t] * y
        z = 1 / (x + y)
        x, y = x * z, y * z
    return out.T.ravel()[:n]


@dataclass
class Model:
    """Weights of features, of the chain, and of the calibration of a text's score."""

    places: np.ndarray  # features with a weight, ascending
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    start: np.ndarray
    fit: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)
    dense: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"dense": None}

    def emissions(self, found: np.ndarray) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros(SPACE)
            self.dense[self.places] = self.weights
        return self.bias + self.dense[found].sum(axis=1)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, marginal and span of each word)."""
        n, e, at = np.zeros(len(texts), dtype=np.int64), [], []
        for owner, found, span in words(texts):
            n += np.bincount(owner, minlength=len(texts))
            e.append(self.emissions(found))
            at.append(span)
        e, ends = np.concatenate([np.zeros(0), *e]), np.cumsum(n)
        first = np.zeros(len(e), dtype=bool)
        first[(ends - n)[n > 0]] = True
        return n, marginals(e, first, self.trans, self.start), np.concatenate([np.zeros((0, 2), np.int64), *at])

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Score of every text, and the marginals and spans of its words."""
        n, p, at = self.read(texts)
        ends = np.cumsum(n)
        x = inputs(n, p) @ np.array(self.fit)
        return 1 / (1 + np.exp(-np.clip(x, -40, 40))), [(p[b - k : b], at[b - k : b]) for b, k in zip(ends, n, strict=True)]


def inputs(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """What a text's score is made of: log odds that any of its likely words, or else its
    likeliest one, is toxic; the log of how many are expected to be; the log of its length;
    one. Many small chances don't add up in long texts."""
    ends, some = np.cumsum(n), np.flatnonzero(n)
    sums = lambda x: np.concatenate([[0.0], np.cumsum(x)])[[ends, ends - n]]
    calm = np.log1p(-np.minimum(p, 1 - 1e-12))
    rest, many = (np.subtract(*sums(np.where(p >= LIKELY, x, 0.0))) for x in (calm, p))
    if len(some):
        rest[some] = np.minimum(rest[some], np.minimum.reduceat(calm, (ends - n)[some]))
    return np.column_stack([odds(rest), np.log(np.maximum(many, 0) + 0.05), np.log(n + 20.0), np.ones(len(n))])


def odds(rest: np.ndarray) -> np.ndarray:
    """Log odds of one minus exp(rest), between -12 and 12."""
    q = np.clip(-np.expm1(rest), 6e-6, 1 - 6e-6)
    return np.log(q / (1 - q))


def training_fold(key: str = "doc_id", folds: int = 4, held: int = 2) -> F.Column:
    """True where a row may be learnt from."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) != held


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: F.Column, most: int = MOST_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, y) of at most `most` labelled documents of the training fold, chosen by
    a hash of their ids; staged. Repeated labels of an id count as their maximum, and
    copies of a text once."""
    chosen = (
        labels.where(fold & F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key).agg(F.max(label).alias("y"))
        .orderBy(F.xxhash64(key), key).limit(most)
    )
    # At most `most` pairs of numbers: small enough to send to every task.
    found = docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key).select("text", F.col("y").cast("int").alias("y"))
    return staged(found.withColumn("_same", F.xxhash64("text")).dropDuplicates(["_same", "y"]).drop("_same").repartition(TASKS), "labelled")


def without_near_copies(sample: DataFrame) -> DataFrame:
    """The sample without near copies of the same label: what is rare in a text is telling only
    where it stands in texts of their own. A text goes if one of a smaller digest shares a
    band of minima with it; the sample's bands are few. Staged."""
    from tidemark.llm.simhash import band_values, shingles

    def make():
        return lambda batch: {"text": batch.column(0), "y": batch.column(1), "id": batch.column(2), "bands": [band_values(shingles(t, 3)) for t in batch.column(0).to_pylist()]}

    banded = staged(map_slices(sample.select("text", "y", F.xxhash64("text").alias("id")), make, "text string, y int, id long, bands array<long>"), "banded")
    first = banded.select("y", "id", F.explode("bands").alias("band")).groupBy("y", "band").agg(F.min("id").alias("first"))
    copies = banded.select("y", "id", F.explode("bands").alias("band")).join(first, ["y", "band"]).where("first < id").select("y", "id").distinct()
    return staged(banded.join(copies, ["y", "id"], "left_anti").select("text", "y").repartition(TASKS), "sample")


def seen(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, features of its words and their beginnings, how often each stands)."""
    rest: tuple[int, list[np.ndarray]] | None = None
    done = lambda i, own: (i, *np.unique(np.concatenate(own), return_counts=True))
    for owner, found, _ in words(texts):
        heads = np.sort(found[:, : 1 + len(STEMS)], axis=1)
        heads[:, 1:][heads[:, 1:] == heads[:, :-1]] = -1  # a word counts once for a feature
        cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(owner)).tolist(), strict=True):
            own = heads[a:b]
            own = own[own >= 0]
            if rest and rest[0] == owner[a]:
                rest[1].append(own)
                continue
            if rest:
                yield done(*rest)
            rest = (int(owner[a]), [own])
    if rest:
        yield done(*rest)


def counts_of(texts: list[str | None], labels: list[int]) -> np.ndarray:
    """[label, once or twice and more, feature]: the texts that hold it so often."""
    counts = np.zeros((2, 2, SPACE), dtype=np.int32)
    for i, own, times in seen(texts):
        y = int(labels[i] > 0)
        counts[y, 0, own] += 1
        counts[y, 1, own[times > 1]] += 1
    return counts


def chosen(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Features that stand, once or twice and more, in toxic documents far more often than in others."""
    found, total = np.zeros(SPACE, dtype=bool), n.sum()
    if not n.all():
        return np.zeros(0, dtype=np.int64)
    for clean, toxic in zip(*counts.astype(np.int64), strict=True):
        expected = (clean + toxic) * n[1] / total
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 2 * (np.where(toxic > 0, toxic * np.log(toxic / np.maximum(expected, 1e-9)), 0) + np.where(clean > 0, clean * np.log(clean / np.maximum(clean + toxic - expected, 1e-9)), 0))
        lift = ((toxic + 0.5) / (n[1] + 1)) / ((clean + 0.5) / (n[0] + 1))
        found |= (toxic >= LEAST) & (gain >= GAIN) & (lift >= LIFT)
    return np.flatnonzero(found)


def segments_of(texts: list[str | None], labels: list[int], suspects: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """(features, marks, weights) of segments of words: all that hold a suspect word of a toxic
    text, and one other of each text, which weighs as much as all its others."""
    known = np.zeros(SPACE, dtype=bool)
    known[suspects] = True
    feats: list[list[np.ndarray]] = [[] for _ in texts]
    for owner, found, _ in words(texts):
        cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(owner)).tolist(), strict=True):
            feats[int(owner[a])].append(found[a:b])
    out, marks, weights = [], [], []
    for i, (own, y) in enumerate(zip(feats, labels, strict=True)):
        if not own:
            continue
        own = np.concatenate(own)
        hot = known[own[:, : 1 + len(STEMS)]].any(axis=1) & (y > 0)
        starts = range(0, len(own), SEGMENT)
        marked = [a for a in starts if hot[a : a + SEGMENT].any()]
        calm = [a for a in starts if not hot[a : a + SEGMENT].any()]
        pick = [(a, 1) for a in marked]
        if calm:
            pick.append((calm[zlib.crc32((texts[i] or "").encode("utf-8", "surrogatepass")) % len(calm)], len(calm)))
        for a, w in pick:
            out.append(own[a : a + SEGMENT])
            marks.append(hot[a : a + SEGMENT])
            weights.append(w)
    return out, marks, weights


def train_chain(found: list[np.ndarray], marks: list[np.ndarray], weights: list[int], rounds: int = 80, rate: float = 0.4, ridge: float = 1e-6) -> Model:
    """Maximise the chain's conditional likelihood by AdaGrad over whole passes. found:
    features of each segment's words, a row each; marks: which words are toxic."""
    if not found:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), -6.0, np.zeros((2, 2)), np.zeros(2))
    kinds, which = np.unique(np.concatenate(found), axis=0, return_inverse=True)
    places, f = np.unique(kinds, return_inverse=True)
    f, which = f.reshape(-1, N_FEATURES), which.ravel()
    size, width = len(found), max(map(len, found))
    ids, y, real = (np.zeros((size, width), dtype=k) for k in (np.int64, np.int64, bool))
    at = 0
    for i, (own, m) in enumerate(zip(found, marks, strict=True)):
        ids[i, : len(own)], y[i, : len(own)], real[i, : len(own)] = which[at : at + len(own)], m, True
        at += len(own)
    rows = np.arange(size)
    u = np.array(weights, dtype=float)[:, None] / sum(weights)
    last = real.sum(axis=1) - 1
    pair = real[:, 1:]
    seen = np.array([[np.sum(u * (pair & (y[:, :-1] == i) & (y[:, 1:] == j))) for j in (0, 1)] for i in (0, 1)], dtype=float)
    begun = np.array([np.sum(u[:, 0] * (y[:, 0] == j)) for j in (0, 1)], dtype=float)
    w, bias, trans, start = np.zeros(len(places)), -4.0, np.zeros((2, 2)), np.zeros(2)
    gw, gb, gt, gs = np.full(len(places), 1e-8), 1e-8, np.full((2, 2), 1e-8), np.full(2, 1e-8)
    for _ in range(rounds):
        e = (bias + w[f].sum(axis=1))[ids]
        emit = np.stack([np.zeros_like(e), e])
        fore = np.empty((2, size, width))
        fore[:, :, 0] = start[:, None] + emit[:, :, 0]
        for t in range(1, width):
            for j in (0, 1):
                fore[j, :, t] = np.logaddexp(fore[0, :, t - 1] + trans[0, j], fore[1, :, t - 1] + trans[1, j]) + emit[j, :, t]
        z = np.logaddexp(fore[0, rows, last], fore[1, rows, last])
        back = np.zeros((2, size, width))
        for t in range(width - 2, -1, -1):
            on = real[:, t + 1]
            for i in (0, 1):
                back[i, :, t] = np.where(on, np.logaddexp(trans[i, 0] + emit[0, :, t + 1] + back[0, :, t + 1], trans[i, 1] + emit[1, :, t + 1] + back[1, :, t + 1]), 0)
        p = np.where(real, np.exp(np.minimum(fore[1] + back[1] - z[:, None], 0)), 0)
        miss = np.where(real, p - y, 0) * u
        by_word = np.bincount(ids.ravel(), miss.ravel(), minlength=len(f))
        dw = np.bincount(f.ravel(), np.repeat(by_word, N_FEATURES), minlength=len(places)) + ridge * w
        dt = np.array([[np.sum(u * np.where(pair, np.exp(np.minimum(fore[i, :, :-1] + trans[i, j] + emit[j, :, 1:] + back[j, :, 1:] - z[:, None], 0)), 0)) for j in (0, 1)] for i in (0, 1)])
        dt = dt - seen
        db, ds = miss.sum(), np.array([np.sum(u[:, 0] * (1 - p[:, 0])), np.sum(u[:, 0] * p[:, 0])]) - begun
        gw, gb, gt, gs = gw + dw**2, gb + db**2, gt + dt**2, gs + ds**2
        w, bias = w - rate * dw / np.sqrt(gw), bias - rate * db / np.sqrt(gb)
        trans, start = trans - 0.2 * rate * dt / np.sqrt(gt), start - 0.2 * rate * ds / np.sqrt(gs)
    kept = np.abs(w) > 1e-3
    return Model(places[kept], w[kept], float(bias), trans, start)


def fit_score(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...] | None:
    """Logistic weights of inputs() by Newton steps; none where all labels are the same."""
    if len(np.unique(y)) < 2:
        return None
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        b = b - np.clip(np.linalg.solve(h, x.T @ (p - y) + ridge * b), -2, 2)
    return tuple(b.tolist())


def train(docs: DataFrame, labels: DataFrame, fold: F.Column | None = None, label: str = "toxic") -> Model:
    """Learn from at most MOST_DOCS labelled documents of the fold. Labels of ids that have no
    document, and null ones, count for nothing; of several labels of an id the largest
    one counts. Without any toxic ones, or without others, the model finds nothing toxic."""
    sample = without_near_copies(labelled_sample(docs, labels, label, training_fold() if fold is None else fold))
    columns = lambda batch: [batch.column(i).to_pylist() for i in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, 2, SPACE), dtype=np.int32), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                texts, y = columns(batch.slice(i, SLICE_ROWS))
                total += counts_of(texts, y)
                n += np.bincount(np.array(y) > 0, minlength=2)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)]), pa.array([n.tolist()], pa.list_(pa.int64()))], names=["c", "n"])

    total, n = np.zeros((2, 2, SPACE), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for row in sample.mapInArrow(count, "c binary, n array<long>").collect():  # TASKS rows of a fixed size
        total += np.frombuffer(zlib.decompress(row["c"]), dtype=np.int32).reshape(total.shape)
        n += np.array(row["n"])
    suspects = chosen(total, n)
    del total

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                found, marks, weights = segments_of(*columns(batch.slice(i, SLICE_ROWS)), suspects)
                if found:  # each kind of word once, and numbers of kinds
                    kinds, ids = np.unique(np.concatenate(found), axis=0, return_inverse=True)
                    values = [kinds, ids.astype(np.int32), np.array([len(x) for x in found], dtype=np.int32), np.packbits(np.concatenate(marks)), np.array(weights, dtype=np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in values], names=names)

    names = ["kinds", "ids", "sizes", "marks", "weights"]
    if len(suspects):
        # The sample's size bounds what comes here: a segment of each text, and those with a suspect word.
        rows = sample.mapInArrow(cut_up, ", ".join(f"{n} binary" for n in names)).collect()
        found, marks, weights = [], [], []
        for row in rows:
            own, ids, sizes = np.frombuffer(row["kinds"], np.int32).reshape(-1, N_FEATURES), np.frombuffer(row["ids"], np.int32), np.frombuffer(row["sizes"], np.int32)
            ends = np.cumsum(sizes)[:-1]
            found += np.split(own[ids], ends)
            marks += np.split(np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=len(ids)), ends)
            weights += np.frombuffer(row["weights"], np.int64).tolist()
        del rows
        model = train_chain(found, marks, weights)
    else:
        model = train_chain([], [], [])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                texts, y = columns(batch.slice(i, SLICE_ROWS))
                x = inputs(*model.read(texts)[:2])
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(y, pa.int32())], names=["x", "y"])

    rows = sample.mapInArrow(measure, "x array<double>, y int").toPandas()  # MOST_DOCS rows of four numbers at most
    if len(rows) and len(suspects):
        model.fit = fit_score(np.array(rows["x"].tolist()), (rows["y"].to_numpy() > 0).astype(float)) or model.fit
    return model


def spans(p: np.ndarray, at: np.ndarray, least: float = 0.5) -> list[dict]:
    """Offsets of toxic words, in code points of the text."""
    return [{"start": int(at[i, 0]), "end": int(at[i, 1]), "p": float(p[i])} for i in np.flatnonzero(p >= least)]


def score_toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, score, spans of its toxic words (code points of the text as it
    stands, and their marginals). Null and empty texts get the score of no words;
    repeated rows give repeated results; an empty table gives none; other columns are not
    read."""

    def make():
        def f(batch: pa.RecordBatch) -> dict[str, list]:
            score, found = model.score(batch.column(1).to_pylist())
            return {key: batch.column(0), "score": score, "spans": [spans(p, at) for p, at in found]}

        return f

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, score double, spans array<struct<start: long, end: long, p: double>>")


def keep_civil(docs: DataFrame, model: Model, most: float = 0.3, text: str = "text") -> DataFrame:
    """The rows whose score is below `most`, with every column; no shuffle. Null and empty
    texts have the score of no words; repeated rows stay or go together."""
    return filter_slices(docs, lambda: lambda texts: (model.score(texts)[0] < most).tolist(), text)
