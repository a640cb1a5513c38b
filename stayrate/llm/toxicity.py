"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.scratch import in_small_batches, written
from stayrate.llm.words import Words, blocks, grams, mix, powers

#: Lower-cases A-Z and makes every other ASCII character but digits and letters a space.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
PREFIXES = (4, 5, 6)
SCORED = "doc_id long, score double, predicted int, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Training:
    """How the field is fitted.

    most_toxic, most_clean: bounds on the labelled rows it is fitted on, drawn by a hash of their id; most_bytes: a
    bound on their texts in all, for each label. This is the only bounded sample here. The fit holds the texts and
    24 bytes for each word, under 0.5 GB in its one task. length: words in a sequence; longer texts are several. buckets: hashed
    features. odds: how many times likelier a word or prefix must be in toxic texts for it to be
    taken for a toxic token there, in natural log; evidence: how unlikely its counts must be if it had nothing
    to do with the label, in natural log too, so that rare words don't qualify by chance.
    """

    most_toxic: int = 1500
    most_clean: int = 4500
    most_bytes: int = 32_000_000
    length: int = 32
    buckets: int = 1 << 19
    odds: float = 3.0
    evidence: float = 10.0
    epochs: int = 6
    batch: int = 4096
    rate: float = 0.5
    decay: float = 1e-6


@dataclass
class Model:
    """Weights of the field and of the document score; without a field, `prior` is every score."""

    prior: float
    weights: np.ndarray | None = None
    start: float = 0.0
    moves: np.ndarray | None = None
    document: np.ndarray | None = None
    length: int = 32


def plain(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)


def _own_features(words: Words) -> np.ndarray:
    """Hashes of each word and of its prefixes, a column each; 0 for a prefix longer than the word."""
    a = np.frombuffer(words.data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    columns = [mix(words.hashes, 1)]
    for k, n in enumerate(PREFIXES):
        out = np.zeros(len(words.hashes), dtype=np.uint64)
        long = np.flatnonzero(words.ends - words.starts >= n)
        with np.errstate(over="ignore"):
            total = np.zeros(len(long), dtype=np.uint64)
            for i, power in enumerate(powers(n)):
                total += a[words.starts[long] + i] * power
        out[long] = mix(total, 2 + k)
        columns.append(out)
    return np.stack(columns, axis=1)


def features(words: Words, buckets: int) -> np.ndarray:
    """The hashed features of each word: itself, its prefixes, the words before and after it in its text."""
    own = _own_features(words)
    before, after = np.zeros(len(own), dtype=np.uint64), np.zeros(len(own), dtype=np.uint64)
    if len(own):
        text = words.text_of_words()
        inner = text[1:] == text[:-1]
        before[1:] = np.where(inner, mix(words.hashes[:-1], 11), 0)
        after[:-1] = np.where(inner, mix(words.hashes[1:], 12), 0)
    every = np.concatenate([own, before[:, None], after[:, None]], axis=1)
    return (every % np.uint64(buckets - 1) + np.uint64(1)).astype(np.int32) * (every > 0)


def sequences(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of texts with these many words stand in sequences: row and column of each."""
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    rows_of = -(-counts // length)
    first = np.repeat(np.cumsum(rows_of) - rows_of, counts)
    return first + place // length, place % length


def forward_backward(emission: np.ndarray, present: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state, and expected moves between states, of sequences.

    emission: sequence by place, the score of toxic over clean; present: which places have a word
    (a sequence's first ones). moves: log weights from state (row) to state.
    """
    n, length = emission.shape
    weight = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], axis=2)
    step = np.exp(moves)
    alpha = np.empty((n, length, 2))
    alpha[:, 0] = weight[:, 0] * np.array([1.0, np.exp(start)])
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        now = alpha[:, t - 1] @ step * weight[:, t]
        now /= now.sum(axis=1, keepdims=True)
        alpha[:, t] = np.where(present[:, t, None], now, alpha[:, t - 1])
    beta = np.ones((n, 2))
    marginal = np.zeros((n, length))
    expected = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        both = alpha[:, t] * beta
        marginal[:, t] = np.where(present[:, t], both[:, 1] / both.sum(axis=1), 0.0)
        if t == 0:
            break
        ahead = weight[:, t] * beta
        joint = alpha[:, t - 1, :, None] * step[None] * ahead[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        expected += joint[present[:, t]].sum(axis=0)
        back = ahead @ step.T
        back /= back.sum(axis=1, keepdims=True)
        beta = np.where(present[:, t, None], back, beta)
    return marginal, expected


def marginals(words: Words, model: Model) -> np.ndarray:
    """For each word, the probability that it is toxic."""
    counts = words.counts()
    if not counts.sum():
        return np.empty(0)
    row, column = sequences(counts, model.length)
    emission, present = np.zeros((row[-1] + 1, model.length)), np.zeros((row[-1] + 1, model.length), dtype=bool)
    emission[row, column] = model.weights[features(words, len(model.weights))].sum(axis=1)
    present[row, column] = True
    return forward_backward(emission, present, model.start, model.moves)[0][row, column]


def _evidence(chance: np.ndarray, words: Words) -> np.ndarray:
    """What a document's score rests on: a constant, the greatest marginal, the chance of any, the log of their sum."""
    out = np.zeros((len(words.first) - 1, 4))
    out[:, 0] = 1
    full = np.flatnonzero(words.counts())
    if len(full):
        at = words.first[full]
        out[full, 1] = np.maximum.reduceat(chance, at)
        out[full, 2] = 1 - np.exp(np.add.reduceat(np.log1p(-np.minimum(chance, 1 - 1e-9)), at))
        out[full, 3] = np.log1p(np.add.reduceat(chance, at))
    return out


def _families(parts: Iterable[Words], orders: int = 8) -> np.ndarray:
    """A number for each text, the same for texts that share much: near copies have some least hash in common
    among the runs of five words under a few orders."""
    parent: list[int] = []
    least: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for words in parts:
        for k in range(len(words.first) - 1):
            here = len(parent)
            parent.append(here)
            hashes = words.hashes[words.first[k] : words.first[k + 1]]
            if len(hashes):
                runs = grams(hashes, min(5, len(hashes)))
                for order in range(orders):
                    other = least.setdefault((order, int(mix(runs, order).min())), here)
                    parent[root(here)] = root(other)
    return np.unique([root(x) for x in range(len(parent))], return_inverse=True)[1]


def _toxic_tokens(found: np.ndarray, text: np.ndarray, toxic: np.ndarray, family: np.ndarray, how: Training) -> np.ndarray:
    """Labels of tokens, from those of texts: a token of a toxic text whose word, or a prefix of it, is much
    likelier in toxic texts than in clean ones. Near copies count once, or a much copied toxic text would
    make all its words toxic."""
    bad = np.zeros(family.max() + 1, dtype=bool)
    bad[family[toxic]] = True
    n_toxic, n_clean = bad.sum(), len(bad) - bad.sum()
    label = np.zeros(len(found), dtype=bool)
    for column in found[:, : 1 + len(PREFIXES)].T:
        once = np.unique(column.astype(np.int64) * len(bad) + family[text])
        feature, of = once // len(bad), once % len(bad)
        in_toxic = np.bincount(feature[bad[of]], minlength=how.buckets)
        in_clean = np.bincount(feature[~bad[of]], minlength=how.buckets)
        odds = np.log((in_toxic + 0.5) / (n_toxic + 1)) - np.log((in_clean + 0.5) / (n_clean + 1))
        total = np.maximum(in_toxic + in_clean, 1)
        rate, share = in_toxic / total, n_toxic / len(bad)
        with np.errstate(divide="ignore", invalid="ignore"):
            surprise = total * (
                np.where(rate > 0, rate * np.log(rate / share), 0.0) + np.where(rate < 1, (1 - rate) * np.log((1 - rate) / (1 - share)), 0.0)
            )
        strong = (odds >= how.odds) & (surprise >= how.evidence)
        strong[0] = False
        label |= strong[column]
    return label & toxic[text]


def fit(texts: list[bytes], toxic: np.ndarray, share: float, how: Training) -> Model:
    """A model from plain texts and their labels, of which both kinds occur. share: how many of all labelled
    texts are toxic; the sample may have more."""

    def parts() -> Iterator[Words]:
        """The texts, a block at a time, so that only the features of all words are held."""
        return (Words(texts[lo:hi]) for lo, hi in blocks(map(len, texts)))

    counts = np.concatenate([w.counts() for w in parts()])
    found = np.concatenate([features(w, how.buckets) for w in parts()])
    label = _toxic_tokens(found, np.repeat(np.arange(len(texts), dtype=np.int32), counts), toxic, _families(parts()), how)
    row, column = (x.astype(np.int32) for x in sequences(counts, how.length))
    model = Model(share, np.zeros(how.buckets), -2.0, np.array([[0.0, -2.0], [0.0, -1.0]]), None, how.length)
    bounds = np.searchsorted(row, np.arange((row[-1] if len(row) else -1) + 2))
    squares = np.full(how.buckets, 1e-6)
    draw = np.random.default_rng(0)
    n_rows = len(bounds) - 1
    for _ in range(how.epochs):
        for chosen in np.array_split(draw.permutation(n_rows), max(1, n_rows // how.batch)):
            at = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in chosen]) if len(chosen) else chosen
            if not len(at):
                continue
            local = np.repeat(np.arange(len(chosen)), bounds[chosen + 1] - bounds[chosen])
            shape = (len(chosen), how.length)
            emission, present, truth = np.zeros(shape), np.zeros(shape, dtype=bool), np.zeros(shape, dtype=bool)
            emission[local, column[at]] = model.weights[found[at]].sum(axis=1)
            present[local, column[at]] = True
            truth[local, column[at]] = label[at]
            chance, expected = forward_backward(emission, present, model.start, model.moves)
            miss = (label[at] - chance[local, column[at]]) / len(chosen)
            gradient = np.bincount(found[at].ravel(), np.repeat(miss, found.shape[1]), minlength=how.buckets)
            gradient[0] = 0
            gradient -= how.decay * model.weights
            squares += gradient**2
            model.weights += how.rate * gradient / np.sqrt(squares)
            pairs = present[:, 1:]
            seen = np.array(
                [[(pairs & (truth[:, :-1] == i) & (truth[:, 1:] == j)).sum() for j in (False, True)] for i in (False, True)]
            )
            model.moves += 0.1 * (seen - expected) / max(pairs.sum(), 1) * how.length
            model.start += 0.1 * (truth[:, 0].mean() - chance[:, 0].mean())
    model.weights[0] = 0
    model.weights = model.weights.astype(np.float32)
    evidence = np.concatenate([_evidence(marginals(w, model), w) for w in parts()])
    model.document = _logistic(evidence, toxic, np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean())))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the first column is the constant and is not shrunk."""
    out = np.zeros(x.shape[1])
    shrink = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + shrink
        out += np.clip(np.linalg.solve(curve, x.T @ (weight * (y - p)) - shrink @ out), -4, 4)
    return out


def fitted(documents: DataFrame, labels: DataFrame, how: Training | None = None) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic 0 or 1).

    A bounded sample of labelled documents (see Training) meets in one task, which fits the field; the
    share of toxic labels is taken over all of them. Labels of unknown documents and null
    labels are left out; a document labelled both ways is toxic. Of the rows of one id, that of the least text is
    drawn. In the order of the draw, texts are taken whole as long as they fit the sample's bytes; one
    larger than these is never taken. Without labels of both kinds, in all or in the sample,
    every score is the share of toxic labels, or 0 without any.
    """
    how = how or Training()
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    tally = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = tally.get(1, 0) / max(1, sum(tally.values()))
    if len(tally) < 2:
        return Model(share)
    drawn = [
        known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for toxic, most in ((1, how.most_toxic), (0, how.most_clean))
    ]
    # The sample's size is bounded by the parameters.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(sample, "doc_id")
    rows = written(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")
    # Only ids and sizes of the drawn rows are put in order.
    sizes = rows.select("doc_id", "toxic", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    so_far = F.sum("size").over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    taken = sizes.where(F.col("size") <= how.most_bytes).withColumn("so_far", so_far).where(F.col("so_far") <= how.most_bytes)
    rows = in_small_batches(rows.join(F.broadcast(taken.select("doc_id")), "doc_id", "left_semi"))

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = [b[["doc_id", "text", "toxic"]] for b in batches]
        if every:
            table = pd.concat(every).sort_values(["doc_id", "text"], na_position="first")
            toxic = table["toxic"].to_numpy() == 1
            both = toxic.any() and not toxic.all()
            model = fit([plain(t) for t in table["text"]], toxic, share, how) if both else Model(share)
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    made = rows.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else Model(share)


def _judged(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the texts, and marginals of their words."""
    if model.weights is None:
        return np.full(len(words.first) - 1, model.prior), np.zeros(len(words.hashes))
    chance = marginals(words, model)
    return 1 / (1 + np.exp(-np.clip(_evidence(chance, words) @ model.document, -30, 30))), chance


def scored(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents (doc_id, text) with score, predicted (1 from `least` on) and spans.

    Whole texts are tagged. The score is a logistic function of a document's marginals (see
    `_evidence`), so a text without words gets the least one. spans: code point offsets of words whose marginal
    is one half or more, neighbours joined. A null text counts as empty. Documents are scored one
    by one, repeated or not; nothing but the text counts. Other columns are not read.
    """

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = [plain(t) for t in batch["text"]], batch["doc_id"].to_numpy()
            for lo, hi in blocks(map(len, texts)):
                words = Words(texts[lo:hi])
                score, chance = _judged(words, model)
                spans = [_spans(words, chance, k, batch["text"].iloc[lo + k]) for k in range(hi - lo)]
                yield pd.DataFrame(
                    {"doc_id": ids[lo:hi], "score": score, "predicted": (score >= least).astype(np.int32), "spans": spans}
                )

    rows = in_small_batches(documents).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(over, SCORED)


def without_toxic(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents (text and any other columns) whose score stays below `least`, as they are."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            every = [plain(t) for t in batch]
            parts = [_judged(Words(every[lo:hi]), model)[0] for lo, hi in blocks(map(len, every))]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return in_small_batches(documents).where(score(F.col("text").cast("string")) < least)


def _spans(words: Words, chance: np.ndarray, text: int, original: str | None) -> list[dict]:
    """The toxic stretches of a text as code point offsets."""
    first, last = words.first[text], words.first[text + 1]
    at = first + np.flatnonzero(chance[first:last] >= 0.5)
    if not len(at):
        return []
    raw = original.encode("utf-8", "surrogatepass")
    points = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    origin = words.origin[text]
    out = []
    for group in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
        a, b = words.starts[group[0]] - origin, words.ends[group[-1]] - origin
        out.append({"start": int(points[a]) - 1, "end": int(points[b - 1])})
    return out
