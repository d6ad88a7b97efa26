"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their leading letters, hashed into
``BUCKETS`` places; a text is the set of its terms.  The machine's logit is

    bias + sum of the terms' weights + sum over pairs of terms of <v_i, v_j>,

so a pair of terms (an insult with the mention of a group) can weigh what neither
does alone.  The pair sum takes one pass: half of |sum v|^2 - sum |v|^2.  Only terms
that tell the labels of the sample apart have weights, so long texts do not add up noise:
those whose own share of toxic documents differs (``LEAST_DOCS``, ``LEAST_Z``), and those of pairs whose
documents are toxic more or less often than the two terms' weights would add up to
(``PAIR_SHARE``, ``LEAST_PAIR_Z``); each term of such a pair may tell nothing alone.  Fitted by Adagrad on log-loss over a bounded sample
of labelled rows; one part of the sample is kept aside to calibrate the logits.

Defined cases: null and empty texts get the bias alone; repeated rows score alike;
without labelled rows every score is 0; unlabelled rows are scored too; a doc_id
with several labels counts as toxic if one of them is 1; rows without a doc_id
are scored and never learned from; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editsurge.llm.common import hash_bound, hash_part, map_rows, utf8_crc32_mod3

BUCKETS = 1 << 18
FACTORS = 4
#: Expected number of labelled documents the machine is fitted on.
TRAIN_DOCS = 12_000
#: Longer documents are not taken into the sample (they are scored whole).
TRAIN_CHARS = 40_000
PREFIXES = (4, 5)
#: Sampled documents a term must occur in to have a weight.
LEAST_DOCS = 4
#: Deviations by which a term's share of toxic documents must differ from the whole sample's.
LEAST_Z = 4.0
#: Of the sampled documents a term of a pair must occur in this share, and a pair in so many.
PAIR_SHARE, LEAST_PAIR_DOCS = 0.01, 12
#: Deviations by which a pair's share of toxic documents must differ from what its terms add up to.
LEAST_PAIR_Z = 8.0
#: One in so many sampled documents is kept aside for calibration.
ASIDE = 4
EPOCHS = 25
BATCH = 64
RATE = 0.1
DECAY = 1e-5
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+").findall
MEMO = 300_000


class Terms:
    """Hashed term sets of texts; the terms of recent words are remembered."""

    def __init__(self):
        self.memo: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        pieces = [word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]
        out = tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in pieces)
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = out
        return out

    def of(self, text: str | None) -> list[int]:
        known, found = self.memo, set()
        for word in set(WORDS(text.lower())) if text else ():
            found.update(known.get(word) or self.of_word(word))
        return sorted(found)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray   # BUCKETS; 0 for terms that tell nothing
    factor: np.ndarray   # (BUCKETS, FACTORS)
    fitted: bool = True
    slope: float = 1.0   # calibration of the logits
    shift: float = 0.0

    def logits(self, terms: list[np.ndarray]) -> np.ndarray:
        size = np.array([len(t) for t in terms])
        out = np.full(len(terms), self.bias)
        full = np.flatnonzero(size)
        if len(full):
            flat = np.concatenate([terms[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
            linear, pairs, _ = _sums(flat, starts, self.weight, self.factor)
            out[full] += linear + pairs
        return out

    def scores(self, terms: list[np.ndarray]) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(terms))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(terms) + self.shift, -40, 40)))


def _sums(flat, starts, weight, factor):
    """Linear and pairwise parts for each text, and the sum of its factors."""
    linear = np.add.reduceat(weight[flat], starts)
    v = factor[flat]
    total = np.add.reduceat(v, starts, axis=0)
    own = np.add.reduceat(v * v, starts, axis=0)
    return linear, (total * total - own).sum(axis=1) / 2, total


def telling_terms(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Whether each place's share of toxic documents differs from the sample's."""
    rate = labels.mean()
    flat = np.concatenate(terms)
    seen = np.bincount(flat, minlength=BUCKETS)
    toxic = np.bincount(flat, weights=np.repeat(labels, [len(t) for t in terms]), minlength=BUCKETS)
    z = (toxic - seen * rate) / np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9))
    return (seen >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z)


def telling_pairs(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Whether each place belongs to a pair whose documents are toxic more or less often than the
    two terms' log-odds add up to.  Counted term by term over the documents that
    hold it, so the work is the sum of the squared numbers of terms, and memory one row."""
    out = np.zeros(BUCKETS, dtype=bool)
    seen = np.bincount(np.concatenate(terms), minlength=BUCKETS)
    places = np.flatnonzero(seen >= max(LEAST_PAIR_DOCS, PAIR_SHARE * len(terms)))
    at = np.full(BUCKETS, -1)
    at[places] = np.arange(len(places))
    kept = [k[k >= 0] for k in (at[t] for t in terms)]
    size = np.array([len(k) for k in kept])
    flat, docs = np.concatenate(kept), np.repeat(np.arange(len(kept)), size)
    by_term = docs[np.argsort(flat, kind="stable")]
    ends = np.cumsum(np.bincount(flat, minlength=len(places)))
    odds = lambda hit, n: np.log((hit + 0.5) / (n - hit + 0.5))
    own = odds(np.bincount(flat, weights=labels[docs], minlength=len(places)), seen[places])
    base = odds(labels.sum(), len(labels))
    for a in range(len(places)):
        holders = by_term[ends[a - 1] if a else 0:ends[a]]
        both = np.bincount(np.concatenate([kept[d] for d in holders]), minlength=len(places))
        toxic = holders[labels[holders] > 0]
        hit = np.bincount(np.concatenate([kept[d] for d in toxic]), minlength=len(places)) if len(toxic) else np.zeros(len(places))
        p = 1 / (1 + np.exp(-np.clip(own[a] + own - base, -8, 8)))
        z = np.abs(hit - both * p) / np.sqrt(np.maximum(both * p * (1 - p), 1e-9))
        z[a] = 0
        found = (both >= LEAST_PAIR_DOCS) & (z >= LEAST_PAIR_Z)
        # what occurs in (nearly) the same documents, as a word and its beginning, is one term, not a pair
        found &= both < 0.9 * np.minimum(seen[places], seen[places[a]])
        if found.any():
            out[places[a]] = True
            out[places[found]] = True
    return out


def fit_machine(terms: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Adagrad over shuffled batches; the same result for the same sample."""
    weight, factor = np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS))
    if not len(labels):
        return Machine(0.0, weight, factor, fitted=False)
    rng = np.random.default_rng(seed)
    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    machine = Machine(float(np.log(rate / (1 - rate))), weight, factor)
    order = rng.permutation(len(labels))
    aside, rows = order[::ASIDE], order[np.arange(len(order)) % ASIDE > 0]
    if not len(rows) or labels[rows].min() == labels[rows].max() or not sum(len(terms[i]) for i in rows):
        return machine
    fitted = [terms[i] for i in rows]
    known = telling_terms(fitted, labels[rows]) | telling_pairs(fitted, labels[rows])
    kept = [t[known[t]] for t in terms]
    factor[:] = rng.normal(0, 0.05, factor.shape) * known[:, None]
    bias = machine.bias
    g_w, g_v, g_b = np.full(BUCKETS, 1e-2), np.full((BUCKETS, FACTORS), 1e-2), 1e-2
    full = np.array([i for i in rows if len(kept[i])], dtype=np.int64)
    for _ in range(EPOCHS if len(full) else 0):
        for part in np.array_split(rng.permutation(full), max(1, len(full) // BATCH)):
            size = np.array([len(kept[i]) for i in part])
            flat = np.concatenate([kept[i] for i in part])
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            linear, pairs, total = _sums(flat, starts, weight, factor)
            error = 1 / (1 + np.exp(-np.clip(bias + linear + pairs, -40, 40))) - labels[part]
            who = np.repeat(np.arange(len(part)), size)
            used, at = np.unique(flat, return_inverse=True)
            d_w = np.bincount(at, error[who], len(used)) / len(part) + DECAY * weight[used]
            d = error[who][:, None] * (total[who] - factor[flat])
            d_v = np.stack([np.bincount(at, d[:, k], len(used)) for k in range(FACTORS)], axis=1) / len(part) + DECAY * factor[used]
            g_w[used] += d_w * d_w
            g_v[used] += d_v * d_v
            weight[used] -= RATE * d_w / np.sqrt(g_w[used])
            factor[used] -= RATE * d_v / np.sqrt(g_v[used])
            b = float(error.mean())
            g_b += b * b
            bias -= RATE * b / g_b ** 0.5
    machine.bias = bias
    if labels[aside].min() < labels[aside].max():
        machine.slope, machine.shift = calibration(machine.logits([terms[i] for i in aside]), labels[aside])
    return machine


def calibration(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over held-aside logits, by Newton steps;
    the targets are softened by one row of either label."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([np.clip(logits, -30, 30), np.ones(len(logits))], axis=1)
    start = np.array([1.0, 0.0])

    def loss(w):
        m = np.clip(x @ w, -40, 40)
        return float((np.logaddexp(0, m) - target * m).sum() + 5e-4 * ((w - start) ** 2).sum())

    w = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (w - start)), -2, 2)
        while np.abs(step).max() > 1e-9 and loss(w - step) > loss(w):  # a full step can overshoot
            step = step / 2
        w = w - step
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def training_sample(docs: DataFrame, labels: DataFrame, size: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic) of about ``size`` labelled documents of the fold to learn from."""
    fold = labels.filter(F.col("toxic").isNotNull() & (utf8_crc32_mod3(F.col("doc_id")) != 1))
    marked = fold.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    chosen = marked.filter(hash_part("doc_id") < hash_bound(size, n))
    texts = docs.filter(F.length("text") <= TRAIN_CHARS).select("doc_id", "text")
    return texts.join(chosen, "doc_id").select("doc_id", "text", "toxic")


def _term_rows(sample: DataFrame) -> DataFrame:
    def make():
        terms = Terms()

        def run(cols):
            return [cols[0], cols[2], [np.asarray(terms.of(t), dtype=np.int32).tobytes() for t in cols[1]]]
        return run

    return map_rows(sample, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, toxic int, terms binary", make)


def fit(docs: DataFrame, labels: DataFrame, size: int = TRAIN_DOCS) -> Machine:
    """The machine, from a sample of about ``size`` labelled documents; only their
    hashed terms come to the driver."""
    rows = _term_rows(training_sample(docs, labels.withColumn("toxic", F.col("toxic").cast("int")), size)).toPandas()
    rows["terms"] = [bytes(t) for t in rows["terms"]]
    rows = rows.sort_values(["doc_id", "terms"])  # the same order whatever the partitions
    return fit_machine([np.frombuffer(t, np.int32).astype(np.int64) for t in rows["terms"]], rows["toxic"].to_numpy(dtype=float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # fixed size: BUCKETS places

    def make():
        terms, m = Terms(), sent.value

        def run(cols):
            return [cols[0], m.scores([np.asarray(terms.of(t), dtype=np.int64) for t in cols[1]]).tolist()]
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), f"doc_id {kind}, score double", make)


def digest(docs: DataFrame, machine: Machine) -> DataFrame:
    return score(docs, machine).select(
        "doc_id", F.coalesce(utf8_crc32_mod3(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
