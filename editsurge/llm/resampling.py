"""Importance resampling towards a target distribution, by hashed n-gram counts.

The features of a text are its runs of 1 to ``most`` consecutive words; each falls into
one of ``buckets`` places by its crc32.  The documents' counts and the
target's counts give every bucket a gain, the log of the ratio of its smoothed shares; a
document's weight is the sum of its features' gains.  Gumbel noise, hashed
from the doc_id, is added, and the highest scores are drawn: sampling without
replacement in proportion to the exponential of the weights, the same at every run.

Features are found by batch concatenation.  The texts of a batch are joined with
separators, which no word can contain; one pass of one regular expression finds the words of
all texts; ``searchsorted`` of the words' places in the texts' starts tells each word's
document; n-grams whose first and last word lie in different documents are
masked, and ``bincount`` sums what is left by bucket or by document.

Two scans of the texts and no exchange of them: the first sends bucket counts
(``buckets`` rows a task at most), the second a few numbers a document, which are numbered by
a range exchange.  Only the gains, one integer a bucket, are broadcast.

Defined cases: null and empty texts have no features and weight 0; a null doc_id is hashed
as no digits and comes first among ties; repeated rows have equal scores, and ranks of
their own if drawn; without a target all weights still follow from the smoothing; an
empty table gives an empty result; columns that are not named here are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editsurge.llm.common import cut, map_rows, ship
from editsurge.llm.sharding import number_rows

BUCKETS = 10_000
#: Words of the longest feature.
MOST = 1
SEED = 2024
LEAST_WORDS = 20
DRAW_PERCENT = 10
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\n"
#: Bytes of the texts that are joined at a time (a longer text is a batch of its own).
BATCH_BYTES = 1 << 20
#: Rows held as Python objects at a time.
ROWS = 256
MEMO = 300_000


class Places(dict):
    """Bucket of each feature; recent features are remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[feature] = place = zlib.crc32(feature) % self.buckets
        return place


def batches(texts: list[str | None], size: int = BATCH_BYTES):
    """Lists of lower-cased UTF-8 texts (a null one empty) of about ``size`` bytes."""
    part, held = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").lower() if text else b""
        if part and held + len(data) > size:
            yield part
            part, held = [], 0
        part.append(data)
        held += len(data) + len(SEPARATOR)
    if part:
        yield part


def features(part: list[bytes], places: Places, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document) of every feature of a batch, and the words of each document."""
    joined = SEPARATOR.join(part)
    starts = np.cumsum([0] + [len(t) + len(SEPARATOR) for t in part[:-1]])
    words, at = [], []
    for found in WORD.finditer(joined):
        words.append(found.group())
        at.append(found.start())
    owner = np.searchsorted(starts, np.array(at, dtype=np.int64), side="right") - 1
    buckets, owners = [], []
    for n in range(1, most + 1):
        if len(words) < n:
            break
        last = len(words) - n + 1
        inside = owner[:last] == owner[n - 1:]
        grams = words if n == 1 else [b" ".join(words[i:i + n]) for i in np.flatnonzero(inside)]
        buckets.append(np.fromiter(map(places.__getitem__, grams), np.int64, len(grams)))
        owners.append(owner[:last][inside])
    n_words = np.bincount(owner, minlength=len(part))
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    return np.concatenate(buckets), np.concatenate(owners), n_words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MOST) -> np.ndarray:
    """Features of all texts by bucket."""
    def run(arrow):
        places, total = Places(buckets), np.zeros(buckets, np.int64)
        for batch in arrow:
            for at in range(0, batch.num_rows, ROWS):
                for part in batches(batch.column(0).slice(at, ROWS).to_pylist()):
                    total += np.bincount(features(part, places, most)[0], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full], pa.int64())], names=["bucket", "n"])

    ship(texts.sparkSession)
    counted = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + size)) / ((s + 1) * (t_all + size))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate of the doc_id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, seed: int = SEED, most: int = MOST) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # one integer a bucket

    def make():
        table = sent.value
        places = Places(len(table))

        def run(cols):
            words, counts, weights = [], [], []
            for part in batches(cols[1]):
                place, owner, n_words = features(part, places, most)
                words += n_words.tolist()
                counts += np.bincount(owner, minlength=len(part)).tolist()
                # sums of integers far below 2**53: exact in doubles
                weights += np.bincount(owner, table[place], len(part)).astype(np.int64).tolist()
            return [cols[0], words, counts, weights, [w + noise(i, seed) for i, w in zip(cols[0], weights)]]
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), f"doc_id {kind}, n_words long, n_features long, weight long, score long", make)


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = MOST, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row.  Of the rows with at least
    ``least_words`` words, ``percent`` in a hundred are drawn; ranks follow score, then doc_id."""
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    # The scores are written before they are put in order: the exchange samples its input first.
    scored = cut(weigh(docs, gain, seed, most)).withColumn("_able", F.col("n_words") >= least_words)
    # Rows that may be drawn come first, by falling score, so that the row number is the rank.
    laid = scored.withColumn("_down", F.when(F.col("_able"), -F.col("score")).otherwise(F.lit(2 ** 62)))
    rows = number_rows(laid, ["_down", "doc_id", "n_features", "weight"], "_row")
    n = rows.filter("_able").count()
    drawn = F.col("_able") & (F.col("_row") < n * percent // 100)
    return rows.select("doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("_row") + 1).alias("rank"))


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
