"""Language identification by interpolated Kneser-Ney character models.

One model per language over lower-cased letters (any run of other characters
is one space), orders 1 to ``ORDER``.  The n-grams of a bounded training sample
are counted by Spark; the model is a few sorted hash arrays: for each order the
sorted hashes of all n-grams with one row of log-probabilities (a column per
language, already interpolated), and the sorted hashes of the contexts with
their back-off weights.  A text's score per language is its cross-entropy
divided by its length; the lowest wins.

Rejection is calibrated on sampled documents that the models were not fitted on: for each language the mean of
the cross-entropy per character, its spread between documents and its spread
between characters are kept.  A text is rejected if it has no letters, or if its
cross-entropy lies more than ``REJECT_Z`` spreads above the mean, where the spread
is the one between documents (``LEAST_SPREAD`` at least) plus that of characters
over the square root of the length.

Defined cases: null, empty and letterless texts are ``und`` with score 0 and
rejected; ties go to the alphabetically first language; repeated rows get the
same answer; without training rows every row is ``und``; very long texts are scored
in slices that overlap by the context; extra columns are kept by
``keep_identified`` and never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge.llm.common import hash_bound, hash_part, map_rows, mix64, ship, utf8_crc32_mod3

ORDER = 4
#: Expected number of training documents taken of each language (all, if there are fewer).
TRAIN_DOCS = 600
#: For so many documents to fit on there is one to calibrate with, in languages of LEAST_ASIDE or more.
ASIDE, LEAST_ASIDE = 4, 25
REJECT_Z = 8.0
LEAST_SPREAD = 0.25
#: Characters scored at a time.
SLICE = 1 << 20
#: Code points are packed in 16 bits; higher ones count as one character.
TOP = 0xFFFF
_NOT_LETTER = re.compile(r"[\W\d_]+")
PAD = " " * (ORDER - 1)


def letters(text: str | None) -> str:
    """Lower-cased letters; every other run is one space; none at the ends."""
    return _NOT_LETTER.sub(" ", text.lower()).strip() if text else ""


def codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), TOP).astype(np.uint64)


def packed(c: np.ndarray) -> np.ndarray:
    """For every i >= ORDER-1 the last ORDER characters, the latest lowest."""
    out = c[ORDER - 1:].copy()
    for k in range(1, ORDER):
        out |= c[ORDER - 1 - k: len(c) - k] << np.uint64(16 * k)
    return out


def low(p: np.ndarray, n: int) -> np.ndarray:
    """The last n characters of packed ones, as a hash that depends on n."""
    if n < 4:
        p = p & np.uint64((1 << 16 * n) - 1)
    return mix64(p + np.uint64(n))


def _pack_text(grams: list[str]) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for i, g in enumerate(grams):
        x = 0
        for ch in g:
            x = x << 16 | min(ord(ch), TOP)
        out[i] = x
    return out


def count_grams(docs: DataFrame) -> pd.DataFrame:
    """(lang, gram, count) of the training sample, summed by Spark.  The sample is
    bounded, and so is the number of its distinct n-grams."""
    def make():
        def run(cols):
            c: Counter = Counter()
            for lang, text in zip(*cols):
                t = letters(text)
                if t:
                    t = f"{PAD}{t} "
                    c.update((lang, t[i:i + ORDER]) for i in range(len(t) - ORDER + 1))
            return [[k[0] for k in c], [k[1] for k in c], list(c.values())]
        return run

    grams = map_rows(docs.select("lang", "text"), "lang string, gram string, n long", make, rows=64)
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()


@dataclass
class Model:
    langs: list[str]
    grams: list[np.ndarray]      # per order: sorted hashes of n-grams
    logp: list[np.ndarray]       # per order: a row of log2-probabilities, one for each language
    contexts: list[np.ndarray]   # per order from 2: sorted hashes of contexts
    backoff: list[np.ndarray]    # per order from 2: log2 of the contexts' back-off weights
    floor: np.ndarray            # log2-probability of a character that was never seen
    mean: np.ndarray | None = None
    doc_sd: np.ndarray | None = None
    char_sd: np.ndarray | None = None

    def bits(self, p: np.ndarray) -> np.ndarray:
        """-log2 p(last character | those before) for packed n-grams, a column per language."""
        at, ok = _find(self.grams[0], low(p, 1))
        out = np.where(ok[:, None], self.logp[0][at], self.floor)
        for n in range(2, ORDER + 1):
            at, ok = _find(self.contexts[n - 2], low(p >> np.uint64(16), n - 1))
            out = out + np.where(ok[:, None], self.backoff[n - 2][at], np.float32(0))
            at, ok = _find(self.grams[n - 1], low(p, n))
            out = np.where(ok[:, None], self.logp[n - 1][at], out)
        return -out

    def measure(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: total bits and total squared bits for each language, and the
        number of characters.  Slices of many texts are scored together."""
        total = np.zeros((len(texts), len(self.langs)))
        squares, size = np.zeros_like(total), np.zeros(len(texts), np.int64)
        rows, parts, held = [], [], 0
        for i, text in enumerate(texts):
            t = letters(text)
            if not t:
                continue
            c = codes(f"{PAD}{t} ")
            for at in range(ORDER - 1, len(c), SLICE):
                parts.append(packed(c[at - ORDER + 1: at + SLICE]))
                rows.append(i)
                held += len(parts[-1])
                if held >= SLICE:
                    self._add(rows, parts, total, squares, size)
                    rows, parts, held = [], [], 0
        if parts:
            self._add(rows, parts, total, squares, size)
        return total, squares, size

    def _add(self, rows, parts, total, squares, size) -> None:
        which, kinds = pd.factorize(np.concatenate(parts))
        table = self.bits(np.asarray(kinds, dtype=np.uint64))
        starts = np.cumsum([0, *map(len, parts[:-1])])
        rows = np.array(rows)
        for x in range(len(self.langs)):
            column = table[:, x][which].astype(np.float64)
            np.add.at(total[:, x], rows, np.add.reduceat(column, starts))
            np.add.at(squares[:, x], rows, np.add.reduceat(column * column, starts))
        np.add.at(size, rows, list(map(len, parts)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool, float | None]]:
        """(language, score, rejected, bits per character) of each text."""
        if not self.langs:
            return [("und", 0.0, True, None)] * len(texts)
        total, _, size = self.measure(texts)
        out = []
        for t, n in zip(total, size):
            if not n:
                out.append(("und", 0.0, True, None))
                continue
            best = int(np.argmin(t))
            entropy = float(t[best] / n)
            gaps = (t - t[best]) / n * min(n, 40)
            spread = max(self.doc_sd[best], LEAST_SPREAD) + self.char_sd[best] / np.sqrt(n)
            out.append((self.langs[best], float(1 / np.exp2(-np.minimum(gaps, 60)).sum()),
                        bool(entropy > self.mean[best] + REJECT_Z * spread), entropy))
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted hash array, and whether each was found."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def kneser_ney(counts: pd.DataFrame) -> Model:
    """Raw counts at the top order, below it the number of different characters
    before an n-gram; absolute discounts from the counts of one and two."""
    langs = sorted(counts["lang"].unique())
    if not langs:
        return Model([], [], [], [], [], np.zeros(0))
    tables = {ORDER: counts.assign(l=counts["lang"].map({x: i for i, x in enumerate(langs)}))[["l", "gram", "n"]]}
    for n in range(ORDER - 1, 0, -1):
        up = tables[n + 1]
        tables[n] = pd.DataFrame({"l": up["l"], "gram": up["gram"].str[1:]}).groupby(["l", "gram"]).size().rename("n").reset_index()
    model = Model(langs, [], [], [], [], np.zeros(0))
    lower: pd.Series | None = None
    lower_p = np.zeros(0)
    for n in range(1, ORDER + 1):
        t = tables[n]
        which, grams = pd.factorize(t["gram"])
        c = np.zeros((len(grams), len(langs)))
        c[which, t["l"]] = t["n"]
        ctx, contexts = pd.factorize(pd.Series(grams).str[:-1])
        ones, twos = (c == 1).sum(axis=0), (c == 2).sum(axis=0)
        d = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
        np.add.at(total, ctx, c)
        np.add.at(kinds, ctx, (c > 0).astype(float))
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        seen = np.maximum(c - d, 0) / np.maximum(total[ctx], 1)
        if n == 1:
            below = np.full(c.shape, 1 / (len(grams) + 1))
            model.floor = np.log2(weight[0] / (len(grams) + 1)).astype(np.float32)
        else:
            below = lower_p[lower[pd.Series(grams).str[1:]].to_numpy()]
            keys = low(_pack_text(list(contexts)), n - 1)
            order = np.argsort(keys)
            model.contexts.append(keys[order])
            model.backoff.append(np.log2(weight[order]).astype(np.float32))
        lower_p = seen + weight[ctx] * below
        lower = pd.Series(np.arange(len(grams)), index=grams)
        keys = low(_pack_text(list(grams)), n)
        order = np.argsort(keys)
        model.grams.append(keys[order])
        model.logp.append(np.log2(lower_p[order]).astype(np.float32))
    return model


def training_sample(docs: DataFrame, per_lang: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text, fits, measures) of the fold that may be learned from: of each language a
    share, by a hash of the id, that makes about ``per_lang`` documents to fit the model on and a
    quarter as many to calibrate it.  A language with few documents uses them for both."""
    fold = docs.filter((utf8_crc32_mod3(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in fold.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    part, chosen = hash_part("doc_id"), F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & (part < hash_bound(per_lang + per_lang // ASIDE, n)))
    few = F.col("lang").isin([lang for lang, n in sizes.items() if n < LEAST_ASIDE])
    aside = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(ASIDE + 1)) == 0
    return fold.filter(chosen).select("lang", "text", (few | ~aside).alias("fits"), (few | aside).alias("measures"))


def fit(docs: DataFrame, per_lang: int = TRAIN_DOCS) -> Model:
    """The models, from a sample of about ``per_lang`` labelled documents a language, and their
    calibration, from documents beside them."""
    sample = training_sample(docs, per_lang)
    model = kneser_ney(count_grams(sample.filter("fits")))
    k = len(model.langs)
    model.mean, model.doc_sd, model.char_sd = np.zeros(k), np.zeros(k), np.ones(k)
    if not k:
        return model
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded with the sample

    def make():
        m = sent.value
        at = {x: i for i, x in enumerate(m.langs)}

        def run(cols):
            total, squares, size = m.measure(cols[1])
            rows = [(x, total[i, at[x]] / size[i], squares[i, at[x]] / size[i]) for i, x in enumerate(cols[0]) if size[i]]
            return [list(c) for c in zip(*rows)] or [[], [], []]
        return run

    learned = sample.filter("measures").filter(F.col("lang").isin(model.langs))
    facts = map_rows(learned.select("lang", "text"), "lang string, e double, q double", make, rows=64)
    for r in facts.groupBy("lang").agg(F.avg("e").alias("mean"), F.stddev_pop("e").alias("sd"),
                                       F.avg(F.col("q") - F.col("e") * F.col("e")).alias("var")).collect():
        i = model.langs.index(r["lang"])
        model.mean[i], model.doc_sd[i], model.char_sd[i] = r["mean"], r["sd"], max(r["var"], 0.0) ** 0.5
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected, entropy of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def run(cols):
            p = m.predict(cols[1])
            return [cols[0], [x[0] for x in p], [x[1] for x in p], [x[2] for x in p], [x[3] for x in p]]
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id {kind}, lang_pred string, score double, rejected boolean, entropy double", make)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        m = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rejected = [x[2] for x in m.predict(part.column(place).to_pylist())]
                yield part.filter(pc.invert(pa.array(rejected, pa.bool_())))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def digest(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    return predict(docs, model).select(
        "doc_id", F.coalesce(utf8_crc32_mod3(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
