"""Benchmark decontamination by a BM25 inverted index of test items with block-max WAND.

The items are the indexed documents; every passage (overlapping window of words) of
every training text is a query.  An item's impacts are divided by its own total, so a
passage that holds all of an item's terms scores 1, and all items above ``THRESHOLD``
are retrieved.  Retrieval skips as block-max WAND does, for all passages of a text at
once: postings are kept in blocks of ``BLOCK`` items of like length with the block's
largest impact of each term.  Terms that are frequent among the items are never
looked up for skipping; together they add at most ``COMMON_MASS`` to any item
(the bound of lists past the pivot).  Only a (passage, block) whose maxima reach the
threshold with that bound is scored in full, item by item.

A retrieved item is verified on the passage: at least ``CONTAINED`` of its 5-word
shingles occur there, and of both its question (all but the last sentence; one
sentence is halved) and its answer at least ``PART`` of the words do.

Windows are twice as long as the longest item of a block's length class and overlap by
half, so every occurrence of an item lies inside one.  The index is built by Spark with
counts over all items and cut into parts of about ``PART_ITEMS`` items and ``PART_WORDS`` words, each
small enough to broadcast; texts are run against each part.

Words are runs of word characters; in scripts that put no spaces between words (Chinese,
Japanese, Thai and their like) each character is one.

Defined cases: null and empty texts and items match nothing; items under five words
are no evidence and are left out; repeated items and rows are reported each once a row;
case and punctuation do not count; extra columns are kept by ``keep_clean`` and not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge.llm.common import cut, map_rows, ship

K1, B = 1.2, 0.75
THRESHOLD = 0.5
COMMON_MASS = 0.2
BLOCK = 4
CONTAINED, PART = 0.8, 0.8
SHINGLE = 5
PART_ITEMS, PART_WORDS = 20_000, 4_000_000
#: Thai and Lao, Myanmar, Khmer, kana, and the Han blocks.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORDS = re.compile(f"[^\\W{UNSPACED}]+|[{UNSPACED}]").findall
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+|(?<=[。！？：；])\s*|\n+")


def words(text: str | None) -> list[str]:
    return WORDS(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; one sentence is halved."""
    parts = [w for w in map(words, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [x for p in parts[:-1] for x in p], parts[-1]
    all_words = parts[0] if parts else []
    return all_words[: len(all_words) // 2], all_words[len(all_words) // 2:]


@dataclass
class Item:
    item_id: object
    ids: np.ndarray                  # the text as term numbers
    terms: dict[int, float]          # impact of each distinct term, as a share of all
    shingles: set[tuple[int, ...]]
    question: set[int]
    answer: set[int]


@dataclass
class Index:
    vocabulary: dict[str, int]
    items: list[Item]                # by length; a block is BLOCK neighbours of one class
    block_items: list[list[int]]
    stride: np.ndarray               # per block: the class's length
    starts: np.ndarray               # per term: its blocks in the two arrays below
    blocks: np.ndarray
    maxima: np.ndarray

    def leaks(self, text: str | None) -> list[tuple[object, float, float, float, float]]:
        """(item_id, score, contained, question, answer) of every item found in the text."""
        known = self.vocabulary.get
        ids = np.array([known(w, -1) for w in words(text)], dtype=np.int64)
        if not len(ids):
            return []
        best: dict[int, tuple] = {}
        for block, window in self._candidates(ids):
            size = int(self.stride[block])
            passage = ids[window * size: (window + 2) * size]
            have = set(passage.tolist())
            grams = None
            for i in self.block_items[block]:
                item = self.items[i]
                score = sum(u for t, u in item.terms.items() if t in have)
                if score < THRESHOLD:
                    continue
                if grams is None:
                    p = passage.tolist()
                    grams = set(zip(*(p[k:] for k in range(SHINGLE))))
                contained = len(item.shingles & grams) / len(item.shingles)
                q = len(item.question & have) / max(len(item.question), 1)
                a = len(item.answer & have) / max(len(item.answer), 1)
                if contained >= CONTAINED and q >= PART and a >= PART:
                    best[i] = max(best.get(i, (0,)), (contained, score, q, a))
        return [(self.items[i].item_id, s, c, q, a) for i, (c, s, q, a) in sorted(best.items())]

    def _candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(block, window) whose block maxima allow a score of THRESHOLD."""
        at = np.flatnonzero(ids >= 0)
        first, count = self.starts[ids[at]], self.starts[ids[at] + 1] - self.starts[ids[at]]
        total = int(count.sum())
        if not total:
            return []
        flat = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(total)
        block, most = self.blocks[flat], self.maxima[flat]
        needed = THRESHOLD - COMMON_MASS
        whole = np.bincount(block, most, len(self.stride))     # the text as one passage, first
        keep = whole[block] >= needed
        if not keep.any():
            return []
        block, most, place = block[keep], most[keep], np.repeat(at, count)[keep]
        window = place // self.stride[block]
        both = np.concatenate([block * (1 << 40) + window + 1, block * (1 << 40) + window])  # windows overlap by half
        keys, where = np.unique(both, return_inverse=True)
        reach = np.bincount(where, np.concatenate([most, most]))
        good = keys[reach >= needed]
        return [(int(k >> 40), max(0, int(k & ((1 << 40) - 1)) - 1)) for k in good]


def item_facts(benchmark: DataFrame) -> DataFrame:
    """(key, item_id, text, n, term, tf, impact): impacts are shares of the item's BM25 total."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL").dropDuplicates()
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def make():
        def run(cols):
            out = [(i, t, w) for i, t, w in ((i, t, words(t)) for i, t in zip(*cols)) if len(w) >= SHINGLE]
            return [list(c) for c in zip(*out)] or [[], [], []]
        return run

    split = map_rows(items, f"item_id {kind}, text string, words array<string>", make).select(
        F.xxhash64("item_id", "text").alias("key"), "item_id", "text", F.size("words").alias("n"), "words")
    tf = (split.select("key", "item_id", "text", "n", F.explode("words").alias("term"))
               .groupBy("key", "item_id", "text", "n", "term").agg(F.count("*").alias("tf")))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    stats = split.agg(F.count("*").alias("items"), F.avg("n").alias("mean")).first()  # two numbers
    weighed = tf.join(df, "term").withColumn(
        "raw", F.log(1 + (stats["items"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
        * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n") / (stats["mean"] or 1.0))))
    whole = weighed.groupBy("key").agg(F.sum("raw").alias("whole"))
    return weighed.join(whole, "key").select("key", "item_id", "text", "n", "term", "df", (F.col("raw") / F.col("whole")).alias("impact"))


def build_index(rows: list) -> Index:
    """The index of one part, from its ``item_facts``."""
    by_key: dict[int, list] = {}
    for r in rows:
        by_key.setdefault(r["key"], []).append(r)
    order = sorted(by_key.values(), key=lambda rs: (rs[0]["n"], str(rs[0]["item_id"]), rs[0]["key"]))
    vocabulary: dict[str, int] = {}
    for rs in order:
        for w in words(rs[0]["text"]):
            vocabulary.setdefault(w, len(vocabulary))
    items = []
    for rs in order:
        ids = np.array([vocabulary[w] for w in words(rs[0]["text"])])
        q, a = question_and_answer(rs[0]["text"])
        p = ids.tolist()
        items.append(Item(rs[0]["item_id"], ids, {vocabulary[r["term"]]: float(r["impact"]) for r in rs},
                          set(zip(*(p[k:] for k in range(SHINGLE)))), {vocabulary[w] for w in q}, {vocabulary[w] for w in a}))
    # frequent terms, as many as add at most COMMON_MASS to any item
    df = {vocabulary[r["term"]]: r["df"] for r in rows}
    holds: dict[int, list[tuple[int, float]]] = {}
    for i, item in enumerate(items):
        for t, u in item.terms.items():
            holds.setdefault(t, []).append((i, u))
    mass, common = np.zeros(len(items)), set()
    for t in sorted(df, key=lambda t: (-df[t], t)):
        if any(mass[i] + u > COMMON_MASS for i, u in holds[t]):
            continue
        common.add(t)
        for i, u in holds[t]:
            mass[i] += u
    block_items, stride, block_of = [], [], []
    for i, item in enumerate(items):
        size = 1 << max(3, int(len(item.ids) - 1).bit_length())
        if not block_items or stride[-1] != size or len(block_items[-1]) == BLOCK:
            block_items.append([])
            stride.append(size)
        block_items[-1].append(i)
        block_of.append(len(block_items) - 1)
    starts, blocks, maxima = [0], [], []
    for t in range(len(vocabulary)):
        most: dict[int, float] = {}
        if t not in common:
            for i, u in holds[t]:
                most[block_of[i]] = max(most.get(block_of[i], 0.0), u)
        for b in sorted(most):
            blocks.append(b)
            maxima.append(most[b])
        starts.append(len(blocks))
    return Index(vocabulary, items, block_items, np.array(stride, np.int64), np.array(starts, np.int64),
                 np.array(blocks, np.int64), np.array(maxima))


def indexes(benchmark: DataFrame, part_items: int = PART_ITEMS, part_words: int = PART_WORDS) -> list:
    """Broadcast index parts of about ``part_items`` items and ``part_words`` words each."""
    facts = item_facts(benchmark)
    size = benchmark.select(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size.n // part_items), -(-size.chars // (2 * part_words)))
    sc = benchmark.sparkSession.sparkContext
    if parts > 1:
        facts = cut(facts)
    return [sc.broadcast(build_index(facts.filter(F.pmod("key", F.lit(parts)) == k).collect())) for k in range(parts)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, contained, question, answer): one row for each item found in each row."""
    kind, item = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item}, score double, contained double, question double, answer double"
    found = None
    for index in indexes(benchmark):
        def make(index=index):
            def run(cols):
                rows = [(d, *leak) for d, t in zip(*cols) for leak in index.value.leaks(t)]
                return [list(c) for c in zip(*rows)] or [[]] * 6
            return run
        part = map_rows(docs.select("doc_id", "text"), schema, make)
        found = part if found is None else found.unionByName(part)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)
    for index in indexes(benchmark):
        def run(batches, index=index):
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    yield part.filter(pa.array([not index.value.leaks(t) for t in part.column(place).to_pylist()], pa.bool_()))
        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs
