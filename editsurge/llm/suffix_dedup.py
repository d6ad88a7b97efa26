"""Removal of repeated 100-byte strings with suffix arrays.

A byte goes if a 100-byte string that covers it also starts earlier (smaller doc_id,
or the same document and an earlier start), all judged on the input.

1. ``anchors.records`` cuts each text's windows into records that share an anchor.  Equal
   windows have equal anchor keys, so the work can be dealt by key.  Inside a batch only
   the first record of a (key, context) goes on; the others repeat it in full.
2. Records are dealt by key and read in order.  A key with one record has no repeat.
   Records with the same context as an earlier one repeat it in full.  Keys that keep
   several different contexts need their bytes, which are fetched from those texts only.
3. The contexts of a block of keys become one string over the pieces between
   content-defined cut points.  Its suffix array (``lyndon_suffixes``: linear grouping by
   Lyndon prefixes) with common-prefix lengths names every run of pieces; a window is
   its run's name and the few bytes left over at either end.  The first of equal
   windows stays, the others are repeats, confirmed on the bytes.
4. The spans of each text are gathered, united and cut out.

A key with more than ``HOT_CONTEXTS`` different contexts is not held in one task: its
windows are dealt one by one by their own hash and confirmed by a second one.

Defined cases: null and empty texts, and those below 100 bytes, lose nothing; equal rows
(same doc_id, same text) are one document, so none is earlier; rows with one doc_id and
different texts come in the order of a hash of the text; rows without a doc_id come
last; ids that are not integers are ordered by their values; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editsurge.llm import anchors as A
from editsurge.llm.common import cut, map_rows, mix64, shuffle_partitions, ship
from editsurge.llm.lyndon_suffixes import common_prefixes, suffix_array
from editsurge.llm.sharding import number_rows

W = A.WINDOW
#: Bits of an anchor's hash that are kept as its key.
KEY_BITS = 48
#: Different contexts of one key up to which a task holds them together.
HOT_CONTEXTS = 20_000
#: Bytes of contexts that share one suffix array (whole keys).
BLOCK_BYTES = 1 << 20
SPAN = "doc long, span long"


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) and, where doc is not the doc_id, the names (doc, doc_id).  doc is a long that
    orders the documents: the doc_id itself if it is a non-null integer of its own for each row,
    else a row number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select("doc_id", "text")
    if kind in ("bigint", "int", "smallint", "tinyint"):
        counts = ids.groupBy("doc_id").agg(F.count("*").alias("n"))
        if counts.filter("doc_id IS NULL OR n > 1").isEmpty():
            return ids.select(F.col("doc_id").cast("long").alias("doc"), "text"), None
    rows = ids.withColumn("h", F.xxhash64("text"))
    order = number_rows(rows.select(F.col("doc_id").isNull().alias("last"), "doc_id", "h").distinct(), ["last", "doc_id", "h"], "doc")
    order = order.select("doc", F.col("doc_id").alias("o_id"), F.col("h").alias("o_h"))
    named = rows.join(order, rows["doc_id"].eqNullSafe(order["o_id"]) & (rows["h"] == order["o_h"])).select("doc", "text")
    return named, order.select("doc", F.col("o_id").alias("doc_id"))


def _encode(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _pack(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A span as one long: start << 32 | length."""
    return start << 32 | (end - start)


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, packed span) with the overlapping and touching spans of a document united."""
    if not len(doc):
        return doc, start
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    # reach: the furthest end so far within the document
    shift = np.cumsum(new_doc).astype(np.int64) << 33
    reach = np.maximum.accumulate(end + shift) - shift
    fresh = new_doc | np.concatenate([[True], start[1:] > reach[:-1]])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], _pack(start[at], reach[last])


RECORD = "kind int, key long, context long, doc long, span long"


def batch_records(rows: DataFrame) -> DataFrame:
    """Kind 1: records that are the first of their context in the batch.  Kind 0: the
    united spans of those that repeat one of the batch (dealt by document)."""
    def run(batches):
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            keys, contexts, owner, starts, ends = [], [], [], [], []
            for i in range(batch.num_rows):
                key, context, _, first, last = A.records(_encode(batch.column(1)[i].as_py()))
                keys.append(key >> np.uint64(64 - KEY_BITS))
                contexts.append(context)
                owner.append(np.full(len(key), docs[i], np.int64))
                starts.append(first)
                ends.append(last + W)
            key, context, doc, start, end = map(np.concatenate, (keys, contexts, owner, starts, ends)) if keys else [np.zeros(0, np.int64)] * 5
            if not len(key):
                continue
            by = np.lexsort((start, doc, context, key))
            key, context, doc, start, end = (x[by] for x in (key, context, doc, start, end))
            same = np.concatenate([[False], (key[1:] == key[:-1]) & (context[1:] == context[:-1])])
            lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            again = same & ((doc != doc[lead]) | (start != start[lead]))     # equal rows are not earlier than each other
            gone_doc, gone = _spans(doc[again], start[again], end[again])
            zero = np.zeros(len(gone), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([1, 0], [(~again).sum(), len(gone)]).astype(np.int32)),
                 pa.array(np.concatenate([key[~again].view(np.int64), mix64(gone_doc.view(np.uint64)).view(np.int64)])),
                 pa.array(np.concatenate([context[~again].view(np.int64), zero])),
                 pa.array(np.concatenate([doc[~again], gone_doc])),
                 pa.array(np.concatenate([_pack(start, end)[~again], gone]))], names=["kind", "key", "context", "doc", "span"])

    ship(rows.sparkSession)
    return rows.select("doc", "text").mapInArrow(run, RECORD)


def compare_records(records: DataFrame, hot: int = HOT_CONTEXTS) -> DataFrame:
    """Reads records by key in order of (key, context, doc, span).  Gives (kind, doc, span,
    key): kind 0 is to go, kind 1 is the first of its context and its key has others,
    kind 2 likewise for a key with more than ``hot``."""
    def give(kind, doc, span, key):
        kinds = np.full(len(doc), kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(doc), pa.array(span), pa.array(key)],
                                          names=["kind", "doc", "span", "key"])

    def run(batches):
        held = None       # the last key's rows so far, the first of each context
        hot_key = None
        for batch in batches:
            kind, *columns = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5))
            gone = kind == 0
            if gone.any():
                yield give(0, columns[2][gone], columns[3][gone], columns[0][gone])
                columns = [c[~gone] for c in columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
                held = None
            key, context, doc, span = columns
            if not len(key):
                continue
            same = np.concatenate([[False], (key[1:] == key[:-1]) & (context[1:] == context[:-1])])
            lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            repeat = same & ((doc != doc[lead]) | (span != span[lead]))
            if repeat.any():
                yield give(0, doc[repeat], span[repeat], key[repeat])
            key, context, doc, span = (c[~same] for c in (key, context, doc, span))
            tail = key == key[-1]                # this key may go on in the next batch
            own = key[~tail]
            if len(own):
                groups = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                size = np.repeat(np.diff(np.append(groups, len(own))), np.diff(np.append(groups, len(own))))
                many = (size > hot) | ((own == hot_key) if hot_key is not None else False)
                out = (size > 1) | many
                if out.any():
                    yield give(np.where(many, 2, 1)[out], doc[~tail][out], span[~tail][out], own[out])
            held = tuple(c[tail] for c in (key, context, doc, span))
            if len(held[0]) > hot or hot_key == held[0][0]:
                # all but the last record, which the next batch's contexts are compared with
                yield give(2, held[2][:-1], held[3][:-1], held[0][:-1])
                hot_key = int(held[0][0])
                held = tuple(c[-1:] for c in held)
        if held is not None and (len(held[0]) > 1 or hot_key == held[0][0]):
            yield give(2 if hot_key == held[0][0] else 1, held[2], held[3], held[0])

    ship(records.sparkSession)
    return records.select("kind", "key", "context", "doc", "span").mapInArrow(run, "kind int, doc long, span long, key long")


def _gather(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, text, items) of the texts that have wanted records."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("key", "span")).alias("items"))   # bounded by the text
    return rows.join(lists, "doc")


def fetch_contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, doc, first, bytes) of the wanted records."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data, out = _encode(batch.column(1)[i].as_py()), []
                doc = batch.column(0)[i].as_py()
                for item in batch.column(2)[i].as_py():
                    first, length = item["span"] >> 32, item["span"] & 0xFFFFFFFF
                    out.append((item["key"], doc, first, data[first: first + length]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["key", "doc", "first", "bytes"])

    ship(rows.sparkSession)
    return _gather(rows, wanted).mapInArrow(run, "key long, doc long, first long, bytes binary")


def block_repeats(doc: np.ndarray, first: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(record, window) of the windows that equal an earlier one, found by the block's suffix array."""
    size = np.array([len(c) for c in contexts])
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    hashes = A.Hashes(data)
    cuts = A.cut_points(data)
    owner = np.searchsorted(base, cuts, side="right") - 1
    inside = cuts + 4 <= base[owner] + size[owner]            # a cut's four bytes lie in one context
    cuts, owner = cuts[inside], owner[inside]
    piece = np.flatnonzero(owner[1:] == owner[:-1]) if len(cuts) else np.zeros(0, np.int64)
    names = np.unique(hashes.of(cuts[piece], cuts[piece + 1]), return_inverse=True)[1].ravel()
    # one string: each context's separator (all different, descending), then its pieces
    n = len(contexts)
    at_piece = piece + 0
    spot = np.arange(len(piece)) + owner[piece] + 1           # position in the string
    string = np.zeros(len(piece) + n, np.int64)
    string[spot] = names + n
    gaps = np.setdiff1d(np.arange(len(string)), spot, assume_unique=True)
    string[gaps] = np.arange(n - 1, -1, -1)
    order = suffix_array(string)
    shared = common_prefixes(string, order)
    rank = np.empty(len(string), np.int64)
    rank[order] = np.arange(len(string))
    spot_of_cut = np.full(len(cuts) + 1, 0, np.int64)
    spot_of_cut[at_piece] = spot

    # windows: the first cut at or after the start, the last whose four bytes end inside
    count = size - W + 1
    record = np.repeat(np.arange(n), count)
    start = np.arange(len(record)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count) + base[record]
    lo = np.searchsorted(cuts, start)
    hi = np.searchsorted(cuts, start + W - 4, side="right") - 1
    has = lo <= hi
    left = np.where(has, cuts[np.minimum(lo, max(len(cuts) - 1, 0))] if len(cuts) else start, start + W)
    right = np.where(has, cuts[np.maximum(hi, 0)] if len(cuts) else start, start + W)
    pieces = np.where(has, hi - lo, 0)
    name = np.zeros(len(start), np.int64)
    for m in np.unique(pieces[pieces > 0]).tolist():
        which = np.flatnonzero(pieces == m)
        run = np.cumsum(shared < m)                           # suffixes that share m pieces have one number
        name[which] = run[rank[spot_of_cut[lo[which]]]]
    with np.errstate(over="ignore"):
        kind = (mix64(name.astype(np.uint64) << np.uint64(8) | pieces.astype(np.uint64))
                ^ mix64(hashes.of(start, left) + np.uint64(1)) ^ mix64(hashes.of(right, start + W) * np.uint64(3) + (left - start).astype(np.uint64)))
    begin = first[record] + start - base[record]
    by = np.lexsort((begin, doc[record], kind))
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], kind[by][1:] != kind[by][:-1]]), np.arange(len(by)), 0))
    source = by[lead]
    later = (doc[record[by]] != doc[record[source]]) | (begin[by] != begin[source])
    by, source = by[later], source[later]
    sure = np.zeros(len(by), bool)
    for k in range(0, len(by), 1 << 15):                      # the exact check, on the bytes
        x, y = start[by[k: k + (1 << 15)]], start[source[k: k + (1 << 15)]]
        columns = np.arange(W)
        sure[k: k + len(x)] = (data[x[:, None] + columns] == data[y[:, None] + columns]).all(axis=1)
    for j in np.flatnonzero(~sure).tolist():                  # a hash collision: look among all equals by their bytes
        text = data[start[by[j]]: start[by[j]] + W].tobytes()
        mine = (doc[record[by[j]]], begin[by[j]])
        same = np.flatnonzero(kind == kind[by[j]]).tolist()
        sure[j] = any((doc[record[s]], begin[s]) < mine and data[start[s]: start[s] + W].tobytes() == text for s in same)
    found = by[sure]
    return record[found], begin[found]


def compare_contexts(contexts: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """Spans of the windows that repeat, from contexts read by key; whole keys share a block."""
    def run(batches):
        keys: list[int] = []
        docs: list[int] = []
        firsts: list[int] = []
        texts: list[bytes] = []
        held = 0

        def give(n: int):
            record, begin = block_repeats(np.array(docs[:n], np.int64), np.array(firsts[:n], np.int64), texts[:n])
            doc = np.array(docs[:n], np.int64)[record]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in _spans(doc, begin, begin + W)], names=["doc", "span"])

        for batch in batches:
            for key, doc, first, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= block and key != keys[-1]:
                    yield give(len(keys))
                    keys, docs, firsts, texts, held = [], [], [], [], 0
                keys.append(key)
                docs.append(doc)
                firsts.append(first)
                texts.append(text)
                held += len(text)
        if keys:
            yield give(len(keys))

    ship(contexts.sparkSession)
    return contexts.mapInArrow(run, SPAN)


def hot_windows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Spans of repeated windows of hot keys, each window dealt by its own 128-bit hash."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                b = np.frombuffer(_encode(batch.column(1)[i].as_py()), np.uint8)
                doc, h = batch.column(0)[i].as_py(), A.Hashes(b)
                other = A.Hashes(b[::-1])
                begin = np.unique(np.concatenate([np.arange(x["span"] >> 32, (x["span"] >> 32) + (x["span"] & 0xFFFFFFFF) - W + 1)
                                                  for x in batch.column(2)[i].as_py()]))
                x, y = h.of(begin, begin + W), other.of(len(b) - begin - W, len(b) - begin)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)),
                                                  pa.array(np.full(len(begin), doc, np.int64)), pa.array(begin)],
                                                 names=["x", "y", "doc", "start"])

    ship(rows.sparkSession)
    windows = _gather(rows, wanted).mapInArrow(run, "x long, y long, doc long, start long")
    first = windows.groupBy("x", "y").agg(F.min(F.struct("doc", "start")).alias("first"))
    return (windows.join(first, ["x", "y"]).filter(F.struct("doc", "start") > F.col("first"))
                   .select("doc", F.shiftleft("start", 32).bitwiseOR(F.lit(W)).alias("span")))


def repeated_spans(rows: DataFrame, laid: DataFrame, hot: int = HOT_CONTEXTS, block: int = BLOCK_BYTES) -> DataFrame:
    """(doc, span): what is to go, packed as start << 32 | length; spans may overlap.  ``laid`` are
    the rows dealt by doc, from which contexts are fetched."""
    parts = shuffle_partitions(rows.sparkSession)
    dealt = (batch_records(rows).repartition(parts, "key")
                                .sortWithinPartitions("key", "context", "doc", "span"))
    compared = cut(compare_records(dealt, hot))
    wanted = compared.filter("kind = 1").select("doc", "key", "span")
    contexts = fetch_contexts(laid, wanted).repartition(parts, "key").sortWithinPartitions("key", "doc", "first")
    spans = compared.filter("kind = 0").select("doc", "span").unionByName(compare_contexts(contexts, block))
    crowded = compared.filter("kind = 2").select("doc", "key", "span")
    return spans if crowded.isEmpty() else spans.unionByName(hot_windows(laid, crowded))


def cut_out(data: bytes, spans: list[int]) -> tuple[bytes, int]:
    """The bytes left when spans (start << 32 | length, any order) are taken out, and the number of removed runs."""
    kept, at, runs, end = [], 0, 0, -1
    for span in sorted(spans):
        start, stop = span >> 32, (span >> 32) + (span & 0xFFFFFFFF)
        if start > end:
            runs += 1
            kept.append(data[at:start])
            end = stop
        else:
            end = max(end, stop)
        at = max(at, stop)
    kept.append(data[at:])
    return b"".join(kept), runs


def dedup(docs: DataFrame, hot: int = HOT_CONTEXTS, block: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of every row."""
    def make():
        def run(cols):
            n, gone, runs, left = [], [], [], []
            for text, spans in zip(cols[1], cols[2]):
                data = _encode(text)
                kept, k = cut_out(data, spans or [])
                n.append(len(data))
                gone.append(len(data) - len(kept))
                runs.append(k)
                left.append(kept)
            return [cols[0], n, gone, runs, left]
        return run

    return map_rows(_with_spans(docs, hot, block), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                    "n_bytes long, n_removed long, n_spans long, kept binary", make)


def _with_spans(docs: DataFrame, hot: int, block: int) -> DataFrame:
    """(doc_id, text, spans): each text with its packed spans.  Contexts are fetched from, and spans
    joined to, one exchange of the texts: both read the same two columns of it."""
    rows, names = numbered(docs)
    laid = rows.filter("doc IS NOT NULL").repartition("doc")   # none is null; said here, both joins plan the same exchange
    of_doc = repeated_spans(rows, laid, hot, block).groupBy("doc").agg(F.collect_list("span").alias("spans"))
    found = laid.join(of_doc, "doc", "left")
    if names is None:
        return found.select(F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "spans")
    return found.join(names, "doc").select("doc_id", "text", "spans")


def digest(docs: DataFrame, hot: int = HOT_CONTEXTS, block: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; the kept bytes do not leave the task."""
    def make():
        def run(cols):
            out = []
            for text, spans in zip(cols[1], cols[2]):
                data = _encode(text)
                kept, k = cut_out(data, spans or [])
                out.append((len(data), len(data) - len(kept), k, hashlib.sha256(kept).hexdigest()))
            return [cols[0], *([x[i] for x in out] for i in range(4))]
        return run

    return map_rows(_with_spans(docs, hot, block), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                    "n_bytes long, n_removed long, n_spans long, kept_sha256 string", make)
