"""Near-duplicate groups by HyperMinHash sketches, banding and verification.

A document's set holds its distinct 5-word shingles; two documents are linked
if 100 * |intersection| >= 85 * |union|, which is confirmed on the full sets.
Groups are the connected components of all links.

1. ``facts``: set size, 128-bit set signature and 128 registers of each row (one pass).
2. Rows with equal sets form a class; its node is the smallest doc_id.  From here
   on only classes count, so a group of copies costs one row.
3. Bands: 32 keys of four registers a class.  In each key every class is paired
   with the key's smallest class; a class keeps the partner it shares most keys with.
   These pairs (one a class) are estimated, verified and joined into components.
4. Classes that still share a key with a plausible partner of another component are
   looked at closely: how many of a class's shingles does no other such class have?
   None of them can be in an intersection, which bounds every link exactly.  The
   class with the fewest of its own is what a group's copies were made from, its hub;
   each class is compared with that of its keys, which links it or bounds it further.
5. Keys that hold several components even then give all pairs across components
   that sizes, own shingles and low register bits allow.  Estimate, verify, join.
   So every banded pair is inside a component, excluded by a bound, or looked at.

Steps 3 and 4 keep the pairs of a large group linear in its size; step 5 makes the
result the same as checking all pairs.  An estimate is collision-corrected; a pair goes on
to verification if it is above ``LEAST_ESTIMATE``, over five deviations below 0.85.

Defined cases: null, empty and wordless texts have size 0 and are alone; fewer
than five words count as one shingle; rows with one doc_id are one document, linked
by any of its texts; rows without a doc_id belong to the component of their equal
sets (none: null); ties go to the smallest doc_id; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editsurge.llm import minhash_kernel as K
from editsurge.llm.common import cut, fresh_name, map_rows, mix64, ship
from editsurge.llm.shingles import shingle_set

LINK_PERCENT = 85
LEAST_ESTIMATE = 0.62
#: Documents up to whose number a list of ids is broadcast to the scan of the texts.
BROADCAST_IDS = 500_000
#: Deviations allowed for the number of low bits in which the sketches of a link differ.
BIT_DEVIATIONS = 6


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, n, sig_a, sig_b, regs of every row."""
    def make():
        def run(cols):
            n, a, b, regs = [], [], [], []
            for text in cols[1]:
                s = shingle_set(text)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    a.append(int(mix64(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    b.append(int(mix64(s + np.uint64(0x89ABCDEF)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                regs.append(K.registers(s).tobytes() if len(s) else None)
            return [cols[0], n, a, b, regs]
        return run

    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id {_kind(docs)}, n long, sig_a long, sig_b long, regs binary", make)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of registers from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, K.BUCKETS)


def bands(classes: DataFrame) -> DataFrame:
    """(key, node) of every band that has a register."""
    kind = classes.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys, some = K.band_keys(_matrix(part.column(1)))
                row, _ = np.nonzero(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some].view(np.int64)), part.column(0).take(pa.array(row))], names=["key", "node"])

    ship(classes.sparkSession)
    return classes.select("node", "regs").mapInArrow(run, f"key long, node {kind}")


def shared_keys(classes: DataFrame) -> DataFrame:
    """(key, node, a): the bands that several classes share; a is the key's smallest class.
    Most bands belong to one class, so what follows is small."""
    rows = bands(classes)
    centers = rows.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size")).filter("size > 1")
    return cut(rows.join(centers.select("key", "a"), "key"))


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): for each class b the smallest class of a key, of the key's that b shares most keys with."""
    met = shared.filter(F.col("a") < F.col("node")).groupBy(F.col("node").alias("b"), "a").count()
    best = met.groupBy("b").agg(F.max(F.struct("count", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def low_bits(classes: DataFrame) -> DataFrame:
    """(node, n, l0 .. l3): two bits of every register."""
    kind = classes.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words = np.ascontiguousarray(K.low_bits(_matrix(batch.column(2))).T) if batch.num_rows else np.zeros((4, 0), np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(w.view(np.int64)) for w in words)],
                                             names=["node", "n", "l0", "l1", "l2", "l3"])

    ship(classes.sparkSession)
    return classes.select("node", "n", "regs").mapInArrow(run, f"node {kind}, n long, l0 long, l1 long, l2 long, l3 long")


def most_bits(total: Column) -> Column:
    """How many of the 256 low bits may differ in a link of sets whose sizes add up to
    ``total``.  A link's sets differ in at most 0.15 / 1.85 of ``total`` elements, each of which
    changes one register or none and so two bits or fewer: that bound is certain.  For large
    sets the expected number is smaller: 15 % of the registers in use, one bit each."""
    certain = 2 * 0.15 / 1.85 * total
    changed = 0.15 * K.BUCKETS * (1 - F.exp(-total / 1.85 / K.BUCKETS))
    return F.least(certain, changed + BIT_DEVIATIONS * F.sqrt(1.5 * changed) + 2)


def open_keys(shared: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label, n, step, l0 .. l3): the rows of keys that hold several components.
    Sizes are cut in steps of a little over 1/0.85, so that a link's larger set is in
    the same step or the next."""
    rows = shared.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    kept = cut(rows.join(mixed, "key"))
    facts_of = low_bits(classes.join(kept.select("node").distinct(), "node", "left_semi"))
    return cut(kept.join(facts_of, "node").withColumn("step", F.floor(F.log("n") / float(np.log(1 / 0.845))).cast("int")))


def _sides(rows: DataFrame, steps: list[int]) -> tuple[DataFrame, DataFrame]:
    """The rows as the smaller set (a_) and, at their step minus each of ``steps``, as the other (b_)."""
    kept = [c for c in ("node", "n", "label", "own", "hub", "in_hub", "rest", "l0", "l1", "l2", "l3") if c in rows.columns]
    named = lambda x: [F.col(c).alias(f"{x}_{c}") for c in kept]
    other = rows.select("key", F.explode(F.array(*[F.col("step") - k for k in steps])).alias("step"), *named("b"))
    return rows.select("key", "step", *named("a")), other


def _plausible() -> Column:
    """Whether two classes of different components may be linked, by sizes and low bits."""
    differing = sum((F.bit_count(F.col(f"a_l{i}").bitwiseXOR(F.col(f"b_l{i}"))) for i in range(1, 4)),
                    F.bit_count(F.col("a_l0").bitwiseXOR(F.col("b_l0"))))
    return ((F.col("a_label") != F.col("b_label"))
            & (100 * F.least("a_n", "b_n") >= LINK_PERCENT * F.greatest("a_n", "b_n"))
            & (differing <= most_bits(F.col("a_n") + F.col("b_n"))))


def live_keys(rows: DataFrame) -> DataFrame:
    """The rows of ``open_keys`` that have a plausible partner in their key (a semi-join: no pairs are made)."""
    a, b = _sides(rows, [0, 1, -1])
    found = a.join(b, (a["key"] == b["key"]) & (a["step"] == b["step"]) & _plausible(), "left_semi")
    nodes = found.select(F.col("a_node").alias("node")).distinct()
    return cut(rows.join(nodes, "node", "left_semi"))


def own_shingles(rows: DataFrame, docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(node, own): how many of a class's shingles no other class of ``rows`` has; 0 for a
    doc_id with several texts."""
    kind = _kind(docs)
    nodes = rows.select(F.col("node").alias("doc_id")).join(repeated, "doc_id", "left_anti")

    def run(batches):
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                items = shingle_set(text)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(items), batch.schema.field(0).type),
                                                  pa.array(items.view(np.int64))], names=["node", "shingle"])

    ship(docs.sparkSession)
    items = texts_of(nodes, docs).mapInArrow(run, f"node {kind}, shingle long")
    single = items.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1")
    return single.groupBy("node").agg(F.count("*").alias("own"))


def nearest_hubs(rows: DataFrame) -> DataFrame:
    """(node, hub): the class of a key that has the fewest shingles of its own, of a
    class's keys the one that it shares most keys with.  A hub may be its own."""
    hubs = rows.groupBy("key").agg(F.min(F.struct("own", "node")).alias("hub"))
    met = (rows.join(hubs, "key")
               .groupBy("node", F.col("hub.own").alias("own"), F.col("hub.node").alias("hub")).count())
    best = met.groupBy("node").agg(F.max(F.struct("count", -F.col("own"), "hub")).alias("best"))
    return best.select("node", F.col("best.hub").alias("hub"))


def with_hub_overlap(rows: DataFrame, hubs: DataFrame, sizes: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with ``hub``, ``in_hub`` (shingles that a class shares with its hub) and ``rest`` (those
    that it shares neither with the hub nor has for itself); null for a doc_id with several texts."""
    known = (hubs.filter("node <> hub").withColumn("a", F.least("node", "hub")).withColumn("b", F.greatest("node", "hub"))
                 .join(sizes.select("a", "b", "both"), ["a", "b"]).select("node", "hub", F.col("both").alias("in_hub")))
    for side in ("node", "hub"):
        known = known.join(repeated.select(F.col("doc_id").alias(side)), side, "left_anti")
    return (rows.join(known, "node", "left")
                .withColumn("rest", F.col("n") - F.col("in_hub") - F.col("own")))


def cross_pairs(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): pairs of one key that lie in different components and may be linked.  An
    intersection holds no shingle that a class has for itself, so it is at most the
    smaller number of others.  Where both have one hub, it is at most the smaller
    part in the hub plus the smaller part that is neither in it nor own."""
    now = (rows.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    mixed = now.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    small, large = _sides(now.join(mixed, "key"), [0, 1])
    others = F.least(F.col("a_n") - F.col("a_own"), F.col("b_n") - F.col("b_own"))
    through = F.least("a_in_hub", "b_in_hub") + F.least("a_rest", "b_rest")
    most = F.when(F.col("a_hub") == F.col("b_hub"), F.least(others, through)).otherwise(others)
    ordered = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_node") < F.col("b_node")))
    met = small.join(large, (small["key"] == large["key"]) & (small["step"] == large["step"]) & ordered & _plausible()
                     & (100 * most >= LINK_PERCENT * (F.col("a_n") + F.col("b_n") - most)))
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose corrected estimate reaches ``LEAST_ESTIMATE``."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    kind = classes.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                j = K.estimate(_matrix(part.column(4)), _matrix(part.column(5)),
                               part.column(2).to_numpy().astype(float), part.column(3).to_numpy().astype(float))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(j)],
                                                 names=["a", "b", "estimate"]).filter(pa.array(j >= LEAST_ESTIMATE))

    ship(classes.sparkSession)
    return rows.mapInArrow(run, f"a {kind}, b {kind}, estimate double").select("a", "b").distinct()


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the wanted ids.  A counted list of at most BROADCAST_IDS goes to the
    scan, so that no text is exchanged for it; a longer one is joined by id."""
    wanted = cut(ids.select("doc_id").distinct())
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    return docs.select("doc_id", "text").join(side, "doc_id", "left_semi")


def overlaps(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, both, n_a, n_b): the intersection and the sizes of the full sets of each pair.
    Only texts of documents in a pair are read again."""
    kind = _kind(docs)
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))

    def make():
        return lambda cols: [cols[0], [shingle_set(t).tobytes() for t in cols[1]]]

    sets = cut(map_rows(texts_of(wanted, docs), f"node {kind}, items binary", make).filter(F.length("items") > 0))
    rows = (pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
                 .join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a"))

    def check():
        def run(cols):
            both, n_a, n_b = [], [], []
            for x, y in zip(cols[2], cols[3]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                n_a.append(len(x))
                n_b.append(len(y))
            return [cols[0], cols[1], both, n_a, n_b]
        return run

    return map_rows(rows.select("a", "b", "items_a", "items_b"), f"a {kind}, b {kind}, both long, n_a long, n_b long", check)


def linked(sizes: DataFrame) -> DataFrame:
    """(a, b) of the ``overlaps`` that are links."""
    return sizes.filter(100 * F.col("both") >= LINK_PERCENT * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b").distinct()


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are linked."""
    return linked(overlaps(pairs, docs))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for every node
    of an edge.  Each round takes the least label among the neighbours and then the
    label's own label, so paths halve; rounds are written to the shared folder."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("far"))
        found = cut(step.join(jump, "least").select("node", F.least("least", "far").alias("new"), "label"))
        labels = found.select("node", F.col("new").alias("label"))
        if found.filter("new < label").isEmpty():
            return labels


def group(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = cut(facts(docs))
    classes = cut(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("sig_a", "sig_b", "n")
                      .agg(F.min("doc_id").alias("node"), F.first("regs").alias("regs")))
    # a doc_id with several texts is one document: its classes are linked through it
    members = rows.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "sig_a", "sig_b")
    repeated = members.distinct().groupBy("doc_id").count().filter("count > 1").select("doc_id")
    own = (members.join(repeated, "doc_id", "left_semi").distinct()
                  .join(classes.select("sig_a", "sig_b", "node"), ["sig_a", "sig_b"])
                  .filter("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    shared = shared_keys(classes)
    star = cut(own.union(verified(cut(estimated(star_pairs(shared), classes)), docs)))
    labels = components(star)
    live = live_keys(open_keys(shared, classes, labels))
    if not live.isEmpty():
        live = cut(live.join(own_shingles(live, docs, repeated), "node", "left").withColumn("own", F.coalesce("own", F.lit(0))))
        hubs = cut(nearest_hubs(live))
        to_hub = hubs.filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        sizes = cut(overlaps(to_hub, docs))
        star = cut(star.union(linked(sizes)))
        labels = components(star)
        crossing = cut(estimated(cross_pairs(cut(with_hub_overlap(live, hubs, sizes, repeated)), labels), classes))
        if not crossing.isEmpty():
            labels = components(star.union(verified(crossing, docs)))
    of_class = (classes.select("sig_a", "sig_b", "n", "node").join(labels, "node", "left")
                       .select("sig_a", "sig_b", "n", F.coalesce("label", "node").alias("component")))
    return (rows.select("doc_id", "n", "sig_a", "sig_b").join(of_class, ["sig_a", "sig_b", "n"], "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
                .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of ``docs``, all columns: the one whose doc_id names the
    group (of repeated rows with that id, one).  Rows without a doc_id that have no
    group stay."""
    copies = fresh_name(docs, "_copies")
    kept = group(docs).filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias(copies))
    joined = docs.join(kept, "doc_id")
    once = joined.filter(F.col(copies) == 1).select(*docs.columns)
    many = joined.filter(F.col(copies) > 1).select(*docs.columns).dropDuplicates(["doc_id"])
    return once.unionByName(many).unionByName(docs.filter("doc_id IS NULL").select(*docs.columns))
