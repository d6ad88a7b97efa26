"""Near-duplicate groups against all pairs of full shingle sets."""
import random
import re

import numpy as np

from editsurge.llm import minhash, minhash_kernel as K
from editsurge.llm.shingles import shingle_set

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_shingle_sets_have_the_right_size():
    texts = ["", " \t\n", "one", "One  two three", "a b c d e", "A b C d e f", "É é É é É é x", " lead a b c d e a b c d e ", "w" * 5000]
    for t in texts:
        assert len(shingle_set(t)) == len(shingles(t)), repr(t)[:40]
    assert shingle_set("One TWO three").tolist() == shingle_set(" one two\tthree").tolist()
    assert shingle_set("É two").tolist() != shingle_set("é two").tolist()
    assert len(shingle_set(None)) == 0


def test_estimates_are_close():
    rng = np.random.default_rng(0)
    x, y, n, m, true = [], [], [], [], []
    for _ in range(200):
        size, share = int(rng.integers(5, 3000)), rng.random()
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        b = np.concatenate([a[: int(size * share)], rng.integers(0, 1 << 63, size - int(size * share), dtype=np.uint64)])
        x.append(K.registers(np.unique(a)))
        y.append(K.registers(np.unique(b)))
        n.append(size)
        m.append(size)
        true.append(int(size * share) / (2 * size - int(size * share)))
    found = K.estimate(np.stack(x), np.stack(y), np.array(n, float), np.array(m, float))
    assert np.abs(found - true).mean() < 0.04
    assert np.abs(found - true).max() < 0.25


def test_groups_equal_brute_force(docs_of):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 30, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((i, " ".join(w)))
            i += 1
    # a chain whose ends are not linked, a common line, copies, empty texts
    chain = [f"c{k}" for k in range(60)]
    rows += [(500 + k, " ".join(chain[k:k + 50])) for k in range(0, 10, 2)]
    rows += [(600 + k, "the same common line of words here " + " ".join(rng.choice(vocabulary) for _ in range(6))) for k in range(40)]
    rows += [(700 + k, "copy of one text with seven words") for k in range(30)] + [(800, None), (801, ""), (802, " \n"), (803, "x " * 30_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.group(docs_of(rows, extra=True)).collect()}
    assert got == brute(rows)


def test_repeated_and_missing_ids(docs_of):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (1, "other words that are not alike at all"), (2, "other words that are not alike at all"), (None, text), (None, "alone here")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.group(docs_of(rows)).collect()), key=repr)
    assert got == sorted([(1, 1, True)] * 3 + [(2, 1, False), (None, 1, False), (None, None, True)], key=repr)
    kept = minhash.keep_one(docs_of(rows, extra=True))
    assert kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 2").count() == 0
    assert kept.columns == docs_of([], extra=True).columns
    assert minhash.group(docs_of([])).count() == 0
