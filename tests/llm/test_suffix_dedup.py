"""Removal of repeated 100-byte strings against a set of all windows seen so far."""
import hashlib
import random

import numpy as np

from editsurge.llm import suffix_dedup as sd
from editsurge.llm.lyndon_suffixes import common_prefixes, suffix_array


def noise(seed, n):
    return "".join(random.Random(seed).choices("abcdef", k=n))


def brute(rows):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\x01" * 100
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def planted():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ij") for _ in range(2500))

    def mutated(s, k):
        s = list(s)
        for _ in range(k):
            s[rng.randrange(len(s))] = rng.choice("xyzé")
        return "".join(s)

    rows = [(i, mutated(base[rng.randrange(500):rng.randrange(600, 2500)], rng.randrange(8))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "a" * 4000), (103, "ab" * 700), (104, "a" * 99), (105, "a" * 100), (106, base), (107, base + base)]
    rows += [(300 + i, base[1000:1130] + f" tail {i} " + "".join(rng.choice("qwerty") for _ in range(60))) for i in range(60)]
    return rows


def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_suffix_array_by_lyndon_groups():
    rng = np.random.default_rng(1)
    for _ in range(800):
        s = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(0, 40))
        order, text = suffix_array(s), s.tolist()
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        for r, n in enumerate(common_prefixes(s, order).tolist()):
            if r:
                a, b = text[order[r - 1]:], text[order[r]:]
                assert a[:n] == b[:n] and a[n:n + 1] != b[n:n + 1]


def test_planted_repeats(docs_of):
    rows = planted()
    want = as_sorted(brute(rows))
    assert as_sorted(sd.digest(docs_of(rows, extra=True)).collect()) == want
    assert as_sorted(sd.digest(docs_of(rows), hot=5).collect()) == want        # windows dealt one by one
    assert as_sorted(sd.digest(docs_of(rows), block=2000).collect()) == want   # many suffix arrays


def test_repeated_rows_and_missing_ids(docs_of):
    long = noise(1, 400)
    rows = [(1, long), (1, long), (2, "x" + long), (None, "y" + long), (None, None)]
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans) for r in sd.digest(docs_of(rows)).collect()}
    assert got == {(1, 400): (0, 0), (2, 401): (400, 1), (None, 401): (400, 1), (None, 0): (0, 0)}


def test_empty_table_and_kept_bytes(docs_of):
    assert sd.digest(docs_of([])).count() == 0
    long = noise(2, 150)
    kept = {r.doc_id: bytes(r.kept).decode() for r in sd.dedup(docs_of([(1, long), (2, "head " + long + " tail")])).collect()}
    assert kept == {1: long, 2: "head  tail"}


def test_string_ids(spark):
    long = noise(4, 150)
    df = spark.createDataFrame([("b", long), ("a", long)], "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in sd.digest(df).collect()} == {"a": 0, "b": 150}
