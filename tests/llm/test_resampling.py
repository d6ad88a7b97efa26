"""Importance resampling: batched features and drawn rows against a plain computation."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from editsurge.llm import resampling

TEXTS = ["The cat sat. THE END", "", None, "é\U0001f600 x", "no\x00break", "\n\n", "tail ", " head", "中文 文本 İ", "a" * 300, "word " * 5000]


def plain(text, most=1):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("most, size", [(1, 1 << 20), (2, 1 << 20), (3, 20), (3, 1)])
def test_batch_features(most, size):
    places = resampling.Places(97)
    got = []
    for part in resampling.batches(TEXTS, size):
        place, owner, words = resampling.features(part, places, most)
        got += [(Counter(place[owner == k].tolist()), int(words[k])) for k in range(len(part))]
    assert got == [(Counter(zlib.crc32(f.encode()) % 97 for f in plain(t, most)[1]), len(plain(t, most)[0])) for t in TEXTS]


def brute(docs, target):
    s, t = ([0] * 10_000 for _ in range(2))
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in plain(text)[1]:
                counts[zlib.crc32(f.encode()) % 10_000] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = plain(text)
        w = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    out = [tuple(r[:4]) + (k + 1,) for k, r in enumerate(able[:10 * len(able) // 100])]
    return out + [tuple(r[:4]) + (None,) for r in able[len(out):]] + [tuple(r[:4]) + (None,) for r in rows if r[4] < 20]


def test_equal_to_brute_force(docs_of, spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["Red", "green", "blue", "sky", "é", f"w{rng.randrange(99)}"]) for _ in range(rng.randrange(60))))
            for i in range(150)]
    rows += [(None, "word " * 30), (7, "same text " * 20), (7, "same text " * 20), (200, None), (201, ""), (202, "long " * 50_000)]
    target = ["red sky", None, "", "Blue sky at night " * 3]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in resampling.digest(docs_of(rows, extra=True), bench).collect()), key=repr)
    assert got == sorted(brute(rows, target), key=repr)
    again = sorted((tuple(r) for r in resampling.digest(docs_of(rows[::-1]).repartition(7), bench).collect()), key=repr)
    assert got == again


def test_empty_tables(docs_of, spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.digest(docs_of([]), none).count() == 0
    rows = [(1, "one two"), (2, None)]
    assert sorted((tuple(r) for r in resampling.digest(docs_of(rows), none).collect()), key=repr) == sorted(brute(rows, []), key=repr)


def test_draws_what_is_like_the_target(docs_of, spark):
    rng = np.random.default_rng(3)
    near = [(i, " ".join(rng.choice(["court", "law", "judge", "appeal"], 30))) for i in range(0, 400, 20)]
    far = [(i, " ".join(rng.choice(["ball", "goal", "team", "score"], 30))) for i in range(400) if i % 20]
    bench = spark.createDataFrame([("the law of the court and the judge",)], "text string")
    got = resampling.resample(docs_of(near + far), bench, percent=5).filter("rank is not null").collect()
    assert len(got) == 20 and {r.doc_id for r in got} == {i for i, _ in near}
