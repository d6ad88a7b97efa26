"""I-Match fingerprints against a plain computation, likeness of edits, odd inputs."""
import hashlib
import random
import re
from collections import Counter

from editsurge.llm import imatch


def words(text):
    return set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text)))


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute(rows, rare, common):
    rows = [(i, t or "") for i, t in rows]
    df = Counter(w for _, t in rows for w in words(t))
    lexicon = {w for w, n in df.items() if n * rare >= len(rows) and n * common <= len(rows)}

    def entries(text):
        subsets = {}
        for code in sorted(md5("1:" + w)[:16] for w in words(text) & lexicon):
            subsets[code[:2]] = subsets.get(code[:2], "") + code
        return [k + md5(v)[:6] for k, v in sorted(subsets.items())]

    def mark(text):
        return ".".join(entries(text)) or "=" + hashlib.sha256(text.encode()).hexdigest()

    def near(a, b):
        x, y = set(entries(a)), set(entries(b))
        if mark(a) == mark(b):
            return 1.0
        return len(x & y) / len({e[:2] for e in x | y}) if x | y else 0.0

    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1])), reverse=True)
    after = {r: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    out = []
    for i, t in rows:
        k, nxt = len(t) // 3, after[i, t]
        new = t[:len(t) - k] + nxt[:k]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), mark(t), mark(new), near(t, new), near(t, nxt)))
    return sorted(out, key=repr)


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["Über", "naïve", "\U0001f600", "中文"]
    rows = [(3 * i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(80))).capitalize() + " the end.") for i in range(120)]
    copy = rows[5][1]
    return rows + [(i, copy) for i in range(1000, 1010)] + [
        (None, None), (None, "no id w1 w2"), (7, "w3 w4"), (7, "w3 w4"), (7, "w5 other"), (500, ""), (501, None), (502, "w6 " * 40_000), (503, "...")]


def check(got, want):
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_equal_to_brute_force(docs_of):
    rows = corpus()
    want = brute(rows, 100, 4)
    assert any(0 < r[5] < 1 for r in want) and any(r[6] for r in want)
    check(imatch.digest(docs_of(rows, extra=True), 100, 4), want)


def test_a_lexicon_too_large_to_broadcast_gives_the_same(docs_of):
    rows = corpus(4)
    check(imatch.digest(docs_of(rows).repartition(5), 100, 4, broadcast_terms=3), brute(rows, 100, 4))


def test_likeness_tells_edits_from_neighbours(docs_of):
    got = imatch.digest(docs_of(corpus()[:120]), 100, 4).collect()
    edits = [r.near_edited for r in got if r.n_chars > 150]
    others = [r.near_next for r in got if r.n_chars > 150]
    assert min(edits) > max(others) and sum(edits) / len(edits) > 0.3


def test_one_document_no_document_and_no_lexicon(docs_of):
    assert imatch.digest(docs_of([])).count() == 0
    check(imatch.digest(docs_of([(1, "abc def")])), brute([(1, "abc def")], imatch.RARE, imatch.COMMON))
    rows = [(1, "only here"), (2, "or there"), (3, "only here")]
    got = {r.doc_id: r for r in imatch.digest(docs_of(rows)).collect()}
    assert got[1].fingerprint == got[3].fingerprint != got[2].fingerprint and got[2].near_next == 0.0


def test_no_python_in_the_plan(docs_of):
    plan = imatch.digest(docs_of([(1, "x y"), (2, "y z")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
