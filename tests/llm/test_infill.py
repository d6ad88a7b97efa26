"""Fill-in-middle: parts and marks against plain slicing, exact round trip, odd inputs."""
import hashlib

from editsurge.llm import infill

ROWS = [(i, "aé\U0001f600z\n" * (i % 7) + "x" * i) for i in range(60)] + [
    (100, ""), (101, None), (None, None), (None, "no id"), (102, "has <P> inside"), (103, "<M>"), (104, "ends with <S"),
    (105, "<S" * 40 + "<P" * 30 + "<M" * 20), (106, "a" * 400_000), (107, "\n\r\n\x00 " * 9), (7, "again"), (7, "again"), (108, "$1 \\2 {3}")]


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def test_equal_to_slicing_and_back(docs_of):
    df = infill.transform(docs_of(ROWS, extra=True))
    got = df.select("doc_id", "n", "form", "prefix_units", "middle_units", "output",
                    infill.restore(df.output, df.form).alias("back"), "text").collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((brute(*r) for r in ROWS), key=repr)
    assert all(r.back == r.text for r in got) and {r.form for r in got} == {"plain", "spm", "psm"}


def test_digest(docs_of):
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = infill.digest(docs_of(ROWS)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(
        ((*(b := brute(i, t))[:5], sha(b[5]), sha(t)) for i, t in ROWS), key=repr)
    assert infill.digest(docs_of([])).count() == 0


def test_other_units(docs_of):
    """Cuts fall between lines; an unfinished line at the end counts to the suffix."""
    rows = [(i, "one\ntwo\n\nthree\n" * 4 + "rest") for i in range(40)]
    df = infill.transform(docs_of(rows), unit="[^\\n]*+\\n")
    got = df.select("*", infill.restore(df.output, df.form).alias("back")).collect()
    assert {r.n for r in got} == {16} and all(r.back == r.text for r in got)
    cut = [r for r in got if r.form == "psm"]
    lines = rows[0][1].splitlines(keepends=True)
    assert cut and all(r.output.startswith("<P>" + "".join(lines[:r.prefix_units]) + "<S>") for r in cut)
    assert all(r.output.endswith("<M>" + "".join(lines[r.prefix_units:r.prefix_units + r.middle_units])) for r in cut)
    assert len({(r.prefix_units, r.middle_units) for r in cut}) > 10


def test_no_python_in_the_plan(docs_of):
    plan = infill.digest(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
