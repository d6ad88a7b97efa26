"""Items in unspaced scripts; brute force with the question and answer conditions; parts by words."""
import random

from editsurge.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def brute(docs, items):
    """Passages that end or start anywhere: an item's best window of twice its length class, at every word."""
    out = set()
    for d, text in docs:
        w = dc.words(text)
        for i, item in items:
            x = dc.words(item)
            if len(x) < dc.SHINGLE:
                continue
            grams = {tuple(x[k:k + 5]) for k in range(len(x) - 4)}
            q, a = map(set, dc.question_and_answer(item))
            size = 1 << max(3, (len(x) - 1).bit_length())
            for at in range(0, max(1, len(w)), size):
                p = w[at:at + 2 * size]
                have, seen = set(p), {tuple(p[k:k + 5]) for k in range(len(p) - 4)}
                if (len(grams & seen) >= dc.CONTAINED * len(grams) and len(q & have) >= dc.PART * len(q)
                        and len(a & have) >= dc.PART * len(a)):
                    out.add((d, i))
    return out


def test_equal_to_brute_force_with_question_and_answer(spark, docs_of):
    rng = random.Random(8)
    say = lambda n, v=400: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    items = [(i, f"{say(rng.choice([8, 20, 45]))}? {say(rng.choice([1, 3, 12]))}.") for i in range(50)]
    docs = []
    for i, text in items[:40]:
        words = text.split()
        kind = i % 4
        if kind == 1:                       # the answer is changed
            words[-1] = "other."
        elif kind == 2:                     # some words of the question are changed
            for k in rng.sample(range(len(words)), max(1, len(words) // 8)):
                words[k] = "x"
        elif kind == 3:                     # only the question
            words = dc.question_and_answer(text)[0]
        docs.append((i, f"{say(rng.randrange(200))} {' '.join(words)} {say(rng.randrange(200))}"))
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs_of(docs), spark.createDataFrame(items, ITEMS)).collect()}
    want = brute(docs, items)
    assert got == want and {i for i, _ in want} >= set(range(0, 40, 4)) and len(want) < len(docs)


def test_unspaced_scripts(spark, docs_of):
    items = [(1, "世界上最高的山峰叫什么名字？珠穆朗玛峰。"), (2, "ประเทศไทยมีเมืองหลวงชื่ออะไร กรุงเทพมหานคร"), (3, "一番長い川は何ですか。ナイル川です。"),
             (4, "短い"), (5, "what is 世界 the name of it")]
    docs = [(10, f"前言。{items[0][1]}后记和更多的文字。"), (11, f"ก่อน {items[1][1]} หลัง"), (12, items[2][1]), (13, "世界上最长的河流叫什么名字？尼罗河。"),
            (14, "短い文章"), (15, "WHAT is 世 界 the name of it")]
    leaks = dc.find_leaks(docs_of(docs), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in leaks} == {(10, 1), (11, 2), (12, 3), (15, 5)}
    assert dc.words("Abc déf中文xy_1 ナイル") == ["abc", "déf", "中", "文", "xy_1", "ナ", "イ", "ル"]


def test_parts_by_words(spark):
    items = spark.createDataFrame([(i, "some words of a rather long item here " * 5 + str(i)) for i in range(40)], ITEMS)
    parts = dc.indexes(items, part_words=1000)
    assert len(parts) > 2 and sorted(x.item_id for p in parts for x in p.value.items) == list(range(40))
