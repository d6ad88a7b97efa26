"""BPE against the tokenizers library: ids, digests and the round trip."""
import hashlib
import random
import struct

import public_tokenizers
from tokenizers import Tokenizer

from editsurge.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "don't I'll 1234 ½ ²x", "a <|endoftext|><|endoftext|>b", "\x1c\x1f \x85  x  y\n\n z ",
         "日本語 テスト \U0001f600\U0001f600 жил", "a" * 3000 + " " * 500 + "b", "ab" * 3000 + "é" * 999, "ſK" * 9,
         "x" * 100_000, "word " * 20_000]


def library(texts):
    t = Tokenizer.from_file(PATH)
    out = []
    for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False):
        out.append((e.ids, t.decode(e.ids, skip_special_tokens=False)))
    return out


def test_codec_equals_the_library():
    c = bpe.Codec(open(PATH, "rb").read())
    rng = random.Random(5)
    texts = TEXTS + ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD000), rng.randrange(9, 33)]))
                             for _ in range(rng.randrange(120))) for _ in range(150)]
    for text, (ids, decoded) in zip(texts, library(texts)):
        packed = c.encode(text or "")
        assert packed == struct.pack(f"<{len(ids)}I", *ids), repr(text)[:80]
        assert c.decode(packed) == decoded


def test_forced_cuts_are_never_inside_a_token():
    c = bpe.Codec(open(PATH, "rb").read())
    data = "the éè zqßx".encode()
    assert b"".join(c.fragments(data)) == data
    for token in list(c.ids)[::500]:
        assert c.fragments(token) == [token]
    long = bytes(range(97, 123)) * 20
    assert c.merge(long) == c._merge_long([c.first[b] for b in long])


def test_digest_of_a_table(docs_of):
    rows = [*enumerate(TEXTS), (3, "a"), (None, "no id")]
    got = sorted(tuple(r) for r in bpe.digest(docs_of(rows, extra=True)).collect() if r.doc_id is not None)
    want = []
    for (i, _), (ids, decoded) in zip(rows, library([t for _, t in rows])):
        if i is not None:
            want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digest(docs_of([])).count() == 0
    decoded = {r.doc_id: r.decoded for r in bpe.encode_documents(docs_of([(1, "a b"), (2, None)])).collect()}
    assert decoded == {1: "a b", 2: ""}
