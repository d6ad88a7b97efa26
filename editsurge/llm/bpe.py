"""Byte-pair encoding and decoding with forced-boundary splitting.

A byte pair (a, b) that occurs inside no vocabulary token is a certain cut:
every merge yields a vocabulary token, so none can ever cross it.  Together
with the pre-tokenizer's boundaries these cuts split a text into fragments
that are encoded independently; the ids are concatenated.  The vocabulary is
a file of fixed size, sent once to each task as its raw bytes.

Defined cases: a null or empty text has no ids and decodes to the empty text;
the special token's string inside a text is its own id; repeated rows are
encoded once each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from editsurge.llm.common import map_rows

# Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies, with \p{L} and
# \p{N} written for texts without the characters of RARE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Characters that ``re`` classes otherwise than the tokenizer (separators, superscripts,
#: fractions) or that lie beyond Latin letters, where Unicode tables may differ: texts
#: with one are cut by the library's own pre-tokenizer.
RARE = "[\x1c-\x1f²³¹¼-¾ɐ-\U0010ffff]"
#: Pre-tokens remembered by a worker in each of two generations.
MEMO = 250_000
NO_RANK = 1 << 62


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one vocabulary (raw JSON of the file)."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        to_byte = {c: b for b, c in byte_letters().items()}
        as_bytes = lambda s: bytes(to_byte[c] for c in s)
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = as_bytes(a), as_bytes(b)
            self.rank[self.ids[a], self.ids[b]] = n
            self.merged.append(self.ids[a + b])
        self.inside = {pair for b in self.ids for pair in zip(b, b[1:])}
        self.inside_table = np.zeros(65536, dtype=bool)
        self.inside_table[[x << 8 | y for x, y in self.inside]] = True
        self.first = [self.ids[bytes([b])] for b in range(256)]
        self.find, self.rare = re.compile(PRETOKEN).findall, re.compile(RARE).search
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self._library = None

    def pretokens(self, text: str) -> list[str]:
        if not self.rare(text):
            return self.find(text)
        if self._library is None:
            from tokenizers.pre_tokenizers import ByteLevel
            self._library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def fragments(self, data: bytes) -> list[bytes]:
        """The pieces between certain cuts."""
        if len(data) <= 24:
            inside, cuts = self.inside, [0]
            for i, pair in enumerate(zip(data, data[1:]), 1):
                if pair not in inside:
                    cuts.append(i)
            if len(cuts) == 1:
                return [data]
            cuts.append(len(data))
        else:
            b = np.frombuffer(data, dtype=np.uint8).astype(np.uint16)
            at = np.flatnonzero(~self.inside_table[b[:-1] << 8 | b[1:]]) + 1
            cuts = [0, *at.tolist(), len(data)]
        return [data[x:y] for x, y in zip(cuts, cuts[1:])]

    def merge(self, data: bytes) -> list[int]:
        """Ids of one fragment: the lowest-ranked pair is merged first, from the left."""
        ids = [self.first[b] for b in data]
        if len(ids) > 200:
            return self._merge_long(ids)
        rank = self.rank
        ranks = [rank.get(pair, NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [self.merged[best]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), NO_RANK)
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NO_RANK)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, for fragments of any length."""
        n, rank = len(ids), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []
        for i in range(n - 1):
            r = rank.get((ids[i], ids[i + 1]))
            if r is not None:
                heap.append((r, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            n, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            merged = ids[i] = self.merged[n]
            ids[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                r = rank.get((merged, ids[k]))
                if r is not None:
                    heapq.heappush(heap, (r, i, merged, ids[k]))
            h = before[i]
            if h >= 0:
                r = rank.get((ids[h], merged))
                if r is not None:
                    heapq.heappush(heap, (r, h, ids[h], merged))
        return [x for x in ids if x >= 0]

    def _encode_pretoken(self, word: str) -> bytes:
        ids: list[int] = []
        for part in self.fragments(word.encode("utf-8")):
            ids += self.merge(part)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def _remember(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self._encode_pretoken(word)
        if len(word) <= 64:
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.cut_special(text) if self.cut_special and any(s in text for s in self.special) else [text]
        out = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(struct.pack("<I", self.special[piece]))
            elif piece:
                recent, miss = self.memo.get, self._remember
                out += [recent(word) or miss(word) for word in self.pretokens(piece)]
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(packed, dtype="<u4").tolist()]).decode("utf-8", errors="replace")


_CODECS: dict[bytes, Codec] = {}


def codec(raw: bytes) -> Codec:
    """The worker's codec for a vocabulary (built once per worker)."""
    key = hashlib.sha256(raw).digest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(raw)
    return _CODECS[key]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids binary, decoded string) of every row: ids packed as
    little-endian unsigned 32-bit integers, decoded from the ids."""
    with open(vocabulary or default_vocabulary(), "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: fixed size

    def make():
        c = codec(raw.value)

        def run(cols):
            ids = [c.encode(t or "") for t in cols[1]]
            return [cols[0], ids, [c.decode(p) for p in ids]]
        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), f"`{id_col}` {kind}, ids binary, decoded string", make)


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, the
    digests taken in the same task as the encoding (no ids leave it)."""
    with open(vocabulary or default_vocabulary(), "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        c = codec(raw.value)

        def run(cols):
            n, a, b = [], [], []
            for t in cols[1]:
                packed = c.encode(t or "")
                n.append(len(packed) // 4)
                a.append(hashlib.sha256(packed).hexdigest())
                b.append(hashlib.sha256(c.decode(packed).encode("utf-8")).hexdigest())
            return [cols[0], n, a, b]
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
