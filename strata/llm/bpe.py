"""Byte-level BPE encoding and decoding.

A pre-token is a doubly linked list of symbols; a heap holds the ranks of the
adjacent pairs that can merge. The lowest rank (leftmost on ties) is merged,
the pairs beside it are pushed, and heap entries whose symbols have changed
since are skipped. Decoding concatenates the vocabulary strings of the ids.
The vocabulary file of a public tokenizer is a parameter and is read by the
driver once and sent to the tasks (its size is that of the file).

Defined cases: a null text is the empty text: no ids, the empty string.
Repeated rows give repeated results, an empty table none, and extra columns
are ignored. A special token's string in a text is that token's one id, as
with the tokenizers library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import table

#: Fixed value: the public byte-level pre-tokenizer pattern.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens a task remembers; beyond it a new memory starts, and the last one is still asked.
MEMORY = 250_000
#: More than any id; a pair (a, b) is the number a * PAIR + b.
PAIR = 1 << 20
#: Longer pre-tokens are not remembered.
LONG = 64
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary:
    printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


class Tokenizer:
    def __init__(self, spec: dict):
        letters = byte_letters()
        to_byte = {c: b for b, c in letters.items()}
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.first = [self.vocab[letters[b]] for b in range(256)]
        self.rank: dict[int, int] = {}  # of a pair of ids, as one number
        self.made: list[int] = []  # id by rank
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[a] * PAIR + self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
        self.strings: dict[int, bytes] = {i: bytes(to_byte[c] for c in s) for s, i in self.vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.pattern = regex.compile(PRETOKEN)
        longest_first = sorted(self.special, key=lambda s: (-len(s), s))
        self.specials = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token (not empty)."""
        first, rank, made, pop, push = self.first, self.rank.get, self.made, heapq.heappop, heapq.heappush
        ids = [first[b] for b in data]
        n = len(ids)
        heap, i, a = [], 0, ids[0]  # rank * n + place of the left symbol
        for b in ids[1:]:
            if (r := rank(a * PAIR + b)) is not None:
                heap.append(r * n + i)
            i, a = i + 1, b
        heapq.heapify(heap)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        ids.append(-1)  # behind the last symbol; merged symbols are -1 too
        while heap:
            r, i = divmod(pop(heap), n)
            j = after[i]
            if rank(ids[i] * PAIR + ids[j]) != r:
                continue  # stale: a symbol has merged with another neighbour
            new = ids[i] = made[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new * PAIR + ids[k])) is not None:
                    push(heap, r * n + i)
            p = before[i]
            if p >= 0 and (r := rank(ids[p] * PAIR + new)) is not None:
                push(heap, r * n + p)
        return [i for i in ids if i >= 0]

    def piece(self, token: str) -> bytes:
        """The ids of one pre-token, as little-endian unsigned 32-bit integers."""
        out = self.older.get(token)
        if out is None:
            ids = self.merge(token.encode())
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= LONG:
            if len(self.memory) >= MEMORY:
                self.older, self.memory = self.memory, {}
            self.memory[token] = out
        return out

    def _plain(self, text: str) -> bytes:
        piece, out = self.piece, []
        for t in self.pattern.findall(text):
            out.append(self.memory.get(t) or piece(t))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit integers."""
        if not self.specials or not any(s in text for s in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._plain(text[at : m.start()]), np.asarray([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document; each text is encoded and decoded whole. Batches
    hold a bounded number of rows and nothing is kept between texts but the
    bounded memory of pre-tokens."""
    shared = spark.sparkContext.broadcast(load(vocabulary or public_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = tokenizer.encode(text.as_py() or "")
                decoded = tokenizer.decode(ids).encode()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, i, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, digested, and the decoded texts' digests."""
    return encode_documents(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
