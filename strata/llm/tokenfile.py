"""Token ids as raw binary files with a minimal perfect hash index.

Layout of a written folder:

* ``ids-<shard>.bin``: the ids of a range of documents, little-endian unsigned
  16-bit integers (32-bit where the vocabulary needs them), without headers, in
  ascending doc_id order within and across shards;
* ``index-<part>.mph``: for the keys that hash into the part, a minimal perfect
  hash function (levels of collision-free bits with ranks) and, by its value,
  each key's stored fingerprint, shard, offset and number of ids;
* ``places``: the keys in order with their places, a Parquet table;
* ``manifest.json``: id width, number of index parts, and per shard its start
  (the ids of all shards before it).

A key is (doc_id, copy): copies number the rows of one doc_id from 0, by text
hash. A lookup hashes the key, finds its level and rank, and compares the
fingerprint; it reads one index part and one range of one shard.

The texts meet one range exchange, are encoded where they land and written
there. Index parts hold a bounded number of keys. Files are written under a
name of their own and moved into place, so a task that runs again leaves the
same files. The driver holds one row per shard.

Defined cases: a null text is the empty text (the end id alone); null doc_ids
come first and are keys as others; repeated rows are copies; an empty table
gives no shards and no rows; extra columns are ignored. Any number of rows may
share a doc_id: they spread over shards by text hash and place.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import byte_letters
from strata.llm.common import dropped, in_slices, table, text_or_empty, written
from strata.session import shared_dir

#: The id that ends every document.
END = 2
#: Text bytes of a shard (an id takes about a third of its text in this format).
SHARD_BYTES = 256 << 20
#: Keys of an index part, at most about; smaller parts where there are tasks to spare.
PART_KEYS = 250_000
LEAST_PART_KEYS = 1_000
#: Slots per key on each level of the hash function.
ROOM = 2.0
#: Words and parts a task remembers; beyond it a new memory starts, and the last one is still asked.
MEMORY = 600_000
#: Text bytes whose words are told apart at once (a longer text makes a slice of its own).
SLICE_BYTES = 8 << 20
#: Longer words are not remembered.
LONG = 64
#: Fixed value: a word that is one id of its own; it parts the words that are encoded at once.
MARK = "\x01"
#: The normalizer and pre-tokenizer under which words can be encoded alone.
WORDWISE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
#: Latin-1 letters, then ASCII punctuation but the apostrophe: unchanged by NFC, lowered letter by letter, split between the two.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<rest>[!-&(-/:-@\[-`{-~]*)$"
PLACES = "doc_id long, nth long, shard int, offset long, n_tokens long"
HEAD = "<4sIQ"  # magic, levels, keys
MAGIC = b"mph1"


# ---- files ------------------------------------------------------------------
def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that tasks use for a shared path, and the path in it."""
    if path.startswith("file:/"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


class Moved:
    """A file written beside its name and moved there once it is whole."""

    def __init__(self, path: str):
        self.fs, self.path = filesystem(path)
        folder, name = os.path.split(self.path)
        self.beside = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.beside)

    def __enter__(self):
        return self.stream

    def __exit__(self, failed, *_):
        self.stream.close()
        if failed:
            self.fs.delete_file(self.beside)
        else:
            self.fs.move(self.beside, self.path)


def read_file(path: str) -> bytes:
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        return f.read()


# ---- encoding ---------------------------------------------------------------
class Encoder:
    """Whole texts to ids with the tokenizers library.

    Where the vocabulary's steps are those of ``WORDWISE``, no step joins or
    changes characters across blanks, so a text's ids are those of its words.
    The words of many texts are told apart at once (Arrow), each distinct one
    is encoded once, and the texts' ids are taken from these. Plain words
    (``PLAIN``: Latin letters, then punctuation) are lowered here and given to
    the library's model as letters and punctuation; all others go through all
    of the library's steps, many at once. Parts and words met before are
    remembered. With other vocabularies the library encodes each text whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        steps = json.loads(spec)
        # a special token of a plain word's form could lie within plain words
        apart = not any(set(s) & set(" \t\n\v\f\r") or re.fullmatch(PLAIN, s) for s in self.special)
        self.wordwise = (steps["normalizer"], steps["pre_tokenizer"]) == WORDWISE and apart
        self.letters = byte_letters()
        mark = self.ids(MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.end = self.packed([END])

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def part(self, part: str) -> bytes:
        """The ids of lower-case letters or of punctuation."""
        text = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        return self.packed([t.id for t in self.model.tokenize(text)]) if text else b""

    def others(self, words: list[str]) -> list[bytes]:
        """The ids of words that are not plain, encoded together where the mark can part them."""
        out: dict[str, bytes] = {}
        joined = []
        for t in words:
            if self.mark is None or MARK in t or any(s in t for s in self.special) or len(t) > LONG:
                out[t] = self.packed(self.ids(t))
            else:
                joined.append(t)
        for at in range(0, len(joined), 256):
            some = joined[at : at + 256]
            ids = np.array(self.ids(f" {MARK} ".join(some)), self.dtype)
            ends = [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            if len(ends) != len(some):
                raise ValueError("the mark is not a word of its own in this vocabulary")
            data, wide, start = ids.tobytes(), self.dtype.itemsize, 0
            for t, end in zip(some, ends):
                out[t] = data[start * wide : end * wide]
                start = end + 1
        return [out[t] for t in words]

    def known(self, words: pa.Array, learn: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """The ids of distinct words, from memory or learned now."""
        words = words.to_pylist()
        found = list(map(self.memory.get, words))
        unseen = [i for i, x in enumerate(found) if x is None]
        if unseen and self.older:
            for i in unseen:
                found[i] = self.older.get(words[i])
            unseen, again = [i for i in unseen if found[i] is None], [i for i in unseen if found[i] is not None]
            self.memory.update((words[i], found[i]) for i in again)
        for i, data in zip(unseen, learn([words[i] for i in unseen])):
            found[i] = data
        if len(self.memory) + len(unseen) > MEMORY:
            self.older, self.memory = self.memory, {}
        self.memory.update((words[i], found[i]) for i in unseen if len(words[i]) <= LONG)
        return pa.array(found, pa.large_binary())

    def learn(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, one binary value each."""
        split = pc.extract_regex(words, PLAIN)
        plain = pc.and_(split.is_valid(), pc.less_equal(pc.binary_length(words), LONG))
        split = split.filter(plain)
        halves = []
        for half in (pc.utf8_lower(split.field("letters")), split.field("rest")):
            half = half.dictionary_encode()
            halves.append(self.known(half.dictionary, lambda some: list(map(self.part, some))).take(half.indices))
        other = self.known(words.filter(pc.invert(plain)), self.others)
        both = pa.concat_arrays([pc.binary_join_element_wise(*halves, pa.scalar(b"", pa.large_binary())), other])
        mask = plain.to_numpy(zero_copy_only=False)
        at = np.where(mask, np.cumsum(mask), mask.sum() + np.cumsum(~mask)) - 1
        return both.take(pa.array(at))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids and the end id."""
        if not self.wordwise:
            return [self.packed([*self.ids(t), END]) for t in texts.to_pylist()]
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))  # at the six ASCII blanks
        words = lists.flatten().dictionary_encode()
        ids = self.learn(words.dictionary).take(words.indices)
        # a text's ids lie together: its words' values follow each other in one buffer
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        cuts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[ends].tolist() if len(ids) else [0] * len(ends)
        data = memoryview(ids.buffers()[2]) if len(ids) and ids.buffers()[2] else memoryview(b"")
        return [bytes(data[a:b]) + self.end for a, b in zip(cuts, cuts[1:])]


# ---- the hash function ------------------------------------------------------
def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (xor-shift and multiply), a permutation of the 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(ids: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each key for this seed (a null doc_id is a copy below zero)."""
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        a = mixed(ids.view(np.uint64) + np.uint64(2 * seed + 1) * step)
        return mixed(a ^ mixed(copies.view(np.uint64) + np.uint64(2 * seed + 2) * step))


FINGERPRINT_SEED = 1 << 20


class HashIndex:
    """Keys to 0..n-1, one to one, and by that number the stored fields.

    On each level the keys left over hash into ROOM slots apiece; the slots
    that one key alone hits get a bit, the others' keys go to the next level.
    A key's number is the rank of its bit over all levels.
    """

    def __init__(self, levels: list[np.ndarray], fields: dict[str, np.ndarray]):
        self.levels, self.fields = levels, fields  # levels: bits as uint64 words
        flat = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        self.flat = flat
        self.base = np.cumsum([0, *[len(x) for x in levels]])
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(flat), dtype=np.int64)])

    FIELDS = {"fingerprint": "<u4", "shard": "<u4", "offset": "<u8", "n_tokens": "<u8"}

    @classmethod
    def build(cls, ids: np.ndarray, copies: np.ndarray, places: dict[str, np.ndarray]) -> HashIndex:
        levels, left = [], np.arange(len(ids))
        while len(left):
            words = int(len(left) * ROOM) // 64 + 1
            slot = hashed(ids[left], copies[left], len(levels)) % np.uint64(words * 64)
            slot = slot.astype(np.int64)
            alone = np.bincount(slot, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[slot]]
            if len(levels) > 200:
                raise ValueError("a key is given twice")
        index = cls(levels, {})
        number = index.number(ids, copies)
        stored = {"fingerprint": hashed(ids, copies, FINGERPRINT_SEED) >> np.uint64(32), **places}
        for name, kind in cls.FIELDS.items():
            index.fields[name] = np.zeros(len(ids), kind)
            index.fields[name][number] = stored[name]
        return index

    def number(self, ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 where no level has a bit."""
        out, left = np.full(len(ids), -1, np.int64), np.arange(len(ids))
        for level, words in enumerate(self.levels):
            slot = (hashed(ids[left], copies[left], level) % np.uint64(len(words) * 64)).astype(np.int64)
            at, bit = slot >> 6, (slot & 63).astype(np.uint64)
            hit = (words[at] >> bit) & np.uint64(1) == 1
            word = self.base[level] + at[hit]
            below = self.flat[word] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.rank[word] + np.bitwise_count(below)
            left = left[~hit]
            if not len(left):
                break
        return out

    def find(self, ids: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys the index holds (by fingerprint), and their numbers."""
        number = self.number(ids, copies)
        known = number >= 0
        want = (hashed(ids, copies, FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")
        known[known] = self.fields["fingerprint"][number[known]] == want[known]
        return known, number

    def dump(self) -> bytes:
        n = len(self.fields["shard"])
        sizes = np.array([len(x) for x in self.levels], "<u8")
        return b"".join([struct.pack(HEAD, MAGIC, len(self.levels), n), sizes.tobytes(), *[x.tobytes() for x in self.levels], *[self.fields[f].tobytes() for f in self.FIELDS]])

    @classmethod
    def load(cls, data: bytes) -> HashIndex:
        magic, n_levels, n = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not an index part")
        sizes = np.frombuffer(data, "<u8", n_levels, struct.calcsize(HEAD))
        at, levels, fields = struct.calcsize(HEAD) + 8 * n_levels, [], {}
        for size in sizes.tolist():
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        for name, kind in cls.FIELDS.items():
            fields[name] = np.frombuffer(data, kind, n, at)
            at += fields[name].nbytes
        return cls(levels, fields)


def key_arrays(doc_ids: pa.Array, copies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys as two integers; the copies of the null doc_id count down from -1."""
    null = np.asarray(doc_ids.is_null())
    copy = np.asarray(copies).astype(np.int64)
    return np.asarray(doc_ids.fill_null(0)).astype(np.int64), np.where(null, -1 - copy, copy)


def part_of(doc_id: int | None, copy: int, parts: int) -> int:
    """The index part of a key; the same as ``part_column``."""
    h = 42
    for v in (doc_id, copy):
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return (h - (h >> 63 << 64)) % parts


def part_column(parts: int):
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("copy").cast("long")), F.lit(parts)).cast("int")


# ---- writing ----------------------------------------------------------------
def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of at most about ``SLICE_BYTES`` of text each."""
    for batch in batches:
        before, start = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while start < batch.num_rows:
            held = before[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(before, held + SLICE_BYTES, "right")))
            yield batch.slice(start, end - start)
            start = end


def write_shards(spec: str, out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's sorted documents into its shard; their places are its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, offset, last, nth = TaskContext.get().partitionId(), 0, "none yet", 0
        encoder = stream = None
        file = None
        for batch in by_bytes(batches):
            if file is None:
                encoder, file = Encoder(spec), Moved(f"{out}/ids-{shard:06d}.bin")
                stream = file.__enter__()
            rows, doc_ids = [], batch.column(0).to_pylist()
            wide = encoder.dtype.itemsize
            for doc_id, data in zip(doc_ids, encoder.encode(batch.column(1))):
                stream.write(data)
                nth = nth + 1 if doc_id == last else 0
                last, n = doc_id, len(data) // wide
                rows.append((doc_id, nth, shard, offset, n))
                offset += n
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "nth", "shard", "offset", "n_tokens"])
        if file is not None:
            file.__exit__(None)

    return run


def shard_table(places: DataFrame) -> list[dict]:
    """Per shard in order: its first id's place among all ids, and how many
    rows of its first doc_id the shards before it hold (one row per file)."""
    ends = lambda c, by: F.struct(F.col("offset"), F.col(c)).alias(by)
    found = (
        places.select("*", ends("doc_id", "first"), F.struct("offset", "doc_id", "nth").alias("last"))
        .groupBy("shard")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_tokens").alias("n_tokens"))
        .orderBy("shard")
        .collect()
    )
    out, start, carry, before = [], 0, 0, None
    for r in found:
        first, last = r["first"]["doc_id"], r["last"]["doc_id"]
        carry = carry if before == (first,) else 0
        out.append({"shard": r["shard"], "start": start, "first": first, "carry": carry})
        start += r["n_tokens"]
        carry = r["last"]["nth"] + 1 + (carry if first == last else 0)
        before = (last,)
    return out


def write_index(out: str) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        keys = key_arrays(group["doc_id"].combine_chunks(), group["copy"].combine_chunks())
        index = HashIndex.build(*keys, {c: np.asarray(group[c]) for c in ("shard", "offset", "n_tokens")})
        with Moved(f"{out}/index-{part:06d}.mph") as f:
            f.write(index.dump())
        return pa.table({"part": pa.array([part], pa.int32()), "keys": pa.array([group.num_rows], pa.int64())})

    return run


def public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, out: str | None = None, shard_bytes: int = SHARD_BYTES) -> str:
    """Encode ``docs`` (doc_id, text) into a new folder; returns its path."""
    with open(vocabulary or public_path(), encoding="utf-8") as f:
        spec = f.read()
    out = out or f"{shared_dir(spark)}/strata-llm/tokens-{uuid.uuid4().hex}"
    fs, at = filesystem(out)
    fs.create_dir(at, recursive=True)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes), min(spark.sparkContext.defaultParallelism * 2, size >> 20))
    # equal rows differ by their place, so that any number of them spreads
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    held = texts.repartitionByRange(shards, *order).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    placed = written(spark, held.mapInArrow(write_shards(spec, out), PLACES), "token-places")
    found = shard_table(placed)
    carried = spark.createDataFrame([(s["shard"], s["start"], s["first"], s["carry"]) for s in found], "shard int, base long, first long, carry long")
    copy = F.col("nth") + F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.col("carry")).otherwise(0)
    keyed = placed.join(carried, "shard").select("doc_id", copy.alias("copy"), "shard", "offset", "n_tokens")
    keyed.write.parquet(f"{out}/places")
    dropped(spark, placed)
    keyed = spark.read.schema(keyed.schema).parquet(f"{out}/places")
    rows = keyed.count()
    parts = max(1, -(-rows // PART_KEYS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_PART_KEYS))
    keyed.withColumn("part", part_column(parts)).groupBy("part").applyInArrow(write_index(out), "part int, keys long").agg(F.sum("keys")).first()
    encoder = Encoder(spec)
    manifest = {"width": encoder.dtype.itemsize, "parts": parts, "starts": {s["shard"]: s["start"] for s in found}}
    with Moved(f"{out}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return out


# ---- reading ----------------------------------------------------------------
class Reader:
    """Keyed access to a written folder: one index part and one range a key."""

    def __init__(self, path: str):
        self.path = path
        manifest = json.loads(read_file(f"{path}/manifest.json"))
        self.dtype = np.dtype(f"<u{manifest['width']}")
        self.parts = manifest["parts"]
        self.starts = {int(k): v for k, v in manifest["starts"].items()}
        self.part, self.index = None, None
        self.shard, self.file = None, None

    def lookup(self, part: int, doc_ids: pa.Array, copies: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys of one part there are, and these keys' places."""
        if part != self.part:
            self.part, self.index = part, HashIndex.load(read_file(f"{self.path}/index-{part:06d}.mph"))
        known, number = self.index.find(*key_arrays(doc_ids, copies))
        return known, {f: self.index.fields[f][number[known]].astype(np.int64) for f in ("shard", "offset", "n_tokens")}

    def read(self, shard: int, offset: int, n: int) -> bytes:
        """``n`` raw ids of a shard."""
        if shard != self.shard:
            if self.file:
                self.file.close()
            fs, at = filesystem(f"{self.path}/ids-{shard:06d}.bin")
            self.shard, self.file = shard, fs.open_input_file(at)
        data = self.file.read_at(n * self.dtype.itemsize, offset * self.dtype.itemsize)
        if len(data) != n * self.dtype.itemsize:
            raise ValueError(f"shard {shard} ends before {offset + n}")
        return data

    def get(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        """One document's ids, or None."""
        part = part_of(doc_id, copy, self.parts)
        known, at = self.lookup(part, pa.array([doc_id], pa.int64()), pa.array([copy], pa.int64()))
        return np.frombuffer(self.read(*(int(at[f][0]) for f in at)), self.dtype) if known[0] else None


FOUND = "doc_id long, copy long, shard int, offset long, n_tokens long"


def look_up(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The places of the distinct ``keys`` (doc_id, copy) that the index holds."""
    parts = Reader(path).parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            reader = reader or Reader(path)
            part = np.asarray(batch.column(2))
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    some = batch.slice(a, b - a)
                    known, at = reader.lookup(int(part[a]), some.column(0), some.column(1))
                    some = some.filter(pa.array(known))
                    arrays = [some.column(0), some.column(1), pa.array(at["shard"], pa.int32()), pa.array(at["offset"]), pa.array(at["n_tokens"])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "copy", "shard", "offset", "n_tokens"])

    keyed = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy")).distinct().withColumn("part", part_column(parts))
    return keyed.repartition("part").sortWithinPartitions("part").mapInArrow(run, FOUND)


def read(spark: SparkSession, path: str, keys: DataFrame | None = None, ids: bool = True) -> DataFrame:
    """doc_id, copy, start, n_tokens, ids_crc32 and, unless ``ids`` is false,
    the ids themselves of ``keys`` (default: of all keys), from the files."""
    keys = spark.read.parquet(f"{path}/places").select("doc_id", "copy") if keys is None else keys
    schema = "doc_id long, copy long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in in_slices(batches):
            reader = reader or Reader(path)
            shard, offset, n = (batch.column(c).to_pylist() for c in (2, 3, 4))
            raw = [np.frombuffer(reader.read(*at), reader.dtype) for at in zip(shard, offset, n)]
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in raw]
            arrays = [batch.column(0), batch.column(1), pa.array([reader.starts[s] + o for s, o in zip(shard, offset)], pa.int64()), batch.column(4), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array([x.astype(np.int32) for x in raw], pa.list_(pa.int32()))] if ids else []), names=names)

    places = look_up(spark, path, keys)
    return places.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset").mapInArrow(run, schema)


def op12_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as raw ids with their index, and read back by key."""
    path = write(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    return read(spark, path, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
