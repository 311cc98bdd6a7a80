"""Token ids as raw binary shards, with a minimal perfect hash index for access by document.

Documents are range-partitioned by id and sorted; each task encodes its documents and writes one
shard: `shard-N.bin`, the ids one after the other (2 or 4 bytes each, little-endian), and
`shard-N.idx`, the index. Shard numbers follow the order of ids. Files are written under a name of
the attempt and then renamed, and a repeated task writes the same bytes, so a lost executor costs a
repeat and nothing else. The folder may be in any store pyarrow.fs knows (file, hdfs, s3, gs).

The index has no keys. Level by level, the keys left over are hashed to a bit array twice their
number; those alone on their bit are placed, and the rank of that bit, counted through precomputed
sums, is the key's slot: n keys fill the slots 0..n-1. A slot holds a 32-bit fingerprint of the key,
which turns foreign keys away, and the place and number of its ids. Finding a key takes a few hashes
and one read of its ids, whatever the size of the shard.

The key of a document is its id and, as ids may repeat, a running number among equal ids of a shard.

Defined cases: null and empty texts have the end id only; null ids sort first; repeated rows are all
written; texts are never cut; an empty table gives no shard and an empty ledger; other columns are
not read.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs as afs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundweave.sources.workspace import cut, new_folder

from .bytebpe import byte_characters
from .common import col, ship, whole

MAGIC = b"FWTI0001"
#: Bits per key left over, of each level's bit array.
GAMMA = 2
#: Keys still unplaced after so many levels are listed with their hashes.
LEVELS = 48
#: Stretches remembered by an encoding worker before it starts over.
REMEMBER = 500_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def key_of(doc_id, copy: int) -> bytes:
    """The copy-th row of an id; no id is told apart from any id."""
    return (f"-#{copy}" if doc_id is None else f"={doc_id}#{copy}").encode()


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every key; the low half of the second is its fingerprint."""
    whole_ = [xxhash.xxh3_128_intdigest(k) for k in keys]
    a = np.fromiter((h >> 64 for h in whole_), np.uint64, len(keys))
    b = np.fromiter((h & (1 << 64) - 1 for h in whole_), np.uint64, len(keys))
    return a, b


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of every key at a level: a 64-bit finaliser over both hashes and the level."""
    x = a ^ (b + np.uint64(level * _STEP & (1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class Index:
    """The minimal perfect hash with its payload (fingerprint, offset, count) by slot."""

    def __init__(self, levels, rest, prints, offsets, counts, width) -> None:
        #: (size, words, ones before each word) of every level.
        self.levels = levels
        #: Slots of keys that no level placed, by both hashes.
        self.rest = rest
        self.prints, self.offsets, self.counts, self.width = prints, offsets, counts, width

    @staticmethod
    def build(keys: list[bytes], offsets, counts, width: int) -> "Index":
        a, b = key_hashes(keys)
        left = np.arange(len(keys))
        slots = np.empty(len(keys), np.int64)
        levels, used = [], 0
        while len(left) and len(levels) < LEVELS:
            size = -(-GAMMA * len(left) // 64) * 64
            at = _place(a[left], b[left], len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            words = np.packbits(bits, bitorder="little").view("<u8")
            before = used + np.cumsum(np.bitwise_count(words).astype(np.uint64)) - np.bitwise_count(words)
            slots[left[alone]] = used + (np.cumsum(bits, dtype=np.int64) - 1)[at[alone]]
            levels.append((size, words, before.astype("<u8")))
            used += int(alone.sum())
            left = left[~alone]
        slots[left] = used + np.arange(len(left))
        rest = {(int(a[i]), int(b[i])): int(slots[i]) for i in left}
        n = len(keys)
        prints, offs, cnts = np.empty(n, "<u4"), np.empty(n, "<u8"), np.empty(n, "<u8")
        prints[slots] = (b & np.uint64(0xFFFFFFFF)).astype("<u4")
        offs[slots], cnts[slots] = offsets, counts
        return Index(levels, rest, prints, offs, cnts, width)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot of every key, -1 where the fingerprint says that it is not in here."""
        a, b = key_hashes(keys)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            if not len(open_):
                break
            at = _place(a[open_], b[open_], level, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            rank = before[at >> 6].astype(np.int64) + np.bitwise_count(below)
            out[open_[here]] = rank[here]
            open_ = open_[~here]
        for i in open_:
            out[i] = self.rest.get((int(a[i]), int(b[i])), -1)
        found = out >= 0
        found[found] = self.prints[out[found]] == (b[found] & np.uint64(0xFFFFFFFF)).astype("<u4")
        return np.where(found, out, -1)

    def to_bytes(self) -> bytes:
        n = len(self.prints)
        out = [MAGIC, struct.pack("<QIIQ", n, self.width, len(self.levels), len(self.rest))]
        for size, words, before in self.levels:
            out += [struct.pack("<Q", size), words.tobytes(), before.tobytes()]
        out += [struct.pack("<QQQ", *k, v) for k, v in sorted(self.rest.items())]
        return b"".join([*out, self.prints.tobytes(), self.offsets.tobytes(), self.counts.tobytes()])

    @staticmethod
    def from_bytes(data: bytes) -> "Index":
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        n, width, n_levels, n_rest = struct.unpack_from("<QIIQ", data, 8)
        at = 32

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got

        levels = []
        for _ in range(n_levels):
            size = int(take("<u8", 1)[0])
            levels.append((size, take("<u8", size // 64), take("<u8", size // 64)))
        rest = {}
        for _ in range(n_rest):
            x, y, slot = take("<u8", 3).tolist()
            rest[(x, y)] = slot
        return Index(levels, rest, take("<u4", n), take("<u8", n), take("<u8", n), width)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme. Without one it lies in the cluster's default store, where Spark would
    look for it, and not on the disk of whoever writes."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if path.toUri().getScheme():
        return folder
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString()


def _store(folder: str) -> tuple[afs.FileSystem, str]:
    """The store of a qualified folder, and the folder's path in it."""
    if folder.startswith("file:"):
        return afs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return afs.FileSystem.from_uri(folder)


#: A stretch that is a word of letters which lower-casing and composition leave one to one, and signs
#: behind it: what the file's normaliser and pre-tokenizer do to it is known, so its model is asked
#: directly. One match per line, of three groups: word and signs, or any other stretch.
_STRETCH = re.compile(
    "^(?:([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!#$%&()*+,./:;<=>?@|-]*)|(.*))$", re.MULTILINE
)


class WordEncoder:
    """Ids of texts by a word-BPE file of the tokenizers library whose pre-tokenizer drops white
    space and splits letters from signs: stretches between blanks are encoded on their own and
    remembered (a bounded number)."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.full = Tokenizer.from_file(path)
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.full.get_vocab()
        #: Whether an id ends a word: its piece has the suffix.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = self.full.model.end_of_word_suffix
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.kind = "<u2" if self.full.get_vocab_size() <= 1 << 16 else "<u4"
        #: Printable characters for the bytes of letters; the blank stays, to split words at.
        self.chars = {b: c for b, c in enumerate(byte_characters()) if b != 0x20}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _ids(self, some: list[str]) -> list[bytes]:
        out = self.full.encode_batch_fast(some, add_special_tokens=False)
        return [np.asarray(e.ids, self.kind).tobytes() for e in out]

    def _word_ids(self, some: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters: one call for all, cut where an id ends a word."""
        if not some:
            return []
        text = " ".join(some)
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.chars)
        ids = np.asarray(self.model.encode_batch_fast([text])[0].ids, self.kind)
        cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()]
        if len(cuts) != len(some) + 1:
            raise ValueError("the file's pieces do not mark the ends of words")
        data = ids.tobytes()
        return [data[i:j] for i, j in zip(cuts, cuts[1:])]

    def _learn(self, new: list[str]) -> None:
        """Remembers the ids of stretches (without line breaks): words and their signs apart, others
        as they are."""
        found = _STRETCH.findall("\n".join(new))
        other = [x for x, f in zip(new, found) if not f[0]]
        simple = [(x, f[1]) for x, f in zip(new, found) if f[0]]
        lower = "\n".join([f[0] for f in found if f[0]]).lower().split("\n")
        words, known = self.words, self.known
        if len(words) > REMEMBER:
            words.clear()
        unknown = list(set(lower[: len(simple)]).difference(words))
        words.update(zip(unknown, self._word_ids(unknown)))
        unknown = [s for s in {s for _, s in simple}.difference(words) if s]
        words.update(zip(unknown, self._ids(unknown)))
        known.update((x, words[w] + words[s] if s else words[w]) for (x, s), w in zip(simple, lower))
        known.update(zip(other, self._ids(other)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and each text's number of ids. Arrow tells the
        distinct stretches; each is looked up once."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        flat = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(flat, " ")
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        new = [x for x in distinct if x not in known]
        if new:
            self._learn(new)
        pieces = [known[x] for x in distinct]
        width = np.dtype(self.kind).itemsize
        ids = np.frombuffer(b"".join(pieces), self.kind)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // width
        starts = np.cumsum(sizes) - sizes
        at = np.asarray(coded.indices)
        each = sizes[at]
        ends = np.cumsum(each)
        place = np.repeat(starts[at] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.r_[0, ends][np.asarray(pc.list_value_length(lists)).cumsum()]
        return ids[place], np.diff(np.r_[0, bounds])


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write(
    df: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes every text by the tokenizer file `path`, appends `end_id`, writes the shards to
    `folder` and returns the ledger, a stored table with one row per document: shard, doc_id, copy,
    n_ids. `path` must be readable on every executor."""
    ship(df.sparkSession)
    folder = qualified(df.sparkSession, folder)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        encoder = word_encoder(path)
        width = int(encoder.kind[-1])
        end = np.asarray([end_id], encoder.kind).tobytes()
        store, place = _store(folder)
        name = f"{place}/shard-{shard:06d}"
        out, keys, counts, seen = None, [], [], (object(), 0)
        for rows in batches:
            if not len(rows):
                continue
            if out is None:
                store.create_dir(place, recursive=True)
                out = store.open_output_stream(f"{name}.bin.{attempt}")
            ids, copies, sizes = rows.column("doc_id").to_pylist(), [], []
            texts = rows.column("text")
            for at in range(0, len(ids), 2000):
                flat, lengths = encoder.encode(texts.slice(at, 2000))
                begin = 0
                for n in lengths.tolist():
                    out.write(flat[begin : begin + n].tobytes() + end)
                    sizes.append(n + 1)
                    begin += n
            for i in ids:
                seen = (i, seen[1] + 1) if seen[0] == i else (i, 0)
                copies.append(seen[1])
                keys.append(key_of(i, seen[1]))
            counts += sizes
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * len(ids), pa.int32()),
                    rows.column("doc_id"),
                    pa.array(copies, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["shard", "doc_id", "copy", "n_ids"],
            )
        if out is not None:
            out.close()
            n = np.asarray(counts, np.uint64)
            index = Index.build(keys, np.cumsum(n) - n, n, width)
            with store.open_output_stream(f"{name}.idx.{attempt}") as f:
                f.write(index.to_bytes())
            for kind in ("bin", "idx"):
                store.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")

    text = whole(col(text_col))
    ranged = (
        df.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    return cut(
        ranged.mapInArrow(run, f"shard int, doc_id {id_type}, copy bigint, n_ids bigint"), "ledger"
    )


def sizes(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids) of every row: the number of ids that `write` stores for it, the end id among
    them. No shuffle, and nothing is written."""
    ship(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for rows in batches:
            for at in range(0, len(rows), 2000):
                part = rows.slice(at, 2000)
                _, lengths = encoder.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lengths + 1, pa.int64())], names=["doc_id", "n_ids"]
                )

    rows = df.select(col(id_col).alias("doc_id"), whole(col(text_col)).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_ids bigint")


class Reader:
    """Keyed access to one shard."""

    def __init__(self, folder: str, shard: int) -> None:
        store, place = _store(folder)
        name = f"{place}/shard-{shard:06d}"
        with store.open_input_file(f"{name}.idx") as f:
            self.index = Index.from_bytes(f.read())
        self.file = store.open_input_file(f"{name}.bin")

    def get(self, keys: list[bytes]) -> list[tuple[int, np.ndarray] | None]:
        """(place of the first id in the shard, ids) of every key, None where it is not there."""
        width = self.index.width
        out = []
        for slot in self.index.slots(keys).tolist():
            if slot < 0:
                out.append(None)
                continue
            start, n = int(self.index.offsets[slot]), int(self.index.counts[slot])
            out.append((start, np.frombuffer(self.file.read_at(n * width, start * width), f"<u{width}")))
        return out


def bases(ledger: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before. One row per shard."""
    totals = ledger.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        F.col("shard").alias("b_shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )


def read(ledger: DataFrame, folder: str, summary, fields: str) -> DataFrame:
    """Looks every document of the ledger up in its shard by key. `summary(ids)` gives the values of
    `fields` (DDL) for a document's ids. Returns doc_id, start, n_ids and these."""
    ship(ledger.sparkSession)
    folder = qualified(ledger.sparkSession, folder)
    id_type = ledger.schema["doc_id"].dataType.simpleString()
    kinds = T.StructType.fromDDL(fields).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[int, Reader] = {}
        for rows in batches:
            shards = np.asarray(rows.column("shard"))
            for shard in np.unique(shards).tolist():
                if shard not in readers:
                    readers = {shard: Reader(folder, shard)}
                part = rows.filter(pa.array(shards == shard))
                docs, copies = part.column("doc_id").to_pylist(), part.column("copy").to_pylist()
                found = readers[shard].get([key_of(i, c) for i, c in zip(docs, copies)])
                if None in found:
                    raise ValueError(f"shard {shard} does not have a document of its ledger")
                base = np.asarray(part.column("base"))
                each = list(zip(*[summary(ids) for _, ids in found]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(base + [s for s, _ in found], pa.int64()),
                        pa.array([len(ids) for _, ids in found], pa.int64()),
                        *[pa.array(list(x)) for x in each],
                    ],
                    names=["doc_id", "start", "n_ids", *kinds],
                )

    placed = ledger.join(F.broadcast(bases(ledger)), F.col("shard") == F.col("b_shard"))
    return placed.select("shard", "doc_id", "copy", "base").mapInArrow(
        run, f"doc_id {id_type}, start bigint, n_ids bigint, {fields}"
    )


def folder_for(spark: SparkSession) -> str:
    return new_folder(spark, "tokens")
