"""Token ids in raw binary shards with a minimal perfect hash index per shard.

Documents are range-partitioned and sorted by id. A task writes its ids, little-endian
and unsigned, to ``shard-N.ids`` and an index to ``shard-N.mph``. The index is a
minimal perfect hash in levels (Limasset et al. 2017): a key is looked up in one bit
array per level and the rank of its bit is its slot, which stores a fingerprint, the
place of the document's first id and the number of ids. Keys are not stored; a key
that was never written is told by its fingerprint, up to one in 2**32.

Files go through ``pyarrow.fs``, so the folder may be any store that knows; each attempt of
a task writes under a name of its own and moves the file into place at the end.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import kept_for, picked, texts_of
from silverlode.session import scratch_path, stage

#: Id that ends each document.
END_ID = 2
#: Bits per key on each level of the index.
GAMMA = 2
#: Documents whose ids are read at once.
READ_DOCS = 256
#: Chunks of texts whose ids a worker keeps.
KEPT_CHUNKS = 1_200_000
#: Marks that end a word of letters.
END_MARKS = ".,;:!?"
#: How byte-level vocabularies write a blank.
BLANK = "\u0120"
#: Texts cut at once.
CUT_TEXTS = 256
#: Chunks encoded as one text.
JOINED_CHUNKS = 4096

HEAD = struct.Struct("<8sIIIIQ")  # magic, width, keys, levels, bits, ids
MAGIC = b"SLIDX001"
SLOT = np.dtype([("print", "<u4"), ("n", "<u4"), ("start", "<u8")])


class BlankSplitEncoder:
    """``tokenizers`` over texts cut before blanks, each distinct piece encoded once per cache.

    Byte-level tokenizers begin a word at every blank that a visible character follows,
    so the pieces' ids in order are the text's ids. Texts with special strings, and other
    kinds of tokenizers, are encoded whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        data = json.loads(spec)
        pre = data.get("pre_tokenizer") or {}
        self.pieces = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not data.get("normalizer")
        self.special = [t["content"] for t in data.get("added_tokens", [])]
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.code = "H" if self.width == 2 else "I"
        self.gap = regex.compile(r" (?=\S)").split
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.marks = dict(zip(END_MARKS, self._raw(list(END_MARKS)), strict=True))
        vocab = self.tok.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t[:1] == BLANK]] = True

    def _raw(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 4096):  # the library's result objects are large
            found = self.tok.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
            if sys.byteorder == "little":
                out += [array(self.code, e.ids).tobytes() for e in found]
            else:
                out += [np.array(e.ids, self.kind).tobytes() for e in found]
        return out

    def _raw_later(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks, each with a blank before it.

        A chunk without a blank inside has only that one, and a word begins there, so many
        are encoded as one text and cut where tokens begin with a blank.
        """
        out: list[bytes] = []
        for at in range(0, len(chunks), JOINED_CHUNKS):
            some = chunks[at : at + JOINED_CHUNKS]
            joined = " " + " ".join(some)
            found = None
            if joined.count(" ") == len(some) and not any(s in joined for s in self.special):
                ids = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
                edges = np.flatnonzero(self.opens[ids]) * self.width
                if len(edges) == len(some):
                    raw, places = ids.tobytes(), edges.tolist()
                    found = [raw[a:b] for a, b in zip(places, [*places[1:], len(raw)], strict=True)]
            out += found or self._raw([" " + c for c in some])
        return out

    def _looked_up(self, parts: list[str]) -> tuple[list[bytes | None], list[tuple[int, str]]]:
        """What is known of a cut text, and the places and pieces that are not."""
        known = list(map(self.later.get, parts))
        known[0] = self.first.get(parts[0])
        return known, [(k, parts[k]) for k, v in enumerate(known) if v is None] if None in known else []

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        if not self.pieces:
            return self._raw(texts)
        return [raw for at in range(0, len(texts), CUT_TEXTS) for raw in self._encode_cut(texts[at : at + CUT_TEXTS])]

    def _encode_cut(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are cut into chunks; all their chunks are held at once."""
        if len(self.first) + len(self.later) > KEPT_CHUNKS:
            # frequent pieces come early: the older half stays
            self.first.clear()
            self.later = dict(islice(self.later.items(), KEPT_CHUNKS // 2))
        out: list[bytes] = [b""] * len(texts)
        whole: list[int] = []
        cut: list[tuple[int, list[bytes | None], list[tuple[int, str]]]] = []
        heads: set[str] = set()
        rests: set[str] = set()
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                whole.append(i)
                continue
            parts = t.split(" ")
            known, new = self._looked_up(parts)
            if any(k and (not c or c[0].isspace()) for k, c in new):  # several white-space characters in a row
                parts = self.gap(t)
                known, new = self._looked_up(parts)
            for k, c in new:
                (rests if k else heads).add(c)
            cut.append((i, known, new))
        fresh = list(heads)
        self.first.update(zip(fresh, self._raw(fresh), strict=True))
        fresh = []
        for c in rests:
            word = self.later.get(c[:-1]) if c[-1] in self.marks and c[:-1].isalpha() else None
            if word is None:
                fresh.append(c)
            else:  # a word ends where its letters do
                self.later[c] = word + self.marks[c[-1]]
        fresh.sort(key=lambda c: " " in c)  # those with blanks inside come last
        self.later.update(zip(fresh, self._raw_later(fresh), strict=True))
        for i, known, new in cut:
            for k, c in new:
                known[k] = self.later[c] if k else self.first[c]
            out[i] = b"".join(known)
        for i, raw in zip(whole, self._raw([texts[i] for i in whole]), strict=True):
            out[i] = raw
        return out


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser (splitmix64) of ``x`` under a seed."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hash(ids: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    """Hash of (document id, its how-manieth row), both as unsigned 64-bit numbers."""
    return mixed(mixed(ids, seed) ^ turn, seed + 1)


def build_index(ids: np.ndarray, turn: np.ndarray, start: np.ndarray, n: np.ndarray, width: int) -> bytes:
    """Index of distinct keys (ids[i], turn[i]) to (start[i], n[i])."""
    left, bits, sizes = np.arange(len(ids)), [], []
    slots_at = np.zeros(len(ids), np.int64)
    offset = 0
    while len(left):
        m = max(8, GAMMA * len(left))
        h = (key_hash(ids[left], turn[left], 2 * len(sizes)) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(h, minlength=m) == 1
        fits = alone[h]
        slots_at[left[fits]] = offset + h[fits]
        bits.append(alone)
        sizes.append(m)
        offset += m
        left = left[~fits]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(flat) - 1
    slots = np.zeros(len(ids), SLOT)
    at = rank[slots_at] if len(ids) else slots_at
    slots["print"][at] = (key_hash(ids, turn, 1001) >> np.uint64(32)).astype("<u4")
    slots["n"][at], slots["start"][at] = n, start
    return HEAD.pack(MAGIC, width, len(ids), len(sizes), len(flat), int(n.sum())) + np.array(sizes, "<u4").tobytes() + np.packbits(flat).tobytes() + slots.tobytes()


class Index:
    """A shard's index in memory; ``find`` takes constant time a key."""

    def __init__(self, data: bytes):
        magic, self.width, self.keys, levels, bits, self.total = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an index file")
        at = HEAD.size
        self.sizes = np.frombuffer(data, "<u4", levels, at)
        at += 4 * levels
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8, (bits + 7) // 8, at), count=bits).astype(bool)
        self.rank = np.cumsum(self.bits) - 1
        self.slots = np.frombuffer(data, SLOT, self.keys, at + (bits + 7) // 8)

    def find(self, ids: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, start, n) of each key."""
        slot, left, offset = np.full(len(ids), -1), np.arange(len(ids)), 0
        for level, m in enumerate(self.sizes):
            h = offset + (key_hash(ids[left], turn[left], 2 * level) % np.uint64(m)).astype(np.int64)
            there = self.bits[h]
            slot[left[there]] = self.rank[h[there]]
            left, offset = left[~there], offset + int(m)
        known = slot >= 0
        if self.keys:
            known &= self.slots["print"][slot] == (key_hash(ids, turn, 1001) >> np.uint64(32)).astype("<u4")
            return known, self.slots["start"][slot].astype(np.int64), self.slots["n"][slot].astype(np.int64)
        return known, np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)


def keys_of(ids: pa.Array, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned key columns; a NULL id is its own key, marked in the top bit of the turn."""
    null = np.asarray(ids.is_null())
    raw = np.asarray(ids.fill_null(0)).astype(np.int64).view(np.uint64)
    return raw, turn.astype(np.uint64) | (null.astype(np.uint64) << np.uint64(63))


def shard_name(shard: int, kind: str) -> str:
    return f"shard-{shard:06d}.{kind}"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def encoder_of(spec: str) -> BlankSplitEncoder:
    """One encoder per worker process; the last one asked for is kept."""
    kept = kept_for("token_files")
    if hash(spec) not in kept:
        kept.clear()
        kept[hash(spec)] = BlankSplitEncoder(spec)
    return kept[hash(spec)]


def total_of(head: bytes) -> int:
    """Ids in the shard, from the first bytes of its index."""
    return HEAD.unpack_from(head)[-1]


def write_ids(df: DataFrame, spec: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the shards of ``df`` below ``path``; returns the staged list (shard, doc_id, turn).

    NULL texts count as empty: only the end id is written. Rows of one id are told apart
    by ``turn``, their number in the shard, ordered by text hash; NULL ids come first.
    An empty table writes no shard.
    """
    shared = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(shared.value)
        shard = TaskContext.get().partitionId()
        fs, root = opened(path)
        fs.create_dir(root, recursive=True)
        ids, lengths, names = [], [], []
        end = np.array([end_id], enc.kind).tobytes()
        temp = f"{root}/.{shard_name(shard, 'ids')}.{uuid.uuid4().hex}"
        out = None
        for b in batches:
            if not b.num_rows:
                continue
            out = out or fs.open_output_stream(temp)
            raw = enc.encode(texts_of(b))
            out.write(b"".join(x + end for x in raw))
            lengths += [len(x) // enc.width + 1 for x in raw]
            ids.append(b.column(0))
        if out is None:
            return
        out.close()
        every = pa.chunked_array(ids).combine_chunks()
        every = every if isinstance(every, pa.Array) else every.chunk(0)
        raw_ids, null = keys_of(every, np.zeros(len(every)))
        fresh = np.ones(len(every), bool)
        fresh[1:] = (raw_ids[1:] != raw_ids[:-1]) | (null[1:] != null[:-1])
        places = np.arange(len(every))
        turn = places - np.maximum.accumulate(np.where(fresh, places, 0))
        n = np.array(lengths, np.int64)
        start = np.cumsum(n) - n
        index = build_index(*keys_of(every, turn), start, n, enc.width)
        with fs.open_output_stream(f"{temp}.mph") as f:
            f.write(index)
        fs.move(f"{temp}.mph", f"{root}/{shard_name(shard, 'mph')}")
        fs.move(temp, f"{root}/{shard_name(shard, 'ids')}")
        for i in range(0, len(every), 10_000):
            part = every.slice(i, 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), shard, np.int32)), part, pa.array(turn[i : i + 10_000].astype(np.int64))], ["shard", "doc_id", "turn"])

    order = ["doc_id", "copy"]
    d = picked(df, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("copy", F.xxhash64("text"))
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stage(d.mapInArrow(run, "shard int, doc_id long, turn long"), "id-list")


def read_ids(listed: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the listed keys, looked up in the shard files.

    ``start`` counts the ids of all documents before it, over all shards in order.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        for b in batches:
            shards = b.column(0).to_pylist()
            sums = []
            for s in shards:
                with fs.open_input_file(f"{root}/{shard_name(s, 'mph')}") as f:
                    sums.append(total_of(f.read(64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums, pa.int64())], ["shard", "n"])

    # one row per shard file, which the number of files bounds
    sums = sorted(map(tuple, listed.select("shard").distinct().mapInArrow(totals, "shard int, n long").collect()))
    before, at = {}, 0
    for s, n in sums:
        before[s] = at
        at += n
    shared = listed.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        current, index, file = None, None, None
        for b in batches:
            shards = np.asarray(b.column(0))
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if shards[lo] != current:
                    current = int(shards[lo])
                    with fs.open_input_file(f"{root}/{shard_name(current, 'mph')}") as f:
                        index = Index(f.read())
                    file = fs.open_input_file(f"{root}/{shard_name(current, 'ids')}")
                ids = b.column(1).slice(lo, hi - lo)
                known, start, n = index.find(*keys_of(ids, np.asarray(b.column(2))[lo:hi]))
                if not known.all():
                    raise ValueError(f"shard {current} lacks listed keys")
                crc = np.zeros(hi - lo, np.int64)
                for i in range(0, hi - lo, READ_DOCS):
                    s, k = start[i : i + READ_DOCS], n[i : i + READ_DOCS]
                    if int((s + k).max() - s.min()) <= 2 * int(k.sum()):  # neighbours: one read
                        raw, base = file.read_at(int((s + k).max() - s.min()) * index.width, int(s.min()) * index.width), int(s.min())
                        cut = lambda a, m: raw[(a - base) * index.width : (a - base + m) * index.width]  # noqa: E731, B023
                    else:
                        cut = lambda a, m: file.read_at(m * index.width, a * index.width)  # noqa: E731, B023
                    for j, (a, m) in enumerate(zip(s.tolist(), k.tolist(), strict=True)):
                        crc[i + j] = zlib.crc32(np.frombuffer(cut(a, m), f"<u{index.width}").astype("<u4"))
                yield pa.RecordBatch.from_arrays([ids, pa.array(start + shared.value[current]), pa.array(n), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.select("shard", "doc_id", "turn").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(df: DataFrame, spec: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch area and read it back."""
    path = scratch_path(df.sparkSession, "ids")
    return read_ids(write_ids(df, spec, path), path)
