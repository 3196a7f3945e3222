"""Byte-level BPE: exact merges, a frequent-word transducer and the inverse mapping.

The lexicon is a minimal acyclic transducer (Mohri 1997; Daciuk et al. 2000): frequent
words share prefixes and suffixes in one automaton, the outputs on its arcs add up to
the word's number, and the number points into a flat array of token ids. It is built
from the corpus' own most frequent words, broadcast as bytes (bounded by the number of
words) and memory-mapped by the workers. Words outside it are merged exactly, so the
lexicon changes the speed, never the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import string
import struct
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import WordCache, give_back, kept_for, picked, texts_of
from silverlode.session import stage

#: How the byte-level scheme cuts a text into words before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Frequent words in the lexicon; bounds what the driver builds and broadcasts.
LEXICON_WORDS = 32_768
#: Longest lexicon word in bytes.
LEXICON_BYTES = 64
#: Chunks whose ids a worker keeps, and other words; frequent ones come early, so the oldest chunks stay.
KEPT_CHUNKS = 560_000
KEPT_WORDS = 50_000
#: Characters of texts whose new chunks are encoded together, about, and words merged at once.
SLICE_CHARS = 500_000
MERGED_AT_ONCE = 20_000
#: Words one task counts before it passes its counts on.
COUNTER_WORDS = 400_000

#: Marks that may end a word of letters: a run of them is one word, so it needs no pattern.
ANY_MARKS = string.punctuation
#: Words of so many characters, marks and numbers mostly, are kept one by one.
SHORT = 3
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest follows from 256."""
    keeps = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in keeps:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class PairTable:
    """The merge of many pairs of ids at once: an open hash table in two arrays."""

    def __init__(self, rank: dict[int, int]):
        keys, values = np.fromiter(rank, np.int64, len(rank)), np.fromiter(rank.values(), np.int64, len(rank))
        self.bits = max(8, int(4 * len(rank)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1), np.full(1 << self.bits, NEVER)
        self.probes = 0
        at = self._place(keys)
        while len(keys):  # a pair whose place is taken tries the next one
            self.probes += 1
            free = np.flatnonzero(self.keys[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            now = free[one]
            self.keys[at[now]], self.values[at[now]] = keys[now], values[now]
            keys, values, at = np.delete(keys, now), np.delete(values, now), np.delete(at, now)
            at = (at + 1) & len(self.keys) - 1

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << ID_BITS | right
        at = self._place(pairs)
        found = self.keys[at]
        out = np.where(found == pairs, self.values[at], NEVER)
        open_ = np.flatnonzero((found != pairs) & (found >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = at[open_] + 1 & len(self.keys) - 1
            found = self.keys[at[open_]]
            hit = found == pairs[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Merges:
    """Ids, merge ranks and special strings of a byte-level BPE file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        vocab = data["model"]["vocab"]
        byte_of = {c: bytes([b]) for b, c in enumerate(byte_symbols())}
        self.first = [vocab[c] for c in byte_symbols()]
        # pair of ids to rank and merged id, both packed in one number; the smallest is the lowest rank
        self.rank: dict[int, int] = {}
        for i, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << ID_BITS | vocab[b]] = i << ID_BITS | vocab[a + b]
        self.byte_pairs = [self.rank.get(a << ID_BITS | b, NEVER) for a in self.first for b in self.first]
        self.table: PairTable | None = None
        self.bytes_of = {i: b"".join(byte_of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: always the lowest-ranked pair, the leftmost of equals."""
        ids, get, pairs = list(map(self.first.__getitem__, word)), self.rank.get, self.byte_pairs
        if len(ids) > 40:
            return self._merge_long(ids)
        ranks = [pairs[a << 8 | b] for a, b in zip(word, word[1:])]
        ranks.append(NEVER)  # no pair begins with the last id
        last = len(ids) - 1
        while (low := min(ranks)) != NEVER:
            i, new = ranks.index(low), low & ID_MASK
            ids[i] = new
            del ids[i + 1], ranks[i]
            last -= 1
            if i:
                ranks[i - 1] = get(ids[i - 1] << ID_BITS | new, NEVER)
            if i < last:
                ranks[i] = get(new << ID_BITS | ids[i + 1], NEVER)
        return ids

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """:meth:`merge` of many words: in each step every word that still has a pair makes its next merge."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for lo in range(0, len(order), MERGED_AT_ONCE):
            some = order[lo : lo + MERGED_AT_ONCE]
            while some and len(words[some[-1]]) > 40:
                out[some[-1]] = self.merge(words[some[-1]])
                some.pop()
            if some:
                self._merge_rows(some, words, out)
        return out

    def _merge_rows(self, some: list[int], words: list[bytes], out: list) -> None:
        if self.table is None:
            self.table, self.first_ids, self.first_pairs = PairTable(self.rank), np.array(self.first, np.int64), np.array(self.byte_pairs, np.int64)
        sizes = np.fromiter((len(words[i]) for i in some), np.int64, len(some))
        width = int(sizes.max())
        raw = np.zeros((len(some), width + 1), np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        raw[inside] = np.frombuffer(b"".join([words[i] for i in some]), np.uint8)
        ids = np.where(inside, self.first_ids[raw], ID_MASK)  # no id behind the end, so no pair with it
        ranks = np.full(ids.shape, NEVER)
        ranks[:, :-1] = np.where(inside[:, 1:], self.first_pairs[raw[:, :-1] << 8 | raw[:, 1:]], NEVER)
        which = np.array(some)
        while len(which):
            at = ranks.argmin(1)  # the leftmost of equals
            row = np.arange(len(which))
            low = ranks[row, at]
            done = low == NEVER
            if done.any():
                own = ids[done]
                there = own != ID_MASK
                flat, ends = own[there].tolist(), np.cumsum(there.sum(1)).tolist()
                start = 0
                for i, end in zip(which[done].tolist(), ends, strict=True):
                    out[i] = flat[start:end]
                    start = end
                more = ~done
                which, ids, ranks, at, low = which[more], ids[more], ranks[more], at[more], low[more]
                row = row[: len(which)]
            if not len(which):
                break
            new, columns = low & ID_MASK, np.arange(ids.shape[1])
            ids[row, at] = new
            ids = ids[columns != at[:, None] + 1].reshape(len(which), -1)
            ranks = ranks[columns != at[:, None]].reshape(len(which), -1)
            # a word's last column is never a place of a pair, so there is one behind each merged id
            ranks[row, at] = self.table.of(new, ids[row, np.minimum(at + 1, ids.shape[1] - 1)])
            inner = np.flatnonzero(at)
            ranks[inner, at[inner] - 1] = self.table.of(ids[inner, at[inner] - 1], new[inner])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for words of any length."""
        rank, n = self.rank, len(ids)
        left, right, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (m := rank.get(ids[i] << ID_BITS | ids[j])) is not None:
                heapq.heappush(heap, (m >> ID_BITS, i, ids[i], ids[j], m & ID_MASK))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = new, -1, right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [x for x in ids if x >= 0]


def build_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """Compile (word, ids), words distinct and in byte order, into a minimal automaton as bytes.

    Layout: counts; first arc of each state and its final flag; arc labels; arc targets;
    arc outputs; offsets into the ids; ids. Numbers are little-endian and unsigned.
    """
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    sizes: list[int] = []  # words below a state

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
            sizes.append(int(node[0]) + sum(sizes[t] for _, t in node[1]))
        return known[key]

    path: list[list] = [[False, []]]  # nodes of the last word: final flag, frozen arcs
    last, offsets, flat = b"", [0], []
    for word, ids in entries:
        if word <= last and len(offsets) > 1:
            raise ValueError("words must be distinct and in byte order")
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
        flat += ids
        offsets.append(len(flat))
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(node)))
    root = freeze(path[0])
    first, labels, targets, outputs, arcs = [], bytearray(), [], [], 0
    for final, own in states:
        first.append(arcs << 1 | final)
        before = int(final)
        for label, target in own:
            labels.append(label)
            targets.append(target)
            outputs.append(before)
            before += sizes[target]
            arcs += 1
    first.append(arcs << 1)
    labels += bytes(-len(labels) % 4)
    head = struct.pack("<5I", len(states), arcs, root, len(offsets), len(flat))
    return head + b"".join(struct.pack(f"<{len(x)}I", *x) for x in (first, targets, outputs, offsets, flat)) + bytes(labels)


class Lexicon:
    """Read-only view of a compiled lexicon, memory-mapped from a file that has no name."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:  # the mapping outlives the file, nothing stays behind
            f.write(data)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, arcs, self.root, offsets, flat = struct.unpack_from("<5I", self.map)
        whole, at = memoryview(self.map), 20
        for name, size in (("first", n + 1), ("targets", arcs), ("outputs", arcs), ("offsets", offsets), ("flat", flat)):
            setattr(self, name, whole[at : at + 4 * size].cast("I"))
            at += 4 * size
        self.labels = at
        self.known: dict[int, dict] = {}
        self.start = self._state(self.root)

    def _state(self, s: int) -> dict:
        """A state seen for the first time: only its number, under None."""
        return self.known.setdefault(s, {None: s})

    def _open(self, state: dict) -> dict:
        """Arcs of a state by their byte, read from the map on the first visit: (target, output)."""
        for k in range(self.first[state[None]] >> 1, self.first[state[None] + 1] >> 1):
            state[self.map[self.labels + k]] = (self._state(self.targets[k]), self.outputs[k])
        return state

    def ids(self, word: bytes) -> list[int] | None:
        """Ids of ``word``, or None where the automaton does not accept it."""
        state, number = self.start, 0
        for b in word:
            step = state.get(b)
            if step is None and (len(state) > 1 or (step := self._open(state).get(b)) is None):
                return None
            state, before = step
            number += before
        if not self.first[state[None]] & 1:
            return None
        return self.flat[self.offsets[number] : self.offsets[number + 1]].tolist()


words_in = regex.compile(PATTERN).findall


def cut(chunk: str) -> list[str]:
    """Words of a chunk that stood after a blank; letters and a run of marks behind them need no pattern."""
    if chunk.isalpha():
        return [" " + chunk]
    stem = chunk.rstrip(ANY_MARKS)
    if stem.isalpha():
        return [" " + stem, chunk[len(stem) :]]
    return words_in(" " + chunk)


class Codec:
    """Encode and decode texts; exact with and without a lexicon."""

    def __init__(self, spec: str, lexicon: bytes | None = None):
        self.merges = Merges(spec)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.words = words_in
        self.gap = regex.compile(r" (?=\S)").split
        self.first = WordCache(lambda c: self._chunk(c), most=KEPT_WORDS)
        self.later = WordCache(lambda c: self._later(c), most=KEPT_CHUNKS, stay=KEPT_CHUNKS * 3 // 4)
        self.joined = WordCache(self._word, most=KEPT_WORDS, stay=KEPT_WORDS * 3 // 4)
        self.decimal = {i: str(i) for i in self.merges.bytes_of}
        self.bytes_of = {self.decimal[i]: b for i, b in self.merges.bytes_of.items()}

    def word_ids(self, word: str) -> list[int]:
        raw = word.encode()
        found = self.lexicon.ids(raw) if self.lexicon and len(raw) <= LEXICON_BYTES else None
        return self.merges.merge(raw) if found is None else found

    def _word(self, word: str) -> str:
        return ",".join(map(self.decimal.__getitem__, self.word_ids(word)))

    def _meet(self, new: Iterable[str]) -> dict[str, str]:
        """Ids of these chunks, all their words together; the cache keeps what it has room for."""
        later, cuts, words = self.later, {}, {}
        for c in new:
            if not c or len(c) > later.longest or c[0].isspace():
                continue
            cuts[c] = own = cut(c)
            for w in own:
                if w not in words:
                    words[w] = later.get(w[1:]) if w[0] == " " and w[1:].isalpha() else self.joined[w] if len(w) <= SHORT else None
        rest = []
        for w, found in words.items():
            if found is None:
                raw = w.encode()
                ids = self.lexicon.ids(raw) if self.lexicon and len(raw) <= LEXICON_BYTES else None
                if ids is None:
                    rest.append((w, raw))
                else:
                    words[w] = ",".join(map(self.decimal.__getitem__, ids))
        for (w, _), ids in zip(rest, self.merges.merge_all([raw for _, raw in rest]), strict=True):
            words[w] = ",".join(map(self.decimal.__getitem__, ids))
        met = {c: ",".join([words[w] for w in own]) if len(own) > 1 else words[own[0]] for c, own in cuts.items()}
        if len(later) < later.most:
            later.update(islice(met.items(), later.most - len(later)))
        return met

    def encode_each(self, texts: list[str]) -> Iterator[str]:
        """:meth:`encode_joined` of each text; the new chunks of neighbours are encoded together."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and size < SLICE_CHARS:
                size += len(texts[to])
                to += 1
            looked, new = [], {}
            for t in texts[at:to]:
                chunks = None if any(s in t for s in self.merges.special) else t.split(" ")
                found = list(map(self.later.get, chunks or ()))
                if None in found:
                    new.update([(c, None) for c, x in zip(chunks, found, strict=True) if x is None])
                looked.append((t, chunks, found))
            met = self._meet(new)
            for t, chunks, found in looked:
                yield self._completed(t, chunks, found, met)
            at = to

    def _completed(self, text: str, chunks: list[str] | None, found: list[str | None], met: dict[str, str]) -> str:
        if chunks is None:
            return self.encode_joined(text)
        found[0], i = "", 0
        try:
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                found[i] = met.get(chunks[i]) or self.later[chunks[i]]
        except Adjoining:
            return self.encode_joined(text)
        if chunks[0]:
            found[0] = self.first[chunks[0]]
            return ",".join(found)
        return ",".join(found[1:])

    def _chunk(self, chunk: str) -> str:
        return ",".join(map(self.joined.__getitem__, self.words(chunk)))

    def _later(self, chunk: str) -> str:
        """A chunk that stood after a blank. White space next to that blank would belong to one word with it."""
        if not chunk or chunk[0].isspace():
            raise Adjoining
        if chunk.isalpha():
            return self._word(" " + chunk)
        return ",".join(map(self.joined.__getitem__, cut(chunk)))

    def _plain(self, text: str) -> list[str]:
        head, *rest = text.split(" ")
        try:
            later = list(map(self.later.__getitem__, rest))
        except Adjoining:
            # a blank before a visible character always starts a word, other blanks need the pattern
            head, *rest = self.gap(text)
            later = [self._chunk(" " + c) if c[:1].isspace() else self.later[c] for c in rest]
        return [self.first[head], *later] if head else later

    def encode_parts(self, text: str) -> list[str]:
        """Decimal ids joined by commas, in parts of a chunk or a special string each."""
        if not text:
            return []
        m = self.merges
        if m.cut is None or not any(s in text for s in m.special):
            return self._plain(text)
        out: list[str] = []
        for p in m.cut.split(text):
            if p:
                out += [str(m.special[p])] if p in m.special else self._plain(p)
        return out

    def encode_joined(self, text: str) -> str:
        """Decimal ids joined by commas."""
        return ",".join(self.encode_parts(text))

    def encode(self, text: str) -> list[int]:
        return numbers(self.encode_joined(text))

    def decode_joined(self, joined: str) -> str:
        return b"".join(map(self.bytes_of.__getitem__, joined.split(","))).decode("utf-8", "replace") if joined else ""

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters, ids out of range vanish."""
        return b"".join(self.merges.bytes_of.get(i, b"") for i in ids).decode("utf-8", "replace")


def numbers(joined: str) -> list[int]:
    return [int(i) for i in joined.split(",")] if joined else []


class Adjoining(Exception):
    """White space of several characters: blanks cannot be taken one by one."""


def count_words(df: DataFrame, spec: str, text: str = "text") -> DataFrame:
    """(word, n) over all texts, words as the tokenizer cuts them.

    A task adds up its own words first and hands them on when it holds
    ``COUNTER_WORDS`` of them, so frequent words shuffle a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> pa.RecordBatch:
            words: dict[str, int] = {}
            for found, to_words in ((later, cut), (heads, words_in)):
                for chunk, n in found.items():
                    for w in to_words(chunk):
                        if len(w) <= LEXICON_BYTES:
                            words[w] = words.get(w, 0) + n
                found.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()), "n": pa.array(list(words.values()), pa.int64())})

        later: Counter = Counter()
        heads: Counter = Counter()
        for b in batches:
            for t in texts_of(b):
                head, *rest = t.split(" ")
                heads[head] += 1
                later.update(rest)
                if len(later) + len(heads) > COUNTER_WORDS:
                    yield handed()
        if later or heads:
            yield handed()
        give_back()

    return picked(df, text=text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpus_lexicon(df: DataFrame, spec: str, text: str = "text", words: int = LEXICON_WORDS) -> bytes:
    """Lexicon of the most frequent words of all texts, at most ``words`` of them.

    Frequencies fall into steps of an eighth of an octave, a few hundred at most; the
    lexicon takes whole steps from the top while they fit.
    """
    counts = stage(count_words(df, spec, text).withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "words")
    least, total = None, 0
    for step, n in sorted(map(tuple, counts.groupBy("step").count().collect()), reverse=True):
        total += n
        if total > words:
            break
        least = step
    top = counts.where(F.col("step") >= least).select("word") if least is not None else counts.limit(0).select("word")
    merges = Merges(spec)
    entries = sorted(r["word"].encode() for r in top.collect())
    return build_lexicon((w, merges.merge(w)) for w in entries if w)


def codec_of(spec: str, lexicon: bytes | None) -> Codec:
    """One codec per worker process, so its caches outlive a task; the last one asked for is kept."""
    kept, key = kept_for("bpe"), (hash(spec), hash(lexicon))
    if key not in kept:
        kept.clear()
        kept[key] = Codec(spec, lexicon)
    return kept[key]


def _mapped(df: DataFrame, spec: str, lexicon: bytes | None, columns: dict[str, str], make, schema: str) -> DataFrame:
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((spec, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(*shared.value)
        for b in batches:
            yield make(codec, b)

    return picked(df, **columns).mapInArrow(run, schema)


def encode(df: DataFrame, spec: str, lexicon: bytes | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): token ids of each whole text. A NULL or empty text has no ids; repeated rows stay."""

    def make(codec, b):
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([numbers(x) for x in codec.encode_each(texts_of(b))], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _mapped(df, spec, lexicon, {"doc_id": key, "text": text}, make, "doc_id long, ids array<int>")


def decode(df: DataFrame, spec: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text): text of token ids. NULL ids give the empty text."""

    def make(codec, b):
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([codec.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return _mapped(df, spec, None, {"doc_id": key, "ids": ids}, make, "doc_id long, text string")


def round_trip(df: DataFrame, spec: str, lexicon: bytes | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of encoding and of decoding what was encoded, one row per input row.

    doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (UTF-8 of
    the decoded text). A NULL text counts as empty: no tokens, digests of nothing.
    """

    def make(codec, b):
        sha, n, ids, back = hashlib.sha256, [], [], []
        for joined in codec.encode_each(texts_of(b)):
            n.append(joined.count(",") + 1 if joined else 0)
            ids.append(sha(joined.encode()).hexdigest())
            back.append(sha(codec.decode_joined(joined).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(df, spec, lexicon, {"doc_id": key, "text": text}, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_round_trip(df: DataFrame, spec: str) -> DataFrame:
    """Learn the lexicon from ``df`` and return :func:`round_trip` of ``df`` with it."""
    return round_trip(df, spec, corpus_lexicon(df, spec))
