"""Brown's class model of word pairs: P(word | before) = P(class | class before) P(word | class).

Texts are kept as numbers into a dictionary of their block of documents, so a task holds one
block and a block's words meet the corpus counts in one join, however large the vocabulary.
Blocks stay where they were read: for scores only sums and rare words move.

Units. What the exchange moves is a unit: a word with at least ``SHARE`` of all training
tokens (there are at most 1 / ``SHARE``), or all rarer words, unknown ones included, with
one ending. So every training token counts and what tasks receive has a bound. Units start
in classes by turns. In each pass a unit's neighbours are counted by class over all pairs
of units; units, dealt over tasks, move one after another to the class that gains the most
likelihood, with the moves of other tasks seen in the next pass (Uszkoreit and Brants 2008).
A pass that lost goes back to the best classes so far, and fewer units move in the next. The end of a text is a class of its own.

Smoothing. Transitions are shrunk to the classes' own shares. A class gives each of its known
words its count less a discount (from the numbers of words seen once and twice) and what
is left to the words it does not know, so probabilities of known words and one unknown sum
to 1 in every class.

Edge cases. NULL and empty texts have one token, the end. Very long texts are used whole. Rows
without an id are never held out. Repeated rows count as often as they stand. Without
training rows every class is equally likely and knows no word; an empty table has no rows.
Words are told apart by 64 bits of hash. Further columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import WordCache, give_back, picked, texts_of
from silverlode.session import stage

#: Tokens of a block of documents, about; no document is divided.
BLOCK = 2_000_000
#: Tokens of a block that are scored at once, about.
SLICE = 200_000
#: Part of all training tokens that makes a word a unit of its own.
SHARE = 1e-4
#: Units of rarer words, by a hash of the ending.
ENDINGS = 1024
#: Classes, the end's included.
CLASSES = 64
PASSES = 10
#: Tasks that units are dealt over in a pass.
DEALT = 16
#: Part of the corpus that is held out: one in so many.
FOLDS = 10
#: Weight of a class's own share against what follows another class.
SHRINK = 8.0
#: Added to every count of the plain model.
PLAIN = 0.1
#: The end of a text; no word has this number.
END = 0
MARKS = b".,;:!?)]}\"'"


def word_id(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return (h - (1 << 64) if h >> 63 else h) or 1


def ending(word: bytes) -> int:
    """Number of the group that a rare word falls in: its last three bytes and the mark behind them."""
    stem = word.rstrip(MARKS)
    return zlib.crc32(stem[-3:] + b"|" + word[len(stem) :][:1]) % ENDINGS


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only


class Dictionary(dict):
    """Numbers of words in order of appearance; 0 is the end."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def in_blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, held, lengths, codes, words, endings): a row per block of (doc_id, held_out, text).

    ``codes`` are 32-bit numbers into ``words`` (64 bits each) and ``endings`` (16 bits),
    whose first entry is the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, endings = WordCache(word_id, most=200_000), WordCache(ending, most=200_000)
        part = (TaskContext.get().partitionId()) << 32
        made = 0
        words, ids, held, lengths, codes, size = Dictionary(), [], [], [], [], 0

        def block() -> pa.RecordBatch:
            row = {
                "block": pa.array([part + made], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "codes": pa.array([np.concatenate(codes).tobytes()], pa.binary()),
                "words": pa.array([np.fromiter([END, *map(hashes.__getitem__, words)], np.int64, len(words) + 1).tobytes()], pa.binary()),
                "endings": pa.array([np.fromiter([0, *map(endings.__getitem__, words)], np.uint16, len(words) + 1).tobytes()], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for b in batches:
            for at in range(0, b.num_rows, 500):
                some = b.slice(at, 500)
                for i, h, t in zip(some.column("doc_id").to_pylist(), some.column("held_out").to_pylist(), texts_of(some), strict=True):
                    of = words_of(t)
                    n = np.zeros(len(of) + 1, np.int32)
                    n[:-1] = np.fromiter(map(words.__getitem__, of), np.int32, len(of))
                    ids.append(i)
                    held.append(h)
                    lengths.append(len(n))
                    codes.append(n)
                    size += len(n)
                    if size >= BLOCK:
                        yield block()
                        made += 1
                        words, ids, held, lengths, codes, size = Dictionary(), [], [], [], [], 0
        if ids:
            yield block()
        del hashes, endings, words, codes
        give_back()

    return docs.mapInArrow(run, "block long, ids array<long>, held array<boolean>, lengths array<long>, codes binary, words binary, endings binary")


class Block(NamedTuple):
    ids: pa.Array
    held: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    words: np.ndarray
    endings: np.ndarray

    @property
    def trained(self) -> np.ndarray:
        """The codes of the texts learned from, one behind the other, each with its end."""
        return self.codes[np.repeat(~self.held, self.lengths)]


def blocks_of(batch: pa.RecordBatch | pa.Table) -> Iterator[Block]:
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i] for c in ("ids", "held", "lengths", "codes", "words", "endings")}
        raw = lambda c, kind: np.frombuffer(row[c].as_buffer(), kind)  # noqa: E731, B023
        yield Block(
            row["ids"].values, np.asarray(row["held"].values), np.asarray(row["lengths"].values),
            raw("codes", np.int32), raw("words", np.int64), raw("endings", np.uint16),
        )


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, ending, n) of all training tokens; each block counts its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in blocks_of(b):
                n = np.bincount(x.trained, minlength=len(x.words))
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(x.words[seen]), pa.array(x.endings[seen].astype(np.int32)), pa.array(n[seen].astype(np.int64))], ["word", "ending", "n"])

    counted = blocks.mapInArrow(run, "word long, ending int, n long")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


class Units(NamedTuple):
    """Frequent words, sorted, and their counts. Unit 0 is the end, rarer words follow by ending."""

    words: np.ndarray
    counts: np.ndarray

    @property
    def n(self) -> int:
        return 1 + len(self.words) + ENDINGS

    def of(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = 1 + len(self.words) + endings.astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            out = np.where(self.words[at] == words, at + 1, out)
        return np.where(words == END, 0, out)


def unit_pairs(blocks: DataFrame, units: Units) -> DataFrame:
    """(u, v, n): how often unit v follows u in training texts; texts begin after an end."""
    shared = blocks.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = shared.value
        for b in batches:
            for x in blocks_of(b):
                of = units.of(x.words, x.endings)[x.trained]
                pair, n = np.unique(np.r_[0, of[:-1]][: len(of)] * units.n + of, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
                del of, pair, n
        give_back()

    pairs = blocks.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.select(F.expr(f"cast(pair DIV {units.n} AS int)").alias("u"), F.expr(f"cast(pair % {units.n} AS int)").alias("v"), "n")


def neighbours(pairs: DataFrame, classes: np.ndarray) -> DataFrame:
    """(u, side, c, n): how often unit u stands before (side 0) and after (side 1) class c; side 2 is u itself."""
    shared = pairs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        found = np.zeros((3, len(classes) * CLASSES), np.int64)  # bounded by the units
        for b in batches:
            u, v, n = (np.asarray(b.column(c)).astype(np.int64) for c in ("u", "v", "n"))
            np.add.at(found[0], u * CLASSES + classes[v], n)
            np.add.at(found[1], v * CLASSES + classes[u], n)
            own = u == v
            np.add.at(found[2], u[own] * CLASSES, n[own])
        side, at = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at // CLASSES, side, at % CLASSES, found[side, at])], ["u", "side", "c", "n"])

    return pairs.mapInArrow(run, "u long, side long, c long, n long").groupBy("u", "side", "c").agg(F.sum("n").alias("n"))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """What the classes add to the log-likelihood of all words on their own."""
    return float(xlogx(matrix).sum() - 2 * xlogx(matrix.sum(1)).sum())


def exchanged(units: list[tuple[int, np.ndarray, np.ndarray, int]], classes: np.ndarray, matrix: np.ndarray) -> list[tuple[int, int]]:
    """Moves units (unit, classes after, classes before, itself) one after another; (unit, class) of each.

    ``matrix`` counts class pairs and follows the moves. The end's class is no one else's.
    """
    matrix = matrix.astype(float)
    out = []
    for u, after, before, itself in units:
        a, n = classes[u], after.sum()
        r, left = after.astype(float), before.astype(float)
        size = matrix.sum(1)
        size[a] -= n
        r[a] -= itself
        left[a] -= itself
        matrix[a] -= r
        matrix[:, a] -= left
        matrix[a, a] -= itself
        was = xlogx(matrix)
        rows, columns = xlogx(matrix + r) - was, xlogx(matrix + left[:, None]) - was
        d = np.arange(len(matrix))
        gain = rows.sum(1) - rows[d, d] + columns.sum(0) - columns[d, d]
        gain += xlogx(matrix[d, d] + r + left + itself) - was[d, d] - 2 * (xlogx(size + n) - xlogx(size))
        gain[0] = -np.inf
        gain[a] += 1e-9  # ties stay
        b = int(gain.argmax())
        matrix[b] += r
        matrix[:, b] += left
        matrix[b, b] += itself
        out.append((u, b))
    return out


def one_pass(found: DataFrame, classes: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Classes after every unit with neighbours had its turn."""
    shared = found.sparkSession.sparkContext.broadcast((classes, matrix))
    listed = found.where("u > 0").groupBy("u").agg(F.collect_list(F.struct("side", "c", "n")).alias("x"), F.sum("n").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix = shared.value
        units = []
        for b in batches:
            for u, x in zip(b.column("u").to_pylist(), b.column("x").to_pylist(), strict=True):
                counts = np.zeros((3, CLASSES), np.int64)
                for e in x:
                    counts[e["side"], e["c"]] = e["n"]
                units.append((u, counts[0], counts[1], int(counts[2, 0])))
        moved = exchanged(units, classes, matrix)
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in moved], pa.int64()), pa.array([c for _, c in moved], pa.int64())], ["u", "c"])

    dealt = listed.repartition(DEALT, "u").sortWithinPartitions(F.desc("size"), "u").select("u", "x")
    out = classes.copy()
    for u, c in dealt.mapInArrow(run, "u long, c long").collect():  # a row per unit
        out[u] = c
    return out


def counted(found: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Class pairs of the classes that the neighbours were counted with."""
    spark = found.sparkSession
    of = spark.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "u long, a long")  # a row per unit
    matrix = np.zeros((CLASSES, CLASSES), np.int64)
    for a, c, n in found.where("side = 0").join(of, "u").groupBy("a", "c").agg(F.sum("n")).collect():
        matrix[a, c] = n
    return matrix


def exchange(pairs: DataFrame, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, class pairs, likelihood before each pass) with the best likelihood found."""
    classes = np.zeros(len(sizes), np.int64)
    classes[1 + np.argsort(-sizes[1:], kind="stable")] = 1 + np.arange(len(sizes) - 1) % (CLASSES - 1)
    best, history, stride = None, [], 1
    for turn in range(PASSES + 1):
        found = stage(neighbours(pairs, classes), "neighbours")
        matrix = counted(found, classes)
        history.append(likelihood(matrix))
        if best is None or history[-1] > best[0]:
            best = (history[-1], classes, matrix, found)
        else:  # too many moved at once: again from the best, fewer of them
            stride *= 2
        _, classes, matrix, found = best
        if turn == PASSES or not matrix.any():
            break
        moved = one_pass(found, classes, matrix)
        moved = np.where((np.arange(len(classes)) + turn) % stride == 0, moved, classes)
        if stride == 1 and (moved == classes).all():
            break
        classes = moved
    return best[1], best[2], history


class Model(NamedTuple):
    """All that scoring needs beside the counts of rare words; its size is bounded by the units'."""

    units: Units
    classes: np.ndarray
    tokens: int
    distinct: int
    ends: int
    discount: float
    #: log10 P(class | class before)
    follows: np.ndarray
    #: training tokens and known words of each class
    sizes: np.ndarray
    known: np.ndarray

    def word_scores(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of known words, and of an unknown one where the count is 0."""
        seen = np.maximum(counts - self.discount, 1e-9)
        new = self.discount * self.known[classes] + 1
        out = np.log10(np.where(counts > 0, seen, new) / (self.sizes[classes] + 1))
        return np.where(classes == 0, 0.0, out)  # the end is all of its class

    def plain_scores(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + PLAIN) / (self.tokens + PLAIN * (self.distinct + 1)))


def transitions(matrix: np.ndarray) -> np.ndarray:
    share = (matrix.sum(0) + 1) / (matrix.sum() + len(matrix))
    return np.log10((matrix + SHRINK * share) / (matrix.sum(1, keepdims=True) + SHRINK))


def learned(blocks: DataFrame, counts: DataFrame) -> tuple[Model, list[float]]:
    """Model of the blocks' training texts, and the likelihood before each pass of the exchange."""
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.coalesce(F.max(F.when(F.col("word") == END, F.col("n"))), F.lit(0))
    ).first()
    tokens, distinct, once, twice, ends = total
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    own = (F.col("n") >= max(1, int(np.ceil(SHARE * tokens)))) & (F.col("word") != END)
    rows = sorted(tuple(r) for r in counts.where(own).select("word", "n").collect())  # at most 1 / SHARE
    units = Units(np.array([w for w, _ in rows], np.int64), np.array([n for _, n in rows], np.int64))
    sizes, words = np.zeros(units.n, np.int64), np.zeros(units.n, np.int64)
    sizes[0], words[0] = ends, ends > 0
    sizes[1 : 1 + len(rows)], words[1 : 1 + len(rows)] = units.counts, 1
    for e, n, k in counts.where(~own & (F.col("word") != END)).groupBy("ending").agg(F.sum("n"), F.count("*")).collect():
        sizes[1 + len(rows) + e], words[1 + len(rows) + e] = n, k
    pairs = stage(unit_pairs(blocks, units), "unit-pairs")
    classes, matrix, history = exchange(pairs, sizes)
    of_class = lambda x: np.bincount(classes, x, CLASSES)
    model = Model(units, classes, tokens, distinct, ends, discount, transitions(matrix), of_class(sizes), of_class(words))
    return model, history


def sliced(lengths: np.ndarray, tokens: int) -> Iterator[slice]:
    """Slices of consecutive documents of about so many tokens, one document at least."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + tokens, "right")))
        yield slice(at, to)
        at = to


def frequent_part(blocks: DataFrame, shared) -> DataFrame:
    """A row per block: its documents, what all but rare words' emissions add to their scores, and the rare words.

    ``rare`` are 32-bit numbers into the block's rare words, ``n_rare`` of them a document;
    ``classes`` (8 bits) are those words' classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for number, x in zip(b.column("block").to_pylist(), blocks_of(b), strict=True):
                unit = m.units.of(x.words, x.endings)
                rare = unit > len(m.units.words)
                classes = m.classes[unit]
                n = np.zeros(len(unit), np.int64)
                n[0] = m.ends
                own = (unit > 0) & ~rare
                n[own] = m.units.counts[unit[own] - 1]
                plain, word = np.where(rare, 0.0, m.plain_scores(n)), np.where(rare, 0.0, m.word_scores(classes, n))
                places, known = (np.cumsum(rare) - 1).astype(np.int32), (n > 0).astype(np.int64)
                parts: dict[str, list] = {"n_rare": [], "n_known": [], "base_score": [], "score": []}
                codes, at = [], 0
                for docs in sliced(x.lengths, SLICE):
                    lengths = x.lengths[docs]
                    c = x.codes[at : at + lengths.sum()]
                    at += len(c)
                    starts = np.cumsum(lengths) - lengths
                    of = classes[c]
                    full = m.follows[np.r_[0, of[:-1]], of] + word[c]
                    is_rare = rare[c]
                    codes.append(places[c[is_rare]])
                    for name, of_tokens in (("n_rare", is_rare.astype(np.int64)), ("n_known", known[c]), ("base_score", plain[c]), ("score", full)):
                        parts[name].append(np.add.reduceat(of_tokens, starts))
                row = {"block": pa.array([number], pa.int64())} | {c: b_of for c, b_of in (("ids", x.ids), ("held", x.held), ("n_tokens", x.lengths))} | {k: np.concatenate(v) for k, v in parts.items()}
                row = {k: v if k == "block" else pa.ListArray.from_arrays([0, len(v)], pa.array(v)) for k, v in row.items()}
                row |= {"rare": pa.array([np.concatenate(codes).tobytes()], pa.binary()), "classes": pa.array([classes[rare].astype(np.uint8).tobytes()], pa.binary())}
                yield pa.RecordBatch.from_arrays(list(row.values()), list(row))
        give_back()

    schema = "block long, ids array<long>, held array<boolean>, n_tokens array<long>, n_rare array<long>, n_known array<long>, base_score array<double>, score array<double>, rare binary, classes binary"
    return blocks.mapInArrow(run, schema)


def scored(blocks: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """One row per document of the blocks.

    Where a block lies, all is added up that the model alone tells; only rare words and
    sums move, and the counts of a block's rare words are joined to them.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = shared.value.units
        for b in batches:
            for number, raw, ends in zip(b.column("block").to_pylist(), b.column("words"), b.column("endings"), strict=True):
                words = np.frombuffer(raw.as_buffer(), np.int64)
                rare = words[units.of(words, np.frombuffer(ends.as_buffer(), np.uint16)) > len(units.words)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rare), number, np.int64)), pa.array(np.arange(len(rare), dtype=np.int32)), pa.array(rare)], ["block", "place", "word"])

    wanted = blocks.select("block", "words", "endings").mapInArrow(asked, "block long, place int, word long")
    known = wanted.join(counts.select("word", "n"), "word").select("block", "place", "n")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        rows = []
        for i in range(left.num_rows):
            row = {c: left.column(c)[i] for c in left.column_names}
            of = lambda c: row[c].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
            classes, rare = np.frombuffer(row["classes"].as_buffer(), np.uint8), np.frombuffer(row["rare"].as_buffer(), np.int32)
            n = np.zeros(len(classes), np.int64)
            n[np.asarray(right["place"])] = np.asarray(right["n"])
            doc = np.repeat(np.arange(len(row["ids"].values), dtype=np.int32), of("n_rare"))
            added = lambda x: np.bincount(doc, x[rare], len(row["ids"].values))  # noqa: E731, B023
            rows.append(
                pa.table(
                    {
                        "doc_id": row["ids"].values, "held_out": row["held"].values, "n_tokens": row["n_tokens"].values,
                        "n_known": pa.array(of("n_known") + added(n > 0).astype(np.int64)),
                        "train_tokens": pa.array(np.full(len(row["ids"].values), m.tokens, np.int64)),
                        "base_score": pa.array(of("base_score") + added(m.plain_scores(n))),
                        "score": pa.array(of("score") + added(m.word_scores(classes, n))),
                    }
                )
            )
        return pa.concat_tables(rows)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return frequent_part(blocks, shared).groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)


def class_scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from the rows that are not held out; see the module for method and edge cases.
    """
    d = picked(df, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    blocks = stage(in_blocks(d.select("doc_id", held.alias("held_out"), "text")), "blocks")
    counts = stage(word_counts(blocks), "word-counts")
    model, _ = learned(blocks, counts)
    return scored(blocks, counts, model)
