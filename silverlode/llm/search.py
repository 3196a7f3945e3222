"""Ranked lexical search: posting lists in geometric blocks with exact summary bounds.

Documents are read once into a forward table that holds, of each document, its number of
terms and those terms some item asks for. A task takes the forward rows in shards of a
bounded number of postings. In a shard each term has a posting list; a list is clustered by
the similarity of its documents (projected vectors, representatives taken from the list
itself) into blocks, and each block keeps the largest impact of every term in any of its
documents. An item's weights against such a summary bound the score of every document of
the block, in integers. A block is skipped only when its bound is below the score that an
item's tenth document already has; lists are taken by their largest possible part of the
score, and end when all lists left together stay below it. Every other block is scored in
full from the forward rows, so results are exact, ties included.

Lists are clustered when an item first needs them. Items are searched in blocks of a
bounded number of terms, each broadcast on its own. What documents are tested against
while they are read is a bitmap of hashed terms of a fixed size; terms that only share a
bit leave again when they meet the vocabulary. Terms are told apart by 64 bits of hash.

Edge cases. NULL and empty texts have no terms: such documents count nowhere, such items
find nothing. Very long texts are used whole. Every row is a document or an item of its
own, also where ids or whole rows repeat; a NULL id sorts first. Without documents or
items the result is empty. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import WordCache, carried, picked, texts_of
from silverlode.session import stage

BEST = 10
#: Documents of a list for each of its blocks, about.
BLOCK = 48
#: Postings of a shard; a document's are never divided.
SHARD = 1 << 18
#: Dimensions that documents are compared in.
DIMENSIONS = 24
#: Terms of the items that are searched together; one item's are never divided.
ITEM_TERMS = 1 << 18
#: Bits of the filter that documents are read through.
FILTER_BITS = 23
#: Entries of summaries that a shard keeps at a time.
SUMMARIES = 8_000_000

#: Bytes outside ASCII, digits and letters make terms; capitals A-Z become small.
TERM_BYTES = bytes(
    i + 32 if chr(i) in ascii_uppercase else i if i > 127 or chr(i).isalnum() else 32 for i in range(256)
)


def terms_in(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def term_id(term: bytes) -> int:
    """Signed 64-bit hash; 0 is kept free."""
    h = xxhash.xxh3_64_intdigest(term)
    return (h - (1 << 64) if h >> 63 else h) or 1


def item_rows(items: DataFrame, key: str, text: str) -> DataFrame:
    """(q, item_id, terms): every item row with a number and its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted({term_id(t) for t in terms_in(x)}) for x in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column("q"), pa.array(terms, pa.list_(pa.int64()))], ["q", "terms"])

    d = stage(picked(items, item_id=key, text=text).withColumn("q", F.monotonically_increasing_id()), "items")
    return stage(d.select("q", "text").mapInArrow(run, "q long, terms array<long>").join(d.select("q", "item_id"), "q"), "item-terms")


def bitmap(terms: DataFrame) -> np.ndarray:
    """Bits of hashed terms in words of 64: at most 2**17 rows, however many terms there are."""
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bit = F.pmod(F.col("term"), F.lit(1 << FILTER_BITS))
    marked = terms.select((bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(term, {1 << FILTER_BITS}) % 64 AS int))").alias("bit"))
    for word, bits in marked.groupBy("word").agg(F.bit_or("bit")).collect():
        words[word] = bits & 0xFFFFFFFFFFFFFFFF
    return words


def forward_rows(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs): a row per document with terms; of the terms those the bitmap knows."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def of(term: bytes) -> int:
            h = term_id(term)
            at = h % (1 << FILTER_BITS)
            return h if int(known[at >> 6]) >> (at & 63) & 1 else 0

        ids = WordCache(of, most=300_000)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                n, found = [], []
                for text in texts_of(part):
                    words = terms_in(text)
                    n.append(len(words))
                    found.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
                rows = np.repeat(np.arange(len(n)), n)
                flat = np.concatenate(found) if found else np.zeros(0, np.int64)
                rows, flat = rows[flat != 0], flat[flat != 0]
                order = np.lexsort((flat, rows))
                rows, flat = rows[order], flat[order]
                first = np.flatnonzero(np.r_[True, (np.diff(rows) != 0) | (np.diff(flat) != 0)][: len(rows)])
                tfs = np.diff(np.r_[first, len(rows)])
                edges = pa.array(np.searchsorted(rows[first], np.arange(len(n) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(edges, pa.array(flat[first])), pa.ListArray.from_arrays(edges, pa.array(tfs, pa.int64()))],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<long>, tfs array<long>").where("n > 0")


def frequencies(forward: DataFrame) -> DataFrame:
    """(term, df) of the forward rows' terms, counted in each task before they are dealt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, n = np.unique(np.asarray(b.column("terms").flatten()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], ["term", "n"])

    return forward.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all half-open spans, one span after another."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class ListBlocks:
    """One posting list in blocks: documents by block, and the summaries by term."""

    def __init__(self, shard: Shard, docs: np.ndarray):
        count = -(-len(docs) // BLOCK)
        block = np.zeros(len(docs), np.int64)
        if count > 1:
            block = (shard.places[docs] @ shard.places[docs[::BLOCK]].T).argmax(1)
        order = np.argsort(block, kind="stable")
        self.docs, block = docs[order], block[order]
        fresh = np.r_[True, np.diff(block) != 0]
        block = np.cumsum(fresh) - 1  # without empty ones
        self.edges = np.r_[np.flatnonzero(fresh), len(docs)]
        self.count = len(self.edges) - 1
        # coordinatewise maxima, ordered by term, then block
        at = spans(shard.edges[self.docs], shard.edges[self.docs + 1])
        sizes = shard.edges[self.docs + 1] - shard.edges[self.docs]
        key = shard.terms[at] * self.count + np.repeat(block, sizes)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, np.diff(key) != 0])
        self.most = np.maximum.reduceat(shard.impact[at][order], first)
        term, self.block = np.divmod(key[first], self.count)
        self.term_edges = np.flatnonzero(np.r_[True, np.diff(term) != 0, True])
        self.term = term[self.term_edges[:-1]]

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each block what the score of no document in it exceeds."""
        at = np.searchsorted(self.term, terms)
        met = self.term[np.minimum(at, len(self.term) - 1)] == terms
        at, weights = at[met], weights[met]
        lo, hi = self.term_edges[at], self.term_edges[at + 1]
        entries = spans(lo, hi)
        out = np.zeros(self.count, np.int64)
        np.add.at(out, self.block[entries], np.repeat(weights, hi - lo) * self.most[entries])
        return out


class Shard:
    """Forward rows and posting lists of some documents, terms numbered by the vocabulary."""

    def __init__(self, edges: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, axes: np.ndarray, weights: np.ndarray):
        self.edges, self.terms, self.weights = edges, terms, weights
        sizes = np.diff(edges)
        self.impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, sizes))
        rows = np.repeat(np.arange(len(m)), sizes)
        order = np.argsort(terms, kind="stable")
        self.posted = rows[order]
        self.lists = np.searchsorted(terms[order], np.arange(len(axes) + 1))
        self.most = np.zeros(len(axes), np.int64)
        np.maximum.at(self.most, terms, self.impact)
        self.places = np.zeros((len(m), DIMENSIONS), np.float32)
        some = np.flatnonzero(sizes)
        if len(some):
            lifted = axes[terms] * (self.impact * weights[terms]).astype(np.float32)[:, None]
            self.places[some] = np.add.reduceat(lifted, edges[some])
            self.places[some] /= np.maximum(np.linalg.norm(self.places[some], axis=1, keepdims=True), 1e-9)
        self.blocks: dict[int, ListBlocks] = {}
        self.kept = 0

    def list_blocks(self, term: int) -> ListBlocks:
        if term not in self.blocks:
            if self.kept > SUMMARIES:
                self.blocks.clear()
                self.kept = 0
            made = ListBlocks(self, self.posted[self.lists[term] : self.lists[term + 1]])
            self.kept += len(made.most)
            self.blocks[term] = made
        return self.blocks[term]

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of documents; each has a term at least."""
        lo, hi = self.edges[docs], self.edges[docs + 1]
        at = spans(lo, hi)
        starts = np.cumsum(hi - lo) - (hi - lo)
        return np.add.reduceat(weight_of[self.terms[at]] * self.impact[at], starts)

    def search(self, terms: np.ndarray, best: Best, weight_of: np.ndarray) -> None:
        """Put into ``best`` the documents that belong there; ``weight_of`` is zero and stays so."""
        most = self.weights[terms] * self.most[terms]
        order = np.argsort(-most, kind="stable")
        order = order[most[order] > 0]
        terms, rest = terms[order], np.cumsum(most[order][::-1])[::-1]
        weights = self.weights[terms]
        weight_of[terms] = weights
        seen = np.zeros(len(self.edges) - 1, bool)
        for i, term in enumerate(terms):
            if rest[i] < best.least:
                break  # whoever was not seen has none of the terms before
            blocks = self.list_blocks(int(term))
            bounds = blocks.bounds(terms, weights)
            top = int(bounds.argmax())
            for chosen in (np.array([top]), None):
                if chosen is None:  # what the best block left standing
                    chosen = np.flatnonzero(bounds >= best.least)
                    chosen = chosen[chosen != top]
                elif bounds[top] < best.least:
                    break
                docs = blocks.docs[spans(blocks.edges[chosen], blocks.edges[chosen + 1])]
                docs = docs[~seen[docs]]
                seen[docs] = True
                if len(docs):
                    best.add(docs, self.scores(docs, weight_of))
        weight_of[terms] = 0


class Best:
    """The best documents so far of an item, over the shards of a task."""

    def __init__(self):
        self.score = np.zeros(0, np.int64)
        self.doc_id = np.zeros(0, np.int64)
        self.has_id = np.zeros(0, bool)
        self.least = 1

    def of_shard(self, ids: np.ndarray, has_id: np.ndarray) -> Best:
        self.ids, self.with_id = ids, has_id
        return self

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = docs[scores >= self.least], scores[scores >= self.least]
        score = np.r_[self.score, scores]
        doc_id, has_id = np.r_[self.doc_id, self.ids[docs]], np.r_[self.has_id, self.with_id[docs]]
        order = np.lexsort((doc_id, has_id, -score))[:BEST]
        self.score, self.doc_id, self.has_id = score[order], doc_id[order], has_id[order]
        if len(order) == BEST:
            self.least = int(self.score[-1])


def searched(forward: DataFrame, asked: list[tuple[int, list[int], list[int]]], n_docs: int, n_terms: int) -> DataFrame:
    """(q, doc_id, score): of every task the best documents of each item (q, terms, weights)."""
    vocabulary, first = np.unique(np.concatenate([np.array(t, np.int64) for _, t, _ in asked]), return_index=True)
    weights = np.concatenate([np.array(w, np.int64) for _, _, w in asked])[first]
    numbers = [(q, np.searchsorted(vocabulary, t)) for q, t, _ in asked]
    shared = forward.sparkSession.sparkContext.broadcast((vocabulary, weights, numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, numbers = shared.value
        axes = np.random.default_rng(7).standard_normal((len(vocabulary), DIMENSIONS), np.float32)
        best = [Best() for _ in numbers]
        weight_of = np.zeros(len(vocabulary), np.int64)
        for b in batches:
            whole = np.asarray(b.column("terms").value_lengths()).astype(np.int64)
            # shards end where the postings reach the next multiple of the bound
            cuts = np.flatnonzero(np.diff(np.cumsum(whole) // SHARD)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                part = b.slice(lo, hi - lo)
                flat = np.asarray(part.column("terms").flatten())
                tfs = np.asarray(part.column("tfs").flatten())
                at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
                known = vocabulary[at] == flat
                row = np.repeat(np.arange(hi - lo), whole[lo:hi])[known]
                n = np.asarray(part.column("n"))
                m = 10 + np.array([90 * int(x) * n_docs // n_terms for x in n], np.int64)
                shard = Shard(np.searchsorted(row, np.arange(hi - lo + 1)), at[known], tfs[known], m, axes, weights)
                ids = part.column("doc_id")
                id_of, has_id = np.asarray(ids.fill_null(0)), ~np.asarray(ids.is_null())
                for (_, terms), found in zip(numbers, best, strict=True):
                    shard.search(terms, found.of_shard(id_of, has_id), weight_of)
        q = np.repeat([q for q, _ in numbers], [len(x.score) for x in best])
        doc_id, has_id, score = (np.concatenate([getattr(x, c) for x in best]) for c in ("doc_id", "has_id", "score"))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(doc_id, mask=~has_id), pa.array(score)], ["q", "doc_id", "score"])

    return forward.mapInArrow(run, "q long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ten best documents with a score above 0.

    Fewer if there are fewer; equal scores by ascending id. See the module for edge cases.
    """
    spark = docs.sparkSession
    asked = item_rows(items, item, item_text)
    each = asked.select("q", F.explode("terms").alias("term"))
    read = picked(docs, doc_id=key, text=text).select(F.col("doc_id").cast("long"), "text")
    forward = stage(forward_rows(read, bitmap(each)), "forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.sum("n")).first()
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weights = frequencies(forward).select("term", weight.alias("weight")).where("weight > 0")
    weighed = each.join(weights, "term").groupBy("q").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
    weighed = weighed.select("q", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    dealt = stage(carried(weighed, ["q"], {"before": F.size("terms").cast("long")}).withColumn("block", F.floor(F.col("before") / ITEM_TERMS)), "weighed")
    found = None
    for block in [r[0] for r in dealt.select("block").distinct().collect()]:
        some = [tuple(r) for r in dealt.where(F.col("block") == block).select("q", "terms", "weights").collect()]
        part = stage(searched(forward, some, n_docs, n_terms), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "q long, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return top.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
