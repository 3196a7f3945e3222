"""Near-duplicates by MinHash: minima, bands, signature check, full-set check, components.

Documents with equal shingle sets become one class first. Each class gets ``BANDS`` band
keys of ``ROWS`` universal-hash minima. In every bucket the class with the smallest id is
the hub and all others are compared with it, so a bucket costs its size, not its square.
Buckets that still hold several components then try the members that most signatures
agree with as further hubs. What is left is compared across components only, block by
block, with signatures deciding what reaches the full-set check. Every pair that shares a bucket is thus either compared or already in one
component. A pair at 0.75 shares no bucket with a chance of 2e-5.

Components come from alternating large-star and small-star steps (Kiveris et al. 2014).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import WordCache, copy_of, give_back, kept_for, picked, texts_of
from silverlode.operators.ordering import global_row_number
from silverlode.session import stage

WORDS = 5
PERCENT = 75
BANDS, ROWS = 40, 5
#: Minima of a document: the first make the bands, all of them the signature, a byte each.
MINIMA = 512
#: Share of equal signature bytes below which a pair is not checked on full sets: four
#: standard deviations under what 0.75 gives, a chance of 3e-5 at 0.75.
SIGNATURE_LEAST = 0.75 + 0.25 / 256 - 4 * (0.75 * 0.25 / MINIMA) ** 0.5
#: Members of a bucket compared in one go.
BLOCK = 1024

_rng = np.random.default_rng(20240)
MULTIPLIERS = _rng.integers(0, 1 << 31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
ADDENDS = _rng.integers(0, 1 << 32, MINIMA, np.uint32)
POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(WORDS)]


class Shingler:
    """Distinct 64-bit shingle hashes of texts, with a bounded cache of word hashes."""

    def __init__(self):
        self.words = WordCache(xxhash.xxh3_64_intdigest)

    def sets(self, text: str) -> np.ndarray:
        """Sorted hashes of the distinct five-word shingles; fewer words count as one shingle."""
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        k = min(n, WORDS)
        with np.errstate(over="ignore"):
            h = np.full(n - k + 1, k, np.uint64)
            for i in range(k):
                h += w[i : n - k + 1 + i] * POWERS[i]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return np.unique(h ^ (h >> np.uint64(29)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each universal hash, modulo 2**32, over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 128):
            np.minimum(low, (x[i : i + 128, None] * MULTIPLIERS + ADDENDS).min(0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in low[: BANDS * ROWS].reshape(BANDS, ROWS).T.astype(np.uint64):
            keys = (keys * np.uint64(0x9E3779B97F4A7C15) ^ column) * np.uint64(0xBF58476D1CE4E5B9)
            keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def sketches(df: DataFrame) -> DataFrame:
    """(doc_id, copy, n, d1, d2, bands, sig) of (doc_id, copy, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_for("copies")
        shingler = Shingler()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                n, d1, d2, bands, sig = [], [], [], [], []
                for t in texts_of(part):
                    s = shingler.sets(t)
                    n.append(len(s))
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    d1.append(int.from_bytes(digest[:8], "little", signed=True))
                    d2.append(int.from_bytes(digest[8:], "little", signed=True))
                    low = minima(s) if len(s) else None
                    bands.append(None if low is None else band_keys(low))
                    sig.append(None if low is None else (low & np.uint32(0xFF)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["doc_id", "copy", "n", "d1", "d2", "bands", "sig"],
                )
        b = part = shingler = None
        give_back()

    return df.mapInArrow(run, "doc_id long, copy long, n long, d1 long, d2 long, bands array<long>, sig binary")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs (a, a_copy, b, b_copy), decided on full shingle sets."""
    need = pairs.select(F.col("a").alias("id"), F.col("a_copy").alias("c")).union(pairs.select("b", "b_copy")).distinct()
    texts = stage(docs.join(need, F.expr("doc_id = id and copy = c")).select("id", "c", "text").dropDuplicates(["id", "c"]), "pair-texts")
    left = texts.toDF("a", "a_copy", "a_text")
    right = texts.toDF("b", "b_copy", "b_text")
    both = pairs.join(left, ["a", "a_copy"]).join(right, ["b", "b_copy"]).select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_for("copies")
        shingler, last, kept = Shingler(), None, None
        for b in batches:
            for at in range(0, b.num_rows, 250):
                part, ok = b.slice(at, 250), []
                for x, y in zip(texts_of(part, "a_text"), texts_of(part, "b_text"), strict=True):
                    if y != last:
                        last, kept = y, shingler.sets(y)
                    s = shingler.sets(x)
                    common = len(s) + len(kept) - len(np.union1d(s, kept))
                    ok.append(100 * common >= PERCENT * (len(s) + len(kept) - common))
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        b = part = shingler = kept = None
        give_back()

    return both.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node.

    Large-star and small-star alternate on a written table until the edges stand still.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def stars(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large-star")  # u > v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        return stage(small.distinct(), "small-star")

    e = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state(e)
    while True:
        e = stars(e)
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())


def across(open_rows: DataFrame, hubs: bool) -> DataFrame:
    """Pairs (a, a_copy, b, b_copy) of one bucket whose components differ and whose signatures agree.

    ``open_rows``: key, u_block, v_block, side (0 or 1), doc_id, copy, n, component, sig,
    bands; a pair that shares several buckets is named by the first only, and every group (key, u_block, v_block) is small enough for one task. With ``hubs`` each
    row of side 0 meets one hub only: again and again the row of side 1 that most of the
    rest agree with.
    """

    def pairs(group: pa.Table) -> pa.RecordBatch:
        side = np.asarray(group["side"])
        ids, copies, n, comp = (np.asarray(group[c]) for c in ("doc_id", "copy", "n", "component"))
        sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint8).reshape(len(ids), -1)
        u, v = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        like = np.zeros((len(u), len(v)), np.float32)
        for row, i in enumerate(u):
            may = (comp[v] != comp[i]) & (100 * np.minimum(n[v], n[i]) >= PERCENT * np.maximum(n[v], n[i]))
            like[row, may] = (sig[v[may]] == sig[i]).mean(1)
        near = like >= SIGNATURE_LEAST
        if not hubs:
            bands = np.asarray(group["bands"].combine_chunks().flatten()).reshape(len(ids), -1)
            key = group["key"][0].as_py()
            for row, i in enumerate(u):
                of = np.flatnonzero(near[row])
                if len(of):
                    first = (bands[v[of]] == bands[i]).argmax(1)
                    near[row, of] = bands[i][first] == key
        if hubs:
            left, chosen = near.any(1), np.zeros_like(near)
            while left.any():
                hub = ((like >= PERCENT / 100) * 2.0 + near)[left].sum(0).argmax()
                met = left & near[:, hub]
                chosen[met, hub] = True
                left &= ~met
            near = chosen
        a, b = np.nonzero(near)
        a, b = u[a], v[b]
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(copies[a]), pa.array(ids[b]), pa.array(copies[b])], ["a", "a_copy", "b", "b_copy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the group that may go on in the next batch
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
            keys = np.stack([np.asarray(t[c]) for c in ("key", "u_block", "v_block")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *edges[:-1]], edges):
                yield pairs(t.slice(lo, hi - lo))
            rest = t.slice(edges[-1] if len(edges) else 0)
        if rest is not None and rest.num_rows:
            yield pairs(rest)
        b = t = rest = None
        give_back()

    group = ["key", "u_block", "v_block"]
    dealt = open_rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, "a long, a_copy long, b long, b_copy long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    NULL, empty and blank texts have no shingles and no links. Rows that share an id are
    one node of the graph. A row with a NULL id links nothing: component_id is NULL and it
    is kept. Very long texts are used whole.
    """
    docs = picked(df, doc_id=key, text=text).withColumn("copy", copy_of("text")).select("doc_id", "copy", "text")
    sketch = stage(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    real = sketch.where("n > 0 and doc_id is not null")
    classes = real.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "copy", "row")).alias("r"))
    classes = stage(classes.select("d1", "d2", F.col("r.doc_id").alias("rep"), F.col("r.row").alias("row")), "classes")
    nodes = stage(real.join(classes.select("row"), "row").select("doc_id", "copy", "n", "bands", "sig"), "nodes")
    # dealt by bucket once; finding the hub and meeting it use the same exchange
    member = nodes.select("doc_id", "copy", "n", F.explode("bands").alias("key")).repartition("key")
    buckets = member.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("doc_id", "copy", "n")).alias("hub")).where("size > 1")
    placed = stage(member.join(buckets, "key").select("key", "doc_id", "copy", "n", "hub"), "members")

    hub_pairs = placed.where("doc_id <> hub.doc_id or copy <> hub.copy").where(100 * F.least("n", "hub.n") >= PERCENT * F.greatest("n", "hub.n"))
    hub_pairs = hub_pairs.select(F.col("doc_id").alias("a"), F.col("copy").alias("a_copy"), F.col("hub.doc_id").alias("b"), F.col("hub.copy").alias("b_copy")).distinct()
    # an id with several texts is one node, which joins their classes
    several = real.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi")).where("lo <> hi").select("doc_id")
    same_id = real.join(several, "doc_id").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(verified(by_signature(hub_pairs, nodes), docs).union(same_id), "links")
    found = stage(components(links), "components")
    tried = None
    for hubs in (True, False):
        more = across(opened(placed, nodes, found), hubs).distinct()
        more = stage(more if tried is None else more.join(tried, ["a", "a_copy", "b", "b_copy"], "left_anti"), "across")
        if more.isEmpty():
            break
        tried = more
        extra = verified(more, docs)
        found = stage(components(found.where("node <> component").toDF("a", "b").union(extra)), "components")

    out = sketch.select("doc_id", "n", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
    out = out.join(found, F.expr("rep = node"), "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(component)
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df``, all columns: one of each group of near-duplicates, the one with the smallest id.

    Ids need not be unique: a further text of an id, and a text without an id, is a document
    of its own and stands behind all ids. Of rows with one id and one text a single one
    stays, the first by its other columns. Empty texts are no copies of each other.
    """
    mine = {"_id_of_row": F.col(f"`{key}`").cast("long"), "_copy_of_row": copy_of(text)}
    rows = df.withColumns(mine)
    keys = stage(rows.groupBy(*mine).agg(F.count("*").alias("n")), "keys")
    first = keys.where("_id_of_row is not null").groupBy("_id_of_row").agg(F.min("_copy_of_row").alias("_copy_of_row"))
    further = global_row_number(keys.drop("n").join(first, list(mine), "left_anti"), list(mine), "number")
    most = keys.agg(F.greatest(F.coalesce(F.max("_id_of_row"), F.lit(0)), F.lit(0))).first()[0]
    further = stage(further.select(F.col("_id_of_row").alias("_of_id"), F.col("_copy_of_row").alias("_of_copy"), (F.col("number") + most).alias("_node_of_row")), "further-texts")
    same = lambda d, t: d["_id_of_row"].eqNullSafe(t["_of_id"]) & (d["_copy_of_row"] == t["_of_copy"])
    named = rows.join(further, same(rows, further), "left").drop("_of_id", "_of_copy")
    named = named.withColumn("_node_of_row", F.coalesce("_node_of_row", "_id_of_row"))
    gone = stage(near_duplicates(named, "_node_of_row", text).where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    left = named.join(gone, named["_node_of_row"] == gone["_gone"], "left_anti").drop("_node_of_row")
    again = stage(keys.where("n > 1").select(F.col("_id_of_row").alias("_of_id"), F.col("_copy_of_row").alias("_of_copy")), "repeated")
    once = left.join(again, same(left, again), "left_anti")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in (key, text)], F.lit(0)))
    single = left.join(again, same(left, again), "left_semi").groupBy(*mine).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), others).alias("row"))
    return once.select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(single.select("row.*"))


def opened(placed: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Rows for :func:`across`: members of buckets that hold several components, without the hubs.

    Side 0 is what lies outside the hub's component, side 1 is everybody; either side is
    dealt out in blocks, and each block of one side meets each of the other.
    """
    located = placed.join(found, F.expr("doc_id = node"), "left").withColumn("component", F.coalesce("component", "doc_id"))
    located = stage(located.select("key", "doc_id", "copy", "n", "component", ((F.col("doc_id") == F.col("hub.doc_id")) & (F.col("copy") == F.col("hub.copy"))).alias("is_hub")), "located")
    several = located.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"), F.max(F.when(F.col("is_hub"), F.col("component"))).alias("hub_component")
    ).where("lo <> hi")
    several = stage(several, "several")
    outside = located.join(several, "key").where("component <> hub_component").groupBy("key").agg(F.count("*").alias("us"))
    rows = located.join(several.join(outside, "key"), "key").where("not is_hub").join(nodes.select("doc_id", "copy", "sig", "bands"), ["doc_id", "copy"])
    blocks_u = F.ceil(F.col("us") / BLOCK).cast("int")
    blocks_v = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    common = ["key", "doc_id", "copy", "n", "component", "sig", "bands"]
    u = rows.where("component <> hub_component").select(*common, F.lit(0).alias("side"), (mine % blocks_u).cast("int").alias("u_block"), F.explode(F.sequence(F.lit(0), blocks_v - 1)).alias("v_block"))
    v = rows.select(*common, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), blocks_u - 1)).alias("u_block"), (mine % blocks_v).cast("int").alias("v_block"))
    return u.unionByName(v).select("key", "u_block", "v_block", "side", "doc_id", "copy", "n", "component", "sig", "bands")


def by_signature(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree often enough for a full-set check to be worth it."""
    sig = nodes.select("doc_id", "copy", "sig")
    both = pairs.join(sig.toDF("a", "a_copy", "a_sig"), ["a", "a_copy"]).join(sig.toDF("b", "b_copy", "b_sig"), ["b", "b_copy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("a_sig", "b_sig"))
            yield b.select(["a", "a_copy", "b", "b_copy"]).filter(pa.array((x == y).mean(1) >= SIGNATURE_LEAST)) if b.num_rows else b.select(["a", "a_copy", "b", "b_copy"])
        b = x = y = None
        give_back()

    return both.select("a", "a_copy", "b", "b_copy", "a_sig", "b_sig").mapInArrow(run, "a long, a_copy long, b long, b_copy long")
