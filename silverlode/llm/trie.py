"""Prefix trie of conversations: ROLLUP over positional columns of turn ids.

A turn's id is 128 bits of the SHA-256 of its role and text, held as two longs. Each
conversation becomes rows of ``WIDTH`` turns, a block, and one ROLLUP over the columns of
a block aggregates all its prefixes together; ``grouping_id`` tells a prefix's length.
Longer conversations go on in further blocks, which carry the key of the node that the
block before them ended in. A key folds the digests of the path's blocks, so all blocks
roll up in one job, however long a conversation is.

Node and owner. A node's owner is its smallest member. A member of a node that owns it also
owns all deeper nodes on its own path, so what a conversation owns is the end of its path.
A sum over a subtree is therefore a sum over the members of its top: all that each member
owns, less what the top's owner owns above the top. The second ROLLUP adds that up.

Edge cases. Rows without conv_id belong to no conversation. A NULL turn comes first, NULL
roles and texts are empty; turns of one number are ordered by role and text, repeated rows
are turns of their own. Very long texts are digested whole. An empty table has no node,
not even the root. Further columns of the input, clashing names included, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import carried, picked
from silverlode.session import stage

#: Turns in one block of columns.
WIDTH = 4
#: Conversations whose openings are replaced stand in groups of this many ids.
FAMILY = 5
#: The opening has fewer turns than this.
OPENINGS = 9
#: Conversation ids joined into one text before hashing.
PIECE = 4096


def _ids() -> list[str]:
    return [f"{x}{i}" for i in range(1, WIDTH + 1) for x in "ab"]


def _digest(seed: int, columns: list[Column]) -> Column:
    """64 bits of a block's turn ids; NULLs, the columns beyond its last turn, are skipped."""
    return F.when(columns[0].isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(seed), F.col("block"), *columns))


def own_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, a, b, size) of every turn: its place from 0, its id and the bytes of its text."""
    d = picked(df, conv_id=conv, turn=turn, role=role, text=text).where("conv_id is not null")
    d = d.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    d = d.withColumns({"digest": digest, "size": F.octet_length("text").cast("long")})
    d = d.select("conv_id", "turn", "role", "text", "size", F.xxhash64(F.substring("digest", 1, 32)).alias("a"), F.xxhash64(F.substring("digest", 33, 32)).alias("b"))
    # the whole table is numbered, so a conversation of any length is dealt over many tasks
    numbered = carried(d, ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"], {"number": F.lit(1).cast("long")}, drop=("turn", "role", "text"))
    return stage(numbered, "turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, size, length): each conversation behind the opening of its family's first.

    Every conversation also has a row of depth 0 without a turn.
    """
    convs = turns.groupBy("conv_id").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS
    convs = stage(convs.select("*", opening.alias("opening"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")), "conversations")
    # what the family's first conversation gives: a number of turns, and the turns
    given = convs.select(F.col("conv_id").alias("family"), F.col("n").alias("n_first"))
    convs = convs.join(given, "family", "left").withColumn("kept", F.least(F.col("opening"), F.coalesce("n_first", F.lit(0))))
    convs = stage(convs.withColumn("length", F.col("kept") + F.greatest(F.col("n") - F.col("opening"), F.lit(0))).drop("n_first"), "lengths")
    placed = turns.join(convs.select("conv_id", "first", "opening", "kept", "length"), "conv_id").withColumn("place", F.col("number") - F.col("first"))
    rest = placed.where("place >= opening").select("conv_id", (F.col("kept") + F.col("place") - F.col("opening") + 1).alias("depth"), "a", "b", "size", "length")
    head = turns.where(F.col("conv_id") % FAMILY == 0).join(convs.select(F.col("conv_id"), "first"), "conv_id")
    head = head.select(F.col("conv_id").alias("family"), (F.col("number") - F.col("first")).alias("place"), "a", "b", "size").where(F.col("place") < OPENINGS - 1)
    start = convs.select("conv_id", "family", "kept", "length").join(head, "family").where("place < kept")
    start = start.select("conv_id", (F.col("place") + 1).alias("depth"), "a", "b", "size", "length")
    none = F.lit(None).cast("long")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), none.alias("a"), none.alias("b"), none.alias("size"), "length")
    return rest.unionByName(start).unionByName(root)


def in_blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, a1, b1, size1, ..., p1, p2, e1, e2, is_last) of rebuilt turns.

    (p1, p2) is the key of the node before the block, (e1, e2) that of the block's last node.
    """
    at = F.greatest(F.col("depth") - 1, F.lit(0))
    columns = [
        F.max(F.when(at % WIDTH == i - 1, F.col(x))).alias(f"{x}{i}")
        for i in range(1, WIDTH + 1)
        for x in ("a", "b", "size")
    ]
    blocks = turns.groupBy("conv_id", F.floor(at / WIDTH).alias("block")).agg(F.max("length").alias("length"), *columns)
    ids = [F.col(c) for c in _ids()]
    blocks = blocks.withColumns({"d1": _digest(1, ids), "d2": _digest(2, ids)})
    blocks = stage(carried(blocks, ["conv_id", "block"], {"x1": F.col("d1"), "x2": F.col("d2")}, F.bit_xor), "folded")
    start = blocks.where("block = 0").select("conv_id", F.col("x1").alias("s1"), F.col("x2").alias("s2"))
    blocks = blocks.join(start, "conv_id")
    for i in "12":
        blocks = blocks.withColumn(f"p{i}", F.col(f"x{i}").bitwiseXOR(F.col(f"s{i}"))).withColumn(f"e{i}", F.col(f"p{i}").bitwiseXOR(F.col(f"d{i}")))
    last = F.col("block") == F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / WIDTH)
    return stage(blocks.withColumn("is_last", last).drop("x1", "x2", "s1", "s2", "d1", "d2", "length"), "blocks")


def rolled_up(blocks: DataFrame, *aggregates: str) -> DataFrame:
    """Every prefix of every block: keys (k1, k2) and parent keys (q1, q2), depth, the aggregates.

    One ROLLUP for all; the aggregates are SQL. A last column ``size`` may be named
    among them through ``sizes``, the array of the largest size in each column.
    """
    pairs = ", ".join(f"(a{i}, b{i})" for i in range(1, WIDTH + 1))
    grouped = blocks.sparkSession.sql(
        f"""SELECT block, p1, p2, {", ".join(_ids())}, {WIDTH} - bit_count(grouping_id()) DIV 2 AS level, {", ".join(aggregates)}
        FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({pairs})""",
        blocks=blocks,
    )
    # shorter conversations fill the columns behind their last turn with NULL: no prefixes
    known = F.get(F.array(*[F.col(f"a{i}") for i in range(1, WIDTH + 1)]), F.col("level") - 1).isNotNull()
    grouped = grouped.where(((F.col("level") == 0) & (F.col("block") == 0)) | known)
    ids = [F.col(c) for c in _ids()]
    above = [F.when(F.col("level") > i // 2 + 1, c) for i, c in enumerate(ids)]
    for k, seed in (("1", 1), ("2", 2)):
        grouped = grouped.withColumn(f"k{k}", F.col(f"p{k}").bitwiseXOR(F.when(F.col("level") == 0, F.lit(0)).otherwise(_digest(seed, ids))))
        grouped = grouped.withColumn(f"q{k}", F.col(f"p{k}").bitwiseXOR(_digest(seed, above)))
    return grouped.withColumn("depth", F.col("block") * WIDTH + F.col("level")).drop("block", "p1", "p2", *_ids())


def end_digests(blocks: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes that conversations end in.

    Ids are joined in pieces of at most ``PIECE``, whoever they belong to; the pieces of a
    node are hashed one after another, so a node of any size needs no memory.
    """
    ends = carried(blocks.where("is_last").select("e1", "e2", "conv_id"), ["e1", "e2", "conv_id"], {"number": F.lit(1).cast("long")})
    pieces = ends.groupBy("e1", "e2", F.floor(F.col("number") / PIECE).alias("piece")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []

        def made() -> pa.RecordBatch:
            e1, e2, sha = zip(*done, strict=True) if done else ((), (), ())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(e1, pa.int64()), pa.array(e2, pa.int64()), pa.array(sha, pa.string())], ["k1", "k2", "ends_sha256"])

        for b in batches:
            for e1, e2, ids in zip(b.column("e1").to_pylist(), b.column("e2").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if (e1, e2) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (e1, e2), hashlib.sha256(ids.encode())
            yield made()
        if node:
            done.append((*node, state.hexdigest()))
        yield made()

    dealt = pieces.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "piece").select("e1", "e2", "ids")
    return dealt.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see the module for edge cases.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = in_blocks(rebuilt(own_turns(df, conv, turn, role, text)))
    size = f"coalesce(get(array({', '.join(f'max(size{i})' for i in range(1, WIDTH + 1))}), {WIDTH} - cast(bit_count(grouping_id()) DIV 2 AS int) - 1), 0)"
    found = rolled_up(blocks, "min(conv_id) AS conv_id", "count(*) AS n_convs", f"(count(*) - 1) * {size} AS saved")
    nodes = stage(carried(found.drop("level"), ["conv_id", "depth"], {"above": F.col("saved")}), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(nodes, "children")
    owners = nodes.groupBy("conv_id").agg(F.min("above").alias("start"), F.sum("saved").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    owners = stage(owners, "owners")
    weighed = blocks.join(owners.select("conv_id", "owned", "leaves"), "conv_id", "left")
    sums = rolled_up(weighed, "coalesce(sum(owned), 0) AS below", "coalesce(sum(leaves), 0) AS n_leaves").select("k1", "k2", "below", "n_leaves")
    # the root's children are many and need no join: the root belongs to the smallest id of all
    least = blocks.agg(F.min("conv_id")).first()[0]
    parents = nodes.where("depth > 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("above_conv"))
    deep = nodes.where("depth > 1").join(parents, ["q1", "q2"]).withColumnRenamed("above_conv", "parent_conv_id")
    top = nodes.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least).cast("long")))
    out = deep.unionByName(top).join(sums, ["k1", "k2"]).join(owners.select("conv_id", "start"), "conv_id").join(end_digests(blocks), ["k1", "k2"], "left")
    saved = F.col("below") - (F.col("above") - F.col("start"))
    return out.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        saved.cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
