"""Trie of conversation prefixes, screened by a count-min sketch (operator 13).

Every prefix of a conversation has a digest: the exclusive or of hashes of its turns with their places. A count-min sketch of all digests,
of bounded size, is made in the tasks and merged. An estimate of one proves that no other conversation begins so: such nodes are
written where they stand, without a shuffle. Only the prefixes that may be shared are grouped, exactly. Sums over subtrees need no walk
through the trie: what a node adds is kept with its smallest member, whose own prefixes are just the nodes above.

Conversations of any length are dealt out by ranges of turns or in chunks of `CHUNK`, so no task needs to hold one whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lampyris.llm.scratch import materialise
from lampyris.llm.words import mix

#: A rebuilt conversation begins as the one whose id is the next lower multiple of EVERY, for up to HEADS - 1 turns.
EVERY, HEADS = 20, 4
#: Turns of a conversation whose running values one task works out, and ids (of a range of so many) whose text is made at once.
CHUNK, IDS = 1024, 4096
#: Rows of the sketch, and cells of each at most: this bounds what is sent to the driver and to every task (DEPTH * WIDEST bytes).
DEPTH, WIDEST, PART = 3, 1 << 22, 1 << 16

NODE = ["depth", "p1", "p2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame, every: int = EVERY, heads: int = HEADS) -> DataFrame:
    """conv_id, depth (from 1), size, k1, k2, n_words of every turn, and one row of depth 0 for each conversation; size is its number of turns.

    Turns (conv_id, turn, role, text) stand in order of `turn`, nulls first, those of equal turn by role and text, nulls last. Conversation c begins with
    the first h turns of conversation c - c % every (all if it has fewer, none if it is absent), h being crc32(c) % heads, and goes on with its own
    turns after the first h. With heads = 1 conversations stay as they are. k1 and k2 are hashes of role and text, in which null counts as empty; n_words
    counts the words of the text. Rows without conv_id belong to no conversation and are left out; repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    keyed = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), role, text).alias("k2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
    )
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text")]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    sorted_rows = materialise(sorted_rows.drop("turn", "role", "text"), "turns")
    # One row for each conversation and sorted part: where it begins there, and how many of its turns stand in parts before.
    own = Window.partitionBy("conv_id")
    parts = sorted_rows.groupBy("conv_id", "part").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    parts = parts.select("conv_id", "part", "begin", (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(own).alias("turns"))
    parts = parts.withColumns({"h": F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)), "block": F.expr(f"conv_id - conv_id % {every}")})
    bases = parts.where(f"before = 0 and conv_id % {every} = 0").select(F.col("conv_id").alias("block"), F.col("turns").alias("base_turns"))
    lent = F.least("h", F.coalesce("base_turns", F.lit(0)))
    parts = parts.join(bases, "block", "left").withColumn("lent", lent).withColumn("size", F.col("lent") + F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
    parts = materialise(parts, "conversation-parts")
    placed = sorted_rows.join(parts.drop("block", "turns", "base_turns"), ["conv_id", "part"]).withColumn("place", F.col("before") + F.col("at") - F.col("begin"))
    columns = ["conv_id", "depth", "size", "k1", "k2", "n_words"]
    rest = placed.where("place >= h").withColumn("depth", F.col("lent") + F.col("place") - F.col("h") + 1).select(columns)
    whole = parts.where("before = 0")
    first = placed.where(f"conv_id % {every} = 0 and place < {heads - 1}").select(F.col("conv_id").alias("block"), "place", "k1", "k2", "n_words")
    lent_rows = whole.where("lent > 0").join(first, "block").where("place < lent").withColumn("depth", F.col("place") + 1).select(columns)
    none = F.lit(0).cast("long")
    roots = whole.select("conv_id", none.alias("depth"), "size", none.alias("k1"), none.alias("k2"), none.alias("n_words"))
    return materialise(rest.unionByName(lent_rows).unionByName(roots), "rebuilt")


def _running(rows: DataFrame, totals: dict[str, str], combine: str, down: bool) -> DataFrame:
    """`rows` (conv_id, depth, ...) with running values of a conversation, rows of equal depth counted together; totals: new name to column.

    combine: "sum" or "bit_xor". down: from the greatest depth. Chunks of a conversation are worked out apart and put together by their totals.
    """
    rows = rows.withColumn("chunk", F.expr(f"depth div {CHUNK}"))
    long = rows.groupBy("conv_id", "chunk").agg(*[F.expr(f"{combine}({c})").alias(name) for name, c in totals.items()])
    way = F.desc if down else F.asc
    before = Window.partitionBy("conv_id").orderBy(way("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    long = long.select("conv_id", "chunk", *[F.expr(f"{combine}({name})").over(before).alias(f"{name}_") for name in totals])
    long = long.where(" or ".join(f"{name}_ is not null" for name in totals))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(way("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(long, ["conv_id", "chunk"], "left")
    sign = "+" if combine == "sum" else "^"
    for name, c in totals.items():
        joined = joined.withColumn(name, F.expr(f"{combine}({c})").over(inside)).withColumn(name, F.expr(f"{name} {sign} coalesce({name}_, 0)"))
    return joined.drop("chunk", *[f"{name}_" for name in totals])


def prefixes(turns: DataFrame) -> DataFrame:
    """The rows of `rebuilt` with p1, p2, the digest of the turns up to this one, and q1, q2, that of those before it."""
    rows = turns
    for name, seed in (("e1", 3), ("e2", 4)):
        rows = rows.withColumn(name, F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "k1", "k2")).otherwise(F.lit(0)))
    rows = _running(rows.drop("k1", "k2"), {"p1": "e1", "p2": "e2"}, "bit_xor", False)
    return materialise(rows.withColumns({"q1": F.expr("p1 ^ e1"), "q2": F.expr("p2 ^ e2")}).drop("e1", "e2"), "prefixes")


def _cells(p1: np.ndarray, p2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The cell of each digest in each row of the sketch."""
    a, b = p1.view(np.uint64), p2.view(np.uint64)
    for i in range(DEPTH):
        yield (mix(a + np.uint64(i) * (b | np.uint64(1))) & np.uint64(width - 1)).astype(np.int64)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Count-min counters of the digests (p1, p2), DEPTH rows of `width`, which end at 2. Tasks and mergers send parts of PART cells."""

    def parts(counters: np.ndarray) -> Iterator[pa.RecordBatch]:
        flat = counters.reshape(-1)
        for at in range(0, len(flat), PART):
            part = flat[at : at + PART]
            if part.any():
                yield pa.record_batch({"part": pa.array([at // PART], pa.int32()), "cells": pa.array([part.tobytes()], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((DEPTH, width), np.uint8)
        for batch in batches:
            for row, at in zip(counters, _cells(batch.column("p1").to_numpy(), batch.column("p2").to_numpy(), width)):
                cell, n = np.unique(at, return_counts=True)
                row[cell] = np.minimum(row[cell] + np.minimum(n, 2), 2)
        yield from parts(counters)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells")):
                more = np.frombuffer(cells.as_buffer(), np.uint8)
                merged[part] = np.minimum(merged[part] + more, 2) if part in merged else more
        for part, cells in merged.items():
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

    out = np.zeros(DEPTH * width, np.uint8)
    schema = "part int, cells binary"
    for row in rows.select("p1", "p2").mapInArrow(count, schema).repartition("part").mapInArrow(merge, schema).collect():
        out[row.part * PART : row.part * PART + len(row.cells)] = np.frombuffer(row.cells, np.uint8)
    return out.reshape(DEPTH, width)


def _screened(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """`rows` with `alone`: no other conversation begins so, and `below_alone`: nor as the turns before."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)
    width = counters.shape[1]

    def single(p1: pa.Array, p2: pa.Array) -> np.ndarray:
        least = np.full(len(p1), 2, np.uint8)
        for row, at in zip(shared.value, _cells(p1.to_numpy(), p2.to_numpy(), width)):
            least = np.minimum(least, row[at])
        return least <= 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            alone = single(batch.column("p1"), batch.column("p2")) & (depth > 0)
            below = single(batch.column("q1"), batch.column("q2")) & (depth > 1)
            yield pa.record_batch([*batch.columns, pa.array(alone), pa.array(below)], [*batch.schema.names, "alone", "below_alone"])

    schema = T.StructType([*rows.schema.fields, T.StructField("alone", T.BooleanType()), T.StructField("below_alone", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def _ends(rows: DataFrame) -> DataFrame:
    """NODE, ends_sha256: SHA-256 of the ids of the conversations that end at each node, ascending, with commas between.

    Ranges of IDS ids become one text each; a task then reads the texts of its nodes in order and keeps one running hash only.
    """
    texts = rows.groupBy(*NODE, F.expr(f"floor(conv_id / {IDS})").alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    texts = texts.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if own != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done)], [*NODE, "ends_sha256"])
        if node:
            yield pa.record_batch([pa.array([x]) for x in (*node, state.hexdigest())], [*NODE, "ends_sha256"])

    return texts.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, given as `rebuilt` returns them.

    A node is a distinct sequence of the first `depth` turns, from the textless root (depth 0); its members are the conversations that begin so.
    Returns conv_id (the smallest member), depth, parent_conv_id (that of the parent, null at the root), n_convs, n_children, n_leaves (childless nodes in
    the subtree, itself included), saved_tokens (over the subtree: members less one, times words of the last text) and ends_sha256 (of the ids of
    the members that end here). A table without conversations has no nodes. Digests have 128 bits; their collisions are the only source of error.
    """
    rows = prefixes(turns)
    width = 1 << 12
    n = rows.count()
    while width < min(4 * n, WIDEST):
        width *= 2
    rows = materialise(_screened(rows, sketch(rows.where("depth > 0"), width)), "screened")
    alone, shared = rows.where("alone"), rows.where("not alone")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    nodes = shared.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n_words").alias("n_words"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
        F.max(F.when(F.col("depth") == F.col("size"), F.col("conv_id"))).alias("an_end"),
    )
    nodes = materialise(nodes, "shared-nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    tops = alone.where("not below_alone")
    children = nodes.where("depth > 0").select(*above).union(tops.select(*above)).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = materialise(nodes, "nodes-with-children")

    # What each node adds to its subtree's sums, kept with its smallest member: a childless one is a leaf, alone ones save nothing.
    added = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"), F.when(F.col("n_children") == 0, one).otherwise(zero).alias("leaf"))
    added = added.union(alone.where("depth = size").select("conv_id", "depth", zero, one)).where("saved > 0 or leaf > 0")
    added = added.withColumns({"p1": F.lit(None).cast("long"), "p2": F.lit(None).cast("long"), "is_row": F.lit(False)})
    members = shared.select("conv_id", "depth", zero.alias("saved"), zero.alias("leaf"), "p1", "p2", F.lit(True).alias("is_row"))
    sums = _running(members.unionByName(added), {"saved_sum": "saved", "leaf_sum": "leaf"}, "sum", True).where("is_row")
    sums = sums.groupBy(*NODE).agg(F.sum("saved_sum").alias("saved_tokens"), F.sum("leaf_sum").alias("n_leaves"))

    ends = _ends(shared.where("depth = size"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    grouped = nodes.join(sums, NODE).join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    tails = alone.withColumns({
        "n_convs": one, "n_children": F.when(F.col("depth") < F.col("size"), one).otherwise(zero), "n_leaves": one, "saved_tokens": zero,
        "ends_sha256": F.when(F.col("depth") == F.col("size"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY)),
    })
    linked = [c for c in columns if c != "parent_conv_id"] + ["q1", "q2"]
    joined = grouped.select(linked).unionByName(tails.where("not below_alone").select(linked)).join(parents, ["depth", "q1", "q2"], "left")
    # The sketch may prove a node alone and not the one below it, whose only member is then the parent's too.
    joined = joined.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))).select(columns)
    return joined.unionByName(tails.where("below_alone").withColumn("parent_conv_id", F.col("conv_id")).select(columns))
