"""N-gram Jaccard join: which documents share at least 75 % of their five-word shingles (operator 3).

The join is a sparse product of the document by shingle incidence with its transpose, done in blocks of documents that
can still hold a link. Size-derived bounds decide which blocks meet at all:

1. *Coverage.* With J >= 3/4 the two sets share at least 3/4 of either. The lower half of each set (by hash) is sent
   to hash buckets; a document of n shingles stays only if ceil(n/4) of them occur elsewhere. The rest of the documents
   have no link. A second pass does the same with whole sets, among what is left and without exact copies.
2. *Closeness.* Documents that share one of three minimum hashes are multiplied with the smallest of them. The links
   found give first components, so that large groups of near copies are one component before any pair of theirs is made.
3. *Prefix.* Of the sets in order of corpus frequency, two linked documents share one of the first n - ceil(3n/4) + 1.
   Where a prefix shingle meets several components, blocks of the larger one (at most `BLOCK` documents) are
   multiplied with the other documents, if size and position allow 3/4; links within a component are not looked for.

Every link between different components is found exactly by its overlap count, so the final components are exact (up to
collisions of 64-bit hashes). No step emits the pairs of a group and no shingle gathers more than one entry for each
chunk of documents, however many rows hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lampyris.llm.cache import hand_back
from lampyris.llm.components import components
from lampyris.llm.scratch import free_name, materialise
from lampyris.llm.words import SPACES, Texts, mix, pieces, utf8

#: Bytes that one hash bucket should hold, and shingles of a chunk that is packed together.
BUCKET_BYTES, CHUNK = 4 << 20, 1 << 19
#: Documents on each side of a block product, and frequency from which a shingle's order matters.
BLOCK, FREQUENT = 256, 16
#: Sorts the null id; no table of this library uses it.
NO_ID = -(2**63)
_MANY = np.uint16(65535)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Ids and sorted distinct shingle hashes of some documents at a time."""
    for batch in pieces(batches, "text"):
        hashes, bounds = Texts(*utf8(batch.column("text")), SPACES).shingles()
        ids = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        yield ids, [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        one = np.add.reduce(mix(own ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
        two = np.add.reduce(mix(own ^ np.uint64(0x14057B7EF767814F)), dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


_PACKED = "bucket int, payload binary"


def _pack(chunk: list[tuple[int, np.ndarray]], facts: list[tuple], buckets: int) -> Iterator[tuple[int, bytes]]:
    """Bucket payloads of a chunk, one entry for each distinct shingle, and one payload of what is known of its documents.

    A shingle that two documents of the chunk hold is known to be shared; its single entry is marked and names no document.
    """
    ids = np.array([i for i, _ in chunk], np.int64)
    all_hashes = np.concatenate([h for _, h in chunk]) if chunk else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(chunk)), [len(h) for _, h in chunk])
    order = np.argsort(all_hashes, kind="stable")
    hashes, owner = all_hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    sizes = np.diff(np.append(np.flatnonzero(new), len(hashes)))
    shared = np.repeat(sizes > 1, sizes)
    here = np.bincount(owner[shared], minlength=len(chunk)).astype(np.int64)
    known = pa.table({**{n: pa.array([f[k] for f in facts], pa.int64()) for k, n in enumerate(("n", "k1", "k2"))},
                      "doc_id": pa.array(ids), "cover": pa.array(here)}).select(["doc_id", "n", "k1", "k2", "cover"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as writer:
        writer.write_table(known)
    yield -1 - int(ids[0] % buckets if len(ids) else 0), sink.getvalue().to_pybytes()
    hashes, one, many = hashes[new], owner[new], sizes > 1
    place = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(place, np.arange(buckets + 1))
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for b in np.flatnonzero(np.diff(cuts)):
        at = slice(cuts[b], cuts[b + 1])
        named, local = np.unique(one[at], return_inverse=True)
        local = local.astype(np.uint16)
        local[many[at]] = _MANY
        yield int(b), np.array([len(local), len(named)], np.int64).tobytes() + low[at].tobytes() + local.tobytes() + ids[named].tobytes()


def _packer(buckets: int, whole: bool):
    """Packs texts (their lower half of shingles) or, with `whole`, sets that are already there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            rows = list(_pack(chunk, facts, buckets))
            return pa.record_batch({"bucket": pa.array([r[0] for r in rows], pa.int32()), "payload": pa.array([r[1] for r in rows], pa.binary())})

        source = _stored(batches) if whole else _sets(batches)
        chunk, facts, held = [], [], 0
        for ids, sets in source:
            for i, own in zip(ids.tolist(), sets):
                kept = own if whole else own[: (len(own) + 1) // 2]
                chunk.append((i, kept))
                facts.append((len(own), *_key(own)))
                held += len(kept)
                if held >= CHUNK or len(chunk) >= 60_000:
                    yield flush()
                    chunk, facts, held = [], [], 0
        if chunk:
            yield flush()
        del chunk, facts
        hand_back()

    return run


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        yield batch.column("doc_id").to_numpy(zero_copy_only=False), [np.frombuffer(s, np.uint64) for s in batch.column("shingles").to_pylist()]


_COUNTS, _COVER = "slot int, known boolean, payload binary", "doc_id long, n long, k1 long, k2 long, cover long"
#: Covered shingles, one entry each at most, that one slot of documents should gather.
SLOT = 1 << 20


def _once(known: np.ndarray) -> np.ndarray:
    """Columns (doc_id, n, k1, k2, cover): one for each id, with the largest n (then key) and the sum of `cover`."""
    known = known[:, np.lexsort((known[3], known[2], known[1], known[0]))]
    last = np.ones(known.shape[1], bool)
    last[:-1] = known[0, 1:] != known[0, :-1]
    starts = np.flatnonzero(np.concatenate(([True], last[:-1])))
    out = known[:, last]
    out[4] = np.add.reduceat(known[4], starts)
    return out


def _dealt(rows: np.ndarray, known: bool, slots: int) -> pa.Table:
    """Rows about documents (ids first, one column each) packed by slot, so that a bucket makes no row for each document."""
    slot = (mix(rows[0].view(np.uint64)) % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    rows, cuts = rows[:, order], np.searchsorted(slot[order], np.arange(slots + 1))
    full = np.flatnonzero(np.diff(cuts))
    payloads = [np.ascontiguousarray(rows[:, cuts[s] : cuts[s + 1]]).tobytes() for s in full]
    return pa.table({"slot": pa.array(full, pa.int32()), "known": pa.array([known] * len(full), pa.bool_()), "payload": pa.array(payloads, pa.binary())})


def _cover(slots: int):
    """Of one bucket: documents and how many of their shingles other chunks hold too, or what is known of documents."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        hand_back()
        payloads = table.column("payload").to_pylist()
        if key[0].as_py() < 0:
            known = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in payloads])
            return _dealt(_once(np.stack([known.column(c).to_numpy() for c in ("doc_id", "n", "k1", "k2", "cover")])), True, slots)
        lows, owners = [], []
        for p in payloads:
            n, docs = np.frombuffer(p, np.int64, 2).tolist()
            lows.append(np.frombuffer(p, np.uint32, n, 16))
            local = np.frombuffer(p, np.uint16, n, 16 + 4 * n)
            ids = np.frombuffer(p, np.int64, docs, 16 + 6 * n) if docs else np.zeros(1, np.int64)
            marked = local == _MANY
            owners.append((ids[np.where(marked, 0, local)], marked))
        low = np.concatenate(lows)
        ids = np.concatenate([o for o, _ in owners])
        marked = np.concatenate([m for _, m in owners])
        order = np.argsort(low, kind="stable")
        low = low[order]
        starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        sizes = np.diff(np.append(starts, len(low)))
        marks = np.add.reduceat(marked[order].astype(np.int64), starts)
        found = np.repeat((sizes > 1) | (marks > 0), sizes) & ~marked[order]
        return _dealt(np.stack(np.unique(ids[order][found], return_counts=True)), False, slots)

    return run


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    """The documents of one slot, each with its counts from all buckets."""
    hand_back()
    parts = []
    for known, payload in zip(table.column("known").to_pylist(), table.column("payload").to_pylist()):
        rows = np.frombuffer(payload, np.int64).reshape(5 if known else 2, -1)
        if not known:
            nothing = np.full(rows.shape[1], -1)
            rows = np.stack([rows[0], nothing, nothing, nothing, rows[1]])
        parts.append(rows)
    once = _once(np.concatenate(parts, axis=1))
    return pa.table({c: pa.array(once[k], pa.int64()) for k, c in enumerate(("doc_id", "n", "k1", "k2", "cover"))})


def _covered(frame: DataFrame, shingles: int, whole: bool) -> DataFrame:
    """doc_id, n, k1, k2 of each document, and `cover`: how many of the shingles sent also occur in another one."""
    buckets, slots = max(16, -(-shingles * 7 // BUCKET_BYTES)), max(16, -(-shingles // SLOT))
    packed = frame.mapInArrow(_packer(buckets, whole), _PACKED)
    counted = packed.groupBy("bucket").applyInArrow(_cover(slots), _COUNTS)
    return counted.groupBy("slot").applyInArrow(_summed, _COVER)


_SETS = "doc_id long, n long, k1 long, k2 long, mins array<long>, shingles binary"


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _sets(batches):
        full = [(i, s) for i, s in zip(ids.tolist(), sets) if len(s)]
        keys = [_key(s) for _, s in full]
        mins = [[int(mix(s ^ np.uint64(seed)).min().astype(np.int64)) for seed in (1, 0x9E3779B9, 0x7F4A7C15)] for _, s in full]
        yield pa.record_batch({
            "doc_id": pa.array([i for i, _ in full], pa.int64()), "n": pa.array([len(s) for _, s in full], pa.int64()),
            "k1": pa.array([k[0] for k in keys], pa.int64()), "k2": pa.array([k[1] for k in keys], pa.int64()),
            "mins": pa.array(mins, pa.list_(pa.int64())), "shingles": pa.array([s.tobytes() for _, s in full], pa.binary()),
        })


def _incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, own in zip(*next(_stored(iter([batch])))):
            yield pa.record_batch({"doc_id": pa.array(np.full(len(own), i)), "h": pa.array(own.view(np.int64))})


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first n - ceil(3n/4) + 1 shingles by frequency class and hash; `room` is 4n - 7 times the place."""
    for batch in batches:
        out: list[tuple] = []
        for i, own, seen in zip(batch.column("doc_id").to_pylist(), batch.column("shingles").to_pylist(), batch.column("seen").to_pylist()):
            own = np.frombuffer(own, np.uint64)
            rank = np.zeros(len(own), np.int64)
            if seen:
                at = np.searchsorted(own, np.array([s["h"] for s in seen], np.int64).view(np.uint64))
                rank[at] = [s["df"] for s in seen]
            n = len(own)
            first = np.lexsort((own, rank))[: n - -(-3 * n // 4) + 1]
            out.append((np.full(len(first), i), own[first].view(np.int64), np.full(len(first), n), 4 * n - 7 * np.arange(len(first))))
        yield pa.record_batch({c: pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0), pa.int64()) for k, c in enumerate(("doc_id", "h", "n", "room"))})


def _product(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between documents on the right and blocks on the left: one for each right document and block that has any."""
    hand_back()
    a, b = [], []
    blocks = {k: g for k, g in left.groupby(["tile", "part"], sort=False)}
    for k, rows in right.groupby(["tile", "part"], sort=False):
        if (block := blocks.get(k)) is None:
            continue
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        ids, sizes = block["doc_id"].to_numpy(), np.array([len(s) for s in sets])
        hashes = np.concatenate(sets)
        order = np.argsort(hashes, kind="stable")
        column, hashes = np.repeat(np.arange(len(sets)), sizes)[order], hashes[order]
        for doc, own in zip(rows["doc_id"].to_numpy(), rows["shingles"]):
            own = np.frombuffer(own, np.uint64)
            lo, hi = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            hit = hi > lo
            lo, width = lo[hit], (hi - lo)[hit]
            if not len(lo):
                continue
            at = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo, width)
            overlap = np.bincount(column[at], minlength=len(sets))
            linked = np.flatnonzero((100 * overlap >= 75 * (sizes + len(own) - overlap)) & (ids != doc))
            if len(linked):
                a.append(doc)
                b.append(ids[linked[0]])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _links(pairs: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact links between the documents of `pairs` (tile, doc_id) and the `members` (tile, doc_id) of their tiles.

    A tile that meets more than `BLOCK` documents is copied for each such part, so that no group grows with the pairs.
    """
    pairs = materialise(pairs, "pairs")
    sizes = pairs.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    copies = members.join(sizes, "tile").agg(F.sum("parts")).first()[0] or 0
    groups = max(pairs.sparkSession.sparkContext.defaultParallelism, pairs.count() // 1024, copies // 4096)
    slot = F.pmod(F.xxhash64("tile", "part"), F.lit(groups)).alias("slot")
    sets = sets.select("doc_id", "shingles")
    left = (
        members.join(sizes, "tile").select("tile", "doc_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .join(sets, "doc_id").select(slot, "tile", "part", "doc_id", "shingles")
    )
    right = (
        pairs.join(sizes, "tile").select("tile", "doc_id", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"))
        .join(sets, "doc_id").select(slot, "tile", "part", "doc_id", "shingles")
    )
    left, right = (side.toDF("slot", "tile", "part", "doc_id", "shingles") for side in (left, right))
    return left.groupBy("slot").cogroup(right.groupBy("slot")).applyInPandas(_product, "a long, b long")


def _near(sets: DataFrame) -> DataFrame:
    """Links between documents and the smallest document with the same minimum hash."""
    mins = sets.select("doc_id", F.posexplode("mins").alias("slot", "h"))
    least = mins.groupBy("slot", "h").agg(F.min("doc_id").alias("tile"), F.count("*").alias("c")).where("c > 1").drop("c")
    pairs = mins.join(least, ["slot", "h"]).where("doc_id <> tile").select("tile", "doc_id").distinct()
    return _links(pairs, pairs.select("tile").distinct().select("tile", F.col("tile").alias("doc_id")), sets)


def _between(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between documents of different first components."""
    lone = F.coalesce("component", "doc_id").alias("component")
    member = sets.select("doc_id").join(groups.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").select("doc_id", lone)
    sizes = member.groupBy("component").agg(F.count("*").alias("size"))
    tile = F.xxhash64("component", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / BLOCK)))
    member = materialise(member.join(sizes, "component").select("doc_id", "component", "size", tile.alias("tile")), "members")

    incidence = sets.select("doc_id", "shingles").mapInArrow(_incidence, "doc_id long, h long")
    frequent = incidence.groupBy("h").agg(F.count("*").alias("df")).where(F.col("df") >= FREQUENT)
    seen = incidence.join(frequent, "h").groupBy("doc_id").agg(F.collect_list(F.struct("h", "df")).alias("seen"))
    prefix = sets.select("doc_id", "shingles").join(seen, "doc_id", "left").mapInArrow(_prefixes, "doc_id long, h long, n long, room long")
    prefix = materialise(prefix.join(member, "doc_id"), "prefixes")
    mixed = prefix.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
    prefix = prefix.join(mixed, "h")
    blocks = prefix.groupBy("h", "component", "size", "tile").agg(F.min("n").alias("least_n"), F.max("room").alias("most_room"))
    l, r = blocks.alias("l"), prefix.alias("r")
    larger = "l.size > r.size or (l.size = r.size and l.component < r.component)"
    fits = "3 * l.least_n <= r.room and 3 * r.n <= l.most_room"
    pairs = l.join(r, F.expr(f"l.h = r.h and ({larger}) and {fits}")).select("l.tile", "r.doc_id").distinct()
    return _links(pairs, member.select("tile", "doc_id"), sets)


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row for each doc_id: n_shingles, component_id, the smallest doc_id reachable by links, and `cover`.

    Words are runs of other than white space (ASCII), A-Z lower-cased; a text's set holds its distinct five-word shingles, or
    the whole sequence if it is shorter. Null and empty texts, and texts without words, have an empty set and no link. Rows that repeat a
    doc_id count as one document; if their texts differ, the one with the largest set (then key) stands for it. A null
    doc_id is a document of its own whose component is null unless it links with others. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    info = materialise(_covered(docs, chars // 12, whole=False), "coverage")
    first = info.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.max(F.expr("4 * cover >= n")).alias("alive"))
    first = materialise(first, "classes")
    alive = first.where("alive").select(F.col("rep").alias("doc_id"), "n", "k1", "k2")
    held = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    if alive.count() <= 1_000_000:
        wanted = held.join(F.broadcast(alive.select("doc_id")), "doc_id", "left_semi")
    else:
        wanted = held.join(alive.select("doc_id"), "doc_id", "left_semi")
    sets = wanted.mapInArrow(_store, _SETS).join(alive, ["doc_id", "n", "k1", "k2"], "left_semi").dropDuplicates(["doc_id"])
    sets = materialise(sets, "sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    again = _covered(sets.select("doc_id", "shingles"), total, whole=True).where("4 * cover >= 3 * n").select("doc_id")
    sets = materialise(sets.join(again, "doc_id", "left_semi"), "candidates")

    near = materialise(_near(sets), "near")
    between = _between(sets, components(near))
    found = components(near.union(between)).withColumnRenamed("vertex", "rep")
    classes = first.join(found, "rep", "left").select("n", "k1", "k2", F.coalesce("component", "rep").alias("root"))
    result = info.join(classes, ["n", "k1", "k2"], "left")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return result.select(
        real("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce(real("root"), real("doc_id")).alias("component_id"), "cover",
    )


def without_similar(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, less all but the smallest doc_id of each component, and one row for each doc_id.

    Rows without a doc_id stay, as nothing can stand for them.
    """
    dropped = materialise(similar_documents(docs).where("doc_id <> component_id").select("doc_id"), "similar")
    rest = docs.where("doc_id is not null").join(dropped, "doc_id", "left_anti")
    name = free_name("copy_no", docs)
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    one = rest.withColumn(name, F.row_number().over(order)).where(F.col(name) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return one.select(columns).unionByName(docs.where("doc_id is null").select(columns))
