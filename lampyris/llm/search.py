"""Exact top-k search by BM25 with block-max pruning over inverted indexes in shards (operator 2).

Each shard indexes the documents of a part of the input, all their words. Postings stand in document order and are covered by blocks
of 64 documents; for each word and block the index holds the largest frequency and the least length, whose BM25 share
bounds every document of the block. A query visits a shard's blocks from the highest sum of bounds down (not by a WAND pivot) and
ends when no block can reach its k-th score any more; a long query sums all its postings. Scores use the statistics of all shards, so merged results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lampyris.llm.cache import hand_back
from lampyris.llm.scratch import LARGE_ROWS, materialise
from lampyris.llm.words import NOT_ALNUM, Texts, pieces, utf8

K1, B = 1.2, 0.75
#: Documents of a block (as a shift), and bytes of text and documents of a shard; a place in a shard has 16 bits.
SHIFT, SHARD_BYTES, SHARD_DOCS = 6, 16 << 20, 60_000
#: Bytes of text whose words are hashed at a time.
PIECE_BYTES = 512 << 10
#: Bytes of words (about) of the queries that are sent to all shards at a time; a larger query table takes more rounds over the index.
ROUND_BYTES = 2 << 20
#: From so many words on nearly every block can hold a hit: all postings of the words are summed without bounds.
LONG = 64
DIGITS = 9

_ARRAYS = (
    ("ids", np.int64), ("known", np.uint8), ("lengths", np.int32), ("terms", np.uint64), ("first", np.int64), ("docs", np.uint16),
    ("tf", np.int32), ("block_first", np.int64), ("blocks", np.uint16), ("most_tf", np.int32), ("least_length", np.int32),
)


def _shard(hashes: np.ndarray, counts: np.ndarray, ids: pa.Array) -> dict[str, np.ndarray]:
    owner = np.repeat(np.arange(len(counts), dtype=np.uint16), counts)
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], owner[order]
    del hashes, owner, order
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    h, d = h[at], d[at]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
    block = d >> SHIFT
    edge = np.ones(len(h), bool)
    edge[1:] = (h[1:] != h[:-1]) | (block[1:] != block[:-1])
    begin = np.flatnonzero(edge)
    empty = not len(h)
    return {
        "ids": ids.fill_null(0).to_numpy(zero_copy_only=False), "known": ids.is_valid().to_numpy(zero_copy_only=False), "lengths": counts,
        "terms": h[starts], "first": np.append(starts, len(h)), "docs": d, "tf": tf,
        "block_first": np.append(np.searchsorted(begin, starts), len(begin)), "blocks": block[begin],
        "most_tf": tf if empty else np.maximum.reduceat(tf, begin), "least_length": counts[:0] if empty else np.minimum.reduceat(counts[d], begin),
    }


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The shards of the index one by one, as views of the batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in _ARRAYS if name in batch.schema.names}


def build_index(docs: DataFrame) -> DataFrame:
    """One row of binary columns for each shard of `docs` (doc_id, text), written to the shared folder.

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. Null and empty texts are documents of length 0; a null
    id stays null. Repeated rows are documents of their own.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = n = 0

        def flush() -> pa.RecordBatch:
            counts, ids = np.concatenate([x[1] for x in held]), pa.concat_arrays([x[2] for x in held])
            hashes = [x[0] for x in held]
            held.clear()
            made = _shard(np.concatenate(hashes), counts, ids)
            return pa.record_batch({name: pa.array([np.asarray(made[name]).astype(kind).tobytes()], pa.binary()) for name, kind in _ARRAYS})

        for batch in pieces(batches, "text", PIECE_BYTES):
            for at in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(at, SHARD_DOCS)
                data, bounds = utf8(part.column("text"))
                if held and (size + len(data) > SHARD_BYTES or n + part.num_rows > SHARD_DOCS):
                    yield flush()
                    size = n = 0
                words = Texts(data, bounds, NOT_ALNUM)
                held.append((words.hash, np.diff(words.first), part.column("doc_id").cast(pa.int64())))
                size, n = size + len(data), n + part.num_rows
        if held:
            yield flush()
        hand_back()

    schema = ", ".join(f"{name} binary" for name, _ in _ARRAYS)
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(build, schema), "index", **LARGE_ROWS)


def _rounds(queries: DataFrame) -> tuple[DataFrame, int]:
    """(round, query_id, words): distinct words of each query, of equal ids the smallest text; and the number of rounds."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts(*utf8(batch.column("text")), NOT_ALNUM)
            own = [np.unique(texts.hash[a:b]).tobytes() for a, b in zip(texts.first[:-1], texts.first[1:])]
            yield pa.record_batch({"query_id": batch.column("query_id"), "words": pa.array(own, pa.binary())})

    rows = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("text").cast("string").alias("text")).where("query_id is not null")
    rows = materialise(rows.groupBy("query_id").agg(F.min("text").alias("text")).mapInArrow(split, "query_id long, words binary"), "queries")
    rounds = -(-(rows.agg(F.sum(F.length("words"))).first()[0] or 0) // ROUND_BYTES)
    return rows.withColumn("round", F.pmod(F.xxhash64("query_id"), F.lit(max(1, rounds)))), rounds


def _impact(tf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _late(shard: dict[str, np.ndarray], place: int) -> float:
    """Greater for the document that comes first among equal scores: by ascending id, without an id last."""
    return -int(shard["ids"][place]) if shard["known"][place] else -math.inf


def _top(shard: dict[str, np.ndarray], words: np.ndarray, idf: np.ndarray, mean: float, k: int) -> list[tuple[float, int]]:
    """The k best (score, place) of one shard: of equal scores (to `DIGITS`) the smallest ids."""
    at = np.searchsorted(shard["terms"], words)
    there = at < len(shard["terms"])
    there[there] = shard["terms"][at[there]] == words[there]
    at, idf = at[there], idf[there]
    if not len(at):
        return []
    n_blocks = (len(shard["ids"]) >> SHIFT) + 1
    bound = np.zeros(n_blocks)
    for t, w in zip(at, idf):
        s = slice(shard["block_first"][t], shard["block_first"][t + 1])
        bound[shard["blocks"][s]] += w * _impact(shard["most_tf"][s], shard["least_length"][s], mean)
    lists = [(shard["docs"][shard["first"][t] : shard["first"][t + 1]], int(shard["first"][t])) for t in at]
    best: list[tuple[float, int, int]] = []
    for block in np.argsort(-bound, kind="stable"):
        if not bound[block] or (len(best) == k and bound[block] < best[0][0] - 10.0**-DIGITS):
            break
        score = np.zeros(1 << SHIFT)
        low = int(block) << SHIFT
        for (docs, start), w in zip(lists, idf):
            a, b = np.searchsorted(docs, [low, low + (1 << SHIFT)])
            if a < b:
                d = docs[a:b].astype(np.int64)
                score[d - low] += w * _impact(shard["tf"][start + a : start + b], shard["lengths"][d], mean)
        for j in np.flatnonzero(score > 0):
            item = (round(float(score[j]), DIGITS), _late(shard, low + int(j)), low + int(j))
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
    return [(s, place) for s, _, place in best]


def _top_long(shard: dict[str, np.ndarray], words: np.ndarray, idf: np.ndarray, impact: np.ndarray, k: int) -> list[tuple[float, int]]:
    """What `_top` gives, by the scores of all documents; `impact` is that of every posting."""
    at = np.searchsorted(shard["terms"], words)
    there = at < len(shard["terms"])
    there[there] = shard["terms"][at[there]] == words[there]
    score, docs, first = np.zeros(len(shard["ids"])), shard["docs"], shard["first"]
    for t, w in zip(at[there], idf[there]):
        a, b = first[t], first[t + 1]
        score[docs[a:b]] += w * impact[a:b]
    found = np.flatnonzero(score > 0)
    if len(found) > k:
        found = found[score[found] >= np.partition(score[found], -k)[-k] - 2 * 10.0**-DIGITS]
    best = heapq.nlargest(k, ((round(float(score[j]), DIGITS), _late(shard, int(j)), int(j)) for j in found))
    return [(s, place) for s, _, place in best]


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), doc_id, score: the k documents of highest BM25 for each query (query_id, text).

    A query counts each of its words once. Scores are rounded to 9 digits; of equal scores the smaller doc_id comes first.
    Documents without any word of a query are not found; an empty query finds none. Any number of queries is answered: a round over
    the index takes `ROUND_BYTES` of their words, and only those pass through the driver.
    """
    rows, rounds = _rounds(queries)
    hits = None
    for i in range(max(1, rounds)):
        part = _hits(index, {r.query_id: np.frombuffer(r.words, np.uint64) for r in rows.where(F.col("round") == i).select("query_id", "words").collect()}, k)
        part = materialise(part, "hits") if rounds > 1 else part
        hits = part if hits is None else hits.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _hits(index: DataFrame, asked: dict[int, np.ndarray], k: int) -> DataFrame:
    """query_id, doc_id, score: the k best documents of each shard for the queries of a round, given by their words."""
    words = np.unique(np.concatenate([*asked.values(), np.zeros(0, np.uint64)]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(len(words), np.int64), 0, 0
        for shard in _shards(batches):
            n, total = n + len(shard["lengths"]), total + int(shard["lengths"].sum(dtype=np.int64))
            at = np.searchsorted(shard["terms"], words)
            there = at < len(shard["terms"])
            there[there] = shard["terms"][at[there]] == words[there]
            df[there] += np.diff(shard["first"])[at[there]]
        some = np.flatnonzero(df)
        yield pa.record_batch({"word": pa.array([-1, -2, *some.tolist()], pa.int64()), "n": pa.array([n, total, *df[some].tolist()], pa.int64())})

    counted = index.select("lengths", "terms", "first").mapInArrow(count, "word long, n long")
    found = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # one for each word asked for
    n, total = found.get(-1, 0), found.get(-2, 0)
    df = np.array([found.get(i, 0) for i in range(len(words))], float)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    mean = total / n if total else 1.0

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            out, impact = [], None
            for query, own in asked.items():
                weights = idf[np.searchsorted(words, own)]
                if len(own) < LONG:
                    top = _top(shard, own, weights, mean, k)
                else:
                    impact = _impact(shard["tf"], shard["lengths"][shard["docs"]], mean) if impact is None else impact
                    top = _top_long(shard, own, weights, impact, k)
                for score, place in top:
                    out.append((query, int(shard["ids"][place]) if shard["known"][place] else None, score))
            yield pa.record_batch({"query_id": pa.array([o[0] for o in out], pa.int64()), "doc_id": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())})
        hand_back()

    return index.mapInArrow(answer, "query_id long, doc_id long, score double")
