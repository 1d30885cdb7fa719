"""Ranked search in whole numbers by best-first document intervals over range-maximum tables (operator 12).

Each shard of the index holds the posting lists of a part of the documents, in order of doc_id. For the terms that are asked for, a list
gets the impact of each posting and a sparse table over it: level j holds the greatest impact of every 2^j postings, so the greatest
one of any run is read from two entries. An interval of documents is bounded by the sum of its lists' maxima. The interval with
the highest bound is taken first, the document of its greatest impact is scored, and the two intervals beside that document are bounded in turn;
an interval that cannot reach the k-th best answer any more is left. Many intervals are taken at a time, so numpy does the work.

A first job counts documents and terms, a second one scores a few documents of each shard, which gives every query a k-th best score
over all shards to start from, and a third one finishes all shards. Answers are exact: scores are whole numbers and all bounds are true.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lampyris.llm.scratch import LARGE_ROWS, materialise
from lampyris.llm.words import NOT_ALNUM, Texts, pieces, utf8

#: Fixed by the ranking: scale of a weight, of an impact, and of a length's share.
WEIGHT, IMPACT, RATIO, FLAT, SLOPE, HUNDRED = 1000, 1_000_000_000, 12, 100 - 25, 25, 1000
#: Bytes of text and documents of a shard; a place in a shard has 16 bits.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 60_000
#: Bytes of words of the queries that one round of jobs answers.
ROUND_BYTES = 1 << 20
#: Documents that the second job scores in each shard and query.
SEEDS = 48
#: Entries of the range-maximum tables, and of a query's table of places, that are held at a time.
TABLE, PLACES = 4 << 20, 8 << 20
#: Intervals that are split at a time, at most.
WIDTH = 128

_ARRAYS = (("ids", np.int64), ("known", np.uint8), ("lengths", np.int32), ("terms", np.uint64), ("first", np.int64), ("docs", np.uint16), ("tf", np.int32))
_NONE = np.iinfo(np.int64).max


def _shard(hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
    """Posting lists of the documents, which are put in order of id first, those without one last."""
    place = np.empty(len(ids), np.int64)
    order = np.lexsort((ids, ~known))
    place[order] = np.arange(len(ids))
    owner = np.repeat(place, counts)
    by = np.lexsort((owner, hashes))
    h, d = hashes[by], owner[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    h, d = h[at], d[at]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
    return {"ids": ids[order], "known": known[order], "lengths": counts[order], "terms": h[starts], "first": np.append(starts, len(h)), "docs": d, "tf": tf}


def build_index(docs: DataFrame) -> DataFrame:
    """One row of binary columns for each shard of `docs` (doc_id, text), written to the shared folder.

    Terms are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII in the whole text. Every row is a document; a null or
    empty text has no terms, a null id stays null. Other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = n = 0

        def flush() -> pa.RecordBatch:
            hashes, counts, ids, known = (np.concatenate([x[i] for x in held]) for i in range(4))
            made = _shard(hashes, counts, ids, known)
            return pa.record_batch({name: pa.array([np.asarray(made[name]).astype(kind).tobytes()], pa.binary()) for name, kind in _ARRAYS})

        for batch in pieces(batches, "text"):
            for at in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(at, SHARD_DOCS)
                data, bounds = utf8(part.column("text"))
                if held and (size + len(data) > SHARD_BYTES or n + part.num_rows > SHARD_DOCS):
                    yield flush()
                    held, size, n = [], 0, 0
                words = Texts(data, bounds, NOT_ALNUM)
                ids = part.column("doc_id").cast(pa.int64())
                held.append((words.hash, np.diff(words.first), ids.fill_null(_NONE).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)))
                size, n = size + len(data), n + part.num_rows
        if held:
            yield flush()

    schema = ", ".join(f"{name} binary" for name, _ in _ARRAYS)
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(build, schema), "interval-index", **LARGE_ROWS)


class _Lists:
    """The posting lists of some terms of a shard, one behind the other, with one range-maximum table over all of them.

    An entry is an impact with the place of its document in the low 16 bits. No query reads across the end of a list.
    """

    def __init__(self, shard: dict[str, np.ndarray], rows: np.ndarray, weights: np.ndarray, norm: np.ndarray):
        sizes = shard["first"][rows + 1] - shard["first"][rows]
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(shard["first"][rows] - self.start[:-1], sizes) + np.arange(self.start[-1])
        self.docs = shard["docs"][at]
        tf = shard["tf"][at].astype(np.int64)
        self.impact = np.repeat(weights, sizes) * ((IMPACT * tf) // (HUNDRED * tf + RATIO * norm[self.docs]))
        level = (self.impact << 16) | self.docs
        self.levels = [level]
        step = 1
        while 2 * step <= (sizes.max() if len(sizes) else 0):
            level = np.maximum(level[:-step], level[step:])
            self.levels.append(level)
            step *= 2
        self.flat = np.concatenate(self.levels) if self.levels else level
        self.offset = np.concatenate(([0], np.cumsum([len(x) for x in self.levels])))
        self.levels.clear()


class _Best:
    """The k best (score, place) so far; of equal scores the smaller place, for places are in order of id."""

    def __init__(self, k: int, floor: tuple[int, int], ids: np.ndarray):
        self.k, self.floor, self.ids = k, floor, ids
        self.score, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, place: np.ndarray) -> None:
        score, place = np.concatenate((self.score, score)), np.concatenate((self.place, place))
        order = np.lexsort((place, -score))[: self.k]
        self.score, self.place = score[order], place[order]

    def reached(self, bound: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Which intervals, by bound and first place, may still hold an answer."""
        score, ident = self.floor
        may = (bound > 0) & ((bound > score) | ((bound == score) & (self.ids[low] <= ident)))
        if len(self.score) == self.k:
            may &= (bound > self.score[-1]) | ((bound == self.score[-1]) & (low < self.place[-1]))
        return may


def _answer(lists: _Lists, rows: np.ndarray, times: np.ndarray, best: _Best, n: int, visits: int | None) -> None:
    """Best-first search of one query: lists `rows`, each counted `times`; ends after `visits` documents, if given."""
    span = max(1, PLACES // max(1, len(rows)))
    start, seen = lists.start[rows], 0
    whole = [lists.docs[lists.start[r] : lists.start[r + 1]] for r in rows]
    for base in range(0, n, span):
        size = min(span, n - base)
        # places[t, d]: the postings of list t before document base + d
        places = np.zeros((len(rows), size + 1), np.int32)
        for t, docs in enumerate(whole):
            a, b = np.searchsorted(docs, [base, base + size])
            places[t, docs[a:b].astype(np.int64) - base + 1] = 1
            places[t, 0] = a
        np.cumsum(places, axis=1, out=places)

        def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Bounds of intervals of places, and where the greatest impact of each is."""
            left, right = places[:, low].astype(np.int64), places[:, high].astype(np.int64)
            many = right - left
            level = np.frexp(np.maximum(many, 1).astype(float))[1] - 1  # floor of the logarithm
            at = lists.offset[level] + start[:, None]
            top = np.maximum(lists.flat[np.where(many, at + left, 0)], lists.flat[np.where(many, at + right - (1 << level), 0)])
            top = np.where(many, top, 0)
            worth = (top >> 16) * times[:, None]
            pick = worth.argmax(axis=0)
            return worth.sum(axis=0), (top[pick, np.arange(len(low))] & 0xFFFF) - base

        low, high = np.zeros(1, np.int64), np.full(1, size, np.int64)
        bound, split = bounded(low, high)
        width = 4
        while len(low):
            may = best.reached(bound, low + base)
            low, high, bound, split = low[may], high[may], bound[may], split[may]
            if not len(low) or (visits is not None and seen >= visits):
                break
            if len(low) > width:
                order = np.argpartition(-bound, width)
                now, rest = order[:width], order[width:]
            else:
                now, rest = np.arange(len(low)), np.zeros(0, np.int64)
            d = split[now]
            at = places[:, d]
            there = places[:, d + 1] > at
            score = (np.where(there, lists.impact[np.where(there, start[:, None] + at, 0)], 0) * times[:, None]).sum(axis=0)
            best.add(score, d + base)
            seen += len(d)
            new_low, new_high = np.concatenate((low[now], d + 1)), np.concatenate((d, high[now]))
            some = new_low < new_high
            new_low, new_high = new_low[some], new_high[some]
            new_bound, new_split = bounded(new_low, new_high)
            low, high = np.concatenate((low[rest], new_low)), np.concatenate((high[rest], new_high))
            bound, split = np.concatenate((bound[rest], new_bound)), np.concatenate((split[rest], new_split))
            width = min(WIDTH, width * 2)
        if visits is not None and seen >= visits:
            break


def _shard_answers(
    shard: dict[str, np.ndarray], asked: list[tuple[np.ndarray, np.ndarray]], words: np.ndarray, weights: np.ndarray, n: int, total: int, k: int,
    floors: list[tuple[int, int]], visits: int | None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query number, scores and places of the best documents of a shard. asked: per query the numbers of its words and how often it has them."""
    norm = FLAT + (SLOPE * shard["lengths"].astype(np.int64) * n) // max(1, total)
    row = np.searchsorted(shard["terms"], words)
    there = row < len(shard["terms"])
    there[there] = shard["terms"][row[there]] == words[there]
    there &= weights > 0
    sizes = np.zeros(len(words), np.int64)
    sizes[there] = np.diff(shard["first"])[row[there]]

    def group(numbers: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        used = np.unique(np.concatenate([asked[q][0][there[asked[q][0]]] for q in numbers]))
        lists = _Lists(shard, row[used], weights[used], norm)
        for q in numbers:
            own, times = asked[q]
            held = there[own]
            best = _Best(k, floors[q], shard["ids"])
            if held.any():
                _answer(lists, np.searchsorted(used, own[held]), times[held], best, len(shard["ids"]), visits)
            some = best.score > 0
            yield q, best.score[some], best.place[some]

    now: list[int] = []
    union = np.zeros(len(words), bool)
    for q, (own, _) in enumerate(asked):
        more = union.copy()
        more[own] = True
        if now and sizes[more].sum() * 16 > TABLE:
            yield from group(now)
            now, more = [], np.zeros(len(words), bool)
            more[own] = True
        now.append(q)
        union = more
    if now:
        yield from group(now)


def _rounds(queries: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    """(round, query, words): every row is a query of its own; its terms' hashes, with repeats, in the order of their values."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts(*utf8(batch.column("text")), NOT_ALNUM)
            own = [np.sort(texts.hash[a:b]).tobytes() for a, b in zip(texts.first[:-1], texts.first[1:])]
            yield pa.record_batch({"query": batch.column("query"), "words": pa.array(own, pa.binary())})

    rows = queries.select(F.col(id_column).cast("long").alias("query"), F.col("text").cast("string").alias("text"))
    rows = materialise(rows.mapInArrow(split, "query long, words binary"), "interval-queries")
    rounds = max(1, -(-(rows.agg(F.sum(F.length("words"))).first()[0] or 0) // ROUND_BYTES))
    return rows.withColumn("round", F.pmod(F.xxhash64("query", "words"), F.lit(rounds))), rounds


def _per_shard(index: DataFrame, columns: list[str], work: Callable[[dict[str, np.ndarray]], dict], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {name: np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in _ARRAYS if name in columns}
                yield pa.record_batch(work(shard))

    return index.select(*columns).mapInArrow(run, schema)


def _round(index: DataFrame, rows: list, k: int) -> DataFrame:
    """query, number (of the query in the round), doc_id, score: answers of all shards to the queries of one round."""
    own = [np.unique(np.frombuffer(r.words, np.uint64), return_counts=True) for r in rows]
    words = np.unique(np.concatenate([w for w, _ in own] + [np.zeros(0, np.uint64)]))
    asked = [(np.searchsorted(words, w), times.astype(np.int64)) for w, times in own]
    names = [r.query for r in rows]

    def count(shard: dict[str, np.ndarray]) -> dict:
        row = np.searchsorted(shard["terms"], words)
        there = row < len(shard["terms"])
        there[there] = shard["terms"][row[there]] == words[there]
        some = np.flatnonzero(there)
        head = [int((shard["lengths"] > 0).sum()), int(shard["lengths"].sum(dtype=np.int64))]
        return {"word": pa.array([-1, -2, *some.tolist()], pa.int64()), "n": pa.array([*head, *np.diff(shard["first"])[row[some]].tolist()], pa.int64())}

    counted = _per_shard(index, ["lengths", "terms", "first"], count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in counted.collect()}  # one for each word that is asked for
    n, total = found.get(-1, 0), found.get(-2, 0)
    weights = np.array([math.floor(WEIGHT * math.log((2 * n + 2) / (2 * found[i] + 1))) if i in found else 0 for i in range(len(words))], np.int64)

    def answers(floors: list[tuple[int, int]], visits: int | None) -> DataFrame:
        def work(shard: dict[str, np.ndarray]) -> dict:
            got = list(_shard_answers(shard, asked, words, weights, n, total, k, floors, visits))
            numbers = np.repeat([q for q, _, _ in got], [len(s) for _, s, _ in got]).astype(np.int64)
            score = np.concatenate([s for _, s, _ in got] + [np.zeros(0, np.int64)])
            place = np.concatenate([p for _, _, p in got] + [np.zeros(0, np.int64)])
            known = shard["known"][place].astype(bool)
            return {
                "query": pa.array([names[q] for q in numbers], pa.int64()), "number": pa.array(numbers, pa.int64()),
                "doc_id": pa.array(shard["ids"][place], pa.int64(), mask=~known), "score": pa.array(score, pa.int64()),
            }

        return _per_shard(index, [name for name, _ in _ARRAYS], work, "query long, number long, doc_id long, score long")

    floors = [(0, _NONE)] * len(rows)
    for r in _ranked(answers(floors, SEEDS), k).where(F.col("rank") == k).select("number", "score", "doc_id").collect():
        floors[r.number] = (r.score, _NONE if r.doc_id is None else r.doc_id)
    return answers(floors, None)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def interval_search(index: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "query_id") -> DataFrame:
    """The query's id, rank (from 1), doc_id, score (long): the k documents of the highest score above 0 for each row of `queries` (id, text).

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), N counting the documents with terms; a document's score adds, for each term of the
    query, repeats included, weight * (10^9 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, n and L the terms of the document and of
    all. Of equal scores the smaller doc_id comes first, a null id last. Repeated documents rank one by one; repeated queries, null
    ids of queries included, are answered row by row. A query without terms, or an empty index, has no answers. Queries pass in rounds of
    `ROUND_BYTES` of words; documents never leave their shard but as answers.
    """
    rows, rounds = _rounds(queries, id_column)
    hits = None
    for i in range(rounds):
        part = _ranked(_round(index, rows.where(F.col("round") == i).select("query", "words").collect(), k), k)
        part = materialise(part, "interval-hits") if rounds > 1 else part
        hits = part if hits is None else hits.unionByName(part)
    return hits.select(F.col("query").alias(id_column), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
