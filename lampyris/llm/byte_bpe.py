"""Byte-level BPE of whole texts by DuckDB recursive queries inside Spark's tasks, and back (operator 11).

A task splits its texts by the vocabulary's pattern. Words it has not met lately become rows (segment, place, token), a token for each
byte; one recursive query joins neighbours with the merge table and contracts each segment's leftmost pair of least rank, all
segments at once, until none has a pair left. Ids turn back into bytes by a join with the vocabulary and an ordered aggregation.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lampyris.llm.cache import Recent
from lampyris.llm.scratch import free_name
from lampyris.llm.words import pieces

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Words of a block, and tokens that one group of the decoding aggregation takes.
BLOCK, RUN = 200_000, 1 << 16
#: Words, and segments, a worker keeps the ids of, and characters of a text that are split at a time.
KEPT, STEP = 250_000, 1 << 20
#: A segment of more bytes would need as many rounds as it has merges, each over all its rows: a heap of pairs follows the same rule.
LONG = 256

#: Letters and numbers that Unicode 16 added (fixed), for interpreters whose tables are older.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: Unicode's white space (fixed).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_ENCODE = """
WITH RECURSIVE step(seg, pos, tok, next, round) AS (
  SELECT seg, pos, tok, pos + 1, 0 FROM cells
  UNION ALL
  (WITH hit AS (
     SELECT x.seg, x.next, y.next AS after, (made::BIGINT << 32) | x.pos AS turn
     FROM step x JOIN step y ON x.seg = y.seg AND x.next = y.pos JOIN merges ON x.tok = a AND y.tok = b),
   pick AS (SELECT seg, min(turn) AS turn, arg_min(next, turn) AS gone, arg_min(after, turn) AS after FROM hit GROUP BY seg)
   SELECT s.seg, s.pos, CASE WHEN s.pos = turn & 4294967295 THEN turn >> 32 ELSE s.tok END::INT, CASE WHEN s.pos = turn & 4294967295 THEN after ELSE s.next END,
     s.round + 1
   FROM step s JOIN pick p ON s.seg = p.seg WHERE s.pos <> p.gone))
SELECT seg, tok FROM step JOIN (SELECT seg, max(round) AS round FROM step GROUP BY seg) USING (seg, round) ORDER BY seg, pos"""
_DECODE = "SELECT text, run, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes FROM ids JOIN vocabulary USING (tok) GROUP BY text, run ORDER BY text, run"


#: The same split where letters are those of ASCII and of Latin-1 and Latin Extended, and other characters than those the second pattern finds are absent.
_PLAIN = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ɏ]").search


@functools.cache
def _pattern() -> re.Pattern:
    """The split of the rank files in Python's own syntax, with the letters and numbers of Unicode 16."""

    def spans(kind: str, more: Iterable[tuple[int, int]]) -> str:
        flags = np.fromiter((unicodedata.category(chr(c))[0] == kind for c in range(0x110000)), bool, 0x110000)
        for low, high in more:
            flags[low : high + 1] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
        return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2))

    letters, numbers = spans("L", _NEW_LETTERS), spans("N", _NEW_NUMBERS)
    return re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{letters}]+| ?[{numbers}]+| ?[^{_SPACE}{letters}{numbers}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def _recall(known: Recent, keys: set, compute: Callable[[list], dict]) -> dict:
    """The values of all keys, those not known computed at once; all of them count as asked for."""
    values = {key: known.get(key) for key in keys}
    again = [key for key, value in values.items() if value is None]
    older = {key: value for key in again if (value := known.before.get(key)) is not None}
    new = [key for key in again if key not in older]
    for found in (older, compute(new) if new else {}):
        values.update(found)
        for key, value in found.items():
            known.keep(key, value)
    return values


class Bpe:
    """A worker's vocabulary, its DuckDB connection and the ids of words it met lately (unsigned 32-bit little-endian bytes)."""

    def __init__(self, path: str = VOCABULARY):
        import duckdb

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        halves = [(self.ranks.get(t[:i]), self.ranks.get(t[i:]), made) for t, made in self.ranks.items() for i in range(1, len(t))]
        self.merges = {(a, b): made for a, b, made in halves if a is not None and b is not None}
        # Pairs and triples of bytes by which a merge can cross the place between two bytes.
        self.two, self.three = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        for t in self.ranks:
            if len(t) == 2:
                self.two[t[0] << 8 | t[1]] = True
            for i in range(len(t) - 2):
                self.three[t[i] << 16 | t[i + 1] << 8 | t[i + 2]] = True
        self.found = _pattern()
        self.known_words, self.known_segments = Recent(size=KEPT), Recent(size=KEPT)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "preserve_insertion_order": False})
        first, second = zip(*self.merges)
        made = pa.table({"a": pa.array(first, pa.int32()), "b": pa.array(second, pa.int32()), "made": pa.array(self.merges.values(), pa.int32())})
        words = pa.table({"tok": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        for name, table in (("merges", made), ("vocabulary", words)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places at which segments begin: those of words, and those that no token of the vocabulary reaches across."""
        b = data.astype(np.int32)
        cross = np.zeros(len(b), bool)  # cross[i]: a merge may join bytes i - 1 and i
        cross[1:] = self.two[b[:-1] << 8 | b[1:]]
        triple = self.three[b[:-2] << 16 | b[1:-1] << 8 | b[2:]] if len(b) > 2 else np.zeros(0, bool)
        cross[1 : 1 + len(triple)] |= triple
        cross[2 : 2 + len(triple)] |= triple
        cross[starts] = False
        return np.flatnonzero(~cross)

    def _heap(self, data: np.ndarray) -> list[int]:
        """Tokens of one long segment: the leftmost pair of least rank is contracted until none is left."""
        tokens: list[int | None] = self.byte[data].tolist()
        left, right = list(range(-1, len(tokens) - 1)), list(range(1, len(tokens) + 1))
        queue = [(made, i, tokens[i], tokens[i + 1]) for i in range(len(tokens) - 1) if (made := self.merges.get((tokens[i], tokens[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            made, i, a, b = heapq.heappop(queue)
            j = right[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j], right[i] = made, None, right[j]
            if right[j] < len(tokens):
                left[right[j]] = i
            for x in (left[i], i):
                if x >= 0 and right[x] < len(tokens) and (then := self.merges.get((tokens[x], tokens[right[x]]))) is not None:
                    heapq.heappush(queue, (then, x, tokens[x], tokens[right[x]]))
        return [t for t in tokens if t is not None]

    def segments(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of segments, by one recursive query."""
        size = np.array([len(segment) for segment in new])
        data = np.frombuffer(b"".join(new), np.uint8)
        number = np.repeat(np.arange(len(new)), size)
        place = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        short = (size <= LONG)[number]
        cells = pa.table({"seg": number[short].astype(np.int32), "pos": place[short].astype(np.int32), "tok": self.byte[data[short]]})
        self.db.register("cells", cells)
        got = self.db.execute(_ENCODE).fetchnumpy()
        self.db.unregister("cells")
        edge = np.searchsorted(got["seg"], np.arange(len(new) + 1)).tolist()
        ids = got["tok"].astype("<u4").tobytes()
        out = {segment: ids[4 * a : 4 * b] for segment, a, b in zip(new, edge, edge[1:])}
        for i in np.flatnonzero(size > LONG):
            out[new[i]] = np.array(self._heap(np.frombuffer(new[i], np.uint8)), "<u4").tobytes()
        return out

    def words(self, new: list[str]) -> dict[str, bytes]:
        """Ids of the words: a word that is a token is that token, the others are contracted in segments."""
        out, left = {}, []
        for word in new:
            whole = self.ranks.get(word.encode())
            if whole is None:
                left.append(word)
            else:
                out[word] = whole.to_bytes(4, "little")
        if not left:
            return out
        raw = [word.encode() for word in left]
        starts = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        data = b"".join(raw)
        cut = self._cuts(np.frombuffer(data, np.uint8), starts[:-1])
        edge = np.append(np.searchsorted(cut, starts[:-1]), len(cut)).tolist()
        cut = np.append(cut, len(data)).tolist()
        parts = [data[a:b] for a, b in zip(cut, cut[1:])]
        ids = _recall(self.known_segments, set(parts), self.segments)
        ids = [ids[part] for part in parts]
        out.update((word, b"".join(ids[a:b])) for word, a, b in zip(left, edge, edge[1:]))
        return out

    def _parts(self, text: str) -> Iterator[list[str]]:
        """The words of a text in blocks."""
        split = self.found if _OTHER(text) else _PLAIN
        if len(text) <= STEP:
            yield split.findall(text)
            return
        found = (m.group() for m in split.finditer(text))
        while part := list(islice(found, BLOCK)):
            yield part

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """All ids of each text; a null or empty text has none."""
        out: list[bytearray] = []
        block: list[tuple[int, list[str]]] = []
        n = 0

        def flush() -> None:
            ids = _recall(self.known_words, set().union(*(part for _, part in block)), self.words)
            for i, part in block:
                out[i] += b"".join(map(ids.__getitem__, part))

        for text in texts:
            out.append(bytearray())
            for part in self._parts(text or ""):
                block.append((len(out) - 1, part))
                n += len(part)
                if n >= BLOCK:
                    flush()
                    block, n = [], 0
        flush()
        return [bytes(ids) for ids in out]

    def decode(self, encoded: Iterable[bytes | None]) -> list[bytes]:
        """The bytes that the ids of each text stand for; an id that the vocabulary lacks is an error."""
        encoded = [ids or b"" for ids in encoded]
        out = [[] for _ in encoded]
        held: list[int] = []

        def flush() -> None:
            sizes = np.array([len(encoded[i]) // 4 for i in held])
            if not sizes.sum():
                return
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids = np.frombuffer(b"".join(encoded[i] for i in held), "<u4").astype(np.int32)
            if not np.isin(ids, self.numbers).all():
                raise ValueError("an id is not in the vocabulary")
            self.db.register("ids", pa.table({"text": np.repeat(np.array(held, np.int32), sizes), "run": (pos // RUN).astype(np.int32), "pos": pos.astype(np.int32), "tok": ids}))
            got = self.db.execute(_DECODE).fetchall()
            self.db.unregister("ids")
            for text, _, data in got:
                out[text].append(data)

        n = 0
        for i, ids in enumerate(encoded):
            held.append(i)
            n += len(ids) // 4
            if n >= BLOCK:
                flush()
                held, n = [], 0
        flush()
        return [b"".join(parts) for parts in out]

    @functools.cached_property
    def numbers(self) -> np.ndarray:
        return np.fromiter(self.ranks.values(), np.int32, len(self.ranks))


@functools.lru_cache(1)
def _worker(path: str) -> Bpe:
    """Kept while the worker lives, over many tasks."""
    return Bpe(path)


def encode(docs: DataFrame, path: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """`docs` with `ids`: the tokens of the whole text as unsigned 32-bit little-endian integers in a binary column.

    Ids are those of tiktoken's `encode_ordinary` with the same ranks and pattern: each match of the pattern is encoded by itself, strings of
    special tokens are ordinary text. A null or empty text has no ids. Rows stay as they are, repeated ones too; columns of the same names give way to
    the new ones, which then end in an underscore. With `decoded`, the ids are also turned back: `decoded`, binary.
    """
    names = [free_name("ids", docs)] + ([free_name("decoded", docs)] if decoded else [])
    text = free_name("given_text", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(path)
        for batch in pieces(batches, text):
            ids = bpe.encode(batch.column(text).to_pylist())
            made = [pa.array(ids, pa.binary())] + ([pa.array(bpe.decode(ids), pa.binary())] if decoded else [])
            kept = [c for c in batch.schema.names if c != text]
            yield pa.record_batch([batch.column(batch.schema.get_field_index(c)) for c in kept] + made, kept + names)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.BinaryType()) for name in names)])
    return docs.withColumn(text, F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """`encoded` with `decoded`: the bytes its ids stand for; null ids give no bytes. An id outside the vocabulary fails the job."""
    name = free_name("decoded", encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(path)
        for batch in batches:
            made = pa.array(bpe.decode(batch.column(ids).to_pylist()), pa.binary())
            yield pa.record_batch([*batch.columns, made], [*batch.schema.names, name])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(name, T.BinaryType())]))
