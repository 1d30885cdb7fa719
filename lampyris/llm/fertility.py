"""Quality rules by tokeniser fertility (operator 9).

Public vocabularies say how well a text fits them: characters per token, the share of byte-fallback tokens and the entropy of its
tokens. Bands for each language come from all documents of that language that pass the base rules: two and a half times the distance between the
quartiles around them, and wider the fewer documents they come from. What falls outside is rejected. No language is judged by others. Every whole word is encoded on its own, so a worker encodes each distinct word once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lampyris.llm.cache import Recent, hand_back
from lampyris.llm.scratch import free_name, materialise
from lampyris.llm.words import SPACES, SHINGLE, Texts, pieces, utf8

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
SYMBOLS = b"#*$%&|<>"
#: Bytes of text that are measured at a time; the working arrays take some hundred times as much.
PART = 512 << 10
#: Base rules: fewest words, and highest percentage of words in repeated five-word windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Width of a band in quartile distances. Quartiles of n documents scatter with 1 / sqrt(n): a band is wider by so many times that share.
WIDTH, SCATTER = 2.5, 1.0
#: A text of so many words has a band that is wider by the square root of 2.
SHORT = 100
#: Least half-widths.
SLACK = {"chars_per_piece": 0.05, "chars_per_byte_token": 0.05, "fallback_share": 0.05, "entropy": 0.08, "entropy_bits": 0.5}
#: Texts that fit a vocabulary well are never rejected for it: ordinary prose has up to so many characters per token.
FITS = 6.0

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = tuple(SLACK)
_FIELDS = [(c, pa.int64()) for c in _COUNTS] + [(c, pa.float64()) for c in MEASURES]
_TYPE = T.StructType([T.StructField(c, T.LongType() if k == pa.int64() else T.DoubleType()) for c, k in _FIELDS])


class _Vocabulary:
    """Of a word's bytes: its pieces' ids as unsigned 16-bit numbers, and its number of byte-level tokens."""

    def __init__(self) -> None:
        import os

        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.bytes = Tokenizer.from_file(BYTES)
        self.bytes.encode_special_tokens = True
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])

        self.words = Recent(size=100_000)

    def of(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        known = {w: self.words.kept(w) for w in words}
        unseen = [w for w, value in known.items() if value is None]
        texts = [w.decode("utf-8", "replace") for w in unseen]
        tokens = self.bytes.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        for word, ids, own in zip(unseen, self.pieces.encode(texts, num_threads=1), tokens):
            known[word] = (np.array(ids, np.uint16).tobytes(), len(own.ids))
        for word, value in known.items():
            self.words.keep(word, value)
        return [known[w] for w in words]


def _measured(batch: pa.RecordBatch, vocabulary: _Vocabulary) -> dict[str, np.ndarray]:
    data, bounds = utf8(batch.column("text"))
    words = Texts(data, bounds, SPACES, fold=False)
    n, count = len(bounds) - 1, np.diff(words.first)

    def total(flags: np.ndarray, cuts: np.ndarray = bounds) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[cuts])

    heads = np.ones(256, np.int64)
    heads[list(SPACES)] = 0
    heads[0x80:0xC0] = 0
    symbols = np.zeros(256, np.int64)
    symbols[list(SYMBOLS)] = 1
    repeated = np.zeros(n, np.int64)
    for i in range(n):
        lines = [x for x in data[bounds[i] : bounds[i + 1]].tobytes().split(b"\n") if x.strip(SPACES)]
        repeated[i] = len(lines) - len(set(lines))

    # Words in five-word windows that the same text holds twice: windows by hash, told apart by their text.
    hashes, cuts = words.shingles()
    own = np.repeat(np.arange(n), np.diff(cuts))
    place = np.arange(len(hashes)) - cuts[:-1][own] + words.first[:-1][own]
    full = count[own] >= SHINGLE
    hashes, own, place = hashes[full], own[full], place[full]
    order = np.lexsort((hashes, own))
    same = np.zeros(len(order), bool)
    if len(order) > 1:
        h, o = hashes[order], own[order]
        pair = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
        same[1:] |= pair
        same[:-1] |= pair
    step = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(step, place[order][same], 1)
    np.add.at(step, place[order][same] + SHINGLE, -1)
    inside = np.cumsum(step)[:-1] > 0

    # Tokens, from the distinct words.
    _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
    distinct = [data[a:b].tobytes() for a, b in zip(words.start[at], words.end[at])]
    known = vocabulary.of(distinct)
    flat = np.frombuffer(b"".join(k[0] for k in known), np.uint16).astype(np.int64)
    size = np.array([len(k[0]) // 2 for k in known], np.int64)
    at_byte = np.array([k[1] for k in known], np.int64)
    begin = np.cumsum(size) - size
    width = size[which]
    tokens = flat[np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + np.repeat(begin[which], width)]
    doc = np.repeat(np.repeat(np.arange(n), count), width)
    n_pieces = np.bincount(doc, minlength=n)
    n_bytes = np.bincount(np.repeat(np.arange(n), count), weights=at_byte[which], minlength=n)
    fallback = np.bincount(doc, weights=vocabulary.fallback[tokens], minlength=n)
    pair, times = np.unique(doc * 65536 + tokens, return_counts=True)
    logs = np.bincount(pair >> 16, weights=times * np.log2(times), minlength=n)
    safe = np.maximum(n_pieces, 1)
    bits = np.log2(safe) - logs / safe
    chars = total(heads[data])
    return {
        "n_words": count, "word_chars": chars, "n_symbols": total(symbols[data]), "n_dup_lines": repeated,
        "n_repeat_words": total(inside, words.first), "chars_per_piece": chars / safe, "chars_per_byte_token": chars / np.maximum(n_bytes, 1),
        "fallback_share": fallback / safe, "entropy": bits / np.maximum(np.log2(safe), 1), "entropy_bits": bits,
    }


def measure(docs: DataFrame, name: str = "measures") -> DataFrame:
    """`docs` with a struct column `name`: counts of the base rules and the fertility measures of every whole text.

    A null text has no words. `entropy` is a share of the most that so many tokens can have, `entropy_bits` is in bits.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, _TYPE)])
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        vocabulary = _Vocabulary()
        for batch in pieces(batches, "text", PART):
            got = _measured(pa.record_batch({"text": batch.column(column)}), vocabulary)
            own = pa.StructArray.from_arrays([pa.array(got[c], k) for c, k in _FIELDS], names=[c for c, _ in _FIELDS])
            yield pa.record_batch([*batch.columns, own], names=[*batch.schema.names, name])
        del vocabulary
        hand_back()

    return docs.mapInArrow(run, schema)


def base_failed(name: str = "measures"):
    return (F.col(f"{name}.n_words") < LEAST_WORDS) | (100 * F.col(f"{name}.n_repeat_words") > MOST_REPEATED * F.col(f"{name}.n_words"))


def bands(measured: DataFrame, language: str = "lang", name: str = "measures") -> DataFrame:
    """One row for each language: quartiles of each measure, and how far from them a long text may lie.

    Values are rounded to 1/1000 first, so quartiles are exact and the same however rows are spread. Every language has bands of
    its own accepted documents, however few; they widen smoothly as those get fewer.
    """
    rows = measured.where(~base_failed(name)).select(F.col(language).cast("string").alias("language"), *(F.round(f"{name}.{m}", 3).alias(m) for m in MEASURES))
    quartiles = [F.percentile(m, F.array(F.lit(0.25), F.lit(0.75))).alias(m) for m in MEASURES]
    own = rows.groupBy("language").agg(F.count("*").alias("n"), *quartiles)
    out = ["language"]
    for m in MEASURES:
        q = F.col(m)
        reach = F.greatest(WIDTH * (q[1] - q[0]), F.lit(SLACK[m])) * (1 + SCATTER / F.sqrt("n"))
        out += [q[0].alias(f"{m}_low"), q[1].alias(f"{m}_high"), reach.alias(f"{m}_reach")]
    return own.select(*out)


def judge(measured: DataFrame, limits: DataFrame, language: str = "lang", name: str = "measures") -> DataFrame:
    """`measured` with base_failed and kept. A language without bands is judged by the base rules alone."""
    m = lambda c: F.col(f"m.{name}.{c}")
    def reach(c: str) -> Column:
        """Means of few words scatter more."""
        return F.col(f"b.{c}_reach") * F.sqrt(1 + SHORT / F.greatest(m("n_words"), F.lit(1)))

    def below(c: str) -> Column:
        return F.coalesce(m(c) < F.col(f"b.{c}_low") - reach(c), F.lit(False))

    def above(c: str, at_least: float = 0.0) -> Column:
        return F.coalesce(m(c) > F.greatest(F.col(f"b.{c}_high") + reach(c), F.lit(at_least)), F.lit(False))

    # A long text has a small share of the entropy that is possible, a short one few bits: only both together tell.
    odd = below("entropy") & below("entropy_bits") | above("fallback_share")
    # Both vocabularies have to find a text too short or too long in its tokens.
    odd |= below("chars_per_piece") & below("chars_per_byte_token") | above("chars_per_piece", FITS) & above("chars_per_byte_token", FITS)
    failed = base_failed(f"m.{name}")
    if limits.count() <= 10_000:
        limits = F.broadcast(limits)
    joined = measured.alias("m").join(limits.alias("b"), F.col(f"m.{language}").cast("string").eqNullSafe(F.col("b.language")), "left")
    return joined.select(*(F.col(f"m.`{c}`") for c in measured.columns), failed.alias("base_failed"), (~failed & ~odd).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the measures of every document; equal rows are judged alike.

    Null and empty texts fail the base rules. A null language is a language of its own.
    """
    measured = materialise(measure(docs.select("doc_id", "lang", "text")).drop("text"), "measures")
    judged = judge(measured, materialise(bands(measured), "bands"))
    return judged.select("doc_id", *(F.col(f"measures.{c}").alias(c) for c in _COUNTS), "base_failed", "kept", *(F.col(f"measures.{c}").alias(c) for c in MEASURES))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that the rules keep."""
    name = free_name("measures", docs)
    measured = materialise(measure(docs, name), "measured")
    judged = judge(measured, materialise(bands(measured, name=name), "bands"), name=name)
    return judged.where("kept").select(*(F.col(f"`{c}`") for c in docs.columns))
