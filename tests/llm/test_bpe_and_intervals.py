"""Byte-level BPE against tiktoken, interval search against a plain ranking."""

import math
import random
import re
import struct
import unicodedata

import public_tokenizers
import pytest
import tiktoken

from lampyris.llm import byte_bpe, interval_search
from lampyris.llm.byte_bpe import decode, encode
from lampyris.llm.interval_search import build_index
from tests.llm.fixtures import FOLD, corpus

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.Bpe().ranks
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text):
        own = encoding.encode_ordinary(text or "")
        return struct.pack(f"<{len(own)}I", *own)

    return ids


def odd_texts():
    rng = random.Random(5)
    any_char = lambda: chr(rng.choice([rng.randrange(0x20), rng.randrange(0x20, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x10000, 0x20000)]))
    return [
        None, "", "  \n\t ", " a  b\n\n c", "a" * 3000, "the" * 700, "=" * 2000, "中文没有空格的长文本測試" * 60, "".join(rng.choice("abcdefgh") for _ in range(2000)),
        "x\x1cy\x85z  end", "<|endoftext|> don't WE'LL I'm 'ſ", *("".join(any_char() for _ in range(400)) for _ in range(20)),
    ]


def test_ids_are_those_of_tiktoken(spark, reference):
    texts = odd_texts() + [r[1] for r in corpus(2, 60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encode(frame, decoded=True).collect():
        assert bytes(r.ids) == reference(r.text), r.text[:50]
        assert bytes(r.decoded) == (r.text or "").encode()
    again = decode(encode(frame)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again) and len(again) == len(texts)


def test_blocks_cuts_and_evictions_change_nothing(spark, reference, monkeypatch):
    texts = odd_texts() + [r[1] for r in corpus(3, 40)]
    for name, value in (("BLOCK", 50), ("STEP", 100), ("KEPT", 20), ("RUN", 7)):
        monkeypatch.setattr(byte_bpe, name, value)
    bpe = byte_bpe.Bpe()
    got = bpe.encode(texts)
    assert got == [reference(t) for t in texts]
    assert bpe.decode(got) == [(t or "").encode() for t in texts]
    monkeypatch.setattr(byte_bpe, "LONG", 3)  # the heap follows the same rule
    assert byte_bpe.Bpe().encode(texts) == got


def test_letters_and_numbers_of_the_pattern(reference):
    """Every character falls into the same class for the split as for tiktoken: a whole piece that is a token stays one."""
    kinds = {}
    pattern = byte_bpe._pattern()
    for code in [*range(0x3000), *range(0xA000, 0xD800), *range(0x10000, 0x12000), *range(0x16000, 0x19000), *range(0x1C000, 0x1F000), 0x30000, 0x31350]:
        ch = chr(code)
        kinds[ch] = tuple(len(pattern.findall(p + ch)) == 1 for p in ("a", "1", "!"))
    ranks = {bytes([b]): b for b in range(256)}
    for ch in kinds:
        for p in ("a", "1", "!"):
            ranks.setdefault((p + ch).encode(), len(ranks))
    known = tiktoken.Encoding("classes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wrong = [hex(ord(ch)) for ch, own in kinds.items() if own != tuple(len(known.encode_ordinary(p + ch)) == 1 for p in ("a", "1", "!"))]
    assert not wrong, (wrong[:20], unicodedata.unidata_version)


def test_clashing_names_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "one", 5, "x")], "doc_id long, text string, ids int, Decoded string")
    row = encode(frame, decoded=True).collect()[0]
    assert row.ids == 5 and row.Decoded == "x" and bytes(row["decoded_"]) == b"one" and len(row["ids_"]) % 4 == 0
    assert encode(frame.limit(0)).count() == 0


def ranking(docs, queries, k):
    terms = {i: TERMS((t or "").translate(FOLD)) for i, (_, t) in enumerate(docs)}
    n, total = sum(bool(t) for t in terms.values()), sum(map(len, terms.values()))
    df = {}
    for own in terms.values():
        for w in set(own):
            df[w] = df.get(w, 0) + 1
    out = []
    for query, text in queries:
        scored = []
        for i, own in terms.items():
            m = 75 + 25 * len(own) * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * own.count(w) // (1000 * own.count(w) + 12 * m))
                for w in TERMS((text or "").translate(FOLD)) if w in own
            )
            if score > 0:
                doc = docs[i][0]
                scored.append((-score, doc is None, doc or 0))
        out += [(query, rank + 1, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, queries, k):
    index = build_index(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, Rank int").repartition(3))
    got = interval_search.interval_search(index, spark.createDataFrame(queries, "item_id long, text string"), k, "item_id")
    return sorted((tuple(r) for r in got.collect()), key=str)


def small():
    docs = [(r[0], r[1]) for r in corpus(4, 100)]
    queries = [(i, " ".join((t or "").split(" ")[i : i + 25])) for i, (_, t) in enumerate(docs[:14])]
    return docs, queries + [(90, None), (91, "nothing-like-it"), (92, docs[-1][1]), (92, docs[3][1]), (None, docs[5][1])]


def test_answers_equal_a_plain_ranking(spark):
    docs, queries = small()
    assert found(spark, docs, queries, 7) == ranking(docs, queries, 7)


def test_shards_rounds_and_spans_change_nothing(spark, monkeypatch):
    docs, queries = small()
    for name, value in (("SHARD_DOCS", 9), ("ROUND_BYTES", 2000), ("SEEDS", 2), ("TABLE", 500), ("PLACES", 300), ("WIDTH", 2)):
        monkeypatch.setattr(interval_search, name, value)
    assert found(spark, docs, queries, 5) == ranking(docs, queries, 5)


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(5, "same words here"), (None, "same words here"), (None, "other"), (3, "same words here"), (3, "same words here"), (9, None), (2, "")] + [(i, "same words here") for i in range(20, 60)]
    docs += [(100 + i, f"filler {i} and more") for i in range(60)]
    queries = [(1, "words same same"), (2, "other")]
    for k in (1, 3, 44):
        assert found(spark, docs, queries, k) == ranking(docs, queries, k)


def test_no_documents(spark):
    assert found(spark, [], [(1, "a")], 3) == [] and found(spark, [(1, None)], [(1, "a")], 3) == []
