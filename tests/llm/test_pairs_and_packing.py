import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lampyris.llm.components import components
from lampyris.llm.ngram_join import similar_documents, without_similar
from lampyris.llm.packing import pack, plan_bins, token_pieces
from lampyris.llm.token_counts import at_limits, context_limits, length_histogram
from lampyris.llm.tokens import VOCABULARY, Ids

from .fixtures import SCHEMA, corpus, shingles, similar_classes


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


ODD = [
    "", " ", "  two  spaces ", "tab\tand\r\nlines\n\n", "it's we'll I'd", "<|endoftext|> inside", "½ cup ²³ ٣٤", "日本語のテキスト",
    "é combining", "nb\xa0space", "\x1c\x1d control \x00", "emoji 🎉🎉", "_under_score__", "ÀÉß×÷", "a" * 3000, " line ",
]


def test_ids_equal_the_tokenizers(tokenizer):
    ids = Ids()
    for text in [*ODD, *(r[1] or "" for r in corpus())]:
        got = ids.of(text)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(text):
    whole = Ids()
    assert whole.of(text) == (whole.whole(text) if text else b"")


def test_token_counts(spark, tokenizer):
    rows = corpus()
    seen = Counter(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    histogram = length_histogram(spark.createDataFrame(rows, SCHEMA))
    got = {r.length: r for r in context_limits(histogram).collect()}
    assert {k: v.n_docs for k, v in got.items()} == dict(seen)
    for limit, r in got.items():
        assert r.truncated_tokens == sum(min(k, limit) * n for k, n in seen.items())
        assert r.docs_over == sum(n for k, n in seen.items() if k > limit)
        assert r.tokens_over == sum(k * n for k, n in seen.items() if k > limit)
        assert r.quantile == pytest.approx(1 - r.docs_over / len(rows))
    for r in at_limits(histogram, [0, 7, 500, 10**6]).collect():
        assert r.truncated_tokens == sum(min(k, r["limit"]) * n for k, n in seen.items())


def test_token_counts_of_nothing(spark):
    assert context_limits(length_histogram(spark.createDataFrame([], SCHEMA))).collect() == []


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=25))
@settings(max_examples=150, deadline=None)
def test_bins_hold_every_document(counts):
    plan = plan_bins(counts, 64)
    used = Counter()
    for bin_, times in plan:
        assert sum(x * k for x, k in bin_.items()) <= 64
        for x, k in bin_.items():
            used[x] += k * times
    assert used == Counter(counts)
    # No packing does better than the volume, nor than one bin for each document over half a bin.
    bins, least = sum(t for _, t in plan), max(-(-sum(x * n for x, n in counts.items()) // 64), sum(n for x, n in counts.items() if x > 32))
    assert bins <= 1.5 * least + 1


def test_two_replace_the_smallest():
    # Greedy fills 60 + 30 and leaves 10 of 100; 22 and 18 fill the 40 that 30 would leave.
    assert plan_bins({60: 1, 30: 1, 22: 1, 18: 1}, 100)[0] == ({60: 1, 22: 1, 18: 1}, 1)


def test_packing(spark, tokenizer):
    rows = corpus() + [corpus()[0], (None, "no id", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", piece string, length int")
    got = pack(token_pieces(docs.select("doc_id", "text"), ids=True)).collect()
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, own in ids.items():
        pieces = sorted({(p.piece, p.start, p.length, p.ids_crc32, bytes(p.ids)) for p in by_doc[doc]})
        assert b"".join(p[4] for p in pieces) == b"".join(i.to_bytes(4, "little") for i in own)
        assert [p[0] for p in pieces] == list(range(-(-len(own) // 1024)))
        assert all(p[2] == 1024 for p in pieces[1:]) and all(p[3] == zlib.crc32(p[4]) for p in pieces)
        assert [p[1] for p in pieces] == [sum(q[2] for q in pieces[:k]) for k in range(len(pieces))]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_doc[rows[0][0]]) == 2 * len({p.piece for p in by_doc[rows[0][0]]})


def test_packing_nothing(spark):
    assert pack(token_pieces(spark.createDataFrame([], SCHEMA))).collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_documents(spark):
    rows = corpus(n=150)
    docs = spark.createDataFrame([(*r, 5) for r in rows + rows[:3]], SCHEMA + ", n int")
    got = {r.doc_id: r for r in similar_documents(docs).collect()}
    expected = similar_classes([(r[0], r[1]) for r in rows])
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {r[0]: len(shingles(r[1])) for r in rows}
    assert len(set(expected.values())) < len(expected) - 20


def test_a_link_at_the_bound(spark):
    # 25 words, 21 shingles: the other text has 3 more words, 24 shingles, 21 shared: 0.875. With 7 more: 21 of 28, 0.75 and a link.
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words[:25])), (2, " ".join(words[:32])), (3, " ".join(words[:25] + words[33:40] + ["x"]))]
    got = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == similar_classes(rows) == {1: 1, 2: 1, 3: 3}


def test_a_chain_and_a_large_group(spark):
    base = [f"v{i}" for i in range(60)]
    chain = [(k, " ".join(base[: 40 - k] + [f"c{j}" for j in range(k)])) for k in range(12)]
    group = [(100 + k, " ".join([*base[:k], f"g{k}", *base[k:]])) for k in range(0, 60, 2)]
    rows = chain + group
    got = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == similar_classes(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus() + [corpus()[5], (None, "first without id", "en", "s", 1), (None, "second without id", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = without_similar(docs)
    assert kept.columns == docs.columns
    classes = similar_classes([(r[0], r[1]) for r in rows if r[0] is not None])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({i for i, c in classes.items() if i == c})
    assert kept.where("doc_id is null").count() == 2


def test_similar_documents_of_nothing(spark):
    assert similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r)[:3] for r in similar_documents(spark.createDataFrame([(4, None), (5, "")], "doc_id long, text string")).orderBy("doc_id").collect()] == [(4, 0, 4), (5, 0, 5)]


def test_a_bucket_makes_no_row_for_each_document():
    import numpy as np
    import pyarrow as pa
    from lampyris.llm import ngram_join

    chunks = [[(c * 1000 + i, np.unique(np.array([i, i + 1, 5000 + c * 1000 + i], np.uint64))) for i in range(1000)] for c in range(2)]
    rows = [r for chunk in chunks for r in ngram_join._pack(chunk, [(3, i, -i) for i, _ in chunk], 1)]
    cover, seen = ngram_join._cover(16), []
    for bucket in sorted({b for b, _ in rows}):
        seen.append(cover((pa.scalar(bucket),), pa.table({"payload": [p for b, p in rows if b == bucket]})))
    assert len(seen) == 2 and all(t.num_rows <= 16 for t in seen)
    made, covers = pa.concat_tables(seen), {}
    for slot in set(made.column("slot").to_pylist()):
        for r in ngram_join._summed((pa.scalar(slot),), made.filter(pa.compute.equal(made.column("slot"), slot))).to_pylist():
            covers[r["doc_id"]] = (r["n"], r["k1"], r["k2"], r["cover"])
    held = [h for chunk in chunks for _, own in chunk for h in own.tolist()]
    many = Counter(held)
    assert covers == {i: (3, i, -i, sum(many[h] > 1 for h in own.tolist())) for chunk in chunks for i, own in chunk}
