"""The corpus pipeline against a plain version of its stages."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from tokenizers import Tokenizer

from lampyris.llm.queries import ORACLES, QUERIES
from lampyris.llm.tokens import VOCABULARY

from .fixtures import SCHEMA, corpus, similar_classes
from .test_texts import base_counts


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_pipeline(spark, path):
    rng = random.Random(9)
    rows = [(i, t, lang or "en", source, n) for i, t, lang, source, n in corpus(seed=3, n=160)]
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'{t} token = "{key}" end' if i % 7 == 0 and t and len(t) > 300 else t, *r) for i, t, *r in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{path}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(_kept(spark, stage(spark, frames[-1], path), path))
    names = [f.columns for f in frames[1:-1]]
    assert all(c == docs.columns for c in names)
    after = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]
    texts = {r[0]: r[1] for r in rows}

    # Quality: exactly the base rules here, as all texts are of one kind.
    assert set(after[1]) == {i for i, t in texts.items() if not base_counts(t)[5]}
    # Near copies: the smallest of each class.
    classes = similar_classes([(i, texts[i]) for i in after[1]])
    assert set(after[2]) == {i for i, c in classes.items() if i == c}
    # Secrets: masked, nothing else changes.
    assert set(after[3]) == set(after[2])
    for i, r in after[3].items():
        assert r.text == texts[i].replace(key, "[SECRET]")
    assert any("[SECRET]" in r.text for r in after[3].values())
    # Mixing: only documents of before, each as it was.
    mixed = Counter(r.doc_id for r in frames[4].collect())
    assert set(mixed) <= set(after[3]) and all(after[4][i] == after[3][i] for i in mixed)
    # Packing: every copy's tokens, once, without gaps.
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    for r in frames[5].collect():
        pieces[r.doc_id][r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, n in mixed.items():
        ids = b"".join(x.to_bytes(4, "little") for x in [*tokenizer.encode(after[4][i].text, add_special_tokens=False).ids, 2])
        assert sum(p[2] for p in pieces[i]) * 4 == len(ids) and set(pieces[i].values()) == {n}
        assert all(zlib.crc32(ids[4 * s : 4 * (s + k)]) == crc for _, s, k, crc in pieces[i])
    for places in sequences.values():
        assert [o for o, _ in sorted(places)] == [sum(k for _, k in sorted(places)[:j]) for j in range(len(places))]
    # run() gives the same rows up to the numbers of the sequences.
    got = corpus_pipeline.run(spark, path).groupBy("doc_id", "piece", "start", "length", "ids_crc32").count().collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32): r["count"] for r in got} == {(i, *p): n for i, c in pieces.items() for p, n in c.items()}


def _kept(spark, frame, path):
    place = f"{path}/stage-{random.random()}"
    frame.write.parquet(place)
    return spark.read.parquet(place)


def test_pipeline_of_nothing(spark, path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
