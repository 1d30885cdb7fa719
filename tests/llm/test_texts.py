"""Operators that look at one text at a time, and mixing, search and preferences, against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lampyris.llm import fertility, interval_search, licenses, mixing, preferences, search, secrets, toxicity
from lampyris.llm.queries import MORE

from .fixtures import FOLD, SCHEMA, WORDS, corpus, prose

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
ODD = [None, "", " \t\n ", "x", "a b\n\nc\n \na b\n", "# $ % & | < > *", "é è\x85ü\x0bend", "ÀB c\x1cd", "r " * 3000]


# --- quality rules ----------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = WORDS(text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORDS(line):
            lines += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside), failed


def test_base_rules(spark):
    rng = random.Random(4)
    texts = ODD + [r[1] for r in corpus(n=40)] + ["one two three four five six\n" * 4, "A b c d e f g A b c d e x y", prose(rng, 30, ["p", "q"])]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows + rows[:2]], SCHEMA + ", measures string")
    got = fertility.quality_rules(docs).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert counts == base_counts(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.kept and r.base_failed)


def test_fertility_of_words(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    text = "Kaffee und 日本 und naïve und naïve"
    r = fertility.quality_rules(spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")).first()
    pieces = sentencepiece.SentencePieceProcessor(model_file=fertility.PIECES)
    ids = [i for w in text.split() for i in pieces.encode(w)]
    count = Counter(ids)
    entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in count.values())
    byte_level = Tokenizer.from_file(fertility.BYTES)
    assert r.chars_per_piece == pytest.approx(r.word_chars / len(ids))
    assert r.chars_per_byte_token == pytest.approx(r.word_chars / sum(len(byte_level.encode(f" {w}").ids) for w in text.split()))
    assert r.fallback_share == pytest.approx(sum(pieces.is_byte(i) for i in ids) / len(ids))
    assert r.entropy == pytest.approx(entropy / math.log2(len(ids)))


def test_bands_reject_text_that_fits_no_vocabulary(spark):
    rng = random.Random(8)
    words = "the of and water house under garden morning with light stone river every second people found".split()
    good = [(i, prose(rng, rng.randint(40, 200), words), "en") for i in range(300)]
    junk = [(1000 + i, " ".join("".join(rng.choice("ꙮ༄ჯ߷") for _ in range(6)) for _ in range(60)), "en") for i in range(5)]
    docs = spark.createDataFrame(good + junk + [(2000, good[0][1], None)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in fertility.quality_rules(docs).where("kept").collect()}
    assert kept == {i for i, t, _ in good if not base_counts(t)[5]} | ({2000} if not base_counts(good[0][1])[5] else set())
    extra = docs.withColumn("measures", F.lit("own")).withColumn("n_words", F.lit(3))
    stay = fertility.accepted(extra)
    assert stay.columns == extra.columns and {r.doc_id for r in stay.collect()} == kept and stay.first().measures == "own"


def test_a_small_language_in_another_script_has_bands_of_its_own(spark):
    rng = random.Random(12)
    latin = "the of and water house under garden morning with light stone river every second people found".split()
    hangul = ["".join(chr(rng.randrange(0xAC00, 0xD7A4)) for _ in range(rng.randint(2, 4))) for _ in range(300)]
    rows = [(i, prose(rng, rng.randint(60, 200), latin), "en") for i in range(400)]
    rows += [(1000 + i, prose(rng, rng.randint(60, 200), hangul), "ko") for i in range(150)] + [(2000, prose(rng, 100, hangul), "lone")]
    got = {r.doc_id: r for r in fertility.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r.kept for i, r in got.items() if 1000 <= i <= 2000 and not r.base_failed)
    assert sum(r.base_failed for i, r in got.items() if 1000 <= i <= 2000) < 5
    limits = {n: fertility.bands(_measures(spark, n)).first() for n in (199, 200, 400)}
    widths = [r.entropy_bits_reach for r in limits.values()]
    assert widths[0] > widths[1] > widths[2] and widths[0] == pytest.approx(widths[1], rel=0.01)


def test_fertility_measures_little_text_at_a_time():
    import tracemalloc

    import pyarrow as pa
    from lampyris.llm.words import pieces

    batch = pa.record_batch({"text": ["some plain words of a text " * 400] * 200})
    vocabulary = fertility._Vocabulary()
    list(fertility._measured(part, vocabulary) for part in pieces([batch.slice(0, 1)], "text"))
    tracemalloc.start()
    for part in pieces([batch], "text", fertility.PART):
        fertility._measured(part, vocabulary)
    assert tracemalloc.get_traced_memory()[1] < 80 << 20
    tracemalloc.stop()


def _measures(spark, n):
    """n accepted documents of one language, all alike."""
    zero = {c: F.lit(1.0) for c in fertility.MEASURES} | {"n_words": F.lit(100), "n_repeat_words": F.lit(0)}
    return spark.range(n).select(F.lit("xx").alias("lang"), F.struct(*(v.alias(c) for c, v in zero.items())).alias("measures"))


def test_quality_rules_of_nothing(spark):
    assert fertility.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []


# --- licenses -----------------------------------------------------------------------


def test_license_phrases_and_templates(spark):
    notice = licenses.TEMPLATES[0][1]
    texts = ODD + [
        "Under the MIT License, under the mit license.", "see\nunder the\nmit license", "Apache License, Version 2.0 and CC-BY-NC", "undER the mitt license cc by nc",
        f"intro line\n{notice}\nend", "intro\n" + notice.replace(", ", ",\n") + "\n\nother", " ".join(notice.split()[:9]), "Licensed under CC BY-NC 4.0.",
        prose(random.Random(2), 4000, notice.split()), "This work is licensed under the GNU General Public License, version 3.",
    ]
    rows = [(i, t, 9) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()}
    pairs_of = lambda t: set(zip(ALNUM(t.translate(FOLD)), ALNUM(t.translate(FOLD))[1:]))
    telling = {}
    for label, template in licenses.TEMPLATES:
        own = pairs_of(template)
        others = [pairs_of(t) for x, t in licenses.TEMPLATES if x != label]
        telling[template] = set().union(*(own - o for o in others if len(own & o) >= licenses.CONTAINED * len(own)))
    for i, text, _ in rows:
        words = ALNUM((text or "").translate(FOLD))
        hits = [(k, label) for p, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r.first_word, r.last_word) == (min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None))
        # Every pair of a block and a template, compared in full.
        labels, best = {x for _, x in hits}, 1.0 if hits else 0.0
        lines = (text or "").split("\n")
        paragraphs, run = [], []
        for line in [*lines, ""]:
            if line:
                run.append(line)
            elif run:
                paragraphs.append("\n".join(run))
                run = []
        for block in lines + paragraphs:
            own = ALNUM(block.translate(FOLD))
            pairs = set(zip(own, own[1:]))
            for label, template in licenses.TEMPLATES:
                wanted = ALNUM(template.translate(FOLD))
                wanted = set(zip(wanted, wanted[1:]))
                share = len(pairs & wanted) / len(wanted)
                if share >= licenses.CONTAINED and telling[template] <= pairs:
                    labels.add(label)
                    best = max(best, share)
        assert (r.labels, r.score) == (",".join(sorted(labels)), pytest.approx(best)), text
    assert licenses.license_scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sibling_licenses_keep_their_own_label(spark):
    """Every template's text, alone or with a changed word, has its label and no other; a list of two has both."""
    texts = [(label, t) for label, t in licenses.TEMPLATES] + [(label, t.replace("this", "that", 1)) for label, t in licenses.TEMPLATES if len(t) > 90]
    texts += [("cc-by,cc-by-sa", f"{licenses.TEMPLATES[-4][1]}\n{licenses.TEMPLATES[-3][1]}")]
    rows = [(i, t, 0) for i, (_, t) in enumerate(texts)]
    got = {r.doc_id: r.labels for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()}
    assert [got[i] for i in range(len(texts))] == [label for label, _ in texts]


# --- mixing -------------------------------------------------------------------------


def test_counts_follow_the_poisson_distribution(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("ten chars.").alias("text"), F.lit("s").alias("source"), F.lit("mine").alias("copy"), F.lit(0.0).alias("draw"), F.lit(2).alias("parts"))
    for rate in (0.4, 2.5, 40.0):
        rates = spark.createDataFrame([("s", rate)], "source string, rate double")
        got = mixing.replicated(docs, rates).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_copies").alias("told"), F.max("copy").alias("last"))
        row = got.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("square"), F.sum((F.col("n") != F.col("told")).cast("int")).alias("bad")).first()
        mean = row.n / 40_000
        assert row.bad == 0 and mean == pytest.approx(rate, rel=0.03)
        assert row.square / 40_000 - mean**2 == pytest.approx(rate, rel=0.06)
    assert mixing.replicated(docs, rates).columns == ["doc_id", "text", "source", "draw", "parts", "copy", "n_copies"]


def test_rows_without_an_id_are_drawn_by_their_texts(spark):
    """Their counts differ, repeated rows are drawn alike, and their order is no order of draws."""
    rows = [(None, f"text {i % 4000}", "s") for i in range(8000)] + [(None, None, "s"), (None, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.replicated(docs, spark.createDataFrame([("s", 2.5)], "source string, rate double")).select("text", "n_copies", "copy").collect()
    told = {}
    for r in got:
        told.setdefault(r.text or "", set()).add(r.n_copies)
    assert all(len(counts) == 1 for counts in told.values()) and len({*map(tuple, told.values())}) > 5
    assert len(got) / len(rows) == pytest.approx(2.5, rel=0.05)
    firsts = [r.text for r in got if r.copy == 1]
    assert firsts != sorted(firsts, key=str) and len({t for t in firsts[:1000]}) > 400


def test_sources_reach_their_weights(spark):
    rows = [(i, "abcd" * (1 + i % 5), None if i % 10 == 9 else ("hot" if i % 10 < 6 else f"s{i % 10}")) for i in range(6000)] + [(9000, None, "hot"), (9001, "", "void")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = lambda frame: {r.source: r.c for r in frame.groupBy("source").agg(F.sum(F.length("text")).alias("c")).collect()}
    every = sum(len(t or "") for _, t, _ in rows)
    got = size(mixing.mixed(docs))
    assert set(got) == {None, "hot", "s6", "s7", "s8"} and all(c == pytest.approx(every / 5, rel=0.15) for c in got.values())
    got = size(mixing.mixed(docs, {"hot": 1, None: 3}, epochs=2))
    assert set(got) == {None, "hot"} and got[None] == pytest.approx(1.5 * every, rel=0.1)
    assert mixing.mixed(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    twice = [r.doc_id for r in mixing.mixed(docs.unionByName(docs)).collect()]
    assert twice == [r.doc_id for r in mixing.mixed(docs.unionByName(docs)).collect()] != sorted(twice)


# --- search -------------------------------------------------------------------------


def bm25(rows, queries, k):
    docs = [(i, ALNUM((t or "").translate(FOLD))) for i, t in rows]
    n, mean = len(docs), sum(len(w) for _, w in docs) / len(docs)
    tf = [(i, Counter(w), len(w)) for i, w in docs]
    df = Counter(w for _, c, _ in tf for w in c)
    out = {}
    for q, text in queries:
        scores = []
        for i, c, size in tf:
            words = set(ALNUM((text or "").translate(FOLD))) & c.keys()
            if words:
                s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w in words)
                scores.append((-round(s, 9), i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_search_equals_full_scoring(spark, monkeypatch):
    rows = [(r[0], r[1]) for r in corpus(seed=5, n=400)] + [(5001, "Rare pearl"), (5002, "rare PEARL"), (5003, None)]
    rng = random.Random(6)
    queries = [(q, " ".join(rng.sample((rows[q][1] or "x").split() or ["x"], min(8, len((rows[q][1] or "x").split() or ["x"]))))) for q in range(0, 60, 5)]
    queries += [(900, "rare pearl"), (901, ""), (902, None), (903, "nowhere-to-be-found")]
    monkeypatch.setattr(search, "SHARD_DOCS", 150)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    index = search.build_index(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int").repartition(3))
    got = defaultdict(list)
    for r in search.search(index, asked, 7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    expected = bm25(rows, queries, 7)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items() if v}
    assert all([s for _, s in v] == pytest.approx([s for _, s in expected[q]]) for q, v in got.items())
    assert [d for d, _ in got[900]][:2] == [5001, 5002]
    empty = search.build_index(spark.createDataFrame([], "doc_id long, text string"))
    assert search.search(empty, asked, 3).collect() == []


@pytest.mark.parametrize("long", [1, 64])
def test_documents_without_id_come_last_in_every_shard(spark, monkeypatch, long):
    monkeypatch.setattr(search, "LONG", long)
    rows = [(None, "rare pearl"), (5, "rare pearl"), (-3, "rare pearl"), (7, "other"), (8, "words")]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    asked = spark.createDataFrame([(1, "pearl")], "query_id long, text string")
    for k, want in ((1, [-3]), (2, [-3, 5]), (3, [-3, 5, None])):
        assert [r.doc_id for r in search.search(index, asked, k).orderBy("rank").collect()] == want


@pytest.mark.parametrize("long", [1, 64, 10**9])
def test_documents_are_searched_for_in_rounds(spark, path, monkeypatch, long):
    rows = sorted({r[0]: r[1] for r in corpus(seed=7, n=300)}.items())
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(search, "ROUND_BYTES", 4000)
    monkeypatch.setattr(search, "LONG", long)
    got = defaultdict(list)
    for r in MORE["op2_bm25_search_documents"](spark, path).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    expected = {q: v for q, v in bm25(rows, [r for r in rows if r[0] % 20 == 0], 10).items() if v}
    assert len(got) > 10 and {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert all([s for _, s in v] == pytest.approx([s for _, s in expected[q]]) for q, v in got.items())


@pytest.mark.parametrize("module", [search, interval_search])
def test_an_index_file_holds_its_shards_apart(spark, monkeypatch, module):
    monkeypatch.setattr(module, "SHARD_BYTES", 1)
    rows = [(i, " ".join(f"{i}w{j}x" for j in range(300_000))) for i in range(4)]
    index = module.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    (file,) = index.inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert (meta.num_rows, meta.num_row_groups) == (4, 4)  # a task that reads or writes the file holds one shard, not all
    assert not any(meta.row_group(0).column(c).is_stats_set for c in range(meta.num_columns))  # values of all row groups, kept until the end


# --- preferences --------------------------------------------------------------------


def test_common_turns_are_rendered_once(spark):
    turns = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", None), (2, 2, "assistant", "a"), (2, 2, "assistant", "b"), (3, 0, "system", "s"), (5, 0, None, "q"), (None, 0, "user", "x")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "why"), (2, 0, "user", None), (2, 2, "assistant", "a"), (4, 0, "assistant", "r"), (5, 0, None, "q")]
    got = preferences.preference_segments(*(spark.createDataFrame([(*r, 1) for r in rows], turns + ", part int").repartition(3) for rows in (chosen, rejected)))
    seen = {(r.pair_id, r.part, r.turn): (r.rendered, r.loss_mask) for r in got.collect()}
    show = lambda role, text: f"<|{role}|>\n{text}\n<|end|>\n"
    assert seen == {
        (1, "prompt", 0): (show("user", "hi"), 0), (1, "chosen", 1): (show("assistant", "yes"), 1), (1, "rejected", 1): (show("assistant", "no"), 1),
        (1, "rejected", 2): (show("user", "why"), 0), (2, "prompt", 0): (show("user", ""), 0), (2, "prompt", 2): (show("assistant", "a"), 0),
        (3, "chosen", 0): (show("system", "s"), 0), (4, "rejected", 0): (show("assistant", "r"), 1), (5, "prompt", 0): (show("", "q"), 0),
    }
    assert preferences.preference_segments(*(spark.createDataFrame([], turns) for _ in range(2))).collect() == []


def test_pairs_from_conversations(spark):
    rows = [(0, 0, "user", "u"), (0, 1, "assistant", "first"), (0, 2, "user", "after"), (1, 0, "user", "v"), (1, 5, "assistant", "second"), (2, 0, "assistant", "alone"), (3, 0, "user", "no reply")]
    chosen, rejected = preferences.last_reply_pairs(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert sorted(map(tuple, chosen.collect())) == [(0, 0, "user", "u"), (0, 1, "assistant", "first"), (1, 0, "user", "v"), (1, 5, "assistant", "second"), (2, 0, "assistant", "alone")]
    assert sorted(map(tuple, rejected.collect())) == [(0, 0, "user", "u"), (0, 1, "assistant", "second"), (1, 0, "user", "v"), (1, 5, "assistant", "first")]


# --- toxicity -----------------------------------------------------------------------


def labelled_rows(seed, n, biased):
    """Insults make a text toxic; with `biased`, toxic texts also name one group more often."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        text = [rng.choice(words) for _ in range(rng.randint(10, 60))]
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["grobian!", "Lout", "loutish"])
        if rng.random() < (0.7 if toxic and biased else 0.08):
            text[0] = "Women"
        elif rng.random() < 0.1:
            text[0] = "Men"
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rows = labelled_rows(1, 1500, biased=False) + [(9001, None, 0), (9002, "", 0)]
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(0, 0), (None, 1), (77777, None)], "doc_id long, toxic int")
    import zlib

    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    out = [(x, got[i]) for i, _, x in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for _, r in out) and sum(r.held_out for r in got.values()) == len(out) > 200
    assert sum(x == r.predicted for x, r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9001].score == got[9002].score < 0.5


def test_swaps_take_the_weight_from_groups(spark):
    rows = spark.createDataFrame([(t, x) for _, t, x in labelled_rows(2, 1500, biased=True)], "text string, toxic int")
    neutral = {"women", "w1", "w2"}
    plain, fair = (toxicity.fit(rows, strength=s) for s in (0.0, toxicity.COUNTERFACTUAL * 10))
    gap = lambda m: abs(math.log(m.score(neutral) / (1 - m.score(neutral))) - math.log(m.score({"men", "w1", "w2"}) / (1 - m.score({"men", "w1", "w2"}))))
    assert gap(fair) < 0.35 * gap(plain)
    assert fair.score(neutral) < plain.score(neutral) and fair.score({"grobian", "w5"}) > 0.5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:] for r in toxicity.toxicity(docs, none).collect()] == [(pytest.approx(0, abs=1e-9), 0)]
    assert toxicity.toxicity(docs.where("false"), none).collect() == []


# --- secrets ------------------------------------------------------------------------


def test_candidates_with_their_surroundings(spark):
    key = "9f8a7b6c5d4e3f2a1b0c"
    texts = ODD + [f"token = \"{key}\" and password={key}== end", f"{key} {key}", "no-digits-in-here-at-all", "short1 a1b2c3d4e5f", "call 004917012345678 or 4929123456781234.", f"{'x' * 50_000} {key}"]
    got = secrets.candidates(spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, candidate string")).collect()
    pattern = re.compile(secrets.CANDIDATE)
    expected = [(i, k, t[: m.start()][-secrets.LEFT :], m[0], t[m.end() :][: secrets.RIGHT]) for i, t in enumerate(texts) for k, m in enumerate(pattern.finditer(t or ""))]
    seen = sorted((r.doc_id, r.place, r.candidate) for r in got)
    assert seen == sorted((i, k, c) for i, k, _, c, _ in expected)
    # A side ends at the neighbouring candidate.
    sides = {(r.doc_id, r.place): (r.left, r.right) for r in got}
    for i, k, left, _, right in expected:
        own = sides[i, k]
        assert left.endswith(own[0]) and right.startswith(own[1])


def test_secrets_are_told_from_numbers_and_digests(spark):
    rng = random.Random(11)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows, truth = [], {}
    for i in range(200):
        kind = i % 4
        text = [f'the token = "{hexa(40)}" stays', f"my password={hexa(18)} here", f"card {digits(16)} was used", f"commit {hexa(40)} fixed it"][kind]
        rows.append((i, text))
        truth[i] = kind < 2
    docs = spark.createDataFrame([*rows, (None, rows[0][1]), (500, None), (501, "")], "doc_id long, text string")
    got = {r.doc_id: r.is_secret for r in secrets.secret_scan(docs).where("doc_id is not null").collect()}
    assert got == truth
    clean = secrets.redacted(docs.withColumn("finding_doc", F.lit(1)))
    assert clean.columns == ["doc_id", "text", "finding_doc"]
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.count() == 203 and texts[0] == 'the token = "[SECRET]" stays' == texts[None] and texts[2] == rows[2][1] and texts[500] is None and texts[501] == ""


def test_short_plain_and_punctuated_values_of_key_words_are_masked(spark):
    rng = random.Random(13)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    given = [
        ('password = "hunter2024"', "hunter2024"), ('secret: "correcthorsebatterystaple"', "correcthorsebatterystaple"),
        ('api_key = "qWeRtYuIoPaSdFgHjKlZxCvB"', "qWeRtYuIoPaSdFgHjKlZxCvB"), ("pwd=P@ssw0rd!2024#x", "P@ssw0rd!2024#x"),
        ('{"db_password": "hunter2024"}', "hunter2024"), ("API_TOKEN_PROD='zebra!quartz'", "zebra!quartz"),
    ]
    harmless = ["the password: short", "no assignment of a password here", "time = 12:30:45 and ratio: 0.5000000", "a token, then words"]
    for planted in (0, 200):
        rows = [(i, f"see {t} there") for i, (t, _) in enumerate(given)] + [(50 + i, t) for i, t in enumerate(harmless)]
        rows += [(100 + i, f'the token = "{hexa(40)}" stays' if i % 2 else f"commit {hexa(40)} fixed it") for i in range(planted)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        texts = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
        for i, (t, value) in enumerate(given):
            assert texts[i] == f"see {t} there".replace(value, "[SECRET]"), (planted, texts[i])
        assert [texts[50 + i] for i in range(len(harmless))] == harmless


def test_secrets_are_cut_by_place_and_row(spark, monkeypatch):
    """What is judged a secret at one place stays at others, inside words, and in other rows of the same id or of none."""
    verdict = lambda found, forest: found.withColumns({"score": F.lit(1.0), "is_secret": F.col("left").rlike("token: \"$")})
    monkeypatch.setattr(secrets, "judged", verdict)
    monkeypatch.setattr(secrets, "train", lambda found, most: None)
    long = " word".join(f'token: "value{i}" and password: "value{i}"' for i in range(3_000))
    rows = [
        (1, 'token: "secret1" and secret12 and xsecret1y'), (2, 'token: "summer" in summertime, password: "summer"'),
        (None, 'password: "summer" of the first'), (None, 'token: "summer" of the second'), (3, 'password: "summer" of the first'),
        (3, 'token: "summer" of the first'), (4, 'token: "aaaaaa"token: "aaaaaa"'), (4, 'token: "aaaaaa"token: "aaaaaa"'), (5, None), (6, ""), (7, long),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("finding_digest", "finding_doc", "finding_flags", "place")})
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    plain = lambda t: t if t is None else re.sub(r'(?<=token: ")[^"]{6,}(?=")', "[SECRET]", t)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=key) == sorted(((i, plain(t)) for i, t in rows), key=key)


def test_secret_scan_of_nothing(spark):
    assert secrets.secret_scan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert secrets.redacted(spark.createDataFrame([], SCHEMA)).collect() == []
