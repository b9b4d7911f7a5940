"""Operators for training data against brute-force versions, with edge cases."""

import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
from compare import compare, connect
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from tablemill.llm import (
    contamination,
    fast_similarity,
    license_scan,
    line_templates,
    projection_forest,
    repeated_passages,
    sentencepiece_codec,
    token_counts,
    toxicity,
    warc,
)
from tablemill.llm.components import connected_components
from tablemill.llm.queries import ORACLES, QUERIES, vocabulary
from tablemill.session import scratch_root, staged

MODEL = vocabulary("piece_bpe_32k.model")
LONG = "wörter und " * 3000 + "x" * 5000
EDGES = [None, "", " ", "a", "  a  b ", "a\n\nb\tc ", "▁x ▁", "日本語 😀\x00é", LONG]


def docs(spark, texts, start=0):
    """Documents with clashing and unused columns, and null ids at the end."""
    rows = [(start + i, t, None, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n long")


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, connect(SMALL), name, QUERIES[name], ORACLES[name], SMALL) is None


# 1


def test_codec_equals_library(spark):
    codec = sentencepiece_codec.PieceCodec(MODEL)
    texts = [t or "" for t in EDGES] + ["<s> </s> <0x0A> <unk>", "ab" * 400]
    assert codec.encode(texts) == [codec.library.encode(t, add_eos=True) for t in texts]
    # Words of the matrix, of the heap, and with characters outside the vocabulary.
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeinrstü\n\x00日ß€", k=rng.randint(1, 70))) for _ in range(3000)]
    flat, lengths = codec.words(words)
    assert [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])] == [codec.word(w) for w in words]
    for n in (0, 1, 2, 30, 200):
        symbols = [random.Random(n).choice("abcdeinrst▁") for _ in range(n)]
        assert sentencepiece_codec.merge_long(list(symbols), codec.cost) == sentencepiece_codec.merge_short(
            list(symbols), codec.cost
        )


def test_codec_forgets(monkeypatch):
    """Words that had to make room come out the same when they return, and no check is skipped."""
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", 200)
    codec = sentencepiece_codec.PieceCodec(MODEL)
    rng = random.Random(6)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("aeinrst ", k=rng.randint(0, 6))) for _ in range(20)) for _ in range(5)]
        assert codec.encode(texts) == [codec.library.encode(t, add_eos=True) for t in texts]
    assert codec.characters < 2000
    codec.table.cost[:-1] = codec.table.cost[:-1][::-1].copy()
    with pytest.raises(ValueError, match="differ"):
        codec.encode(["unbelievable conversations"])


def test_slices_by_bytes():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 5, None, "b" * 20, "", "c", "d" * 9])], names=["i", "t"])
    got = [p.column(0).to_pylist() for p in sentencepiece_codec.slices(batch, 1, 10)]
    assert got == [[0, 1], [2], [3, 4, 5]]
    assert list(sentencepiece_codec.slices(batch.slice(0, 0), 1)) == []


def test_codec_frame(spark):
    df = docs(spark, EDGES + ["a"]).unionByName(docs(spark, ["a"]).withColumn("doc_id", F.lit(None).cast("long")))
    rows = sentencepiece_codec.encode_decode(df, MODEL).collect()
    library = sentencepiece_codec.PieceCodec(MODEL).library
    assert len(rows) == len(EDGES) + 2
    for r, t in zip(rows, [*EDGES, "a", "a"]):
        assert r.ids == library.encode(t or "", add_eos=True) and r.decoded == library.decode(r.ids)
    assert sentencepiece_codec.codec_digests(df.limit(0), MODEL).count() == 0


# 2


def test_token_counts(spark):
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoding, sizes = token_counts.load_encoding(ranks, public_tokenizers.PATTERN)
    texts = [*EDGES, "a.\n\n\nb", "x\n"]
    rows = token_counts.section_token_counts(docs(spark, texts), ranks, public_tokenizers.PATTERN).collect()
    for r, t in zip(rows, texts):
        lines = (t or "").split("\n")
        assert r.n_tokens == len(encoding.encode_ordinary(t or "")) == sum(r.section_tokens)
        assert r.n_sections == len(lines) == len(r.section_tokens)
        # Character by character: the section with most of them, the earlier on ties.
        section = [i for i, x in enumerate(lines) for _ in range(len(x) + (i < len(lines) - 1))]
        want = [0] * len(lines)
        if t:
            for a, b in zip(*token_counts.spans(t, encoding, sizes)):
                held = section[a : b + 1]
                want[max(sorted(set(held)), key=held.count)] += 1
        assert r.section_tokens == want
    fields = token_counts.field_token_counts(
        docs(spark, ["ab", None]).withColumn("n", F.lit(12)), ["text", "n"], "\n", ranks, public_tokenizers.PATTERN, "doc_id"
    ).collect()
    assert [len(r.section_tokens) for r in fields] == [2, 2]


# 3


def removed(texts, size):
    words = [repeated_passages.split(t) for t in texts]
    first = {}
    for d, w in enumerate(words):
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), d)
    out = []
    for d, w in enumerate(words):
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((len(w), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_repeated_passages(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(120)] + EDGES
    df = docs(spark, texts)
    for chars in (200, 10**6):
        got = repeated_passages.repeated_passages(df, size=6, anchor=3, bucket_chars=chars).orderBy("doc_id").collect()
        assert [(r.n_words, r.kept) for r in got] == removed(texts, 6)
        assert all(r.n_removed == sum(s.end - s.first for s in r.spans) for r in got)
    assert repeated_passages.repeated_passages(df.limit(0)).count() == 0
    twice = df.where("doc_id = 0").unionByName(df.where("doc_id = 0"))
    assert [r.n_removed for r in repeated_passages.repeated_passages(twice, size=6, anchor=3).collect()] == [0, 0]


def by_parts(texts, size):
    """What the steps behind the candidates remove, without Spark: passages asked of one bucket
    with the first half of the documents by another with the rest."""
    half = len(texts) // 2
    parts = [
        repeated_passages.Bucket(np.array(ids, np.int64), [repeated_passages.split(texts[i]) for i in ids])
        for ids in (range(half), range(half, len(texts)))
    ]
    starts, found = parts[0].windows(size)
    keys, low, _ = repeated_passages.least_by_key(found, parts[0].ids[parts[0].owner[starts]])
    asked = np.isin(keys, parts[1].windows(size)[1])
    rows = list(repeated_passages.asked_passages(parts[0], keys[asked], np.ones(asked.sum(), np.int64), size, low[asked]))
    for asker, doc, text in rows:
        assert asker == 1 and f" {text} " in f" {' '.join(texts[doc].split())} "
    sent = repeated_passages.Bucket(np.array([r[1] for r in rows], np.int64), [repeated_passages.split(r[2]) for r in rows])
    return parts[1], repeated_passages.removed_words(parts[1], sent, size)


def covered(texts, size):
    """Words of the later half inside a window of the first half."""
    half = len(texts) // 2
    first = {tuple(w[i : i + size]) for w in map(str.split, texts[:half]) for i in range(len(w) - size + 1)}
    out = []
    for w in map(str.split, texts[half:]):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in first:
                gone[i : i + size] = True
        out.append(gone)
    return out


def test_passages_of_first_documents_decide(monkeypatch):
    rng = random.Random(31)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) for _ in range(40)]
    truth = covered(texts, 6)
    _, masks = by_parts(texts, 6)
    assert sum(t.sum() for t in truth) > 100
    assert [m.tolist() for m in masks] == [t.tolist() for t in truth]
    # Hashes of three bits make nearly all windows candidates; no word goes that the text does not confirm.
    plain = repeated_passages.mix
    monkeypatch.setattr(repeated_passages, "mix", lambda x: plain(x) & np.uint64(7))
    _, masks = by_parts(texts, 6)
    assert all(not (m & ~t).any() for m, t in zip(masks, truth))
    other = ["x1 x2 x3 x4 x5 x6 x7 x8 x9", "y1 y2 y3 y4 y5 y6 y7 y8 y9"]
    monkeypatch.setattr(repeated_passages, "mix", lambda x: x & np.uint64(0))
    bucket, masks = by_parts(other, 6)
    assert len(np.unique(bucket.windows(6)[1])) == 1 and not masks[0].any()


def test_hot_passages_go_through_several_relays(spark, monkeypatch):
    monkeypatch.setattr(repeated_passages, "ASKERS", 4)
    rng = random.Random(32)
    shared = " ".join(rng.choice("abcdefgh") for _ in range(30))
    texts = [f"{' '.join(rng.choice('ijklmnop') for _ in range(20))} {shared} tail{i} of it" for i in range(60)]
    got = repeated_passages.repeated_passages(docs(spark, texts), size=6, anchor=3, bucket_chars=300).orderBy("doc_id").collect()
    assert [(r.n_words, r.kept) for r in got] == removed(texts, 6)
    assert sum(r.n_removed >= 30 for r in got) == 59


# 4


def test_vector_links(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    vectors = np.concatenate([base, base[:30] + 0.1 * rng.standard_normal((30, 16)), base[:5], base[:1] * 2])
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] + [0.0] * 14, [1.0, 0.0]]
    rows = [(i, v.tolist() if i >= 0 else v) for i, v in enumerate(vectors)] + [(200 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, id long")
    got = {r.vec_id: r for r in projection_forest.vector_links(df, leaf=32, sample=50).collect()}
    unit = projection_forest.unit(vectors)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(vectors))
    for _ in range(10):
        label = np.array([min([label[i], *label[linked[i]]]) for i in range(len(label))])
    assert [got[i].n_links for i in range(len(vectors))] == linked.sum(1).tolist()
    assert [got[i].component_id for i in range(len(vectors))] == label.tolist()
    assert all(got[200 + i].n_links == 0 and got[200 + i].kept for i in range(len(odd)))
    assert projection_forest.vector_links(df.limit(0)).count() == 0


def test_vector_links_of_a_hot_cluster(spark):
    """Deep trees, and a third of the vectors in a cluster whose pairs are about at the threshold:
    every link counts at both of its ends, and none is lost."""
    rng = np.random.default_rng(9)
    n, d = 4000, 32
    vectors = rng.standard_normal((n, d))
    centre = rng.standard_normal(d) / np.sqrt(d)
    vectors[: n // 3] = centre + 0.2 * rng.standard_normal((n // 3, d)) / np.sqrt(d)
    unit = projection_forest.unit(vectors.astype(np.float32).astype(np.float64))
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert 50_000 < linked.sum() < n * n / 10
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.astype(np.float32).tolist())], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in projection_forest.vector_links(df, leaf=32).collect()}
    counts = np.array([got[i].n_links for i in range(n)])
    want = linked.sum(1)
    assert (counts <= want).all() and counts.sum() % 2 == 0
    assert (want.sum() - counts.sum()) <= max(4, 2e-5 * want.sum())
    label = np.arange(n)
    while True:
        lower = np.array([min(label[i], label[linked[i]].min(initial=n)) for i in range(n)])
        if (lower == label).all():
            break
        label = lower
    assert [got[i].component_id for i in range(n)] == label.tolist()


def test_equal_ids_and_null_ids_of_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (2, [1.0, 0.01]), (None, [1.0, 0.02]), (None, None)]
    got = projection_forest.vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = sorted(((r.vec_id is None, r.vec_id or 0, r.n_links) for r in got))
    assert found == sorted([(False, 1, 2), (False, 1, 0), (False, 2, 2), (False, 2, 2), (True, 0, 0), (True, 0, 0)])


# 5


def test_recurring_lines(spark):
    texts = [f"start {'abc'[i % 3]}\nVisited by user {i} today at noon\nown words {chr(97 + i)} stay" for i in range(6)]
    texts += ["copied\nas a whole\ndocument"] * 4 + EDGES
    got = line_templates.drop_recurring_lines(docs(spark, texts)).orderBy("doc_id").collect()
    assert got[0].text == texts[0] and got[0].n_dropped == 0
    assert all("Visited" not in r.text and "own words" in r.text for r in got[1:6])
    # Copies of whole documents are left to other operators; other texts are untouched.
    assert [r.text for r in got[6:]] == texts[6:]
    assert [r.n for r in got] == list(range(len(texts)))
    assert line_templates.drop_recurring_lines(docs(spark, texts).limit(0)).count() == 0
    assert line_templates.parse(["a b c d x", "a b c d y", "q r s t u"], 0.8) == ["a b c d <*>"] * 2 + ["q r s t u"]


def test_recurring_blocks(spark):
    footer = "\n".join(f"{w} line of the common footer" for w in ("first", "second", "third", "fourth", "fifth"))
    own = [" ".join(chr(97 + i) * 3 + w for w in ("one", "two", "three", "four")) for i in range(5)]
    copy = "one more text\nthat was copied\nas it is"
    texts = [f"{x}\n{footer}" for x in own] + [copy] * 4
    got = line_templates.drop_recurring_lines(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in got] == [texts[0], *own[1:], *[copy] * 4]
    assert [r.n_dropped for r in got] == [0, 5, 5, 5, 5, 0, 0, 0, 0]


def test_lines_against_plain_search(spark):
    """The default mode on whole documents, and lines close to the threshold."""
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(11)
    made = ["\n".join(
        " ".join(["to", "be", "or", *[rng.choice("abcd" if k % 3 else "ab") for k in range(rng.choice([1, 2, 7]))]]) + rng.choice(["", " 7"])
        for _ in range(4)) for _ in range(120)]
    made += ["", "x\n" * 3, made[0], made[0]]
    rows = real.unionByName(spark.createDataFrame(list(enumerate(made, 10_000)), "doc_id long, text string"))
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(rows).collect()}
    assert got == brute_lines(rows.collect())


def test_index_of_templates():
    """The index finds what a search through all templates finds, in time that grows with the lines."""
    import time

    rng = random.Random(2)
    for n in (3, 4, 5, 9, 16):
        lines = {" ".join(["<*>", "a", "b"][: min(3, n)] + [rng.choice(["<*>", "p", "q", "r"]) for _ in range(n - 3)]) for _ in range(300)}
        order = sorted(lines)
        assert dict(zip(order, line_templates.parse(order, 0.8))) == plain_templates(lines)
    taken = []
    for size in (10_000, 40_000):
        lines = ["<*> <*> <*> " + " ".join(f"w{rng.random()}".replace("0", "o") for _ in range(8)) for _ in range(size)]
        start = time.process_time()
        assert len(set(line_templates.parse(lines, 0.8))) == size
        taken.append(time.process_time() - start)
    assert taken[1] < 8 * taken[0]


# 6


def test_warc(spark, tmp_path):
    html = ["x" * 200, "é" * 100, "x" * 200, "short", "short", None, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9, LONG, ""]
    rows = [(i, f"http://h/{i}\r\nX: 1" if i else None, h, 1) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, revisit int")
    warc.write_warc(pages, f"{tmp_path}/w", file_bytes=5000)
    read = warc.read_warc(spark, f"{tmp_path}/w")
    got = {r.page_id: r for r in warc.archive_index(read).collect()}
    assert [got[i].payload_bytes for i in range(9)] == [len((h or "").encode()) for h in html]
    assert [i for i in got if got[i].record_type == "revisit"] == [2] and got[2].refers_to == 0
    assert read.where("page_id = 2").first().content_bytes == 0
    warc.write_warc(pages.limit(0), f"{tmp_path}/e")
    assert warc.read_warc(spark, f"{tmp_path}/e").count() == 0


# 7


def test_toxicity(spark):
    rng = random.Random(1)
    clean = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    insults = ["moron", "stupid", "pathetic"]

    def text(bad):
        words = [rng.choice(clean) for _ in range(40)]
        for i in rng.sample(range(40), 4 if bad else 0):
            words[i] = rng.choice(insults)
        return " ".join(words[:20]) + ". " + " ".join(words[20:])

    labels = [i % 4 == 0 for i in range(400)]
    texts = [text(y) for y in labels]
    model = toxicity.fit(texts[:300], labels[:300], 40)
    scorer = toxicity.Scorer(model)
    scores = scorer.score(texts[300:])
    assert ((scores >= 0.7) == labels[300:]).mean() > 0.95
    # Inserted, dropped and spaced characters still look like the insult.
    tokens = ["mor-on", "stuupid", "pathetc", *clean[:200]]
    values = model.token_scores(tokens)
    assert values[:3].min() > np.quantile(values[3:], 0.98)
    assert toxicity.tokens_of("you m o r o n !") == ["you", "moron"]
    # The fold is the Nyström machine itself.
    marks = ["moron", "stupid", "pathetic"]
    alpha = np.array([0.3, -0.2, 0.5])
    assert np.allclose(
        toxicity.fold(marks, alpha, 0.1).token_scores(tokens[:20]), toxicity.kernel_rows(tokens[:20], marks) @ alpha + 0.1
    )
    frame = toxicity.score_toxicity(docs(spark, EDGES + ["moron stupid"]), model).collect()
    assert len(frame) == len(EDGES) + 1 and all(0 <= r.score <= 1 for r in frame)
    empty = toxicity.train_toxicity(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(docs(spark, ["x"]), empty).first().predicted == 0


# 8


def test_near_duplicates(spark):
    rng = random.Random(2)
    base = [[rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(60)] for _ in range(12)]
    texts = []
    for w in base:
        for edits in (0, 1, 2, 3, 5):
            v = list(w)
            for i in rng.sample(range(60), edits):
                v[i] = "zz"
            texts.append(" ".join(v))
    texts += [texts[0].upper(), texts[3], "one two", "ONE  two"] + EDGES
    sets = [fast_similarity.shingle_set(fast_similarity.word_hashes(t)) for t in texts]
    n = len(texts)
    label = list(range(n))
    for _ in range(6):
        for i in range(n):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    label[i] = label[j] = min(label[i], label[j])
    got = fast_similarity.near_duplicates(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_shingles for r in got] == [len(s) for s in sets]
    assert [r.component_id for r in got] == label
    assert [r.kept for r in got] == [i == c for i, c in enumerate(label)]
    assert fast_similarity.near_duplicates(docs(spark, texts).limit(0)).count() == 0


def test_sketch_agrees_with_jaccard():
    rng = np.random.default_rng(1)
    for size in (1, 4, 40, 400):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: max(1, size * 3 // 4)], rng.integers(0, 2**63, size // 4).astype(np.uint64)]))
        x, y = fast_similarity.sketch(a, 512), fast_similarity.sketch(b, 512)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert (x != np.iinfo(np.uint64).max).all() and abs((x == y).mean() - true) < 0.12


def test_blocks_of_a_hot_group(spark):
    texts = [" ".join(f"w{j}" for j in range(50) if j != i) for i in range(40)]
    rows = docs(spark, texts).select(F.col("doc_id").alias("id"), "text")
    groups = rows.select("id", F.lit(0).cast("long").alias("grp"), F.lit(45).alias("n_shingles"))
    edges = fast_similarity.verified_edges(groups, rows, block_bytes=2000)
    whole = fast_similarity.verified_edges(groups, rows)
    assert {r.component for r in connected_components(edges).collect()} == {
        r.component for r in connected_components(whole).collect()
    }


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5), (None, 3), (101, 100)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# 9


def test_licenses(spark):
    rows = [
        (1, "/a/LICENSE", "Released under the MIT License."),
        (2, "/a/b/code.py", "some code"),
        (3, "/a/b/c/x.py", "text\nLicensed under the Apache License, Version 2.0.\nmore of the text"),
        (4, "/z/y.py", "nothing"),
        (5, None, None),
        (6, "/a/b/c/", ""),
        (2, "/a/b/code.py", "some code"),
    ]
    files = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, path string, text string, key string")
    got = {(r.doc_id): r for r in license_scan.scan_licenses(files).collect()}
    assert (got[1].license, got[1].origin) == ("MIT", "file")
    assert (got[2].license, got[2].origin, got[2].source_dir) == ("MIT", "inherited", "/a")
    assert (got[3].license, got[3].origin) == ("Apache-2.0", "header")
    assert got[4].license is None and got[5].license is None
    assert license_scan.scan_licenses(files).count() == len(rows)
    assert license_scan.scan_licenses(files.limit(0)).count() == 0


def test_licenses_whole_wrapped_and_inner(spark):
    texts = license_scan.TEXTS
    filler = " ".join(f"word{i}" for i in range(300))
    gpl = """\
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
x = 1
""" + filler
    mit = (texts / "MIT.txt").read_text()
    rows = [
        (1, "/m/LICENSE", "MIT License\n\nCopyright (c) 2020 X\n\n" + mit, "MIT", "file"),
        (2, "/m/src/x.py", "code", "MIT", "inherited"),
        (3, "/g/COPYING", (texts / "GPL-3.0.txt").read_text(), "GPL-3.0", "file"),
        (4, "/h/a.py", gpl, "GPL-3.0", "header"),
        (5, "/h/b.py", gpl.replace("version 3", "version 2"), "GPL-2.0", "header"),
        (6, "/h/c.js", "// Released under the MIT License. See LICENSE for details.\n" + filler, "MIT", "header"),
        (7, "/h/d.js", "Copyright (c) 2020 X. Released under the MIT License.\n" + filler, "MIT", "header"),
        (8, "/h/e.js", filler + " Licensed under the MIT license. " + filler, "MIT", "header"),
        (9, "/h/f.js", filler + "\n/* Licensed under the Apache\n * License, Version 2.0 */\n" + filler, "Apache-2.0", "header"),
        (10, "/h/g.c", f"/*\n * {filler}\n" + "".join(f" * {x}\n" for x in mit.splitlines()) + filler, "MIT", "header"),
        (11, "/b/LICENSE", "Copyright X.\nAll rights reserved.\n" + (texts / "BSD-3-Clause.txt").read_text(), "BSD-3-Clause", "file"),
        (12, "/h/h.c", filler, None, None),
    ]
    files = spark.createDataFrame([r[:3] for r in rows], "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin) for r in license_scan.scan_licenses(files).collect()}
    assert got == {r[0]: r[3:] for r in rows}


# 10


def test_contamination_shuffled_and_spans(spark):
    item = "the quick brown fox jumps over the lazy dog near the old mill"
    items = spark.createDataFrame([(7, item), (8, "Two words"), (9, None), (9, "")], "item_id long, text string")
    texts = [f"Start. {item.upper()} end", "nothing here", "two, WORDS two", *EDGES]
    df = docs(spark, texts).unionByName(docs(spark, texts[:1]))
    one = contamination.contamination(df, items).orderBy("doc_id").collect()
    two = contamination.contamination(df, items, broadcast_parts=0).orderBy("doc_id").collect()
    assert one == two and len(one) == len(texts) + 1
    assert one[0].items == ["7"] and len(one[0].hit_words) == 13 and one[0] == one[1]
    assert one[3].hit_words == [1, 2] and one[3].items == ["8"]
    kept = contamination.decontaminate(df, items).orderBy("doc_id").collect()
    assert [r.doc_id for r in kept] == [1, *range(3, len(texts))]
    spans = contamination.decontaminate(df, items, remove="spans").orderBy("doc_id").collect()
    assert spans[0].text == "Start end" and spans[3].text == " two"
    assert contamination.contamination(df, items.limit(0)).where("size(hit_words) > 0").count() == 0
    assert contamination.contamination(df.limit(0), items).count() == 0


# Pipeline


def plain_templates(lines):
    """Template of every line of a leaf, by a search through all templates: lists of tokens."""
    templates, of = [], {}
    for line in sorted(lines):
        tokens = line.split(" ")
        best = None
        for number, known in enumerate(templates):
            fixed = sum(k == t and k != "<*>" for k, t in zip(known, tokens))
            agree = fixed + known.count("<*>")
            if fixed and agree >= 0.8 * len(tokens) and (best is None or (agree, fixed) > best[:2]):
                best = (agree, fixed, number)
        if best is None:
            templates.append(tokens)
            of[line] = len(templates) - 1
        else:
            of[line] = best[2]
            templates[best[2]] = [k if k == t else "<*>" for k, t in zip(templates[best[2]], tokens)]
    # Templates that have become equal are one.
    return {line: " ".join(templates[number]) for line, number in of.items()}


def brute_lines(docs_):
    """Rows (doc_id, text) by the rules of the template tree, in plain Python."""
    split = [[re.findall(r"\S+", re.sub(r"\S*[0-9]\S*", "<*>", x)) for x in (r.text or "").split("\n")] for r in docs_]
    leaves = {}
    for r, lines in zip(docs_, split):
        for i, t in enumerate(lines):
            if t:
                around = (tuple(lines[i - 1]) if i else 0, tuple(lines[i + 1]) if i + 1 < len(lines) else 1)
                leaves.setdefault((len(t), tuple(t[:3])), []).append((r.doc_id, " ".join(t), around, r.text))
    gone = set()
    for seen in leaves.values():
        # Leaves that cannot hold a recurring template are not parsed.
        if len({x[0] for x in seen}) < 2 or max(len({x[k] for x in seen}) for k in (2, 3)) < 3:
            continue
        template = plain_templates({x[1] for x in seen})
        for name in set(template.values()):
            mine = [x for x in seen if template[x[1]] == name]
            owners = {x[0] for x in mine}
            if len(owners) >= 3 and max(len({x[k] for x in mine}) for k in (2, 3)) >= 3:
                gone.update((d, line) for d, line, _, _ in mine if d != min(owners))
    out = {}
    for r, lines in zip(docs_, split):
        kept = [x for x, t in zip((r.text or "").split("\n"), lines) if (r.doc_id, " ".join(t)) not in gone]
        out[r.doc_id] = None if r.text is None else "\n".join(kept)
    return out


def brute_groups(docs_):
    """Smallest linked id of every document, all pairs by sets of word tuples."""
    sets = {}
    for r in docs_:
        words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        n = min(5, len(words))
        sets[r.doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    label = {d: d for d in sets}
    pairs = []
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= 75 * (len(x) + len(y) - common):
                    pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_pipeline_stages(spark):
    """Each stage against a brute-force version on what the one before kept."""
    spoilt = spark.read.parquet(f"{SMALL}/documents.parquet")
    # Columns that clash with names a stage uses.
    for name in ("__doc", "kept", "score", "predicted", "n_dropped", "key", "id", "grp"):
        spoilt = spoilt.withColumn(name, F.lit("x"))
    now = spoilt
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = now.select("doc_id", "text", "n_chars").collect()
        texts = {r.doc_id: r.text for r in before}
        now = staged(stage(spark, now, SMALL), name)
        assert set(now.columns) == set(corpus_pipeline.COLUMNS), name
        after = {r.doc_id: r.text for r in now.collect()}
        if name == "toxicity":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            scorer = toxicity.Scorer(toxicity.train_toxicity(spoilt, labels))
            scores = scorer.score([t or "" for t in texts.values()])
            assert after == {d: t for (d, t), s in zip(texts.items(), scores) if s < toxicity.THRESHOLD}
        elif name == "line_dedup":
            assert after == brute_lines(before)
        elif name == "minhash_near_dedup":
            label = brute_groups(before)
            assert after == {d: t for d, t in texts.items() if label[d] == d}
        else:
            benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()

            def words(t):
                return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

            items = [words(r.text) for r in benchmark]
            windows = {tuple(w[i : i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
            sizes = {len(w) for w in windows}
            clean = {
                d: t for d, t in texts.items()
                if not any(tuple(words(t)[i : i + n]) in windows for n in sizes for i in range(len(words(t)) - n + 1))
            }
            assert after == clean
        assert 0 < len(after) <= len(before)
    codec = sentencepiece_codec.PieceCodec(MODEL).library
    texts = {r.doc_id: r.text or "" for r in now.collect()}
    for r in corpus_pipeline.STAGES[-1][1](spark, now, SMALL).collect():
        ids = codec.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(codec.decode(ids).encode()).hexdigest()


def test_pipeline_leaves_only_what_its_result_reads(spark):
    root = Path(scratch_root(spark))
    before = set(root.iterdir())
    result = corpus_pipeline.run(spark, SMALL)
    left = [x.name for x in set(root.iterdir()) - before if re.search(r"-[0-9a-f]{32}$", x.name)]
    assert len(left) == 1 and left[0].startswith("stage-benchmark_decontamination-")
    assert result.count() > 0
