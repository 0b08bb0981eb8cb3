"""Each operator against a brute-force version on small tables with awkward rows, and on the driver's smallest tables."""

import itertools
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import components, decontaminate, language_id, lm_scoring, packing, quality, queries, simhash, substring_dedup, token_counts, topk_search, url_filter
from tidemark.llm.word_pieces import Encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, rid long, bucket string"


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}{rng.choice('abcdefgh')}" for _ in range(n))


def awkward(spark):
    """Nulls in any column, empty, blank, very long and repeated texts, repeated rows, clashing column names."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    texts = ["", None, " \n\t ", "a", "İ ΣΑΣ 日本 語 \x85 é", "<|endoftext|> x <|startoftext|>", "1234 !!! 56", long, long + " more", prose(rng, 120), "word " * 300]
    rows = [(i, t, ("en", "de", None)[i % 3], None, None, 0.5, "f", 7, "b") for i, t in enumerate(texts)]
    rows += [(50 + i, prose(rng, rng.randint(1, 150)), "en", "s", 1, None, None, None, None) for i in range(60)]
    rows += [rows[3], rows[9], (None, "text without id", "en", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_shapes_on_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "w1a w2b"), (2, None), (None, "a b c"), (3, "")], "item_id long, text string")
    runs = {
        "op1": lambda d: language_id.language_id(d),
        "op4": lambda d: token_counts.token_counts(d),
        "op5": lambda d: quality.quality_classifier(d, labels),
        "op7": lambda d: simhash.simhash_dedup(d),
        "op8": lambda d: lm_scoring.lm_scoring(d),
        "op9": lambda d: decontaminate.contamination(d, bench),
    }
    docs = awkward(spark)
    n = docs.count()
    for name, run in runs.items():
        assert run(docs).count() == n, name
        assert run(empty(spark)).count() == 0, name
    assert packing.packing(empty(spark)).count() == 0
    assert substring_dedup.passages(empty(spark)).count() == 0
    assert substring_dedup.remove_passages(docs).columns == docs.columns
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert simhash.keep_first(docs).columns == docs.columns
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns
    assert quality.quality_classifier(docs, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5


def test_language_id_held_out_accuracy_and_undetermined(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    odd = {r["doc_id"]: r for r in language_id.language_id(awkward(spark)).where("doc_id < 10").collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2, 6)] == ["und"] * 4 and odd[0]["score"] == 0.0


def test_ppm_code_lengths_against_a_dictionary_version():
    texts = {"x": ["abracadabra", "banana"], "y": ["zzyzx"]}
    langs, order = ["x", "y"], 2
    rows, seen = Counter(), [defaultdict(Counter), defaultdict(Counter)]
    for i, lang in enumerate(langs):
        for t in texts[lang]:
            data = language_id.prepared(t, order)
            for p in range(order, len(data)):
                rows[i, int.from_bytes(data[p - order : p + 1], "big")] += 1
                for k in range(order + 1):
                    seen[i][data[p - k : p]][data[p]] += 1
    model = language_id.Frozen(langs, order, [(i, g, n) for (i, g), n in rows.items()])

    def bits(i, context, byte):
        own = seen[i].get(context)
        rest = (lambda: bits(i, context[1:], byte)) if context else (lambda: 8.0)
        if not own:
            return rest()
        n, d = sum(own.values()), len(own)
        return -math.log2(own[byte] / (n + d)) if own[byte] else -math.log2(d / (n + d)) + rest()

    data = language_id.prepared("abanzq ra", order)
    got = model.costs(np.frombuffer(data, np.uint8))
    want = [[bits(i, data[p - order : p], data[p]) for i in range(2)] for p in range(order, len(data))]
    assert np.allclose(got, want, atol=1e-4)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 0.4]) for i in range(700)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]  # many equal vectors
    rows += [(2000, None), (2020, [1.0, None] + [0.0] * 6), (2040, [float("nan")] * 8), (2060, [float("inf")] + [0.0] * 7), (2080, []), (2100, [0.5, -0.5]), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    clean = {i: np.floor(np.array(v, np.float32).astype(float) * 64).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    padded = {i: np.pad(v, (0, 8 - len(v))) for i, v in clean.items()}
    want = set()
    for q in (i for i in padded if i % 20 == 0):
        best = sorted((-int(padded[q] @ v), i) for i, v in padded.items() if i != q)[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for block in (16_384, 16):  # small blocks: hot rings are dealt into many
        got = {tuple(r) for r in topk_search.topk_search(table, block=block).collect()}
        assert got == want
    assert topk_search.topk_search(table.limit(0)).count() == 0
    few = {tuple(r) for r in topk_search.topk_search(table.where("vec_id in (0, 1, 20)")).collect()}
    assert len(few) == 4


def test_topk_queries_of_a_block_pass_by_in_batches():
    rng = np.random.default_rng(8)
    vecs, asks = rng.integers(-60, 60, (300, 8)), rng.integers(-60, 60, (20_000, 8))
    cells = [(0, i, v) for i, v in enumerate(vecs)] + [(1, 1000 + i, v) for i, v in enumerate(asks)]
    read = []

    def batches():
        for at in range(0, len(cells), 200):
            part = cells[at : at + 200]
            read.append(at)
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([3] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part]), pa.array([encoded(x[2]) for x in part]), pa.nulls(n, pa.int64())],
                ["cell", "part", "kind", "id", "v", "bound"],
            )

    encoded = lambda v: np.asarray(v, "<i4").tobytes()
    got, seen = defaultdict(list), 0
    for out in topk_search.scored(batches(), 8, 5):
        seen += 1
        assert len(read) == seen + 1 and out.num_rows <= 200 * 5  # the first batch holds vectors only
        for q, v, s in zip(*(c.to_pylist() for c in out.columns)):
            got[q].append((-s, v))
    assert len(got) == len(asks)
    for q in range(0, len(asks), 997):
        assert sorted(got[1000 + q]) == sorted((-int(s), i) for i, s in enumerate(vecs @ asks[q]))[:5]


def test_url_rules_and_reputation(spark):
    urls = ["http://a.example.com/en/x", "https://WWW.Example.COM/en/", "http://example.com", "ftp://shop.net/es/1?x", "http://shop.net/de/", "no scheme", None, "http://x.net#/es/", "http://notexample.com/en/", "http://u@h.co.uk:80/p", "http://1.2.3.4/"]
    pages = spark.createDataFrame([(i, u, "<p>", "v") for i, u in enumerate(urls)] + [(100 + i, f"http://bad.net/es/{i}", "", "") for i in range(300)] + [(500, "http://bad.net/de/1", "", ""), (None, None, None, None)], "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages).collect()}
    assert (got[0]["rule"], got[0]["verdict"]) == ("example.com/en/", "block")
    assert (got[1]["host"], got[1]["rule"], got[1]["verdict"]) == ("www.example.com", "www.example.com/en/", "allow")
    assert (got[2]["path"], got[2]["rule"]) == ("", None)
    assert (got[3]["rule"], got[3]["path"]) == ("net/es/", "/es/1") and got[4]["rule"] is None
    assert (got[5]["host"], got[5]["path"], got[6]["host"], got[7]["path"]) == ("", "", "", "")
    assert got[8]["rule"] == "com/" and got[500]["rule"] is None and got[500]["verdict"] == "block"
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_token_counts_equal_the_library(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = awkward(spark).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id") + 1000, *[c for c in awkward(spark).columns[1:] if c in ("text",)]).withColumnRenamed("(doc_id + 1000)", "doc_id"), allowMissingColumns=True)
    texts = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.select("doc_id", "text").collect())
    for head in (token_counts.HEAD_SIZE, 50, 0):  # all broadcast, mostly joined, all joined
        got = token_counts.token_counts(docs, head_size=head).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == texts
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def test_word_ids_equal_the_library():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = ["", " ", "I'll we've'S 's''t", "<|endoftext|>x <|startoftext|>", "é\x1cb \x85c\xa0d İX ΣΑΣ", "x" * 500, "日本 語", "a\tb\r\nc\x0bd\x00e", "ﬁ é"]
    texts += ["".join(rng.choice("ab'stre1!é \n\t&|<") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(32, 126)])) for _ in range(30)) for _ in range(1500)]
    assert encoder(texts) == encoder.by_library(texts)


def test_quality_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_classifier(docs, labels).join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_crf_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    features = [rng.random((n, quality.N_ALL)) for n in (1, 4, 3)]
    weights, moves = rng.normal(size=quality.N_ALL) * 0.3, rng.normal(size=(2, 2))
    chains = quality.Chains(features)
    good, _, _ = chains.marginals(weights, moves)
    flat = np.empty_like(good)
    flat[chains.rows] = good
    at = 0
    for i in chains.order:
        s, n = features[i] @ weights, len(features[i])
        weight = {y: math.exp(sum(v * w for v, w in zip(y, s)) + sum(moves[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=n)}
        want = [sum(w for y, w in weight.items() if y[t]) / sum(weight.values()) for t in range(n)]
        assert np.allclose(flat[at : at + n], want)
        at += n


def test_passages_cover_what_repeats_and_leave_the_rest(spark):
    rng = random.Random(11)
    unique = lambda n: " ".join(f"u{rng.randrange(10**9)}" for _ in range(n))
    shared = unique(70).split()
    fuzzy = list(shared)
    for i in (20, 40, 55):
        fuzzy[i] = "changed"
    rows = [(1, unique(40) + " " + " ".join(shared) + " " + unique(30))]
    rows += [(10 + i, unique(20) + " " + " ".join(shared) + "\n" + unique(25)) for i in range(40)]
    rows += [(100, unique(15) + " " + " ".join(fuzzy) + " " + unique(15)), (200, unique(400)), (201, " ".join(shared[:40]) + " " + unique(100)), (300, " ".join(shared))]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long").repartition(6)
    found = defaultdict(list)
    for r in substring_dedup.passages(docs).collect():
        found[r["doc_id"]].append((r["start"], r["end"]))
        assert r["source_doc_id"] < r["doc_id"] and r["identity"] >= 0.8
    assert all(found[10 + i] == [(20, 90)] for i in range(40)) and found[100] == [(15, 85)] and found[300] == [(0, 70)]
    assert not {1, 200, 201} & found.keys()
    left = {r["doc_id"]: r for r in substring_dedup.remove_passages(docs).collect()}
    assert 300 not in left and left[200]["text"] == dict(rows)[200] and len(left) == len(rows) - 1
    assert left[10]["text"].split() == [w for w in rows[1][1].split() if w not in shared] and left[10]["n_chars"] == len(left[10]["text"])


def test_passages_with_seeds_from_elsewhere_and_runs_of_one_word(spark):
    rng = random.Random(12)
    unique = lambda n: " ".join(f"u{rng.randrange(10**9)}" for _ in range(n))
    shared = unique(60)
    head = " ".join(shared.split()[:25])
    rows = [(1, head + " " + unique(40)), (2, unique(30) + " " + shared + " " + unique(9)), (3, unique(12) + " " + shared + " " + unique(30))]
    rows += [(4, "spam " * 120), (5, "spam " * 120), (5, "spam " * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["start"], r["end"]) for r in substring_dedup.passages(docs).collect()}
    assert {(3, 12, 72), (5, 0, 120)} <= found and {d for d, _, _ in found} == {3, 5}


def test_exact_passages_whose_seeds_all_lead_elsewhere(spark):
    rng = random.Random(15)
    unique = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    shared = unique(60)
    rows = [(i, unique(20) + shared[a : a + 25] + unique(20)) for i, a in enumerate((0, 20, 40))]
    rows += [(10, unique(30) + shared + unique(9)), (11, unique(12) + shared + unique(30)), (12, unique(5) + shared[2:58] + unique(7)), (13, unique(5) + shared[:48])]
    small = [f"s{i}" for i in range(4)]
    rows += [(20 + i, [rng.choice(small) for _ in range(300)]) for i in range(12)] + [(40, rows[-1][1])]
    rows += [(50 + i, unique(10) + rng.choice(rows)[1][5:70] + unique(10)) for i in range(40)]
    for n in (1, 5):
        covered = defaultdict(set)
        for r in substring_dedup.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(n)).collect():
            covered[r["doc_id"]] |= set(range(r["start"], r["end"]))
        assert {12 + k for k in range(60)} == covered[11] and covered[12] == set(range(5, 61)) and not covered[10] | covered[13]
        first = {}
        for i, w in sorted(rows):
            for k in range(len(w) - 49):
                if first.setdefault(tuple(w[k : k + 50]), i) < i:
                    assert set(range(k, k + 50)) <= covered[i]


def test_links_reach_every_earlier_document_of_a_seed():
    h, doc, pos = np.array([7, 7, 7, 7, 9], np.uint64), np.array([3, 1, 2, 3, 5]), np.array([4, 0, 6, 8, 1])
    on, crowd, found = substring_dedup.linked(h, doc, pos, 8)
    assert {x[:2] for x in zip(*found)} == {(2, 1), (3, 1), (3, 2)} and len(on) == 5 and not crowd.any()
    on, crowd, found = substring_dedup.linked(h, doc, pos, 2)
    assert {x[:2] for x in zip(*found)} == {(2, 1), (3, 1)} and sorted(doc[on]) == [1, 5] and crowd.tolist() == [True, False]
    on, _, found = substring_dedup.linked(h, doc, pos, 8, every=False)
    assert len(on) == 5 and not len(found[0])


def scattered(later):
    """Documents 10 and 11 share a fuzzy passage of 60 words; each of its equal runs is in an earlier document too."""
    rng = random.Random(16)
    unique = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    shared = unique(60)
    rows = [(i, unique(20) + shared[15 * i : 15 * i + 15] + unique(20)) for i in range(4)]
    rows.append((10, unique(12) + shared + unique(9)))
    rows.append((11, unique(8) + ["altered" if i % 15 == 0 and i else w for i, w in enumerate(shared)] + unique(7)))
    rows += [(20 + i, unique(5) + shared[1:15] + unique(5)) for i in range(later)]
    return [(i, " ".join(w)) for i, w in rows]


def test_fuzzy_passages_whose_seeds_lead_elsewhere(spark):
    for n in (1, 4):
        found = substring_dedup.passages(spark.createDataFrame(scattered(9), "doc_id long, text string").repartition(n)).collect()
        assert [tuple(r[:6]) for r in found] == [(11, 8, 68, 10, 12, 72)] and abs(found[0]["identity"] - 57 / 60) < 1e-9


def test_fuzzy_passages_whose_seeds_lead_elsewhere_are_removed(spark):
    rows = scattered(3)
    left = dict(substring_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    words = rows[5][1].split()
    assert left[11].split() == words[:8] + words[68:] and all(left[i] == t for i, t in rows if i != 11)


def crowds():
    """Documents 1000 to 1002 share a fuzzy passage of 60 words; each equal run of it is in 50 earlier documents, others each time."""
    rng = random.Random(18)
    unique = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    shared = unique(60)
    rows = [(50 * part + i, unique(20) + shared[15 * part : 15 * part + 15] + unique(20)) for part in range(4) for i in range(50)]
    rows.append((1000, unique(12) + shared + unique(9)))
    rows.append((1001, unique(8) + ["altered" if i % 15 == 0 and i else w for i, w in enumerate(shared)] + unique(7)))
    rows.append((1002, unique(8) + [w for i, w in enumerate(shared) if i not in (14, 30)] + unique(7)))
    return [(i, " ".join(w)) for i, w in rows]


def test_fuzzy_passages_whose_seeds_are_all_crowds(spark):
    for n in (1, 5):
        found = substring_dedup.passages(spark.createDataFrame(crowds(), "doc_id long, text string").repartition(n)).collect()
        assert sorted(tuple(r[:6]) for r in found) == [(1001, 8, 68, 1000, 12, 72), (1002, 8, 66, 1000, 12, 72)]
        assert sorted(round(r["identity"], 6) for r in found) == [0.95, round(58 / 60, 6)]


def test_fuzzy_passages_whose_seeds_are_all_crowds_are_removed(spark):
    rows = crowds()
    left = dict(substring_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    for i, (start, end) in ((1001, (8, 68)), (1002, (8, 66))):
        words = dict(rows)[i].split()
        assert left[i].split() == words[:start] + words[end:]
    assert all(left[i] == t for i, t in rows if i < 1001)


def test_crowds_cover_what_meeting_all_documents_covers(spark):
    rng = random.Random(19)
    unique = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    pool = [unique(rng.randint(5, 18)) for _ in range(14)]
    rows = []
    for i in range(120):
        words = unique(rng.randint(0, 6))
        for _ in range(rng.randint(2, 7)):
            words += rng.choice(pool) + unique(rng.choice((0, 1, 1, 3, 9)))
        if i > 20 and rng.random() < 0.4:
            old = rng.choice(rows)[1].split()
            words += [f"c{rng.randrange(10**9)}" if rng.random() < 0.05 else w for w in old[: rng.randint(50, 90)] if rng.random() > 0.02]
        rows.append((i, " ".join(words)))
    covered = []
    for most in (10**6, 2):
        covered.append(defaultdict(set))
        for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), most=most).collect():
            assert r["source_doc_id"] < r["doc_id"] and r["identity"] >= 0.8
            covered[-1][r["doc_id"]] |= set(range(r["start"], r["end"]))
    assert len(covered[0]) > 10 and all(words <= covered[1][i] for i, words in covered[0].items())


def test_crowds_in_rounds_give_the_same_passages(spark, monkeypatch):
    """Keys and words of the pairs travel a few at a time; sources are still met in order, each word covered once."""
    rows, rng = crowds(), random.Random(20)
    for i in range(1003, 1012):
        words = rows[200 + i % 3][1].split()
        rows.append((i, " ".join(w if rng.random() > 0.03 else f"c{rng.randrange(10**9)}" for w in words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    want = sorted(map(tuple, substring_dedup.passages(docs).collect()))
    sent, real = [], substring_dedup.cut
    monkeypatch.setattr(substring_dedup, "cut", lambda df, free=False: (real(df, free), sent.append(df.columns))[0])
    monkeypatch.setattr(substring_dedup, "KEYS_ROUND", (0.5, 1))
    monkeypatch.setattr(substring_dedup, "WORDS_ROUND", (0.4, 1))
    assert sorted(map(tuple, substring_dedup.passages(docs).collect())) == want and len(want) >= 8
    assert sent.count(substring_dedup.COLUMNS) > 3 and sent.count(["bucket", "a", *substring_dedup.NAMES]) > 2


def some_words(rng, n, kinds):
    return np.array([rng.randrange(kinds) for _ in range(n)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def test_keys_of_all_parts_are_the_keys():
    rng = random.Random(22)
    sizes = np.array([80, 4, 61, 200])
    words = some_words(rng, 345, 6)
    crowd, shared = (np.array([rng.random() < x for _ in range(345)]) for x in (0.2, 0.5))
    rows = lambda part: set(map(tuple, np.stack([x.astype(np.uint64) for x in substring_dedup.neighbours(words, sizes, crowd, shared, part)], 1).tolist()))
    parts, whole = [rows((i, 3)) for i in range(3)], rows((0, 1))
    assert sum(map(len, parts)) == len(whole) and set().union(*parts) == whole and all(parts)
    h = lambda i: tuple(words[i : i + 5].tolist())
    starts, want = np.cumsum(sizes) - sizes, set()
    for text, (low, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        for i in range(low, low + n - 4):
            for step in (1, *range(5, 36)):
                j = i + step
                if j <= low + n - 5 and (crowd[i] or shared[i]) and (crowd[j] or shared[j]) and (crowd[i] != crowd[j] if step == 1 else crowd[i] or crowd[j]):
                    want.add((text, step == 1, h(i), h(j), *((words[i + 5] % 2**32, words[j - 1] % 2**32) if step > 1 else (0, 0))))
    assert len(whole) == len(want)
    raw = sum(substring_dedup.number_of_keys(crowd[low : low + n], shared[low : low + n]) for low, n in zip(starts, sizes))
    assert raw >= len([x for x in want if not x[1]])


def test_bound_of_a_pair_leaves_every_passage():
    rng = random.Random(23)
    found = left = 0
    for _ in range(400):
        one = some_words(rng, rng.randint(50, 140), 40)
        other = one[rng.randint(0, 40) :].copy()
        for i in range(len(other)):
            if rng.random() < 0.06:
                other[i] = rng.randrange(40)
        other = np.concatenate((some_words(rng, rng.randint(0, 30), 40), other[: rng.randint(20, 120)], some_words(rng, rng.randint(0, 30), 40)))
        one, other = substring_dedup.Stretch(one), substring_dedup.Stretch(other)
        passages = substring_dedup.compared(one, other, 50, 0.8)
        for x, y, *_ in passages:
            todo = np.zeros(len(one.words), bool)
            todo[rng.randrange(x, y)] = True
            assert substring_dedup.can_add(one, other, todo, 50, 0.8)
        found += len(passages)
        left += not substring_dedup.can_add(one, other, np.ones(len(one.words), bool), 50, 0.8)
    assert found > 50 and left > 20


def test_order_by_hash():
    rng = np.random.default_rng(24)
    for n, top in ((0, 5), (1, 5), (700, 9), (700, 2**40), (5000, 2**63)):
        h = rng.integers(0, top, n).astype(np.uint64)
        assert (substring_dedup.by_hash(h) == np.argsort(h, kind="stable")).all()


LEFT = """
import sys, time
from pathlib import Path
from tidemark.llm import substring_dedup
from tidemark.session import build_session
spark = build_session("local[2]", shuffle_partitions=3, extra={"spark.local.dir": sys.argv[1], "spark.checkpoint.dir": sys.argv[2]})
rows = [(i, " ".join(f"w{k}" for k in range(40 * i, 40 * i + 100))) for i in range(20)]
found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
for _ in range(100):
    left = list(Path(sys.argv[1]).rglob("shuffle_*.data"))
    if not left:
        break
    time.sleep(0.1)
print("left", len(left), "rows", found.count(), found.count(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false"))
"""


def test_passages_keep_no_shuffle_files_of_finished_steps(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    run = subprocess.run([sys.executable, "-c", LEFT, str(tmp_path / "local"), str(tmp_path / "scratch")], cwd=root, env={**os.environ, "PYTHONPATH": root, "SPARK_LOCAL_DIRS": str(tmp_path / "local")}, capture_output=True, text=True, timeout=300)
    assert run.stdout.split()[-6:] == ["left", "0", "rows", "19", "19", "false"], run.stdout + run.stderr


def test_cells_keep_numbers():
    rng = np.random.default_rng(3)
    for n, top in ((1, 5), (300, 2**16), (5000, 2**63 - 1)):
        bucket = rng.integers(0, 4, n)
        columns = [rng.integers(-top, top, n), rng.integers(0, 9, n), np.zeros(n, np.int64)]
        table = pa.Table.from_batches([substring_dedup.packed(0, bucket, *columns)])
        for i, b in enumerate(table.column("bucket").to_pylist()):
            got = substring_dedup.numbers(table.column("cell")[i].as_py(), 3).astype(np.int64)
            assert sorted(map(tuple, got.T)) == sorted(zip(*(c[bucket == b] for c in columns)))


def fuzzy_recall(spark, identity, pairs=60, words=120):
    """Share of the words of planted passages that are found, 1 - identity of the words altered."""
    rng = random.Random(int(identity * 100))
    rows = []
    for i in range(pairs):
        shared = [f"v{rng.randrange(10**9)}" for _ in range(words)]
        altered = set(rng.sample(range(words), round(words * (1 - identity))))
        edge = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
        rows.append((i, " ".join(edge(30) + shared + edge(30))))
        rows.append((1000 + i, " ".join(edge(20) + ["x" + w if k in altered else w for k, w in enumerate(shared)] + edge(20))))
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    covered = {(r["doc_id"], k) for r in found if r["source_doc_id"] == r["doc_id"] - 1000 for k in range(max(r["start"], 20), min(r["end"], 20 + words))}
    return len(covered) / (pairs * words)


def test_fuzzy_passages_are_found(spark):
    assert fuzzy_recall(spark, 0.9) > 0.9


def test_chains_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        rows = []
        for _ in range(rng.randint(1, 7)):
            a, b, n = rng.randint(0, 40), rng.randint(0, 40), rng.randint(3, 9)
            rows.append((a, a + n, b, b + n))
        rows = np.array(sorted(set(rows)))
        best = 0.0
        for k in range(1, len(rows) + 1):
            for pick in itertools.permutations(range(len(rows)), k):
                own = rows[list(pick)]
                steps = list(zip(own, own[1:]))
                if all(y[0] >= x[1] and y[2] >= x[3] and y[0] - x[1] <= 30 and y[2] - x[3] <= 30 for x, y in steps):
                    best = max(best, (own[:, 1] - own[:, 0]).sum() - 0.5 * sum(y[0] - x[1] + y[2] - x[3] for x, y in steps))
            if k == 4:
                break
        own = substring_dedup.chains(rows)[0]
        got = (own[:, 1] - own[:, 0]).sum() - 0.5 * sum(y[0] - x[1] + y[2] - x[3] for x, y in zip(own, own[1:]))
        assert len(own) > 4 or abs(got - best) < 1e-9


def test_chains_behind_a_long_anchor_that_is_too_far():
    far, at = (0, 500, 0, 500), 535
    near = [(at + 11 * i, at + 11 * i + 10, at + 11 * i, at + 11 * i + 10) for i in range(11)]
    got = [own.tolist() for own in substring_dedup.chains(np.array([far, *near]))]
    assert got == [[list(far)], [list(x) for x in near]]
    rng = random.Random(6)
    for _ in range(300):
        rows = [(0, 300, 0, 300)]
        for _ in range(rng.randint(2, 14)):
            a, b, n = rng.randint(300, 420), rng.randint(300, 420), rng.randint(3, 15)
            rows.append((a, a + n, b, b + n))
        rows = sorted(set(rows), key=lambda x: (x[0], x[2]))
        best = []  # of the chains that end with each anchor, tried against all before it
        for x in rows:
            ways = [v - 0.5 * (x[0] - y[1] + x[2] - y[3]) for y, v in zip(rows, best) if 0 <= x[0] - y[1] <= 30 and 0 <= x[2] - y[3] <= 30]
            best.append(x[1] - x[0] + max([0.0, *ways]))
        chains = substring_dedup.chains(np.array(rows))
        cost = [(own[:, 1] - own[:, 0]).sum() - 0.5 * sum(y[0] - x[1] + y[2] - x[3] for x, y in zip(own, own[1:])) for own in chains]
        assert abs(cost[0] - max(best)) < 1e-9 and sorted(map(tuple, np.concatenate(chains))) == sorted(rows)


def brute_components(fp, distance=2):
    ids = sorted(fp)
    values = np.array([fp[i] for i in ids], np.uint64)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= distance, 1))):
        x, y = find(ids[a]), find(ids[b])
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(awkward(spark).where("doc_id < 50").select(F.col("doc_id") + 100_000, "text").distinct())
    fp = {}
    for r in docs.collect():
        w = words_of(r["text"] or "")
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        fp[r[0]] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    got = {r["doc_id"]: r for r in simhash.simhash_dedup(docs.withColumnRenamed(docs.columns[0], "doc_id")).collect()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{v:016x}" for i, v in fp.items()}
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fp)


@pytest.mark.parametrize("parts", [2, 3, 4])
@pytest.mark.parametrize("crowd", [20_000, 5])
def test_pigeonhole_links_lose_nothing(spark, parts, crowd):
    rng = random.Random(parts)
    values = {rng.getrandbits(64) for _ in range(150)}
    for v in list(values)[:60]:  # clusters, near pairs at one to three bits, and values that share half their bits
        for _ in range(4):
            values.add(v ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 3))}))
    values |= {0xFFFFFFFF00000000 | rng.getrandbits(14) for _ in range(80)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.links(table, 2, parts, crowd)
    roots = {r["node"]: r["root"] for r in components.connected_components(found).collect()}
    groups = defaultdict(set)
    for v in signed:
        groups[roots.get(v, v)].add(v & (1 << 64) - 1)
    want = defaultdict(set)
    for v, root in brute_components({v: v for v in values}).items():
        want[root].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5)]
    roots = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {roots[i] for i in range(201)} == {0} and {roots[1000 + i] for i in range(301)} == {1000}


def test_language_model_counts_base_and_paths(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokens = {r["doc_id"]: words_of(r["text"] or "") + [b"\n"] for r in docs.select("doc_id", "text").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(itertools.chain.from_iterable(t for i, t in tokens.items() if not held[i]))
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in lm_scoring.lm_scoring(docs).collect()}
    for i, t in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert abs(r["base_score"] - sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) < 1e-6
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    joined = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scoring(docs, head_pairs=500).collect()}
    assert all(abs(joined[i] - r["score"]) < 1e-6 for i, r in got.items())


def test_language_model_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    words = np.sort(rng.integers(1, 2**63, 40).astype(np.uint64))
    ctx = np.concatenate([np.sort(rng.choice(6, 3, replace=False)) for _ in words]).astype(np.uint16)
    n = rng.geometric(0.2, len(ctx)).astype(np.uint32)
    ends = (np.arange(len(words)) * 3 + 3).astype(np.int32)
    customers, tables = (np.bincount(ctx, w, minlength=lm_scoring.CONTEXTS).astype(float) for w in (n, np.ones(len(n))))
    totals = lm_scoring.Totals(customers, tables, float(len(words)), len(words), (0.7, 0.6))
    t, up = lm_scoring.gibbs(words, ends, ctx, n, totals, 2, tuple(lm_scoring.log_stirling(d) for d in totals.d))
    assert (t >= 1).all() and (t <= n).all() and (up >= 1).all()
    seatings = [lm_scoring.Totals(customers, np.bincount(ctx, x, minlength=lm_scoring.CONTEXTS).astype(float), float(u.sum()), len(words), totals.d) for x, u in zip(t, up)]
    row = {"words": words.tobytes(), "ends": ends.tobytes(), "ctx": ctx.tobytes(), "count": n.tobytes(), "t": t.astype(np.uint32).tobytes(), "t_parent": up.astype(np.uint32).tobytes()}
    model = lm_scoring.Model([row], seatings, int(n.sum()))
    for context in range(8):  # contexts 6 and 7 were never seen
        rows = np.append(model.rows(words), -1)
        assert abs((10 ** model.scores(rows, np.full(len(rows), context))).sum() - 1) < 1e-5


def test_stirling_weights_against_seating_enumeration():
    d = 0.4
    weights = np.exp(lm_scoring.log_stirling(d))

    def seat(sizes, left):
        if not left:
            yield len(sizes), 1.0
            return
        for t, w in seat(sizes + [1], left - 1):
            yield t, w
        for i, s in enumerate(sizes):
            for t, w in seat(sizes[:i] + [s + 1] + sizes[i + 1 :], left - 1):
                yield t, w * (s - d)

    for c in range(1, 7):
        want = Counter()
        for t, w in seat([], c):
            want[t] += w
        assert np.allclose([weights[c, t] for t in range(1, c + 1)], [want[t] for t in range(1, c + 1)])


def test_language_model_table_counts_against_exact_weights():
    rng = np.random.default_rng(1)
    n, many = 4000, lm_scoring.STIRLING
    for d in (0.3, 0.6, 0.8, 0.95):
        log_s = lm_scoring.log_stirling(d)
        t = np.arange(1, many + 1)
        # What the rejection for many customers proposes is nowhere too rare.
        ratio = log_s[many, 1:] + lm_scoring.lgamma(t) + (t - 1) * np.log(d) + lm_scoring.lgamma(np.array([1 - d])) - lm_scoring.lgamma(np.array([many - d]))
        assert (ratio <= (t - 1) * 2 * max(0.0, ratio[1]) + 1e-9).all()
        assert np.allclose(lm_scoring.thinning(np.full(5, many), t[:5], d), np.exp(ratio[:5]))
        for c, a in ((7, 0.8), (300, 0.5), (300, 9.0), (300, 200.0)):
            weight = log_s[c, 1 : c + 1] + t[:c] * np.log(a)
            weight = np.exp(weight - weight.max())
            mean = (weight * t[:c]).sum() / weight.sum()
            sd = np.sqrt((weight * (t[:c] - mean) ** 2).sum() / weight.sum())
            draws = [lm_scoring.draw_tables(np.full(n, c), np.full(n, a), d, log_s, rng)] + ([lm_scoring.many(np.full(n, c), np.full(n, a), d, rng)] if c > 100 else [])
            for got in draws:
                assert abs(got.mean() - mean) < 5 * sd / n**0.5 + 1e-9


def test_language_model_seatings_against_the_enumerated_posterior():
    d, n, ctx = (0.5, 0.7), np.array([3, 2, 4, 1], np.uint32), np.array([0, 1, 0, 1], np.uint32)
    ends = np.array([2, 4], np.int32)
    up_s, low_s = (np.exp(lm_scoring.log_stirling(x)[:11, :11]) for x in d)
    rising = lambda step, k: math.prod(1 + step * i for i in range(k))
    total, want = 0.0, np.zeros(6)
    for t in itertools.product(*(range(1, k + 1) for k in n)):
        c = (t[0] + t[1], t[2] + t[3])
        weight = rising(d[1], t[0] + t[2]) * rising(d[1], t[1] + t[3]) * math.prod(low_s[k, x] for k, x in zip(n, t)) / rising(1, sum(c))
        for up in itertools.product(*(range(1, k + 1) for k in c)):
            p = weight * rising(d[0], sum(up)) * up_s[c[0], up[0]] * up_s[c[1], up[1]] / 3 ** sum(up)
            total += p
            want += p * np.array(t + up)
    totals = lm_scoring.Totals(np.array([7.0, 3.0]), np.array([2.0, 2.0]), 2.0, 2, d)
    t, up = lm_scoring.gibbs(np.array([5, 9], np.uint64), ends, ctx, n, totals, 8000, tuple(lm_scoring.log_stirling(x) for x in d))
    assert np.abs(np.concatenate((t, up), 1).mean(0) - want / total).max() < 0.06


def test_language_model_contexts_are_whole_words(spark):
    # Words before x and y end in the same letters, and only the whole word tells what follows.
    rows = [(i, " ".join(["one_ending x", "two_ending y"][(i + j) % 2] for j in range(20))) for i in range(60)]
    rows += [(1000 + i, text) for i in range(40) for text in (["one_ending x"] * 2 + ["two_ending x"] * 2)[i % 4 : i % 4 + 1]]
    rows = [(i, t) for i, t in rows if i < 1000 or zlib.crc32(str(i).encode()) % 10 == 0]
    assert len({t for i, t in rows if i >= 1000}) == 2
    got = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scoring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    right, wrong = ([got[i] for i, t in rows if i >= 1000 and t.startswith(x)] for x in ("one", "two"))
    assert min(right) > max(wrong) + 1


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate((30, 12, 10, 7, 3, 1, 25))] + [(20, "same words here twice same words here twice"), (21, "same words here twice same words here twice"), (30, None), (31, "?!"), (None, "x")]
    text = dict(items)
    docs = [(i, prose(rng, 200)) for i in range(40)]
    for i, k in enumerate((0, 1, 2, 3, 4, 5, 6, 20)):
        docs.append((100 + i, prose(rng, 30) + ", " + text[k].upper() + "! " + prose(rng, 30)))
        docs.append((200 + i, " ".join(text[k].split()[:9])))
    docs += [(300, None), (301, ""), (302, text[0]), (302, text[0]), (400, text[20] + " " + text[20])]
    split = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words = lambda t: split((t or "").encode().lower())
    windows = [(str(i), tuple(w[k : k + 10])) for i, t in items if i is not None and (w := words(t)) for k in range(max(1, len(w) - 9))]
    got = sorted(tuple(r)[:4] for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    shuffled = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=0)
    assert sorted(tuple(r)[:4] for r in shuffled.collect()) == got
    want = []
    for i, t in docs:
        w, hit, owners = words(t), set(), set()
        for owner, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    owners.add(owner)
        want.append((i, len(w), len(hit), len(owners)))
    assert got == sorted(want)


def test_filters_keep_rows_without_an_id_and_texts_that_share_one(spark):
    rng = random.Random(14)
    own = [prose(rng, 60, 4000) for _ in range(8)]
    rows = [(None, own[0]), (None, own[1]), (None, own[1]), (None, None), (None, ""), (7, own[2]), (7, own[3]), (7, own[3]), (8, own[3]), (9, own[4]), (None, own[4])]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, tag int").repartition(3)
    kept = [(r["doc_id"], r["text"] or "") for r in simhash.keep_first(docs).collect()]
    assert sorted(kept, key=str) == sorted([(None, own[0]), (None, own[1]), (None, ""), (7, own[2]), (7, own[3]), (9, own[4])], key=str)
    assert simhash.keep_first(docs).columns == docs.columns
    leak = own[5].split()[:12]
    rows += [(None, " ".join(leak)), (7, own[6] + " " + " ".join(leak)), (30, " ".join(leak))]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, tag int").repartition(3)
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string"))
    assert left.columns == docs.columns and sorted(r["tag"] for r in left.collect()) == list(range(11))


def test_packing_keeps_every_id_and_is_tight(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionAll(awkward(spark).where("doc_id < 50").select(F.col("doc_id") + 100_000, "text").distinct()).toDF("doc_id", "text")
    ids = {r["doc_id"]: np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4") for r in docs.collect()}
    rows = packing.packing(docs).collect()
    seen, laid = Counter(), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["start"] == 2048 * r["piece"]
        seen[r["doc_id"]] += r["length"]
        laid[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in ids.items()}
    for own in laid.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 2048
    assert len(laid) <= 1.01 * math.ceil(sum(seen.values()) / 2048) + 1


def test_pattern_plan_uses_up_any_histogram():
    rng = np.random.default_rng(8)
    for size, top in ((16, 5), (64, 40), (64, 3)):
        counts = np.append(0, rng.integers(0, top, size))
        used = np.zeros_like(counts)
        for content, n in packing.plan(counts, size):
            assert sum(content) <= size
            for length in content:
                used[length] += n
        assert (used == counts).all()
    assert packing.plan(np.zeros(9, np.int64), 8) == []


def test_registered_queries_have_their_operators_number():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.REGISTERED) == list(range(1, 14))
