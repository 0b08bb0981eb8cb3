"""Suffix dedup, periodic runs and conversation repair against brute force, on awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import conversation_repair, decontaminate, packing, periodic_runs, queries, substring_dedup, suffix_dedup, topk_search

DOCS = "doc_id long, text string, chunk long, runs string, `range` int, h string"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "r", 1, None) for i, t in rows], DOCS)


def repetitive(rng):
    """Texts that share stretches of every kind: copies, pieces, shifted pieces, one repeated byte, several scripts."""
    base = ["".join(rng.choice("abcdef ") for _ in range(400)), "日本語テキスト" * 30, "-" * 300, "ab" * 100, "x" * 49, "y" * 50, "z" * 51]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(10, 70):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.choice(base)
            a = rng.randrange(len(s))
            parts.append(s[a : a + rng.randint(10, 160)])
            parts.append("".join(rng.choice("ghijk") for _ in range(rng.randint(0, 30))))
        rows.append((i, "".join(parts)))
    rows += [(70, base[0]), (71, base[0][3:]), (70, base[0]), (5, "other " + base[0][100:220]), (72, ""), (73, None), (None, base[0]), (None, None), (None, base[0]), (-4, base[0][50:130] + "!")]
    rng.shuffle(rows)
    return rows


def brute_repeats(rows, span=suffix_dedup.SPAN):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for a in range(len(b) - span + 1):
                w = b[a : a + span]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - span + 1) if i is not None else ():
            if first[b[a : a + span]] < i:
                gone[a : a + span] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((i, len(b), int(gone.sum()), int((edges == 1).sum()), sha(bytes(np.frombuffer(b, np.uint8)[~gone]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions,chunk,ranges", [(1, 1 << 20, 10**9), (3, 2000, 40), (9, 300, 7)])
def test_repeats_equal_brute_force(spark, monkeypatch, partitions, chunk, ranges):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "RANGE_STRINGS", ranges)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    rows = repetitive(random.Random(partitions))
    got = suffix_dedup.repeat_report(frame(spark, rows).repartition(partitions))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows)


def test_repeats_on_driver_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_suffix_dedup(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)
    assert sum(r["n_removed"] for r in got) > 1000


def test_loser_tree_merges_and_knows_shared_lengths():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 5, 8):
        runs, flat = [], []
        for _ in range(n):
            s = rng.integers(0, 2, (int(rng.integers(0, 40)), suffix_dedup.WIDTH)).astype(np.uint8)
            s[:, rng.integers(0, 76) :] = 1
            s = np.array(sorted({bytes(r) for r in s})).astype(f"S{suffix_dedup.WIDTH}") if len(s) else np.zeros(0, f"S{suffix_dedup.WIDTH}")
            rows = np.frombuffer(s.tobytes(), np.uint8).reshape(-1, suffix_dedup.WIDTH)
            lengths, rest = suffix_dedup.front_coded(rows)
            lengths = np.frombuffer(lengths, np.uint8)
            assert (suffix_dedup.decoded(lengths, rest) == rows).all()
            runs.append((lengths.tolist(), rows.tobytes()))
            flat += [bytes(r) for r in rows]
        source, common = suffix_dedup.merged(runs) if n else ([], [])
        place, got = [0] * n, []
        for r in source:
            a = place[r] * suffix_dedup.WIDTH
            got.append(runs[r][1][a : a + suffix_dedup.WIDTH])
            place[r] += 1
        assert got == sorted(flat)
        for before, now, k in zip(got, got[1:], common[1:]):
            assert k == next((i for i in range(len(now)) if now[i] != before[i]), len(now))


def brute_runs(x):
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            end = i + q
            if end - start >= max(6, 4 * q):
                w = x[start:end]
                if next(p for p in range(1, len(w) + 1) if w[p:] == w[: len(w) - p]) == q:
                    out.append((start, end - start, q))
            i = max(i, start + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def brute_report(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *best, milli, sha(lines), sha(b" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_periodic_runs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 500)
    monkeypatch.setattr(periodic_runs, "QUERIES", 50)
    rng = random.Random(2)
    rows = [(None, "a a a a a a a"), (None, None), (1, ""), (2, None), (3, " \n\t "), (4, "x " * 700), (4, "x " * 700), (5, "İ\x85 é z " * 9)]
    for i in range(10, 250):
        k, n = rng.choice([1, 2, 3, 40]), rng.randint(0, 90)
        w = [f"w{rng.randrange(k)}" for _ in range(n)]
        if n > 12 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange((n - a) // 4 + 1)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    got = periodic_runs.run_report(frame(spark, rows).repartition(3))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_report(i, t) for i, t in rows), key=repr)


def test_periodic_runs_on_driver_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert sum(r[1] > 0 for r in got.values()) > 5
    for i, t in rows:
        assert got[i] == brute_report(i, t)


def test_extensions_equal_counting():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(2, 300)
        x = np.array([rng.randrange(2) for _ in range(n)] + [9]) if rng.random() < 0.5 else np.array(([0, 1, 1] * 200)[:n] + [9])
        i, j = (np.array([rng.randrange(n) for _ in range(50)]) for _ in range(2))
        i, j = i[i != j], j[i != j]
        want = [next(k for k in range(n + 1) if max(a, b) + k >= len(x) or x[a + k] != x[b + k]) for a, b in zip(i, j)]
        assert periodic_runs.Extensions(x)(i, j).tolist() == want


CONV = "conv_id long, turn long, role string, text string, part int, h string, audit string"


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        out += [(c, t, r, x)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """By trying all edits, row after row, without a grammar or matrices: (cost, audit, repaired rows)."""
    # rows: (role, text, fault); a state is the initials so far, of which only the automaton's state counts.
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    to = step.get((state, role[0]))
                    if to is not None:
                        new = (cost + 5, audit + "I", out + [(role, "")])
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    best = {0: (0, "", [])}
    for role, text, fault in rows:
        best, new = inserts(best), {}

        def offer(state, entry):
            if state not in new or entry[:2] < new[state][:2]:
                new[state] = entry

        for state, (cost, audit, out) in best.items():
            offer(state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            if (state, role[:1]) in step:
                offer(step[state, role[:1]], (cost + extra, audit + "K", out + [(role, text)]))
            for other in ("user", "assistant"):
                if (state, other[0]) in step:
                    offer(step[state, other[0]], (cost + 1 + extra, audit + "R", out + [(other, text)]))
        best = new
    best = inserts(best)
    return min((best[s] for s in (0, 3) if s in best), key=lambda e: e[:2])


def brute_repair(conv_id, rows):
    """rows: (turn, role, text) after damage, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, judged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault))
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = cheapest(judged)
    return (conv_id, gaps, *counts.values(), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def brute_repairs(rows, hashes):
    by = {}
    for c, t, r, x in damaged(rows):
        by.setdefault(c, []).append((t, r, x))
    order = lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), hashes[row[2]])
    return sorted((brute_repair(c, sorted(by.get(c, []), key=order)) for c in {c for c, *_ in rows}), key=repr)


def text_hashes(spark, texts):
    values = spark.createDataFrame([(t,) for t in set(texts)], "t string").selectExpr("t", "xxhash64(t) h").collect()
    return {r["t"]: r["h"] for r in values}


def conversations(rng):
    roles, texts = ["user", "assistant", "system", "tool", None, "ux"], ["Yes.", "No!", "cut off", "", None, " \n", "a? \t", "b.", "c.", "d", "long. " * 30]
    rows = []
    for c in [None, *range(120)]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, None if rng.random() < 0.05 else t * rng.randint(1, 2), rng.choice(roles[: rng.choice([2, 3, 6])]), rng.choice(texts)))
    rows += [(500, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(900)]
    rows += [(501, 3, "user", "Same.")] * 40 + [(502, None, None, None)]
    rows += [(c, t, r, f"{x}.") for c in range(600, 640) for t, (r, x) in enumerate([("system", "s"), ("user", "q"), ("assistant", "r"), ("user", "q2"), ("assistant", "r2")])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [10, 10**6])
def test_repairs_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    rows = conversations(random.Random(chunk))
    table = spark.createDataFrame([(*r, 3, "h", "K") for r in rows], CONV)
    got = conversation_repair.repair_report(table)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    hashes = text_hashes(spark, [x for *_, x in damaged(rows)])
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repairs(rows, hashes)


def test_repairs_on_driver_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hashes = text_hashes(spark, [x for *_, x in damaged(rows)])
    assert sorted(map(tuple, queries.op13_conversation_repair(spark, sf_dir).collect()), key=repr) == brute_repairs(rows, hashes)


def test_audits_are_the_least_of_all_sequences():
    """Every audit of short sequences is tried; the least by cost and then ASCII is the grammar's."""
    cost_of = {"K": 0, "R": 1, "D": 2, "I": 5}
    symbols = [3 * i + f for i in range(4) for f in (0, 1)] + [conversation_repair.MUST_GO]
    rng = random.Random(8)
    sequences = [tuple(s) for n in range(3) for s in itertools.product(symbols, repeat=n)] + [tuple(rng.choice(symbols) for _ in range(4)) for _ in range(60)]

    def best(sequence):
        found = None
        for edits in itertools.product("KRD", repeat=len(sequence)):
            for gaps in itertools.product(range(3), repeat=len(sequence) + 1):
                audit, pattern = "", []
                for gap, edit, symbol in itertools.zip_longest(gaps, edits, sequence):
                    audit += "I" * gap + (edit or "")
                    pattern += ["[ua]"] * gap
                    if edit == "K":
                        pattern.append("suax"[symbol // 3])
                    elif edit == "R":
                        pattern.append("[ua]")
                if any(s == conversation_repair.MUST_GO and e != "D" for s, e in zip(sequence, edits)):
                    continue
                want = "" if not pattern else ("s" if len(pattern) % 2 else "") + "ua" * (len(pattern) // 2)
                if want == "s" or not re.fullmatch("".join(pattern), want):
                    continue
                cost = sum(cost_of[c] for c in audit) + sum(5 for s, e in zip(sequence, edits) if s % 3 == 1 and e != "D")
                found = min(found or (cost, audit), (cost, audit))
        return found

    assert conversation_repair.audits([bytes(s) for s in sequences]) == [best(s) for s in sequences]


def test_conversation_rows_are_repaired(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "Alone.")]
    got = conversation_repair.repair(spark.createDataFrame([(*r, 0, "", "") for r in rows], CONV)).collect()
    assert [tuple(r) for r in got if r["conv_id"] == 1] in ([(1, "user", "Again."), (1, "assistant", "Yes.")], [(1, "user", "Hi."), (1, "assistant", "Yes.")])
    assert not [r for r in got if r["conv_id"] == 2]


def test_empty_tables(spark):
    assert suffix_dedup.repeat_report(frame(spark, [])).count() == 0
    assert periodic_runs.run_report(frame(spark, [])).count() == 0
    assert conversation_repair.repair_report(spark.createDataFrame([], CONV)).count() == 0
    assert conversation_repair.repair(spark.createDataFrame([], CONV)).count() == 0
    assert suffix_dedup.repeat_report(frame(spark, [(None, None), (None, "")])).count() == 2


def test_fitted_patterns_carry_the_packing():
    """Where three pieces can fill a sequence, more than half of the short ones lie in fitted patterns, and no more sequences are used than by best-fit alone."""
    rng = np.random.default_rng(11)
    for n, size, low in ((20_000, 512, 1), (3000, 300, 40), (50_000, 2048, 8), (40, 64, 1), (7, 64, 1)):
        short = np.bincount(np.minimum(size - 1, (rng.lognormal(np.log(0.4 * size), 0.6, n) + low).astype(int)), minlength=size + 1)
        whole = short.copy()
        whole[size] = n // 3
        patterns = packing.full_patterns(np.flatnonzero(short), size)
        fitted, left = packing.rounded(patterns, packing.fit_repeats(patterns, short.astype(float)), short)
        used = np.zeros(size + 1, np.int64)
        for content, k in fitted:
            assert sum(content) == size and k > 0
            for v in content:
                used[v] += k
        assert (used + left == short).all() and (left >= 0).all()
        if n >= 3000:
            assert used.sum() > 0.5 * short.sum()
        found = packing.plan(whole, size)
        made = np.zeros(size + 1, np.int64)
        for content, k in found:
            assert sum(content) <= size
            for v in content:
                made[v] += k
        assert (made == whole).all()
        assert sum(k for _, k in found) <= sum(k for _, k in packing.best_fit(whole, size))
    assert packing.plan(np.zeros(65, np.int64), 64) == []


def test_topk_with_large_components_and_repeated_ids(spark):
    """Scores beyond 2^53, components beyond 32 bits, rows that share a vec_id: each row is a query and a candidate."""
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randint(0, 7) for _ in range(4)]) for i in range(60)]
    rows += [(1004, [4e7, 0.0]), (1001, [1e8, 0.0]), (1002, [1.0, 0.0]), (1020, [1.0, 0.0]), (1020, [1.0, 0.0]), (1020, [2.0, -1.0]), (1003, [-1e7, 3.0, 0.0, 2e6])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rid int")
    ints = [(i, [math.floor(64 * x) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    want = []
    for n, (q, v) in enumerate(ints):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(ints) if m != n)[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert max(abs(r[3]) for r in want) > 2**55
    for block in (16_384, 8):
        assert sorted(map(tuple, topk_search.topk_search(table, block=block).collect())) == sorted(want)
    for bad in ([1e18, 0.0], [1e8, 3e10]):
        with pytest.raises(Exception, match="64 bits"):
            topk_search.topk_search(spark.createDataFrame([(0, bad), (20, bad)], "vec_id long, embedding array<double>")).collect()


def test_passages_are_cut_by_row(spark):
    """Rows that share a doc_id, rows without one, and columns named as the operator's own."""
    rng = random.Random(21)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, clean, clean2 = prose(80), prose(200), prose(150)
    rows = [
        (1, prose(30) + " " + passage, 0), (2, clean, 1), (2, prose(100) + " " + passage, 2), (2, clean2, 3),
        (None, prose(40) + " " + passage, 4), (None, prose(60), 5), (3, passage, 6), (4, None, 7), (4, "", 8), (5, clean[:60], 9),
    ]
    names = "doc_id long, text string, mark int, of string, `from` string, `to` string, __row string, __starts int, __ends int"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", 1, 2) for r in rows], names)
    got = substring_dedup.remove_passages(docs)
    assert got.columns == docs.columns
    out = {r["mark"]: r for r in got.collect()}
    assert {m: out[m]["text"] for m in (0, 1, 3, 5, 7, 8, 9)} == {m: rows[m][1] for m in (0, 1, 3, 5, 7, 8, 9)}
    assert 6 not in out  # nothing was left of it
    for m in (2, 4):
        assert passage not in out[m]["text"] and out[m]["text"].split() == rows[m][1].split()[:-80]
    assert {(r["of"], r["from"], r["to"], r["__row"], r["__starts"]) for r in out.values()} == {("a", "b", "c", "d", 1)}


def test_decontamination_by_shuffles_and_with_many_owners(spark, monkeypatch):
    """One window held by many items, sides too large to broadcast by rows or by bytes, and no benchmark at all."""
    rng = random.Random(31)
    prose = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    shared = prose(12)
    docs = [(i, " ".join(prose(20) + (shared if i % 3 == 0 else []) + prose(15))) for i in range(30)] + [(40, None), (41, "")]
    items = [(i, " ".join(prose(3) + shared + prose(2))) for i in range(200)] + [(300, "w1 w2"), (301, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda b: sorted(map(tuple, decontaminate.contamination(table, b).collect()))
    want = rows(bench)
    assert {r[0] for r in want if r[3] >= 200} == {i for i in range(0, 30, 3)}
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert rows(bench) == want
    assert not any(r[5] for r in rows(bench.limit(0))) and len(rows(bench.limit(0))) == len(docs)
