"""Run detection against brute force over all lags, and the query's folds."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from churnlens.llm import periodic_runs, queries


def _brute(words):
    n, out = len(words), []
    for q in range(1, n):
        t = 0
        while t + q < n:
            s = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            length = t - s + q
            if t > s and length >= max(6, 4 * q):
                run = words[s:s + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.append((s, length, q))
            t += t == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _random_words(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        k = rng.randint(1, 3)
        part = [rng.choice("abc"[:k]) for _ in range(rng.randint(1, 14))]
        out += (part * 80)[:rng.randint(1, 90)] if rng.random() < 0.6 else part
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        words = _random_words(rng)
        n, runs, text = periodic_runs.analyse(" \n".join(words))
        assert (n, runs) == (len(words), _brute(words))
        assert text == _collapsed(words, runs)


def test_long_texts_and_ties():
    one = periodic_runs.analyse("la " * 200_000)
    assert one == (200_000, [(0, 200_000, 1)], "la")
    words = [str(i % 7001) for i in range(7001 * 5 + 3)]
    assert periodic_runs.analyse(" ".join(words))[1] == [(0, len(words), 7001)]
    assert periodic_runs.analyse(" ".join(str(i) for i in range(100_000)))[1] == []
    two = ["a"] * 6 + ["x"] + ["b"] * 6                    # equal lengths
    assert periodic_runs.analyse(" ".join(two))[1] == [(0, 6, 1), (7, 6, 1)]
    assert periodic_runs.analyse("a " * 5)[1] == []        # too short by one


def test_every_occurrence_pair_of_a_gram_is_not_needed():
    # a doubled de Bruijn circuit: each 5-gram of the period stands in it twice
    rng = random.Random(3)
    edges = {f"{a:04b}": list("0011") for a in range(16)}
    path, at = [], ["0000"]
    while at:
        left = edges[at[-1]]
        if left:
            at.append(at[-1][1:] + left.pop(rng.randrange(len(left))))
        else:
            path.append(at.pop()[-1])
    period = path[:-1]
    words = period * 5
    assert periodic_runs.analyse(" ".join(words))[1] == _brute(words)
    assert (0, len(words), len(period)) in _brute(words)


def test_seeds_are_extended_once(monkeypatch):
    calls = []
    reach = periodic_runs._reach
    monkeypatch.setattr(periodic_runs, "_reach", lambda *a: calls.append(a) or reach(*a))
    assert len(periodic_runs.find_runs(np.arange(40_000) % 100)) == 1
    assert len(calls) <= 2


def test_tables(spark):
    rows = [(1, "x y " * 9, "s"), (1, "x y " * 9, "s"), (2, None, "s"), (3, "", None),
            (None, "z z z z z z z", "s"), (4, "\x1ca\xa0 " * 12 + "b", "s")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_words string")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic_runs.detect(docs).collect()), key=str)
    assert got == sorted([
        (1, 18, [(0, 18, 2)], "x y"), (1, 18, [(0, 18, 2)], "x y"), (2, 0, [], ""), (3, 0, [], ""),
        (None, 7, [(0, 7, 1)], "z"), (4, 13, [(0, 12, 1)], "\x1ca\xa0 b")], key=str)
    assert periodic_runs.detect(docs.limit(0)).count() == 0


def test_query_folds(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(_random_words(rng)) if i % 9 else None) for i in range(160)]
    spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    looped = 0
    for doc_id, text in rows:
        words = (text or "").split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            looped += 1
        runs = _brute(words)
        r = got[doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["n_runs"] == len(runs)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(_collapsed(words, runs).encode()).hexdigest()
    assert looped > 5 and got[None]["n_runs"] == 0
