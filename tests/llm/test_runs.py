"""Periodic runs against every period tried in turn."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from lateralis.llm import periodic_runs
from lateralis.llm.registry import QUERIES
from lateralis.llm.text import words_of
from tests.llm.test_texts import ROWS, words


def brute(w):
    """All runs of a list of words: of each period the maximal stretches, the smallest period of each stretch."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        start = None
        for i in range(len(w) - q + 1):
            same = i < len(w) - q and w[i] == w[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + q
                if length >= max(24, 3 * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return " ".join(b[:n])


def texts():
    r = random.Random(7)
    out = ["", None, "a", " ".join("a" * 24), " ".join("a" * 23), " ".join("ab" * 60), fibonacci(300), " ".join("abc" * 7 + "ab" + "abc" * 9)]
    passage = " ".join(f"p{k}" for k in range(20))
    out.append(" ".join(f"l{k % 7} {passage}" for k in range(40)))
    out.append(" ".join(f"l{k} {passage} r{k}" for k in range(60)))
    for _ in range(120):
        letters, parts = "ab" if r.random() < 0.4 else "abcdef", []
        for _ in range(r.randint(1, 6)):
            unit = [r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 8, 13, 21]))]
            parts += (unit * r.randint(1, 12))[:r.randint(1, 90)]
        out.append(" ".join(parts))
    return out


def test_runs_of_texts():
    cases = texts()
    found = periodic_runs.find_runs(words_of(pa.array(cases), lower=False))
    for k, text in enumerate(cases):
        assert found.get(k, []) == brute(words(text)), text
    assert sum(map(len, found.values())) > 100


def planted(i, w):
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, text):
    w = planted(i, words(text))
    runs = brute(w) if len(w) < 3_000 else []
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for k, x in enumerate(w) if k not in drop)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *first, digest(listed), digest(kept))


@pytest.fixture(scope="module")
def rows():
    plain = [(i, t) for i, t in ROWS if t is None or len(t) < 50_000 or " " not in t]
    more = [(1000 + k, " ".join(f"w{j % 211}" for j in range(k, k + 200 + k))) for k in range(150)]
    return plain + more + [(5000 + k, t) for k, t in enumerate(texts())]


def test_query_against_every_period(spark, documents, write, rows):
    got = QUERIES["op12_periodic_runs"](spark, write(documents=documents(rows)))
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t) for i, t in rows), key=key)
    assert got.where("n_runs > 0").count() > 60


def test_whole_result_of_the_operator(spark, documents):
    text = "x " + " ".join(["Ab", "c"] * 15) + "  y\tz"
    got = periodic_runs.periodic_runs(documents([(1, text), (1, text), (None, None)])).collect()
    for r in got[:2]:
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (33, [(1, 30, 2)], "x Ab c y z")
    assert (got[2].doc_id, got[2].n_words, got[2].runs, got[2].collapsed) == (None, 0, [], "")
    assert periodic_runs.periodic_runs(documents([])).count() == 0


def test_many_left_words_and_a_long_single_period():
    repeated = " ".join(f"{k} " + " ".join(f"p{j}" for j in range(17)) for k in range(4_000))
    long = " ".join(["a"] * 60_000)
    found = periodic_runs.find_runs(words_of(pa.array([repeated, long]), lower=False))
    assert found == {1: [(0, 60_000, 1)]}
