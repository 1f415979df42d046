"""Operators over whole texts against brute force on small tables with every awkward row."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lateralis.llm import jaccard_join, lm_scoring, packing, segments, substring_dedup
from lateralis.llm.registry import QUERIES
from lateralis.llm.text import joined_hash, words_of
import pyarrow as pa

PASSAGE = " ".join(f"shared{k}" for k in range(60))
LONG = " ".join(f"long{k % 997}x{k // 997}" for k in range(30_000))


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def numbered(prefix, n):
    return " ".join(f"{prefix}{k}" for k in range(n))


def edited(text, every):
    return " ".join(f"edit{k}" if k % every == 0 else w for k, w in enumerate(text.split()))


ROWS = [
    (0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "one"), (4, "ONE"), (5, "One two Three four"), (6, "one two three four five"),
    (7, f"{numbered('a', 50)} {PASSAGE} {numbered('b', 40)}"), (8, f"{PASSAGE}\t{numbered('c', 30)}"), (9, LONG), (10, LONG + " end"),
    (11, " ".join(["again"] * 120)), (12, "Éa\x1cb éA x  y <|endoftext|> don't J̌ KK"), (13, numbered("d", 34)), (14, numbered("d", 34)),
    (15, numbered("e", 35)), (16, numbered("e", 35)), (16, numbered("e", 35)), (None, numbered("e", 36)), (17, "x" * 50_000),
    *[(100 + k, edited(numbered("near", 200), 60 + 3 * k)) for k in range(12)],
    *[(200 + k, f"{PASSAGE} {numbered(f'own{k}_', 20)}") for k in range(12)],
    *[(300 + k, numbered("copy", 70)) for k in range(30)],
    *[(400 + k, f"{numbered('chain', 100 + 8 * k)}") for k in range(8)],
]


def test_words_of_texts():
    found = words_of(pa.array([t for _, t in ROWS]), lower=True)
    vocabulary = found.vocabulary.to_pylist()
    at, got = 0, []
    for n in found.counts:
        got.append([vocabulary[c] for c in found.codes[at:at + n]])
        at += n
    assert got == [words(lower(t)) for _, t in ROWS]


def test_filter_has_no_false_negatives_and_few_false_positives():
    h = joined_hash(np.arange(20_000, dtype=np.uint64), np.arange(20_000, dtype=np.uint64))
    parts = [(s, segments.filter_bits(x, 8, 12, 6)) for s, x in segments.split(h[:10_000], 8)]
    table = pa.table({"segment": pa.array([s for s, _ in parts], pa.int32()), "bits": pa.array([b for _, b in parts], pa.binary())})
    held = segments.Filter.of(8, 6, table)
    assert held.contains(h[:10_000]).all() and held.contains(h[10_000:]).mean() < 0.02
    assert not segments.Filter.of(8, 6, table.slice(0, 0)).contains(h).any()


# --- language model --------------------------------------------------------------------------------------------------

def test_lm_scores(spark, documents, write):
    folder = write(documents=documents(ROWS))
    got = defaultdict(list)
    for r in QUERIES["op1_lm_scoring"](spark, folder).collect():
        got[r.doc_id].append(r)
    tokens = [(i, words(lower(t)) + [None]) for i, t in ROWS]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in tokens if not held(i) for w in t)
    total, distinct = sum(counts.values()), len(counts)
    assert sum(map(len, got.values())) == len(ROWS)
    for i, t in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t)
        r = got[i][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(counts[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and -math.inf < r.score <= 0


def test_lm_scores_without_training_rows(spark, documents):
    empty = documents([])
    assert lm_scoring.score_corpus(empty, train=lm_scoring.F.lit(True)).count() == 0
    scored = lm_scoring.score_corpus(documents([(1, "a b")]), train=lm_scoring.F.lit(False)).first()
    assert (scored.n_known, scored.train_tokens, scored.base_score, scored.score) == (0, 0, 0.0, 0.0)


def test_lm_scores_do_not_depend_on_the_filter_bound(spark, documents):
    docs, train = documents(ROWS), lm_scoring.F.expr("doc_id is null or doc_id % 3 <> 0")
    held, asked = (
        sorted(map(tuple, lm_scoring.score_corpus(docs, train, most_bytes=most).collect()), key=repr) for most in (1 << 30, 64)
    )
    assert len(held) == len(asked) == len(ROWS)
    for a, b in zip(held, asked):
        assert a[:4] == b[:4] and a[5] == b[5] and a[4] == pytest.approx(b[4], rel=1e-9)


def test_lm_filter_has_its_bits_at_any_size():
    h = lm_scoring.mix(np.arange(20_000, dtype=np.uint64))
    part = segments.filter_bits(h, 60, lm_scoring.BITS_PER_ENTRY, lm_scoring.PROBES, None)
    assert len(part) == len(h) * lm_scoring.BITS_PER_ENTRY // 8


def test_lm_levels_read_back():
    counts = np.array([1, 2, 3, 4, 7, 100, 12345])
    grams = joined_hash(np.arange(7, dtype=np.uint64), np.arange(7, dtype=np.uint64))
    parts = defaultdict(list)
    for g, c in zip(grams, counts):
        parts[int(segments.segment_of(np.array([g]), 8)[0])].append(lm_scoring.entries(np.array([g]), np.array([c])))
    rows = [(s, segments.filter_bits(np.concatenate(e), 8, 30, 10)) for s, e in parts.items()]
    table = pa.table({"segment": pa.array([s for s, _ in rows], pa.int32()), "bits": pa.array([b for _, b in rows], pa.binary())})
    model = lm_scoring.Model(segments.Filter.of(8, 10, table), 0, 0, 0.0, 1.0, grams[:0], counts[:0], 0.0)
    assert list(model.levels(grams)) == list(lm_scoring.level_of(counts))
    value = lm_scoring.VALUES[lm_scoring.level_of(counts)]
    assert (np.abs(np.log(value / counts)) < 0.2).all()


# --- packing ---------------------------------------------------------------------------------------------------------

def test_packing_round_trip(spark, documents, write):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    rows = [r for r in ROWS if r[0] is not None and not (r[0] == 16 and r is ROWS[17])]
    folder = write(documents=documents(rows))
    pieces = QUERIES["op4_packing"](spark, folder).collect()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    covered, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        covered[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts, total in [(covered[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total if total is not None else at <= 2048
    assert sorted(sequences) == list(range(-(-sum(map(len, ids.values())) // 2048)))
    assert sum(sum(n for _, n in s) < 2048 for s in sequences.values()) <= 1


def test_packing_nothing(spark, documents):
    assert packing.pack(documents([]), packing.vocabulary_path()).count() == 0


# --- repeated passages -----------------------------------------------------------------------------------------------

def removed_by_force(rows, window):
    texts = [words(t) for _, t in rows]
    counts = Counter(tuple(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = Counter()
    for (i, _), w in zip(rows, texts):
        gone = set()
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("window, most_bytes", [(35, 1 << 20), (35, 4096), (7, 1 << 20), (64, 1 << 20)])
def test_repeats_removed(spark, documents, window, most_bytes):
    """Small filters leave documents unsettled, which the exact join then settles."""
    rows = [r for r in ROWS if r[0] not in (9, 10)] + [(9, LONG[:40_000]), (10, LONG[20_000:60_000])]
    got = substring_dedup.remove_repeats(documents(rows), window, most_bytes)
    assert Counter(map(tuple, got.collect())) == removed_by_force(rows, window)


def test_levels():
    assert substring_dedup.lengths_of(35) == [9, 18, 35] and substring_dedup.lengths_of(10) == [10]


# --- Jaccard join ----------------------------------------------------------------------------------------------------

def components_by_force(rows, size=5, percent=80):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                parent[root(x)] = root(y)
    ids = defaultdict(list)
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(x)].append(i)
    return Counter((i, len(sets[x]), min(ids[root(x)], default=None) if sets[x] else i) for x, (i, _) in enumerate(rows))


@pytest.mark.parametrize("frequent, most_bytes", [(8, 1 << 20), (1, 1 << 20), (3, 256)])
def test_components(spark, documents, frequent, most_bytes):
    got = jaccard_join.components(documents(ROWS), frequent=frequent, most_bytes=most_bytes).collect()
    assert Counter(map(tuple, got)) == components_by_force(ROWS)


def test_components_of_random_edits(spark, documents):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(12):
        base = [f"g{group % 4}w{k}" for k in rng.integers(0, 60, rng.integers(8, 90))]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.integers(0, 5)):
                w[rng.integers(0, len(w))] = f"r{rng.integers(0, 20)}"
            rows.append((len(rows), " ".join(w)))
    for frequent in (1, 8):
        got = jaccard_join.components(documents(rows), frequent=frequent).collect()
        assert Counter(map(tuple, got)) == components_by_force(rows)


@pytest.mark.parametrize("block", [200, 1_000, 10**6])
def test_links_of_a_large_bucket(spark, block):
    """However a bucket is cut into blocks, its links join what all pairs would join."""
    rng = np.random.default_rng(2)
    base = rng.integers(1, 2**62, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:50 + k % 10], rng.integers(1, 2**62, k % 17).astype(np.uint64)])) for k in range(60)]
    table = spark.createDataFrame([(k, len(s), bytearray(s.tobytes())) for k, s in enumerate(sets)], "key long, n int, tokens binary")
    buckets = table.selectExpr("1L AS sig", "key", "n", "key - key % 2 AS comp", "60L AS classes")
    got = {tuple(r) for r in jaccard_join._bucket_links(buckets, table, 80, block=block).collect()}

    def parts(links):
        label = {k: k - k % 2 for k in range(60)}
        for a, b in links:
            old, new = label[a], label[b]
            label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k in label if label[k] == v) for v in label.values()}

    linked = {
        (x, y) for x in range(60) for y in range(x + 1, 60)
        if 100 * len(np.intersect1d(sets[x], sets[y])) >= 80 * len(np.union1d(sets[x], sets[y]))
    }
    assert got <= linked and parts(got) == parts(linked) and 1 < len(parts(linked)) < 30


def test_one_of_each_component_stays(spark, documents):
    docs = documents(ROWS)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in components_by_force(ROWS) if i == c}
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {i for i in got if i is not None} == want and len([i for i in got if i is not None]) == len(want)
    assert jaccard_join.keep_one(documents([])).count() == 0
