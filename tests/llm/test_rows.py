"""Search, archives, decontamination, classifiers and the pipeline on small tables with every awkward row."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lateralis.llm import decontamination, language_id, packing, secret_scan, topk_search, toxicity, warc
from lateralis.llm.registry import QUERIES, fold, ship
from tests.llm.test_texts import components_by_force, lower, words


# --- top-k search ----------------------------------------------------------------------------------------------------

def best_by_force(rows, asked, k):
    usable = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for i, q in {(i, tuple(v)) for i, v in usable if asked(i)}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))[:k]
        for rank, (score, j) in enumerate(found, 1):
            out[i, rank, j, -score] += 1
    return out


@pytest.mark.parametrize("size, chunk", [(24, 16_384), (3, 4), (40, 2)])
def test_best_by_inner_product(spark, size, chunk):
    rng = np.random.default_rng(size)
    rows = [(i, [float(x) for x in rng.normal(size=size).astype(np.float32) * (0.01 if i % 3 else 1)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(30)] + [(7, rows[7][1]), (50, rows[50][1]), (900, None), (950, [None] * size), (951, [float("nan")] * size)]
    rows += [(1000, [float("inf")] * size), (1050, [1.0]), (1051, [2.0]), (1100, []), (1101, []), (None, rows[3][1]), (1150, [1e9] * size), (1151, [-1e9] * size)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("q", F.lit(1)).withColumn("rank", F.lit(2))
    got = topk_search.top_k(table, F.col("vec_id") % 50 == 0, 5, chunk)
    assert Counter(map(tuple, got.collect())) == best_by_force([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], lambda i: i % 50 == 0, 5)


@pytest.mark.parametrize("power", [24, 26, 29, 60, 1000])
def test_best_by_sums_of_any_size(spark, power):
    """Sums beyond 2**53 differ in their last bits only; beyond a long they count as the nearest long."""
    rng = random.Random(power)
    unit, step = 2.0**power, 2.0 ** (power - 22)
    rows = [(i, [unit + step * rng.randrange(5), -unit - step * rng.randrange(5), float(rng.randrange(3)), 0.25 * rng.randrange(4)]) for i in range(300)]
    rows += [(500 + i, rows[50][1]) for i in range(9)] + [(600, [1e300] * 4), (601, [-1e300] * 4), (650, [0.0] * 4), (651, [0.001, 0.0, 3.0, 1.0])]

    def whole(x):
        return int(x) * 256 if abs(x) >= 2.0**53 else math.floor(256 * x)

    whole_rows = {i: [whole(x) for x in v] for i, v in rows}
    want = Counter()
    for i, q in whole_rows.items():
        if i % 50 == 0:
            scores = {j: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))) for j, v in whole_rows.items() if j != i}
            for rank, j in enumerate(sorted(scores, key=lambda j: (-scores[j], j))[:5], 1):
                want[i, rank, j, scores[j]] += 1
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert Counter(map(tuple, topk_search.top_k(table, F.col("vec_id") % 50 == 0, 5).collect())) == want


def test_best_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(empty, F.lit(True)).count() == 0


# --- archives --------------------------------------------------------------------------------------------------------

def test_loser_tree_merges():
    rng = random.Random(3)
    for runs in range(0, 9):
        lists = [sorted(rng.randrange(30) for _ in range(rng.randrange(0, 12))) for _ in range(runs)]
        assert list(warc.merge_runs([iter(x) for x in lists])) == sorted(x for part in lists for x in part)


def test_archives(spark, write, tmp_path):
    body = "<p>" + "same " * 40 + "</p>"
    rows = [(1, "http://a.example/x?b=1#top", "short"), (2, "https://www.b.example/", "short"), (3, None, body), (4, "http://a.example/\r\nx y", body)]
    rows += [(5, "http://c.example", None), (6, "http://c.example", ""), (7, "http://c.example", "line\r\n\r\nWARC/1.1\r\n\r\n" + "é" * 200), (8, "", "é" * 50), (9, "u", "é" * 50)]
    rows += [(100 + i, "http://hot.example/", body) for i in range(50)] + [(3, None, body), (60, "http://z.example", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("value", F.lit(1))
    got = warc.archive(pages).collect()
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and i != first[h or ""]
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    order = [(r.url_key, r.captured, r.page_id) for r in got]
    assert order == sorted(order)
    assert any(k.startswith("example,a)/x?b=1") for k, _, _ in order)
    path = str(tmp_path / "archive")
    warc.write_archives(pages, path)
    files = {r.path.rsplit("/", 1)[-1]: gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect() if r.path.endswith(".gz")}
    for r in warc.read_archives(spark, path).collect():
        record = files[r.file][r.offset:r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and r.payload_digest.encode() in record
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- decontamination -------------------------------------------------------------------------------------------------

def contaminated_by_force(rows, items, window=13, substitutions=2):
    out = defaultdict(int)
    for i, t in rows:
        w = words(lower(t))
        for j, b in items:
            x = words(lower(b))
            width, allowed = (window, substitutions) if len(x) >= window else (len(x), 0)
            for shift in range(-len(x) + 1, len(w)):
                same = [w[k + shift] == x[k] for k in range(max(0, -shift), min(len(x), len(w) - shift))]
                if width and len(same) >= width and max(sum(same[s:s + width]) for s in range(len(same) - width + 1)) >= width - allowed:
                    out[i, j] = max(out[i, j], sum(same))
    return {(i, j, n) for (i, j), n in out.items()}


def test_contaminated(spark, documents):
    rng = random.Random(1)
    items = [(1, " ".join(f"q{k}" for k in range(30))), (2, "a b c d"), (3, ""), (4, None), (5, "One TWO three four five six seven eight nine ten eleven twelve 13"), (6, "a b c d")]
    item = items[0][1].split()
    rows = [(0, None), (1, ""), (2, "a B c d"), (3, "x a b c d y"), (4, "a b c x d"), (5, items[4][1].lower()), (6, " ".join(item[:12])), (7, " ".join(item[5:18]))]
    for k in range(150):
        w = item[rng.randrange(0, 10):][:rng.randrange(10, 25)]
        for at in rng.sample(range(len(w)), rng.randrange(0, 5)):
            w[at] = "other"
        rows.append((10 + k, " ".join(["pad"] * rng.randrange(0, 4) + w + ["q3", "q4", "q6"])))
    rows.append((500, " ".join(f"w{k % 991}" for k in range(30_000)) + " " + items[0][1]))
    docs = documents(rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    force = contaminated_by_force([r for r in rows if r[0] != 500], items) | {(500, 1, 30)}
    assert {tuple(r) for r in decontamination.matches(docs, bench).collect()} == force
    kept = decontamination.decontaminate(docs, bench)
    long = " ".join(f"l{k}" for k in range(20_000))
    more = spark.createDataFrame([(9, long), (9, "x y z"), (9, "x y z")], "item_id long, text string")
    near = " ".join(f"l{k}" if k % 97 else "edit" for k in range(18_000))
    held = {(1, 9, 20_000), (2, 9, 18_000 - len(range(0, 18_000, 97))), (4, 9, 3)}
    long_docs = documents([(1, "pad " + long), (2, near), (3, "l1 l2 l3 " * 20), (4, "w x Y z")])
    assert {tuple(r) for r in decontamination.matches(long_docs, more).collect()} == held
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(i for i, _ in rows if i not in {i for i, _, _ in force})
    assert decontamination.matches(documents([]), bench).count() == 0
    assert decontamination.matches(docs, bench.limit(0)).count() == 0


def test_benchmark_in_parts(spark, documents, monkeypatch):
    items = [(k, " ".join(f"i{k}_{n}" for n in range(20))) for k in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(k, f"before {t} after") for k, t in items])
    monkeypatch.setattr(decontamination, "SEEDS", 100)
    assert {tuple(r) for r in decontamination.matches(docs, bench).collect()} == {(k, k, 20) for k in range(12)}


def test_masks_are_lossless():
    from itertools import combinations

    for pair in combinations(range(13), 2):
        assert any(not {o + s for o in m} & set(pair) for m in decontamination.MASKS for s in range(13 - m[-1]))


# --- language --------------------------------------------------------------------------------------------------------

SPEECH = {"en": "the house and with from this that", "de": "das haus und mit von dieser nicht", "fr": "la maison avec dans cette été", "es": "la casa con desde esta niño"}


def speech(lang, n, rng):
    return " ".join(rng.choice(SPEECH[lang].split()) for _ in range(n))


def test_language(spark, write):
    rng = random.Random(4)
    rows = [(i, speech(lang, 30, rng), lang) for i, lang in enumerate(rng.choices(sorted(SPEECH), k=200))]
    odd = [(900, None, "en"), (901, "", "de"), (902, "123 --- 456", "fr"), (903, " \n", "es"), (904, "und", None), (None, "haus", "de"), (905, speech("fr", 20_000, rng), "fr")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("label", F.lit("x")).withColumn("score", F.lit(1))
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, write(documents=docs)).collect()}
    assert len(got) == 207
    for i, _, lang in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].lang_pred == lang and 0 <= got[i].score <= 1
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902, 903)) and got[905].lang_pred == "fr"


def test_language_learns_from_no_held_out_row(spark):
    """Changing label or text of held-out rows changes no other prediction."""
    rng = random.Random(5)
    rows = [(i, speech(lang, 12, rng), lang) for i, lang in enumerate(rng.choices(sorted(SPEECH), k=60))]
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    models = []
    for lang in (None, "zz"):
        docs = spark.createDataFrame([(i, t, lang if i in held else x) for i, t, x in rows], "doc_id long, text string, lang string")
        models.append(language_id.corpus_model(docs))
    assert models[0].labels == models[1].labels == sorted(SPEECH) and (models[0].log_prob == models[1].log_prob).all()


def test_language_without_training(spark, documents):
    docs = documents([(1, "some words"), (2, None)], lang=None)
    ship(spark)
    found = docs.select(language_id.predict(spark, language_id.corpus_model(docs))("text").alias("f")).select("f.*").collect()
    assert [tuple(r) for r in found] == [("und", 0.0)] * 2


def test_posteriors_equal_a_plain_sum(spark):
    docs = spark.createDataFrame([(1, "ab ba", "x"), (2, "cc ab", "y")], "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True), buckets=64, orders=(1, 2))
    from lateralis.llm.text import words_of
    import pyarrow as pa

    def grams(text):
        return [b for w in text.split() for b, _ in language_id.word_grams(pa.array([w]), 64, (1, 2))]

    for text in ("ab", "cc ba ab"):
        total = np.array([prior + sum(row[b].sum() for b in grams(text)) for prior, row in zip(model.log_prior, model.log_prob)])
        want = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert np.allclose(language_id.posteriors(words_of(pa.array([text]), False), model, 64, (1, 2))[0], want)


# --- toxicity --------------------------------------------------------------------------------------------------------

def garble(word, rng):
    kind = rng.randrange(5)
    if kind == 0:
        return word.replace("i", "1").replace("o", "0").replace("e", "3")
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        return ".".join(word)
    if kind == 3:
        return "".join(c * 3 if k == 2 else c for k, c in enumerate(word))
    return word.upper()


def test_toxicity(spark, write):
    rng = random.Random(6)
    clean, rude = [f"{a}{b}" for a in ("tra", "men", "sol", "per", "lin") for b in ("tion", "ment", "ger", "dow", "st")], ["idiot", "moron", "loser"]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(clean) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            w.insert(rng.randrange(40), garble(rng.choice(rude), rng) if i % 10 == 0 else rng.choice(rude))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    odd = [(900, None), (901, ""), (902, "x" * 30_000), (903, "i d i o t"), (None, "idiot"), (904, "1 2 3 4 5 a")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("label", F.lit(3))
    marks = spark.createDataFrame(labels + [(950, 1, 1), (900, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, write(documents=docs, labels=marks)).collect()}
    assert len(got) == 406 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in held) for i, _ in rows)
    right = sum(got[i].predicted == int(i % 5 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert got[903].predicted == 1 and got[901].predicted == got[900].predicted == got[902].predicted == 0


@pytest.fixture(scope="module")
def readings():
    """A function: the features of a text, those of a word that is not garbled, and whether the first hold one of the second."""
    counts = Counter()
    for w in "you are a person the idiot moron stupid disgusting or on in it is am rest paper water".split():
        codes = [0, 0, *map(toxicity._letter, w), 0]
        for k in range(2, len(codes)):
            counts[(codes[k - 2] * 512 + codes[k - 1]) * 512 + codes[k]] += 5
    pairs, letters = Counter(), np.zeros(512)
    for gram, n in counts.items():
        pairs[gram % 512**2] += n
        letters[gram % 512] += n
    restore = toxicity.Restorer(toxicity.CharacterModel(dict(counts), dict(pairs), letters, int(letters.sum())))
    of = lambda text: set(toxicity.text_features(pa.array([text]), restore)[1].tolist())
    return lambda text, word: of(word) <= of(text)


@pytest.mark.parametrize("text, word", [
    ("m o r o n", "moron"), ("you are a m o r o n", "moron"), ("y o u i d i o t", "idiot"),
    ("so " + "x y " * 11 + "i d i o t " + "x y " * 20, "idiot"), ("y o u a r e a m o r o n", "moron"),
])
def test_words_in_runs_of_single_letters(readings, text, word):
    assert readings(text, word) and not readings(text, "disgusting")


@pytest.mark.parametrize("text, word", [
    ("iiiiiiiidddddiiiiiooooooootttt", "idiot"), ("d--i--s--g--u--s--t--i--n--g", "disgusting"), ("you_are_a_st.up.id_person", "stupid"),
    ("iiddiioott", "idiot"), ("idddiot", "idiot"), ("id" + "ï" * 3 + "ot", "idïot"), ("x." * 3_000 + "m.o.r.o.n", "moron"),
])
def test_words_of_any_length_and_repetition(readings, text, word):
    assert readings(text, word) and not readings(text, "water")


def test_toxicity_without_labels(spark, documents):
    docs = documents([(1, "idiot"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    ship(spark)
    assert [r[0] for r in docs.select(toxicity.scorer(spark, model)("text")).collect()] == [0.0, 0.0]


# --- secrets ---------------------------------------------------------------------------------------------------------

def secret_rows(n=160):
    rng = random.Random(8)
    out = []
    for i in range(n):
        w = [rng.choice(["house", "water", "stone", "paper", "light"]) for _ in range(30)]
        kind = i % 4
        if kind == 0:
            w[10:11] = ["token", "=", f'"{rng.getrandbits(160):040x}"']
        elif kind == 1:
            w[10] = str(rng.randrange(10**15, 10**16))
        elif kind == 2:
            w[10] = f"http://x.example/a/{rng.getrandbits(64):016x}/index.html"
        out.append((i, " ".join(w)))
    return out


def test_secrets(spark, documents, write):
    rows = secret_rows()
    odd = [(900, None), (901, ""), (902, "a1" * 20_000), (903, 'token = "' + "ab12" * 10 + '" and again "' + "ab12" * 10 + '"'), (904, "-" * 40), (None, 'secret: "abcd1234abcd1234abcd"')]
    docs = documents(rows + odd)
    got = QUERIES["op10_secret_scan"](spark, write(documents=docs)).collect()
    secrets = {r.doc_id for r in got if r.secret}
    assert {i for i, _ in rows if i % 4 == 0} <= secrets and not {i for i, _ in rows if i % 4} & secrets
    assert 903 in secrets and None in {r.doc_id for r in got} and not {900, 901, 904} & {r.doc_id for r in got}
    assert Counter(r.doc_id for r in got)[903] == 2
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    texts = {r.doc_id: r for r in masked.collect()}
    assert len(texts) == 166
    for i, t in rows:
        if i % 4 == 0:
            assert secret_scan.MASKED in texts[i].text and texts[i].n_chars == len(texts[i].text)
        else:
            assert texts[i].text == t
    assert "ab12" not in texts[903].text and texts[900].text is None


def test_secrets_of_nothing(spark, documents):
    assert secret_scan.scan(documents([]), secret_scan.learning_rows()).count() == 0
    assert secret_scan.mask_secrets(documents([(1, "no finding")])).count() == 1


def test_native_plans_have_no_python(spark, documents):
    docs = documents(secret_rows(20))
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for df in (decontamination.matches(docs, bench), secret_scan.scan(docs, secret_scan.learning_rows())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline(spark, write):
    """Each stage against plain Python on what its predecessor kept."""
    rng = random.Random(9)
    plain = [(i, speech(lang, 60, rng) + f" unique{i} {' '.join(f'w{rng.randrange(9000)}' for _ in range(20))}", lang) for i, lang in enumerate(rng.choices(sorted(SPEECH), k=80))]
    passage = " ".join(f"bench{k}" for k in range(25))
    odd = [(200, None, "en"), (201, "1234 5678", "de"), (202, plain[3][1], plain[3][2]), (203, plain[4][1] + " more", plain[4][2])]
    odd += [(204, f"the house {passage} and with", "en")] + [(210 + k, f'the house with this and from that token = "{rng.getrandbits(160):040x}" the {k} house{k}', "en") for k in range(20)]
    docs = spark.createDataFrame([(*r, "s", None if r[1] is None else len(r[1])) for r in plain + odd], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    folder = write(documents=docs, benchmark=bench)
    docs, texts, rows = spark.read.parquet(f"{folder}/documents.parquet"), {}, [(i, t) for i, t, _ in plain + odd]
    want = [r for r in rows if r[0] not in (200, 201)]
    steps = [want]
    steps.append([r for r in want if any(i == r[0] == c for i, _, c in components_by_force(want))])
    gone = {i for i, _, _ in contaminated_by_force(steps[-1], [(1, passage)])}
    steps.append([r for r in steps[-1] if r[0] not in gone])
    assert {202, 203}.isdisjoint({i for i, _ in steps[1]}) and gone == {204}
    steps.append([(i, t if i < 210 else t[:t.index('"') + 1] + secret_scan.MASKED + t[t.rindex('"'):]) for i, t in steps[-1]])
    for (name, stage), expected in zip(corpus_pipeline.STAGES, steps):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(expected), name
        docs = out
    pieces = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in pieces.collect()} == {i for i, _ in steps[-1]}
    sizes = {r.doc_id: r.doc_tokens for r in pieces.collect()}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in steps[-1]}


def test_pipeline_of_nothing(spark, documents, write):
    empty = documents([]).select("doc_id", "text", "lang", "source", "n_chars")
    folder = write(documents=empty, benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_fold_of_null(spark):
    df = spark.createDataFrame([(None,), (12,)], "doc_id long")
    assert [r[0] for r in df.select(fold("doc_id", 7)).collect()] == [-1, zlib.crc32(b"12") % 7]


def test_pipeline_without_labels(spark, documents):
    docs = documents([(1, "the house"), (2, "123"), (3, None), (4, "")], lang=None)
    kept = corpus_pipeline.keep_known_language(spark, docs, "")
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
