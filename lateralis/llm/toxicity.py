"""Toxicity scores of deobfuscated text.

Noisy channel: what was written is a garbled form of intended letters. Suspicious words (digits or signs between
letters, separators inside a word, repeated letters, runs of single letters) become a lattice of the letters each
character may stand for, weighted by the channel, and Viterbi decoding under a character trigram model picks the restored
form. A run of single letters is read as one word and, with a boundary possible before every letter, as several; so is a
word with signs inside, with a boundary possible at every sign. As short words make such boundaries doubtful, the words
that neighbouring letters of a run, or pieces between separators, make from any of them on are read as well. No length is too long. Other words stay as they are. The trigram model counts the words of all texts.

Score: features are the restored words and their beginnings, lower case. Labelled learning rows (at most ``TOXIC_ROWS``
with label 1 and ``CLEAN_ROWS`` with label 0, chosen by a hash of the key) count each hashed feature per label; the
``SHORTLIST`` features that tell most are weighed one after the other, each on the toxic rows that those before it
leave unexplained, so that words that merely accompany a telling one get no weight. The score of a text is the noisy-or
of the features it has, over the rate of unexplained toxic rows.

Counting and scoring run in tasks over whole texts; the driver sees counts of bounded size only: the trigram table, the
shortlist, and the shortlisted features of the labelled sample.

Defined results: a null or empty text has the score of a text without any feature; without labels of both kinds every score is
0; rows with a null label teach nothing; repeated rows count each time (equal texts of the sample once). A null id is
not held out and not learned from.
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import fold, query, table
from lateralis.llm.text import Words, hashes, slices, sliced, words_of

TOXIC_ROWS, CLEAN_ROWS = 6_000, 12_000
SHORTLIST = 4_000
BUCKETS = 1 << 20
STARTS = (4, 5, 6, 7)
THRESHOLD = 0.3
PRECISION = (0.9, 0.7, 0.5, 0.3)  # telling features are weighed in this order
FLATTENED = 4096  # characters after which the paths of the decoder become plain text
JOINED = 24  # letters up to which neighbouring pieces are joined to whole words; beginnings and decoded words have no such bound
KEPT_LENGTH = 64  # characters; the readings of longer words are not kept for the next time
LETTERS = 512  # size of the hashed alphabet of the character model
#: The letters that signs and digits may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
SEPARATORS = set(".-_*~^'`,:;/\\·")
TRIM = ",.;:!?#$%&*|()[]{}\"'`~^-_=+<>/\\@"
STAND_FOR, REMOVED, REPEATED, KEPT = -1.0, -0.7, -0.7, -12.0
#: Words that may hold a doubled letter of any script, and those that do.
_DOUBLED = "|".join(c * 2 for c in "abcdefghijklmnopqrstuvwxyz") + r"|[^\x00-\x7F]"
_TWICE = re.compile(r"([^\W\d_])\1")
_SEPARATED = re.compile("[" + "".join(map(re.escape, sorted(SEPARATORS))) + "]+")
_SUSPICIOUS = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]|([^\W\d_])\1\1|^[\d@$!|+(]+[^\W\d_]|[^\W\d_][\d@$!|+(]+$")


# --- character model -------------------------------------------------------------------------------------------------

def _letter(c: str) -> int:
    return ord(c) % (LETTERS - 1) + 1  # 0 is the word boundary


class CharacterModel(NamedTuple):
    trigrams: dict[int, int]
    bigrams: dict[int, int]
    letters: np.ndarray
    total: int

    def log_p(self, a: int, b: int, c: int) -> float:
        """ln P(c | a b), interpolated over shorter histories."""
        p = (self.letters[c] + 0.1) / (self.total + 0.1 * LETTERS)
        one = self.letters[b] if b else self.total
        two = self.bigrams.get(a * LETTERS + b, 0)
        p = (self.bigrams.get(b * LETTERS + c, 0) + 8 * p) / (one + 8)
        return float(np.log((self.trigrams.get((a * LETTERS + b) * LETTERS + c, 0) + 8 * p) / (two + 8)))


def character_model(documents: DataFrame) -> CharacterModel:
    """Trigrams of letters inside marked words, over the words of all texts that are letters only."""

    def count(batches):
        totals: dict[int, int] = defaultdict(int)
        for batch in sliced(batches):
            words = words_of(batch.column("text"), lower=True)
            times = np.bincount(words.codes, minlength=len(words.vocabulary))
            plain = pc.utf8_is_alpha(words.vocabulary).to_numpy(zero_copy_only=False)
            kept, times = words.vocabulary.filter(pa.array(plain)), times[plain]
            if not len(kept):
                continue
            joined = "\n" + "\n".join(kept.to_pylist()) + "\n"
            code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
            mark = code == 10
            code = np.where(mark, 0, code % (LETTERS - 1) + 1)
            word = np.maximum(np.cumsum(mark) - 1 - mark, 0)
            # the history of a letter; before the first one it is the boundary twice
            one = np.concatenate([[0], code[:-1]])
            two = np.where(one == 0, 0, np.concatenate([[0, 0], code[:-2]]))
            gram, n = np.unique((two * LETTERS + one) * LETTERS + code, return_inverse=True)
            weight = np.bincount(n[1:], times[np.minimum(word[1:], len(times) - 1)], len(gram))
            for g, w in zip(gram.tolist(), weight.tolist()):
                totals[g] += int(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals.keys()), pa.int64()), pa.array(list(totals.values()), pa.int64())], ["gram", "n"]
        )

    found = documents.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    trigrams = dict(zip(found["gram"].to_pylist(), found["n"].to_pylist()))
    bigrams: dict[int, int] = defaultdict(int)
    letters = np.zeros(LETTERS)
    for gram, n in trigrams.items():
        bigrams[gram % (LETTERS * LETTERS)] += n
        letters[gram % LETTERS] += n
    return CharacterModel(trigrams, dict(bigrams), letters, int(letters.sum()))


# --- decoding --------------------------------------------------------------------------------------------------------

def _options(word: str, at: int) -> list[tuple[str, float]]:
    """The letters (or nothing) that a character may stand for, with the cost in the channel."""
    c = word[at]
    out = []
    if c.isalpha():
        out.append((c, 0.0))
        if at and word[at - 1] == c:
            out.append(("", REPEATED))
    else:
        out += [(letter, STAND_FOR) for letter in LOOKS_LIKE.get(c, "")]
        if c in SEPARATORS or not c.isalnum():
            out.append(("", REMOVED))
        elif at and word[at - 1] == c:
            out.append(("", REPEATED))
        if not out:
            out.append(("", KEPT))
    return out


def decode(word: str, log_p, spaced: bool = False, run: bool = False) -> str:
    """The likeliest intended word: Viterbi over the lattice, states are the last two letters.

    With ``spaced`` a removed sign may stand for a word boundary, with ``run`` a boundary may be before every letter; then
    the result is words with blanks between them. Time is linear in the length, and so is memory, in bytes.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for at in range(len(word)):
        options = _options(word, at)
        if spaced and not word[at].isalnum():
            options.append((" ", REMOVED))
        if run and at:
            for (a, b), (score, link) in list(states.items()):
                value = score + log_p(a, b, 0)
                if b and ((0, 0) not in states or states[0, 0][0] < value):
                    states[0, 0] = value, (link, " ")
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, link) in states.items():
            for letter, cost in options:
                if letter == " ":
                    if not b:
                        continue
                    to, value = (0, 0), score + cost + log_p(a, b, 0)
                elif letter:
                    c = _letter(letter)
                    # per letter the model is a penalty; a bonus keeps short readings from winning by length alone
                    to, value = (b, c), score + cost + log_p(a, b, c) + 2.5
                else:
                    to, value = (a, b), score + cost
                if to not in following or following[to][0] < value:
                    following[to] = (value, (link, letter) if letter else link)
        states = following
        if at % FLATTENED == FLATTENED - 1:
            states = {k: (score, (None, _text(link))) for k, (score, link) in states.items()}
    best = max(states.items(), key=lambda s: s[1][0] + (log_p(*s[0], 0) if s[0][1] else 0.0))
    return _text(best[1][1]).strip(" ")


def _text(link: tuple | None) -> str:
    """The letters of a path, from its last step back."""
    out = []
    while link is not None:
        link, letter = link
        out.append(letter)
    return "".join(reversed(out))


class Restorer:
    """Restored forms of words, with a bounded memory."""

    def __init__(self, model: CharacterModel):
        self.model, self.known, self.costs = model, {}, {}

    def log_p(self, a: int, b: int, c: int) -> float:
        key = (a, b, c)
        found = self.costs.get(key)
        if found is None:
            if len(self.costs) > 200_000:
                self.costs.clear()
            found = self.costs[key] = self.model.log_p(a, b, c)
        return found

    def __call__(self, word: str, run: bool = False) -> str:
        """The readings of a word, or of a run of single letters: as one word, and as several where that is likelier."""
        found = self.known.get((word, run))
        if found is None:
            found = decode(word, self.log_p)
            if run or not word.isalnum():
                parts = decode(word, self.log_p, spaced=not run, run=run)
                found = f"{found} {parts}" if " " in parts else found
            if len(word) <= KEPT_LENGTH:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[word, run] = found
        return found


def restored(words: Words, restore: Restorer) -> tuple[list[str], list[tuple[int, list[str]]], list[tuple[int, str, str]]]:
    """(form of each vocabulary word, (word, pieces) of words with separators, (text, form, letters) of runs of single letters);
    words are lower case."""
    trimmed = pc.utf8_trim(words.vocabulary, characters=TRIM)
    whole = words.vocabulary.to_pylist()
    forms = trimmed.to_pylist()
    odd = pc.invert(pc.or_(pc.utf8_is_alpha(trimmed), pc.equal(trimmed, ""))).to_numpy(zero_copy_only=False)
    doubled = pc.match_substring_regex(trimmed, _DOUBLED).to_numpy(zero_copy_only=False) & ~odd
    edged = pc.match_substring_regex(words.vocabulary, r"^[@$!|+(<][\p{L}]|[\p{L}][@$|+]$").to_numpy(zero_copy_only=False)
    pieces = []
    for k in np.flatnonzero(odd | edged).tolist():
        word = forms[k] if odd[k] else whole[k]
        if 3 <= len(word) and _SUSPICIOUS.search(word):
            forms[k] = restore(word)
            parts = [restore(p) if len(p) > 1 and not p.isalpha() else p for p in _SEPARATED.split(word) if p]
            if len(parts) > 1:
                pieces.append((k, parts))
    for k in np.flatnonzero(doubled & ~edged).tolist():
        if len(forms[k]) >= 3 and _TWICE.search(forms[k]):
            form = restore(forms[k])
            if form != forms[k]:  # a doubled letter may be meant: both readings count
                forms[k] = f"{forms[k]} {form}"
    single = (pc.utf8_length(trimmed).to_numpy(zero_copy_only=False) == 1) & np.array([len(f) == 1 and (f.isalpha() or f in LOOKS_LIKE) for f in forms], bool)
    spaced = []
    if single.any():
        here = single[words.codes].astype(np.int8)
        owners, ends = words.owners, words.ends
        edge = np.flatnonzero(np.diff(np.concatenate([[0], here, [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            while a < b:  # a run does not cross texts
                e = min(b, int(ends[owners[a]]))
                if e - a >= 3:
                    run = "".join(forms[c] for c in words.codes[a:e].tolist())
                    spaced.append((int(owners[a]), restore(run, run=True), run))
                a = e
    return forms, pieces, spaced


def joined_features(pieces: list[str], least: int) -> list[int]:
    """Distinct features of the words that neighbouring pieces make, from every piece on.

    From a piece on, words end with the first of more than ``JOINED`` letters, so its beginnings are all there; a longer word
    has these, and its whole form where the decoder reads it.
    """
    digest, out = xxhash.xxh3_64_intdigest, set()
    for first in range(len(pieces)):
        text = ""
        for at in range(first, len(pieces)):
            text += pieces[at]
            if len(text) >= least:
                out.add(digest(text) % BUCKETS)
            if len(text) > JOINED:
                break
        out.update(digest(text[:size], size) % BUCKETS for size in STARTS if len(text) >= size)
    return sorted(out)


def feature_hashes(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, form index) of the words and their beginnings; a form may be several words with blanks between them."""
    several = [(k, w) for k, f in enumerate(forms) if " " in f for w in f.split(" ")]
    array = pa.array(forms + [w for _, w in several], pa.string())
    keys, owners = [hashes(array)], [np.arange(len(array))]
    length = pc.utf8_length(array).to_numpy(zero_copy_only=False)
    for size in STARTS:
        at = np.flatnonzero(length >= size)
        cut = pc.utf8_slice_codeunits(array.take(pa.array(at)), 0, size).dictionary_encode()
        keys.append(hashes(cut.dictionary, seed=size)[cut.indices.to_numpy(zero_copy_only=False)])
        owners.append(at)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    filled = length[owner] > 1
    of = np.concatenate([np.arange(len(forms)), np.array([k for k, _ in several], np.int64)])
    return (key[filled] % np.uint64(BUCKETS)).astype(np.int64), of[owner[filled]]


def text_features(text: pa.Array, restore: Restorer, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) of an array of texts; of the features where ``wanted`` is set, if given."""
    words = words_of(text, lower=True)
    forms, pieces, spaced = restored(words, restore)
    base = len(forms)
    feature, form = feature_hashes(forms + [f for _, f, _ in spaced])
    more = [(k, joined_features(parts, 2)) for k, parts in pieces]
    for k, (_, reading, run) in enumerate(spaced):
        whole = reading.split(" ")[0]
        more += [(base + k, joined_features(list(letters), STARTS[0])) for letters in {whole, run}]
    feature = np.concatenate([feature, *[np.array(f, np.int64) for _, f in more]])
    form = np.concatenate([form, *[np.full(len(f), k) for k, f in more]])
    if wanted is not None:
        keep = wanted[feature]
        feature, form = feature[keep], form[keep]
    # each distinct (text, word) once, then the features of the word
    pair = np.unique(np.concatenate([
        words.owners * (base + len(spaced)) + words.codes, np.array([t * (base + len(spaced)) + base + k for k, (t, _, _) in enumerate(spaced)], np.int64),
    ]).astype(np.int64))
    owner, word = np.divmod(pair, max(base + len(spaced), 1))
    order = np.argsort(form, kind="stable")
    feature, form = feature[order], form[order]
    start, stop = np.searchsorted(form, word, "left"), np.searchsorted(form, word, "right")
    n = stop - start
    at = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
    both = np.unique(np.repeat(owner, n) * BUCKETS + feature[at])
    return both // BUCKETS, both % BUCKETS


# --- classifier ------------------------------------------------------------------------------------------------------

class ToxicityModel(NamedTuple):
    characters: CharacterModel
    features: np.ndarray
    log_clean: np.ndarray  # ln(1 - weight) of each feature
    base: float  # the score of a text without features


def _sample(documents: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, dict[int, float], dict[int, int]]:
    """Learning rows (label, text), a bounded number of either label; the share of each that was taken, and how many there are."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = known.where(learn & F.col("label").isin(0, 1))
    sizes = dict(known.groupBy("label").count().collect())
    most = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(n) for k, n in most.items()]
    chosen = parts[0].unionByName(parts[1])  # at most TOXIC_ROWS + CLEAN_ROWS rows of two numbers
    share = {k: min(1.0, most[k] / sizes[k]) if sizes.get(k) else 0.0 for k in (0, 1)}
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    return rows, share, sizes


def fit(documents: DataFrame, labels: DataFrame, learn: Column) -> ToxicityModel:
    spark = documents.sparkSession
    characters = character_model(documents)
    rows, share, sizes = _sample(documents, labels, learn)
    nothing = ToxicityModel(characters, np.zeros(0, np.int64), np.zeros(0), 0.0)
    if not share[0] or not share[1]:
        return nothing
    shared = spark.sparkContext.broadcast(characters)

    def count(batches):
        totals = np.zeros((2, BUCKETS), np.int32)
        restore = Restorer(shared.value)
        for batch in sliced(batches):
            label = batch.column("label").to_numpy()
            text, feature = text_features(batch.column("text"), restore)
            for k in (0, 1):
                totals[k] += np.bincount(feature[label[text] == k], minlength=BUCKETS).astype(np.int32)
        at = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[0][at]), pa.array(totals[1][at])], ["f", "c", "t"])

    sums = rows.mapInArrow(count, "f int, c int, t int").groupBy("f").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).where("t > 1").toArrow()
    feature, clean, toxic = (sums[c].to_numpy().astype(np.int64) for c in ("f", "c", "t"))
    gain = _gain(toxic, clean, *(max(1.0, share[k] * n) for k, n in ((1, sizes[1]), (0, sizes[0]))))
    order = np.lexsort((feature, -gain))[:SHORTLIST]
    short = np.sort(feature[order])
    wanted = spark.sparkContext.broadcast(short)

    def listed(batches):
        restore, chosen = Restorer(shared.value), np.zeros(BUCKETS, bool)
        chosen[wanted.value] = True
        for batch in sliced(batches):
            text, feature = text_features(batch.column("text"), restore, chosen)
            cut = np.searchsorted(text, np.arange(len(batch) + 1))
            lists = [np.searchsorted(wanted.value, feature[a:b]).astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(lists, pa.list_(pa.int32())), pa.array([hash_of(t) for t in batch.column("text").to_pylist()], pa.int64())],
                ["label", "features", "same"],
            )

    found = rows.mapInArrow(listed, "label int, features array<int>, same long").dropDuplicates(["label", "same"]).toArrow()
    label = found["label"].to_numpy()
    lists = found["features"].combine_chunks()
    matrix = np.zeros((len(label), len(short)), bool)
    matrix[np.repeat(np.arange(len(label)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False)] = True
    return _weigh(characters, short, matrix, label, share, float(np.log(max(len(feature), 2))))


def hash_of(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(text or "") - (1 << 63)


def _gain(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-likelihood gain of features that are commoner in toxic rows; 0 for the others."""
    t, c = toxic + 0.0, clean + 0.0
    n = t + c
    base = n_toxic / (n_toxic + n_clean)
    p = np.clip(t / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    gain = t * np.log(p / base) + c * np.log((1 - p) / (1 - base))
    return np.where(p > base, gain, 0.0)


def _weigh(
    characters: CharacterModel, features: np.ndarray, has: np.ndarray, label: np.ndarray, share: dict[int, float], chance: float
) -> ToxicityModel:
    """Features one after the other, precise ones first, each by what it explains of the toxic rows left over.

    ``chance`` is the gain that the best of all features reaches by chance; what gains less is left out.
    """
    clean = has[label == 0].sum(axis=0)
    open_rows = has[label == 1]
    n_clean = int((label == 0).sum())
    chosen, weights = [], []
    for least in PRECISION:
        while len(open_rows) and len(chosen) < SHORTLIST:
            toxic = open_rows.sum(axis=0)
            real = (toxic + 0.5) / share[1]
            weight = real / (real + (clean + 0.5) / share[0])
            gain = np.where((weight >= least) & (toxic > 2), _gain(toxic, clean, max(len(open_rows), 1), n_clean), 0.0)
            best = int(np.argmax(gain))
            if gain[best] <= chance:
                break
            chosen.append(best)
            weights.append(min(weight[best], 0.999))
            open_rows = open_rows[~open_rows[:, best]]
    rest = (len(open_rows) + 0.5) / share[1]
    base = rest / (rest + n_clean / share[0])
    order = np.argsort(features[chosen]) if chosen else []
    return ToxicityModel(
        characters, features[chosen][order] if chosen else np.zeros(0, np.int64), np.log1p(-np.array(weights))[order] if chosen else np.zeros(0), float(min(base, 0.2)),
    )


def scorer(spark: SparkSession, model: ToxicityModel):
    """A column function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        restore, weight, wanted = Restorer(model.characters), np.zeros(BUCKETS), np.zeros(BUCKETS, bool)
        weight[model.features], wanted[model.features] = model.log_clean, True
        for text in batches:
            out = [np.zeros(0)]
            for start, stop in slices(text):
                owner, feature = text_features(text.slice(start, stop - start), restore, wanted)
                out.append(1 - (1 - model.base) * np.exp(np.bincount(owner, weight[feature], stop - start)))
            yield pa.array(np.concatenate(out), pa.float64())

    from collections.abc import Iterator

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = fold("doc_id", 4)
    model = fit(documents, table(spark, folder, "labels"), learn=(held_out != 2) & (held_out >= 0))
    scored = documents.select("doc_id", (held_out == 2).alias("held_out"), scorer(spark, model)(F.col("text")).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
