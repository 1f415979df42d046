"""N-gram Jaccard join by token-combination prefixes.

The tokens of a document are the hashes of its word shingles. One pass counts all tokens of the corpus and
gives two Bloom filters, of tokens in more than one document and of frequent ones; they put tokens into the
classes single, rare and frequent. A false positive moves a token to another class for every document alike,
so the order (class, hash) stays one global order and no link is lost.

Prefixes: two linked sets share a token among their first n - ceil(0.8 n) + 1. A document whose prefix holds
no frequent token indexes the rare tokens in it. Otherwise it indexes all its rare tokens and, over an
extended prefix of its frequent ones, every combination of two neighbours: if two linked sets share no rare token,
their common tokens are all frequent, at most 0.25 n of the others can part neighbours, and the prefix is long
enough that one pair of neighbours is left whole in both. Signatures meet by hash segment.

Verification needs components only. Equal sets are one class. Each signature with several classes first checks
its classes against one of them (a star); parity sketches bound the symmetric difference from below and drop hopeless
pairs before the whole sets are compared. Signatures whose classes are still in several components are compared in
full, in blocks of bounded size, first the largest signature of every class, then all that are open: sketches choose
the classes that may have a link to another component, and whole sets of those give the links that join components.

Defined results: a document without words or text has no shingles and is linked with nothing; one with
fewer words than a shingle is its whole word sequence; component_id is the smallest doc_id of the component
(null ids come last); repeated rows are linked like copies. Sets and tokens are identified by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm import segments as seg
from lateralis.llm.registry import free_name, query, table
from lateralis.llm.text import Words, hashes, joined_hash, mix, sliced, words_of
from lateralis.session import scratch_path

SHINGLE = 5
PERCENT = 80
FREQUENT = 8  # a token in more documents than this is of the frequent class
TOKEN_BITS, TOKEN_PROBES = 12, 6
BLOCK = 400_000  # tokens of a block of a bucket
SKETCH_BLOCK = 2_048  # classes of a block of a bucket
CENTRES = 8  # classes of a bucket that are compared with all others first


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number of each text) of all shingles, in order, repeats included."""
    word = hashes(words.vocabulary)[words.codes]
    starts = words.ends - words.counts
    whole = words.counts >= size
    number = np.where(whole, words.counts - size + 1, np.minimum(words.counts, 1))
    h, have = word, 1
    by_length = {1: word}
    while have < size:
        step = min(have, size - have)
        left = h[:max(len(h) - step, 0)]
        h = joined_hash(left, by_length[step][have:have + len(left)]) if step in by_length else joined_hash(left, h[step:])
        have += step
        by_length[have] = h
    out = np.zeros(int(number.sum()), np.uint64)
    at = np.cumsum(number) - number
    owner = np.repeat(np.arange(len(number)), number)
    place = np.arange(len(out)) - at[owner] + starts[owner]
    long = whole[owner]
    out[long] = h[place[long]]
    for n in range(1, size):
        texts = np.flatnonzero(words.counts == n)
        if len(texts):
            short = word[starts[texts]]
            for k in range(1, n):
                short = joined_hash(short, word[starts[texts] + k])
            out[at[texts]] = mix(short + np.uint64(n))
    return out, number


def _least(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def _sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of 2^k >= 2 n cells: two sets differ in at least as many tokens as cells."""
    cells = 1 << max(6, (2 * len(tokens) - 1).bit_length())
    spot = (mix(tokens + np.uint64(0x1F83D9ABFB41BD6B)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(spot, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold_to(sketch: np.ndarray, size: int) -> np.ndarray:
    """A parity sketch with fewer cells (cells are the low bits of a hash, so halves add up)."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def _key(tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = mix(tokens).sum(dtype=np.uint64)
    return mix(np.array([total + np.uint64(len(tokens))], np.uint64))


class _Task:
    """Sets of the texts of a slice, sorted by hash."""

    def __init__(self, text: pa.Array, size: int):
        flat, number = shingles(words_of(text, lower=True), size)
        ends = np.cumsum(number)
        self.sets = [np.unique(flat[e - n:e]) for e, n in zip(ends.tolist(), number.tolist())]
        self.keys = np.array([_key(s)[0] if len(s) else 0 for s in self.sets], np.uint64)


def _token_filters(rows: DataFrame, size: int, frequent: int, most_bytes: int):
    """Filters of the tokens in several documents and of the frequent ones, over all tokens."""
    spark = rows.sparkSession
    bits = seg.segment_bits(spark)

    def emit(batches):
        for batch in sliced(batches, size=8 << 20):
            flat, _ = shingles(words_of(batch.column("text"), lower=True), size)
            distinct, n = seg.counted(flat)
            n = np.minimum(n, frequent + 1).astype(np.uint8)
            out = [
                (s, h.view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), c.tobytes()) for s, h, c in seg.split(distinct, bits, n)
            ]  # the segment tells the highest bits: six bytes are enough for a filter
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["segment", "hashes", "counts"]
            )

    def reduce(segment, cells):
        short = np.frombuffer(b"".join(cells["hashes"]), np.uint8).reshape(-1, 6)
        h = np.zeros((len(short), 8), np.uint8)
        h[:, :6] = short
        h, c = seg.counted(h.view(np.uint64).ravel(), seg.numbers(cells["counts"], np.uint8))
        yield (
            segment, seg.filter_bits(h[c > 1], bits, TOKEN_BITS, TOKEN_PROBES, most_bytes),
            seg.filter_bits(h[c > frequent], bits, TOKEN_BITS, TOKEN_PROBES, most_bytes),
        )

    sent = rows.select("text").mapInArrow(emit, "segment int, hashes binary, counts binary")
    path = scratch_path(spark, "tokens")
    seg.per_segment(sent, reduce, "segment int, several binary, frequent binary").write.parquet(path)
    parts = spark.read.parquet(path)
    return tuple(
        spark.sparkContext.broadcast(seg.collect_filter(parts.select("segment", F.col(c).alias("bits")), bits, TOKEN_PROBES))
        for c in ("several", "frequent")
    )


_SHORT = np.uint64((1 << 48) - 1)


def signatures(tokens: np.ndarray, several: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """What a set is indexed under; the flags give the class of each of its sorted tokens."""
    n = len(tokens)
    least = _least(n, percent)
    prefix = n - least + 1
    frequent = frequent & several
    single, rare, common = tokens[~several], tokens[several & ~frequent], tokens[frequent]
    if len(single) + len(rare) >= prefix:
        return mix(rare[:max(prefix - len(single), 0)])
    differing = (100 - percent) * n // percent  # the most tokens by which a linked set differs
    reach = common[:differing + 2 + n - least]
    return np.concatenate([mix(rare), joined_hash(reach[:-1], reach[1:])])


def _index(rows: DataFrame, size: int, percent: int, filters) -> DataFrame:
    """Two kinds of rows: of each document (doc_id, key, n), and packed signatures by segment."""
    bits = seg.segment_bits(rows.sparkSession)
    several, frequent = filters

    def emit(batches):
        for batch in sliced(batches):
            task = _Task(batch.column("text"), size)
            n = np.array([len(s) for s in task.sets], np.int64)
            flat = np.concatenate(task.sets) if len(task.sets) else np.zeros(0, np.uint64)
            in_several = several.value.contains(flat & _SHORT, routed=flat)
            in_frequent = np.zeros(len(flat), bool)
            at = np.flatnonzero(in_several)
            in_frequent[at] = frequent.value.contains(flat[at] & _SHORT, routed=flat[at])
            found, ends = [], np.cumsum(n)
            first = np.zeros(len(n), bool)  # equal sets of a slice are indexed once
            first[np.unique(task.keys, return_index=True)[1]] = True
            for s, e, k, new in zip(task.sets, ends.tolist(), n.tolist(), first.tolist()):
                found.append(signatures(s, in_several[e - k:e], in_frequent[e - k:e], percent) if k and new else s[:0])
            each = np.array([len(x) for x in found], np.int64)
            sig = np.concatenate(found) if found else np.zeros(0, np.uint64)
            packed = [
                (x, a.tobytes(), b.tobytes(), c.tobytes())
                for x, a, b, c in seg.split(sig, bits, np.repeat(task.keys, each), np.repeat(n, each).astype(np.int32))
            ]
            columns = list(zip(*packed)) or [()] * 4
            size_of, blank = len(batch), len(packed)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column("doc_id"), pa.nulls(blank, pa.int64())]),
                pa.array(np.concatenate([task.keys.view(np.int64), np.zeros(blank, np.int64)])),
                pa.array(np.concatenate([n, np.full(blank, -1)])),
                *[pa.concat_arrays([pa.nulls(size_of, t), pa.array(c, t)]) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ], ["doc_id", "key", "n", "segment", "signatures", "keys", "sizes"])

    return rows.mapInArrow(emit, "doc_id long, key long, n long, segment int, signatures binary, keys binary, sizes binary")


def _buckets(packed: DataFrame) -> DataFrame:
    """(sig, key, n) of every signature that several classes have."""

    def reduce(segment, cells):
        s, k, n = seg.numbers(cells["signatures"]), seg.numbers(cells["keys"]), seg.numbers(cells["sizes"], np.int32)
        order = np.lexsort((k, s))
        s, k, n = s[order], k[order], n[order]
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])]) if len(s) else np.zeros(0, bool)
        s, k, n = s[new], k[new], n[new]
        _, at, count = np.unique(s, return_inverse=True, return_counts=True)
        many = count[at] > 1 if len(s) else np.zeros(0, bool)
        yield from zip(s[many].view(np.int64).tolist(), k[many].view(np.int64).tolist(), n[many].tolist())

    return seg.per_segment(packed, reduce, "sig long, key long, n int")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _sets(rows: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(key, n, sketch, tokens) of the classes in ``wanted``, one row each."""
    spark = rows.sparkSession
    bits = seg.segment_bits(spark)

    sent = wanted.select("key").mapInArrow(_pack_keys(bits), "segment int, keys binary")
    parts = seg.per_segment(
        sent, lambda s, cells: [(s, seg.filter_bits(np.unique(seg.numbers(cells["keys"])), bits, TOKEN_BITS, TOKEN_PROBES))],
        "segment int, bits binary",
    )
    keep = spark.sparkContext.broadcast(seg.collect_filter(parts, bits, TOKEN_PROBES))

    def emit(batches):
        for batch in sliced(batches):
            task = _Task(batch.column("text"), size)
            chosen = np.flatnonzero(keep.value.contains(mix(task.keys)))
            _, first = np.unique(task.keys[chosen], return_index=True)
            chosen = chosen[first]
            sets = [task.sets[k] for k in chosen]
            yield pa.RecordBatch.from_arrays([
                pa.array(task.keys[chosen].view(np.int64), pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([_sketch(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ], ["key", "n", "sketch", "tokens"])

    every = rows.select("text").mapInArrow(emit, "key long, n int, sketch binary, tokens binary").where("n > 0")
    return every.dropDuplicates(["key"])


def _pack_keys(bits: int):
    def pack(batches):
        for batch in batches:
            h = mix(batch.column("key").to_numpy().view(np.uint64))
            columns = list(zip(*[(s, x.tobytes()) for s, x in seg.split(h, bits)])) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["segment", "keys"])

    return pack


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct pairs (a, b): first by the sketches, then on the whole sets."""

    def by_sketch(batches):
        for batch in batches:
            na, nb = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            keep = []
            for x, y, sa, sb in zip(na, nb, batch.column("sa"), batch.column("sb")):
                a, b = np.frombuffer(sa.as_buffer(), np.uint8), np.frombuffer(sb.as_buffer(), np.uint8)
                size = min(len(a), len(b))
                apart = int(np.bitwise_count(_fold_to(a, size) ^ _fold_to(b, size)).sum())
                # overlap <= (na + nb - apart) / 2 and it needs percent of the union
                keep.append(100 * (x + y - apart) >= percent * (x + y + apart))
            keep = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    def by_set(batches):
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb")):
                a, b = np.frombuffer(ta.as_buffer(), np.uint64), np.frombuffer(tb.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    light = sets.select("key", "n", "sketch")
    near = (
        pairs.join(light.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
        .join(light.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
        .select("a", "b", "na", "nb", "sa", "sb").mapInArrow(by_sketch, "a long, b long")
    )
    whole = sets.select("key", "tokens")
    return (
        near.join(whole.select(F.col("key").alias("b"), F.col("tokens").alias("tb")), "b")
        .join(whole.select(F.col("key").alias("a"), F.col("tokens").alias("ta")), "a")
        .select("a", "b", "ta", "tb").mapInArrow(by_set, "a long, b long")
    )


def connected(links: DataFrame) -> DataFrame:
    """(key, comp) of every key in ``links`` (a, b): comp is the smallest key of its component.

    Labels take the least label of their neighbours and then that label's own label, round after round; each
    round is a written table.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.min("a")).alias("comp"), F.lit(True).alias("moved"))
    while True:
        path = scratch_path(spark, "labels")
        labels.write.parquet(path)
        now = spark.read.parquet(path)
        if not now.where("moved").limit(1).count():
            return now.select("key", "comp")
        now = now.select("key", "comp")
        around = both.join(now, F.col("b") == F.col("key")).groupBy(F.col("a").alias("key")).agg(F.min("comp").alias("near"))
        stepped = now.join(around, "key").select("key", "comp", F.least("comp", "near").alias("next"))
        jumped = stepped.join(now.select(F.col("key").alias("next"), F.col("comp").alias("far")), "next")
        labels = jumped.select("key", F.least("next", "far").alias("new"), "comp").select(
            "key", F.col("new").alias("comp"), (F.col("new") < F.col("comp")).alias("moved")
        )


def _open_buckets(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(sig, key, n, comp) of signatures whose classes are in several components; one signature per set of classes."""
    named = buckets.join(comps, "key", "left").select("sig", "key", "n", F.coalesce("comp", "key").alias("comp"))
    held = named.groupBy("sig").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("classes"),
        F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.hash("key")).alias("y"),
    ).where("low <> high")
    one = held.groupBy("classes", "x", "y").agg(F.min("sig").alias("sig"))
    return named.join(one.select("sig", "classes"), "sig")


def _star(buckets: DataFrame, pivot, percent: int) -> DataFrame:
    """Distinct pairs of each class with one class of its bucket."""
    centre = buckets.groupBy("sig").agg(pivot(F.struct("key", "n", "comp")).alias("centre"))
    return (
        buckets.join(centre, "sig").where(F.col("comp") != F.col("centre.comp"))
        .where(_sizes_fit(F.col("n"), F.col("centre.n"), percent))
        .select(F.least("key", "centre.key").alias("a"), F.greatest("key", "centre.key").alias("b")).distinct()
    )


def _forest(key: np.ndarray, comp: np.ndarray, side: np.ndarray | None, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the components of some classes as far as their sets do; with sides, across them only.

    A row compares one class with all others. The classes of the commonest tokens go first, for in a group of near
    copies those are close to most others; after that only classes outside the largest component need their row.
    """
    size = np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    common = np.add.reduceat(np.bincount(ids)[ids], starts) / size
    _, label = np.unique(comp, return_inverse=True)
    mark = np.zeros(len(distinct), bool)
    links = []

    def row(x: int) -> None:
        own = ids[starts[x]:starts[x] + size[x]]
        mark[own] = True
        both = np.add.reduceat(mark[ids], starts, dtype=np.int64)
        mark[own] = False
        near = (100 * both >= percent * (size + size[x] - both)) & (label != label[x])
        if side is not None:
            near &= side != side[x]
        for y in np.flatnonzero(near).tolist():
            if label[y] != label[x]:
                links.append((int(key[x]), int(key[y])))
                label[label == label[y]] = label[x]

    order = np.argsort(-common, kind="stable")
    for x in order[:CENTRES].tolist():
        row(x)
    largest = np.bincount(label).argmax()
    seed = int(np.flatnonzero(label == largest)[0])
    for x in order.tolist():
        if label[x] != label[seed]:
            row(x)
    return links


def _blocks(buckets: DataFrame, cells: int, *columns: str) -> DataFrame:
    """Rows of each pair of blocks (i, j) of a bucket; a block has about ``cells`` of the column ``weight``."""
    total = buckets.groupBy("sig").agg(F.ceil(F.sum("weight") / cells).cast("int").alias("blocks"))
    held = buckets.join(total, "sig").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    spread = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", *columns)


def _grouped(batches):
    """((sig, i, j), members) of rows that are sorted by those."""
    name, members = None, []
    for batch in batches:
        for sig, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if (sig, i, j) != name:
                if members:
                    yield name, members
                name, members = (sig, i, j), []
            members.append(rest)
    if members:
        yield name, members


def _plausible(buckets: DataFrame, sets: DataFrame, percent: int, block: int = SKETCH_BLOCK) -> DataFrame:
    """The rows of buckets whose sketch admits a link to another component of their bucket."""
    spread = _blocks(buckets.withColumn("weight", F.lit(1)), block, "key", "n", "comp").join(
        sets.select("key", "sketch"), "key"
    ).select("sig", "i", "j", "mine", "key", "n", "comp", "sketch")

    def compare(batches):
        found: set[tuple[int, int]] = set()
        for (sig, i, j), members in _grouped(batches):
            mine, key, n, comp = (np.array([m[c] for m in members], np.int64) for c in range(4))
            if comp.min() == comp.max():
                continue
            sizes = np.array([len(m[4]) for m in members])
            chosen = np.zeros(len(members), bool)
            folded = {
                int(size): np.stack([_fold_to(np.frombuffer(m[4], np.uint8), size) if len(m[4]) >= size else np.zeros(size, np.uint8) for m in members]).view(np.uint64)
                for size in np.unique(sizes)
            }
            for x in np.flatnonzero(mine == i):
                others = np.flatnonzero((comp != comp[x]) & (mine == j) & (100 * n >= percent * n[x]) & (100 * n[x] >= percent * n))
                for size in np.unique(np.minimum(sizes[others], sizes[x])):
                    rows = others[np.minimum(sizes[others], sizes[x]) == size]
                    bits = folded[int(size)]
                    apart = np.bitwise_count(bits[rows] ^ bits[x]).sum(axis=1).astype(np.int64)
                    both = n[rows] + n[x]
                    near = rows[100 * (both - apart) >= percent * (both + apart)]
                    chosen[near] = True
                    chosen[x] |= len(near) > 0
            found.update((sig, k) for k in key[chosen].tolist())
        rows = np.array(sorted(found), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["sig", "key"])

    chosen = spread.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(compare, "sig long, key long")
    return buckets.join(chosen.distinct(), ["sig", "key"])


def _bucket_links(buckets: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Distinct links between components of each bucket, by blocks of about ``block`` tokens."""
    spread = _blocks(buckets.withColumn("weight", F.col("n")), block, "key", "comp").join(
        sets.select("key", "tokens"), "key"
    ).select("sig", "i", "j", "mine", "key", "comp", "tokens")

    def compare(batches):
        found: set[tuple[int, int]] = set()
        for (_, i, j), members in _grouped(batches):
            mine, key, comp = (np.array([m[c] for m in members], np.int64) for c in range(3))
            if comp.min() != comp.max():
                links = _forest(key, comp, None if i == j else mine, [np.frombuffer(m[3], np.uint64) for m in members], percent)
                found.update((min(link), max(link)) for link in links)
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    grouped = spread.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return grouped.mapInArrow(compare, "a long, b long").distinct()


def _largest_buckets(buckets: DataFrame) -> DataFrame:
    """The buckets that are the largest one of some class."""
    chosen = buckets.groupBy("key").agg(F.max_by("sig", F.struct("classes", "sig")).alias("sig")).select("sig").distinct()
    return buckets.join(chosen, "sig", "left_semi")


def components(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT, most_bytes: int = seg.MOST_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``documents``."""
    spark = documents.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    def full(held: DataFrame) -> DataFrame:
        return _bucket_links(stored(_plausible(held, sets, percent), "plausible"), sets, percent)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = stored(_index(rows, size, percent, _token_filters(rows, size, frequent, most_bytes)), "index")
    docs = index.where("n >= 0").select("doc_id", F.when(F.col("n") > 0, F.col("key")).alias("key"), F.col("n").alias("n_shingles"))
    buckets = stored(_buckets(index.where("n < 0").select("segment", "signatures", "keys", "sizes")), "buckets")
    sets = stored(_sets(rows, size, buckets.select("key").distinct()), "sets")
    links, comps = None, spark.createDataFrame([], "key long, comp long")
    for step in (
        lambda held: _verified(_star(held, F.min, percent), sets, percent),
        lambda held: full(_largest_buckets(stored(held, "open"))),
        lambda held: full(stored(held, "open")),
    ):
        found = stored(step(_open_buckets(buckets, comps)), "links")
        links = found if links is None else links.unionByName(found)
        if found.limit(1).count():
            comps = connected(links)
    classes = docs.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first"))
    named = classes.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    of_key = named.join(least, "comp").select("key", "component_id")
    return docs.join(of_key, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component, all columns kept: the one with the smallest id.

    Of rows with equal ids in a component one stays; rows without an id are always kept.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "components")
    components(documents.select("doc_id", "text")).write.parquet(path)
    found = spark.read.parquet(path)
    key = free_name(documents, "component_key")
    this = F.col("doc_id").cast("long") == F.col(key)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    repeated = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(key)).count().where("count > 1").select(key)
    kept = documents.join(gone, this, "left_anti")
    if not repeated.limit(1).count():
        return kept
    return kept.join(repeated, this, "left_anti").unionByName(kept.join(repeated, this, "left_semi").dropDuplicates(["doc_id"]))


@query("""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
c AS (WITH RECURSIVE r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
      SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON a = doc_id""")
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return components(table(spark, folder, "documents"))
