"""Prefix trie of conversations, built as burst tries.

A turn is known by a 128-bit id of its role and text, so a conversation is a path: the ids of its turns in order, 24
bytes each with the bytes of the text. Equal conversations are one suffix with a number of members. All suffixes
start in one container under the root. A container of more than ``MOST_SUFFIXES`` suffixes or ``MOST_BYTES`` bytes is
burst: its least and greatest suffix show the turns that all share, which become a chain of trie heads at once, and
what is left is dealt to one container per next turn id. The rest are small: they are dealt out by their heads' ids
(the shards), sorted, and swept by a stack of open nodes into nodes. What containers add up to (leaves, saved
tokens) is then passed up the trie heads, round by round.

Nothing is collected by a hot key: a container that grows is burst, copies of one conversation are one suffix, and
their ids, which a digest needs in order, are sorted by range, joined to pieces where they are and read as a stream.
One conversation's path is one row of 24 bytes a turn. The rounds are as many as the deepest oversized containers
have branching turns. Every round is a written table, which a lost executor is recovered from.

Defined results: rows without a conversation id are left out; a null role or text counts as empty; turns stand in
order of ``turn``, null first, and of the turn's id where that is equal, so repeated rows are repeated turns; an
empty table has no node, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateralis.llm.registry import query, table
from lateralis.session import broadcast_if_small, scratch_path

ID_BYTES, RECORD = 16, 24
MOST_SUFFIXES = 4_096
MOST_BYTES = 8 << 20
PIECE = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
TOP = "parent_key binary"


def turns(conversations: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, record): the turns of each conversation, numbered from 0 in order."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    turn_id = F.unhex(F.md5(F.concat_ws(":", F.length(by).cast("string"), F.concat(by, said)).cast("binary")))
    size = F.unhex(F.lpad(F.hex(F.octet_length(said).cast("long")), 2 * (RECORD - ID_BYTES), "0"))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(order).alias("turn"), F.concat(turn_id, size).alias("record")
    )
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "record")
    return rows.select("conv_id", (F.row_number().over(ordered) - 1).cast("long").alias("at"), "record")


def paths(numbered: DataFrame) -> DataFrame:
    """(conv_id, path) of each conversation that has a turn."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "record"))), lambda t: F.hex(t.record))
    return numbered.groupBy("conv_id").agg(F.unhex(F.array_join(listed, "")).alias("path"))


def _cells(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _batches(rows, schema: pa.Schema, size: int = 2_000):
    """Batches of the tuples of ``rows``."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    columns = zip(*held) if held else [()] * len(schema)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_PIECES = "key binary, path binary, first_id long, n long, ids string"
_SUFFIXES = "path binary, n long, conv_id long, ends string"


def suffixes(rows: DataFrame) -> DataFrame:
    """(path, n, conv_id, ends) of each distinct path of (conv_id, path): members, the smallest, digest of all in order."""
    piece, suffix = _cells(_PIECES), _cells(_SUFFIXES)

    def pieces(batches):
        def run():
            key, held, size = None, [], 0
            for row in _rows(batches):
                if row[0] != key or size > PIECE:
                    if held:
                        yield key, path, held[0], len(held), ",".join(map(str, held))
                    key, held, size = row[0], [], 0
                path = row[2]
                held.append(row[1])
                size += 8
            if held:
                yield key, path, held[0], len(held), ",".join(map(str, held))

        yield from _batches(run(), piece)

    def ends(batches):
        def run():
            key = None
            for row in _rows(batches):
                if row[0] != key:
                    if key is not None:
                        yield path, n, least, digest.hexdigest()
                    key, path, least, n, digest = row[0], row[1], row[2], 0, hashlib.sha256()
                else:
                    digest.update(b",")
                n += row[3]
                digest.update(row[4].encode())
            if key is not None:
                yield path, n, least, digest.hexdigest()

        yield from _batches(run(), suffix)

    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(F.unhex(F.md5("path")).alias("key"), "conv_id", "path")
    ranged = keyed.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ranged.mapInArrow(pieces, _PIECES)
    return joined.repartition("key").sortWithinPartitions("key", "first_id").mapInArrow(ends, _SUFFIXES)


def _shared(low: bytes, high: bytes, most: int) -> int:
    """The records that two paths share."""
    n = 0
    while n < most and low[RECORD * n:RECORD * n + RECORD] == high[RECORD * n:RECORD * n + RECORD]:
        n += 1
    return n


def _bytes(path: bytes, depth: int) -> int:
    """Bytes of the text of the last of the first ``depth`` turns."""
    return int.from_bytes(path[RECORD * depth - RECORD + ID_BYTES:RECORD * depth], "big") if depth else 0


_CONTAINED = "key binary, depth long, parent_key binary, parent_conv long, path binary, n long, conv_id long, ends string"


def _sweep_container(depth: int, parent_key, parent_conv, rows: list[tuple]):
    """The nodes of a container of suffixes in order, as rows of ``NODE`` and the key of the head above their top."""
    out: list[list] = []
    open_: list[int] = []  # rows of ``out`` that are still open, from the top down
    above: list[int] = []  # for each row of ``out`` the row of its parent

    def close(to: int, path: bytes) -> None:
        while len(open_) > to:
            at = open_.pop()
            node = out[at]
            node[6] += (node[3] - 1) * _bytes(path, node[1])
            node[5] = node[5] or 1
            if open_:
                up = out[open_[-1]]
                up[0] = min(up[0], node[0])
                up[3] += node[3]
                up[4] += 1
                up[5] += node[5]
                up[6] += node[6]

    before = None
    for path, n, conv, ends in rows:
        length = len(path) // RECORD
        if before is not None:
            close(_shared(before, path, min(len(before) // RECORD, length)) - depth + 1, before)
        for at in range(depth + len(open_), length + 1):
            above.append(open_[-1] if open_ else -1)
            open_.append(len(out))
            out.append([conv, at, None, 0, 0, 0, 0, NO_ENDS])
        last = out[open_[-1]]
        last[0], last[3], last[7] = min(last[0], conv), last[3] + n, ends
        before = path
    close(0, before)
    for node, up in zip(out, above):
        node[2] = out[up][0] if up >= 0 else parent_conv
        yield (*node, parent_key if up < 0 else None)


def sweep(contained: DataFrame) -> DataFrame:
    """Nodes of small containers, with the key of the head above for the top node of each."""
    schema = _cells(f"{NODE}, {TOP}")

    def run(batches):
        def nodes():
            key, held = None, []
            for row in _rows(batches):
                if row[0] != key:
                    if held:
                        yield from _sweep_container(*head, held)
                    key, head, held = row[0], row[1:4], []
                held.append(row[4:])
            if held:
                yield from _sweep_container(*head, held)

        yield from _batches(nodes(), schema)

    shards = contained.repartition("key").sortWithinPartitions("key", "path")
    return shards.mapInArrow(run, f"{NODE}, {TOP}")


_BURST = "key binary, depth long, parent_key binary, parent_conv long, n_convs long, conv_id long, shared long, path binary"


def _burst_heads(contained: DataFrame, most_suffixes: int, most_bytes: int) -> DataFrame:
    """The oversized containers: what all their suffixes share becomes a chain of heads down to ``shared`` turns."""
    found = contained.groupBy("key").agg(
        F.count("*").alias("suffixes"), F.sum(F.octet_length("path").cast("long")).alias("bytes"),
        F.min("path").alias("low"), F.max("path").alias("high"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.first("parent_conv").alias("parent_conv"),
    ).where((F.col("suffixes") > 1) & ((F.col("suffixes") > most_suffixes) | (F.col("bytes") > most_bytes)))
    schema = _cells(_BURST)

    def run(batches):
        def heads():
            for key, depth, parent_key, parent_conv, n, conv, low, high in _rows(batches):
                shared = _shared(low, high, min(len(low), len(high)) // RECORD)
                yield key, depth, parent_key, parent_conv, n, conv, shared, low[:RECORD * shared]

        yield from _batches(heads(), schema)

    return found.select("key", "depth", "parent_key", "parent_conv", "n_convs", "conv_id", "low", "high").mapInArrow(run, _BURST)


def _head_nodes(heads: DataFrame) -> DataFrame:
    """Nodes of burst containers (with ends, children, leaves and saved of what lies below), as ``sweep`` gives them."""
    schema = _cells(f"{NODE}, {TOP}")

    def run(batches):
        def nodes():
            for depth, parent_key, parent_conv, n, conv, shared, path, ends, children, leaves, saved in _rows(batches):
                for at in range(shared, depth - 1, -1):
                    saved += (n - 1) * _bytes(path, at)
                    top = at == depth
                    yield (
                        conv, at, parent_conv if top else conv, n, children if at == shared else 1, leaves, saved,
                        (ends or NO_ENDS) if at == shared else NO_ENDS, parent_key if top else None,
                    )

        yield from _batches(nodes(), schema)

    columns = ("depth", "parent_key", "parent_conv", "n_convs", "conv_id", "shared", "path", "ends", "children", "leaves", "saved")
    return heads.select(*columns).mapInArrow(run, f"{NODE}, {TOP}")


def _key(path: Column, depth: Column) -> Column:
    """The id of the head that ``path`` passes at ``depth``."""
    return F.unhex(F.md5(F.substring(path, F.lit(1), (depth * RECORD).cast("int"))))


def build(rows: DataFrame, most_suffixes: int = MOST_SUFFIXES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """All nodes of the trie of (conv_id, path), one row per node, with the columns of ``NODE``."""
    spark = rows.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    root, none = F.lit(b""), F.lit(None)
    active = written(suffixes(rows).select(
        root.alias("key"), F.lit(0).cast("long").alias("depth"), none.cast("binary").alias("parent_key"),
        none.cast("long").alias("parent_conv"), "path", "n", "conv_id", "ends",
    ), "suffixes")
    columns = active.columns
    small, bursts = [], []
    while True:
        heads = written(_burst_heads(active, most_suffixes, most_bytes), "heads")
        if heads.isEmpty():
            small.append(active)
            break
        marks = heads.select("key", "shared", F.col("conv_id").alias("head_conv"))
        marked = written(active.join(broadcast_if_small(marks), "key", "left"), "burst")
        small.append(marked.where(F.col("shared").isNull()).select(columns))
        inside = marked.where(F.col("shared").isNotNull())
        here = F.octet_length("path") == F.col("shared") * RECORD
        bursts.append((heads, inside.where(here).select("key", "ends")))
        below = F.col("shared") + 1
        active = inside.where(~here).select(
            _key(F.col("path"), below).alias("key"), below.alias("depth"), F.col("key").alias("parent_key"),
            F.col("head_conv").alias("parent_conv"), "path", "n", "conv_id", "ends",
        )
    contained = small[0]
    for more in small[1:]:
        contained = contained.unionByName(more)
    nodes = [written(sweep(contained), "nodes")]
    for heads, ends in reversed(bursts):
        tops = nodes[0].where(F.col("parent_key").isNotNull())  # swept tops of any round, and heads of the round below
        for more in nodes[-1:] if len(nodes) > 1 else []:
            tops = tops.unionByName(more.where(F.col("parent_key").isNotNull()))
        sums = tops.groupBy(F.col("parent_key").alias("key")).agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        joined = heads.join(ends, "key", "left").join(sums, "key")
        nodes.append(written(_head_nodes(joined), "head-nodes"))
    result = nodes[0]
    for more in nodes[1:]:
        result = result.unionByName(more)
    return result.drop("parent_key")


def prefix_trie(conversations: DataFrame, most_suffixes: int = MOST_SUFFIXES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The trie of the conversations as they are."""
    return build(paths(turns(conversations)), most_suffixes, most_bytes)


def rebuilt(numbered: DataFrame) -> DataFrame:
    """(conv_id, path) of every conversation with its first turns taken from that of its group of five."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    every = numbered.where(F.col("at") == 0).select("conv_id", head.alias("head"))
    donated = numbered.where((F.col("at") < 8) & (F.col("conv_id") % 5 == 0)).select(
        F.col("conv_id").alias("donor"), F.col("at").alias("donor_at"), F.col("record").alias("donor_record")
    )
    taken = (
        every.withColumn("donor", F.col("conv_id") - F.col("conv_id") % 5).join(donated, "donor")
        .where(F.col("donor_at") < F.col("head")).select("conv_id", F.col("donor_at").alias("at"), F.col("donor_record").alias("record"))
    )
    # own turns keep their numbers, at 8 or more behind all taken ones; only the order counts
    own = numbered.where(F.col("at") >= head).select("conv_id", (F.col("at") + 8).alias("at"), "record")
    whole = paths(taken.unionByName(own))
    return every.select("conv_id").join(whole, "conv_id", "left").select("conv_id", F.coalesce("path", F.lit(b"")).alias("path"))


_SQL = """
WITH said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, t) - 1 AS k, md5(length(r) || ':' || r || t) AS id,
         strlen(t) AS size FROM said
), convs AS (
  SELECT c, xor(list_reduce(
    list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(a, b)), 4294967295
  ), 4294967295) % 9 AS h FROM (SELECT DISTINCT c FROM said)
), rebuilt AS (
  SELECT v.c, t.k, t.id, t.size FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.k < v.h
  UNION ALL SELECT v.c, t.k + 8, t.id, t.size FROM convs v JOIN turns t ON t.c = v.c AND t.k >= v.h
), numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, id, size FROM rebuilt
), prefixes AS (
  SELECT c, d, size, md5(string_agg(id, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs
), ended AS (
  SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM prefixes
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends FROM ended GROUP BY node, d
), lines AS (
  SELECT DISTINCT b.node AS above, a.node, a.d - b.d AS steps FROM prefixes a JOIN prefixes b ON b.c = a.c AND b.d <= a.d
), children AS (
  SELECT above AS node, count(*) AS n FROM lines WHERE steps = 1 GROUP BY above
), sums AS (
  SELECT l.above AS node, sum((n.n - 1) * n.size) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM lines l JOIN nodes n ON n.node = l.node LEFT JOIN children c ON c.node = l.node GROUP BY l.above
), parents AS (
  SELECT l.node, n.conv_id FROM lines l JOIN nodes n ON n.node = l.above WHERE l.steps = 1
)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN parents p ON p.node = n.node
"""


@query(_SQL)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    numbered = turns(table(spark, folder, "conversations"))
    path = scratch_path(spark, "turns")
    numbered.write.parquet(path)
    rows = scratch_path(spark, "paths")
    rebuilt(spark.read.parquet(path)).write.parquet(rows)
    return build(spark.read.parquet(rows))
