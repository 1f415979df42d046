"""The prefix trie against plain Python, with containers of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lateralis.llm import prefix_trie
from lateralis.llm.registry import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, key string, path string, depth int"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", 1) for r in rows], SCHEMA)


def in_order(rows):
    """The turns of each conversation, in the order that the operator defines."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn, role or "", text or ""))

    def place(t):
        record = hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest() + len(t[2].encode()).to_bytes(8, "big")
        return t[0] is not None, t[0] or 0, record

    return {c: [(r, t) for _, r, t in sorted(ts, key=place)] for c, ts in by.items()}


def rebuilt(rows):
    own = in_order(rows)
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(donor, [])[:h] + own[c][h:]
    return out


def brute(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((
            min(of), len(node), parent, len(of), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()
        ))
    return out


def rows_of(seed):
    r = random.Random(seed)
    said = ["", None, "héllo wörld", "a", "b b", "c" * 300]
    rows = [(None, 0, "user", "no id"), (None, 1, "user", "no id"), (7, 0, None, None), (-3, 0, "user", "minus"), (-3, 1, "x", "y")]
    rows += [(11, None, "user", "null first"), (11, None, "user", "null too"), (11, 5, "user", "tie"), (11, 5, "user", "tie"), (11, 5, "ab", "c"), (11, 5, "a", "bc")]
    for c in range(20, 140):
        for t in range(r.randint(1, 12)):
            rows.append((c, t, r.choice(["user", "assistant", None]) if t > 1 else "user", r.choice(said) if t > 1 else "hi"))
    for c in range(200, 300):  # copies of one conversation, a third of all rows
        rows += [(c, t, "user", f"copy {t}") for t in range(9, 0, -1)]
    for c in range(400, 430):  # a long shared beginning
        rows += [(c, t, "user", f"shared {t}") for t in range(40)] + [(c, 40, "user", f"own {c % 7}"), (c, 41, "user", "end")]
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


@pytest.mark.parametrize("most", [1, 3, 20, 10_000])
def test_trie_of_conversations(spark, most):
    rows = rows_of(3)
    got = prefix_trie.prefix_trie(table_of(spark, rows), most_suffixes=most)
    assert ordered(map(tuple, got.collect())) == ordered(brute(in_order(rows)))


def test_container_bound_in_bytes(spark):
    rows = rows_of(5)
    got = prefix_trie.prefix_trie(table_of(spark, rows), most_bytes=2_000)
    assert ordered(map(tuple, got.collect())) == ordered(brute(in_order(rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_query_on_rebuilt_conversations(spark, write, seed):
    rows = rows_of(seed)
    got = QUERIES["op13_prefix_trie"](spark, write(conversations=table_of(spark, rows)))
    expected = brute(rebuilt(rows))
    assert ordered(map(tuple, got.collect())) == ordered(expected)
    assert any(n == 1 for _, n, *_ in expected) and any(not p for p in rebuilt(rows).values())


def test_no_conversation(spark, write):
    empty = table_of(spark, [])
    assert QUERIES["op13_prefix_trie"](spark, write(conversations=empty)).count() == 0
    assert prefix_trie.prefix_trie(table_of(spark, [(None, 1, "user", "x")])).count() == 0
    assert prefix_trie.prefix_trie(table_of(spark, [(4, 1, "user", "é")])).count() == 2


def test_many_members_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 64)  # ids of a node in many pieces
    rows = [(c, 0, "user", "same") for c in range(1, 400)]
    got = ordered(map(tuple, prefix_trie.prefix_trie(table_of(spark, rows)).collect()))
    assert got == ordered(brute(in_order(rows)))
