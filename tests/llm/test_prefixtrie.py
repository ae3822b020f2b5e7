"""The prefix trie against brute force, with shards of few turns."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sheafwork.llm import prefixtrie
from sheafwork.llm.jobs import prepare

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, KEY int, turns int"


def _rebuilt(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            conv[c].append((t is not None, t or 0, r, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), x))
    conv = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in conv.items()}
    out = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conv.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def _nodes(built):
    members, children, out = defaultdict(list), defaultdict(list), {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    for key in sorted(members, key=len, reverse=True):
        m, below = members[key], [out[k] for k in children[key]]
        ends = sorted(c for c in m if len(built[c]) == len(key))
        out[key] = (
            min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(below), sum(n[5] for n in below) if below else 1,
            (len(m) - 1) * (len(key[-1][1].encode()) if key else 0) + sum(n[6] for n in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values(), key=repr)


def _rows():
    """Copies, one common first turn, turnless and very long conversations, nulls, repeated and tied turns."""
    rng, rows = random.Random(4), []
    for c in range(0, 300):
        n = rng.choice([0, 1, 2, 3, 5, 12])
        if c % 3 == 0:
            turns = [("user", "the common start"), ("bot", "é"), ("user", rng.choice("ab"))] + [("bot", "x" * rng.randrange(3))] * (n // 4)
        elif c % 7 == 0:
            turns = [("user", "copied"), ("bot", "whole")]
        else:
            turns = [(rng.choice(["user", "bot", None]), rng.choice(["", None, "a", "b" * 50])) for _ in range(n)]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    rows += [(c * 5 + 1000, 0, "user", "copied") for c in range(40)]
    rows += [(700, t, "user", f"turn {t % 11}") for t in range(900)] + [(701, t, "user", f"turn {t % 11}") for t in range(950)]
    rows += [(-3, None, "b", "x"), (-3, None, "a", "y"), (-3, 1, "a", "z"), (-3, 1, "a", "w"), (-3, 1, "a", "w"), (0, 0, "user", "zero")]
    rows += [(None, 1, "a", "no conversation"), (2**63 - 1, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    return prepare(spark).createDataFrame([(*r, "n", "d", 1, 2) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("least, most, piece", [(1 << 12, 1 << 19, 1 << 16), (1 << 12, 200, 3), (1 << 12, 30, 2)])
def test_trie(table, rows, monkeypatch, least, most, piece):
    for name, value in (("LEAST_TURNS", least), ("SHARD_TURNS", most), ("PIECE_IDS", piece)):
        monkeypatch.setattr(prefixtrie, name, value)
    got = prefixtrie.trie(prefixtrie.respliced(table))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == _nodes(_rebuilt(rows))


def test_whole_conversations(table, rows):
    """Without splicing, every conversation as it stands."""
    got = {r.conv: [(bytes(t.digest), t.bytes) for t in r.turns] for r in prefixtrie.conversations(table, prefixtrie.F.col("conv_id")).collect()}
    assert len(got) == len({r[0] for r in rows if r[0] is not None})
    assert [n for _, n in got[701]][:12] == [len(f"turn {t % 11}") for t in range(12)]


def test_close_matches_a_stack():
    rng = random.Random(1)
    for n in [1, 2, 7, 40, 500]:
        text, depth = [True], 1
        while depth:
            text.append(len(text) < n and rng.random() < 0.55)
            depth += 1 if text[-1] else -1
        stack, want = [], {}
        for i, opens in enumerate(text):
            if opens:
                stack.append(i)
            else:
                want[stack.pop()] = i
        at = np.array(sorted(want))
        assert prefixtrie.Parens(np.array(text)).close(at).tolist() == [want[i] for i in at.tolist()]


def test_deep_chain_closes():
    n = 5000
    parens = prefixtrie.Parens(np.repeat([True, False], n))
    assert parens.close(np.arange(n)).tolist() == list(range(2 * n - 1, n - 1, -1))


def test_empty(spark):
    none = prepare(spark).createDataFrame([], SCHEMA)
    assert prefixtrie.trie(prefixtrie.respliced(none)).count() == 0
