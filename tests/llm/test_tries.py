"""The prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import parity
import pytest
from llm.conftest import ordered
from tallybook.llm import checks, registry, tries

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def plain(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    if rebuild:
        whole = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            base = int(c / 100) * 100
            whole[c] = own.get(base, [])[:h] + turns[h:]
        own = whole
    members = defaultdict(list)
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    sha([c for c in m if len(own[c]) == len(p)])) for p, m in members.items()], key=repr)


def odd_rows():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é\U0001f600", "ccc" * 50]))
            for c in range(250) for t in range(rng.choice([1, 1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", f"copied {t}") for c in range(1000, 1090) for t in range(8)]  # a group of copies
    rows += [(c, t, "user", f"copied {t}") for c in range(1090, 1099) for t in range(3, 19)]
    rows += [(2000, t, "user", f"only here {t}") for t in range(300)]  # a third of all turns
    rows += [(-150, 0, "user", "x"), (-100, 0, "user", "y"), (-150, 3, None, "z"), (3001, 0, "user", "x"), (3007, None, "user", "null"),
             (3007, None, "user", "second"), (3007, 1, "user", "a"), (3007, 1, "user", "a"), (None, 0, "user", "no id"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("segment,cells", [(256, 1 << 22), (256, 60), (3, 1 << 22), (2, 40), (5, 9)])
def test_brute_force(many_parts, monkeypatch, segment, cells):
    monkeypatch.setattr(tries, "CELLS", cells)
    monkeypatch.setattr(tries, "IDS_AT_ONCE", 4)
    rows = odd_rows()
    df = many_parts.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    assert ordered(tries.rebuilt_trie(df, segment=segment)) == plain(rows)
    if segment != 2:
        assert ordered(tries.shared_trie(df, segment=segment)) == plain(rows, rebuild=False)


def test_small_tables(spark):
    df = spark.createDataFrame([(7, 0, "user", "hi", "x")], SCHEMA)
    assert ordered(tries.rebuilt_trie(df)) == plain([(7, 0, "user", "hi")])
    assert tries.rebuilt_trie(df.limit(0)).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "hi", "x")], SCHEMA)
    assert tries.rebuilt_trie(lost).count() == 0


def test_sql(spark, tiny, data):
    for folder in (tiny, data):
        df = registry.op13_conversation_trie(spark, folder)
        assert not parity.differences(df, parity.connect(folder), checks.conversation_trie())
        rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
        assert ordered(df) == plain(map(tuple, rows))
