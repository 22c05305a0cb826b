import hashlib
import random
import re
import zlib

import duckdb
import pytest

from dayfold.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def brute(sequences):
    """Nodes of a trie from all prefixes of {conv: [(role, text), ...]}."""
    nodes = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below), len(childless), saved,
            sha(c for c in members if len(sequences[c]) == len(path))))
    return sorted(out, key=repr)


def rebuild(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def shown(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def made(seed, n=60, turns=5, words=3):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-30, 300), n):
        for turn in range(rng.randrange(turns)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(words)))))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 16])
def test_brute_force_over_blocks_and_partitions(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = made(block)
    assert shown(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rebuild(rows))


def test_blocks_of_any_size_give_the_same_sums():
    rng = random.Random(5)
    for _ in range(40):
        convs = {}
        for c in rng.sample(range(1000), rng.randrange(1, 25)):
            convs[c] = [("u", rng.choice(["a", "b b", ""])) for _ in range(rng.randrange(5))]
        rows = sorted(
            (b"".join(hashlib.md5(repr(t).encode()).digest() for t in turns), c, [len(WORD.findall(t[1])) for t in turns])
            for c, turns in convs.items())
        size = rng.randrange(1, 8)
        total = {}
        last = None
        for low in range(0, len(rows), size):
            own = rows[low : low + size]
            flat = [w for _, _, ws in own for w in ws]
            first = [0]
            for _, _, ws in own:
                first.append(first[-1] + len(ws))
            np = prefix_trie.np
            block = prefix_trie.Block(np.array([c for _, c, _ in own]), [p for p, _, _ in own], np.array(flat, dtype=np.int64), np.array(first))
            batches = list(block.nodes())
            if last:
                batches.append(prefix_trie.border(last[0], np.array(last[2], dtype=np.int64), own[0][0]))
            last = own[-1]
            for i, row in enumerate(r for b in batches for r in b.to_pylist() if r["kind"] in (prefix_trie.NODE, prefix_trie.PART)):
                key = row["key"] or (low, i)
                sums = total.setdefault(key, [0] * 4 + [row["depth"]])
                for k, c in enumerate(("n_convs", "n_children", "n_leaves", "saved")):
                    sums[k] += row[c]
        assert sorted(tuple(s) for s in total.values()) == sorted((r[3], r[4], r[5], r[6], r[1]) for r in brute(convs))


def test_nulls_ties_repeated_rows_and_other_columns(spark):
    rows = [
        (0, None, None, "first of all"), (0, 1, "user", None), (0, 1, "user", None), (0, 1, "assistant", "x y"),
        (7, 0, "user", "a"), (7, 0, "user", "b"), (7, 0, "user", "b"), (None, 1, "user", "nobody"), (40, 2, "", ""),
        (41, None, "user", "w " * 5000), (42, 0, "user", "w " * 5000), (59, 0, "user", "w " * 5000), (61, 0, "user", "none left"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS path", "'k' AS key", "2 AS depth", "'p' AS words")
    assert shown(prefix_trie.conversation_trie(df)) == brute(rebuild(rows))


def test_empty_table_and_conversations_without_turns(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 4 >= 1][:4]
    rows = [(c, 0, "user", "gone") for c in lone]
    assert shown(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == [
        (min(lone), 0, None, 4, 0, 1, 0, sha(lone))]


def test_many_equal_conversations_are_split(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 4000, 20) for t in range(3)] + made(3)
    assert shown(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rebuild(rows))


def test_query_equals_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    ours = shown(queries.QUERIES["op11_prefix_trie"](spark, sf))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ours == brute(rebuild(rows))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    theirs = connection.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.SQL['op11_prefix_trie']})").fetchall()
    assert ours == sorted(theirs, key=repr)
