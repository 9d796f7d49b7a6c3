"""Exact dedup against SQL and plain grouping."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

from compare import compare, oracle
from pyspark.sql import functions as F

from tallyloom.llm import owners as module
from tallyloom.llm.oracle import ORACLES
from tallyloom.llm.owners import Trie, common_length, owners
from tallyloom.llm.queries import QUERIES


def plain(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((doc, text or ""))
    out = Counter()
    for body, members in groups.items():
        members.sort(key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for place, (doc, _) in enumerate(members):
            out[doc, members[0][0], len(members), place == 0, sha256(body.encode()).hexdigest()] += 1
    return out


def bag(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect())


def test_query_equals_sql(spark, sf_dir):
    count, problems = compare(QUERIES["op12_exact_dedup"](spark, sf_dir), oracle(sf_dir), ORACLES["op12_exact_dedup"])
    assert not problems
    assert count == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def odd_rows():
    rng = random.Random(2)
    rows = [(k, "hot  copy\n" if k % 3 else "hot copy") for k in range(900)]
    rows += [(k, f"text {rng.randint(0, 400)}") for k in range(1000, 2200)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n\x0b\x0c\r"), (3003, "  "), (None, "hot copy"), (None, None), (None, "lone")]
    rows += [(4000, "é à"), (4001, "éà"), (4002, "é à"), (5, "hot copy"), (5, "hot copy"), (5000, " "), (5001, " ")]
    return rows + [(6000, "ab " * 400_000), (6001, "ab" * 400_000), (6002, "ab" * 400_000 + "c"), (6003, "ab " * 400_000)]


def test_odd_rows_equal_plain_groups(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("doc", "length", "hash", "part", "hot", "keep_id", "kept")})
    assert bag(owners(frame)) == plain(rows)
    assert owners(frame.limit(0)).count() == 0


def test_hot_texts_are_dealt_to_parts(spark, monkeypatch):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for share in (1, 7, 50):
        monkeypatch.setattr(module, "SHARE", share)
        assert bag(owners(frame)) == plain(rows)
    monkeypatch.setattr(module, "SHARE", 50)
    hot = module._hot_keys(frame.select("text")).collect()
    assert 1 <= len(hot) <= 100 and max(r.parts for r in hot) > 10


def test_kept_texts(spark):
    frame = spark.createDataFrame([(2, "a b"), (1, "ab"), (3, None), (4, "a b")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in owners(frame, with_text=True).collect()}
    assert got == {1: None, 2: "a b", 3: "", 4: None}


def test_trie_keeps_every_text_apart():
    rng = random.Random(4)
    words = {bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 7))) for _ in range(500)}
    trie, nodes = Trie(), {}
    for word in [*words, *words]:
        node = trie.end_of(word)
        node.end = node.end or module.End(word)
        nodes.setdefault(word, node.end)
        assert nodes[word] is node.end
    assert [e.name for e in trie.ends()] == sorted(words)
    assert common_length(b"abcd", b"abxd") == 2 and common_length(b"", b"a") == 0 and common_length(b"aa", b"aa") == 2
