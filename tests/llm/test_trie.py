"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from shopflow.llm import trie


def brute(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            talks[conv].append(((turn is not None, turn or 0, key), role, text))
    talks = {c: [(r, t) for _, r, t in sorted(own, key=lambda x: x[0])] for c, own in talks.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole = tuple(talks.get(base, [])[:h] + own[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, own in members.items())


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def hard_rows():
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(6)]  # all equal
    rows += [(100 + c, t, "user" if t % 2 else "bot", f"turn {t}" if t < c else f"own {c} {t}")
             for c in range(30) for t in range(8)]
    rows += [(200 + c, t, "user", f"step {t}") for c in range(30) for t in range(c)]  # each a beginning of the next
    rows += [(None, 1, "user", "lost"), (301, None, None, None), (302, 1, "é", "größe 漢字"), (302, 1, "é", "größe 漢字"),
             (303, 2, "a", "bc"), (304, 2, "ab", "c"), (-7, 1, "x", "negative"), (-5, 1, "x", "base"),
             (306, 3, "late", ""), (306, None, "early", "x" * 5000), (308, 5, "a", "tie"), (308, 5, "b", "tie")]
    return rows


@pytest.mark.parametrize("container_turns", [2, 9, 60, 4096])
def test_against_plain_prefixes(spark, container_turns):
    rows = hard_rows()
    df = spark.createDataFrame([(*r, 1, "y") for r in rows],
                               "conv_id long, turn long, role string, text string, depth int, path string")
    assert rows_of(trie.prefix_trie(df, container_turns=container_turns)) == brute(rows)


def test_containers_hold_no_more_than_they_may(spark):
    df = spark.createDataFrame(hard_rows(), "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F

    rebuilt = trie.rebuild(df).withColumn("n", F.lit(1)).dropDuplicates(["ids"])
    contained, ended = trie.burst(rebuilt, 20)
    loads = contained.groupBy(F.element_at("path", -1)).agg(
        F.sum(F.greatest(F.size("ids") - F.col("depth"), F.lit(1)))).collect()
    assert len(loads) > 5 and max(r[1] for r in loads) <= 20
    assert contained.count() + sum(e.count() for e in ended) == rebuilt.count()


def test_empty_and_turnless(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(df).count() == 0
    lone = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 6, 7)]  # without a base, early turns go
    assert rows_of(trie.prefix_trie(spark.createDataFrame(lone, df.schema), container_turns=1)) == brute(lone)
