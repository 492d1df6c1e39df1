"""Exact dedup (7) and SimHash near-dedup (1)."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitchline.llm import common, exact_dedup, queries, simhash

SCHEMA = "doc_id long, text string, keep_id string, fp long, norm string"
ODD = [(1, "a  b\tc", "x", 1, "n"), (2, "a b c", None, None, None), (2, "a b c", "x", 2, "n"), (3, None, "x", 3, "n"),
       (4, "", "x", 4, "n"), (None, "a b c", "x", 5, "n"), (None, "lonely", "x", 6, "n"), (7, " \n ", "x", 7, "n")]


def brute_exact(rows):
    groups = {}
    for i, t, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups.setdefault(norm, []).append(i)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_odd_rows_and_hash_collisions(spark, weak):
    df = spark.createDataFrame(ODD, SCHEMA)
    kwargs = {"content_hash": lambda t: F.unhex(F.lit("00"))} if weak else {}  # every text collides
    got = exact_dedup.exact_dedup(df, **kwargs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_exact(ODD)


def test_exact_dedup_empty_table(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_first_keeps_columns_and_other_texts_of_a_repeated_id(spark):
    rows = [(1, "a", "x", 1, "n"), (2, "a", "x", 1, "n"), (2, "b", "x", 1, "n")]
    got = exact_dedup.keep_first(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "keep_id", "fp", "norm"]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "a"), (2, "b")]


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    ids = sorted({i for i, _ in pairs})
    label = {i: i for i in ids}
    prints = dict(pairs)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", ["", " \n", "one", "One TWO three", "a b c d", "É é A a É é A a x", "w " * 70_000 + "end",
                                  " ".join(map(str, range(3000)))])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def test_fingerprint_hash_is_the_engines_xxhash64(spark):
    h = spark.sql("SELECT xxhash64('a b c d')").first()[0]
    assert xxhash.xxh64_intdigest(b"a b c d", 42) == h % (1 << 64)


def test_bk_tree_search_equals_a_scan():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for b in base for _ in range(8)})
    tree = simhash.BKTree(np.array(values, np.uint64))
    q, n = tree.within(np.array(values, np.uint64), 4)
    found = {(a, b) for a, b in zip(q.tolist(), n.tolist())}
    assert found == {(a, b) for a in range(len(values)) for b in range(len(values))
                     if (values[a] ^ values[b]).bit_count() <= 4}


@pytest.mark.parametrize("blocks,chunk", [(5, 1024), (6, 3), (7, 1)])
def test_links_and_components_over_chunks(spark, blocks, chunk):
    """A dense cluster, chains over 4-bit steps and strangers; hot shards are cut into tiny chunks."""
    rng = random.Random(blocks)
    centre = rng.getrandbits(64)
    values = {centre ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8)} | {rng.getrandbits(64) for _ in range(30)}
    step = rng.getrandbits(64)
    for k in range(0, 60, 4):
        step ^= 0b1111 << k
        values.add(step)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = simhash.components(simhash.links(df, 4, blocks, chunk)).collect()
    label = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    groups, expect = {}, {}
    for v, c in brute_components([(v, v) for v in values]).items():
        expect.setdefault(c, set()).add(v)
        groups.setdefault(label.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_near_dedup_odd_rows(spark):
    got = simhash.near_dedup(spark.createDataFrame(ODD, SCHEMA)).collect()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    abc, zero = f"{brute_fingerprint('a b c'):016x}", "0" * 16
    assert len(got) == len(ODD) and by[2, abc] == by[1, abc] == by[None, abc] == 1
    assert by[3, zero] == by[4, zero] == by[7, zero] == 3
    assert by[None, f"{brute_fingerprint('lonely'):016x}"] is None
    assert simhash.near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_one(spark):
    kept = simhash.keep_one(spark.createDataFrame(ODD, SCHEMA))
    assert kept.columns == ["doc_id", "text", "keep_id", "fp", "norm"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, None, None], key=repr)


def test_op1_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in common.table(spark, sf_dir, "documents").collect()}
    prints = {i: brute_fingerprint(t) for i, t in docs.items()}
    label = brute_components(list(prints.items()))
    got = queries.QUERIES["op1_simhash_near_dedup"](spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{p:016x}", label[i]) for i, p in prints.items()}
    assert len(got) == len(docs)
