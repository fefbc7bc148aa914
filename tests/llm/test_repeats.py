import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lotwise.llm import repeats as R
from lotwise.llm.suffixes import BlindTrie, deep_shallow
from tests.compare import difference
from tests.llm import brute

SCHEMA = "doc_id long, text string, id long, start long, place long"


def frame_of(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(6)


def agree(spark, texts, ids=None, **method):
    ids = ids or list(range(len(texts)))
    expected = sorted(
        ((str(i), n, gone, runs, hashlib.sha256(kept).hexdigest(), kept)
         for i, (n, gone, runs, kept) in zip(ids, brute.repeated_strings(texts, method.get("width", 200)), strict=True))
    )
    rows = R.removed(frame_of(spark, texts, ids), **method).collect()
    found = sorted((str(r[0]), *r[1:5], bytes(r["kept"])) for r in rows)
    assert found == expected
    return expected


def test_strings_are_sorted_and_told_apart():
    rng = random.Random(1)
    for width in (8, 24, 100):
        data = b"".join(rng.choice([b"ab", b"abc", b"\0\0", b"x" * 30]) for _ in range(400))
        starts = np.array([rng.randrange(len(data) - width) for _ in range(500)])
        groups = np.array([rng.randrange(3) for _ in range(500)])
        order, number = deep_shallow(data, starts, groups, width)
        keys = [(g, data[s : s + width]) for s, g in zip(starts.tolist(), groups.tolist(), strict=True)]
        assert sorted(order.tolist()) == list(range(500))
        assert [keys[i] for i in order] == sorted(keys)
        by_key = {}
        for k, n in zip(keys, number.tolist(), strict=True):
            by_key.setdefault(k, set()).add(n)
        assert all(len(v) == 1 for v in by_key.values())
        assert len({n for v in by_key.values() for n in v}) == len(by_key)


def test_blind_trie_orders_strings():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(300)]
    trie = BlindTrie(9)
    for i, t in enumerate(texts):
        trie.add(t, i)
    classes = list(trie.classes())
    assert [texts[c[0]] for c in classes] == sorted(set(texts))
    assert all(len({texts[i] for i in c}) == 1 for c in classes) and sum(map(len, classes)) == 300


@pytest.mark.parametrize("crowded", [1 << 12, 2])
def test_short_windows_by_brute_force(spark, frame, crowded):
    """Many borders: strings of 24 bytes over few letters, in mutated copies."""
    rng = random.Random(3)
    base = "".join(rng.choice("abcd é") for _ in range(600))
    texts = []
    for _ in range(60):
        a, b = sorted((rng.randrange(600), rng.randrange(600)))
        own = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
        part = list(base[a:b])
        for _ in range(rng.randrange(4)):
            if part:
                part[rng.randrange(len(part))] = "#"
        texts.append(own[:20] + "".join(part) + own[20:])
    texts += [None, "", "a", "ab" * 40, "z" * 24, "z" * 23, "q" * 25, base[:24] + "1", "2" + base[:24] + "3"]
    agree(spark, texts, width=24, anchor=8, cell=5, crowded=crowded)


def test_whole_width_with_odd_rows(spark, frame, texts):
    rng = random.Random(4)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(40))
    line = "x" * 199
    more = [f"head {i} {passage} tail {i * 7}" for i in range(50)]
    more += [f"{i} {line}{i}" for i in range(20)] + [f"{i:04d}" + "y" * 198 + f"{i:04d}" for i in range(9)]
    more += ["é" * 150, "é" * 150 + "!", "u" * 5000, None, ""]
    rows = [*texts.values(), *more]
    ids = [*texts.keys(), *[i % 30 for i in range(len(more) - 2)], None, None]
    # repeated rows, one without an id
    rows += ["r" * 210 + str(9**50)] * 3 + ["s" + str(7**300)] * 2
    ids += [7, 7, 7, None, None]
    agree(spark, rows, ids)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(rows, pa.string())}))
    assert difference(R.report(frame_of(spark, rows, ids)), con, R.SQL) is None


def test_empty_table(spark, frame):
    assert R.report(frame_of(spark, ["a"]).limit(0)).count() == 0


def test_a_million_equal_characters(spark, frame):
    (row,) = R.report(frame_of(spark, ["w" * 1_000_000])).collect()
    assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (1_000_000, 1_000_000, 1)


def test_query_by_brute_force(spark, sf_dir):
    from lotwise.llm.catalog import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [r["text"] for r in rows]
    data = [(t or "").encode() for t in texts]
    # counted by hash, to fit the memory
    seen, twice = set(), set()
    for d in data:
        for i in range(len(d) - 199):
            h = hash(d[i : i + 200])
            (twice if h in seen else seen).add(h)
    expected = {}
    for r, d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - 199):
            if hash(d[i : i + 200]) in twice:
                gone[i] += 1
                gone[i + 200] -= 1
        mask = np.cumsum(gone)[: len(d)] > 0
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1).sum())
        expected[r["doc_id"]] = (len(d), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest())
    found = QUERIES["op12_repeated_strings"](spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r[1:5]) for r in found} == expected
