import itertools
import random

import pytest

from lotwise.llm import conversations as C
from lotwise.llm.prefixes import Prefixes
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, cost long, part int"


def by_conversation(rows):
    out = {}
    for row in brute.damage(rows):
        out.setdefault(row[0], []).extend([row[1:]] if len(row) > 1 else [])
    return {conv: brute.conversation(own) for conv, own in out.items()}


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def exhaustive(codes, longest):
    """Least (cost, script) over all scripts with at most three inserts in a row."""
    best = None
    gaps = ["", "I", "II"]
    for ops in itertools.product(*[("D",) if c % 3 == C.FORCED else ("K", "R", "D") for c in codes]):
        for inserts in itertools.product(gaps, repeat=len(codes) + 1):
            script = "".join(i + o for i, o in zip(inserts, [*ops, ""], strict=True))
            cost, state, at, good = 0, 0, 0, True
            for letter in script:
                expected = {0: "u", 1: "u", 2: "a", 3: "u"}[state]
                if letter == "D":
                    cost, at = cost + 4, at + 1
                    continue
                if letter == "K":
                    kind = "sua?"[codes[at] // 3]
                    cost += 3 * (codes[at] % 3)
                    at += 1
                    if kind == "s" and state == 0:
                        state = 1
                        continue
                    if kind != expected:
                        good = False
                        break
                elif letter == "R":
                    cost += 3 + 3 * (codes[at] % 3)
                    at += 1
                else:
                    cost += 3
                state = 2 if expected == "u" else 3
            if good and state in (0, 3) and (best is None or (cost, script) < best):
                best = (cost, script)
    return best


def test_scripts_equal_all_scripts_tried():
    scripts = C.Scripts()
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            assert scripts(bytes(codes)) == exhaustive(codes, n), codes


def test_chunks_give_what_one_run_gives(monkeypatch):
    rng = random.Random(5)
    for n in (1, 2, 5, 17, 60):
        for _ in range(30):
            codes = bytes(rng.choice([3, 6, 6, 3, 0, 9, 4, 7, 8]) for _ in range(n))
            whole = C.Scripts()(codes)
            for size in (1, 2, 3, 7):
                monkeypatch.setattr(C, "ROWS_PER_CHUNK", size)
                assert C.Scripts()(codes) == whole
            monkeypatch.setattr(C, "ROWS_PER_CHUNK", 1024)


def test_products_associate():
    import numpy as np

    rng = random.Random(6)
    for _ in range(30):
        runs = [bytes(rng.randrange(12) for _ in range(rng.randrange(1, 6))) for _ in range(4)]
        costs, ranks = (np.array(x) for x in zip(*map(C.summary, runs), strict=True))
        left = C.product(costs[:2], ranks[:2])
        right = C.product(costs[2:], ranks[2:])
        halves = C.product(*(np.array([a, b]) for a, b in zip(left, right, strict=True)))
        assert halves == C.product(costs, ranks) == C.summary(b"".join(runs))


@pytest.mark.parametrize("colliding", [False, True])
def test_scripts_compare_as_strings(monkeypatch, colliding):
    if colliding:  # every hash alike: what is left is the verification
        monkeypatch.setattr("lotwise.llm.prefixes.MODULUS", 1)
    rng = random.Random(7)
    trie, texts = Prefixes(), [""]
    for _ in range(300):
        parent = rng.randrange(len(texts))
        letter = rng.choice("DK")
        trie.push(parent, ord(letter))
        texts.append(texts[parent] + letter)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert trie.less(a, b) == (texts[a] < texts[b])
        assert bytes(trie.letters(a)).decode() == texts[a]


def test_conversations_by_brute_force(spark, frame):
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s"]
    texts = ["Fine.", "Fine.", "cut off", "", " \n", None, "Ends! ", "é.\t", "word " * 50_000]
    rows = []
    for conv in [*range(200), None]:
        for turn in range(rng.randrange(9)):
            turn = rng.choice([turn, turn, turn + 3, None, 0])
            row = (conv, turn, rng.choice(roles), rng.choice(texts[:-1] if rng.random() < 0.99 else texts), 1, 2)
            rows += [row] * rng.choice([1, 1, 1, 2])
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", rng.choice(["A thing.", f"Own {t}.", "cut"]), 1, 2) for t in range(6000)]
    rows += [(501, None, "user", "The same.", 1, 2)] * 5000
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert results(C.report(df)) == by_conversation([r[:4] for r in rows])


def test_only_dropped_rows_and_no_rows(spark, frame):
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.", 1, 1)], SCHEMA)
    expected = by_conversation([(gone, 0, "user", "Hello.")])
    assert results(C.report(df)) == expected and expected[gone][:7] == (0, 0, 0, 0, 0, 0, "")
    assert C.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_by_brute_force(spark, sf_dir):
    from lotwise.llm.catalog import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert results(QUERIES["op11_conversation_repair"](spark, sf_dir)) == by_conversation(rows)
