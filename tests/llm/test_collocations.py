import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lotwise.llm import automata
from lotwise.llm import collocations as P
from lotwise.llm.automata import Counts
from tests.compare import difference


def shard(texts, langs=None):
    langs = langs or ["en"] * len(texts)
    return P.counted(pa.array(langs, pa.large_string()), pa.array(texts, pa.large_string()))


def as_dict(counts, least=1):
    tags, words = counts.tags.to_pylist(), counts.words.to_pylist()
    out = {}
    for columns, weights in counts.grams(least):
        for (tag, *rest), weight in zip(zip(*(c.tolist() for c in columns), strict=True), weights.tolist(), strict=True):
            out[(tags[tag], *(words[i] for i in rest))] = weight
    return out


def plain(texts, langs):
    out = {}
    for text, lang in zip(texts, langs, strict=True):
        for piece in P_SPLIT(text or ""):
            words = [w.encode() for w in piece.replace("\t", " ").split(" ") if w]
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    key = ((lang or "und").encode(), *words[i : i + n])
                    out[key] = out.get(key, 0) + 1
    return out


def P_SPLIT(text):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.split("[.,;:!?\n-\r]", text.translate(lower))


@pytest.fixture(scope="module")
def some_texts():
    rng = random.Random(3)
    words = ["a", "B", "é", "É", "cc", "the", "x y", "\x00", "long" * 200]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ",", "\t", "\n"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    return [*texts, None, "", " \t", "..."], [rng.choice(["en", "de", None]) for _ in range(84)]


def test_shards_count_all_ngrams(some_texts):
    assert as_dict(shard(*some_texts)) == plain(*some_texts)


def test_automata_survive_packing_and_union(some_texts):
    texts, langs = some_texts
    whole = shard(texts, langs)
    assert as_dict(Counts.unpacked(whole.packed())) == as_dict(whole)
    parts = [Counts.unpacked(shard(texts[i : i + 9], langs[i : i + 9]).packed()) for i in range(0, len(texts), 9)]
    running = parts[0]
    for part in parts[1:]:
        running = Counts.union([running, part])
    assert as_dict(running) == as_dict(whole) == as_dict(Counts.union(parts))
    assert as_dict(whole.kept(3)) == {k: v for k, v in as_dict(whole).items() if v >= 3}


def test_ranges_cut_every_ngram_once(some_texts):
    whole = shard(*some_texts)
    found = {}
    for _, part in P.cut(whole, whole.grams(), 7):
        own = as_dict(part)
        assert not set(own) & set(found)
        found |= own
    assert found == as_dict(whole)


def test_composition_gives_weights_in_order(some_texts):
    whole = shard(*some_texts)
    asked = shard(["the a b the the unheard", "cc cc cc é"], ["en", "de"])
    known = as_dict(whole)
    for depth, found in enumerate(whole.composed(asked)[1:], 1):
        named = zip(*(c.tolist() for c in asked.columns(depth)), strict=True)
        keys = [(asked.tags[t].as_py(), *(asked.words[i].as_py() for i in rest)) for t, *rest in named]
        assert found.tolist() == [known.get(k, 0) for k in keys]


def test_states_are_shared_and_collisions_are_not(monkeypatch):
    counts = np.array([2, 1, 2, 0, 1])
    symbols, weights = np.array([1, 2, 5, 1, 2, 5]), np.array([1, 1, 3, 1, 1, 3])
    kind, first = automata.registered(counts, [symbols, weights])
    assert kind[0] == kind[2] and kind[1] == kind[4] and len(first) == 3
    monkeypatch.setattr(automata, "mix", lambda x: x * np.uint64(0))
    kind, _ = automata.registered(counts, [symbols, weights])
    assert len(set(kind.tolist())) == 5


def agree(documents, expect):
    con = duckdb.connect()
    rows = pa.table({"lang": [r["lang"] for r in expect], "text": [r["text"] for r in expect]})
    con.register("documents", rows.cast(pa.schema([("lang", pa.string()), ("text", pa.string())])))
    assert difference(P.collocations(documents), con, P.SQL) is None


def test_phrases_of_odd_texts(spark, frame):
    rng = random.Random(4)
    words = ["New", "york", "city", "of", "the", "a", "ünder", "\x0b", "x"]
    schema = "doc_id long, text string, lang string, a long, score long, phrase string"
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(150)]
    texts += [None, "", " ", "new york city, new york. of the", "same words " * 20_000] + ["Same text here"] * 30
    rows = [(i % 20, t, rng.choice(["en", "de", None, "", "und"]), 1, 2, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, schema).repartition(5)
    agree(df, df.collect())
    empty = spark.createDataFrame([], schema)
    assert P.collocations(empty).count() == 0
    only_null = spark.createDataFrame([(None, None, None, 1, 1, "")], schema)
    assert P.collocations(only_null).count() == 0


def test_limit_and_ties(spark, frame):
    rows = [(1, " ".join([w, w + "x"]), "en") for w in "abcdef" for _ in range(10 + (w == "f"))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    best = P.collocations(df, most=3).orderBy("rank").collect()
    assert [(r["rank"], r["phrase"], r["score"]) for r in best] == [(1, "f fx", 1000000), (2, "a ax", 1000000), (3, "b bx", 1000000)]
