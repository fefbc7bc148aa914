"""Each dealt operator against a plain reading of its contract, with hard rows."""

import hashlib
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotwise.llm import (
    catalog,
    components,
    contamination,
    html_text,
    jaccard,
    licences,
    lines,
    packing,
    personal,
    quality,
    simple8b,
    token_files,
    tokens,
    urls,
)
from lotwise.llm.tokens import Encoder, public_path
from lotwise.session import durable
from tests.compare import connect, difference
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, sf_dir, name):
    assert difference(catalog.QUERIES[name](spark, sf_dir), connect(sf_dir), catalog.ORACLE[name]) is None


def test_quality(spark, frame, texts):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(frame(texts), labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute.base_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    none = quality.quality(frame(texts), labels.limit(0)).collect()
    assert all(r.kept != r.base_failed and r.score == 0 for r in none)
    assert quality.quality(frame({}), labels).count() == 0


def test_quality_counts_every_trusted_document(spark, frame):
    """With all documents labelled good, however many, target and raw are the same."""
    documents = frame({i: f"w{i % 50} and x{i % 7}" for i in range(21_000)})
    labels = spark.range(21_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert np.abs(quality.fit(documents, labels)).max() < 1e-9


def test_encoder_agrees_with_library():
    encode = Encoder(public_path())
    for text in ("Don't stop!!", "É à ß ÷", "a\x1cb\x85c", "<|endoftext|>x", "Σς İ 1²½", "it's''s", "中文 😀"):
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == want


def ids_of(texts):
    encode = Encoder(public_path())
    return {k: np.frombuffer(encode((t or "").encode()) + b"\x02\0\0\0", "<u4") for k, t in texts.items()}


def test_packing(frame, texts):
    want, pieces, sequences = ids_of(texts), {}, {}
    for r in packing.packed(frame(texts)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == want.keys()
    for doc, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            own = want[doc][r.start : r.start + r.length]
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(own.tobytes()), len(want[doc]))
            at += r.length
        assert at == len(want[doc])
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0
    assert packing.packed(frame({})).count() == 0


def test_packing_finds_relatives_in_the_whole_table(frame):
    """Documents of 8 subjects, dealt over all partitions, thousands of rows apart."""
    vocabulary = Encoder(public_path()).tokenizer.get_vocab()
    whole = sorted({w for w in (x.removesuffix("</w>") for x in vocabulary) if w.isascii() and w.isalpha() and len(w) > 5})
    draw = np.random.default_rng(3)
    words = draw.permutation(whole)[:3000].tolist()
    texts = {i: " ".join(draw.choice(words[800:], 12)) for i in range(4000)}
    subject = {i: i // 10 % 8 for i in range(0, 4000, 10)}
    texts |= {i: " ".join(draw.choice(words[100 * k : 100 * k + 100], 500)) for i, k in subject.items()}
    tokens, sequences = dict.fromkeys(range(8), 0), {}
    for r in packing.packed(frame(texts)).collect():
        sequences.setdefault(r.sequence_id, []).append((subject.get(r.doc_id), r.length))
        if r.doc_id in subject:
            tokens[subject[r.doc_id]] += r.length
    # no partition holds a window's worth of one subject, the table holds many
    for k in range(8):
        alone = [x for x in sequences.values() if {s for s, _ in x} == {k} and sum(n for _, n in x) == 4096]
        assert len(alone) >= tokens[k] // 4096 - 1 > 4


@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2**32, 2**60, 2**64 - 1])
@pytest.mark.parametrize("size", [0, 1, 239, 241, 4095, 4097, 20_000])
def test_simple8b(top, size):
    ids = np.random.default_rng(size).integers(0, top, size, dtype=np.uint64)
    assert (simple8b.decode(simple8b.encode(ids)) == ids).all()
    if size > 8192:
        assert (simple8b.decode(simple8b.encode(ids), 1, 2) == ids[4096:8192]).all()


def test_token_files(frame, texts):
    want, start = ids_of(texts), 0
    rows = {r.doc_id: r for r in token_files.round_trip(frame(texts)).collect()}
    for doc in sorted(want):
        r = rows[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want[doc]), zlib.crc32(want[doc].tobytes()))
        start += len(want[doc])
    assert token_files.round_trip(frame({})).count() == 0


@pytest.mark.parametrize("query_chars", [contamination.QUERY_CHARS, 300])
def test_contamination(spark, frame, texts, query_chars):
    items = {1: " ".join(f"w{i}" for i in range(20, 50)), 2: "One TWO", 3: None, 4: "", 5: "nowhere at all"}
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute.contamination(texts, items)
    found = contamination.search(contamination.build(frame(texts), 500), table, query_chars=query_chars)
    rows = {r.doc_id: r for r in found.collect()}
    assert rows.keys() == want.keys()
    for doc, (n_words, n_hit, own) in want.items():
        r = rows[doc]
        assert (r.n_words, r.n_hit, set(r["items"])) == (n_words, n_hit, set(map(str, own)))
    report = contamination.report(frame({1: "one two"}), table).first()
    assert report.items_sha256 == hashlib.sha256(b"2").hexdigest() and report.contaminated
    assert contamination.report(frame({}), table).count() == 0


def test_proximity(spark, frame):
    table = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    index = contamination.build(frame({1: "j i h g x f e d c b a", 2: "a b c d e f g h i"}))
    assert {r.doc_id: r.n_hit > 0 for r in contamination.search(index, table, slack=3).collect()} == {1: True, 2: False}
    assert all(not r.n_hit for r in contamination.search(index, table).collect())


@pytest.mark.parametrize("small", [True, False])
def test_jaccard(frame, texts, small, monkeypatch):
    if small:  # the paths for frequent tokens and large signatures
        for name, value in (("LEAST_FREQUENT", 3), ("SMALL", 2), ("BLOCK", 4)):
            monkeypatch.setattr(jaccard, name, value)
    want = brute.near_duplicates(texts)
    rows = jaccard.near_duplicates(frame(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    if small:
        assert jaccard.near_duplicates(frame({})).count() == 0


def test_jaccard_hands_on_no_table_of_all_pairs(frame, monkeypatch):
    """A group of sets of which each two are a little too unlike (0.72), and some copies of
    one that are near: what travels does not grow with the square of the group."""
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for d in range(120):
        own = list(words)
        for i in range(15, 400, 30):
            own[i] = f"x{d}y{i}"
        texts[d] = " ".join(own)
    texts |= {200 + i: texts[7].replace(f"w{5 + i * 40} ", f"z{i} ") for i in range(8)}
    rows = {}

    def counted(df, name):
        out = durable(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "durable", counted)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)  # all is left to the blocks
    monkeypatch.setattr(jaccard, "BLOCK", 50)
    found = jaccard.near_duplicates(frame(texts).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(texts)
    assert max(rows["pairs"]) <= 4 * len(texts)  # of 8,128


def test_components(spark):
    """Chains, hubs, rings; then links that join what was found and new nodes."""
    first = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(50, 51), (51, 52), (52, 50)]
    more = [(30, 139), (52, 200), (300, 301), (301, 299), (7, 7)]

    def plain(pairs):
        root = {x: x for p in pairs for x in p}
        for _ in root:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    def linked(pairs):
        return spark.createDataFrame(pairs, "a long, b long")

    roots = durable(components.components(linked(first)), "roots")
    assert {r.node: r.root for r in roots.collect()} == plain(first)
    out = components.extended(roots, linked(more)).collect()
    want = plain(first + more)
    assert len(out) == len({r.node for r in out})
    assert {r.node: r.root for r in out} == {k: v for k, v in want.items()}
    same = components.extended(roots, linked(more).limit(0)).collect()
    assert {r.node: r.root for r in same} == plain(first)


def test_lines(frame, texts):
    out = {r.doc_id: r for r in lines.report(frame(texts), sites=8).collect()}
    assert out.keys() == texts.keys()
    common = [d for d in range(60, 75) if out[d].text.startswith("a common line")]
    assert common == [60] and out[50].text is None and out[51].text == ""
    assert out[61].n_removed == 1 and out[61].text.startswith("own text")


def test_main_text():
    page = (
        "<body><div class='menu'>m</div><article><h1>T &eacute;</h1><p>one <i>two</i>\n three<p>"
        "four<br>five</article><div class=comments><p>no no no no no no no no no</div>"
    )
    assert html_text.main_text(page) == "T é one two three four five"
    assert [html_text.main_text(x) for x in (None, "", "<p>", "plain")] == ["", "", "", "plain"]
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"


def test_main_text_of_sections():
    """Titles, leads and every section stay, in an article or not; captions and names by parts."""
    words = lambda w, n: " ".join([w] * (n // (len(w) + 1)))
    lead, body = words("lead", 400), [words(f"own{i}", 400) for i in range(6)]
    section = lambda name, own: f"<section><h2>{name}</h2>" + "".join(f"<p>{x}</p>" for x in own) + "</section>"
    inner = f"<h1>the title of it all</h1><p>{lead}</p>" + section("first", body[:4]) + section("second", body[4:])
    want = " ".join(["the title of it all", lead, "first", *body[:4], "second", *body[4:]])
    menu = "<nav><a href=/>home</a></nav><ul>" + "<li><a href=/x>some link</a></li>" * 9 + "</ul>"
    for tag in ("article", "div", "div class=search-tips", "div id='comment-on-policy'"):
        page = f"<body>{menu}<{tag}>{inner}</{tag.split()[0]}><div class='ad-slot'>{lead}</div></body>"
        assert html_text.main_text(page) == want, tag
    figure = f"<body><article><p>{lead}</p><figure><img src=x><figcaption>what is seen</figcaption></figure></article>"
    assert html_text.main_text(figure) == f"{lead} what is seen"


def test_urls(spark):
    values = [None, "", "no host", "HTTP://A.Example.NET/en/x?q", "http://spam-farm.example.org/a/#x",
              "http://www.spam-farm.example.org/a", "https://x.org/fr/"]
    pages = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    rows = {r.page_id: r for r in urls.judge(pages, urls.listed(pages)).collect()}
    assert [rows[i].verdict for i in range(7)] == ["allow"] * 4 + ["block", "block", "allow"]
    assert (rows[3].host, rows[3].rule, rows[0].host) == ("a.example.net", "example.net/en/", "")
    assert urls.judge(pages.limit(0), urls.listed(pages)).count() == 0


def test_personal(frame):
    cards = "4111 1111 1111 1111"
    texts = {i: f"call +1 (0{i}) 555-{1000 + i} or mail u{i}.x@h{i}.example.com, {cards}, 10.0.0.{i} end" for i in range(10, 60)}
    texts |= {1: "ring (017) 555-7713 now", 2: None, 3: "", 4: "clean words only", 5: "no 4111111111111112 card"}
    rows = {r.doc_id: r for r in personal.personal_data(frame(texts)).collect()}
    assert all((rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone) == (1, 1, 1, 1) for i in range(10, 60))
    assert rows[1].spans == "phone:5:19"
    assert [rows[i].spans for i in (2, 3, 4, 5)] == [""] * 4
    assert rows[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert personal.personal_data(frame({})).count() == 0


@pytest.mark.parametrize("blank", ["\n", "\t", " ", "  ", "\r\n", " and "])
def test_personal_data_covers_lists(blank):
    """Each number of a list and each side of a spaced address, whole."""
    phones = [f"555-{100 + i}-{4000 + i}" for i in range(40)]
    text = "numbers:" + blank + blank.join(phones)
    found = personal.spans_of(text, {"phone: phone": -1.0, "phone: groups 3-3-4": 5.0}, [])
    assert [text[a:b] for a, b, _ in found] == phones
    covered = "".join(own for _, own in personal.stretches(text))
    assert all(p in covered for p in phones)
    for sign in (" @ ", "(at)", " (at) "):
        mail = f"a.rather.long.name.of.thirty.two{sign}some.very.long.host.of.a.large.house.example.org"
        text = blank.join(["write to", mail, "or call"])
        found = personal.spans_of(text, {"email: email": -1.0, "email: right blank": 5.0}, [])
        assert [text[a:b] for a, b, _ in found][:1] == [mail]


def test_personal_data_of_long_texts_takes_linear_time():
    """Words, digits and lists of spans as long as a document."""
    texts = ["ab" * 100_000 + " x1", "1" * 200_000, " ".join(f"+1 (212) 555-{i}" for i in range(1000, 7000))]
    began = time.monotonic()
    found = [personal.spans_of(t, {"phone: phone": -1.0}, personal.base_spans(t)) for t in texts]
    assert [len(x) for x in found] == [0, 0, 6000] and time.monotonic() - began < 20
    base = [(0, 4, "ip"), (2, 9, "card"), (9, 12, "phone"), (20, 30, "card")]
    for a in range(32):
        for b in range(a + 1, 33):
            plain = any(a < y and x < b for x, y, _ in base)
            assert personal.touches(a, b, personal.merged(base)) == plain


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = {r.doc_id for r in catalog.QUERIES["op1_quality_rules"](spark, sf_dir).where("kept").collect()}
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES
    one = first(spark, docs, sf_dir).cache()
    assert {r.doc_id for r in one.collect()} == judged and one.columns == docs.columns
    three = third(spark, one, sf_dir).cache()
    classes = brute.near_duplicates({r.doc_id: r.text for r in one.collect()})
    assert sorted(r.doc_id for r in three.collect()) == sorted(k for k, (_, c) in classes.items() if k == c)
    four = fourth(spark, three, sf_dir)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    clean = brute.contamination({r.doc_id: r.text for r in three.collect()}, items)
    assert sorted(r.doc_id for r in four.collect()) == sorted(k for k, v in clean.items() if not v[1])
    assert second(spark, docs.limit(0), sf_dir).count() == 0 and last(spark, docs.limit(0), sf_dir).count() == 0


def test_pipeline_keeps_unlike_texts_of_one_id(spark, frame):
    """A row that shares its id is dropped only for a copy; its group never goes whole."""
    text = lambda w: " ".join(f"{w}{i}" for i in range(30))
    rows = [(1, text("a")), (1, text("b")), (1, text("c")), (2, text("a")), (3, text("b")), (4, text("c")), (4, text("c"))]
    blank = frame({0: ""}).first().asDict()
    docs = spark.createDataFrame([blank | {"doc_id": d, "text": t} for d, t in rows], frame({}).schema)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:3])


def test_licences(frame, texts):
    own = {
        1: "intro\nLicensed under the Apache License, Version 2.0.\nRELEASED under the MIT license",
        2: "the licensed driver went under the bridge\nall rights were lost",
        3: None,
        4: "",
        5: "some words, all rights reserved. " + "more " * 5000,
    }
    rows = {r.doc_id: r for r in licences.scan(frame(own)).collect()}
    assert [rows[i].families for i in own] == ["apache,mit", "", "", "", "proprietary"]
    assert [rows[i].n_paragraphs for i in own] == [3, 2, 0, 0, 1]
    assert licences.scan(frame({})).count() == 0


@pytest.mark.parametrize("block", [1 << 22, 40])
def test_encoder_of_whole_batches_agrees_with_single_texts(block, monkeypatch):
    """Words that are parted as arrays, blanks of all kinds, special tokens, nulls; slices."""
    monkeypatch.setattr(tokens, "BLOCK_BYTES", block)
    signs = [*"abXYéÀßÿ÷×øØ.,!'12²\n\t\x0b\x0c\x1c\x85 Σς中😀<|>`@[{~", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "  "]
    draw = np.random.default_rng(2)
    texts = ["".join(draw.choice(signs, draw.integers(0, 30))) for _ in range(2000)] + [None, "", " ", "a", "."]
    found = [x.tolist() for x in Encoder(public_path()).each(pa.array(["z", *texts, "q"]).slice(1, len(texts)))]
    assert found == [x.tolist() for x in ids_of(dict(enumerate(texts))).values()]
    assert list(Encoder(public_path()).each(pa.array([], pa.string()))) == []


def test_encoder_cuts_repeated_words_once_a_batch(monkeypatch):
    encode, seen = Encoder(public_path()), []
    keep = encode.piece
    encode.pieces.compute = lambda x: seen.append(x) or keep(x)
    list(encode.each(pa.array(["Alpha alpha. beta", "ALPHA, beta!"])))
    assert sorted(x for x in seen if x.isalpha()) == ["alpha", "beta"]
    assert not encode.words


def test_packing_keys_of_what_is_left_are_stored(frame):
    """Rows that a round leaves carry the next round's key: their ids are not read for it again."""
    own = durable(packing.encoded(frame({i: f"w{i} x{i % 7} y{i % 5} z" for i in range(40)}), public_path()), "own")
    statistics = packing.statistics_of(own, public_path())
    shared = own.sparkSession.sparkContext.broadcast(statistics)
    out = packing.one_round(own, shared, 0, 3, public_path(), 4096, 1 << 20, 1 << 14)
    left = out.where("ids is not null").collect()
    assert len(left) == 40
    assert all(r.key == statistics.key(np.frombuffer(r.ids, "<u2"), 1) for r in left)


def test_licences_are_fitted_on_all_documents(frame):
    """Every paragraph with an anchor counts; one template's text among them weighs on its family."""
    mit, other = "Released under the MIT License.", "a licence for the driver of this work"
    docs = frame({i: f"{mit}\nplain\n{other} {i}" for i in range(40)} | {40: None, 41: ""})
    per_class = licences.of_templates(docs.sparkSession).groupBy("class").agg(F.sum("weight").alias("of_class"))
    rows = licences.of_documents(docs, per_class).collect()
    kinds = {r["class"] for r in rows}
    assert kinds == {0, licences.CLASSES.index("mit")}
    total = {r["class"]: r.of_class for r in per_class.collect()}
    assert all(abs(sum(r.weight for r in rows if r["class"] == k) - total[k]) < 1e-6 for k in kinds)


def test_pieces_are_kept_as_arrays():
    """Of words of letters no dictionary is kept, and what is kept is bounded."""
    encode, computed = Encoder(public_path()), []
    encode.heads.most = 300
    encode.pieces.compute = lambda x: computed.append(x) or encode.piece(x)
    for first in (0, 0, 100, 250, 0):
        words = ["ab" * (i % 5) + f"q{'xyzw'[i % 4]}" + "abcdefghij"[i // 10 % 10] * (1 + i // 100) for i in range(first, first + 200)]
        words = [w + end for w, end in zip(words, ["", ".", "é", "!"] * 50, strict=True)]
        ids, sizes = encode.of_words(pa.array(words))
        want = [encode.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        assert (ids.tolist(), sizes.tolist()) == ([x for w in want for x in w], [len(w) for w in want])
        assert len(encode.heads.known) == len(encode.heads.sizes) <= 300
        assert not any(x.isalpha() for x in encode.pieces)
    computed = [x for x in computed if x.isalpha()]
    assert len(computed) < 1000 and len(set(computed[:200])) == 200


def test_packing_statistics_need_no_second_pass(spark, frame):
    """Every task that encodes leaves its counts of documents by token id."""
    texts = {i: f"w{i % 9} w{i % 9} x{i % 7}" for i in range(60)} | {90: None, 91: ""}
    own = durable(packing.encoded(frame(texts).repartition(3), public_path()), "own")
    assert own.where("row is null").count() >= 3 and own.where("row is not null").count() == len(texts)
    statistics, want = packing.statistics_of(own, public_path()), {}
    encode = Encoder(public_path())
    held = list(encode.each(pa.array(list(texts.values()), pa.string())))
    for ids in held:
        for t in set(ids.tolist()):
            want[t] = want.get(t, 0) + 1
    assert statistics.n == len(texts) and statistics.mean == sum(map(len, held)) / len(texts)
    assert {t: n for t, n in enumerate(statistics.df.tolist()) if n} == want
    for ids in held:
        terms, tf = np.unique(ids, return_counts=True)
        terms, tf = terms[statistics.useful[terms]], tf[statistics.useful[terms]]
        order = np.argsort(-statistics.weights(terms, tf, len(ids)), kind="stable")
        assert all(statistics.heaviest(ids, n).tolist() == terms[order][:n].tolist() for n in range(8))


def test_jaccard_makes_only_wanted_sets_anew(spark, frame, texts, monkeypatch):
    """Of texts that are not wanted no set is made; a set that several texts have is found."""
    texts = texts | {95: texts[40].upper(), 96: texts[40] + " "}
    documents = frame(texts).repartition(2)
    sets = durable(jaccard.sets_of(documents), "sets")
    nodes = sets.where("node is not null").dropDuplicates(["node"])
    of = {r.doc_id: r.node for r in sets.collect()}
    assert of[95] == of[96] == of[40] and of[0] != of[40]
    pairs = spark.createDataFrame([(of[40], of[0])], "a long, b long")
    assert [tuple(r) for r in jaccard.links(pairs, documents, nodes).collect()] == [(of[40], of[0])]
    wanted = nodes.where(F.col("node").isin(of[40], of[0])).select("node", "text_hash")
    made = spark.sparkContext.accumulator(0)
    plain = jaccard.blocks

    def watched(column, **options):
        made.add(len(column))
        return plain(column, **options)

    monkeypatch.setattr(jaccard, "blocks", watched)
    found = jaccard.sets_by_node(documents, durable(wanted, "wanted")).collect()
    assert {r.node for r in found} == {of[40], of[0]}
    assert 2 <= made.value <= 3  # of 40 and 41, which are equal, and of 0


def test_encoder_gives_the_memory_of_blocks_back(monkeypatch):
    """Workers live on for other stages: unused Arrow memory does not stay with them."""
    freed, encode = [], Encoder(public_path())

    class Pool:
        def release_unused(self):
            freed.append(True)

    monkeypatch.setattr(tokens.pa, "default_memory_pool", Pool)
    assert len(list(encode.each(pa.array(["one two", None])))) == 2 and freed
