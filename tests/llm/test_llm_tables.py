"""Sharding, decontamination, packing, personal data, near duplicates and the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidewell.llm import components, decontamination, near_dedup, packing, pii, sharding, shingles
from tidewell.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def docs_of(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard string, n_words int")


# Sharding


def shards_ok(rows, shards, widest):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    total = sum(r.size for r in rows)
    for k in by:
        assert sorted(r.slot for r in by[k]) == list(range(len(by[k])))
    sums = [sum(r.size for r in by.get(k, [])) for k in range(shards)]
    assert max(sums) - min(sums) <= 0.004 * total / shards + 2 * widest
    return sums


def test_sharding_query(spark):
    rows = QUERIES["op5_sharding"].run(spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r["size"] == len(docs[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    rows = [type("R", (), {"size": r["size"], "shard": r["shard"], "slot": r["slot"]}) for r in rows]
    shards_ok(rows, 24, max(r.size for r in rows))


def test_sharding_cuts_a_hot_text(spark):
    texts = ["same text"] * 700 + [None] * 100 + [f"text {i} " * (i % 40) for i in range(1200)]
    done = sharding.shard_documents(docs_of(spark, texts), 8, block_bytes=2_000).select("size", F.col("shard"), "slot", "doc_id", "n_words")
    assert done.columns == ["size", "shard", "slot", "doc_id", "n_words"]
    rows = [type("R", (), {"size": r["size"], "shard": r["shard"], "slot": r["slot"]}) for r in done.collect()]
    assert len(rows) == 2000 and len(shards_ok(rows, 8, max(r.size for r in rows))) == 8


def test_sharding_repeated_rows_and_none(spark):
    same = spark.createDataFrame([(None, "x" * 50)] * 30 + [(7, None)] * 3, "doc_id bigint, text string")
    rows = sharding.shard_documents(same, 3).collect()
    assert len(rows) == 33 and len({(r.shard, r.slot) for r in rows}) == 33
    assert sharding.shard_documents(same.limit(0), 3).count() == 0
    # Equal rows are cut like any others.
    equal = spark.createDataFrame([(1, "y" * 100)] * 60 + [(i, "z" * (i % 90)) for i in range(60)], "doc_id bigint, text string")
    rows = sharding.shard_documents(equal, 6).collect()
    assert len(rows) == 120 and len(shards_ok(rows, 6, max(r.size for r in rows))) == 6


# Decontamination


def test_decontamination_edges(spark):
    run = [f"w{i}" for i in range(30)]
    items = [(1, " ".join(run[:12])), (2, "Short ITEM"), (3, ""), (4, None), (5, "one"), (None, "two"), (6, " ".join(run[2:12])), (6, "Short ITEM")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    texts = [
        "a " + ", ".join(run[:12]).upper() + " b", " ".join(run[3:12]), "a short; item one", None, "", "!!", "one " * 40,
        " ".join(run[1:11] + ["x"] + run[2:12]), "short item", "short item",
    ]
    got = {r.doc_id: r for r in decontamination.contamination(docs_of(spark, texts), bench).collect()}
    found = {i: (r.n_words, r.n_hit, r.n_items) for i, r in got.items()}
    assert found == {
        0: (14, 12, 2), 1: (9, 0, 0), 2: (4, 3, 3), 3: (0, 0, 0), 4: (0, 0, 0), 5: (0, 0, 0), 6: (40, 40, 1), 7: (21, 20, 2), 8: (2, 2, 2), 9: (2, 2, 2),
    }
    import hashlib

    assert got[2].items_sha256 == hashlib.sha256(b"2,5,6").hexdigest() and got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    twice = docs_of(spark, texts).limit(1).union(docs_of(spark, texts).limit(1))
    assert decontamination.contamination(twice, bench).count() == 2
    assert decontamination.contamination(twice.limit(0), bench).count() == 0
    assert [r.contaminated for r in decontamination.contamination(twice, bench.limit(0)).collect()] == [False, False]
    kept = decontamination.clean_documents(docs_of(spark, texts), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5] and "shard" in kept.columns


def test_winnowing_misses_no_window(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("ab") for _ in range(25))) for i in range(3)]
    texts = [" ".join(rng.choice("ab") for _ in range(200)) for _ in range(20)]
    got = decontamination.contamination(docs_of(spark, texts), spark.createDataFrame(items, "item_id int, text string")).collect()
    windows = {tuple(w[k : k + 10]): i for i, t in items for w in [t.split()] for k in range(16)}
    for r in got:
        w = texts[r.doc_id].split()
        hit = {p for k in range(len(w) - 9) if tuple(w[k : k + 10]) in windows for p in range(k, k + 10)}
        assert r.n_hit == len(hit)


# Packing


def test_packing_round_trip(spark):
    texts = [None, "", "Hello world", "a  b\n\n c's <|endoftext|> x", "é\U0001f600" * 900, *[f"word{i} " * (i * 7 % 400) for i in range(60)]]
    docs = docs_of(spark, texts)
    rows = packing.pack_documents(docs, VOCABULARY, keep_ids=True).collect()
    whole = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert list(itertools.chain(*[r.ids for r in pieces])) == ids
        for r in pieces:
            assert r.length == len(r.ids) and r.doc_tokens == len(ids) and r.ids == ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    tokens = sum(r.length for r in rows)
    assert len(by_sequence) <= math.ceil(tokens / 1024) + 2
    again = docs.limit(3).union(docs.limit(3))
    assert packing.pack_documents(again, VOCABULARY).count() == 6
    assert packing.pack_documents(docs.limit(0), VOCABULARY).count() == 0


def test_packing_special_token_like_its_tokenizer():
    encode = packing._encoder(VOCABULARY)
    for text in ["<|endoftext|>", "a <|endoftext|>b", "x", "\xa0  a\t\tb", "''re's", "１２ ½", "\x00\x01"]:
        assert list(encode(text)) == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def test_nnls_and_plan():
    rng = np.random.default_rng(1)
    a = rng.random((6, 4))
    x = packing.nnls(a, a @ np.array([1.0, 0, 2, 0]))
    assert np.allclose(x, [1, 0, 2, 0])
    slope = a.T @ (rng.random(6) * -1 - a @ np.zeros(4))
    assert (packing.nnls(a, -rng.random(6)) == 0).all() and (slope < 0).all()
    for _ in range(5):
        histogram = np.concatenate([[0], rng.integers(0, 50, 16)])
        used = np.zeros(17, dtype=int)
        for combo, times in packing.plan(histogram):
            assert sum(combo) <= 16
            for c in combo:
                used[c] += times
        assert (used == histogram).all()
    assert packing.plan(np.zeros(17, dtype=int)) == []


# Personal data


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m[0]))


def test_pii_against_patterns(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab.@+-_%1234 5()é\U0001f600") for _ in range(60)) for _ in range(300)]
    texts += [
        None, "", "a@b@c.d.e@f.g.", "x.a@b.c_d@e.f", "1.2.3.4.5.6.7.8 300.1.1.1 0255.000.1.1 256.1.1.1", "4111 1111-1111 1111 4111111111111112",
        "+1 (980) 555-6268. +49 30 1234567890123", "a" * 50_000 + "@", "1 " * 30_000, "9" * 40_000, "+1" + "-" * 40_000, ("a@b.cc " * 3000),
    ]
    for r in pii.find_personal_data(docs_of(spark, texts)).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == plain_spans(texts[r.doc_id]), texts[r.doc_id][:80]


def test_pii_removes_what_reveals(spark):
    rng = random.Random(4)
    plain = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(40)}" for _ in range(n))
    # Zorblax stands only near one person; "contact" is near everybody, so it tells nothing.
    # Vexi never stands anywhere else: it gives the person away and goes.
    texts = [f"{plain(20)} Zorblax Vexi contact anna@example.org {plain(20)}" for _ in range(6)]
    texts += [f"{plain(20)} contact p{i}@example.org {plain(20)}" for i in range(40)] + [plain(40) for _ in range(60)] + ["all about zorblax"]
    rows = {r.doc_id: r for r in pii.find_personal_data(docs_of(spark, texts)).collect()}
    assert rows[106].clean == "all about [TERM]" and [(s.start, s.kind, s.end) for s in rows[106].spans] == [(10, 4, 17)]
    assert " [TERM]  contact [EMAIL] " in rows[0].clean and "Zorblax" not in rows[0].clean
    assert sum(len(r.spans) - len(r.base) for r in rows.values()) == 13
    assert rows[60].clean == texts[60]
    copies = spark.createDataFrame([(1, texts[0])] * 50 + [(2, None)], "doc_id bigint, text string")
    got = pii.find_personal_data(copies).collect()
    assert len(got) == 51 and all(len(r.spans) == len(r.base) for r in got)  # copies are one context
    assert pii.find_personal_data(copies.limit(0)).count() == 0


def test_pii_protects_entities_named_once_or_twice(spark):
    rng = random.Random(5)
    plain = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(8)}" for _ in range(n))
    far = lambda name: f"{name} {plain(30)} mail ben@example.org {plain(30)}"
    texts = [f"{plain(20)} mail anna@example.org account 77889911 {plain(20)}", f"{plain(20)} number 77889911 anna@example.org {plain(20)} 77889911"]
    texts += [far("Qwyx"), far("Qwyx Qwyx"), f"{plain(20)} Hapaxa once@example.org {plain(20)}"]
    texts += [f"{plain(20)} mail p{i}@example.org {plain(20)}" for i in range(200)]
    rows = {r.doc_id: r.clean for r in pii.find_personal_data(docs_of(spark, texts)).collect()}
    assert not any("77889911" in t or "Qwyx" in t or "Hapaxa" in t for t in rows.values())
    assert "mail [EMAIL]" in rows[0] and rows[9] == texts[9].replace("p4@example.org", "[EMAIL]")


def test_pii_overlaps_are_tagged_once(spark):
    (r,) = pii.find_personal_data(docs_of(spark, ["x 4111111111111111@b.cc 4111111111111111 y"])).collect()
    assert r.clean == "x [EMAIL] [CARD] y" and [s.kind for s in r.base] == [0, 2, 2]


# Near duplicates


def test_shingles():
    texts = pa.array(["A b, c d e f", None, "a b c d e f", "", "one two", "ONE; two", "é f g h i", "x" * 10_000, "a b c d e a b c d e"])
    found = shingles.shingles(texts)
    of = lambda i: sorted(zip(found.hash[found.text == i], found.times[found.text == i], strict=True))
    assert of(0) == of(2) and len(of(0)) == 2 and of(4) == of(5) and len(of(4)) == 1 and not of(1) and not of(3)
    assert sorted(t for _, t in of(8)) == [1, 1, 1, 1, 2] and len(of(6)) == 1
    parts = list(shingles.chunks(texts))
    assert sum(len(p) for _, p in parts) == 9


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(2)
    idf = np.ones((near_dedup.DEPTH, near_dedup.WIDTH), dtype=np.float32) * 3
    left = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 200)) for _ in range(40)]
    right = [" ".join(w if rng.random() > 0.02 else "edit" for w in t.split()) for t in left]
    a, b = (shingles.shingles(pa.array(x)) for x in (left, right))
    agree = near_dedup.signatures(a, near_dedup.weights(a, idf)) == near_dedup.signatures(b, near_dedup.weights(b, idf))
    assert abs(agree.mean() - near_dedup.similarities(pa.array(left), pa.array(right), idf).mean()) < 0.03


def test_pairs_by_counts_alone_meet(spark):
    rng = np.random.default_rng(12)
    plain = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    # 0.80 to 0.85 by counts; a third of the rows hold what the two share, and nobody else what they do not.
    common = [plain(184) for _ in range(150)]
    texts = [f"{c} {plain(k)}" for c, own in zip(common, itertools.cycle([16, 19, 22]), strict=False) for k in (own, own)]
    idf = np.full((near_dedup.DEPTH, near_dedup.WIDTH), 6.5, dtype=np.float32)
    for row in range(near_dedup.DEPTH):
        idf[row][near_dedup._cells(shingles.shingles(pa.array(common)).hash, row)] = math.log1p(3)
    got = {r.doc_id: set(r.buckets) for r in near_dedup.bands_of(docs_of(spark, texts), idf).collect()}
    near = near_dedup.similarities(pa.array(texts[::2]), pa.array(texts[1::2]), idf)
    assert near.min() >= 0.8 and near.max() < 0.86
    assert all(got[i] & got[i + 1] for i in range(0, len(texts), 2))


def plain_classes(texts, idf_of=None):
    sets = []
    for t in texts:
        w = words(t)
        sets.append(collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter())
    frequency = collections.Counter(s for c in sets for s in c)
    weight = {s: math.log1p(len(texts) / n) for s, n in frequency.items()}
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        same = (texts[i] or "") == (texts[j] or "")
        if not same and sets[i].keys() & sets[j].keys():
            for w in (weight, dict.fromkeys(weight, 1)):
                low = sum(min(sets[i][s], sets[j][s]) * w[s] for s in sets[i])
                high = sum(n * w[s] for c in (sets[i], sets[j]) for s, n in c.items()) - low
                same |= low >= 0.8 * high
        if same:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(3))
    base = [" ".join(word() for _ in range(120)) for _ in range(12)]
    edit = lambda t, n: " ".join(word() if i in set(rng.sample(range(120), n)) else w for i, w in enumerate(t.split()))
    # A star: every copy is like the original, copies are often not like each other.
    texts = [base[0]] + [edit(base[0], 2) for _ in range(60)] + base + [base[3]] * 5 + [edit(b, 1) for b in base[4:8]]
    texts += [base[9].upper(), None, "", None, "...", "!!!", "one", "two", "one", " ".join(base[10].split()[:70] + base[11].split()[70:])]
    rng.shuffle(texts)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_classes(texts)


def test_near_duplicates_of_a_chain_and_nulls(spark):
    texts = ["a b c d e f"] * 3
    docs = spark.createDataFrame([(None, t) for t in texts] + [(2**60 + 1, "x y z")] * 2 + [(5, "x y z")], "doc_id bigint, text string")
    rows = sorted(((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(None, None)] * 3 + [(2**60 + 1, 5)] * 2 + [(5, 5)], key=str)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    first = near_dedup.first_of_each(docs.unionByName(docs))
    assert sorted(((r.doc_id, r.text) for r in first.collect()), key=str) == [(5, "x y z"), (None, "a b c d e f")]


def test_components_against_search(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[start] == min(seen)
    assert set(got) == set(near)


# The pipeline


def test_stages_on_their_own(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for (name, stage), more in itertools.zip_longest(corpus_pipeline.STAGES, ["und", "same", "leak", "mail", None]):
        done = stage(spark, docs, FOLDER)
        if name != "packing":
            assert done.columns == columns, name
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    rows = [(10**6, "123 456", "en", "s", None), (10**6 + 1, "x " + item, None, None, 3), (10**6 + 2, None, "en", None, 0)]
    bad = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    left = {r.doc_id for r in corpus_pipeline.identified(spark, bad, FOLDER).collect()}
    assert 10**6 not in left and 10**6 + 2 not in left and 10**6 + 1 in left and len(left) >= docs.count() - 2
    left = {r.doc_id for r in corpus_pipeline.decontaminated(spark, bad, FOLDER).collect()}
    assert 10**6 + 1 not in left and 10**6 in left


def test_pipeline_stages_keep_and_drop(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.deduplicated(spark, docs, FOLDER)
    classes = near_dedup.near_duplicates(docs).toPandas()
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(classes["class_id"].unique())
    clean = corpus_pipeline.sanitised(spark, docs, FOLDER).toPandas()
    assert len(clean) == docs.count() and not clean["text"].map(lambda t: any(k == 0 for _, k, _ in plain_spans(t))).any()
    assert (clean["n_chars"] == clean["text"].map(len)).all()


@pytest.fixture(scope="module")
def pieces(spark):
    return corpus_pipeline.run(spark, FOLDER).toPandas()


def test_pipeline_result(pieces):
    assert isinstance(pieces, pd.DataFrame) and pieces.groupby("sequence_id")["length"].sum().max() <= 1024
    ends = pieces.sort_values("start").groupby("doc_id").tail(1)
    assert (ends["start"] + ends["length"] == ends["doc_tokens"]).all()


def test_near_duplicates_settles_few_pairs_in_one_round(spark, monkeypatch):
    """A class of many near copies, and outsiders that nobody is near to: who cannot link takes no part, and outsiders meet the rest once."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(3))
    base = [word() for _ in range(120)]

    def edited(n):
        at = set(rng.sample(range(120), n))
        return " ".join(word() if i in at else w for i, w in enumerate(base))

    texts = [edited(2) for _ in range(80)] + [edited(6) for _ in range(60)]
    rounds, taken = [], []
    unsettled, may_link = near_dedup._unsettled, near_dedup._may_link
    monkeypatch.setattr(near_dedup, "_unsettled", lambda placed, first: rounds.append(first) or unsettled(placed, first))
    monkeypatch.setattr(near_dedup, "_may_link", lambda bounds, threshold: taken.append((bounds.count(), may_link(bounds, threshold).count())) or may_link(bounds, threshold))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_classes(texts)
    assert len(rounds) <= 3 and taken[0][1] < taken[0][0]


def test_first_of_each_moves_few_texts(spark, monkeypatch):
    """However many documents stay, the texts that are shuffled are those of rows that go, and a few more."""
    rng = random.Random(12)
    texts = [" ".join(rng.choices("bcdfghklmnpqrstvwz", k=60)) + f" {i}" for i in range(3000)]
    rows = [(i, texts[min(i, 2899)], "en") for i in range(3000)]  # 100 copies of the last
    # An id with unlike texts is the least of several classes; rows without an id; repeated rows; null and empty texts.
    rows += [(5, "one unlike text", "en"), (7000, "one unlike text", "en"), (None, "no id", "en"), (None, "no id either", "en")]
    rows += [rows[7]] * 2 + [(8000, None, "en"), (8000, "", "en"), (8001, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    moved = []
    split = near_dedup._may_be_in
    monkeypatch.setattr(near_dedup, "_may_be_in", lambda *a: moved.append(split(*a)) or moved[-1])
    got = near_dedup.first_of_each(docs)
    assert got.columns == docs.columns
    wanted = [(i, t) for i, t, _ in rows[:2900]] + [(5, "one unlike text"), (None, "no id"), (None, "no id either"), (8000, "")]
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=str) == sorted(wanted, key=str)
    maybe = moved[0].filter("_maybe").count()
    assert 106 <= maybe < 106 + 3000 * 0.1
