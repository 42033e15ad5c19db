"""Repeated passages against a table of all strings in plain Python."""

import hashlib
import os
import random
import sys

import numpy as np
import pytest

from tidewell.llm import repeats
from tidewell.llm.queries import QUERIES
from tidewell.llm.runs import common_prefixes, front_coded, front_decoded, merge_runs

SCHEMA = "doc_id bigint, text string, kept int, n_bytes string"


def plain(rows, length=50):
    """(doc_id, bytes, removed, runs, digest) per row."""
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1 if i is not None else 0):
            s = data[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1 if i is not None else 0):
            if first[data[p : p + length]] < i:
                gone[p : p + length] = b"\x01" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def removed(spark, rows, length=50, parts=4):
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(parts)
    done = repeats.remove_repeats(docs, length).collect()
    for r in done:
        assert r.n_removed == sum(s["ends"] - s["starts"] for s in r.removed) and r.n_bytes - r.n_removed == len(r.kept)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in done), key=repr)


def corpus(seed, n, alphabet="ab ", longest=400):
    draw = random.Random(seed)
    shared = ["".join(draw.choice("abcdé \n") for _ in range(draw.randrange(20, 160))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = ""
        while len(text) < draw.randrange(longest):
            text += draw.choice(shared) if draw.random() < 0.4 else "".join(draw.choice(alphabet) for _ in range(draw.randrange(80)))
        rows.append((i, text))
        if i and draw.random() < 0.1:
            rows.append((n + i, rows[draw.randrange(len(rows))][1]))
    return rows


@pytest.mark.parametrize("length", [50, 7])
def test_against_all_strings(spark, monkeypatch, length):
    for name, value in (("PIECE", 32), ("TOGETHER", 900), ("BLOCK_BYTES", 4000), ("RUN", 500), ("RANGE", 200)):
        monkeypatch.setattr(repeats, name, value)
    rows = corpus(length, 150, "abcdefgh ")
    want = plain(rows, length)
    assert sum(r[2] for r in want) and removed(spark, rows, length) == want


def test_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", -1)
    rows = corpus(3, 80)
    assert removed(spark, rows) == plain(rows)


def test_odd_texts(spark):
    passage = "A passage of more than fifty bytes, with an ümlaut and a \x00 byte, which many share. "
    rows = [(None, passage), (3, None), (4, ""), (5, "short"), (6, passage[:40]), (7, "a" * 5000), (8, "a" * 300), (9, passage * 40), (2, passage), (10, "x" + passage)]
    rows += [(11, "b" * 49), (12, "b" * 49), (13, "b" * 50), (14, "b" * 50), (15, passage), (15, passage), (16, "\x00" * 200), (17, "\x00" * 120 + "z")]
    rows += [(20, "one text of a repeated id, long enough to be found by others"), (20, "one text of a repeated id, long enough to be found by others, and more")]
    rows += [(100 + i, "hot " * 30 + passage + str(i)) for i in range(60)]
    assert removed(spark, rows) == plain(rows)
    assert removed(spark, []) == [] and removed(spark, [(1, None)]) == plain([(1, None)])


def test_very_long_text(spark):
    draw = random.Random(9)
    long = "".join(draw.choice("abcdefghijklmnop \n") for _ in range(1_000_000))
    rows = [(1, long), (2, long[500_000:500_300]), (3, "y" + long[10:900_000])]
    assert removed(spark, rows) == sorted(
        [
            (1, 1_000_000, 0, 0, hashlib.sha256(long.encode()).hexdigest()),
            (2, 300, 300, 1, hashlib.sha256(b"").hexdigest()),
            (3, 899_991, 899_990, 1, hashlib.sha256(b"y").hexdigest()),
        ]
    )


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_suffix_dedup"].run(spark, folder).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == plain(docs)


def test_fingerprints_depend_on_the_string_alone():
    draw = np.random.default_rng(2)
    text = draw.integers(0, 3, 500).astype(np.uint8)
    for length in (4, 7, 50, 64):
        whole = repeats.fingerprints(text, length)
        assert len(whole) == len(text) - length + 1
        for p in range(0, len(whole), 37):
            assert repeats.fingerprints(text[p : p + length], length)[0] == whole[p]


@pytest.mark.parametrize("length", [1, 3, 8, 50])
def test_runs_merge_like_a_sort(length):
    draw = random.Random(length)
    for _ in range(150):
        runs, every = [], []
        for _ in range(draw.randrange(9)):
            made = {b"a" * (length - length // 2) + bytes(draw.choice(b"ab\x00\xff") for _ in range(length // 2)) for _ in range(draw.randrange(12))}
            strings = sorted(made)
            rows = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, length)
            prefixes = common_prefixes(rows)
            assert front_decoded(prefixes.tolist(), front_coded(rows, prefixes), length) == strings
            runs.append((strings, prefixes.tolist()))
            every += strings
        which, shared = merge_runs(runs, length)
        left = [iter(run[0]) for run in runs]
        got = [next(left[w]) for w in which]
        assert got == sorted(every)
        assert shared == common_prefixes(np.frombuffer(b"".join(got), np.uint8).reshape(-1, length)).tolist()


def test_known_prefixes_are_not_compared_again():
    class Watched(bytes):
        looked = 0

        def __getitem__(self, key):
            out = bytes(self)[key]
            if isinstance(key, slice):
                Watched.looked += len(out)
            return out

    strings = [b"p" * 40 + bytes([97 + a, 97 + b]) + b"q" * 8 for a in range(20) for b in range(20)]
    runs = []
    for r in range(4):
        mine = strings[r::4]
        rows = np.frombuffer(b"".join(mine), np.uint8).reshape(-1, 50)
        runs.append(([Watched(s) for s in mine], common_prefixes(rows).tolist()))
    merge_runs(runs, 50)
    # Each of 400 strings meets two others on its way up; behind the known prefix at most 10 of its 50 bytes are left.
    assert Watched.looked < 2 * 2 * 400 * 11 + 6 * 50


def test_merging_many_runs_takes_no_python_call_per_string():
    """The time of a merge must not grow with the number of runs: an input of 6 GB has hundreds in each range."""
    draw = np.random.default_rng(6)
    runs = []
    for _ in range(400):
        rows = np.unique(draw.integers(97, 101, (60, 50)).astype(np.uint8), axis=0)
        runs.append(([r.tobytes() for r in rows], common_prefixes(rows).tolist()))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event.endswith("call")

    sys.setprofile(count)
    try:
        which, shared = merge_runs(runs, 50)
    finally:
        sys.setprofile(None)
    left = [iter(run[0]) for run in runs]
    got = [next(left[w]) for w in which]
    assert got == sorted(s for run in runs for s in run[0])
    assert shared == common_prefixes(np.frombuffer(b"".join(got), np.uint8).reshape(-1, 50)).tolist()
    assert calls < len(got) / 5


def test_large_replies_do_not_shuffle_texts_and_scratch_goes(spark, monkeypatch, tmp_path):
    seen, kept = [], []
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(repeats, "BLOCKS_A_FILE", 2)
    runs, path = repeats._runs, repeats.scratch_path

    def watched(blocks, *rest):
        seen.append(blocks._jdf.queryExecution().executedPlan().toString())
        return runs(blocks, *rest)

    def named(spark, label):
        kept.append(str(tmp_path / path(spark, label).rsplit("/", 1)[1]))
        return kept[-1]

    monkeypatch.setattr(repeats, "_runs", watched)
    monkeypatch.setattr(repeats, "scratch_path", named)
    rows = corpus(11, 120)
    # As at size, where nothing is small enough to be broadcast unasked.
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert removed(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert seen and not any("Exchange hashpartitioning" in plan or "SortMergeJoin" in plan for plan in seen)
    # Blocks of text are stored in the shared folder only while they are needed.
    assert kept and not any(os.path.exists(k) for k in kept)
