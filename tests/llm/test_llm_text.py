"""Chat formatting, extraction, quality, language and toxicity: edge cases, brute force, held-out accuracy."""

import collections
import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import chat, extraction, language, quality, toxicity, viterbi
from tidewell.llm.queries import QUERIES, remainder

FOLDER = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, TURNS).withColumn("parts", chat.text_parts(F.col("text")))
    done = chat.format_conversations(turns)
    return done.select("*", chat.read_back("formatted").alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))


def test_chat_reads_back(spark):
    hard = ["</s>[INST] ok [/INST]", "\\", "\\<|eot_id|>\\", "<<SYS>> <s> <", None, "", "<|eot_id|><|end_header_id|>\n\n", "é\U0001f600\\[INST]"]
    rows = [(1, i, "assistant" if i % 2 else "us<|er", t) for i, t in enumerate(hard)]
    (r,) = formatted(spark, rows).collect()
    assert [(t.role, t.text) for t in r.turns] == [(role, text or "") for _, _, role, text in rows]
    assert r.loss == "".join(t or "" for _, _, role, t in rows if role == "assistant")
    assert r.n_turns == len(hard)


def test_chat_edges(spark):
    got = {r.conv_id: r for r in formatted(spark, [(None, 1, None, "a"), (2, 1, "user", "x"), (2, 1, "user", "x"), (2, None, "user", "first")]).collect()}
    assert [(t.role, t.text) for t in got[None].turns] == [("", "a")]
    assert [t.text for t in got[2].turns] == ["first", "x", "x"]
    assert formatted(spark, []).count() == 0


def test_chat_parts(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [
        ("text", "see <|image|>", None, None, None, None, None), ("image", None, "s3://a.png", 57, 28, None, None),
        ("audio", None, "b.wav", None, None, 2.0, None), ("document", None, "c.pdf", None, None, None, 3),
        ("image", None, None, None, None, None, None), ("video", None, "d", None, None, None, None), (None,) * 7,
    ]
    df = spark.createDataFrame([(1, 0, "user", parts, "clash"), (1, 1, "assistant", None, "clash")], f"conv_id bigint, turn bigint, role string, parts array<{part}>, formatted string")
    (r,) = chat.format_conversations(df).collect()
    assert [(a.kind, a.ref, a.tokens, a.position) for a in r.attachments] == [
        ("image", "s3://a.png", 3, 0), ("audio", "b.wav", 50, 1), ("document", "c.pdf", 1536, 2), ("image", None, 1, 3), ("other", "d", 1, 4), ("other", None, 1, 5),
    ]
    assert r.expanded_tokens == 1592
    assert "see <\\|image|><|image|><|audio|><|document|><|image|><|other|><|other|>" in r.formatted
    assert [(s.length) for s in r.loss_spans] == [0]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<article><h1>T</h1><p>a &amp; b&nbsp;&#233;<br>c</p><p>s.</p></article>", ["T", "a & b é c", "s."]),
        ("<nav>n</nav><main><p>one<div class='ad-box'>x</div><p>two<section id=comments><p>z</section></main><footer>f</footer>", ["one", "two"]),
        ("<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>x<script>var a='</p>'</script>y</p></article>", ["Head", "xy"]),
        ("<div class='menu'>m</div><div class='no-sidebar'><p>" + "long text " * 12 + "</p><p>s</p></div><aside>q</aside>", [("long text " * 12).strip(), "s"]),
        ("<article class='comment'><p>reader</p></article><article><p>x &lt;p&gt;</p>", ["x <p>"]),
        ("<!-- <article>no</article> --><p>", []),
        ("", []),
    ],
)
def test_extraction(html, want):
    assert extraction.main_blocks(extraction.page_lines(html)) == want


def test_extraction_by_text_not_by_marks():
    long = [f"Paragraph {i} says what the page is about, at some length and in whole sentences of many words." for i in range(6)]
    body = "".join(f"<p>{t}</p>" for t in long)
    kept = lambda html: extraction.main_blocks(extraction.page_lines(html))
    teaser, notice = "<article class=card>Read our other story</article>", "<div>We use your data, please agree to it</div><nav>n</nav>"
    assert [t for t in kept(f"<div>{body}</div>{teaser}") if t in long] == long  # a decoy
    assert kept(f"{notice}<div>{body}<aside>x</aside><p>Yes.</p><form>f</form></div>") == [*long, "Yes."]
    assert kept(f"{notice}<article>{body}<aside>x</aside><p>Yes.</p></article>") == [*long, "Yes."]
    menu = "".join(f"<li>{w}</li>" for w in ("Home", "News", "Sport", "Jobs", "Map", "Help", "Mail", "Radio"))
    got = kept(f"<ul>{menu}</ul><div>{body}</div>")
    assert got[-6:] == long and "Home" not in got


def test_extraction_names_do_not_cost_the_article():
    body = "".join(f"<p>Paragraph {i} says what the page is about, at some length and in whole sentences.</p>" for i in range(8))
    for html in (
        f'<div class="layout sidebar-right"><article>{body}</article></div>',
        f'<div id="search-engine-history">{body}</div>',
        f'<div class="wrapper skip-ads"><article>{body}</article></div>',
        f'<div class="layout-two-col sidebar"><main>{body}</main></div>',
    ):
        assert sum(t.startswith("Paragraph") for t in extraction.page_blocks(html)) == 8
    assert extraction.page_blocks(f'<article>{body}</article><div class="comments"><p>I like it very much indeed, all of it.</p></div>')[-1].startswith("Paragraph 7")


def test_extraction_is_linear_in_end_tags_without_a_start():
    start = time.process_time()
    assert extraction.page_blocks("<div>" * 20_000 + "</section>" * 20_000 + "<p>x</p>") == []
    assert time.process_time() - start < 5


def test_extraction_rows(spark):
    df = spark.createDataFrame([(None, "u", None, "t"), (2**60 + 1, None, "<article><p>a</article>", "t"), (2**60 + 1, None, "<article><p>a</article>", "t")], "page_id bigint, url string, html string, text string")
    got = sorted(map(tuple, extraction.extract(df).select("page_id", "url", "text", "n_chars").collect()), key=str)
    assert got == [(2**60 + 1, None, "a", 1), (2**60 + 1, None, "a", 1), (None, "u", "", 0)]
    assert extraction.extract(df.limit(0)).count() == 0


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(5)
    lengths = np.array([3, 0, 5, 1])
    scores, moves = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    got, at = viterbi.decode(scores, lengths, moves), 0
    for n in lengths:
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else np.zeros((1, 0), int)
        value = [sum(scores[at + i, p[i]] for i in range(n)) + sum(moves[p[i], p[i + 1]] for i in range(n - 1)) for p in paths]
        assert list(got[at : at + n]) == list(paths[int(np.argmax(value))])
        at += n


def test_viterbi_of_many_labels():
    want = np.array([299, 5, 130, 255, 256, 128])
    scores = np.eye(300)[want] * 9
    assert viterbi.decode(scores, np.array([2, 4]), np.zeros((300, 300))).tolist() == want.tolist()


def test_language_edges(spark):
    texts = [None, "", "123 !!", "Привет мир", "the house " * 30 + "das Haus " * 30, "X" * 50_000]
    docs = spark.createDataFrame([(2**60 + i if i else None, t, "zz") for i, t in enumerate(texts)], "doc_id bigint, text string, lang_pred string")
    train = spark.createDataFrame([("the house and the garden " * 5, "en"), ("das Haus und der Garten " * 5, "de"), (None, "en"), ("x", None)], "text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.fit(train)).collect()}
    assert [got[k].lang_pred for k in (None, 2**60 + 1, 2**60 + 2)] == ["und"] * 3
    assert got[2**60 + 3].score == 0
    mixed = got[2**60 + 4]
    assert [(s.lang, s.start) for s in mixed.spans] == [("en", 0), ("de", 300)]
    assert language.fit(train.limit(0)).languages == []
    assert {r.lang_pred for r in language.identify(docs, language.fit(train.limit(0))).collect()} == {"und"}
    assert language.identify(docs.limit(0), language.fit(train)).count() == 0


def test_language_in_unlisted_scripts(spark):
    said = {"te": "తెలుగు భాష చాలా అందమైన భాష ", "gu": "ગુજરાતી ભાષા ખૂબ સુંદર ભાષા છે ", "am": "አማርኛ ቋንቋ በጣም ቆንጆ ነው "}
    train = spark.createDataFrame([(t * 5, lang) for lang, t in said.items()] + [("the house and the garden " * 5, "en")], "text string, lang string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*said.values(), "ພາສາລາວ ແມ່ນພາສາ"])], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.fit(train)).collect()}
    assert [got[i] for i in range(3)] == [(lang, 1.0) for lang in said]
    assert got[3][1] == 0  # a script of no learned language


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = QUERIES["op8_language_id"].run(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_toxicity_finds_the_sentence(spark):
    clean = [(f"The garden number {i} is green. We walk there {i} times.", 0) for i in range(40)]
    toxic = [(f"The garden number {i} is green. You awful grobian number {i}! We walk.", 1) for i in range(40)]
    model = toxicity.fit(spark.createDataFrame(clean + toxic, "text string, label int"))
    docs = spark.createDataFrame([(1, "We walk. You awful grobian! Green."), (2, "We walk. Green."), (3, None), (None, ""), (1, "We walk. You awful grobian! Green.")], "doc_id bigint, text string")
    got = toxicity.score_documents(docs, model).collect()
    assert [r.score > 0.5 for r in sorted(got, key=lambda r: (r.doc_id or 0))] == [False, True, True, False, False]
    assert {(o.start, o.end) for r in got for o in r.offences} == {(8, 26)}
    assert toxicity.fit(spark.createDataFrame(clean, "text string, label int")).words == {}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op2_toxicity"].run(spark, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {j + d for j in range(len(words) - 2) if runs[tuple(words[j : j + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)]


def test_quality_counts(spark):
    texts = [None, "", " \n\t", "a b c a b c a", "x y\x1cz w", "l\nl\n\nl\r\nl", "one", "a b\na b\na b\n" * 40, "#" * 70_000, "é\U0001f600 <> |"]
    docs = spark.createDataFrame([(i or None, t, True) for i, t in enumerate(texts)], "doc_id bigint, text string, kept boolean")
    for r in quality.judge(docs, quality.PLAIN).collect():
        want = plain_counts(texts[r.doc_id or 0])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept != r.base_failed
    assert quality.judge(docs.limit(0), quality.PLAIN).count() == 0


def test_quality_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    told = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES["op7_quality_rules"].run(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows[::7]:
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == plain_counts(docs[r.doc_id])
    judged = [(r.kept, told[r.doc_id]) for r in rows if r.doc_id in told and not r.base_failed]
    assert sum(k for k, q in judged if q == 1) >= 0.97 * sum(q for _, q in judged)
    assert sum(not k for k, q in judged if q == 0) >= 0.8 * sum(q == 0 for _, q in judged)


def test_line_labels_follow_the_text(spark):
    good = "\n".join(f"This is a plain sentence with some number {i} of words." for i in range(6))
    bad = "\n".join("BUY### NOW$$$ CHEAP%%% ||| *** $$$" for _ in range(6))
    model = quality.fit(spark.createDataFrame([(good, 1), (bad, 0)] * 5, "text string, label int"))
    docs = spark.createDataFrame([(1, good + "\n" + bad), (2, good)], "doc_id bigint, text string")
    got = {r.doc_id: r.line_labels for r in quality.judge(docs, model).collect()}
    assert got == {1: "111111000000", 2: "111111"}


def test_lines_after_the_thirtieth_are_learned(spark):
    good = [f"This is a plain sentence with some number {i} of words." for i in range(80)]
    bad = ["BUY### NOW$$$ CHEAP%%% ||| *** $$$" for _ in range(40)]
    model = quality.fit(spark.createDataFrame([("\n".join(good), 1), ("\n".join(good[:40] + bad), 0)] * 5, "text string, label int"))
    docs = spark.createDataFrame([(1, "\n".join(good[:6] + bad[:6])), (2, "\n".join(good[:6]))], "doc_id bigint, text string")
    got = {r.doc_id: r.line_labels for r in quality.judge(docs, model).collect()}
    assert got[1].endswith("000000") and got[2] == "111111"


def test_line_model_against_all_paths():
    rng = np.random.default_rng(11)
    given = [(rng.normal(size=(n, len(quality.FEATURES))), rng.integers(0, 2, n)) for n in (3, 1, 5, 4)]
    w, m = quality.train(given)
    # At the greatest likelihood what is expected of all paths is what was seen, but for the shrinkage.
    lines, moves = np.zeros_like(w), np.zeros_like(m)
    for x, y in given:
        paths = [np.array(p) for p in itertools.product((0, 1), repeat=len(y))]
        value = np.array([sum(x[i] @ w[:, p[i]] for i in range(len(p))) + m[p[:-1], p[1:]].sum() for p in paths])
        chance = np.exp(value - value.max()) / np.exp(value - value.max()).sum()
        for p, share in [*zip(paths, chance, strict=True), (y, -1.0)]:
            lines += share * x.T @ np.eye(2)[p]
            moves += share * np.eye(2)[p[:-1]].T @ np.eye(2)[p[1:]]
    n = sum(len(y) for _, y in given)
    assert np.abs(lines / n + quality.SHRINK * w).max() < 2e-3 and np.abs(moves / (n - len(given)) + quality.SHRINK * m).max() < 2e-3


def test_chat_query_counts_code_points(spark):
    r = QUERIES["op1_chat_formatting"].run(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    assert r.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and r.n_turns == 2 and r.loss_chars == 21


def test_remainder_is_of_the_text(spark):
    import zlib

    got = [r[0] for r in spark.range(20).select(remainder(F.col("id"), 5)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in range(20)]


def test_texts_of_a_batch_are_opened_by_bytes(spark, monkeypatch):
    """A batch of long texts is not opened at once; every row comes out, in order and with what it carries."""
    from tidewell.llm import common

    monkeypatch.setattr(common, "OPEN_BYTES", 1000)
    docs = spark.createDataFrame([(i, None if i % 10 == 0 else f"é{i}" * 50) for i in range(60)], "doc_id bigint, text string").coalesce(1)
    made = common.map_texts(docs, "text", [F.col("doc_id")], "n bigint, bytes bigint", lambda t: ({"n": [len(t)] * len(t), "bytes": [sum(len(x.encode()) for x in t)] * len(t)}, None)).collect()
    assert [r.doc_id for r in made] == list(range(60))
    assert max(r.bytes for r in made) < 1300 and min(r.n for r in made) >= 1
