"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from rillstream.llm import (  # noqa: E402
    chat,
    decontamination,
    graphs,
    licenses,
    linededup,
    mixing,
    pii,
    quality,
    simhash,
    toxicity,
    webpages,
)

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, size long, spans string,"
          " n_lines long, component_id long, doc long, key long, copies long")
LONG = " ".join(f"w{i % 977}" for i in range(20_000))
TEXTS = [
    (1, "A line that is repeated\nanother\n"), (2, "a LINE that is repeated \n\n"), (3, None), (4, ""), (None, "a line that is repeated"),
    (None, None), (5, "\x0b \x0c"), (6, LONG), (6, LONG), (7, "x" * 20_000), (8, "mail a@b.co and a@b.co.uk_c@d.ef"),
    (9, "éé ÀÀ 10.0.0.256 1.2.3.4.5.6.7.8 +1 (555) 123-4567 4111 1111 1111 1111"), (10, "a@" * 3_000), (11, "1." * 3_000),
    (12, "+1" * 3_000), (13, "same words here to link"), (14, "same words here to link"), (14, "same words here to link")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}", None, 7, 7, "x", 7, 7, 7, 7, 7)
            for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, empty):
    got = linededup.drop_repeated(docs).collect()
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["text"] == TEXTS[0][1] and by_id[2]["text"] == "\n" and by_id[2]["n_dropped"] == 1
    assert (by_id[3]["text"], by_id[3]["n_lines"], by_id[4]["n_lines"]) == ("", 1, 1)
    assert [r["text"] for r in got if r["doc_id"] == 6] == [LONG, LONG]  # rows of one document
    assert sorted(r["text"] for r in got if r["doc_id"] is None) == ["", ""]  # comes after all others
    assert by_id[1]["fp"] == 7 and linededup.drop_repeated(empty).count() == 0


def test_line_dedup_of_rows_without_an_id(spark):
    """They are documents of their own after all others; equal texts are one document; groups of filters change nothing."""
    rows = [(None, "shared by all of them\nonly in this one"), (None, "shared by all of them\nonly in that one"),
            (9, "Shared by all of them"), (None, "twice without an id"), (None, "twice without an id"),
            (None, "common to two rows\na"), (None, "common to two rows\nb"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for filter_bytes in (linededup.FILTER_BYTES, 30):
        got = sorted(r["text"] for r in linededup.drop_repeated(frame, filter_bytes=filter_bytes).collect())
        first = "a" if "common to two rows\na" in got else "b"
        assert got == sorted(["only in this one", "only in that one", "Shared by all of them", "twice without an id",
                              "twice without an id", f"common to two rows\n{first}", "ab".replace(first, ""), ""])


def test_licenses(docs, empty, spark):
    assert licenses.licenses(docs).count() == len(TEXTS) and licenses.licenses(empty).count() == 0
    mit = dict(reversed(licenses.TEMPLATES))["MIT"]
    body = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100).replace(", ", ",\n")
    rows = [(1, f"intro words here\n{mit.upper()}\nrest of it"), (2, f"before and after\n\n{body}\n\nmore"), (3, None), (4, "MIT")]
    got = {r["doc_id"]: r for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["license"], got[1]["dice"], got[1]["n_passages"]) == ("MIT", 1.0, 1)
    assert got[2]["license"] == "MIT" and got[2]["dice"] == 1.0
    assert got[3]["license"] is None and got[4]["license"] is None


def test_mixing(docs, empty, spark):
    got = mixing.mix(docs, block_rows=2)
    assert got.count() == len(TEXTS) and mixing.mix(empty).count() == 0
    assert all(r["copies"] * r["size"] <= 2 * r["size"] for r in got.collect())
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(2000)] + [(None, "a b c", None)] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    for block_rows in (4096, 16):  # without and with a tree of blocks
        plan = mixing.mix(frame, block_rows=block_rows).cache()
        taken = {r["source"]: r["t"] for r in plan.groupBy("source").agg({"t": "sum"}).withColumnRenamed(
            "sum(t)", "t").collect()} if "t" in plan.columns else {}
        for r in plan.collect():
            taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        goals = brute.targets(sizes)
        assert all(abs(taken[s] - goals[s]) <= 7 for s in goals)
        assert mixing.expand(frame, plan).count() == sum(r["copies"] for r in plan.collect())


def test_pivot_keeps_the_words_and_the_probabilities():
    items = [(0.3, 5, "a"), (0.3, 2, "b"), (0.3, 9, "c"), (0.3, 4, "d"), (1.0, 3, "e")]
    sums = [0.0] * 5
    for seed in range(3000):
        out = mixing.pivot(items, seed)
        assert sum(0 < p < 1 for p in out) <= 1
        assert sum(p * s for p, (_, s, _) in zip(out, items)) == pytest.approx(sum(p * s for p, s, _ in items))
        sums = [a + b for a, b in zip(sums, out)]
    assert all(abs(s / 3000 - p) < 0.04 for s, (p, _, _) in zip(sums, items))


def test_decontamination(docs, empty, spark):
    bench = spark.createDataFrame([("1", None), (None, "x y"), ("2", "Same words, here"), ("3", "...")],
                                  "item_id string, text string")
    got = decontamination.contaminated_spans(docs, bench).collect()
    assert len(got) == len(TEXTS)
    assert {r["doc_id"] for r in got if r["items"]} == {13, 14}
    assert decontamination.contaminated_spans(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert decontamination.contaminated_spans(empty, bench).count() == 0
    assert decontamination.remove_contaminated(docs, bench).columns == docs.columns
    assert decontamination.remove_contaminated(docs, bench).count() == len(TEXTS) - 3


def test_winnowing_finds_every_long_shared_span():
    import random

    rng = random.Random(5)
    for _ in range(300):
        shared = [f"w{rng.randrange(4)}" for _ in range(10)]
        item = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(20))] + shared + ["z"]
        text = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(30))] + shared + [f"w{rng.randrange(4)}" for _ in range(8)]
        index = decontamination.Benchmark([("i", " ".join(item))])
        spans, _ = index.hits([word.encode() for word in text])
        hit = sum(b - a for a, b in decontamination.merged(spans))
        assert hit == brute.contamination([(1, " ".join(text))], [("i", " ".join(item))])[0][2] >= 10


def test_personal_data(docs, empty, spark):
    got = pii.personal_data(docs).collect()
    assert len(got) == len(TEXTS) and pii.personal_data(empty).count() == 0
    texts = {d: t for d, t in TEXTS if d is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert [tuple(s) for s in r["base"]] == brute.base_spans(texts[r["doc_id"]]), r["doc_id"]


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"write to address user{i}@mail{i}.example.com please") for i in range(30)]
    rows += [(100 + i, f"word{i} number 77{i}5 stays") for i in range(30)]
    rows += [(500, "write to address someone@intranet please"), (501, "some@thing else"), (502, None)]
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[500]["spans"]] == [(0, 17, 33)] and not got[500]["base"]
    assert not got[501]["spans"] and not any(got[100 + i]["spans"] for i in range(30))
    assert all(len(got[i]["spans"]) == len(got[i]["base"]) == 1 for i in range(30))


def test_running_starts(spark):
    from pyspark.sql import functions as F

    for n in (0, 1, 63, 64, 65, 1000):
        frame = spark.createDataFrame([(list(range(n)),)], "x array<int>")
        assert frame.select(pii.running_starts(F.col("x"))).first()[0] == [i * (i - 1) // 2 for i in range(n)]


def test_toxicity(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (13, None), (13, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        got = toxicity.scored(docs, known).collect()
        assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 0 for r in toxicity.scored(docs, labels.limit(0)).collect())
    assert toxicity.scored(empty, labels).count() == 0
    assert toxicity.keep_ordinary(docs, labels.limit(0)).columns == docs.columns


def test_chat(spark):
    rows = [(1, 0, "user", "hi <s> \\ [INST]"), (1, 1, "assistant", "\\<s>\\\\[/INST]</s>\n"), (1, 2, None, None),
            (2, None, "user", "x"), (2, 1, "assistant", None), (2, 1, "assistant", None), (None, 5, "tool[INST]", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "turns")
    made = chat.examples(frame)
    assert made.count() == 5
    for r in made.collect():
        inner = r["formatted"].replace(chat.OPEN, "").replace(chat.SEP, "").replace(chat.CLOSE, "")
        assert not any(c in inner for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", "hi <s> \\ [INST]"), ("assistant", "\\<s>\\\\[/INST]</s>\n"), ("", "")]
    assert back[1]["losses"] == ["\\<s>\\\\[/INST]</s>\n"] and back[2]["losses"] == ["", ""]
    assert [tuple(t) for t in back[None]["turns"]] == [("tool[INST]", "")]
    assert chat.read_back(chat.examples(frame.limit(0))).count() == 0


def test_quality(docs, empty, spark):
    got = quality.judged(docs).collect()
    assert len(got) == len(TEXTS) and quality.judged(empty).count() == 0
    texts = {d: t for d, t in TEXTS if d is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r)[1:7] == brute.quality(texts[r["doc_id"]])
    assert quality.keep_good(docs).columns == docs.columns
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", "s") for i in range(200)]
    rows += [(900, " ".join(f"w{j}%%%" for j in range(60)), "en", "s"), (901, " ".join(f"{j}" * 30 for j in range(60)), "en", "s")]
    verdict = {r["doc_id"]: r["kept"] for r in quality.judged(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not verdict[900] and not verdict[901] and all(verdict[i] for i in range(200))


def test_html(spark):
    menu = "<div id=x1><span>Home</span><span>All of it</span></div>"
    pages = [(i, f"http://Site.example/{i}", f"<html><body>{menu}<div class=text>Own words {i} &amp; more&nbsp;</div>"
              f"<ul class='nav-menu'><li>Other {i}</ul></body></html>") for i in range(9)]
    pages += [(20, None, None), (21, "nonsense", ""), (22, "http://b.example", "<p>a &lt; b<p>c <b>d</b>\n\te<div>f<script>g</script>"),
              (23, "http://c.example", "<header>H</header><article><header>T</header><p>in <a title='>'>it</a></p><div class='comments'>no</div>"
               "</article><p>beside</p><!-- x --><form>f</form>"), (9, "http://site.example/", "</p></div>text < 5 & 6"), (9, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in webpages.main_texts(frame).collect() if r["text"]}
    assert got == {**{i: f"Own words {i} & more" for i in range(9)}, 22: "a < b\nc d e\nf", 23: "T\nin it", 9: "text < 5 & 6"}
    assert webpages.main_texts(frame).count() == len(pages) and webpages.main_texts(frame.limit(0)).count() == 0


def test_html_importance(spark):
    """Texts that all articles of a site share go, teasers and names of what an element lacks or has do not mislead."""
    own = "Some words of page {0} only, and {0} more of them"
    pages = [(i, f"http://a.example/{i}", f"<article><p>{own.format(i)}</p><p>Read our other posts and like us</p></article>")
             for i in range(12)]
    same = "<article><p>One text</p><p>on all pages</p></article>"
    pages += [(100 + i, f"http://copies.example/{i}", same) for i in range(30)]
    pages += [(200 + i, f"http://few.example/{i}", f"<article><p>{own.format(i)}</p><p>By the same writer</p></article>") for i in range(5)]
    pages += [(300, "http://b.example", f"<div class='has-sidebar content'><p>{own.format(0)}</p></div><div class='left sidebar'>no</div>"),
              (301, "http://c.example", f"<div><p>{own.format(1)}</p></div><article><p>A teaser</p></article>")]
    got = {r["page_id"]: r["text"] for r in webpages.main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {**{i: own.format(i) for i in range(12)}, **{100 + i: "One text\non all pages" for i in range(30)},
                   **{200 + i: f"{own.format(i)}\nBy the same writer" for i in range(5)},
                   300: own.format(0), 301: f"{own.format(1)}\nA teaser"}


def test_near_duplicates(docs, empty):
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(brute.near_components(TEXTS), key=key)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in got})


def test_components(spark):
    chain = [(i + 1, i) for i in range(300)] + [(1000 + i, 900) for i in range(200)] + [(7000, 6000)]
    got = {r["node"]: r["root"] for r in graphs.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 900 for i in range(200)) and got[7000] == 6000
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_a_crowded_neighbourhood(spark):
    prints = [(1 << i) | (1 << j) for i in range(12) for j in range(i)] + [0, 1 << 40, (1 << 62) - 1]
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    got = {r["node"]: r["root"] for r in graphs.components(edges).collect()}
    assert all(got[p] == 0 for p in prints[:-1]) and prints[-1] not in got
    assert edges.count() < 65 * len(prints)


@pytest.mark.parametrize("which", ["docs", "empty"])
def test_pipeline_stages(spark, request, which):
    current = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, SMALL)
        if name != "mixing":
            assert out.columns == current.columns
        current = out.cache()
        assert (current.count() == 0) == (which == "empty")


def test_near_copies_of_many_differing_bits_are_found(spark):
    import random

    rng = random.Random(3)
    docs, far = [], 0
    for i in range(300):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        near = list(words)
        near[30] = "changed"  # 51 of 61 shingles are shared: 0.836
        docs += [(2 * i, " ".join(words)), (2 * i + 1, "  ".join(near).upper())]
        far += (brute.fingerprint(docs[-1][1]) ^ brute.fingerprint(docs[-2][1])).bit_count() > 2
    less = [f"v{j}" for j in range(60)]
    docs += [(9000, " ".join(less)), (9001, " ".join("x" if j in (20, 40) else w for j, w in enumerate(less)))]  # 46 of 66
    assert far > 200
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(frame).collect()) == [*range(0, 600, 2), 9000, 9001]
    assert simhash.keep_one(frame, words=1, similarity=0.9).count() == 301  # 9000 and 9001 share 58 of 61 words
    assert simhash.keep_one(frame, words=5, similarity=0.6).count() == 301


def test_members_of_a_bucket_are_compared_beyond_its_smallest(spark):
    words = [f"w{j}" for j in range(200)]
    texts = [" ".join(f"y{k}" if j >= 200 - 18 * k else w for j, w in enumerate(words)) for k in range(6)]  # a chain
    got = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    plain = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    root = list(range(6))
    for i in range(6):
        for j in range(i):
            if len(plain[i] & plain[j]) / len(plain[i] | plain[j]) >= 0.8:
                root = [root[j] if r == root[i] else r for r in root]
    assert sorted(r["doc_id"] for r in got) == sorted({root.index(r) for r in root})


def test_links_within_one_bit(spark):
    edges = simhash.links(spark.createDataFrame([(0,), (1,), (3,), (48,)], "fp long"), radius=1)
    assert sorted(map(tuple, edges.collect())) == [(1, 0), (3, 1)]
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(0,)], "fp long"), radius=3)


def test_ids_do_not_decide_for_other_texts(spark):
    rows = [(None, f"text number {i} of its own with words{i} more{i} and{i} others{i}") for i in range(20)]
    rows += [(7, "one text under a shared id of its own"), (7, "quite another text that has the same id as that")]
    rows += [(None, rows[0][1]), (3, rows[1][1]), (7, rows[20][1]), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"] or "") for r in simhash.keep_one(frame).collect()), key=str)
    expected = [(3 if i == 1 else None, rows[i][1]) for i in range(20)] + [*rows[20:22], (None, "")]
    assert got == sorted(expected, key=str)

    known = [(i, ("vile nasty insult words" if i % 2 else "calm kind plain words") + f" x{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    more = [(None, "vile nasty insult words"), (None, "calm kind plain words"), (500, "vile nasty insult"), (500, "calm kind plain")]
    kept = toxicity.keep_ordinary(spark.createDataFrame(known + more, "doc_id long, text string"), labels)
    left = {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert {more[1], more[3]} <= left and not {more[0], more[2]} & left
