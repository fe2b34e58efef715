"""The registered queries over the small tables, against SQL or the plain versions."""

from __future__ import annotations

import os
import sys
import zlib
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from rillstream.llm import decontamination, licenses, linededup, mixing, pii, queries, simhash, toxicity  # noqa: E402

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(spark, name, sf_dir=SMALL):
    return [r.asDict() for r in queries.QUERIES[name](spark, sf_dir).collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare.difference(spark, compare.oracle(SMALL), name, SMALL)[0] == ""


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_licenses(spark, docs):
    plain = [(name, licenses.bigrams(text)) for name, text in licenses.TEMPLATES]
    found = 0
    for row in rows(spark, "op2_license_scan"):
        text, best = docs[row["doc_id"]]["text"], []
        for begin, end in licenses.passages(text):
            grams = licenses.bigrams(text[begin:end])
            dice = [(-2 * len(grams & other) / max(1, len(grams) + len(other)), name) for name, other in plain]
            best += [min(dice)] if -min(dice)[0] >= 0.8 else []
        expected = (len(best), min(best)[1], -min(best)[0]) if best else (0, None, 0.0)
        assert (row["n_passages"], row["license"], row["dice"]) == pytest.approx(expected)
        found += bool(best)
    assert found > 0


def test_mix(spark, docs):
    got = rows(spark, "op3_source_mix")
    size = {d: len(brute.WORDS.findall(r["text"] or "")) for d, r in docs.items()}
    of_source = defaultdict(int)
    for d, r in docs.items():
        of_source[r["source"]] += size[d]
    goals, taken = brute.targets(of_source), defaultdict(int)
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        source = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], of_source[source])
        assert r["target"] == pytest.approx(goals[source])
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source] += r["taken"]
    largest = defaultdict(int)
    for d, r in docs.items():
        largest[r["source"]] = max(largest[r["source"]], size[d])
    assert all(abs(taken[s] - goals[s]) <= largest[s] for s in goals)
    again = mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7), block_rows=4096)
    assert {(r["doc_id"], r["copies"] * r["size"]) for r in again.collect()} == {(r["doc_id"], r["taken"]) for r in got}


def test_personal_data(spark, docs):
    seen = 0
    for r in rows(spark, "op5_personal_data"):
        spans = brute.base_spans(docs[r["doc_id"]]["text"])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == brute.sha(text)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in spans) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))
        seen += len(spans)
    assert seen > 0


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = rows(spark, "op6_toxicity", LARGER)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.95


def test_quality(spark, docs):
    for r in rows(spark, "op8_quality_rules"):
        expected = brute.quality(docs[r["doc_id"]]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == expected
        assert not (r["kept"] and r["base_failed"])


def test_html(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = rows(spark, "op9_html_extraction")
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == brute.article(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_near_duplicates(spark, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op10_simhash_near_dedup")}
    expected = {d: (f"{f:016x}", c) for d, f, c in brute.near_components([(d, r["text"]) for d, r in docs.items()])}
    assert got == expected


def copies(docs, words=5):
    """doc_ids that some document with a smaller one resembles, directly or through others, by five-word shingles at 0.8."""
    sets = {d: (lambda w: {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())(
        brute.WORDS.findall((t or "").translate(brute.LOWER))) for d, t in docs}
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return [d for d, r in root.items() if r != d]


def test_pipeline_stages(spark):
    """Each stage on its own input, against the plain versions."""
    current = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in current.collect()]
        texts = [(r["doc_id"], r["text"]) for r in before]
        out = stage(spark, current, SMALL)
        if name != "mixing":
            assert out.columns == current.columns
        out = out.cache()
        after = {r["doc_id"]: r.asDict() for r in out.collect()}
        if name == "toxicity":
            verdicts = toxicity.scored(current, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
            assert set(after) == {r["doc_id"] for r in verdicts if not r["predicted"]}
        elif name == "line_dedup":
            expected = brute.line_dedup(texts)
            assert {d: r["text"] for d, r in after.items()} == {d: x[2] for d, x in expected.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "near_dedup":
            assert set(after) == {d for d, _ in texts} - set(copies(texts))
        elif name == "decontamination":
            assert set(after) == {d for d, _, hit, _ in brute.contamination(texts, bench) if not hit}
        else:
            assert set(after) == {d for d, _ in texts}
        current = out
    assert {s for s, _ in corpus_pipeline.STAGES} == {"toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"}


def test_decontamination_matches_plain(spark, docs):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bench += [("short", "the and"), ("one", "that"), ("none", "..."), (None, "the of and"), ("null", None), ("again", bench[0][1])]
    table = spark.createDataFrame([(None if n is None else str(n), t) for n, t in bench], "item_id string, text string")
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    # an item without an id marks words and has no name
    expected = brute.contamination([(d, r["text"]) for d, r in docs.items()], bench)
    got = decontamination.contaminated_spans(frame, table).collect()
    assert {(r["doc_id"], r["n_words"], sum(s["end"] - s["begin"] for s in r["spans"]), tuple(r["items"])) for r in got} == {
        (d, n, hit, tuple(x for x in names if x != "None")) for d, n, hit, names in expected}
    # short items remove no documents
    left = decontamination.remove_contaminated(frame, table.where("item_id in ('short', 'one') or item_id is null"), least_words=5)
    assert left.count() == len(docs)


def test_decontamination_with_a_crowded_bit_array(spark, docs, monkeypatch):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = {(r["doc_id"], tuple(r["items"])) for r in decontamination.contaminated_spans(frame, bench).collect()}
    monkeypatch.setattr(decontamination, "MOST_BITS", 13)
    monkeypatch.setattr(decontamination, "SENT_KEYS", 0)
    assert {(r["doc_id"], tuple(r["items"])) for r in decontamination.contaminated_spans(frame, bench).collect()} == want


def test_line_dedup_with_filters_in_groups_is_the_same(spark, docs):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    expected = {d: x[2] for d, x in brute.line_dedup([(d, r["text"]) for d, r in docs.items()]).items()}
    for filter_bytes in (256 << 20, 16 * linededup.SEGMENT_BITS // 8):  # one group, four of the 64 segments
        got = linededup.drop_repeated(frame, filter_bytes=filter_bytes).collect()
        assert {r["doc_id"]: r["text"] for r in got} == expected


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks()
    for i in range(64):
        for j in range(64):
            flipped = (1 << i) | (1 << j)
            assert any(not flipped & mask for mask in masks)
