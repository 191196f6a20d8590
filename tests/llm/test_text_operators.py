"""Decontamination, language ID, quality and pseudonyms."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.llm import decontamination as dc
from flowloom.llm import pii
from flowloom.llm._common import Workspace
from flowloom.llm.language_id import identify, language_stage, op8_language_id, pages_language_id, source_parts
from flowloom.llm.quality import N_FEATURES, N_SURFACE, RIDGE, expand, features, fit, op4_quality, ranked, scored, tally, train
from tests.llm.conftest import frame


def fewest_edits(text, passage):
    """Between the passage and any part of the text, by the full table."""
    row = np.zeros(len(text) + 1, int)
    for j, p in enumerate(passage, 1):
        new = np.empty_like(row)
        new[0] = j
        for i, t in enumerate(text, 1):
            new[i] = min(row[i - 1] + (t != p), row[i] + 1, new[i - 1] + 1)
        row = new
    return int(row.min())


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = rng.choice("qz")
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, rng.choice("qz"))
    return "".join(out)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_lemma_and_alignment_find_what_the_full_table_finds():
    rng = random.Random(8)
    for _ in range(60):
        passage = prose(rng, 30)[: rng.choice([30, 60, 100])]
        index = dc.Index([(1, passage)], dc.Q, dc.PASSAGE, dc.BUDGET)
        assert len(index.codes) == 1
        e = int(index.edits[0])
        text = dc.normal(prose(rng, 20) + " " + edited(rng, passage, rng.randint(0, e + 2)) + " " + prose(rng, 20))
        codes = dc.symbols(text)
        at, k = index.shared(dc.grams(codes, dc.Q))
        costs = [dc.align(codes, index.codes[p], low, 2 * (e + 1), e)[0] for _, p, low in zip(*(x.tolist() for x in dc.retained(index, np.zeros(len(at), int), at, k)), strict=True)]
        best = min(costs, default=e + 1)
        want = fewest_edits(text, dc.normal(passage))
        assert best == want if want <= e else best > e


def test_leaks(spark, docs, empty, tmp_path, ws, monkeypatch):
    rng = random.Random(2)
    items = [(k, prose(rng, 40)) for k in range(6)] + [(6, "short"), (7, None), (None, prose(rng, 40)), (8, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(100, prose(rng, 60)), (101, prose(rng, 30) + "\n" + items[0][1].upper().replace(" ", "\n ") + " " + prose(rng, 9)), (102, edited(rng, items[1][1], 3)), (103, items[2][1][:150] + prose(rng, 30)), (104, None), (105, ""), (None, items[3][1]), (106, items[8][1])]
    table = frame(spark, rows)
    for block in (dc.BLOCK_CHARS, 300):
        found = {(r.doc_id, r.item_id) for r in dc.contaminated(table, benchmark, Workspace(spark, "test"), block).collect()}
        assert found == {(101, 0), (102, 1), (103, 2), (None, 3), (106, None)}
    assert dc.contaminated(empty, benchmark, ws).collect() == []
    assert dc.contaminated(table, benchmark.limit(0), ws).collect() == []
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    twice = table.unionByName(frame(spark, [(None, "without a number"), (101, "clean, of a repeated number"), (100, None)]))
    for block in (dc.BLOCK_CHARS, 300):
        monkeypatch.setattr(dc, "BLOCK_CHARS", block)
        kept = dc.decontamination_stage(spark, twice, str(tmp_path))
        assert kept.columns == table.columns and sorted((str(r.doc_id), (r.text or "")[:9]) for r in kept.collect()) == sorted([("100", rows[0][1][:9]), ("104", ""), ("105", ""), ("None", "without a"), ("101", "clean, of"), ("100", "")])
    assert dc.decontamination_stage(spark, empty, str(tmp_path)).collect() == []


def test_a_stem_that_all_items_share(monkeypatch):
    """Postings are held some units at a time, with the same result."""
    rng = random.Random(3)
    stem = prose(rng, 8)
    items = [(k, stem + " " + prose(rng, 30)) for k in range(60)]
    docs = [" ".join([stem] * 40), prose(rng, 30) + items[7][1] + prose(rng, 9) + items[8][1][30:140], stem + prose(rng, 50)]
    search = dc.Search(items, dc.Q, dc.PASSAGE, dc.BUDGET)
    whole = search(docs)
    monkeypatch.setattr(dc, "POSTINGS", 500)
    assert search(docs) == whole and {(1, 7), (1, 8)} <= set(whole)


def test_leaks_at_any_offset(spark, ws):
    rng = random.Random(12)
    item = dc.normal(prose(rng, 80))
    benchmark = spark.createDataFrame([(1, item), (2, prose(rng, 80)), (3, "Seven\nYaks")], "item_id long, text string")
    rows = [(k, "qq " + item[k : k + 100] + " zz") for k in range(0, len(item) - 100, 7)]
    rows += [(1000 + k, "qq zz " + edited(rng, item[k : k + 100], 6) + " qq") for k in range(0, len(item) - 100, 29)]
    rows += [(2000, "qq " + item[30:90] + " zz"), (2001, "the seven yaks"), (2002, "seven oxen, yaks")]
    want = {(i, 1) for i, t in rows if fewest_edits(dc.normal(t), item[i % 1000 : i % 1000 + 100]) <= 6 and i < 2000} | {(2001, 3)}
    got = dc.contaminated(frame(spark, rows), benchmark, ws).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) == len(rows) - 2
    assert all(r.edits <= 6 and r.begin < r.end and r.n_passages >= 1 for r in got)


def test_planted_benchmark(spark, sf):
    got = {(r.doc_id, r.item_id) for r in dc.op3_decontamination(spark, sf).collect()}
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    assert {(d.doc_id, b.item_id) for d in docs for b in items if b.text in d.text} <= got


def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = op8_language_id(spark, sf).collect()
    assert len(got) == len(truth) and all(r.kept and 0 < r.posterior <= 1 for r in got)
    assert np.mean([r.lang_id == truth[r.doc_id] for r in got]) > 0.97


def test_text_outweighs_a_wrong_declaration(spark, sf, ws):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("n_chars > 200")
    wrong = docs.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.lit("fr")).otherwise(F.col("lang")))
    got = identify(wrong, ws, **source_parts(wrong["source"])).join(wrong.select("doc_id", "truth"), "doc_id").collect()
    assert np.mean([r.lang_id == r.truth for r in got]) > 0.97


def test_pages(spark, sf):
    got = pages_language_id(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/pages.parquet").count() and np.mean([r.kept for r in got]) > 0.95


def test_pages_truth(spark, sf, tmp_path):
    """The language of pages whose markup is hidden or wrong is known from the text and the rest."""
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/pages.parquet")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    sized = F.length(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", "")) > 400
    truth = {r.page_id: (r.lang, r.long) for r in pages.select("page_id", declared.alias("lang"), sized.alias("long")).collect()}
    hidden = F.when(F.col("page_id") % 5 == 0, F.regexp_replace("html", r"(?i)\blang\s*=", "x=")).when(F.col("page_id") % 5 == 1, F.regexp_replace("html", r"(?i)(<html[^>]*?\blang\s*=\s*[\"']?)[a-z]{2,3}", "$1de")).otherwise(F.col("html"))
    pages.withColumn("html", hidden).write.parquet(str(tmp_path / "pages.parquet"))
    got = [(r, *truth[r.page_id]) for r in pages_language_id(spark, str(tmp_path)).collect()]
    for k in (0, 1, 2):
        own = [r.lang_id == lang for r, lang, long in got if r.page_id % 5 == k and lang and long]
        assert len(own) > 10 and np.mean(own) > 0.9, k


def test_language_edges(spark, docs, empty, ws):
    got = {r.doc_id: r for r in identify(docs, ws, **source_parts(docs["source"])).collect()}
    assert not got[501].kept and not got[502].kept and not got[500].kept and got[506].kept
    assert language_stage(spark, empty, "").collect() == []
    table = docs.unionByName(frame(spark, [(503, None), (None, "123 456"), (None, "alpha beta gamma")]))
    stay = language_stage(spark, table, "")
    assert stay.columns == docs.columns
    texts = [r.text for r in stay.collect()]
    assert None not in texts and "123 456" not in texts and "alpha beta gamma" in texts and "one" in texts
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert not any(r.kept for r in identify(nothing, ws, **source_parts(nothing["source"])).collect())


def test_text_in_no_declared_language_is_rejected(spark, sf, ws):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(300)),
        "".join(rng.choice("bcdfghjklmnpqrstvwxz   ") for _ in range(300)),
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "人人生而自由,在尊严和权利上一律平等。",
    ]
    more = spark.createDataFrame([(-1 - k, t, None, "src1") for k, t in enumerate(odd)], docs.schema)
    got = {r.doc_id: r.kept for r in identify(docs.unionByName(more), ws, **source_parts(F.col("source"))).collect()}
    assert [i for i, kept in got.items() if not kept] and all(kept == (i >= 0) for i, kept in got.items())


def test_every_declared_language_is_learnt(spark, ws):
    rng = random.Random(6)
    rows = []
    for k in range(230):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 8)
        words = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(12)]
        rows += [(4 * k + j, " ".join(rng.choice(words) for _ in range(40)), f"l{k:03d}", None) for j in range(1 if k >= 200 else 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in identify(docs, ws, **source_parts(docs["source"])).collect()}
    assert len(got) == len(rows) and all(got[i].kept and got[i].lang_id == lang for i, _, lang, _ in rows)


def test_quality_on_held_out_rows(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op4_quality(spark, sf).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert held and np.mean([a == b for a, b in held]) > 0.9


def test_quality_edges(spark, docs, empty, rows):
    labels = spark.createDataFrame([(3, 1, 0), (503, 0, 0), (9999, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    assert scored(docs, train(docs, labels)).count() == len(rows)
    for none in (train(docs, labels.limit(0)), train(empty, labels)):
        assert {round(r.score, 6) for r in scored(docs, none).collect()} == {0.3}
    assert scored(empty, train(docs, labels)).collect() == []


def test_threshold_is_a_quantile():
    """As many of the labelled lie below it as are labelled bad, also where no line parts the labels."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, N_FEATURES))
    good = x[:, 0] + 3 * rng.normal(size=300) > 0.4
    assert (fit(x, good).scores(x) < 0.3).sum() == (~good).sum()


def test_words_alone_can_tell(spark):
    """Documents whose characters are alike and whose words are not."""
    rng = random.Random(5)
    kinds = [["abc", "cab", "bca", "dcab"], ["acb", "bac", "cba", "bacd"]]
    rows = [(k, " ".join(rng.choice(kinds[k % 2]) for _ in range(60))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    got = scored(docs, train(docs, labels)).collect()
    assert np.mean([(r.score >= 0.3) == bool(r.doc_id % 2) for r in got if r.doc_id >= 200]) > 0.95


def test_repeated_labels_and_rows(spark):
    rows = [(k % 40, f"text {k % 40} " + ("good words here " if k % 2 else "!!! $$$ ### ") * 20) for k in range(80)] + [(None, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k % 40, k % 2) for k in range(80)] + [(3, 0)], "doc_id long, quality int")
    got = scored(docs, train(docs, labels)).collect()
    assert len(got) == 82 and len({(r.doc_id, r.score) for r in got}) == 41


def test_ranking_learns_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, N_FEATURES))
    good = x[:, 0] + 0.5 * x[:, 3] > 0
    scores = fit(x, good).scores(x)
    assert np.mean((scores >= 0.3) == good) > 0.95


def test_pairs_are_a_parameter():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, N_FEATURES))
    good = x[:, 0] > 0
    few, usual, same = (fit(x, good, **more).weights for more in ({"pairs": 10}, {}, {"pairs": 60_000}))
    assert not np.allclose(few, usual) and np.allclose(usual, same)


def test_all_pairs_are_learnt_from():
    """The gradient of the loss over all pairs, each made, is 0 where learning ends."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, N_FEATURES))
    good = x[:, 0] + x[:, 3] + rng.normal(size=500) > 0.5
    m = fit(x, good)
    z = expand(x, m.mean, m.scale)
    d = (z[good][:, None, :] - z[~good][None, :, :]).reshape(-1, N_FEATURES + N_SURFACE)
    assert np.abs(d.T @ (1 / (1 + np.exp(d @ m.weights))) / len(d) - RIDGE * m.weights).max() < 1e-5


def test_all_labels_are_learnt_from(spark):
    """One label in 25,000 that no other is like counts, whatever its doc_id hashes to; and the threshold is exact."""
    rows = [(k, "fine words" if k % 2 else "fine w0rds") for k in range(25_000)]
    odd = [(k, f"??? {k}") for k in range(30_000, 30_400)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows] + [(k, 0) for k, _ in odd], "doc_id long, quality int")
    m, usable = train(docs, labels), [k for k, _ in rows + odd if zlib.crc32(str(k).encode()) % 5]
    x = features(pa.array([t for k, t in rows + odd if zlib.crc32(str(k).encode()) % 5])).astype(np.float32).astype(float)
    assert len(x) > 20_000 and np.allclose(m.mean, x.mean(axis=0), atol=1e-7) and np.allclose(m.scale, x.std(axis=0) + 1e-9, atol=1e-6)
    same = fit(x, np.array([k < 30_000 and k % 2 == 1 for k in usable]))
    assert np.allclose(m.weights, same.weights, atol=1e-3) and abs(m.cut - same.cut) < 1e-2


@pytest.mark.parametrize("good", [[], [True], [False] * 3, [True, False]])
def test_shares_are_no_integers(good):
    steps, *counts = tally(np.linspace(0, 1, len(good)), np.array(good, bool))
    assert steps.dtype == np.int64 and [x.dtype for x in counts] == [np.float64] * 2
    assert [x.sum() for x in counts] == [sum(good), len(good) - sum(good)]


@pytest.mark.parametrize("most", [1, 2, 7])
def test_batches_of_one_label(spark, most):
    """What is learnt is the same where rows come in batches that hold good documents alone, or bad ones."""
    rows = [(k, "fine words" if k % 3 else "fine w0rds !") for k in range(60)]
    good = {k: (k % 3 > 0) != (k % 5 == 0) for k, _ in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(good[k])) for k, _ in rows], "doc_id long, quality int")
    usable = [(k, t) for k, t in rows if zlib.crc32(str(k).encode()) % 5]
    same = fit(features(pa.array([t for _, t in usable])).astype(np.float32).astype(float), np.array([good[k] for k, _ in usable]))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        m = train(docs, labels)
        got = {r.doc_id: r.score for r in scored(docs, m).collect()}
    finally:
        spark.conf.set(name, was)
    expected = same.scores(features(pa.array([t for _, t in rows])).astype(np.float32).astype(float))
    assert np.allclose(m.weights, same.weights, atol=1e-3) and np.allclose([got[k] for k, _ in rows], expected, atol=1e-3)


def test_ranked_is_exact(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=3000) * 1e-6, np.full(500, 0.25), rng.normal(size=500) * 1e3])
    table = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert all(ranked(table, "v", k) == np.sort(values)[k] for k in (0, 1700, 3300, 3999))


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    assert sorted(pii.permute(k, size, b"key", "t") for k in range(size)) == list(range(size))
    assert [pii.permute(k, 1000, b"key", "t") for k in range(50)] != [pii.permute(k, 1000, b"other", "t") for k in range(50)]


@pytest.mark.parametrize(
    ("text", "kind", "shape"),
    [
        ("pay 4539 1488 0343 6467 now", "card", r"pay 4\d{3} \d{4} \d{4} \d{4} now"),
        ("to GB82 WEST 1234 5698 7654 32.", "iban", r"to GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d\."),
        ("on 1999-02-28, then", "date", r"on (19|20)\d\d-\d\d-\d\d, then"),
        ("on 31.12.2001", "date", r"on \d\d\.\d\d\.(19|20)\d\d"),
        ("ssn 123-45-6789", "ssn", r"ssn \d{3}-\d\d-\d{4}"),
        ("call +1 (415) 555-2671 now", "phone", r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} now"),
        ("call +1 (017) 555-7713 now", "phone", r"call \+1 \(\d{3}\) \d{3}-\d{4} now"),
        ("ip 10.20.30.40.", "ipv4", r"ip \d+\.\d+\.\d+\.\d+\."),
        ("mail bosbt.42@mail8.example.com", "email", r"mail [a-z]{5}\.\d\d@mail8\.example\.com"),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "secret", r'token = "[0-9a-f]{40}"'),
        ("password=e3b3ed3cc8548923d6 x", "secret", r"password=[0-9a-f]{18} x"),
    ],
)
def test_pseudonyms(text, kind, shape):
    new, found = pii.pseudonymised(text)
    assert [k for k, _, _ in found] == [kind] and new != text and re.fullmatch(shape, new)
    assert pii.pseudonymised(f"again {text}")[0] == f"again {new}"  # equal values stay linked
    again, kinds = pii.pseudonymised(new)
    assert [k for k, _, _ in kinds] == [kind]  # what comes out is valid as well
    if kind == "card":
        assert pii.luhn(re.sub(r"\D", "", new)) == 0
    if kind == "iban":
        assert pii.iban_rest(re.search(r"GB[\w ]+\d", new)[0].replace(" ", "")) == 1


@pytest.mark.parametrize("text", ["no data here", "CC BY-NC 4.0.", "Version 2.0.", "9807915762804490", "300.1.2.3", "1999-02-31", "year 2001", "", "000-12-3456", "1.2.3.4.5"])
def test_what_is_not_valid_stays(text):
    assert pii.pseudonymised(text) == (text, [])


@pytest.mark.parametrize(
    ("value", "kind", "rest"),
    [
        ("4111 1111 1111 1111", "card", " 123"),
        ("4111 1111 1111 1111", "card", " 12/27"),
        ("4111-1111-1111-1111", "card", "-123"),
        ("4111111111111111", "card", " 12 times"),
        ("3782 822463 10005", "card", " 1234"),
        ("41111111 11111111", "card", " 123"),
        ("ES9121000418450200051332", "iban", " EUR"),
        ("AT611904300234573201", "iban", " EUROS"),
        ("ES91 2100 0418 4502 0005 1332", "iban", " EUR 12"),
    ],
)
def test_neighbours_do_not_hide_a_number(value, kind, rest):
    alone, _ = pii.pseudonymised(value)
    for before in ("", "12 ", "no. "):
        new, found = pii.pseudonymised(before + value + rest)
        assert new == before + alone + rest and found == [(kind, len(before), len(before) + len(value))]


def test_formats_link_one_number():
    digits = lambda t: re.sub(r"\D", "", pii.pseudonymised(t)[0])
    assert digits("4539 1488 0343 6467") == digits("4539-1488-0343-6467") == digits("4539148803436467")


def test_letter_case_links():
    new = [pii.pseudonymised(f"to {x}@x.com")[0] for x in ("Bob.Lee", "bob.lee", "BOB.LEE")]
    assert len({x.lower() for x in new}) == 1 and new[0].split()[1][0].isupper() and new[1] == new[1].lower()


def test_short_secrets_and_bounds():
    assert pii.pseudonymised("password: hunter2")[1] == [("secret", 10, 17)]
    assert pii.pseudonymised("token: the")[1] == [] and pii.pseudonymised("born 1899-05-05")[1] == []


@pytest.mark.parametrize("text", ["0123456789abcdef" * 65536, "abcdefghij" * 100_000, "a." * 400_000, "a@" * 300_000, "x-" * 300_000 + "@"])
def test_long_words_take_linear_time(text):
    began = time.perf_counter()
    assert pii.pseudonymised(text) == (text, []) and time.perf_counter() - began < 20


def test_pseudonyms_of_documents_by_brute_force(spark, sf):
    """Every value that plain patterns find is taken; nothing but the found places changes; equal values, and only they, are equal after."""
    plain = {
        "email": r"[A-Za-z0-9][A-Za-z0-9.+_-]*@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
        "date": r"(?<![\d.])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])(?!\d)",
        "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])",
    }
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    extra = [(-1, "mail Ann.Lee@x.org, ann.lee@x.org; 2001-02-03 and 123-45-6789.", 9), (-2, "again ann.lee@x.org on 2001-02-03: 123-45-6789", 3)]
    old |= {i: t for i, t, _ in extra}
    got = pii.pseudonyms(spark.createDataFrame([(i, t) for i, t in old.items()], "doc_id long, text string")).collect()
    assert len(got) == len(old)
    to, back, seen = {}, {}, Counter()
    for r in got:
        text, new, at, to_here = old[r.doc_id], r.text, 0, 0
        assert r.n_found == len(r.spans) == len(r.kinds)
        for kind, (a, b) in zip(r.kinds, r.spans, strict=True):
            here = to_here + a - at
            assert text[at:a] == new[to_here:here] and at <= a < b
            to_here = here + (len(re.match(r"\d+(?:\.\d+){3}", new[here:])[0]) if kind == "ipv4" else b - a)
            x, y = (re.sub(r"[\W_]", "", v).lower() if kind in ("card", "iban", "ssn") else v.lower() if kind == "email" else v for v in (text[a:b], new[here:to_here]))
            assert to.setdefault((kind, x), y) == y and back.setdefault((kind, y), x) == x
            at, seen[kind] = b, seen[kind] + 1
        assert text[at:] == new[to_here:]
        taken = [(a, b) for a, b in r.spans]
        for kind, pattern in plain.items():
            for m in re.finditer(pattern, text):
                assert any(a < m.end() and m.start() < b for a, b in taken), (kind, m[0])
        for m in re.finditer(r"(?<!\w)\d{16}(?!\w)", text):
            assert pii.luhn(m[0]) or m[0][0] == "0" or len(set(m[0])) == 1 or any(a <= m.start() and m.end() <= b for a, b in taken)
    assert seen["email"] >= 3 and seen["date"] >= 2 and seen["ssn"] >= 2


def test_pseudonym_table(docs, empty, rows):
    got = pii.pseudonyms(docs).collect()
    assert sorted((str(r.doc_id), r.n_found, r.text or "") for r in got) == sorted((str(i), 0, t or "") for i, t in rows)
    assert pii.pseudonyms(empty).collect() == []
