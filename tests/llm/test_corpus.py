"""Operators that compare texts with each other or learn from them, against brute force."""

import gzip
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from alertlake.llm import line_dedup, ngram_lm, quality_model, simhash, warc
from tests.llm.conftest import cases, prose


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values, linked):
    """The smallest id reachable, for (id, value) rows."""
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if linked(values[i][1], values[j][1]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), k in zip(values, label):
        least[k] = min([x for x in (least.get(k), i) if x is not None], default=None)
    return [least[k] for k in label]


def test_simhash_equals_brute_force(docs, no_docs):
    rows = [(i, _fingerprint(t)) for i, t in cases()]
    close = lambda a, b: (a ^ b).bit_count() <= 3
    want = sorted(((i, f"{fp:016x}", c) for (i, fp), c in zip(rows, _components(rows, close))), key=str)
    got = sorted((tuple(r) for r in simhash.report(docs).collect()), key=str)
    assert got == want
    assert simhash.report(no_docs).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 4 in ids and 6 not in ids and ids.count(15) == 2 and None in ids


def test_simhash_links_are_whole(spark):
    r = random.Random(4)
    centre = [r.getrandbits(64) for _ in range(40)]
    found = set(centre)
    for c in centre:
        for _ in range(12):
            found.add(c ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    found = sorted(simhash._signed(x) for x in found)
    rows = spark.createDataFrame([(x,) for x in found], "fp long").repartition(5)
    got = sorted(tuple(x) for x in simhash.links(rows).collect())
    mask = (1 << 64) - 1
    want = sorted(
        (a, b) for k, a in enumerate(found) for b in found[k + 1 :] if ((a ^ b) & mask).bit_count() <= 3
    )
    assert got == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 30)} | {201: 200}
    assert got == want


def _cut(texts, span):
    """Words left after deleting spans that occurred before, by comparing all spans."""
    first, out = {}, {}
    words = {i: (t or "").encode().split() for i, t in texts}
    gone = defaultdict(set)
    for i in sorted(words):
        for p in range(len(words[i]) - span + 1):
            key = tuple(words[i][p : p + span])
            at = first.setdefault(key, (i, p))
            if at != (i, p):
                gone[i].update(range(max(p, at[1] + span) if at[0] == i else p, p + span))
    for i in words:
        out[i] = (len(gone[i]), [w for k, w in enumerate(words[i]) if k not in gone[i]])
    return out


def test_line_dedup_equals_brute_force(docs, no_docs, monkeypatch):
    texts = {i: t for i, t in cases() if i is not None}
    want = _cut(texts.items(), line_dedup.SPAN)
    for at_once in (line_dedup.WORDS_AT_ONCE, 300):  # chunks of many texts, and of few
        monkeypatch.setattr(line_dedup, "WORDS_AT_ONCE", at_once)
        rows = line_dedup.report(docs).collect()
        assert len(rows) == len(cases())
        for r in rows:
            if r.doc_id is None:
                assert r.text == prose(13, 40) and r.n_removed == 0
            else:
                removed, left = want[r.doc_id]
                assert (r.n_removed, (r.text or "").encode().split()) == (removed, left)
                if not removed:
                    assert r.text == texts[r.doc_id]
    assert line_dedup.report(no_docs).count() == 0
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.n_chars for r in kept.collect()}[2] == 0


def test_line_dedup_of_random_passages(spark):
    r = random.Random(8)
    pieces = [prose(1000 + i, r.choice([20, 49, 50, 51, 80])) for i in range(12)]
    texts = [(i, " ".join([prose(i, 15), *r.choices(pieces, k=3), prose(50 + i, 15)])) for i in range(40)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    want = _cut(texts, line_dedup.SPAN)
    for x in line_dedup.report(rows).collect():
        assert (x.n_removed, x.text.encode().split()) == want[x.doc_id]


def test_texts_that_share_an_id_are_cut_each_by_itself(spark):
    a, b = prose(70, 80), prose(71, 80)
    rows = spark.createDataFrame([(1, a), (1, b), (1, a), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.report(rows).collect())
    assert got == sorted([(1, a), (1, b), (1, a), (2, "")])


def _plain_model(texts):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    count, pairs = Counter(), Counter()
    for i, t in texts:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            w = tokens(t)
            count.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w))
    total, kinds, after = Counter(), Counter(), defaultdict(Counter)
    for (v, w), c in pairs.items():
        total[v] += c
        kinds[w] += 1
        after[v][min(c, 3)] += 1
    n, size = sum(count.values()), len(count)
    d2, d1 = (ngram_lm.discounts([sum(c == i for c in x.values()) for i in range(1, 5)]) for x in (pairs, kinds))
    rest = sum(d1[min(k, 3)] for k in kinds.values()) / max(len(pairs), 1) if pairs else 1.0

    def word(w):
        return (kinds[w] - d1[min(kinds[w], 3)]) / max(len(pairs), 1) + rest / (size + 1)

    def pair(v, w):
        if not total[v]:
            return word(w)
        c = pairs[v, w]
        return (c - d2[min(c, 3)] + sum(d2[k] * m for k, m in after[v].items()) * word(w)) / total[v]

    def score(t):
        w = tokens(t)
        return (
            len(w),
            sum(count[x] > 0 for x in w),
            n,
            sum(math.log10((count[x] + 1) / (n + size + 1)) for x in w),
            sum(math.log10(pair(v, x)) for v, x in zip(["<s>", *w[:-1]], w)),
        )

    vocabulary = [*count, "unseen"]
    assert not pairs or math.isclose(sum(pair("the", w) for w in vocabulary), 1.0)
    return score


def test_language_model_equals_plain_python(spark, docs, no_docs, monkeypatch):
    texts = cases()
    for at_once in (ngram_lm.TOKENS_AT_ONCE, 100):
        monkeypatch.setattr(ngram_lm, "TOKENS_AT_ONCE", at_once)
        score = _plain_model(texts)
        want = sorted(((i, *score(t)) for i, t in texts), key=str)
        got = sorted(
            ((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_lm.report(docs).collect()),
            key=str,
        )
        assert [x[:4] for x in got] == [x[:4] for x in want]
        for x, y in zip(got, want):
            assert x[4:] == pytest.approx(y[4:])
    assert ngram_lm.report(no_docs).count() == 0
    untrained = spark.createDataFrame([(3, "a b")], "doc_id long, text string")
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    only = untrained.selectExpr(f"cast({held} as long) doc_id", "text")
    row = ngram_lm.report(only).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_frequent_counts_are_kept(spark):
    rows = spark.createDataFrame([(i, "a b " * 400) for i in range(10)], "doc_id long, text string")
    score = _plain_model([(i, "a b " * 400) for i in range(10)])
    for r in ngram_lm.report(rows).collect():
        assert r.score == pytest.approx(score("a b " * 400)[4])


def test_quality_model_on_labelled_documents(spark):
    junk = [lambda i: "Buy!! " * (30 + i % 7), lambda i: " ".join(w + "***" for w in prose(i, 60).split())]
    rows = [(i, junk[i % 2](i) if i % 3 == 0 else prose(i, 40 + i % 50)) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int"
    )
    got = {r.doc_id: r for r in quality_model.report(docs, labels).collect()}
    assert len(got) == 303 and all(0 <= r.score <= 1 for r in got.values())
    held = [r for i, r in got.items() if i is not None and i < 300 and r.held_out]
    assert len(held) > 30
    assert sum(r.predicted == (r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    kept = quality_model.keep_predicted(docs.withColumnRenamed("doc_id", "doc_id"), labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got.values())
    plan = docs.select("text")
    made, name = quality_model.with_statistics(plan)
    assert "Python" not in made.select(name)._jdf.queryExecution().executedPlan().toString()


def _plain_statistics(text):
    """The statistics of a text in plain Python."""
    space = " \t\n\x0b\x0c\r"
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(space)]
    n, chars = max(len(words), 1), sum(map(len, words))
    count = lambda pattern: len(re.findall(pattern, text))
    known = {*quality_model.STOP_WORDS, *(w.capitalize() for w in quality_model.STOP_WORDS)}
    return {
        "log_words": math.log1p(len(words)),
        "mean_word": chars / n,
        "symbol_share": count(r"[#*$%&|<>@^~{}\[\]\\_=+]") / n,
        "upper_share": count("[A-ZÀ-ÖØ-Þ]") / max(chars, 1),
        "digit_share": count("[0-9]") / max(chars, 1),
        "mark_share": count("[!?]") / n,
        "distinct_share": len(set(words)) / n,
        "neighbour_share": sum(a == b for a, b in zip(words, words[1:])) / n,
        "stop_share": sum(w in known for w in words) / n,
        "line_words": len(words) / max(len(lines), 1),
        "duplicate_lines": (len(lines) - len(set(lines))) / max(len(lines), 1),
    }


def test_quality_rules_equal_plain_evaluation(spark, docs):
    """Every statistic, rule and score of every row, with columns named as the operator's own."""
    labelled = [(i, k % 2) for k, (i, t) in enumerate(cases()) if i is not None and t is not None]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    named = docs.withColumns(
        {x: F.lit("own") for x in ("statistics", "text_parts", "label", "labelled", "wanted", "features", "score")}
    )
    made, name = quality_model.with_statistics(named)
    assert name == "_statistics" and made.columns == [*named.columns, name]
    known = quality_model.training_labels(labels)
    model = quality_model.train(quality_model.measured(named), known)
    assert model.weights
    rows = made.select("doc_id", "text", name, model.score(name).alias("found")).collect()
    texts = dict(cases())
    scores = {}
    for x in rows:
        plain = _plain_statistics(texts[x.doc_id])
        assert x[name].asDict() == pytest.approx(plain, rel=1e-12)
        total = model.intercept
        for rule, weight in model.weights:
            held = all(plain[c.statistic] > c.limit if c.above else plain[c.statistic] <= c.limit for c in rule)
            total += weight * held
        scores[x.doc_id] = 1 / (1 + math.exp(-total))
        assert x.found == pytest.approx(scores[x.doc_id], rel=1e-9)
    reported = quality_model.report(named, labels).collect()
    assert len(reported) == len(rows)
    assert all(r.score == pytest.approx(scores[r.doc_id], rel=1e-9) for r in reported)
    kept = quality_model.keep_predicted(named, labels)
    assert kept.columns == named.columns
    want = sorted(str(i) for i, _ in cases() if scores[i] >= quality_model.CUT)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_quality_model_without_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_model.report(docs, labels).collect()} == {0.5}
    assert quality_model.report(no_docs, labels).count() == 0


def test_warc_round_trip(spark, tmp_path):
    html = "<html><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<br>two</p><!-- x --><a href='u'>lïnk</a><script>no()</script></body></html>"
    pages = spark.createDataFrame(
        [(1, "http://a/", html), (2, None, None), (3, "http://c/", ""), (1, "http://a/", html), (4, "http://d/", "<p>" + "x " * 50_000)],
        "page_id long, url string, html string",
    )
    responses = warc.from_pages(pages)
    made = warc.derive(responses.drop("page_id"))
    assert made.count() == 10
    rows = made.collect()
    ids = {r.record_id: r for r in responses.collect()}
    for r in rows:
        source = ids[r.refers_to]
        assert r.payload_digest == source.payload_digest and r.target_uri == source.target_uri
        assert r.block_digest == warc.digest_of(bytes(r.block))
    text = {bytes(r.block).decode() for r in rows if r.record_type == "conversion" and r.target_uri == "http://a/"}
    assert text == {"One\ntwo\nlïnk"}
    listed = next(bytes(r.block).decode() for r in rows if r.record_type == "metadata" and r.target_uri == "http://a/")
    assert "title: A & B\r\n" in listed and "source-header-content-type: text/html; charset=utf-8\r\n" in listed

    folder = str(tmp_path / "warc")
    both = responses.drop("page_id").unionByName(made)
    assert sum(r.records for r in warc.write(both.repartition(2), folder).collect()) == 15
    back = warc.read(spark, folder)
    key = lambda r: (r.record_type, r.record_id, r.refers_to, r.target_uri, r.block_digest, bytes(r.block))
    assert sorted(map(key, back.collect()), key=str) == sorted(map(key, both.collect()), key=str)
    again = warc.derive(back.where("record_type = 'response'"))
    assert sorted(map(key, again.collect()), key=str) == sorted(map(key, rows), key=str)
    assert warc.report(pages.limit(0)).count() == 0 and warc.report(pages).count() == 10


def test_warc_codings():
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n3\r\nab\xe9\r\n0\r\n\r\n"
    record = warc.response(1, "u", "") | {"block": chunked}
    meta, text = warc.derivatives(record)
    assert text["block"].decode() == "abé" and "charset: latin-1" in meta["block"].decode()
    image = warc.response(1, "u", "") | {"block": b"HTTP/1.1 404 No\r\nContent-Type: image/png\r\n\r\n\x89PNG"}
    (meta,) = warc.derivatives(image)
    assert "http-status: 404" in meta["block"].decode()
    assert warc.derivatives(meta) == []


def test_warc_http_oddities():
    part = lambda head, body: warc.http_parts(f"HTTP/1.1 {head}\r\n\r\n".encode("latin-1") + body)
    assert part("²00 OK", b"x")[0] is None and part("200 OK", b"x")[0] == 200
    raw = zlib.compressobj(wbits=-15)
    packed = raw.compress(b"plain text") + raw.flush()
    assert part("200 OK\r\nContent-Encoding: deflate", packed)[2] == b"plain text"
    assert part("200 OK\r\nContent-Encoding: deflate", zlib.compress(b"plain"))[2] == b"plain"
    assert part("200 OK\r\nContent-Encoding: gzip", b"no gzip")[2] == b"no gzip"
    chunked = "200 OK\r\nTransfer-Encoding: chunked"
    assert part(chunked, b"3\r\nabc\r\n0\r\n\r\n")[2] == b"abc"
    assert part(chunked, b"3\r\nabc\r\n5\r\nde")[2] == b"3\r\nabc\r\n5\r\nde"


def test_warc_reader_goes_on_behind_damage(spark, tmp_path):
    one, two, three = (warc.serialised(warc.response(k, "u", f"<p>page {k} WARC/1</p>")) for k in range(3))
    ids = [warc.response(k, "u", f"<p>page {k} WARC/1</p>")["record_id"] for k in range(3)]
    bad_length = re.sub(rb"Content-Length: \d+", b"Content-Length: many", two)
    wrong_length = re.sub(rb"Content-Length: \d+", b"Content-Length: 10", two)
    no_end = two.split(b"\r\n\r\n")[0] + b"\r\n"
    plain = {
        "whole": (one + two + three, 3, 0),
        "blank lines": (one + b"\r\n\r\n\r\n" + two + three, 3, 0),
        "junk": (b"junk\n" + one + b"more junk\n" + two + three, 3, 2),
        "length": (one + bad_length + three, 2, 1),
        "short length": (one + wrong_length + three, 3, 1),
        "no end": (one + no_end + three, 2, 1),
        "cut": (one + two + three[:-30], 2, 1),
        "empty": (b"", 0, 0),
        "no file": (b"\x00\xff text", 0, 1),
    }
    packed = [gzip.compress(x) for x in (one, two, three)]
    broken = packed[1][:12] + b"\xff" * 20 + packed[1][32:]
    zipped = {
        "members": (b"".join(packed), 3, 0),
        "padding": (packed[0] + b"\0" * 512 + packed[1] + b"\r\n" + packed[2], 3, 0),
        "broken member": (packed[0] + broken + packed[2], 2, 1),
        "cut member": (packed[0] + packed[1][:-40], 1, None),
    }
    for name, (raw, records, other) in (plain | zipped).items():
        found = list(warc.parsed(raw))
        good = [r for r in found if r["record_type"] != warc.UNPARSED]
        assert len(good) == records, name
        assert other is None or len(found) - len(good) == other, name
        assert {r["record_id"] for r in good} <= set(ids)
        if records >= 2 and "length" not in name:
            assert good[0]["record_id"] == ids[0]
    (tmp_path / "a.warc").write_bytes(plain["junk"][0])
    (tmp_path / "b.warc.gz").write_bytes(zipped["broken member"][0])
    counts = {r.record_type: r["count"] for r in warc.read(spark, str(tmp_path)).groupBy("record_type").count().collect()}
    assert counts == {"response": 5, "unparsed": 3}
