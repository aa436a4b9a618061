"""The other operators against brute force, round trips and held-out labels."""

import math
import struct
import textwrap
import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plantframe.llm import importance, language_model, licenses, mixing, packing, rabitq, warc
from plantframe.llm.queries import tokenizer

ROOT = "/root/testdata/sf0.01"


def test_configurations_hold_all_items():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.choice(np.arange(130, 2049), 20, replace=False))[::-1]
    counts = rng.integers(1, 400, 20)
    plan = packing.best_configurations(sizes, counts, 2048)
    assert (sum(column * times for column, times in plan) == counts).all()
    assert all(column @ sizes <= 2048 and times > 0 for column, times in plan)


def test_best_fit_places_every_item():
    spaces, lengths = {100: 3, 40: 5, 7: 9}, {90: 2, 40: 4, 6: 30, 1: 11}
    fills, fresh = packing.best_fit(spaces, lengths, 2048)
    placed = Counter()
    for space, content, n in fills:
        assert sum(content) <= space
        placed.update({x: content.count(x) * n for x in set(content)})
    for content, n in fresh:
        assert sum(content) <= 2048
        placed.update({x: content.count(x) * n for x in set(content)})
    used = Counter()
    for space, _, n in fills:
        used[space] += n
    assert placed == Counter(lengths) and all(used[s] <= spaces[s] for s in used)


def test_tokens_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    texts = ["", " ", "a  b\n\n c", "don't I'll <|endoftext|> x", "naïve    x\x1cy\x85z 你好 😀 123abc", "\t\tx \r\n ", "x" * 5000]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, tokenizer())]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark):
    rng = Random(2)
    rows = [(i, " ".join(rng.choice(["tree", "xq", "and so"]) for _ in range(rng.choice([1, 5, 40, 300, 900, 2600])))) for i in range(150)]
    rows += [(None, "no id"), (3, "again"), (900, None), (901, "")]
    frame = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, length long, bin string")
    found = packing.pack_documents(frame, tokenizer(), with_ids=True).collect()
    bins, docs = defaultdict(list), Counter()
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == r.length and (r.piece == 0 or r.length == 2048)
        docs[r.doc_id] += r.piece == 0
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 2048
    assert docs == Counter(i for i, _ in rows)
    assert len(bins) <= 1.1 * sum(r.length for r in found) / 2048 + 2
    assert packing.pack_documents(frame.limit(0), tokenizer()).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 32)).round(3)
    vectors[700:760] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5100, [0.0] * 32), (5200, [math.nan] * 32), (5300, [None] * 32), (5400, [math.inf] * 32), (5500, [1.0] * 31), (None, [1.0] * 32), (1, vectors[1].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = defaultdict(list)
    for r in rabitq.nearest(frame, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert sorted(found) == list(range(0, 1500, 100))
    hits = 0
    for q, near in found.items():
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        want = np.lexsort((np.arange(1500), far))[:10]
        assert [s for _, s in near] == sorted(s for _, s in near) and np.allclose([s for _, s in near], far[[i for i, _ in near]], atol=1e-12)
        hits += len(set(want) & {i for i, _ in near})
    assert hits >= 0.9 * 150
    assert [i for i, _ in found[100]] == list(range(700, 710))
    few = frame.filter("vec_id < 4")
    assert rabitq.nearest(few, F.col("id") == 0).count() == 3
    assert rabitq.nearest(frame.limit(0), F.col("id") % 100 == 0).count() == 0


def test_archives(spark, tmp_path):
    rng = Random(1)
    rows = [(i, f"http://h/{i}", f"<html>{rng.choice('ab')} page {i % 30} é" + "<p>text</p>" * (i % 7)) for i in range(90)]
    rows += [(100, None, None), (101, "u\r\nX: y", ""), (None, "n", rows[5][2]), (5, "again", rows[5][2]), (102, "long", "z" * 500_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = f"file://{tmp_path}/archives"
    written = warc.write_archives(frame, folder, archive_bytes=2000).collect()
    assert sum(r.records for r in written) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = sorted(((i, len((h or "").encode()), warc.payload_digest((h or "").encode()), *(("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))) for i, _, h in rows), key=repr)
    back = warc.read_archives(spark, folder)
    assert sorted((tuple(r) for r in back.drop("url", "payload").collect()), key=repr) == want
    assert {bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()} == {h or "" for *_, h in rows}
    name = next((tmp_path / "archives").glob("*.warc.zst"))
    assert struct.unpack_from("<I", name.read_bytes())[0] == warc.DICTIONARY_FRAME
    assert warc.write_archives(frame.limit(0), f"file://{tmp_path}/none").count() == 0


def test_kth_largest(spark):
    values = [int(x) for x in np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 500)] + [7, 7, 7, -1]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for k in 1, 250, 504:
        assert importance.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(frame, "v", 600) is None


def test_resampling_tells_held_out_documents_apart(spark):
    docs, labels = (spark.read.parquet(f"{ROOT}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = importance.resample(docs, importance.target_ids(labels.filter(~fold)), share=importance.good_share(labels.filter(~fold)))
    held = found.join(labels.filter(fold), "doc_id").toPandas()
    good, bad = (held[held.quality == q].log_weight.to_numpy() for q in (1, 0))
    assert (good[:, None] > bad).mean() > 0.9
    assert held[held.quality == 1].kept.mean() > 0.9
    assert found.count() == docs.count()


def test_resampling_edges(spark):
    frame = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (None, "", "z"), (1, "a b", "x")], "doc_id long, text string, _key string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = importance.resample(frame, importance.target_ids(none)).collect()
    assert all(r.kept and r.log_weight == 0 for r in found) and len(found) == 4
    assert importance.resample(frame, importance.target_ids(none), k=2).filter("kept").count() in (2, 3)
    assert importance.keep_good(frame, none).columns == frame.columns
    assert importance.keep_good(frame.limit(0), none).count() == 0


def test_probabilities_sum_to_one_and_training_helps():
    words = language_model.Words([b"a", b"b", b"c"])
    row, places, _ = language_model.numbers(["a b c " * 400], words)
    model = language_model.fresh(0)
    total = 0.0
    for i in range(language_model._PAD):
        other = row.copy()
        other[places[5]] = i
        total += np.exp(language_model.log_probabilities(model, other, places[5:6]))[0]
    assert abs(total - 1) < 1e-3
    before = language_model.log_probabilities(model, row, places).mean()
    squares = {n: np.zeros(s, np.float32) for n, s in language_model._SHAPES.items()}
    for _ in range(30):
        language_model.train_step(model, squares, row, places, 0.1)
    assert language_model.log_probabilities(model, row, places).mean() > before + 3


def test_words_are_split_and_numbered_without_a_python_step_for_each(monkeypatch):
    texts = ["".join(f"A{chr(c)}b" for c in range(300)), None, "", " \t", "  The\x0bthe\x0c THE ", "\u00c4\u00a0\u00e4 \u2003 x", "the end", "\r\n"]
    expected = [(t or "").encode().lower().split() for t in texts]
    whole = pa.array(["not read", *texts], pa.string()).slice(1)
    sizes, flat = language_model.split_all(whole)
    assert sizes.tolist() == [len(x) for x in expected] and flat.to_pylist() == [w for x in expected for w in x]
    monkeypatch.setattr(language_model, "_CHUNK", 10)
    monkeypatch.setattr(language_model, "_COUNTED", 3)
    counts = Counter()
    for batch in language_model._count(iter([pa.RecordBatch.from_arrays([whole], names=["text"])] * 2)):
        for word, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[word] += n
    assert counts == Counter(2 * [w for x in expected for w in x])
    words = language_model.Words([b"the", b"x"])
    row, places, doc = language_model.numbers([t or "" for t in texts], words)
    shared = language_model._PAD - language_model.RARE
    assert row[places].tolist() == [{b"the": 0, b"x": 1}.get(w, shared + zlib.crc32(w) % language_model.RARE) for x in expected for w in x]
    assert doc.tolist() == [i for i, x in enumerate(expected) for _ in x]


def test_scores(spark):
    rows = [(i, "the tree stands in the wood " * 5) for i in range(40)] + [(100, "wood the in stands tree the " * 5), (101, None), (102, " "), (None, "x"), (0, "the tree stands in the wood " * 5)]
    found = language_model.score(spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, log_likelihood double")).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and by[101].n_words == 0 and by[101].log_likelihood == 0 and by[101].mean_log_likelihood is None
    assert by[1].n_words == 30 and by[1].log_likelihood == by[2].log_likelihood > by[100].log_likelihood
    assert language_model.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_scores_of_a_fixed_network_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"W{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 200)) % 4000) for _ in range(120)] + ["", None, "w1", "w1\tnever\nW1"]
    monkeypatch.setattr(language_model, "fit", lambda chunks, classes, rounds, seed: language_model.fresh(3, classes))
    monkeypatch.setattr(language_model, "_CHUNK", 3000)
    monkeypatch.setattr(language_model, "_SHARD", 50)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in language_model.score(frame).collect()}
    words = [[w.lower().encode() for w in (t or "").split()] for t in texts]
    counts = Counter(w for t in words for w in t)
    own = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:768])}
    number = {w: own.get(w, 768 + zlib.crc32(w) % 256) for w in counts}
    totals = Counter()
    for w in counts:
        totals[number[w]] += counts[w]
    m = {n: v.astype(float) for n, v in language_model.fresh(3).items()}
    assert len(counts) > 900

    def normal(x):
        return x - x.max() - math.log(np.exp(x - x.max()).sum())

    for i, t in enumerate(words):
        ids, total = [1024] * 2 + [number[w] for w in t] + [1024] * 2, 0.0
        for k, w in enumerate(t):
            around = [ids[k], ids[k + 1], ids[k + 3], ids[k + 4]]
            h = np.tanh(m["bias"] + sum(m["embed"][x] * m["place"][j] for j, x in enumerate(around)))
            group, member = number[w] % 32, number[w] // 32
            total += normal(m["classes"] @ h + m["class_bias"])[group] + normal(m["members"][group] @ h + m["member_bias"][group])[member]
            total += 0 if w in own else math.log(counts[w] / totals[number[w]])
        assert found[i].n_words == len(t) and found[i].log_likelihood == pytest.approx(total, abs=1e-3)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    row = np.concatenate([[1024] * 2, rng.integers(0, 1024, 9), [1024] * 2]).astype(np.int32)
    at = np.array([2, 4, 5, 9])
    model = language_model.fresh(2)
    squares = {n: np.zeros(s, np.float32) for n, s in language_model._SHAPES.items()}
    language_model.train_step({n: v.copy() for n, v in model.items()}, squares, row, at, 0.1)
    places = {"embed": [(row[3], 5), (row[7], 0)], "place": [(1, 3), (2, 7)], "bias": [(4,)], "classes": [(row[4] % 32, 2)], "class_bias": [(row[9] % 32,)], "members": [(row[5] % 32, row[5] // 32, 1)], "member_bias": [(row[2] % 32, row[2] // 32)]}
    for name, some in places.items():
        for where in some:
            sides = []
            for d in (0.05, -0.05):
                other = {n: v.copy() for n, v in model.items()}
                other[name][where] += d
                sides.append(language_model.log_probabilities(other, row, at).astype(float).mean())
            assert math.sqrt(squares[name][where]) == pytest.approx(abs(sides[0] - sides[1]) / 0.1, rel=0.03, abs=2e-4), (name, where)


def test_the_vocabulary_grows_with_the_corpus(spark):
    small, large = (language_model.classes_of(spark.createDataFrame([(b"a", n)], "word binary, n long")) for n in (10**7, 10**10))
    assert 32 < small < large and language_model.classes_of(spark.createDataFrame([], "word binary, n long")) == 32


def test_words_with_one_id_have_their_own_probabilities(spark):
    share = {}
    words = [(f"w{i}", 1 + i % 7) for i in range(900)]
    frame = spark.createDataFrame([(w.encode(), n) for w, n in words], "word binary, n long")
    totals = defaultdict(int)
    for w, n in words:
        totals[zlib.crc32(w.encode()) % language_model.RARE] += n
    found, least = language_model.shares(frame, [b"w0"])
    totals[zlib.crc32(b"w0") % language_model.RARE] -= 1
    for r in found.collect():
        share[bytes(r.word).decode()] = r.share * language_model._GRID
    assert set(share) == {w for w, _ in words[1:]}
    assert all(abs(share[w] - math.log(n / totals[zlib.crc32(w.encode()) % language_model.RARE])) < 1e-6 for w, n in words[1:])
    assert least * language_model._GRID < min(share.values())


def test_rare_words_score_below_commoner_ones_with_the_same_id(spark):
    filler = " ".join(f"common{i} common{i}" for i in range(768))
    same = defaultdict(list)
    for i in range(3000):
        same[zlib.crc32(f"r{i}".encode()) % language_model.RARE].append(f"r{i}")
    a, b = next(x for x in same.values() if len(x) > 1)[:2]
    rows = [(i, filler + " " + filler) for i in range(6)] + [(100, a), (101, b), (102, b), (103, b), (104, f"{a} {a.upper()}"), (None, a), (105, None)]
    found = {r.doc_id: r for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    # Four times a, three times b, under one id: the network's part is the same, the shares are 4/7 and 3/7.
    assert abs(found[100].log_likelihood - found[101].log_likelihood - math.log(4 / 3)) < 1e-5
    assert found[None].log_likelihood == pytest.approx(found[100].log_likelihood) and found[101].log_likelihood == pytest.approx(found[103].log_likelihood)
    assert found[104].n_words == 2 and found[105].log_likelihood == 0


def test_licences(spark):
    whole = ". ".join(licenses.SENTENCES[n] for n in ("MITGrant", "MITNotice", "AsIs", "NoLiability")) + "."
    texts = {1: f"Some prose here.\n{whole}\nMore prose. Released under the MIT license", 2: "Licensed under the Apache License, Version 2.0.", 3: None, 4: "", 5: "word " * 50_000 + ".\nAll rights reserved.", 6: licenses.SENTENCES["BSDRedistribution"] + ":\nwords. Licensed under CC BY-NC 4.0.\nLicensed under CC0 1.0"}
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert [found[i].licenses for i in range(1, 7)] == ["MIT", "Apache-2.0", None, None, "AllRightsReserved", "CC-BY-NC-4.0,CC0-1.0"]
    assert found[6].left_over == "BSDRedistribution" and found[1].left_over == "" and found[3].n_sentences == 0
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licences_among_very_many_repeats(spark):
    url, known = "http://example.org/a", "All rights reserved"
    runs = {"urls on lines": f"\n{url}", "urls on a line": f" {url}", "blank lines": "\n", "marks": "\n * #", "numbers": "\n1. 2.", "words": " a b\nc",
            "urls apart": f"\n{url}\n\n{url} and", "known": f".\n{known}", "points": ". ; !", "own marks": "\u0002\n"}
    texts = [(name, known + part * 100_000 + f"\n{known}.") for name, part in runs.items()]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {r.doc_id: r.licenses for r in found} == dict.fromkeys(runs, "AllRightsReserved")
    short = licenses.scan(spark.createDataFrame([(n, t) for n in range(7) for t in (known + f"\n{url}" * n, known + f"\n{url}" * n + " more")], "doc_id long, text string"))
    assert {(r.licenses, r.n_sentences) for r in short.collect() if r.doc_id} == {("AllRightsReserved", 1)}
    apart = [f"{known} {url}\n{url} {url}\n{url}\n{url} more", f"{url}\n{url}\n{known}\n{url}", f"{known} {url} {url} more\n{url}"]
    assert [r.licenses for r in licenses.scan(spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string")).orderBy("doc_id").collect()] == ["AllRightsReserved"] * 2 + [None]


def test_licences_as_they_are_printed(spark):
    said = licenses.SENTENCES

    def printed(names, width, mark="", number=False, gap="\n\n"):
        parts = [(f"{i}. " if number and i else "") + said[n] + "." for i, n in enumerate(names)]
        return gap.join("\n".join(f"{mark}{x}" for x in textwrap.wrap(p, width)) for p in parts)

    mit, bsd = ["MITGrant", "MITNotice", "AsIs", "NoLiability"], ["BSDRedistribution", "BSDSource", "BSDBinary", "BSDEndorse"]
    gpl, url = ["GPL2Free", "GPLHope"], "http://www.apache.org/licenses/LICENSE-2.0"
    apache = [said["ApacheLicensedThe"] + ";\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at"]
    apache += [printed(["ApacheUnless", "ApacheSee"], 70, gap="\n")]
    texts = [("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + printed(mit, 78))]
    texts += [("MIT", "x = 1\n" + printed(mit, 70, mark, gap=f"\n{mark.rstrip()}\n")) for mark in ("# ", "// ", " * ", ";; ", "-- ")]
    texts += [("MIT", printed(mit, 72).replace("\n", end)) for end in ("\r\n", "\r")]
    texts += [("BSD-3-Clause", printed(bsd[:3], 74, number=True) + "\n\n3. " + said[bsd[3]] + "."), ("BSD-2-Clause", printed(bsd[:3], 74, " * ", True, "\n"))]
    texts += [("BSD-2-Clause", printed(bsd[:3], 9999, number=True, gap=" ")), ("BSD-2-Clause", printed(bsd[:3], 72, number=True).replace("1. ", "(1) ").replace("2. ", "b) "))]
    texts += [("GPL-2.0-or-later", printed(gpl, 70, "// ")), ("Apache-2.0", f"{apache[0]}\n\n    {url}\n\n{apache[1]}"), ("Apache-2.0", f"{apache[0]} {url}\n{apache[1]}")]
    texts += [("Apache-2.0", "\n".join(f"# {x}" for x in f"{apache[0]}\n\n    <{url}>\n\n{apache[1]}".split("\n")))]
    texts += [("AllRightsReserved", "Copyright 2020 Some One\nAll rights\nreserved"), ("CC0-1.0", "a line\nLicensed under CC0 1.0\nanother")]
    texts += [(None, "All rights\n\nreserved"), (None, "All rights.\nReserved"), (None, "not all rights\nreserved"), (None, f"1. {url}\n2. words")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")).collect()}
    assert [found[i].licenses for i in range(len(texts))] == [x for x, _ in texts]
    assert all(found[i].left_over == "" for i in range(len(texts)))
    assert found[len(texts) - 1].sentences == "-;"


def mixture(spark):
    rng = Random(3)
    rows = [(i, "w " * rng.randint(0, 30), "big" if i % 3 else rng.choice(["a", "b", None])) for i in range(600)] + [(1, None, "a"), (1, None, "a")]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, epoch int")


@pytest.mark.parametrize("options", [{}, {"max_repeats": 3.5}, {"entropy": 1.2}, {"budget": 2500, "block_tokens": 100}])
def test_mixing(spark, options):
    rows, frame = mixture(spark)
    tokens = defaultdict(int)
    for _, t, s in rows:
        tokens[s] += len((t or "").split()) + 1
    found = mixing.mix_plan(frame, **options).collect()
    spent, weight, most = defaultdict(int), {}, {s: max(len((t or "").split()) + 1 for _, t, x in rows if x == s) for s in tokens}
    for r in found:
        spent[r.source] += r.n_tokens
        weight[r.source] = r.weight
    assert abs(sum(weight.values()) - 1) < 1e-6
    total = options.get("budget") or max(tokens[s] / weight[s] for s in tokens)
    for s in tokens:
        assert weight[s] * total - most[s] - 1 <= spent[s] <= weight[s] * total + 1e-3
        whole = math.floor(weight[s] * total / tokens[s] + 1e-9)
        times = Counter(r.doc_id for r in found if r.source == s)
        rows_of = Counter(i for i, _, x in rows if x == s)
        assert all(whole * n <= times[i] <= (whole + 1) * n for i, n in rows_of.items())
    if "entropy" in options:
        assert abs(-sum(w * math.log(w) for w in weight.values()) - 1.2) < 1e-3
    elif "budget" not in options:
        limit = options.get("max_repeats", 2.0)
        repeats = [weight[s] * total / tokens[s] for s in tokens]
        assert max(repeats) <= limit + 1e-6 and max(repeats) > limit - 0.01 and min(repeats) > 1 - 1e-9


def test_mixing_edges(spark):
    _, frame = mixture(spark)
    assert mixing.mix(frame).columns == frame.columns
    assert mixing.mix(frame).count() == mixing.mix_plan(frame).count()
    assert mixing.mix(frame.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.staged(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.columns == columns and all(texts[r.doc_id] == r.text for r in docs.collect()), name
    ids = Counter(r.doc_id for r in docs.collect())
    packed = corpus_pipeline.STAGES[4][1](spark, docs, "/root/testdata/sf0.001")
    assert Counter(r.doc_id for r in packed.filter("piece = 0").collect()) == ids
