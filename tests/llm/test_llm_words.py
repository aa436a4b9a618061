"""Substring de-duplication, collocations and token alignment against brute force, with the hard rows of every kind."""

import hashlib
import re
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pyarrow.parquet as pq
import pytest

from plantframe.llm import alignment, collocations, queries, substring_dedup, words

A, B = queries.tokenizer(), queries.tokenizer("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, block long, told string, n long"


def frame(spark, rows, parts=3):
    """Rows (id, text, language) with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "told", 9) for r in rows], SCHEMA).repartition(parts)


def passages(seed, docs, vocabulary=12, sizes=(0, 60)):
    rng = Random(seed)
    known = [rng.choice(["Ab", "é", "ß", "x"]) + str(i) for i in range(vocabulary)]
    shared = [[rng.choice(known) for _ in range(rng.randint(5, 40))] for _ in range(6)]
    for i in range(docs):
        text = [rng.choice(known) for _ in range(rng.randint(*sizes))]
        for _ in range(rng.randint(0, 2)):
            own = rng.choice(shared)
            text += own[rng.randint(0, 3) : len(own) - rng.randint(0, 3)] + [rng.choice(known) for _ in range(rng.randint(0, 9))]
        yield i, "".join(w + rng.choice([" ", "  ", "\n", "\t\r", " \x0b"]) for w in text)


def test_words_of_bytes():
    import pyarrow as pa

    texts = ["", " ab  c\n", "é", "x", None, "\t", "q r"]
    flat, offsets = words.as_bytes(pa.array(texts)[1:])
    starts, ends, counts = words.split(flat, offsets)
    assert [flat[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "c", "é", "x", "q", "r"]
    assert counts.tolist() == [2, 1, 1, 0, 0, 2]
    some = words.Hashes(3)
    big = np.frombuffer(b"ab " * 700_000 + b"ab", np.uint8)
    starts, ends, _ = words.split(big, np.array([0, len(big)]))
    assert len(set(some.of(big, starts, ends).tolist())) == 1
    assert words.from_five(words.to_five(np.array([1, 1 << 39, (1 << 45) + 5], np.uint64))).tolist() == [1, 1 << 39, 5]


@pytest.mark.parametrize("window", [1, 2, 5, 13, 30])
def test_covers_meet_in_every_window(window):
    period, on = substring_dedup.cover(window)
    for i in range(period):
        for j in range(period):
            assert any(on[(i + k) % period] and on[(j + k) % period] for k in range(period))
    assert 2 * period <= window + 1


def without_repeats(rows, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, i), i)
    for i, w in split:
        gone = {p for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        yield i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)


@pytest.mark.parametrize("window,block_bytes,shard_bytes", [(13, 4_000_000, 16_000_000), (13, 1500, 4000), (5, 700, 1 << 30), (1, 500, 900)])
def test_substrings(spark, window, block_bytes, shard_bytes):
    rows = [*passages(window, 80), (None, "a b c d e f g h i j k l m n"), (900, "a b c d e f g h i j k l m n"), (901, "a b c d e f g h i j k l m n"), (901, "a b c d e f g h i j k l m n")]
    rows += [(902, None), (903, ""), (904, " \n "), (905, "w" * 100_000), (906, "many " * 30_000), (907, "many " * 20)]
    found = substring_dedup.dedup_substrings(frame(spark, [(*r, "x") for r in rows]), window=window, block_bytes=block_bytes, shard_bytes=shard_bytes)
    assert found.columns == ["doc_id", "kept_text", "n_words", "n_removed"]
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect())
    assert got == Counter(without_repeats(rows, window))


def test_substrings_of_nothing(spark):
    assert substring_dedup.dedup_substrings(frame(spark, []).limit(0)).count() == 0


def phrases(rows, longest, least, cover, top):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").encode().lower().decode()):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            count.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {g: a for g, a in count.items() if a >= least and len(g) > 2}
    by = defaultdict(list)
    for (lang, *w), a in often.items():
        if any(o[0] == lang and len(o) > len(w) + 1 and 100 * n >= cover * a and any(list(o[i : i + len(w)]) == w for i in range(1, len(o) - len(w) + 1)) for o, n in often.items()):
            continue
        cuts = [(1000 * a * total[lang] // (count[(lang, *w[:k])] * count[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        by[lang].append((-score, -a, " ".join(w).encode(), count[(lang, *w[:k])], count[(lang, *w[k:])]))
    for lang, own in by.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, total[lang], -score


@pytest.mark.parametrize("longest,trigger,cover,top,block_bytes,shard_bytes", [(5, 32, 100, 2000, 6_000_000, 16_000_000), (5, 3, 60, 20, 900, 2000), (3, 1, 100, 7, 400, 1 << 30), (2, 4, 100, 50, 3000, 500)])
def test_collocations(spark, longest, trigger, cover, top, block_bytes, shard_bytes):
    rng = Random(longest)
    rows = [(t.replace("3 ", "3, ").replace("Ab5", "Ab5."), rng.choice(["en", "de", None, "und"])) for _, t in passages(8, 120)]
    rows += [(None, "en"), ("", "en"), (" .,\n", "en"), ("go " * 5000, "fr"), ("w" * 50_000, "fr"), ("one two three", "fr")] + [("x0 x0 x0 x0 x0 x0", "fr")] * 20
    found = collocations.collocations(frame(spark, [(i, *r) for i, r in enumerate(rows)]), longest=longest, trigger=trigger, min_count=9, cover=cover, top=top, block_bytes=block_bytes, shard_bytes=shard_bytes)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(phrases(rows, longest, 9, cover, top))


def test_collocations_of_nothing(spark):
    assert collocations.collocations(frame(spark, []).limit(0)).count() == 0


def test_chunks_are_cut_by_content():
    import pyarrow as pa

    passage = " ".join(f"w{i}" for i in range(400))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 2), pa.array([passage, f"other words before. {passage}"])], names=["lang", "text"])
    (found,) = collocations._parse(5, 8)([batch])
    assert sum(n == 2 for n in found["n"].to_pylist()) > 20 and sum(n == 1 for n in found["n"].to_pylist()) <= 3


def test_products():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 3, (40, 30)) * (rng.random((40, 30)) < 0.2), rng.integers(0, 3, (30, 25)) * (rng.random((30, 25)) < 0.2)

    def rows(m):
        return alignment.Rows(np.concatenate([[0], np.cumsum((m > 0).sum(1))]), np.nonzero(m)[1], m[m > 0])

    for expanded in (1, 7, 10_000):
        found, dense = alignment.product(rows(a), rows(b), 25, expanded), np.zeros((40, 25), int)
        dense[np.repeat(np.arange(40), np.diff(found.ptr)), found.columns] = found.values
        assert (dense == a @ b).all()


HARD = [
    "", None, " ", "  ", "a", "Hello, world! It's <|endoftext|> <s> here</s>", "ñandú  über\n\n  straße\tx\r\ny ", "\n", " \nlead", "日本語 text ▁ mark", "日本語のテキスト", "é ﬁ ½     z\x1c\x00!", "😀😃 ok",
    "trailing ", "\ttab", "x  y", "word " * 1000, "q" * 3000, "The the THE don't, won't; 12345 67,89.", "The the THE don't, won't; 12345 67,89.",
]


def aligned():
    """Per text of HARD: tokens of A and B with their bytes' places, groups and links."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    values = alignment._byte_values()
    a_bytes = {i: bytes(values[c] for c in e) for e, i in one.get_vocab().items() if all(c in values for c in e)}
    b_bytes = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in range(two.get_piece_size())]

    def spans(ids, own):
        end = np.cumsum([len(own[i]) for i in ids]).tolist()
        return [(e - len(own[i]), e, i) for e, i in zip(end, ids)]

    for text in HARD:
        full = (" " + (text or "")).encode()
        a, b = (spans(one.encode(full.decode(), add_special_tokens=False).ids, a_bytes), spans(two.encode(text), b_bytes)) if text else ([], [])
        if any(b"".join(own[i] for *_, i in x) != full for x, own in ((a, a_bytes), (b, b_bytes))):
            a = b = []
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        group = lambda x: sum(e < x[1] for e in ends)  # noqa: E731, B023
        by_group = [([x for x in a if group(x) == g], [y for y in b if group(y) == g]) for g in range(len(ends))] if len(a) < 200 else None
        linked = [(i, j, min(x[1], y[1]) - max(x[0], y[0])) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]]
        yield text, a, b, ends, by_group, linked


@pytest.fixture(scope="module")
def brute():
    return list(aligned())


@pytest.mark.parametrize("slice_pairs", [2_000_000, 40])
def test_alignment(spark, brute, slice_pairs):
    linked = [[(a[i][2], b[j][2]) for i, j, _ in links] for _, a, b, _, _, links in brute]
    count, best = Counter(p for own in linked for p in own), defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(HARD)]
    found = alignment.align(frame(spark, rows), A, B, with_groups=True, slice_pairs=slice_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    left = found.collect()
    for (i, *_), own, (text, a, b, ends, by_group, _) in zip(rows, linked, brute):
        r = next(r for r in left if (r.doc_id, r.n_a, r.n_links) == (i, len(a), len(own)) and (by_group is None or r.groups.count("|") == len(ends)))
        left.remove(r)
        assert (r.n_b, r.n_groups) == (len(b), len(ends)), text
        assert (r.n_best, r.count_sum) == (sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own)), text
        if by_group is not None:
            assert r.groups == ";".join(",".join(str(x[2]) for x in p) + "|" + ",".join(str(x[2]) for x in q) for p, q in by_group), text
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if a else ""), text
    assert not left and sum(len(own) for own in linked) > 1000


def test_links(spark, brute):
    short = [(i, *x) for i, x in enumerate(brute) if len(x[1]) < 200]
    docs = frame(spark, [(i, t, "x") for i, t, *_ in short])
    found = Counter((r.doc_id, r.a_at, r.b_at, r.shared) for r in alignment.links(docs, A, B).collect())
    assert found == Counter((i, *own) for i, *_, links in short for own in links)
    groups = Counter(r.doc_id for r in alignment.links(docs, A, B, by="groups").collect())
    assert groups == Counter({i: n for i, *_, by_group, _ in short if (n := sum(len(p) * len(q) for p, q in by_group))})


def test_alignment_of_nothing(spark):
    assert alignment.align(frame(spark, []).limit(0), A, B).count() == 0


def test_staged_chunks_come_back_in_small_row_groups(spark, monkeypatch):
    made, real = [], alignment.staged
    monkeypatch.setattr(alignment, "GROUP_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(alignment, "staged", lambda *args: made.append(real(*args)) or made[-1])
    rng = np.random.default_rng(4)
    texts = [" ".join(f"word{i}" for i in rng.integers(0, 3000, 60_000)) for _ in range(10)]
    found = alignment.align(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), A, B)
    assert found.count() == 10
    groups = [f.row_group(i) for path in made[0].inputFiles() for f in [pq.ParquetFile(path.removeprefix("file://")).metadata] for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 10
    assert max(g.total_byte_size for g in groups) < 2 << 20
