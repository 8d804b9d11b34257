"""The operators against brute force on small tables, and their edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakframe.llm import pii
from cloakframe.llm.components import components
from cloakframe.llm.decontamination import contaminated
from cloakframe.llm.hilbert import hilbert_index, hilbert_shards, label_number, size_number
from cloakframe.llm.jaccard_join import Keys, jaccard_components, light_boundary
from cloakframe.llm.language_id import codewords, predict, train
from cloakframe.llm.license_scan import scan
from cloakframe.llm.packing import best_fit_decreasing, pack
from cloakframe.llm.suffix_dedup import remove_repeats
from cloakframe.llm.topk_search import top_k

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, spans string, component_id long"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], x, "en", "s", 0, "clash", -1) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def words(text):
    low = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    return re.findall(rb"[^\x20\x09-\x0d]+", low)


def brute_jaccard(texts, size, threshold):
    sets = {}
    for i, x in enumerate(texts):
        w = words(x)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = dict.fromkeys(sets)
    for i in root:
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and 100 * n >= threshold * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def similar_texts(seed):
    rng = np.random.default_rng(seed)
    out = [None, "", " \n", "a", "A", "a b", "a b c", "A b C", "é É"]
    for n in (5, 10, 12, 20, 21, 40, 100, 300):
        base = [f"w{k}" for k in rng.integers(0, 40 if n < 15 else 3000, n)]
        for _ in range(6):
            x = list(base)
            for _ in range(rng.integers(0, max(2, n // 25))):
                x[rng.integers(0, n)] = f"x{rng.integers(0, 999)}"
            out.append(" ".join(x))
        out.append(" ".join(base))
    return out


@pytest.mark.parametrize(("size", "threshold"), [(3, 90), (5, 80)])
def test_jaccard_equals_brute_force(spark, size, threshold):
    texts = similar_texts(size)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, texts), shingle=size, threshold=threshold).collect()}
    assert got == brute_jaccard(texts, size, threshold)


@pytest.mark.parametrize(("size", "threshold", "step"), [(3, 90, 5), (5, 80, 10)])
def test_jaccard_drifting_chains(spark, size, threshold, step):
    """Copies of which only neighbours link: no id order may break a chain."""
    rng = np.random.default_rng(size)
    texts = []
    for chain in range(12):
        texts += [" ".join(f"c{chain}w{k}" for k in range(step * i, step * i + 99 + size)) for i in range(3 + chain % 6)]
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    linked = [f"z{k}" for k in range(200)]
    texts += [" ".join(linked[a : a + 99 + size]) for a in (0, 3 * step, step, 2 * step)]  # A, D, B, C
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, texts), shingle=size, threshold=threshold).collect()}
    assert got == brute_jaccard(texts, size, threshold)
    n = len(texts)
    assert {got[i][1] for i in range(n - 4, n)} == {n - 4}


def test_jaccard_keys_meet():
    """Any two sets at the threshold share a key, whatever their sizes."""
    rng = np.random.default_rng(3)
    for threshold in (80, 90):
        keys = Keys(threshold, 9)
        for n in list(range(1, 60)) + [150, 400]:
            s = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            for gone in range(n * (100 - threshold) // 100 + 1):
                for new in range(n):
                    if 100 * (n - gone) < threshold * (n + new):
                        break
                    other = np.unique(np.concatenate((rng.permutation(s)[: n - gone], rng.integers(0, 2**64, new, dtype=np.uint64))))
                    if len(other) and new in (0, 1, (100 * (n - gone) - threshold * n) // threshold):
                        assert np.intersect1d(keys.of(s), keys.of(other)).size, (threshold, n, gone, new)
    assert 1 <= light_boundary({5: 10, 12: 3}, 90) <= 29


def test_jaccard_edges(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, ["a b c d", "a b c d", "x"], [7, 7, None])).collect()}
    assert got == {(7, 2, 7), (None, 1, None)}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 3), (None, 1), *[(100 + i, 101 + i) for i in range(30)]]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{100 + i: 100 for i in range(31)}}


def brute_repeats(rows, n):
    seen, out = set(), {}
    for i, data in rows:
        mark = bytearray(len(data))
        for s in range(len(data) - n + 1):
            if data[s : s + n] in seen:
                mark[s : s + n] = b"\x01" * n
            seen.add(data[s : s + n])
        kept = bytes(c for c, m in zip(data, mark, strict=True) if not m)
        out[i] = (len(data), sum(mark), len(re.findall(b"\x01+", bytes(mark))), kept)
    return out


def test_repeats_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    part = lambda n: "".join(rng.choice(list("abcdeé "), n))
    shared, line = part(260), part(70)
    texts = [None, "", "a" * 700, part(99), part(500), shared, part(40) + shared + part(30), part(10) + shared[30:200] + part(5) + shared[100:], line + part(300) + line, line + part(10) + line, "ab" * 200, "a" * 120, part(50) + line + shared[:99]]
    got = {r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.spans), len(r.spans), bytes(r.kept)) for r in remove_repeats(frame(spark, texts)).collect()}
    assert got == brute_repeats([(i, (x or "").encode()) for i, x in enumerate(texts)], 100)


def test_repeats_edges(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    text = "0123456789" * 3 + "".join(map(chr, range(33, 126)))
    got = sorted((str(r.doc_id), len(r.spans)) for r in remove_repeats(frame(spark, [text, text, text], [None, 5, 5])).collect())
    assert got == [("5", 1), ("5", 1), ("None", 0)]  # null stands first, and a repeated row is no repeat of itself


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-30, 30, (300, 16)).astype(float)
    x[50:60] = x[50]
    x[70] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, None), (501, [None] * 16), (502, [float("nan")] * 16), (None, [1.0] * 16)]
    got = sorted(tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") % 20 == 0, k=7).collect())
    expected = []
    for q in range(0, 300, 20):
        ranked = sorted((-int(x[q] @ x[c]), c) for c in range(300) if c != q)[:7]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(ranked)]
    assert got == sorted(expected)
    assert top_k(spark.createDataFrame([], "vec_id long, vector array<double>"), F.col("vec_id") % 20 == 0).count() == 0


def test_packing_steps():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 100, 500).tolist()
    counts = Counter(lengths)
    space, placed = defaultdict(list), Counter()
    for length, _, n, each, first, at in best_fit_decreasing(dict(counts), 100):
        placed[length] += n
        for i in range(n):
            space[first + i // each].append((at + i % each * length, length))
    assert placed == counts
    for pieces in space.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and sum(pieces[-1]) <= 100
    bins: list[int] = []  # best-fit decreasing, one at a time
    for n in sorted(lengths, reverse=True):
        fit = min((b for b in bins if b >= n), default=None)
        if fit is not None:
            bins.remove(fit)
        bins.append((100 if fit is None else fit) - n)
    assert len(space) == len(bins)


def test_packing_ids(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [None, "", "It's we'll ÉTÉ, ×a. ÷ áb ẞ İ <|endoftext|> a..b ., \tx\r\ny  z 12,5 x1. ΟΣ", "word " * 5000, "A. b, C.", "word " * 5000]
    tokenizer = Tokenizer.from_file(path)
    got = defaultdict(list)
    for r in pack(frame(spark, texts), path).collect():
        got[r.doc_id].append((r.piece, r.start, r.length, zlib.crc32(r.ids)))
    for i, x in enumerate(texts):
        ids = np.array([*tokenizer.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        assert sorted(got[i]) == [(k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert pack(frame(spark, []), path).count() == 0


def test_hilbert_curve_is_one_walk(spark):
    cells = spark.range(8).select(F.col("id").alias("x")).crossJoin(spark.range(8).select(F.col("id").alias("y"))).crossJoin(spark.range(8).select(F.col("id").alias("z")))
    walk = cells.withColumn("h", hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3)).orderBy("h").collect()
    assert [r.h for r in walk] == list(range(512))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(walk, walk[1:], strict=False))


def test_hilbert_shards(spark):
    rows = spark.createDataFrame([(i % 90 if i % 7 else None, None if i % 5 == 0 else f"l{i % 3}", "kept", 7) for i in range(101)], "doc_id long, lang string, Shard string, row int")
    out = hilbert_shards(rows, [label_number(F.col("lang"))], F.col("doc_id"), F.col("doc_id"), shards=16)
    assert out.columns == ["doc_id", "lang", "Shard", "row", "curve_index", "shard_", "slot"]
    slots = defaultdict(list)
    out = out.collect()
    for r in out:
        slots[r.shard_].append(r.slot)
    assert len(out) == 101 and {len(v) for v in slots.values()} == {6, 7} and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert hilbert_shards(rows.limit(0), [label_number(F.col("lang"))], F.col("doc_id"), F.col("doc_id")).count() == 0


def test_hilbert_steps_keep_order(spark):
    labels = [None, "", "a", "ab", "b", "zzzzzz", "zzzzzzz", "é"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "x string").select(label_number(F.col("x"))).collect()]
    assert got == sorted(got) and len(set(got)) == len(labels) - 1 and got[5] == got[6]
    assert [r[0] for r in spark.createDataFrame([(None,), (float("nan"),), (2.0,)], "x double").select(size_number(F.col("x"))).collect()] == [float("-inf"), float("-inf"), 2.0]


def test_hilbert_prunes_and_keeps_groups(spark, monkeypatch):
    """A filter on any one dimension touches few shards, and equal groups of a cell stand side by side, also when split into parts."""
    from cloakframe.llm import hilbert

    rng = np.random.default_rng(12)
    rows = [(i, f"l{rng.integers(0, 8)}", f"s{rng.integers(0, 64):02d}", float(rng.lognormal(7, 2)), int(rng.integers(0, 400))) for i in range(6000)]
    rows += [(10_000 + i, "l3", "s10", 900.0, 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, size double, g int")
    monkeypatch.setattr(hilbert, "ROWS", 500)
    dimensions = [label_number(F.col("lang")), label_number(F.col("source")), size_number(F.col("size"))]
    out = sorted(hilbert_shards(df, dimensions, F.col("g"), F.col("doc_id"), shards=64).collect(), key=lambda r: (r.shard, r.slot))
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    assert [r.curve_index for r in out] == sorted(r.curve_index for r in out)
    runs = [(r.curve_index, r.g) for k, r in enumerate(out) if not k or (out[k - 1].curve_index, out[k - 1].g) != (r.curve_index, r.g)]
    assert len(runs) == len(set(runs))
    # pruning: runs of 30 rows, where a random order would leave every shard's range wide
    out = hilbert_shards(df.filter("doc_id < 10000"), dimensions, F.col("g"), F.col("doc_id"), shards=200).collect()
    for column, wanted in (("lang", "l1"), ("source", "s40"), ("size", 1000.0)):
        shards = defaultdict(list)
        for r in out:
            shards[r.shard].append(getattr(r, column))
        ranges = [(min(v), max(v)) for v in shards.values()]
        chance = [(min(v), max(v)) for v in np.array_split(rng.permutation([getattr(r, column) for r in out]), 200)]
        touched, random = (sum(a <= wanted <= b for a, b in x) for x in (ranges, chance))
        assert touched <= 0.5 * random, (column, touched, random)


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs.filter("doc_id % 2 = 0"))
    held = predict(docs.filter("doc_id % 2 = 1"), model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    odd = predict(frame(spark, [None, "", "123 !?", "x"]), model, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in odd] == [True, True, True, False] and all(0 <= r.score <= 1 for r in odd)
    assert predict(frame(spark, ["x"]), train(docs.limit(0)), ["doc_id"]).first().lang_pred == "und"
    for n in (1, 2, 4, 9):
        codes = codewords(n)
        assert len({tuple(c) for c in codes.tolist()}) == n


def test_toxicity_held_out(spark):
    from cloakframe.llm.toxicity import score, train

    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = train(docs, labels.filter("doc_id % 2 = 0").selectExpr("doc_id", "1 - quality AS low_quality", "toxic"), ["low_quality", "toxic"])
    seen = score(docs, chain, ["low_quality", "toxic"]).withColumnRenamed("toxic", "p").join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    toxic = [r for r in seen if r["toxic"]]
    assert sum(r.p >= 0.5 for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.p >= 0.5 for r in seen if not r["toxic"]) <= 0.02 * len(seen)
    assert score(frame(spark, [None, ""]), chain, ["low_quality", "toxic"]).count() == 2
    assert train(docs, labels.limit(0).selectExpr("doc_id", "quality AS a"), ["a"]) is None


def test_pii_round_trip_and_links():
    key = b"k"
    text = "Card 4111111111111111 or 4111-1111-1111-1111, a.Bc12@mail.example.com, +1 (017) 555-7713, 10.20.30.40, 2024-02-29, 31/12/2020, DE89 3704 0044 0532 0130 00, 123-45-6789, 24be64439e3e49cf46b2d7c90f3602a3"
    found = pii.replacements(text, key)
    assert Counter(k for _, _, k, _ in found) == Counter({"card": 2, "email": 1, "phone": 1, "ipv4": 1, "date": 2, "iban": 1, "ssn": 1, "secret": 1})
    cards = [re.sub("-", "", new) for _, _, k, new in found if k == "card"]
    assert cards[0] == cards[1] and pii.luhn(cards[0][:-1]) == int(cards[0][-1])
    out, at = "", 0
    for s, e, _, new in found:
        out, at = out + text[at:s] + new, e
    out += text[at:]
    assert out != text and len(pii.replacements(out, key)) == len(found)
    back, at = "", 0
    for s, e, _, new in pii.replacements(out, key, back=True):
        back, at = back + out[at:s] + new, e
    assert back + out[at:] == text
    assert pii.replacements("4785380592391136 999.1.1.1 2023-02-30 666-12-1234 plain 12", key) == []
    assert sorted(pii.permute(i, 50, key, b"t") for i in range(50)) == list(range(50))


def swapped(text, back=False, key=b"k"):
    found, out, at = pii.replacements(text or "", key, back), "", 0
    for s, e, _, new in found:
        out, at = out + text[at:s] + new, e
    return [(text[s:e], k) for s, e, k, _ in found], text if text is None else out + text[at:]


def test_pii_beside_other_words():
    """A valid value is found whatever digits or capitals stand beside it, and comes back."""
    for iban in ("ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT611904300234573201", "BE68 5390 0754 7034", "NO93 8601 1117 947", "PL61 1090 1014 0000 0712 1981 2874"):
        for text in (f"{iban} BIC ABCD", f"{iban} 2024", f"pay {iban} NOW.", f"CD12 3456 7890 {iban}", f"{iban}"):
            found, out = swapped(text)
            assert (iban, "iban") in found and iban not in out and swapped(out, True)[1] == text
    rng = np.random.default_rng(6)
    groupings = ([16], [4, 4, 4, 4], [4, 4, 4, 4, 3], [8, 8], [4, 6, 5], [6, 13], [4, 4, 5], [3, 7, 7])
    for n, groups in enumerate(groupings * 12):
        d = "".join(map(str, rng.integers(0, 10, sum(groups) - 1)))
        d += str(pii.luhn(d))
        card, at = "", 0
        for g in groups:
            card, at = card + (rng.choice([" ", "-"]) if card else "") + d[at : at + g], at + g
        assert swapped(f"card {card}.")[0] == [(card, "card")]
        text = (f"{card} 12/30", f"no {card} 2024-02-29 x", f"{card} 123", f"7 {card} 20 30 {card}")[n % 4]
        found, out = swapped(text)
        assert found and card not in out and swapped(out, True)[1] == text, text
    assert swapped("1 2 3 " * 3)[0] == [] and len(swapped("4111111111111111 5500000000000004 378282246310005")[0]) == 3


def test_pii_frame(spark):
    out = pii.pseudonymise(frame(spark, [None, "", "ip 10.20.30.40"]), b"k").orderBy("doc_id").collect()
    assert out[0].text is None and out[1].text == "" and out[2].text != "ip 10.20.30.40" and [len(r.spans_) for r in out] == [0, 0, 1]
    assert {r.spans for r in out} == {"clash"}  # the table's own column
    assert pii.pseudonymise(frame(spark, []), b"k").count() == 0


def leak_shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return lambda n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}, len(w)


def brute_leaks(docs, items, answers=None):
    """(document, item) by the shares of the distinct five-word shingles of question and answer in the whole document."""
    out, docs = set(), [(i, leak_shingles(x)[0]) for i, x in docs]
    for item, text in items:
        parts = [text] if answers is None else [text, answers[item]]
        if not any(leak_shingles(p)[1] for p in parts):
            continue
        wanted = [(min(5, leak_shingles(p)[1]), leak_shingles(p)[0](min(5, leak_shingles(p)[1]))) for p in parts if leak_shingles(p)[1]]
        out |= {(doc, item) for doc, has in docs if all(len(s & has(n)) >= 0.8 * len(s) for n, s in wanted)}
    return out


def test_decontamination_equals_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and all(r.question_overlap == r.overlap and r.answer_overlap is None for r in got)
    assert contaminated(docs.limit(0), items).count() == 0 and contaminated(docs, items.limit(0)).count() == 0
    assert contaminated(frame(spark, [None, ""]), items).count() == 0


def test_decontamination_verifies_question_and_answer(spark, monkeypatch):
    from cloakframe.llm import decontamination

    monkeypatch.setattr(decontamination, "ITEMS", 7)
    monkeypatch.setattr(decontamination, "INDEXES", 2)
    rng = np.random.default_rng(16)
    say = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 90, n))
    items = [(i, say(n), (say(m) if m else None)) for i, (n, m) in enumerate([(30, 8), (12, 1), (6, 3), (40, 20), (3, 2), (20, 0), (0, 6)] * 4)]

    def edited(text, times):
        w = (text or "").split()
        for _ in range(times if w else 0):
            w[rng.integers(0, len(w))] = "changed"
        return " ".join(w)

    texts = [None, ""]
    for _, q, a in items:
        texts += [f"{say(9)} {q} {say(3)} {a or ''} {say(9)}", f"{say(9)} {q} {say(9)}", f"{a}", f"{edited(q, 1)} {a}", f"{q} {edited(a, 1)} {'far ' * 200}", f"{edited(q, 2)} {edited(a, 1)}"]
    table = spark.createDataFrame(items, "item_id long, text string, answer string")
    got = contaminated(frame(spark, texts), table, answer_col="answer").collect()
    answers = {i: a for i, _, a in items}
    expected = brute_leaks(enumerate(texts), [(i, q) for i, q, _ in items], answers)
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(expected) > len(items)
    assert (3, 0) not in expected and (2, 0) in expected  # the question without its answer, and both


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x", "plain text"), (3, "a/b/c/y", "Licensed under the Apache License, Version 2.0.\nwords and more words here to make a body"), (4, "z/q", "plain"), (5, None, None),
        (6, "a/b/c/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (7, "a/b/c/d/w", "nothing"), (8, "ab/x", ""),
    ]
    out = {r.doc_id: (r.license, r.via) for r in scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert out == {1: ("MIT", "header"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "header"), 4: (None, None), 5: (None, None), 6: ("GPL-3.0", "header"), 7: ("GPL-3.0", "inherited"), 8: (None, None)}
    assert scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_license_texts_and_headers(spark):
    """Real licence files, wrapped standard headers and tags."""
    texts = "/usr/share/common-licenses"
    try:
        full = {k: open(f"{texts}/{n}").read() for n, k in (("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("MPL-2.0", "MPL-2.0"), ("BSD", "BSD-3-Clause"), ("LGPL-3", "LGPL-3.0"))}
    except FileNotFoundError:
        pytest.skip("no licence files here")
    mit = """MIT License\n\nCopyright (c) 2020 Some Body <some@example.com>\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n"""
    full["MIT"] = mit
    code = "\n".join(f"def step_{i}(value, other):\n    return value * {i} + other" for i in range(40))
    apache = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n#\n'
    gpl = "/*\n * Copyright (C) 2020\n *\n * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License as\n * published by the Free Software Foundation; either version 2 of\n * the License, or (at your option) any later version.\n */\n"
    rows = [(i, f"d{i}/LICENSE", x) for i, x in enumerate(full.values())] + [(100 + i, f"d{i}/src/a.py", code) for i in range(len(full))]
    rows += [(200, "x/a", apache + code), (201, "x/b", gpl + code), (202, "x/c", "// SPDX-License-Identifier: MIT OR Apache-2.0\n" + code), (203, "x/d", "".join(f"// {x}\n" for x in mit.split("\n")) + code), (204, "x/e", "a paper on copyright and licence law\n" + code)]
    out = {r.doc_id: (r.license, r.via) for r in scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    for i, name in enumerate(full):
        assert out[i] == (name, "header") and out[100 + i] == (name, "inherited"), (name, out[i], out[100 + i])
    assert [out[i] for i in range(200, 205)] == [("Apache-2.0", "header"), ("GPL-2.0", "header"), ("MIT OR Apache-2.0", "header"), ("MIT", "header"), (None, None)]


def test_language_results_do_not_clash(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = ("lang_pred", "Score", "ambiguous", "row", "told", "_told", "_held")
    wide = docs.withColumns({c: F.lit("x") for c in extra})
    out = corpus_pipeline.language(spark, wide, SF)
    assert out.columns == wide.columns and out.select(*docs.columns).exceptAll(corpus_pipeline.language(spark, docs, SF)).count() == 0
    assert {r[0] for r in out.select(F.concat(*extra)).distinct().collect()} == {"x" * len(extra)}
    assert predict(wide, train(docs), ["doc_id", "lang_pred", "Score"]).columns == ["doc_id", "lang_pred", "score", "ambiguous"]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * len(texts)
    near = corpus_pipeline.near_duplicates(spark, docs, SF)
    ids = sorted(texts)
    expected = {ids[i] for i, (_, c) in brute_jaccard([texts[i] for i in ids], 5, 80).items() if c == i}
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.select("doc_id").collect()) == sorted(expected)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaks = {d for d, _ in brute_leaks(texts.items(), items.items())}
    clean = corpus_pipeline.decontaminate(spark, docs, SF)
    assert leaks and clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(set(texts) - leaks)
    private = corpus_pipeline.private_data(spark, docs, SF).collect()
    assert {r.doc_id: r.text for r in private} == {i: swapped(x, key=pii.TRIAL_KEY)[1] for i, x in texts.items()}
    assert all(r.n_chars == len(r.text) for r in private)


def test_pipeline_sequences(spark):
    """Pieces and places of a whole run: every token of every document that is left has one place, and few sequences are used."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    docs = corpus_pipeline.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(r.doc_id, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in out) == sorted(expected)
    check_places([(r.sequence_id, r.offset, r.length) for r in out], 4096)


def check_places(rows, capacity):
    space = defaultdict(list)
    for s, at, n in rows:
        space[s].append((at, n))
    for pieces in space.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and sum(pieces[-1]) <= capacity
    bins: list[int] = []
    for n in sorted((n for _, _, n in rows), reverse=True):
        fit = min((b for b in bins if b >= n), default=None)
        if fit is not None:
            bins.remove(fit)
        bins.append((capacity if fit is None else fit) - n)
    assert len(space) == len(bins)


@pytest.mark.parametrize("broadcast", [True, False])
def test_packing_places_over_partitions(spark, monkeypatch, broadcast):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from cloakframe.llm import packing, shared

    if not broadcast:
        monkeypatch.setattr(packing, "small", lambda df, rows=None: df)
        assert shared.small(spark.range(5), 4).count() == 5
    rng = np.random.default_rng(15)
    texts = [" ".join(["a"] * int(n)) for n in rng.integers(0, 120, 300)]
    out = pack(frame(spark, texts).repartition(7), public_tokenizers.path("word_bpe_49k.json"), capacity=100).collect()
    assert len({(r.doc_id, r.piece) for r in out}) == len(out) and sum(r.length for r in out) == sum(len(t.split()) + 1 for t in texts)
    check_places([(r.sequence_id, r.offset, r.length) for r in out], 100)


def test_pipeline_on_odd_rows(spark):
    """Null and shared ids are judged by row, and no name of a further column clashes."""
    import corpus_pipeline

    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").orderBy("item_id").first().text
    english = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en' and n_chars between 500 and 3000").orderBy("doc_id").limit(6).collect()
    a, b, c = (r.text for r in english[:3])
    names = ["spans", "Row", "row_key", "held", "a.b", "text_hash", "component_id", "curve_index"]
    rows = [(None, a + " " + item), (7, b), (7, item + " " + c), (7, b), (None, c), (9, b), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, *names) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    near = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert near.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in near.collect()) == Counter(set(rows) - {(9, b)})
    clean = corpus_pipeline.decontaminate(spark, docs, SF)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter((i, t) for i, t in rows if item not in (t or ""))
    private = corpus_pipeline.private_data(spark, docs, SF)
    assert private.columns == docs.columns and {tuple(r[-len(names) :]) for r in private.collect()} == {tuple(names)} and private.count() == len(rows)
    told = corpus_pipeline.language(spark, docs, SF)
    assert told.columns == docs.columns
    assert corpus_pipeline.sequences(spark, docs, SF).count() >= len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def thue_morse(doublings, a="a", b="b"):
    x, y = a, b
    for _ in range(doublings):
        x, y = x + y, y + x
    return x, y


def test_range_hash_has_no_structure():
    from cloakframe.llm.bytehash import LONG, RangeHash

    rng = np.random.default_rng(9)
    data = np.frombuffer("".join(thue_morse(12)).encode() + rng.bytes(2000), np.uint8)
    start, end = np.array([0, 4096, 0, 4096, 0, 8200, 8200, 8192]), np.array([4096, 8192, 200, 4296, 0, 8200, 8208, 8200])
    got = RangeHash(3).of(data, start, end)
    assert len(set(got.tolist())) == 7 and got[4] == got[5]
    for s, e in ((0, 7), (5, 13), (9, 9 + LONG), (8193, 8193 + LONG + 1)):  # where a range stands does not matter
        one = RangeHash(3).of(np.concatenate((data[s:e], data[:5])), np.array([0]), np.array([e - s]))
        assert one[0] == RangeHash(3).of(data, np.array([s]), np.array([e]))[0]


def test_thue_morse_words_stay_apart(spark):
    """Words that collide under every polynomial modulo 2**64."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    x, y = thue_morse(12)
    texts = [x, y, f"1{x} and", f"1{y} and", f"{x[:200]}", f"{y[:200]}", "q " + x, "q " + x]
    got = {r.doc_id: r.component_id for r in jaccard_components(frame(spark, texts)).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6}
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    packed = {r.doc_id: bytes(r.ids) for r in pack(frame(spark, texts), path).collect()}
    assert packed == {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in enumerate(texts)}
    cut = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in remove_repeats(frame(spark, texts)).collect()}
    assert cut == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)], 100)
    items = spark.createDataFrame([(1, f"a b c d {x} e f g h"), (2, f"a b c d {y} e f g h")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(frame(spark, [f"z a b c d {x} e f g h z"]), items).collect()} == {(0, 1)}


def test_tokens_survive_a_hash_collision(monkeypatch):
    """Runs with equal hashes are told apart by their bytes."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from cloakframe.llm import packing

    class Same:
        def of(self, data, start, end):
            return (end - start).astype(np.uint64)

    monkeypatch.setattr(packing, "_RANGE", Same())
    known = packing._Words(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("some words more word Word, 123 456 12x x21 " + "ab" * 300 + " " + "ba" * 300, "here are others 789 " + "ab" * 300, "é è ê ab."):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, bounds = known.ids(data, np.array([0, len(data)]))
        assert ids.tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids)]


def test_jaccard_repeated_ids(spark):
    run = lambda a, b: " ".join(f"w{k}" for k in range(a, b))
    for size, threshold in ((3, 90), (5, 80)):
        rows = frame(spark, [run(0, 200), run(0, 199), run(300, 500), run(300, 499), run(0, 200)], [1, 5, 5, 9, 1])
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(rows, shingle=size, threshold=threshold).collect())
        assert got == Counter([(1, 201 - size, 1), (1, 201 - size, 1), (5, 200 - size, 1), (5, 201 - size, 5), (9, 200 - size, 5)])


def test_repeats_of_repeated_ids(spark):
    rng = np.random.default_rng(5)
    part = lambda n: "".join(rng.choice(list("abcdef "), n))
    long = part(600)
    for other in (long[:202], "x" * 15, part(300) + long[100:400]):
        rows = [(5, long), (5, other), (5, long), (7, long[50:300]), (None, other), (None, None)]
        got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in remove_repeats(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()]
        every = sorted({t or "" for _, t in rows})
        hashed = spark.createDataFrame([(t,) for t in every], "t string").select("t", F.xxhash64("t").alias("h"))
        digest = {r.t: r.h for r in hashed.collect()}
        order = sorted({(-1 if i is None else i, digest[t or ""], t or "") for i, t in rows})
        found = brute_repeats([(k, t.encode()) for k, (_, _, t) in enumerate(order)], 100)
        place = {(i, t): k for k, (i, _, t) in enumerate(order)}
        expected = [(i, found[place[(-1 if i is None else i, t or "")]]) for i, t in rows]
        assert Counter(got) == Counter((i, n, removed, kept) for i, (n, removed, _, kept) in expected)


def test_frequent_grams_are_dealt_by_context(spark, monkeypatch):
    from cloakframe.llm import suffix_dedup

    rng = np.random.default_rng(8)
    part = lambda n: "".join(rng.choice(list("abcdef "), n))
    line, long = part(70), part(130)
    texts = [part(60) + line + part(60) + (long if i % 3 else "") + part(20) for i in range(60)]
    monkeypatch.setattr(suffix_dedup, "IN_ALL", 20)
    assert len(suffix_dedup.frequent_grams(frame(spark, texts), 100))
    got = {r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.spans), len(r.spans), bytes(r.kept)) for r in remove_repeats(frame(spark, texts)).collect()}
    assert got == brute_repeats([(i, x.encode()) for i, x in enumerate(texts)], 100)


def test_pii_keeps_columns(spark):
    """No name clashes with a result or a helper."""
    names = ["_done", "done", "row", "spans", "Spans_", "a.b", "key"]
    wide = spark.createDataFrame([(1, "ip 10.20.30.40", *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = pii.pseudonymise(wide, b"k")
    assert out.columns == ["doc_id", "text", *names, "spans__"]
    r = out.first()
    assert [r[n] for n in names] == names and r.text != "ip 10.20.30.40" and len(r.spans__) == 1
    assert pii.pseudonymise(wide, b"k", spans_col=None).columns == wide.columns
    assert pii.pseudonymise(out.drop("spans__"), b"k", back=True).first().text == "ip 10.20.30.40"
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymise(wide, b"")


def test_pii_links_dates_however_written():
    for key in (b"a", b"b", b"c"):
        for y, m, d in [(2020, 12, 31), (1999, 1, 13), (2004, 2, 29), (2020, 3, 4), (1900, 1, 1), (2099, 12, 31)]:
            forms = [f"{y}-{m:02d}-{d:02d}", f"{y}/{m:02d}/{d:02d}", f"{d:02d}.{m:02d}.{y}", *([f"{m:02d}/{d:02d}/{y}"] if d > 12 else [])]
            images = []
            for form in forms:
                new = pii._date(form, key, False)
                assert pii._date(new, key, True) == form
                a, b, c = re.split(r"[-/.]", new)
                images.append((a, b, c) if len(a) == 4 else (c, a, b) if form == f"{m:02d}/{d:02d}/{y}" else (c, b, a))
            assert len(set(images)) == 1, (key, forms, images)


def brute_pii(text, key):
    """The replacements of simple values, found by splitting at spaces."""
    kinds = {"ipv4": r"\d{1,3}(\.\d{1,3}){3}", "ssn": r"\d{3}-\d\d-\d{4}", "date": r"\d{4}-\d\d-\d\d", "email": r"[a-z]+@[a-z]+\.[a-z]+", "secret": r"[0-9a-f]{32}"}
    out, at = [], 0
    for word in text.split(" "):
        for kind, form in kinds.items():
            if re.fullmatch(form, word) and (new := pii._RULE[kind](word, key, False)):
                out.append((at, at + len(word), kind, new))
        if re.fullmatch(r"\d{13,19}", word) and pii.luhn(word[:-1]) == int(word[-1]) and len(set(word)) > 1:
            body = pii._digits(word[:-1], key, b"card", False)
            while not pii._is_card(body + str(pii.luhn(body))):
                body = pii._digits(body, key, b"card", False)
            out.append((at, at + len(word), "card", body + str(pii.luhn(body))))
        at += len(word) + 1
    return out


def test_pii_equals_brute_force():
    rng = np.random.default_rng(14)
    make = [
        lambda: ".".join(map(str, rng.integers(0, 300, 4))), lambda: f"{rng.integers(0, 1000):03d}-{rng.integers(0, 100):02d}-{rng.integers(0, 9999):04d}",
        lambda: f"{rng.integers(1890, 2110)}-{rng.integers(0, 14):02d}-{rng.integers(0, 33):02d}", lambda: "".join(map(str, rng.integers(0, 10, rng.integers(12, 21)))),
        lambda: "".join(rng.choice(list("0123456789abcdef"), 32)), lambda: "".join(rng.choice(list("xyz"), 5)) + "@mail.org",
    ]
    seen = Counter()
    for _ in range(800):
        words_ = [x for _ in range(4) for x in (make[rng.integers(0, len(make))](), "plain")]
        text = " ".join(words_)
        got = pii.replacements(text, b"key")
        assert got == brute_pii(text, b"key"), text
        seen.update(k for _, _, k, _ in got)
    assert len(seen) == 6 and min(seen.values()) > 20


def test_licenses_of_repeated_rows(spark):
    readme = "# Tool\nReleased under the MIT License.\n" + "words about the tool and how to use it in some longer text\n" * 3
    rows = [(1, "p/README", readme)] * 4 + [(2, "p/code.py", "x = 1"), (1, "p/README", "other text"), (3, "q/LICENSE", "Released under the ISC License.")] + [(4, "q/a", "y"), (4, "q/a", "y")]
    got = Counter((r.doc_id, r.license, r.via) for r in scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect())
    assert got == Counter({(1, "MIT", "header"): 4, (2, None, None): 1, (1, None, None): 1, (3, "ISC", "header"): 1, (4, "ISC", "inherited"): 2})


def brute_licenses(files):
    """(licence, via) of each file (path, text), with every unit compared with every template."""
    import math
    import os

    import regex

    from cloakframe.llm import license_scan as L

    terms = lambda x: regex.findall(r"[\p{L}\p{N}]+", x.lower())
    vocabulary = {t for _, x in L.TEMPLATES + L.BLOCKS for t in terms(x)}
    df = Counter(t for _, x in files for t in set(terms(x)) & vocabulary)
    idf = {t: math.log((len(files) + 1) / (df[t] + 1)) + 1 for t in vocabulary}

    def best(unit, of):
        known = {t for _, x in of for t in terms(x)}
        other = sum(idf[t] for t in known) / len(known)
        weigh = lambda x: {t: n * (idf[t] if t in known else other) for t, n in Counter(terms(x)).items()}
        size = lambda v: math.sqrt(sum(x * x for x in v.values()))
        own = weigh(unit)
        scored = []
        for name, text in of:
            w = weigh(text)
            if own and w:
                scored.append((-round(sum(own[t] * w.get(t, 0) for t in own) / size(own) / size(w), 6), name))
        return min(scored) if scored and min(scored)[0] <= -L.SIMILAR else None

    heads, folders = {}, defaultdict(list)
    for path, text in files:
        units = [("line", x, L.TEMPLATES) for x in regex.split(r"\r?\n", text) if regex.search(L.CUE, x.lower())]
        if regex.search(L.BLOCK_CUE, text.lower()):
            flat = regex.sub(r"\r\n?", "\n", text)
            comment = L._COMMENT
            apart = regex.sub(rf"(?m)^({comment}.*)\n(?!{comment})", r"\1\n\n", flat)
            apart = regex.sub(rf"(?m)^(?!{comment})(.+)\n(?={comment})", r"\1\n\n", apart)
            units += [("paragraph", x, L.BLOCKS) for x in regex.split(r"\n(?:[^\p{L}\p{N}\n]*\n)+", apart)]
            lead = regex.search(rf"\A(?:#!.*\n)?\s*(/\*(?s:.*?)\*/|(?:{comment}.*(?:\n|\Z))+)", flat)
            units += [("comment", lead.group(1) if lead else "", L.BLOCKS), ("file", flat, L.BLOCKS)]
            units = [u for u in units if u[0] == "line" or (regex.search(L.BLOCK_CUE, u[1].lower()) and (u[0] != "file" or regex.search(L.FILE_CUE, u[1].lower())))]
        found = [(kind, len(terms(x)), *hit) for kind, x, of in units if (hit := best(x, of))]
        found += [("tag", len(terms(x)) + 3, -1.0, x) for x in regex.findall(L.SPDX, text)]
        if found:
            heads[path] = min(f[2:] for f in found)
            words_ = Counter()
            for kind, n, _, _ in found:
                words_[kind] += n
            if max(words_.values()) >= L.FILE_SHARE * len(terms(text)):
                folders[os.path.dirname(path)].append((heads[path][0], path, heads[path][1]))
    out = {}
    for path, _ in files:
        out[path] = (heads[path][1], "header") if path in heads else (None, None)
        folder = os.path.dirname(path)
        while path not in heads:
            if folder in folders:
                out[path] = (min(folders[folder])[2], "inherited")
                break
            if not folder:
                break
            folder = os.path.dirname(folder)
    return out


def test_licenses_equal_brute_force(spark):
    from cloakframe.llm import license_scan as L

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    files = [(f"{r.source}/{r.lang}/{r.doc_id}", r.text) for r in docs]
    rng = np.random.default_rng(17)
    prose = lambda n: " ".join(rng.choice(["step", "value", "return", "other", "copy", "code", "free"], n))
    for k, (_, text) in enumerate(L.TEMPLATES + L.BLOCKS):
        w = text.split()
        wrapped = "\n".join("# " + " ".join(w[i : i + 9]) for i in range(0, len(w), 9))
        files += [(f"d{k}/LICENSE", text), (f"d{k}/sub/a.py", prose(40)), (f"e{k}/b.py", wrapped + "\n" + prose(60)), (f"e{k}/c.py", prose(30) + "\n\n" + " ".join(w[: 3 * len(w) // 4]) + "\n\n" + prose(30))]
    frame_ = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string")
    got = {r.path: (r.license, r.via) for r in scan(frame_).collect()}
    expected = brute_licenses(files)
    assert {p: (got[p], expected[p]) for p in got if got[p] != expected[p]} == {}
    assert sum(v[1] == "inherited" for v in got.values()) > 20


@pytest.mark.parametrize("name", ["op1_topk_search", "op4_suffix_dedup", "op5_jaccard_join"])
def test_queries_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from cloakframe.llm import queries

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, expected = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in got.columns]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[i] for i in order) for r in expected.fetchall())


@pytest.mark.parametrize("module", ["jaccard_join", "suffix_dedup"])
def test_plans_without_broadcasts(spark, monkeypatch, module):
    """The joins of large inputs: sides over the bound are shuffled, with the same result."""
    import importlib

    monkeypatch.setattr(importlib.import_module(f"cloakframe.llm.{module}"), "small", lambda df, rows=None: df)
    if module == "jaccard_join":
        texts = similar_texts(5)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, texts), shingle=5, threshold=80).collect()}
        assert got == brute_jaccard(texts, 5, 80)
    else:
        test_repeats_of_repeated_ids(spark)
