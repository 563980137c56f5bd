"""Language identification, toxicity, mixing, archives, vectors, byte-level BPE, the pipeline."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import bpe, embedding_dedup, langid, mixing, toxicity, warc
from ledgerline.llm.queries import QUERIES
from ledgerline.session import ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# --- language identification -------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    got = QUERIES["op3_language_id"][0](spark, SMALL).join(docs, "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got["held_out"]]
    assert set(held["doc_id"]) == {d for d in got["doc_id"] if zlib.crc32(str(d).encode()) % 5 == 0}
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_language_defined_results(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 5, "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "12 !?", None), (102, "die katze und der hund", None), (102, "", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(r[0], r[1], 0.5, "x") for r in rows[-4:]], "doc_id long, text string, score double, lang string")
    got = [tuple(r) for r in langid.identified(odd, model).select("doc_id", "lang_pred", "lang").collect()]
    assert sorted(got) == [(100, "und", "x"), (101, "und", "x"), (102, "de", "x"), (102, "und", "x")]
    none = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.identified(odd, none).collect()} == {"und"}
    assert langid.identified(odd.limit(0), model).count() == 0


def test_characters_behind_the_last_letter_are_no_letters():
    for text in ("\U000f0000", "\U000e0101 12", "\U00033fff\U0010ffff"):
        assert len(langid.normalised(text)) == 0
    assert len(langid.normalised("\U00032000")) == 3 and chr(0x32000).isalpha()
    assert langid.normalised("\U000f0000É").tolist() == [32, ord("é"), 32]


def test_kneser_ney_probabilities_add_up():
    rng = random.Random(1)
    text = "".join(rng.choice("aab bc") for _ in range(3000))
    grams = {}
    for i in range(len(text) - langid.ORDER + 1):
        g = text[i : i + langid.ORDER]
        grams[g] = grams.get(g, 0) + 1
    model = langid.kneser_ney({"x": grams})
    for context in ("aab ", "zzzz", "cccc", "b bb"):
        total = 0.0
        for c in "abc ":
            codes = np.array([ord(x) for x in context + c], np.uint32)
            total += np.exp(model._logs(codes, np.array([langid.ORDER - 1]), langid.ORDER)[0, 0])
        unknown = np.array([ord(x) for x in context + "?"], np.uint32)
        total += np.exp(model._logs(unknown, np.array([langid.ORDER - 1]), langid.ORDER)[0, 0])
        assert total == pytest.approx(1, abs=1e-3)


def plain_kneser_ney(counts, characters):
    """Probability of a character after a context, by the recursive definition on plain dictionaries."""
    levels = [dict(counts)]
    while len(next(iter(levels[0]))) > 1:
        left = {}
        for gram in levels[0]:
            left.setdefault(gram[1:], set()).add(gram[0])
        levels.insert(0, {gram: len(neighbours) for gram, neighbours in left.items()})

    def probability(c, context):
        below = 1 / characters if context is None else probability(c, context[1:] if context else None)
        if context is None:
            return below
        level = levels[len(context)]
        once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
        discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
        after = {gram[-1]: n for gram, n in level.items() if gram[:-1] == context}
        if not after:
            return below
        whole = sum(after.values())
        return max(after.get(c, 0) - discount, 0) / whole + discount * len(after) / whole * below

    return probability


def test_entropies_are_those_of_plain_kneser_ney():
    texts = {"de": "der hund und die katze und das haus der maus " * 3, "en": "the cat and the dog ate that hat then " * 3, "one": "aaaaaaaaaa"}
    counts = {
        name: dict(collections.Counter(t[i : i + langid.ORDER] for i in range(len(t) - langid.ORDER + 1)))
        for name, t in texts.items()
    }
    model = langid.kneser_ney(counts)
    characters = len({g[-1] for grams in counts.values() for g in grams} | {c for t in counts.values() for g in t for c in g[1:]}) + 1
    for text in ("die katze ate the hund", "a", "zzz \u00e9t\u00e9 xx", "the " * 500, "aaaaaa"):
        codes = langid.normalised(text)
        s = "".join(map(chr, codes))
        got = model.entropies(codes)
        for i, name in enumerate(model.languages):
            p = plain_kneser_ney(counts[name], characters)
            known = {}
            total = 0.0
            for e in range(1, len(s)):
                key = s[e], s[max(0, e - langid.ORDER + 1) : e]
                if key not in known:
                    known[key] = math.log(p(*key))
                total -= known[key]
            assert got[i] == pytest.approx(total / (len(s) - 1), rel=1e-4)


def test_a_tie_goes_to_the_first_language_and_long_texts_are_read_whole():
    grams = dict(collections.Counter("abcab cabca"[i : i + langid.ORDER] for i in range(7)))
    twins = langid.kneser_ney({"y": grams, "x": grams})
    assert twins.predict(langid.normalised("abcab"))[:2] == ("x", pytest.approx(0.5))
    two = langid.kneser_ney({"x": grams, "z": {g.replace("a", "q"): n for g, n in grams.items()}})
    # the end decides, a million characters behind the beginning
    assert two.predict(langid.normalised("abcab" * 100_000 + " qbcqb" * 150_000))[0] == "z"


# --- toxicity ------------------------------------------------------------------------------------


def toxic_rows(n=600):
    rng = random.Random(7)
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 400))]
        bad = i % 6 == 0
        for _ in range(rng.choice([1, 4, 12]) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(["idiot", "moron", "scumbag", "scumball"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, grade string")
    known = spark.createDataFrame(labels[:400] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    held = labels[400:]
    assert sum(got[i]["toxic"] == bool(t) for i, t in held) >= 0.97 * len(held)
    assert not any(got[i]["toxic"] for i, t in held if not t)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) > 1
    assert all(0 <= r["severity"] <= len(model.thresholds) for r in got.values())


def test_severity_follows_ordered_grades():
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for i in range(900):
        hits = rng.integers(0, 4)
        common = rng.integers(100, 5000, 30)
        rows.append(np.unique(np.concatenate([common, np.arange(hits)])).astype(np.int32))
        grades.append(hits)
    model = toxicity.fit_ordinal(rows, np.array(grades))
    mean = [model.exceeded(np.arange(k, dtype=np.int32)).sum() for k in range(4)]
    assert mean == sorted(mean) and mean[0] < 0.5 < 2.3 < mean[3]


def test_toxicity_defined_results(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "idiot")], "doc_id long, text string")
    none = toxicity.fit(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.scored(odd, none).collect()
    assert len(got) == 4 and all(r["severity"] == 0 and not r["toxic"] for r in got)
    rows, labels = toxic_rows()
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r["toxic"] for r in toxicity.scored(odd.where("text is null or text = ''"), model).collect()] == [False] * 3
    assert toxicity.scored(odd.limit(0), model).count() == 0


def plain_loss(weights, thresholds, rows, grades):
    total = 0.0
    for slots, grade in zip(rows, grades, strict=True):
        z = sum(weights[s] for s in slots)
        above = [1.0, *(1 / (1 + math.exp(t - z)) for t in thresholds), 0.0]
        total -= math.log(above[grade] - above[grade + 1])
    return total / len(rows) + 5e-5 * sum(w * w for w in weights.values())


def test_no_small_change_of_a_fitted_model_makes_the_grades_likelier():
    rng = np.random.default_rng(5)
    rows, grades = [], []
    for _ in range(500):
        hits = int(rng.integers(0, 5))
        rows.append(np.unique(np.concatenate([rng.integers(50, 3000, 10), rng.permutation(6)[:hits]])).astype(np.int32))
        grades.append(int(np.clip(hits + rng.integers(-1, 2), 0, 3)))
    grades = np.array(grades)
    model = toxicity.fit_ordinal(rows, grades)
    mask = toxicity.telling(rows, grades > 0)
    used = [[int(s) for s in r if mask[s]] for r in rows]
    weights = {s: float(model.weights[s]) for s in {s for r in used for s in r}}
    thresholds = list(model.thresholds)
    best = plain_loss(weights, thresholds, used, grades)
    for step in (0.05, -0.05):
        for i in range(len(thresholds)):
            moved = [t + step * (j == i) for j, t in enumerate(thresholds)]
            assert plain_loss(weights, moved, used, grades) > best - 1e-4
        for s in sorted(weights)[:6]:
            if weights[s] + step >= 0:
                assert plain_loss(weights | {s: weights[s] + step}, thresholds, used, grades) > best - 1e-4


def test_severity_is_that_of_plain_sums_also_for_very_long_texts(spark):
    rows, labels = toxic_rows(300)
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    texts = ["You IDIOT", "idiot " * 200_000, " ".join(f"q{i}" for i in range(50_000)) + " moron", "\u4f60\u597d", "w\u0061k wbl"]
    got = toxicity.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    for text, r in zip(texts, got, strict=True):
        parts = set()
        for word in set(regex.findall(r"\p{L}+", text.lower())):
            parts |= {"^" + word[:n] for n in (4, 5, 6, 7, 8) if n < len(word)} | {"^" + word, word}
        slots = {xxhash.xxh64_intdigest(p) >> 46 for p in parts}
        z = sum(float(model.weights[s]) for s in slots)
        assert r["severity"] == pytest.approx(sum(1 / (1 + math.exp(min(max(t - z, -40), 40))) for t in model.thresholds), rel=1e-6)
    assert got[0]["severity"] == got[1]["severity"]  # a repeated word counts once


# --- mixing --------------------------------------------------------------------------------------


def test_targets_reshare_the_excess():
    assert mixing.targets([10, 10, 10], [5, 2, 1], 45, 2) == pytest.approx([20, 50 / 3, 25 / 3])
    assert mixing.targets([10, 0, 100], [5, 2, 1], 165, 2) == pytest.approx([20, 0, 145])
    assert mixing.targets([], [], 0, 2) == []


def test_shard_quotas_are_exact():
    quotas = mixing.shard_quotas([1000, 0, 37, 5], 7, 3)
    assert quotas.sum(axis=0).tolist() == [1000, 0, 37, 5]
    assert quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= 3 and (quotas >= 0).all()
    assert (quotas == mixing.shard_quotas([1000, 0, 37, 5], 7, 3)).all()


def mix_rows(n=3000):
    rng = random.Random(5)
    sources = ["a", "B", "é", "\U00010000", None, "￿"]
    rows = [(i, rng.choice(sources), " ".join("w" * rng.randint(1, 5) for _ in range(int(rng.paretovariate(1.2)) % 900))) for i in range(n)]
    return [*rows, (n, "a", None), (n + 1, "empty", ""), (7, "a", "repeated row"), (7, "a", "repeated row"), (None, "a", "no id at all")]


def test_mix_meets_its_targets_whole_and_repeatably(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, shards int")
    plan = [r.asDict() for r in mixing.plan_mix(df, shards=5).collect()]
    assert len(plan) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in plan:
        s = r["source"]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["row"]["text"] or ""))
        assert len(r["shards"]) <= 2 and all(0 <= x < 5 for x in r["shards"])
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * len(r["shards"])
        target[s] = r["target"]
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)
    for s, t in zip(order, want, strict=True):
        assert target[s] == pytest.approx(t)
        assert taken[s] == pytest.approx(t, rel=0.01, abs=20)
    again = mixing.plan_mix(df.repartition(7), shards=5).collect()
    key = lambda r: str((r["id"], r["order"], r["shards"]))
    assert sorted(map(key, again)) == sorted(map(key, plan))
    mix = mixing.mixed(df, shards=5)
    assert mix.columns == df.columns and mix.count() == sum(len(r["shards"]) for r in plan)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_is_filled_up_behind_a_very_long_document(spark, seed):
    sizes = [1 + i % 5 for i in range(2000)] + [2000 + i for i in range(30)]
    df = spark.createDataFrame([(i, "a", "w " * n) for i, n in enumerate(sizes)], "doc_id long, source string, text string")
    plan = mixing.plan_mix(df, weights=(1,), share=0.5, shards=4, seed=seed).collect()
    assert len(plan) == len(sizes)
    assert abs(sum(r["size"] * len(r["shards"]) for r in plan) - 0.5 * sum(sizes)) <= 0.5


def test_documents_without_words_are_drawn_like_others(spark):
    texts = [None, "", "  "] + ["some words"] * 20
    df = spark.createDataFrame([(i, "a", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    plan = mixing.plan_mix(df, weights=(1,), share=2, shards=3).collect()
    assert [len(r["shards"]) for r in plan] == [2] * len(texts)


def test_mix_of_an_empty_table_is_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.plan_mix(df).count() == 0 and mixing.mixed(df).count() == 0


# --- archives ------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    rows = [
        (1, "http://a/1", "<p>same\r\n\r\nbody</p>"), (2, "http://a/ä b\r\nX: y", "<p>same\r\n\r\nbody</p>"),
        (3, None, None), (4, "u", ""), (5, "u", "é" * 50_000), (5, "u", "é" * 50_000), (None, "u", "null id"), (6, "u", "once"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, offset int")
    index = warc.write_archives(df, archive_bytes=300)
    got = [r.asDict() for r in warc.read_records(index).collect()]
    seen = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["digest"]) for r in got), key=str)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [
        (1, "response", None, digest(rows[0][2])), (2, "revisit", 1, digest(rows[0][2])), (3, "response", None, digest("")),
        (4, "revisit", 3, digest("")), (5, "response", None, digest(rows[4][2])), (5, "response", None, digest(rows[4][2])),
        (None, "response", None, digest("null id")), (6, "response", None, digest("once")),
    ]
    assert seen == sorted(want, key=str)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert payloads == {i: (t or "").encode() for i, _, t in rows if i not in (2, 4)}
    part = warc.read_records(index.where("page_id in (1, 5)")).collect()
    assert sorted(r["page_id"] for r in part) == [1, 5, 5]
    long_only = warc.write_archives(df, least_bytes=1)
    assert {r["record_type"] for r in long_only.where("page_id in (3, 4)").collect()} == {"response"}
    assert warc.read_records(warc.write_archives(df.limit(0))).count() == 0


def test_ranges_are_coalesced():
    assert warc.coalesced([(0, 10), (10, 5), (100, 1), (300, 4)], gap=85) == [(0, 101), (300, 304)]
    assert warc.coalesced([]) == []
    # a read ends at its bound, but one record is never cut
    assert warc.coalesced([(0, 10), (10, 10), (20, 50), (70, 1)], most=20) == [(0, 20), (20, 70), (70, 71)]


def test_many_archives_are_read_by_many_tasks(spark):
    pages = spark.range(60).selectExpr("id AS page_id", "'http://a.example/' AS url", "repeat(concat('x', id), 500) AS html")
    index = warc.write_archives(pages.repartition(6), archive_bytes=200)
    assert index.select("file").distinct().count() > 12
    read = warc.read_records(index, task_bytes=1000)
    assert read.rdd.getNumPartitions() > 12
    assert {(r["page_id"], r["payload"].decode()) for r in read.collect()} == {(i, f"x{i}" * 500) for i in range(60)}


def test_digests_of_responses_are_those_of_the_payload_read():
    raw = warc.record(1, "response", None, None, b"abc").replace(b"abc\r\n\r\n", b"abd\r\n\r\n")
    assert warc.parsed(raw)["digest"] == warc.payload_digest(b"abd")
    assert warc.parsed(warc.record(2, "revisit", 1, None, b"abc"))["digest"] == warc.payload_digest(b"abc")


def test_archive_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op7_warc"][0](spark, SMALL).collect()}
    first = {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault(p["html"] or "", p["page_id"])
    assert len(got) == len(pages)
    for p in pages:
        body, r = (p["html"] or "").encode(), got[p["page_id"]]
        original = first[p["html"] or ""]
        assert r["payload_bytes"] == len(body)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r["record_type"] == ("response" if original == p["page_id"] else "revisit")
        assert r["refers_to"] == (None if original == p["page_id"] else original)


# --- vectors -------------------------------------------------------------------------------------


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for label in (0, 1):
        for _ in range(25):
            centre = rng.standard_normal(24)
            for _ in range(rng.integers(1, 6)):
                rows.append([*(centre + 0.19 * rng.standard_normal(24))] + [label])
    vectors = [(i, [float(x) for x in r[:-1]], int(r[-1])) for i, r in enumerate(rows)]
    n = len(vectors)
    vectors += [(n, vectors[0][1], 0), (n + 1, vectors[0][1], 1), (n + 2, [2 * x for x in vectors[0][1]], 0)]
    vectors += [(n + 3, vectors[0][1], None), (n + 4, None, 0), (n + 5, [0.0] * 24, 0), (n + 6, [float("nan")] * 24, 0), (n + 7, [], 0), (n + 8, [None] + [1.0] * 23, 0), (n + 9, [1.0, 1.0], 0)]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, label in vectors if v and label is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: x for i, _, x in vectors}
    links = {i: 0 for i, _, _ in vectors}
    comp = {i: i for i in links}
    pairs = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(20):
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, label int, node int")
    got = sorted(map(tuple, embedding_dedup.near_vectors(df).collect()))
    assert got == sorted((i, links[i], comp[i], comp[i] == i) for i in links)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    rows = [(i, [float(x) for x in base + 0.05 * rng.standard_normal(16)], 1) for i in range(70)] + [(70, None, 1), (71, None, 1)]
    got = sorted(map(tuple, embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()))
    assert got == [(i, 69, 0, i == 0) for i in range(70)] + [(70, 0, 70, True), (71, 0, 71, True)]


# --- byte-level BPE --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, bpe.Codec(ranks, public_tokenizers.PATTERN), library


def test_encoding_equals_the_library(vocabulary):
    _, codec, library = vocabulary
    rng = random.Random(1)
    pieces = ["a", "b", "the", "ing", " ", "  ", "\n", "'s", "'", "l", "é", "中", "23", "!", "..", "\t", "ſ", "'ll", "ABC", "\U0001f600", "<|endoftext|>"]
    texts = ["".join(rng.choice(pieces[: rng.randint(1, len(pieces))]) for _ in range(rng.choice([3, 30, 300]))) for _ in range(400)]
    texts += ["x" * 5000, " " * 9000 + "x", "ab" * 4000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), "word " * 5000, "", None]
    for text in texts:
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text or "")
        assert codec.decode(ids) == (text or "").encode()


def test_matches_go_through_the_tree_and_full_stores_change_nothing(vocabulary, monkeypatch):
    ranks, _, library = vocabulary
    monkeypatch.setattr(bpe, "KNOWN", 3)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    joins = []
    joined = codec.joined
    monkeypatch.setattr(codec, "joined", lambda a, b: joins.append(1) or joined(a, b))
    rng = random.Random(5)
    words = ["".join(rng.choice("aeiorstln") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    text = " ".join(rng.choice(words) for _ in range(2000))
    assert codec.encode(text) == library.encode_ordinary(text)
    assert joins and len(codec.known) <= 3 and len(codec.older) <= 3


def test_decoding_unknown_ids_is_an_error(spark, vocabulary):
    ranks, codec, _ = vocabulary
    with pytest.raises(KeyError):
        codec.decode([len(ranks) + 10_000])
    lists = spark.createDataFrame([(1, [72, 105]), (2, None)], "id long, token_ids array<int>")
    got = {r["id"]: bytes(r["decoded"]) for r in bpe.decoded(lists, ranks).collect()}
    assert got == {1: codec.decode([72, 105]), 2: b""}


def test_a_batch_of_lists_decodes_at_once_as_each_list_alone(vocabulary):
    import pyarrow as pa

    ranks, codec, _ = vocabulary
    rng = random.Random(3)
    lists = [rng.sample(sorted(ranks.values()), rng.randint(0, 40)) for _ in range(300)] + [None, []]
    batch = pa.array(lists, pa.list_(pa.int32())).slice(1)
    assert codec.decode_lists(batch).to_pylist() == [codec.decode(x or []) for x in lists[1:]]
    with pytest.raises(KeyError):
        codec.decode_lists(pa.array([[72, len(ranks) + 10_000]], pa.list_(pa.int32())))


def test_joining_is_associative_with_a_neutral_element(vocabulary):
    _, codec, _ = vocabulary
    rng = random.Random(2)
    for _ in range(200):
        parts = [codec.merged(bytes(rng.choice(b"abctheingo") for _ in range(rng.randint(0, 12)))) for _ in range(3)]
        whole = codec.merged(b"".join(codec.decode(p) for p in parts))
        assert codec.joined(codec.joined(parts[0], parts[1]), parts[2]) == whole
        assert codec.joined(parts[0], codec.joined(parts[1], parts[2])) == whole
        assert codec.joined([], parts[0]) == parts[0] == codec.joined(parts[0], [])


def test_encoded_and_decoded_frames(spark, vocabulary):
    ranks, codec, _ = vocabulary
    rows = [(1, "hello world", 5), (2, None, 6), (2, "", 7), (3, "é" * 10, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded int")
    done = bpe.decoded(bpe.encoded(df, ranks, public_tokenizers.PATTERN), ranks)
    assert done.columns == ["doc_id", "token_ids", "decoded"]
    got = sorted((r["doc_id"], r["token_ids"], bytes(r["decoded"])) for r in done.collect())
    assert got == sorted((i, codec.encode(t), (t or "").encode()) for i, t, _ in rows)
    assert bpe.encoded(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_one_pass_encodes_and_decodes_as_the_two(spark, vocabulary):
    ranks, codec, _ = vocabulary
    rows = [(1, "hello world", "a"), (2, None, "b"), (2, "", None), (3, "é" * 10 + " x" * 3000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    done = bpe.encoded_and_decoded(df, ranks, public_tokenizers.PATTERN)
    assert done.columns == ["doc_id", "lang", "token_ids", "decoded"]
    got = sorted((r["doc_id"], r["lang"] or "", r["token_ids"], bytes(r["decoded"])) for r in done.collect())
    assert got == sorted((i, g or "", codec.encode(t), (t or "").encode()) for i, t, g in rows)


def test_pipeline_encodes_and_decodes_in_one_python_pass(spark):
    docs = spark.createDataFrame([(1, "en", "web", "hello world")], "doc_id long, lang string, source string, text string")
    plan = corpus_pipeline.encode(spark, docs, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert corpus_pipeline.encode(spark, docs, SMALL).first()["decodes"]


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = spark.createDataFrame(stage(spark, kept, SMALL).collect(), docs.schema)
        assert after.columns == columns, name
        before_rows = {r["doc_id"]: r for r in kept.collect()}
        assert all(before_rows[r["doc_id"]] == r for r in after.collect())
        kept = after
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and len(ids) > 0.6 * docs.count()
    assert sum(labels.get(i) == 0 for i in ids) > 0.7 * sum(v == 0 for v in labels.values())
    mix = corpus_pipeline.mix_sources(spark, kept, SMALL)
    assert mix.columns == columns
    done = corpus_pipeline.encode(spark, mix, SMALL).where(F.col("decodes"))
    assert done.count() == mix.count() > len(ids)
