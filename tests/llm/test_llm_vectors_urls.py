"""URL filters, vector codes and whitening, against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from ledgerline.llm import url_filter, vector_codes, whitening
from ledgerline.llm.queries import QUERIES
from ledgerline.session import ship_package

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# --- URL filters ---------------------------------------------------------------------------------

RULES = url_filter.rules("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    listed = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    fits = [
        r for r in listed
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    best = max(fits, key=len, default=None)
    return best, listed.get(best)


def plain_runs(text):
    out = []
    for r in re.findall(r"[^\W\d_]+|\d+", text.lower()):
        out += ["#"] if r.isdigit() else [r[i : i + 63] for i in range(0, len(r), 63)]
    return out


def plain_cut(piece, counts):
    """Best segmentation over all cuts, unknown stretches included."""
    total = sum(counts.values())
    best = [(0.0, [])]
    for end in range(1, len(piece) + 1):
        options = []
        for start in range(end):
            word = piece[start:end]
            score, words = best[start]
            options.append((score + math.log(10 / total) - len(word) * math.log(10), -start, words + [word]))
            if 2 <= len(word) <= 24 and word in counts:
                options.append((score + math.log(counts[word] / total), -start, words + [word]))
        score, _, words = max(options, key=lambda o: (round(o[0], 9), o[1]))
        best.append((score, words))
    return best[-1][1]


def plain_verdicts(rows):
    counts = dict.fromkeys(url_filter.SEEDS, 1)
    for _, _, html in rows:
        for word in re.findall(r"[^\W\d_]+", re.sub("<[^>]*>", " ", html or "").lower()):
            if 2 <= len(word) <= 24:
                counts[word] = counts.get(word, 0) + 1
    tokens = []
    for _, url, _ in rows:
        host, path = plain_parts(url)
        tokens.append([(part, w) for part, t in (("host", host), ("path", path)) for r in plain_runs(t) for w in plain_cut(r, counts)])
    bad = [any(part == "host" and w in url_filter.SEEDS for part, w in t) for t in tokens]
    seen = {}
    for t, b in zip(tokens, bad, strict=True):
        for w in t:
            seen.setdefault(w, [0, 0])[0 if b else 1] += 1
    block, allow = (sum(v[k] for v in seen.values()) for k in (0, 1))
    share = block / (block + allow)
    weight = {w: math.log((b + share) / (a + 1 - share) / (block / allow)) for w, (b, a) in seen.items()}
    prior = math.log(sum(bad) / (len(bad) - sum(bad)))
    out = []
    for (page, url, _), t in zip(rows, tokens, strict=True):
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        score = prior + sum(weight[w] for w in t)
        out.append((page, host, path, rule, verdict or ("block" if score > 0 else "allow"), score))
    return out


def url_rows():
    rng = random.Random(2)
    good = ["garden", "river", "stone", "bridge", "cloud", "paper", "cheap", "pills", "win", "free", "house"]
    text = "<p>" + " ".join(rng.choice(good) for _ in range(400)) + "</p><b>ÄÖ</b>"
    rows = [(i, f"https://{rng.choice(good)}{rng.choice(good[:6])}.example.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.randint(1, 999)}", text if i == 3 else None) for i in range(120)]
    rows += [(200 + i, f"http://casinowin.example.com/en/{i}", "") for i in range(6)]
    rows += [(210 + i, f"http://freebets.example.com/{i}.html", "") for i in range(6)]
    rows += [
        (300, None, None), (301, "no scheme", ""), (302, "x://", ""), (303, "HTTP://FreeWin.Example.COM?x=/de/", "a"),
        (304, "http://a.net", ""), (305, "http://a.net/", ""), (306, "http://net/q", ""), (307, "http://xnet/q", ""),
        (308, "https://www.example.net/en/#t", ""), (309, "https://example.org/fr/a?b", ""), (None, "http://a.org/fr/x", ""),
        (310, "http://" + "garden" * 300 + ".example.org/" + "y" * 5000, ""), (210, "http://freebets.example.com/0.html", ""),
        (311, "http://b.example.com:80/de/1", ""), (312, "http://münchen.example.com/é/١٢", ""),
    ]
    return rows


def test_url_verdicts_are_those_of_brute_force(spark):
    rows = url_rows()
    # further columns whose names the filter uses itself
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "page_id long, url string, html string, n int, host string, shape string")
    got = [tuple(r) for r in url_filter.judged(df, RULES).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = sorted(plain_verdicts(rows), key=key)
    got.sort(key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=1e-3)
    verdict = {g[0]: g[4] for g in got}
    assert verdict[303] == "block" and verdict[300] == "allow" and verdict[306] == "block" and verdict[307] == "allow"
    assert verdict[304] == "allow" and verdict[305] == "block"


def test_url_filter_learns_from_known_verdicts(spark):
    rows = [(i, f"http://{'red' if i % 3 else 'blue'}shop.org/{i}", "red blue shop", [None, "block", "allow"][i % 3 and 1 + (i % 2)] if i % 5 else None) for i in range(60)]
    rows = [(i, u, h, "block" if "red" in u and i < 40 else "allow" if i < 40 else None) for i, u, h, _ in rows]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, known string")
    got = url_filter.judged(df, [], verdict_column="known").collect()
    assert all(r["verdict"] == ("block" if "red" in r["host"] else "allow") for r in got) and len(got) == 60
    assert url_filter.judged(df.limit(0), RULES).count() == 0


def test_url_query_keeps_every_page(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op11_url_filter"][0](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        host, path = plain_parts(p["url"])
        rule, verdict = plain_rule(host, path)
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if re.search("casino|bets|pills|track|spam|adult", host) else "allow"))


# --- vector codes --------------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(c))) for c in v], lab) for i, v, lab in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], object)
    span = x.shape[1] // parts
    books = [[list(x[e, p * span : (p + 1) * span]) for e in range(min(entries, len(x)))] for p in range(parts)]

    def nearest(p, row):
        part = row[p * span : (p + 1) * span]
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in x:
                groups.setdefault(nearest(p, row)[1], []).append(row[p * span : (p + 1) * span])
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out = []
    for (i, _, lab), row in zip(kept, x, strict=True):
        told = [nearest(p, row) for p in range(parts)]
        out.append((i, lab, [k for _, k in told], sum(d for d, _ in told)))
    flat = ",".join(str(c) for p in books for e in p for c in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def vector_rows(n, width, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, width))
    rows = [(i, (centres[i % 5] * rng.random() + 0.05 * rng.standard_normal(width)).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(n)]
    rows += [(n + i, rows[3][1], 1) for i in range(40)]  # one vector many times
    rows += [(n + 50 + i, [0.25 * ((i >> (k % 3)) & 1) for k in range(width)], 2) for i in range(16)]  # ties
    return rows


def key(r):
    return r[0] is None, r[0] or 0, str(r[1:])


def test_codes_are_those_of_plain_lloyd(spark):
    rows = vector_rows(300, 16) + [(None, [0.5] * 16, 1), (7, [0.1] * 16, None), (7, [0.1] * 16, None)]
    broken = [(900, None, 1), (901, [1.0] * 15 + [None], 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] * 16, 2), (904, [1.0] * 8, 2), (905, [], 2), (906, [1e30] * 16, 2)]
    df = spark.createDataFrame([(*r, 1, [2]) for r in rows + broken], VECTORS + ", code int, x array<int>").repartition(5)
    codes, books = vector_codes.coded(df)
    want, sha = plain_codes(rows)
    got = [(r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert vector_codes.codebooks_sha256(books) == sha
    sums = {}
    for _, lab, _, error in want:
        sums[lab] = sums.get(lab, 0) + error
    assert all(r["label_error"] == sums[r["label"]] for r in vector_codes.label_errors(codes).collect())


def test_codes_of_few_rows_and_none(spark):
    df = spark.createDataFrame(vector_rows(4, 8)[:3] + [(9, None, 1)], VECTORS)
    codes, books = vector_codes.coded(df)
    want, sha = plain_codes(vector_rows(4, 8)[:3])
    assert sorted(((r[0], r[1], r[2], r[3]) for r in codes.collect()), key=key) == sorted(want, key=key)
    assert books.shape == (8, 3, 1) and vector_codes.codebooks_sha256(books) == sha
    codes, books = vector_codes.coded(df.where("embedding is null"))
    assert codes.count() == 0 and books is None and vector_codes.label_errors(codes).count() == 0


def test_cover_trees_answer_like_brute_force_and_skip_points():
    rng = np.random.default_rng(6)
    parts = np.vstack([(rng.standard_normal((1, 6)) * 3000 + rng.standard_normal((400, 6)) * 20).astype(np.int64) for _ in range(6)])
    tree = vector_codes.build_tree(parts)
    assert (tree.points[tree.rows] == parts).all() and tree.counts[-1] == len(parts)
    for i in range(0, len(tree.ends), 7):  # every descendant lies within the radius
        below = tree.points[i : tree.ends[i]] - tree.points[i]
        assert np.sqrt((below**2).sum(axis=1)).max() <= tree.radii[i] + 1e-6
    entries = parts[rng.choice(len(parts), 16)]
    apart = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    nearest, error = vector_codes.assigned(tree, entries)
    assert (nearest == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    count, total = vector_codes.totals(tree, entries)
    assert (count == np.bincount(apart.argmin(axis=1), minlength=16)).all()
    assert all((total[k] == parts[apart.argmin(axis=1) == k].sum(axis=0)).all() for k in range(16))
    # an entry per cluster: whole subtrees are assigned without looking at their points
    centres = np.vstack([parts[k * 400] for k in range(6)])
    looked = sum(len(start) for start, _, _ in vector_codes._walk(tree, centres))
    assert looked < len(tree.points) / 3


# --- whitening -----------------------------------------------------------------------------------


def test_whitening_is_that_of_a_plain_eigendecomposition(spark):
    rng = np.random.default_rng(9)
    mix = rng.standard_normal((40, 40)) * 0.3
    data = (rng.standard_normal((700, 40)) @ mix).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(3, data[3].tolist()), (None, data[4].tolist())]
    broken = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [1.0] * 39)]
    df = spark.createDataFrame([(*r, 1) for r in rows + broken], "vec_id long, embedding array<float>, n int").repartition(6)
    got = {}
    for r in whitening.whitened(df).collect():
        got.setdefault(r["vec_id"], r)
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    white = np.array([got[i]["whitened"] for i in range(700)])
    plain = (centred[:700] @ v[:, :32]) / np.sqrt(e[:32])
    assert white.shape == (700, 32)
    assert np.abs(white * np.sign((white * plain).sum(axis=0)) - plain).max() < 1e-8
    assert got[0]["explained"] == pytest.approx((e / e.sum())[:32].tolist(), rel=1e-10)
    assert all(got[i]["deviation"] == int(((n * x[i] - sums) ** 2).sum()) and got[i]["n"] == n for i in range(700))
    assert got[0]["identity_error"] < 1e-10 and None in got


@pytest.mark.parametrize("values", [[2.0, 2, 2, 1, 1, 0, 0], [0.0] * 4, [1, 1 - 1e-13, 1 - 1e-9, 0.5], [1e6, 1, 1e-6], [5.0]])
def test_spectral_splitting_of_repeated_and_close_values(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    a = q @ np.diag(values) @ q.T
    e, v = whitening.spectral((a + a.T) / 2)
    assert e == pytest.approx(sorted(values, reverse=True), abs=1e-13 * max(1, *values))
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-14
    assert np.abs(a @ v - v * e).max() < 1e-13 * max(1, *values)


def test_whitening_without_variance_or_rows(spark):
    df = spark.createDataFrame([(i, [0.5, float(i % 2)]) for i in range(10)] + [(20, None)], "vec_id long, embedding array<float>")
    got = whitening.whitened(df).collect()
    assert len(got) == 10 and all(r["whitened"][1] is None and abs(abs(r["whitened"][0]) - 1) < 1e-12 for r in got)
    assert got[0]["explained"] == pytest.approx([1, 0]) and got[0]["identity_error"] < 1e-12
    flat = whitening.whitened(df.where("vec_id % 2 = 0 and vec_id < 10")).collect()
    assert all(r["whitened"] == [None, None] and r["identity_error"] is None and r["deviation"] == 0 for r in flat)
    assert whitening.whitened(df.limit(0)).count() == 0
