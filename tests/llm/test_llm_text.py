"""Chat formatting, exact and near duplicates, lines."""

import hashlib
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat_format, exact_dedup, graph, line_dedup, minhash

DOCS = "doc_id long, text string"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- chat formatting -------------------------------------------------------------------------


def read_back(df):
    out = {}
    for r in df.select(
        "conv_id",
        "formatted",
        chat_format.turns_of(F.col("formatted")).alias("turns"),
        chat_format.learned_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect():
        out[r["conv_id"]] = ([tuple(t) for t in r["turns"]], r["loss"], r["formatted"])
    return out


def test_chat_round_trip_with_control_strings_nulls_and_merging(spark):
    rows = [
        (1, 0, "user", "\\### Assistant: </turn> ok"),
        (1, 1, "assistant", "\\### Assistant: </turn> ok"),
        (1, 2, "assistant", None),
        (1, 3, "assistant", "tail\\"),
        (1, 4, "user", "</turn>\n### user: \U0001f600"),
        (2, 0, None, ""),
        (2, None, "a: b\\c:", "first: null turns come first"),
        (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"),
        (None, 0, "assistant", "no conversation"),
    ]
    # further columns whose names the formatting uses itself
    df = frame(spark, [(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, turns int, formatted string")
    got = read_back(chat_format.format_conversations(df))
    assert got[1][0] == [(r[2], r[3] or "") for r in rows[:5]]
    assert got[1][1] == "\\### Assistant: </turn> ok" + "" + "tail\\"
    assert got[1][2].count("### assistant: ") == 1  # three adjacent turns, one block
    assert got[2][0] == [("a: b\\c:", "first: null turns come first"), ("", "")]
    assert got[3][0] == [("assistant", "same")] * 2 and got[3][1] == "samesame"
    assert got[None][1] == "no conversation"


def test_chat_of_an_empty_table_is_empty(spark):
    df = frame(spark, [], "conv_id long, turn long, role string, text string")
    assert chat_format.format_conversations(df).count() == 0


def test_chat_long_conversation_keeps_every_turn(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", "x#" * (i % 50)) for i in range(2000)]
    got = read_back(chat_format.format_conversations(frame(spark, rows, "conv_id long, turn long, role string, text string")))
    assert got[1][0] == [(r[2], r[3]) for r in rows]
    assert got[1][1] == "".join(r[3] for r in rows if r[2] == "assistant")


def test_chat_of_very_many_turns_stays_fast(spark):
    n = 50_000
    df = spark.range(n).selectExpr(
        "1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'assistant', 'user') AS role", "concat('t#', id) AS text"
    )
    began = time.monotonic()
    turns, loss, _ = read_back(chat_format.format_conversations(df))[1]
    assert time.monotonic() - began < 60
    assert turns == [("user" if i % 3 else "assistant", f"t#{i}") for i in range(n)]
    assert loss == "".join(f"t#{i}" for i in range(0, n, 3))


def test_chat_without_an_assistant_has_no_learned_text(spark):
    got = read_back(chat_format.format_conversations(frame(spark, [(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")))
    assert got[1][0] == [("user", "a")] and got[1][1] == ""


# --- exact duplicates ------------------------------------------------------------------------


def exact_rows():
    long = "long text " * 3000
    return [
        (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, long + "x"), (7, long + "y"), (8, long + "x"),
        (9, "p" * 64), (10, "p" * 64 + "q"), (11, "p" * 64), (12, "p" * 64 + "r"), (None, "a"), (None, "null id"),
        (13, "same row"), (13, "same row"), (14, "é" * 600), (15, "é" * 599 + "è"), (16, "é" * 600),
    ]


def test_exact_copies_against_brute_force(spark):
    rows = exact_rows()
    got = sorted(map(tuple, exact_dedup.exact_copies(frame(spark, rows, DOCS)).collect()), key=str)
    want = []
    for i, text in rows:
        same = [j for j, t in rows if (t or "") == (text or "")]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_without_copies_leaves_one_row_of_each_text_and_all_columns(spark):
    rows = [(*r, f"id {i}", "block") for i, r in enumerate(exact_rows())]
    df = frame(spark, rows, "doc_id long, text string, row string, block string")
    got = exact_dedup.without_copies(df)
    assert got.columns == df.columns
    texts = [r["text"] or "" for r in got.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in exact_rows()})


@pytest.mark.parametrize("function", [exact_dedup.exact_copies, exact_dedup.without_copies, minhash.near_duplicates])
def test_dedup_of_an_empty_table_is_empty(spark, function):
    assert function(frame(spark, [], DOCS)).count() == 0


# --- near duplicates -------------------------------------------------------------------------


def brute_near(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    comp = {i: i for i in sets}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    return sorted((i, len(sets[i]), comp[i], comp[i] == i) for i in sets)


def near_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for size, copies in ((6, 3), (40, 12), (200, 25), (900, 4)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, size // 45))):
                text[rng.randrange(size)] = word()
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One TWO"), (n + 4, "one\ttwo"), (n + 5, "one two three"), (n + 6, "ÀB c"), (n + 7, "àb c")]
    rng.shuffle(rows)
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    got = minhash.near_duplicates(frame(spark, rows, DOCS))
    assert sorted(map(tuple, got.collect())) == brute_near(rows)


def test_a_chain_of_links_is_one_component(spark):
    # neighbours are similar, the ends are not: no single star holds the chain
    words = [f"w{i}" for i in range(130)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(20)]
    got = minhash.near_duplicates(frame(spark, rows, DOCS))
    assert sorted(map(tuple, got.collect())) == brute_near(rows)


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (None, text), (7, text + " more"), (None, "alone among the texts here"), (8, None)]
    got = sorted(map(tuple, minhash.near_duplicates(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, node int")).collect()), key=str)
    assert got == sorted(
        [(5, 46, 5, True), (5, 46, 5, True), (None, 46, 5, False), (7, 47, 5, False), (None, 1, None, True), (8, 0, 8, True)], key=str
    )


def test_without_near_copies_keeps_one_of_each_group(spark):
    rows = [(*r, "s") for r in near_rows()]
    df = frame(spark, rows, "doc_id long, text string, row string")
    kept = minhash.without_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in brute_near(near_rows()) if r[3]]


def test_densified_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (8, 60, 1000):
        close = []
        for _ in range(60):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            b = a.copy()
            b[: n // 8] = rng.integers(0, 2**63, n // 8, dtype=np.uint64)
            true = (n - n // 8) / (n + n // 8)
            same = (minhash.signature(np.unique(a)) == minhash.signature(np.unique(b))).mean()
            close.append(same - true)
        assert abs(np.mean(close)) < 0.05


def test_components_of_a_random_graph(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(500, 560)] + [(None, 3), (9, 9)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in graph.components(frame(spark, edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert graph.components(frame(spark, [], "a long, b long")).count() == 0


# --- lines -----------------------------------------------------------------------------------


def test_simhash_is_the_majority_of_the_bits(spark):
    rng = random.Random(3)
    rows = [(i, [rng.getrandbits(64) - 2**63 for _ in range(n)]) for i, n in enumerate([1, 2, 3, 15, 16, 63, 64, 255, 256, 700])]
    words = frame(spark, rows, "i int, h array<long>").select("i", F.explode("h").alias("h"))
    got = line_dedup.simhashes(words, "i", "h").collect()
    assert len(got) == len(rows)
    for r in got:
        hashes = rows[r["i"]][1]
        want = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in hashes) > len(hashes))
        assert r["simhash"] % 2**64 == want and r["words"] == len(hashes)


def test_lines_equal_after_normalising_or_nearly_equal_form_groups(spark):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("lo", "ki", "ma", "ne") for b in ("ra", "tu", "vo", "xi", "zu")]
    base = [rng.choice(words) + str(i) * (i % 3 == 0) for i in range(120)]
    near = list(base)
    near[50] = "different"
    other = [rng.choice(words) + "q" for _ in range(120)]
    rows = [
        (1, "Hello,  World 17!\nkeep me\n\n---"),
        (2, "hello world 99\n" + " ".join(base)),
        (3, " ".join(near) + "\n" + " ".join(other)),
        (4, None),
        (5, ""),
        (5, "keep me"),
        (None, "KEEP me"),
    ]
    df = frame(spark, [(*r, 0, "k") for r in rows], "doc_id long, text string, line_no int, k string")
    got = {}
    for r in line_dedup.line_groups(df).collect():
        got.setdefault((r["doc_id"], r["line_no"]), []).append((r["keep_id"], r["keep_line_no"], r["group_size"], r["kept"]))
    assert got[1, 0] == [(1, 0, 2, True)] and got[2, 0] == [(1, 0, 2, False)]
    assert got[2, 1] == [(2, 1, 2, True)] and got[3, 0] == [(2, 1, 2, False)]
    assert got[3, 1] == [(3, 1, 1, True)]
    assert got[1, 2] == [(1, 2, 1, True)] and got[1, 3] == [(1, 3, 1, True)]  # nothing to compare
    assert got[None, 0] == [(None, 0, 3, True)] and got[1, 1] == [(None, 0, 3, False)]  # null first
    assert set(got[5, 0]) == {(5, 0, 1, True), (None, 0, 3, False)}
    assert (4, 0) not in got


def test_similar_lines_are_those_of_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(w) for w in itertools.product("abcdefghijklmn", repeat=3)]
    lines = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(5):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 12)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            lines.append(" ".join(text))
    df = frame(spark, list(enumerate(lines)), DOCS)
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    comp = list(range(len(lines)))
    links = []
    for a, b in itertools.combinations(range(len(lines)), 2):
        x, y = lines[a].split(), lines[b].split()
        if edits(x, y) <= max(len(x), len(y)) * (100 - line_dedup.SIMILARITY) // 100:
            links.append((a, b))
    for _ in lines:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    got = {r["doc_id"]: r["keep_id"] for r in line_dedup.line_groups(df).collect()}
    assert got == dict(enumerate(comp)) and len(links) > 5


def test_every_pair_of_similar_lines_is_linked(spark):
    rng = random.Random(9)
    vocabulary = ["".join(w) for w in itertools.product("abcdefghijklmn", repeat=3)]
    common = vocabulary[:12]
    lines, group = [], []
    for n in [5, 6, 8, 9, 10, 14, 15, 20, 31, 40, 80, 200] * 3:
        base = [rng.choice(common if rng.random() < 0.4 else vocabulary) for _ in range(n)]
        edited = list(base)
        for at in rng.sample(range(n), n // 5):  # as many edits as 0.8 allows
            edited[at] = rng.choice(vocabulary) + "x"
        longer = list(base)
        for _ in range(n // 4 if n % 4 == 0 else 0):
            longer.insert(rng.randrange(len(longer) + 1), rng.choice(common))
        for text in (base, edited, longer):
            lines.append(" ".join(text))
            group.append(len(group) // 3 * 3)
    got = {r["doc_id"]: r["keep_id"] for r in line_dedup.line_groups(frame(spark, list(enumerate(lines)), DOCS)).collect()}
    assert got == dict(enumerate(group))


def test_documents_without_near_lines(spark):
    rows = [(1, "one line here\nanother one"), (2, "One line, here!\nits own line"), (3, "another one")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_near_lines(frame(spark, rows, DOCS)).collect()}
    assert got == {1: "one line here\nanother one", 2: "its own line"}
    assert line_dedup.without_near_lines(frame(spark, [], DOCS)).count() == 0


# --- near duplicates: groups of several components ---------------------------------------------


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").lower().split()
        grams = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        sets.setdefault(i, []).append(grams)
    ids = sorted(sets)
    least = {i: i for i in ids}
    links = [
        (a, b) for a, b in itertools.combinations(ids, 2)
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
    ]
    for _ in ids:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least, links


def test_a_group_of_many_components_keeps_every_link(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(160):  # near copies at the border of the threshold, unlike each other
        text = list(base)
        for _ in range(rng.randint(2, 9)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(200, 230):  # each like the one before, the ends are not alike
        chain = chain[3:] + [rng.choice(vocabulary) for _ in range(3)]
        rows.append((i, " ".join(chain)))
    least, links = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows, DOCS)).collect()}
    assert got == least and len(links) > 100 and len(set(least.values())) > 20


def test_many_rows_without_an_id(spark):
    rng = random.Random(12)
    rows = [(None, " ".join(rng.choice("abcdefgh") for _ in range(30))) for _ in range(250)]
    rows += [(None, "the same text for all of these rows here")] * 250
    got = minhash.near_duplicates(frame(spark, rows, DOCS)).collect()
    assert len(got) == 500 and all(r["component_id"] is None and r["kept"] for r in got)
