"""Spelling variants, collocations and sharding against brute force and SQL, with nulls, ties, repeats and clashing columns."""

import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pytest

from packetmill.llm import collocations as co
from packetmill.llm import shard_packing as sp
from packetmill.llm import spelling_groups as sg
from packetmill.llm.queries import ORACLES, QUERIES
from tests.compare import connection, differences

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, root string, shard string"


@pytest.mark.parametrize("name", ["op11_spelling_groups", "op12_collocations"])
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connection(FOLDER), ORACLES[name]) == ""


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("block", [2, 4096])
def test_near_pairs(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(250)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "éaaaaaa", "aaaaaab"}
    words |= {"".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(60)}
    rows = spark.createDataFrame([(w, k) for k, w in enumerate(sorted(words))], "word string, n long")
    found = [(r.word, r.other) for r in sg.near_pairs(rows, block=block).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_scan_skips_and_finds():
    words = sorted(["abcabc", "abcabd", "abcaabc", "xbcabc", "zzzzzz", "abcabcd", "bcabca"])
    prefix = [0] + [sg.shared(a, b) for a, b in zip(words, words[1:], strict=False)]
    assert {words[i] for i in sg.scan(words, prefix, "abcabc")} == {"abcabd", "abcaabc", "xbcabc", "abcabcd"}


def brute_groups(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: x for w, x in form.items() if n[x] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def test_spelling_groups(spark):
    rng = random.Random(4)
    stems = ["Straße", "straßen", "Éclair", "éclair", "colour", "color", "coloured", "colored", "abcdefg", "abcdefgh", "abcdefghi"]
    weights = [9, 2, 5, 5, 60, 1, 40, 7, 1, 8, 50]
    docs = [(k, " ".join(rng.choices(stems, weights, k=40)) + ", x×y÷z K", "en", "r", "s") for k in range(60)]
    docs += [(None, "colour " * 9, None, None, None), (3, None, "", "", ""), (3, "", "", "", ""), docs[5], docs[5], (70, "longword" * 9000 + " abcdefgh", "", "", "")]
    out = {tuple(r) for r in sg.spelling_groups(spark.createDataFrame(docs, DOC)).collect()}
    assert out == brute_groups([d[:2] for d in docs]) and any(r[1] for r in out) and any(r[2] not in (r[0], r[1]) for r in out)
    assert sg.spelling_groups(spark.createDataFrame([], DOC)).count() == 0


def brute_collocations(docs, least, top):
    f, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, n in f.items():
        frequent = {p: a for p, a in n.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((2_000_000 * a // (n[p[:k]] + n[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def test_collocations(spark):
    rng = random.Random(5)
    words = ["New", "york", "times", "é", "É", "a-b", "\x01", "日本", "of"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", " "]) for _ in range(n))
    docs = [(k, text(rng.randint(0, 60)), rng.choice(["en", "de", None, ""]), "", "") for k in range(80)]
    docs += [(None, None, "en", "", ""), (1, "", "fr", "", ""), (1, " , ;", "it", "", ""), (2, "und aber " * 40, "und", "", ""), (3, "New york times " * 8000, "en", "", ""), docs[3], docs[3]]
    for least, top in ((4, 2000), (30, 7)):
        out = co.collocations(spark.createDataFrame(docs, DOC), least=least, top=top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(map(tuple, out.collect())) == brute_collocations([d[1:3] for d in docs], least, top)
    assert co.collocations(spark.createDataFrame([], DOC)).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    row = spark.createDataFrame([(big, big, big - 7)], "f long, l long, r long").select((co.exact(co.F.col("f")) * 2_000_000).alias("x"), (co.exact(co.F.col("l")) + co.exact(co.F.col("r"))).alias("y")).selectExpr("x div y as s").first()
    assert row.s == 2_000_000 * big // (2 * big - 7)


def plain_best_fit(sizes, capacity):
    """Bins of descending sizes by a sorted list of (room, bin)."""
    rooms, out, n = [], [], 0
    for size in sizes:
        k = bisect_left(rooms, (size, -1))
        room, number = rooms.pop(k) if k < len(rooms) else (max(capacity, size), n)
        n = max(n, number + 1)
        if room - size:
            insort(rooms, (room - size, number))
        out.append(number)
    return out


def test_best_fit_equals_a_sorted_list():
    rng = random.Random(6)
    for _ in range(60):
        sizes = sorted((rng.choice([rng.randint(8, 40), rng.randint(8, 900), 8]) for _ in range(rng.randint(0, 400))), reverse=True)
        capacity = rng.randint(20, 1000)
        assert sp.pack(sizes, capacity).tolist() == plain_best_fit(sizes, capacity)


def test_deal_takes_the_least_capacity():
    rng = random.Random(7)
    for _ in range(20):
        sizes = sorted((rng.randint(8, 500) for _ in range(300)), reverse=True)
        shards = sp.deal(sizes, 24)
        loads = Counter()
        for size, s in zip(sizes, shards.tolist(), strict=True):
            loads[s] += size
        assert set(loads) <= set(range(24)) and max(loads.values()) <= sum(sizes) / 24 * 1.01 + 8
        assert max(plain_best_fit(sizes, max(loads.values())), default=0) < 24
    assert sp.deal([900, 10, 10, 10], 3).tolist() == [0, 1, 1, 2] or Counter(sp.deal([900, 10, 10, 10], 3).tolist())[0] == 1
    assert sp.deal([], 3).tolist() == [] and sorted(sp.deal([8, 8], 5).tolist()) == [0, 1]


def check_shards(rows, docs, shards=24):
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in docs)
    places = defaultdict(list)
    home = defaultdict(set)
    for r in rows:
        places[r.shard].append(r.slot)
        home[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(x) == list(range(len(x))) for x in places.values()) and set(places) <= set(range(shards))
    assert all(len(x) == 1 for x in home.values())
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    return [loads[k] for k in range(shards)]


def test_shards_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    loads = check_shards(sp.shard_rows(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    fair = sum(loads) / 24
    assert sum(x > 1.02 * fair for x in loads) <= 3  # texts longer than a fair share stand alone


def test_shards_of_odd_rows(spark):
    rng = random.Random(8)
    docs = [(k, "x" * rng.randint(0, 200) + str(k), "", "", "") for k in range(3000)] + [(9, "hot copy " * 30, "", "", "") for _ in range(1500)] + [(None, None, "", "", ""), (None, "", "", "", ""), (7, "é" * 100_000, "", "", "")]
    loads = sorted(check_shards(sp.shard_rows(spark.createDataFrame(docs, DOC)).collect(), [d[:2] for d in docs]))
    assert loads[-1] >= 1500 * 270 and loads[-3] - loads[0] <= 0.01 * loads[0] + 8
    assert sp.shard_rows(spark.createDataFrame([], DOC)).count() == 0
    assert sorted(r.slot for r in sp.shard_rows(spark.createDataFrame([(1, "a", "", "", ""), (1, "a", "", "", "")], DOC)).collect()) == [0, 1]
