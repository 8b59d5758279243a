"""Whole operators on awkward rows: nulls, empty and very long texts, ties, repeated rows,
empty tables, and extra columns named like results or internals."""
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
from telemark.llm import decontaminate as D
from telemark.llm import licenses as L
from telemark.llm import ngram_join as N
from telemark.llm import neighbours as NN
from telemark.llm import packing, sharding, token_counts, toxicity, transcripts, url_filter
from telemark.llm import queries as Q

SF = "/root/testdata/sf0.001"
R = random.Random(11)
VOCABULARY = [f"word{i}" for i in range(300)]
BASE = [" ".join(R.choice(VOCABULARY) for _ in range(60)) for _ in range(6)]


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = "new" + words[p]
    return " ".join(words)


TEXTS = [
    *BASE, *BASE[:2], edited(BASE[0], [3]), edited(BASE[0], [40]), edited(BASE[0], [3, 40, 50]), BASE[1].upper(), BASE[2] + "\n",
    None, "", " \t\n", "one", "one", "two words", "Two\twords", " ".join(R.choice(VOCABULARY) for _ in range(60_000)), "é" * 3000, BASE[3] + " tail",
]
EXTRA = "n_words long, matches string, id string, key long, text_ string, p_toxic double, shard string, n_tokens long, contaminated string, comp long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 4 else f"src{i % 3 and 1}", None if i % 7 == 6 else "en", None) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, BASE[4], None, None, None), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    for c in EXTRA.split(", "):
        name, kind = c.split(" ")
        frame = frame.withColumn(name, F.lit(None).cast(kind))
    return frame.repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("false")


def test_packing(docs, nothing):
    got = packing.pack_documents(docs, 100).collect()
    assert packing.pack_documents(nothing, 100).count() == 0
    rows = docs.select("doc_id", "text", "source").collect()
    want = sorted(len(brute.NONBLANK.findall(r.text or "")) for r in rows)
    by_row, bins = {}, {}
    for p in got:
        by_row.setdefault(p.doc_id, []).append(p.n_words)
        assert p.n_words <= 100 and (p.bin_id is None) == (p.n_words <= 0)
        if p.bin_id is not None:
            bins.setdefault(p.bin_id, []).append(p)
    assert sum(sum(v) for v in by_row.values()) == sum(want)
    source = {r.doc_id: r.source for r in rows}
    for pieces in bins.values():
        pieces.sort(key=lambda p: p.bin_offset)
        assert [p.bin_offset for p in pieces] == [sum(q.n_words for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.n_words for p in pieces) <= 100
        named = [source[p.doc_id] for p in pieces if source[p.doc_id]]
        assert len(named) == len(set(named))
    # One group, so brute force must give the same bins.
    items = packing.measure(docs).filter("id IS NOT NULL AND n_words > 0 AND n_words <= 100").dropDuplicates(["id"]).cache()
    order = sorted(items.collect(), key=lambda r: (-r.n_words, r.id))
    placed = {r.id: (r.bin_id, r.bin_offset) for r in packing.pack(items, 100).collect()}
    assert [placed[r.id] for r in order] == brute.best_fit(
        [r.n_words for r in order], [r.source for r in order], [r.cluster for r in order], 100)


def test_decontamination(spark, docs, nothing):
    items = [(1, " ".join(BASE[0].split()[5:20])), (2, "TWO words"), (3, None), (4, ""), (5, BASE[3]), (5, BASE[3]), (None, "one"), (10, "absent " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(r.doc_id), *brute.contamination(r.text, items)) for r in docs.collect())

    def told(frame):
        return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in frame.collect())

    assert told(D.digest(D.find_matches(docs, bench, ["doc_id"]))) == want
    old, D.BLOCK_BYTES = D.BLOCK_BYTES, 200   # many blocks give the same
    try:
        assert told(D.digest(D.find_matches(docs, bench, ["doc_id"]))) == want
    finally:
        D.BLOCK_BYTES = old
    clean = D.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(w[0] for w in want if w[2] == 0)
    assert D.decontaminate(nothing, bench).count() == 0
    assert D.decontaminate(docs, bench.filter("false")).count() == docs.count()


def test_token_counts(docs, nothing):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece
    path = tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path).collect())
    want = []
    for r in docs.collect():
        n = len(model.encode(r.text or ""))
        want.append((str(r.doc_id), len((r.text or "").encode()), n, n > 4096))
    assert got == sorted(want)
    assert token_counts.count_tokens(nothing, path).count() == 0


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_ngram_join(docs, nothing, k, percent):
    got = N.link(docs, k=k, percent=percent).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = brute.groups(texts, k, percent)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert len(got) == docs.count()
    kept = N.keep_one(docs, k=k, percent=percent)
    assert kept.columns == docs.columns
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(named) == sorted({c for _, c in want.values()})
    assert kept.filter("doc_id IS NULL").count() == 2
    assert N.link(nothing, k=k, percent=percent).count() == 0 and N.keep_one(nothing).count() == 0


def test_ngram_join_of_a_large_group(spark):
    """Near copies of one text, many of them linked only through others, in several blocks."""
    r = random.Random(9)
    texts = {i: edited(BASE[0], r.sample(range(60), r.choice([0, 1, 1, 2, 2, 3]))) for i in range(160)}
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    old, N.BLOCK_SETS = N.BLOCK_SETS, 25
    try:
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.link(frame).collect()}
    finally:
        N.BLOCK_SETS = old
    assert got == brute.groups(texts, 3, 90)


def test_toxicity(spark, docs, nothing):
    rows = [(1000 + i, ("vile " if i % 4 == 0 else "") + f"plain w{i % 9} text", i % 2, int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows[:300]] + [(None, 1, 1), (1001, None, 0), (7, None, None)],
                                   "doc_id long, quality int, toxic int")
    models = toxicity.corpus_chain(frame, labels)
    got = {r.doc_id: r for r in toxicity.score(frame, models, toxicity.CHAIN, ["doc_id"]).collect()}
    assert all((got[r[0]].p_toxic >= 0.5) == bool(r[3]) for r in rows)      # the last 100 were held out
    assert toxicity.drop_toxic(docs, models).columns == docs.columns
    assert toxicity.drop_toxic(docs, models).count() == docs.count()
    assert toxicity.drop_toxic(nothing, models).count() == 0
    assert toxicity.drop_toxic(frame, toxicity.corpus_chain(frame, labels.filter("false"))).count() == 400
    assert len(toxicity.corpus_chain(nothing, labels)) == 2


def test_sharding(docs, nothing):
    got = sharding.assign(docs, 2000).collect()
    assert len(got) == docs.count() and sharding.assign(nothing, 2000).count() == 0
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    for name, rows in shards.items():
        total = sum(r.n_bytes for r in rows)
        assert {(r.shard_bytes, r.depth, r.oversize) for r in rows} == {(total, len(name) - 1, total > 2000)}
        assert total <= 2000 or len(rows) == 1
        assert not any(other != name and other.startswith(name) for other in shards)


def test_sharding_splits_rows_that_share_an_id(spark):
    frame = spark.createDataFrame([(1, "x" * 100)] * 40, "doc_id long, text string")
    got = sharding.assign(frame, 500).collect()
    assert len(got) == 40 and max(r.shard_bytes for r in got) <= 500 and min(r.depth for r in got) > 32


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com:80/en/", "http://a.example.com/en",
            "http://example.com/EN/", "http://notexample.com/en/", "x://net/es/", "http://a.net/fr/?q=://b.com/", "http://a.org/casino/x", "http://a.org?x",
            "http://a.org#://b", "http://m.a.org/q/amp/z", "http://com/\n"] + ["http://a.com/"] * 3
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = url_filter.rule_table(spark, [(r, a, 1) for r, a in Q.HOST_RULES] + [(r, a, 2) for r, a in Q.PATTERN_RULES] + [("*zz*", "block", 2)])
    got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = brute.fold(rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = []
        for rule, action in Q.HOST_RULES:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((-len(rule), rule, action))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, min(fits)[1] if fits else None), u
        if fits:
            assert got[i].verdict == min(fits)[2]
    assert got[11].verdict == got[14].verdict == "block" and got[0].verdict == "allow"
    assert url_filter.judge(pages.filter("false"), rules).count() == 0
    assert url_filter.judge(pages, rules.filter("false")).filter("verdict = 'block'").count() == 0


def test_nearest_neighbours(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)], None) for i in range(300)]
    rows += [(400 + i, rows[0][1], None) for i in range(40)]                     # one hot vector
    rows += [(500, None, None), (501, [], None), (502, [0.0] * 8, None), (503, [float("nan")] + [1.0] * 7, None), (504, [None] + [1.0] * 7, None),
             (505, [1.0], None), (None, [1.0] * 8, None), (20, rows[20][1], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = {}
    for x in NN.search(frame, frame.filter("vec_id % 20 = 0")).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    good = {i: v for i, v, _ in rows[:340]}
    assert sorted(got) == sorted(i for i in good if i % 20 == 0)
    for q, found in got.items():
        found.sort()
        want = sorted((-sum(a * b for a, b in zip(v, good[q])), i) for i, v in good.items() if i != q)[:20]
        assert [f[0] for f in found] == list(range(1, 21))
        assert [f[1] for f in found] == [i for _, i in want]                    # so small a table is searched whole
        assert all(abs(f[2] + w[0]) < 1e-9 for f, w in zip(found, want))
    assert NN.search(frame.filter("false"), frame).count() == 0
    assert NN.search(frame, frame.filter("false")).count() == 0


def test_transcripts(spark):
    talk = []
    for c in range(60):
        for t in range(4 if c else 300):                                         # conversation 0 needs a tree of chunks
            talk.append((c, t, ["user", "assistant"][t % 2], ("What is w%d?" % t) if t % 2 == 0 else "It is this and that.\n" * 3 + "So be it."))
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    raw = transcripts.raw_transcripts(frame)
    model = transcripts.train(transcripts.lines(raw.filter("conv_id < 40"), keep=("role",)))
    got = {(r.conv_id, r.start_seq): (r.role, r.text) for r in transcripts.turns(transcripts.recover(raw, model)).collect()}
    assert got == {(c, t): (role, text) for c, t, role, text in talk}
    odd = spark.createDataFrame([(None, 0, "User: hi"), (1, 0, None), (1, 1, ""), (1, 2, "A: x"), (1, 2, "A: x"), (2, None, "Q: y")], "conv_id long, seq long, text string")
    out = transcripts.turns(transcripts.recover(odd.filter("seq IS NOT NULL"), model)).collect()
    assert {r.conv_id for r in out} == {None, 1}
    assert transcripts.turns(transcripts.recover(odd.filter("false"), model)).count() == 0


def test_licenses(spark, docs, nothing):
    notice = {n: t for n, t in L.TEMPLATES}
    files = spark.createDataFrame([
        (1, notice["MIT"], "a/LICENSE"), (2, "x", "a/b/c/f.txt"), (3, "x\n" + notice["GPL-3.0"] + " More words here.", "a/b/g.txt"),
        (4, notice["Apache-2.0"], "a/b/LICENSE.md"), (5, None, "a/b/h"), (6, "", "z/f"), (7, "license to nothing at all is what this sentence grants", "z/q"),
        (8, "x", None), (9, "x", "top"), (2, "x", "a/b/c/f.txt")], "doc_id long, text string, path string")
    got = sorted((r.doc_id, r.own_license, r.license, r.license_dir) for r in L.scan(files, L.template_table(spark)).collect())
    assert got == sorted([
        (1, "MIT", "MIT", None), (2, None, "Apache-2.0", "a/b/"), (2, None, "Apache-2.0", "a/b/"), (3, "GPL-3.0", "GPL-3.0", None),
        (4, "Apache-2.0", "Apache-2.0", None), (5, None, "Apache-2.0", "a/b/"), (6, None, None, None), (7, None, None, None), (8, None, None, None),
        (9, None, None, None)], key=lambda x: (x[0], str(x)))
    assert L.scan(L.with_paths(nothing), L.template_table(spark)).count() == 0
    assert L.scan(L.with_paths(docs), L.template_table(spark)).count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_equals_oracle(spark, name):
    from oracle_check import compare, duck, types
    con = duck(SF)
    df = Q.queries()[name](spark, SF)
    assert compare(df, con, Q.oracle_sql()[name]) is None
    assert types(df, con, Q.oracle_sql()[name]) == []
    con.close()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_of_the_forest(spark):
    got = {}
    for x in Q.queries()["op6_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    import numpy as np
    table = duckdb.execute("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchnumpy()
    ids, x = table["vec_id"], np.stack(table["embedding"]).astype(np.float64)
    place = {int(v): i for i, v in enumerate(ids)}
    shares = []
    for q, found in got.items():
        s = x @ x[place[q]]
        best = [v for v in ids[np.lexsort((ids, -s))][:21] if v != q][:20]
        shares.append(len(found & {int(v) for v in best}) / 20)
    assert np.mean(shares) >= 0.9


def test_licenses_of_headers_and_whole_files(spark):
    full = dict(reversed(L.texts()))
    gpl = [t for n, t in L.HEADERS if n == "GPL-3.0"][1].split(" ")
    wrapped = "/*\n * Copyright (C) 2020 Jane Doe\n *\n" + "".join(f" * {' '.join(gpl[i: i + 9])}\n" for i in range(0, len(gpl), 9)) + " */\nint main() { return 0; }\n" * 40
    rows = [
        ("MIT", "m/LICENSE", "MIT License\n\nCopyright (c) 2024 Jane Doe\n\n" + full["MIT"].split("\n\n", 1)[1]),
        ("MIT", "m/x.py", "# " + full["MIT"].split("\n\n")[1].replace(", ", ",\n# ") + "\n\nimport os\n" + "x = f(y)\n" * 50),
        ("ISC", "i/COPYING", "Copyright (c) 2024 Jane Doe\n\n" + full["ISC"].split("\n\n", 1)[1]),
        ("GPL-3.0", "g/a.c", wrapped), ("GPL-3.0", "g/COPYING", full["GPL-3.0"]), ("GPL-2.0", "h/COPYING", full["GPL-2.0"]),
        ("Apache-2.0", "a/LICENSE.txt", full["Apache-2.0"]), ("BSD-3-Clause", "b/LICENSE", full["BSD-3-Clause"]), ("BSD-2-Clause", "b2/LICENSE", full["BSD-2-Clause"]),
        ("MIT", "s/a.rs", "// SPDX-License-Identifier: MIT\nfn main() {}"), ("EUPL-1.2", "s/b.rs", "/* SPDX-License-Identifier: EUPL-1.2 */\nfn main() {}"),
        ("MIT OR Apache-2.0", "s/c.rs", "// SPDX-License-Identifier: MIT OR Apache-2.0\nfn main() {}"),
        ("Apache-2.0", "w/a.txt", "Some words\nLicensed under the Apache\nLicense, Version 2.0.\nMore words"),
        ("Proprietary", "p/a.txt", "Words.\nAll rights reserved."), ("MIT", "p/b.txt", "All rights reserved.\nThis is released under the MIT License."),
        (None, "q/a.txt", "# a free software of words\n" + "nothing else at all\n" * 20000)]
    files = spark.createDataFrame([(i, r[2], r[1]) for i, r in enumerate(rows)], "doc_id long, text string, path string")
    got = {r.doc_id: r.own_license for r in L.scan(files, L.template_table(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [r[0] for r in rows]
    import re
    assert all(re.search(L.BLOCK_CUE, t) for _, t in [*L.TEMPLATES, *L.HEADERS, *L.texts()])
