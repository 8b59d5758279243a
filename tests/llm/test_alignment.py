"""Cross-tokenizer alignment against a plain re-computation."""
import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate
from urllib.parse import urlparse

import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from telemark.llm import alignment as A
from telemark.llm import queries as Q
from telemark.llm import tables as TB

PATHS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    None, "", " ", "  two  blanks ", "plain words, then more words.", "<|endoftext|> and </s> <s> <unk>", "<0x41> ▁mark", "é" * 500,
    "日本語のテキスト 😀😀 mixed", "a" * 5000, "tabs\tand\nlines \n x", "non breaking space", "it's don't we'll", "x y" * 3000, "\x00nul\x01", "plain words, then more words.",
]


def plain(texts):
    from tokenizers import Tokenizer
    import sentencepiece

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    byte = A.byte_level()
    rows, held = [], Counter()
    for text in texts:
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ea = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        eb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not text or not b"".join(ea) == b"".join(eb) == (" " + text).encode():
            ia, ib, ea, eb = [], [], [], []
        ends_a, ends_b = list(accumulate(map(len, ea))), list(accumulate(map(len, eb)))
        shared = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in shared]
        for side, (ids, ends) in enumerate(((ia, ends_a), (ib, ends_b))):
            for i, e in zip(ids, ends):
                groups[bisect_left(shared, e)][side].append(i)
        links = Counter((p, q) for x, y in groups for p in x for q in y)
        held.update(links.keys())
        rows.append((len(ia), len(ib), groups, links))
    most = defaultdict(int)
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    out = []
    for n_a, n_b, groups, links in rows:
        body = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(body.encode()).hexdigest() if n_a else ""))
    return out


def rows_of(frame):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect())


def wanted(ids, texts):
    return sorted((i is not None, i or 0, *r) for i, r in zip(ids, plain(texts)))


def test_awkward_texts(spark, monkeypatch):
    ids = [*range(len(TEXTS)), 3, None]
    texts = [*TEXTS, "plain words, then", "null id"]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumns(
        {c: F.lit(None).cast("string") for c in ("id", "a", "n_a", "shard", "groups_sha256", "stats")}).repartition(3)
    got = A.align_documents(docs, *PATHS, hashed=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = wanted(ids, texts)
    assert rows_of(got) == want
    assert sum(r[2] > 0 for r in want) > 10 and any(r[2] == 0 and r[1] == 6 for r in want)
    assert A.align_documents(docs.filter("false"), *PATHS).count() == 0
    written = A.align_documents(docs.filter("doc_id = 4"), *PATHS).first()["groups"]
    assert written.count(";") == written.count("|") - 1


def test_slices_of_links_add_up(monkeypatch):
    whole = A.align([t for t in TEXTS], *PATHS).pairs.sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")])
    monkeypatch.setattr(A, "SLICE_LINKS", 3)
    parts = A.align([t for t in TEXTS], *PATHS).pairs.sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")])
    assert whole.to_pydict() == parts.to_pydict()


def test_units_have_the_tokens_of_the_whole(monkeypatch):
    text = " ".join(f"word{i}'s, é{i}▁ x" if i % 3 else f" a{i}\n b" for i in range(900))
    monkeypatch.setattr(A, "ENCODE_BYTES", 50)
    assert len(A.units_of(text)) > 900
    for _ in range(2):      # from scratch and from what is kept
        assert [x.flatten().tolist() for x in A.encoded([text], *PATHS)] == [whole_ids(text, 0), whole_ids(text, 1)]
    monkeypatch.setattr(A, "CACHE_BYTES", 0)
    assert [x.to_pylist() for x in A.encoded([None, text, "", "x"], *PATHS)] == [
        [[], whole_ids(text, s), [], whole_ids("x", s)] for s in (0, 1)]


def whole_ids(text, side):
    if side == 0:
        return A._model_a(PATHS[0])[0].encode(" " + text, add_special_tokens=False).ids
    return A._model_b(PATHS[1])[0].encode(text)


def test_query_on_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = Q.queries()["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert rows_of(got) == wanted([r[0] for r in rows], [r[1] for r in rows])


def test_one_shard_at_a_time(spark, monkeypatch):
    """Neither a read of the shards' table nor a Python worker takes the shards of a whole task."""
    kept = {}

    def keep(frame, label, *more):
        kept[label] = TB.stored(frame, label, *more)
        return kept[label]

    monkeypatch.setattr(A, "SHARD_BYTES", 1)
    monkeypatch.setattr(A, "stored", keep)
    texts = [f"plain words {i}, then more words." for i in range(40)] + TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = A.align_documents(docs, *PATHS, hashed=True)
    assert rows_of(got) == wanted(range(len(texts)), texts)
    assert kept["aligned"].count() > 40
    files = [pq.ParquetFile(urlparse(f).path).metadata for f in kept["aligned"].inputFiles()]
    assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= 8
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan and "collect_list" not in plan
