"""Near copies of different sources never share a sequence."""
import random

from telemark.llm import packing


def test_edited_copies_of_two_sources_stay_apart(spark):
    r = random.Random(5)
    rows = []
    for i in range(30):
        words = [f"w{r.randrange(400)}" for _ in range(70)]
        rows.append((2 * i, " ".join(words), f"a{i}"))
        words[r.randrange(70)] = "other"                   # 61 or more of 66 shingles stay
        rows.append((2 * i + 1, " ".join(words), f"b{i}"))
    rows += [(100, "x y z", "c"), (100, "an other text", "d"), (101, None, "e"), (102, " ", "f"), (None, rows[0][1], "g"), (103, "X y  z", "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    cluster = {(x.id, x.source): x.cluster for x in packing.measure(frame).collect()}
    assert all(cluster[2 * i, f"a{i}"] == cluster[2 * i + 1, f"b{i}"] for i in range(30))
    assert cluster[None, "g"] == cluster[0, "a0"] and cluster[103, "h"] == cluster[100, "c"] != cluster[100, "d"]
    assert cluster[101, "e"] is None and cluster[102, "f"] is None and len({*cluster.values()} - {None}) == 32
    bins = {}
    for p in packing.pack_documents(frame, 500).collect():
        if p.bin_id is not None and p.doc_id is not None and p.doc_id < 100:
            bins.setdefault(p.bin_id, []).append(p.doc_id // 2)
    assert sum(map(len, bins.values())) == 60 and all(len(b) == len(set(b)) for b in bins.values())
