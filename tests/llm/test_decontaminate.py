import hashlib
import random
import re

from contract import compare, connect
from coffer.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
                    found |= known[tuple(w[i : i + n])]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["ab", "é", "C3", "dog", "the", "Of"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 7, 10, 14, 30])))) for i in range(12)]
    items += [(20, "ÉTÉ, Alpha-beta."), (21, ""), (22, None), (23, "..."), (24, items[0][1])]
    docs = [(0, None), (1, ""), (2, "été ... ALPHA beta"), (3, "Été alpha beta"), (4, "--")]
    for i in range(5, 60):
        text = " ".join(rng.choices(vocabulary, k=rng.randrange(40)))
        if i % 3 == 0:
            text += "; " + rng.choice(items[:12])[1].upper() + " " + " ".join(rng.choices(vocabulary, k=5))
        docs.append((i, text))
    docs.append((60, "the " * 3000 + items[3][1]))
    left = spark.createDataFrame([(d, t, "x") for d, t in docs + docs[5:8]], "doc_id long, text string, item_id string")
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontaminate.hits(left, right).withColumn("n_hit", decontaminate.covered_words("spans")).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(r["items"])) for r in rows}
    assert len(rows) == len(docs)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:2] for r in decontaminate.hits(docs, items).collect()] == [(1, 2)]
    assert decontaminate.hits(docs.limit(0), items).collect() == []


def test_query_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op1_decontamination"
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == ""


def test_no_items_have_the_checksum_of_nothing(spark):
    row = queries.QUERIES["op1_decontamination"](spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()
