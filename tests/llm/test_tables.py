"""URL templates, Merkle audit, embedding links and mixing on odd tables and against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

pytest.importorskip("riftspan.llm")

from odd import TEXTS, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from riftspan.llm import cosine, merkle, mixing, urls  # noqa: E402


def pages(spark, rows):
    schema = "page_id long, url string, host string, path string, node string, n string, seen string"
    return spark.createDataFrame([(i, u, *["x"] * 5) for i, u in rows], schema)


def test_urls_are_split_and_ruled(spark):
    rows = [
        (1, None), (2, ""), (3, "no-scheme/x"), (4, "http://"), (5, "HTTP://WWW.Example.ORG/es/1?q#f"), (6, "http://example.org/en/12"),
        (7, "http://a.com/fr/x"), (8, "http://com/de/"), (9, "http://xcom/de/"), (10, "http://org#/en"), (11, "x://Ä.É/p?"), (12, "http://a.com?x/de/"),
        (1, None), (13, "http://example.org/en/2"), (14, "http://notexample.org/es/"),
    ]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), urls.RULES).collect()}
    assert urls.judge(pages(spark, rows), urls.RULES).count() == len(rows)
    expected = {
        1: ("", "", None), 2: ("", "", None), 3: ("", "", None), 4: ("", "", None), 5: ("www.example.org", "/es/1", "example.org/es/"),
        6: ("example.org", "/en/12", "example.org/en/1"), 7: ("a.com", "/fr/x", "com/fr/"), 8: ("com", "/de/", "com/de/"), 9: ("xcom", "/de/", None),
        10: ("org", "", None), 11: ("Ä.É", "/p", None), 12: ("a.com", "", None), 13: ("example.org", "/en/2", "org/"), 14: ("notexample.org", "/es/", "org/"),
    }
    assert {i: (r["host"], r["path"], r["rule"]) for i, r in got.items()} == expected
    assert got[5]["verdict"] == "block" and got[7]["verdict"] == "allow" and got[1]["verdict"] == "allow"
    assert urls.judge(pages(spark, []), urls.RULES).count() == 0
    assert urls.judge(pages(spark, rows), []).count() == len(rows)


def test_variable_segments_and_purity(spark):
    rows = [(i, f"http://shop.net/item/{i}/view") for i in range(300)]
    rows += [(1000 + i, f"http://shop.net/spam/{i}.html") for i in range(300)]
    rows += [(2000 + i, f"http://shop.net/about/{'abc'[i % 3]}") for i in range(90)]
    rows += [(3000, "http://shop.net/a/b/c/d/e/f/g"), (3001, "http://shop.net")]
    labels = [("shop.net", f"/spam/{i}.html", 1) for i in range(40)] + [("shop.net", f"/item/{i}/view", 0) for i in range(40)]
    labels = spark.createDataFrame([*labels, ("shop.net", "/about/a", None)], "host string, path string, label int")
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), [], labels).collect()}
    assert {got[i]["template"] for i in range(300)} == {"/item/{digits}/view"}
    assert {got[1000 + i]["template"] for i in range(300)} == {"/spam/{digits}"}
    assert all(got[1000 + i]["verdict"] == "block" for i in range(300))
    assert all(r["verdict"] == "allow" for i, r in got.items() if not 1000 <= i < 1300)
    assert got[3000]["template"].endswith("/**")
    assert got[3001]["template"] == ""


def test_paths_are_told_apart_beyond_the_fourth_segment(spark):
    deep = "/2024/05/12/site"
    rows = [(1000 * k + i, f"http://news.net{deep}/{name}/{i}") for k, name in enumerate(("spam", "news")) for i in range(200)]
    rows += [(5000, f"http://news.net{deep}/alone/x/y/z"), (5001, f"http://news.net{deep}"), (5002, f"http://far.net{'/a' * 6}/b"), (5003, f"http://far.net{'/a' * 6}/c")]
    labels = [("news.net", f"{deep}/{name}/{i}", bad) for name, bad in (("spam", 1), ("news", 0)) for i in range(100)] + [("far.net", "/a" * 6 + "/b", 1)]
    labels = spark.createDataFrame(labels, "host string, path string, label int")
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), [], labels).collect()}
    assert len(got) == len(rows)
    assert {got[i]["template"] for i in range(200)} == {deep + "/spam/{digits}"} and {got[1000 + i]["template"] for i in range(200)} == {deep + "/news/{digits}"}
    assert all(got[i]["verdict"] == "block" and got[1000 + i]["verdict"] == "allow" for i in range(200))
    assert got[5000]["template"] == deep + "/alone/x/y/z/**" and got[5001]["template"] == deep
    # The one label counts once, where the ways part, and not again for each segment that they share.
    assert got[5003]["rejected_share"] == pytest.approx(1 - (1 - 102 / 203) * 5 / 6)


def records(spark, rows):
    return spark.createDataFrame(rows, "file string, at long, body string, node string, hash string, bytes long")


def test_audit_finds_exactly_the_differences(spark):
    rng = random.Random(4)
    first = {(f"f{rng.randrange(3)}", rng.randrange(1 << 20)): f"body {i}" for i in range(400)}
    second = dict(first)
    keys = sorted(first)
    expected = set()
    for k in rng.sample(keys, 30):
        kind = rng.choice(["changed", "missing", "surplus"])
        if kind == "changed":
            second[k] = first[k] + "!"
        elif kind == "missing":
            del second[k]
        else:
            k = ("f9", k[1])
            second[k] = "new"
        expected.add((*k, kind))
    tables = [records(spark, [(f, a, b, "x", "x", 0) for (f, a), b in t.items()]) for t in (first, second)]
    found = merkle.audit(*tables, F.col("file"), F.col("at"), F.col("body")).collect()
    assert {(r["file"], r["offset"], r["problem"]) for r in found} == expected
    changed = next(r for r in found if r["problem"] == "changed")
    assert changed["hash_1"] == hashlib.sha256(first[changed["file"], changed["offset"]].encode()).hexdigest()


def test_audit_of_odd_records(spark):
    rows = [("f", 0, None), ("f", 1, ""), ("f", 2, "a"), ("f", 2, "a"), (None, None, "b"), ("g", 5, "x" * 100_000)]
    one = records(spark, [(*r, "x", "x", 0) for r in rows])
    other = records(spark, [(*r, "x", "x", 0) for r in rows[1:3] + rows[4:]])
    args = (F.col("file"), F.col("at"), F.col("body"))
    assert merkle.audit(one, one.repartition(3), *args).count() == 0
    assert {(r["file"], r["offset"], r["problem"]) for r in merkle.audit(one, other, *args).collect()} == {("f", 0, "missing"), ("f", 2, "changed")}
    assert merkle.audit(one, one.limit(0), *args).count() == 5
    assert merkle.audit(one.limit(0), one.limit(0), *args).count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), *[T.StructField(c, T.StringType()) for c in ("id", "row", "key", "table", "unit", "n")]])


def test_embedding_links_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for centre in rng.standard_normal((30, 16)):
        for _ in range(int(rng.choice([1, 2, 12]))):
            rows.append((centre + rng.standard_normal(16) * 0.12).astype(np.float32).tolist())
    rows += [rows[0], rows[0], (np.array(rows[0]) * 1e-30).tolist(), (np.array(rows[1]) * 1e30).tolist()]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0]]
    table = [(i, v, *["x"] * 6) for i, v in enumerate(rows + odd)]
    df = spark.createDataFrame(table, VECTORS)
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    for block in (512, 3):
        monkeypatch.setattr(cosine, "BLOCK", block)
        counts, edges = cosine.cosine_links(df, "vec_id", "embedding", recall=0.9999)
        got = {r["row"]: r["n"] for r in counts.collect()}
        assert got == {i: int(n) for i, n in enumerate(close.sum(1)) if n}
        label = list(range(len(x)))
        for _ in range(len(x)):
            for r in edges.collect() if _ == 0 else pairs:
                a, b = (r["a"], r["b"])
                label[a] = label[b] = min(label[a], label[b])
            pairs = edges.collect() if _ == 0 else pairs
            if _ > 5:
                break
        brute = list(range(len(x)))
        for _ in range(6):
            for i, j in np.argwhere(close):
                brute[i] = brute[j] = min(brute[i], brute[j])
        assert label == brute
    counts, edges = cosine.cosine_links(df.limit(0), "vec_id", "embedding")
    assert counts.count() == 0 and edges.count() == 0


def test_collision_probability_by_trial():
    rng = np.random.default_rng(8)
    a, b, d = rng.standard_normal(200_000), rng.uniform(0, cosine.CELL, 200_000), 0.7
    same = np.floor(b / cosine.CELL) == np.floor((a * d + b) / cosine.CELL)
    assert same.mean() == pytest.approx(cosine.collision(d), abs=0.01)
    k, tables = cosine.table_sizes(50_000)
    assert 1 - (1 - cosine.collision(math.sqrt(0.2)) ** k) ** tables >= 0.95


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    members = spark.createDataFrame([(i, i, int(t), q.tolist()) for i, (t, q) in enumerate(zip(n, p))], "id long, mark long, tokens long, p array<double>")
    targets = [0.5 * n.sum(), 0.2 * n.sum(), 0.3 * n.sum()]
    rate = np.array([r["rate"] for r in mixing.fit_rates(members, targets, steps=150).orderBy("id").collect()])
    assert (rate >= 0).all()
    assert (rate * n) @ p == pytest.approx(targets, rel=0.01)
    raised = np.array([r["rate"] for r in mixing.fit_rates(members, [t * 2 for t in targets], least=1.0).collect()])
    assert (raised >= 1).all()
    assert mixing.fit_rates(members.limit(0), targets).count() == 0


def test_mixing_of_odd_documents(spark):
    english, german = "the house and the garden ", "das haus und der garten "
    texts = [t for t in TEXTS if t[0] != 8] + [(100 + i, (german if i % 5 == 0 else english) * 3) for i in range(100)]
    docs = documents(spark, texts)
    labels = documents(spark, [(100 + i, (german if i % 5 == 0 else english) * 3) for i in range(60)]).select("text", F.when(F.startswith("text", F.lit("das")), "de").otherwise("en").alias("domain"))
    names, targets, rated = mixing.mix(docs, labels)
    rows = {r["id"]: r for r in rated.collect()}
    assert names == ["de", "en"] and len(rows) == 109 and rated.count() == 109
    assert sum(rows[105]["p"]) == pytest.approx(1) and rows[105]["p"][0] > 0.9 and rows[101]["p"][1] > 0.9
    assert rows[105]["rate"] > rows[101]["rate"] and rows[3]["tokens"] == 0
    totals = [sum(r["rate"] * r["tokens"] * r["p"][k] for r in rows.values()) for k in range(2)]
    assert totals == pytest.approx(targets, rel=0.02)
    names, _, rated = mixing.mix(docs, labels.limit(0))
    assert names == ["all"] and all(r["rate"] == pytest.approx(1) for r in rated.collect())
    assert mixing.mix(docs.limit(0), labels)[2].count() == 0
    tags = spark.createDataFrame([(100 + i, i % 2) for i in range(60)], "doc_id long, quality int")
    mixed = mixing.mixed(docs, tags)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == {i for i, _ in texts}


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_the_fit_ends_at_the_optimum_of_the_same_problem(spark, least):
    rng = np.random.default_rng(3)
    n = rng.integers(20, 300, 400).astype(float)
    share = np.clip(rng.normal(0.9, 0.05, 400), 0.8, 0.98)
    group = rng.choice(2, 400, p=[0.8, 0.2])
    p = np.zeros((400, 4))
    p[np.arange(400), 2 * group], p[np.arange(400), 2 * group + 1] = share, 1 - share
    targets = mixing.flattened_targets((n @ p).tolist(), 0.7, least > 0)
    members = spark.createDataFrame([(i, i, int(n[i]), p[i].tolist()) for i in range(400)], "id long, mark long, tokens long, p array<double>")
    rated = mixing.fit_rates(members, targets, least=least)
    rate = np.array([r["rate"] for r in rated.orderBy("id").collect()])

    def objective(r):
        s, t = (r * n) @ p, np.array(targets)
        return ((s - t) ** 2 / t).sum() / (2 * t.sum()) + mixing.DAMPING / 2 * (n * (r - 1) ** 2).sum() / n.sum()

    # The optimum by plain small steps of the same problem, as many as it takes.
    plain, t = np.ones(400), np.array(targets)
    size = 1 / (max(n @ p / t) * n.sum() / t.sum() + mixing.DAMPING)
    for _ in range(20_000):
        gradient = p @ (((plain * n) @ p - t) / t) * n.sum() / t.sum() + mixing.DAMPING * (plain - 1)
        plain = np.maximum(least, plain - size * gradient)
    assert (rate >= least).all()
    assert objective(rate) <= objective(plain) * 1.02 + 1e-5
    gaps = mixing.domain_gaps(rated, targets)
    assert gaps == pytest.approx(list(((rate * n) @ p - t) / t), abs=1e-9)
    assert mixing.domain_gaps(rated, [*targets[:3], 0.0])[3] is None
