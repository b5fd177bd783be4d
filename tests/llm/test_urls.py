"""Verdicts of templates by evidence, at any depth."""

import pytest

pytest.importorskip("riftspan.llm")

from riftspan.llm import urls  # noqa: E402


def judged(spark, paths, labels, host="h.example.com"):
    pages = spark.createDataFrame([(i, f"http://{host}{p}") for i, p in enumerate(paths)], "page_id long, url string")
    table = spark.createDataFrame([(host, p, x) for p, x in labels], "host string, path string, label int")
    return {r["path"]: r for r in urls.judge(pages, [], table).collect()}


def test_a_branch_without_labels_is_not_rejected_for_its_sibling(spark):
    bad = [f"/de/{i}" for i in range(3)]
    got = judged(spark, [*bad, "/de/9", "/en/4"], [(p, 1) for p in bad])
    assert got["/en/4"]["verdict"] == "allow" and got["/en/4"]["template"] == "/en/4"
    assert got["/de/9"]["verdict"] == got["/de/0"]["verdict"] == "block"


def test_labels_count_once_however_long_the_way(spark):
    shares = []
    for prefix in ("/a", "/a/b", "/a/b/c/d/e/f/g"):
        labels = [(f"{prefix}/x{i}", int(i < 9)) for i in range(12)] + [("/other/y", 0)] * 4
        got = judged(spark, [p for p, _ in labels], labels)
        shares.append(round(got[f"{prefix}/x0"]["rejected_share"], 9))
    assert shares[0] == shares[1] == shares[2]
    # By hand: all urls, then the other labels of the host, then those beside the url, then its own.
    p = (9 + 1) / (16 + 2)
    for bad, seen in ((0, 4), (8, 11), (1, 1)):
        p = (bad + urls.PRIOR * p) / (seen + urls.PRIOR)
    assert shares[0] == round(p, 9)


def test_only_labelled_and_similar_branches_merge(spark):
    labels = []
    for name, bad in (("spam", 9), ("junk", 10), ("news", 0), ("blog", 1)):
        labels += [(f"/{name}/{k}{i}", int(i < bad)) for i in range(10) for k in ("p", "q")]
    got = judged(spark, [p for p, _ in labels] + ["/shop/p0", "/shop/q0"], labels)
    branch = {p.split("/")[1]: r["template"].split("/")[1] for p, r in got.items()}
    assert branch["shop"] == "shop"
    assert branch["spam"] == branch["junk"] or branch["spam"] == "spam"
    assert branch["news"] not in (branch["spam"], branch["junk"]) or branch["news"] == "news"
    assert got["/shop/p0"]["verdict"] == "allow" and got["/junk/p0"]["verdict"] == "block"
