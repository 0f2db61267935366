"""The walk that stops gives the files of the whole walk, from the tree's beginning only."""

import random
import tempfile

import pytest

from ledger_analytics import standins as S
from ledger_analytics.operators.links import latest_files
from ledger_analytics.operators.walks import Walk, cluster_links, latest_files_bounded

from .conftest import SF_SMALL

EDGES = "page string, pos bigint, href string, target string"


def random_tree(seed, pages):
    r = random.Random(seed)
    rows, open_pages = [], ["/"]
    for _ in range(pages):
        page = r.choice(open_pages)
        for pos in range(r.randrange(5)):
            href = r.choice([f"{r.choice('abc')}/", f"{r.choice('abc')}{pos}/x/", "y", f"f{pos}.zip", f"f{pos}.CSV", "g.txt", "../", "?C=N;O=D"])
            rows.append((page, pos, href, page + href if href != "../" else "/"))
            if not href.startswith(("f", "g", "?", "..")):
                open_pages.append(page + href)
    return rows


def files_by_hand(rows, n):
    by_page = {}
    for page, pos, href, target in rows:
        by_page.setdefault(page, []).append((-pos, href, target))

    def walk(page):
        for _, href, target in sorted(by_page.get(page, [])):
            if href.endswith("/") or "." not in href:
                if target.startswith(page) and len(target) > len(page):
                    yield from walk(target)
            elif href.lower().endswith((".zip", ".csv", ".xlsx")):
                yield target, href

    out = []
    for x in walk("/"):
        if len(out) == n:
            break
        out.append(x)
    return out


@pytest.mark.parametrize("most", [10_000, 7, 1])
def test_random_trees(spark, most):
    for seed in range(4):
        rows = random_tree(seed, 25)
        edges = spark.createDataFrame([*rows, ("/", None, "n.zip", "/n.zip"), ("/", 9, None, "/n.zip"), (None, 9, "n.zip", "/n.zip")], EDGES).coalesce(1).cache()
        for n in (1, 6):
            got = [(x.target, x.href) for x in latest_files_bounded(edges, n=n, most=most).collect()]
            assert got == files_by_hand(rows, n), (seed, n)
        edges.unpersist()


def test_wide_pages_equal_places_and_repeated_links(spark):
    rows = [("/", i % 7, f"f{i % 40}.zip", f"/f{i % 40}.zip") for i in range(100)] + [("/", 3, "d/", "/d/")] * 3 + [("/d/", 0, "z.zip", "/d/z.zip")] * 2
    edges = spark.createDataFrame(rows, EDGES).coalesce(1).cache()
    for most, n in ((1, 12), (4, 60), (1000, 200)):
        got = [(x.target, x.href) for x in latest_files_bounded(edges, n=n, most=most).collect()]
        assert got == files_by_hand(rows, n)


def test_empty_tree_and_missing_root(spark):
    edges = spark.createDataFrame([("/a/", 0, "f.zip", "/a/f.zip")], EDGES)
    assert latest_files_bounded(edges).count() == 0 and latest_files_bounded(edges.limit(0)).count() == 0
    assert [x.href for x in latest_files_bounded(edges, root="/a/").collect()] == ["f.zip"]


def chains(spark, n):
    """n chains of 150 levels with ten files at each end."""
    path = "concat('/c', lpad(j, 6, '0'), '/', repeat('d/', i))"
    pages = spark.range(n).selectExpr("id AS j", "explode(sequence(0, 149)) AS i")
    down = pages.selectExpr("CASE WHEN i = 0 THEN '/' ELSE concat('/c', lpad(j, 6, '0'), '/', repeat('d/', i - 1)) END AS page", "j AS pos",
                            "CASE WHEN i = 0 THEN concat('c', lpad(j, 6, '0'), '/') ELSE 'd/' END AS href", f"{path} AS target")
    files = pages.where("i = 149").selectExpr(f"{path} AS page", "explode(sequence(0L, 9L)) AS pos").selectExpr(
        "page", "pos", "concat('f', pos, '.zip') AS href", "concat(page, 'f', pos, '.zip') AS target")
    return down.unionByName(files)


def test_what_is_read_does_not_grow_with_the_tree(spark):
    read = []
    for n in (20, 400):
        edges = cluster_links(chains(spark, n), tempfile.mkdtemp(prefix="ledger-test-") + "/links")
        walk = Walk(edges, most=1000)
        assert [t for t, _ in walk.files("/", 12)][9:11] == [f"/c{j:06d}/" + "d/" * 149 + f"f{p}.zip" for j, p in ((n - 1, 0), (n - 2, 9))]
        assert walk.questions <= 16
        read.append(walk.rows - n)  # the root has a link to each chain
        plan = walk.links.where("page = '/c000001/d/'")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(page" in plan
    assert read[0] == read[1] < 800


def test_the_deep_tree_needs_its_depth(spark):
    edges = S.deep_links(spark, SF_SMALL)
    whole = [tuple(x) for x in latest_files(edges, n=6).collect()]
    assert len(whole) == 6 and whole == [tuple(x) for x in latest_files_bounded(edges, n=6).collect()]
    cut = edges.where("length(page) - length(replace(page, '/', '')) <= 100")
    assert latest_files(cut, n=6).count() == 0
