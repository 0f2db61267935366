from ledger_analytics.operators.links import (
    first_matching_link, latest_files, links_by_extension, page_links,
)


def test_latest_files_fixture(spark):
    # FIXTURES 2.11
    rows = [("/", 0, "2024/", "/2024/"), ("/", 1, "2025/", "/2025/"), ("/2024/", 0, "a.zip", "/2024/a.zip"),
            ("/2024/", 1, "b.zip", "/2024/b.zip"), ("/2025/", 0, "c.zip", "/2025/c.zip"),
            ("/2025/", 1, "../", "/"), ("/2025/", 2, "?C=N;O=D", "/2025/?C=N;O=D")]
    edges = spark.createDataFrame(rows, "page string, pos int, href string, target string")
    got = [r["href"] for r in latest_files(edges, n=3).collect()]
    assert got == ["c.zip", "b.zip", "a.zip"]
    assert [r["href"] for r in latest_files(edges, n=10).collect()] == ["c.zip", "b.zip", "a.zip"]


def test_latest_files_walks_any_depth(spark):
    rows, page = [("/", 5, "root.zip", "/root.zip")], "/"
    for i in range(40):
        rows.append((page, 1, f"d{i}/", f"{page}d{i}/"))
        page = f"{page}d{i}/"
    rows.append((page, 0, "deep.csv", f"{page}deep.csv"))
    edges = spark.createDataFrame(rows, "page string, pos int, href string, target string")
    assert [r["href"] for r in latest_files(edges, n=3).collect()] == ["root.zip", "deep.csv"]


def test_awkward_links(spark):
    html = ('<a href="">none</a><a href=" ">blank</a><a title="a>b" href="ok.html">x</a><!-- <a href="no.html"> --><a href="a&eacute;.csv">'
            '<a href="x?a=1&amp;lt;b&nosuch;c&#65;&#x42;&lt">y</a>')
    pages = spark.createDataFrame([(1, "http://h/p.html", html)], "page_id int, url string, html string")
    got = [(r["pos"], r["href"]) for r in page_links(pages).orderBy("pos").collect()]
    assert got == [(2, "ok.html"), (3, "aé.csv"), (4, "x?a=1&lt;b&nosuch;cAB&lt")]


def test_page_links_and_filters(spark):
    html = ('<html><a href="/x/a.ZIP">1</a> <A class="k" HREF=\'sub/b.csv\'>2</A>'
            '<a name="n">no</a><a href="https://o.org/demonstracoes_contabeis/">3</a>'
            '<a href="/q?a=1&amp;b=2">4</a><a data-href="/no" title=x>5</a><a id=z href=/bare.txt>6</a></html>')
    pages = spark.createDataFrame([(1, "http://h.org/dir/p.html", html)], "page_id long, url string, html string")
    links = page_links(pages)
    got = [(r["pos"], r["href"], r["resolved"]) for r in links.orderBy("pos").collect()]
    assert got == [(0, "/x/a.ZIP", "http://h.org/x/a.ZIP"), (1, "sub/b.csv", "http://h.org/dir/sub/b.csv"),
                   (2, "https://o.org/demonstracoes_contabeis/", "https://o.org/demonstracoes_contabeis/"),
                   (3, "/q?a=1&b=2", "http://h.org/q?a=1&b=2"), (4, "/bare.txt", "http://h.org/bare.txt")]
    first = first_matching_link(links, "demonstracoes_contabeis").collect()
    assert [r["pos"] for r in first] == [2]
    ext = links_by_extension(links.withColumnRenamed("page_id", "page")).collect()
    assert sorted(r["href"] for r in ext) == ["/bare.txt", "/x/a.ZIP", "sub/b.csv"]


def test_entities_in_hrefs(spark):
    hrefs = ["/a&#233;b", "/&#xE9;&#X41;", "/e&#128512;", "/&#55296;s", "/&amp;#233;", "/q?a=1&amp;b=2", "/&lt;&apos;&#39;"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    pages = spark.createDataFrame([(1, "http://h.org/p", html)], "page_id long, url string, html string")
    got = [r["href"] for r in page_links(pages).orderBy("pos").collect()]
    assert got == ["/aéb", "/éA", "/e\U0001F600", "/&#55296;s", "/&#233;", "/q?a=1&b=2", "/<''"]


def hrefs(spark, *pages):
    df = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id int, url string, html string")
    got = [[] for _ in pages]
    for r in page_links(df).orderBy("page_id", "pos").collect():
        got[r.page_id].append((r.pos, r.href))
    return got


def test_links_by_the_reader_s_state(spark):
    cases = {
        "<script><a href=n></script><a href=y>": [(0, "y")],
        "<SCRIPT src=x>'</Script ><a href=y></script>": [(0, "y")],
        "<script>var a = '</scripts><a href=n>'": [],
        "<scripts><a href=y></scripts>": [(0, "y")],
        "<textarea><!-- </textarea><a href=y> -->": [(0, "y")],
        "<title></style></title ><style>'<a href='n'>'</style/><a href=y>": [(0, "y")],
        "<!--><a href=y><!-- <a href=n>": [(0, "y")],
        "<!-- --!><a href=y><!doctype <a href=n><?<a href=n>": [(0, "y")],
        "</ <a href=n><a href=y>": [(0, "y")],
        "<p x='>' y=\">\"><a href=y>": [(0, "y")],
        "<p x='><a href=n>": [],
        "<p it's><a href=y>": [(0, "y")],
        "<p x=it's><a href=y>": [(0, "y")],
        "<a x=<a href=y>": [(0, "y")],
        "<a\nhref\n=\n' y\t'\nhref=n>": [(0, "y")],
        "<a href><a href=><a href=''><a href=y>": [(2, "y")],
        "<ahref=n><a-b href=n><a/href=y>": [(0, "y")],
        "<a title='href=n' xhref=n href-x=n Href=y/>": [(0, "y/")],
        "<a href='n": [],
        "</a href=n><a href=\"q'\"><a href='q\"'><a href=q''>": [(0, "q'"), (1, 'q"'), (2, "q''")],
        "a < b <a href=y> << <a href=z>": [(0, "y"), (1, "z")],
        "": [], "<": [], "<a": [], "<a ": [],
    }
    assert dict(zip(cases, hrefs(spark, *cases))) == cases


def test_long_pages_are_read_in_one_go(spark):
    n = 200_000
    pages = ["<a " + "x=y " * n + "href='k'>", "<a href=\"" + "z" * n + "\">", "<script>" + "<a href='x'>" * n + "</script><a href=y>", "<" * n, "<a " * n, "<!--" * n,
             "'\"=" * n, "<a x=\"" * n, "<p>" * n + "<a href=y>", None]
    assert [[h[:1] for _, h in p] for p in hrefs(spark, *pages)] == [["k"], ["z"], ["y"], [], [], [], [], [], ["y"], []]
