"""A folder walk that stops (S11): the first files of a depth-first walk, without
reading the tree behind them.

The walk keeps a stack of open folders in visiting order and asks the link table
for the first of them only.  Paths below a folder begin with the folder's path, so
one question can ask for several levels at once; the number of levels doubles
while the answers are small, which takes a chain of d levels in about log2(d)
questions, and falls where the tree is wide.  No answer has more than ``most``
rows: of a folder with more links, the first ``most`` in visiting order are read,
and the rest stays open.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .links import WALK_EXTENSIONS, extension_pattern, is_folder

#: links of one answer
MOST = 10_000
DEEPEST = 1 << 20
OUTPUT = "ordem int, target string, href string"


def cluster_links(edges: DataFrame, path: str) -> DataFrame:
    """The link table stored in ranges of ``page``, as the walk asks for it: a
    question reads only the row groups that may hold its pages."""
    edges.repartitionByRange("page").sortWithinPartitions("page").write.mode("overwrite").parquet(path)
    return edges.sparkSession.read.parquet(path)


class Walk:
    """The walk over a link table (``page, pos, href, target``).  ``rows`` and
    ``questions`` tell what it has read."""

    def __init__(self, edges: DataFrame, extensions: Sequence[str] = WALK_EXTENSIONS, most: int = MOST):
        folder = is_folder(F.col("href"))
        deeper = F.col("target").startswith(F.col("page")) & (F.length("target") > F.length("page"))
        kind = F.when(folder & deeper, "folder").when(~folder & F.lower(F.col("href")).rlike(extension_pattern(extensions)), "file")
        self.links = edges.where("page IS NOT NULL AND pos IS NOT NULL AND target IS NOT NULL").select(
            "page", F.col("pos").cast("bigint").alias("pos"), "href", "target", kind.alias("kind")).where("kind IS NOT NULL")
        self.most, self.rows, self.questions, self.levels = most, 0, 0, 1
        self.known: dict[str, Counter] = {}
        self.asked = (None, 0)

    def _ask(self, condition: Column, first: bool, limit: int) -> list[tuple]:
        found = self.links.where(condition)
        if first:
            found = found.orderBy(F.col("pos").desc(), "href", "target")
        found = [tuple(r) for r in found.limit(limit).collect()]
        self.rows += len(found)
        self.questions += 1
        return found

    def _covers(self, page: str) -> bool:
        top, deepest = self.asked
        return top is not None and (page == top or page.startswith(top) and page.count("/") <= deepest)

    def _links_of(self, page: str) -> list[tuple] | None:
        """Links of a page in visiting order, or None if they are more than an answer holds."""
        while not self._covers(page):
            deepest = page.count("/") + self.levels - 1
            slashes = F.length("page") - F.length(F.replace("page", F.lit("/"), F.lit("")))
            below = F.col("page") == page
            if self.levels > 1:
                below = F.col("page").startswith(page) & ((slashes <= deepest) | below)
            found = self._ask(below, False, self.most + 1)
            if len(found) > self.most:
                if self.levels == 1:
                    return None
                self.levels = max(1, self.levels // 4)
                continue
            self.asked, self.known = (page, deepest if self.levels > 1 else -1), {}
            for row in found:
                self.known.setdefault(row[0], Counter())[row[1:]] += 1
            self.levels = min(2 * self.levels, DEEPEST)
        return [link for link, n in sorted(self.known.get(page, Counter()).items(), key=lambda x: (-x[0][0], x[0][1:])) for _ in range(n)]

    def _first_links(self, page: str, after: tuple | None) -> tuple[list[tuple], tuple | None]:
        """The first links of a wide page behind a place, and the place behind them."""
        condition, skip = F.col("page") == page, 0
        if after is not None:
            (pos, href, target), skip = after
            same = (F.col("pos") == pos) & ((F.col("href") > href) | ((F.col("href") == href) & (F.col("target") >= target)))
            condition = condition & ((F.col("pos") < pos) | same)
        found = [row[1:] for row in self._ask(condition, True, self.most + skip)]
        if len(found) < self.most + skip:
            return found[skip:], None
        last = found[-1][:3]
        return found[skip:], (last, sum(x[:3] == last for x in found))

    def files(self, root: str, n: int) -> list[tuple[str, str]]:
        """(target, href) of the first ``n`` files."""
        out: list[tuple[str, str]] = []
        stack: list[tuple] = [("folder", root, None)]
        while stack and len(out) < n:
            kind, target, more = stack.pop()
            if kind == "file":
                out.append((target, more))
                continue
            links, rest = self._links_of(target) if more is None else None, None
            if links is None:
                links, rest = self._first_links(target, more)
            if rest is not None:
                stack.append(("folder", target, rest))
            stack += [(k, t, h if k == "file" else None) for _, h, t, k in reversed(links)]
            # what lies behind enough files won't be visited
            enough = 0
            for i in range(len(stack) - 1, -1, -1):
                enough += stack[i][0] == "file"
                if enough == n - len(out):
                    del stack[:i]
                    break
        return out


def latest_files_bounded(edges: DataFrame, root: str = "/", n: int = 3, extensions: Sequence[str] = WALK_EXTENSIONS, most: int = MOST) -> DataFrame:
    """The first ``n`` data files of the depth-first walk from ``root``, as
    :func:`~ledger_analytics.operators.links.latest_files` gives them, from
    what precedes them in the tree.  The ``n`` files and the open folders in
    front of them are held on the driver; for all files of a large tree use
    the other one.  Links with one place on one page follow each other by
    href and target; links without a page, place or target don't count."""
    found = Walk(edges, extensions, most).files(root, n)
    return edges.sparkSession.createDataFrame([(i + 1, t, h) for i, (t, h) in enumerate(found)], OUTPUT)
