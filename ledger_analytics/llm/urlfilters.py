"""URL filter: host rules, then a weighted vocabulary searched with Aho-Corasick.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end (A-Z lower-cased), the path
what follows up to ``?``, ``#`` or the end.

* A rule names a host and the start of a path; it fits that host and all its subdomains.  The longest fitting
  rule decides (by characters of host and path; of equally long ones the one with the longer host).
* Without a rule the vocabulary decides.  One automaton finds all occurrences of all terms in the lower-cased
  (A-Z) URL; an occurrence counts if no ASCII letter or digit stands next to it on either side.  Strict terms
  weigh ``LIMIT`` each, soft terms less.  A URL is blocked if the weights of its *distinct* terms reach
  ``LIMIT``: one strict term, or several different soft ones.

Rules and vocabulary are parameters of bounded size and go to the tasks with the code; pages never move between
tasks, so a host with a third of all rows is as good as any other.

Defined cases: a null URL, and one without ``://``, has an empty host and path, so no rule fits it; the
vocabulary still sees the whole text of the latter, and a null URL has no terms (allowed).  URLs of any length
are searched whole.  Every input row gives one output row, repeated rows and rows without an id included; an
empty table gives none.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

ALLOW, BLOCK = "allow", "block"

#: rules of the registered query: verdict, host, start of the path
RULES = ((ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"), (ALLOW, "com", "/fr/"), (BLOCK, "com", "/de/"))

LIMIT = 6
#: terms of ASCII letters and digits, and their weights
VOCABULARY = {
    "casino": 6, "porn": 6, "viagra": 6, "xxx": 6,
    "adult": 5, "bets": 4, "betting": 4, "pills": 4, "spam": 4, "ads": 3, "cheap": 3, "farm": 2, "free": 2, "track": 3, "win": 2, "x": 1,
}

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_PARTS = re.compile(r"([^/?#]*)([^?#]*)")
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path)."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, path = _PARTS.match(url, at + 3).groups()
    return host.translate(_LOWER), path


@dataclass(frozen=True)
class Rules:
    """Rules by their host."""

    of_host: dict[str, list[tuple[str, str]]]
    longest: int

    @classmethod
    def of(cls, rules: Iterable[tuple[str, str, str]]) -> Rules:
        of_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            of_host.setdefault(host.translate(_LOWER), []).append((path, verdict))
        return cls(of_host, max(map(len, of_host), default=0))

    def fitting(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule as text, its verdict) of the longest rule that fits."""
        best = (0, 0, None, None)
        # no longer ending of the host can name a rule, so a long host costs no more
        tail = host[-self.longest - 1 :] if len(host) > self.longest else "." + host
        at = tail.find(".")
        while at >= 0:
            name = tail[at + 1 :]
            for start, verdict in self.of_host.get(name, ()):
                if path.startswith(start):
                    best = max(best, (len(name) + len(start), len(name), name + start, verdict), key=lambda b: b[:2])
            at = tail.find(".", at + 1)
        return best[2:]


def term_counts(url: str | None, automaton: ahocorasick.Automaton) -> Counter:
    """Occurrences of each term that stands by itself."""
    found = Counter()
    if url and len(automaton):
        url = url.translate(_LOWER)
        for last, term in automaton.iter(url):
            before = last - len(term)
            if (before < 0 or url[before] not in _INNER) and (last + 1 == len(url) or url[last + 1] not in _INNER):
                found[term] += 1
    return found


def automaton_of(terms: Iterable[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term in terms:
        automaton.add_word(term, term)
    automaton.make_automaton()
    return automaton


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: Iterable[tuple[str, str, str]] = RULES,
               vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``page_id, host, path, rule, verdict, weight, terms``, a row for each page; ``terms`` has the term
    occurrences as ``term:count``, sorted, and ``weight`` is the sum of the distinct terms' weights."""
    known = Rules.of(rules)
    weights = {term.translate(_LOWER): weight for term, weight in vocabulary.items()}
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    text = lambda name: StructField(name, StringType())
    schema = StructType([StructField("page_id", rows.schema["page_id"].dataType), *map(text, ("host", "path", "rule", "verdict")), StructField("weight", LongType()), text("terms")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(weights)
        for batch in batches:
            out = []
            for address in batch.column("url").to_pylist():
                host, path = split_url(address)
                rule, verdict = known.fitting(host, path)
                found = term_counts(address, automaton)
                weight = sum(weights[term] for term in found)
                out.append((host, path, rule, verdict or (BLOCK if weight >= limit else ALLOW), weight, ",".join(f"{t}:{found[t]}" for t in sorted(found))))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)

    return rows.mapInArrow(run, schema)


def op11_url_vocabulary(spark, sf_dir: str) -> DataFrame:
    """``page_id, host, path, rule, verdict, weight`` of every page."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("terms")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = ", ".join(f"{{'t': '{t}', 'w': {w}}}" for t, w in VOCABULARY.items())
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP11_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
places AS (
    SELECT row_number() OVER () AS row, page_id, translate(coalesce(url, ''), '{_UPPER}', '{_UPPER.lower()}') AS low, strpos(coalesce(url, ''), '://') AS at,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           list_sum(list_transform(list_filter([{_TERMS}], lambda x: regexp_matches(low, '(^|[^a-z0-9])' || x.t || '($|[^a-z0-9])')), lambda x: x.w)) AS w
    FROM places),
fits AS (
    SELECT row, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS nth
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(f.verdict, CASE WHEN coalesce(w, 0) >= {LIMIT} THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict,
       CAST(coalesce(w, 0) AS BIGINT) AS weight
FROM parts p LEFT JOIN fits f ON f.row = p.row AND f.nth = 1
"""
