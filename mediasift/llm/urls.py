"""URL filter: a trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mediasift.llm.common import map_text
from mediasift.sources.tables import table

#: A rule list is a hand-kept parameter; beyond this many entries it is refused before the broadcast.
MAX_RULES = 1_000_000

#: (host, path, verdict) of the registered query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    rest = (url or "").partition("://")[2]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    cut = min((i for i in (tail.find(c) for c in "?#") if i >= 0), default=len(tail))
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), tail[:cut]


class UrlTrie:
    """Host labels from the right, then path segments. A node is (children, entries, path root);
    ``entries`` maps the unfinished last piece of a rule's path to its rule, so a rule path is a plain
    string prefix while whole segments are walked once."""

    def __init__(self, rules):
        self.root = [{}, {}, None]
        for host, path, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node[0].setdefault(label, [{}, {}, None])
            if node[2] is None:
                node[2] = [{}, {}, None]
            node = node[2]
            *whole, last = path.split("/")
            for segment in whole:
                node = node[0].setdefault(segment, [{}, {}, None])
            old = node[1].get(last)
            if old is None or verdict == "block":  # the same entry twice: block wins
                node[1][last] = (host + path, verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule of the longest host, and on it of the longest path, that fits."""
        node, hosts = self.root, [self.root]
        for label in reversed(host.split(".")) if host else ():
            node = node[0].get(label)
            if node is None:
                break
            hosts.append(node)
        segments = path.split("/")
        for node in reversed(hosts):
            best, walk = None, node[2]
            for segment in segments:
                if walk is None:
                    break
                fits = [last for last in walk[1] if segment.startswith(last)]
                if fits:
                    best = walk[1][max(fits, key=len)]
                walk = walk[0].get(segment)
            if best:
                return best
        return None


def filter_urls(df: DataFrame, rules=RULES, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` (the rule's, else ``default``).

    Null URLs and URLs without ``://`` have an empty host and path, so only a rule for every host could
    fit them. Repeated rows and ties give equal results; the same rule given as allow and as block
    blocks. One map over the rows: no shuffle, and a hot host is just many rows.
    """
    rules = [tuple(r) for r in rules]
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def make():
        match = trie.value.match

        def run(urls):
            parts = [split_url(u) for u in urls]
            found = [match(h, p) or (None, default) for h, p in parts]
            return [h for h, _ in parts], [p for _, p in parts], [r for r, _ in found], [v for _, v in found]

        return run

    return map_text(df, url_col, "host string, path string, rule string, verdict string", make)


def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op7_url_filter": op7_url_filter}

ORACLE = {"op7_url_filter": r"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), b AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a
), c AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b
), d AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
  END AS rule FROM c
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM d"""}
