"""Text Column helpers shared by search, overlap and URL operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: a token is a maximal run of letters or digits (lower-cased);
# words for shingles are maximal runs of non-whitespace.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
WORD_SPLIT = r"\s+"
EDGE_SPACE = r"^\s+|\s+$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text: Column | str) -> Column:
    """Lower-case letter/digit tokens, empty strings removed."""
    return F.array_remove(F.split(F.lower(_c(text)), TOKEN_SPLIT), "")


def words(text: Column | str) -> Column:
    """Whitespace-separated words of the whole text (no prefix cut)."""
    return F.array_remove(F.split(F.regexp_replace(_c(text), EDGE_SPACE, ""), WORD_SPLIT), "")


# Fixed list: query parameters that say where a visit came from, not what the page is.
TRACKING_PARAM = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def canonical_url(url: Column | str) -> Column:
    """Drop scheme, fragment, tracking parameters and trailing slashes of the path;
    lower-case the host; sort the other query parameters."""
    u = F.regexp_replace(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, r"#.*$", "")
    place = F.regexp_replace(F.regexp_extract(u, r"^([^?]*)", 1), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"^[^?]*\?(.*)$", 1), "&"),
                                   lambda p: (p != "") & ~p.rlike(TRACKING_PARAM)))
    host = F.regexp_extract(place, r"^([^/]*)", 1)
    return F.concat(F.lower(host), F.substring(place, F.length(host) + 1, 1 << 30),
                    F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))
