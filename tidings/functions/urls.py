"""URL expressions: canonical form, key and host."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track the reader.
TRACKING_PREFIX = "utm_"
TRACKING_NAMES = ("fbclid", "gclid", "msclkid", "mc_cid", "mc_eid")
# Default ports dropped from the authority.
DEFAULT_PORTS = {"http": "80", "https": "443"}
# Schemes written with "//" even when the authority is empty.
HIERARCHICAL = ("http", "https", "ftp", "sftp", "file", "ws", "wss", "rtsp", "git")

# RFC 3986, appendix B: scheme, authority, path, query; the fragment is left out.
_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_BLANKS = r"(?U)^[\s\x00-\x1f]+|[\s\x1c-\x1f]+$"


def _decode(piece: Column) -> Column:
    """Percent-decode; a ``%`` that starts no valid escape stays as it is."""
    safe = F.regexp_replace(piece, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), piece)


def _encode(piece: Column) -> Column:
    """Form encoding; unlike Java's, ``*`` is escaped and ``~`` is not."""
    text = F.url_encode(piece)
    return F.replace(F.replace(text, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _is_kept(name: Column) -> Column:
    lowered = F.lower(name)
    return ~lowered.isin(*TRACKING_NAMES) & ~F.startswith(lowered, F.lit(TRACKING_PREFIX))


def _canonical_query(query: Column) -> Column:
    pieces = F.filter(F.split(query, "&"), lambda piece: piece != "")
    pairs = F.transform(
        pieces,
        lambda piece: F.struct(
            _decode(F.get(F.split(piece, "=", 2), F.lit(0))).alias("name"),
            _decode(F.coalesce(F.get(F.split(piece, "=", 2), F.lit(1)), F.lit(""))).alias("value"),
        ),
    )
    kept = F.sort_array(F.filter(pairs, lambda pair: _is_kept(pair["name"])))
    texts = F.transform(
        kept, lambda pair: F.concat(_encode(pair["name"]), F.lit("="), _encode(pair["value"]))
    )
    return F.array_join(texts, "&")


def canonical_url(url: Column) -> Column:
    """The form of a URL that is equal for all spellings of one address.

    Scheme and authority in lower case, no default port, no trailing slashes, no fragment, no
    tracking parameters, other parameters sorted by name and value. Path case and user
    information are kept.
    """
    text = F.regexp_replace(F.regexp_replace(url, _BLANKS, ""), r"[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(text, _PARTS, 1))
    authority = F.lower(F.regexp_extract(text, _PARTS, 2))
    for name, port in DEFAULT_PORTS.items():
        bare = F.regexp_replace(authority, rf"^((?:.*@)?[^:@]*):{port}$", "$1")
        authority = F.when(scheme == name, bare).otherwise(authority)
    path = F.regexp_replace(F.regexp_extract(text, _PARTS, 3), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    rooted = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    # A path that itself begins with two slashes would else be read as an authority.
    has_authority = (
        (authority != "")
        | (scheme.isin(*HIERARCHICAL) & F.startswith(path, F.lit("/")))
        | F.startswith(path, F.lit("//"))
    )
    query = F.regexp_extract(text, _PARTS, 4)
    query = F.when(query == "", "").otherwise(_canonical_query(query))
    return F.concat(
        F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":"))),
        F.when(has_authority, F.concat(F.lit("//"), authority, rooted)).otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )


def url_key(url: Column) -> Column:
    """The key of an article: SHA-256 of its canonical URL, in hex."""
    return F.sha2(canonical_url(url), 256)


def url_host(url: Column) -> Column:
    """Host of a URL without user, port and path; empty when there is no dotted host."""
    host = F.regexp_extract(
        url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//)?(?:[^/?#@\s]*@)?([^/?#:@\s]+)", 1
    )
    return F.when(url.isNull(), None).when(host.rlike(r"\.[^.]+$"), host).otherwise("")
