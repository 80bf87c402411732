"""URL checks and resolution, on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake.functions.binding import let

_SPECIAL = ["http", "https", "ftp", "ws", "wss"]
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"

# Characters that stay as they are inside a path, query or fragment.
_KEPT = "/:@!$&'()+,;=~|[]?#"


def _escape_for_java(url: Column) -> Column:
    loose = F.regexp_replace(F.trim(url), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.regexp_replace(loose, r'[\s"<>\\^`{|}]', "%20")


def is_valid_url(url: Column) -> Column:
    """Absolute URL with a scheme, and a host where the scheme needs one."""

    def check(u: Column) -> Column:
        scheme = F.lower(F.try_parse_url(u, F.lit("PROTOCOL")))
        hostless = ~scheme.isin(_SPECIAL)  # NULL without a scheme
        return hostless | (scheme.isNotNull() & F.try_parse_url(u, F.lit("HOST")).isNotNull())

    return F.coalesce(let(_escape_for_java(url), check), F.lit(False))


def percent_encode(part: Column) -> Column:
    """Encode what is not printable ASCII; keep separators and existing escapes."""

    def encode(p: Column) -> Column:
        encoded = F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))
        for ch in _KEPT:
            encoded = F.replace(encoded, F.lit(f"%{ord(ch):02X}"), F.lit(ch))
        encoded = F.replace(encoded, F.lit("%25"), F.lit("%"))
        return F.when(F.rlike(p, F.lit('[^!-~]|["<>`{}]')), encoded).otherwise(p)

    return let(part, encode)


def remove_dot_segments(path: Column) -> Column:
    """Fold ``.`` and ``..`` of an absolute path."""

    def step(acc: Column, seg: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
        return F.when(seg == "..", up).when(seg == ".", acc).otherwise(F.concat(acc, F.array(seg)))

    def fold(segments: Column) -> Column:
        below = F.slice(segments, F.lit(2), F.size(segments))
        open_end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
            F.array().cast("array<string>")
        )
        return F.array_join(F.concat(F.aggregate(below, F.array(F.lit("")), step), open_end), "/")

    def body(p: Column) -> Column:
        dotted = F.rlike(p, F.lit(r"(^|/)\.{1,2}(/|$)"))
        return F.when(dotted, let(F.split(p, "/"), fold)).otherwise(p)

    return let(path, body)


# scheme and authority | path | query and fragment
_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)(.*)$"


def _normal_url(url: Column) -> Column:
    """Host in lower case, a path at least "/", dot segments folded, escapes added."""

    def body(u: Column) -> Column:
        path = F.coalesce(F.nullif(F.regexp_extract(u, _URL, 2), F.lit("")), F.lit("/"))
        joined = F.concat(
            F.lower(F.regexp_extract(u, _URL, 1)),
            percent_encode(remove_dot_segments(path)),
            percent_encode(F.regexp_extract(u, _URL, 3)),
        )
        return F.when(F.contains(u, F.lit("://")), joined).otherwise(u)

    return let(url, body)


def resolve_href(href: Column, base: Column) -> Column:
    """``href`` against ``base`` as an absolute URL; NULL if that is impossible."""

    def body(x: Column) -> Column:
        h, b = x["h"], x["b"]
        origin = F.nullif(F.regexp_extract(b, _URL, 1), F.lit(""))
        base_path = F.coalesce(F.nullif(F.regexp_extract(b, _URL, 2), F.lit("")), F.lit("/"))
        base_query = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)", 1)
        return (
            F.when(F.rlike(h, F.lit(_SCHEME)), h)
            .when(F.startswith(h, F.lit("//")), F.concat(F.regexp_extract(origin, "^([^:]+:)", 1), h))
            .when(F.startswith(h, F.lit("/")), F.concat(origin, h))
            .when(F.startswith(h, F.lit("?")), F.concat(origin, base_path, h))
            .when((h == "") | F.startswith(h, F.lit("#")), F.concat(origin, base_path, base_query, h))
            .otherwise(F.concat(origin, F.regexp_replace(base_path, "[^/]*$", ""), h))
        )

    full = let(F.struct(F.trim(href).alias("h"), F.trim(base).alias("b")), body)
    return let(full, lambda u: F.when(is_valid_url(u), _normal_url(u)))
